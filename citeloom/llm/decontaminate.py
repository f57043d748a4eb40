"""Benchmark decontamination: size-partitioned MinHash containment search, in DataFrame functions only.

A document leaks a test item if it contains at least CONTAINMENT of the item's distinct word shingles. Items are
partitioned by size, in powers of two. All items of a partition keep the same number k of their shingles with the smallest
hashes (a bottom-k MinHash sketch), with k so large that a document may miss every shingle that it is allowed to miss and
still must hold k - misses of the sketch. Document length plays no part, so short items are found in documents of any
length, and no leak is lost. Candidates are then verified on the shingles themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.bind import bind
from citeloom.session import materialise

SHINGLE = 5
CONTAINMENT = 0.8
#: Sketch entries (16 bytes each) and candidate pairs that are broadcast at most; beyond that, the joins shuffle.
BROADCAST_ROWS = 1_000_000
SEPARATORS = "[^\\p{L}\\p{N}]+"


def words(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS), lambda w: w != "")


def _starts(ws: Column, width: int) -> Column:
    return F.when(F.size(ws) >= width, F.sequence(F.lit(0), F.size(ws) - width)).otherwise(F.array().cast("array<int>"))


def _hashed(ws: Column, width: int) -> Column:
    """Hashes of all shingles of ``width`` words."""
    of_words = F.transform(ws, lambda w: F.xxhash64(w))
    return bind(
        of_words, lambda h: F.transform(_starts(h, width), lambda i: F.xxhash64(F.lit(width), *[F.get(h, i + j) for j in range(width)]))
    )


def _spelled(ws: Column, width: Column | int) -> Column:
    """Distinct shingles as text."""
    width = F.lit(width) if isinstance(width, int) else width
    starts = F.when(F.size(ws) >= width, F.sequence(F.lit(1), F.size(ws) - width + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(ws, i, width), " ")))


def allowed_misses(n: Column) -> Column:
    """Shingles of ``n`` that a leaking document may lack."""
    return n - F.ceil(n * F.lit(CONTAINMENT) - F.lit(1e-9)).cast("int")


def item_shingles(items: DataFrame) -> DataFrame:
    """(item_id, width, shingles, n) of each item with a word. Items of fewer than SHINGLE words are one shingle."""
    split = items.select(F.col("item_id"), words(F.col("text")).alias("ws")).where(F.size("ws") > 0).distinct()
    width = F.least(F.lit(SHINGLE), F.size("ws"))
    whole = split.select("item_id", width.alias("width"), _spelled(F.col("ws"), width).alias("shingles"))
    return whole.withColumn("n", F.size("shingles"))


def sketches(shingled: DataFrame) -> DataFrame:
    """(item_id, width, hash, least): the bottom-k sketch of each item and how many of its entries a leak must hold."""
    largest = F.pow(F.lit(2), F.ceil(F.log2("n"))).cast("int")  # largest size of the item's partition
    k = F.least(F.col("n"), allowed_misses(largest) + 1)
    hashes = F.transform("shingles", lambda s: bind(F.split(s, " "), lambda ws: F.get(F.flatten(F.array(*[
        F.when(F.col("width") == w, _hashed(ws, w)).otherwise(F.array().cast("array<bigint>")) for w in range(1, SHINGLE + 1)
    ])), F.lit(0))))
    kept = shingled.select("item_id", "width", "n", k.alias("k"), F.slice(F.array_sort(hashes), F.lit(1), k).alias("sketch"))
    least = F.greatest(F.lit(1), F.size("sketch") - allowed_misses(F.col("n")))
    return kept.select("item_id", "width", F.explode("sketch").alias("hash"), least.alias("least"))


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_found, containment) of each document that contains an item.

    ``docs`` needs (doc_id, text), ``items`` (item_id, text); other columns are not looked at. Words are runs of letters and
    digits in lower case. Null, empty and wordless texts contain nothing, and such items are contained nowhere. Items of
    fewer than five words are found as a whole. Rows with a repeated id give one row per id and item, with the highest
    containment. Empty tables give an empty table.
    """
    shingled = materialise(item_shingles(items), "item-shingles")
    sketch = materialise(sketches(shingled), "item-sketches")
    size = sketch.count()
    widths = [r["width"] for r in sketch.select("width").distinct().collect()]  # five at most
    if not widths:
        widths = [SHINGLE]
    hashes = bind(words(F.col("text")), lambda ws: F.flatten(F.array(*[_hashed(ws, w) for w in widths])))
    exploded = docs.select("doc_id", F.explode(hashes).alias("hash"))
    small = F.broadcast(sketch) if size <= BROADCAST_ROWS else sketch
    hits = exploded.join(small, "hash").groupBy("doc_id", "item_id", "least", "hash").agg(F.lit(1).alias("one"))
    pairs = hits.groupBy("doc_id", "item_id").agg(F.count("*").alias("held"), F.min("least").alias("least"))
    pairs = materialise(pairs.where("held >= least").select("doc_id", "item_id"), "leak-candidates")
    few = pairs.count() <= BROADCAST_ROWS
    texts = docs.select("doc_id", "text").join(F.broadcast(pairs) if few else pairs, "doc_id")
    checked = texts.join(F.broadcast(shingled) if size <= BROADCAST_ROWS else shingled, "item_id")
    own = bind(words(F.col("text")), lambda ws: _spelled(ws, F.col("width")))
    found = checked.select("doc_id", "item_id", F.col("n").cast("long").alias("n_shingles"), F.size(F.array_intersect("shingles", own)).cast("long").alias("n_found"))
    best = found.groupBy("doc_id", "item_id").agg(F.max("n_shingles").alias("n_shingles"), F.max("n_found").alias("n_found"))
    scored = best.withColumn("containment", F.col("n_found") / F.col("n_shingles"))
    return scored.where(F.col("n_found") >= F.col("n_shingles") - allowed_misses(F.col("n_shingles").cast("int")))


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the documents that contain an item; rows without an id stay."""
    found = materialise(leaks(docs, items).select("doc_id").distinct(), "leaking-documents")
    small = F.broadcast(found) if found.count() <= BROADCAST_ROWS else found
    return docs.join(small, "doc_id", "left_anti").select(docs.columns)
