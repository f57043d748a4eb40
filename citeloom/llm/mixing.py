"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame functions only.

Each source's documents are shuffled by a hash, laid end to end and cut into blocks of equal numbers of words. The mix is a
row of slots of one block each. Slot t has the golden-ratio point frac(t * phi); the cumulative target weights map
it to a source, so every stretch of the mix holds each source in nearly its share. The slots of a source are ranked, and
rank r takes block r, starting over when the source is through. The mix is the join of slots and blocks.

No source is one group: places inside a source and ranks of slots are running counts over pieces of bounded size, whose
totals are summed first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.common import n_words, placed
from citeloom.session import materialise

#: Weights of sources in code point order, repeating; null comes last.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_PASSES = 2
#: A source is cut into so many blocks at least (or into its words); a block has MOST_BLOCK words at most.
SOURCE_BLOCKS, MOST_BLOCK = 64, 4096
#: Rows of one running count.
PIECE = 16_384
#: The golden ratio's fraction as a multiple of 2^-32; odd, so that 2^32 points in a row all differ.
GOLDEN = 2_654_435_769


@dataclass(frozen=True)
class Mix:
    """``targets`` per source, documents with their ``places``, and the ``schedule`` of slots of one block; ``block_words`` of a place is its source's."""

    targets: DataFrame
    places: DataFrame
    schedule: DataFrame


def source_targets(sizes: DataFrame) -> DataFrame:
    """Target words per source from (source, source_size, docs).

    Sources share SHARE of all words by weight; what a source can't take beyond MOST_PASSES times its size goes to the
    others by weight, until none is above. That is one level L with target = min(MOST_PASSES * size, L * weight):
    sources are sorted by the level that fills them, and L follows from the sums of those before. One row per source is
    sorted; running sums combine rows of one source only.
    """
    numbered = placed(sizes, [F.col("source").isNull(), F.col("source")], {"number": F.lit(1)}, "source-numbers")
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.pmod("number", F.lit(len(WEIGHTS))) + 1).cast("int"))
    full = F.col("source_size") * F.lit(MOST_PASSES) / F.col("weight")
    weighed = numbered.withColumn("weight", weight).drop("number").withColumn("full", full)
    amounts = {"filled": F.col("source_size"), "passed": F.col("weight")}
    levels = placed(weighed, [F.col("full"), F.col("source").isNull(), F.col("source")], amounts, "source-levels")
    total = levels.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    size, weights = total["size"] or 0, total["weight"] or 0
    level = (F.lit(size).cast("long") * F.lit(SHARE) - F.col("filled") * F.lit(MOST_PASSES)) / (F.lit(weights).cast("long") - F.col("passed"))
    open_ = levels.withColumn("level", level).where("level < full").agg(F.min(F.struct("full", "level")).alias("m")).first()["m"]
    most = F.col("source_size") * F.lit(float(MOST_PASSES))
    top = most if open_ is None else F.least(F.lit(open_["level"]) * F.col("weight"), most)
    return levels.select("source", "source_size", "docs", top.cast("double").alias("target"))


def _running(df: DataFrame, keys: list[str], piece: str, order: list[str], amount: str, name: str) -> DataFrame:
    """Sum of ``amount`` over the earlier rows of a key. Pieces are ordered and bounded; only their totals meet."""
    totals = df.groupBy(*keys, piece).agg(F.sum(amount).alias("_total"))
    before = Window.partitionBy(*keys).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col(piece).alias("_piece"), F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy(*keys, piece).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumn(name, F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col(piece) == F.col("_piece")]
    out = local.join(offsets, same).withColumn(name, F.col(name) + F.col("_offset"))
    return out.drop("_offset", "_piece", *[f"_{k}" for k in keys])


def _golden_point(slot: Column) -> Column:
    """frac((slot + 1) * phi) in units of 2^-32, by halves of 16 bits so that no product overflows."""
    k = F.pmod(slot + 1, F.lit(1 << 32))
    high, low = F.floor(k / F.lit(1 << 16)), F.pmod(k, F.lit(1 << 16))
    return F.pmod(F.pmod(high * F.lit(GOLDEN), F.lit(1 << 16)) * F.lit(1 << 16) + low * F.lit(GOLDEN), F.lit(1 << 32))


def _bounds(targets: DataFrame) -> DataFrame:
    """Stretch of points 0 to 2^32 of each source, by its share of all ``slots``."""
    units = F.round(F.col("slots") * F.lit(float(1 << 20))).cast("long")  # whole numbers, so that sums agree in any order
    summed = placed(targets.withColumn("units", units), [F.col("source").isNull(), F.col("source")], {"before": F.col("units")}, "source-bounds")
    total = F.lit(summed.agg(F.sum("units")).first()[0])
    point = lambda upto: F.round(upto / total * F.lit(float(1 << 32))).cast("long")
    return summed.withColumn("low", point(F.col("before"))).withColumn("high", point(F.col("before") + F.col("units")))


def plan_mix(docs: DataFrame, id_col: str = "doc_id", sizes: Column | None = None) -> Mix:
    """The mix of ``docs`` (doc_id, text, source); see ``taken_words`` for its cases.

    Each source has blocks of a size of its own, which cuts it into SOURCE_BLOCKS blocks or more and does not depend on the
    other sources. A source has as many slots as
    its target has blocks, so it meets its own target at every corpus size. ``sizes`` are the words of the texts, counted unless they are given.
    """
    counted = n_words(F.col("text")) if sizes is None else sizes
    sized = materialise(docs.select(F.col(id_col).alias("doc_id"), "source", counted.alias("size")), "doc-sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    block = F.greatest(F.lit(1), F.least(F.lit(MOST_BLOCK), F.floor(F.col("source_size") / SOURCE_BLOCKS))).cast("long")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("source_size") / block))
    passes = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = materialise(source_targets(sizes).withColumn("block_words", block).withColumn("blocks", blocks).withColumn("slots", passes * F.col("blocks")), "source-targets")
    known = targets.select(F.col("source").alias("_source"), "source_size", "target", "docs", "block_words")
    # The hash deals documents evenly over pieces; rows of one id stay in one piece.
    digest = F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 10), 16, 10)
    pieces = F.greatest(F.lit(1), F.ceil(F.col("docs") * 4 / PIECE))
    joined = sized.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn("_hash", digest.cast("long"))
    shuffled = joined.withColumn("_piece_no", F.floor(F.col("_hash") / F.lit(float(1 << 40)) * pieces))
    located = _running(shuffled, ["source"], "_piece_no", ["_hash", "doc_id", "size"], "size", "start")
    places = materialise(located.drop("_hash", "_piece_no", "docs"), "doc-places")
    n_slots = round(targets.agg(F.coalesce(F.sum("slots"), F.lit(0.0))).first()[0])
    # Slots and sources meet by cells of the circle of points, four a source, so that a slot is compared with the few of its cell.
    cell = max(1, (1 << 30) >> max(10, targets.count().bit_length()))
    reach = F.sequence(F.floor(F.col("low") / cell), F.floor((F.col("high") - 1) / cell))
    cells = _bounds(targets).where("high > low").select("source", "blocks", "low", "high", F.explode(reach).alias("cell"))
    slots = docs.sparkSession.range(n_slots).select(F.col("id").alias("slot"), _golden_point(F.col("id")).alias("point"))
    dealt = slots.withColumn("cell", F.floor(F.col("point") / cell)).join(cells, "cell").where("point >= low and point < high")
    dealt = dealt.select("slot", "source", "blocks", F.lit(1).alias("_one"), F.floor(F.col("slot") / PIECE).alias("_piece_no"))
    ranked = _running(dealt, ["source"], "_piece_no", ["slot"], "_one", "rank")
    schedule = ranked.select(
        "slot", "source", F.pmod("rank", "blocks").cast("long").alias("block"), F.floor(F.col("rank") / F.col("blocks")).alias("pass")
    )
    return Mix(targets, places, schedule.where(F.col("pass") < MOST_PASSES))


def _cut(mix: Mix) -> DataFrame:
    """Documents with the blocks that they lie in: ``words`` words from ``offset`` on are in ``block``."""
    end_at = F.col("start") + F.col("size")
    size = F.col("block_words")
    last = F.floor((F.greatest(end_at, F.col("start") + 1) - 1) / size)
    cut = mix.places.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / size), last)))
    begin = F.greatest(F.col("start"), F.col("block") * size)
    end = F.least(end_at, (F.col("block") + 1) * size)
    return cut.withColumn("offset", begin - F.col("start")).withColumn("words", end - begin)


def mix_pieces(mix: Mix) -> DataFrame:
    """The mix itself: in ``slot`` stand ``words`` words of a document from its word ``offset`` on, in order of ``start``."""
    slots = mix.schedule.select("slot", F.col("source").alias("_source"), F.col("block").alias("_block"))
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block"))
    return _cut(mix).where("size > 0").join(slots, same).select("slot", "doc_id", "source", "start", "offset", "words")


def taken_words(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, source, size, source_size, target, taken): the words that the mix takes from each row of ``docs``.

    Null and empty texts have size 0 and nothing is taken from them. A null source is a source, the last one; sources of
    size 0 have target 0. Repeated rows are documents of their own; rows that agree in id, size and source may swap their
    shares. Other columns are not looked at. An empty table gives an empty table. Reruns agree, as order, cuts
    and slots depend on values only. A document is taken twice at most, and a source's words miss its target by a few
    of its own blocks. Sources may be as many as documents: they are ranked and summed by range partitions.
    """
    mix = plan_mix(docs, id_col)
    times = mix.schedule.groupBy(F.col("source").alias("_source"), F.col("block").alias("_block")).agg(F.count("*").alias("times"))
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block"))
    keys = ["doc_id", "source", "size", "source_size", "target"]
    cut = _cut(mix).where("size > 0").join(times, same, "left")
    taken = cut.groupBy(*keys, "start").agg(F.sum(F.col("words") * F.coalesce("times", F.lit(0))).cast("long").alias("taken"))
    none = mix.places.where("size = 0").select(*keys, F.lit(0).cast("long").alias("taken"))
    return taken.select(*keys, "taken").unionByName(none)
