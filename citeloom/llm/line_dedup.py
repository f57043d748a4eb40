"""Reversible line dedup: exact reference counts of line keys, and sharded cuckoo filters over the frequent ones.

The state of the index is two tables in the shared folder. ``counts`` holds every key with the number of documents
that contain it; it is exact and can be added to and taken from. ``filters`` holds one cuckoo filter per shard with
the keys at or above the threshold. Cuckoo filters can delete, so a change of documents only edits the entries of
keys that cross the threshold.

Dropping lines needs no shuffle of texts or lines: filters are sent to the tasks in groups of shards of a stated
size, and every group is one narrow pass over the documents. A filter may answer yes for a key that it doesn't
hold. Since ``counts`` knows all keys of the corpus, these false answers are found beforehand by asking the
filters about all other keys, and are listed as exceptions; the answers are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.llm.common import BLANKS, map_columns
from citeloom.session import materialise

SLOTS = 4
SHARD_KEYS = 65_536
#: Bytes of filters that one pass sends to every task.
GROUP_BYTES = 64 << 20
FILTER_SCHEMA = "shard long, keys long, cells binary"
KEY_SCHEMA = "hi long, lo long"


@dataclass(frozen=True)
class LineIndex:
    """Reference counts and filters of all documents inserted so far; ``shards`` and ``buckets`` are the filters' shape."""

    counts: DataFrame
    filters: DataFrame
    min_docs: int
    shards: int
    buckets: int


def line_digests(text: str | None) -> tuple[list[str], list[bytes]]:
    """Lines of a text and the 128-bit digest of each line's key (empty for a blank line)."""
    lines = (text or "").split("\n")
    digest = xxhash.xxh3_128_digest
    return lines, [digest(k.encode().lower()) if (k := line.strip(BLANKS)) else b"" for line in lines]


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    words = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return words[:, 0], words[:, 1]


def key_counts(docs: DataFrame) -> DataFrame:
    """Number of documents (rows of ``docs``) that contain each key, combined before the shuffle."""

    def keys(batch: pa.RecordBatch) -> dict:
        found: list[bytes] = []
        for text in batch.column(0).to_pylist():
            found.extend({d for d in line_digests(text)[1] if d})
        hi, lo = _halves(found)
        return {"hi": hi, "lo": lo}

    return map_columns(docs.select("text"), keys, KEY_SCHEMA).groupBy("hi", "lo").agg(F.count("*").alias("docs"))


def _places(hi: np.ndarray, lo: np.ndarray, shards: int, buckets: int) -> tuple[np.ndarray, ...]:
    """Shard, both buckets and fingerprint of keys. Either bucket follows from the other one and the fingerprint."""
    low = lo.view(np.uint64)
    mark = (low >> np.uint64(32)).astype(np.uint32)
    mark[mark == 0] = 1
    first = (low & np.uint64(buckets - 1)).astype(np.int64)
    shard = (hi.view(np.uint64) % np.uint64(shards)).astype(np.int64)
    return shard, first, first ^ _jump(mark, buckets), mark


def _jump(mark: np.ndarray, buckets: int) -> np.ndarray:
    """Distance of the two buckets of a fingerprint; odd, so never zero where there is more than one bucket."""
    mixed = (mark.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    return ((mixed | np.uint64(1)) & np.uint64(buckets - 1)).astype(np.int64)


def cuckoo_insert(cells: np.ndarray, first: np.ndarray, second: np.ndarray, mark: np.ndarray) -> None:
    """Put fingerprints into a filter of ``buckets`` x SLOTS cells, moving others to their second bucket where needed."""
    buckets = len(cells)
    rows = cells.tolist()
    for a, b, m in zip(first.tolist(), second.tolist(), mark.tolist(), strict=True):
        for turn in range(1000):
            row = rows[a] if 0 in rows[a] else rows[b]
            if 0 in row:
                row[row.index(0)] = m
                break
            row = rows[b]
            out, row[turn % SLOTS] = row[turn % SLOTS], m
            a, m = b, out
            b = a ^ int(_jump(np.array([m], np.uint32), buckets)[0])
        else:
            raise OverflowError("cuckoo filter is full")
    cells[:] = rows


def cuckoo_delete(cells: np.ndarray, first: np.ndarray, second: np.ndarray, mark: np.ndarray) -> None:
    """Take one copy of each fingerprint out of its buckets."""
    for a, b, m in zip(first.tolist(), second.tolist(), mark.tolist(), strict=True):
        for at in (a, b):
            if len(hit := np.flatnonzero(cells[at] == m)):
                cells[at, hit[0]] = 0
                break
        else:
            raise KeyError("fingerprint isn't in the filter")


def _edit(shards: int, buckets: int):
    def edit(old: pd.DataFrame, change: pd.DataFrame) -> pd.DataFrame:
        cells, keys = np.zeros((buckets, SLOTS), np.uint32), 0
        if len(old):
            cells, keys = np.frombuffer(old["cells"].iloc[0], np.uint32).reshape(buckets, SLOTS).copy(), int(old["keys"].iloc[0])
        for sign, act in ((-1, cuckoo_delete), (1, cuckoo_insert)):
            part = change[change["sign"] == sign]
            _, *places = _places(part["hi"].to_numpy(np.int64), part["lo"].to_numpy(np.int64), shards, buckets)
            act(cells, *places)
            keys += sign * len(part)
        shard = (old if len(old) else change)["shard"].iloc[0]
        return pd.DataFrame({"shard": [shard], "keys": [keys], "cells": [cells.tobytes()]})

    return edit


def _edited(filters: DataFrame | None, changes: DataFrame, shards: int, buckets: int) -> DataFrame:
    """Filters after the changes (hi, lo, sign). A shard holds some SHARD_KEYS keys, as their number sets the shards."""
    by_shard = changes.withColumn("shard", F.expr(f"cast(pmod(cast(hi as decimal(20,0)) + if(hi < 0, 18446744073709551616BD, 0BD), {shards}) as long)"))
    old = filters if filters is not None else changes.sparkSession.createDataFrame([], FILTER_SCHEMA)
    return materialise(
        old.groupBy("shard").cogroup(by_shard.groupBy("shard")).applyInPandas(_edit(shards, buckets), FILTER_SCHEMA), "line-filters"
    )


def empty_index(spark: SparkSession, min_docs: int = 10) -> LineIndex:
    """An index without documents."""
    if min_docs < 1:
        raise ValueError("min_docs must be 1 or more")
    none = spark.createDataFrame([], f"{KEY_SCHEMA}, docs long")
    return LineIndex(none, spark.createDataFrame([], FILTER_SCHEMA), min_docs, 1, 0)


def _changed(index: LineIndex, docs: DataFrame, sign: int) -> LineIndex:
    new = key_counts(docs).select("hi", "lo", (F.col("docs") * sign).alias("docs"), F.lit(0).cast("long").alias("was"))
    old = index.counts.select("hi", "lo", "docs", F.col("docs").alias("was"))
    merged = new if index.buckets == 0 else old.unionByName(new).groupBy("hi", "lo").agg(F.sum("docs").alias("docs"), F.sum("was").alias("was"))
    counts = materialise(merged, "line-counts")
    now, was = F.col("docs") >= index.min_docs, F.col("was") >= index.min_docs
    found = counts.agg(
        F.count_if(now).alias("hot"), F.count_if(now != was).alias("moved"), F.min("docs").alias("least")
    ).first()
    if (found["least"] or 0) < 0:
        raise ValueError("documents to delete were not inserted")
    hot = found["hot"]
    kept = counts.where("docs > 0").select("hi", "lo", "docs")
    if index.buckets and hot <= 0.8 * index.shards * index.buckets * SLOTS and hot * 16 >= index.shards * index.buckets:
        changes = counts.where(now != was).select("hi", "lo", F.when(now, 1).otherwise(-1).alias("sign"))
        filters = _edited(index.filters, changes, index.shards, index.buckets) if found["moved"] else index.filters
        return LineIndex(kept, filters, index.min_docs, index.shards, index.buckets)
    shards = max(1, -(-hot // SHARD_KEYS))  # built anew from the exact counts: too full, or far too large
    buckets = 1 << max(4, int(np.ceil(np.log2(max(1, hot / shards) * 1.6 / SLOTS))))
    changes = counts.where(now).select("hi", "lo", F.lit(1).alias("sign"))
    return LineIndex(kept, _edited(None, changes, shards, buckets), index.min_docs, shards, buckets)


def insert_documents(index: LineIndex, docs: DataFrame) -> LineIndex:
    """The index with the lines of ``docs`` counted as well."""
    return _changed(index, docs, 1)


def delete_documents(index: LineIndex, docs: DataFrame) -> LineIndex:
    """The index without ``docs``, which must have been inserted with the same texts; lines come back below the threshold."""
    return _changed(index, docs, -1)


def _answers(cells: np.ndarray, held: np.ndarray, shards: int, buckets: int, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """Whether the filters of the group say yes. ``held``: the row of ``cells`` of each shard, -1 for other groups."""
    shard, first, second, mark = _places(hi, lo, shards, buckets)
    row = held[shard]
    yes = ((cells[row, first] == mark[:, None]) | (cells[row, second] == mark[:, None])).any(axis=1)
    return yes & (row >= 0)


def drop_frequent_lines(docs: DataFrame, index: LineIndex, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``docs`` without the lines whose key is frequent in ``index``, which must hold these documents.

    A line's key is the line without white space at its ends, A-Z in lower case. Adds ``n_lines`` and ``n_dropped``; if
    ``docs`` has columns of these names, they are replaced. All other columns stay, whatever their names. A null text stays null and counts as
    one line; an empty text is one line; a text that loses all lines is empty. Repeated rows count as documents of their
    own. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    shards, buckets = index.shards, max(1, index.buckets)
    base = docs.drop("n_lines", "n_dropped")
    gone = "_gone"
    while gone in base.columns:
        gone += "_"
    marked = base.withColumn(gone, F.lit(b""))
    per_group = max(1, group_bytes // (buckets * SLOTS * 4))
    cold = index.counts.where(F.col("docs") < index.min_docs).select("hi", "lo")
    for start in range(0, shards if index.buckets else 0, per_group):
        rows = index.filters.where(F.col("shard").between(start, start + per_group - 1)).select("shard", "cells").collect()
        cells = np.zeros((len(rows) + 1, buckets, SLOTS), np.uint32)
        held = np.full(shards, -1, np.int64)
        for i, r in enumerate(rows):
            cells[i], held[r["shard"]] = np.frombuffer(r["cells"], np.uint32).reshape(buckets, SLOTS), i
        sent = sc.broadcast((cells, held))

        def wrong(batch: pa.RecordBatch, sent=sent) -> dict:
            hi, lo = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            yes = _answers(*sent.value, shards, buckets, hi, lo)
            return {"hi": hi[yes], "lo": lo[yes]}

        # Of N other keys, some N / 500 million get a false answer from 32-bit fingerprints.
        false = sc.broadcast({(r["hi"], r["lo"]) for r in map_columns(cold, wrong, KEY_SCHEMA).collect()})
        marked = _marked(marked, gone, sent, false, shards, buckets)
        if start + per_group < shards:
            marked = materialise(marked, "line-marks")
    return _without(marked, gone)


def _marked(docs: DataFrame, marks_col: str, sent, false, shards: int, buckets: int) -> DataFrame:
    """``marks_col`` with one byte per line, set also where this group of filters holds the line's key."""
    at, gone = docs.columns.index("text"), docs.columns.index(marks_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, sizes = [], []
            for text in batch.column(at).to_pylist():
                own = line_digests(text)[1]
                digests.extend(own)
                sizes.append(len(own))
            filled = [d or bytes(16) for d in digests]
            hi, lo = _halves(filled)
            yes = _answers(*sent.value, shards, buckets, hi, lo) & np.array([bool(d) for d in digests], bool)
            for i in np.flatnonzero(yes) if false.value else ():
                yes[i] = (int(hi[i]), int(lo[i])) not in false.value
            marks, ends = yes.astype(np.uint8).tobytes(), np.cumsum(sizes).tolist()
            out = []
            for end, n, old in zip(ends, sizes, batch.column(gone).to_pylist(), strict=True):
                own = marks[end - n : end]
                out.append(bytes(x | y for x, y in zip(old, own, strict=True)) if old else own)
            yield batch.set_column(gone, marks_col, pa.array(out, pa.binary()))

    return docs.mapInArrow(run, docs.schema)


def _without(marked: DataFrame, marks_col: str) -> DataFrame:
    at, gone = marked.columns.index("text"), marked.columns.index(marks_col)
    keep = [i for i in range(len(marked.columns)) if i != gone]
    names = [marked.columns[i] for i in keep] + ["n_lines", "n_dropped"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, marks = batch.column(at).to_pylist(), batch.column(gone).to_pylist()
            lines, dropped = [], []
            for i, (text, mark) in enumerate(zip(texts, marks, strict=True)):
                lines.append((text or "").count("\n") + 1)
                dropped.append(sum(mark))
                if dropped[-1]:
                    texts[i] = "\n".join(x for x, m in zip(text.split("\n"), mark, strict=True) if not m)
            columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], names)

    schema = marked.drop(marks_col).schema.add("n_lines", "long").add("n_dropped", "long")
    return marked.mapInArrow(run, schema)


def dedup_lines(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """``docs`` without the lines found in at least ``min_docs`` of them; see ``drop_frequent_lines``."""
    return drop_frequent_lines(docs, insert_documents(empty_index(docs.sparkSession, min_docs), docs))
