"""Unique file names: repeated stems get ``_2``, ``_3`` and so on, in row order.

The rule is sequential (a name that is in use at its turn is skipped), but only rows of one stem, and
stems of the form ``stem_2`` next to ``stem``, touch each other. Rows are ranked with block-wise
counting, and the clashes between stems are solved from counts alone: no task ever walks all rows of
a frequent stem. Numbers that a stem has to skip are rows, sorted by number and walked with a counter
as only memory; each skipped number ends a free range, and a row finds its range by a running count
in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeloom.operators.joins import lookup_join
from citeloom.operators.order import DEFAULT_BLOCK_ROWS, rank_in_key
from citeloom.session import materialise

# A suffix as it is handed out: an underscore and a number from 2 on, without leading zeros.
SUFFIX = r"_([2-9]|[1-9][0-9]{1,8})$"


def _rows_before(rows: DataFrame, marks: DataFrame, block_rows: int) -> DataFrame:
    """For every mark ``(stem, at, ...)`` the number of rows ``(stem, ord)`` with a smaller order value."""
    extra = [c for c in marks.columns if c not in ("stem", "at")]
    both = rows.select("stem", F.col("ord").alias("at"), F.lit(1).alias("is_row"),
                       F.lit(None).cast(marks.select(F.struct(*extra)).schema[0].dataType).alias("mark")).unionByName(
        marks.select("stem", "at", F.lit(0).alias("is_row"), F.struct(*extra).alias("mark"))
    )
    blocked = both.withColumn("_block", F.floor(F.col("at") / block_rows))
    prior = Window.partitionBy("stem").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        blocked.groupBy("stem", "_block").agg(F.sum("is_row").alias("_n"))
        .select("stem", "_block", F.coalesce(F.sum("_n").over(prior), F.lit(0)).alias("_offset"))
    )
    inner = Window.partitionBy("stem", "_block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    counted = blocked.withColumn("_inner", F.sum("is_row").over(inner)).filter("is_row = 0")
    return counted.join(offsets, ["stem", "_block"]).select(
        "stem", "at", "mark.*", (F.col("_offset") + F.col("_inner")).alias("rows_before")
    )


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Decide about numbered stems; rows (stem, k, child, need, before) come sorted by stem and k.

    ``need`` rows of the stem want a suffix, ``before`` of them come ahead of the child's first row. A number whose turn comes
    after that row is skipped, one that is handed out earlier displaces the child. Memory is one counter.
    """
    stem, skipped = None, 0
    for batch in batches:
        out = []
        for name, k, child, need, before in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if name != stem:
                stem, skipped = name, 0
            place = k - 1 - skipped
            if place <= need:
                skip = place > before
                out.append((name, k, child, place, skip))
                skipped += skip
        columns = list(zip(*out, strict=True)) or [()] * 5
        types = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["stem", "k", "child", "place", "skip"])


def _marks_upto(rows: DataFrame, marks: DataFrame, block_rows: int) -> DataFrame:
    """Adds ``passed`` to rows ``(stem, place, ...)``: how many marks ``(stem, place)`` stand at its place or before."""
    rest = [c for c in rows.columns if c not in ("stem", "place")]
    row = rows.select("stem", "place", F.lit(0).alias("is_mark"), F.struct(*rest).alias("row"))
    none = F.lit(None).cast(row.schema["row"].dataType)
    both = row.unionByName(marks.select("stem", "place", F.lit(1).alias("is_mark"), none.alias("row"))).withColumn("_block", F.floor(F.col("place") / block_rows))
    prior = Window.partitionBy("stem").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        both.groupBy("stem", "_block").agg(F.sum("is_mark").alias("_n"))
        .select("stem", "_block", F.coalesce(F.sum("_n").over(prior), F.lit(0)).alias("_offset"))
    )
    # A range frame counts the marks of the row's own place too.
    inner = Window.partitionBy("stem", "_block").orderBy("place").rangeBetween(Window.unboundedPreceding, 0)
    counted = both.withColumn("_inner", F.sum("is_mark").over(inner)).filter("is_mark = 0")
    return counted.join(offsets, ["stem", "_block"]).select("stem", "place", "row.*", (F.col("_offset") + F.col("_inner")).alias("passed"))


def unique_names(rows: DataFrame, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Adds ``name`` to rows ``(stem, ord)``; ``ord`` is unique.

    Whether a numbered stem is displaced depends on whether its own parent is, so decisions are taken in rounds until they
    stay; there are as many as stems show suffixes behind one another, and each is written before the next.
    """
    ranked = rank_in_key(rows, ["stem"], "ord", "stem_rank", block_rows)
    stems = materialise(rows.groupBy("stem").agg(F.count("*").alias("n"), F.min("ord").alias("first")), "stems")
    pairs = stems.select(
        F.regexp_replace("stem", SUFFIX, "").alias("stem"), F.col("stem").alias("child"),
        F.regexp_extract("stem", SUFFIX, 1).try_cast("bigint").alias("k"), F.col("first").alias("at"),
    ).filter(F.col("k").isNotNull())
    children = materialise(
        _rows_before(rows, pairs.join(stems.select("stem"), "stem", "left_semi"), block_rows).join(stems.select("stem", "n"), "stem"), "numbered-stems"
    )
    # displaced: the plain name of the stem was already handed out as a suffix of its parent stem.
    displaced = stems.select("stem").where("false")
    decided = None
    while decided is None or not _same(decided.where("NOT skip").select(F.col("child").alias("stem")), displaced):
        if decided is not None:
            displaced = decided.where("NOT skip").select(F.col("child").alias("stem"))
        # Rows of a stem that need a suffix, and how many of them come before the child's first row.
        level = lookup_join(children, displaced.withColumn("_lost", F.lit(1)), ["stem"])
        free = F.when(F.col("_lost").isNull(), 1).otherwise(0)
        asked = level.select("stem", "k", "child", (F.col("n") - free).alias("need"), F.greatest(F.col("rows_before") - free, F.lit(0)).alias("before"))
        sorted_ = asked.repartition("stem").sortWithinPartitions("stem", "k")
        decided = materialise(sorted_.mapInArrow(_walk, "stem string, k bigint, child string, place bigint, skip boolean"), "decided-stems")
    place = F.col("stem_rank") - F.when(F.col("_lost").isNull(), 1).otherwise(0)
    placed = lookup_join(ranked, displaced.withColumn("_lost", F.lit(1)), ["stem"]).withColumn("place", place).drop("_lost", "stem_rank")
    counted = _marks_upto(placed, decided.where("skip").select("stem", "place"), block_rows)
    suffix = F.col("place") + 1 + F.col("passed")
    name = F.when(F.col("place") == 0, F.col("stem")).otherwise(F.concat_ws("_", "stem", suffix.cast("string")))
    return counted.withColumn("name", name).select(*rows.columns, "name")


def _same(a: DataFrame, b: DataFrame) -> bool:
    """Whether two sets of distinct stems are the same."""
    return a.join(b, "stem", "left_anti").isEmpty() and b.join(a, "stem", "left_anti").isEmpty()
