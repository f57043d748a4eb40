"""Order-aware operators that stay exact when one key holds a large share of all rows.

Order is always an explicit column. Where a rank or a running value is needed over one key, rows are
cut into blocks of at most ``block_rows`` consecutive order values; blocks are summarised first (with
map-side partial aggregation), and only the summaries of a key meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BLOCK_ROWS = 1_000_000


def _others(df: DataFrame, keys: list[str]) -> list[str]:
    return [c for c in df.columns if c not in keys]


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the smallest order value of every key. Partial aggregation, so a hot key costs one row per task."""
    rest = _others(df, keys)
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the largest order value of every key."""
    rest = _others(df, keys)
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def best_per_key(df: DataFrame, keys: list[str], score: str, order: str) -> DataFrame:
    """Highest score of every key, the earliest row on ties."""
    rest = _others(df, keys)
    rank = F.struct(F.col(score), (-F.col(order)).alias("_neg"))
    best = F.max_by(F.struct(*rest), rank).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def top_n_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows of every key. Catalyst turns the filter into a group limit before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def rank_in_key(
    df: DataFrame, keys: list[str], ord_col: str, name: str = "rank", block_rows: int = DEFAULT_BLOCK_ROWS
) -> DataFrame:
    """Exact ``row_number`` of every key over a unique integer order column."""
    blocked = df.withColumn("_block", F.floor(F.col(ord_col) / block_rows))
    return rank_in_blocks(blocked, block_counts(blocked, keys), keys, [ord_col], name)


def block_counts(blocked: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (``_rows``) of every key and ``_block``."""
    return blocked.groupBy(*keys, "_block").agg(F.count("*").alias("_rows"))


def rank_in_blocks(blocked: DataFrame, counts: DataFrame, keys: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """Exact ``row_number`` of every key over ``order``, which ``_block`` must follow; ``counts`` are the block counts."""
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    inside = Window.partitionBy(*keys, "_block").orderBy(*order)
    ranked = blocked.withColumn("_inner", F.row_number().over(inside))
    return (
        ranked.join(offsets, [*keys, "_block"])
        .withColumn(name, (F.col("_offset") + F.col("_inner")).cast("bigint"))
        .drop("_block", "_inner", "_offset")
    )


def place_in_runs(df: DataFrame, key: str, ord_col: str, name: str = "place") -> DataFrame:
    """Exact ``row_number`` of every key over ids of a sorted table, which count up by one inside each task's run (2^33 ids).

    ``df`` must be written, so that its ids are fixed. Only the runs are summed up: some for each key and task.
    """
    cut = df.withColumn("_run", F.shiftright(ord_col, 33))
    runs = cut.groupBy(key, "_run").agg(F.min(ord_col).alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy(key).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    shifts = runs.select(key, "_run", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    return cut.join(shifts, [key, "_run"]).withColumn(name, F.col(ord_col) + F.col("_shift")).drop("_run", "_shift")


def running_best(
    df: DataFrame,
    keys: list[str],
    ord_col: str,
    values: dict[str, str],
    block_rows: int = DEFAULT_BLOCK_ROWS,
    first_flag: str | None = None,
) -> DataFrame:
    """Longest non-blank text so far, per key and in order, the earliest on ties.

    ``values`` maps a text column to the name of its running column. ``first_flag`` names an optional
    column that is true on the first row of a key.
    """
    def ranked(c: str) -> Column:
        return F.when(
            F.length(c) > 0,
            F.struct(F.length(c).alias("len"), (-F.col(ord_col)).alias("neg"), F.col(c).alias("text")),
        )

    blocked = df.withColumn("_block", F.floor(F.col(ord_col) / block_rows))
    summary = blocked.groupBy(*keys, "_block").agg(*[F.max(ranked(c)).alias(f"_best_{c}") for c in values])
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(
        *keys,
        "_block",
        *[F.max(f"_best_{c}").over(before).alias(f"_carry_{c}") for c in values],
        (F.row_number().over(Window.partitionBy(*keys).orderBy("_block")) == 1).alias("_first_block"),
    )
    upto = Window.partitionBy(*keys, "_block").orderBy(ord_col).rowsBetween(Window.unboundedPreceding, 0)
    local = blocked.select(
        "*",
        *[F.max(ranked(c)).over(upto).alias(f"_local_{c}") for c in values],
        F.row_number().over(Window.partitionBy(*keys, "_block").orderBy(ord_col)).alias("_pos"),
    )
    out = local.join(carried, [*keys, "_block"])
    for c, name in values.items():
        out = out.withColumn(name, F.greatest(f"_local_{c}", f"_carry_{c}")["text"])
    if first_flag:
        out = out.withColumn(first_flag, F.col("_first_block") & (F.col("_pos") == 1))
    helpers = ["_block", "_first_block", "_pos"]
    for c in values:
        helpers += [f"_local_{c}", f"_carry_{c}"]
    return out.drop(*helpers)
