"""Outputs of a run: tables under ``runs/<run_id>``, a latest pointer, and text files.

``latest`` is not a copy. Every finished run claims the next number by creating a pointer file, and the highest
number wins, so a reader sees either the old run or the new one, never a mixture, and nothing is written twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.plans.keyed_state import claim_next, claims
from citeloom.sources.files import path_exists


def run_path(base: str, run_id: str, name: str) -> str:
    return f"{base.rstrip('/')}/runs/{run_id}/{name}"


def write_table(df: DataFrame, base: str, run_id: str, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write one table of a run and return it as written. A repeated run replaces its own output."""
    path = run_path(base, run_id, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_json(df: DataFrame, base: str, run_id: str, name: str) -> None:
    """JSON lines form of a table, for other tools."""
    df.write.mode("overwrite").json(run_path(base, run_id, name))


def write_ordered(df: DataFrame, order: list[str], base: str, run_id: str, name: str) -> None:
    """A table sorted over all its files: partitions are ranges of the whole order, so a hot leading key is split too."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(run_path(base, run_id, name))


def write_text(lines: DataFrame, order: list[str], column: str, base: str, run_id: str, name: str) -> None:
    """Text lines in order: part files are range-partitioned, so their names give the order."""
    ordered = lines.orderBy(*order).select(F.col(column).alias("value"))
    ordered.write.mode("overwrite").text(run_path(base, run_id, name))


def _pointers(spark: SparkSession, base: str) -> DataFrame | None:
    path = f"{base.rstrip('/')}/published"
    known = [p for _, p in claims(spark, path)]
    return spark.read.schema("run_id STRING, seq BIGINT").json(known).where("run_id IS NOT NULL") if known else None


def publish(spark: SparkSession, base: str, run_id: str) -> int:
    """Make a finished run the latest one. Runs are counted as they finish; their ids need no order.

    The next pointer is created only if it is not there yet, and the next number is tried if another run was first, so
    of two runs that finish at once each gets a pointer.
    """
    return claim_next(spark, f"{base.rstrip('/')}/published", {"run_id": run_id})


def published_runs(spark: SparkSession, base: str, before: str | None = None) -> set[str]:
    """Ids of the published runs, with ``before`` of those published before that id was first published."""
    known = _pointers(spark, base)
    if known is None:
        return set()
    rows = known.collect()  # one short row per run
    first = min((r["seq"] for r in rows if r["run_id"] == before), default=None)
    return {r["run_id"] for r in rows if r["run_id"] != before and (first is None or r["seq"] < first)}


def latest_run(spark: SparkSession, base: str, before: str | None = None) -> str | None:
    """Id of the run that was published last; with ``before``, of the last one before that id was first published."""
    known = _pointers(spark, base)
    if known is None:
        return None
    if before is not None:
        first = known.where(F.col("run_id") == before).agg(F.min("seq")).first()[0]
        known = known.where(F.col("run_id") != before)
        known = known if first is None else known.where(F.col("seq") < first)
    return known.agg(F.max_by("run_id", "seq")).first()[0]


def read_latest(spark: SparkSession, base: str, name: str, before: str | None = None) -> DataFrame | None:
    """A table of the latest run (see ``latest_run``); None if there is no run, or it did not write that table."""
    run_id = latest_run(spark, base, before)
    if run_id is None or not path_exists(spark, run_path(base, run_id, name)):
        return None
    return spark.read.parquet(run_path(base, run_id, name))
