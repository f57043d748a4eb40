"""Session helpers: a local session for tests and the shared scratch folder of a cluster."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


# Runtime settings that the operators rely on: partitions of hot keys are split by measured size, also
# where the split costs one more shuffle, and small partitions are merged.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Texts and pages of any length go to Python in batches of some MB, so a worker's memory does not grow with the table.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session, for example one that a cluster job brings along."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "citeloom", cpus: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench; a cluster job brings its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("CITELOOM_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, which the cluster names in ``spark.checkpoint.dir``.

    A session on one machine (master ``local``) that names none gets a folder of its own, as in tests. On
    a cluster a missing setting is an error: a folder of one machine would lose data with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = Path(os.environ.get("CITELOOM_SCRATCH", "/tmp")) / f"citeloom-{spark.sparkContext.applicationId}"
    spark.conf.set("spark.checkpoint.dir", own.as_uri())
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    return own.as_uri()


#: Scratch tables that this process has written and not yet dropped.
_written: list[str] = []


#: Whether Spark drops the shuffle files of a statement at its end, and not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a table in the scratch folder and read it back, which cuts its lineage.

    Nothing reads the shuffle files of the write after it, so they go at its end: disk holds those of one step, not of all.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        writer.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def _drop(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    _written.remove(path)


@contextmanager
def scratch_table(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` as a scratch table for the block, dropped when it ends; what is made of it must be written by then."""
    table = materialise(df, label)
    path = _written[-1]
    try:
        yield table
    finally:
        _drop(df.sparkSession, path)


@contextmanager
def scratch_space(spark: SparkSession) -> Iterator[None]:
    """Drops the scratch tables that are written inside the block when it ends; results must be written elsewhere by then."""
    start = len(_written)
    try:
        yield
    finally:
        for path in _written[start:]:
            _drop(spark, path)
