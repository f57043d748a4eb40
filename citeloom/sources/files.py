"""Readers of landed files: payload folders, target lists, manifests, and the previous paper index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom import schemas


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """The landing table (Parquet, partitioned by source where it was written that way)."""
    return spark.read.schema(schemas.RAW_PAYLOADS).parquet(path)


def xml_records(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    """Rows of large XML files by their row tag; Spark splits the files."""
    return spark.read.schema(schema).option("rowTag", row_tag).option("ignoreNamespace", "true").format("xml").load(path)


def doi_list_files(spark: SparkSession, path: str, list_rank: int = 1) -> DataFrame:
    """Target lists as text files, one row per line: ``(list_rank, ord, text)``."""
    lines = spark.read.text(path)
    return lines.select(
        F.lit(list_rank).alias("list_rank"), F.monotonically_increasing_id().alias("ord"), F.col("value").alias("text")
    )


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A manifest given as one JSON array; entries that are no objects are dropped.

    Order inside a file is the reading order of its single task.
    """
    schema = "title STRING, authors ARRAY<STRING>, member_authors ARRAY<STRING>, url STRING, doi STRING"
    rows = spark.read.schema(schema + ", _corrupt_record STRING").json(path, multiLine=True)
    filled = F.coalesce("title", "url", "doi", F.array_join("authors", ","), F.array_join("member_authors", ","))
    return (
        rows.withColumn("ord", F.monotonically_increasing_id())
        .filter(filled.isNotNull())
        .select("ord", "title", "authors", "member_authors", "url", "doi")
    )


def paper_index(spark: SparkSession, path: str | None) -> DataFrame:
    """The previous paper index, or an empty one on a first run. Rows without id are dropped."""
    empty = spark.createDataFrame([], schemas.PAPER_INDEX)
    if path is None or not path_exists(spark, path):
        return empty
    return spark.read.schema(schemas.PAPER_INDEX).parquet(path).filter(F.col("canonical_id").isNotNull())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, asked through the file system of the path itself."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)
