"""Helpers of the training-data operators: sessions, words, and connected components over links."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeloom.session import configure, materialise

#: White space of the line and word rules (fixed values): space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"

#: Rows of one Arrow batch. Texts of 20,000 words then take some 100 MB of a worker at most.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> SparkSession:
    """Settings that the operators rely on: skewed joins are split, and Arrow batches stay small."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_columns(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """Apply ``fn`` to every Arrow batch; it returns the columns of the output batch by name."""
    names = T.StructType.fromDDL(schema).fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(batch)
            if len(out[names[0]]):
                yield pa.RecordBatch.from_arrays([pa.array(out[n]) if not isinstance(out[n], pa.Array) else out[n] for n in names], names)

    return df.mapInArrow(run, schema)


def n_words(text: Column) -> Column:
    """Number of words; NULL counts as no text."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def placed(df: DataFrame, order: list[Column], amounts: dict[str, Column], label: str) -> DataFrame:
    """Adds sums of ``amounts`` over all earlier rows in ``order``: inside range partitions, whose totals are summed first."""
    sorted_ = df.select("*", *[c.alias(f"_o{i}") for i, c in enumerate(order)], *[c.alias(f"_a{n}") for n, c in amounts.items()])
    keys = [f"_o{i}" for i in range(len(order))]
    held = materialise(sorted_.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), label)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    totals = held.groupBy("_part").agg(*[F.sum(f"_a{n}").alias(f"_t{n}") for n in amounts])
    offsets = totals.select("_part", *[F.coalesce(F.sum(f"_t{n}").over(before), F.lit(0)).alias(f"_t{n}") for n in amounts])
    inside = Window.partitionBy("_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    sums = [(F.coalesce(F.sum(f"_a{n}").over(inside), F.lit(0)) + F.col(f"_t{n}")).alias(n) for n in amounts]
    return held.join(offsets, "_part").select(*df.columns, *sums)


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``links`` (a, b): one row (node, component) per node, component its smallest node.

    Alternating large and small stars: every round points nodes at the smallest node that they know, and the
    number of rounds grows with the logarithm of the longest chain. Each star is one aggregation (combined
    before its shuffle) and one join, whose long side AQE splits at a hot node. Rounds are written to the
    shared folder, so that a lost executor repeats one round only.
    """
    edges = materialise(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links"
    )
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialise(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "links")
        size = edges.agg(F.count("*").alias("edges"), F.countDistinct("a").alias("nodes")).first()
        if size["edges"] == size["nodes"] and edges.join(edges.select(F.col("b").alias("a")), "a", "left_semi").isEmpty():
            break  # every node hangs on one other node, which is a root
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
