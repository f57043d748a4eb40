"""A corpus pipeline over documents: language ID, line dedup, near-dedup, benchmark decontamination, source mix."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.llm import decontaminate, language, line_dedup, mixing, near_copies
from citeloom.llm.common import prepare, table
from citeloom.session import scratch_dir, scratch_space


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a language explains."""
    prepare(spark)
    return language.known_languages(docs)


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share; ``n_chars`` follows the text."""
    prepare(spark)
    kept = line_dedup.dedup_lines(docs)
    length = F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", length).select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies (five-word shingles, Jaccard 0.8)."""
    prepare(spark)
    return near_copies.keep_one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mix takes from each document that is left."""
    prepare(spark)
    return mixing.taken_words(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_languages),
    ("line_dedup", fresh_lines),
    ("near_dedup", one_of_each),
    ("decontamination", without_benchmark),
    ("source_mix", source_mix),
]

#: Trigram models and 64-bit shingle hashes have no SQL form; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result is written to the shared folder and read as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    base = f"{scratch_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex[:12]}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{base}/{number}-{name}"
        with scratch_space(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
