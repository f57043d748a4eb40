"""Comparison with the previous run: fingerprints, new / changed / unchanged, cached results, state upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.arrays import distinct_ws, empty_strings, or_empty

FINGERPRINT_FIELDS = ["canonical_id", "title", "year", "published_date", "venue", "doi"]


def fingerprint(papers: DataFrame, values: DataFrame) -> DataFrame:
    """Adds ``hash``: SHA-256 over the scalar fields and an order-free digest of every list field.

    Abstract and mentions do not take part. The list digests are two independent 64-bit xor sums and a
    count per field over distinct values, so lists are never collected and a long list costs no more
    than a short one.
    """
    first, second = value_digests(F.col("field"), F.col("value"))
    digests = values.groupBy("canonical_id", "field").agg(
        F.concat_ws(":", "field", F.count("*").cast("string"), F.hex(F.bit_xor(first)), F.hex(F.bit_xor(second))).alias("digest")
    )
    # At most one digest per list field, five in all.
    per_paper = digests.groupBy("canonical_id").agg(
        F.concat_ws(";", F.array_sort(F.collect_list("digest"))).alias("list_digest")
    )
    return (
        papers.join(per_paper, "canonical_id", "left")
        .withColumn("hash", paper_hash(F.col("list_digest")))
        .drop("list_digest")
    )


def value_digests(field: Column, value: Column) -> tuple[Column, Column]:
    """The two independent hashes of a list value that the list digests sum up."""
    return F.xxhash64(field, value), F.xxhash64(F.lit("second"), value, field)


def paper_hash(list_digest: Column) -> Column:
    """SHA-256 of the JSON text of the fingerprint fields; NULL fields are kept in the JSON."""
    payload = F.to_json(
        F.struct(*FINGERPRINT_FIELDS, list_digest.alias("lists")), {"ignoreNullFields": "false"}
    )
    return F.sha2(payload, 256)


def diff(papers: DataFrame, previous: DataFrame) -> DataFrame:
    """Adds ``status`` (new, changed, unchanged) by comparing ``hash`` with the previous index."""
    prev = previous.select(
        "canonical_id", F.trim(F.coalesce("hash", F.lit(""))).alias("_prev_hash"), F.lit(True).alias("_known")
    )
    return (
        papers.join(prev, "canonical_id", "left")
        .withColumn(
            "status",
            F.when(F.col("_known").isNull(), "new")
            .when(F.col("_prev_hash") != F.col("hash"), "changed")
            .otherwise("unchanged"),
        )
        .drop("_prev_hash", "_known")
    )


def status_counts(diffed: DataFrame) -> DataFrame:
    """One row with the three counts."""
    return diffed.agg(
        *[F.count_if(F.col("status") == s).alias(f"{s}_count") for s in ("new", "changed", "unchanged")]
    )


def delta_ids(diffed: DataFrame) -> DataFrame:
    """New and changed ids in sorted order, as rows (a range-partitioned sort, no list on one machine)."""
    return (
        diffed.filter(F.col("status").isin("new", "changed")).select("status", "canonical_id")
        .orderBy("status", "canonical_id")
    )


def hydrate(diffed: DataFrame, previous: DataFrame) -> DataFrame:
    """Cached results for unchanged papers: flags replaced, lists extended, kind and URL if filled.

    ``diffed`` needs the six result columns; ``previous`` is the paper index.
    """
    cached = previous.select(
        "canonical_id",
        F.struct(
            F.coalesce("award_mentioned_in_metadata", F.lit(False)).alias("meta"),
            F.coalesce("award_mentioned_in_document", F.lit(False)).alias("doc"),
            "award_mentions",
            "document_award_mentions",
            "document_verification_kind",
            "document_verification_url",
        ).alias("_cached"),
    )
    joined = diffed.join(cached, "canonical_id", "left")
    use = (F.col("status") == "unchanged") & F.col("_cached").isNotNull()

    def flag(current: str, field: str) -> Column:
        return F.when(use, F.col(f"_cached.{field}")).otherwise(F.col(current))

    def extended(name: str) -> Column:
        both = F.concat(or_empty(F.col(name)), or_empty(F.col(f"_cached.{name}")))
        return F.when(use & F.col(f"_cached.{name}").isNotNull(), distinct_ws(both)).otherwise(
            F.coalesce(F.col(name), empty_strings())
        )

    def filled(name: str) -> Column:
        value = F.col(f"_cached.{name}")
        return F.when(use & (F.trim(value) != ""), value).otherwise(F.col(name))

    return (
        joined.withColumn("award_mentioned_in_metadata", flag("award_mentioned_in_metadata", "meta"))
        .withColumn("award_mentioned_in_document", flag("award_mentioned_in_document", "doc"))
        .withColumn("award_mentions", extended("award_mentions"))
        .withColumn("document_award_mentions", extended("document_award_mentions"))
        .withColumn("document_verification_kind", filled("document_verification_kind"))
        .withColumn("document_verification_url", filled("document_verification_url"))
        .drop("_cached")
    )


def upsert(
    previous: DataFrame, current: DataFrame, run_started_at: str, run_finished_at: str, output_dir: str
) -> DataFrame:
    """The next paper index in one full outer join: current entries replace, all others are carried over.

    Only ``first_seen_at`` survives from a replaced entry. Both sides hold one row per ``canonical_id``.
    """
    stamps = ("first_seen_at", "last_seen_at", "last_output_dir")
    fields = [c for c in previous.columns if c != "canonical_id" and c not in stamps]
    prev = previous.select("canonical_id", F.struct(*fields, *stamps).alias("_p"))
    cur = current.select("canonical_id", F.struct(*fields).alias("_c"))
    joined = prev.join(cur, "canonical_id", "full")
    is_current = F.col("_c").isNotNull()
    picked = [F.when(is_current, F.col(f"_c.{c}")).otherwise(F.col(f"_p.{c}")).alias(c) for c in fields]
    return joined.select(
        "canonical_id",
        *picked,
        F.when(is_current, F.coalesce("_p.first_seen_at", F.lit(run_started_at)))
        .otherwise(F.col("_p.first_seen_at"))
        .alias("first_seen_at"),
        F.when(is_current, F.lit(run_finished_at)).otherwise(F.col("_p.last_seen_at")).alias("last_seen_at"),
        F.when(is_current, F.lit(output_dir)).otherwise(F.col("_p.last_output_dir")).alias("last_output_dir"),
    )


def touched(previous: DataFrame, current: DataFrame, run_started_at: str, run_finished_at: str, output_dir: str) -> DataFrame:
    """The index rows that a run writes: its own entries, with ``first_seen_at`` carried over. All others stay as they are.

    ``upsert`` is these rows in place of the previous ones. The previous index is asked for the touched ids only.
    """
    first = previous.select("canonical_id", F.col("first_seen_at").alias("_first"))
    stamped = current.drop("first_seen_at", "last_seen_at", "last_output_dir").join(first, "canonical_id", "left")
    stamps = {
        "first_seen_at": F.coalesce("_first", F.lit(run_started_at)), "last_seen_at": F.lit(run_finished_at), "last_output_dir": F.lit(output_dir),
    }
    return stamped.withColumns(stamps).drop("_first").select(*[c for c in previous.columns])


def first_arrivals(events: DataFrame, key: str, order: list[str], seen: DataFrame | None = None) -> DataFrame:
    """First row of every key that is not in ``seen`` yet (batch form of the streaming filter)."""
    from citeloom.operators.order import first_per_key

    fresh = events if seen is None else events.join(seen.select(key), key, "left_anti")
    return first_per_key(fresh, [key], order)
