"""The roster: people on team pages, with configured names as the fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.functions.html import ANY_ANCHOR_TIER, page_anchors
from citeloom.functions.names import is_probable_person, letters_key
from citeloom.functions.text import ws
from citeloom.operators.order import first_per_key


def roster_from_pages(pages: DataFrame, extra_stopwords: list[str] | None = None) -> DataFrame:
    """Distinct people of every page ``(page_id, source_url, html)``, headings first.

    Plain anchors count only on pages without any person in the preferred headings.
    """
    anchors = page_anchors(pages).withColumn("name", ws("text")).filter(
        is_probable_person(F.col("text"), extra_stopwords)
    )
    keyed = anchors.withColumn("name_key", letters_key(F.col("name")))
    # One row per page and person: the best place of that person, preferred headings before plain anchors.
    firsts = first_per_key(keyed, ["page_id", "name_key"], ["tier", "pos"])
    tiers = firsts.groupBy("page_id").agg(F.min("tier").alias("best_tier"))
    kept = firsts.join(tiers, "page_id").filter(
        (F.col("tier") < ANY_ANCHOR_TIER) | (F.col("best_tier") == ANY_ANCHOR_TIER)
    )
    return kept.select("page_id", "source_url", "tier", "pos", "name", F.col("href").alias("profile_url"))


def roster_or_fallback(parsed: DataFrame, fallback_names: list[str], source_url: str) -> DataFrame:
    """Parsed people, or the configured names if nobody was parsed at all."""
    spark = parsed.sparkSession
    people = parsed.select("name", "source_url", "profile_url", "page_id", "tier", "pos")
    nobody = parsed.agg(F.count("*") == 0).scalar()
    configured = spark.createDataFrame(
        [(n, source_url, None, -1, 0, i) for i, n in enumerate(fallback_names)],
        "name STRING, source_url STRING, profile_url STRING, page_id BIGINT, tier INT, pos BIGINT",
    ).filter(nobody)
    return people.unionByName(configured)


def limit_roster(members: DataFrame, n: int) -> DataFrame:
    """First ``n`` people in roster order."""
    return members.orderBy("page_id", "tier", "pos").limit(max(0, n))
