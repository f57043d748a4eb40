"""Target list handling: free-text DOI lists, coverage of targets by papers, target-only selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.functions.ids import doi_tokens
from citeloom.functions.text import ws
from citeloom.operators.joins import lookup_join
from citeloom.operators.order import first_per_key


def parse_doi_lists(texts: DataFrame) -> DataFrame:
    """Distinct DOIs (ignoring case, first spelling kept) of texts given as ``(list_rank, ord, text)``.

    A lower ``list_rank`` wins over a higher one, so parameter lists come before files.
    """
    tokens = texts.select("list_rank", "ord", F.posexplode(doi_tokens(F.col("text"))).alias("pos", "doi"))
    keyed = tokens.withColumn("doi_key", F.lower("doi"))
    return first_per_key(keyed, ["doi_key"], ["list_rank", "ord", "pos"]).select(
        "doi_key", "doi", "list_rank", "ord", F.col("pos").cast("bigint").alias("pos")
    )


def target_keys(targets: DataFrame) -> DataFrame:
    """Distinct lower-cased target DOIs in first-seen order; input ``(ord, doi)``."""
    keyed = targets.select("ord", F.lower(ws("doi")).alias("doi_key")).filter(F.col("doi_key") != "")
    return keyed.groupBy("doi_key").agg(F.min("ord").alias("target_ord"))


def coverage_details(targets: DataFrame, papers: DataFrame, require_document: bool = True) -> DataFrame:
    """One row per target: found or not, and whether the paper is verified. The first paper of a DOI counts.

    ``papers`` needs ``ord, doi, title`` and the two award flags. Only papers of target DOIs are
    aggregated: a semi join comes first.
    """
    wanted = target_keys(targets)
    keyed = papers.withColumn("doi_key", F.lower(ws("doi"))).filter(F.col("doi_key") != "")
    hits = lookup_join(keyed, wanted.select("doi_key"), ["doi_key"], "inner")
    firsts = first_per_key(hits, ["doi_key"], ["ord"])
    verified = F.col("award_mentioned_in_document")
    if not require_document:
        verified = verified | F.col("award_mentioned_in_metadata")
    return wanted.join(
        firsts.withColumn("_found", F.lit(True)).withColumn("award_verified", F.coalesce(verified, F.lit(False))),
        "doi_key",
        "left",
    ).withColumn("found", F.coalesce("_found", F.lit(False))).drop("_found", "ord", "doi")


def coverage_counts(details: DataFrame) -> DataFrame:
    """One row: total, matched, missing, verified and unverified targets."""
    return details.agg(
        F.count("*").alias("total"),
        F.count_if("found").alias("matched_count"),
        F.count_if(~F.col("found")).alias("missing_count"),
        F.count_if(F.col("found") & F.col("award_verified")).alias("award_verified_count"),
        F.count_if(F.col("found") & ~F.col("award_verified")).alias("award_verified_missing_count"),
    )


def select_for_scan(
    papers: DataFrame,
    targets: DataFrame | None,
    target_only: bool = False,
    incremental: bool = False,
) -> DataFrame:
    """Papers whose documents are scanned.

    Target-only mode keeps papers of target DOIs (an empty target list keeps all). Otherwise the
    incremental mode keeps papers with status new or changed.
    """
    selected = papers
    if target_only and targets is not None:
        wanted = target_keys(targets)
        # A scalar subquery: with an empty target list all papers stay, and the incremental rule applies.
        any_target = wanted.agg(F.count("*") > 0).scalar()
        keyed = papers.withColumn("doi_key", F.lower(ws("doi")))
        flagged = lookup_join(keyed, wanted.select("doi_key", F.lit(True).alias("_hit")), ["doi_key"], "left")
        untargeted = F.col("status").isin("new", "changed") if incremental else F.lit(True)
        kept = F.when(any_target, F.coalesce("_hit", F.lit(False))).otherwise(untargeted)
        return flagged.filter(kept).drop("doi_key", "_hit")
    if incremental:
        selected = papers.filter(F.col("status").isin("new", "changed"))
    return selected


def verification_failures(details: DataFrame) -> DataFrame:
    """Targets that are found but not verified, in target order; a job may fail on any row."""
    return details.filter(F.col("found") & ~F.col("award_verified")).orderBy("target_ord")
