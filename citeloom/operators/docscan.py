"""Scan of fetched documents for mentions, and the outcome per paper.

Every landed document is judged and scanned once per distinct address, however many papers point at
it. Only small outcome rows are joined back to the candidates, and all per-paper folds are partially
aggregated. The full-text step runs only for papers without a hit in the first step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.bind import once
from citeloom.functions.html import searchable_text
from citeloom.functions.scan import ScanSpec, find_mentions, mention_context
from citeloom.functions.arrays import distinct_ws, empty_strings, or_empty
from citeloom.operators.joins import lookup_join
from citeloom.operators.order import top_n_per_key
from citeloom.session import materialise

NOT_LANDED = "nothing landed"
NO_TEXT = "document without text"
NO_FULL_TEXT = "full text without content"
NO_CANDIDATES = "no candidate address"


def retrieval_error(max_mb: int | None = None) -> Column:
    """First reason why a response is not a usable PDF, or NULL. Works on the columns of ``fetched``; no size is too large by default."""
    body = F.col("body")
    kind = F.lower(F.coalesce("content_type", F.lit("")))
    # The reported content type is the text "None" when the response had none.
    shown = F.coalesce("content_type", F.lit("None"))
    bad = (
        F.when(F.col("error") != "", F.col("error"))
        .when(F.col("status_code") >= 400, F.concat(F.lit("status "), F.col("status_code").cast("string")))
        .when(F.coalesce(F.octet_length(body), F.lit(0)) == 0, F.lit("no body"))
    )
    if max_mb is not None:
        bad = bad.when(F.octet_length(body) > max_mb * 1024 * 1024, F.lit(f"larger than {max_mb} MB"))
    return bad.when(
        ~(body.startswith("%PDF") | kind.contains("application/pdf")), F.concat(F.lit("no PDF but "), shown)
    )


def classify_error(c: Column) -> Column:
    """Readable error: TLS, proxy, otherwise shortened to 240 characters; blank to a default."""
    from citeloom.functions.text import clip, ws

    compact = ws(F.coalesce(c, F.lit("")))
    return (
        F.when(
            compact.contains("SSLEOFError") | compact.contains("SSL_connect"),
            F.lit("TLS broke off behind the proxy"),
        )
        .when(compact.contains("ProxyError"), F.lit("proxy not reached"))
        .when(compact == "", F.lit("no error text"))
        .otherwise(clip(compact, 240))
    )


def _needed(fetched: DataFrame, candidates: DataFrame) -> DataFrame:
    return fetched.join(candidates.select("url").distinct(), "url", "left_semi")


def pdf_outcomes(fetched: DataFrame, candidates: DataFrame, spec: ScanSpec, max_mb: int | None = None) -> DataFrame:
    """One row per needed address: ``(url, error, downloaded, extracted, mentions, context)``."""
    text = F.nullif(F.col("document_text"), F.lit(""))
    judged = _needed(fetched, candidates).select("url", retrieval_error(max_mb).alias("bad"), text.alias("text"))
    found = F.when(F.col("bad").isNull(), find_mentions(F.col("text"), spec))
    scanned = once(judged, ["url", "bad", "text"], found=found)
    return scanned.select(
        "url",
        F.coalesce("bad", F.when(F.col("text").isNull(), F.lit(NO_TEXT))).alias("error"),
        F.col("bad").isNull().alias("downloaded"),
        (F.col("bad").isNull() & F.col("text").isNotNull()).alias("extracted"),
        F.coalesce("found", empty_strings()).alias("mentions"),
        mention_context(F.col("text"), F.col("found"), spec).alias("context"),
    )


def text_outcomes(fetched: DataFrame, candidates: DataFrame, spec: ScanSpec) -> DataFrame:
    """One row per needed full-text address: ``(url, error, final_url, mentions, context)``."""
    judged = _needed(fetched, candidates).select(
        "url",
        F.coalesce(F.nullif("final_url", F.lit("")), "url").alias("final_url"),
        F.when(F.col("error") != "", F.col("error"))
        .when(F.col("status_code") >= 400, F.concat(F.lit("status "), F.col("status_code").cast("string")))
        .alias("bad"),
        searchable_text(F.col("body"), F.col("content_type")).alias("text"),
    )
    found = F.when(F.col("bad").isNull(), find_mentions(F.col("text"), spec))
    scanned = once(judged, ["url", "final_url", "bad", "text"], found=found)
    return scanned.select(
        "url",
        "final_url",
        F.coalesce("bad", F.when(F.col("text").isNull(), F.lit(NO_FULL_TEXT))).alias("error"),
        F.coalesce("found", empty_strings()).alias("mentions"),
        mention_context(F.col("text"), F.col("found"), spec).alias("context"),
    )


def _at_error(error: str, at: str) -> Column:
    """Error text of the last failing candidate."""
    return F.max_by(error, F.when(F.col(error).isNotNull(), F.col(at)))


def scan_documents(
    papers: DataFrame,
    pdf_candidates: DataFrame,
    text_candidates: DataFrame,
    fetched: DataFrame,
    spec: ScanSpec,
    max_candidates: int | None = None,
    max_mb: int | None = None,
) -> DataFrame:
    """Outcome of every paper: status and evidence.

    ``papers`` needs ``canonical_id`` and ``already_mentioned`` (a cached document hit). All addresses of a
    paper count; a caller may ask for the first ``max_candidates`` and for documents up to ``max_mb`` only. Status is
    mention, download_fail, extract_fail, no_pdf or scanned_clear, in this precedence.
    """
    of_scan = pdf_candidates.join(papers.select("canonical_id"), "canonical_id", "left_semi")
    chosen = of_scan if max_candidates is None else top_n_per_key(of_scan, ["canonical_id"], [F.col("at")], max_candidates)
    tried = lookup_join(chosen, pdf_outcomes(fetched, chosen, spec, max_mb), ["url"], "left").select(
        "canonical_id",
        "at",
        "url",
        F.coalesce("downloaded", F.lit(False)).alias("downloaded"),
        F.coalesce("extracted", F.lit(False)).alias("extracted"),
        F.when(F.col("downloaded").isNull(), F.lit(NOT_LANDED)).otherwise(F.col("error")).alias("error"),
        F.coalesce("mentions", empty_strings()).alias("mentions"),
        "context",
    )
    hit = F.size("mentions") > 0
    first_step = tried.groupBy("canonical_id").agg(
        F.count("*").alias("candidates"),
        F.max("downloaded").alias("downloaded_any"),
        F.max("extracted").alias("extracted_any"),
        _at_error("error", "at").alias("pdf_error"),
        F.max_by("url", F.when(F.col("downloaded"), F.col("at"))).alias("last_downloaded"),
        F.min_by(F.struct("url", "mentions", "context"), F.when(hit, F.col("at"))).alias("pdf_hit"),
    )
    state = papers.select("canonical_id", F.coalesce("already_mentioned", F.lit(False)).alias("cached")).join(
        first_step, "canonical_id", "left"
    )
    # One small row per paper. Written once, because both the second step and the result read it, and
    # documents must not be scanned twice.
    state = materialise(state, "scan-step-one")

    open_ids = state.filter(F.col("pdf_hit").isNull() & ~F.col("cached")).select("canonical_id")
    wanted = text_candidates.join(open_ids, "canonical_id", "left_semi")
    read = lookup_join(wanted, text_outcomes(fetched, wanted, spec), ["url"], "left").select(
        "canonical_id",
        "at",
        "kind",
        F.when(F.col("mentions").isNull(), F.lit(NOT_LANDED)).otherwise(F.col("error")).alias("error"),
        F.coalesce("mentions", empty_strings()).alias("mentions"),
        "context",
        "final_url",
    )
    second_step = read.groupBy("canonical_id").agg(
        _at_error("error", "at").alias("text_error"),
        F.min_by(
            F.struct("kind", F.col("final_url").alias("url"), "mentions", "context"), F.when(hit, F.col("at"))
        ).alias("text_hit"),
    )
    out = state.join(second_step, "canonical_id", "left")

    downloaded, extracted = F.coalesce("downloaded_any", F.lit(False)), F.coalesce("extracted_any", F.lit(False))
    pdf_hit, text_hit = F.col("pdf_hit").isNotNull(), F.col("text_hit").isNotNull()
    last_error = F.coalesce("pdf_error", F.when(~F.col("cached"), F.col("text_error")))
    status = (
        F.when(pdf_hit | text_hit, "mention")
        .when(~downloaded & last_error.isNotNull(), "download_fail")
        .when(downloaded & ~extracted & last_error.isNotNull(), "extract_fail")
        .when(F.coalesce("candidates", F.lit(0)) == 0, F.when(F.col("cached"), "mention").otherwise("no_pdf"))
        .when(F.col("cached"), "mention")
        .otherwise("scanned_clear")
    )
    # A hit in a document clears no earlier success: the document address is the one that was hit.
    return out.withColumn("status", status).select(
        "canonical_id",
        "status",
        (pdf_hit | text_hit | F.col("cached")).alias("award_mentioned_in_document"),
        F.coalesce("pdf_hit.mentions", "text_hit.mentions", empty_strings()).alias("document_award_mentions"),
        F.coalesce("pdf_hit.context", "text_hit.context").alias("document_award_context"),
        F.coalesce(F.when(pdf_hit, F.lit("pdf")), F.col("text_hit.kind")).alias("document_verification_kind"),
        F.coalesce("pdf_hit.url", "text_hit.url").alias("document_verification_url"),
        F.coalesce("pdf_hit.url", "last_downloaded").alias("document_pdf_url"),
        F.when(F.col("status").isin("download_fail", "extract_fail"), last_error)
        .when(F.col("status") == "no_pdf", F.lit(NO_CANDIDATES))
        .alias("document_scan_error"),
    )


def scan_counters(outcomes: DataFrame) -> DataFrame:
    """One row of counters over all scanned papers."""
    return outcomes.agg(
        F.count("*").alias("papers_total"),
        F.count_if(F.col("status") == "mention").alias("mentions_count"),
        F.count_if(F.col("status") == "no_pdf").alias("no_pdf_count"),
        F.count_if(F.col("status") == "download_fail").alias("download_fail_count"),
        F.count_if(F.col("status") == "extract_fail").alias("extract_fail_count"),
    )


def apply_outcomes(papers: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Papers with the results of a scan: a hit also extends the mentions and sets the metadata flag."""
    fields = [
        "document_award_context",
        "document_verification_kind",
        "document_verification_url",
        "document_pdf_url",
        "document_scan_error",
    ]
    res = outcomes.select("canonical_id", F.struct(*[c for c in outcomes.columns if c != "canonical_id"]).alias("_o"))
    joined = papers.join(res, "canonical_id", "left")
    hit = F.coalesce(F.size("_o.document_award_mentions") > 0, F.lit(False))
    out = (
        joined.withColumn(
            "award_mentions",
            F.when(
                hit, distinct_ws(F.concat(or_empty(F.col("award_mentions")), F.col("_o.document_award_mentions")))
            ).otherwise(or_empty(F.col("award_mentions"))),
        )
        .withColumn(
            "document_award_mentions",
            F.when(hit, F.col("_o.document_award_mentions")).otherwise(or_empty(F.col("document_award_mentions"))),
        )
        .withColumn("award_mentioned_in_metadata", F.col("award_mentioned_in_metadata") | hit)
        .withColumn(
            "award_mentioned_in_document",
            F.coalesce("_o.award_mentioned_in_document", "award_mentioned_in_document", F.lit(False)),
        )
    )
    for name in fields:
        current = F.col(name) if name in papers.columns else F.lit(None).cast("string")
        out = out.withColumn(name, F.coalesce(F.col(f"_o.{name}"), current))
    return out.drop("_o")


def mention_rows(texts: DataFrame, spec: ScanSpec, id_col: str, text_col: str) -> DataFrame:
    """Every hit of a scan with the rule that produced it: ``(id, pos, rule, mention)``; no shuffle."""
    from citeloom.functions.scan import mention_hits

    return texts.select(id_col, F.posexplode(mention_hits(F.col(text_col), spec)).alias("pos", "hit")).select(
        id_col, F.col("pos").cast("bigint").alias("pos"), "hit.rule", "hit.mention"
    )


def rule_report(rows: DataFrame, id_col: str) -> DataFrame:
    """How precise each rule is: hits, texts, and texts that only the looser rules found."""
    per_text = rows.groupBy(id_col).agg(
        *[
            F.count_if(F.col("rule") == r).alias(r)
            for r in ("phrase", "exact_number", "separated_number", "collapsed_number")
        ]
    )
    strict = (F.col("phrase") > 0) | (F.col("exact_number") > 0)
    return per_text.agg(
        F.count("*").alias("texts"),
        F.sum("phrase").alias("phrase_hits"),
        F.sum("exact_number").alias("exact_number_hits"),
        F.sum("separated_number").alias("separated_number_hits"),
        F.sum("collapsed_number").alias("collapsed_number_hits"),
        F.count_if(strict).alias("strict_texts"),
        F.count_if(~strict).alias("loose_only_texts"),
    )
