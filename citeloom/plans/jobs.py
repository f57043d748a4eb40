"""The three jobs: collection run, curation, finalisation. Every stage writes its table, later stages read it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeloom import schemas
from citeloom.functions.scan import ScanSpec
from citeloom.operators import candidates, coverage, curate, docscan, finalize, merge, report, snapshot
from citeloom.operators.order import place_in_runs
from citeloom.plans import sinks
from citeloom.plans.keyed_state import KeyedState
from citeloom.session import configure, materialise, scratch_space
from citeloom.sources import json_sources, markup_sources
from citeloom.sources.common import ORDER


#: Ids of one source; the source's rank stands above them (12 sources: below 10^17).
ORD_BITS = 52


@dataclass(frozen=True)
class RunParams:
    """Parameters of a collection run. There are no limits unless a caller sets them."""

    run_id: str
    run_started_at: str
    run_finished_at: str
    current_year: int
    spec: ScanSpec
    lookback_years: int = 2
    enabled_sources: tuple[str, ...] = tuple(schemas.SOURCE_ORDER)
    max_rows: int | None = None
    max_pages: int | None = None
    max_candidates: int | None = None
    max_mb: int | None = None
    scan_documents: bool = True
    scan_target_only: bool = False
    incremental_scan: bool = True
    use_state: bool = True
    write_full_corpus: bool = False
    fail_on_unverified_targets: bool = False
    scholar_as_json: bool = False
    versions_before_compaction: int = 50

    @property
    def min_year(self) -> int:
        return self.current_year - max(0, self.lookback_years)


@dataclass(frozen=True)
class RunInputs:
    """Landed tables of a run; see ``citeloom.schemas``."""

    raw_payloads: DataFrame
    members: DataFrame
    fetched: DataFrame
    doi_lookup: DataFrame
    health: DataFrame
    request_log: DataFrame
    targets: DataFrame | None = None


def normalise_all(raw: DataFrame, members: DataFrame, params: RunParams, fields: list[str] | None = None) -> DataFrame:
    """Records of all enabled sources. ``fields`` are the record columns that the caller reads, all by default; others may be NULL."""
    y, n, p = params.min_year, params.max_rows, params.max_pages
    read = fields and [F.col(c) for c in dict.fromkeys([*ORDER, "source", "member_name", *fields])]
    scholar = json_sources.google_scholar_json if params.scholar_as_json else markup_sources.google_scholar_html
    makers = {
        "dblp": lambda: markup_sources.dblp(raw, y, n),
        "openalex": lambda: json_sources.openalex(raw, y, n),
        "semantic_scholar": lambda: json_sources.semantic_scholar(raw, y, n),
        "crossref": lambda: json_sources.crossref(raw, y, n),
        "datacite": lambda: json_sources.datacite(raw, y, n),
        "europe_pmc": lambda: json_sources.europe_pmc(raw, y, n),
        "pubmed": lambda: markup_sources.pubmed(raw, y, n),
        "openaire": lambda: markup_sources.openaire(raw, y, n, p),
        "doaj": lambda: json_sources.doaj(raw, y, n, p),
        "arxiv": lambda: markup_sources.arxiv(raw, y, n),
        "inspirehep": lambda: json_sources.inspirehep(raw, members, y, placed="member_ord" in members.columns, columns=read),
        "google_scholar": lambda: scholar(raw, y, n, p),
    }
    out = None
    for name in schemas.SOURCE_ORDER:
        if name in params.enabled_sources:
            part = makers[name]()
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no source is enabled")
    return out


def with_order(
    records: DataFrame, members: DataFrame, fields: list[str] | None = None, place: str | None = None
) -> DataFrame:
    """Adds ``ord``: source order, member order, page, row, item.

    The ids follow a range-partitioned sort, so they rise with the order. They are fixed by writing the
    table right afterwards. Records that bring their ``source_place`` are not sorted: the ids of a source
    have a range of their own, and theirs count up by it, so pairs of papers and members are never shuffled.

    ``fields`` are the record columns to keep, all by default. ``place`` names a column for the place of a record
    in its source, from 1; records and their ids are then fixed in scratch tables.
    """
    fields = list(fields or schemas.RECORD_FIELDS)
    places = members.select(F.col("name").alias("member_name"), "member_ord").groupBy("member_name").agg(
        F.min("member_ord").alias("member_ord")
    )
    rank = report.source_rank(F.col("source"))
    first = F.shiftleft(rank.cast("bigint"), ORD_BITS)
    has_places = "source_place" in records.columns
    listed = records.filter("source_place IS NULL") if has_places else records
    ranked = listed.join(places, "member_name", "left").withColumn("rank", rank)
    by = ["rank", "member_ord", "member_name", *ORDER, "source_id"]
    if place:  # A range sort reads its input twice, so payloads are parsed before it.
        ranked = materialise(ranked.select(*dict.fromkeys([*by, "source", *fields])), "records")
    ordered = ranked.orderBy(*by)
    out = ordered.select((first + F.monotonically_increasing_id()).alias("ord"), *fields)
    if place:
        out = place_in_runs(materialise(out, "ordered-records"), "source", "ord", place)
    if has_places:
        known = records.filter("source_place IS NOT NULL").select(
            (first + F.col("source_place") - 1).alias("ord"), *fields, *([F.col("source_place").alias(place)] if place else [])
        )
        out = out.unionByName(known)
    return out


def with_scan_columns(papers: DataFrame) -> DataFrame:
    """Result columns of a paper before any document is scanned."""
    empty = F.expr("cast(array() as array<string>)")
    none = F.lit(None).cast(T.StringType())
    out = papers.withColumn("award_mentioned_in_document", F.lit(False)).withColumn("document_award_mentions", empty)
    for name in (
        "document_award_context", "document_verification_kind", "document_verification_url", "document_pdf_url",
        "document_pdf_local_path", "document_pdfa_path", "document_pdfa_error", "document_scan_error",
    ):
        out = out.withColumn(name, none)
    return out


def mention_lists(mentions: DataFrame) -> DataFrame:
    """Mentions of a paper as one ordered array; these are distinct spellings of one reference."""
    pairs = F.array_sort(F.collect_list(F.struct("first_ord", "first_pos", "mention")))
    return mentions.groupBy("canonical_id").agg(F.transform(pairs, lambda p: p["mention"]).alias("award_mentions"))


def index_state(spark: SparkSession, base: str) -> KeyedState:
    """The paper index of all runs under ``base``; see ``paper_index`` for its current rows."""
    return KeyedState(spark, f"{base.rstrip('/')}/state/paper_index", schemas.PAPER_INDEX, "canonical_id")


def paper_index(spark: SparkSession, base: str, before: str | None = None) -> DataFrame:
    """The paper index after the published runs, with ``before`` after those published before that run."""
    return index_state(spark, base).current(runs=sinks.published_runs(spark, base, before))


def collection_run(spark: SparkSession, inputs: RunInputs, params: RunParams, base: str) -> DataFrame:
    """One run from landed payloads to published tables; returns the run summary."""
    configure(spark)
    with scratch_space(spark):
        return _collect(spark, inputs, params, base)


def _collect(spark: SparkSession, inputs: RunInputs, params: RunParams, base: str) -> DataFrame:
    rid = params.run_id

    def save(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        return sinks.write_table(df, base, rid, name, partition_by)

    save(inputs.members, "members")
    healthy = inputs.raw_payloads.join(inputs.health.select("source").distinct(), "source", "left_anti")
    records = save(with_order(normalise_all(healthy, inputs.members, params), inputs.members), "source_records", ["source"])
    errors = save(
        report.probe_errors(inputs.health).unionByName(markup_sources.blocked_pages(healthy)), "source_errors"
    )

    keyed = merge.with_canonical_id(records)
    values = save(merge.merge_values(keyed), "paper_values")
    links = save(merge.paper_records(keyed), "paper_records")
    mentions = save(merge.metadata_mentions(keyed, params.spec), "paper_mentions")
    plain = merge.flag_papers(merge.merge_papers(keyed), mentions)
    nested = merge.nest_values(values, ["members", "sources"])
    papers = with_scan_columns(
        plain.join(nested, "canonical_id").join(mention_lists(mentions), "canonical_id", "left").withColumn(
            "award_mentions", F.coalesce("award_mentions", F.expr("cast(array() as array<string>)"))
        )
    )
    papers = save(snapshot.fingerprint(papers, values), "papers_merged")

    state = index_state(spark, base)
    seen = sinks.published_runs(spark, base, before=rid) if params.use_state else set()
    previous = state.current(runs=seen)
    diffed = save(snapshot.hydrate(snapshot.diff(papers, previous), previous), "papers_diffed")
    save(snapshot.delta_ids(diffed), "paper_delta")

    derived = save(candidates.pdf_candidates(diffed, values, links), "pdf_candidates_derived")
    looked_up = candidates.enrich_from_lookup(diffed, derived, inputs.doi_lookup)
    pdfs = save(derived.unionByName(looked_up), "pdf_candidates")
    texts = save(candidates.text_candidates(diffed, values, pdfs, links), "text_candidates")

    final, counters = diffed, None
    if params.scan_documents:
        incremental = params.use_state and params.incremental_scan
        chosen = coverage.select_for_scan(diffed, inputs.targets, params.scan_target_only, incremental).select(
            "canonical_id", F.col("award_mentioned_in_document").alias("already_mentioned")
        )
        outcomes = save(
            docscan.scan_documents(
                chosen, pdfs, texts, inputs.fetched, params.spec, params.max_candidates, params.max_mb
            ),
            "scan_outcomes",
        )
        counters = docscan.scan_counters(outcomes)
        named = save(candidates.fulltext_candidates(outcomes, inputs.fetched), "fulltext_candidates")
        chosen_urls = save(candidates.chosen_documents(outcomes, named, pdfs, inputs.fetched), "chosen_documents")
        outcomes = outcomes.join(chosen_urls.withColumnRenamed("url", "_chosen"), "canonical_id", "left").withColumn(
            "document_pdf_url", F.coalesce("document_pdf_url", "_chosen")
        ).drop("_chosen")
        final = docscan.apply_outcomes(diffed, outcomes)
    final = save(final, "papers")

    with_award, without_award = report.split_by_award(final, params.scan_documents)
    save(with_award, "papers_with_award_mention")
    if params.write_full_corpus:
        save(without_award, "papers_without_award_mention")
    save(report.award_summary(final), "award_document_summary")
    audit = save(report.require_proxied(report.request_audit(inputs.request_log)), "request_audit")

    parts = [
        inputs.members.agg(F.count("*").alias("team_member_count")),
        records.agg(F.count("*").alias("raw_record_count")),
        final.agg(F.count("*").alias("canonical_paper_count")),
        with_award.agg(F.count("*").alias("award_match_count")),
        snapshot.status_counts(diffed),
        counters if counters is not None else docscan.scan_counters(spark.createDataFrame([], "status STRING")),
        audit.filter("level = 'total'").agg(
            F.coalesce(F.max("attempts"), F.lit(0)).alias("proxy_attempt_count"),
            F.coalesce(F.max("direct_attempts"), F.lit(0)).alias("direct_attempt_count"),
        ),
    ]
    counts = report.source_counts(records, errors, list(params.enabled_sources))
    probes = report.active_sources(inputs.health, list(params.enabled_sources)).select("source", "probe")
    parts.append(report.as_map(counts, "source", "records", "source_record_counts"))
    parts.append(report.as_map(counts, "source", "errors", "source_error_counts"))
    parts.append(report.as_map(probes, "source", "probe", "source_probe_status"))
    details = None
    if inputs.targets is not None:
        ordered = final.withColumn("ord", F.col("first_ord"))
        details = save(coverage.coverage_details(inputs.targets, ordered, params.scan_documents), "target_coverage")
        parts.append(
            coverage.coverage_counts(details).selectExpr(
                "total AS target_doi_total", "matched_count AS target_doi_matched", "missing_count AS target_doi_missing",
                "award_verified_count AS target_doi_award_verified", "award_verified_missing_count AS target_doi_award_missing",
            )
        )
    constants = {
        "run_started_at": params.run_started_at,
        "run_finished_at": params.run_finished_at,
        "output_dir": f"{base}/runs/{rid}",
        "lookback_years": params.lookback_years,
        "state_cache_enabled": params.use_state,
        "document_scan_enabled": params.scan_documents,
    }
    if details is None:
        constants |= {f"target_doi_{k}": 0 for k in ("total", "matched", "missing", "award_verified", "award_missing")}
    summary = save(report.summary_row(spark, parts, **constants), "summary")

    top = report.top_papers(with_award)
    ranked = top.select(F.row_number().over(report.report_window(top)).alias("rank"), "*")
    lines = report.report_lines(summary, counts.join(probes, "source", "left"), ranked)
    sinks.write_text(lines, ["section", "line_no"], "line", base, rid, "report")

    if params.use_state:
        index = final.select([F.col(c) for c in previous.columns if c in final.columns])
        state.append(snapshot.touched(previous, index, params.run_started_at, params.run_finished_at, f"{base}/runs/{rid}"), rid)
    sinks.publish(spark, base, rid)
    if state.since_base() >= params.versions_before_compaction:
        state.compact(runs=sinks.published_runs(spark, base))
    if params.fail_on_unverified_targets and details is not None:
        failed = save(coverage.verification_failures(details), "unverified_targets")
        if not failed.isEmpty():
            raise RuntimeError(f"targets not verified, see {sinks.run_path(base, rid, 'unverified_targets')}")
    return summary


def curation_job(
    candidates_: DataFrame, baseline: DataFrame, papers: DataFrame, base: str, run_id: str
) -> DataFrame:
    """Review candidates against papers and write the four outputs; returns the counts."""
    reviewed = sinks.write_table(curate.review(candidates_, baseline, papers), base, run_id, "manifest_review")
    cumulative = sinks.write_table(curate.cumulative(baseline, reviewed), base, run_id, "cumulative_manifest")
    portal = curate.portal(cumulative, papers)
    sinks.write_json(reviewed.filter("accepted"), base, run_id, "accepted_additions")
    sinks.write_json(reviewed.filter("NOT accepted"), base, run_id, "rejected_candidates")
    sinks.write_json(portal, base, run_id, "portal_manifest")
    counts = curate.review_counts(baseline, reviewed, portal)
    return sinks.write_table(counts, base, run_id, "manifest_review_summary")


def finalisation_job(
    raw_manifest: DataFrame,
    papers: DataFrame,
    records: DataFrame,
    fetched: DataFrame,
    doi_lookup: DataFrame,
    local_files: DataFrame,
    base: str,
    run_id: str,
) -> DataFrame:
    """Best evidence per manifest item, and the Markdown list. Unknown items stop the job before any work."""
    with scratch_space(papers.sparkSession):
        return _finalise(raw_manifest, papers, records, fetched, doi_lookup, local_files, base, run_id)


def _finalise(
    raw_manifest: DataFrame,
    papers: DataFrame,
    records: DataFrame,
    fetched: DataFrame,
    doi_lookup: DataFrame,
    local_files: DataFrame,
    base: str,
    run_id: str,
) -> DataFrame:
    groups = sinks.write_table(merge.title_groups(papers), base, run_id, "title_groups")
    items = finalize.require_valid(finalize.clean_manifest(raw_manifest))
    missing = sinks.write_table(finalize.unmatched(items, groups), base, run_id, "unmatched_items")
    if not missing.isEmpty():
        raise RuntimeError(f"manifest items not found in papers, see {sinks.run_path(base, run_id, 'unmatched_items')}")
    matched = sinks.write_table(finalize.with_groups(items, groups), base, run_id, "manifest_items")
    values = sinks.write_table(merge.title_group_values(papers, records), base, run_id, "title_group_values")
    seen = merge.with_title_group(papers).select(
        "group_key", F.col("document_verification_kind").alias("kind"), F.col("document_verification_url").alias("url"), "ord"
    ).filter(F.col("kind").isNotNull() & F.col("url").isNotNull())
    lines = sinks.write_table(finalize.metadata_snapshot(matched, values, doi_lookup), base, run_id, "metadata_snapshot_lines")
    sinks.write_table(finalize.snapshot_documents(matched, lines), base, run_id, "metadata_snapshots")
    sinks.write_ordered(finalize.snapshot_pieces(lines), ["group_key", "ord", *finalize.PIECE_ORDER], base, run_id, "metadata_snapshot_text")
    evidence = finalize.best_evidence(matched, values, seen, doi_lookup, fetched, local_files)
    out = sinks.write_table(evidence, base, run_id, "final_results")
    sinks.write_text(finalize.markdown_blocks(matched), ["ord"], "block", base, run_id, "final_markdown")
    return out


def backfill_job(spark: SparkSession, updates: DataFrame, tables: list[str], base: str, run_id: str, new_run_id: str) -> None:
    """Put new document status into existing outputs by id, as tables of a new run."""
    for name in tables:
        path = sinks.run_path(base, run_id, name)
        table = spark.read.parquet(path)
        for column, kind in (("pdfa_conversion_ok", "boolean"),):
            if column not in table.columns:
                table = table.withColumn(column, F.lit(None).cast(kind))
        sinks.write_table(report.apply_status(table, updates), base, new_run_id, name)
