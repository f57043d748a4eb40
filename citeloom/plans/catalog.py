"""Checked queries: every one reads whole test tables, or tables that Spark derives from them."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom import schemas
from citeloom.functions import html, names, urls
from citeloom.functions.arrays import decode_inverted_index, inverted_index
from citeloom.functions.bind import once
from citeloom.functions.ids import file_stem
from citeloom.functions.scan import ScanSpec, find_mentions, mention_context
from citeloom.functions.text import chunk_words, ws
from citeloom.operators import (
    candidates,
    coverage,
    curate,
    docscan,
    finalize,
    matching,
    merge,
    multiscan,
    naming,
    order,
    report,
    snapshot,
)
from citeloom.plans import jobs, sinks, stand_ins
from citeloom.plans.keyed_state import KeyedState
from citeloom.plans.stand_ins import source_records, table
from citeloom.schemas import SOURCE_ORDER
from citeloom.session import configure, materialise, scratch_dir, scratch_table
from citeloom.sources import files, json_sources, markup_sources, roster
from citeloom.sources.common import in_window
from citeloom.streaming.state import current_state, first_arrivals, record_stream, run_upserts

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

LICENCES = ScanSpec(
    phrases=("Apache License", "MIT License", "GNU General Public License", "CC BY-NC 4.0")
)
NUMBER = ScanSpec(phrases=("555-2373", "call 555"), number="555", prefix="call")


def query(fn: Query) -> Query:
    """Registers a query, which runs with the library's runtime settings."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    REGISTRY[fn.__name__] = run
    return run


def keyed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.with_canonical_id(source_records(spark, sf_dir))


@dataclass(frozen=True)
class Run:
    """The written tables of one run's merge step, which all later steps read."""

    keyed: DataFrame
    papers: DataFrame
    values: DataFrame
    records: DataFrame


def _merged_run(spark, sf_dir) -> Run:
    """Records are derived and keyed once, and merged once, however many steps of a query follow."""
    keyed = materialise(keyed_records(spark, sf_dir), "keyed")
    return Run(
        keyed,
        materialise(merge.merge_papers(keyed), "papers"),
        materialise(merge.merge_values(keyed), "paper-values"),
        merge.paper_records(keyed),
    )


# --- merge ----------------------------------------------------------------------------------------------------


@query
def canonical_merge(spark, sf_dir):
    """Merged scalar fields of every paper."""
    return merge.merge_papers(keyed_records(spark, sf_dir)).select(
        "canonical_id", "title", "normalized_title", F.col("year").cast("bigint").alias("year"), "published_date",
        "venue", "doi", F.md5("abstract").alias("abstract_md5"), "record_count", "first_ord",
    )


@query
def canonical_values(spark, sf_dir):
    """Ordered distinct list fields of every paper, as rows."""
    return merge.merge_values(keyed_records(spark, sf_dir))


@query
def canonical_source_records(spark, sf_dir):
    """Contributing records of every paper with their rank."""
    rows = merge.paper_records(keyed_records(spark, sf_dir))
    return order.rank_in_key(rows, ["canonical_id"], "ord", "record_rank")


@query
def metadata_mentions(spark, sf_dir):
    """Mentions in running titles and abstracts of every paper."""
    return merge.metadata_mentions(keyed_records(spark, sf_dir), LICENCES)


@query
def running_best_title(spark, sf_dir):
    """Best title so far at every record of a paper."""
    keyed = keyed_records(spark, sf_dir).select("canonical_id", "ord", "title")
    return order.running_best(keyed, ["canonical_id"], "ord", {"title": "best_title"}).select(
        "canonical_id", "ord", "best_title"
    )


@query
def title_groups(spark, sf_dir):
    """Papers grouped by display-title key."""
    papers = merge.merge_papers(keyed_records(spark, sf_dir)).withColumn("ord", F.col("first_ord"))
    return merge.title_groups(papers).select(
        "group_key", "paper_count", "first_canonical_id", "first_title", "first_ord"
    )


@query
def title_group_values(spark, sf_dir):
    """List fields of title groups, as rows."""
    keyed = keyed_records(spark, sf_dir)
    papers = merge.merge_papers(keyed).withColumn("ord", F.col("first_ord"))
    none = F.lit(None).cast("string")
    papers = papers.select(
        "ord", "canonical_id", "title", "doi", "abstract",
        F.expr("cast(array() as array<string>)").alias("urls"), F.expr("cast(array() as array<string>)").alias("pdf_urls"),
        none.alias("document_pdf_url"),
    )
    values = merge.title_group_values(papers, merge.paper_records(keyed))
    return values.select("group_key", "field", F.md5("value").alias("value_md5"), "first_ord")


# --- order ----------------------------------------------------------------------------------------------------


@query
def top_n_per_group(spark, sf_dir):
    """First three line items per supplier by price."""
    li = table(spark, sf_dir, "lineitem")
    top = order.top_n_per_key(
        li, ["l_suppkey"], [F.col("l_extendedprice").desc(), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")], 3
    )
    return top.select("l_suppkey", "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_extendedprice")


@query
def first_per_key(spark, sf_dir):
    """First customer of every nation and segment."""
    c = table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment", "c_custkey", "c_name")
    return order.first_per_key(c, ["c_nationkey", "c_mktsegment"], ["c_custkey"])


@query
def last_per_key(spark, sf_dir):
    """Last customer of every nation and segment."""
    c = table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment", "c_custkey", "c_name")
    return order.last_per_key(c, ["c_nationkey", "c_mktsegment"], ["c_custkey"])


@query
def rank_in_group(spark, sf_dir):
    """Place of every event among the events of its type, by blocks."""
    e = table(spark, sf_dir, "events").select("event_type", "event_id")
    return order.rank_in_key(e, ["event_type"], "event_id", "place", block_rows=1000)


# --- scan -----------------------------------------------------------------------------------------------------


@query
def phrase_mentions(spark, sf_dir):
    """Licence phrases of every document."""
    docs = table(spark, sf_dir, "documents")
    return docscan.mention_rows(docs, LICENCES, "doc_id", "text")


@query
def award_number_table(spark, sf_dir):
    """Mentions of a table of numbers (the part keys of three digits and more) in all documents, in one pass."""
    numbers = table(spark, sf_dir, "part").where("p_partkey >= 100").select("p_partkey")
    return multiscan.number_mentions(table(spark, sf_dir, "documents"), numbers, "doc_id", "text", "p_partkey")


def _contexts(docs: DataFrame, spec: ScanSpec) -> DataFrame:
    found = once(docs, ["doc_id", "text"], found=find_mentions(F.col("text"), spec)).filter(F.size("found") > 0)
    return found.select(
        "doc_id",
        F.array_join("found", " | ").alias("mentions"),
        mention_context(F.col("text"), F.col("found"), spec).alias("context"),
    )


@query
def phrase_context(spark, sf_dir):
    """Text around the first licence phrase of every document that has one."""
    return _contexts(table(spark, sf_dir, "documents"), LICENCES)


@query
def number_scan_separated(spark, sf_dir):
    """A number as phrase, alone, split or run together, in every document."""
    return _contexts(table(spark, sf_dir, "documents"), NUMBER)


@query
def mention_rule_report(spark, sf_dir):
    """Hits by scan rule and texts that only the loose rules found."""
    rows = docscan.mention_rows(table(spark, sf_dir, "documents"), NUMBER, "doc_id", "text")
    return docscan.rule_report(rows, "doc_id")


# --- sources --------------------------------------------------------------------------------------------------


def _shown() -> list[Column]:
    kept = ["published_date", "venue", "doi"]
    return [
        *[F.col(c) for c in ("member_name", "row_no", "source_id", "title")], F.col("year").cast("bigint").alias("year"), *[F.col(c) for c in kept],
        F.array_join("authors", "; ").alias("authors"), F.md5("abstract").alias("abstract_md5"),
        *[F.col(c) for c in ("landing_page_url", "pdf_url", "relevance_score")],
    ]


def _show(records: DataFrame) -> DataFrame:
    return records.select(*_shown())


MIN_YEAR = 2008


@query
def source_openalex(spark, sf_dir):
    return _show(json_sources.openalex(stand_ins.landed_openalex(spark, sf_dir)))


@query
def source_semantic_scholar(spark, sf_dir):
    return _show(json_sources.semantic_scholar(stand_ins.landed_semantic_scholar(spark, sf_dir), MIN_YEAR))


@query
def source_crossref(spark, sf_dir):
    return _show(json_sources.crossref(stand_ins.landed_crossref(spark, sf_dir), MIN_YEAR))


@query
def source_datacite(spark, sf_dir):
    return _show(json_sources.datacite(stand_ins.landed_datacite(spark, sf_dir), MIN_YEAR))


@query
def source_europe_pmc(spark, sf_dir):
    return _show(json_sources.europe_pmc(stand_ins.landed_europe_pmc(spark, sf_dir), MIN_YEAR))


@query
def source_doaj(spark, sf_dir):
    return _show(json_sources.doaj(stand_ins.landed_doaj(spark, sf_dir), MIN_YEAR))


@query
def source_inspirehep(spark, sf_dir):
    return json_sources.inspirehep(
        stand_ins.landed_inspirehep(spark, sf_dir), stand_ins.people(spark, sf_dir), MIN_YEAR, max_hits=None, columns=_shown()
    )


@query
def collected_records(spark, sf_dir):
    """Records of all twelve sources in the order of a run, from payloads over three pages, blocked pages among them."""
    landed = [getattr(stand_ins, f"landed_{n}")(spark, sf_dir) for n in (
        "dblp", "openalex", "semantic_scholar", "crossref", "datacite", "europe_pmc", "pubmed", "openaire", "doaj", "arxiv", "inspirehep", "scholar_html",
    )]
    columns = ["source", "member_name", "page_no", "row_no", "payload"]
    raw = landed[0].select(columns)
    for part in landed[1:]:
        raw = raw.unionByName(part.select(columns))
    blocked = F.lit("<html><body>Our systems have detected unusual traffic: captcha</body></html>")
    walls = landed[-1].filter("row_no % 50 = 7").select(columns).withColumn("payload", blocked)
    raw = raw.unionByName(walls).withColumn("page_no", F.pmod("row_no", F.lit(3)).cast(raw.schema["page_no"].dataType))
    members = materialise(stand_ins.people(spark, sf_dir).withColumn("member_ord", F.length("name")), "members")
    params = jobs.RunParams("r", "t0", "t1", MIN_YEAR, NUMBER, lookback_years=0)
    shown = ["source", "member_name", "source_id", "title", "doi"]
    return jobs.with_order(jobs.normalise_all(raw, members, params, shown), members, shown, "place").select(*shown, "place")


@query
def pubmed_search_ids(spark, sf_dir):
    """Record ids of landed search answers, one answer per document."""
    answers = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "to_json(named_struct('esearchresult', named_struct('idlist', array(concat(' ', doc_id, ' '), '', cast(n_chars AS string))))) AS payload"
    )
    ids = answers.select("doc_id", F.posexplode(json_sources.pubmed_ids(F.col("payload"))).alias("pos", "pmid"))
    return ids.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "pmid")


@query
def blocked_pages(spark, sf_dir):
    """Error rows of the blocked ones among result pages."""
    pages = stand_ins.landed_scholar_html(spark, sf_dir)
    wall = F.when(F.col("row_no") % 5 == 2, F.concat(F.lit("<p>captcha</p> unusual traffic "), "payload")).otherwise(F.col("payload"))
    return markup_sources.blocked_pages(pages.withColumn("payload", wall)).groupBy("source", "member", "error").agg(F.count("*").alias("pages"))


@query
def source_google_scholar_json(spark, sf_dir):
    return _show(json_sources.google_scholar_json(stand_ins.landed_scholar_json(spark, sf_dir), MIN_YEAR))


@query
def source_google_scholar_html(spark, sf_dir):
    return _show(markup_sources.google_scholar_html(stand_ins.landed_scholar_html(spark, sf_dir), MIN_YEAR))


@query
def source_dblp(spark, sf_dir):
    return _show(markup_sources.dblp(stand_ins.landed_dblp(spark, sf_dir), MIN_YEAR))


@query
def source_arxiv(spark, sf_dir):
    return _show(markup_sources.arxiv(stand_ins.landed_arxiv(spark, sf_dir), MIN_YEAR))


@query
def source_pubmed(spark, sf_dir):
    return _show(markup_sources.pubmed(stand_ins.landed_pubmed(spark, sf_dir), MIN_YEAR))


@query
def source_openaire(spark, sf_dir):
    return _show(markup_sources.openaire(stand_ins.landed_openaire(spark, sf_dir), MIN_YEAR))


# --- snapshots ------------------------------------------------------------------------------------------------


def _fingerprinted(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    keyed = merge.with_canonical_id(records)
    values = merge.merge_values(keyed)
    return snapshot.fingerprint(merge.merge_papers(keyed), values), values


def _index(records: DataFrame, stamp: str) -> DataFrame:
    """A paper index as a run of that time would have written it."""
    papers, values = _fingerprinted(records)
    nested = merge.nest_values(values, ["sources", "members"])
    return papers.join(nested, "canonical_id").select(
        "canonical_id", "hash", "doi", "title", "year", "published_date", "venue", "sources", "members",
        (F.col("record_count") > 1).alias("award_mentioned_in_metadata"),
        (F.col("year") > 2010).alias("award_mentioned_in_document"),
        F.array(F.lit("cached"), F.col("venue")).alias("award_mentions"),
        F.array(F.lit(" cached  document ")).alias("document_award_mentions"),
        F.when(F.col("year") > 2010, F.lit("pdf")).alias("document_verification_kind"),
        F.lit(" ").alias("document_verification_url"),
        F.lit(None).cast("string").alias("document_scan_error"),
        F.lit(stamp).alias("first_seen_at"), F.lit(stamp).alias("last_seen_at"), F.lit("run-0").alias("last_output_dir"),
    )


def _diffed(spark, sf_dir, run: Run | None = None) -> tuple[DataFrame, DataFrame]:
    previous = _index(stand_ins.labelled_records(spark, sf_dir, run.keyed if run else None), "t0")
    current = snapshot.fingerprint(run.papers, run.values) if run else _fingerprinted(source_records(spark, sf_dir))[0]
    return snapshot.diff(current, previous), previous


@query
def snapshot_diff(spark, sf_dir):
    """Status of every paper against the smaller, earlier collection."""
    return _diffed(spark, sf_dir)[0].select("canonical_id", "status")


@query
def snapshot_counts(spark, sf_dir):
    """New, changed and unchanged papers."""
    return snapshot.status_counts(_diffed(spark, sf_dir)[0])


@query
def snapshot_delta(spark, sf_dir):
    """New and changed ids."""
    return snapshot.delta_ids(_diffed(spark, sf_dir)[0])


@query
def hydrate_cached(spark, sf_dir):
    """Unchanged papers take the cached results."""
    diffed, previous = _diffed(spark, sf_dir)
    fresh = (
        diffed.withColumn("award_mentioned_in_metadata", F.lit(True))
        .withColumn("award_mentioned_in_document", F.lit(False))
        .withColumn("award_mentions", F.array(F.lit("fresh")))
        .withColumn("document_award_mentions", F.expr("cast(array() as array<string>)"))
        .withColumn("document_verification_kind", F.lit("old"))
        .withColumn("document_verification_url", F.lit("old"))
    )
    return snapshot.hydrate(fresh, previous).select(
        "canonical_id", "status", "award_mentioned_in_metadata", "award_mentioned_in_document",
        F.array_join("award_mentions", "|").alias("award_mentions"),
        F.array_join("document_award_mentions", "|").alias("document_award_mentions"),
        "document_verification_kind", "document_verification_url",
    )


@query
def state_upsert(spark, sf_dir):
    """The full collection's index after a later run that saw only the labelled documents."""
    previous = _index(source_records(spark, sf_dir), "t0")
    current = _index(stand_ins.labelled_records(spark, sf_dir), "t1")
    return snapshot.upsert(previous, current, "t1-start", "t1-end", "run-1").select(
        "canonical_id", "title", "doi", F.col("year").cast("bigint").alias("year"),
        F.array_join(F.array_sort("sources"), "|").alias("sources"), "first_seen_at", "last_seen_at", "last_output_dir",
    )


@query
def state_runs(spark, sf_dir):
    """The paper index after three runs and a compaction: all records, the labelled ones, and those of recent years."""
    state = KeyedState(spark, f"{scratch_dir(spark)}/state-{uuid.uuid4().hex[:12]}", schemas.PAPER_INDEX, "canonical_id")
    records = source_records(spark, sf_dir)
    for n, seen in enumerate((records, stand_ins.labelled_records(spark, sf_dir), records.where("year > 2010"))):
        state.append(snapshot.touched(state.current(), _index(seen, f"t{n}"), f"t{n}-start", f"t{n}-end", f"run-{n}"), f"run-{n}")
        if n == 1:
            state.compact()
    return state.current().select(
        "canonical_id", "title", "doi", F.col("year").cast("bigint").alias("year"),
        F.array_join(F.array_sort("sources"), "|").alias("sources"), "first_seen_at", "last_seen_at", "last_output_dir",
    )


@query
def event_first_seen(spark, sf_dir):
    """First event of every user and type."""
    e = table(spark, sf_dir, "events").select(
        F.concat_ws("-", "user_id", "event_type").alias("key"), "event_id", F.col("value").alias("value")
    )
    return snapshot.first_arrivals(e, "key", ["event_id"])


@query
def unseen_keys(spark, sf_dir):
    """First arrivals among papers that the earlier collection did not know."""
    known = merge.merge_papers(merge.with_canonical_id(stand_ins.labelled_records(spark, sf_dir)))
    keyed = keyed_records(spark, sf_dir).select("canonical_id", "ord", "source")
    return snapshot.first_arrivals(keyed, "canonical_id", ["ord"], seen=known)


# --- names ----------------------------------------------------------------------------------------------------


def _hits(spark, sf_dir) -> DataFrame:
    """Author hits: the authors of a record are candidates for its first author."""
    recs = source_records(spark, sf_dir).filter(F.size("authors") > 0)
    return recs.select(
        F.get("authors", F.lit(0)).alias("member_name"), "ord", F.posexplode("authors").alias("pos", "author")
    ).select(
        "member_name",
        (F.col("ord") * 10 + F.col("pos")).alias("hit_ord"),
        "author",
        F.concat(F.lit("https://dblp.org/pid/"), F.md5("author")).alias("url"),
        (F.col("ord") % 2 == 0).alias("has_notes"),
    )


@query
def author_scores(spark, sf_dir):
    """Scores of every author hit by the three weightings."""
    h = _hits(spark, sf_dir)
    for kind in ("dblp", "openalex", "semantic_scholar"):
        h = matching.scored_hits(h, kind).withColumnRenamed("score", f"{kind}_score")
    return h.select("member_name", "hit_ord", "author", "dblp_score", "openalex_score", "semantic_scholar_score")


@query
def best_author_hit(spark, sf_dir):
    """Best hit of every member by the three weightings."""
    h = _hits(spark, sf_dir)
    out = None
    for kind in ("dblp", "openalex", "semantic_scholar"):
        best = matching.best_author_hits(h, kind).select(
            F.lit(kind).alias("kind"), "member_name", "author", "hit_ord", "score"
        )
        out = best if out is None else out.unionByName(best)
    return out


@query
def member_profiles(spark, sf_dir):
    """Profile id of every member: configured ids before the best hit."""
    members = stand_ins.people(spark, sf_dir).select(
        "name", F.expr("cast(array() as array<string>)").alias("aliases"), F.lit(None).cast("string").alias("dblp_pid"),
        F.lit(None).cast("string").alias("dblp_url"),
    )
    hits = _hits(spark, sf_dir).withColumn(
        "member_name", F.concat_ws(" ", F.substring_index("member_name", " ", 1), F.initcap(F.substring_index("member_name", " ", -1)))
    )
    fixed = stand_ins.people(spark, sf_dir).select(
        names.letters_key(F.col("name")).alias("name_key"), F.concat(F.lit("x/"), F.length("name")).alias("pid")
    ).filter(F.length("name_key") < 8).distinct()
    return matching.resolve_pids(members, hits, fixed).select("name", "dblp_pid", "dblp_url", F.array_join("aliases", "|").alias("aliases"))


def _record_authors(spark, sf_dir) -> DataFrame:
    return source_records(spark, sf_dir).select("ord", F.explode("authors").alias("author"))


@query
def name_match_equi(spark, sf_dir):
    """Members named among the authors of every record."""
    return matching.match_records(_record_authors(spark, sf_dir), stand_ins.people(spark, sf_dir))


@query
def name_match_full_given(spark, sf_dir):
    """Author and member pairs with equal surname and compatible given names."""
    return matching.match_authors_full_given(_record_authors(spark, sf_dir), stand_ins.people(spark, sf_dir))


@query
def name_variants(spark, sf_dir):
    """Spellings and search phrases of every roster name."""
    p = stand_ins.people(spark, sf_dir)
    return p.select(
        "name",
        F.array_join(names.name_variants(F.col("name")), "|").alias("variants"),
        names.arxiv_author_query(F.col("name")).alias("arxiv_query"),
        names.pubmed_author_query(F.col("name"), 2020).alias("pubmed_query"),
        names.is_probable_person(F.col("name")).alias("is_person"),
    )


# --- targets --------------------------------------------------------------------------------------------------


@query
def doi_list_parse(spark, sf_dir):
    """Distinct DOIs of free texts in two lists."""
    texts = source_records(spark, sf_dir).select(
        (F.col("ord") % 2).cast("int").alias("list_rank"), "ord",
        F.concat_ws(" ", F.lit("see"), F.concat(F.lit("(doi:"), "doi", F.lit("),")), F.upper("doi"), F.col("title")).alias("text"),
    )
    return coverage.parse_doi_lists(texts).select("doi_key", "doi", F.col("list_rank").cast("bigint").alias("list_rank"), "ord", "pos")


def _targets(spark, sf_dir) -> DataFrame:
    """DOIs of the labelled documents, and one unknown DOI per benchmark item."""
    known = stand_ins.labelled_records(spark, sf_dir).select("ord", F.concat(F.lit(" "), "doi", F.lit(" ")).alias("doi"))
    unknown = table(spark, sf_dir, "benchmark").select(
        (F.lit(1_000_000_000) + F.col("item_id")).alias("ord"), F.concat(F.lit("10.9999/"), "item_id").alias("doi")
    )
    return known.filter(F.col("doi").isNotNull()).unionByName(unknown)


def _flagged_papers(spark, sf_dir, run: Run | None = None) -> DataFrame:
    """Papers with metadata flags; the document flag is taken from the year."""
    keyed = run.keyed if run else keyed_records(spark, sf_dir)
    papers = merge.flag_papers(run.papers if run else merge.merge_papers(keyed), merge.metadata_mentions(keyed, LICENCES))
    return papers.withColumn("award_mentioned_in_document", F.coalesce(F.col("year") > 2015, F.lit(False))).withColumn(
        "ord", F.col("first_ord")
    )


@query
def target_coverage(spark, sf_dir):
    """Found and verified targets."""
    papers = _flagged_papers(spark, sf_dir).select(
        "ord", "doi", "title", "award_mentioned_in_document", "award_mentioned_in_metadata"
    )
    return coverage.coverage_details(_targets(spark, sf_dir), papers, require_document=False).select(
        "doi_key", "target_ord", "found", "title", "award_verified"
    )


@query
def target_coverage_counts(spark, sf_dir):
    """Totals of the coverage."""
    papers = _flagged_papers(spark, sf_dir).select(
        "ord", "doi", "title", "award_mentioned_in_document", "award_mentioned_in_metadata"
    )
    return coverage.coverage_counts(coverage.coverage_details(_targets(spark, sf_dir), papers))


@query
def target_semi(spark, sf_dir):
    """Papers of target DOIs."""
    papers = merge.merge_papers(keyed_records(spark, sf_dir)).withColumn("status", F.lit("unchanged"))
    return coverage.select_for_scan(papers, _targets(spark, sf_dir), target_only=True).select("canonical_id", "doi")


@query
def incremental_selection(spark, sf_dir):
    """Papers whose documents an incremental run scans."""
    return coverage.select_for_scan(_diffed(spark, sf_dir)[0], None, incremental=True).select("canonical_id", "status")


# --- candidates and document scan -----------------------------------------------------------------------------


def _paper_tables(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The written tables of the merge step, which all later steps read."""
    keyed = keyed_records(spark, sf_dir)
    return (
        materialise(merge.merge_papers(keyed), "papers"),
        materialise(merge.merge_values(keyed), "paper-values"),
        materialise(merge.paper_records(keyed), "paper-records"),
    )


@query
def pdf_candidates(spark, sf_dir):
    """Document addresses of every paper."""
    return candidates.pdf_candidates(*_paper_tables(spark, sf_dir)).select("canonical_id", "url", "at.*")


@query
def text_candidates(spark, sf_dir):
    """Full-text addresses of every paper."""
    papers, values, records = _paper_tables(spark, sf_dir)
    pdfs = candidates.pdf_candidates(papers, values, records)
    return candidates.text_candidates(papers, values, pdfs, records).select(
        "canonical_id", "kind", "url", F.col("at.g").alias("g"), F.col("at.at.a").alias("first_ord"), F.col("at.n").alias("n")
    )


@query
def enriched_candidates(spark, sf_dir):
    """Addresses looked up by DOI for papers without any."""
    papers, values, records = _paper_tables(spark, sf_dir)
    pdfs = candidates.pdf_candidates(papers, values, records)
    found = candidates.enrich_from_lookup(papers, pdfs, stand_ins.doi_lookup(spark, sf_dir))
    return found.select("canonical_id", "url", F.col("at.b").alias("pos"))


@query
def enrichment_stats(spark, sf_dir):
    """Counts of the enrichment."""
    papers, values, records = _paper_tables(spark, sf_dir)
    pdfs = candidates.pdf_candidates(papers, values, records)
    found = candidates.enrich_from_lookup(papers, pdfs, stand_ins.doi_lookup(spark, sf_dir))
    listed = values.filter(F.col("field") == "pdf_urls")
    return candidates.enrichment_stats(papers, listed, pdfs, found)


@query
def local_file_candidates(spark, sf_dir):
    """Addresses at which a missing document is looked for again."""
    papers, values, records = _paper_tables(spark, sf_dir)
    papers = papers.withColumn("document_pdf_url", F.concat(F.lit("https://example.org/"), "first_ord", F.lit(".PDF")))
    return candidates.local_file_candidates(papers, values, records).select("canonical_id", "url", "at.stage")


@query
def fulltext_links(spark, sf_dir):
    """PDF addresses named in full-text XML made of the documents."""
    docs = stand_ins.documents(spark, sf_dir)
    xml = docs.selectExpr(
        "concat('https://r.example/PMC', doc_id, '/xml') AS url", "cast(NULL AS string) AS final_url", "doc_id",
        "concat('<article><self-uri xlink:href=\"/f', doc_id, '.pdf\"/><self-uri xlink:href=\"https://e.org/', doc_id, "
        "'.PDF?x\"/><self-uri xlink:href=\"page.html\"/>', text, '</article>') AS body",
    )
    outcomes = docs.selectExpr(
        "concat('p', doc_id) AS canonical_id", "concat('https://r.example/PMC', doc_id, '/xml') AS document_verification_url",
        "CASE WHEN n_chars % 2 = 0 THEN 'pmc_efetch_xml' ELSE 'pdf' END AS document_verification_kind",
    )
    return candidates.fulltext_candidates(outcomes, xml).select("canonical_id", "url", F.col("at.b").alias("pos"))


@query
def publication_merge(spark, sf_dir):
    """List fields of publication rows merged by their title."""
    rows = source_records(spark, sf_dir).select(
        F.md5("title").alias("paper_id"), "ord", "title", "doi", F.col("source_id").alias("dblp_key"),
        F.col("landing_page_url").alias("dblp_record_url"), F.array("source").alias("source_pids"),
        F.array("member_name").alias("members"), F.array_compact(F.array("landing_page_url", "pdf_url")).alias("ee_urls"),
    )
    scalars, values = merge.merge_publications(rows)
    return values.join(scalars, "paper_id").select(
        "paper_id", "field", "value", "first_ord", "first_pos", "doi", "dblp_key", "dblp_record_url"
    )


@query
def retrieval_errors(spark, sf_dir):
    """Why a response is not a usable document."""
    return stand_ins.fetched(spark, sf_dir).select("url", docscan.retrieval_error(30).alias("reason"))


@query
def error_taxonomy(spark, sf_dir):
    """Readable error of long error texts."""
    kind = F.expr("CASE n_chars % 4 WHEN 0 THEN 'SSLEOFError ' WHEN 1 THEN 'x ProxyError ' ELSE '' END")
    docs = table(spark, sf_dir, "documents")
    text = F.when(F.col("n_chars") % 9 == 0, F.lit("  ")).otherwise(F.concat(kind, F.col("text")))
    return docs.select("doc_id", docscan.classify_error(text).alias("error"))


def _scan(spark, sf_dir, run: Run | None = None) -> DataFrame:
    run = run or _merged_run(spark, sf_dir)
    papers, values, records = run.papers, run.values, run.records
    pdfs = materialise(candidates.pdf_candidates(papers, values, records), "pdf-candidates")
    texts = materialise(candidates.text_candidates(papers, values, pdfs, records), "text-candidates")
    scanned = papers.select("canonical_id", F.lit(False).alias("already_mentioned"))
    return docscan.scan_documents(scanned, pdfs, texts, materialise(stand_ins.fetched(spark, sf_dir), "fetched"), LICENCES)


@query
def document_scan(spark, sf_dir):
    """Outcome of the document scan of every paper."""
    return _scan(spark, sf_dir).withColumn("document_award_mentions", F.array_join("document_award_mentions", "|"))


@query
def document_scan_counters(spark, sf_dir):
    """Counters of the document scan."""
    return docscan.scan_counters(_scan(spark, sf_dir))


# --- curation -------------------------------------------------------------------------------------------------


def _curation_inputs(spark, sf_dir):
    keyed = keyed_records(spark, sf_dir)
    sources = merge.nest_values(merge.merge_values(keyed), ["sources"])
    papers = merge.merge_papers(keyed).join(sources, "canonical_id").withColumn("ord", F.col("first_ord"))
    papers = materialise(papers, "papers")
    listed = source_records(spark, sf_dir).select("ord", "title", F.upper("doi").alias("doi"))
    # Candidates that no paper matches, with and without a DOI.
    unknown = listed.where("ord % 10 = 3").selectExpr(
        "ord + 1000000000 AS ord", "concat('Unlisted ', ord) AS title", "if(ord % 20 = 3, NULL, concat('10.9999/UNLISTED.', ord)) AS doi"
    )
    items = listed.unionByName(unknown)
    good = table(spark, sf_dir, "labels").filter("quality = 1").select(F.col("doc_id").alias("ord"))
    return items, items.join(good, "ord", "left_semi"), papers


@query
def curate_decisions(spark, sf_dir):
    """Decision for every candidate of the manifest."""
    items, baseline, papers = _curation_inputs(spark, sf_dir)
    return curate.review(items, baseline, papers).select(
        "ord", "accepted", "confidence", "reason", "portal_eligible", "is_preprint", F.array_join("sources", "|").alias("sources")
    )


@query
def cumulative_manifest(spark, sf_dir):
    """Baseline and accepted candidates."""
    items, baseline, papers = _curation_inputs(spark, sf_dir)
    rows = curate.cumulative(baseline, curate.review(items, baseline, papers))
    return rows.select("ord", "title", "doi", F.col("section").cast("bigint").alias("section"))


@query
def portal_manifest(spark, sf_dir):
    """Rows of the cumulative manifest for the portal."""
    items, baseline, papers = _curation_inputs(spark, sf_dir)
    rows = materialise(curate.cumulative(baseline, curate.review(items, baseline, papers)), "cumulative")
    return curate.portal(rows, papers).select("ord", "title", "doi")


@query
def curation_counts(spark, sf_dir):
    """Counts of the curation."""
    items, baseline, papers = _curation_inputs(spark, sf_dir)
    reviewed = materialise(curate.review(items, baseline, papers), "reviewed")
    return curate.review_counts(baseline, reviewed, curate.portal(curate.cumulative(baseline, reviewed), papers))


# --- finalisation ---------------------------------------------------------------------------------------------


def _final_inputs(spark, sf_dir):
    """Matched manifest items, values of title groups and the groups, as written tables; papers are merged once and dropped again."""
    keyed = keyed_records(spark, sf_dir)
    none = F.lit(None).cast("string")
    empty = F.expr("cast(array() as array<string>)")
    with scratch_table(merge.merge_papers(keyed).withColumn("ord", F.col("first_ord")), "papers") as papers:
        shaped = papers.select(
            "ord", "canonical_id", "title", "doi", "abstract", empty.alias("urls"), empty.alias("pdf_urls"), none.alias("document_pdf_url")
        )
        values = materialise(merge.title_group_values(shaped, merge.paper_records(keyed)), "group-values")
        groups = materialise(merge.title_groups(papers), "title-groups")
    items = finalize.require_valid(finalize.clean_manifest(stand_ins.manifest(spark, sf_dir)))
    matched = finalize.with_groups(items, groups).filter(F.col("group_key").isNotNull())
    return materialise(matched, "items"), values, groups


def _landed_tables(spark, sf_dir):
    """Looked-up works and fetched responses, as written tables."""
    return (
        materialise(stand_ins.doi_lookup(spark, sf_dir), "doi-lookup"),
        materialise(stand_ins.fetched(spark, sf_dir), "fetched"),
    )


def _verification(spark, sf_dir) -> DataFrame:
    bad = table(spark, sf_dir, "labels").filter("quality = 0").select(F.col("doc_id").alias("ord"))
    recs = source_records(spark, sf_dir).join(bad, "ord", "left_semi")
    return merge.with_title_group(recs).select("group_key", F.lit("landing_page_text").alias("kind"), F.col("landing_page_url").alias("url"), "ord")


def _local_files(spark, sf_dir) -> DataFrame:
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1").select(F.col("doc_id").alias("ord"))
    recs = source_records(spark, sf_dir).join(toxic, "ord", "left_semi")
    return merge.with_title_group(recs).select(
        "group_key", "ord", F.concat(F.lit("/files/"), "ord", F.lit(".pdf")).alias("path"), (F.col("ord") % 2 == 0).alias("ok"),
        F.when(F.col("ord") % 2 == 1, F.lit("conversion failed")).alias("error"),
    )


@query
def manifest_groups(spark, sf_dir):
    """Manifest items with their title group."""
    items, _, _ = _final_inputs(spark, sf_dir)
    return items.select("ord", "group_key", "first_title", "first_canonical_id", "paper_count")


@query
def archived_copies(spark, sf_dir):
    """Archived copy chosen for every title group."""
    return finalize.choose_archived_copy(_local_files(spark, sf_dir))


@query
def discovered_candidates(spark, sf_dir):
    """Documents found through lookups and on landing pages of manifest items."""
    items, values, _ = _final_inputs(spark, sf_dir)
    direct = finalize.direct_candidates(items, values)
    found = finalize.discovered_candidates(items, values, *_landed_tables(spark, sf_dir), direct)
    return found.select("group_key", "preprint", "ord", "url", F.col("at.s").cast("bigint").alias("stage"))


@query
def snapshot_texts(spark, sf_dir):
    """First usable text of every manifest item."""
    items, values, _ = _final_inputs(spark, sf_dir)
    texts = finalize.snapshot_texts(items, values, _verification(spark, sf_dir), stand_ins.fetched(spark, sf_dir))
    return texts.select("ord", "kind", "source_url", F.md5("text").alias("text_md5"))


@query
def metadata_snapshot(spark, sf_dir):
    """Citation and abstract lines of the manifest items and their groups."""
    items, values, _ = _final_inputs(spark, sf_dir)
    lines = finalize.metadata_snapshot(items, values, stand_ins.doi_lookup(spark, sf_dir))
    return lines.select("group_key", "ord", F.col("section").cast("bigint").alias("section"), "label", F.md5("text").alias("text_md5"))


@query
def snapshot_documents(spark, sf_dir):
    """Length, lines and digests of the composed metadata snapshot of every manifest item."""
    items, values, _ = _final_inputs(spark, sf_dir)
    lines = materialise(finalize.metadata_snapshot(items, values, stand_ins.doi_lookup(spark, sf_dir)), "snapshot-lines")
    return finalize.snapshot_documents(items, lines).select("ord", "chars", "n_lines", "digest", "text_md5")


@query
def snapshot_pieces(spark, sf_dir):
    """Printed pieces of the metadata snapshots, each group's once."""
    items, values, _ = _final_inputs(spark, sf_dir)
    lines = materialise(finalize.metadata_snapshot(items, values, stand_ins.doi_lookup(spark, sf_dir)), "snapshot-lines")
    pieces = finalize.snapshot_pieces(lines)
    owner = pieces.groupBy("group_key", "ord", F.col("section").cast("bigint").alias("section"), "label")
    return owner.agg(F.sum(F.char_length("piece")).cast("bigint").alias("chars"), F.count_if(F.col("piece").startswith("\n") & ~F.col("piece").startswith("\n\n")).alias("openings"))


@query
def best_evidence(spark, sf_dir):
    """Best evidence of every manifest item."""
    items, values, _ = _final_inputs(spark, sf_dir)
    return finalize.best_evidence(
        items, values, _verification(spark, sf_dir), *_landed_tables(spark, sf_dir), _local_files(spark, sf_dir)
    ).select(
        "ord", F.col("rank").cast("bigint").alias("rank"), "evidence_kind", "evidence_url", "snapshot_kind",
        finalize.snapshot_note(F.col("snapshot_kind")).alias("note"), "matched_ids", "first_id", "error",
    )


@query
def final_markdown(spark, sf_dir):
    """Markdown block of every manifest item."""
    return finalize.markdown_blocks(finalize.clean_manifest(stand_ins.manifest(spark, sf_dir)))


# --- texts and pages ------------------------------------------------------------------------------------------


@query
def page_text(spark, sf_dir):
    """Visible text of every page, by the HTML parser."""
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", F.md5(html.visible_text("html")).alias("text_md5"))


@query
def page_text_expression(spark, sf_dir):
    """Visible text of every page, by JVM expressions."""
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", F.md5(html.markup_text(F.col("html"))).alias("text_md5"))


@query
def page_links(spark, sf_dir):
    """Document links of every page, with a meta tag and two links put into the pages."""
    pages = table(spark, sf_dir, "pages").selectExpr(
        "url", "cast(NULL AS string) AS final_url", "'text/html' AS content_type",
        "replace(replace(html, '</head>', concat('<meta name=\"citation_pdf_url\" content=\"/downloads/', page_id, '.pdf\"></head>')), "
        "'</nav>', concat('<a href=\"files/', page_id, '.PDF\">x</a><a href=\"/pdf/', page_id, '\">y</a></nav>')) AS body",
    )
    return html.document_links(pages)


@query
def host_audit(spark, sf_dir):
    """Requests and errors in total, by transport and by host."""
    log = table(spark, sf_dir, "pages").selectExpr(
        "url", "CASE page_id % 3 WHEN 0 THEN 'requests' WHEN 1 THEN 'urllib' ELSE 'browser' END AS transport", "true AS use_proxy",
        "CASE WHEN length(html) % 5 = 0 THEN 'timeout' END AS error",
    )
    return report.request_audit(log)


@query
def usable_text(spark, sf_dir):
    """Whether every document is long and clean enough for a snapshot."""
    return table(spark, sf_dir, "documents").select("doc_id", finalize.usable_text(F.col("text")).alias("usable"))


@query
def chunk_text(spark, sf_dir):
    """Greedy chunks of every document."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(chunk_words(F.col("text"), 1500)).alias("n", "chunk")).select(
        "doc_id", F.col("n").cast("bigint").alias("n"), F.md5("chunk").alias("chunk_md5")
    )


@query
def inverted_index_decode(spark, sf_dir):
    """Every text turned into a word index and back, each in its own row."""
    index = table(spark, sf_dir, "documents").select("doc_id", inverted_index(F.split(ws("text"), " ")).alias("index"))
    return index.select("doc_id", F.md5(decode_inverted_index(F.col("index"))).alias("text_md5"))


def _team_pages(spark, sf_dir):
    names_of = source_records(spark, sf_dir).filter(F.size("authors") > 0)
    link = lambda tag, extra: F.concat_ws(
        "", F.transform("authors", lambda a: F.concat(F.lit(f"<{tag}{extra}><a href='/p/"), F.md5(a), F.lit("'>"),
                                                     F.initcap(a), F.lit(f"</a></{tag}>"))))
    heading = F.when(F.col("ord") % 2 == 0, link("h3", " class='et_pb_module_header'")).otherwise(link("p", ""))
    return names_of.select(
        F.col("ord").alias("page_id"), F.lit("https://example.org/team").alias("source_url"),
        F.concat(F.lit("<html><body><p><a href='/'>The Team</a></p>"), heading, F.lit("</body></html>")).alias("html"),
    )


@query
def team_roster(spark, sf_dir):
    """People on team pages made of the documents' names, headings before plain anchors."""
    return roster.roster_from_pages(_team_pages(spark, sf_dir)).select(
        "page_id", F.col("tier").cast("bigint").alias("tier"), "name", "profile_url"
    )


@query
def unique_names(spark, sf_dir):
    """Unique file names of all parts."""
    parts = table(spark, sf_dir, "part").select(file_stem(F.col("p_name")).alias("stem"), F.col("p_partkey").alias("ord"))
    return naming.unique_names(parts)


# --- reports --------------------------------------------------------------------------------------------------


def _health(spark, sf_dir) -> DataFrame:
    """Failed checks: sources whose documents of one language are all long."""
    recs = source_records(spark, sf_dir)
    return recs.groupBy("source").agg(F.avg(F.length("abstract")).alias("mean")).filter("mean > 1500").select(
        "source", F.lit("HTTP 503").alias("error")
    )


@query
def source_counts(spark, sf_dir):
    """Records and errors of every source after failed ones are left out."""
    health = _health(spark, sf_dir)
    kept = report.drop_failed_sources(source_records(spark, sf_dir), health)
    return report.source_counts(kept, report.probe_errors(health))


@query
def active_sources(spark, sf_dir):
    """Sources in merge order with the result of their check."""
    return report.active_sources(_health(spark, sf_dir), SOURCE_ORDER).select(
        "source", F.col("source_rank").cast("bigint").alias("source_rank"), "probe", "active"
    )


def _report_papers(spark, sf_dir, run: Run | None = None, outcomes: DataFrame | None = None) -> DataFrame:
    """Papers with scan results in the shape of the report."""
    run = run or _merged_run(spark, sf_dir)
    nested = merge.nest_values(run.values, ["members", "sources"])
    papers = _flagged_papers(spark, sf_dir, run).join(nested, "canonical_id")
    empty = F.expr("cast(array() as array<string>)")
    shaped = papers.select(
        "canonical_id", "title", "year", "venue", "doi", "members", "sources", "first_ord", "award_mentioned_in_metadata",
        F.lit(False).alias("award_mentioned_in_document"), empty.alias("award_mentions"), empty.alias("document_award_mentions"),
    )
    scanned = outcomes if outcomes is not None else _scan(spark, sf_dir, run)
    return materialise(docscan.apply_outcomes(shaped, scanned), "report-papers")


@query
def records_sorted_top100(spark, sf_dir):
    """First hundred papers of the report order."""
    papers = merge.merge_papers(keyed_records(spark, sf_dir))
    return report.top_papers(papers).select("canonical_id", "title", F.col("year").cast("bigint").alias("year"))


@query
def award_split(spark, sf_dir):
    """Papers with and without a mention, by year."""
    with_award, without = report.split_by_award(_report_papers(spark, sf_dir), scanned=True)
    rows = with_award.select("year", F.lit(True).alias("award")).unionByName(without.select("year", F.lit(False).alias("award")))
    return rows.groupBy(F.col("year").cast("bigint").alias("year"), "award").agg(F.count("*").alias("papers"))


@query
def award_summary(spark, sf_dir):
    """Compact rows of papers with a hit in their document."""
    none = F.lit(None).cast("string")
    papers = _report_papers(spark, sf_dir).withColumn("document_pdf_local_path", none).withColumn(
        "document_pdfa_path", F.when(F.col("document_pdf_url").isNotNull(), F.concat(F.lit("/a/"), "first_ord"))
    ).withColumn("document_pdfa_error", none)
    return report.award_summary(papers).select(
        "canonical_id", F.array_join("award_mentions", "|").alias("award_mentions"), F.array_join("members", "|").alias("members"),
        F.array_join("sources", "|").alias("sources"), "document_verification_kind", "pdfa_conversion_ok",
    )


@query
def status_backfill(spark, sf_dir):
    """New document status put into the papers by id."""
    papers = merge.merge_papers(keyed_records(spark, sf_dir)).selectExpr(
        "canonical_id", "concat('/old/', first_ord) AS document_pdf_local_path", "'u' AS document_pdf_url",
        "cast(NULL AS string) AS document_pdfa_path", "'old' AS document_pdfa_error", "false AS pdfa_conversion_ok",
    )
    known = merge.merge_papers(merge.with_canonical_id(stand_ins.labelled_records(spark, sf_dir)))
    updates = known.selectExpr(
        "canonical_id", "concat('/new/', first_ord) AS document_pdf_local_path", "cast(NULL AS string) AS document_pdf_url",
        "concat('/a/', first_ord) AS document_pdfa_path", "cast(NULL AS string) AS document_pdfa_error", "true AS pdfa_conversion_ok",
    )
    return report.apply_status(papers, updates)


@query
def run_summary(spark, sf_dir):
    """All counts of a run in one row."""
    recs, run = source_records(spark, sf_dir), _merged_run(spark, sf_dir)
    counts = report.source_counts(recs, report.probe_errors(_health(spark, sf_dir)))
    scanned = docscan.scan_counters(_scan(spark, sf_dir, run))
    papers = run.papers
    per_source = report.as_map(counts, "source", "records", "source_record_counts")
    row = report.summary_row(
        spark,
        [recs.agg(F.count("*").alias("raw_record_count")), papers.agg(F.count("*").alias("canonical_paper_count")),
         snapshot.status_counts(_diffed(spark, sf_dir, run)[0]), scanned, per_source],
        run_started_at="t0", lookback_years=2,
    )
    return row.select(
        "run_started_at", F.col("lookback_years").cast("bigint").alias("lookback_years"), "raw_record_count",
        "canonical_paper_count", "new_count", "changed_count", "unchanged_count", "papers_total", "mentions_count",
        F.array_join(F.transform(F.map_entries("source_record_counts"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias("source_record_counts"),
    )


@query
def run_report(spark, sf_dir):
    """The text report of a run."""
    run = _merged_run(spark, sf_dir)
    outcomes = materialise(_scan(spark, sf_dir, run), "outcomes")
    papers = _report_papers(spark, sf_dir, run, outcomes)
    with_award, _ = report.split_by_award(papers, scanned=True)
    top = report.top_papers(with_award)
    # At most a hundred rows are ranked here.
    ranked = top.withColumn("rank", F.row_number().over(report.report_window(top)))
    health = materialise(_health(spark, sf_dir), "health")
    counts = report.source_counts(source_records(spark, sf_dir), report.probe_errors(health))
    probes = report.active_sources(health, SOURCE_ORDER).select("source", "probe")
    summary = report.summary_row(
        spark,
        [source_records(spark, sf_dir).agg(F.count("*").alias("raw_record_count")),
         papers.agg(F.count("*").alias("canonical_paper_count")), with_award.agg(F.count("*").alias("award_match_count")),
         docscan.scan_counters(outcomes), snapshot.status_counts(_diffed(spark, sf_dir, run)[0])],
        run_finished_at="t1", team_member_count=4, lookback_years=2, target_doi_total=0, target_doi_matched=0, target_doi_missing=0,
    )
    return report.report_lines(summary, counts.join(probes, "source", "left"), ranked).select(
        F.col("section").cast("bigint").alias("section"), "line_no", "line"
    )


# --- files and outputs: written and read back -----------------------------------------------------------------


def _folder(spark, name):
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@query
def lookback_window(spark, sf_dir):
    """Records of the lookback window of a run in 2014; records without a year stay."""
    return in_window(source_records(spark, sf_dir), 2014 - 2).select("ord", F.col("year").cast("bigint").alias("year"))


@query
def limited_roster(spark, sf_dir):
    """The first hundred people of the team pages; configured names count only where no page has anybody."""
    people = roster.roster_or_fallback(roster.roster_from_pages(_team_pages(spark, sf_dir)), ["Nobody Else"], "https://example.org/team")
    return roster.limit_roster(people, 100).select("page_id", "name")


@query
def partitioned_records(spark, sf_dir):
    """Records written in one folder per source and read back."""
    back = sinks.write_table(source_records(spark, sf_dir), _folder(spark, "run"), "r1", "source_records", ["source"])
    return back.groupBy("source").agg(F.count("*").alias("records"), F.min("ord").alias("first_ord"), F.count("doi").alias("with_doi"))


@query
def json_papers(spark, sf_dir):
    """Papers as JSON lines, read back; missing fields come back as NULL."""
    base = _folder(spark, "run")
    sinks.write_json(merge.merge_papers(keyed_records(spark, sf_dir)), base, "r1", "papers")
    back = spark.read.schema("canonical_id STRING, title STRING, year BIGINT, venue STRING, doi STRING, abstract STRING").json(sinks.run_path(base, "r1", "papers"))
    return back.select("canonical_id", "title", "year", "venue", "doi", F.md5("abstract").alias("abstract_md5"))


@query
def accepted_additions(spark, sf_dir):
    """Accepted and rejected candidates and the portal list as the curation job writes them."""
    base = _folder(spark, "curation")
    jobs.curation_job(*_curation_inputs(spark, sf_dir), base, "c1")
    rows = None
    for name in ("accepted_additions", "rejected_candidates", "portal_manifest"):
        part = spark.read.schema("ord BIGINT, doi STRING").json(sinks.run_path(base, "c1", name)).select(F.lit(name).alias("output"), "ord", "doi")
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query
def published_papers(spark, sf_dir):
    """Papers of the latest published run and of the one before it; a run that is not published is not seen."""
    base = _folder(spark, "runs")
    for run_id, records in (("b", stand_ins.labelled_records(spark, sf_dir)), ("a", source_records(spark, sf_dir)), ("c", stand_ins.labelled_records(spark, sf_dir))):
        sinks.write_table(merge.with_canonical_id(records).select("canonical_id").distinct(), base, run_id, "papers")
        if run_id != "c":
            sinks.publish(spark, base, run_id)
    latest, before = sinks.read_latest(spark, base, "papers"), sinks.read_latest(spark, base, "papers", before="a")
    return latest.withColumn("run", F.lit("latest")).unionByName(before.withColumn("run", F.lit("before")))


@query
def prior_state(spark, sf_dir):
    """A paper index read from files; rows without an id are dropped, and no files are an empty index."""
    path = _folder(spark, "index")
    index = _index(source_records(spark, sf_dir), "t0")
    index.withColumn("canonical_id", F.when(F.col("title").rlike("^[A-M]"), F.col("canonical_id"))).write.parquet(path)
    read = files.paper_index(spark, path).unionByName(files.paper_index(spark, f"{path}-none"))
    return read.select("canonical_id", "title", F.array_join(F.array_sort("sources"), "|").alias("sources"), "last_output_dir")


@query
def manifest_files(spark, sf_dir):
    """A manifest written as files of one JSON array each, read back and judged."""
    path = _folder(spark, "manifest")
    rows = source_records(spark, sf_dir).select(
        F.floor(F.col("ord") / 500).alias("part"),
        F.struct("title", "authors", F.array("member_name").alias("member_authors"), F.col("landing_page_url").alias("url"), "doi").alias("row"),
    )
    arrays = rows.groupBy("part").agg(F.to_json(F.collect_list("row")).alias("value"))  # five hundred rows at most
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    judged = finalize.clean_manifest(files.manifest(spark, path))
    return judged.groupBy("title", "url", "doi", "valid").agg(F.count("*").alias("rows"))


@query
def publication_links(spark, sf_dir):
    """Candidates of single publication rows, from their links and DOI."""
    number = F.regexp_extract("pdf_url", r"([0-9]{4}\.[0-9]{4,5})$", 1)
    links = F.array("landing_page_url", F.concat("pdf_url", F.lit(".pdf")), F.when(number != "", F.concat(F.lit("https://arxiv.org/abs/"), number)))
    found = candidates.publication_candidates(F.filter(links, lambda u: u.isNotNull()), F.col("doi"))
    return source_records(spark, sf_dir).select("ord", F.array_join(found, " ").alias("urls"))


@query
def service_addresses(spark, sf_dir):
    """Query addresses with scheme and path filled in, over the page addresses, every other one without a scheme."""
    bare = F.when(F.col("page_id") % 2 == 0, F.regexp_replace("url", "^https?://", "")).otherwise(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", urls.arxiv_api_url(bare, "http://export.arxiv.org/api/query").alias("address"))


# --- streams --------------------------------------------------------------------------------------------------


@query
def state_upsert_stream(spark, sf_dir):
    """Paper state after a stream of records: the labelled documents first, then all of them."""
    folder = f"{scratch_dir(spark)}/stream-{uuid.uuid4().hex[:12]}"
    stand_ins.labelled_records(spark, sf_dir).write.parquet(f"{folder}/landed")
    run_upserts(record_stream(spark, f"{folder}/landed"), f"{folder}/state", f"{folder}/progress").awaitTermination()
    source_records(spark, sf_dir).write.mode("append").parquet(f"{folder}/landed")
    run_upserts(record_stream(spark, f"{folder}/landed"), f"{folder}/state", f"{folder}/progress").awaitTermination()
    return current_state(spark, f"{folder}/state").select("canonical_id", "status", "first_seen_at", "last_seen_at")


@query
def event_first_seen_stream(spark, sf_dir):
    """First arrivals in the event stream, which lands in eight files and is read in as many micro-batches."""
    folder = f"{scratch_dir(spark)}/events-{uuid.uuid4().hex[:12]}"
    events = table(spark, sf_dir, "events")
    events.repartition(8).write.parquet(f"{folder}/landed")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/landed")
    fresh = first_arrivals(stream.select(F.concat_ws("-", "user_id", "event_type").alias("key"), "ts"), "key")
    fresh.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/progress").trigger(
        availableNow=True
    ).start().awaitTermination()
    return spark.read.schema("key STRING, ts TIMESTAMP").parquet(f"{folder}/out").select("key")
