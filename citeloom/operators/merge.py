"""Merge of source records into canonical papers, and grouping of papers by title.

Papers are kept as a narrow table plus child tables instead of nested lists. A paper whose key holds
a large share of all records therefore never becomes one giant row:

* ``papers``: one row per canonical id with the merged scalar fields;
* ``paper_values``: distinct values of the list fields (authors, members, urls, pdf_urls, sources), where
  ``first_ord`` and ``first_pos`` give list order;
* ``paper_records``: every contributing record, in ``ord`` order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions import ids
from citeloom.functions.arrays import distinct_ws, or_empty
from citeloom.functions.scan import ScanSpec, find_mentions
from citeloom.functions.text import display_text, strip, title_key, ws
from citeloom.operators.joins import lookup_join
from citeloom.operators.order import DEFAULT_BLOCK_ROWS, running_best

LIST_FIELDS = ["authors", "members", "urls", "pdf_urls", "sources"]


def with_canonical_id(records: DataFrame) -> DataFrame:
    """Blank titles dropped, titles cleaned, ``canonical_id`` added."""
    return (
        records.withColumn("title", ws("title"))
        .filter(F.col("title") != "")
        .withColumn(
            "canonical_id",
            ids.canonical_id(
                F.col("doi"),
                F.col("source_id"),
                F.col("landing_page_url"),
                F.col("pdf_url"),
                F.col("title"),
                F.col("year"),
            ),
        )
    )


def _longest(c: str) -> Column:
    return F.max_by(c, F.when(F.length(c) > 0, F.struct(F.length(c), -F.col("ord"))))


def _first_filled(c: str) -> Column:
    return F.min_by(c, F.when(F.length(c) > 0, F.col("ord")))


#: Lengths and places share one decimal, the place in the lower digits.
_PLACES = 10**18


def _longest_at(c: str) -> Column:
    """Length and place of the longest non-blank text, the earliest on ties, as one number that hashes aggregate."""
    length = F.length(c).cast("decimal(10,0)") * F.lit(_PLACES).cast("decimal(20,0)")
    return F.max(F.when(F.length(c) > 0, (length + (F.lit(_PLACES - 1).cast("decimal(20,0)") - F.col("ord"))).cast("decimal(38,0)")))


def _place_of(packed: Column) -> Column:
    return (F.lit(_PLACES - 1).cast("decimal(20,0)") - F.pmod(packed, F.lit(_PLACES).cast("decimal(20,0)"))).cast("bigint")


def merge_papers(keyed: DataFrame) -> DataFrame:
    """One row per canonical id: longest title and abstract, smallest year and date, first venue and DOI.

    All aggregates combine before the shuffle. Abstracts, the long texts, take no part in them: only length and place of
    the longest one do, and the text of the winner is joined back by its place. ``ord`` is unique, not negative and below 10^18.
    """
    merged = keyed.groupBy("canonical_id").agg(
        _longest("title").alias("title"),
        F.min("year").alias("year"),
        F.min("published_date").alias("published_date"),
        _first_filled("venue").alias("venue"),
        _first_filled("doi").alias("doi"),
        _longest_at("abstract").alias("_at"),
        F.count("*").alias("record_count"),
        F.min("ord").alias("first_ord"),
    )
    texts = keyed.filter(F.length("abstract") > 0).select(F.col("ord").alias("_ord"), "abstract")
    joined = texts.join(merged.withColumn("_ord", _place_of(F.col("_at"))), "_ord", "right")
    return joined.select(
        "canonical_id", "title", "year", "published_date", "venue", "doi", "abstract", "record_count", "first_ord",
        title_key("title").alias("normalized_title"),
    )


def _value_rows(field: str, arr: Column) -> Column:
    return F.transform(
        distinct_ws(arr),
        lambda v, i: F.struct(F.lit(field).alias("field"), i.cast("bigint").alias("pos"), v.alias("value")),
    )


def value_rows(keyed: DataFrame) -> DataFrame:
    """List values of every record as rows ``(canonical_id, ord, v)`` with ``v`` a struct of field, pos and value; no shuffle."""
    return keyed.select(
        "canonical_id",
        "ord",
        F.explode(
            F.concat(
                _value_rows("authors", F.col("authors")),
                _value_rows("members", F.array("member_name")),
                _value_rows("urls", F.array("landing_page_url")),
                _value_rows("pdf_urls", F.array("pdf_url")),
                _value_rows("sources", F.array("source")),
            )
        ).alias("v"),
    )


def merge_values(keyed: DataFrame) -> DataFrame:
    """Ordered distinct list fields as rows ``(canonical_id, field, value, first_ord, first_pos)``."""
    firsts = value_rows(keyed).groupBy("canonical_id", F.col("v.field").alias("field"), F.col("v.value").alias("value")).agg(
        F.min(F.struct("ord", F.col("v.pos").alias("pos"))).alias("at")
    )
    return firsts.select(
        "canonical_id", "field", "value", F.col("at.ord").alias("first_ord"), F.col("at.pos").alias("first_pos")
    )


def paper_records(keyed: DataFrame) -> DataFrame:
    """Every contributing record with its paper, order kept in ``ord``; no shuffle."""
    return keyed.select(
        "canonical_id",
        "ord",
        "source",
        "source_id",
        "member_name",
        "relevance_score",
        "landing_page_url",
        "pdf_url",
    )


def metadata_mentions(
    keyed: DataFrame, spec: ScanSpec, block_rows: int = DEFAULT_BLOCK_ROWS
) -> DataFrame:
    """Mentions in the metadata of a paper: ``(canonical_id, mention, first_ord, first_pos)``.

    Every record is scanned together with the best title and abstract known at its place in the order,
    so a phrase that runs from the title into an abstract counts.
    """
    running = running_best(
        keyed.select("canonical_id", "ord", "title", "abstract"),
        ["canonical_id"],
        "ord",
        {"title": "best_title", "abstract": "best_abstract"},
        block_rows,
        first_flag="is_first",
    )
    own = F.nullif(F.col("abstract"), F.lit(""))
    text = F.when(F.col("is_first"), F.concat_ws(" ", "best_title", own)).otherwise(
        F.concat_ws(" ", "best_title", "best_abstract", own)
    )
    hits = running.select("canonical_id", "ord", F.posexplode(find_mentions(text, spec)).alias("pos", "mention"))
    firsts = hits.groupBy("canonical_id", "mention").agg(F.min(F.struct("ord", "pos")).alias("at"))
    return firsts.select(
        "canonical_id",
        "mention",
        F.col("at.ord").alias("first_ord"),
        F.col("at.pos").cast("bigint").alias("first_pos"),
    )


def merge_publications(publications: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merge of publication rows of one source by ``paper_id``, in ``ord`` order.

    Returns the scalar fields (first filled DOI, key and record address win) and the ordered distinct
    values of ``source_pids``, ``members`` and ``ee_urls`` as rows, exactly as they were given.
    """
    scalars = publications.groupBy("paper_id").agg(
        _first_filled("doi").alias("doi"),
        _first_filled("dblp_key").alias("dblp_key"),
        _first_filled("dblp_record_url").alias("dblp_record_url"),
        F.min_by("title", "ord").alias("title"),
    )

    def rows(field: str) -> Column:
        return F.transform(
            or_empty(F.col(field)),
            lambda v, i: F.struct(F.lit(field).alias("field"), i.cast("bigint").alias("pos"), v.alias("value")),
        )

    listed = publications.select(
        "paper_id", "ord", F.explode(F.concat(rows("source_pids"), rows("members"), rows("ee_urls"))).alias("v")
    )
    firsts = listed.groupBy("paper_id", F.col("v.field").alias("field"), F.col("v.value").alias("value")).agg(
        F.min(F.struct("ord", F.col("v.pos").alias("pos"))).alias("at")
    )
    return scalars, firsts.select(
        "paper_id", "field", "value", F.col("at.ord").alias("first_ord"), F.col("at.pos").alias("first_pos")
    )


def flag_papers(papers: DataFrame, mentions: DataFrame) -> DataFrame:
    """Adds ``award_mentioned_in_metadata``."""
    flagged = mentions.select("canonical_id").distinct().withColumn("_hit", F.lit(True))
    return papers.join(flagged, "canonical_id", "left").withColumn(
        "award_mentioned_in_metadata", F.coalesce("_hit", F.lit(False))
    ).drop("_hit")


def nest_values(values: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """List fields as arrays on one row per paper, for exports and fingerprints.

    The arrays hold distinct values only. Use it for fields whose distinct values per paper are few
    (members and sources are bounded by the roster and by the source list).
    """
    wanted = fields or LIST_FIELDS
    ordered = lambda f: F.transform(
        F.array_sort(
            F.collect_list(F.when(F.col("field") == f, F.struct("first_ord", "first_pos", "value")))
        ),
        lambda s: s["value"],
    )
    return values.filter(F.col("field").isin(wanted)).groupBy("canonical_id").agg(
        *[ordered(f).alias(f) for f in wanted]
    )


# --- grouping by title ----------------------------------------------------------------------------------------


def title_groups(papers: DataFrame) -> DataFrame:
    """One row per display-title key: number of papers, first title, first canonical id. ``ord`` orders papers."""
    keyed = with_title_group(papers)
    return keyed.groupBy("group_key").agg(
        F.count("*").alias("paper_count"),
        F.min_by("canonical_id", "ord").alias("first_canonical_id"),
        F.min_by("display_title", F.when(F.col("display_title") != "", F.col("ord"))).alias("first_title"),
        F.min("ord").alias("first_ord"),
    )


def with_title_group(papers: DataFrame) -> DataFrame:
    """Adds ``group_key`` and ``display_title``; rows without a key are dropped."""
    shown = display_text(F.col("title"), strip_period=False)
    return (
        papers.withColumn("display_title", shown)
        .withColumn("group_key", title_key("display_title"))
        .filter(F.col("group_key") != "")
    )


def title_group_values(papers: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """List fields of title groups as rows ``(group_key, field, value, first_ord, first_pos)``.

    ``papers`` needs ``ord, canonical_id, title, doi, abstract, urls, pdf_urls, document_pdf_url``.
    ``records`` are the contributing records with ``canonical_id, ord``; their links follow the paper's own.
    Values are trimmed only, blanks are dropped, case matters.
    """
    keyed = with_title_group(papers)

    def rows(field: str, arr: Column, base: int) -> Column:
        return F.transform(
            F.filter(F.transform(or_empty(arr), strip), lambda v: v.isNotNull() & (v != "")),
            lambda v, i: F.struct(
                F.lit(field).alias("field"), (i + base).cast("bigint").alias("pos"), v.alias("value")
            ),
        )

    own = keyed.select(
        "group_key",
        "ord",
        F.explode(
            F.concat(
                rows("canonical_ids", F.array("canonical_id"), 0),
                rows("titles", F.array("display_title"), 0),
                rows("dois", F.array("doi"), 0),
                rows("urls", F.col("urls"), 0),
                rows("pdf_urls", F.col("pdf_urls"), 0),
                # The chosen document follows the listed ones, the links of the records follow both.
                rows("pdf_urls", F.array("document_pdf_url"), 1 << 20),
                rows("abstracts", F.array(display_text(F.col("abstract"), strip_period=False)), 0),
            )
        ).alias("v"),
    )
    if records is not None:
        linked = (
            lookup_join(
                records.select("canonical_id", F.col("ord").alias("rec_ord"), "landing_page_url", "pdf_url"),
                keyed.select("group_key", F.col("ord").alias("paper_ord"), "canonical_id"),
                ["canonical_id"],
                "inner",
            ).select(
                "group_key",
                F.col("paper_ord").alias("ord"),
                F.explode(
                    F.concat(
                        rows("urls", F.array("landing_page_url"), 0),
                        rows("pdf_urls", F.array("pdf_url"), 0),
                    )
                ).alias("r"),
                "rec_ord",
            )
            .select(
                "group_key",
                "ord",
                F.struct(
                    F.col("r.field").alias("field"),
                    ((F.lit(1).cast("bigint") * (1 << 21)) + F.col("rec_ord")).alias("pos"),
                    F.col("r.value").alias("value"),
                ).alias("v"),
            )
        )
        own = own.unionByName(linked)
    firsts = own.groupBy("group_key", F.col("v.field").alias("field"), F.col("v.value").alias("value")).agg(
        F.min(F.struct("ord", F.col("v.pos").alias("pos"))).alias("at")
    )
    return firsts.select(
        "group_key", "field", "value", F.col("at.ord").alias("first_ord"), F.col("at.pos").alias("first_pos")
    )
