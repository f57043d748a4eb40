"""Document candidates of papers, as rows with an explicit order instead of nested lists.

Every function takes the child tables of ``merge`` and returns ``(canonical_id, ..., at)``, where
``at`` orders the candidates of a paper. Distinctness is a partially aggregated ``min(at)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions import ids, urls
from citeloom.functions.arrays import distinct_trimmed, distinct_ws, non_null
from citeloom.functions.text import strip_or_null, ws, ws_or_null
from citeloom.operators.joins import lookup_join

OPENALEX_WORK = (
    "open_access STRUCT<oa_status STRING, oa_url STRING>, "
    "best_oa_location STRUCT<pdf_url STRING, landing_page_url STRING>, "
    "primary_location STRUCT<pdf_url STRING, landing_page_url STRING>, "
    "locations ARRAY<STRUCT<pdf_url STRING, landing_page_url STRING>>, "
    "abstract_inverted_index MAP<STRING, ARRAY<INT>>"
)
CROSSREF_MESSAGE = (
    "abstract STRING, `container-title` ARRAY<STRING>, link ARRAY<STRUCT<URL STRING, `content-type` STRING>>, "
    "`published-print` STRUCT<`date-parts` ARRAY<ARRAY<INT>>>, "
    "`published-online` STRUCT<`date-parts` ARRAY<ARRAY<INT>>>, "
    "published STRUCT<`date-parts` ARRAY<ARRAY<INT>>>, "
    "issued STRUCT<`date-parts` ARRAY<ARRAY<INT>>>"
)
DATACITE_DOI = "attributes STRUCT<descriptions ARRAY<STRUCT<description STRING, descriptionType STRING>>>"


def _at(stage: int, a: Column, b: Column, c: Column | int = 0) -> Column:
    third = c if isinstance(c, Column) else F.lit(c)
    return F.struct(
        F.lit(stage).cast("bigint").alias("stage"),
        a.cast("bigint").alias("a"),
        b.cast("bigint").alias("b"),
        third.cast("bigint").alias("c"),
    )


def hint_rows(papers: DataFrame, values: DataFrame, records: DataFrame) -> DataFrame:
    """Texts that may hold a document address: DOI, URLs, then the links and id of every record."""
    zero = F.lit(0)
    doi = papers.select("canonical_id", F.nullif("doi", F.lit("")).alias("hint"), _at(1, zero, zero).alias("at"))
    listed = values.filter(F.col("field") == "urls").select(
        "canonical_id", F.col("value").alias("hint"), _at(2, F.col("first_ord"), F.col("first_pos")).alias("at")
    )
    linked = records.select(
        "canonical_id",
        "ord",
        F.posexplode(
            F.array(strip_or_null(F.col("pdf_url")), strip_or_null(F.col("landing_page_url")),
                    strip_or_null(F.col("source_id")))
        ).alias("pos", "hint"),
    ).select("canonical_id", "hint", _at(3, F.col("ord"), F.col("pos")).alias("at"))
    return doi.unionByName(listed).unionByName(linked).filter(F.col("hint").isNotNull())


def pdf_candidates(papers: DataFrame, values: DataFrame, records: DataFrame) -> DataFrame:
    """Document addresses per paper: listed ones, then ``.pdf`` hints and arXiv addresses made from hints."""
    listed = values.filter(F.col("field") == "pdf_urls").select(
        "canonical_id", F.col("value").alias("url"), _at(0, F.col("first_ord"), F.col("first_pos")).alias("at")
    )
    derived = hint_rows(papers, values, records).select(
        "canonical_id",
        "at",
        F.posexplode(
            F.array(
                F.when(urls.ends_with_pdf(F.col("hint")), ws("hint")),
                ids.arxiv_pdf(ids.arxiv_loose(F.col("hint"))),
            )
        ).alias("sub", "url"),
    )
    derived = derived.filter(F.col("url").isNotNull()).select(
        "canonical_id",
        "url",
        F.struct("at.stage", "at.a", "at.b", F.col("sub").cast("bigint").alias("c")).alias("at"),
    )
    return listed.unionByName(derived).groupBy("canonical_id", "url").agg(F.min("at").alias("at"))


def openalex_pdf_links(work: Column) -> Column:
    """Document links of a looked-up work: PDF-like locations and arXiv addresses."""
    locations = F.array(
        work["best_oa_location"]["pdf_url"],
        work["best_oa_location"]["landing_page_url"],
        work["primary_location"]["pdf_url"],
        work["primary_location"]["landing_page_url"],
    )
    both = F.flatten(
        F.transform(
            non_null(F.transform(locations, ws_or_null)),
            lambda v: F.array(F.when(urls.pdf_suffix_or_path(v), v), ids.arxiv_pdf(ids.arxiv_loose(v))),
        )
    )
    return distinct_ws(non_null(both))


def openalex_all_links(work: Column) -> Column:
    """Every location of a looked-up work, open-access address first."""
    places = F.concat(
        F.array(work["open_access"]["oa_url"]),
        F.array(work["best_oa_location"]["pdf_url"], work["best_oa_location"]["landing_page_url"]),
        F.array(work["primary_location"]["pdf_url"], work["primary_location"]["landing_page_url"]),
        F.coalesce(
            F.flatten(
                F.transform(work["locations"], lambda p: F.array(p["pdf_url"], p["landing_page_url"]))
            ),
            F.expr("cast(array() as array<string>)"),
        ),
    )
    return distinct_trimmed(non_null(places))


def crossref_pdf_links(message: Column) -> Column:
    """Links of a looked-up message that are typed as PDF or look like one."""
    hits = F.filter(
        message["link"],
        lambda r: F.lower(F.coalesce(r["content-type"], F.lit(""))).contains("pdf") | urls.looks_like_pdf(r["URL"]),
    )
    return distinct_trimmed(F.transform(hits, lambda r: r["URL"]))


def external_urls(work: Column, doi: Column) -> Column:
    """Resolver address of the DOI, then the preferred locations of a work; distinct, order kept."""
    return distinct_trimmed(
        non_null(
            F.array(
                urls.fill(urls.DOI_PAGE, doi),
                work["best_oa_location"]["pdf_url"],
                work["best_oa_location"]["landing_page_url"],
                work["primary_location"]["pdf_url"],
                work["primary_location"]["landing_page_url"],
            )
        )
    )


def publication_candidates(ee_urls: Column, doi: Column) -> Column:
    """Candidates of one publication row: ``.pdf`` links and arXiv addresses of links, then of the DOI."""
    per_link = F.flatten(
        F.transform(
            F.filter(F.transform(ee_urls, lambda u: F.trim(u)), lambda u: u != ""),
            lambda u: F.array(F.when(urls.ends_with_pdf(u), u), ids.arxiv_pdf(ids.arxiv_strict(u))),
        )
    )
    return F.array_distinct(non_null(F.concat(per_link, F.array(ids.arxiv_pdf(ids.arxiv_strict(doi))))))


def enrich_from_lookup(papers: DataFrame, candidates: DataFrame, doi_lookup: DataFrame) -> DataFrame:
    """Candidates looked up by DOI for papers that have none: ``(canonical_id, url, at)`` rows to add.

    Every DOI is looked up once. ``doi_lookup(doi, provider, payload)`` holds landed works by lower-case DOI.
    """
    with_any = candidates.select("canonical_id").distinct()
    open_papers = (
        papers.select("canonical_id", F.lower(ws("doi")).alias("doi"))
        .filter(F.col("doi") != "")
        .join(with_any, "canonical_id", "left_anti")
    )
    works = (
        doi_lookup.filter(F.col("provider") == "openalex")
        .withColumn("doi", F.lower("doi"))
        .join(open_papers.select("doi").distinct(), "doi", "left_semi")
        .select("doi", openalex_pdf_links(F.from_json("payload", OPENALEX_WORK)).alias("links"))
    )
    found = lookup_join(open_papers, works, ["doi"], "inner")
    return found.select("canonical_id", F.posexplode("links").alias("pos", "url")).select(
        "canonical_id", "url", _at(4, F.lit(0), F.col("pos")).alias("at")
    )


def enrichment_stats(
    papers: DataFrame, listed: DataFrame, derived: DataFrame, looked_up: DataFrame
) -> DataFrame:
    """One row: papers, papers with a candidate, papers that got their first one here, DOIs looked up.

    ``listed`` are the papers with an address before derivation, ``derived`` and ``looked_up`` candidates.
    """
    marks = (
        papers.select("canonical_id", F.lower(ws("doi")).alias("doi"))
        .join(listed.select("canonical_id").distinct().withColumn("had", F.lit(True)), "canonical_id", "left")
        .join(derived.select("canonical_id").distinct().withColumn("derived", F.lit(True)), "canonical_id", "left")
        .join(looked_up.select("canonical_id").distinct().withColumn("looked", F.lit(True)), "canonical_id", "left")
    )
    none = F.col("derived").isNull()
    has_doi = F.coalesce(F.col("doi") != "", F.lit(False))
    return marks.agg(
        F.count("*").alias("papers_total"),
        F.count_if(F.col("derived").isNotNull() | F.col("looked").isNotNull()).alias("papers_with_pdf_after_enrich"),
        F.count_if(F.col("had").isNull() & (F.col("derived").isNotNull() | F.col("looked").isNotNull())).alias(
            "filled_count"
        ),
        F.count_distinct(F.when(none & has_doi, F.col("doi"))).alias("doi_lookup_count"),
    )


def text_candidates(papers: DataFrame, values: DataFrame, pdf_urls: DataFrame, records: DataFrame) -> DataFrame:
    """Full-text addresses per paper: two services per PMC id, then landing pages; ``(canonical_id, kind, url, at)``."""
    zero = F.lit(0)
    sources = (
        values.filter(F.col("field") == "urls")
        .select("canonical_id", F.col("value").alias("text"), _at(0, F.col("first_ord"), F.col("first_pos")).alias("at"))
        .unionByName(
            pdf_urls.select(
                "canonical_id",
                F.col("url").alias("text"),
                # Listed before derived, derived in hint order.
                F.struct(
                    F.lit(1).cast("bigint").alias("stage"),
                    (F.col("at.stage") * F.lit(1 << 40) + F.col("at.a")).alias("a"),
                    F.col("at.b").alias("b"),
                    F.col("at.c").alias("c"),
                ).alias("at"),
            )
        )
        .unionByName(papers.select("canonical_id", F.col("doi").alias("text"), _at(2, zero, zero).alias("at")))
        .unionByName(
            records.select(
                "canonical_id", "ord", F.posexplode(F.array("source_id", "landing_page_url", "pdf_url")).alias("p", "text")
            ).select("canonical_id", "text", _at(3, F.col("ord"), F.col("p")).alias("at"))
        )
        .filter(F.col("text").isNotNull())
    )
    hits = sources.select(
        "canonical_id", "at", F.posexplode(ids.pmcids(F.array("text"))).alias("m", "pmcid")
    )
    firsts = hits.groupBy("canonical_id", "pmcid").agg(
        F.min(F.struct("at", "m")).alias("first")
    )
    services = firsts.select(
        "canonical_id",
        F.col("first").alias("f"),
        F.posexplode(
            F.array(
                F.struct(
                    F.lit("europe_pmc_fulltext_xml").alias("kind"),
                    urls.fill(urls.EUROPE_PMC_FULLTEXT, F.col("pmcid")).alias("url"),
                ),
                F.struct(
                    F.lit("pmc_efetch_xml").alias("kind"), urls.fill(urls.PMC_EFETCH, F.col("pmcid")).alias("url")
                ),
            )
        ).alias("s", "c"),
    ).select(
        "canonical_id",
        "c.kind",
        "c.url",
        F.struct(
            F.lit(0).cast("bigint").alias("g"),
            F.col("f.at").alias("at"),
            (F.col("f.m") * 2 + F.col("s")).cast("bigint").alias("n"),
        ).alias("at"),
    )
    landing = (
        values.filter(F.col("field") == "urls")
        .select("canonical_id", F.col("value").alias("url"), _at(0, F.col("first_ord"), F.col("first_pos")).alias("at"))
        .unionByName(
            records.select("canonical_id", ws("landing_page_url").alias("url"), _at(1, F.col("ord"), zero).alias("at"))
        )
        .filter(F.col("url") != "")
        .groupBy("canonical_id", "url")
        .agg(F.min("at").alias("at"))
        .select(
            "canonical_id",
            F.lit("landing_page_text").alias("kind"),
            "url",
            F.struct(F.lit(1).cast("bigint").alias("g"), "at", F.lit(0).cast("bigint").alias("n")).alias("at"),
        )
    )
    return services.unionByName(landing)


def fulltext_xml_links(body: Column, verification_url: Column) -> Column:
    """PDF links of a full-text XML body (``self-uri``), relative ones placed under the PMC id of its address."""
    pmcid = F.get(ids.pmcids(F.array(verification_url)), F.lit(0))
    has_uri = body.contains("self-uri")
    xml = F.when(has_uri, body)
    hrefs = F.regexp_extract_all(xml, F.lit(r"""(?s)<self-uri\b[^>]*?\b(?:xlink:)?href\s*=\s*["']([^"']*)["']"""), F.lit(1))
    kept = F.filter(F.transform(hrefs, lambda h: F.trim(h)), lambda h: F.lower(h).contains(".pdf"))
    absolute = F.transform(
        kept,
        lambda h: F.when(h.startswith("http://") | h.startswith("https://"), h).otherwise(
            urls.fill(urls.PMC_BIN, pmcid, F.ltrim(h, F.lit("/")))
        ),
    )
    own = F.array(urls.fill(urls.PMC_PDF, pmcid))
    return distinct_ws(non_null(F.concat(F.coalesce(absolute, F.expr("cast(array() as array<string>)")), own)))


def chosen_documents(outcomes: DataFrame, fulltext: DataFrame, pdfs: DataFrame, fetched: DataFrame) -> DataFrame:
    """Document of each paper that a full text verified: the first candidate with a valid landed response.

    Links named in the full text (``fulltext``) come before the paper's other candidates (``pdfs``). Gives
    ``(canonical_id, url)``; papers that have a document already, or no valid candidate, have no row.
    """
    from citeloom.operators.docscan import retrieval_error

    open_ids = outcomes.filter(
        (F.col("status") == "mention") & F.col("document_pdf_url").isNull()
    ).select("canonical_id")
    ranked = fulltext.select("canonical_id", "url", F.struct(F.lit(0).alias("step"), "at").alias("at")).unionByName(
        pdfs.select("canonical_id", "url", F.struct(F.lit(1).alias("step"), "at").alias("at"))
    )
    wanted = ranked.join(open_ids, "canonical_id", "left_semi")
    valid = fetched.filter(retrieval_error().isNull()).select("url").distinct()
    return wanted.join(valid, "url", "left_semi").groupBy("canonical_id").agg(F.min_by("url", "at").alias("url"))


def fulltext_candidates(outcomes: DataFrame, fetched: DataFrame) -> DataFrame:
    """PDF addresses named in the full-text XML that verified a paper: ``(canonical_id, url, at)`` rows to add.

    Only bodies of verifying addresses are read, once each.
    """
    verified = outcomes.filter(
        F.col("document_verification_kind").isin("europe_pmc_fulltext_xml", "pmc_efetch_xml")
    ).select("canonical_id", F.col("document_verification_url").alias("page"))
    bodies = fetched.withColumn("page", F.coalesce(F.nullif("final_url", F.lit("")), "url")).join(
        verified.select("page").distinct(), "page", "left_semi"
    )
    links = bodies.groupBy("page").agg(F.min_by("body", "url").alias("body")).select(
        "page", F.posexplode(fulltext_xml_links(F.col("body"), F.col("page"))).alias("pos", "url")
    )
    return lookup_join(verified, links, ["page"], "inner").select(
        "canonical_id", "url", _at(5, F.lit(0), F.col("pos")).alias("at")
    )


def local_file_candidates(papers: DataFrame, values: DataFrame, records: DataFrame) -> DataFrame:
    """Candidates when a paper's document is fetched again: all known addresses that look like a PDF."""
    zero = F.lit(0)
    listed = (
        papers.select("canonical_id", F.trim("document_pdf_url").alias("url"), _at(0, zero, zero).alias("at"))
        .unionByName(
            values.filter(F.col("field").isin("pdf_urls", "urls")).select(
                "canonical_id",
                F.col("value").alias("url"),
                F.struct(
                    F.when(F.col("field") == "pdf_urls", 1).otherwise(2).cast("bigint").alias("stage"),
                    F.col("first_ord").alias("a"),
                    F.col("first_pos").alias("b"),
                    F.lit(0).cast("bigint").alias("c"),
                ).alias("at"),
            )
        )
        .unionByName(
            records.select(
                "canonical_id", "ord", F.posexplode(F.array("pdf_url", "landing_page_url")).alias("p", "u")
            ).select("canonical_id", F.trim("u").alias("url"), _at(3, F.col("ord"), F.col("p")).alias("at"))
        )
        .unionByName(
            papers.select(
                "canonical_id", ids.arxiv_pdf(ids.arxiv_loose(F.col("doi"))).alias("url"), _at(4, zero, zero).alias("at")
            )
        )
    )
    return (
        listed.filter((F.col("url") != "") & urls.pdf_suffix_or_path(F.col("url")))
        .groupBy("canonical_id", "url")
        .agg(F.min("at").alias("at"))
    )
