"""Identifiers: DOI, arXiv, PMC, stable fallback ids, canonical ids, file stems."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeloom.functions.arrays import first_of
from citeloom.functions.bind import bind, null_if
from citeloom.functions.text import title_key, ws, ws_or_null

# Identifier patterns.
ARXIV_LOOSE = r"(?i)([0-9]{4}\.[0-9]{4,5})(?:v\d+)?"
ARXIV_ANCHOR = r"(?i)abs[-_/]([0-9]{4})[-_/]([0-9]{4,5})(?:v\d+)?"
ARXIV_URL = r"(?i)arxiv\.org/(?:abs|pdf)/([0-9]{4}\.[0-9]{4,5}(?:v\d+)?)"
ARXIV_ABS_URL = r"(?i)arxiv\.org/abs/([0-9]{4}\.[0-9]{4,5}(?:v\d+)?)"
ARXIV_PDF_URL = r"(?i)arxiv\.org/pdf/([0-9]{4}\.[0-9]{4,5}(?:v\d+)?)\.pdf"
ARXIV_DOI = r"(?i)10\.48550/arXiv\.([0-9]{4}\.[0-9]{4,5}(?:v\d+)?)"
DOI_IN_TEXT = r"(?i)10\.\d{4,9}/[-._;()/:A-Z0-9]+"
PMCID = r"(?iU)\bPMC\d+\b"
ARXIV_PDF_TEMPLATE = "https://arxiv.org/pdf/{}.pdf"


def _match(c: Column, pattern: str, group: int = 1) -> Column:
    return null_if(F.regexp_extract(c, pattern, group), "")


def normalize_doi(c: Column) -> Column:
    """Resolver prefix and surrounding full stops removed; blank to NULL. Case is kept."""
    text = F.regexp_replace(ws(c), r"(?i)^.*?doi\.org/", "")
    return null_if(F.btrim(F.trim(text), F.lit(".")), "")


def doi_from_text(c: Column) -> Column:
    """First DOI-shaped token in a text."""
    return _match(c, DOI_IN_TEXT, 0)


def doi_from_resolver(c: Column) -> Column:
    """DOI of a resolver URL or a bare DOI; anything else is NULL."""
    return bind(
        F.trim(c),
        lambda raw: F.when(
            F.lower(raw).contains("doi.org/"), F.get(F.split(raw, r"(?i)doi\.org/"), F.lit(1))
        ).when(raw.startswith("10."), raw),
    )


def doi_from_links(urls: Column) -> Column:
    """First link that is a resolver URL (rest after the host) or a bare DOI."""
    found = F.transform(
        F.transform(urls, lambda u: F.trim(u)),
        lambda u: F.when(u.contains("doi.org/"), F.regexp_extract(u, r"^.*?doi\.org/(.*)$", 1)).when(
            u.startswith("10."), u
        ),
    )
    return first_of(F.filter(found, lambda d: d.isNotNull()))


def first_doi(values: Column) -> Column:
    """First value that is a DOI, or contains one."""
    found = F.transform(
        values,
        lambda v: bind(
            normalize_doi(v),
            lambda d: F.when(d.startswith("10."), d).otherwise(normalize_doi(doi_from_text(v))),
        ),
    )
    return first_of(F.filter(found, lambda d: d.isNotNull()))


def arxiv_loose(c: Column) -> Column:
    """arXiv number anywhere in a text, version dropped; also the ``abs-dddd-ddddd`` anchor form."""
    def find(text: Column) -> Column:
        anchor = F.when(
            F.regexp_like(text, F.lit(ARXIV_ANCHOR)),
            F.concat(F.regexp_extract(text, ARXIV_ANCHOR, 1), F.lit("."), F.regexp_extract(text, ARXIV_ANCHOR, 2)),
        )
        return F.coalesce(_match(text, ARXIV_LOOSE), anchor)

    return bind(c, find)


def arxiv_from_url(c: Column) -> Column:
    """arXiv number of an abs/pdf URL, version kept."""
    return _match(c, ARXIV_URL)


def arxiv_strict(c: Column) -> Column:
    """arXiv number of an abs URL, a ``.pdf`` URL or an arXiv DOI, version kept."""
    return F.coalesce(_match(c, ARXIV_ABS_URL), _match(c, ARXIV_PDF_URL), _match(c, ARXIV_DOI))


def arxiv_pdf(arxiv_id: Column) -> Column:
    return F.concat(F.lit("https://arxiv.org/pdf/"), arxiv_id, F.lit(".pdf"))


def normalize_pmcid(c: Column) -> Column:
    def shape(text: Column) -> Column:
        digits = F.regexp_replace(text, r"\D+", "")
        return (
            F.when(F.upper(text).startswith("PMC"), F.concat(F.lit("PMC"), F.substring(text, 4, 1 << 30)))
            .when(digits != "", F.concat(F.lit("PMC"), digits))
            .otherwise(text)
        )

    return bind(ws_or_null(c), shape)


def pmcids(values: Column) -> Column:
    """Distinct upper-cased PMC ids of a list of texts, in order of appearance."""
    hits = F.flatten(F.transform(values, lambda v: F.regexp_extract_all(v, F.lit(PMCID), F.lit(0))))
    return F.array_distinct(F.transform(hits, lambda h: F.upper(h)))


def stable_id(prefix: str, title: Column, year: Column) -> Column:
    """SHA-1 over prefix, year and lower-cased title, in hex digits."""
    year_part = F.coalesce(null_if(year, 0).cast("string"), F.lit("na"))
    seed = F.concat(F.lit(f"{prefix}|"), year_part, F.lit("|"), F.lower(title))
    return F.concat(F.lit(f"{prefix}:"), F.sha1(seed.cast("binary")))


def slug(c: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), F.lit("-"))


def _head(title: Column) -> Column:
    """The readable part of an id, which a digest follows."""
    return F.substring(slug(title), 1, 40)


def author_title_id(title: Column, authors: Column, year: Column) -> Column:
    """Fallback id: year, the head of the title slug, and a digest of title and all authors."""
    seed = F.concat_ws("|", F.lower(title), F.lower(F.array_join(authors, "_")))
    year_part = F.coalesce(null_if(year, 0).cast("string"), F.lit("na"))
    return F.concat(F.lit("fallback:"), year_part, F.lit(":"), _head(title), F.lit(":"), F.sha1(seed.cast("binary")))


def dblp_id(doi: Column, key: Column, title: Column, authors: Column, year: Column) -> Column:
    return F.coalesce(
        F.concat(F.lit("doi:"), F.lower(null_if(doi, ""))),
        null_if(key, ""),
        author_title_id(title, authors, year),
    )


def openalex_short_id(c: Column) -> Column:
    return F.coalesce(
        F.substring_index(F.rtrim(null_if(c, ""), F.lit("/")), "/", -1),
        F.lit("unknown"),
    )


def openalex_id(doi: Column, work_id: Column, title: Column) -> Column:
    return F.coalesce(
        F.concat(F.lit("doi:"), F.lower(null_if(doi, ""))),
        F.when(work_id != "", F.concat(F.lit("openalex:"), openalex_short_id(work_id))),
        F.concat(F.lit("openalex:"), _head(title), F.lit(":"), F.sha1(F.lower(title).cast("binary"))),
    )


def pid_from_profile(url: Column) -> Column:
    """The part of a profile URL after ``/pid/``."""
    return null_if(F.btrim(F.regexp_extract(url, r"^.*?/pid/(.*)$", 1), F.lit("/")), "")


def file_stem(c: Column) -> Column:
    """A safe file name stem; ``paper`` if nothing is left."""
    stem = F.btrim(F.regexp_replace(c, "[^A-Za-z0-9._-]+", "_"), F.lit("_"))
    return F.coalesce(null_if(stem, ""), F.lit("paper"))


def canonical_id(
    doi: Column, source_id: Column, landing_url: Column, pdf_url: Column, title: Column, year: Column
) -> Column:
    """DOI key, else arXiv key, else year and title key."""
    doi_key = F.concat(F.lit("doi:"), F.lower(null_if(doi, "")))
    haystack = F.concat_ws(" ", source_id, landing_url, pdf_url)
    arxiv_key = F.concat(F.lit("arxiv:"), arxiv_loose(haystack))
    fallback = F.concat(
        F.lit("title:"), F.coalesce(year.cast("string"), F.lit("na")), F.lit(":"), title_key(title)
    )
    return F.coalesce(doi_key, arxiv_key, fallback)


def doi_tokens(c: Column) -> Column:
    """DOI-like tokens of a free text: split on white space and commas, punctuation stripped, cut at ``10.``."""
    parts = F.split(F.coalesce(c, F.lit("")), r"(?U)[\s\x1c-\x1f,]+")
    bare = F.transform(parts, lambda p: F.btrim(p, F.lit("()[]{}<>.,;")))
    return F.transform(F.filter(bare, lambda p: p.contains("10.")), lambda p: F.substr(p, F.locate("10.", p)))
