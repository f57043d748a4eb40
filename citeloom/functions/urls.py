"""URL predicates and link pickers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeloom.functions.arrays import first_of
from citeloom.functions.bind import null_if
from citeloom.functions.ids import arxiv_from_url, arxiv_pdf

# Markers of supplementary files, preprint DOI prefixes and source page templates.
SUPPLEMENT_MARKERS = [
    "mediaobjects",
    "_mosem",
    "_esm",
    "supplement",
    "supplementary",
    "supporting-information",
]
PREPRINT_DOI_PREFIXES = ["10.48550/arxiv.", "10.1101/"]
EUROPE_PMC_FULLTEXT = "https://www.ebi.ac.uk/europepmc/webservices/rest/{}/fullTextXML"
PMC_EFETCH = "https://eutils.ncbi.nlm.nih.gov/entrez/eutils/efetch.fcgi?db=pmc&id={}&retmode=xml"
PMC_PDF = "https://pmc.ncbi.nlm.nih.gov/articles/{}/pdf/"
PMC_PAGE = "https://pmc.ncbi.nlm.nih.gov/articles/{}/"
PMC_BIN = "https://pmc.ncbi.nlm.nih.gov/articles/{}/bin/{}"
PUBMED_PAGE = "https://pubmed.ncbi.nlm.nih.gov/{}/"
DOI_PAGE = "https://doi.org/{}"


def fill(template: str, *values: Column) -> Column:
    """A template with ``{}`` places filled by columns; NULL if any of them is NULL."""
    parts = template.split("{}")
    pieces: list[Column] = [F.lit(parts[0])]
    for value, tail in zip(values, parts[1:]):
        pieces += [value, F.lit(tail)]
    return F.concat(*pieces)


def ends_with_pdf(c: Column) -> Column:
    return F.lower(c).endswith(".pdf")


def pdf_suffix_or_path(c: Column) -> Column:
    """``.pdf`` at the end or ``/pdf`` anywhere."""
    return ends_with_pdf(c) | F.lower(c).contains("/pdf")


def looks_like_pdf(c: Column) -> Column:
    """``.pdf`` anywhere, or a path that ends in ``/pdf`` or has a ``/pdf/`` part (query and anchor left out)."""
    lowered = F.lower(c)
    path = F.regexp_replace(lowered, r"^([a-z][a-z0-9+.-]*:)?(//[^/?#]*)?|[?#].*$", "")
    return lowered.contains(".pdf") | F.rtrim(path, F.lit("/")).endswith("/pdf") | path.contains("/pdf/")


def is_supplement(c: Column) -> Column:
    lowered = F.lower(c)
    verdict = F.lit(False)
    for marker in SUPPLEMENT_MARKERS:
        verdict = verdict | lowered.contains(marker)
    return verdict


def is_preprint_doi(c: Column) -> Column:
    lowered = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return lowered.startswith(PREPRINT_DOI_PREFIXES[0]) | lowered.startswith(PREPRINT_DOI_PREFIXES[1])


def skip_candidate(url: Column, doi: Column) -> Column:
    """Supplementary files, arXiv copies of papers that are not preprints, and the text of a missing link."""
    return skip_by_rule(url, is_preprint_doi(doi))


def skip_by_rule(url: Column, preprint: Column) -> Column:
    """The same rule where it is known whether the paper is a preprint."""
    lowered = F.lower(url)
    return is_supplement(url) | (~preprint & lowered.contains("arxiv.org/pdf/")) | (F.trim(lowered) == "none")


def pick_pdf(urls: Column) -> Column:
    """First link that is a ``.pdf`` file, or an arXiv page turned into its PDF address."""
    picked = F.transform(
        urls,
        lambda u: F.when(ends_with_pdf(F.trim(u)), F.trim(u)).otherwise(arxiv_pdf(arxiv_from_url(u))),
    )
    return first_of(F.filter(picked, lambda u: u.isNotNull()))


def first_pdf_suffix_or_path(urls: Column) -> Column:
    return first_of(F.filter(urls, lambda u: u.isNotNull() & pdf_suffix_or_path(u)))


def host(c: Column) -> Column:
    """Lower-case host name without port and user; NULL if there is none."""
    return null_if(F.lower(F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), "")


def arxiv_api_url(c: Column, default: str) -> Column:
    """Query address of the arXiv service: scheme added, the export host kept on plain http, default path filled in."""
    raw = F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(default))
    raw = F.when(raw.contains("://"), raw).otherwise(F.concat(F.lit("http://"), F.ltrim(raw, F.lit("/"))))
    pattern = r"^([^:/?#]*)://([^/?#]*)([^?#]*)(.*)$"
    scheme = F.lower(F.regexp_extract(raw, pattern, 1))
    netloc = F.regexp_extract(raw, pattern, 2)
    path = F.coalesce(F.nullif(F.regexp_extract(raw, pattern, 3), F.lit("")), F.lit("/api/query"))
    rest = F.regexp_extract(raw, pattern, 4)
    new_scheme = (
        F.when((host(raw) == "export.arxiv.org") & scheme.isin("", "https"), F.lit("http"))
        .when(scheme == "", F.lit("https"))
        .otherwise(scheme)
    )
    return F.concat(new_scheme, F.lit("://"), netloc, path, rest)
