"""Explicit schemas of the tables that the jobs exchange."""

from __future__ import annotations

MEMBERS = (
    "member_ord BIGINT, name STRING, source_url STRING, profile_url STRING, role STRING, "
    "dblp_pid STRING, dblp_url STRING, aliases ARRAY<STRING>"
)

# One landed page (or a part of one) of a source. ``row_no`` orders payloads inside a page.
RAW_PAYLOADS = "source STRING, member_name STRING, page_no BIGINT, row_no BIGINT, payload STRING"

RECORD_FIELDS = [
    "source",
    "source_id",
    "member_name",
    "title",
    "year",
    "published_date",
    "venue",
    "doi",
    "authors",
    "abstract",
    "landing_page_url",
    "pdf_url",
    "relevance_score",
]

SOURCE_RECORDS = (
    "ord BIGINT, source STRING, source_id STRING, member_name STRING, title STRING, year INT, "
    "published_date STRING, venue STRING, doi STRING, authors ARRAY<STRING>, abstract STRING, "
    "landing_page_url STRING, pdf_url STRING, relevance_score DOUBLE"
)

# ``url`` is unique. ``document_text`` holds the text of a document that was decoded before landing.
FETCHED = (
    "url STRING, final_url STRING, status_code INT, content_type STRING, "
    "body STRING, error STRING, document_text STRING"
)

DOI_LOOKUP = "doi STRING, provider STRING, payload STRING"

PAPER_INDEX = (
    "canonical_id STRING, hash STRING, doi STRING, title STRING, year INT, published_date STRING, "
    "venue STRING, sources ARRAY<STRING>, members ARRAY<STRING>, "
    "award_mentioned_in_metadata BOOLEAN, award_mentioned_in_document BOOLEAN, "
    "award_mentions ARRAY<STRING>, document_award_mentions ARRAY<STRING>, "
    "document_verification_kind STRING, document_verification_url STRING, "
    "document_scan_error STRING, first_seen_at STRING, last_seen_at STRING, last_output_dir STRING"
)

MANIFEST = (
    "ord BIGINT, title STRING, authors ARRAY<STRING>, member_authors ARRAY<STRING>, url STRING, doi STRING"
)

# The order in which sources are merged.
SOURCE_ORDER = [
    "dblp",
    "openalex",
    "semantic_scholar",
    "crossref",
    "datacite",
    "europe_pmc",
    "pubmed",
    "openaire",
    "doaj",
    "arxiv",
    "inspirehep",
    "google_scholar",
]
