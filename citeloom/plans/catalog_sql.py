"""The same queries as plain SQL for a second engine, which reads the same tables."""

from __future__ import annotations

from citeloom.schemas import SOURCE_ORDER

SQL: dict[str, str] = {}

# White space as in the column functions; the second engine's \s is ASCII only.
_SPACE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def ws(e: str) -> str:
    return f"trim(regexp_replace({e}, '{_SPACE}+', ' ', 'g'))"


def key(e: str) -> str:
    return f"regexp_replace(lower({e}), '[^a-z0-9]+', '', 'g')"


_ORDER = "[" + ", ".join(f"'{s}'" for s in SOURCE_ORDER) + "]"
_AUTHORS = (
    "list_filter([w[1] || ' ' || w[2], w[3] || ' ' || w[4], w[5] || ' ' || w[6]], lambda x : x IS NOT NULL)"
)
_YEAR = "CASE WHEN n_chars % 7 = 0 THEN NULL ELSE 2000 + n_chars % 25 END"

DOCS = (
    "docs AS (SELECT doc_id, lang, source AS origin, n_chars, text, split_part(text, chr(10), 1) AS line1, "
    "regexp_extract_all(split_part(text, chr(10), 1), '[A-Za-z]+') AS w, "
    "CASE WHEN strpos(text, chr(10)) > 0 THEN nullif(substr(text, strpos(text, chr(10)) + 1), '') END AS rest "
    "FROM documents)"
)
RECORDS = DOCS + (
    f", records AS (SELECT doc_id AS ord, ({_ORDER})[(CAST(substr(origin, 4) AS INT) % 12) + 1] AS source, "
    f"'rec-' || doc_id AS source_id, 'Team ' || lang AS member_name, {ws('line1')} AS title, {_YEAR} AS year, "
    f"CAST({_YEAR} AS VARCHAR) || '-' || lpad(CAST(1 + n_chars % 12 AS VARCHAR), 2, '0') || '-01' AS published_date, "
    "CASE WHEN n_chars % 4 <> 0 THEN 'Venue ' || lang END AS venue, "
    "CASE WHEN n_chars % 3 = 0 THEN '10.5555/' || CASE WHEN doc_id % 2 = 0 THEN upper(substr(md5(line1), 1, 10)) "
    f"ELSE substr(md5(line1), 1, 10) END END AS doi, {_AUTHORS} AS authors, rest AS abstract, "
    "CASE WHEN n_chars % 8 = 0 THEN 'https://pmc.ncbi.nlm.nih.gov/articles/PMC' || (length(line1) * 1000 + n_chars % 1000) || '/' "
    "ELSE 'https://example.org/' || origin || '/' || substr(md5(line1), 1, 6) END AS landing_page_url, "
    "CASE WHEN n_chars % 5 = 0 THEN 'https://arxiv.org/pdf/' || lpad(CAST(length(line1) % 10000 AS VARCHAR), 4, '0') || '.' "
    "|| lpad(CAST(n_chars % 100000 AS VARCHAR), 5, '0') END AS pdf_url, "
    "round(n_chars % 100 / 100.0, 2)::DOUBLE AS relevance_score FROM docs)"
    ", keyed AS (SELECT *, CASE WHEN doi IS NOT NULL THEN 'doi:' || lower(doi) "
    "WHEN pdf_url IS NOT NULL THEN 'arxiv:' || regexp_extract(pdf_url, '([0-9]{4}\\.[0-9]{4,5})', 1) "
    f"ELSE 'title:' || coalesce(CAST(year AS VARCHAR), 'na') || ':' || {key('title')} END AS canonical_id "
    "FROM records WHERE title <> '')"
)
PAPERS = RECORDS + (
    ", papers AS (SELECT canonical_id, first(title ORDER BY length(title) DESC, ord) AS title, min(year) AS year, "
    "min(published_date) AS published_date, first(venue ORDER BY ord) FILTER (WHERE venue <> '') AS venue, "
    "first(doi ORDER BY ord) FILTER (WHERE doi <> '') AS doi, "
    "first(abstract ORDER BY length(abstract) DESC, ord) FILTER (WHERE abstract <> '') AS abstract, "
    "count(*) AS record_count, min(ord) AS first_ord FROM keyed GROUP BY canonical_id)"
)

SQL["canonical_merge"] = (
    f"WITH {PAPERS} SELECT canonical_id, title, {key('title')} AS normalized_title, year, published_date, venue, doi, "
    "md5(abstract) AS abstract_md5, record_count, first_ord FROM papers"
)

VALUES = RECORDS + (
    f", vals AS (SELECT canonical_id, field, value, min(ord * 1000 + pos) AS at FROM ("
    "SELECT canonical_id, ord, 'authors' AS field, unnest(authors) AS value, generate_subscripts(authors, 1) - 1 AS pos FROM keyed "
    "UNION ALL SELECT canonical_id, ord, 'members', member_name, 0 FROM keyed "
    "UNION ALL SELECT canonical_id, ord, 'urls', landing_page_url, 0 FROM keyed "
    "UNION ALL SELECT canonical_id, ord, 'pdf_urls', pdf_url, 0 FROM keyed WHERE pdf_url IS NOT NULL "
    "UNION ALL SELECT canonical_id, ord, 'sources', source, 0 FROM keyed) GROUP BY ALL)"
)
# Only author lists have several values per record, and distinct ones move up by the repeats before them.
SQL["canonical_values"] = (
    f"WITH {RECORDS}, d AS (SELECT canonical_id, ord, list_filter(list_transform(authors, lambda a, i : "
    "CASE WHEN list_position(authors, a) = i THEN a END), lambda x : x IS NOT NULL) AS authors, member_name, "
    "landing_page_url, pdf_url, source FROM keyed), rows_ AS ("
    "SELECT canonical_id, ord, 'authors' AS field, unnest(authors) AS value, generate_subscripts(authors, 1) - 1 AS pos FROM d "
    "UNION ALL SELECT canonical_id, ord, 'members', member_name, 0 FROM d "
    "UNION ALL SELECT canonical_id, ord, 'urls', landing_page_url, 0 FROM d "
    "UNION ALL SELECT canonical_id, ord, 'pdf_urls', pdf_url, 0 FROM d WHERE pdf_url IS NOT NULL "
    "UNION ALL SELECT canonical_id, ord, 'sources', source, 0 FROM d) "
    "SELECT canonical_id, field, value, min(ord) AS first_ord, CAST(first(pos ORDER BY ord, pos) AS BIGINT) AS first_pos "
    "FROM rows_ GROUP BY canonical_id, field, value"
)
SQL["canonical_source_records"] = (
    f"WITH {RECORDS} SELECT canonical_id, ord, source, source_id, member_name, relevance_score, landing_page_url, "
    "pdf_url, row_number() OVER (PARTITION BY canonical_id ORDER BY ord) AS record_rank FROM keyed"
)
SQL["running_best_title"] = (
    f"WITH {RECORDS}, r AS (SELECT canonical_id, ord, max(length(title) * 1000000000 - ord) OVER "
    "(PARTITION BY canonical_id ORDER BY ord) AS best FROM keyed) "
    "SELECT r.canonical_id, r.ord, k.title AS best_title FROM r JOIN keyed k ON r.canonical_id = k.canonical_id "
    "AND length(k.title) * 1000000000 - k.ord = r.best"
)
_DISPLAY = ws("regexp_replace(replace(title, '&amp;', '&'), '<[^>]+>', '', 'g')")
SQL["title_groups"] = (
    f"WITH {PAPERS}, g AS (SELECT *, {_DISPLAY} AS shown FROM papers) "
    f"SELECT {key('shown')} AS group_key, count(*) AS paper_count, first(canonical_id ORDER BY first_ord) AS first_canonical_id, "
    f"first(shown ORDER BY first_ord) AS first_title, min(first_ord) AS first_ord FROM g WHERE {key('shown')} <> '' GROUP BY 1"
)
_SHOWN_ABSTRACT = ws("regexp_replace(replace(replace(abstract, '&amp;', '&'), '&quot;', '\"'), '<[^>]+>', '', 'g')")
SQL["title_group_values"] = (
    f"WITH {PAPERS}, g AS (SELECT *, {key(_DISPLAY)} AS group_key, {_DISPLAY} AS shown FROM papers), rows_ AS ("
    "SELECT group_key, first_ord AS o, 'canonical_ids' AS field, canonical_id AS value FROM g "
    "UNION ALL SELECT group_key, first_ord, 'titles', shown FROM g "
    "UNION ALL SELECT group_key, first_ord, 'dois', doi FROM g WHERE doi IS NOT NULL "
    f"UNION ALL SELECT group_key, first_ord, 'abstracts', {_SHOWN_ABSTRACT} FROM g WHERE {_SHOWN_ABSTRACT} <> '' "
    "UNION ALL SELECT group_key, g.first_ord, 'urls', k.landing_page_url FROM g JOIN keyed k USING (canonical_id) "
    "UNION ALL SELECT group_key, g.first_ord, 'pdf_urls', k.pdf_url FROM g JOIN keyed k USING (canonical_id) WHERE k.pdf_url IS NOT NULL) "
    "SELECT group_key, field, md5(value) AS value_md5, min(o) AS first_ord FROM rows_ WHERE group_key <> '' GROUP BY 1, 2, 3"
)

# --- scan -----------------------------------------------------------------------------------------------------

_LICENCE_RE = ["Apache\\s+License", "MIT\\s+License", "GNU\\s+General\\s+Public\\s+License", "CC\\s+BY[-\\s]?NC\\s+4\\.0"]


def hits(text: str, patterns: list[str]) -> str:
    """All matches in rule order as one list."""
    parts = [
        f"list_transform(regexp_extract_all({text}, '(?i){p}'), lambda m : {ws('m')})" for p in patterns
    ]
    out = parts[0]
    for p in parts[1:]:
        out = f"list_concat({out}, {p})"
    return out


def distinct(lst: str) -> str:
    """First occurrences of a list, order kept."""
    return (
        f"list_filter(list_transform({lst}, lambda v, i : CASE WHEN list_position({lst}, v) = i THEN v END), "
        "lambda x : x IS NOT NULL)"
    )


SQL["phrase_mentions"] = (
    f"WITH h AS (SELECT doc_id, {hits('text', _LICENCE_RE)} AS m FROM documents) "
    "SELECT doc_id, CAST(generate_subscripts(m, 1) - 1 AS BIGINT) AS pos, 'phrase' AS rule, unnest(m) AS mention FROM h"
)


def context(window: int = 120) -> str:
    """Text around the first mention that occurs literally, from columns text and mentions (a list)."""
    found = "list_filter(mentions, lambda m : strpos(lower(text), lower(m)) > 0)[1]"
    return (
        f"CASE WHEN {found} IS NOT NULL THEN "
        + ws(
            f"substr(text, greatest(strpos(lower(text), lower({found})) - {window}, 1), "
            f"strpos(lower(text), lower({found})) + length({found}) + {window} "
            f"- greatest(strpos(lower(text), lower({found})) - {window}, 1))"
        )
        + " END"
    )


SQL["phrase_context"] = (
    f"WITH h AS (SELECT doc_id, text, {hits('text', _LICENCE_RE)} AS m FROM documents), "
    f"d AS (SELECT doc_id, text, {distinct('m')} AS mentions FROM h WHERE len(m) > 0) "
    f"SELECT doc_id, array_to_string(mentions, ' | ') AS mentions, {context()} AS context FROM d"
)

_NUMBER_RE = ["555[-\\s]?2373", "call\\s+555", "\\b555\\b", "5[\\s\\-_./,:;]*5[\\s\\-_./,:;]*5"]
_COLLAPSED = "regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', '', 'g')"
_NUMBER_HITS = (
    f"list_concat(list_concat({hits('text', _NUMBER_RE)}, CASE WHEN contains({_COLLAPSED}, 'call555') THEN ['call555'] ELSE [] END), "
    f"CASE WHEN contains({_COLLAPSED}, '555') THEN ['555'] ELSE [] END)"
)
_SEP = "(?i)5[\\s\\-_./,:;]*5[\\s\\-_./,:;]*5"
_SEP_HIT = f"regexp_extract(text, '{_SEP}')"
SQL["number_scan_separated"] = (
    f"WITH h AS (SELECT doc_id, text, {_NUMBER_HITS} AS m FROM documents), "
    f"d AS (SELECT doc_id, text, {distinct('m')} AS mentions FROM h WHERE len(m) > 0) "
    f"SELECT doc_id, array_to_string(mentions, ' | ') AS mentions, coalesce({context()}, CASE WHEN {_SEP_HIT} <> '' THEN "
    + ws(
        f"substr(text, greatest(strpos(text, {_SEP_HIT}) - 120, 1), strpos(text, {_SEP_HIT}) + length({_SEP_HIT}) + 120 "
        f"- greatest(strpos(text, {_SEP_HIT}) - 120, 1))"
    )
    + " END) AS context FROM d"
)
SQL["mention_rule_report"] = (
    "WITH h AS (SELECT doc_id, "
    f"len(regexp_extract_all(text, '(?i){_NUMBER_RE[0]}')) + len(regexp_extract_all(text, '(?i){_NUMBER_RE[1]}')) AS phrase, "
    f"len(regexp_extract_all(text, '(?i){_NUMBER_RE[2]}')) AS exact_, len(regexp_extract_all(text, '(?i){_NUMBER_RE[3]}')) AS sep, "
    f"contains({_COLLAPSED}, 'call555')::INT + contains({_COLLAPSED}, '555')::INT AS col FROM documents), "
    "t AS (SELECT * FROM h WHERE phrase + exact_ + sep + col > 0) "
    "SELECT count(*) AS texts, CAST(sum(phrase) AS BIGINT) AS phrase_hits, CAST(sum(exact_) AS BIGINT) AS exact_number_hits, "
    "CAST(sum(sep) AS BIGINT) AS separated_number_hits, CAST(sum(col) AS BIGINT) AS collapsed_number_hits, "
    "count(*) FILTER (WHERE phrase > 0 OR exact_ > 0) AS strict_texts, "
    "count(*) FILTER (WHERE phrase = 0 AND exact_ = 0) AS loose_only_texts FROM t"
)


# Mentions of metadata: every record is scanned with the best title and abstract known at its place.
def _running(col: str) -> str:
    return (
        f"arg_max({col}, length({col}) * 1000000000 - ord) FILTER (WHERE {col} <> '') "
        "OVER (PARTITION BY canonical_id ORDER BY ord)"
    )


SQL["metadata_mentions"] = (
    f"WITH {RECORDS}, r AS (SELECT canonical_id, ord, abstract, {_running('title')} AS bt, {_running('abstract')} AS ba, "
    "row_number() OVER (PARTITION BY canonical_id ORDER BY ord) AS rn FROM keyed), "
    "t AS (SELECT canonical_id, ord, CASE WHEN rn = 1 THEN concat_ws(' ', bt, nullif(abstract, '')) "
    "ELSE concat_ws(' ', bt, ba, nullif(abstract, '')) END AS text FROM r), "
    f"h AS (SELECT canonical_id, ord, {hits('text', _LICENCE_RE)} AS m FROM t), "
    f"d AS (SELECT canonical_id, ord, {distinct('m')} AS m FROM h WHERE len(m) > 0), "
    "e AS (SELECT canonical_id, ord, unnest(m) AS mention, generate_subscripts(m, 1) - 1 AS pos FROM d) "
    "SELECT canonical_id, mention, min(ord) AS first_ord, CAST(first(pos ORDER BY ord, pos) AS BIGINT) AS first_pos "
    "FROM e GROUP BY 1, 2"
)

# --- order ----------------------------------------------------------------------------------------------------

SQL["top_n_per_group"] = (
    "SELECT l_suppkey, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_extendedprice FROM lineitem QUALIFY row_number() OVER "
    "(PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) <= 3"
)
SQL["first_per_key"] = (
    "SELECT c_nationkey, c_mktsegment, c_custkey, c_name FROM customer QUALIFY row_number() OVER "
    "(PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) = 1"
)
SQL["last_per_key"] = (
    "SELECT c_nationkey, c_mktsegment, c_custkey, c_name FROM customer QUALIFY row_number() OVER "
    "(PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey DESC) = 1"
)
SQL["rank_in_group"] = (
    "SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS place FROM events"
)

# --- sources --------------------------------------------------------------------------------------------------

_MEMBER = "CASE WHEN n_chars % 2 = 0 THEN w[1] || ' ' || w[2] ELSE 'The And' END"
_DOI = "CASE WHEN n_chars % 3 = 0 THEN '10.5555/' || substr(md5(line1), 1, 10) END"
_STEP = "WHEN x.doi IS NOT NULL THEN x.doi "

# Member and author meet if surname and first initial agree, in either name order.
_MATCH = (
    "(len(authors) = 0 OR len(list_filter(authors, lambda a : "
    "(lower(split_part(a, ' ', 2)) = lower(split_part(member_name, ' ', 2)) AND lower(a[1]) = lower(member_name[1])) OR "
    "(lower(split_part(a, ' ', 1)) = lower(split_part(member_name, ' ', 2)) AND "
    "lower(split_part(a, ' ', 2)[1]) = lower(member_name[1])))) > 0)"
)
_GIVEN = (
    "(len(authors) = 0 OR len(list_filter(authors, lambda a : CASE "
    "WHEN lower(split_part(a, ' ', 2)) = lower(split_part(member_name, ' ', 2)) THEN {test1} "
    "WHEN lower(split_part(a, ' ', 1)) = lower(split_part(member_name, ' ', 2)) THEN {test2} ELSE false END)) > 0)"
)


def _given_test(author_part: int) -> str:
    a, m = f"lower(split_part(a, ' ', {author_part}))", "lower(split_part(member_name, ' ', 1))"
    return (
        f"({a} = {m} OR {a} = {m}[1] OR ({m} = {a}[1] AND length({m}) <= 3) OR (length({a}) = 1 AND {a} = {m}[1]) "
        f"OR (length({m}) = 1 AND {m} = {a}[1]))"
    )


_GIVEN = _GIVEN.format(test1=_given_test(1), test2=_given_test(2))


def stable(prefix: str) -> str:
    return (
        f"'{prefix}:' || sha1('{prefix}|' || coalesce(CAST(year AS VARCHAR), 'na') || '|' || lower(title))"
    )


def dedupe_authors(lst: str) -> str:
    """First spelling of every name, ignoring case."""
    lowered = f"list_transform({lst}, lambda q : lower(q))"
    return (
        f"list_filter(list_transform({lst}, lambda v, i : CASE WHEN list_position({lowered}, lower(v)) = i THEN v END), "
        "lambda x : x IS NOT NULL)"
    )


def source(
    name: str,
    score: float,
    year: str = _YEAR,
    title: str = ws("line1"),
    published: str = "NULL",
    venue: str = "'Venue ' || lang",
    authors: str = _AUTHORS,
    abstract: str = f"nullif({ws('rest')}, '')",
    doi: str = _DOI,
    source_id: str = "doi",
    landing: str = "'https://example.org/' || doc_id",
    pdf: str = "NULL",
    match: str | None = _MATCH,
    min_year: int | None = 2008,
    copies: int = 1,
) -> None:
    where = ["title <> ''", "member_name IS NOT NULL"]
    if min_year is not None:
        where.append(f"(year IS NULL OR year >= {min_year})")
    if match:
        where.append(match)
    dup = f" CROSS JOIN range({copies}) AS c(item)" if copies > 1 else " CROSS JOIN (SELECT 0 AS item) AS c"
    SQL[f"source_{name}"] = (
        f"WITH {DOCS}, a AS (SELECT doc_id, n_chars, lang, line1, w, rest, text, {_MEMBER} AS member_name, {year} AS year, {title} AS title, "
        f"{doi} AS doi, {authors} AS authors FROM docs), "
        f"f AS (SELECT * FROM a{dup} WHERE {' AND '.join(where)}) "
        f"SELECT member_name, doc_id AS row_no, {source_id} AS source_id, title, CAST(year AS BIGINT) AS year, "
        f"{published} AS published_date, {venue} AS venue, doi, array_to_string(authors, '; ') AS authors, "
        f"md5({abstract}) AS abstract_md5, {landing} AS landing_page_url, {pdf} AS pdf_url, "
        f"CAST({score} AS DOUBLE) AS relevance_score FROM f "
    )


_Y1 = "CAST(year AS VARCHAR) || '-01-01'"
_ARXIV_N = "lpad(CAST(n_chars % 100000 AS VARCHAR), 5, '0')"
# The DOI of this source keeps its trailing full stop.
source(
    "openalex", 0.95, min_year=None, match=None, title="trim(line1)", published=_Y1, abstract="NULL",
    doi=f"{_DOI} || '.'",
    source_id="coalesce('doi:' || lower(doi), 'openalex:W' || doc_id)",
    landing="'https://openalex.org/W' || doc_id",
    pdf="CASE WHEN n_chars % 5 = 0 THEN 'https://example.org/' || doc_id || '.pdf' END",
)
source(
    "semantic_scholar", 0.93, match=None, venue="NULL", published="CAST(year AS VARCHAR) || '-02-03'",
    source_id=f"CASE WHEN n_chars % 6 <> 0 THEN 's' || doc_id ELSE {stable('semantic')} END",
    pdf="'https://example.org/' || doc_id || '.pdf'",
)
source(
    "crossref", 0.85,
    published="CASE WHEN year IS NOT NULL THEN CAST(year AS VARCHAR) || '-' || lpad(CAST(1 + n_chars % 12 AS VARCHAR), 2, '0') || '-01' END",
    abstract=ws("text"), source_id=f"coalesce(doi, {stable('crossref')})",
    pdf="CASE WHEN n_chars % 5 = 0 THEN 'https://example.org/' || doc_id || '/file' END",
)
source(
    "datacite", 0.82, authors=dedupe_authors(_AUTHORS), source_id="coalesce(doi, 'dc' || doc_id)",
    published=f"coalesce(CASE WHEN n_chars % 2 = 0 THEN CAST(year AS VARCHAR) || '-05-06' END, {_Y1})",
    landing="CASE WHEN n_chars % 4 = 0 THEN 'https://example.org/' || doc_id ELSE 'https://doi.org/' || doi END",
    pdf="'https://example.org/pdf/' || doc_id",
)
source(
    "europe_pmc", 0.8,
    year=f"coalesce({_YEAR}, CASE WHEN n_chars % 2 = 1 THEN 2011 END)",
    source_id=(
        "coalesce(doi, CASE WHEN n_chars % 2 = 0 THEN 'pmid:' || doc_id END, "
        "CASE WHEN n_chars % 5 = 0 THEN 'pmcid:PMC' || doc_id END, 'europepmc:MED:' || doc_id)"
    ),
    published=f"coalesce(CASE WHEN n_chars % 2 = 1 THEN '2011-07-08' END, {_Y1})",
    venue="CASE WHEN n_chars % 4 <> 0 THEN 'Venue ' || lang ELSE 'Europe PMC' END",
    landing=(
        "coalesce('https://doi.org/' || doi, CASE WHEN n_chars % 5 = 0 THEN 'https://pmc.ncbi.nlm.nih.gov/articles/PMC' || doc_id || '/' END, "
        "CASE WHEN n_chars % 2 = 0 THEN 'https://pubmed.ncbi.nlm.nih.gov/' || doc_id || '/' END, 'https://europepmc.org/article/MED/' || doc_id)"
    ),
    pdf=(
        "CASE WHEN n_chars % 10 = 0 THEN 'https://example.org/f/' || doc_id "
        "WHEN n_chars % 5 = 0 THEN 'https://pmc.ncbi.nlm.nih.gov/articles/PMC' || doc_id || '/pdf/' END"
    ),
)
source(
    "doaj", 0.74, year=f"coalesce({_YEAR}, 2010)", authors=dedupe_authors(_AUTHORS), published=_Y1,
    # Without a DOI the identifier list still has a serial number that reads as one.
    doi=f"coalesce({_DOI}, '1234-5678')",
    pdf=f"'https://arxiv.org/pdf/2001.' || {_ARXIV_N} || 'v2.pdf'",
)
source(
    "google_scholar_json", 0.74, published=_Y1, source_id=stable("scholar"), doi="NULL",
    # Without authors the meta line starts with the separator, so its second part is the host.
    venue="CASE WHEN len(authors) = 0 THEN 'example.org' ELSE 'Venue ' || lang || ', ' || coalesce(CAST(year AS VARCHAR), 'n.d.') END",
    landing="'https://example.org/' || doc_id",
    pdf="CASE WHEN n_chars % 5 = 0 THEN 'https://example.org/' || doc_id || '.pdf' END",
)
source(
    "google_scholar_html", 0.7, published=_Y1, source_id=stable("scholar"),
    venue="'Venue ' || lang || ', ' || coalesce(CAST(year AS VARCHAR), 'n.d.')", doi="NULL", abstract=ws("text"),
    # Without authors the first part of the meta line is the venue, which is read as two names.
    authors=f"CASE WHEN len({_AUTHORS}) = 0 THEN ['- Venue ' || lang, coalesce(CAST({_YEAR} AS VARCHAR), 'n.d.')] ELSE {_AUTHORS} END",
    landing="'https://example.org/' || doc_id",
)
source(
    "dblp", 1.0, match=None, title=ws("line1 || ' et al'"), published=_Y1, abstract="NULL", doi=f"{_DOI} || '.'",
    source_id="coalesce('doi:' || lower(doi), 'k/' || doc_id)",
    venue="CASE WHEN n_chars % 2 = 0 THEN 'Venue ' || lang ELSE 'Book ' || lang END",
    landing="'https://dblp.org/rec/' || doc_id", pdf="'https://example.org/' || doc_id || '.pdf'",
)
source(
    "arxiv", 0.84, published="CAST(year AS VARCHAR) || '-09-10T00:00:00Z'", venue="'arXiv'",
    abstract=f"coalesce(nullif({ws('rest')}, ''), title)", source_id=f"'arxiv:2001.' || {_ARXIV_N} || 'v3'",
    landing=f"'http://arxiv.org/abs/2001.' || {_ARXIV_N} || 'v3'",
    pdf=(
        "CASE WHEN n_chars % 5 = 0 THEN 'https://example.org/' || doc_id || '.pdf' "
        f"ELSE 'https://arxiv.org/pdf/2001.' || {_ARXIV_N} || 'v3.pdf' END"
    ),
)
source(
    "pubmed", 0.83, year=f"coalesce({_YEAR}, 2013)", title=ws("line1 || ' 2'"), match=_GIVEN,
    authors=dedupe_authors(_AUTHORS), published="CAST(year AS VARCHAR) || '-03-07'",
    abstract=f"'AIM: ' || {ws('line1')} || ' ' || coalesce(nullif({ws('rest')}, ''), {ws('line1')})",
    source_id="coalesce(doi, 'pmid:' || doc_id)",
    landing="coalesce('https://doi.org/' || doi, 'https://pubmed.ncbi.nlm.nih.gov/' || doc_id || '/')",
    pdf="CASE WHEN n_chars % 5 = 0 THEN 'https://pmc.ncbi.nlm.nih.gov/articles/PMC' || doc_id || '/pdf/' END",
)
source(
    "openaire", 0.78, authors=dedupe_authors(_AUTHORS), published="CAST(year AS VARCHAR) || '-06-07'", abstract=ws("text"),
    # Without an identifier the links are searched for a DOI, which they do not hold.
    venue="CASE WHEN n_chars % 4 <> 0 THEN 'Venue ' || lang ELSE 'OpenAIRE' END",
    source_id=f"coalesce(doi, {stable('openaire')})", pdf="'https://example.org/' || doc_id || '.pdf'", copies=2,
)
# One affiliation feed: authors meet every person of the roster, and a row is made for each of them.
SQL["source_inspirehep"] = (
    f"WITH {DOCS}, people AS (SELECT DISTINCT w[1] || ' ' || upper(w[2][1]) || lower(substr(w[2], 2)) AS name FROM docs WHERE len(w) >= 2), "
    f"a AS (SELECT doc_id, n_chars, lang, rest, line1, coalesce(CASE WHEN n_chars % 2 = 0 THEN 2012 END, {_YEAR}) AS year, {ws('line1')} AS title, "
    f"{_DOI} AS doi, {dedupe_authors(_AUTHORS)} AS authors, "
    "CASE WHEN n_chars % 2 = 0 THEN '2012-03-04' ELSE CAST(" + _YEAR + " AS VARCHAR) || '-01-01' END AS published_date "
    f"FROM docs WHERE {_MEMBER} IS NOT NULL), f AS (SELECT * FROM a WHERE title <> '' AND len(authors) > 0 AND (year IS NULL OR year >= 2008)), "
    "n AS (SELECT DISTINCT doc_id, unnest(authors) AS au FROM f), "
    "m AS (SELECT DISTINCT n.doc_id, p.name FROM n JOIN people p ON "
    "(lower(split_part(n.au, ' ', 2)) = lower(split_part(p.name, ' ', 2)) AND lower(n.au[1]) = lower(p.name[1])) OR "
    "(lower(split_part(n.au, ' ', 1)) = lower(split_part(p.name, ' ', 2)) AND lower(split_part(n.au, ' ', 2)[1]) = lower(p.name[1]))) "
    "SELECT m.name AS member_name, f.doc_id AS row_no, coalesce(f.doi, CASE WHEN f.doc_id <> 0 THEN 'inspirehep:' || f.doc_id ELSE "
    + stable("inspirehep").replace("year", "f.year").replace("title", "f.title")
    + " END) AS source_id, f.title, CAST(f.year AS BIGINT) AS year, f.published_date, 'Venue ' || f.lang AS venue, f.doi, "
    f"array_to_string(f.authors, '; ') AS authors, md5(nullif({ws('f.rest')}, '')) AS abstract_md5, "
    "CASE WHEN f.doc_id <> 0 THEN 'https://inspirehep.net/literature/' || f.doc_id END AS landing_page_url, "
    f"'https://arxiv.org/pdf/2001.' || {_ARXIV_N.replace('n_chars', 'f.n_chars')} || '.pdf' AS pdf_url, "
    "CAST(0.88 AS DOUBLE) AS relevance_score FROM m JOIN f USING (doc_id)"
)

_TWELVE = {
    "dblp": "dblp", "openalex": "openalex", "semantic_scholar": "semantic_scholar", "crossref": "crossref", "datacite": "datacite",
    "europe_pmc": "europe_pmc", "pubmed": "pubmed", "openaire": "openaire", "doaj": "doaj", "arxiv": "arxiv", "inspirehep": "inspirehep",
    "google_scholar": "google_scholar_html",
}
SQL["collected_records"] = (
    f"WITH {DOCS}, members AS (SELECT DISTINCT w[1] || ' ' || upper(w[2][1]) || lower(substr(w[2], 2)) AS name FROM docs WHERE len(w) >= 2), u AS ("
    + " UNION ALL ".join(f"SELECT '{source}' AS source, * FROM ({SQL['source_' + name]})" for source, name in _TWELVE.items())
    + ") SELECT source, member_name, source_id, title, doi, row_number() OVER (PARTITION BY source ORDER BY length(m.name) NULLS FIRST, member_name, "
    "row_no % 3, row_no, source_id) AS place FROM u LEFT JOIN members m ON m.name = u.member_name"
)
SQL["pubmed_search_ids"] = (
    "SELECT doc_id, 0 AS pos, CAST(doc_id AS VARCHAR) AS pmid FROM documents UNION ALL SELECT doc_id, 1, CAST(n_chars AS VARCHAR) FROM documents"
)
SQL["blocked_pages"] = (
    f"WITH {DOCS} SELECT 'google_scholar' AS source, {_MEMBER} AS member, 'result page is blocked' AS error, count(*) AS pages "
    f"FROM docs WHERE doc_id % 5 = 2 AND {_MEMBER} IS NOT NULL GROUP BY 2"
)

# --- snapshots ------------------------------------------------------------------------------------------------


def _fields(suffix: str, condition: str) -> str:
    """Merged fields and sorted lists of the papers of some records."""
    k = f"(SELECT * FROM keyed WHERE {condition})"
    return (
        f"p{suffix} AS (SELECT canonical_id, first(title ORDER BY length(title) DESC, ord) AS title, min(year) AS year, "
        "min(published_date) AS published_date, first(venue ORDER BY ord) FILTER (WHERE venue <> '') AS venue, "
        "first(doi ORDER BY ord) FILTER (WHERE doi <> '') AS doi, count(*) AS record_count, min(ord) AS first_ord, "
        "list_sort(list_distinct(flatten(list(authors)))) AS authors, list_sort(list_distinct(list(member_name))) AS members, "
        "list_sort(list_distinct(list(landing_page_url))) AS urls, list_sort(list_distinct(list(pdf_url))) AS pdf_urls, "
        f"list_sort(list_distinct(list(source))) AS sources FROM {k} GROUP BY canonical_id)"
    )


_ALL, _SOME = _fields("_all", "true"), _fields("_some", "ord IN (SELECT doc_id FROM labels)")
_SAME = " AND ".join(
    f"c.{f} IS NOT DISTINCT FROM o.{f}"
    for f in ("title", "year", "published_date", "venue", "doi", "authors", "members", "urls", "pdf_urls", "sources")
)
DIFF = (
    f"{RECORDS}, {_ALL}, {_SOME}, diff AS (SELECT c.canonical_id, CASE WHEN o.canonical_id IS NULL THEN 'new' "
    f"WHEN {_SAME} THEN 'unchanged' ELSE 'changed' END AS status, o.record_count AS old_count, o.year AS old_year, "
    "o.venue AS old_venue FROM p_all c LEFT JOIN p_some o USING (canonical_id))"
)
SQL["snapshot_diff"] = f"WITH {DIFF} SELECT canonical_id, status FROM diff"
SQL["snapshot_counts"] = (
    f"WITH {DIFF} SELECT count(*) FILTER (WHERE status = 'new') AS new_count, count(*) FILTER (WHERE status = 'changed') "
    "AS changed_count, count(*) FILTER (WHERE status = 'unchanged') AS unchanged_count FROM diff"
)
SQL["snapshot_delta"] = f"WITH {DIFF} SELECT status, canonical_id FROM diff WHERE status <> 'unchanged'"
SQL["incremental_selection"] = f"WITH {DIFF} SELECT canonical_id, status FROM diff WHERE status IN ('new', 'changed')"
SQL["hydrate_cached"] = (
    f"WITH {DIFF}, u AS (SELECT *, status = 'unchanged' AS use FROM diff) SELECT canonical_id, status, "
    "CASE WHEN use THEN old_count > 1 ELSE true END AS award_mentioned_in_metadata, "
    "CASE WHEN use THEN coalesce(old_year > 2010, false) ELSE false END AS award_mentioned_in_document, "
    "CASE WHEN use THEN concat_ws('|', 'fresh', 'cached', old_venue) ELSE 'fresh' END AS award_mentions, "
    "CASE WHEN use THEN 'cached document' ELSE '' END AS document_award_mentions, "
    "CASE WHEN use AND old_year > 2010 THEN 'pdf' ELSE 'old' END AS document_verification_kind, "
    "'old' AS document_verification_url FROM u"
)
SQL["state_upsert"] = (
    f"WITH {RECORDS}, {_ALL}, {_SOME} SELECT o.canonical_id, coalesce(c.title, o.title) AS title, "
    "CASE WHEN c.canonical_id IS NULL THEN o.doi ELSE c.doi END AS doi, "
    "CAST(CASE WHEN c.canonical_id IS NULL THEN o.year ELSE c.year END AS BIGINT) AS year, "
    "array_to_string(CASE WHEN c.canonical_id IS NULL THEN o.sources ELSE c.sources END, '|') AS sources, 't0' AS first_seen_at, "
    "CASE WHEN c.canonical_id IS NULL THEN 't0' ELSE 't1-end' END AS last_seen_at, "
    "CASE WHEN c.canonical_id IS NULL THEN 'run-0' ELSE 'run-1' END AS last_output_dir "
    "FROM p_all o LEFT JOIN p_some c USING (canonical_id)"
)
_LATE = _fields("_late", "year > 2010")
_LAST = lambda f: f"CASE WHEN l.canonical_id IS NOT NULL THEN l.{f} WHEN c.canonical_id IS NOT NULL THEN c.{f} ELSE o.{f} END"
_RUN = "CASE WHEN l.canonical_id IS NOT NULL THEN '2' WHEN c.canonical_id IS NOT NULL THEN '1' ELSE '0' END"
SQL["state_runs"] = (
    f"WITH {RECORDS}, {_ALL}, {_SOME}, {_LATE} SELECT o.canonical_id, {_LAST('title')} AS title, {_LAST('doi')} AS doi, "
    f"CAST({_LAST('year')} AS BIGINT) AS year, array_to_string({_LAST('sources')}, '|') AS sources, 't0-start' AS first_seen_at, "
    f"'t' || {_RUN} || '-end' AS last_seen_at, 'run-' || {_RUN} AS last_output_dir "
    "FROM p_all o LEFT JOIN p_some c USING (canonical_id) LEFT JOIN p_late l USING (canonical_id)"
)
SQL["event_first_seen"] = (
    "SELECT user_id || '-' || event_type AS key, event_id, value FROM events "
    "QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1"
)
SQL["unseen_keys"] = (
    f"WITH {RECORDS} SELECT canonical_id, ord, source FROM keyed WHERE canonical_id NOT IN "
    "(SELECT canonical_id FROM keyed WHERE ord IN (SELECT doc_id FROM labels)) "
    "QUALIFY row_number() OVER (PARTITION BY canonical_id ORDER BY ord) = 1"
)

# --- names ----------------------------------------------------------------------------------------------------

PEOPLE = (
    "people AS (SELECT DISTINCT w[1] || ' ' || upper(w[2][1]) || lower(substr(w[2], 2)) AS name FROM docs WHERE len(w) >= 2)"
)
# Author names of the stand-in tables have exactly two parts of letters.
_PARTS = (
    "lower(split_part(member_name, ' ', 1)) AS tf, lower(split_part(member_name, ' ', 2)) AS tl, "
    "lower(split_part(author, ' ', 1)) AS cf, lower(split_part(author, ' ', 2)) AS cl"
)
HITS = (
    f"{RECORDS}, hits AS (SELECT authors[1] AS member_name, ord * 10 + generate_subscripts(authors, 1) - 1 AS hit_ord, "
    "unnest(authors) AS author, ord % 2 = 0 AS has_notes FROM records WHERE len(authors) > 0), "
    f"hp AS (SELECT *, {_PARTS} FROM hits), "
    "ho AS (SELECT *, len(list_distinct(list_filter([tf, tl], lambda t : t = cf OR t = cl))) AS overlap FROM hp), "
    "scored AS (SELECT member_name, hit_ord, author, "
    "CASE WHEN tl = cl THEN 25.0 ELSE -40.0 END + CASE WHEN tf = cf THEN 30.0 WHEN tf[1] = cf[1] THEN 12.0 ELSE -12.0 END "
    "+ overlap * 8.0 + CASE WHEN tf || tl = cf || cl THEN 100.0 ELSE 0.0 END + CASE WHEN has_notes THEN 2.0 ELSE 0.0 END AS dblp_score, "
    "CASE WHEN tl = cl THEN 20.0 ELSE -30.0 END + CASE WHEN tf = cf THEN 20.0 WHEN tf[1] = cf[1] THEN 8.0 ELSE -8.0 END "
    "+ overlap * 6.0 + CASE WHEN tf || tl = cf || cl THEN 60.0 ELSE 0.0 END AS openalex_score, "
    "CASE WHEN tl = cl THEN 30.0 WHEN tl = cf THEN 10.0 ELSE -30.0 END + CASE WHEN tf = cf THEN 30.0 WHEN tf[1] = cf[1] THEN 12.0 ELSE -12.0 END "
    "+ overlap * 6.0 AS semantic_scholar_score FROM ho)"
)
SQL["author_scores"] = (
    f"WITH {HITS} SELECT member_name, hit_ord, author, dblp_score::DOUBLE AS dblp_score, openalex_score::DOUBLE AS openalex_score, "
    "semantic_scholar_score::DOUBLE AS semantic_scholar_score FROM scored"
)
BEST_DBLP = (
    "best_dblp AS (SELECT member_name, author, hit_ord, dblp_score AS score FROM "
    "(SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY member_name, author ORDER BY hit_ord) = 1) "
    "QUALIFY row_number() OVER (PARTITION BY member_name ORDER BY dblp_score DESC, hit_ord) = 1)"
)
SQL["best_author_hit"] = (
    f"WITH {HITS}, {BEST_DBLP}, "
    "o AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY member_name ORDER BY openalex_score DESC, hit_ord) = 1), "
    "s AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY member_name ORDER BY semantic_scholar_score DESC, hit_ord) = 1) "
    "SELECT 'dblp' AS kind, member_name, author, hit_ord, score::DOUBLE AS score FROM best_dblp WHERE score >= 25 "
    "UNION ALL SELECT 'openalex', member_name, author, hit_ord, openalex_score::DOUBLE FROM o WHERE openalex_score >= 18 "
    "UNION ALL SELECT 'semantic_scholar', member_name, author, hit_ord, semantic_scholar_score::DOUBLE FROM s"
)
_NAME_RULE = (
    "((lower(split_part(n.author, ' ', 2)) = lower(split_part(p.name, ' ', 2)) AND lower(n.author[1]) = lower(p.name[1])) OR "
    "(lower(split_part(n.author, ' ', 1)) = lower(split_part(p.name, ' ', 2)) AND lower(split_part(n.author, ' ', 2)[1]) = lower(p.name[1])))"
)
SQL["name_match_equi"] = (
    f"WITH {RECORDS}, {PEOPLE}, n AS (SELECT DISTINCT ord, unnest(authors) AS author FROM records) "
    f"SELECT DISTINCT n.ord, p.name AS member_name FROM n JOIN people p ON {_NAME_RULE}"
)
SQL["name_match_full_given"] = (
    f"WITH {RECORDS}, {PEOPLE}, n AS (SELECT DISTINCT unnest(authors) AS a FROM records), "
    "j AS (SELECT a, name AS member_name FROM n JOIN people ON "
    "lower(split_part(a, ' ', 2)) = lower(split_part(name, ' ', 2)) OR lower(split_part(a, ' ', 1)) = lower(split_part(name, ' ', 2))) "
    "SELECT DISTINCT a AS author, member_name FROM j WHERE CASE WHEN lower(split_part(a, ' ', 2)) = lower(split_part(member_name, ' ', 2)) "
    f"THEN {_given_test(1)} ELSE {_given_test(2)} END"
)
SQL["name_variants"] = (
    f"WITH {DOCS}, {PEOPLE}, v AS (SELECT name, lower(split_part(name, ' ', 1)) AS f, lower(split_part(name, ' ', 2)) AS l FROM people) "
    "SELECT name, CASE WHEN f = f[1] THEN name ELSE name || '|' || f[1] || ' ' || l END AS variants, "
    "CASE WHEN f = f[1] THEN 'au:\"' || name || '\"' ELSE 'au:\"' || name || '\" OR au:\"' || f[1] || ' ' || l || '\"' END AS arxiv_query, "
    "'(\"' || l || ' ' || f[1] || '\"[Author] OR \"' || name || '\"[Author]) AND (\"2020/01/01\"[Date - Publication] : \"3000\"[Date - Publication])' AS pubmed_query, "
    "length(name) BETWEEN 5 AND 80 AND name[1] = upper(name[1]) AND NOT regexp_matches(lower(name), "
    "'team|faculty|students|postdocs|news|events|contact|opportunities|institute|research|materials') AS is_person FROM v"
)
SQL["member_profiles"] = (
    f"WITH {HITS}, {PEOPLE}, renamed AS (SELECT split_part(member_name, ' ', 1) || ' ' || upper(split_part(member_name, ' ', 2)[1]) || "
    "lower(substr(split_part(member_name, ' ', 2), 2)) AS name, author, hit_ord, dblp_score FROM scored), "
    "one AS (SELECT * FROM renamed QUALIFY row_number() OVER (PARTITION BY name, author ORDER BY hit_ord) = 1), "
    "best AS (SELECT * FROM one QUALIFY row_number() OVER (PARTITION BY name ORDER BY dblp_score DESC, hit_ord) = 1), "
    "fixed AS (SELECT DISTINCT regexp_replace(lower(name), '[^a-z]', '', 'g') AS k, 'x/' || length(name) AS pid FROM people), "
    "r AS (SELECT p.name, f.pid AS fixed, md5(b.author) AS pid, b.author FROM people p "
    "LEFT JOIN (SELECT * FROM fixed WHERE length(k) < 8) f ON f.k = regexp_replace(lower(p.name), '[^a-z]', '', 'g') "
    "LEFT JOIN (SELECT * FROM best WHERE dblp_score >= 25) b ON b.name = p.name) "
    "SELECT name, coalesce(fixed, pid) AS dblp_pid, 'https://dblp.org/pid/' || coalesce(fixed, pid) AS dblp_url, "
    "CASE WHEN fixed IS NULL THEN coalesce(author, '') ELSE '' END AS aliases FROM r"
)

# --- targets --------------------------------------------------------------------------------------------------

SQL["doi_list_parse"] = (
    f"WITH {RECORDS}, t AS (SELECT ord % 2 AS list_rank, ord, concat_ws(' ', 'see', '(doi:' || doi || '),', upper(doi), title) AS text FROM records), "
    "b AS (SELECT list_rank, ord, list_filter(list_transform(string_split_regex(text, '[\\s,]+'), lambda p : trim(p, '()[]{}<>.,;')), "
    "lambda p : contains(p, '10.')) AS parts FROM t), "
    "u AS (SELECT list_rank, ord, unnest(parts) AS p, generate_subscripts(parts, 1) - 1 AS pos FROM b), "
    "c AS (SELECT list_rank, ord, pos, substr(p, strpos(p, '10.')) AS doi FROM u) "
    "SELECT lower(doi) AS doi_key, doi, list_rank, ord, CAST(pos AS BIGINT) AS pos FROM c "
    "QUALIFY row_number() OVER (PARTITION BY lower(doi) ORDER BY list_rank, ord, pos) = 1"
)
TARGETS = (
    "targets AS (SELECT lower(doi) AS doi_key, min(ord) AS target_ord FROM (SELECT ord, doi FROM records WHERE doi IS NOT NULL "
    "AND ord IN (SELECT doc_id FROM labels) UNION ALL SELECT 1000000000 + item_id, '10.9999/' || item_id FROM benchmark) GROUP BY 1)"
)
_FLAGGED = (
    SQL["metadata_mentions"].replace("WITH ", "", 1).rsplit("SELECT canonical_id, mention", 1)[0]
    + ", flagged AS (SELECT DISTINCT canonical_id FROM e), "
    + PAPERS[len(RECORDS) + 2:]
    + ", fp AS (SELECT p.*, f.canonical_id IS NOT NULL AS meta, coalesce(p.year > 2015, false) AS docf FROM papers p LEFT JOIN flagged f USING (canonical_id)), "
    "firsts AS (SELECT lower(doi) AS doi_key, title, meta, docf FROM fp WHERE doi IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY lower(doi) ORDER BY first_ord) = 1), "
    + TARGETS
)
SQL["target_coverage"] = (
    f"WITH {_FLAGGED} SELECT t.doi_key, t.target_ord, f.doi_key IS NOT NULL AS found, f.title, f.docf OR f.meta AS award_verified "
    "FROM targets t LEFT JOIN firsts f USING (doi_key)"
)
SQL["target_coverage_counts"] = (
    f"WITH {_FLAGGED} SELECT count(*) AS total, count(f.doi_key) AS matched_count, count(*) - count(f.doi_key) AS missing_count, "
    "count(*) FILTER (WHERE f.docf) AS award_verified_count, count(*) FILTER (WHERE NOT f.docf) AS award_verified_missing_count "
    "FROM targets t LEFT JOIN firsts f USING (doi_key)"
)
SQL["target_semi"] = f"WITH {PAPERS}, {TARGETS} SELECT canonical_id, doi FROM papers WHERE lower(doi) IN (SELECT doi_key FROM targets)"

# --- candidates -----------------------------------------------------------------------------------------------

CANDIDATES = (
    "cand AS (SELECT canonical_id, url, min(o) AS o FROM ("
    "SELECT canonical_id, pdf_url AS url, ord AS o FROM keyed WHERE pdf_url IS NOT NULL "
    "UNION ALL SELECT canonical_id, pdf_url || '.pdf', 1000000000000 + ord FROM keyed WHERE pdf_url IS NOT NULL) GROUP BY 1, 2)"
)
SQL["pdf_candidates"] = (
    f"WITH {RECORDS}, {CANDIDATES} SELECT canonical_id, url, CASE WHEN o < 1000000000000 THEN 0 ELSE 3 END AS stage, "
    "o % 1000000000000 AS a, 0 AS b, CASE WHEN o < 1000000000000 THEN 0 ELSE 1 END AS c FROM cand"
)
_PMC = "regexp_extract(landing_page_url, 'PMC[0-9]+')"
TEXTS = (
    f"pmc AS (SELECT canonical_id, {_PMC} AS pmcid, min(ord) AS o FROM keyed WHERE {_PMC} <> '' GROUP BY 1, 2), "
    "texts AS (SELECT canonical_id, 'europe_pmc_fulltext_xml' AS kind, 'https://www.ebi.ac.uk/europepmc/webservices/rest/' || pmcid || '/fullTextXML' AS url, "
    "0 AS g, o AS first_ord, 0 AS n FROM pmc UNION ALL "
    "SELECT canonical_id, 'pmc_efetch_xml', 'https://eutils.ncbi.nlm.nih.gov/entrez/eutils/efetch.fcgi?db=pmc&id=' || pmcid || '&retmode=xml', 0, o, 1 FROM pmc UNION ALL "
    "SELECT canonical_id, 'landing_page_text', landing_page_url, 1, min(ord), 0 FROM keyed GROUP BY canonical_id, landing_page_url)"
)
SQL["text_candidates"] = f"WITH {RECORDS}, {TEXTS} SELECT canonical_id, kind, url, g, first_ord, n FROM texts"

LOOKUP = (
    "look AS (SELECT doi, doc_id, n_chars, lang FROM (SELECT '10.5555/' || substr(md5(line1), 1, 10) AS doi, doc_id, n_chars, lang "
    "FROM docs WHERE n_chars % 3 = 0) QUALIFY row_number() OVER (PARTITION BY doi ORDER BY doc_id) = 1)"
)
_ENRICHED = (
    f"{PAPERS}, {CANDIDATES}, {LOOKUP}, open_ AS (SELECT canonical_id, lower(doi) AS doi FROM papers WHERE doi <> '' "
    "AND canonical_id NOT IN (SELECT canonical_id FROM cand)), "
    "links AS (SELECT canonical_id, list_filter([CASE WHEN n_chars % 2 = 0 THEN 'https://example.org/pdf/' || doc_id || '?v=1' END, "
    "'https://arxiv.org/pdf/2101.' || lpad(CAST(doc_id % 100000 AS VARCHAR), 5, '0') || '.pdf'], lambda x : x IS NOT NULL) AS urls "
    "FROM open_ JOIN look USING (doi))"
)
SQL["enriched_candidates"] = (
    f"WITH {_ENRICHED} SELECT canonical_id, unnest(urls) AS url, CAST(generate_subscripts(urls, 1) - 1 AS BIGINT) AS pos FROM links"
)
SQL["enrichment_stats"] = (
    f"WITH {_ENRICHED}, has AS (SELECT DISTINCT canonical_id FROM keyed WHERE pdf_url IS NOT NULL) "
    "SELECT (SELECT count(*) FROM papers) AS papers_total, (SELECT count(*) FROM has) + (SELECT count(*) FROM links) AS papers_with_pdf_after_enrich, "
    "(SELECT count(*) FROM links) AS filled_count, (SELECT count(DISTINCT doi) FROM open_) AS doi_lookup_count"
)
SQL["local_file_candidates"] = (
    f"WITH {PAPERS} SELECT canonical_id, url, min(stage) AS stage FROM ("
    "SELECT canonical_id, 'https://example.org/' || first_ord || '.PDF' AS url, 0 AS stage FROM papers "
    "UNION ALL SELECT canonical_id, pdf_url, 1 FROM keyed WHERE pdf_url IS NOT NULL) GROUP BY 1, 2"
)

_ESC = "replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
FETCHED = (
    "src AS (SELECT r.ord, d.n_chars, d.text, r.pdf_url, r.landing_page_url FROM records r JOIN docs d ON d.doc_id = r.ord), "
    "addr AS (SELECT ord, n_chars, text, 'pdf' AS kind, pdf_url AS url FROM src UNION ALL SELECT ord, n_chars, text, 'page', landing_page_url FROM src "
    "UNION ALL SELECT ord, n_chars, text, 'pdf', CASE WHEN n_chars % 3 = 0 THEN 'https://example.org/cr/' || ord || '/pdf' END FROM src "
    "UNION ALL SELECT ord, n_chars, text, 'xml', CASE WHEN landing_page_url LIKE '%/PMC%' THEN 'https://www.ebi.ac.uk/europepmc/webservices/rest/' || "
    "regexp_extract(landing_page_url, 'PMC[0-9]+') || '/fullTextXML' END FROM src), "
    "fetched AS (SELECT url, ord, kind, CASE WHEN kind = 'page' THEN url || '?final' ELSE url END AS final_url, CASE WHEN n_chars % 11 = 0 THEN 404 ELSE 200 END AS status_code, "
    "CASE WHEN kind = 'xml' THEN 'application/xml' WHEN kind = 'page' OR n_chars % 3 = 0 THEN 'text/html' ELSE 'application/pdf' END AS content_type, "
    "CASE WHEN kind = 'pdf' AND n_chars % 3 <> 0 THEN true WHEN kind = 'pdf' THEN false ELSE NULL END AS is_pdf, "
    "CASE WHEN n_chars % 19 = 0 THEN 'read timed out' END AS error, CASE WHEN kind = 'pdf' AND n_chars % 4 <> 0 THEN text END AS document_text, "
    "regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', '') AS page_text FROM addr WHERE url IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY url ORDER BY ord) = 1), "
    "judged AS (SELECT *, CASE WHEN error IS NOT NULL THEN error WHEN status_code >= 400 THEN 'status ' || status_code "
    "WHEN is_pdf IS NOT TRUE THEN 'no PDF but ' || content_type END AS bad, "
    "CASE WHEN error IS NOT NULL THEN error WHEN status_code >= 400 THEN 'status ' || status_code END AS page_bad FROM fetched)"
)
SQL["retrieval_errors"] = f"WITH {RECORDS}, {FETCHED} SELECT url, bad AS reason FROM judged"
SQL["error_taxonomy"] = (
    "WITH t AS (SELECT doc_id, CASE WHEN n_chars % 9 = 0 THEN '' ELSE "
    + ws("CASE n_chars % 4 WHEN 0 THEN 'SSLEOFError ' WHEN 1 THEN 'x ProxyError ' ELSE '' END || text")
    + " END AS c FROM documents) SELECT doc_id, CASE WHEN contains(c, 'SSLEOFError') OR contains(c, 'SSL_connect') THEN "
    "'TLS broke off behind the proxy' WHEN contains(c, 'ProxyError') THEN "
    "'proxy not reached' WHEN c = '' THEN 'no error text' "
    "WHEN length(c) > 240 THEN substr(c, 1, 237) || '...' ELSE c END AS error FROM t"
)

# --- document scan --------------------------------------------------------------------------------------------


def _mentions(text: str) -> str:
    return distinct(hits(text, _LICENCE_RE))


SCAN = (
    f"{PAPERS}, {CANDIDATES}, {TEXTS}, {FETCHED}, "
    "tried AS (SELECT c.canonical_id, c.url, row_number() OVER (PARTITION BY c.canonical_id ORDER BY c.o) AS rn FROM cand c), "
    "tr AS (SELECT t.canonical_id, t.url, t.rn, f.url IS NOT NULL AND f.bad IS NULL AS dl, f.url IS NOT NULL AND f.bad IS NULL AND f.document_text IS NOT NULL AS ex, "
    "CASE WHEN f.url IS NULL THEN 'nothing landed' WHEN f.bad IS NOT NULL THEN f.bad WHEN f.document_text IS NULL THEN 'document without text' END AS err, "
    f"f.document_text AS text, CASE WHEN f.bad IS NULL AND f.document_text IS NOT NULL THEN {_mentions('f.document_text')} ELSE [] END AS mentions "
    "FROM tried t LEFT JOIN judged f USING (url)), "
    f"trc AS (SELECT *, {context()} AS context FROM tr), "
    "s1 AS (SELECT canonical_id, count(*) AS n, bool_or(dl) AS dl, bool_or(ex) AS ex, first(err ORDER BY rn DESC) FILTER (WHERE err IS NOT NULL) AS err, "
    "first(url ORDER BY rn DESC) FILTER (WHERE dl) AS last_dl, first(url ORDER BY rn) FILTER (WHERE len(mentions) > 0) AS hit_url, "
    "first(array_to_string(mentions, '|') ORDER BY rn) FILTER (WHERE len(mentions) > 0) AS hit_mentions, "
    "first(context ORDER BY rn) FILTER (WHERE len(mentions) > 0) AS hit_context FROM trc GROUP BY 1), "
    "tx AS (SELECT t.canonical_id, t.kind, row_number() OVER (PARTITION BY t.canonical_id ORDER BY t.g, t.first_ord, t.n) AS rn, f.final_url, f.page_text AS text, "
    "CASE WHEN f.url IS NULL THEN 'nothing landed' ELSE f.page_bad END AS err, "
    f"CASE WHEN f.url IS NOT NULL AND f.page_bad IS NULL THEN {_mentions('f.page_text')} ELSE [] END AS mentions "
    "FROM texts t LEFT JOIN judged f USING (url) WHERE t.canonical_id NOT IN (SELECT canonical_id FROM s1 WHERE hit_url IS NOT NULL)), "
    f"txc AS (SELECT *, {context()} AS context FROM tx), "
    "s2 AS (SELECT canonical_id, first(err ORDER BY rn DESC) FILTER (WHERE err IS NOT NULL) AS terr, "
    "first(kind ORDER BY rn) FILTER (WHERE len(mentions) > 0) AS tkind, first(final_url ORDER BY rn) FILTER (WHERE len(mentions) > 0) AS turl, "
    "first(array_to_string(mentions, '|') ORDER BY rn) FILTER (WHERE len(mentions) > 0) AS tmentions, "
    "first(context ORDER BY rn) FILTER (WHERE len(mentions) > 0) AS tcontext FROM txc GROUP BY 1), "
    "st AS (SELECT p.canonical_id, s1.*, s2.*, coalesce(s1.err, s2.terr) AS last_error, "
    "CASE WHEN hit_url IS NOT NULL OR tkind IS NOT NULL THEN 'mention' WHEN NOT coalesce(dl, false) AND coalesce(s1.err, s2.terr) IS NOT NULL THEN 'download_fail' "
    "WHEN dl AND NOT ex AND coalesce(s1.err, s2.terr) IS NOT NULL THEN 'extract_fail' WHEN n IS NULL THEN 'no_pdf' ELSE 'scanned_clear' END AS status "
    "FROM papers p LEFT JOIN s1 ON s1.canonical_id = p.canonical_id LEFT JOIN s2 ON s2.canonical_id = p.canonical_id), "
    "outcome AS (SELECT canonical_id, status, status = 'mention' AS award_mentioned_in_document, coalesce(hit_mentions, tmentions, '') AS document_award_mentions, "
    "CASE WHEN hit_url IS NOT NULL THEN hit_context ELSE tcontext END AS document_award_context, CASE WHEN hit_url IS NOT NULL THEN 'pdf' ELSE tkind END AS document_verification_kind, "
    "coalesce(hit_url, turl) AS document_verification_url, coalesce(hit_url, last_dl) AS document_pdf_url, "
    "CASE WHEN status IN ('download_fail', 'extract_fail') THEN last_error WHEN status = 'no_pdf' THEN 'no candidate address' END AS document_scan_error FROM st)"
)
SQL["document_scan"] = f"WITH {SCAN} SELECT * FROM outcome"
SQL["document_scan_counters"] = (
    f"WITH {SCAN} SELECT count(*) AS papers_total, count(*) FILTER (WHERE status = 'mention') AS mentions_count, "
    "count(*) FILTER (WHERE status = 'no_pdf') AS no_pdf_count, count(*) FILTER (WHERE status = 'download_fail') AS download_fail_count, "
    "count(*) FILTER (WHERE status = 'extract_fail') AS extract_fail_count FROM outcome"
)

# --- curation -------------------------------------------------------------------------------------------------

CURATION = (
    f"{RECORDS}, {_ALL}, items AS (SELECT r.ord, d.line1 AS title, upper(r.doi) AS doi, {key('d.line1')} AS tk FROM records r JOIN docs d ON d.doc_id = r.ord "
    "UNION ALL SELECT ord + 1000000000, 'Unlisted ' || ord, CASE WHEN ord % 20 <> 3 THEN '10.9999/UNLISTED.' || ord END, 'unlisted ' || ord FROM records WHERE ord % 10 = 3), "
    "base AS (SELECT * FROM items WHERE ord IN (SELECT doc_id FROM labels WHERE quality = 1)), "
    "bydoi AS (SELECT lower(doi) AS k, doi AS pdoi, venue, sources FROM p_all WHERE doi <> '' QUALIFY row_number() OVER (PARTITION BY lower(doi) ORDER BY first_ord DESC) = 1), "
    f"bytitle AS (SELECT {key('title')} AS k, doi AS pdoi, venue, sources FROM p_all WHERE {key('title')} <> '' QUALIFY row_number() OVER (PARTITION BY {key('title')} ORDER BY first_ord DESC) = 1), "
    "m AS (SELECT i.*, (lower(coalesce(i.doi, '')), i.tk) IN (SELECT (lower(coalesce(doi, '')), tk) FROM base) AS in_base, "
    "coalesce(a.sources, b.sources) AS psources, CASE WHEN a.k IS NOT NULL THEN a.pdoi ELSE b.pdoi END AS pdoi, CASE WHEN a.k IS NOT NULL THEN a.venue ELSE b.venue END AS pvenue "
    "FROM items i LEFT JOIN bydoi a ON a.k = lower(i.doi) LEFT JOIN bytitle b ON b.k = i.tk), "
    "e AS (SELECT *, CASE WHEN in_base THEN [] ELSE coalesce(psources, []) END AS s, CASE WHEN in_base THEN doi ELSE coalesce(doi, pdoi) END AS edoi FROM m), "
    "f AS (SELECT *, len(list_filter(s, lambda x : x IN ('dblp', 'openalex', 'inspirehep'))) > 0 AS high, len(s) > 0 AND len(list_filter(s, lambda x : x <> 'arxiv')) = 0 AS only_arxiv, "
    "list_contains(s, 'pubmed') AS pm, list_contains(s, 'europe_pmc') AS ep, "
    "len(list_filter(s, lambda x : x NOT IN ('crossref', 'datacite', 'semantic_scholar', 'google_scholar', 'openaire', 'doaj'))) > 0 AS nontrivial FROM e), "
    "g AS (SELECT *, (NOT in_base) AND (lower(coalesce(edoi, '')) LIKE '10.48550/arxiv.%' OR lower(coalesce(edoi, '')) LIKE '10.1101/%' OR only_arxiv) AS pre, "
    "CASE WHEN in_base THEN 'baseline' WHEN psources IS NULL THEN 'missing' WHEN high THEN 'high' WHEN only_arxiv THEN 'high-preprint' WHEN pm AND ep THEN 'high' "
    "WHEN pm OR ep THEN 'medium' WHEN len(s) >= 2 AND nontrivial THEN 'medium' WHEN len(s) >= 2 AND list_contains(s, 'crossref') AND list_contains(s, 'openaire') THEN 'medium' ELSE 'low' END AS confidence, "
    "CASE WHEN in_base THEN 'in baseline' WHEN psources IS NULL THEN 'no paper found' "
    "WHEN high THEN 'authoritative source' WHEN only_arxiv THEN 'arXiv only' "
    "WHEN pm AND ep THEN 'both biomedical indexes' WHEN pm OR ep THEN 'one biomedical index' "
    "WHEN len(s) >= 2 AND nontrivial THEN 'several sources' "
    "WHEN len(s) >= 2 AND list_contains(s, 'crossref') AND list_contains(s, 'openaire') THEN 'Crossref and OpenAIRE' "
    "ELSE 'weak evidence' END AS reason FROM f), "
    "reviewed AS (SELECT *, confidence IN ('high', 'high-preprint', 'medium') AS accepted, coalesce(edoi, '') <> '' AND NOT pre AND (in_base OR psources IS NOT NULL) AS eligible FROM g), "
    "cumul AS (SELECT ord, title, doi, 0 AS section FROM base UNION ALL SELECT ord, title, doi, 1 FROM reviewed WHERE accepted), "
    "judgedc AS (SELECT c.ord, c.title, c.doi, coalesce(c.doi, m.pdoi) AS edoi, coalesce(m.psources, []) AS s FROM cumul c JOIN m USING (ord)), "
    "portal AS (SELECT ord, title, doi FROM judgedc WHERE coalesce(edoi, '') <> '' AND NOT (lower(edoi) LIKE '10.1101/%' OR (len(s) > 0 AND len(list_filter(s, lambda x : x <> 'arxiv')) = 0)))"
)
SQL["curate_decisions"] = (
    f"WITH {CURATION} SELECT ord, accepted, confidence, reason, eligible AS portal_eligible, CASE WHEN in_base THEN NULL ELSE pre END AS is_preprint, "
    "array_to_string(s, '|') AS sources FROM reviewed"
)
SQL["cumulative_manifest"] = f"WITH {CURATION} SELECT ord, title, doi, section FROM cumul"
SQL["portal_manifest"] = f"WITH {CURATION} SELECT ord, title, doi FROM portal"
SQL["curation_counts"] = (
    f"WITH {CURATION} SELECT (SELECT count(*) FROM base) AS baseline_count, (SELECT count(*) FROM reviewed) AS candidate_count, "
    "(SELECT count(*) FROM reviewed WHERE accepted) AS accepted_addition_count, (SELECT count(*) FROM cumul) AS cumulative_count, "
    "(SELECT count(*) FROM portal) AS portal_count"
)

# --- finalisation ---------------------------------------------------------------------------------------------

_STRIP_DOT = "trim(regexp_replace({e}, '\\.+$', ''))"
_ITEM_TITLE = _STRIP_DOT.format(e=ws("regexp_replace(replace(line1, '&amp;', '&'), '<[^>]+>', '', 'g')"))
ITEMS = (
    f"items AS (SELECT doc_id AS ord, {_ITEM_TITLE} AS title, {key(_ITEM_TITLE)} AS gk, {_AUTHORS} AS authors, lang, n_chars, "
    "'https://example.org/item/' || doc_id AS url, CASE WHEN n_chars % 2 = 0 THEN '10.1101/' ELSE '10.5555/' END || substr(md5(line1), 1, 10) AS doi "
    f"FROM docs WHERE doc_id IN (SELECT doc_id FROM labels) AND trim(line1) <> '' AND len({_AUTHORS}) > 0)"
)
_GROUPED = SQL["title_groups"].split(", g AS (", 1)[1].split(") SELECT", 1)[0]
GROUPS = (
    f"{PAPERS}, g AS ({_GROUPED}), gk AS (SELECT *, {key('shown')} AS group_key FROM g), "
    "grp AS (SELECT group_key, count(*) AS paper_count, first(canonical_id ORDER BY first_ord) AS first_canonical_id, "
    "first(shown ORDER BY first_ord) AS first_title FROM gk WHERE group_key <> '' GROUP BY 1)"
)
SQL["manifest_groups"] = (
    f"WITH {GROUPS}, {ITEMS} SELECT ord, group_key, first_title, first_canonical_id, paper_count FROM items JOIN grp ON gk = group_key"
)
FILES = (
    f"files AS (SELECT ord, {key('title')} AS group_key, '/files/' || ord || '.pdf' AS path, ord % 2 = 0 AS ok, "
    "CASE WHEN ord % 2 = 1 THEN 'conversion failed' END AS error FROM records WHERE title <> '' AND ord IN (SELECT doc_id FROM labels WHERE toxic = 1))"
)
SQL["archived_copies"] = (
    f"WITH {RECORDS}, {FILES} SELECT group_key, path, ok, error FROM files WHERE group_key <> '' "
    "QUALIFY row_number() OVER (PARTITION BY group_key ORDER BY NOT ok, ord) = 1"
)
_PRE = "(lower({d}) LIKE '10.48550/arxiv.%' OR lower({d}) LIKE '10.1101/%')"
_SKIP = (
    "(regexp_matches(lower(url), 'mediaobjects|_mosem|_esm|supplement|supplementary|supporting-information') OR "
    f"(NOT {_PRE.format(d='doi')} AND contains(lower(url), 'arxiv.org/pdf/')) OR lower(trim(url)) = 'none')"
)
# Links of a group: every record of every paper of the group, in paper order, then record order.
LINKS = (
    "glink AS (SELECT k.group_key, k.first_ord AS po, r.ord AS ro, r.landing_page_url, r.pdf_url FROM gk k JOIN keyed r USING (canonical_id) WHERE k.group_key <> ''), "
    "gurl AS (SELECT group_key, landing_page_url AS url, first(po ORDER BY po, ro) AS po, first(ro ORDER BY po, ro) AS ro FROM glink GROUP BY 1, 2), "
    "gpdf AS (SELECT group_key, pdf_url AS url, first(po ORDER BY po, ro) AS po, first(ro ORDER BY po, ro) AS ro FROM glink WHERE pdf_url IS NOT NULL GROUP BY 1, 2)"
)
_LANDING = (
    "land AS (SELECT i.ord, i.doi, 'landing_page_text' AS kind, u.url, 0 AS s, u.po, u.ro FROM items i JOIN gurl u ON u.group_key = i.gk "
    "UNION ALL SELECT ord, doi, 'manifest_url', url, 1, 0, 0 FROM items UNION ALL SELECT ord, doi, 'doi_landing_page', 'https://doi.org/' || doi, 2, 0, 0 FROM items)"
)
FINAL = (
    f"{GROUPS}, {ITEMS}, {LINKS}, {LOOKUP}, {FETCHED}, {FILES}, {_LANDING}, "
    f"rules AS (SELECT DISTINCT gk, {_PRE.format(d='doi')} AS pre FROM items), "
    f"direct AS (SELECT r.gk, r.pre, p.url, p.po, p.ro FROM rules r JOIN gpdf p ON p.group_key = r.gk WHERE NOT {_SKIP.replace('url', 'p.url').replace(_PRE.format(d='doi'), 'r.pre')}), "
    # Pages of records carry one typed link; found documents are named by the record that gave the page.
    "plink AS (SELECT url AS page, regexp_extract(url, '^(https?://[^/]*)', 1) || '/dl/' || ord AS url FROM judged WHERE page_bad IS NULL), "
    f"gdisc AS (SELECT DISTINCT r.gk AS group_key, r.pre AS preprint, l.url FROM rules r JOIN gurl u ON u.group_key = r.gk JOIN plink l ON l.page = u.url "
    f"WHERE NOT {_SKIP.replace('url', 'l.url').replace(_PRE.format(d='doi'), 'r.pre')} AND (r.gk, r.pre, l.url) NOT IN (SELECT (gk, pre, url) FROM direct)), "
    "disc AS (SELECT ord, url, min(stage) AS stage FROM ("
    "SELECT i.ord, i.doi, i.gk, 'https://example.org/cr/' || l.doc_id || '/pdf' AS url, 0 AS stage FROM items i JOIN look l ON l.doi = lower(i.doi) "
    "UNION ALL SELECT i.ord, i.doi, i.gk, unnest(list_filter(['https://example.org/oa/' || l.doc_id, CASE WHEN l.n_chars % 2 = 0 THEN 'https://example.org/pdf/' || l.doc_id || '?v=1' END, "
    "'https://doi.org/' || l.doi, 'https://arxiv.org/abs/2101.' || lpad(CAST(l.doc_id % 100000 AS VARCHAR), 5, '0') || 'v2'], lambda x : x IS NOT NULL)), 1 FROM items i JOIN look l ON l.doi = lower(i.doi) "
    "UNION ALL SELECT i.ord, i.doi, i.gk, l.url, 2 FROM items i JOIN plink l ON l.page IN (i.url, 'https://doi.org/' || i.doi)) "
    f"WHERE NOT {_SKIP} AND (gk, {_PRE.format(d='doi')}, url) NOT IN (SELECT (gk, pre, url) FROM direct) GROUP BY 1, 2)"
)
SQL["discovered_candidates"] = (
    f"WITH {FINAL} SELECT NULL AS group_key, NULL AS preprint, ord, url, stage FROM disc UNION ALL SELECT group_key, preprint, NULL, url, 2 FROM gdisc"
)
_USABLE = (
    "(length({w}) >= 400 AND NOT regexp_matches(lower({w}), 'preparing to download|recaptcha|captcha|access denied|enable javascript|browser check'))"
)
SNAPSHOTS = (
    f"verif AS (SELECT {key('title')} AS gk, 'landing_page_text' AS kind, landing_page_url AS url, ord AS vo FROM records WHERE title <> '' AND ord IN (SELECT doc_id FROM labels WHERE quality = 0)), "
    "vk AS (SELECT i.ord, v.kind, v.url, -1 AS s, v.vo AS po, 0 AS ro FROM items i JOIN verif v USING (gk)), "
    "allp AS (SELECT * FROM vk UNION ALL SELECT ord, kind, url, s, po, ro FROM land WHERE kind <> 'landing_page_text' OR ord NOT IN (SELECT ord FROM vk)), "
    f"snap AS (SELECT a.ord, a.kind, f.final_url AS source_url, f.page_text FROM allp a JOIN judged f ON f.url = a.url WHERE f.page_bad IS NULL AND {_USABLE.format(w=ws('f.page_text'))} "
    "QUALIFY row_number() OVER (PARTITION BY a.ord ORDER BY a.s, a.po, a.ro) = 1)"
)
SQL["snapshot_texts"] = f"WITH {FINAL}, {SNAPSHOTS} SELECT ord, kind, source_url, md5(page_text) AS text_md5 FROM snap"
META = (
    f"gabs AS (SELECT group_key, {_SHOWN_ABSTRACT} AS t FROM gk WHERE group_key <> '' AND {_SHOWN_ABSTRACT} <> ''), "
    "xr AS (SELECT i.ord, l.doc_id, l.lang FROM items i JOIN look l ON l.doi = lower(i.doi)), "
    "abst AS (SELECT ord, t, min(p) AS p FROM (SELECT i.ord, a.t, 0 AS p FROM items i JOIN gabs a ON a.group_key = i.gk "
    "UNION ALL SELECT ord, 'looked up ' || lang, 2 FROM xr UNION ALL SELECT ord, 'A looked-up note', 3 FROM xr) GROUP BY 1, 2), "
    "heads AS (SELECT ord, 0 AS section, 'Title' AS label, title AS t FROM items UNION ALL SELECT ord, 1, 'Authors', array_to_string(authors, ', ') FROM items "
    "UNION ALL SELECT ord, 2, 'Member Authors', 'Team ' || lang FROM items UNION ALL SELECT ord, 3, 'Address', url FROM items UNION ALL SELECT ord, 4, 'DOI', doi FROM items), "
    "gl AS (SELECT DISTINCT gk FROM items), "
    "lines_ AS (SELECT NULL AS group_key, * FROM heads "
    "UNION ALL SELECT k.group_key, NULL, 5, 'Paper ids', k.canonical_id FROM gk k WHERE k.group_key IN (FROM gl) "
    "UNION ALL SELECT u.group_key, NULL, 6, 'Addresses', u.url FROM gurl u WHERE u.group_key IN (FROM gl) "
    "UNION ALL SELECT u.group_key, NULL, 7, 'Document addresses', u.url FROM gpdf u WHERE u.group_key IN (FROM gl) "
    "UNION ALL SELECT DISTINCT a.group_key, NULL, 9, 'canonical_record_abstract', a.t FROM gabs a WHERE a.group_key IN (FROM gl) "
    "UNION ALL SELECT NULL, ord, 8, 'Metadata', unnest(['Crossref published date: 2015-6', 'Crossref venue: Venue ' || lang, 'OpenAlex OA status: green', 'OpenAlex OA URL: https://example.org/oa/' || doc_id]) FROM xr "
    "UNION ALL SELECT NULL, ord, 9, CASE p WHEN 2 THEN 'openalex_metadata' ELSE 'datacite_metadata' END, t FROM abst WHERE p > 0 "
    "UNION ALL SELECT NULL, ord, 9, 'citation_snapshot', 'Neither full text nor an abstract has landed; the citation stands for the paper.' "
    "FROM items WHERE ord NOT IN (SELECT ord FROM abst))"
)
_MATCHED = "ord IN (SELECT ord FROM items JOIN grp ON gk = group_key)"
_SHARED = "(ord IS NULL AND group_key IN (SELECT group_key FROM grp))"
SQL["metadata_snapshot"] = f"WITH {FINAL}, {META} SELECT group_key, ord, section, label, md5(t) AS text_md5 FROM lines_ WHERE t <> '' AND ({_MATCHED} OR {_SHARED})"
_LINE_DIGEST = "sum(CAST('0x' || substr(md5(section || '|' || label || '|' || t), 1, 8) AS BIGINT))"
#: The whole text of every item: blocks of one label in the order of their first lines, lines inside them by place.
_COMPOSED = (
    "places AS (SELECT NULL AS group_key, *, 0 AS a, 0 AS b FROM heads "
    "UNION ALL SELECT k.group_key, NULL, 5, 'Paper ids', k.canonical_id, k.first_ord, 0 FROM gk k WHERE k.group_key IN (FROM gl) "
    "UNION ALL SELECT u.group_key, NULL, 6, 'Addresses', u.url, u.po, u.ro FROM gurl u WHERE u.group_key IN (FROM gl) "
    "UNION ALL SELECT u.group_key, NULL, 7, 'Document addresses', u.url, u.po, u.ro FROM gpdf u WHERE u.group_key IN (FROM gl) "
    f"UNION ALL SELECT k.group_key, NULL, 9, 'canonical_record_abstract', k.t, min(k.first_ord), 0 FROM (SELECT group_key, first_ord, {_SHOWN_ABSTRACT} AS t FROM gk) k "
    "WHERE k.group_key IN (FROM gl) GROUP BY k.group_key, k.t "
    "UNION ALL SELECT NULL, ord, 8, 'Metadata', unnest(['Crossref published date: 2015-6', 'Crossref venue: Venue ' || lang, 'OpenAlex OA status: green', "
    "'OpenAlex OA URL: https://example.org/oa/' || doc_id]), unnest([0, 0, 1, 1]), unnest([0, 1, 0, 1]) FROM xr "
    "UNION ALL SELECT NULL, ord, 9, CASE p WHEN 2 THEN 'openalex_metadata' ELSE 'datacite_metadata' END, t, p, 0 FROM abst WHERE p > 0 "
    "UNION ALL SELECT NULL, ord, 9, 'citation_snapshot', 'Neither full text nor an abstract has landed; the citation stands for the paper.', 0, 0 "
    "FROM items WHERE ord NOT IN (SELECT ord FROM abst)), "
    "lines_at AS (SELECT i.ord AS item, l.section, l.label, l.t, l.a::HUGEINT * 1000000000000 + l.b AS place FROM items i JOIN places l "
    "ON l.ord = i.ord OR l.group_key = i.gk WHERE l.t <> ''), "
    "bodies AS (SELECT item, section, label, min(place) AS place, CASE WHEN section = 9 THEN string_agg(t, chr(10) || chr(10) ORDER BY place) "
    "ELSE label || ': ' || string_agg(t, ', ' ORDER BY place) END AS body FROM lines_at GROUP BY item, section, label), "
    "texts AS (SELECT item, string_agg(body, chr(10) ORDER BY section, place, label) AS text FROM bodies GROUP BY item)"
)
SQL["snapshot_documents"] = (
    f"WITH {FINAL}, {META}, {_COMPOSED}, own AS (SELECT i.ord AS item, l.* FROM items i JOIN lines_ l ON l.ord = i.ord OR l.group_key = i.gk WHERE l.t <> ''), "
    "by_label AS (SELECT item, section, label, sum(length(t)) + (count(*) - 1) * 2 + CASE WHEN section = 9 THEN 0 ELSE length(label) + 2 END AS chars, "
    f"count(*) AS n, {_LINE_DIGEST} AS digest FROM own GROUP BY item, section, label) "
    "SELECT s.*, md5(x.text) AS text_md5 FROM (SELECT item AS ord, CAST(sum(chars) + count(*) - 1 AS BIGINT) AS chars, CAST(sum(n) AS BIGINT) AS n_lines, CAST(sum(digest) AS BIGINT) AS digest "
    f"FROM by_label WHERE {_MATCHED.replace('ord IN', 'item IN')} GROUP BY item) s JOIN texts x ON x.item = s.ord"
)
SQL["snapshot_pieces"] = (
    f"WITH {FINAL}, {META} SELECT group_key, ord, section, label, CAST(sum(length(t)) + (count(*) - 1) * 2 + CASE WHEN section = 9 THEN 1 ELSE length(label) + 3 END AS BIGINT) AS chars, "
    f"CAST(1 AS BIGINT) AS openings FROM lines_ WHERE t <> '' AND ({_MATCHED} OR {_SHARED}) GROUP BY group_key, ord, section, label"
)
SQL["best_evidence"] = (
    f"WITH {FINAL}, {SNAPSHOTS}, {META}, ok AS (SELECT url FROM judged WHERE bad IS NULL), "
    "r0 AS (SELECT i.ord, first(f.path ORDER BY f.ord) AS u FROM items i JOIN files f ON f.group_key = i.gk GROUP BY 1), "
    f"r1 AS (SELECT i.ord, first(d.url ORDER BY d.po, d.ro) AS u FROM items i JOIN direct d ON d.gk = i.gk AND d.pre = {_PRE.format(d='i.doi')} WHERE d.url IN (SELECT url FROM ok) GROUP BY 1), "
    # Only the looked-up documents can be valid here: no typed link of a page was landed.
    "r2 AS (SELECT ord, min(url) AS u FROM disc WHERE url IN (SELECT url FROM ok) GROUP BY 1), "
    "r4 AS (SELECT ord, min(p) AS p FROM abst GROUP BY 1), "
    "e AS (SELECT i.ord, CASE WHEN r0.u IS NOT NULL THEN 0 WHEN r1.u IS NOT NULL THEN 1 WHEN r2.u IS NOT NULL THEN 2 WHEN s.ord IS NOT NULL THEN 3 ELSE 4 END AS rank, "
    "r0.u AS u0, r1.u AS u1, r2.u AS u2, s.source_url AS u3, s.kind AS k3, CASE r4.p WHEN 0 THEN 'canonical_record_abstract' WHEN 2 THEN 'openalex_metadata' "
    "WHEN 3 THEN 'datacite_metadata' ELSE 'citation_snapshot' END AS k4, i.url FROM items i LEFT JOIN r0 USING (ord) LEFT JOIN r1 USING (ord) LEFT JOIN r2 USING (ord) "
    "LEFT JOIN snap s USING (ord) LEFT JOIN r4 USING (ord)), "
    "o AS (SELECT ord, rank, CASE rank WHEN 0 THEN 'existing_local_pdf' WHEN 1 THEN 'downloaded_pdf' WHEN 2 THEN 'downloaded_pdf' WHEN 3 THEN 'generated_text_snapshot_pdf' ELSE 'generated_metadata_snapshot_pdf' END AS evidence_kind, "
    "CASE rank WHEN 0 THEN u0 WHEN 1 THEN u1 WHEN 2 THEN u2 WHEN 3 THEN u3 ELSE CASE WHEN k4 = 'citation_snapshot' THEN url ELSE k4 END END AS evidence_url, "
    "CASE rank WHEN 3 THEN k3 WHEN 4 THEN k4 END AS snapshot_kind FROM e) "
    "SELECT o.*, 'made from ' || CASE WHEN snapshot_kind IN ('landing_page_text', 'manifest_url', 'doi_landing_page') THEN 'article text' "
    "WHEN snapshot_kind IN ('canonical_record_abstract', 'crossref_metadata', 'openalex_metadata', 'datacite_metadata') THEN 'abstract and metadata' "
    "ELSE 'the citation' END || '; no PDF has landed' AS note "
    ", m.matched_ids, m.first_id, fe.error FROM o JOIN items im USING (ord) "
    "LEFT JOIN (SELECT group_key, count(*) AS matched_ids, first(canonical_id ORDER BY first_ord) AS first_id FROM gk GROUP BY 1) m ON m.group_key = im.gk "
    "LEFT JOIN (SELECT group_key, first(error ORDER BY ord) AS error FROM files GROUP BY 1) fe ON fe.group_key = im.gk "
    f"WHERE {_MATCHED}"
)
SQL["final_markdown"] = (
    f"WITH {DOCS}, {ITEMS} SELECT ord, '**' || title || '**' || chr(10) || 'Authors: ' || array_to_string(authors, ', ') || ' | Member Authors: Team ' || lang "
    "|| chr(10) || url || chr(10) || doi AS block FROM items"
)

# --- texts and pages ------------------------------------------------------------------------------------------

_PIECES = (
    "list_filter(list_transform(string_split_regex(regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script>|<style\\b.*?</style>', '<>', 'g'), '<[^>]*>'), "
    "lambda p : regexp_replace(regexp_replace(p, '^\\s+', ''), '\\s+$', '')), lambda p : p <> '')"
)
_DECODED = (
    # Cut-off pages end in entities without their semicolon, which still count.
    f"regexp_replace(replace(replace(replace(replace(replace(array_to_string({_PIECES}, ' '), '&middot;', '·'), '&copy;', '©'), '&quot;', '\"'), "
    "'&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g')"
)
SQL["page_text"] = f"SELECT page_id, md5({_DECODED}) AS text_md5 FROM pages"
SQL["page_text_expression"] = SQL["page_text"]
_ORIGIN = "regexp_extract(url, '^(https?://[^/?#]*)', 1)"
_FOLDER = "regexp_replace(regexp_replace(url, '[?#].*$', ''), '[^/]*$', '')"
SQL["page_links"] = (
    f"SELECT url, 0 AS pos, {_ORIGIN} || '/downloads/' || page_id || '.pdf' AS link FROM pages UNION ALL "
    f"SELECT url, 1, {_FOLDER} || 'files/' || page_id || '.PDF' FROM pages UNION ALL "
    f"SELECT url, 2, {_ORIGIN} || '/pdf/' || page_id FROM pages"
)
SQL["host_audit"] = (
    "WITH l AS (SELECT lower(regexp_extract(url, '^https?://([^/?#:]*)', 1)) AS host, "
    "CASE page_id % 3 WHEN 0 THEN 'requests' WHEN 1 THEN 'urllib' ELSE 'browser' END AS transport, length(html) % 5 = 0 AS failed FROM pages) "
    "SELECT CASE WHEN grouping(host) = 0 THEN 'host' WHEN grouping(transport) = 0 THEN 'transport' ELSE 'total' END AS level, "
    "coalesce(host, transport, '*') AS name, count(*) AS attempts, count(*) FILTER (WHERE failed) AS errors, CAST(0 AS BIGINT) AS direct_attempts "
    "FROM l GROUP BY GROUPING SETS ((host), (transport), ())"
)
SQL["usable_text"] = f"SELECT doc_id, {_USABLE.format(w=ws('text'))} AS usable FROM documents"
SQL["chunk_text"] = (
    f"WITH RECURSIVE t AS (SELECT doc_id, list_filter(string_split({ws('text')}, ' '), lambda x : x <> '') AS w FROM documents), "
    "u AS (SELECT doc_id, generate_subscripts(w, 1) AS i, length(unnest(w)) + 1 AS n FROM t), "
    "c AS (SELECT doc_id, list(cum ORDER BY i) AS cs FROM (SELECT doc_id, i, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS cum FROM u) GROUP BY doc_id), "
    "r AS (SELECT doc_id, 1 AS s, 0 AS n, greatest(len(list_filter(cs, lambda x : x <= 1501)), 1) AS e, cs FROM c "
    "UNION ALL SELECT doc_id, e + 1, n + 1, greatest(len(list_filter(cs, lambda x : x <= cs[e] + 1501)), e + 1), cs FROM r WHERE e < len(cs)) "
    "SELECT r.doc_id, CAST(n AS BIGINT) AS n, md5(array_to_string(list_slice(t.w, s, e), ' ')) AS chunk_md5 FROM r JOIN t USING (doc_id)"
)
SQL["inverted_index_decode"] = f"SELECT doc_id, md5({ws('text')}) AS text_md5 FROM documents"
# People have two names of at least five characters together; the heading "The Team" is no person.
_CAP = "upper(split_part(a, ' ', 1)[1]) || lower(substr(split_part(a, ' ', 1), 2)) || ' ' || upper(split_part(a, ' ', 2)[1]) || lower(substr(split_part(a, ' ', 2), 2))"
SQL["team_roster"] = (
    f"WITH {RECORDS}, n AS (SELECT ord, unnest(authors) AS a, generate_subscripts(authors, 1) AS pos FROM records WHERE len(authors) > 0), "
    f"c AS (SELECT ord, pos, a, {_CAP} AS name FROM n) "
    "SELECT ord AS page_id, CASE WHEN ord % 2 = 0 THEN 0 ELSE 4 END AS tier, name, '/p/' || md5(a) AS profile_url FROM c "
    "WHERE length(name) BETWEEN 5 AND 80 AND NOT regexp_matches(lower(name), 'team|faculty|students|postdocs|news|events|contact|opportunities|institute|research|materials') "
    "QUALIFY row_number() OVER (PARTITION BY ord, lower(replace(name, ' ', '')) ORDER BY pos) = 1"
)
SQL["unique_names"] = (
    "WITH s AS (SELECT replace(p_name, ' ', '_') AS stem, p_partkey AS ord FROM part), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY ord) AS rn FROM s) "
    "SELECT stem, ord, CASE WHEN rn = 1 THEN stem ELSE stem || '_' || rn END AS name FROM r"
)

# --- reports --------------------------------------------------------------------------------------------------

HEALTH = "health AS (SELECT source FROM records GROUP BY source HAVING avg(length(abstract)) > 1500)"
_NAMES = "names AS (SELECT unnest(" + _ORDER + ") AS source, generate_subscripts(" + _ORDER + ", 1) - 1 AS source_rank)"
SQL["source_counts"] = (
    f"WITH {RECORDS}, {HEALTH}, {_NAMES} SELECT n.source, (SELECT count(*) FROM records r WHERE r.source = n.source AND r.source NOT IN (SELECT source FROM health)) AS records, "
    "(SELECT count(*) FROM health h WHERE h.source = n.source) AS errors FROM names n"
)
SQL["active_sources"] = (
    f"WITH {RECORDS}, {HEALTH}, {_NAMES} SELECT source, CAST(source_rank AS BIGINT) AS source_rank, "
    "CASE WHEN source IN (SELECT source FROM health) THEN 'skipped: HTTP 503' ELSE 'ok' END AS probe, source NOT IN (SELECT source FROM health) AS active FROM names"
)
SQL["records_sorted_top100"] = (
    f"WITH {PAPERS} SELECT canonical_id, title, year FROM papers ORDER BY coalesce(year, 0) DESC, lower(title) DESC, first_ord LIMIT 100"
)
SQL["award_split"] = (
    f"WITH {SCAN} SELECT p.year, o.award_mentioned_in_document AS award, count(*) AS papers FROM papers p JOIN outcome o USING (canonical_id) GROUP BY 1, 2"
)
_LISTS = (
    "lists AS (SELECT canonical_id, array_to_string(list(member_name ORDER BY o), '|') AS members FROM (SELECT canonical_id, member_name, min(ord) AS o FROM keyed GROUP BY 1, 2) GROUP BY 1), "
    "srcs AS (SELECT canonical_id, array_to_string(list(source ORDER BY o), '|') AS sources FROM (SELECT canonical_id, source, min(ord) AS o FROM keyed GROUP BY 1, 2) GROUP BY 1)"
)
SQL["award_summary"] = (
    f"WITH {SCAN}, {_LISTS} SELECT canonical_id, document_award_mentions AS award_mentions, members, sources, document_verification_kind, "
    "document_pdf_url IS NOT NULL AS pdfa_conversion_ok FROM outcome JOIN lists USING (canonical_id) JOIN srcs USING (canonical_id) WHERE award_mentioned_in_document"
)
SQL["status_backfill"] = (
    f"WITH {RECORDS}, {_ALL}, {_SOME} SELECT a.canonical_id, CASE WHEN s.canonical_id IS NULL THEN '/old/' || a.first_ord ELSE '/new/' || s.first_ord END AS document_pdf_local_path, "
    "CASE WHEN s.canonical_id IS NULL THEN 'u' END AS document_pdf_url, '/a/' || s.first_ord AS document_pdfa_path, CASE WHEN s.canonical_id IS NULL THEN 'old' END AS document_pdfa_error, "
    "s.canonical_id IS NOT NULL AS pdfa_conversion_ok FROM p_all a LEFT JOIN p_some s USING (canonical_id)"
)
_COUNT_MAP = (
    "(SELECT string_agg(source || '=' || c, ',' ORDER BY source) FROM (SELECT n.source, (SELECT count(*) FROM records r WHERE r.source = n.source) AS c FROM names n))"
)
_EXTRA = f"{_ALL}, {_SOME}, {DIFF.split(f'{_SOME}, ', 1)[1]}"
SQL["run_summary"] = (
    f"WITH {SCAN}, {_EXTRA}, {_NAMES} SELECT 't0' AS run_started_at, CAST(2 AS BIGINT) AS lookback_years, (SELECT count(*) FROM records) AS raw_record_count, "
    "(SELECT count(*) FROM papers) AS canonical_paper_count, (SELECT count(*) FROM diff WHERE status = 'new') AS new_count, "
    "(SELECT count(*) FROM diff WHERE status = 'changed') AS changed_count, (SELECT count(*) FROM diff WHERE status = 'unchanged') AS unchanged_count, "
    "(SELECT count(*) FROM outcome) AS papers_total, (SELECT count(*) FROM outcome WHERE status = 'mention') AS mentions_count, "
    f"{_COUNT_MAP} AS source_record_counts"
)
_C = "(SELECT count(*) FROM {t})"
SQL["run_report"] = (
    f"WITH {SCAN}, {_EXTRA}, {HEALTH}, {_NAMES}, {_LISTS}, "
    "aw AS (SELECT p.*, o.document_award_mentions AS mentions FROM papers p JOIN outcome o USING (canonical_id) WHERE o.award_mentioned_in_document), "
    "rk AS (SELECT *, row_number() OVER (ORDER BY coalesce(year, 0) DESC, lower(title) DESC, first_ord) AS rn FROM aw), "
    "h AS (SELECT ['# Run', '', 'Finished: t1', '', '## Summary', '- Members: 4', '- Years looked back: 2', "
    "'- Against the run before: new=' || (SELECT count(*) FROM diff WHERE status = 'new') || ', changed=' || (SELECT count(*) FROM diff WHERE status = 'changed') || ', unchanged=' || (SELECT count(*) FROM diff WHERE status = 'unchanged'), "
    "'- Source records: ' || (SELECT count(*) FROM records), '- Merged papers: ' || (SELECT count(*) FROM papers), "
    "'- Papers with a mention: ' || (SELECT count(*) FROM aw), '- Scanned: papers=' || (SELECT count(*) FROM outcome) || ', mentions=' || (SELECT count(*) FROM outcome WHERE status = 'mention') || "
    "', no_pdf=' || (SELECT count(*) FROM outcome WHERE status = 'no_pdf') || ', download_fail=' || (SELECT count(*) FROM outcome WHERE status = 'download_fail') || ', extract_fail=' || "
    "(SELECT count(*) FROM outcome WHERE status = 'extract_fail'), NULL, '', '## By source'] AS l) "
    "SELECT section, CAST(line_no AS BIGINT) AS line_no, line FROM ("
    "SELECT 0 AS section, generate_subscripts(l, 1) - 1 AS line_no, unnest(l) AS line FROM h "
    "UNION ALL SELECT 1, row_number() OVER (ORDER BY n.source), '- ' || n.source || ': ' || (SELECT count(*) FROM records r WHERE r.source = n.source) || ' records (' || "
    "(SELECT count(*) FROM health x WHERE x.source = n.source) || ' errors), probe ' || CASE WHEN n.source IN (SELECT source FROM health) THEN 'skipped: HTTP 503' ELSE 'ok' END FROM names n "
    "UNION ALL SELECT 2, 0, '' UNION ALL SELECT 2, 1, '## Papers with a mention' "
    "UNION ALL SELECT 3, rn, '- **' || title || '** (' || coalesce(CAST(year AS VARCHAR), 'n/a') || ', ' || coalesce(venue, 'no venue') || ') | member(s): ' || replace(members, '|', ', ') || "
    "' | mention(s): ' || replace(mentions, '|', ', ') FROM rk JOIN lists USING (canonical_id) WHERE rn <= 100) WHERE line IS NOT NULL"
)

# --- streams --------------------------------------------------------------------------------------------------

# The second micro-batch holds every record, so every paper is touched by it.
SQL["state_upsert_stream"] = (
    f"WITH {DIFF} SELECT canonical_id, status, CASE WHEN status = 'new' THEN 'batch-1' ELSE 'batch-0' END AS first_seen_at, "
    "'batch-1' AS last_seen_at FROM diff"
)
SQL["event_first_seen_stream"] = "SELECT DISTINCT user_id || '-' || event_type AS key FROM events"

# --- links of full texts, publication rows --------------------------------------------------------------------

SQL["fulltext_links"] = (
    "WITH p AS (SELECT doc_id, 'https://pmc.ncbi.nlm.nih.gov/articles/PMC' || doc_id AS base FROM documents WHERE n_chars % 2 = 0), "
    "l AS (SELECT doc_id, [base || '/bin/f' || doc_id || '.pdf', 'https://e.org/' || doc_id || '.PDF?x', base || '/pdf/'] AS urls FROM p) "
    "SELECT 'p' || doc_id AS canonical_id, unnest(urls) AS url, CAST(generate_subscripts(urls, 1) - 1 AS BIGINT) AS pos FROM l"
)
SQL["publication_merge"] = (
    f"WITH {RECORDS}, p AS (SELECT r.*, md5(d.line1) AS paper_id FROM records r JOIN docs d ON d.doc_id = r.ord), "
    "s AS (SELECT paper_id, first(doi ORDER BY ord) FILTER (WHERE doi <> '') AS doi, first(source_id ORDER BY ord) AS dblp_key, "
    "first(landing_page_url ORDER BY ord) AS dblp_record_url FROM p GROUP BY 1), "
    "v AS (SELECT paper_id, ord, 'source_pids' AS field, 0 AS pos, source AS value FROM p UNION ALL SELECT paper_id, ord, 'members', 0, member_name FROM p "
    "UNION ALL SELECT paper_id, ord, 'ee_urls', 0, landing_page_url FROM p UNION ALL SELECT paper_id, ord, 'ee_urls', 1, pdf_url FROM p WHERE pdf_url IS NOT NULL) "
    "SELECT paper_id, field, value, min(ord) AS first_ord, CAST(first(pos ORDER BY ord, pos) AS BIGINT) AS first_pos, "
    "first(doi) AS doi, first(dblp_key) AS dblp_key, first(dblp_record_url) AS dblp_record_url FROM v JOIN s USING (paper_id) GROUP BY paper_id, field, value"
)

# --- many numbers in one scan -----------------------------------------------------------------------------------

_GAP = "[\\s\\x1c-\\x1f\\-_./,:;]*"
SQL["award_number_table"] = (
    "WITH n AS (SELECT CAST(p_partkey AS VARCHAR) AS number FROM part WHERE p_partkey >= 100), "
    "d AS (SELECT doc_id, text, regexp_extract_all(text, '[\\pL\\pN_]+') AS words, regexp_replace(lower(text), '[^\\pL\\pN]', '', 'g') AS folded FROM documents WHERE regexp_matches(text, '[0-9]')), "
    "m AS (SELECT * FROM d JOIN n ON contains(folded, number)), "
    f"r AS (SELECT doc_id, number, unnest([{{'rule': 'exact_number', 'n': len(list_filter(words, lambda w : w = number))}}, "
    f"{{'rule': 'separated_number', 'n': len(regexp_extract_all(text, array_to_string(string_split(number, ''), '{_GAP}')))}}, "
    "{'rule': 'collapsed_number', 'n': 1}]) AS r FROM m) "
    "SELECT doc_id, number, r.rule AS rule, CAST(r.n AS BIGINT) AS mentions FROM r WHERE r.n > 0"
)

# --- files and outputs ------------------------------------------------------------------------------------------

SQL["lookback_window"] = f"WITH {RECORDS} SELECT ord, CAST(year AS BIGINT) AS year FROM records WHERE year IS NULL OR year >= 2012"
SQL["limited_roster"] = f"SELECT page_id, name FROM ({SQL['team_roster'].replace('AS profile_url FROM c', 'AS profile_url, pos FROM c')}) ORDER BY page_id, tier, pos LIMIT 100"
SQL["partitioned_records"] = f"WITH {RECORDS} SELECT source, count(*) AS records, min(ord) AS first_ord, count(doi) AS with_doi FROM records GROUP BY source"
SQL["json_papers"] = (
    f"WITH {RECORDS} SELECT canonical_id, first(title ORDER BY length(title) DESC, ord) AS title, CAST(min(year) AS BIGINT) AS year, "
    "first(venue ORDER BY ord) FILTER (WHERE venue <> '') AS venue, first(doi ORDER BY ord) FILTER (WHERE doi <> '') AS doi, "
    "md5(first(abstract ORDER BY length(abstract) DESC, ord) FILTER (WHERE abstract <> '')) AS abstract_md5 FROM keyed GROUP BY canonical_id"
)
SQL["accepted_additions"] = (
    f"WITH {CURATION} SELECT CASE WHEN accepted THEN 'accepted_additions' ELSE 'rejected_candidates' END AS output, ord, doi FROM reviewed "
    "UNION ALL SELECT 'portal_manifest', ord, doi FROM portal"
)
SQL["published_papers"] = (
    f"WITH {RECORDS} SELECT DISTINCT canonical_id, 'latest' AS run FROM keyed UNION ALL "
    "SELECT DISTINCT canonical_id, 'before' FROM keyed WHERE ord IN (SELECT doc_id FROM labels)"
)
SQL["prior_state"] = (
    f"WITH {RECORDS}, {_ALL} SELECT canonical_id, title, array_to_string(sources, '|') AS sources, 'run-0' AS last_output_dir FROM p_all WHERE regexp_matches(title, '^[A-M]')"
)
SQL["manifest_files"] = (
    f"WITH {RECORDS}, m AS (SELECT trim(regexp_replace(title, '\\.+$', '')) AS title, coalesce(landing_page_url, '') AS url, coalesce(doi, '') AS doi, len(authors) AS n FROM records) "
    "SELECT title, url, doi, title <> '' AND url <> '' AND doi <> '' AND n > 0 AS valid, count(*) AS rows FROM m GROUP BY ALL"
)
SQL["publication_links"] = f"WITH {RECORDS} SELECT ord, coalesce(pdf_url || '.pdf', '') AS urls FROM records"
SQL["service_addresses"] = (
    "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'http://' || regexp_replace(url, '^https?://', '') ELSE url END AS address FROM pages"
)
