"""Bibliographic tables derived from the generic test tables, so that checked queries grow with them.

Titles are the first lines of the documents, which repeat, so that merging has real work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions.bind import once
from citeloom.operators.order import first_per_key
from citeloom.schemas import SOURCE_ORDER



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the generic test tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_ORDER_SQL = "array(" + ", ".join(f"'{s}'" for s in SOURCE_ORDER) + ")"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their first line, its first six words and the rest of the text."""
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        "lang",
        "source AS origin",
        "n_chars",
        "text",
        r"substring_index(text, '\n', 1) AS line1",
        r"regexp_extract_all(regexp_extract(substring_index(text, '\n', 1), '^(?:[^A-Za-z]*[A-Za-z]+){0,6}', 0), '[A-Za-z]+', 0) AS w",
        r"nullif(substr(text, length(substring_index(text, '\n', 1)) + 2), '') AS rest",
    )


_AUTHORS = (
    "filter(array(get(w,0) || ' ' || get(w,1), get(w,2) || ' ' || get(w,3), get(w,4) || ' ' || get(w,5)), "
    "x -> x IS NOT NULL)"
)
_YEAR = "CASE WHEN n_chars % 7 = 0 THEN NULL ELSE 2000 + n_chars % 25 END"


def source_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents read as source records; ``ord`` is the document id."""
    return documents(spark, sf_dir).selectExpr(
        "doc_id AS ord",
        f"get({_ORDER_SQL}, cast(substr(origin, 4) AS int) % 12) AS source",
        "concat('rec-', doc_id) AS source_id",
        "concat('Team ', lang) AS member_name",
        "line1 AS title",
        f"cast({_YEAR} AS int) AS year",
        f"cast({_YEAR} AS string) || '-' || lpad(cast(1 + n_chars % 12 AS string), 2, '0') || '-01' AS published_date",
        "CASE WHEN n_chars % 4 <> 0 THEN concat('Venue ', lang) END AS venue",
        "CASE WHEN n_chars % 3 = 0 THEN concat('10.5555/', "
        "CASE WHEN doc_id % 2 = 0 THEN upper(substr(md5(line1), 1, 10)) ELSE substr(md5(line1), 1, 10) END) END AS doi",
        f"{_AUTHORS} AS authors",
        "rest AS abstract",
        "CASE WHEN n_chars % 8 = 0 THEN concat('https://pmc.ncbi.nlm.nih.gov/articles/PMC', length(line1) * 1000 + n_chars % 1000, '/') "
        "ELSE concat('https://example.org/', origin, '/', substr(md5(line1), 1, 6)) END AS landing_page_url",
        "CASE WHEN n_chars % 5 = 0 THEN concat('https://arxiv.org/pdf/', lpad(cast(length(line1) % 10000 AS string), 4, '0'), "
        "'.', lpad(cast(n_chars % 100000 AS string), 5, '0')) END AS pdf_url",
        "round(n_chars % 100 / 100.0D, 2) AS relevance_score",
    )


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A roster: every distinct capitalised pair of first words, ``(name)``."""
    return (
        documents(spark, sf_dir)
        .selectExpr("get(w,0) || ' ' || initcap(get(w,1)) AS name")
        .filter("name IS NOT NULL")
        .distinct()
    )


def labelled_records(spark: SparkSession, sf_dir: str, records: DataFrame | None = None) -> DataFrame:
    """Records of the labelled documents: an earlier, smaller collection of the same papers. ``records`` are written ones."""
    labels = table(spark, sf_dir, "labels").selectExpr("doc_id AS ord")
    return (source_records(spark, sf_dir) if records is None else records).join(labels, "ord", "left_semi")


def fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses by address: documents of the PDF links, landing pages, and full-text XML of PMC ids.

    The first document of an address gives its text.
    """
    recs = source_records(spark, sf_dir).selectExpr("ord", "pdf_url", "landing_page_url").join(
        documents(spark, sf_dir).selectExpr("doc_id AS ord", "n_chars", "text"), "ord"
    )
    rows = recs.selectExpr(
        "ord", "n_chars", "text",
        "explode(array("
        "named_struct('kind', 'pdf', 'url', pdf_url), named_struct('kind', 'page', 'url', landing_page_url), "
        "named_struct('kind', 'pdf', 'url', CASE WHEN n_chars % 3 = 0 THEN concat('https://example.org/cr/', ord, '/pdf') END), "
        "named_struct('kind', 'xml', 'url', CASE WHEN landing_page_url LIKE '%/PMC%' THEN concat("
        "'https://www.ebi.ac.uk/europepmc/webservices/rest/', regexp_extract(landing_page_url, 'PMC[0-9]+', 0), '/fullTextXML') END))) AS e",
    ).selectExpr("ord", "n_chars", "text", "e.kind", "e.url").filter("url IS NOT NULL")
    return first_per_key(rows, ["url"], ["ord"]).selectExpr(
        "url",
        "CASE WHEN kind = 'page' THEN concat(url, '?final') END AS final_url",
        "CASE WHEN n_chars % 11 = 0 THEN 404 ELSE 200 END AS status_code",
        "CASE WHEN kind = 'xml' THEN 'application/xml' WHEN kind = 'page' OR n_chars % 3 = 0 THEN 'text/html' "
        "ELSE 'application/pdf' END AS content_type",
        "CASE WHEN kind = 'pdf' AND n_chars % 3 <> 0 THEN '%PDF-1.7' WHEN kind = 'pdf' THEN '<html>Preparing to download</html>' "
        f"ELSE concat('<link type=\"application/pdf\" href=\"/dl/', ord, '\"/><article><p>', {_xml('text')}, '</p></article>') END AS body",
        "CASE WHEN n_chars % 19 = 0 THEN 'read timed out' END AS error",
        "CASE WHEN kind = 'pdf' AND n_chars % 4 <> 0 THEN text END AS document_text",
    )


def doi_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Looked-up works by DOI from three services, one per distinct DOI."""
    docs = documents(spark, sf_dir).filter("n_chars % 3 = 0").selectExpr(
        "concat('10.5555/', substr(md5(line1), 1, 10)) AS doi", "doc_id", "n_chars", "line1", "lang"
    )
    one = first_per_key(docs, ["doi"], ["doc_id"])
    return one.selectExpr(
        "doi",
        "explode(array("
        "named_struct('provider', 'openalex', 'payload', to_json(named_struct('open_access', named_struct('oa_status', 'green', "
        "'oa_url', concat('https://example.org/oa/', doc_id)), 'best_oa_location', named_struct('pdf_url', "
        "CASE WHEN n_chars % 2 = 0 THEN concat('https://example.org/pdf/', doc_id, '?v=1') END, 'landing_page_url', concat('https://doi.org/', doi)), "
        "'primary_location', named_struct('landing_page_url', concat('https://arxiv.org/abs/2101.', lpad(cast(doc_id % 100000 AS string), 5, '0'), 'v2')), "
        "'abstract_inverted_index', map('looked', array(0), 'up', array(1), lang, array(2))))), "
        "named_struct('provider', 'crossref', 'payload', to_json(named_struct('container-title', array(concat('Venue ', lang)), "
        "'published-print', named_struct('date-parts', array(array(2015, 6))), 'link', array(named_struct('URL', concat('https://example.org/cr/', doc_id, '/pdf'), "
        "'content-type', 'unspecified'), named_struct('URL', concat('https://example.org/cr/', doc_id), 'content-type', 'text/html'))))), "
        "named_struct('provider', 'datacite', 'payload', to_json(named_struct('attributes', named_struct('descriptions', array("
        "named_struct('description', 'A looked-up note', 'descriptionType', 'Abstract'))))))"
        ")) AS e",
    ).selectExpr("doi", "e.provider", "e.payload")


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest items: the labelled documents that have a title."""
    labels = table(spark, sf_dir, "labels").select("doc_id")
    return (
        documents(spark, sf_dir).join(labels, "doc_id", "left_semi")
        .selectExpr(
            "doc_id AS ord", "line1 AS title", f"{_AUTHORS} AS authors", "array(concat('Team ', lang)) AS member_authors",
            "concat('https://example.org/item/', doc_id) AS url",
            "concat(CASE WHEN n_chars % 2 = 0 THEN '10.1101/' ELSE '10.5555/' END, substr(md5(line1), 1, 10)) AS doi",
        )
        .filter("trim(title) <> '' AND size(authors) > 0")
    )


# --- landed payloads ------------------------------------------------------------------------------------------

# Every document becomes one landed page with one item. Its member is its first author, or a fixed name
# that the author filter mostly rejects.
_MEMBER = "CASE WHEN n_chars % 2 = 0 THEN get(w,0) || ' ' || get(w,1) ELSE 'The And' END"
_DOI = (
    "CASE WHEN n_chars % 3 = 0 THEN concat('https://doi.org/10.5555/', substr(md5(line1), 1, 10), '.') END"
)


def _landing(docs: DataFrame, source: str, payload: str) -> DataFrame:
    """Payloads are made once: filters of later steps would repeat their making, were they not held by ``once``."""
    made = once(docs, ["doc_id"], member_name=F.expr(_MEMBER), payload=F.expr(payload))
    return made.selectExpr(
        f"'{source}' AS source", "member_name", "cast(0 AS bigint) AS page_no", "doc_id AS row_no", "payload",
    ).filter("member_name IS NOT NULL")


def landed_openalex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landing(
        documents(spark, sf_dir), "openalex",
        "to_json(named_struct('results', array(named_struct('id', concat('https://openalex.org/W', doc_id), "
        f"'display_name', line1, 'publication_year', {_YEAR}, 'doi', {_DOI}, 'type', 'article', "
        f"'authorships', transform({_AUTHORS}, a -> named_struct('author', named_struct('display_name', a))), "
        "'primary_location', named_struct('pdf_url', CASE WHEN n_chars % 5 = 0 THEN concat('https://example.org/', doc_id, '.pdf') END, "
        "'landing_page_url', concat('https://example.org/', doc_id), 'source', named_struct('display_name', concat('Venue ', lang)))))))",
    )


def landed_semantic_scholar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landing(
        documents(spark, sf_dir), "semantic_scholar",
        f"to_json(named_struct('data', array(named_struct('paperId', CASE WHEN n_chars % 6 <> 0 THEN concat('s', doc_id) END, 'title', line1, 'year', {_YEAR}, "
        f"'venue', '', 'publicationDate', cast({_YEAR} AS string) || '-02-03', "
        f"'authors', transform({_AUTHORS}, a -> named_struct('name', a)), 'externalIds', named_struct('DOI', {_DOI}), "
        "'url', concat('https://example.org/', doc_id), 'openAccessPdf', named_struct('url', concat('https://example.org/', doc_id, '.pdf')), "
        "'abstract', rest))))",
    )


def landed_crossref(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landing(
        documents(spark, sf_dir), "crossref",
        "to_json(named_struct('message', named_struct('items', array(named_struct("
        f"'DOI', {_DOI}, 'title', array(line1), 'abstract', concat('<jats:p>', text, '</jats:p>'), "
        "'URL', concat('https://example.org/', doc_id), "
        f"'author', transform({_AUTHORS}, a -> named_struct('given', substring_index(a, ' ', 1), 'family', substring_index(a, ' ', -1))), "
        "'container-title', array(concat('Venue ', lang)), "
        f"'issued', CASE WHEN n_chars % 7 <> 0 THEN named_struct('date-parts', array(array(cast({_YEAR} AS int), cast(1 + n_chars % 12 AS int)))) END, "
        "'link', array(named_struct('URL', concat('https://example.org/', doc_id, '/file'), "
        "'content-type', CASE WHEN n_chars % 5 = 0 THEN 'application/pdf' ELSE 'text/html' END)))))))",
    )


def landed_datacite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landing(
        documents(spark, sf_dir), "datacite",
        "to_json(named_struct('data', array(named_struct('id', concat('dc', doc_id), 'attributes', named_struct("
        f"'doi', {_DOI}, 'url', CASE WHEN n_chars % 4 = 0 THEN concat('https://example.org/', doc_id) END, "
        f"'publisher', concat('Venue ', lang), 'published', CASE WHEN n_chars % 2 = 0 THEN cast({_YEAR} AS string) || '-05-06' END, "
        f"'publicationYear', {_YEAR}, 'titles', array(named_struct('title', ' '), named_struct('title', line1)), "
        f"'creators', transform({_AUTHORS}, a -> named_struct('givenName', substring_index(a, ' ', 1), 'familyName', substring_index(a, ' ', -1))), "
        "'descriptions', array(named_struct('description', rest)), "
        "'contentUrl', array(concat('https://example.org/', doc_id), concat('https://example.org/pdf/', doc_id)))))))",
    )


def landed_europe_pmc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landing(
        documents(spark, sf_dir), "europe_pmc",
        "to_json(named_struct('resultList', named_struct('result', array(named_struct('id', cast(doc_id AS string), 'source', 'MED', "
        f"'pmid', CASE WHEN n_chars % 2 = 0 THEN cast(doc_id AS string) END, 'pmcid', CASE WHEN n_chars % 5 = 0 THEN concat('PMC', doc_id) END, "
        f"'doi', {_DOI}, 'title', line1, 'authorString', array_join({_AUTHORS}, ', '), "
        f"'journalTitle', CASE WHEN n_chars % 4 <> 0 THEN concat('Venue ', lang) END, 'pubYear', cast({_YEAR} AS string), "
        "'abstractText', rest, 'electronicPublicationDate', CASE WHEN n_chars % 2 = 1 THEN '2011-07-08' END, "
        "'fullTextUrlList', CASE WHEN n_chars % 10 = 0 THEN named_struct('fullTextUrl', array("
        "named_struct('url', concat('https://example.org/', doc_id), 'documentStyle', 'html'), "
        "named_struct('url', concat('https://example.org/f/', doc_id), 'documentStyle', 'pdf'))) END)))))",
    )


def landed_doaj(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landing(
        documents(spark, sf_dir), "doaj",
        "to_json(named_struct('results', array(named_struct('id', concat('dj', doc_id), 'bibjson', named_struct("
        f"'title', line1, 'year', {_YEAR}, 'last_updated', '2010-11-12T00:00:00Z', 'abstract', rest, "
        f"'author', transform({_AUTHORS}, a -> named_struct('name', a)), "
        f"'identifier', array(named_struct('type', 'issn', 'id', '1234-5678'), named_struct('type', 'DOI', 'id', {_DOI})), "
        "'link', array(named_struct('url', concat('https://example.org/', doc_id)), "
        "named_struct('url', concat('https://arxiv.org/abs/2001.', lpad(cast(n_chars % 100000 AS string), 5, '0'), 'v2'))), "
        "'journal', named_struct('title', concat('Venue ', lang)))))))",
    )


def landed_inspirehep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landing(
        documents(spark, sf_dir), "inspirehep",
        "to_json(named_struct('hits', named_struct('hits', array(named_struct('metadata', named_struct("
        "'control_number', doc_id, 'titles', array(named_struct('title', line1)), "
        "'earliest_date', CASE WHEN n_chars % 2 = 0 THEN '2012-03-04' END, "
        f"'publication_info', array(named_struct('year', {_YEAR}, 'conference_title', concat('Venue ', lang))), "
        f"'authors', transform({_AUTHORS}, a -> named_struct('full_name', concat(substring_index(a, ' ', -1), ', ', substring_index(a, ' ', 1)))), "
        f"'abstracts', array(named_struct('value', rest)), 'dois', array(named_struct('value', {_DOI})), "
        "'arxiv_eprints', array(named_struct('value', concat('2001.', lpad(cast(n_chars % 100000 AS string), 5, '0'))))))))))",
    )


def landed_scholar_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landing(
        documents(spark, sf_dir), "google_scholar",
        "to_json(named_struct('organic_results', array(named_struct('title', line1, 'link', concat('https://example.org/', doc_id), "
        "'snippet', rest, 'publication_info', named_struct('summary', "
        f"concat(array_join({_AUTHORS}, ', '), ' - Venue ', lang, ', ', coalesce(cast({_YEAR} AS string), 'n.d.'), ' - example.org'), "
        f"'authors', transform({_AUTHORS}, a -> named_struct('name', a))), "
        "'resources', array(named_struct('link', concat('https://example.org/', doc_id, CASE WHEN n_chars % 5 = 0 THEN '.pdf' ELSE '.htm' END)))))))",
    )


def _xml(expr: str) -> str:
    """Escape a text for XML; one search tells the texts that have nothing to escape."""
    return f"CASE WHEN {expr} RLIKE '[&<>]' THEN replace(replace(replace({expr}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') ELSE {expr} END"


def landed_scholar_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landing(
        documents(spark, sf_dir), "google_scholar",
        "concat('<html><body><div class=\"gs_r\"><div class=\"gs_ri\"><h3 class=\"gs_rt\"><span>[PDF]</span> <a href=\"https://example.org/', "
        f"doc_id, '\">', {_xml('line1')}, '</a></h3><div class=\"gs_a\">', array_join({_AUTHORS}, ', '), ' - Venue ', lang, ', ', "
        f"coalesce(cast({_YEAR} AS string), 'n.d.'), ' - example.org</div><div class=\"gs_rs\">', {_xml('text')}, '</div></div></div></body></html>')",
    )


def landed_dblp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landing(
        documents(spark, sf_dir), "dblp",
        "concat('<?xml version=\"1.0\"?><dblpperson><r><', CASE WHEN n_chars % 2 = 0 THEN 'article' ELSE 'inproceedings' END, "
        f"' key=\"k/', doc_id, '\">', array_join(transform({_AUTHORS}, a -> concat('<author>', a, '</author>')), ''), "
        f"'<title>', {_xml('line1')}, ' <i>et</i> al</title>', coalesce(concat('<year>', {_YEAR}, '</year>'), ''), "
        "CASE WHEN n_chars % 2 = 0 THEN concat('<journal>Venue ', lang, '</journal>') ELSE concat('<booktitle>Book ', lang, '</booktitle>') END, "
        f"coalesce(concat('<ee>', {_DOI}, '</ee>'), ''), '<ee>https://example.org/', doc_id, '.pdf</ee><url>rec/', doc_id, '</url></', "
        "CASE WHEN n_chars % 2 = 0 THEN 'article' ELSE 'inproceedings' END, '></r></dblpperson>')",
    )


def landed_arxiv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landing(
        documents(spark, sf_dir), "arxiv",
        "concat('<feed xmlns=\"http://www.w3.org/2005/Atom\" xmlns:arxiv=\"http://arxiv.org/schemas/atom\"><entry>"
        "<id>http://arxiv.org/abs/2001.', lpad(cast(n_chars % 100000 AS string), 5, '0'), 'v3</id><title>', "
        f"{_xml('line1')}, '</title>', coalesce(concat('<published>', {_YEAR}, '-09-10T00:00:00Z</published>'), ''), "
        f"'<summary>', {_xml('coalesce(rest, line1)')}, '</summary>', "
        f"array_join(transform({_AUTHORS}, a -> concat('<author><name>', a, '</name></author>')), ''), "
        f"coalesce(concat('<arxiv:doi>', {_DOI}, '</arxiv:doi>'), ''), "
        "CASE WHEN n_chars % 5 = 0 THEN concat('<link title=\"pdf\" href=\"https://example.org/', doc_id, '.pdf\" rel=\"related\"/>') ELSE '' END, "
        "'</entry></feed>')",
    )


def landed_pubmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landing(
        documents(spark, sf_dir), "pubmed",
        "concat('<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>', doc_id, '</PMID><Article><Journal><JournalIssue><PubDate>', "
        f"coalesce(concat('<Year>', {_YEAR}, '</Year>'), '<MedlineDate>2013 Spring</MedlineDate>'), '<Month>Mar</Month><Day>7</Day></PubDate></JournalIssue><Title>Venue ', lang, "
        f"'</Title></Journal><ArticleTitle>', {_xml('line1')}, ' <sub>2</sub></ArticleTitle><Abstract>"
        f"<AbstractText Label=\"AIM\">', {_xml('line1')}, '</AbstractText><AbstractText>', {_xml('coalesce(rest, line1)')}, '</AbstractText></Abstract><AuthorList>', "
        f"array_join(transform({_AUTHORS}, a -> concat('<Author><LastName>', substring_index(a, ' ', -1), '</LastName><ForeName>', substring_index(a, ' ', 1), '</ForeName></Author>')), ''), "
        "'</AuthorList></Article></MedlineCitation><PubmedData><ArticleIdList><ArticleId IdType=\"pubmed\">', doc_id, '</ArticleId>', "
        f"coalesce(concat('<ArticleId IdType=\"doi\">', {_DOI}, '</ArticleId>'), ''), "
        "CASE WHEN n_chars % 5 = 0 THEN concat('<ArticleId IdType=\"pmc\">PMC', doc_id, '</ArticleId>') ELSE '' END, "
        "'</ArticleIdList></PubmedData></PubmedArticle></PubmedArticleSet>')",
    )


def landed_openaire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landing(
        documents(spark, sf_dir), "openaire",
        "concat('<response><header><totalPages>1</totalPages></header><results><result><metadata><oaf:entity xmlns:oaf=\"http://namespace.openaire.eu/oaf\"><oaf:result>"
        f"<title>', {_xml('line1')}, '</title>', array_join(transform({_AUTHORS}, a -> concat('<creator>', a, '</creator>')), ''), "
        f"coalesce(concat('<dateofacceptance>', {_YEAR}, '-06-07</dateofacceptance>'), ''), "
        "CASE WHEN n_chars % 4 <> 0 THEN concat('<journal>Venue ', lang, '</journal>') ELSE '' END, "
        f"coalesce(concat('<pid>', {_DOI}, '</pid>'), ''), '<children><url>https://example.org/', doc_id, '</url><url>https://example.org/', doc_id, '.pdf</url></children>"
        f"<description>', {_xml('text')}, '</description></oaf:result></oaf:entity></metadata></result></results></response>')",
    )
