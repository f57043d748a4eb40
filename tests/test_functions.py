"""Column functions against small literals."""

import datetime as dt

import pytest
from conftest import value
from pyspark.sql import functions as F

from citeloom.functions import arrays, dates, ids, names, text, urls

C = F.col


def test_white_space_of_all_kinds_collapses(spark):
    raw = " a \tb\x1cc  d \n"
    assert value(spark, text.ws(C("x")), x=raw) == " ".join(raw.split()) == "a b c d"
    assert value(spark, text.ws_or_null(C("x")), x="   ") is None
    assert value(spark, text.payload_text(C("x")), x=" None ") is None


def test_display_text_decodes_and_strips(spark):
    raw = "  Phase&nbsp;<i>diagrams</i> &amp; more... "
    assert value(spark, text.display_text(C("x")), x=raw) == "Phase diagrams & more"
    assert value(spark, text.display_text(C("x"), False), x=raw) == "Phase diagrams & more..."
    assert value(spark, text.display_title_key(C("x")), x=raw) == "phasediagramsmore"


def test_ten_megabytes_are_chunked_and_indexed(spark):
    words = F.transform(F.sequence(F.lit(1), F.lit(1_400_000)), lambda i: F.concat(F.lit("w"), (i % 99991).cast("string")))
    df = spark.range(1).select(F.array_join(words, " ").alias("t"))
    chunks = df.select(F.explode(text.chunk_words(C("t"), 1500)).alias("c")).select(F.length("c").alias("n"), F.substring_index("c", " ", 1).alias("w"))
    sizes = [r["n"] for r in chunks.collect()]
    assert sum(sizes) + len(sizes) - 1 == df.select(F.length("t")).first()[0] and max(sizes) <= 1500 and min(sizes[:-1]) > 1490
    assert df.select(arrays.decode_inverted_index(arrays.inverted_index(F.split("t", " "))) == C("t")).first()[0]


def test_references_of_any_length_are_decoded():
    assert text._decoded("a&#" + "0" * 9000 + "65;&#" + "9" * 9000 + ";&amp;&#x41;&#128512;") == "aA\ufffd&A\U0001f600" and text._decoded(None) is None


def test_word_index(spark):
    got = spark.range(1).select(arrays.inverted_index(F.split(F.lit("b a b c a b"), " ")).alias("m")).first()["m"]
    assert got == {"a": [1, 4], "b": [0, 2, 5], "c": [3]}
    assert spark.range(1).select(arrays.inverted_index(F.expr("cast(array() as array<string>)")).alias("m")).first()["m"] == {}


def test_chunks_pack_greedily_and_keep_long_words(spark):
    assert value(spark, text.chunk_words(C("x"), 7), x="aa bb cc dddddddddd e") == ["aa bb", "cc", "dddddddddd", "e"]
    assert value(spark, text.chunk_words(C("x"), 7), x="   ") == []


def test_ordered_distinct_lists(spark):
    data = ["B x", " b  X ", "", "A", "B x"]
    assert value(spark, arrays.distinct_ws(C("x")), x=data) == ["B x", "b X", "A"]
    assert value(spark, arrays.distinct_ignore_case(C("x")), x=data) == ["B x", "A"]
    assert value(spark, arrays.distinct_trimmed(C("x")), x=data) == ["B x", "b  X", "A"]


def test_inverted_index_first_word_of_a_position_wins(spark):
    m = F.expr("map('soft', array(0), 'matter', array(1, -4), 'late', array(1), 'here', array(2))")
    assert value(spark, arrays.decode_inverted_index(m)) == "soft matter here"


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("https://DOI.org/10.7777/Ab.", "10.7777/Ab"),
        (" doi.org/10.1/x ", "10.1/x"),
        ("10.5/y..", "10.5/y"),
        ("  ", None),
        (None, None),
    ],
)
def test_normalize_doi(spark, raw, expected):
    assert value(spark, ids.normalize_doi(C("x").cast("string")), x=raw) == expected


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("http://arxiv.org/abs/2203.04567v2", "2203.04567"),
        ("https://bib.example/db/corr2203.html#abs-2203-04567", "2203.04567"),
        ("nothing", None),
    ],
)
def test_arxiv_loose(spark, raw, expected):
    assert value(spark, ids.arxiv_loose(C("x")), x=raw) == expected


def test_canonical_id_prefers_doi_then_arxiv_then_title(spark):
    cid = ids.canonical_id(C("d"), C("s"), C("l"), C("p"), C("t"), C("y"))
    base = {"s": "k1", "l": "https://e.org/1", "p": "", "t": "On Glass: A Study", "y": 2021}
    assert value(spark, cid, d="10.9/ABC", **base) == "doi:10.9/abc"
    assert value(spark, cid, d="", **(base | {"l": "arxiv.org/abs/2101.00001v3"})) == "arxiv:2101.00001"
    assert value(spark, cid, d="", **base) == "title:2021:onglassastudy"


def test_small_ids(spark):
    assert value(spark, ids.normalize_pmcid(C("x")), x="pmc123") == "PMC123"
    assert value(spark, ids.normalize_pmcid(C("x")), x="id 45") == "PMC45"
    assert value(spark, ids.pmcids(C("x")), x=["a PMC12 b pmc12", "PMC7"]) == ["PMC12", "PMC7"]
    assert value(spark, ids.file_stem(C("x")), x="10.1/a b?c/") == "10.1_a_b_c"
    assert value(spark, ids.file_stem(C("x")), x="???") == "paper"
    assert value(spark, ids.pid_from_profile(C("x")), x="https://d.example/pid/12/345/") == "12/345"
    assert value(spark, ids.openalex_short_id(C("x")), x="https://o.example/W77/") == "W77"
    assert value(spark, ids.doi_tokens(C("x")), x="see (doi:10.1/a), [10.2/B]; none") == ["10.1/a", "10.2/B"]
    assert value(spark, ids.doi_from_links(C("x")), x=["https://e.org/x", "https://dx.doi.org/10.3/Q"]) == "10.3/Q"
    assert value(spark, ids.first_doi(C("x")), x=["urn:5", "https://e.org/10.4321/zz"]) == "10.4321/zz"


def test_dates(spark):
    assert value(spark, dates.month_number(C("x")), x="Sept") == 9
    assert value(spark, dates.month_number(C("x")), x="17") == 12
    assert value(spark, dates.month_number(C("x")), x="spring") == 1
    assert value(spark, dates.year_in_text(C("x")), x="vol 3, 1998 / 2004") == 1998
    parts = F.expr("array(array(2019, 4))")
    assert value(spark, dates.date_of_parts(parts)) == "2019-04-01"
    assert value(spark, dates.display_parts(parts)) == "2019-4"
    assert dt.date.fromisoformat(value(spark, dates.year_to_date(C("x")), x=2005)).year == 2005


def test_person_names(spark):
    ok = names.is_probable_person(C("x"), ["ex-lab"])
    assert value(spark, ok, x="Ines Q. Fabre")
    assert value(spark, ok, x="Jean-Luc O’Neil")
    assert not value(spark, ok, x="Our Research Group")
    assert not value(spark, ok, x="The EX-Lab People")
    assert not value(spark, ok, x="lower Case")
    assert not value(spark, ok, x="Solo")


@pytest.mark.parametrize(
    "member, author, loose, strict",
    [
        ("Mei-Lin Roth", "Mei Lin Roth", True, True),
        ("Mei-Lin Roth", "ML Roth", True, True),
        ("Mei-Lin Roth", "Roth M", True, True),
        ("Mei-Lin Roth", "Meike Roth", True, False),
        ("Mei-Lin Roth", "Anna Roth", False, False),
        ("Roth", "Mei Roth", False, False),
    ],
)
def test_author_matchers(spark, member, author, loose, strict):
    m, a = names.tokens(C("m")), names.tokens(C("a"))
    assert value(spark, names.surname_initial_match(m, a), m=member, a=author) is loose
    assert value(spark, names.full_given_match(m, a), m=member, a=author) is strict


def test_scores_prefer_the_right_given_name(spark):
    for score in (
        lambda a: names.score_dblp(F.lit("Nora Vance"), F.lit(a), F.lit(False)),
        lambda a: names.score_openalex(F.lit("Nora Vance"), F.lit(a)),
        lambda a: names.score_semantic_scholar(F.lit("Nora Vance"), F.lit(a)),
    ):
        assert value(spark, score("Nora Vance")) > value(spark, score("Peter Vance 0003"))
    assert value(spark, names.score_dblp(F.lit("Nora Vance"), F.lit("Nora Vance"), F.lit(True))) == 25 + 30 + 16 + 100 + 2
    assert value(spark, names.score_dblp(F.lit("Nora Vance"), F.lit(" "), F.lit(True))) == float("-inf")


def test_variants(spark):
    got = value(spark, names.name_variants(C("x")), x="Ada Maria Lund")
    assert got == ["Ada Maria Lund", "ada lund", "a m lund", "a lund"]
    assert value(spark, names.flip_comma_name(C("x")), x="Lund,  Ada") == "Ada Lund"


def test_url_rules(spark):
    assert value(spark, urls.looks_like_pdf(C("x")), x="https://e.org/Download/PDF?x=1")
    assert value(spark, urls.looks_like_pdf(C("x")), x="/a/pdf/b")
    assert not value(spark, urls.looks_like_pdf(C("x")), x="https://pdf.example.org/a?q=/pdf/")
    assert value(spark, urls.skip_candidate(C("x"), F.lit("10.1/a")), x="https://arxiv.org/pdf/2001.00001")
    assert not value(spark, urls.skip_candidate(C("x"), F.lit("10.1101/a")), x="https://arxiv.org/pdf/2001.00001")
    assert value(spark, urls.skip_candidate(C("x"), F.lit("10.1101/a")), x="https://e.org/MediaObjects/1.pdf")
    assert value(spark, urls.pick_pdf(C("x")), x=["https://e.org/a", "https://arxiv.org/abs/2001.00001v2"]) == (
        "https://arxiv.org/pdf/2001.00001v2.pdf"
    )
    assert value(spark, urls.host(C("x")), x="https://u@Ex.ORG:81/a") == "ex.org"
    api = urls.arxiv_api_url(C("x"), "http://export.arxiv.org/api/query")
    assert value(spark, api, x="https://export.arxiv.org") == "http://export.arxiv.org/api/query"
    assert value(spark, api, x="mirror.example/q?z=1") == "http://mirror.example/q?z=1"
    assert value(spark, api, x=" ") == "http://export.arxiv.org/api/query"


def test_long_texts_go_to_python_in_small_batches(spark):
    """A checked query sets the session up; then no batch holds more than some MB, however long the texts are."""
    import pandas as pd

    from citeloom.plans import catalog

    for key in ("maxRecordsPerBatch", "maxBytesPerBatch"):
        spark.conf.unset(f"spark.sql.execution.arrow.{key}")
    catalog.REGISTRY["page_text_expression"](spark, "/root/testdata/sf0.001")
    size = F.pandas_udf(lambda s: pd.Series([int(s.str.len().sum())] * len(s)), "long")
    texts = spark.range(0, 64, 1, 1).select(F.expr("repeat(cast(id % 10 AS string), 1 << 20)").alias("t"))
    held = [r["n"] for r in texts.select(size("t").alias("n")).collect()]
    assert len(held) == 64 and max(held) <= 6 << 20


def test_white_space_runs_are_those_of_the_plain_rule(spark):
    """Only runs that differ from one space are replaced; the result is that of replacing every run."""
    import random

    from citeloom.functions.text import WS_RUN, ws

    rng = random.Random(3)
    signs = [" ", " ", "\t", "\n", " ", " ", "\x1c", "\x1f", "\x85", "a", "b", "ä", "\U0001f600"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 12))) for _ in range(3000)] + [None, "", " ", "a b", " a  b\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    assert df.filter(~ws(F.col("t")).eqNullSafe(F.trim(F.regexp_replace("t", WS_RUN, " ")))).count() == 0


def test_distinct_names_are_sorted_once(spark):
    from citeloom.functions.arrays import distinct_ignore_case

    df = spark.createDataFrame([(["B  x", "a", "b X", None, " ", "A"],), ([],), (None,)], "v ARRAY<STRING>").select(distinct_ignore_case(F.col("v")).alias("d"))
    assert [r["d"] for r in df.collect()] == [["B x", "a"], [], []]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("array_sort(") == 2


def test_landed_documents_keep_words_rest_and_signs(spark, tmp_path):
    """First six words, the text behind the first line, and escaped signs, by what Python makes of the same texts."""
    import re

    from citeloom.plans import stand_ins

    texts = ["one", "", "\nrest", "a1b c-d, e f g h\nmore\nlines", "line\n", "x & <y> z\n&amp;", "1 2 3", "äb cd " * 5000 + "\nend", "word " * 20, None]
    path = str(tmp_path)
    spark.createDataFrame([(i, t, "en", "src1", 0) for i, t in enumerate(texts)], "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT").write.parquet(f"{path}/documents.parquet")
    escaped = lambda t: t.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    docs = stand_ins.documents(spark, path).selectExpr("doc_id", "line1", "w", "rest", f"{stand_ins._xml('text')} AS x")
    for r in docs.collect():
        text = texts[r["doc_id"]]
        if text is None:
            assert r["w"] is None and r["rest"] is None and r["x"] is None
            continue
        line, _, rest = text.partition("\n")
        assert (r["line1"], r["w"], r["rest"], r["x"]) == (line, re.findall("[A-Za-z]+", line)[:6], rest or None, escaped(text))
