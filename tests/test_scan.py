"""Phrase and number scan against a plain Python statement of the same rules."""

import re

import pytest
from conftest import cells, value
from pyspark.sql import functions as F

from citeloom.functions.scan import ScanSpec, find_mentions, mention_context, mention_hits
from citeloom.operators import docscan, multiscan

SPEC = ScanSpec(phrases=("QXR-7654321", "Award QXR 7654321"), number="7654321", prefix="QXR")


def plain_mentions(text):
    digits = r"[\s\-_./,:;]*".join("7654321")
    rules = [r"QXR[-\s]?7654321", r"Award\s+QXR\s+7654321", r"\b7654321\b", digits]
    out = []
    for rule in rules:
        for m in re.finditer(rule, text, re.IGNORECASE):
            v = " ".join(m.group(0).split())
            if v not in out:
                out.append(v)
    collapsed = "".join(ch for ch in text.lower() if ch.isalnum())
    for label in ("QXR7654321", "7654321"):
        if label.lower() in collapsed and label not in out:
            out.append(label)
    return out


TEXTS = [
    "Supported by Award  QXR 7654321 and qxr-7654321.",
    "grant no 7654321 only",
    "split 7 6-5.4/3:2;1 digits",
    "longer 976543219 number",
    "Q X R * 7*6*5*4*3*2*1 stars",
    "nothing to see",
    "",
]


@pytest.mark.parametrize("text", TEXTS)
def test_mentions_equal_the_plain_rules(spark, text):
    assert value(spark, find_mentions(F.col("x"), SPEC), x=text) == plain_mentions(text)


def test_context_is_cut_at_both_ends(spark):
    pad = "w" * 200
    ctx = mention_context(F.col("x"), find_mentions(F.col("x"), SPEC), SPEC, window=10)
    assert value(spark, ctx, x=f"{pad} 7654321 {pad}") == "w" * 9 + " 7654321 " + "w" * 9
    assert value(spark, ctx, x="7654321") == "7654321"
    assert value(spark, ctx, x="a 7 6 5 4 3 2 1 b") == "a 7 6 5 4 3 2 1 b"
    assert value(spark, ctx, x="none") is None


def test_rule_report_separates_strict_and_loose(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id INT, t STRING")
    row = docscan.rule_report(docscan.mention_rows(df, SPEC, "id", "t"), "id").first()
    assert (row["texts"], row["strict_texts"], row["loose_only_texts"]) == (5, 2, 3)


def _fetched(spark, rows):
    from citeloom.schemas import FETCHED

    return spark.createDataFrame(rows, FETCHED)


def test_retrieval_reasons(spark):
    rows = [
        ("u1", None, 200, "application/pdf", "x", None, None),
        ("u2", None, 200, "text/html", "%PDF-1.4", None, None),
        ("u3", None, 403, "application/pdf", "%PDF", None, None),
        ("u4", None, None, None, "", None, None),
        ("u5", None, None, None, "abc", None, None),
        ("u6", None, None, None, None, "no route", None),
    ]
    got = dict(_fetched(spark, rows).select("url", docscan.retrieval_error(30)).collect())
    assert got == {
        "u1": None,
        "u2": None,
        "u3": "status 403",
        "u4": "no body",
        "u5": "no PDF but None",
        "u6": "no route",
    }


def _scan(spark, pdfs, texts, fetched, papers=None):
    from citeloom.functions.arrays import empty_strings  # noqa: F401

    ids = sorted({c for c, _ in pdfs} | {c for c, _, _ in texts} | set(papers or []))
    p = spark.createDataFrame([(c, False) for c in ids], "canonical_id STRING, already_mentioned BOOLEAN")
    pdf = spark.createDataFrame([(c, u, i) for i, (c, u) in enumerate(pdfs)], "canonical_id STRING, url STRING, at INT")
    txt = spark.createDataFrame(
        [(c, k, u, i) for i, (c, k, u) in enumerate(texts)], "canonical_id STRING, kind STRING, url STRING, at INT"
    )
    out = docscan.scan_documents(p, pdf, txt, _fetched(spark, fetched), SPEC)
    return {r["canonical_id"]: r for r in out.collect()}


def test_scan_outcomes(spark):
    ok = lambda u, t: (u, None, 200, "application/pdf", "%PDF", None, t)
    fetched = [
        ok("hit.pdf", "thanks to QXR-7654321"),
        ok("clear.pdf", "thanks to nobody"),
        ok("scan.pdf", None),
        ("wall.pdf", "wall/final", 200, "text/html", "<p>Preparing to download</p>", None, None),
        ("full.xml", None, 200, "application/xml", "<a><b>QXR</b><c>7654321</c></a>", None, None),
        ("page", "page/final", 200, "text/html", "<p>award QXR 7654321</p><script>QXR-7654321</script>", None, None),
    ]
    got = _scan(
        spark,
        [("a", "wall.pdf"), ("a", "hit.pdf"), ("b", "clear.pdf"), ("c", "scan.pdf"), ("d", "wall.pdf"), ("e", "gone.pdf"),
         ("h", "clear.pdf"), ("h", "clear.pdf2"), ("h", "x3.pdf"), ("h", "hit.pdf")],
        [("d", "pmc_efetch_xml", "full.xml"), ("b", "landing_page_text", "nowhere"), ("e", "landing_page_text", "nowhere"),
         ("g", "landing_page_text", "page")],
        fetched,
        papers=["f"],
    )
    assert (got["a"]["status"], got["a"]["document_verification_kind"], got["a"]["document_verification_url"]) == (
        "mention", "pdf", "hit.pdf"
    )
    assert got["a"]["document_award_mentions"] == ["QXR-7654321", "7654321", "QXR7654321"]
    assert got["b"]["status"] == "scanned_clear" and got["b"]["document_scan_error"] is None
    assert (got["c"]["status"], got["c"]["document_scan_error"]) == ("extract_fail", docscan.NO_TEXT)
    assert (got["d"]["status"], got["d"]["document_verification_kind"]) == ("mention", "pmc_efetch_xml")
    assert (got["e"]["status"], got["e"]["document_scan_error"]) == ("download_fail", docscan.NOT_LANDED)
    assert (got["f"]["status"], got["f"]["document_scan_error"]) == ("no_pdf", docscan.NO_CANDIDATES)
    assert got["g"]["document_verification_url"] == "page/final" and got["g"]["document_scan_error"] is None
    # All addresses of a paper are tried: the hit is in the fourth one.
    assert got["h"]["status"] == "mention"


def test_a_table_of_numbers_gives_what_one_number_gives(spark):
    numbers = ["1234567", "234", "AB12", "ab12", "999", "12 34", "", "4111"]
    texts = ["no 1234567 here", "x1234567y and 12-34 567", "a.b.1.2", "AB12, ab 12", "4 1 1 1 and 4111.", "\u0663", None, "", "1" * 50, "DMR 2 3 4!"]
    df = spark.createDataFrame(list(enumerate(texts)), "id INT, text STRING")
    table = spark.createDataFrame([(n,) for n in numbers], "n STRING")
    got = cells(multiscan.number_mentions(df, table, "id", "text", "n"), "id", "number", "rule", "mentions")
    want = []
    for number in [n for n in numbers if n.isalnum()]:
        spec = ScanSpec(number=number)
        hits = df.select("id", F.explode(mention_hits(F.col("text"), spec)).alias("h")).groupBy("id", "h.rule").count()
        want += [(r["id"], number, r["rule"], r["count"]) for r in hits.collect()]
    assert got == sorted(want, key=lambda t: [(v is None, str(v)) for v in t])
    # Groups of numbers give the same as one automaton.
    assert cells(multiscan.number_mentions(df, table, "id", "text", "n", group_chars=6), "id", "number", "rule", "mentions") == got
    assert multiscan.number_mentions(df, table.where("false"), "id", "text", "n").count() == 0


def test_the_guard_passes_every_text_with_a_phrase(spark):
    spec = ScanSpec(phrases=("MIT License", "CC BY-NC 4.0"))
    texts = ["m\u0131t l\u0130cen\u017fe", "MIT\u00a0LICENSE", "cc bync 4.0", "CC BY NC\t4.0", "mit", "license mit", "M\u0130T license"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    rows = df.select("t", spec.guard(F.col("t")).alias("g"), *[F.rlike("t", F.lit(r.regex)).alias(f"r{i}") for i, r in enumerate(spec.rules)]).collect()
    assert all(r["g"] for r in rows if r["r0"] or r["r1"]) and sum(r["r0"] or r["r1"] for r in rows) >= 4
    assert not rows[4]["g"]
