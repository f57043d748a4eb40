"""Snapshot, coverage, curation and report rules on small literals."""

import pytest
from conftest import cells
from pyspark.sql import functions as F

from citeloom.functions.arrays import empty_strings
from citeloom.operators import coverage, curate, finalize, report, snapshot
from citeloom.schemas import PAPER_INDEX


def _papers(spark, rows):
    df = spark.createDataFrame(rows, "canonical_id STRING, title STRING, doi STRING")
    none = F.lit(None).cast("string")
    return df.withColumn("year", F.lit(2024)).withColumn("published_date", none).withColumn("venue", none)


def _values(spark, rows):
    return spark.createDataFrame(rows, "canonical_id STRING, field STRING, value STRING, first_ord BIGINT, first_pos BIGINT")


def _index(spark, rows):
    names = [c.split()[0] for c in PAPER_INDEX.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], PAPER_INDEX)


def test_diff_ignores_list_order_but_not_list_content(spark):
    papers = _papers(spark, [("p1", "One", None), ("p2", "Two", "10.1/b"), ("p3", "Three", None), ("p4", "Four", None)])
    old = _values(spark, [("p1", "authors", "A", 1, 0), ("p1", "authors", "B", 2, 0), ("p2", "authors", "A", 1, 0), ("p4", "urls", "u", 1, 0)])
    new = _values(spark, [("p1", "authors", "B", 1, 0), ("p1", "authors", "A", 2, 0), ("p2", "authors", "A", 1, 0), ("p2", "authors", "C", 1, 1),
                          ("p4", "pdf_urls", "u", 1, 0)])
    before = snapshot.fingerprint(papers.filter("canonical_id <> 'p3'"), old)
    after = snapshot.fingerprint(papers, new)
    diffed = snapshot.diff(after, before)
    assert cells(diffed, "canonical_id", "status") == [("p1", "unchanged"), ("p2", "changed"), ("p3", "new"), ("p4", "changed")]
    assert tuple(snapshot.status_counts(diffed).first()) == (1, 2, 1)
    assert [r["canonical_id"] for r in snapshot.delta_ids(diffed).collect()] == ["p2", "p4", "p3"]


def test_hydrate_replaces_flags_and_extends_lists(spark):
    rows = [(c, s, True, False, ["x"], [], None, "keep") for c, s in (("p1", "unchanged"), ("p2", "changed"), ("p3", "unchanged"))]
    diffed = spark.createDataFrame(
        rows, "canonical_id STRING, status STRING, award_mentioned_in_metadata BOOLEAN, award_mentioned_in_document BOOLEAN, "
        "award_mentions ARRAY<STRING>, document_award_mentions ARRAY<STRING>, document_verification_kind STRING, document_verification_url STRING"
    )
    prev = _index(spark, [
        dict(canonical_id="p1", award_mentioned_in_metadata=False, award_mentioned_in_document=True, award_mentions=["x", " y "],
             document_award_mentions=["z"], document_verification_kind="pdf", document_verification_url="  "),
        dict(canonical_id="p2", award_mentioned_in_document=True, award_mentions=["q"]),
    ])
    got = {r["canonical_id"]: tuple(r)[2:] for r in snapshot.hydrate(diffed, prev).collect()}
    assert got["p1"] == (False, True, ["x", "y"], ["z"], "pdf", "keep")
    assert got["p2"] == (True, False, ["x"], [], None, "keep")
    assert got["p3"] == (True, False, ["x"], [], None, "keep")


def test_upsert_keeps_unseen_papers_and_first_seen(spark):
    prev = _index(spark, [dict(canonical_id="a", title="old", doi="d", first_seen_at="t0", last_seen_at="t0", last_output_dir="r0"),
                          dict(canonical_id="b", title="kept", first_seen_at="t0", last_seen_at="t0", last_output_dir="r0")])
    cur = _index(spark, [dict(canonical_id="a", title="new"), dict(canonical_id="c", title="fresh")])
    out = snapshot.upsert(prev, cur, "s1", "e1", "r1")
    assert cells(out, "canonical_id", "title", "doi", "first_seen_at", "last_seen_at", "last_output_dir") == [
        ("a", "new", None, "t0", "e1", "r1"), ("b", "kept", None, "t0", "t0", "r0"), ("c", "fresh", None, "s1", "e1", "r1")
    ]


def _coverage_inputs(spark):
    targets = spark.createDataFrame([(1, " 10.1/A"), (2, "10.2/b"), (3, "10.1/a"), (4, "10.3/c"), (5, " ")], "ord BIGINT, doi STRING")
    papers = spark.createDataFrame(
        [(1, "10.1/a", "first", True, False, "new"), (2, "10.1/A", "second", False, False, "new"), (3, "10.3/C", "third", False, True, "unchanged"),
         (4, None, "none", True, True, "changed")],
        "ord BIGINT, doi STRING, title STRING, award_mentioned_in_document BOOLEAN, award_mentioned_in_metadata BOOLEAN, status STRING",
    )
    return targets, papers


def test_coverage_first_paper_counts(spark):
    targets, papers = _coverage_inputs(spark)
    details = coverage.coverage_details(targets, papers)
    assert cells(details, "doi_key", "target_ord", "found", "title", "award_verified") == [
        ("10.1/a", 1, True, "first", True), ("10.2/b", 2, False, None, None), ("10.3/c", 4, True, "third", False)
    ]
    assert tuple(coverage.coverage_counts(details).first()) == (3, 2, 1, 1, 1)
    assert [r["doi_key"] for r in coverage.verification_failures(details).collect()] == ["10.3/c"]
    loose = coverage.coverage_details(targets, papers, require_document=False)
    assert coverage.coverage_counts(loose).first()["award_verified_count"] == 2


def test_scan_selection(spark):
    targets, papers = _coverage_inputs(spark)
    pick = lambda **kw: sorted(r["title"] for r in coverage.select_for_scan(papers, **kw).collect())
    assert pick(targets=targets, target_only=True) == ["first", "second", "third"]
    assert pick(targets=targets.filter("ord > 4"), target_only=True) == ["first", "none", "second", "third"]
    assert pick(targets=targets.filter("ord > 4"), target_only=True, incremental=True) == ["first", "none", "second"]
    assert pick(targets=None, incremental=True) == ["first", "none", "second"]
    # Targets in target-only mode switch the incremental rule off.
    assert pick(targets=targets, target_only=True, incremental=True) == ["first", "second", "third"]


@pytest.mark.parametrize(
    "sources, accepted, confidence",
    [
        (["crossref", "dblp"], True, "high"),
        (["arxiv"], True, "high-preprint"),
        (["pubmed", "europe_pmc"], True, "high"),
        (["pubmed"], True, "medium"),
        (["arxiv", "crossref"], True, "medium"),
        (["openaire", "crossref"], True, "medium"),
        (["doaj", "crossref"], False, "low"),
        (["crossref"], False, "low"),
        ([], False, "low"),
    ],
)
def test_decision_order(spark, sources, accepted, confidence):
    arr = F.array(*[F.lit(s) for s in sources]) if sources else empty_strings()
    d = spark.range(1).select(curate.decision(F.lit(True), arr).alias("d")).first()["d"]
    assert (d["accepted"], d["confidence"]) == (accepted, confidence)


def test_review_doi_beats_title_and_last_paper_wins(spark):
    papers = spark.createDataFrame(
        [(1, "c1", "10.1/a", "Glass", "J", ["crossref"]), (2, "c2", None, "Glass!", "bioRxiv", ["dblp"]), (3, "c3", "10.1/A", "Other", "J", ["pubmed"])],
        "ord BIGINT, canonical_id STRING, doi STRING, title STRING, venue STRING, sources ARRAY<STRING>",
    )
    items = spark.createDataFrame(
        [(1, "Glass", "10.1/a"), (2, "glass", None), (3, "Missing", "10.9/z"), (4, "Known", "10.5/k")], "ord BIGINT, title STRING, doi STRING"
    )
    baseline = items.filter("ord = 4")
    got = {r["ord"]: r for r in curate.review(items, baseline, papers).collect()}
    assert (got[1]["confidence"], got[1]["sources"], got[1]["portal_eligible"]) == ("medium", ["pubmed"], True)
    assert (got[2]["confidence"], got[2]["is_preprint"], got[2]["portal_eligible"]) == ("high", True, False)
    assert (got[3]["confidence"], got[3]["accepted"], got[3]["portal_eligible"]) == ("missing", False, False)
    assert (got[4]["confidence"], got[4]["portal_eligible"], got[4]["is_preprint"]) == ("baseline", True, None)
    total = curate.cumulative(baseline, curate.review(items, baseline, papers))
    assert cells(total, "section", "ord") == [(0, 4), (1, 1), (1, 2)]
    assert cells(curate.portal(total, papers), "ord") == [(1,), (4,)]


def test_audit_policy_and_award_summary(spark):
    log = spark.createDataFrame(
        [("https://a.org/x", "requests", True, None), ("https://A.org/y", "browser", False, "boom"), ("nohost", "requests", True, "")],
        "url STRING, transport STRING, use_proxy BOOLEAN, error STRING",
    )
    audit = report.request_audit(log)
    assert ("host", "a.org", 2, 1, 1) in cells(audit, "level", "name", "attempts", "errors", "direct_attempts")
    assert ("host", "<unknown>", 1, 0, 0) in cells(audit, "level", "name", "attempts", "errors", "direct_attempts")
    with pytest.raises(Exception, match="Policy violation"):
        report.require_proxied(audit).collect()
    assert report.require_proxied(report.request_audit(log.filter("use_proxy"))).count() == 4


def test_snapshot_pieces_compose_to_the_text(spark):
    """Pieces of item and group in order are the text, whose length, lines and digest are sums; a hot group is written once."""
    hot = [("g", None, 9, "canonical_record_abstract", i, 0, f"abstract {i} " + "x" * (i % 7)) for i in range(300)]
    lines = [
        (None, 1, 0, "Title", 0, 0, "T one"), (None, 1, 4, "DOI", 0, 0, "10.1/a"), (None, 2, 0, "Title", 0, 0, "T two"),
        (None, 2, 8, "Metadata", 1, 1, "m2"), (None, 2, 8, "Metadata", 0, 0, "m1"), (None, 2, 9, "openalex_metadata", 2, 0, "looked up"),
        ("g", None, 6, "Addresses", 3, 1, "u3"), ("g", None, 6, "Addresses", 0, 2, "u0"), *hot,
    ]
    df = spark.createDataFrame(lines, "group_key STRING, ord BIGINT, section INT, label STRING, a BIGINT, b BIGINT, text STRING")
    items = spark.createDataFrame([(1, "g"), (2, "g")], "ord BIGINT, item_key STRING")
    pieces = finalize.snapshot_pieces(df).collect()
    assert len(pieces) == len(lines) and max(len(r["piece"]) for r in pieces) < 40
    totals = {r["ord"]: r for r in finalize.snapshot_documents(items, df).collect()}
    abstracts = "\n\n".join(x[6] for x in hot)
    want = {
        1: f"Title: T one\nDOI: 10.1/a\nAddresses: u0, u3\n{abstracts}",
        2: f"Title: T two\nAddresses: u0, u3\nMetadata: m1, m2\n{abstracts}",
    }
    for item, text in want.items():
        own = sorted((tuple(r[c] for c in finalize.PIECE_ORDER), r["piece"]) for r in pieces if r["ord"] == item or r["group_key"] == "g")
        made = "".join(p for _, p in own)[1:]
        if item == 2:  # the looked-up abstract is a block of its own, at its place among the abstracts' blocks
            assert made == text + "\nlooked up"
        else:
            assert made == text
        assert totals[item]["chars"] == len(made) and totals[item]["n_lines"] == len(own)
    # Digests tell texts apart and do not depend on how rows are dealt.
    again = {r["ord"]: r["digest"] for r in finalize.snapshot_documents(items, df.repartition(7)).collect()}
    other = finalize.snapshot_documents(items, df.withColumn("text", F.regexp_replace("text", "abstract 7 ", "abstract 8 "))).collect()
    assert again == {k: r["digest"] for k, r in totals.items()} and all(r["digest"] != again[r["ord"]] for r in other)


def test_snapshot_documents_compose_every_text_in_order(spark):
    """The digest is that of the whole text, so the order of its lines counts; a sum over lines can't tell the two apart."""
    import hashlib

    def lines(first, second):
        rows = [(None, 1, 0, "Title", 0, 0, "T"), ("g", None, 9, "canonical_record_abstract", 0, 0, first), ("g", None, 9, "canonical_record_abstract", 1, 0, second),
                (None, 2, 0, "Title", 0, 0, "U")]
        return spark.createDataFrame(rows, "group_key STRING, ord BIGINT, section INT, label STRING, a BIGINT, b BIGINT, text STRING")

    items = spark.createDataFrame([(1, "g"), (2, "h")], "ord BIGINT, item_key STRING")
    one, other = [{r["ord"]: r for r in finalize.snapshot_documents(items, lines(*t)).collect()} for t in (("ä", "y"), ("y", "ä"))]
    assert one[1]["digest"] == other[1]["digest"]
    assert [d[1]["text_md5"] for d in (one, other)] == [hashlib.md5(t.encode()).hexdigest() for t in ("Title: T\nä\n\ny", "Title: T\ny\n\nä")]
    assert one[2]["text_md5"] == other[2]["text_md5"] == hashlib.md5(b"Title: U").hexdigest()


def test_snapshot_texts_of_a_large_group_are_not_copied_to_its_items(spark, monkeypatch):
    """A group's pieces move once for each part of its items, whose digests are those of the whole texts; a write leaves no shuffle files."""
    import hashlib

    from citeloom.session import materialise

    n, m = 90, 40
    hot = [("g", None, 9, "canonical_record_abstract", i + 1, 0, f"abstract {i} ä") for i in range(m)] + [("g", None, 6, "Addresses", 0, 0, "u")]
    own = [(None, i, 0, "Title", 0, 0, f"T {i}") for i in range(n)] + [(None, i, 9, "openalex_metadata", 0, 0, f"looked {i}") for i in range(0, n, 3)]
    own += [(None, n, 4, "DOI", 0, 0, "10.1/a"), (None, n + 1, 9, "openalex_metadata", 2, 0, "none before")]
    columns = "group_key STRING, ord BIGINT, section INT, label STRING, a BIGINT, b BIGINT, text STRING"
    lines = spark.createDataFrame([*hot, *own, ("other", None, 6, "Addresses", 0, 0, "of nobody")], columns)
    items = spark.createDataFrame([*[(i, "g") for i in range(n)], (n, "alone"), (n + 1, "g")], "ord BIGINT, item_key STRING")
    abstracts = "\n\n".join(x[6] for x in hot[:m])
    looked = {i: f"\nlooked {i}" for i in range(0, n, 3)}
    want = {i: f"Title: T {i}\nAddresses: u{looked.get(i, '')}\n{abstracts}" for i in range(n)}
    want |= {n: "DOI: 10.1/a", n + 1: f"Addresses: u\n{abstracts}\nnone before"}
    for part_items, part_chars, gathered, k in ((10_000, 1 << 33, 1 << 20, 1), (20, 1 << 33, 64, 5), (10_000, 20_000, 1, 3)):
        monkeypatch.setattr(finalize, "PART_ITEMS", part_items)
        monkeypatch.setattr(finalize, "PART_CHARS", part_chars)
        monkeypatch.setattr(finalize, "GATHERED", gathered)
        got = {r["ord"]: r for r in finalize.snapshot_documents(items, lines).collect()}
        assert {o: r["text_md5"] for o, r in got.items()} == {o: hashlib.md5(t.encode()).hexdigest() for o, t in want.items()}
        assert all(r["chars"] == len(want[o]) for o, r in got.items())
        chars = spark.createDataFrame([("g", m * 14)], "item_key STRING, _chars BIGINT")
        parts = finalize.group_parts(items, chars)
        assert [tuple(r) for r in parts.collect()] == ([("g", k)] if k > 1 else [])
        placed = finalize.placed_pieces(items, finalize.snapshot_pieces(lines), parts)
        assert placed.count() == n + 2 + len(own) + len(hot) * k + 1 and placed.groupBy("group_key", "part").count().count() == k + 2
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}

    import time

    before, late = shuffles(), time.time() + 20
    table = materialise(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "seven")
    while shuffles() - before and time.time() < late:
        time.sleep(0.1)
    assert not shuffles() - before
    assert table.count() == 7
