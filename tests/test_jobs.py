"""The jobs end to end on a small landing table, twice, and the streaming state."""

import json
import random

import pytest
from conftest import cells
from pyspark.sql import functions as F

from citeloom.functions.scan import ScanSpec
from citeloom.operators import candidates, merge, snapshot
from citeloom.plans import jobs, sinks
from citeloom.schemas import DOI_LOOKUP, FETCHED, MANIFEST, MEMBERS, RAW_PAYLOADS
from citeloom.streaming import state

SPEC = ScanSpec(phrases=("QXR-7654321",), number="7654321", prefix="QXR")


def _crossref(title, doi, link=None, abstract=None):
    return {"title": [title], "DOI": doi, "author": [{"given": "Ada", "family": "Lund"}], "issued": {"date-parts": [[2024, 2]]},
            "abstract": abstract, "URL": f"https://e.org/{doi}", "link": [{"URL": link, "content-type": "application/pdf"}] if link else []}


def _inputs(spark, items, extra_url=None):
    members = spark.createDataFrame([(0, "Ada Lund", "u", None, None, None, None, [])], MEMBERS)
    openalex = {"results": [{"display_name": "Second paper", "publication_year": 2024, "doi": "https://doi.org/10.1/B", "id": "https://o.example/W2",
                             "authorships": [{"author": {"display_name": "Ada Lund"}}]}]}
    raw = spark.createDataFrame(
        [("crossref", "Ada Lund", 0, 0, json.dumps({"message": {"items": items}})), ("openalex", "Ada Lund", 0, 0, json.dumps(openalex)),
         ("doaj", "Ada Lund", 0, 0, json.dumps({"results": [{"bibjson": {"title": "Never seen"}}]}))],
        RAW_PAYLOADS,
    )
    fetched = spark.createDataFrame(
        [("https://e.org/a.pdf", None, 200, "application/pdf", "%PDF", None, "we thank QXR-7654321"),
         ("https://e.org/b/pdf", None, 200, "application/pdf", "%PDF", None, "no thanks")],
        FETCHED,
    )
    lookup = spark.createDataFrame([("10.1/b", "openalex", json.dumps({"best_oa_location": {"pdf_url": "https://e.org/b/pdf"}}))], DOI_LOOKUP)
    health = spark.createDataFrame([("doaj", "HTTP 503")], "source STRING, error STRING")
    log = spark.createDataFrame([("https://e.org/a", "requests", True, None)], "url STRING, transport STRING, use_proxy BOOLEAN, error STRING")
    targets = spark.createDataFrame([(1, "10.1/A"), (2, "10.1/b"), (3, "10.9/x")], "ord BIGINT, doi STRING")
    return jobs.RunInputs(raw, members, fetched, lookup, health, log, targets)


def _params(rid, **kw):
    kw.setdefault("enabled_sources", ("openalex", "crossref", "doaj"))
    return jobs.RunParams(run_id=rid, run_started_at=f"{rid}-s", run_finished_at=f"{rid}-e", current_year=2025, spec=SPEC, **kw)


def test_two_runs(spark, tmp_path):
    base = str(tmp_path)
    items = [_crossref("First paper", "10.1/A", "https://e.org/a.pdf"), _crossref("Second paper, longer", "10.1/b")]
    s1 = jobs.collection_run(spark, _inputs(spark, items), _params("r1"), base).first()
    assert (s1["raw_record_count"], s1["canonical_paper_count"], s1["new_count"], s1["award_match_count"]) == (3, 2, 2, 1)
    assert (s1["target_doi_total"], s1["target_doi_matched"], s1["target_doi_award_verified"]) == (3, 2, 1)
    assert s1["source_record_counts"]["doaj"] == 0 and s1["source_error_counts"]["doaj"] == 1
    assert s1["source_probe_status"]["doaj"] == "skipped: HTTP 503"
    papers = {r["canonical_id"]: r for r in sinks.read_latest(spark, base, "papers").collect()}
    assert papers["doi:10.1/b"]["sources"] == ["openalex", "crossref"] and papers["doi:10.1/b"]["title"] == "Second paper, longer"
    assert papers["doi:10.1/a"]["document_verification_url"] == "https://e.org/a.pdf"
    lines = [r["value"] for r in spark.read.text(sinks.run_path(base, "r1", "report")).collect()]
    assert lines[0] == "# Run" and any(x.startswith("- **First paper** (2024, no venue)") for x in lines)

    # Second run: one paper unchanged (its cached hit stays, no new scan), one gone, one new.
    items2 = [items[0], _crossref("Third paper", "10.1/c", abstract="about QXR 7654321")]
    s2 = jobs.collection_run(spark, _inputs(spark, items2), _params("r2"), base).first()
    assert (s2["new_count"], s2["changed_count"], s2["unchanged_count"]) == (1, 1, 1)
    assert sinks.latest_run(spark, base) == "r2"
    again = {r["canonical_id"]: r for r in sinks.read_latest(spark, base, "papers").collect()}
    assert again["doi:10.1/a"]["award_mentioned_in_document"] and again["doi:10.1/a"]["document_verification_kind"] == "pdf"
    assert again["doi:10.1/c"]["award_mentioned_in_metadata"]
    index = jobs.paper_index(spark, base)
    assert cells(index, "canonical_id", "first_seen_at", "last_seen_at") == [
        ("doi:10.1/a", "r1-s", "r2-e"), ("doi:10.1/b", "r1-s", "r2-e"), ("doi:10.1/c", "r2-s", "r2-e")
    ]
    # The same run again: compared with the run before it, not with itself.
    s2 = jobs.collection_run(spark, _inputs(spark, items2), _params("r2"), base).first()
    assert (s2["new_count"], s2["changed_count"], s2["unchanged_count"]) == (1, 1, 1)
    assert sinks.latest_run(spark, base) == "r2" and sinks.latest_run(spark, base, before="r2") == "r1"
    sinks.publish(spark, base, "a run whose id does not sort")
    assert sinks.latest_run(spark, base) == "a run whose id does not sort"
    sinks.publish(spark, base, "r2")
    # The state holds what each run touched, and a compaction changes nothing that is read.
    state = jobs.index_state(spark, base)
    before = cells(jobs.paper_index(spark, base), "canonical_id", "hash", "first_seen_at", "last_seen_at", "last_output_dir")
    assert state.since_base() == 3 and cells(jobs.paper_index(spark, base, before="r2"), "canonical_id") == [("doi:10.1/a",), ("doi:10.1/b",)]
    state.compact()
    state.drop_folded()
    assert state.since_base() == 0 and cells(jobs.paper_index(spark, base), "canonical_id", "hash", "first_seen_at", "last_seen_at", "last_output_dir") == before
    with pytest.raises(RuntimeError, match="unverified_targets"):
        jobs.collection_run(spark, _inputs(spark, items), _params("r3", fail_on_unverified_targets=True, use_state=False), base)

    # Curation and finalisation read the written tables.
    final = sinks.read_latest(spark, base, "papers").withColumn("ord", F.col("first_ord"))
    manifest = spark.createDataFrame(
        [(1, "First paper.", ["Ada Lund"], ["Ada Lund"], "https://e.org/1", "10.1/A"), (2, "Third paper", ["Ada Lund"], ["Ada Lund"], "https://e.org/3", "10.1/c")],
        MANIFEST,
    ).filter("ord = 1")
    counts = jobs.curation_job(manifest.select("ord", "title", "doi"), manifest.filter("ord > 9").select("ord", "title", "doi"), final, base, "c1").first()
    assert (counts["candidate_count"], counts["accepted_addition_count"]) == (1, 0)
    shaped = final.withColumn("urls", F.expr("cast(array() as array<string>)")).withColumn("pdf_urls", F.expr("cast(array() as array<string>)"))
    records = sinks.read_latest(spark, base, "paper_records")
    no_files = spark.createDataFrame([], "group_key STRING, ord BIGINT, path STRING, ok BOOLEAN, error STRING")
    inputs = _inputs(spark, items)
    out = jobs.finalisation_job(manifest, shaped, records, inputs.fetched, inputs.doi_lookup, no_files, base, "f1").first()
    assert (out["evidence_kind"], out["evidence_url"]) == ("downloaded_pdf", "https://e.org/a.pdf")
    text = "\n".join(r["value"] for r in spark.read.text(sinks.run_path(base, "f1", "final_markdown")).collect())
    assert text.splitlines()[0] == "**First paper**"
    with pytest.raises(RuntimeError, match="unmatched_items"):
        unknown = manifest.withColumn("title", F.lit("Unknown title"))
        jobs.finalisation_job(unknown, shaped, records, inputs.fetched, inputs.doi_lookup, no_files, base, "f2")
    updates = spark.createDataFrame(
        [("doi:10.1/a", "/p", "u", "/a", None, True)],
        "canonical_id STRING, document_pdf_local_path STRING, document_pdf_url STRING, document_pdfa_path STRING, document_pdfa_error STRING, pdfa_conversion_ok BOOLEAN",
    )
    jobs.backfill_job(spark, updates, ["papers_with_award_mention"], base, "r2", "r4")
    back = spark.read.parquet(sinks.run_path(base, "r4", "papers_with_award_mention"))
    assert ("doi:10.1/a", "/a", True) in cells(back, "canonical_id", "document_pdfa_path", "pdfa_conversion_ok")


def test_pairs_of_papers_and_members_take_their_order_without_a_sort(spark):
    """Places in a source and ids are those of a full sort, but pairs are neither sorted nor counted."""
    rng = random.Random(5)
    first, last = ["Ada", "Al", "Bo", "Mei", "Max"], ["Lund", "Roth", "Vance"]
    members = spark.createDataFrame([(f"{f} {s}", (len(f) + len(s)) if s != "Roth" else None) for f in first for s in last], "name STRING, member_ord INT")
    rows, item = [], 0
    for _ in range(60):
        authors = [{"full_name": f"{rng.choice(last)}, {rng.choice(first)}"} for _ in range(rng.randint(0, 3))]
        meta = {"titles": [{"title": rng.choice(["T", "", "U"])}], "authors": authors, "control_number": (item := item + 1)}
        page, row = rng.randrange(3), item * 300_000  # over several blocks of rows
        rows.append(("inspirehep", "Feed", page, row, json.dumps({"hits": {"hits": [{"metadata": meta}]}})))
        crossref = {"title": ["C"], "author": [{"given": rng.choice(first), "family": rng.choice(last)}], "URL": f"https://e.org/{item}"}
        rows.append(("crossref", f"{rng.choice(first)} {rng.choice(last)}", page, row, json.dumps({"message": {"items": [crossref]}})))
    raw = spark.createDataFrame(rows, RAW_PAYLOADS)
    params = jobs.RunParams("r", "t0", "t1", 2025, ScanSpec(phrases=("x",)), enabled_sources=("crossref", "inspirehep"))
    records = jobs.normalise_all(raw, members, params)
    ords = {r["name"]: r["member_ord"] for r in members.collect()}
    wanted = {}
    for r in records.collect():
        at = ords.get(r["member_name"])
        wanted.setdefault(r["source"], []).append((at is not None, at or 0, r["member_name"], r["page_no"], r["row_no"], r["source_id"]))
    expected = [(s, k[2], k[5], n) for s in ("crossref", "inspirehep") for n, k in enumerate(sorted(wanted[s]), 1)]
    assert len(wanted["inspirehep"]) > 80 and wanted["crossref"]

    placed = jobs.with_order(records, members, ["source", "member_name", "source_id"], "place")
    found = sorted(placed.collect(), key=lambda r: r["ord"])
    assert [(r["source"], r["member_name"], r["source_id"], r["place"]) for r in found] == expected
    plain = sorted(jobs.with_order(records, members).collect(), key=lambda r: r["ord"])
    assert [(r["source"], r["member_name"], r["source_id"]) for r in plain] == [e[:3] for e in expected]
    pairs = placed.filter("source = 'inspirehep'")._jdf.queryExecution().optimizedPlan().toString()
    above = pairs.split("Join")[0]
    assert not any(step in above for step in ("Sort", "Window", "Aggregate"))

    # With the fields that are read, papers of the feed are written narrow, and payloads are not parsed again for their pairs.
    fields = ["source", "member_name", "source_id", "title"]
    narrow = jobs.normalise_all(raw, members, params, fields)
    plans = [df.filter("source = 'inspirehep'")._jdf.queryExecution().optimizedPlan().toString() for df in (records, narrow)]
    assert ["from_json" in p for p in plans] == [True, False]
    again = sorted(jobs.with_order(narrow, members, fields, "place").collect(), key=lambda r: r["ord"])
    assert [(r["source"], r["member_name"], r["source_id"], r["place"]) for r in again] == expected
    assert {(r["ord"], r["title"]) for r in again} == {(r["ord"], r["title"]) for r in plain}


def test_streaming_state(spark, tmp_path):
    from test_merge_and_order import ROWS, _records

    landed, path = str(tmp_path / "landed"), str(tmp_path / "state")
    _records(spark, ROWS[:2]).coalesce(1).write.parquet(landed)
    go = lambda: state.run_upserts(state.record_stream(spark, landed), path, str(tmp_path / "progress")).awaitTermination()
    go()
    _records(spark, [ROWS[1] | {"ord": 9, "title": "Longer title again"}, ROWS[4]]).coalesce(1).write.mode("append").parquet(landed)
    go()
    got = cells(state.current_state(spark, path), "canonical_id", "status", "first_seen_at", "last_seen_at")
    assert got == [("doi:10.1/a", "changed", "batch-0", "batch-1"), ("title:2020:longertitle", "new", "batch-1", "batch-1")]
    small = state.compact(spark, path, str(tmp_path / "compacted"), 1)
    assert cells(small, "canonical_id", "status", "first_seen_at", "last_seen_at") == got


def _land(spark, rows, folder):
    from test_merge_and_order import _records

    _records(spark, rows).coalesce(1).write.mode("append").parquet(folder)


def test_stream_batches_fold_into_the_batch_merge(spark, tmp_path):
    """Twenty micro-batches give what one gives, and what the batch merge gives; each reads its own records only."""
    from test_merge_and_order import ROWS, _records

    rng = random.Random(4)
    rows = [
        ROWS[i % 5] | {"ord": 100 + i, "title": f"Longer title {'x' * rng.randrange(4)}", "doi": f"10.1/{rng.randrange(6)}", "year": rng.choice([None, 2001, 2002]),
                       "venue": rng.choice([None, "", f"V{i}"]), "authors": [f"A {rng.randrange(5)}", "B C"], "abstract": "a"}
        for i in range(60)
    ]
    rng.shuffle(rows)
    rows[7] = rows[7] | {"ord": (1 << 60) + 1}
    for i in range(20):
        _land(spark, rows[3 * i : 3 * i + 3], str(tmp_path / "landed"))
    found = []
    for name, files in (("many", 1), ("one", None)):
        path = str(tmp_path / name)
        query = state.run_upserts(state.record_stream(spark, str(tmp_path / "landed"), files), path, f"{path}-progress")
        query.awaitTermination()
        found.append(cells(state.current_state(spark, path), "canonical_id", "hash", "title", "doi", "year"))
        read = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
        assert len(read) == (20 if files else 1) and max(read) == min(read)
    keyed = merge.with_canonical_id(_records(spark, rows))
    whole = snapshot.fingerprint(merge.merge_papers(keyed), merge.merge_values(keyed))
    assert found[0] == found[1] == cells(whole, "canonical_id", "hash", "title", "doi", "year")
    rows_written = {r["batch_id"]: r["count"] for r in state.state_rows(spark, str(tmp_path / "many")).groupBy("batch_id").count().collect()}
    assert len(rows_written) == 20 and max(rows_written.values()) <= 3


def test_state_functions_can_be_sent_after_any_other_query(spark):
    """Functions of the stream go to workers by value; what earlier queries left in the library's modules must not go along."""
    from pyspark import cloudpickle

    from citeloom.functions import html, text

    fields = [text.unescape_entities(F.lit("a&amp;b")).alias("t"), html.visible_text(F.lit("<p>x</p>")).alias("v")]
    assert spark.range(1).select(*fields).first() == ("a&b", "x")
    for function in (state._combined, state._fold):
        assert len(cloudpickle.dumps(function)) < 20_000


class _Calls:
    """A state store in memory that counts what the processor asks of it."""

    def __init__(self):
        self.papers, self.held, self.calls = {}, None, []

    def getMapState(self, *_):  # noqa: N802
        return self

    def getValueState(self, *_):  # noqa: N802
        return type("Size", (), {"get": lambda _: self.held, "update": lambda _, v: setattr(self, "held", v)})()

    def iterator(self):
        self.calls.append("walk")
        return iter([((k,), v) for k, v in self.papers.items()])

    def getValue(self, key):  # noqa: N802
        self.calls.append("get")
        return self.papers.get(key[0])

    def updateValue(self, key, value):  # noqa: N802
        self.calls.append("put")
        self.papers[key[0]] = value


def test_papers_of_a_shard_share_their_state_calls(spark, monkeypatch):
    """A call between Spark and Python costs more than the fold of a paper: at most one a paper where many are touched, two where few are."""
    from types import SimpleNamespace

    store, processor = _Calls(), state.PaperStates()
    processor.init(store)

    def go(batch, titles):
        monkeypatch.setattr(state, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(getLocalProperty=lambda _: str(batch))))
        rows = []
        for n, title in titles:
            partial = state.Partial()
            partial.add_scalars((title, len(title), n, 2001, None, None, state.NOWHERE, None, state.NOWHERE))
            rows.append(SimpleNamespace(canonical_id=f"p{n}", partial=partial.text()))
        store.calls.clear()
        out = list(processor.handleInputRows((0,), iter(rows), None))
        return {r.canonical_id: (r.title, r.first_seen_at, r.last_seen_at, r.status) for r in out}, {c: store.calls.count(c) for c in set(store.calls)}

    first, calls = go(0, [(n, "ab") for n in range(200)])
    assert calls == {"put": 200} and first["p7"] == ("ab", "batch-0", "batch-0", "new") and store.held == (200,)
    again, calls = go(1, [(n, "abc" if n < 5 else "a") for n in range(201)])
    assert calls == {"walk": 1, "put": 6} and store.held == (201,)
    assert again["p4"] == ("abc", "batch-0", "batch-1", "changed") and again["p5"] == ("ab", "batch-0", "batch-1", "unchanged")
    assert again["p200"] == ("a", "batch-1", "batch-1", "new")
    few, calls = go(2, [(3, "x"), (3, "abcd"), (900, "y")])
    assert calls == {"get": 2, "put": 2} and store.held == (202,)
    assert few == {"p3": ("abcd", "batch-0", "batch-2", "changed"), "p900": ("y", "batch-2", "batch-2", "new")}


def test_one_shard_gives_what_many_give(spark, tmp_path):
    """Two walks over a shard, then single reads: states, first batches and hashes are those of one paper a shard and of the batch merge."""
    from test_merge_and_order import ROWS, _records

    landed = str(tmp_path / "landed")
    base = ROWS[0] | {"doi": None, "authors": ["A B"], "abstract": "a"}
    rows = [base | {"ord": n, "title": f"Title of number {n}"} for n in range(30)]
    late = [base | {"ord": 100 + n, "title": f"Title of number {n}", "authors": ["A B", "C D"] if n % 2 else ["A B"]} for n in range(35)]
    last = [base | {"ord": 200, "title": "Title of number 4", "authors": ["E F"]}, base | {"ord": 201, "title": "Another title"}]
    found = []
    for name, shards in (("one", 1), ("many", state.SHARDS)):
        path = str(tmp_path / name)
        for part in (rows, late, last):
            _land(spark, part, f"{landed}-{name}")
            state.run_upserts(state.record_stream(spark, f"{landed}-{name}"), path, f"{path}-progress", shards).awaitTermination()
        found.append(cells(state.current_state(spark, path), "canonical_id", "hash", "status", "first_seen_at", "last_seen_at"))
    assert found[0] == found[1]
    statuses = [r[2:] for r in found[0]]
    assert statuses.count(("changed", "batch-0", "batch-1")) == 15 and statuses.count(("unchanged", "batch-0", "batch-1")) == 14
    assert statuses.count(("new", "batch-1", "batch-1")) == 5
    assert statuses.count(("changed", "batch-0", "batch-2")) == 1 and statuses.count(("new", "batch-2", "batch-2")) == 1
    keyed = merge.with_canonical_id(_records(spark, rows + late + last))
    whole = snapshot.fingerprint(merge.merge_papers(keyed), merge.merge_values(keyed))
    assert [r[:2] for r in found[0]] == cells(whole, "canonical_id", "hash")


def test_keys_that_come_back_after_months_are_not_new(spark, tmp_path):
    landed = str(tmp_path / "events")
    batches = [[("a", "2024-01-01"), ("b", "2024-01-01"), ("a", "2024-01-02")], [("c", "2024-02-01")], [("a", "2024-04-10"), ("d", "2023-01-01"), ("b", "2024-04-11")], [("c", "2025-01-01")]]
    for rows in batches:
        spark.createDataFrame(rows, "key STRING, day STRING").coalesce(1).write.mode("append").parquet(landed)
        stream = spark.readStream.schema("key STRING, day STRING").parquet(landed)
        out = state.first_arrivals(stream, "key").writeStream.format("parquet").option("path", str(tmp_path / "out"))
        out.option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert cells(got, "key") == [("a",), ("b",), ("c",), ("d",)]
