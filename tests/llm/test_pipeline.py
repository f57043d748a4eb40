"""The corpus pipeline, each stage against a brute-force version on its own input."""

import re
from collections import Counter

from conftest import SMALL
from llm_fixtures import docs
from test_decontaminate import brute as brute_leaks
from test_line_dedup import brute as brute_lines
from test_near_copies import brute_kept

import corpus_pipeline


def check_stage(name, before, after, items):
    """Holds what a stage kept of its input against a brute-force version."""
    ids = lambda rows: Counter(r["doc_id"] for r in rows)
    if name == "language_id":
        assert set(after) <= set(before)
    elif name == "line_dedup":
        assert sorted((r["text"] for r in after), key=repr) == sorted((r[0] for r in brute_lines([r["text"] for r in before], 10)), key=repr)
        assert ids(after) == ids(before) and all(r["n_chars"] == len(r["text"] or "") for r in after)
    elif name == "near_dedup":
        assert ids(after) == Counter(brute_kept(sorted({r["doc_id"]: r["text"] for r in before}.items())))
    elif name == "decontamination":
        gone = {d for d, *_ in brute_leaks([(r["doc_id"], r["text"]) for r in before], items)}
        assert ids(after) == ids(r for r in before if r["doc_id"] not in gone)
        return gone
    else:
        assert ids(after) == ids(before) and all(0 <= r["taken"] <= 2 * r["size"] for r in after)
        words = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in before}
        assert all(r["size"] == words[r["doc_id"]] for r in after)


def through_stages(spark, df):
    """Runs all stages, each on what the one before kept; returns what each kept and the documents that hold benchmark items."""
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    kept, gone = {}, set()
    for name, stage in corpus_pipeline.STAGES:
        before = df.collect()
        df = stage(spark, df, SMALL)
        kept[name] = df.collect()
        df = spark.createDataFrame(kept[name], df.schema)
        if name != "source_mix":
            assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        gone |= check_stage(name, before, kept[name], items) or set()
    return kept, gone


def test_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "near_dedup", "decontamination", "source_mix"]
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept, gone = through_stages(spark, df)
    assert len(kept["language_id"]) >= 0.98 * df.count() and gone


def test_run_is_the_stages_in_a_row(spark):
    assert corpus_pipeline.run(spark, SMALL).columns == ["doc_id", "source", "size", "source_size", "target", "taken"]


def test_awkward_documents_pass_all_stages(spark):
    kept, _ = through_stages(spark, docs(spark).select("doc_id", "text", "lang", "source", "n_chars"))
    assert {r["doc_id"] for r in kept["source_mix"]} == {r["doc_id"] for r in kept["near_dedup"]} and len(kept["source_mix"]) > 0
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs(spark).select("doc_id", "text", "lang", "source", "n_chars").where("false"), SMALL)
        assert empty.count() == 0, name
