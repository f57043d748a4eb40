"""Near-copies against brute-force Jaccard of five-word shingles."""

import random

import numpy as np
import pytest
from llm_fixtures import docs, none
from pyspark.sql import functions as F

import corpus_pipeline
from citeloom.llm import near_copies

MIDDLE = "/root/testdata/sf0.01"


def brute_kept(pairs):
    """Ids that stay, by comparing all pairs that share a shingle."""
    sets, of_shingle = {}, {}
    for d, text in pairs:
        words = (text or "").encode().lower().split()
        n = min(5, len(words))
        sets[d] = {b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)} if words else {b""}
        for s in sets[d]:
            of_shingle.setdefault(s, []).append(d)
    group = {d: d for d in sets}

    def find(d):
        while group[d] != d:
            d = group[d]
        return d

    for a in sets:
        for b in {x for s in sets[a] for x in of_shingle[s] if x < a}:
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                group[max(x, y)] = min(x, y)
    return sorted(d for d in sets if find(d) == d)


def stays(spark, df):
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    return sorted(r["doc_id"] for r in stage(spark, df, MIDDLE).select("doc_id").collect())


def test_stage_matches_brute_force_jaccard(spark):
    df = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    assert stays(spark, df) == brute_kept([(r["doc_id"], r["text"]) for r in df.collect()])


def test_edges(spark):
    df = docs(spark)
    assert stays(spark, df) == brute_kept(sorted({r["doc_id"]: r["text"] for r in df.collect()}.items()))
    assert near_copies.keep_one_of_each(none(df)).count() == 0


def test_rows_without_an_id_stay_beside_repeated_ids(spark):
    rows = [(None, "one text of its own"), (None, "another text of its own"), (None, "a third"), (7, "the same words"), (7, "the same words"), (7, "the same words")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [near_copies.keep_one_of_each(d).collect() for d in (df, df.orderBy(F.desc("text")))]
    for got in kept:
        assert sorted((r["text"] for r in got)) == ["a third", "another text of its own", "one text of its own", "the same words"]


@pytest.mark.parametrize("block", [near_copies.BLOCK, 16])
def test_large_groups_and_chains(spark, monkeypatch, block):
    monkeypatch.setattr(near_copies, "BLOCK", block)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(150):  # near-copies of one text, some of them a little too far from the first
        words = list(base)
        for _ in range(rng.choice([1, 2, 4, 6])):
            words[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    for i in range(60):  # a chain: each is near to the next one only
        rows.append((1000 + i, " ".join(f"c{j}" for j in range(8 * i, 8 * i + 200))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert stays(spark, df) == brute_kept(rows)


def test_close_fingerprints_are_candidates_without_any_band(spark, monkeypatch):
    """The SimHash step finds near-copies by itself: with no MinHash keys those of few differing bits are still linked, others are not."""
    monkeypatch.setattr(near_copies, "band_keys", lambda hashes: np.array([], np.int64))
    base = [f"w{i}" for i in range(2000)]
    rows = [(1, " ".join(base)), (2, " ".join([*base, "x"])), (3, " ".join(base[::-1])), (4, " ".join(base).upper())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    prints = [near_copies.simhash.fingerprint_of(near_copies.shingles(t)) for _, t in rows]
    assert 0 < (prints[0] ^ prints[1]).bit_count() <= 3 or prints[0] == prints[1]
    assert stays(spark, df) == [1, 3]


def test_links_between_two_blocks_span_both():
    sets = [np.arange(i, i + 100, dtype=np.uint64) for i in range(0, 60, 5)]
    assert len(near_copies.spanning(sets)) == len(sets) - 1
    assert len(near_copies.spanning(sets, np.arange(len(sets)) % 2)) == len(sets) - 1
