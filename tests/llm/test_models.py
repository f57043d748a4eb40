"""Quality scores, languages and the exact search: held-out accuracy and brute force."""

import numpy as np
import pytest
from conftest import SMALL
from llm_fixtures import TEXTS, docs, none
from pyspark.sql import functions as F

from citeloom.llm import language, quality, topk

MIDDLE = "/root/testdata/sf0.01"


def test_quality_agrees_with_labels(spark):
    df = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    got = quality.score(df, *quality.fit(df)).join(spark.read.parquet(f"{MIDDLE}/labels.parquet"), "doc_id")
    n = {(r["quality"], r["keep"]): r["count"] for r in got.groupBy("quality", "keep").count().collect()}
    assert n.get((1, False), 0) <= 0.01 * n[1, True]
    assert n.get((0, True), 0) <= 0.1 * n[0, False]


def test_quality_edges(spark):
    df = docs(spark)
    got = quality.score(df, *quality.fit(df)).collect()
    assert len(got) == len(TEXTS) + 1 and all(0 <= r["score"] <= 1 and 0 <= r["weak_label"] <= 1 for r in got)
    assert quality.score(none(df), *quality.fit(none(df))).count() == 0


def test_weak_model_finds_accuracies():
    rng = np.random.default_rng(0)
    y = rng.random(20_000) < 0.8
    seen = np.stack([np.where(rng.random(20_000) < 0.3, quality.SILENT, np.where(y, 1, (rng.random(20_000) > 0.9).astype(int))) for _ in range(4)], axis=1)
    patterns, counts = np.unique(seen, axis=0, return_counts=True)
    model = quality.fit_weak(patterns, counts)
    spoke = (seen != quality.SILENT).any(axis=1)
    assert ((model.posterior(seen) >= 0.5) == y)[spoke].mean() > 0.98


def test_language_of_documents_and_pages(spark):
    df = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    model = language.fit(df)
    got = language.identify(language.document_rows(df), model, "doc_id").join(df.select("doc_id", F.col("lang").alias("want")), "doc_id")
    assert got.where("lang <> want").count() <= 5 and got.where("not keep").count() <= 5
    hidden = language.document_rows(df).withColumn("declared", F.lit(None).cast("string")).withColumn("host", F.lit(None).cast("string"))
    alone = language.identify(hidden, model, "doc_id").join(df.select("doc_id", F.col("lang").alias("want")), "doc_id")
    assert alone.where("lang <> want").count() <= 10
    pages = language.page_rows(spark.read.parquet(f"{MIDDLE}/pages.parquet"))
    declared = pages.where("declared is not null").count()
    judged = language.identify(pages, model, "page_id")
    assert declared == pages.count() and judged.where("lang = declared").count() >= 0.98 * declared


def test_language_edges(spark):
    df = docs(spark)
    model = language.fit(spark.read.parquet(f"{SMALL}/documents.parquet"))
    got = {r["doc_id"]: r for r in language.identify(language.document_rows(df), model, "doc_id").collect()}
    assert len(got) == len(TEXTS)
    for i in (0, 1, 2, 3, 12, 13):  # no letters
        assert got[i]["lang"] == "und" and not got[i]["keep"]
    assert language.identify(language.document_rows(none(df)), model, "doc_id").count() == 0
    assert language.fit(none(df)).languages == []
    kept = language.known_languages(df)
    assert kept.columns == df.columns and kept.where("doc_id < 4").count() == 0


def test_posteriors_match_a_direct_computation(spark):
    names, weights = ["de", "en"], np.full((language.BUCKETS, 3), -np.log(language.BUCKETS), np.float32)
    rng = np.random.default_rng(0)
    weights[:, :2] = np.log(rng.dirichlet(np.ones(language.BUCKETS), 2)).T
    model = language.TrigramModel(names, weights)
    rows = [(i, f"text number {'abc'[i % 3]} xyz {'q' * (i % 5)}", ["de", "en", None][i % 3], ["a.b.org", "c.b.org", "d.net", None][i % 4]) for i in range(40)]
    got = {r["id"]: r for r in language.identify(spark.createDataFrame(rows, "id long, text string, declared string, host string"), model, "id").collect()}

    def normal(x):
        e = np.exp(x - x.max(axis=-1, keepdims=True))
        return e / e.sum(axis=-1, keepdims=True)

    ll = np.zeros((40, 3))
    for i, text, *_ in rows:
        at, _ = language._trigrams([text])
        ll[i] = weights[at].sum(axis=0, dtype=float) * min(len(at), language.MOST_TRIGRAMS) / len(at)
    p = normal(ll)
    told = {d: p[[r[2] == d for r in rows]].sum(axis=0) for d in names}
    of_class = sum(told.values())
    for d in names:
        says = np.log((told[d] + np.array([0.8 if x == d else 0.2 / 3 for x in [*names, "und"]])) / (of_class + 1))
        ll[[r[2] == d for r in rows]] += says
    p = normal(ll)
    prior = (p.sum(axis=0) + 1) / (p.sum() + 3)
    for i, _, _, host in rows:
        q = prior
        for part in ([host.split(".")[-1], ".".join(host.split(".")[-2:]), host] if host else []):
            own = p[[bool(r[3]) and (r[3] == part or r[3].endswith("." + part)) for r in rows]].sum(axis=0)
            q = (own + language.STRENGTH * q) / (own.sum() + language.STRENGTH)
        want = normal(ll[i] + np.log(q))
        assert got[i]["lang"] == [*names, "und"][int(want.argmax())] and abs(got[i]["posterior"] - want.max()) < 1e-4


@pytest.mark.parametrize("hot", [False, True])
def test_search_matches_brute_force(spark, hot):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((700, 8))
    if hot:
        x[rng.random(700) < 0.4] = x[0]
    rows = [(i, [float(v) for v in x[i]], 1) for i in range(700)]
    rows += [(700, None, 1), (800, [1.0, None], 1), (900, [float("nan")] * 8, 1), (1000, [float("inf")] * 8, 1), (1100, [], 1), (1200, [3.0, -1.0], 1), rows[5], rows[100]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    vectors = topk.integer_vectors(df, "vec_id", "embedding")
    got = sorted(tuple(r) for r in topk.top_k(vectors, topk.query_every(vectors, 100)).collect())
    whole = [(i, [int(np.floor(1024 * v)) for v in e]) for i, e, _ in rows if e is not None and all(v is not None and np.isfinite(v) for v in e)]
    want = []
    for q, qv in {i: v for i, v in whole if i % 100 == 0}.items():
        scores = sorted((-sum(a * b for a, b in zip(qv, v, strict=False)), i) for i, v in whole if i != q)[:10]
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)]
    assert got == sorted(want)
    assert topk.top_k(vectors.where("false"), vectors.where("false")).count() == 0
    few = vectors.where("id < 4")
    assert topk.top_k(few, few.where("id = 0")).count() == 3


def test_index_stops_on_proof_only():
    rng = np.random.default_rng(6)
    vectors = rng.integers(-300, 300, (5000, 16))
    vectors[:40] += 500
    index = topk.ImpactIndex.build(vectors)
    for query in rng.integers(-300, 300, (20, 16)):
        at, scores = index.top(query, 10, skip=7)
        exact = np.delete(vectors @ query, 7)
        assert sorted(scores)[::-1][:10] == sorted(exact.tolist())[::-1][:10] and 7 not in at
