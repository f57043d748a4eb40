from collections import defaultdict

from conftest import SMALL
from llm_fixtures import docs, none
from pyspark.sql import functions as F

from citeloom.llm import mixing


def test_edges(spark):
    df = docs(spark)
    got = mixing.taken_words(df).collect()
    assert len(got) == df.count()
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
    sizes = defaultdict(int)
    for r in got:
        sizes[r["source"]] += r["size"]
    assert all(r["source_size"] == sizes[r["source"]] for r in got)
    assert mixing.taken_words(none(df)).count() == 0
    assert mixing.taken_words(docs(spark, [None, "", " "])).where("taken <> 0 or target <> 0").count() == 0


def refilled(sizes):
    """Targets by resharing the excess step by step."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(sizes.values())
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if share * weight[s] >= 2 * sizes[s]}
        if not full:
            target |= {s: share * weight[s] for s in open_}
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def test_targets_and_taken_words_on_a_table(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.col("source")))
    got = mixing.taken_words(df).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.taken_words(df.orderBy(F.desc("doc_id"))).collect()))
    taken = defaultdict(int)
    for r in got:
        taken[r["source"]] += r["taken"]
    want = refilled({r["source"]: r["source_size"] for r in got})
    for r in got:
        assert abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, r["target"])
    for source, words in taken.items():
        assert abs(words - want[source]) <= 3 + 0.05 * want[source]


def test_every_stretch_of_the_schedule_holds_the_sources_in_their_shares(spark):
    rows = [(i, "w " * 50, f"s{i % 4}") for i in range(800)]
    mix = mixing.plan_mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    total = {r["source"]: r["slots"] for r in mix.targets.collect()}
    slots = sorted(tuple(r) for r in mix.schedule.select("slot", "source").collect())
    for at in range(0, len(slots) - 100, 100):
        part = [s for _, s in slots[at : at + 100]]
        for source, n in total.items():
            assert abs(part.count(source) - 100 * n / sum(total.values())) <= 5
    pieces = mixing.mix_pieces(mix)
    assert pieces.agg(F.sum("words")).first()[0] == sum(r["taken"] for r in mixing.taken_words(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect())


def test_small_sources_come_near_their_targets_beside_a_large_one(spark):
    rows = [(i, "w " * 300, "hot") for i in range(2000)] + [(10_000 + i, "w " * 100, f"s{i // 30:02}") for i in range(1200)]
    rows += [(20_000 + i, "w w w w w", f"tiny{i}") for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken, target = defaultdict(int), {}
    for r in mixing.taken_words(df).collect():
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    for source, words in target.items():
        assert abs(taken[source] - words) <= 0.08 * words + 2, source


def test_targets_are_met_at_every_corpus_size(spark):
    """200 sources of 3,000 words beside three that hold the rest; words are drawn as numbers, so a huge corpus costs no texts."""
    for total in (13_000_000, 120_000_000):
        small = [(f"s{i:03}", 3000) for i in range(200)]
        large = [(f"h{i}", total // 3) for i in range(3)]
        per_doc = [(s, n, max(1, n // 1000)) for s, n in small + large]
        rows = spark.createDataFrame(per_doc, "source string, words long, docs long").selectExpr(
            "source", "words", "docs", "explode(sequence(1, least(docs, 300))) AS i"
        ).selectExpr("concat(source, i) AS doc_id", "source", "CAST(words / least(docs, 300) AS BIGINT) AS size")
        mix = mixing.plan_mix(rows.withColumn("text", F.lit("")), sizes=F.col("size"))
        taken = {r["source"]: r["n"] for r in mixing.mix_pieces(mix).groupBy("source").agg(F.sum("words").alias("n")).collect()}
        for r in mix.targets.collect():
            assert abs(taken[r["source"]] / r["target"] - 1) <= 0.02, (total, r["source"])
