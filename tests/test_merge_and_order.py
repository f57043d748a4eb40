"""Order-aware operators: exactness against plain Python, independence of partitioning, small blocks."""

import random

from conftest import cells
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from citeloom.functions.scan import ScanSpec
from citeloom.operators import merge, naming, order
from citeloom.schemas import SOURCE_RECORDS


def _records(spark, rows):
    full = []
    for r in rows:
        base = dict(
            source="crossref", source_id="s", member_name="M One", title="T", year=None, published_date=None, venue=None,
            doi=None, authors=[], abstract=None, landing_page_url=None, pdf_url=None, relevance_score=0.5,
        ) | r
        full.append(tuple(base[c.split()[0]] for c in SOURCE_RECORDS.split(", ")))
    return spark.createDataFrame(full, SOURCE_RECORDS)


ROWS = [
    dict(ord=1, doi="10.1/A", title=" Short  one ", year=2021, published_date="2021-05-01", authors=["A B", "C D"], abstract="aaa"),
    dict(ord=2, doi="10.1/a", title="Longer title", year=2020, venue="V2", authors=["C D", " E  F "], abstract="bbb", source="dblp"),
    dict(ord=3, doi="10.1/a", title="Longer titlX", year=None, published_date="2020-01-01", venue="V3", member_name="M Two"),
    dict(ord=4, title="   ", doi="10.1/z"),
    dict(ord=5, title="Longer title", year=2020, landing_page_url="https://e.org/1"),
    dict(ord=6, title="longer TITLE!", year=2020, landing_page_url="https://e.org/2", pdf_url="https://e.org/2.pdf"),
]


def test_merge_rules(spark):
    keyed = merge.with_canonical_id(_records(spark, ROWS))
    got = {r["canonical_id"]: r for r in merge.merge_papers(keyed).collect()}
    assert set(got) == {"doi:10.1/a", "title:2020:longertitle"}
    a = got["doi:10.1/a"]
    assert (a["title"], a["year"], a["published_date"], a["venue"], a["doi"], a["abstract"]) == (
        "Longer title", 2020, "2020-01-01", "V2", "10.1/A", "aaa"
    )
    nested = {r["canonical_id"]: r for r in merge.nest_values(merge.merge_values(keyed)).collect()}
    assert nested["doi:10.1/a"]["authors"] == ["A B", "C D", "E F"]
    assert nested["doi:10.1/a"]["members"] == ["M One", "M Two"]
    assert nested["doi:10.1/a"]["sources"] == ["crossref", "dblp"]
    assert nested["title:2020:longertitle"]["urls"] == ["https://e.org/1", "https://e.org/2"]


def test_merge_does_not_depend_on_partitions(spark):
    base = _records(spark, ROWS)
    for n in (1, 3, 7):
        keyed = merge.with_canonical_id(base.repartition(n, F.rand(n)))
        for step in (merge.merge_papers, merge.merge_values):
            left, right = step(keyed), step(merge.with_canonical_id(base))
            assert cells(left, *left.columns) == cells(right, *left.columns)


def test_mentions_come_from_running_texts(spark):
    spec = ScanSpec(phrases=("Alpha Beta",))
    rows = [
        dict(ord=1, doi="10.1/q", title="About Alpha", abstract="beta decay"),
        dict(ord=2, doi="10.1/q", title="Beta", abstract="An alpha  beta note that is longer"),
        dict(ord=3, doi="10.1/q", title="x", abstract="nothing"),
        dict(ord=4, doi="10.1/r", title="Alpha", abstract=None),
    ]
    keyed = merge.with_canonical_id(_records(spark, rows))
    for block in (1, 2, 1000):
        got = merge.metadata_mentions(keyed, spec, block_rows=block)
        assert cells(got, "canonical_id", "mention", "first_ord", "first_pos") == [
            ("doi:10.1/q", "Alpha beta", 1, 0), ("doi:10.1/q", "alpha beta", 2, 0)
        ]


def test_rank_and_running_best_by_blocks(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.6 else f"k{rng.randrange(4)}", i, "x" * rng.randrange(1, 9)) for i in range(300)]
    df = spark.createDataFrame(rows, "k STRING, ord BIGINT, t STRING").repartition(5)
    seen, best, want = {}, {}, []
    for k, i, t in rows:
        seen[k] = seen.get(k, 0) + 1
        best[k] = t if len(t) > len(best.get(k, "")) else best[k]
        want.append((k, i, seen[k], best[k]))
    for block in (7, 64, 10_000):
        got = order.rank_in_key(df, ["k"], "ord", "rank", block)
        got = order.running_best(got, ["k"], "ord", {"t": "b"}, block)
        assert sorted(tuple(r) for r in got.select("k", "ord", "rank", "b").collect()) == sorted(want)


def test_first_last_best_top(spark):
    df = spark.createDataFrame(
        [("a", 3, 1.0, "z"), ("a", 1, 2.0, "y"), ("a", 2, 2.0, "x"), ("b", 9, 0.5, None)], "k STRING, o INT, s DOUBLE, v STRING"
    )
    assert cells(order.first_per_key(df, ["k"], ["o"]), "k", "v") == [("a", "y"), ("b", None)]
    assert cells(order.last_per_key(df, ["k"], ["o"]), "k", "v") == [("a", "z"), ("b", None)]
    assert cells(order.best_per_key(df, ["k"], "s", "o"), "k", "v") == [("a", "y"), ("b", None)]
    assert cells(order.top_n_per_key(df, ["k"], [F.col("o")], 2), "k", "o") == [("a", 1), ("a", 2), ("b", 9)]


def test_top_n_limits_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    plan = order.top_n_per_key(df, ["k"], [F.col("id")], 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def plain_names(rows):
    used, out = set(), {}
    for stem, o in sorted(rows, key=lambda r: r[1]):
        name, k = stem, 2
        while name in used:
            name, k = f"{stem}_{k}", k + 1
        used.add(name)
        out[o] = name
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["a", "a_2", "a_3", "a_2_2", "a_10", "b_2", "b", "a_02"]), min_size=1, max_size=40))
def test_unique_names_equal_the_sequential_rule(spark, stems):
    rows = [(s, i * 3) for i, s in enumerate(stems)]
    df = spark.createDataFrame(rows, "stem STRING, ord BIGINT")
    got = {r["ord"]: r["name"] for r in naming.unique_names(df, block_rows=10).collect()}
    assert got == plain_names(rows)


def test_a_stem_with_many_numbered_ones_needs_no_array(spark):
    """Half of a hundred thousand rows are one stem, the others its numbered forms, early and late ones mixed."""
    n = 50_000
    rng = random.Random(2)
    numbers = rng.sample(range(2, 80_000), n)
    rows = [("x", i) for i in range(n)] + [(f"x_{k}", n // 2 + i) for i, k in enumerate(numbers)]
    rng.shuffle(rows)
    rows = [(stem, 2 * o + (stem != "x")) for stem, o in rows]
    df = spark.createDataFrame(rows, "stem STRING, ord BIGINT")
    named = naming.unique_names(df, block_rows=10_000)
    assert {r["ord"]: r["name"] for r in named.collect()} == plain_names_fast(rows)
    assert "collect_list" not in named._jdf.queryExecution().executedPlan().toString()


def plain_names_fast(rows):
    """As ``plain_names``, but no number is tried twice by one stem."""
    used, following, out = set(), {}, {}
    for stem, o in sorted(rows, key=lambda r: r[1]):
        name, k = stem, following.get(stem, 2)
        while name in used:
            name, k = f"{stem}_{k}", k + 1
        following[stem] = k
        used.add(name)
        out[o] = name
    return out


def test_salted_lookup_join_equals_the_plain_one(spark):
    from citeloom.operators.joins import lookup_join

    many = spark.createDataFrame([("hot" if i % 3 else f"k{i % 7}", i) for i in range(200)], "k STRING, i INT")
    one = spark.createDataFrame([("hot", "x"), ("hot", "y"), ("k1", "z"), ("unused", "q")], "k STRING, v STRING")
    for how in ("left", "inner"):
        plain = lookup_join(many, one, ["k"], how)
        assert cells(lookup_join(many, one, ["k"], how, salts=8), "k", "i", "v") == cells(plain, "k", "i", "v")


def test_merge_folds_combine_before_the_shuffle(spark):
    keyed = merge.with_canonical_id(_records(spark, ROWS))
    for step, partial in ((merge.merge_papers, "partial_max_by"), (merge.merge_values, "partial_min")):
        plan = step(keyed)._jdf.queryExecution().executedPlan().toString()
        assert partial in plan and "collect_list" not in plan
