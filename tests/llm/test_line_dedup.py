from collections import Counter

import numpy as np
from llm_fixtures import TEXTS, docs, none, rows
from pyspark.sql import functions as F

from citeloom.llm import line_dedup as ld

BLANKS = " \t\n\x0b\x0c\r"


def brute(texts, least):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))
    seen = Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if seen[key(x)] < least]
        out.append((None if t is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def test_edges_match_brute_force(spark):
    df = docs(spark)
    got = ld.dedup_lines(df, min_docs=2)
    assert set(got.columns) == {*df.columns, "n_lines", "n_dropped"}
    assert rows(got, "text", "n_lines", "n_dropped") == brute([*TEXTS, TEXTS[-1]], 2)
    assert ld.dedup_lines(none(df)).count() == 0


def test_columns_of_any_name_stay(spark):
    df = docs(spark).withColumn("_gone", F.lit("mine")).withColumn("n_lines", F.lit("theirs"))
    got = ld.dedup_lines(df, min_docs=2)
    assert set(got.columns) == {*df.columns, "n_dropped"} and {r["_gone"] for r in got.collect()} == {"mine"}


def test_small_groups_of_filters_give_the_same(spark):
    texts = [f"line {i % 40}\nline {i % 7}\nown {i}" for i in range(300)]
    df = docs(spark, texts)
    index = ld.insert_documents(ld.empty_index(spark, 5), df)
    hot = index.counts.where("docs >= 5").select("hi", "lo").withColumn("sign", __import__("pyspark").sql.functions.lit(1))
    many = ld.LineIndex(index.counts, ld._edited(None, hot, 4, 16), 5, 4, 16)
    assert rows(ld.drop_frequent_lines(df, many, group_bytes=300), "text", "n_dropped") == rows(ld.drop_frequent_lines(df, index), "text", "n_dropped")


def test_deleting_documents_brings_lines_back(spark):
    first = docs(spark, [f"shared\nown {i}\nlate {i // 2}" for i in range(12)])
    second = docs(spark, [f"Shared \nmore {i}" for i in range(3)])
    one = ld.insert_documents(ld.empty_index(spark, 13), first)
    two = ld.insert_documents(one, second)
    back = ld.delete_documents(two, second)
    assert rows(two.counts, "docs") != rows(one.counts, "docs")
    assert rows(back.counts, "hi", "lo", "docs") == rows(one.counts, "hi", "lo", "docs")
    for a, b in ((back, one), (two, ld.insert_documents(ld.empty_index(spark, 13), first.unionByName(second)))):
        assert rows(ld.drop_frequent_lines(first, a), "text") == rows(ld.drop_frequent_lines(first, b), "text")


def test_cuckoo_filter_holds_and_forgets():
    rng = np.random.default_rng(3)
    hi, lo = rng.integers(-(2**63), 2**63 - 1, (2, 3000), dtype=np.int64)
    cells = np.zeros((1024, ld.SLOTS), np.uint32)
    _, a, b, mark = ld._places(hi, lo, 1, 1024)
    ld.cuckoo_insert(cells, a, b, mark)
    held = np.zeros(1, np.int64)
    assert ld._answers(cells[None], held, 1, 1024, hi, lo).all()
    ld.cuckoo_delete(cells, a[:1500], b[:1500], mark[:1500])
    assert ld._answers(cells[None], held, 1, 1024, hi[1500:], lo[1500:]).all()
    assert not ld._answers(cells[None], held, 1, 1024, hi[:1500], lo[:1500]).any()
