"""Vector codes against looking at every entry."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from citeloom.llm import vector_codes as codes


@pytest.mark.parametrize("high", [2, 5, 1000, 10**8])
def test_nearest_entries_are_exact(high):
    rng, measured, all_ = np.random.default_rng(high), 0, 0
    for _ in range(150):
        entries = rng.integers(-high, high, (rng.integers(1, 60), rng.integers(1, 6)))
        queries = np.r_[rng.integers(-high, high, (100, entries.shape[1])), entries]
        index = codes.Gnat(entries)
        found, away = index.nearest(queries)
        want = codes.squared(entries, queries)
        assert (found == want.argmin(axis=1)).all() and (away == want.min(axis=1)).all()
        measured, all_ = measured + index.measured, all_ + want.size
    assert measured < 0.9 * all_  # whole subtrees are left out


def brute(rows):
    """rows: (vec_id, label, components)."""
    kept = [(i, lab, np.array([int(np.floor(4096 * float(x))) for x in v])) for i, lab, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2].tolist()))
    books = [[r[2].reshape(8, -1)[p] for r in order[:16]] for p in range(8)]

    def near(x, book):
        d = [int(((x - e) ** 2).sum()) for e in book]
        return d.index(min(d)), min(d)

    for _ in range(6):
        for p in range(8):
            own = [r[2].reshape(8, -1)[p] for r in kept]
            at = [near(x, books[p])[0] for x in own]
            for e in range(len(books[p])):
                mine = [x for x, a in zip(own, at, strict=True) if a == e]
                if mine:
                    books[p][e] = np.sum(mine, axis=0) // len(mine)
    digest = hashlib.sha256(",".join(str(int(c)) for b in books for e in b for c in e).encode()).hexdigest()
    out, of_label = [], {}
    for i, lab, v in kept:
        found = [near(v.reshape(8, -1)[p], books[p]) for p in range(8)]
        error = sum(f[1] for f in found)
        of_label[lab] = of_label.get(lab, 0) + error
        out.append((i, lab, "".join(f"{f[0]:02x}" for f in found), error))
    return sorted(((i, c, e, of_label[lab], digest) for i, lab, c, e in out), key=repr)


def check(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumn("code", F.lit("clash")).withColumn("v", F.lit(1))
    narrow = [(i, lab, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, lab, v in rows]
    assert sorted(map(tuple, codes.compressed(df).collect()), key=repr) == brute(narrow)


def vectors(n, width=16, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, [0, 1, None][i % 3], rng.normal(0, 1, width).round(rng.integers(1, 4)).tolist()) for i in range(n)]


def test_table_with_awkward_rows(spark):
    rows = vectors(120)
    rows += [(200, 1, None), (201, 1, [None] + [0.5] * 15), (202, 1, [float("nan")] * 16), (203, 1, [float("inf")] * 16), (None, 0, [0.25] * 16)]
    check(spark, [*rows, rows[3], rows[3], (5, 1, [0.5] * 16)])


def test_few_equal_and_no_rows(spark):
    check(spark, vectors(5))
    check(spark, [(i, 0, [1.0, -1.0] * 4) for i in range(30)])
    empty = spark.createDataFrame([(1, 1, None)], "vec_id long, label int, embedding array<float>")
    got = codes.compressed(empty)
    assert got.count() == 0 and got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


@pytest.mark.parametrize("row", [[1.0] * 8, [1.0] * 15, [1e30] * 16])
def test_vectors_that_have_no_code_are_refused(spark, row):
    df = spark.createDataFrame([*vectors(20), (99, 0, row)], "vec_id long, label int, embedding array<float>")
    with pytest.raises(Exception, match="must have|too large"):
        codes.compressed(df).collect()
