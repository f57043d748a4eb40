"""Merkle proofs against trees built row by row."""

import hashlib
import random
import zlib

import pytest
from llm_fixtures import docs, none

from citeloom.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def cell(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        first = i - i % 8
        out.append((level[first:i], level[i + 1 : first + 8]))
        i //= 8
    return out


def brute(rows):
    groups = {}
    for r in rows:
        leaf = h(*[cell(r[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")])
        groups.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf, r))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda t: t[:3])
        trees[lang] = tree([t[2] for t in groups[lang]])
    top = tree([trees[lang][-1][0] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        for i, (_, _, leaf, r) in enumerate(groups[lang]):
            proof, node = path(trees[lang], i) + path(top, k), leaf
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                low = None if r["text"] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])
                node = h(*[cell(r[c]) for c in ("doc_id", "source", "lang", "n_chars")], cell(low))
            for before, after in proof:
                node = h(*before, node, *after)
            flat = [d for before, after in proof for d in (*before, *after)]
            out.append((r["doc_id"], leaf, trees[lang][-1][0], top[-1][0], h(*flat), node, node == top[-1][0]))
    return sorted(out, key=repr)


def check(df):
    got = merkle.verified_documents(df)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(df.collect())


def test_awkward_rows(spark):
    df = docs(spark)
    nameless = spark.createDataFrame([(None, "No id", None, "s", None, 1, "x", 0.5), (None, None, "zz", None, 3, 1, "x", 0.5)], df.schema)
    check(df.unionByName(nameless))
    check(df.limit(1))
    assert merkle.verified_documents(none(df)).count() == 0


@pytest.mark.parametrize("part", [merkle.PART, 64])
def test_large_and_many_groups(spark, monkeypatch, part):
    """One group climbs more than one round of blocks; single rows, full and broken runs; parts cut groups anywhere."""
    monkeypatch.setattr(merkle, "PART", part)
    monkeypatch.setattr(merkle, "CLIMB", 2)
    rng = random.Random(5)
    rows = [(i, f"T{rng.random()}" if i % 2 else f"t{i}", "hot" if i % 3 else f"l{i % 400}", "s", i) for i in range(900)]
    rows += [(10_000 + i, "X", "eight", None, None) for i in range(8)] + [(20_000 + i, None, "nine", "s", 0) for i in range(9)]
    check(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))


def test_a_part_fetches_the_least_set_of_nodes():
    counts = merkle.sizes(8**4)
    assert counts == [4096, 512, 64, 8, 1]
    assert merkle.missing(set(range(8**4)), counts) == []
    assert len(merkle.missing({0}, counts)) == 4 * 7
    assert len(merkle.missing({0, 1}, counts)) == 6 + 3 * 7  # two leaves of one run share all that lies above
    assert merkle.missing(set(range(8)), merkle.sizes(9)) == [(1, 1)]


def test_proofs_of_some_leaves(spark):
    """Any subset can be asked for; a part then fetches leaves of its neighbours too."""
    rows = spark.createDataFrame([(i, f"text {i}", "ab"[i % 2], "s", i) for i in range(700)], "doc_id long, text string, lang string, source string, n_chars long")
    manifest = merkle.build(merkle.row_leaves(rows), "lang", ["doc_id"])
    some = manifest.leaves.where("doc_id % 97 = 5").withColumnRenamed("doc_id", "id")
    want = {r[0]: r for r in brute(rows.collect())}
    got = merkle.proofs(manifest, some).collect()
    assert len(got) == 8 and all(tuple(r) == want[r["id"]] for r in got)
