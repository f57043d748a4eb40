import hashlib
import itertools
import re
import time

import numpy as np
import pytest
from conftest import SMALL
from llm_fixtures import TEXTS, docs, none

from citeloom.llm import pii
from citeloom.llm.tagger import Tagger

PERSONAL = [
    "mail a.b+c@mail.example.com now", "x@y", "1.2.3.4.5.6 and 256.1.1.1 and 007.1.2.3", "4111 1111 1111 1111", "4111111111111111 4111111111111111",
    "call +1 (017) 555-7713 or +49 30 123", "\U0001f600 +33.1.23.45.67.89", "card 4111-1111-1111-1112", "9" * 300, "@" * 50, "a@b.c" * 40,
    "0" * 5000 + "1.1.1.1", "a@b@c.d.e x@" + "y" * 70 + ".example", "mail " + "n" * 70 + " [@] host.example now",
    "host 10.0.0.1, call (017) 555-7713 now, or 4111.1111.1111.1111 then", "v1.2.3 of 2021-04-05 at 12:30",
]


def brute(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p.lstrip("0")[-4:] or 0) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])
        if 12 <= len(d) <= 19 and total % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


@pytest.fixture(scope="module")
def tagger(spark):
    return pii.fit(spark.read.parquet(f"{SMALL}/documents.parquet"))


def listed(spans):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def check(df, tagger):
    got = {r["doc_id"]: r for r in pii.scan(df, tagger).collect()}
    for r in df.select("doc_id", "text").collect():
        base, row = brute(r["text"]), got[r["doc_id"]]
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(b[1] == i for b in base) for i in range(4)]
        assert row["base_sha256"] == hashlib.sha256(listed(base).encode()).hexdigest()
        spans = row["spans"].split(",") if row["spans"] else []
        assert set(listed(base).split(",") if base else []) <= set(spans) and len(spans) == len(base) + row["n_added"]


def test_edges_match_brute_force(spark, tagger):
    check(docs(spark, TEXTS + PERSONAL), tagger)
    assert pii.scan(none(docs(spark)), tagger).count() == 0
    assert pii.fit(none(docs(spark))).params


def test_table_matches_brute_force(spark, tagger):
    check(spark.read.parquet(f"{SMALL}/documents.parquet"), tagger)


def test_tagger_finds_forms_that_patterns_miss(tagger):
    text = "reach of the thing (017) 555-7713 then the"
    found = pii.tagged_spans(tagger, [text])[0]
    assert any(pii.KINDS[k] == "phone" and text[a:b] == "(017) 555-7713" for a, k, b in found) and not brute(text)


def test_held_out_accuracy(spark, tagger):
    texts = [r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id >= 100").select("text").collect()]
    x, y = pii.training_windows(texts, 300, seed=99)
    tags, _ = tagger.decode(x)
    assert (tags == y).mean() > 0.99 and (tags == y)[y > 0].mean() > 0.95


def test_gradients():
    rng = np.random.default_rng(0)
    model = Tagger.new(6, 3, 4, seed=2)
    model.params = {k: v.astype(np.float64) for k, v in model.params.items()}
    x, y = rng.integers(0, 6, (3, 5)), rng.integers(0, 4, (3, 5))
    _, grads = model.loss_and_gradients(x, y)
    for name, grad in grads.items():
        value = model.params[name]
        for at in list(np.ndindex(value.shape))[:6]:
            value[at] += 1e-3
            up, _ = model.loss_and_gradients(x, y)
            value[at] -= 2e-3
            down, _ = model.loss_and_gradients(x, y)
            value[at] += 1e-3
            assert abs((up - down) / 2e-3 - grad[at]) < 1e-3


def test_decoding_finds_the_best_path():
    model = Tagger.new(5, 3, 3, seed=4)
    x = np.random.default_rng(1).integers(0, 5, (4, 4))
    scores, tags = model.emissions(x), model.decode(x)[0]
    for row in range(4):
        def total(path, row=row):
            s = model.params["begin"][path[0]] + sum(scores[t, row, p] for t, p in enumerate(path))
            return s + sum(model.params["move"][a, b] for a, b in itertools.pairwise(path))

        assert np.isclose(total(tuple(tags[row])), max(total(p) for p in itertools.product(range(3), repeat=4)), atol=1e-5)


def test_reconciled_spans_are_the_best_set():
    rng = np.random.default_rng(2)
    for _ in range(40):
        spans = [(int(a), int(k), int(a) + int(n), float(s)) for a, k, n, s in zip(rng.integers(0, 20, 7), rng.integers(0, 4, 7), rng.integers(1, 8, 7), rng.random(7) + 0.1, strict=True)]
        best = 0.0
        for n in range(8):
            for some in itertools.combinations(spans, n):
                if all(p[2] <= q[0] or q[2] <= p[0] for p, q in itertools.combinations(some, 2)):
                    best = max(best, sum(s[3] for s in some))
        score = {}
        for a, k, b, s in spans:
            score[a, k, b] = max(s, score.get((a, k, b), 0))
        assert np.isclose(sum(score[s] for s in pii.reconcile(spans)), best)


def test_windows_cover_every_sign():
    rng = np.random.default_rng(8)
    for _ in range(200):
        text = "".join(rng.choice(list("ab 1@"), int(rng.integers(0, 600)), p=[0.45, 0.4, 0.1, 0.03, 0.02]))
        starts = pii.windows_of(text)
        for m in re.finditer("[0-9@]", text):
            inside = [s for s in starts if s <= m.start() < s + pii.WINDOW]
            assert inside, (m.start(), starts)


@pytest.mark.parametrize("text", ["a" * 1_000_000 + " x@y.zz", "0" * 1_000_000 + "1.1.1.1", "7" * 1_000_000, "9.9." * 250_000, "@" * 1_000_000, "+1" + "(" * 1_000_000])
def test_a_million_characters_in_one_run_take_linear_time(text):
    start = time.monotonic()
    spans = pii.base_spans(text)
    assert len(spans) == {"a": 1, "0": 1, "9": 125_000}.get(text[0], 0) and time.monotonic() - start < 30
