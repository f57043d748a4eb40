"""Quality scores without labels: heuristic labellers, a model of their accuracies, and a hashed linear scorer.

Each labeller says good, bad or nothing about a document. The documents are counted by vote pattern over all rows (there are
3^labellers patterns at most), and expectation-maximisation on these counts estimates the share of good documents and how
often each labeller says what for good and bad ones. The posterior of a document's pattern is its weak label. A linear
scorer is then fitted to the weak labels of a bounded sample; it sees hashed n-grams of character classes and hashed
buckets of statistics, so that it judges also what the labellers leave open. All documents are scored with it.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.common import map_columns

WIDTH = 4096
#: Bound of the fitted sample, and rounds of both fits.
SAMPLE_ROWS, EM_ROUNDS, EPOCHS = 4000, 60, 80
#: Labellers speak up on clear signs only: a good document gets a bad vote from one this often at most.
FALSE_ALARM = 0.002
GOOD, BAD, SILENT = 1, 0, 2
STATS = ("words", "word_length", "symbols", "capitals", "repeats", "variety", "sentence", "bars", "same_sentences")

#: Character classes: digits, small and capital letters, blanks, line ends, common and other marks.
_CLASSES = np.full(256, 1, np.uint8)
for _i in range(128):
    _c = chr(_i)
    _CLASSES[_i] = 0 if _c.isdigit() else 1 if _c.islower() else 2 if _c.isupper() else 4 if _c == "\n" else 3 if _c.isspace() else 5 if _c in ",.;:'\"-()" else 6 if _c in "?!" else 7


@dataclass(frozen=True)
class WeakModel:
    """Latent classes: one kind of bad documents per labeller, and the good ones last. ``prior`` has their shares, ``says``
    (labeller x class x vote) what labellers say of them when they vote. Silence says nothing: it weighs 1 in all classes."""

    prior: np.ndarray
    says: np.ndarray

    def shares(self, votes: np.ndarray) -> np.ndarray:
        """Probability of each class for rows of votes."""
        log = np.log(self.says[np.arange(len(self.says)), :, votes]).sum(axis=1) + np.log(self.prior)
        out = np.exp(log - log.max(axis=1, keepdims=True))
        return out / out.sum(axis=1, keepdims=True)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of good for rows of votes."""
        return self.shares(votes)[:, -1]

    def accuracies(self) -> np.ndarray:
        """Share of each labeller's votes that are right."""
        joint = self.says * self.prior[None, :, None]
        return joint[:, -1, GOOD] + joint[:, :-1, BAD].sum(axis=1)


@dataclass(frozen=True)
class Scorer:
    """Weights of the hashed features; the last one is the constant."""

    weights: np.ndarray


def _encoded(text: str) -> np.ndarray:
    return _CLASSES[np.frombuffer(text.encode(), np.uint8)]


def stats(text: str, classes: np.ndarray) -> tuple[float, ...]:
    """Statistics of a whole text, in the order of STATS."""
    words = text.split()
    n = len(words)
    counts = np.bincount(classes, minlength=8)
    letters = counts[1] + counts[2]
    marks = counts[7] - text.count("|")
    sentences = [s for s in text.replace("!", ".").replace("?", ".").replace("\n", ".").split(".") if not s.isspace() and s]
    return (
        n,
        sum(map(len, words)) / n if n else 0.0,
        marks / max(1, len(classes)),
        counts[2] / max(1, letters),
        sum(map(eq, words, words[1:])) / max(1, n - 1),
        len(set(words)) / n if n else 0.0,
        n / max(1, len(sentences)),
        text.count("|") / max(1, n),
        1 - len(set(sentences)) / len(sentences) if sentences else 0.0,
    )


def votes(s: np.ndarray) -> np.ndarray:
    """Votes of the labellers on rows of statistics: short texts, word length, symbols, capitals, repeats, variety, sentences, tables, copies."""
    words, length, symbols, capitals, repeats, variety, sentence, bars, same = s.T
    return np.stack(
        [
            np.where(words < 1, BAD, np.where(words >= 30, GOOD, SILENT)),
            np.where(((length < 2) | (length > 16)) & (words > 10), BAD, np.where((length > 3) & (length < 10), GOOD, SILENT)),
            np.where(symbols > 0.08, BAD, np.where(symbols < 0.02, GOOD, SILENT)),
            np.where(capitals > 0.4, BAD, np.where(capitals < 0.15, GOOD, SILENT)),
            np.where((repeats > 0.15) & (words > 10), BAD, np.where(repeats < 0.03, GOOD, SILENT)),
            np.where((variety < 0.15) & (words > 30), BAD, np.where((variety > 0.35) | (words > 1500), GOOD, SILENT)),
            np.where((sentence > 120) | ((sentence < 1.3) & (words > 20)), BAD, np.where((sentence > 3) & (sentence < 60), GOOD, SILENT)),
            np.where(bars > 0.1, BAD, np.where(bars > 0, SILENT, GOOD)),
            np.where((same > 0.4) & (words > 10), BAD, np.where(same < 0.1, GOOD, SILENT)),
        ],
        axis=1,
    )


N_LABELLERS = 9


def fit_weak(patterns: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS) -> WeakModel:
    """EM over vote patterns with their counts.

    Bad documents are bad in one way or another, and a labeller that sees one way calls the others good; so each labeller
    begins with a class of the documents that it calls bad, alone or with others. The rate of false alarms among good
    documents is bounded, as EM would else take the rarer ways for noise.
    """
    labellers = patterns.shape[1]
    bad = patterns == BAD
    p = np.concatenate([bad * 0.95 / np.maximum(1, bad.sum(axis=1, keepdims=True)), np.where(bad.any(axis=1), 0.05, 0.95)[:, None]], axis=1) + 0.001
    p /= p.sum(axis=1, keepdims=True)
    model = WeakModel(np.full(labellers + 1, 1 / (labellers + 1)), np.ones((labellers, labellers + 1, 3)))
    for _ in range(rounds):
        weighted = p * counts[:, None].astype(float)
        says = np.stack([(patterns == v).T.astype(float) @ weighted for v in (BAD, GOOD)], axis=2) + 0.05
        says /= says.sum(axis=2, keepdims=True)
        says[:, -1, BAD] = np.minimum(says[:, -1, BAD], FALSE_ALARM)
        says[:, -1, GOOD] = 1 - says[:, -1, BAD]
        says = np.concatenate([says, np.ones_like(says[:, :, :1])], axis=2)
        prior = weighted.sum(axis=0) + 0.5
        model = WeakModel(prior / prior.sum(), says)
        p = model.shares(patterns)
    return model


def _grams(classes: np.ndarray) -> np.ndarray:
    """Buckets of n-grams (1 to 4) of runs of character classes; runs of four and more are marked as long."""
    if not len(classes):
        return np.array([], np.int64)
    cuts = np.flatnonzero(np.r_[True, classes[1:] != classes[:-1]])
    runs = classes[cuts].astype(np.uint32) * 2 + (np.diff(np.r_[cuts, len(classes)]) >= 4)
    out = []
    code = np.zeros(len(runs), np.uint32)
    for n in range(1, 5):
        code = code[: len(runs) - n + 1] * np.uint32(17) + runs[n - 1 :] + np.uint32(1)
        out.append((code * np.uint32(2_654_435_761)) >> np.uint32(20))
    return np.concatenate(out).astype(np.int64)


def _bucketed(row: tuple[float, ...]) -> list[int]:
    """Buckets of the statistics on a logarithmic scale."""
    return [zlib.crc32(f"{name}:{int(4 * np.log2(1 + 64 * v))}".encode()) % WIDTH for name, v in zip(STATS, row, strict=True)]


def hashed(classes: np.ndarray, row: tuple[float, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of a text and their values: shares of n-grams, and one for each statistic's bucket."""
    sums = np.bincount(_grams(classes), minlength=WIDTH) * (10.0 / max(1, len(classes)))
    np.add.at(sums, _bucketed(row), 0.3)
    at = np.flatnonzero(sums)
    return at, sums[at]


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS) -> Scorer:
    """Logistic regression on soft labels by Adam over the whole sample."""
    at = np.concatenate([r[0] for r in rows]) if rows else np.array([], np.int64)
    value = np.concatenate([r[1] for r in rows]) if rows else np.array([])
    owner = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    w, first, second = np.zeros(WIDTH + 1), np.zeros(WIDTH + 1), np.zeros(WIDTH + 1)
    for step in range(1, epochs + 1):
        scores = np.bincount(owner, weights=w[at] * value, minlength=len(rows)) + w[-1]
        miss = labels - 1 / (1 + np.exp(-np.clip(scores, -500, 500)))
        gradient = np.r_[np.bincount(at, weights=value * miss[owner], minlength=WIDTH), miss.sum()] / max(1, len(rows)) - 1e-4 * w
        first += 0.1 * (gradient - first)
        second += 0.01 * (gradient * gradient - second)
        w += 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Scorer(w)


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[WeakModel, Scorer]:
    """Both models. The vote patterns count all rows of ``docs``; the scorer sees a hash sample of some ``sample_rows`` rows."""
    names = [f"v{i}" for i in range(N_LABELLERS)]

    def vote(batch: pa.RecordBatch) -> dict:
        texts = [t or "" for t in batch.column(0).to_pylist()]
        found = votes(np.array([stats(t, _encoded(t)) for t in texts], float).reshape(-1, len(STATS)))
        return {n: found[:, i].astype(np.int32) for i, n in enumerate(names)}

    counted = map_columns(docs.select("text"), vote, ", ".join(f"{n} int" for n in names)).groupBy(*names).agg(F.count("*").alias("n"))
    rows = counted.collect()  # 3^9 patterns at most
    if not rows:
        return fit_weak(np.full((1, N_LABELLERS), SILENT), np.ones(1)), Scorer(np.zeros(WIDTH + 1))
    order = sorted(rows, key=lambda r: tuple(r))
    weak = fit_weak(np.array([[r[n] for n in names] for r in order]), np.array([r["n"] for r in order]))
    share = max(1, -(-sum(r["n"] for r in rows) // sample_rows))
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0).select("doc_id", "text")

    def featured(batch: pa.RecordBatch) -> dict:
        out: dict = {"doc_id": batch.column(0), "at": [], "value": [], "stats": []}
        for text in batch.column(1).to_pylist():
            classes = _encoded(text or "")
            row = stats(text or "", classes)
            at, value = hashed(classes, row)
            out["at"].append(at)
            out["value"].append(value)
            out["stats"].append([float(v) for v in row])
        return out

    schema = f"doc_id {sample.schema['doc_id'].dataType.simpleString()}, at array<long>, value array<double>, stats array<double>"
    drawn = map_columns(sample, featured, schema).orderBy("doc_id").limit(2 * sample_rows).collect()
    if not drawn:
        return weak, Scorer(np.zeros(WIDTH + 1))
    labels = weak.posterior(votes(np.array([r["stats"] for r in drawn])))
    return weak, fit_scorer([(np.array(r["at"], np.int64), np.array(r["value"])) for r in drawn], labels)


def score(docs: DataFrame, weak: WeakModel, scorer: Scorer, id_col: str = "doc_id") -> DataFrame:
    """(id_col, score, weak_label, keep) of each row of ``docs``; ``keep`` is true from a score of one half on.

    Null and empty texts are scored like texts of no words. Repeated rows are scored alike; other columns are not looked at;
    an empty table gives an empty table.
    """
    sent = docs.sparkSession.sparkContext.broadcast((weak, scorer.weights))

    def run(batch: pa.RecordBatch) -> dict:
        model, weights = sent.value
        rows, scores = [], []
        for text in batch.column(1).to_pylist():
            classes = _encoded(text or "")
            row = stats(text or "", classes)
            at, value = hashed(classes, row)
            rows.append(row)
            scores.append(float(weights[at] @ value + weights[-1]))
        p = 1 / (1 + np.exp(-np.clip(np.array(scores), -500, 500)))
        label = model.posterior(votes(np.array(rows, float).reshape(-1, len(STATS))))
        return {"id": batch.column(0), "score": p, "weak_label": label, "keep": p >= 0.5}

    rows = docs.select(F.col(id_col).alias("id"), "text")
    schema = f"id {rows.schema['id'].dataType.simpleString()}, score double, weak_label double, keep boolean"
    return map_columns(rows, run, schema).withColumnRenamed("id", id_col)
