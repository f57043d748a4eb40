"""Vector code compression: parts of vectors become the index of their nearest codebook entry, found through a GNAT over the entries.

A GNAT node holds split points and deals its other entries to the nearest one. For every split point and every such group it
stores the least and greatest distance between them. A query measures its distance to the split points; a group whose stored
range can't meet the query's distance give or take the best distance so far is left out with its whole subtree. Distances
are roots of whole numbers: bounds are rounded away from elimination, a group goes only if it is strictly farther, and what
is measured is compared in whole numbers, ties to the lower index. So the result is that of looking at every entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeloom.llm.common import prepare
from citeloom.session import materialise

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: Split points of a GNAT node; a group of no more entries than this is a leaf, whose entries are measured.
SPLITS = 4
#: Relative error that bounds allow for the rounding of roots and sums.
SLACK = 2.0**-48


def squared(points: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Squared distances (queries x points) in whole numbers."""
    difference = queries[:, None, :] - points[None, :, :]
    return np.einsum("qpd,qpd->qp", difference, difference)


@dataclass
class _Node:
    splits: np.ndarray  # indexes of split points
    least: np.ndarray  # (split, group): bounds of distances between a split point and a group's entries
    most: np.ndarray
    groups: list  # of each split point: a node, an array of indexes, or None


class Gnat:
    """Exact nearest entries of a codebook part (entries x dimensions, whole numbers)."""

    def __init__(self, entries: np.ndarray, splits: int = SPLITS):
        self.entries, self.width = entries, splits
        self.measured = 0
        self.root = self._node(np.arange(len(entries))) if len(entries) else None

    def _node(self, members: np.ndarray):
        if len(members) <= self.width:
            return members
        between = squared(self.entries[members], self.entries[members])
        chosen = [0]  # the first entry, then always the one farthest from those chosen
        while len(chosen) < self.width:
            away = between[chosen].min(axis=0)
            away[chosen] = -1
            chosen.append(int(away.argmax()))
        rest = np.setdiff1d(np.arange(len(members)), chosen)
        nearest = np.argmin(between[np.ix_(chosen, rest)], axis=0)
        roots = np.sqrt(between.astype(np.float64))
        least, most, groups = np.zeros((self.width, self.width)), np.zeros((self.width, self.width)), []
        for g in range(self.width):
            own = rest[nearest == g]
            groups.append(self._node(members[own]) if len(own) else None)
            if len(own):
                away = roots[np.ix_(chosen, own)]
                least[:, g], most[:, g] = away.min(axis=1) * (1 - SLACK), away.max(axis=1) * (1 + SLACK)
        return _Node(members[chosen], least, most, groups)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each query's nearest entry, ties to the lower index."""
        best = np.full(len(queries), np.iinfo(np.int64).max)
        index = np.full(len(queries), len(self.entries))
        if self.root is not None:
            self._search(self.root, queries, np.arange(len(queries)), best, index)
        return index, best

    def _measure(self, members: np.ndarray, queries: np.ndarray, rows: np.ndarray, best: np.ndarray, index: np.ndarray) -> np.ndarray:
        away = squared(self.entries[members], queries[rows])
        self.measured += away.size
        for column, entry in enumerate(members.tolist()):
            d = away[:, column]
            better = (d < best[rows]) | ((d == best[rows]) & (entry < index[rows]))
            best[rows[better]], index[rows[better]] = d[better], entry
        return away

    def _search(self, node, queries: np.ndarray, rows: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
        if isinstance(node, np.ndarray):
            self._measure(node, queries, rows, best, index)
            return
        away = np.sqrt(self._measure(node.splits, queries, rows, best, index).astype(np.float64))
        low, high = away * (1 - SLACK), away * (1 + SLACK)
        for g, group in enumerate(node.groups):
            if group is None:
                continue
            radius = (np.sqrt(best[rows].astype(np.float64)) * (1 + SLACK))[:, None]
            gone = ((low - radius) * (1 - SLACK) > node.most[None, :, g]) | ((high + radius) * (1 + SLACK) < node.least[None, :, g])
            alive = ~gone.any(axis=1)
            if alive.any():
                self._search(group, queries, rows[alive], best, index)


def whole_vectors(table: DataFrame, id_col: str, vector_col: str, label_col: str | None) -> DataFrame:
    """(vec_id, label, v): rows whose vector is whole and finite, components as floor(SCALE * x)."""
    x = F.col(vector_col)
    fine = x.isNotNull() & F.forall(x, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    label = F.lit(None).cast("int") if label_col is None else F.col(label_col)
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(SCALE))))
    return table.where(fine).select(F.col(id_col).alias("vec_id"), label.alias("label"), whole.alias("v"))


def _block(column: pa.ListArray, width: int) -> np.ndarray:
    """Vectors of one batch as a matrix; their distances must fit into 64 bits."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) != width * len(column) or len(set(np.diff(column.offsets.to_numpy()).tolist()) - {width}):
        raise ValueError(f"all vectors must have {width} components")
    if len(flat) and max(int(flat.max()), -int(flat.min())) > int((2**62 / (4 * width)) ** 0.5):
        raise ValueError("components too large for whole squared distances of 64 bits")
    return flat.reshape(len(column), width)


def _codes(vectors: np.ndarray, index: list[Gnat]) -> tuple[np.ndarray, np.ndarray]:
    """Entry indexes (rows x parts) and squared distances summed over parts."""
    width = vectors.shape[1] // len(index)
    found = [g.nearest(vectors[:, p * width : (p + 1) * width]) for p, g in enumerate(index)]
    return np.stack([f[0] for f in found], axis=1), np.sum([f[1] for f in found], axis=0)


@dataclass(frozen=True)
class Codebooks:
    """``entries`` (parts x entries x dimensions) of trained codebooks."""

    entries: np.ndarray

    @property
    def width(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    @property
    def sha256(self) -> str:
        """Digest of all components by part, entry and position."""
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def first_books(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks | None:
    """Codebooks of the vectors with the smallest ids (ties by components); None if there are none."""
    first = vectors.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    if not first:
        return None
    width = len(first[0]["v"])
    if width % parts or any(len(r["v"]) != width for r in first):
        raise ValueError(f"vectors must have one length, a multiple of {parts}")
    return Codebooks(np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, width // parts).transpose(1, 0, 2).copy())


def improved(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every part goes to its nearest entry, each used entry becomes the floored mean of its parts.

    A task sends the sums of its entries, as many as there are in the codebooks, and the driver gets their totals only.
    """
    parts, entries, _ = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = [Gnat(e) for e in books.entries]
        sums, counts = np.zeros(books.entries.shape, object), np.zeros((parts, entries), np.int64)
        for batch in batches:
            vectors = _block(batch.column(0), books.width)
            codes = _codes(vectors, index)[0]
            for p in range(parts):
                own = np.zeros(books.entries.shape[1:], np.int64)
                np.add.at(own, codes[:, p], vectors.reshape(len(vectors), parts, -1)[:, p])
                sums[p] += own
                counts[p] += np.bincount(codes[:, p], minlength=entries)
        at = [(p, e, j) for p in range(parts) for e in range(entries) if counts[p, e] for j in range(-1, books.entries.shape[2])]
        if at:
            value = [int(counts[p, e]) if j < 0 else int(sums[p, e, j]) for p, e, j in at]
            columns = [pa.array(c, pa.int32()) for c in zip(*at, strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(value, pa.int64())], ["part", "entry", "place", "value"])

    sums = vectors.select("v").mapInArrow(run, "part int, entry int, place int, value long")
    totals = {(r["part"], r["entry"], r["place"]): int(r["value"]) for r in sums.groupBy("part", "entry", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()}
    out = books.entries.copy()
    for (p, e, j), value in totals.items():
        if j >= 0:
            out[p, e, j] = value // totals[p, e, -1]
    return Codebooks(out)


def fit(vectors: DataFrame, rounds: int = ROUNDS, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks | None:
    """Codebooks of all ``vectors`` (vec_id, v) after ``rounds`` rounds; None if there are none."""
    books = first_books(vectors, parts, entries)
    for _ in range(rounds if books else 0):
        books = improved(vectors, books)
    return books


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """Adds ``code`` (two hex digits per part) and ``error`` (squared distance) to ``vectors`` (vec_id, label, v), in place of ``v``."""
    schema = T.StructType([f for f in vectors.schema if f.name != "v"]).add("code", "string").add("error", "long")
    names, at = schema.fieldNames(), vectors.columns.index("v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = [Gnat(e) for e in books.entries]
        for batch in batches:
            codes, error = _codes(_block(batch.column(at), books.width), index)
            text = codes.astype(np.uint8).tobytes().hex()
            size = 2 * codes.shape[1]
            kept = [c for i, c in enumerate(batch.columns) if i != at]
            yield pa.RecordBatch.from_arrays([*kept, pa.array([text[i : i + size] for i in range(0, len(text), size)]), pa.array(error, pa.int64())], names)

    return vectors.mapInArrow(run, schema)


def compressed(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of each row of ``table`` whose vector is whole and finite.

    ``label_error`` sums errors over equal labels; nulls are one label. Rows without an id are coded like any other; repeated
    rows count as rows of their own; where ids tie among the first entries, components decide. Fewer rows than
    entries give smaller codebooks. Other columns are not looked at. An empty table, or one without whole vectors, gives an
    empty table. Vectors of differing lengths, of lengths that are no multiple of the parts, or with components whose squared
    distances exceed 64 bits are refused with an error.
    """
    prepare(table.sparkSession)
    vectors = materialise(whole_vectors(table, id_col, vector_col, label_col), "whole-vectors")
    books = fit(vectors)
    columns = [F.col("vec_id").alias(id_col), "code", "error", "label_error", F.lit(books.sha256 if books else None).alias("codebooks_sha256")]
    if books is None:
        empty = vectors.drop("v").withColumn("code", F.lit("")).withColumn("error", F.lit(0).cast("long")).withColumn("label_error", F.lit(0).cast("long"))
        return empty.where("false").select(*columns[:-1], F.lit("").alias("codebooks_sha256"))
    coded = materialise(encode(vectors, books), "vector-codes")
    of_label = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(of_label, F.col("label").eqNullSafe(F.col("_label"))).select(*columns)
