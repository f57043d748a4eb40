"""Exact top-k inner product search on an impact-ordered index, score at a time.

The vectors are dealt into blocks. A block's index holds one posting segment for each dimension and quantised component value
(the component without its lowest bits), with the positions of the vectors that have it. For a query, the impact of a
segment is the query's component times the quantised value. Segments are processed by descending impact, in rounds;
each adds its impact to the running scores of its vectors. A vector's score is then bounded from both sides: what is left of
its dimensions lies between the smallest and the largest impact not yet processed, and the bits cut off are bounded.
Processing stops when these bounds prove that all but a few vectors are outside the top k, or when the segments are
through. Whatever the bounds leave possible is scored exactly from the whole components.

The index is a table with one row per block, written to the shared folder. Blocks of queries meet blocks of the index; a
task holds one of each, and the best k of each block are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeloom.session import materialise

SCALE = 1024
#: Rows of a block of vectors and of a block of queries.
VECTOR_BLOCK, QUERY_BLOCK = 8192, 512
#: Quantised values of a component in a block, at most; rounds of processing; vectors that may be left for exact scoring.
LEVELS = 16
ROUNDS = 8
RESCORED = 256


def integer_vectors(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, v): components floor(1024 * x) of the vectors without null or non-finite components; empty vectors take part."""
    whole = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(1e300))
    return df.where(F.col(vector).isNotNull() & F.forall(vector, whole)).select(
        F.col(id_col).cast("long").alias("id"), F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(SCALE)).cast("long")).alias("v")
    )


def _packed(rows: DataFrame, blocks: int, name: str, order: Column) -> DataFrame:
    """Blocks of bounded size as (name, ids, vectors): hashes deal rows evenly over ``blocks`` blocks."""
    dealt = rows.select(F.pmod(order, F.lit(blocks)).cast("long").alias(name), "id", "v")
    return dealt.groupBy(name).agg(F.collect_list(F.struct("id", "v")).alias("rows"))


INDEX_SCHEMA = "block long, ids binary, width long, vectors binary, shift long, dims binary, levels binary, sizes binary, postings binary"


class ImpactIndex:
    """Posting segments of one block of integer vectors (n x d, shorter ones padded with zeros)."""

    def __init__(self, vectors: np.ndarray, shift: int, dims: np.ndarray, levels: np.ndarray, sizes: np.ndarray, postings: np.ndarray):
        self.vectors, self.shift, self.dims, self.levels, self.sizes, self.postings = vectors, shift, dims, levels, sizes, postings
        self.starts = np.cumsum(sizes) - sizes

    @classmethod
    def build(cls, vectors: np.ndarray) -> ImpactIndex:
        """One segment per dimension and quantised value; the values of a block span LEVELS levels or so."""
        widest = int(vectors.max(initial=0) - vectors.min(initial=0)) if vectors.size else 0
        shift = max(0, int(widest // LEVELS).bit_length())
        quantised = vectors >> shift
        dims, levels, sizes, postings = [], [], [], []
        for j in range(vectors.shape[1]):
            order = np.argsort(quantised[:, j], kind="stable").astype(np.int32)
            column = quantised[order, j]
            cuts = np.flatnonzero(np.r_[True, column[1:] != column[:-1]])
            dims.append(np.full(len(cuts), j))
            levels.append(column[cuts])
            sizes.append(np.diff(np.r_[cuts, len(column)]))
            postings.append(order)
        joined = lambda parts, kind: np.concatenate([*parts, np.array([], kind)]).astype(kind)
        return cls(vectors, shift, joined(dims, np.int64), joined(levels, np.int64), joined(sizes, np.int64), joined(postings, np.int32))

    def row(self) -> list:
        """The index without its block number and ids, in the order of INDEX_SCHEMA."""
        return [self.vectors.shape[1], self.vectors.tobytes(), self.shift, *(x.tobytes() for x in (self.dims, self.levels, self.sizes, self.postings))]

    @classmethod
    def of_row(cls, row: dict) -> ImpactIndex:
        """The index that ``row`` wrote."""
        long = lambda name: np.frombuffer(row[name], np.int64)
        n = len(row["ids"]) // 8
        return cls(
            long("vectors").reshape(n, row["width"]), row["shift"], long("dims"), long("levels"), long("sizes"), np.frombuffer(row["postings"], np.int32)
        )

    def top(self, query: np.ndarray, k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Positions and exact scores of at least the k best vectors other than position ``skip``, ties with the last one included."""
        n, d = self.vectors.shape
        query = np.pad(query[:d], (0, max(0, d - len(query))))
        impacts = query[self.dims] * (self.levels << self.shift)
        order = np.argsort(-impacts, kind="stable")
        rest = (1 << self.shift) - 1
        low_bits, high_bits = int(np.minimum(query, 0).sum()) * rest, int(np.maximum(query, 0).sum()) * rest
        scores, left = np.zeros(n, np.int64), np.full(n, d, np.int64)
        least = int(impacts.min(initial=0))
        possible = np.arange(n)
        ends = np.linspace(0, len(order), ROUNDS + 1).astype(int)
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            segments = order[a:b]
            lengths = self.sizes[segments]
            where = self.postings[np.arange(lengths.sum()) + np.repeat(self.starts[segments] - (np.cumsum(lengths) - lengths), lengths)]
            amount = np.repeat(impacts[segments], lengths)
            scores += np.bincount(where, weights=amount, minlength=n).astype(np.int64)
            left -= np.bincount(where, minlength=n)
            most = int(impacts[order[b]]) if b < len(order) else 0
            floor = scores + left * least + low_bits
            if 0 <= skip < n:
                floor[skip] = np.iinfo(np.int64).min
            if n > k:
                threshold = np.partition(floor, n - k)[n - k]
                possible = np.flatnonzero(scores + left * most + high_bits >= threshold)
            if len(possible) <= RESCORED:
                break
        possible = possible[possible != skip]
        exact = self.vectors[possible] @ query
        if len(exact) > k:
            kept = exact >= np.partition(exact, len(exact) - k)[len(exact) - k]
            possible, exact = possible[kept], exact[kept]
        return possible, exact


def _matrix(rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids and padded vectors of a list of (id, v)."""
    ids = rows.field("id").to_numpy(zero_copy_only=False)
    vectors = rows.field("v")
    lengths = pa.compute.list_value_length(vectors).to_numpy(zero_copy_only=False)
    out = np.zeros((len(ids), int(lengths.max(initial=0))), np.int64)
    at = np.repeat(np.arange(len(ids)), lengths)
    within = np.arange(len(at)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[at, within] = vectors.flatten().to_numpy(zero_copy_only=False)
    return ids, out


def build_index(vectors: DataFrame) -> DataFrame:
    """The index of ``vectors`` (id, v) as rows of INDEX_SCHEMA, written once."""
    blocks = _packed(vectors, max(1, -(-vectors.count() // VECTOR_BLOCK)), "block", F.xxhash64("id", "v"))

    names = T.StructType.fromDDL(INDEX_SCHEMA).fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                ids, own = _matrix(one.column(1).flatten())
                cells = [one.column(0)[0].as_py(), ids.astype(np.int64).tobytes(), *ImpactIndex.build(own).row()]
                yield pa.RecordBatch.from_arrays([pa.array([c]) for c in cells], names)

    return materialise(blocks.mapInArrow(run, INDEX_SCHEMA), "impact-index")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k vectors of ``vectors`` (id, v) with the largest integer inner product with each query.

    ``queries`` (id, v) may be rows of ``vectors``; a vector with the query's own id is no candidate. Ties go to the smaller
    id; with fewer than k candidates all are returned. Vectors of unlike length meet as if the shorter one ended in zeros.
    Repeated rows of ``vectors`` are candidates of their own; repeated queries count once. Empty tables give an empty table.
    """
    n_parts = max(1, -(-queries.count() // QUERY_BLOCK))
    asked = _packed(queries.dropDuplicates(["id"]), n_parts, "part", F.xxhash64("id")).withColumnRenamed("rows", "asked")
    parts = F.sequence(F.lit(0).cast("long"), F.lit(n_parts - 1).cast("long"))
    dealt = build_index(vectors).withColumn("part", F.explode(parts))
    met = dealt.join(materialise(asked, "query-blocks"), "part").repartition("block", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pair = batch.slice(i, 1)
                row = pair.drop_columns(["asked"]).to_pylist()[0]
                query_ids, asked_vectors = _matrix(pair.column(pair.schema.get_field_index("asked")).flatten())
                ids, index, out = np.frombuffer(row["ids"], np.int64), ImpactIndex.of_row(row), []
                for query_id, query in zip(query_ids.tolist(), asked_vectors, strict=True):
                    same = np.flatnonzero(ids == query_id)
                    at, score = index.top(query, k + max(0, len(same) - 1), int(same[0]) if len(same) else -1)
                    other = ids[at] != query_id
                    at, score = at[other], score[other]
                    best = np.lexsort((ids[at], -score))[:k]
                    out.append((np.full(len(best), query_id), ids[at[best]], score[best]))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([o[c] for o in out]).astype(np.int64)) for c in range(3)], ["query_id", "vec_id", "score"]
                    )

    found = met.mapInArrow(run, "query_id long, vec_id long, score long")
    ranked = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", ranked.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query_every(vectors: DataFrame, divisor: int) -> DataFrame:
    """The rows whose id is divisible by ``divisor``."""
    return vectors.where(F.pmod(F.col("id"), F.lit(divisor)) == 0)
