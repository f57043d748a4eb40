"""SimHash near-dedup by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits. Fingerprints that differ in 3 bits or fewer differ in
at most one bit in each of two segments (were two segments to differ in two bits or more, that would be 4). The perfect
binary Golay code of length 23 gives each segment one codeword within distance 3 and 5.3 codewords on average within
distance 4; segments at distance 1 share their nearest codewords within that reach. So each pair of segments gives
keys of two codeword indices (24 bits): the reachable codewords of one with the nearest one of the other, both ways.
Linked fingerprints meet under one key, and are verified by their differing bits.

A key with many fingerprints is no group of one task: beyond BLOCK fingerprints it is cut into blocks, and pairs of blocks
are compared in tasks of their own. A bucket reports links that span its linked fingerprints, not all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.common import components, map_columns
from citeloom.session import materialise

SHINGLE = 3
SEED = 42
MAX_BITS = 3
#: Fingerprints of one key that are compared at once; more are dealt to several tasks.
BLOCK = 2048
#: Up to so many fingerprints of a key are compared by shifting the sorted column against itself.
SHIFTS = 12

#: Generator of the (23, 12) Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
SEGMENTS = ((0, 23), (23, 23), (46, 18))
PAIRS = ((0, 1), (0, 2), (1, 2))


def _syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words divided by the generator."""
    rest = words.copy()
    for bit in range(22, 10, -1):
        rest ^= ((rest >> bit) & 1) * (GENERATOR << (bit - 11))
    return rest


def _error_table() -> np.ndarray:
    """Error pattern of up to three bits for each of the 2,048 syndromes; each has exactly one."""
    one = 1 << np.arange(23)
    patterns = {0}
    for _ in range(3):
        patterns |= {p | int(b) for p in patterns for b in one}
    errors = np.array(sorted(patterns), np.int64)
    table = np.zeros(2048, np.int64)
    table[_syndrome(errors)] = errors
    return table


ERRORS = _error_table()


def nearest(words: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the codeword within distance 3 of each 23-bit word."""
    return (words ^ ERRORS[_syndrome(words)]) >> 11


def reachable(words: np.ndarray) -> np.ndarray:
    """Indices of the codewords within distance 4, as columns; repeats are -1, the nearest one comes first."""
    found = np.stack([nearest(words), *(nearest(words ^ (1 << bit)) for bit in range(23))], axis=1)
    rest = np.sort(found[:, 1:], axis=1)
    rest[:, 1:][rest[:, 1:] == rest[:, :-1]] = -1
    rest[rest == found[:, :1]] = -1
    return np.concatenate([found[:, :1], rest], axis=1)


def golay_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket keys of fingerprints: the index of the fingerprint in the input, and the key."""
    own = prints.view(np.uint64)
    parts = [((own >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    near = [reachable(p) for p in parts]
    rows, keys = [], []
    for p, (a, b) in enumerate(PAIRS):
        left = np.where(near[a] >= 0, (p << 24) | (near[a] << 12) | near[b][:, :1], -1)
        right = np.where(near[b] >= 0, (p << 24) | (near[a][:, :1] << 12) | near[b], -1)[:, 1:]
        both = np.concatenate([left, right], axis=1)
        at, column = np.nonzero(both >= 0)
        rows.append(at)
        keys.append(both[at, column])
    return np.concatenate(rows), np.concatenate(keys)


def fingerprint(text: str | None) -> int:
    """SimHash of the lower-cased word shingles of a whole text, as a signed 64-bit number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = min(SHINGLE, len(words))
    stops = ends[n - 1 :].tolist()
    starts = [0, *(ends[: len(words) - n] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return fingerprint_of(np.array([digest(line[a:b], SEED) for a, b in zip(starts, stops, strict=True)], "<u8"))


def fingerprint_of(hashes: np.ndarray) -> int:
    """SimHash of the hashes of a text's shingles, as a signed 64-bit number; zero if there are none."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096].astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, fp) of every document."""

    def run(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column(0), "fp": np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.int64)}

    return map_columns(docs.select(F.col(id_col).cast("long"), "text"), run, "doc_id long, fp long")


def _bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def _spanning(left: np.ndarray, right: np.ndarray | None) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links that connect what the pairs of ``left``, or of ``left`` with ``right``, connect: fewer than there are nodes."""
    nodes = left if right is None else np.unique(np.concatenate([left, right]))
    near = np.concatenate([_bits(nodes[at : at + 256, None], nodes[None, :]) <= MAX_BITS for at in range(0, len(nodes), 256)])
    if right is not None:
        of_left, of_right = np.isin(nodes, left), np.isin(nodes, right)
        near &= (of_left[:, None] & of_right[None, :]) | (of_right[:, None] & of_left[None, :])
    new = np.ones(len(nodes), bool)
    a, b = [], []
    for seed in range(len(nodes)):
        if not new[seed]:
            continue
        new[seed] = False
        edge = np.array([seed])
        while len(edge):
            reached = near[edge][:, new]
            hit = reached.any(axis=0)
            to = np.flatnonzero(new)[hit]
            a.append(nodes[edge[reached[:, hit].argmax(axis=0)]])
            b.append(nodes[to])
            new[to] = False
            edge = to
    return a, b


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of rows sorted by key. Fingerprints of a key beyond BLOCK are passed on with their block number instead."""
    names = ["a", "b", "key", "block"]

    def out(a, b, key, block):
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, key, block)], names)

    def whole(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.array([], int)
        sizes = np.diff(np.r_[starts, len(keys)])
        a, b = [], []
        size = np.repeat(sizes, sizes)
        for lag in range(1, SHIFTS):
            at = np.flatnonzero((keys[lag:] == keys[:-lag]) & (size[lag:] <= SHIFTS))
            at = at[_bits(fps[at], fps[at + lag]) <= MAX_BITS]
            a.append(fps[at])
            b.append(fps[at + lag])
        for i in np.flatnonzero(sizes > SHIFTS).tolist():
            more = _spanning(fps[starts[i] : starts[i] + sizes[i]], None)
            a += more[0]
            b += more[1]
        if a:
            a, b = np.concatenate(a), np.concatenate(b)
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
            zero = np.zeros(len(pairs), np.int64)
            if len(pairs):
                yield out(pairs[:, 0], pairs[:, 1], zero - 1, zero)

    held_k, held_f, large, seen = np.array([], np.int64), np.array([], np.int64), None, 0
    for batch in batches:
        keys = np.concatenate([held_k, batch.column(0).to_numpy()])
        fps = np.concatenate([held_f, batch.column(1).to_numpy()])
        if large is not None:  # the rest of a key that was too large
            n = int(np.searchsorted(keys, large, "right"))
            if n:
                yield out(fps[:n], fps[:n], keys[:n], (seen + np.arange(n)) // BLOCK)
            seen, keys, fps = seen + n, keys[n:], fps[n:]
            if len(keys):
                large = None
        last = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
        yield from whole(keys[:last], fps[:last])
        held_k, held_f = keys[last:], fps[last:]
        if len(held_k) > BLOCK:
            large, seen = int(held_k[0]), len(held_k)
            yield out(held_f, held_f, held_k, np.arange(seen) // BLOCK)
            held_k, held_f = held_k[:0], held_f[:0]
    yield from whole(held_k, held_f)


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between two blocks of a key; rows (key, i, j, block, fp) are sorted by key, i and j."""
    current, parts = None, []

    def flush() -> Iterator[pa.RecordBatch]:
        if current is None:
            return
        block, fp = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        i, j = current[1:]
        a, b = _spanning(fp[block == i], None if i == j else fp[block == j])
        a, b = np.concatenate([*a, np.array([], np.int64)]), np.concatenate([*b, np.array([], np.int64)])
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    for batch in batches:
        at = np.stack([batch.column(c).to_numpy() for c in range(3)], axis=1)
        cuts = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]).any(axis=1)]).tolist()
        for x, y in zip(cuts, [*cuts[1:], len(at)], strict=True):
            now = tuple(at[x].tolist())
            if now != current:
                yield from flush()
                current, parts = now, []
            parts.append((batch.column(3).to_numpy()[x:y], batch.column(4).to_numpy()[x:y]))
    yield from flush()


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """Links (a, b) that span all chains of fingerprints (column ``fp``, each once) with MAX_BITS differing bits or fewer."""

    def keys(batch: pa.RecordBatch) -> dict:
        fp = batch.column(0).to_numpy()
        row, key = golay_keys(fp)
        return {"key": key, "fp": fp[row]}

    keyed = map_columns(prints.select("fp"), keys, "key long, fp long")
    sorted_keys = keyed.repartition("key").sortWithinPartitions("key", "fp")
    first = materialise(sorted_keys.mapInArrow(_bucket_links, "a long, b long, key long, block long"), "bucket-links")
    links = first.where("key < 0").select("a", "b")
    large = first.where("key >= 0").select("key", F.col("a").alias("fp"), "block")
    if not large.isEmpty():
        blocks = large.groupBy("key").agg(F.max("block").alias("last"))
        dealt = large.join(blocks, "key").select(
            "key", "fp", "block", F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("other")
        )
        dealt = dealt.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "fp")
        by_pair = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
        links = links.unionByName(by_pair.mapInArrow(_block_links, "a long, b long"))
    return links.distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``.

    Null and empty texts have fingerprint zero and link like any other. Equal texts, and so repeated rows, share a
    fingerprint and need no link. The component is the smallest id reachable over links, ties (repeated ids) included.
    Other columns are not looked at. An empty table gives an empty table.
    """
    prints = materialise(fingerprints(docs, id_col), "fingerprints")
    nodes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("lowest")), "distinct-fingerprints")
    linked = components(fingerprint_links(nodes))
    groups = nodes.join(linked.select(F.col("node").alias("fp"), "component"), "fp", "left")
    groups = groups.select("fp", "lowest", F.coalesce("component", "fp").alias("component"))
    least = groups.groupBy("component").agg(F.min("lowest").alias("component_id"))
    of_print = groups.join(least, "component").select("fp", "component_id")
    return prints.join(of_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
