"""Near-copies by word shingles: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Candidates are found by SimHash: fingerprints of the shingle sets that differ in few bits meet under Golay-code keys (``simhash``).
Copies at 0.8 may differ in more bits than those keys reach, so all that share one of BANDS keys of ROWS MinHash values each are
candidates too; a pair at 0.8 shares none with probability 1.4e-7. Every link is verified on whole shingle sets before anything is
connected through it.

First the linked fingerprints are compared, and each node with one other: the smallest of the smallest nodes of its keys. Most groups
are connected by that, and keys whose nodes all are need nothing more. In the keys that stay open each node is compared with the key's smallest
one, each such pair once, however many keys it shares. Jaccard distance is a metric: nothing within 0.2 of the
smallest node can link to what is beyond 0.4 of it, so where nothing lies between, those linked to it are done. What is left of a
key, if its nodes are not connected by then, is cut into blocks of at most some BLOCK sets, and pairs of blocks are
compared in tasks of their own; keys that leave the same nodes are compared once. A node that many are compared with is
sent once per BLOCK of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm import simhash
from citeloom.llm.common import components, map_columns
from citeloom.session import materialise

SHINGLE = 5
SEED = 42
#: Jaccard similarity of near-copies, as a fraction.
LEAST = (4, 5)
BANDS, ROWS = 30, 4
#: Shingle sets that are compared at once.
BLOCK = 512
#: Nodes whose ids (8 bytes each) go to all tasks that read texts again; beyond that texts are shuffled to their ids.
MOST_SENT = 2_000_000

FACTORS = np.random.default_rng(SEED).integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None) -> np.ndarray:
    """Hashes of the distinct lower-cased word shingles of a whole text, sorted; a text of fewer words is one shingle."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.array([], np.uint64)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = min(SHINGLE, len(words))
    starts = [0, *(ends[: len(words) - n] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(line[a:b], SEED) for a, b in zip(starts, ends[n - 1 :].tolist(), strict=True)], np.uint64))


def node_of(hashes: np.ndarray) -> int:
    """Digest of a shingle set; equal sets are one node."""
    return xxhash.xxh64_intdigest(hashes.tobytes(), SEED) - (1 << 63)


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One key per band from the MinHash values of a set; an empty set has none."""
    if not len(hashes):
        return np.array([], np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 512):
        np.minimum(least, (FACTORS[:, None] * hashes[None, at : at + 512]).min(axis=1), out=least)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        key = (key ^ column) * MIX
        key ^= key >> np.uint64(32)
    return key.view(np.int64)


def _alike(common, a, b):
    """Whether sets of sizes ``a`` and ``b`` with ``common`` shared elements are near-copies."""
    return common * (LEAST[0] + LEAST[1]) >= (a + b) * LEAST[0]


def spanning(sets: list[np.ndarray], side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect what all near pairs of ``sets``, or those of different ``side``, connect: fewer than there are sets."""
    sizes = np.array([len(s) for s in sets])
    new, links = np.ones(len(sets), bool), []
    for seed in range(len(sets)):
        edge = [seed] if new[seed] else []
        new[seed] = False
        while edge:
            x = edge.pop()
            may = new & (np.minimum(sizes, sizes[x]) * LEAST[1] >= np.maximum(sizes, sizes[x]) * LEAST[0])
            if side is not None:
                may &= side != side[x]
            others = np.flatnonzero(may)
            if not len(others):
                continue
            flat = np.concatenate([sets[i] for i in others])
            found = sets[x][np.minimum(np.searchsorted(sets[x], flat), sizes[x] - 1)] == flat
            common = np.add.reduceat(found.astype(np.int64), np.r_[0, np.cumsum(sizes[others])[:-1]])
            near = others[_alike(common, sizes[others], sizes[x])]
            links += [(x, i) for i in near.tolist()]
            new[near] = False
            edge += near.tolist()
    return links


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside a block or between two; rows (key, i, j, block, node, hashes) are sorted by key, i and j."""
    current, rows = None, []

    def flush() -> Iterator[pa.RecordBatch]:
        if len(rows) > 1:
            side = None if current[1] == current[2] else np.array([r[0] for r in rows])
            links = spanning([r[2] for r in rows], side)
            ends = [pa.array([rows[p[k]][1] for p in links], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(ends, ["a", "b"])

    for batch in batches:
        at = [batch.column(c).to_pylist() for c in range(5)]
        for n, row in enumerate(zip(*at, strict=True)):
            if row[:3] != current:
                yield from flush()
                current, rows = row[:3], []
            rows.append((row[3], row[4], np.sort(batch.column(5)[n].values.to_numpy().view(np.uint64))))
    yield from flush()


def _with_sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, hashes) of the ``wanted`` nodes. Texts are read again for one document of each.

    Repeated ids may bring other texts along, which go.
    """

    def sets(batch: pa.RecordBatch) -> dict:
        found = [shingles(t) for t in batch.column(1).to_pylist()]
        return {"node": [node_of(h) for h in found], "hashes": pa.array([h.view(np.int64) for h in found], pa.list_(pa.int64()))}

    chosen = materialise(nodes.join(wanted, "node").select(F.col("lowest").alias("doc_id")).distinct(), "chosen-texts")
    if chosen.count() <= MOST_SENT:
        chosen = F.broadcast(chosen)
    again = map_columns(docs.select("doc_id", "text").join(chosen, "doc_id", "left_semi"), sets, "node long, hashes array<long>")
    return materialise(again.dropDuplicates(["node"]).join(wanted, "node", "left_semi"), "shingle-sets")


def _scored(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, near, reach) of ``pairs``: whether the sets are near-copies, and whether they are within twice the distance."""
    slices = pairs.groupBy("b").agg(F.ceil(F.count("*") / BLOCK).alias("slices"))
    # Only nodes with more than BLOCK partners have slices; they are one in BLOCK pairs at most.
    hot = materialise(slices.where("slices > 1").select("b", F.col("slices").alias("_slices")), "hot-partners")
    if hot.count() <= MOST_SENT:
        hot = F.broadcast(hot)
    dealt = pairs.join(hot, "b", "left").withColumn("slice", F.pmod(F.xxhash64("a"), F.coalesce("_slices", F.lit(1))))
    left = dealt.join(sets.withColumnRenamed("node", "a"), "a").select("a", "b", "slice", "hashes")
    right = slices.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("other")), "b")
    right = right.select("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"), "other")
    common, both = F.size(F.array_intersect("hashes", "other")), F.size("hashes") + F.size("other")
    met = left.join(right, ["b", "slice"]).select("a", "b", common.alias("common"), both.alias("both"))
    near = F.col("common") * (LEAST[0] + LEAST[1]) >= F.col("both") * LEAST[0]
    twice = 2 * LEAST[0] - LEAST[1]  # similarity at twice the distance
    reach = F.col("common") * (twice + LEAST[1]) >= F.col("both") * twice
    return materialise(met.select("a", "b", near.alias("near"), reach.alias("reach")), "scored-pairs")


def _open_keys(met: DataFrame, links: DataFrame) -> DataFrame:
    """The keys of ``met`` (key, node, first) whose nodes ``links`` don't connect, with the nodes' components."""
    known = components(links)
    members = met.select("key", "node").unionByName(met.select("key", F.col("first").alias("node")).distinct())
    placed = members.join(known, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    spread = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return materialise(spread.where("low < high").select("key"), "open-keys")


def print_pairs(nodes: DataFrame) -> DataFrame:
    """Candidates (a, b) by SimHash: nodes of one fingerprint with its smallest node, and smallest nodes of linked fingerprints."""
    of_print = materialise(nodes.groupBy("fp").agg(F.min("node").alias("first")), "first-nodes")
    same = nodes.join(of_print, "fp").select(F.col("node").alias("a"), F.col("first").alias("b")).where("a <> b")
    links = simhash.fingerprint_links(of_print.select("fp")).withColumnsRenamed({"a": "x", "b": "y"})
    ends = [of_print.select(F.col("fp").alias(c), F.col("first").alias(f"_{c}")) for c in ("x", "y")]
    met = links.join(ends[0], "x").join(ends[1], "y").select(F.greatest("_x", "_y").alias("a"), F.least("_x", "_y").alias("b"))
    return materialise(same.unionByName(met), "print-pairs")


def shingle_links(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Verified links (a, b) that span all chains of near-copies among ``nodes`` (node, fp, lowest, keys)."""
    keyed = nodes.where("lowest is not null").select("node", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first < last")
    met = materialise(keyed.join(shared.select("key", "first"), "key").where("node <> first"), "met-keys")
    printed = print_pairs(nodes.where("lowest is not null").select("node", "fp"))
    ends = [met.select("node"), met.select("first"), printed.select("a"), printed.select("b")]
    involved = ends[0].union(ends[1]).union(ends[2]).union(ends[3]).distinct()
    sets = _with_sets(docs, nodes, involved)
    once = _scored(met.groupBy(F.col("node").alias("a")).agg(F.min("first").alias("b")).unionByName(printed).distinct(), sets)
    links = once.where("near").select("a", "b")

    met = materialise(met.join(_open_keys(met, links), "key", "left_semi"), "met-keys")
    pairs = met.select(F.col("node").alias("a"), F.col("first").alias("b")).distinct()
    scored = once.unionByName(_scored(pairs.join(once, ["a", "b"], "left_anti"), sets))
    links = scored.where("near").select("a", "b")
    status = met.join(scored, (F.col("node") == F.col("a")) & (F.col("first") == F.col("b"))).select("key", "node", "near", "reach")
    between = status.where("reach and not near").select("key").distinct()
    rest = status.where("not near").select("key", "node").unionByName(
        status.where("near").select("key", "node").join(between, "key", "left_semi")
    )
    rest = materialise(rest, "rest-of-keys")
    if rest.isEmpty():
        return links
    known = components(links)
    placed = rest.join(known, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    open_keys = placed.groupBy("key").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y"),
        F.min("component").alias("low"), F.max("component").alias("high"),
    ).where("low < high")
    # Keys that leave the same nodes stand for one another.
    counts = open_keys.groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    blocked = rest.join(counts, "key").withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    dealt = blocked.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select("key", "node", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block")
    with_sets = dealt.join(sets, "node").select("key", "i", "j", "block", "node", "hashes")
    by_pair = with_sets.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "node")
    return links.unionByName(by_pair.mapInArrow(_block_links, "a long, b long")).distinct()


def near_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, component_id) of every row of ``docs`` (doc_id, text).

    The component is the smallest id reachable over near-copies. Texts without words have equal (empty) shingle sets and
    are one component. Rows without an id link only documents with equal sets. An empty table gives an empty table.
    """

    def run(batch: pa.RecordBatch) -> dict:
        found = [shingles(t) for t in batch.column(1).to_pylist()]
        keys = pa.array([band_keys(h) for h in found], pa.list_(pa.int64()))
        numbers = {n: np.array([f(h) for h in found], np.int64) for n, f in (("node", node_of), ("fp", simhash.fingerprint_of))}
        return {"doc_id": batch.column(0), **numbers, "keys": keys}

    prints = map_columns(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, node long, fp long, keys array<long>")
    prints = materialise(prints, "shingle-keys")
    nodes = prints.groupBy("node").agg(F.first("fp").alias("fp"), F.min("doc_id").alias("lowest"), F.first("keys").alias("keys"))
    nodes = materialise(nodes, "shingle-nodes")
    linked = components(shingle_links(docs.select(F.col("doc_id").cast("long"), "text"), nodes))
    groups = nodes.select("node", "lowest").join(linked, "node", "left").select("node", "lowest", F.coalesce("component", "node").alias("component"))
    least = groups.groupBy("component").agg(F.min("lowest").alias("component_id"))
    of_node = groups.join(least, "component").select("node", "component_id")
    return prints.select("doc_id", "node").join(of_node, "node").select("doc_id", "component_id")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without near-copies: the document with the smallest id of each component stays.

    Of rows that repeat this id the least one by all columns stays. Every row without an id stays.
    """
    groups = materialise(near_copies(docs), "near-copies")
    gone = groups.where("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    repeated = groups.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():  # only repeats cost a shuffle of texts
        return kept
    one = kept.join(repeated, "doc_id", "left_semi").groupBy(F.col("doc_id").alias("_id")).agg(F.min(F.struct(*docs.columns)).alias("_row"))
    return kept.join(repeated, "doc_id", "left_anti").select(docs.columns).unionByName(one.select("_row.*"))
