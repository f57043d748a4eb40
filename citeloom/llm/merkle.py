"""Merkle manifest of a dataset with octopus multiproofs.

Leaves are digests of rows. The leaves of each group, in order, form an 8-ary tree whose top is the group's subroot; the
subroots form another tree whose top is the root. Blocks of 4,096 nodes climb four levels at once, so ten billion rows take
three rounds.

Proofs of many leaves share most of their nodes. Each part of neighbouring leaves first names the least set of nodes that it
can't derive from its own leaves: going up level by level, the siblings that are neither its own nor parents of its own.
These coordinates are fetched once for the whole part; with them the part derives the interiors that its proofs share and
writes down each leaf's own proof locally.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.llm.common import placed
from citeloom.session import materialise

#: Children of a node.
ARITY = 8
#: Levels that a block climbs at once.
CLIMB = 4
#: Leaves of one part, which asks for nodes once.
PART = 1 << 14
#: Group number of the tree over subroots.
TOP = -1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NODE = "tree long, level int, place long, digest string"


@dataclass(frozen=True)
class Manifest:
    """``leaves`` (id columns, leaf, tree, place, leaves_of_tree, part), ``nodes`` of all levels above them, and the root."""

    leaves: DataFrame
    nodes: DataFrame
    trees: int
    root: str | None


def digest_of(parts: list[str]) -> str:
    """SHA-256 of concatenated inputs, as lowercase hex text."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(value: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and itself; null is a hyphen."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(c) for c in columns]), 256)


def sizes(leaves: int) -> list[int]:
    """Nodes of each level of a tree, from its leaves to its top."""
    out = [leaves]
    while out[-1] > 1:
        out.append(-(-out[-1] // ARITY))
    return out


def _climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes above blocks; rows (tree, block, level, place, digest, count) are sorted by tree and place, count is their level's size."""
    key, held = None, []

    def flush() -> Iterator[pa.RecordBatch]:
        if not held:
            return
        tree, _, level, count = key
        out: list[tuple[int, int, int, str]] = []
        current = held
        for step in range(1, CLIMB + 1):
            if count == 1:
                break
            count, grouped = -(-count // ARITY), {}
            for place, digest in current:
                grouped.setdefault(place // ARITY, []).append(digest)
            current = [(place, digest_of(children)) for place, children in grouped.items()]
            out += [(tree, level + step, place, digest) for place, digest in current]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.string()), strict=True)],
                ["tree", "level", "place", "digest"],
            )

    for batch in batches:
        for tree, block, level, place, digest, count in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if key != (tree, block, level, count):
                yield from flush()
                key, held = (tree, block, level, count), []
            held.append((place, digest))
    yield from flush()


def interior_nodes(leaves: DataFrame, label: str) -> DataFrame:
    """All nodes above ``leaves`` (tree, place, digest, count); count is the number of leaves of the tree."""
    spark = leaves.sparkSession
    level, found = leaves.select("tree", F.lit(0).alias("level"), "place", "digest", "count"), spark.createDataFrame([], NODE)
    span, rounds = ARITY**CLIMB, 0
    while not level.where("count > 1").isEmpty():
        blocks = level.where("count > 1").select("tree", F.expr(f"place DIV {span}").alias("block"), "level", "place", "digest", "count")
        dealt = blocks.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")
        new = materialise(dealt.mapInArrow(_climb, NODE), f"{label}-nodes")
        found = found.unionByName(new)
        rounds += 1
        left = F.ceil(F.col("count") / float(span)).cast("long")
        counts = level.select("tree", left.alias("count")).distinct()
        level = new.where(F.col("level") == CLIMB * rounds).join(counts, "tree").select("tree", "level", "place", "digest", "count")
    return found


def build(rows: DataFrame, group: str, order: list[str]) -> Manifest:
    """The manifest of ``rows`` (group, order columns, leaf, others); ``order`` and then the leaf sort a group's rows."""
    placed_rows = placed(rows, [F.col(group), *[F.col(c) for c in order], F.col("leaf")], {"at": F.lit(1)}, "merkle-order")
    ordered = materialise(placed_rows, "merkle-leaves")
    starts = ordered.groupBy(group).agg(F.min("at").alias("start"), F.count("*").alias("leaves_of_tree"))
    trees = materialise(placed(starts, [F.col(group)], {"tree": F.lit(1)}, "merkle-groups").select(F.col(group).alias("_group"), "tree", "start", "leaves_of_tree"), "merkle-trees")
    joined = ordered.join(trees, F.col(group).eqNullSafe(F.col("_group")))
    part = F.expr(f"at DIV {PART}")
    leaves = materialise(joined.select(*rows.columns, F.col("tree").cast("long"), (F.col("at") - F.col("start")).alias("place"), "leaves_of_tree", part.alias("part")), "merkle-placed")
    inner = interior_nodes(leaves.select("tree", "place", F.col("leaf").alias("digest"), F.col("leaves_of_tree").alias("count")), "merkle")
    tops = inner.groupBy("tree").agg(F.max_by("digest", "level").alias("digest"))
    single = leaves.where("leaves_of_tree = 1").select("tree", F.col("leaf").alias("digest"))
    n = trees.count()
    subroots = materialise(
        tops.unionByName(single).select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("place"), "digest", F.lit(n).cast("long").alias("count")), "merkle-subroots"
    )
    upper = interior_nodes(subroots, "merkle-top")
    leaf_nodes = leaves.select("tree", F.lit(0).alias("level"), "place", F.col("leaf").alias("digest"))
    nodes = inner.unionByName(upper).unionByName(subroots.select("tree", F.lit(0).alias("level"), "place", "digest")).unionByName(leaf_nodes)
    last = (upper if n > 1 else subroots.withColumn("level", F.lit(0))).agg(F.max_by("digest", "level").alias("root")).first()["root"]
    return Manifest(leaves, nodes, n, last)


def missing(own: set[int], counts: list[int]) -> list[tuple[int, int]]:
    """The least (level, place) nodes beside the ``own`` leaves from which the top of a tree can be derived with all siblings."""
    out = []
    for level, count in enumerate(counts[:-1]):
        parents = {p // ARITY for p in own}
        out += [(level, c) for p in sorted(parents) for c in range(ARITY * p, min(ARITY * (p + 1), count)) if c not in own]
        own = parents
    return out


def _wanted(trees: int):
    def run(table: pa.Table) -> pa.Table:
        own: dict[int, tuple[int, set[int]]] = {}
        for tree, place, count in zip(*[table.column(c).to_pylist() for c in ("tree", "place", "leaves_of_tree")], strict=True):
            own.setdefault(tree, (count, set()))[1].add(place)
        coordinates = [(tree, *at) for tree, (count, places) in own.items() for at in missing(places, sizes(count))]
        coordinates += [(TOP, *at) for at in missing(set(own), sizes(trees))]
        part = table.column("part")[0].as_py()
        columns = list(zip(*coordinates, strict=True)) or [(), (), ()]
        arrays = [pa.array([part] * len(coordinates), pa.int64()), *[pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64()), strict=True)]]
        return pa.Table.from_arrays(arrays, ["part", "tree", "level", "place"])

    return run


class _Tree:
    """The nodes of one tree that a part knows: its own leaves, fetched nodes, and what follows from both."""

    def __init__(self, own: dict[int, str], fetched: dict[tuple[int, int], str], counts: list[int]):
        self.counts, self.levels = counts, []
        for level, count in enumerate(counts):
            nodes = dict(own) | {p: d for (n, p), d in fetched.items() if n == level}
            self.levels.append(nodes)
            if level + 1 < len(counts):
                parents = {p // ARITY for p in own}
                own = {p: digest_of([nodes[c] for c in range(ARITY * p, min(ARITY * (p + 1), count))]) for p in parents}
        self._rest: dict[tuple[int, int], list[tuple[list[str], list[str]]]] = {}

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def path(self, level: int, place: int) -> list[tuple[list[str], list[str]]]:
        """Siblings before and after the node on each level from ``level`` up; what lies above is shared by its siblings."""
        if level + 1 == len(self.counts):
            return []
        if (level, place) not in self._rest:
            nodes, first = self.levels[level], ARITY * (place // ARITY)
            before = [nodes[c] for c in range(first, place)]
            after = [nodes[c] for c in range(place + 1, min(first + ARITY, self.counts[level]))]
            self._rest[level, place] = [(before, after), *self.path(level + 1, place // ARITY)]
        return self._rest[level, place]


def fold(leaf: str, path: list[tuple[list[str], list[str]]]) -> str:
    """The root that a leaf and its proof give."""
    for before, after in path:
        leaf = digest_of([*before, leaf, *after])
    return leaf


def _expand(trees: int, root: str):
    def run(leaves: pa.Table, nodes: pa.Table) -> pa.Table:
        own: dict[int, dict[int, str]] = {}
        counts: dict[int, int] = {}
        at = [leaves.column(c).to_pylist() for c in ("tree", "place", "leaf", "tampered", "leaves_of_tree")]
        for tree, place, leaf, _, count in zip(*at, strict=True):
            own.setdefault(tree, {})[place] = leaf
            counts[tree] = count
        fetched: dict[int, dict[tuple[int, int], str]] = {}
        for tree, level, place, digest in zip(*[nodes.column(c).to_pylist() for c in ("tree", "level", "place", "digest")], strict=True):
            fetched.setdefault(tree, {})[level, place] = digest
        known = {t: _Tree(o, fetched.get(t, {}), sizes(counts[t])) for t, o in own.items()}
        top = _Tree({t: k.top for t, k in known.items()}, fetched.get(TOP, {}), sizes(trees))
        out: dict[str, list] = {"subroot": [], "root": [], "proof_sha256": [], "folded_root": [], "verified": []}
        for tree, place, leaf, tampered, _ in zip(*at, strict=True):
            path = known[tree].path(0, place) + top.path(0, tree)
            folded = fold(tampered or leaf, path)
            out["subroot"].append(known[tree].top)
            out["root"].append(top.top)
            out["proof_sha256"].append(digest_of([d for before, after in path for d in (*before, *after)]))
            out["folded_root"].append(folded)
            out["verified"].append(folded == root)
        return pa.Table.from_arrays(
            [leaves.column("id"), leaves.column("leaf"), *[pa.array(v) for v in out.values()]], ["id", "leaf", *out]
        )

    return run


def proofs(manifest: Manifest, wanted: DataFrame) -> DataFrame:
    """Proof and check of ``wanted`` leaves (id, leaf, tampered, tree, place, leaves_of_tree, part): all of the manifest's or some.

    (id, leaf, subroot, root, proof_sha256, folded_root, verified); ``tampered`` (null: none) is folded in place of the leaf.
    """
    schema = f"id {wanted.schema['id'].dataType.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if manifest.root is None:
        return wanted.sparkSession.createDataFrame([], schema)
    coordinates = wanted.select("part", "tree", "place", "leaves_of_tree").groupBy("part").applyInArrow(_wanted(manifest.trees), "part long, tree long, level int, place long")
    # Most coordinates are of upper levels, which few rows hold; a join shuffles what is left of both sides.
    fetched = coordinates.join(manifest.nodes, ["tree", "level", "place"]).select("part", "tree", "level", "place", "digest")
    return wanted.groupBy("part").cogroup(fetched.groupBy("part")).applyInArrow(_expand(manifest.trees, manifest.root), schema)


def row_leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, leaf, tampered) of each document; ``tampered`` is the leaf of a lower-cased text where 3 divides the id's CRC-32."""
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate("text", UPPER, LOWER)
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 0
    return docs.select("doc_id", "lang", leaf_of([*columns, F.col("text")]).alias("leaf"), F.when(hit, leaf_of([*columns, lowered])).alias("tampered"))


def verified_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each row of ``docs`` (doc_id, source, lang, n_chars, text).

    Null cells are part of the leaf; a null language is a group, the first one; rows without an id come first in their group
    and are not tampered with. Rows that repeat an id are ordered by their leaves, so whole repeats may swap their places but
    give the same set of results. Other columns are not looked at. An empty table gives an empty table.
    """
    manifest = build(materialise(row_leaves(docs), "merkle-rows"), "lang", ["doc_id"])
    return proofs(manifest, manifest.leaves.withColumnRenamed("doc_id", "id")).withColumnRenamed("id", "doc_id")
