"""Incremental paper state over a stream of source records, and a first-arrival filter.

An id never expires, so nothing here has a watermark. What later records are merged with is operator state, kept by key in
the stream's state store (RocksDB: on disk, in shards, saved in the stream's checkpoint): the list values seen so far, and
for each paper the winners of the scalar fields with their places and the digests of its lists. A micro-batch touches
the state of its own papers, or of groups with one such paper in ten, whatever came before, and writes their index rows as one partition.
Calls between Spark and Python are what a paper costs, so a group of papers shares them. A micro-batch that is
run again replaces its own partition, and the store goes back to its version before it, so a lost driver or executor
leaves no trace. The result of all batches equals the batch merge of all records.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.stateful_processor import TimerValues

from citeloom import schemas
from citeloom.operators import merge, snapshot
from citeloom.operators.merge import LIST_FIELDS
from citeloom.operators.order import last_per_key
from citeloom.sources.files import path_exists

STATE_FIELDS = (
    "canonical_id STRING, hash STRING, title STRING, doi STRING, year INT, first_seen_at STRING, last_seen_at STRING, "
    "status STRING, batch_id BIGINT"
)
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

NOWHERE = (1 << 63) - 1

#: Groups that papers are kept and folded in, so that few calls between Spark and Python serve many papers. Fixed for a checkpoint's life.
SHARDS = 1 << 13
#: A group's papers are read together if the micro-batch touches one in so many of them, else one by one.
READ_TOGETHER = 10

#: What the state gives for a paper that a micro-batch touches.
TOUCHED = (
    "canonical_id STRING, title STRING, year INT, published_date STRING, venue STRING, doi STRING, list_digest STRING, "
    "first_seen_at STRING, last_seen_at STRING, status STRING"
)
TOUCHED_NAMES = [f.split()[0] for f in TOUCHED.split(", ")]


class Partial:
    """Winners and list digests of some records of one paper; two of them fold into one in any order.

    ``row`` holds title, its size and place, year, published date, venue and place, DOI and place (NOWHERE: none), and per list field
    a count and two digests; as JSON text it is what is kept and sent. This class goes to the workers by value, so it names constants
    only: a module would travel with all that it holds.
    """

    def __init__(self, text: str | None = None):
        n = len(LIST_FIELDS)
        self.row = json.loads(text) if text else [None, 0, NOWHERE, None, None, None, NOWHERE, None, NOWHERE, [0] * n, [0] * n, [0] * n]

    def text(self) -> str:
        return json.dumps(self.row)

    def add_scalars(self, other) -> None:
        """Fold the scalar cells of another partial's row in: longest title (earliest on ties), first venue and DOI, least year and date."""
        own = self.row
        if (other[1], -other[2]) > (own[1], -own[2]):
            own[0:3] = other[0:3]
        for at in (3, 4):
            if other[at] is not None and (own[at] is None or other[at] < own[at]):
                own[at] = other[at]
        for at in (5, 7):
            if other[at + 1] < own[at + 1]:
                own[at : at + 2] = other[at : at + 2]

    def add_value(self, field: int, first: int, second: int) -> None:
        """Fold one list value in that the paper has not had yet."""
        self.row[9][field] += 1
        self.row[10][field] ^= first
        self.row[11][field] ^= second

    def add(self, other) -> None:
        """Fold another partial's row in."""
        self.add_scalars(other)
        own = self.row
        own[9] = [a + b for a, b in zip(own[9], other[9], strict=True)]
        for at in (10, 11):
            own[at] = [a ^ b for a, b in zip(own[at], other[at], strict=True)]

    def index_cells(self) -> tuple:
        """What the fingerprint is made of: title, year, date, venue, DOI and the list part."""
        return (*[self.row[at] for at in (0, 3, 4, 5, 7)], self.list_digest())

    def list_digest(self) -> str | None:
        """The list part of a paper's fingerprint, as ``snapshot.fingerprint`` writes it."""
        mask = (1 << 64) - 1
        parts = [
            f"{name}:{n}:{a & mask:X}:{b & mask:X}" for name, n, a, b in zip(LIST_FIELDS, self.row[9], self.row[10], self.row[11], strict=True) if n
        ]
        return ";".join(sorted(parts)) or None


def state_rows(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """All written index rows, optionally only those of earlier micro-batches."""
    if not path_exists(spark, f"{path}/index"):
        return spark.createDataFrame([], STATE_FIELDS)
    rows = spark.read.schema(STATE_FIELDS).parquet(f"{path}/index")
    return rows if before is None else rows.filter(F.col("batch_id") < before)


def current_state(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """Last row of every paper."""
    return last_per_key(state_rows(spark, path, before), ["canonical_id"], ["batch_id"])


def _rows_of(keyed: DataFrame) -> DataFrame:
    """Every record, and every list value that its paper has not had yet: its field's place in LIST_FIELDS and its digests."""
    filled = lambda c: F.when(F.length(c) > 0, F.col(c)).alias(c)
    records = keyed.select(
        "canonical_id", "title", F.length("title").cast("long").alias("title_size"), "ord", "year", "published_date", filled("venue"), filled("doi")
    )
    values = merge.value_rows(keyed).select("canonical_id", "v.field", "v.value").dropDuplicates(["canonical_id", "field", "value"])
    first, second = snapshot.value_digests(F.col("field"), F.col("value"))
    place = F.array_position(F.array(*[F.lit(f) for f in LIST_FIELDS]), F.col("field")) - 1
    lists = values.select("canonical_id", place.alias("field"), first.alias("first"), second.alias("second"))
    return records.unionByName(lists, allowMissingColumns=True)


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partial per paper and batch, so that a paper with many records sends few and narrow rows to the task that holds its state."""
    for batch in batches:
        found: dict[str, Partial] = {}
        for key, title, size, at, year, published, venue, doi, field, first, second in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            paper = found.get(key)
            if paper is None:
                paper = found[key] = Partial()
            if field is None:
                paper.add_scalars((title, size, at, year, published, venue, NOWHERE if venue is None else at, doi, NOWHERE if doi is None else at))
            else:
                paper.add_value(field, first, second)
        if found:
            yield pa.RecordBatch.from_pydict({"canonical_id": list(found), "partial": [p.text() for p in found.values()]})


def _fold(held: tuple | None, came: Partial, stamp: str) -> tuple[tuple, tuple]:
    """Fold a micro-batch's partial of one paper into its state: the next state, and the cells of its index row."""
    paper = Partial(held[0] if held else None)
    before = paper.index_cells() if held else None
    paper.add(came.row)
    now = paper.index_cells()
    status = "new" if held is None else "unchanged" if before == now else "changed"
    first_seen = held[1] if held else stamp
    return (paper.text(), first_seen), (*now, first_seen, stamp, status)


class PaperStates(StatefulProcessor):
    """The state of the papers of one shard, each under its own key: its partial, and the micro-batch that it came with first."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.papers = handle.getMapState("papers", "canonical_id STRING", "partial STRING, first_seen STRING")
        self.size = handle.getValueState("size", "papers BIGINT")
        self.touched = Row(*TOUCHED_NAMES)

    def _held(self, came: dict[str, Partial], size: int) -> dict[str, tuple]:
        """The states of the papers that came: by one walk over the shard if they are much of it, else each by its key."""
        if not size:
            return {}
        if size <= READ_TOGETHER * len(came):
            return {key: state for (key,), state in self.papers.iterator() if key in came}
        return {key: state for key in came if (state := self.papers.getValue((key,))) is not None}

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:  # noqa: N802, N803
        stamp = f"batch-{TaskContext.get().getLocalProperty('streaming.sql.batchId')}"
        came: dict[str, Partial] = {}
        for row in rows:
            if row.canonical_id in came:
                came[row.canonical_id].add(json.loads(row.partial))
            else:
                came[row.canonical_id] = Partial(row.partial)
        size = (self.size.get() or (0,))[0]
        held = self._held(came, size)
        for paper, partial in came.items():
            before = held.get(paper)
            after, cells = _fold(before, partial, stamp)
            if after != before:
                self.papers.updateValue((paper,), after)
            yield self.touched(paper, *cells)
        if len(held) < len(came):
            self.size.update((size + len(came) - len(held),))

    def close(self) -> None:
        pass


def touched_papers(records: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Stream of index rows: one for each paper that a micro-batch of ``records`` touches, merged with all its earlier records."""
    combined = _rows_of(merge.with_canonical_id(records)).mapInArrow(_combined, "canonical_id STRING, partial STRING")
    sharded = combined.withColumn("shard", F.pmod(F.xxhash64("canonical_id"), F.lit(shards).cast("long")))
    rows = sharded.groupBy("shard").transformWithState(PaperStates(), TOUCHED, "append", "none")
    hashed = rows.withColumn("hash", snapshot.paper_hash(F.col("list_digest")))
    return hashed.select("canonical_id", "hash", "title", "doi", "year", "first_seen_at", "last_seen_at", "status")


def run_upserts(records: DataFrame, state_path: str, checkpoint: str, shards: int = SHARDS) -> StreamingQuery:
    """Start the upsert over a stream of source records; everything that has landed is taken, then it stops.

    The number of shuffle partitions at the first start is the number of stores of the state, and ``shards`` that of its groups of papers, both for
    the checkpoint's life.
    """
    records.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{state_path}/index/batch_id={batch_id}")

    writer = touched_papers(records, shards).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def compact(spark: SparkSession, path: str, new_path: str, upto: int) -> DataFrame:
    """The index up to a micro-batch as one partition of a new folder; run it once every few hundred batches."""
    current_state(spark, path, upto + 1).drop("batch_id").write.mode("overwrite").parquet(f"{new_path}/index/batch_id={upto}")
    return current_state(spark, new_path)


def record_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of landed source records from a folder of Parquet files."""
    reader = spark.readStream.schema(schemas.SOURCE_RECORDS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def first_arrivals(stream: DataFrame, key: str) -> DataFrame:
    """Rows whose key no earlier row had, however long ago, as the batch form gives them; one row per key.

    All keys are operator state, by key in shards on disk (RocksDB), so a micro-batch looks up its own keys only.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return stream.dropDuplicates([key])
