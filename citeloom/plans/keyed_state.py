"""State of one row per key, in hash buckets, merged when it is read.

A run appends only the rows of the keys that it touched, as one version; the current state is the last version of each key.
Rows lie in as many files as there are buckets, by the hash of their key, so that joins and folds by that key need no
exchange of the state, however large it is. A compaction folds finished versions into a base, which names those that it
left out because their runs had not finished. Versions are numbers claimed by creating a file, so concurrent runs never share one.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeloom.sources.files import path_exists

BUCKETS = 64


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def create_file(spark: SparkSession, path: str, content: dict) -> bool:
    """Create a small file with ``content`` unless it exists; whether it was created. As atomic as the file system's create."""
    place, fs = _file_system(spark, path)
    try:
        stream = fs.create(place, False)
    except Exception as exc:  # the engine wraps the file system's error
        if "AlreadyExists" in str(exc) or "already exists" in str(exc):
            return False
        raise
    stream.write(bytearray((json.dumps(content) + "\n").encode()))
    stream.close()
    return True


def read_file(spark: SparkSession, path: str) -> dict | None:
    """Content of a small file; None while another run is still writing it."""
    place, fs = _file_system(spark, path)
    stream = fs.open(place)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return json.loads(text) if text.endswith("\n") else None


def claim_next(spark: SparkSession, folder: str, content: dict) -> int:
    """Claim the number after the highest one claimed in ``folder``; a claim lost to another run is tried again."""
    number = 1 + max((n for n, _ in claims(spark, folder)), default=0)
    while not create_file(spark, f"{folder}/{number:012d}", content | {"seq": number}):
        number += 1
    return number


def claims(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """(number, path) of all claims in ``folder``, one per run, in order. File names alone are looked at."""
    if not path_exists(spark, folder):
        return []
    place, fs = _file_system(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(place)]
    return sorted((int(n), f"{folder}/{n}") for n in names if n.isdigit())


class KeyedState:
    """A state table at ``path`` with the fields of ``schema``; ``key`` is one of them. The number of buckets stays for its life."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.schema = T.StructType.fromDDL(schema)
        self.table = "citeloom_state_" + hashlib.sha256(f"{self.path}|{buckets}|{schema}".encode()).hexdigest()[:24]
        place, fs = _file_system(spark, f"{self.path}/rows")
        fs.mkdirs(place)
        # The session's catalogue only names the files; another session opens the same ones.
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({fields}, _from BIGINT, _version BIGINT, _base BOOLEAN) USING parquet PARTITIONED BY (_version, _base) "
            f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{self.path}/rows'"
        )

    def versions(self) -> list[dict]:
        """What is readable: ``{"version", "run", "base", "skipped"}`` in order of version, one per run since the last ``drop_folded``."""
        ready = [read_file(self.spark, path) for _, path in claims(self.spark, f"{self.path}/ready")]
        return [v for v in ready if v]

    def _readable(self, upto: int | None, runs: set[str] | None) -> tuple[int, list[int], list[int]]:
        """(last base, versions to merge with it, versions that are left out)."""
        ready = [v for v in self.versions() if upto is None or v["version"] <= upto]
        base = max((v for v in ready if v["base"]), key=lambda v: v["version"], default={"version": 0, "skipped": []})
        open_ = [v for v in ready if not v["base"] and (v["version"] > base["version"] or v["version"] in base["skipped"])]
        late = [v["version"] for v in open_ if runs is None or v["run"] in runs]
        return base["version"], late, [v["version"] for v in open_ if v["version"] not in late]

    def _write(self, rows: DataFrame, version: int, base: bool, run: str, skipped: list[int]) -> None:
        out = rows.withColumn("_version", F.lit(version).cast("bigint")).withColumn("_base", F.lit(base))
        dealt = out.select(*self.schema.fieldNames(), "_from", "_version", "_base").repartition(self.buckets, self.key)  # one file per bucket
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")  # for this write only: elsewhere an overwrite replaces all partitions
        try:
            dealt.write.insertInto(self.table, overwrite=True)
        finally:
            self.spark.conf.set(mode, before)
        create_file(self.spark, f"{self.path}/ready/{version:012d}{int(base)}", {"version": version, "run": run, "base": base, "skipped": skipped})

    def append(self, rows: DataFrame, run: str) -> int:
        """Write the rows of the keys that a run touched, one per key, as a new version; returns its number."""
        version = claim_next(self.spark, f"{self.path}/claims", {"run": run})
        self._write(rows.withColumn("_from", F.lit(version).cast("bigint")), version, False, run, [])
        return version

    def rows(self, upto: int | None = None, runs: set[str] | None = None) -> DataFrame:
        """Rows of the last base and of the versions after it, up to a version; of versions only those of ``runs``, if given."""
        base, late, _ = self._readable(upto, runs)
        self.spark.sql(f"ALTER TABLE {self.table} RECOVER PARTITIONS")
        self.spark.catalog.refreshTable(self.table)
        read = (F.col("_base") & (F.col("_version") == base)) | (~F.col("_base") & F.col("_version").isin(late))
        return self.spark.table(self.table).where(read)

    def _last(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in (*self.schema.fieldNames(), "_from") if c != self.key]
        last = rows.groupBy(self.key).agg(F.max_by(F.struct(*rest), "_from").alias("_row"))
        return last.select(*[F.col(c) if c == self.key else F.col(f"_row.{c}").alias(c) for c in (*self.schema.fieldNames(), "_from")])

    def current(self, upto: int | None = None, runs: set[str] | None = None) -> DataFrame:
        """The last row of every key; see ``rows``. Files are bucketed by key, so this needs no exchange."""
        return self._last(self.rows(upto, runs)).drop("_from")

    def compact(self, runs: set[str] | None = None) -> int:
        """Fold all versions (of ``runs``, if given) into a base; returns its number.

        What it replaces stays for readers that have begun; ``drop_folded`` removes it later.
        """
        _, late, skipped = self._readable(None, runs)
        if not late:
            return 0
        number = claim_next(self.spark, f"{self.path}/claims", {"run": "compaction"})
        self._write(self._last(self.rows(None, runs)), number, True, "compaction", skipped)
        return number

    def since_base(self) -> int:
        """How many versions a read has to merge with the base."""
        return len(self._readable(None, None)[1])

    def drop_folded(self) -> None:
        """Remove the rows of versions and bases that the last base replaces."""
        base, late, _ = self._readable(None, None)
        for v in self.versions():
            if v["version"] != base and v["version"] not in late:
                for name in (f"ready/{v['version']:012d}{int(v['base'])}", f"rows/_version={v['version']}"):
                    place, fs = _file_system(self.spark, f"{self.path}/{name}")
                    fs.delete(place, True)
        self.spark.sql(f"ALTER TABLE {self.table} RECOVER PARTITIONS")

    def close(self) -> None:
        """Forget the table's name in this session; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
