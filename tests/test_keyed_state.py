"""State in hash buckets: versions, compaction, plans without an exchange of the state, concurrent claims."""

from conftest import cells
from pyspark.sql import functions as F

from citeloom.plans import keyed_state, sinks
from citeloom.plans.keyed_state import KeyedState

SCHEMA = "id STRING, n BIGINT, names ARRAY<STRING>"


def rows(spark, ids, n):
    return spark.createDataFrame([(f"k{i}", n, [f"{n}"]) for i in ids], SCHEMA)


def test_a_run_writes_what_it_touches(spark, tmp_path):
    state = KeyedState(spark, str(tmp_path / "s"), SCHEMA, "id", buckets=4)
    assert state.current().count() == 0
    want = {}
    for run, ids in enumerate((range(1000), range(10), range(5, 15), range(995, 1005))):
        version = state.append(rows(spark, ids, run), f"run{run}")
        want |= {f"k{i}": run for i in ids}
        written = spark.read.parquet(f"{tmp_path}/s/rows/_version={version}")
        assert written.count() == len(ids)  # one per cent of the ids, one per cent of the state
        if run == 2:
            state.compact()
            assert state.since_base() == 0
    got = {r["id"]: r["n"] for r in state.current().collect()}
    assert got == want and state.since_base() == 1
    assert {r["n"] for r in state.current(upto=2).collect()} == {0, 1}
    state.compact()
    state.drop_folded()
    again = KeyedState(spark, str(tmp_path / "s"), SCHEMA, "id", buckets=4)
    assert {r["id"]: r["n"] for r in again.current().collect()} == want
    again.close()
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_joins_need_no_exchange_of_the_state(spark, tmp_path):
    state = KeyedState(spark, str(tmp_path / "s"), SCHEMA, "id", buckets=4)
    state.append(rows(spark, range(50), 1), "a")
    state.append(rows(spark, range(5), 2), "b")
    touched = rows(spark, range(3), 3).select("id").hint("merge")
    plan = state.current().join(touched, "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


def test_unfinished_runs_are_not_read_and_survive_a_compaction(spark, tmp_path):
    state = KeyedState(spark, str(tmp_path / "s"), SCHEMA, "id", buckets=4)
    state.append(rows(spark, range(4), 1), "done")
    state.append(rows(spark, range(2, 6), 2), "pending")
    state.append(rows(spark, range(3, 5), 3), "done too")
    finished = {"done", "done too"}
    assert cells(state.current(runs=finished), "id", "n") == [("k0", 1), ("k1", 1), ("k2", 1), ("k3", 3), ("k4", 3)]
    state.compact(runs=finished)
    state.drop_folded()
    assert cells(state.current(runs=finished), "id", "n") == [("k0", 1), ("k1", 1), ("k2", 1), ("k3", 3), ("k4", 3)]
    # The pending run finishes after the compaction; its place among the versions stays the second.
    assert cells(state.current(runs=finished | {"pending"}), "id", "n") == [("k0", 1), ("k1", 1), ("k2", 2), ("k3", 3), ("k4", 3), ("k5", 2)]


def test_two_runs_that_finish_at_once_get_a_pointer_each(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    assert sinks.publish(spark, base, "r1") == 1
    stale = keyed_state.claims(spark, f"{base}/published")[:0]
    monkeypatch.setattr(keyed_state, "claims", lambda *a: stale)  # both have looked before either wrote
    assert [sinks.publish(spark, base, r) for r in ("r2", "r3")] == [2, 3]
    monkeypatch.undo()
    assert sinks.latest_run(spark, base) == "r3" and sinks.published_runs(spark, base) == {"r1", "r2", "r3"}
    assert sinks.published_runs(spark, base, before="r3") == {"r1", "r2"}


def test_keys_with_odd_names_and_nulls(spark, tmp_path):
    state = KeyedState(spark, str(tmp_path / "a folder"), SCHEMA, "id", buckets=2)
    state.append(spark.createDataFrame([("k\'/ %", None, None), ("", 2, [None])], SCHEMA), "x")
    assert cells(state.current(), "id", "n") == [("", 2), ("k\'/ %", None)] and state.current().where(F.col("names").isNull()).count() == 1
