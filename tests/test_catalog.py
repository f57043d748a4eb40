"""Every registered query against its SQL in a second engine, on the smallest test tables."""

import pytest
from conftest import SMALL

import __spark_entry__ as entry
from citeloom.plans import catalog
from oracle import compare, connect

QUERIES, SQL = entry.catalog.REGISTRY, entry.oracle_sql()


@pytest.fixture(scope="module")
def engine():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, engine, name):
    df = QUERIES[name](spark, SMALL)
    assert name in SQL
    ok, message = compare(engine, df, SQL[name])
    assert ok, message


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name, merges", [("award_split", 1), ("run_summary", 2), ("run_report", 2)])
def test_a_run_is_keyed_and_merged_once(spark, monkeypatch, name, merges):
    """All steps of a report read the same written tables; the second merge is that of the earlier collection."""
    called = []
    plain = catalog.merge.merge_papers
    monkeypatch.setattr(catalog.merge, "merge_papers", lambda keyed: called.append(1) or plain(keyed))
    assert catalog.REGISTRY[name](spark, SMALL).count() > 0
    assert len(called) == merges
