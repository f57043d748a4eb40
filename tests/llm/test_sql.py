"""Queries of the subpackage that SQL can express, against the second engine."""

import pytest
from conftest import SMALL
from oracle import compare, connect

from citeloom.llm import catalog


@pytest.fixture(scope="module")
def engine():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query(spark, engine, name):
    ok, message = compare(engine, catalog.REGISTRY[name](spark, SMALL), catalog.SQL[name])
    assert ok, message


def test_every_operator_has_a_query():
    numbers = {n.split("_")[0] for n in catalog.REGISTRY if n.startswith("op")}
    assert numbers == {f"op{i}" for i in range(1, 14)}
