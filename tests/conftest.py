import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from citeloom.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("citeloom-tests", 8)
    yield session
    session.stop()


def cells(df, *columns):
    """Rows of a frame as tuples, in sorted order."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda t: [(v is None, str(v)) for v in t])


def value(spark, column, **fields):
    """One column expression over one row of literals."""
    from pyspark.sql import functions as F

    row = spark.range(1)
    for name, v in fields.items():
        if isinstance(v, list):
            row = row.withColumn(name, F.array(*[F.lit(x) for x in v]) if v else F.expr("cast(array() as array<string>)"))
        else:
            row = row.withColumn(name, F.lit(v))
    return row.select(column.alias("v")).first()["v"]
