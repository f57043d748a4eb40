"""Evaluate an expression once and use it several times.

Inside higher-order functions Spark inlines every use of a Column expression, so nested helpers would
repeat their inputs many times over. ``bind`` passes the value through a one-element array; ``once``
does the same for whole rows, and also keeps later filters from repeating the work below them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bind(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), lambda v: fn(v)), F.lit(0))


def null_if(value: Column, *blanks) -> Column:
    """``value``, or NULL if it equals one of the given constants; evaluated once."""
    return F.get(F.filter(F.array(value), lambda v: ~v.isin(*blanks)), F.lit(0))


def once(df: DataFrame, keep: list[str], **values: Column) -> DataFrame:
    """Columns ``keep`` and the named values, each computed exactly once per row."""
    packed = F.explode(F.array(F.struct(*[v.alias(k) for k, v in values.items()]))).alias("_once")
    return df.select(*keep, packed).select(*keep, *[F.col("_once")[k].alias(k) for k in values])
