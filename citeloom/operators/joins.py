"""Equi-joins of a long side with a lookup side that survive a hot key on the long side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(many: DataFrame, one: DataFrame, on: list[str], how: str = "left", salts: int = 1, salt_by: list[str] | None = None) -> DataFrame:
    """Join ``many`` with ``one`` on equal keys; ``how`` is left or inner.

    The long side is always on the left, the side that AQE's skew join may cut: with
    ``session.configure`` set, partitions of a hot key are split over several tasks by measured size, and
    only the matching lookup partition is read again. No pass over the long side is needed to find hot
    keys, and AQE may still choose a broadcast join when the measured lookup side is small.

    ``salts`` above one spreads every key of the long side by a hash of the row (or of ``salt_by``), and repeats the
    lookup side as often. It is meant for lookup sides that are far smaller than the long side, such as
    a roster, whose keys are few.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    if salts <= 1:
        return many.join(one, on, how)
    salted = many.withColumn("_salt", F.pmod(F.xxhash64(*(salt_by or many.columns)), F.lit(salts)))
    copies = one.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")
