"""Joins of long frames with tables of one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 32


def spread_join(
    rows: DataFrame,
    per_key: DataFrame,
    on: Sequence[str],
    salt_by: str | Column,
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Join so that the rows of one key spread over ``salts`` tasks.

    A symbol may hold a large share of all rows; joined by symbol alone they would meet
    in one task, and stay there for the windows that follow. ``per_key`` has one row per
    key and is repeated for every salt. ``salt_by`` should differ between the rows of a
    key. Adaptive execution still broadcasts ``per_key`` when it turns out to be small.
    """
    salt = F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int")
    repeated = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_salt", salt).join(repeated, [*on, "_salt"], how).drop("_salt")
