"""Correlation of daily returns between any number of symbols.

A join of all symbol pairs on the date would emit S * S rows per date. Instead the symbols
are cut into blocks; a date's returns of a block are one vector, and the vectors of two
blocks meet for a bounded number of dates, where their products are added up in matrices.
What is sent on is one row per pair of symbols and group of dates. A pair appears once,
with symbol_a <= symbol_b.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candleworks.functions.columns import ratio
from candleworks.operators.relational import symbol_returns
from candleworks.schema import DATETIME, SYMBOL
from candleworks.session import staged

# Limits of the classes.
HIGH, MEDIUM = 0.7, 0.3

#: Symbols per block, and dates whose vectors of two blocks are multiplied in one task.
BLOCK = 256
DATES = 1_024

_SUMS = ["n", "sa", "sb", "saa", "sbb", "sab"]
_SCHEMA = "a long, b long, " + ", ".join(f"{c} double" for c in _SUMS)


def _matrix(rows: pd.DataFrame) -> np.ndarray:
    """Dates by places of a block; NaN where a symbol has no return."""
    out = np.full((len(rows), BLOCK), np.nan)
    for i, (places, values) in enumerate(zip(rows["places"], rows["values"])):
        out[i, np.asarray(places, np.int64)] = values
    return out


def _pair_sums(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    first, second, _ = key
    left = rows[rows["block"] == first].sort_values(DATETIME)
    right = rows[rows["block"] == second].sort_values(DATETIME)
    both = np.intersect1d(left[DATETIME], right[DATETIME])
    x = _matrix(left[left[DATETIME].isin(both)])
    y = x if first == second else _matrix(right[right[DATETIME].isin(both)])
    (kx, ky), (x, y) = [(~np.isnan(m)).astype(float) for m in (x, y)], [np.nan_to_num(m) for m in (x, y)]
    total = [kx.T @ ky, x.T @ ky, kx.T @ y, (x * x).T @ ky, kx.T @ (y * y), x.T @ y]
    a, b = np.nonzero(total[0])
    if first == second:
        a, b = a[a <= b], b[a <= b]
    sums = {name: m[a, b] for name, m in zip(_SUMS, total)}
    return pd.DataFrame({"a": first * BLOCK + a, "b": second * BLOCK + b, **sums})


def _numbered(symbols: DataFrame) -> DataFrame:
    """(symbol, number): 0, 1, ... in the order of the symbols.

    Numbers within hashed groups and the groups' sizes, so that no task sorts all symbols
    of a large universe; with few symbols there is one group and the order is theirs.
    """
    groups = max(1, math.ceil(symbols.count() / 100_000))
    placed = symbols.withColumn("_g", F.pmod(F.xxhash64(SYMBOL), F.lit(groups)))
    ranked = placed.withColumn("_i", F.row_number().over(Window.partitionBy("_g").orderBy(SYMBOL)) - 1)
    return ranked.select(SYMBOL, (F.col("_i").cast("long") * groups + F.col("_g")).alias("number"))


def correlation(bars: DataFrame) -> DataFrame:
    """(symbol_a, symbol_b, correlation, strength) over the dates both have a return."""
    # Returns are computed once; a symbol without any has no pair.
    returns = staged(symbol_returns(bars).where("value is not null"), "returns")
    names = staged(_numbered(returns.select(SYMBOL).distinct()), "symbols")
    blocks = (names.agg(F.max("number")).first()[0] or 0) // BLOCK + 1
    groups = max(1, math.ceil(returns.select(DATETIME).distinct().count() / DATES))
    known = returns.join(names, SYMBOL)
    entry = F.struct(F.pmod("number", F.lit(BLOCK)).cast("int").alias("place"), "value")
    vectors = known.groupBy(DATETIME, F.floor(F.col("number") / BLOCK).alias("block")).agg(
        F.collect_list(entry).alias("v")  # at most one per symbol of the block
    )
    vectors = vectors.select(DATETIME, "block", F.col("v.place").alias("places"), F.col("v.value").alias("values"))
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    sums = (
        vectors.withColumn("_other", other)
        .withColumns(
            {
                "first": F.least("block", "_other"),
                "second": F.greatest("block", "_other"),
                "dates": F.pmod(F.xxhash64(DATETIME), F.lit(groups)),
            }
        )
        .groupBy("first", "second", "dates")
        .applyInPandas(_pair_sums, _SCHEMA)
        .groupBy("a", "b")
        .agg(*[F.sum(c).alias(c) for c in _SUMS])
    )
    n, sa, sb = F.col("n"), F.col("sa"), F.col("sb")
    spread_a = n * F.col("saa") - sa * sa
    spread_b = n * F.col("sbb") - sb * sb
    both = F.when((n > 1) & (spread_a > 0) & (spread_b > 0), F.sqrt(spread_a) * F.sqrt(spread_b))
    value = ratio(n * F.col("sab") - sa * sb, both)
    strength = F.when(F.col("correlation") > HIGH, "high").when(F.col("correlation") > MEDIUM, "medium")
    name = lambda c: names.select(F.col("number").alias(c), F.col(SYMBOL).alias(f"_{c}"))
    return (
        sums.join(name("a"), "a")
        .join(name("b"), "b")
        .select(
            F.least("_a", "_b").alias("symbol_a"),
            F.greatest("_a", "_b").alias("symbol_b"),
            value.alias("correlation"),
        )
        .withColumn("strength", F.when(F.col("correlation").isNotNull(), strength.otherwise("low")))
    )
