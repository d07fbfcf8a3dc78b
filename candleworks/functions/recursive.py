"""Exponential averages as windowed sums instead of a row-by-row recursion.

y[t] = a x[t] + q y[t-1] with q = 1 - a and y[0] = x[0]. Rows are cut in blocks of
B rows. Inside a block y is q^j times the running sum of a x[i] / q^i; the block
before adds q^(j+1) times its last value. B is so long that q^B < 1e-18, so what
lies two blocks back is below double precision and one carried value is enough.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candleworks.functions.series import before, keys, so_far, timeline
from candleworks.schema import DATETIME

_NEGLIGIBLE = 1e-18
_LARGEST_SCALE = 1e250


def memory(span: float) -> int:
    """Rows after which a value has no weight left in double precision."""
    if span <= 1:
        return 1
    return math.ceil(math.log(_NEGLIGIBLE) / math.log(1 - 2 / (span + 1)))


def _block_rows(spans: list[float]) -> int | None:
    """A common block length, or None when the shortest span would overflow in it."""
    rows = max(memory(s) for s in spans)
    q_min = min(1 - 2 / (s + 1) for s in spans)
    return rows if rows * -math.log(q_min) < math.log(_LARGEST_SCALE) else None


def with_ema(frame: DataFrame, wanted: Mapping[str, tuple[str | Column, float]]) -> DataFrame:
    """Add name -> EMA(column, span) for all wanted columns.

    Values must not be null. On split frames the overlap has to cover
    :func:`memory` rows.
    """
    flat = {n: x for n, (x, span) in wanted.items() if span <= 1}
    moving = {n: v for n, v in wanted.items() if n not in flat}
    if flat:
        frame = frame.withColumns({n: F.col(x) if isinstance(x, str) else x for n, x in flat.items()})
    if not moving:
        return frame
    common = _block_rows([span for _, span in moving.values()])
    if common is None:
        for name, (x, span) in moving.items():
            frame = _blocked(frame, {name: (x, span)}, memory(span))
        return frame
    return _blocked(frame, moving, common)


def _blocked(frame, wanted, rows: int) -> DataFrame:
    part = keys(frame)
    line = timeline(frame)
    inside = so_far(Window.partitionBy(*part, "_block").orderBy("_j"))
    # The order of rows once more, in terms that share the sort of the blocks.
    blocks = Window.partitionBy(*part).orderBy("_block", "_j")
    local, whole = {}, {}
    for name, (x, span) in wanted.items():
        x = F.col(x) if isinstance(x, str) else x
        a = 2 / (span + 1)
        q = F.lit(1 - a)
        weight = F.when((F.col("_block") == 0) & (F.col("_j") == 0), 1.0).otherwise(a)
        local[name] = F.pow(q, F.col("_j")) * F.sum(weight * x * F.pow(q, -F.col("_j"))).over(inside)
        end = F.when(F.col("_j") == rows - 1, F.col(name))
        carry = F.last(end, ignorenulls=True).over(before(blocks))
        whole[name] = F.col(name) + F.coalesce(carry * F.pow(q, F.col("_j") + 1), F.lit(0.0))
    return (
        frame.withColumn("_n", F.row_number().over(line) - 1)
        .withColumns({"_block": F.floor(F.col("_n") / rows), "_j": F.col("_n") % rows})
        .withColumns(local)
        .withColumns(whole)
        .drop("_n", "_block", "_j")
    )
