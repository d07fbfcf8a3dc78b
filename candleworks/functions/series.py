"""Windows along a price series, and the split of series too long for one task.

A *daily* series has one row per symbol and date, so a window partition by
symbol holds at most 366 rows per year of history, whatever the number of
symbols: the calendar bounds it. Frames without that bound (intraday bars) go
through :func:`split_long` first. It cuts every series into spans of
``span_rows`` rows and copies the last ``lookback`` rows of a span to the front
of the next one. All window specs below partition by symbol *and* span, so the
operators read the same in both cases.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from candleworks.functions.columns import col
from candleworks.schema import DATETIME, SYMBOL

SPAN = "_span"
OWN = "_own"
SPAN_ROWS = 65_536


def is_split(frame: DataFrame) -> bool:
    return SPAN in frame.columns


def keys(frame: DataFrame) -> list[str]:
    return [SYMBOL, SPAN] if is_split(frame) else [SYMBOL]


def timeline(frame: DataFrame) -> WindowSpec:
    return Window.partitionBy(*keys(frame)).orderBy(DATETIME)


def last_n(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), 0)


def so_far(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, 0)


def before(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, -1)


def rolling(fn, x: str | Column, w: WindowSpec, n: int) -> Column:
    """fn over the last n rows, null until n values that are not null are there."""
    frame = last_n(w, n)
    return F.when(F.count(col(x)).over(frame) == n, fn(col(x)).over(frame))


def padded(x: str | Column, w: WindowSpec) -> Column:
    """The last known value up to this row."""
    return F.last(col(x), ignorenulls=True).over(so_far(w))


def split_long(
    bars: DataFrame,
    lookback: int,
    span_rows: int = SPAN_ROWS,
    grain: str = "month",
) -> DataFrame:
    """Cut long series into spans that overlap by ``lookback`` rows.

    Row numbers come from counts per symbol and ``grain`` bucket, so no task ever
    sorts a whole series: rows are numbered inside their bucket and shifted by the
    number of rows in the buckets before. Choose the grain so that one bucket fits
    a task (``month`` for minute bars, ``hour`` for ticks). ``lookback`` must not
    exceed ``span_rows``.
    """
    if lookback > span_rows:
        raise ValueError("lookback must not exceed span_rows")
    bucketed = bars.withColumn("_bucket", F.date_trunc(grain, DATETIME))
    in_order = Window.partitionBy(SYMBOL).orderBy("_bucket")
    offsets = (
        bucketed.groupBy(SYMBOL, "_bucket")
        .count()
        .select(
            SYMBOL,
            "_bucket",
            F.coalesce(F.sum("count").over(before(in_order)), F.lit(0)).alias("_offset"),
        )
    )
    inside = Window.partitionBy(SYMBOL, "_bucket").orderBy(DATETIME)
    position = F.col("_offset") + F.row_number().over(inside) - 1
    home = F.floor(F.col("_pos") / span_rows)
    spans = F.when(
        F.col("_pos") % span_rows >= span_rows - lookback, F.array(home, home + 1)
    ).otherwise(F.array(home))
    return (
        bucketed.join(offsets, [SYMBOL, "_bucket"])
        .withColumn("_pos", position)
        .withColumn(SPAN, F.explode(spans))
        .withColumn(OWN, F.col(SPAN) == home)
        .drop("_bucket", "_offset", "_pos")
    )


def own_rows(frame: DataFrame) -> DataFrame:
    """Drop the copied rows once the windows are done, and the split marks.

    A span that consists of copies alone (a series that ends on a span border)
    disappears here as well.
    """
    return frame.where(OWN).drop(SPAN, OWN) if is_split(frame) else frame


def own(frame: DataFrame, x: Column) -> Column:
    """x on a span's own rows, null on the copies."""
    return F.when(F.col(OWN), x) if is_split(frame) else x


def with_carry(frame: DataFrame, values: Mapping[str, Column], fold) -> DataFrame:
    """Add, on split frames, what earlier spans contribute to a running aggregate.

    Column ``_carry_<name>`` holds fold(values of all spans before the row's own),
    null in the first span. A plain frame is one span and stays as it is.
    """
    if not is_split(frame):
        return frame
    per_span = (
        frame.where(OWN)
        .groupBy(SYMBOL, SPAN)
        .agg(*[fold(value).alias(name) for name, value in values.items()])
    )
    earlier = before(Window.partitionBy(SYMBOL).orderBy(SPAN))
    carry = per_span.select(
        SYMBOL, SPAN, *[fold(F.col(name)).over(earlier).alias(f"_carry_{name}") for name in values]
    )
    return frame.join(carry, [SYMBOL, SPAN], "left")


def running_sum(frame: DataFrame, name: str, w: WindowSpec) -> Column:
    """Sum of column ``name`` since the start of the series (after with_carry)."""
    here = F.sum(own(frame, F.col(name))).over(so_far(w))
    return here + F.coalesce(f"_carry_{name}", F.lit(0)) if is_split(frame) else here


def running_max(frame: DataFrame, name: str, w: WindowSpec) -> Column:
    here = F.max(own(frame, F.col(name))).over(so_far(w))
    return F.greatest(here, f"_carry_{name}") if is_split(frame) else here
