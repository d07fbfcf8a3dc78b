"""Returns, volatility, drawdown, summary and volume statistics per symbol.

Frames are daily (see functions.series) or split with ``split_long`` and a
``lookback`` of at least RISK_LOOKBACK rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candleworks.functions.columns import change, ratio
from candleworks.functions.joins import spread_join
from candleworks.functions.quantiles import exact_quantiles
from candleworks.functions.series import (
    own_rows,
    padded,
    rolling,
    running_max,
    timeline,
    with_carry,
)
from candleworks.schema import DATETIME, SYMBOL
from candleworks.session import staged

# Trading days per year, rolling window, anomaly limit, top days.
TRADING_DAYS = 252
VOLATILITY_WINDOW = 30
ANOMALY_Z = 2
TOP_DAYS = 10

RISK_LOOKBACK = VOLATILITY_WINDOW + 1


def _with_return(bars: DataFrame) -> DataFrame:
    w = timeline(bars)
    return bars.withColumn("_close", padded("close", w)).withColumn(
        "daily_return", change("_close", F.lag("_close").over(w))
    )


def daily_returns(bars: DataFrame) -> DataFrame:
    """(symbol, datetime, date, close, daily_return); a null close counts as unchanged."""
    kept = [SYMBOL, DATETIME, "date", "close", "daily_return"]
    return own_rows(_with_return(bars)).select(*kept)


def _period_returns(bars: DataFrame, label: Column, following, name: str) -> DataFrame:
    """Last close per calendar period and its change; empty periods stay, with change 0.

    ``following`` moves a period label by a number of periods.
    """
    closes = bars.groupBy(SYMBOL, label.alias("period_end")).agg(
        F.max_by("close", F.when(F.col("close").isNotNull(), F.col(DATETIME))).alias("close")
    )
    w = Window.partitionBy(SYMBOL).orderBy("period_end")
    known = closes.withColumn("_known", padded("close", w)).withColumns(
        {
            "_change": change("_known", F.lag("_known").over(w)),
            "_next": F.lead("period_end").over(w),
        }
    )
    periods = known.withColumn(
        "_ahead", F.explode(F.when(F.col("_next").isNull(), F.array(F.lit(0))).otherwise(following))
    )
    real = F.col("_ahead") == 0
    return periods.select(
        SYMBOL,
        F.when(real, F.col("period_end")).otherwise(_moved(name)).alias("period_end"),
        F.when(real, F.col("close")).alias("close"),
        F.when(real, F.col("_change"))
        .when(F.col("_known").isNotNull(), F.lit(0.0))
        .alias(name),
    )


def _moved(name: str) -> Column:
    if name == "weekly_return":
        return F.date_add("period_end", F.col("_ahead") * 7)
    return F.last_day(F.add_months(F.trunc("period_end", "month"), F.col("_ahead")))


def weekly_returns(bars: DataFrame) -> DataFrame:
    """(symbol, period_end, close, weekly_return) for weeks that end on Sunday."""
    sunday = F.date_add(F.trunc("date", "week"), 6)
    weeks = F.sequence(F.lit(0), (F.datediff("_next", "period_end") / 7).cast("int") - 1)
    return _period_returns(bars, sunday, weeks, "weekly_return")


def monthly_returns(bars: DataFrame) -> DataFrame:
    """(symbol, period_end, close, monthly_return) for calendar months."""
    apart = F.months_between(F.trunc("_next", "month"), F.trunc("period_end", "month")).cast("int")
    return _period_returns(
        bars, F.last_day("date"), F.sequence(F.lit(0), apart - 1), "monthly_return"
    )


def _with_rolling_volatility(returns: DataFrame, window: int) -> DataFrame:
    return returns.withColumn(
        "rolling_vol", rolling(F.stddev_samp, "daily_return", timeline(returns), window)
    )


def _with_drawdown(bars: DataFrame) -> DataFrame:
    w = timeline(bars)
    carried = with_carry(bars, {"close": F.col("close")}, F.max)
    top = running_max(carried, "close", w)
    return carried.withColumn("_top", top).withColumn(
        "drawdown", ratio(F.col("close") - F.col("_top"), "_top")
    )


def rolling_volatility(bars: DataFrame, window: int = VOLATILITY_WINDOW) -> DataFrame:
    """(symbol, datetime, rolling_vol), null until the window is full."""
    rows = own_rows(_with_rolling_volatility(_with_return(bars), window))
    return rows.select(SYMBOL, DATETIME, "rolling_vol")


def _volatility_aggregates(annualized: bool) -> list[Column]:
    daily = F.stddev_samp("daily_return")
    yearly = daily * math.sqrt(TRADING_DAYS) if annualized else daily
    return [
        daily.alias("daily_volatility"),
        (yearly * 100).alias("annualized_volatility_pct"),
        F.max_by("rolling_vol", DATETIME).alias("current_rolling_vol"),
        F.max("rolling_vol").alias("max_rolling_vol"),
        F.min("rolling_vol").alias("min_rolling_vol"),
    ]


def volatility(
    bars: DataFrame, window: int = VOLATILITY_WINDOW, annualized: bool = True
) -> DataFrame:
    rows = own_rows(_with_rolling_volatility(_with_return(bars), window))
    return rows.groupBy(SYMBOL).agg(*_volatility_aggregates(annualized))


def drawdown_rows(bars: DataFrame) -> DataFrame:
    """(symbol, datetime, close, running_max, drawdown)."""
    rows = own_rows(_with_drawdown(bars))
    return rows.select(SYMBOL, DATETIME, "close", F.col("_top").alias("running_max"), "drawdown")


def _lowest(value: Column) -> Column:
    """(v, datetime) of the smallest value, the first one when values repeat."""
    return F.min(F.when(value.isNotNull(), F.struct(value.alias("v"), F.col(DATETIME))))


def _drawdown_aggregates() -> list[Column]:
    return [
        _lowest(F.col("drawdown")).alias("_deepest"),
        (F.max_by("drawdown", DATETIME) * 100).alias("current_drawdown_pct"),
        F.count_if(F.col("drawdown") < 0).alias("days_in_drawdown"),
    ]


def _deepest_columns() -> list[Column]:
    return [
        (F.col("_deepest.v") * 100).alias("maximum_drawdown_pct"),
        F.col(f"_deepest.{DATETIME}").cast("date").alias("max_drawdown_date"),
    ]


def drawdown(bars: DataFrame) -> DataFrame:
    """Deepest and current drawdown, and the number of rows below the running maximum."""
    found = own_rows(_with_drawdown(bars)).groupBy(SYMBOL).agg(*_drawdown_aggregates())
    return found.select(SYMBOL, *_deepest_columns(), "current_drawdown_pct", "days_in_drawdown")


def drawdown_days(bars: DataFrame) -> DataFrame:
    below = F.count_if(F.col("drawdown") < 0).alias("days_in_drawdown")
    return own_rows(_with_drawdown(bars)).groupBy(SYMBOL).agg(below)


def summary(bars: DataFrame, window: int = VOLATILITY_WINDOW) -> DataFrame:
    """Price, volume, volatility and drawdown figures, all from one pass over the bars."""
    rows = _with_drawdown(_with_rolling_volatility(_with_return(bars), window))
    found = (
        own_rows(rows)
        .groupBy(SYMBOL)
        .agg(
            F.min(DATETIME).cast("date").alias("start_date"),
            F.max(DATETIME).cast("date").alias("end_date"),
            F.count("*").alias("trading_days"),
            F.min_by("close", DATETIME).alias("start_price"),
            F.max_by("close", DATETIME).alias("end_price"),
            _lowest(-F.col("high")).alias("_highest"),
            _lowest(F.col("low")).alias("_lowest"),
            F.avg("volume").cast("bigint").alias("average_volume"),
            _lowest(-F.col("volume")).alias("_busiest"),
            F.sum("volume").alias("total_volume"),
            *_volatility_aggregates(True),
            *_drawdown_aggregates(),
        )
    )
    rise = F.col("end_price") - F.col("start_price")
    when = lambda place: F.col(f"{place}.{DATETIME}").cast("date")
    return found.select(
        SYMBOL,
        "start_date",
        "end_date",
        "trading_days",
        "start_price",
        "end_price",
        (ratio(rise, "start_price") * 100).alias("total_return_pct"),
        rise.alias("price_change"),
        (-F.col("_highest.v")).alias("highest_price"),
        when("_highest").alias("highest_price_date"),
        F.col("_lowest.v").alias("lowest_price"),
        when("_lowest").alias("lowest_price_date"),
        "average_volume",
        (-F.col("_busiest.v")).alias("max_volume"),
        when("_busiest").alias("max_volume_date"),
        "total_volume",
        "daily_volatility",
        "annualized_volatility_pct",
        "current_rolling_vol",
        "max_rolling_vol",
        "min_rolling_vol",
        *_deepest_columns(),
        "current_drawdown_pct",
        "days_in_drawdown",
    )


# --- volume ----------------------------------------------------------------


def volume_stats(bars: DataFrame) -> DataFrame:
    """Mean, deviation, exact median, extremes (whole numbers) and zero-volume rows."""
    # All figures come from the counts of equal volumes; a volume without value is counted too.
    counts = staged(bars.groupBy(SYMBOL, F.col("volume").alias("value")).agg(F.count("*").alias("n")), "volumes")
    known = counts.where("value is not null").select(SYMBOL, F.col("value").cast("double").alias("value"), "n")
    median = exact_quantiles(known, [SYMBOL], {"median": 0.5})
    whole = lambda c, name: c.cast("bigint").alias(name)
    value, n = F.col("value").cast("double"), F.col("n")
    sums = counts.groupBy(SYMBOL).agg(
        F.sum(F.when(F.col("value").isNotNull(), n)).alias("_n"),
        F.sum(value * n).alias("_sum"),
        F.max("value").alias("max_volume"),
        F.min("value").alias("min_volume"),
        F.coalesce(F.sum(F.when(F.col("value") == 0, n)), F.lit(0)).alias("zero_volume_days"),
    )
    # Deviations from the mean, so that nothing cancels.
    centred = sums.select(SYMBOL, ratio("_sum", "_n").alias("_mean"))
    off = F.col("value") - F.col("_mean")
    spread = spread_join(known, centred, [SYMBOL], "value").groupBy(SYMBOL).agg(F.sum(off * off * n).alias("_off"))
    stats = sums.join(centred, SYMBOL).join(spread, SYMBOL, "left").select(
        SYMBOL,
        whole(F.col("_mean"), "average_volume"),
        whole(F.sqrt(ratio("_off", F.nullif(F.col("_n") - 1, F.lit(0)))), "std_volume"),
        "max_volume",
        "min_volume",
        "zero_volume_days",
    )
    return stats.join(median, SYMBOL, "left").select(
        SYMBOL,
        "average_volume",
        "std_volume",
        whole(F.col("median"), "median_volume"),
        "max_volume",
        "min_volume",
        "zero_volume_days",
    )


def volume_anomalies(bars: DataFrame, limit: float = ANOMALY_Z) -> DataFrame:
    """(symbol, datetime, volume, zscore): rows further than ``limit`` deviations from the mean."""
    stats = bars.groupBy(SYMBOL).agg(
        F.avg("volume").alias("_mean"), F.stddev_samp("volume").alias("_std")
    )
    z = ratio(F.col("volume") - F.col("_mean"), "_std")
    return (
        bars.select(SYMBOL, DATETIME, "volume")
        .transform(spread_join, stats, [SYMBOL], DATETIME)
        .select(SYMBOL, DATETIME, "volume", z.alias("zscore"))
        .where(F.abs("zscore") > limit)
    )


def top_volume_share(bars: DataFrame, days: int = TOP_DAYS) -> DataFrame:
    """(symbol, top_10_days_volume_pct): share of the busiest days in the total volume."""
    busiest = Window.partitionBy(SYMBOL).orderBy(F.desc_nulls_last("volume"))
    top = (
        bars.select(SYMBOL, "volume")
        .withColumn("_n", F.row_number().over(busiest))
        .where(F.col("_n") <= days)
        .groupBy(SYMBOL)
        .agg(F.sum("volume").alias("_top"))
    )
    total = bars.groupBy(SYMBOL).agg(F.sum("volume").alias("_total"))
    share = ratio("_top", "_total") * 100
    return total.join(top, SYMBOL).select(SYMBOL, share.alias(f"top_{days}_days_volume_pct"))


def volume_report(bars: DataFrame) -> DataFrame:
    """volume_stats plus the number of anomalous days and the share of the busiest ones."""
    anomalous = volume_anomalies(bars).groupBy(SYMBOL).agg(
        F.count("*").alias("anomalous_volume_days")
    )
    return (
        volume_stats(bars)
        .join(anomalous, SYMBOL, "left")
        .na.fill(0, ["anomalous_volume_days"])
        .join(top_volume_share(bars), SYMBOL)
    )


# --- snapshots -------------------------------------------------------------


def compare_periods(snapshots: DataFrame, metric: str = "return") -> DataFrame:
    """(symbol, period, value) for every snapshot (as_of_year, as_of_month) given.

    ``metric`` is 'return' (percent), 'volatility' (annualised percent) or 'volume'
    (mean). Select the snapshots before; their partition columns prune the scan.
    """
    period = F.format_string("%d-%02d", "as_of_year", "as_of_month")
    # A snapshot is a series of its own: symbol and period together are its key.
    series = snapshots.withColumn(
        SYMBOL, F.struct(F.col(SYMBOL).alias("name"), period.alias("period"))
    )
    if metric == "return":
        ends = series.groupBy(SYMBOL).agg(
            F.min_by("close", DATETIME).alias("a"), F.max_by("close", DATETIME).alias("b")
        )
        value = ends.select(SYMBOL, (ratio(F.col("b") - F.col("a"), "a") * 100).alias("value"))
    elif metric == "volatility":
        value = volatility(series).select(SYMBOL, F.col("annualized_volatility_pct").alias("value"))
    elif metric == "volume":
        value = series.groupBy(SYMBOL).agg(
            F.avg("volume").cast("bigint").cast("double").alias("value")
        )
    else:
        raise ValueError("metric must be return, volatility or volume")
    return value.select(
        F.col(f"{SYMBOL}.name").alias(SYMBOL), F.col(f"{SYMBOL}.period").alias("period"), "value"
    )
