"""Projections, filters and type conversions of bars tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candleworks.functions.columns import at_midnight, exchange_of, no_nan
from candleworks.functions.joins import spread_join
from candleworks.schema import BAR_COLUMNS, DATETIME, OHLC, PRICES, SYMBOL

# Look-back periods that a compact answer (100 points) covers.
COMPACT_PERIODS = ("5d", "1mo", "3mo")
COMPACT_ROWS = 100


def to_bars_schema(prices: DataFrame, currency: str = "USD") -> DataFrame:
    """Complete (datetime, symbol, OHLC, volume[, adj_close]) to the 11 columns in order."""
    adjusted = F.coalesce("adj_close", "close") if "adj_close" in prices.columns else F.col("close")
    extra = [c for c in prices.columns if c not in BAR_COLUMNS]
    return prices.withColumns(
        {
            "date": F.col(DATETIME).cast("date"),
            "adj_close": adjusted,
            "currency": F.lit(currency),
            "exchange": exchange_of(SYMBOL),
        }
    ).select(*BAR_COLUMNS, *extra)


def with_exchange(frame: DataFrame) -> DataFrame:
    return frame.withColumn("exchange", exchange_of(SYMBOL))


def normalize_types(bars: DataFrame) -> DataFrame:
    """Cast every canonical column to its stored type; NaN becomes null, a missing volume 0."""
    types = {DATETIME: "timestamp_ntz", "date": "date"}
    types |= {c: "string" for c in (SYMBOL, "currency", "exchange")}
    types |= {c: "double" for c in PRICES}
    casts = {c: F.col(c).cast(t) for c, t in types.items() if c in bars.columns}
    casts |= {c: no_nan(casts[c]) for c in PRICES if c in casts}
    if "volume" in bars.columns:
        casts["volume"] = F.coalesce(F.col("volume"), F.lit(0)).cast("bigint")
    return bars.withColumns(casts)


def coerce_numeric(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text to double; text that is no number, and NaN, becomes null."""
    return frame.withColumns({c: no_nan(F.col(c).try_cast("double")) for c in columns})


def drop_null_prices(bars: DataFrame) -> DataFrame:
    return bars.na.drop(subset=OHLC)


def compact(bars: DataFrame, period: str = "3mo") -> DataFrame:
    """The latest 100 rows per symbol for short periods, everything for long ones."""
    if period not in COMPACT_PERIODS:
        return bars
    newest = Window.partitionBy(SYMBOL).orderBy(F.desc(DATETIME))
    # The filter on row_number lets every map task keep 100 rows per symbol.
    return (
        bars.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= COMPACT_ROWS).drop("_n")
    )


def look_back(bars: DataFrame, days: int) -> DataFrame:
    """Rows of the last ``days`` days before each symbol's newest row."""
    newest = bars.groupBy(SYMBOL).agg(F.max("date").alias("_newest"))
    joined = spread_join(bars, newest, [SYMBOL], DATETIME)
    return joined.where(F.col("date") > F.date_sub("_newest", days)).drop("_newest")


def latest_price(bars: DataFrame) -> DataFrame:
    """The newest row of every symbol."""
    fields = ["close", "adj_close", "volume", "date", "currency", "exchange"]
    newest = Window.partitionBy(SYMBOL).orderBy(F.desc(DATETIME))
    return (
        bars.select(SYMBOL, DATETIME, *fields)
        .withColumn("_n", F.row_number().over(newest))
        .where(F.col("_n") == 1)
        .select(
            SYMBOL,
            F.col("close").alias("price"),
            F.col("adj_close").alias("adj_price"),
            F.coalesce("volume", F.lit(0)).alias("volume"),
            "date",
            "currency",
            "exchange",
        )
    )


def snapshot_period(bars: DataFrame) -> DataFrame:
    """(symbol, as_of_year, as_of_month): the partition of each symbol's latest row."""
    latest = F.max(DATETIME)
    return bars.groupBy(SYMBOL).agg(
        F.year(latest).alias("as_of_year"), F.month(latest).alias("as_of_month")
    )


def with_midnight(frame: DataFrame) -> DataFrame:
    return frame.withColumn(DATETIME, at_midnight("date"))
