"""Joins and set operations between bars tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candleworks.functions.columns import change
from candleworks.functions.joins import spread_join
from candleworks.functions.series import padded, timeline
from candleworks.schema import CORRECTED, DATETIME, ORIGINAL, SEQ, SYMBOL


def symbol_values(bars: DataFrame, metric: str = "close") -> DataFrame:
    """(datetime, symbol, value) for any number of symbols.

    ``metric`` is a column of bars or 'returns' (daily change of close).
    """
    if metric == "returns":
        return symbol_returns(bars)
    return bars.select(DATETIME, SYMBOL, F.col(metric).alias("value"))


def symbol_returns(bars: DataFrame) -> DataFrame:
    """(datetime, symbol, value): daily returns on the symbol's own timeline."""
    w = timeline(bars)
    known = bars.select(DATETIME, SYMBOL, padded("close", w).alias("_close"))
    return known.select(DATETIME, SYMBOL, change("_close", F.lag("_close").over(w)).alias("value"))


def side_by_side(values: DataFrame, symbols: Sequence[str] | None = None) -> DataFrame:
    """One row per datetime and one column per symbol; nulls where a symbol has no row.

    The columns are the symbols named, or all that the data holds (up to the session's
    limit of pivot values). For more symbols use the long form.
    """
    return values.groupBy(DATETIME).pivot(SYMBOL, list(symbols) if symbols else None).agg(F.first("value"))


def compare_symbols(bars: DataFrame, symbols: Sequence[str] | None = None, metric: str = "close") -> DataFrame:
    """symbol_values of the symbols (all of the data by default) side by side."""
    chosen = bars.where(F.col(SYMBOL).isin(list(symbols))) if symbols else bars
    return side_by_side(symbol_values(chosen, metric), symbols)


def aligned_returns(bars: DataFrame, symbols: Sequence[str] | None = None) -> DataFrame:
    """Daily returns of the symbols side by side, aligned by datetime."""
    return compare_symbols(bars, symbols, "returns")


def original_corrected(layers: DataFrame) -> DataFrame:
    """Per symbol: rows and total close of both layers side by side, and the difference."""
    is_original = F.col("layer") == ORIGINAL
    is_corrected = F.col("layer") == CORRECTED
    return (
        layers.groupBy(SYMBOL)
        .agg(
            F.count_if(is_original).alias("original_rows"),
            F.count_if(is_corrected).alias("corrected_rows"),
            F.sum(F.when(is_original, F.col("volume"))).alias("original_volume"),
            F.sum(F.when(is_corrected, F.col("volume"))).alias("corrected_volume"),
        )
        .withColumn("added_rows", F.col("corrected_rows") - F.col("original_rows"))
    )


def with_regressors(training: DataFrame, regressors: DataFrame) -> DataFrame:
    """Attach external series by symbol and datetime."""
    return training.join(regressors, [SYMBOL, DATETIME], "left")


def forecast_with_actual(forecast: DataFrame, actual: DataFrame) -> DataFrame:
    """(symbol, datetime, y, p) for the dates that have both."""
    return forecast.select(SYMBOL, DATETIME, F.col("predicted_price").alias("p")).join(
        actual.select(SYMBOL, DATETIME, F.col("close").alias("y")), [SYMBOL, DATETIME]
    )


def missing_symbols(requested: DataFrame, bars: DataFrame) -> DataFrame:
    """Requested symbols that have no bar."""
    return requested.join(bars.select(SYMBOL).distinct(), SYMBOL, "left_anti")


def first_provider(bars: DataFrame) -> DataFrame:
    """Per symbol the rows of the provider with the lowest ``priority`` that delivered any."""
    best = bars.groupBy(SYMBOL).agg(F.min("priority").alias("priority"))
    return spread_join(bars, best, [SYMBOL, "priority"], SEQ, "left_semi")


def dedup_keep_last(bars: DataFrame) -> DataFrame:
    """One row per symbol and date: the latest datetime, then the highest ingest_seq.

    The filter on row_number keeps one row per key in every map task already, so a
    date with very many copies does not meet in one place.
    """
    newest = Window.partitionBy(SYMBOL, "date").orderBy(F.desc(DATETIME), F.desc(SEQ))
    return bars.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") == 1).drop("_n")


def merge_upsert(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Existing and new rows, one per symbol and date: the latest datetime, then the
    highest ingest_seq, then the new row."""
    both = existing.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    newest = Window.partitionBy(SYMBOL, "date").orderBy(
        F.desc(DATETIME), F.desc(SEQ), F.desc("_new")
    )
    return (
        both.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") == 1).drop("_n", "_new")
    )


def missing_dates(bars: DataFrame) -> DataFrame:
    """(symbol, date): calendar days inside a symbol's range without a row."""
    dates = bars.select(SYMBOL, "date").distinct()
    following = F.lead("date").over(Window.partitionBy(SYMBOL).orderBy("date"))
    return (
        dates.withColumn("_next", following)
        .where(F.datediff("_next", "date") > 1)
        .select(SYMBOL, F.explode(F.sequence(F.date_add("date", 1), F.date_sub("_next", 1))).alias("date"))
    )
