"""Data-quality analytics over the original and the corrected layer."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candleworks.functions.columns import days_between, ratio
from candleworks.operators.rules import SEQ_BLOCK
from candleworks.schema import AS_OF, CORRECTED, DATETIME, OHLC, ORIGINAL, SEQ, SYMBOL


def per_snapshot(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A function of frames keyed by symbol, made to keep snapshots apart.

    Where the frames have the snapshot columns, symbol and snapshot together are the key,
    and the result has those columns as well.
    """

    @wraps(fn)
    def run(*frames: DataFrame) -> DataFrame:
        if not set(AS_OF) <= set(frames[0].columns):
            return fn(*frames)
        key = F.struct(SYMBOL, *AS_OF)
        out = fn(*[f.withColumn(SYMBOL, key).drop(*AS_OF) for f in frames])
        named = [F.col(f"{SYMBOL}.{c}").alias(c) for c in (SYMBOL, *AS_OF)]
        return out.select(*named, *[c for c in out.columns if c != SYMBOL])

    return run


def _layer(layers: DataFrame, name: str) -> DataFrame:
    return layers.where(F.col("layer") == name).drop("layer")


@per_snapshot
def completeness(layers: DataFrame) -> DataFrame:
    """Rows against expected trading days (5 of 7 calendar days of the original range)."""
    original = F.col("layer") == ORIGINAL
    start = F.min(F.when(original, F.col(DATETIME)))
    end = F.max(F.when(original, F.col(DATETIME)))
    counted = layers.groupBy(SYMBOL).agg(
        start.alias("_start"),
        end.alias("_end"),
        F.count_if(original).alias("original_records"),
        F.count_if(F.col("layer") == CORRECTED).alias("_corrected"),
    )
    expected = F.col("total_days") * 5 / 7
    percent = lambda n: F.round(ratio(F.col(n), expected) * 100, 2)
    return (
        counted.where(F.col("original_records") > 0)
        .withColumns(
            {
                "start_date": F.col("_start").cast("date"),
                "end_date": F.col("_end").cast("date"),
                "total_days": days_between("_start", "_end") + 1,
                "corrected_records": F.when(F.col("_corrected") > 0, F.col("_corrected")).otherwise(
                    F.col("original_records")
                ),
            }
        )
        .select(
            SYMBOL,
            "start_date",
            "end_date",
            "total_days",
            "original_records",
            "corrected_records",
            F.floor(expected).alias("expected_trading_days"),
            percent("original_records").alias("completeness_original_pct"),
            percent("corrected_records").alias("completeness_corrected_pct"),
        )
    )


def gaps(bars: DataFrame) -> DataFrame:
    """(symbol, gap_days, n): how often each distance above one day occurs.

    Works on the distinct dates-times of a symbol; equal datetimes have distance 0.
    """
    times = bars.select(SYMBOL, DATETIME).distinct()
    w = Window.partitionBy(SYMBOL).orderBy(DATETIME)
    return (
        times.select(SYMBOL, days_between(F.lag(DATETIME).over(w), DATETIME).alias("gap_days"))
        .where(F.col("gap_days") > 1)
        .groupBy(SYMBOL, "gap_days")
        .agg(F.count("*").alias("n"))
    )


def gap_distribution(bars: DataFrame) -> DataFrame:
    """(symbol, total_gaps, largest_gap, gap_distribution MAP<'k_days', count>)."""
    entry = F.struct("gap_days", "n")
    per_symbol = gaps(bars).groupBy(SYMBOL).agg(
        F.sum("n").alias("total_gaps"),
        F.max("gap_days").alias("largest_gap"),
        # One entry per different gap length, not per gap.
        F.array_sort(F.collect_list(entry)).alias("_entries"),
    )
    entries = F.transform(
        "_entries",
        lambda e: F.struct(F.concat(e["gap_days"].cast("string"), F.lit("_days")), e["n"]),
    )
    none = F.from_json(F.lit("{}"), "map<string,bigint>")
    return (
        bars.select(SYMBOL)
        .distinct()
        .join(per_symbol, SYMBOL, "left")
        .select(
            SYMBOL,
            F.coalesce("total_gaps", F.lit(0)).alias("total_gaps"),
            F.coalesce("largest_gap", F.lit(0)).alias("largest_gap"),
            F.coalesce(F.map_from_entries(entries), none).alias("gap_distribution"),
        )
    )


def gaps_filled(metadata: DataFrame) -> DataFrame:
    """(symbol, gaps_filled) from run metadata; 0 where nothing was corrected."""
    return metadata.select(
        SYMBOL, F.coalesce("added_by_correction", F.lit(0)).alias("gaps_filled")
    )


def _null_counts() -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in [*OHLC, "volume"]]


def null_counts(bars: DataFrame) -> DataFrame:
    return bars.groupBy(SYMBOL).agg(*_null_counts())


def duplicate_dates(bars: DataFrame) -> DataFrame:
    """(symbol, duplicates): rows beyond the first of their date (null counts as a date)."""
    per_date = bars.groupBy(SYMBOL, "date").agg(F.count("*").alias("n"))
    return per_date.groupBy(SYMBOL).agg(F.sum(F.col("n") - 1).alias("duplicates"))


def is_sorted(bars: DataFrame) -> DataFrame:
    """(symbol, is_sorted): datetime never falls along ingest_seq.

    Checked inside blocks of ingest order and between their ends, so that no task
    sorts a whole symbol.
    """
    block = F.floor(F.col(SEQ) / SEQ_BLOCK)
    w = Window.partitionBy(SYMBOL, "_block").orderBy(SEQ)
    blocks = (
        bars.select(SYMBOL, SEQ, DATETIME, block.alias("_block"))
        .withColumn("_ok", F.col(DATETIME) >= F.lag(DATETIME).over(w))
        .groupBy(SYMBOL, "_block")
        .agg(
            F.bool_and("_ok").alias("_ok"),
            F.min_by(DATETIME, SEQ).alias("_first"),
            F.max_by(DATETIME, SEQ).alias("_last"),
        )
        .withColumn(
            "_step",
            F.col("_first") >= F.lag("_last").over(Window.partitionBy(SYMBOL).orderBy("_block")),
        )
    )
    whole = F.bool_and(F.coalesce("_ok", F.lit(True)) & F.coalesce("_step", F.lit(True)))
    return blocks.groupBy(SYMBOL).agg(whole.alias("is_sorted"))


# Rows and gap that a series needs before a forecast.
READY_ROWS = 252
READY_GAP_DAYS = 7


def forecast_readiness(bars: DataFrame) -> DataFrame:
    """(symbol, n_rows, largest_gap, positive_close, ready): whether a forecast makes sense."""
    largest = gaps(bars).groupBy(SYMBOL).agg(F.max("gap_days").alias("_gap"))
    counted = bars.groupBy(SYMBOL).agg(
        F.count("*").alias("n_rows"), F.coalesce(F.min("close") > 0, F.lit(False)).alias("positive_close")
    )
    enough = (F.col("n_rows") >= READY_ROWS) & (F.col("largest_gap") <= READY_GAP_DAYS)
    return (
        counted.join(largest, SYMBOL, "left")
        .withColumn("largest_gap", F.coalesce("_gap", F.lit(1)))
        .select(
            SYMBOL,
            "n_rows",
            "largest_gap",
            "positive_close",
            (enough & F.col("positive_close")).alias("ready"),
        )
    )


@per_snapshot
def original_vs_corrected(layers: DataFrame) -> DataFrame:
    """Rows and price/volume statistics of both layers in one row per symbol."""
    columns = []
    for layer in (ORIGINAL, CORRECTED):
        here = F.col("layer") == layer
        close, volume = F.when(here, F.col("close")), F.when(here, F.col("volume"))
        columns += [
            F.count_if(here).alias(f"{layer}_records"),
            F.avg(close).alias(f"{layer}_mean_close"),
            F.stddev_samp(close).alias(f"{layer}_std_close"),
            F.min(close).alias(f"{layer}_min_close"),
            F.max(close).alias(f"{layer}_max_close"),
            F.avg(volume).cast("bigint").alias(f"{layer}_mean_volume"),
            F.sum(volume).alias(f"{layer}_total_volume"),
        ]
    both = layers.groupBy(SYMBOL).agg(*columns)
    added = F.col(f"{CORRECTED}_records") - F.col(f"{ORIGINAL}_records")
    present = (F.col(f"{ORIGINAL}_records") > 0) & (F.col(f"{CORRECTED}_records") > 0)
    return both.where(present).withColumn("added_records", added)


_FROM_METADATA = [
    "added_by_correction",
    "is_valid",
    "total_issues",
    "critical_count",
    "warning_count",
    "info_count",
]


@per_snapshot
def report(layers: DataFrame, metadata: DataFrame) -> DataFrame:
    """The nested quality report: one row per symbol and snapshot (``as_of_year`` and
    ``as_of_month`` of both frames) that has an original layer and metadata."""
    original = _layer(layers, ORIGINAL)
    has_corrected = layers.where(F.col("layer") == CORRECTED).select(SYMBOL).distinct()
    uncorrected = original.join(has_corrected, SYMBOL, "left_anti")
    best = _layer(layers, CORRECTED).unionByName(uncorrected, allowMissingColumns=True)
    integrity = (
        null_counts(best).join(duplicate_dates(best), SYMBOL).join(is_sorted(best), SYMBOL)
    )
    joined = (
        completeness(layers)
        .join(gap_distribution(original), SYMBOL)
        .join(metadata.select(SYMBOL, *_FROM_METADATA), SYMBOL)
        .join(integrity, SYMBOL)
    )
    return joined.select(
        SYMBOL,
        F.format_string("%d-%02d", f"{SYMBOL}.as_of_year", f"{SYMBOL}.as_of_month").alias("period"),
        F.struct(
            F.col("start_date").alias("start"), F.col("end_date").alias("end"), "total_days"
        ).alias("date_range"),
        F.struct(
            "original_records",
            "corrected_records",
            "expected_trading_days",
            "completeness_original_pct",
            "completeness_corrected_pct",
        ).alias("completeness"),
        F.struct(
            "total_gaps",
            F.coalesce("added_by_correction", F.lit(0)).alias("gaps_filled_by_validation"),
            "gap_distribution",
            F.col("largest_gap").alias("largest_gap_days"),
        ).alias("gaps"),
        F.struct("is_valid", "total_issues", "critical_count", "warning_count", "info_count").alias(
            "validation_issues"
        ),
        F.struct(
            F.struct(*[F.col(f"{c}_nulls").alias(c) for c in [*OHLC, "volume"]]).alias("has_nulls"),
            F.col("duplicates").alias("has_duplicates"),
            "is_sorted",
        ).alias("data_integrity"),
    )
