"""Report rows per symbol from the stored layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleworks.operators import analytics, quality
from candleworks.schema import AS_OF, CORRECTED, SYMBOL
from candleworks.sources.store import latest_snapshots


def _nested(frame: DataFrame, name: str) -> DataFrame:
    columns = [c for c in frame.columns if c != SYMBOL]
    return frame.select(SYMBOL, F.struct(*columns).alias(name))


def report_dataset(layers: DataFrame, metadata: DataFrame) -> DataFrame:
    """(symbol, quality, financial, volume, comparison) of every symbol's latest snapshot."""
    layers = latest_snapshots(layers)
    metadata = latest_snapshots(metadata)
    corrected = layers.where(F.col("layer") == CORRECTED).drop("layer")
    return (
        _nested(quality.report(layers, metadata).drop(*AS_OF), "quality")
        .join(_nested(analytics.summary(corrected), "financial"), SYMBOL)
        .join(_nested(analytics.volume_report(corrected), "volume"), SYMBOL)
        .join(_nested(quality.original_vs_corrected(layers).drop(*AS_OF), "comparison"), SYMBOL)
    )


def report_json(dataset: DataFrame) -> DataFrame:
    """(symbol, report): the report payload of each symbol as JSON text."""
    parts = [c for c in dataset.columns if c != SYMBOL]
    return dataset.select(SYMBOL, F.to_json(F.struct(*parts)).alias("report"))
