"""Structured Streaming versions of ingest, row rules and bar building."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from candleworks.operators.rules import row_rules
from candleworks.schema import BAR_COLUMNS, DATETIME, SEQ, SYMBOL
from candleworks.session import staged
from candleworks.sources.store import OWN_MONTH, BarStore


def first_copies(bars: DataFrame, delay: str = "7 days") -> DataFrame:
    """Drop rows that repeat (symbol, date, ingest_seq) within the delay."""
    return (
        bars.withColumn("_at", F.col(DATETIME).cast("timestamp"))
        .withWatermark("_at", delay)
        .dropDuplicatesWithinWatermark([SYMBOL, "date", SEQ])
        .drop("_at")
    )


class BatchLedger:
    """Which micro-batches of a stream are merged: one small folder per batch.

    A batch that a restart delivers again is skipped, so its rows are neither merged nor
    counted twice. The entry is written after the merge: a crash in between leaves the merge
    to be run again, which changes nothing. ``stream`` tells streams into one store apart.
    """

    def __init__(self, store: BarStore, stream: str):
        self.spark = store.spark
        self.root = f"{store.root}/_batches/{stream}"

    def _exists(self, path: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    def holds(self, batch_id: int) -> bool:
        return self._exists(f"{self.root}/batch_id={batch_id}/_SUCCESS")

    def enter(self, batch_id: int, merged: dict) -> None:
        """merged: what the store says of the merge."""
        row = [(int(merged["rows"]), merged["first_date"], merged["last_date"])]
        frame = self.spark.createDataFrame(row, "rows long, first_date date, last_date date")
        frame.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/batch_id={batch_id}")  # one row

    def entries(self) -> DataFrame:
        """batch_id, rows, first_date and last_date of every merged batch."""
        schema = "batch_id long, rows long, first_date date, last_date date"
        if not self._exists(self.root):
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.option("basePath", self.root).parquet(f"{self.root}/batch_id=*")
        return found.select(F.col("batch_id").cast("long").alias("batch_id"), "rows", "first_date", "last_date")


def upsert_into(store: BarStore, layer: str, ledger: BatchLedger | None = None):
    """A foreachBatch function that merges a micro-batch into the bars table.

    The merge keeps one row per symbol and date by datetime and ingest_seq, so a batch
    that is run again after a failure changes nothing. With a ledger a batch that was merged
    before is skipped altogether, and rows and dates of each are kept.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        if ledger and ledger.holds(batch_id):
            return
        months = {"year": F.year("date"), "month": F.month("date")}
        seen = Observation(f"batch-{batch_id}")
        rows = batch.select(*BAR_COLUMNS, SEQ).withColumn("is_filled", F.lit(False)).withColumns(months)
        if ledger:
            counts = F.count("*").alias("rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
            rows = staged(rows.observe(seen, *counts), "batch")  # counted where it is written, once
        if not ledger or seen.get["rows"]:
            store.upsert(rows, layer, "bars", OWN_MONTH)
        if ledger:
            ledger.enter(batch_id, seen.get)

    return run


def flag_rows(bars: DataFrame) -> DataFrame:
    """bars plus ``broken``: the row-local rules each row breaks. Stateless."""
    names = [
        F.when(F.coalesce(cond, F.lit(False)), F.lit(rule if field is None else f"{rule}:{field}"))
        for (rule, field), cond in row_rules().items()
    ]
    return bars.withColumn("broken", F.array_compact(F.array(*names)))


def ohlc(ticks: DataFrame, width: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """Ticks (symbol, ts, price, size) to bars per tumbling window.

    ``ts`` must be a TIMESTAMP. Works on streams (rows behind the watermark are dropped)
    and on tables. Equal times are ordered by price, so the result does not depend on the
    order of arrival. All aggregates combine before the shuffle.
    """
    at = F.struct("ts", "price")
    return (
        ticks.withWatermark("ts", delay)
        .groupBy(F.window("ts", width), SYMBOL)
        .agg(
            F.min(at)["price"].alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max(at)["price"].alias("close"),
            F.sum("size").alias("volume"),
            F.count("*").alias("ticks"),
        )
        .select(SYMBOL, F.col("window.start").alias("bar_start"), "open", "high", "low", "close", "volume", "ticks")
    )
