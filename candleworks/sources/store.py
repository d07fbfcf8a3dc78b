"""Stored layers: snapshots, the current bars table, backups and run metadata.

Tables under one root, all Parquet:

* ``snapshots`` by layer, as_of_year, as_of_month: the whole history of a symbol as
  known in the month of its latest row.
* ``bars`` by layer, year, month of the row itself, for scans that prune by date.
* ``backups``: rows that a merge was about to replace, by backup_id and layer; of each
  symbol and layer the newest four stay.
* ``runs``: one metadata row per symbol and save.
* ``csv``: the bars of each layer and month once more as text, if asked for.

A merge reads only the partitions it touches, writes the result to a staging folder,
replaces just those partitions and removes the staging folder, so a path is never read
and overwritten in one job. Files are sorted by symbol within a month: reading one symbol
skips the row groups of the others.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candleworks.operators import rules
from candleworks.operators.projections import normalize_types, snapshot_period
from candleworks.operators.relational import dedup_keep_last
from candleworks.schema import AS_OF, BAR_COLUMNS, BARS, CORRECTED, DATETIME, ORIGINAL, SEQ, SYMBOL
from candleworks.session import drop_folder

# Fixed value: backups kept per symbol and layer.
MAX_BACKUPS = 4

OWN_MONTH = ["year", "month"]
_STORED = [*BAR_COLUMNS, SEQ, "is_filled"]


def latest_per_key(both: DataFrame, key: Sequence[str], arrival: bool = True) -> DataFrame:
    """One row per key: latest datetime, then highest ingest_seq, then new before stored.

    Without ``arrival`` (layers whose ingest_seq is a place in the series and not an order
    of arrival) new rows come before stored ones. The row_number filter already leaves one
    row per key in each map task.
    """
    order = [F.desc(SEQ), F.desc("_new")] if arrival else [F.desc("_new"), F.desc(SEQ)]
    newest = Window.partitionBy(*key).orderBy(F.desc(DATETIME), *order)
    return both.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") == 1).drop("_n")


def retained_backups(backups: DataFrame, keep: int = MAX_BACKUPS) -> DataFrame:
    """Rows of the newest ``keep`` backups of each symbol and layer."""
    ids = backups.select(SYMBOL, "layer", "backup_id").distinct()
    newest = Window.partitionBy(SYMBOL, "layer").orderBy(F.desc("backup_id"))
    kept = ids.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= keep)
    return backups.join(kept, [SYMBOL, "layer", "backup_id"], "left_semi")


def list_symbols(bars: DataFrame) -> DataFrame:
    return bars.select(SYMBOL).distinct().orderBy(SYMBOL)


def list_periods(snapshots: DataFrame) -> DataFrame:
    """(symbol, as_of_year, as_of_month, is_latest), sorted."""
    periods = snapshots.select(SYMBOL, *AS_OF).distinct()
    newest = F.max(F.struct(*AS_OF)).over(Window.partitionBy(SYMBOL))
    return periods.withColumn("is_latest", F.struct(*AS_OF) == newest).orderBy(SYMBOL, *AS_OF)


def write_csv(bars: DataFrame, path: str) -> None:
    """UTF-8 CSV with header."""
    bars.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def run_metadata(
    original: DataFrame,
    corrected: DataFrame,
    kept: DataFrame,
    verdict: DataFrame,
    stored: DataFrame | None = None,
) -> DataFrame:
    """One row per symbol: records, duplicates removed, date range and issue counts.

    ``original`` holds the delivered rows, ``kept`` those after deduplication. ``stored``
    and ``corrected`` hold what the snapshots have of both layers after the merge; without
    earlier deliveries ``stored`` equals ``kept``.
    """
    delivered = original.groupBy(SYMBOL).agg(F.count("*").alias("_delivered"))
    own = kept.groupBy(SYMBOL).agg(F.count("*").alias("_kept"))
    present = (kept if stored is None else stored).groupBy(SYMBOL).agg(
        F.count("*").alias("original_records"),
        F.min(DATETIME).cast("date").alias("start_date"),
        F.max(DATETIME).cast("date").alias("end_date"),
    )
    repaired = corrected.groupBy(SYMBOL).agg(F.count("*").alias("corrected_records"))
    counts = ["is_valid", "total_issues", "critical_count", "warning_count", "info_count"]
    return (
        present.join(own, SYMBOL)
        .join(delivered, SYMBOL)
        .join(repaired, SYMBOL, "left")
        .join(snapshot_period(kept), SYMBOL)
        .join(verdict.select(SYMBOL, *counts), SYMBOL, "left")
        .select(
            SYMBOL,
            *AS_OF,
            "original_records",
            (F.col("_delivered") - F.col("_kept")).alias("original_duplicates_removed"),
            "corrected_records",
            (F.col("corrected_records") - F.col("original_records")).alias("added_by_correction"),
            "start_date",
            "end_date",
            *counts,
        )
    )


def latest_snapshots(snapshots: DataFrame) -> DataFrame:
    """Rows of each symbol's latest snapshot."""
    newest = snapshots.groupBy(SYMBOL).agg(F.max(F.struct(*AS_OF)).alias("_as_of"))
    latest = newest.select(SYMBOL, *[F.col(f"_as_of.{c}").alias(c) for c in AS_OF])
    return snapshots.join(latest, [SYMBOL, *AS_OF], "left_semi")


class BarStore:
    """The tables under one root folder that all executors can reach."""

    def __init__(self, spark: SparkSession, root: str, compression: str = "snappy"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.compression = compression

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _read(self, table: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(self._path(table))
        except AnalysisException as missing:
            if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def _write(self, frame: DataFrame, table: str, by: Sequence[str], mode: str) -> None:
        # Rebalancing splits large and joins small write tasks per partition folder.
        (
            frame.hint("rebalance", *by)
            .sortWithinPartitions(*by, *([SYMBOL] if SYMBOL in frame.columns else []))
            .write.mode(mode)
            .option("compression", self.compression)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*by)
            .parquet(self._path(table))
        )

    def _touched(self, new: DataFrame, by: Sequence[str]) -> Column:
        """A filter on the partition folders that hold or will hold the new rows.

        The list has one entry per month of the calendar at most.
        """
        year, month = by
        number = F.col(year) * 12 + F.col(month)
        return number.isin([r[0] for r in new.select(number).distinct().collect()])

    def upsert(
        self,
        new: DataFrame,
        layer: str,
        table: str,
        by: Sequence[str],
        backup: bool = False,
        csv: bool = False,
    ) -> DataFrame:
        """Merge rows (with the partition columns ``by``) into one layer of a table.

        Returns (symbol, *by, records, start_date, end_date) of the merged partitions. The
        new rows are computed once, into a staging folder.
        """
        key = [SYMBOL, "date"] if table == "bars" else [SYMBOL, *by, "date"]
        parts = ["layer", *by]
        fresh, fresh_path = self._staged(new.select(*_STORED, *by), "new")
        touched = self._touched(fresh, by)
        both = fresh.withColumns({"layer": F.lit(layer), "_new": F.lit(1)})
        stored = self._read(table)
        if stored is not None:
            stored = stored.where(F.col("layer") == layer).where(touched)
            if backup:
                replaced = stored.join(fresh.select(SYMBOL, *by).distinct(), [SYMBOL, *by], "left_semi")
                self.back_up(replaced)
            both = both.unionByName(stored.select(*_STORED, *parts).withColumn("_new", F.lit(0)))
        merged = latest_per_key(both, key, arrival=layer == ORIGINAL).select(*_STORED, *parts)
        if layer == CORRECTED and table == "snapshots":
            place = Window.partitionBy(SYMBOL, *by).orderBy(DATETIME)
            merged = merged.withColumn(SEQ, F.row_number().over(place).cast("bigint"))
        if stored is None:
            self._write(merged, table, parts, "overwrite")
        else:
            self._replace(merged, table, parts)
        drop_folder(self.spark, fresh_path)
        here = self.spark.read.parquet(self._path(table)).where(F.col("layer") == layer).where(touched)
        if csv:
            self._write_csv(here, parts)
        return here.groupBy(SYMBOL, *by).agg(
            F.count("*").alias("records"), F.min("date").alias("start_date"), F.max("date").alias("end_date")
        )

    def _replace(self, frame: DataFrame, table: str, parts: Sequence[str]) -> None:
        """Overwrites the partitions of the frame, which may be read from the same table.

        The staged copy is one plain folder: only the table itself is dealt to month folders.
        """
        staged, path = self._staged(frame, table)
        self._write(staged, table, parts, "overwrite")
        drop_folder(self.spark, path)

    def _write_csv(self, rows: DataFrame, parts: Sequence[str]) -> None:
        (
            rows.select(*BAR_COLUMNS, *parts)
            .hint("rebalance", *parts)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("header", True)
            .option("encoding", "UTF-8")
            .partitionBy(*parts)
            .csv(self._path("csv"))
        )

    def csv(self, layer: str = CORRECTED) -> DataFrame:
        """The bars of a layer as the CSV files have them."""
        columns = [f for f in BARS.fields if f.name in BAR_COLUMNS]
        named = {f.name: f for f in columns}
        schema = T.StructType([*[named[c] for c in BAR_COLUMNS], T.StructField("layer", T.StringType())])
        schema = schema.add("year", T.IntegerType()).add("month", T.IntegerType())
        rows = self.spark.read.schema(schema).option("header", True).csv(self._path("csv"))
        return rows.where(F.col("layer") == layer)

    def _staged(self, frame: DataFrame, name: str) -> tuple[DataFrame, str]:
        path = self._path(f"staging/{name}-{uuid.uuid4().hex}")
        frame.write.parquet(path)
        return self.spark.read.parquet(path), path

    def back_up(self, rows: DataFrame) -> None:
        """Keep a copy of rows under a backup_id that sorts by time, and prune."""
        stamped = rows.withColumn("backup_id", F.lit(time.strftime("%Y%m%d%H%M%S") + f"{time.time_ns() % 10**9:09d}"))
        self._write(stamped, "backups", ["backup_id", "layer"], "append")
        self.prune_backups()

    def prune_backups(self, keep: int = MAX_BACKUPS) -> None:
        """Removes what is no longer among the newest ``keep`` backups of a symbol and layer.

        Folders without a row to keep are deleted; those with some are written anew. The
        driver sees one row per folder.
        """
        every = self._read("backups")
        if every is None:
            return
        parts = ["backup_id", "layer"]
        every = every.withColumn("backup_id", F.col("backup_id").cast("string"))
        left = retained_backups(every, keep)
        sizes = every.groupBy(*parts).agg(F.count("*").alias("n"))
        kept = left.groupBy(*parts).agg(F.count("*").alias("kept"))
        counted = sizes.join(kept, parts, "left").where("kept is null or kept < n").collect()
        partly = [r["backup_id"] for r in counted if r["kept"]]
        if partly:
            self._replace(left.where(F.col("backup_id").isin(partly)), "backups", parts)
        for r in counted:
            if not r["kept"]:
                drop_folder(self.spark, self._path(f"backups/backup_id={r['backup_id']}/layer={r['layer']}"))

    def save(
        self,
        original: DataFrame,
        corrected: DataFrame,
        found: DataFrame,
        backup: bool = True,
        csv: bool = False,
    ) -> DataFrame:
        """Store both layers of the symbols without critical issues; returns their metadata.

        The metadata is read back from the ``runs`` table it was written to.
        """
        accepted = rules.accepted(original, found)
        repaired = rules.accepted(corrected, found)
        kept = dedup_keep_last(normalize_types(accepted))
        if "is_filled" not in kept.columns:
            kept = kept.withColumn("is_filled", F.lit(False))
        # Both layers feed two tables and the metadata: they are computed once.
        kept, kept_path = self._staged(kept, "kept")
        repaired, repaired_path = self._staged(repaired, "repaired")
        period = snapshot_period(kept)
        own_month = {"year": F.year("date"), "month": F.month("date")}
        for layer, rows in ((ORIGINAL, kept), (CORRECTED, repaired)):
            self.upsert(rows.join(period, SYMBOL), layer, "snapshots", AS_OF, backup)
            self.upsert(rows.withColumns(own_month), layer, "bars", OWN_MONTH, csv=csv)
        verdict = rules.summary(accepted, found)
        saved = self.spark.read.parquet(self._path("snapshots")).where(self._touched(period, AS_OF))
        saved = saved.join(period, [SYMBOL, *AS_OF], "left_semi")
        stored, fixed = (saved.where(F.col("layer") == layer) for layer in (ORIGINAL, CORRECTED))
        run_id = str(time.time_ns())
        (
            run_metadata(accepted, fixed, kept, verdict, stored)
            .withColumn("compression", F.lit(self.compression))
            .withColumn("last_updated", F.current_timestamp())
            .withColumn("run_id", F.lit(run_id))
            .coalesce(1)
            .write.mode("append")
            .parquet(self._path("runs"))
        )
        for path in (kept_path, repaired_path):
            drop_folder(self.spark, path)
        self._compact_runs()
        return self.spark.read.parquet(self._path("runs")).where(F.col("run_id") == run_id)

    def _compact_runs(self, most: int = 64) -> None:
        """Joins the small files of many saves, once there are more than ``most``."""
        runs = self.spark.read.parquet(self._path("runs"))
        if len(runs.inputFiles()) > most:
            joined, path = self._staged(runs.repartition(1 + len(runs.inputFiles()) // (most * 16)), "runs")
            joined.write.mode("overwrite").parquet(self._path("runs"))
            drop_folder(self.spark, path)

    def snapshots(self, layer: str | None = None) -> DataFrame:
        table = self.spark.read.parquet(self._path("snapshots"))
        return table if layer is None else table.where(F.col("layer") == layer)

    def read(self, symbol: str, year: int, month: int, layer: str = CORRECTED) -> DataFrame:
        """One snapshot; empty when there is none. The folder columns prune the scan."""
        here = (F.col("as_of_year") == year) & (F.col("as_of_month") == month)
        return self.snapshots(layer).where(here & (F.col(SYMBOL) == symbol))

    def bars(self, layer: str = CORRECTED) -> DataFrame:
        return self.spark.read.parquet(self._path("bars")).where(F.col("layer") == layer)

    def metadata(self) -> DataFrame:
        """The newest metadata row of every symbol and snapshot."""
        newest = Window.partitionBy(SYMBOL, *AS_OF).orderBy(F.desc(F.col("run_id").cast("bigint")))
        runs = self.spark.read.parquet(self._path("runs"))
        return runs.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") == 1).drop("_n")

    def backups(self) -> DataFrame:
        return retained_backups(self.spark.read.parquet(self._path("backups")))
