"""The rules on the order of rows, along a stream of bars.

vr_date_order and vr_gap_suspicious compare a row with the one that arrived before it, of any
batch: batches arrive in the order of their ids, and rows of a batch in that of ingest_seq.
vr_extreme_variation compares a close with the known close before it in time. For that a row
waits until the stream has moved on by ``delay``; then the rows that are due are taken in order
of datetime and ingest_seq. A row that comes after its time was taken is reported as ``late``
and takes no part in changes. Rows without a datetime wait for the end, behind all others.

A micro-batch is worked on like a table: blocks of ingest order and days of a symbol are
separate tasks, and only their ends meet per symbol. What is kept between batches is one row
per symbol, the rows that wait and the highest datetime. Each batch writes its own folders, the
clock last: a batch that a restart delivers again is skipped when its clock is there, and else
computed anew from the batch before it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from candleworks.functions.columns import days_between
from candleworks.functions.series import before
from candleworks.operators.rules import LONG_GAP_DAYS, MAX_VARIATION, SEQ_BLOCK, variation
from candleworks.schema import DATETIME, SEQ, SYMBOL
from candleworks.session import drop_folder

_ROW = f"{SYMBOL} string, {SEQ} long, {DATETIME} timestamp_ntz, close double"
_ENDS = f"{SYMBOL} string, last_at timestamp_ntz, last_close double"
_FOUND = f"{SYMBOL} string, {SEQ} long, {DATETIME} timestamp_ntz, rule string"
_CLOCK = "highest timestamp_ntz, released timestamp_ntz"


def _moment(value: dt.datetime | None) -> Column:
    return F.lit(None if value is None else value.isoformat()).cast("timestamp_ntz")


def _flagged(rows: DataFrame, rule: Column) -> DataFrame:
    marked = rows.withColumn("rule", rule).where("rule is not null")
    return marked.select(SYMBOL, SEQ, DATETIME, "rule")


def _by_arrival(rows: DataFrame, ends: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The broken order rules of rows, and each symbol's last datetime after them."""
    inside = Window.partitionBy(SYMBOL, "_block").orderBy(SEQ)
    placed = rows.withColumn("_block", F.floor(F.col(SEQ) / SEQ_BLOCK)).withColumns(
        {"_n": F.row_number().over(inside), "_prev": F.lag(DATETIME).over(inside)}
    )
    blocks = placed.groupBy(SYMBOL, "_block").agg(F.max_by(DATETIME, SEQ).alias("last_at"))
    kept = ends.select(SYMBOL, F.lit(-1).cast("long").alias("_block"), "last_at")
    along = Window.partitionBy(SYMBOL).orderBy("_block")
    known = blocks.unionByName(kept).withColumn("_before", F.lag("last_at").over(along))
    joined = placed.join(known.select(SYMBOL, "_block", "_before"), [SYMBOL, "_block"], "left")
    gap = days_between("_last", DATETIME)
    joined = joined.withColumn("_last", F.when(F.col("_n") == 1, F.col("_before")).otherwise(F.col("_prev")))
    rule = F.when(F.col(DATETIME) < F.col("_last"), "vr_date_order").when(gap > LONG_GAP_DAYS, "vr_gap_suspicious")
    return _flagged(joined, rule), known.groupBy(SYMBOL).agg(F.max_by("last_at", "_block").alias("last_at"))


def _by_time(rows: DataFrame, ends: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The extreme changes of rows, and each symbol's last known close after them."""
    day = F.coalesce(F.col(DATETIME).cast("date"), F.lit("9999-12-31").cast("date"))
    inside = Window.partitionBy(SYMBOL, "_day").orderBy(DATETIME, SEQ)
    placed = rows.withColumn("_day", day).withColumn("_prev", F.last("close", ignorenulls=True).over(before(inside)))
    place = F.when(F.col("close").isNotNull(), F.struct(DATETIME, SEQ))
    days = placed.groupBy(SYMBOL, "_day").agg(F.max_by("close", place).alias("last_close"))
    kept = ends.select(SYMBOL, F.lit("0001-01-01").cast("date").alias("_day"), "last_close")
    along = before(Window.partitionBy(SYMBOL).orderBy("_day"))
    known = days.unionByName(kept).withColumn("_before", F.last("last_close", ignorenulls=True).over(along))
    joined = placed.join(known.select(SYMBOL, "_day", "_before"), [SYMBOL, "_day"])
    change = variation(F.col("close"), F.coalesce("_prev", "_before"))
    rule = F.when(change > MAX_VARIATION, "vr_extreme_variation")
    last = F.max_by("last_close", F.when(F.col("last_close").isNotNull(), F.col("_day"))).alias("last_close")
    return _flagged(joined, rule), known.groupBy(SYMBOL).agg(last)


class OrderRules:
    """A foreachBatch function; ``found`` gives the rows that broke a rule.

    ``root`` is a folder of this stream alone that all executors reach.
    """

    def __init__(self, spark: SparkSession, root: str, delay: dt.timedelta = dt.timedelta(days=7)):
        self.spark, self.root, self.delay = spark, root.rstrip("/"), delay

    def _path(self, table: str, batch_id: int) -> str:
        return f"{self.root}/{table}/batch_id={batch_id}"

    def _done(self) -> list[int]:
        """The ids of the batches whose clock is written, the last two at most."""
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/clock/batch_id=*/_SUCCESS")
        found = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(pattern)
        return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found or ())

    def _read(self, table: str, batch_id: int | None, schema: str) -> DataFrame:
        if batch_id is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._path(table, batch_id))

    def _write(self, frame: DataFrame, table: str, batch_id: int) -> None:
        frame.write.mode("overwrite").parquet(self._path(table, batch_id))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        done = self._done()
        if done and batch_id <= done[-1]:
            return
        last = done[-1] if done else None
        seen = Observation(f"order-{batch_id}")
        self._write(batch.select(SYMBOL, SEQ, DATETIME, "close").observe(seen, F.max(DATETIME).alias("highest")), "rows", batch_id)
        clock = self._read("clock", last, _CLOCK).first()
        highest = max((t for t in (clock and clock["highest"], seen.get["highest"]) if t), default=None)
        closed, due = clock and clock["released"], highest and highest - self.delay

        rows, ends = self._read("rows", batch_id, _ROW), self._read("ends", last, _ENDS)
        late = F.coalesce(F.col(DATETIME) <= _moment(closed), F.lit(False))
        ripe = F.coalesce(F.col(DATETIME) <= _moment(due), F.lit(False))
        waited = rows.where(~late).unionByName(self._read("waiting", last, _ROW))
        order, last_at = _by_arrival(rows, ends)
        jumps, last_close = _by_time(waited.where(ripe), ends)
        self._write(order.unionByName(jumps).unionByName(_flagged(rows, F.when(late, "late"))), "found", batch_id)
        self._write(waited.where(~ripe), "waiting", batch_id)
        self._write(last_at.join(last_close, SYMBOL, "left"), "ends", batch_id)
        row = self.spark.createDataFrame([(highest, due)], _CLOCK)
        self._write(row.coalesce(1), "clock", batch_id)  # one row
        drop_folder(self.spark, self._path("rows", batch_id))
        for old in done[:-1]:
            for table in ("clock", "ends", "waiting"):
                drop_folder(self.spark, self._path(table, old))

    def found(self, closed: bool = False) -> DataFrame:
        """(symbol, ingest_seq, datetime, rule) of the batches so far; a row can break several.

        ``closed``: no row is to come, so those that wait are judged as well.
        """
        done = self._done()
        if not done:
            return self.spark.createDataFrame([], _FOUND)
        # Rows of a batch that was broken off have no clock yet and are left out.
        rows = self.spark.read.schema(f"{_FOUND}, batch_id long").parquet(f"{self.root}/found")
        rows = rows.where(F.col("batch_id") <= done[-1]).drop("batch_id")
        if closed:
            rest, _ = _by_time(self._read("waiting", done[-1], _ROW), self._read("ends", done[-1], _ENDS))
            rows = rows.unionByName(rest)
        return rows
