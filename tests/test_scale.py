"""What keeps hot keys out of single tasks."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from candleworks.functions.joins import spread_join
from candleworks.operators import forecast, projections, relational
from candleworks.schema import SEQ, SYMBOL
from candleworks.session import fresh_folder
from candleworks.streaming import bars as streams


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "2")


@pytest.fixture(scope="module")
def raw(spark):
    """A stored raw table in which one symbol and one date hold most rows."""
    path = fresh_folder(spark, "raw")
    n = F.col("id")
    hot = n % 3 != 0
    spark.range(3000).select(
        F.when(hot, "HOT").otherwise(F.concat(F.lit("S"), n % 50)).alias(SYMBOL),
        F.when(hot, F.lit(dt.date(2025, 1, 6))).otherwise(F.date_add(F.lit(dt.date(2025, 1, 1)), (n % 300).cast("int"))).alias("date"),
        n.alias(SEQ),
        n.cast("double").alias("close"),
    ).withColumn("datetime", F.col("date").cast("timestamp_ntz")).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_join(raw, how):
    per_key = raw.groupBy(SYMBOL).agg(F.max("close").alias("top")).where("symbol <> 'S3'")
    plain = raw.join(per_key, [SYMBOL], how)
    spread = spread_join(raw, per_key, [SYMBOL], SEQ, how).select(*plain.columns)
    assert sorted(map(tuple, spread.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_spread_join_divides_the_hot_key(raw, no_broadcast):
    per_key = raw.groupBy(SYMBOL).agg(F.max("close").alias("top"))
    joined = spread_join(raw, per_key, [SYMBOL], SEQ).where("symbol = 'HOT'")
    sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 6 and max(r["count"] for r in sizes) < 1000


@pytest.mark.parametrize(
    "limited", [relational.dedup_keep_last, projections.compact, projections.latest_price]
)
def test_limits_are_applied_before_the_shuffle(raw, no_broadcast, limited):
    full = raw.withColumns({c: F.col("close") for c in ("adj_close", "volume", "currency", "exchange")})
    plan = limited(full)._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_first_copies(spark, tmp_path, raw):
    path = f"{tmp_path}/in"
    raw.limit(50).unionByName(raw.limit(50)).coalesce(1).write.parquet(path)
    stream = spark.readStream.schema(raw.schema).parquet(path)
    started = (
        streams.first_copies(stream, "400 days")
        .writeStream.format("parquet")
        .option("path", f"{tmp_path}/out")
        .option("checkpointLocation", f"{tmp_path}/state")
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 50


def test_holiday_table(spark, raw):
    table = spark.createDataFrame([(dt.date(2025, 1, 6), "epiphany")], "date date, holiday string")
    marked = forecast.with_holiday_table(raw, table, ["epiphany"])
    assert marked.where("epiphany = 1").count() == raw.where("date = date'2025-01-06'").count()
    assert marked.count() == raw.count()


def test_forecast_products_are_no_larger_than_their_rows():
    """At 10,000 symbols of 30 rows a task sends less than it gets, one triangle a symbol."""
    import pyarrow as pa

    from candleworks.operators.forecast import Model, _gram

    size = Model().size()
    rng = np.random.default_rng(0)

    def batches():
        for at in range(0, 10_000, 100):
            rows = rng.normal(size=(3_000, size + 1))
            names = np.repeat([f"S{i:05d}" for i in range(at, at + 100)], 30)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(list(rows), pa.list_(pa.float64()))], names=["symbol", "row"]
            )

    sent = list(_gram(size)(batches()))
    assert sum(b.num_rows for b in sent) == 10_000
    given = 10_000 * 30 * (size + 1)
    assert sum(len(b.column("products").flatten()) for b in sent) <= given
