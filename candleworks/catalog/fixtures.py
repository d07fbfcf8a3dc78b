"""Bars, ticks and forecast pairs derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candleworks.functions.columns import at_midnight
from candleworks.operators.corrections import corrected_layer
from candleworks.schema import BAR_COLUMNS, CORRECTED, ORIGINAL, SEQ, SYMBOL


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bars(trades: DataFrame) -> DataFrame:
    """Daily bars of trades; all aggregates combine before the shuffle.

    Trades are ordered by order, line, part, supplier, price and quantity.
    """
    price = F.col("l_extendedprice") / F.col("l_quantity")
    place = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    daily = trades.groupBy(SYMBOL, F.col("l_shipdate").cast("date").alias("date")).agg(
        F.min_by(price, place).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, place).alias("close"),
        F.sum("l_quantity").cast("bigint").alias("volume"),
    )
    in_order = Window.partitionBy(SYMBOL).orderBy("date")
    return daily.withColumns(
        {
            "datetime": at_midnight("date"),
            "adj_close": F.col("close"),
            "currency": F.lit("USD"),
            "exchange": F.lit("US"),
            SEQ: F.row_number().over(in_order).cast("bigint"),
        }
    ).select(*BAR_COLUMNS, SEQ)


def bars_by_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias(SYMBOL)
    )
    return _bars(table(spark, sf_dir, "lineitem").join(part, "l_partkey"))


def bars_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return _bars(lines.withColumn(SYMBOL, F.col("l_suppkey").cast("string")))


def brand_number(symbol: str | Column = SYMBOL) -> Column:
    return F.try_element_at(F.split(symbol, "#"), F.lit(2)).cast("int")


def symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_brand").alias(SYMBOL)).distinct()


def dirty_bars(spark: SparkSession, sf_dir: str, only: Column | None = None) -> DataFrame:
    """bars_by_brand with planted faults, copies and disorder (where ``only`` holds)."""
    hit = F.lit(True) if only is None else only
    every = lambda n: hit & (F.col(SEQ) % n == 0)
    broken = bars_by_brand(spark, sf_dir).withColumns(
        {
            "open": F.when(every(211), -F.col("open")).otherwise(F.col("open")),
            "low": F.when(every(227), F.col("high") + 1).otherwise(F.col("low")),
            "high": F.when(every(239), F.col("high") - 1).when(~every(223), F.col("high")),
            "adj_close": F.when(~every(233), F.col("adj_close")),
            "volume": F.when(every(11), 0)
            .when(every(229), -F.col("volume"))
            .otherwise(F.col("volume")),
        }
    )
    # The copies are further rows of the same table, emitted in place.
    again = F.when(every(97), F.array(F.lit(0), F.lit(1_000_000))).otherwise(F.array(F.lit(0)))
    return (
        broken.withColumn("_shift", F.explode(again))
        .withColumn(SEQ, F.col(SEQ) + F.col("_shift"))
        .drop("_shift")
    )


def mixed_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty bars of the odd brands, clean bars of the even ones.

    Every fifth even brand has no volume on every fifth bar and no other fault.
    """
    idle = (brand_number() % 10 == 4) & (F.col(SEQ) % 5 == 0)
    bars = dirty_bars(spark, sf_dir, brand_number() % 2 == 1)
    return bars.withColumn("volume", F.when(idle, 0).otherwise(F.col("volume")))


def raw_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bars as text, some fields missing or no numbers: (symbol, ingest_seq, fields)."""
    every = lambda n: F.col(SEQ) % n == 0
    named = lambda *ids: brand_number().isin(*ids)
    text = {c: F.col(c).cast("string") for c in BAR_COLUMNS}
    text["open"] = F.when(every(251), "n/a").otherwise(text["open"])
    text["close"] = F.when(every(263) & named(3, 4, 5), "").otherwise(text["close"])
    text["volume"] = (
        F.when(every(257) & named(6, 7), "many")
        .when(every(269), "12.5")
        .otherwise(text["volume"])
    )
    pairs = F.array(*[F.struct(F.lit(c).alias("k"), v.alias("v")) for c, v in text.items()])
    lost = F.when(named(1, 2), F.array(F.lit("adj_close"))).when(
        named(8), F.array(F.lit("currency"), F.lit("exchange"))
    )
    kept = F.filter(pairs, lambda p: ~F.coalesce(F.array_contains(lost, p["k"]), F.lit(False)))
    return bars_by_brand(spark, sf_dir).select(
        SYMBOL, SEQ, F.map_from_entries(kept).alias("fields")
    )


def adjusted_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bars_by_brand with nulls in adj_close, for the interpolation."""
    holes = (F.col(SEQ) % 31 == 0) | (F.col(SEQ) % 37).isin(0, 1, 2, 3)
    return bars_by_brand(spark, sf_dir).withColumn(
        "adj_close", F.when(~holes, F.col("adj_close"))
    )


def two_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = bars_by_brand(spark, sf_dir)
    original = bars.withColumn("is_filled", F.lit(False)).withColumn("layer", F.lit(ORIGINAL))
    return original.unionByName(corrected_layer(bars).withColumn("layer", F.lit(CORRECTED)))


def year_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot per symbol and year of the data: its history up to the end of that year."""
    last = table(spark, sf_dir, "lineitem").agg(F.max(F.year(F.col("l_shipdate").cast("date")))).first()[0]
    due = F.sequence(F.year("date"), F.lit(last))
    return bars_by_brand(spark, sf_dir).select(
        "*", F.explode(due).alias("as_of_year"), F.lit(12).alias("as_of_month")
    )


def ticks(events: DataFrame) -> DataFrame:
    """(symbol, ts TIMESTAMP, price, size) of an events table or stream."""
    return events.select(
        F.col("event_type").alias(SYMBOL),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("price"),
        F.lit(1).cast("bigint").alias("size"),
    )


def forecast_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, datetime, model, y, p) of a naive forecast and a mean of 5 closes."""
    w = Window.partitionBy(SYMBOL).orderBy("datetime")
    five = w.rowsBetween(-5, -1)
    bars = bars_by_brand(spark, sf_dir).select(
        SYMBOL,
        "datetime",
        F.col("close").alias("y"),
        F.lag("close").over(w).alias("naive"),
        F.when(F.count("close").over(five) == 5, F.avg("close").over(five)).alias("sma5"),
    )
    return bars.unpivot(
        [SYMBOL, "datetime", "y"], ["naive", "sma5"], "model", "p"
    ).where(F.col("p").isNotNull())


def providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priority 1 delivers the odd brands (closes doubled), priority 2 all of them."""
    bars = bars_by_brand(spark, sf_dir)
    ranks = F.when(brand_number() % 2 == 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(2)))
    return bars.withColumn("priority", F.explode(ranks)).withColumn(
        "close", F.when(F.col("priority") == 1, F.col("close") * 2).otherwise(F.col("close"))
    )


def weekly_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar per symbol and week from all its daily bars, dated by its last trading day."""
    daily = bars_by_brand(spark, sf_dir)
    ends = lambda f, c: f(F.col(c), F.col("date")).alias(c)
    return daily.groupBy(SYMBOL, F.date_trunc("week", "date").alias("_week")).agg(
        F.max("datetime").alias("datetime"),
        F.max("date").alias("last_date"),
        ends(F.min_by, "open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        ends(F.max_by, "close"),
        ends(F.max_by, "adj_close"),
        F.sum("volume").alias("volume"),
        F.max("currency").alias("currency"),
        F.max("exchange").alias("exchange"),
        F.max(SEQ).alias(SEQ),
    ).withColumnRenamed("last_date", "date").select(*BAR_COLUMNS, SEQ)


def variant_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series documents in four shapes, by brand and year: (symbol, part, payload).

    By brand number modulo 4: 0 numbered daily fields, 1 adjusted weekly ones with
    ``6. volume``, 2 plain names, 3 a repeated name, with empty opens, dates that are none
    and volumes beyond 64 bits in between.
    """
    bars = bars_by_brand(spark, sf_dir)
    shape, every = brand_number() % 4, lambda n: F.col(SEQ) % n == 0
    text = lambda c: c.cast("string")
    volume = F.when((shape == 3) & every(10), F.lit("1e30")).otherwise(text(F.col("volume")))
    opening = F.when((shape == 3) & every(7), F.lit("")).otherwise(text(F.col("open")))
    pairs = lambda **named: F.concat_ws(
        ",", *[F.concat(F.lit(f'"{k}":"'), v, F.lit('"')) for k, v in named.items()]
    )
    prices = [text(F.col(c)) for c in ("high", "low", "close")]
    numbered = dict(zip(["1. open", "2. high", "3. low", "4. close"], [opening, *prices]))
    plain = dict(zip(["open", "high", "low", "close"], [opening, *prices]))
    adjusted = {"5. adjusted close": text(F.col("close") / 2), "6. volume": volume}
    point = (
        F.when(shape == 0, pairs(**numbered, **{"5. volume": volume}))
        .when(shape == 1, pairs(**numbered, **adjusted))
        .when(shape == 2, pairs(**plain, volume=volume))
        .otherwise(pairs(**numbered, **{"5. volume": volume, "open": F.lit("1")}))
    )
    when = F.when((shape == 3) & every(11), F.lit("no day ")).otherwise(F.lit(""))
    entry = F.concat(F.lit('"'), when, F.date_format("date", "yyyy-MM-dd"), F.lit('":{'), point, F.lit("}"))
    name = F.element_at(
        F.array(*[F.lit(n) for n in ("Time Series (Daily)", "Weekly Adjusted Time Series", "Monthly Time Series", "Time Series (Daily)")]),
        F.first(shape) + 1,
    )
    documents = bars.groupBy(SYMBOL, F.year("date").alias("part")).agg(
        F.concat_ws(",", F.collect_list(entry)).alias("points"), name.alias("name")
    )
    payload = F.concat(F.lit('{"Meta Data":{},"'), "name", F.lit('":{'), "points", F.lit("}}"))
    return documents.select(SYMBOL, "part", payload.alias("payload"))
