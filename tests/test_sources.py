"""Payload variants, the store, runs, forecasts and streams."""

import datetime as dt
import json

import frames
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candleworks.operators import corrections, forecast, projections, relational, rules
from candleworks.plans import daily, reports
from candleworks.schema import CORRECTED, ORIGINAL, SYMBOL
from candleworks.session import fresh_folder
from candleworks.sources import payloads, universe
from candleworks.sources.store import AS_OF, OWN_MONTH, BarStore, retained_backups
from candleworks.streaming import bars as streams


def landed(spark, **documents):
    rows = [(s, d if isinstance(d, str) else json.dumps(d)) for s, d in documents.items()]
    return spark.createDataFrame(rows, "symbol string, payload string")


POINT = {"1. open": "100.0", "2. high": "105.0", "3. low": "95.0", "4. close": "102.0"}


def test_series_variants(spark):
    plain = {"open": "1", "high": "2", "low": "0.5", "close": "1.5", "volume": "7"}
    documents = landed(
        spark,
        A={"Meta Data": {}, "Time Series (Daily)": {"2025-01-06": {**POINT, "5. volume": "1000"}}},
        B={"Weekly Adjusted Time Series": {"2025-01-10": {**POINT, "5. adjusted close": "101", "6. volume": "9"}}},
        C={"Time Series X": {"2025-01-06": plain, "2025-01-07": {"price": "1"}, "2025-01-08": {**plain, "open": ""}}},
        D={"Error Message": "no such symbol"},
    )
    rows = {r.symbol: r for r in payloads.timeseries_bars(documents).collect()}
    assert set(rows) == {"A", "B", "C"}
    assert (rows["A"].volume, rows["A"].adj_close) == (1000, 102.0)
    assert (rows["B"].volume, rows["B"].adj_close, rows["B"].date) == (9, 101.0, dt.date(2025, 1, 10))
    assert rows["C"].date == dt.date(2025, 1, 6)
    generic = payloads.timeseries_generic(documents).where("symbol = 'C'").collect()
    assert len(generic) == 3


def test_no_point_stops_a_run(spark):
    both = {"open": "7", **POINT}
    documents = landed(
        spark,
        A={"Time Series (Daily)": {"2025-01-06": {**both, "5. volume": "1e30"}, "someday": {**POINT, "5. volume": "NaN"}}},
    )
    rows = sorted(payloads.timeseries_bars(documents).collect(), key=lambda r: r.date is None)
    assert [(r.date, r.open, r.volume) for r in rows] == [(dt.date(2025, 1, 6), 7.0, None), (None, 100.0, 0)]
    details = {(r.date_text, r.detail) for r in payloads.point_errors(documents).collect()}
    assert details == {("2025-01-06", "repeated_name"), ("2025-01-06", "volume_overflow"), ("someday", "bad_date")}
    text = spark.createDataFrame([("NaN",), ("1.5",), ("x",)], "close string")
    assert [r.close for r in projections.coerce_numeric(text, ["close"]).collect()] == [None, 1.5, None]


def test_values_and_quotes(spark):
    values = [{"datetime": "2025-01-06", "open": "100", "high": "105", "low": "95", "close": "bad", "volume": None}]
    row = payloads.values_bars(landed(spark, V={"status": "ok", "values": values})).collect()[0]
    assert (row.close, row.volume, row.open) == (None, 0, 100.0)
    meta = {"symbol": "ASML.AS", "regularMarketPrice": 700.1, "currency": "EUR"}
    quote = payloads.quotes(landed(spark, Q={"chart": {"result": [{"meta": meta}]}})).collect()
    assert [tuple(r) for r in quote] == [("ASML.AS", 700.1, "EUR")]


def test_classify(spark):
    documents = landed(
        spark,
        a={"Error Message": "bad"},
        b={"Information": "standard CALL FREQUENCY is 5"},
        c={"Information": "thank you"},
        d={"status": "error", "message": "no"},
        e={"status": "ok", "values": []},
        f="not json",
        g={"Time Series (Daily)": {}},
        h={"Monthly Time Series": {"2025-01-31": POINT}},
    )
    status = {r.symbol: r.status for r in payloads.classify(documents).collect()}
    assert status == {
        "a": "provider_error",
        "b": "rate_limited",
        "c": "no_series",
        "d": "provider_error",
        "e": "no_series",
        "f": "not_json",
        "g": "no_series",
        "h": "ok",
    }


def test_files_and_intervals(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"Time Series (Daily)": {"2025-01-06": POINT}}))
    read = payloads.read_payloads(spark, str(tmp_path)).withColumn(SYMBOL, F.lit("SAP.DE"))
    bars = payloads.interval_bars(read.withColumn("interval", F.lit("1d")), "1d").collect()
    assert [(r.symbol, r.exchange, r.volume) for r in bars] == [("SAP.DE", "Frankfurt", 0)]
    with pytest.raises(ValueError):
        payloads.interval_bars(read, "5m")


def test_universe(spark):
    rows = universe.universe(spark)
    assert rows.count() == 70
    assert rows.where("universe = 'core'").count() == 15


def test_look_back_and_compact(spark):
    bars = frames.bars(spark, [{} for _ in range(130)])
    assert projections.compact(bars, "1mo").count() == 100
    assert projections.compact(bars, "5y").count() == 130
    assert projections.look_back(bars, 7).count() == 7


def test_upsert_is_idempotent_and_the_highest_ingest_seq_wins(spark):
    old = frames.bars(spark, frames.base_rows())
    new = frames.bars(spark, frames.base_rows(close={2: 999.0})[:3])
    once = relational.merge_upsert(old, new)
    twice = relational.merge_upsert(once, new)
    rows = lambda df: sorted((r.date, r.close) for r in df.collect())
    assert rows(once) == rows(twice)
    # Of equal ingest_seq the new row wins, a lower one loses whichever comes last.
    assert len(rows(once)) == 6 and rows(once)[2][1] == 999.0
    assert rows(relational.merge_upsert(old, new.withColumn("ingest_seq", F.lit(0)))) == rows(old)
    assert rows(relational.merge_upsert(new.withColumn("ingest_seq", F.lit(0)), old)) == rows(old)


def save(store, bars):
    found = rules.issues(bars)
    return store.save(bars, corrections.corrected_layer(rules.accepted(bars, found)), found)


def test_a_merge_writes_month_folders_once(spark, monkeypatch):
    target = BarStore(spark, fresh_folder(spark, "store"))
    rows = frames.bars(spark, [{} for _ in range(70)]).withColumn("is_filled", F.lit(False))
    rows = rows.withColumns({"year": F.year("date"), "month": F.month("date")})
    target.upsert(rows, ORIGINAL, "bars", OWN_MONTH)
    written, write = [], BarStore._write
    monkeypatch.setattr(BarStore, "_write", lambda self, frame, table, *more: written.append(table) or write(self, frame, table, *more))
    target.upsert(rows.where("ingest_seq % 2 = 0").withColumn("close", F.lit(1.0)), ORIGINAL, "bars", OWN_MONTH)
    assert written == ["bars"]
    assert target.bars(ORIGINAL).count() == 70 and target.bars(ORIGINAL).where("close = 1").count() == 35


def test_store_round_trip(spark):
    store = BarStore(spark, fresh_folder(spark, "store"), compression="zstd")
    good = frames.bars(spark, [{"date": dt.date(2025, 1, d)} for d in (27, 28, 29, 30, 31)])
    bad = good.withColumn(SYMBOL, F.lit("BAD")).withColumn("open", F.lit(-1.0))
    first = save(store, good.unionByName(bad)).collect()
    assert [(r.symbol, r.original_records, r.added_by_correction) for r in first] == [("TEST", 5, 0)]
    later = frames.bars(
        spark, [{"date": dt.date(2025, 1, d), "close": 103.0} for d in (27, 28, 29, 30, 31)]
    ).unionByName(frames.bars(spark, [{"date": dt.date(2025, 2, 2), "close": 104.0}]))
    later = later.withColumn("ingest_seq", F.row_number().over(_by_date()).cast("bigint"))
    second = save(store, later).collect()
    assert [(r.original_records, r.corrected_records) for r in second] == [(6, 7)]
    # The history as of January stays, the one as of February is new.
    periods = {(r.as_of_year, r.as_of_month) for r in store.snapshots(CORRECTED).select(*AS_OF).distinct().collect()}
    assert periods == {(2025, 1), (2025, 2)}
    assert store.read("TEST", 2025, 1).count() == 5
    assert store.read("TEST", 2025, 2, ORIGINAL).count() == 6
    assert store.read("TEST", 2024, 1).count() == 0
    closes = {r.date.day: r.close for r in store.bars(ORIGINAL).where("month = 1").collect()}
    assert closes == {d: 103.0 for d in (27, 28, 29, 30, 31)}
    assert store.metadata().count() == 2
    # Saving January again merges with its snapshot and leaves a backup.
    save(store, good)
    assert store.backups().where(F.col("layer") == ORIGINAL).count() == 5
    dataset = reports.report_dataset(
        store.snapshots().where("as_of_month = 2"), store.metadata().where("as_of_month = 2")
    )
    report = json.loads(reports.report_json(dataset).collect()[0].report)
    assert report["quality"]["completeness"]["corrected_records"] == 7
    assert report["financial"]["end_price"] == 104.0


def _by_date():
    from pyspark.sql import Window

    return Window.partitionBy(SYMBOL).orderBy("date")


def test_backup_retention(spark):
    rows = spark.createDataFrame(
        [("A", ORIGINAL, str(i)) for i in range(6)] + [("B", ORIGINAL, "0")],
        "symbol string, layer string, backup_id string",
    )
    kept = sorted((r.symbol, r.backup_id) for r in retained_backups(rows).collect())
    assert kept == [("A", "2"), ("A", "3"), ("A", "4"), ("A", "5"), ("B", "0")]


def test_run_statistics(spark):
    asked = spark.createDataFrame([("TEST",), ("BAD",), ("NONE",)], "symbol string")
    good = frames.bars(spark, frames.base_rows())
    bad = good.withColumn(SYMBOL, F.lit("BAD")).withColumn("open", F.lit(-1.0))
    delivered = good.unionByName(bad).withColumn("priority", F.lit(1))
    row = daily.run_statistics(daily.run_daily(asked, delivered).status).collect()[0]
    assert row.asDict() == {
        "total_symbols": 3,
        "successful": 1,
        "failed": 1,
        "skipped": 1,
        "total_records": 6,
        "success_rate": 33.3,
    }


@pytest.fixture(scope="module")
def seasonal(spark):
    days = pd.date_range("2018-01-01", periods=1200, freq="D")
    rng = np.random.default_rng(1)
    frames_ = []
    for k, s in enumerate("AB"):
        t = np.arange(len(days))
        trend = 100 + 0.05 * t + np.where(t > 500, 0.08 * (t - 500), 0)
        y = trend + 6 * np.sin(2 * np.pi * t / 365.25) + 3 * (days.dayofweek == k) + rng.normal(0, 0.5, len(t))
        frames_.append(pd.DataFrame({"datetime": days, "date": days.date, "symbol": s, "close": y}))
    pdf = pd.concat(frames_)
    return spark.createDataFrame(pdf, "datetime timestamp_ntz, date date, symbol string, close double")


def test_forecast_beats_naive(seasonal):
    cut = F.col("date") < F.lit("2021-01-15").cast("date")
    train, test = seasonal.where(cut), seasonal.where(~cut)
    fitted = forecast.fit(forecast.prepare(train))
    scores = {r.symbol: r for r in forecast.evaluate(test, fitted).collect()}
    last = {r.symbol: r.close for r in train.where("date = date'2021-01-14'").collect()}
    for symbol, score in scores.items():
        actual = np.array([r.close for r in test.where(F.col(SYMBOL) == symbol).collect()])
        naive = np.sqrt(np.mean((actual - last[symbol]) ** 2))
        assert score.rmse < naive / 2
    strongest = forecast.changepoints(fitted).where("rank = 1").collect()
    assert all(abs((r.datetime - dt.datetime(2019, 5, 16)).days) < 120 for r in strongest)


def test_forecast_frames(seasonal):
    train = forecast.prepare(seasonal)
    fitted = forecast.fit(train)
    with_past = forecast.predict(forecast.future_frame(train, 30), fitted)
    assert forecast.predictions(with_past).count() == 60
    assert forecast.predictions(with_past, future_only=False).count() == 2460
    only_future = forecast.future_frame(train, 10, include_history=False)
    assert only_future.groupBy(SYMBOL).agg(F.count("*").alias("n"), F.min("ds").alias("a")).collect()[0].n == 10
    inside = with_past.join(train, [SYMBOL, "ds"]).selectExpr("avg(int(y between yhat_lower and yhat_upper)) c")
    assert 0.7 < inside.collect()[0].c < 0.9


def test_stream_bars_drop_late_ticks(spark, tmp_path):
    schema = "symbol string, ts timestamp, price double, size bigint"

    def land(name, *ticks):
        rows = [("A", dt.datetime(2025, 1, 1, h, m, tzinfo=dt.timezone.utc), p, 1) for h, m, p in ticks]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{name}")

    def run():
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in/*")
        started = (
            streams.ohlc(stream)
            .writeStream.format("parquet")
            .option("path", f"{tmp_path}/out")
            .option("checkpointLocation", f"{tmp_path}/state")
            .trigger(availableNow=True)
            .start()
        )
        started.awaitTermination()

    land("1", (9, 0, 10.0), (9, 30, 12.0), (9, 59, 11.0), (13, 0, 20.0))
    run()
    land("2", (9, 15, 99.0), (13, 5, 21.0), (17, 0, 1.0))
    run()
    rows = spark.read.parquet(f"{tmp_path}/out").orderBy("bar_start").collect()
    assert [(r.bar_start.hour, r.open, r.high, r.low, r.close, r.ticks) for r in rows] == [
        (9, 10.0, 12.0, 10.0, 11.0, 3),
        (13, 20.0, 21.0, 20.0, 21.0, 2),
    ]


def test_stream_upsert_again_changes_nothing(spark):
    store = BarStore(spark, fresh_folder(spark, "stream"))
    run = streams.upsert_into(store, ORIGINAL)
    batch = frames.bars(spark, frames.base_rows())
    for i in (0, 0, 1):
        run(batch, i)
    assert store.bars(ORIGINAL).count() == 6
    flagged = streams.flag_rows(frames.bars(spark, frames.base_rows(low={1: 300.0})))
    broken = {r.ingest_seq: sorted(r.broken) for r in flagged.collect() if r.broken}
    weekend = ["vr_weekend_trading"]
    assert broken == {1: ["vr_low_gt_close", "vr_low_gt_high", "vr_low_gt_open"], 3: weekend, 4: weekend}
