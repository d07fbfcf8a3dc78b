"""Logistic growth, intervals that grow with the horizon, holidays of countries."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from candleworks.operators import forecast, growth, holidays


def rows_of(spark, series):
    rows = [(s, dt.datetime(2020, 1, 1) + dt.timedelta(days=i), float(y)) for s, ys in series.items() for i, y in enumerate(ys)]
    return spark.createDataFrame(rows, "symbol string, datetime timestamp_ntz, close double")


def curve(n, cap, floor, u0, rate, bend=0.0, at=0.5):
    t = np.arange(n) / (n - 1)
    return floor + (cap - floor) / (1 + np.exp(-(u0 + rate * t + bend * np.maximum(t - at, 0))))


TREND = forecast.Model(changepoints=0, yearly=0, weekly=0)


def plain_fit(y, cap, start, rounds=200):
    """Gauss-Newton with numpy on one series."""
    t, theta = np.arange(len(y)) / (len(y) - 1), np.array(start, float)
    for _ in range(rounds):
        s = 1 / (1 + np.exp(-(theta[0] + theta[1] * t)))
        j = (cap * s * (1 - s))[:, None] * np.stack([np.ones_like(t), t], 1)
        theta = theta + np.linalg.lstsq(j, y - cap * s, rcond=None)[0]
    return theta


def test_logistic_recovers_planted_curves(spark):
    rng = np.random.default_rng(1)
    series = {
        "exact": curve(400, 50, 10, -3, 6),
        "falling": curve(300, 20, 0, 2, -5),
        "noisy": curve(500, 80, 0, -2, 4) + rng.normal(0, 1.5, 500),
        "single": [7.0],
    }
    caps = {"exact": (50.0, 10.0), "falling": (20.0, 0.0), "noisy": (80.0, 0.0), "single": (20.0, 0.0)}
    bounds = spark.createDataFrame([(s, *b) for s, b in caps.items()], "symbol string, top double, low double")
    train = growth.prepare(rows_of(spark, series).join(bounds, "symbol"), F.col("top"), F.col("low"))
    fitted = growth.fit(train, TREND)
    got = {r.symbol: r for r in fitted.collect()}
    assert all(r.converged for r in got.values()) and len(got) == 4
    assert got["exact"].coefficients == pytest.approx([-3, 6], abs=1e-5) and got["exact"].sigma < 1e-6
    assert got["falling"].coefficients == pytest.approx([2, -5], abs=1e-5)
    assert got["noisy"].coefficients == pytest.approx(plain_fit(series["noisy"], 80, [-2, 4]), abs=1e-6)
    # Far ahead the forecast saturates at the capacity, or at the floor.
    ahead = rows_of(spark, {s: [0.0] * 1200 for s in caps}).select("symbol", F.col("datetime").alias("ds"))
    end = ahead.groupBy("symbol").agg(F.max("ds").alias("ds")).join(bounds.withColumnsRenamed({"top": "cap", "low": "floor"}), "symbol")
    last = {r.symbol: r for r in growth.predict(end, fitted, TREND).collect()}
    assert last["exact"].yhat == pytest.approx(50, abs=0.1) and last["falling"].yhat == pytest.approx(0, abs=0.1)
    assert last["single"].yhat == pytest.approx(7, abs=1e-6)


def test_logistic_with_a_bend_and_seasons(spark):
    """The rate changes at a knot; weekly terms and priors take part."""
    week = 0.8 * np.sin(2 * np.pi * np.arange(700) / 7)
    model = forecast.Model(changepoints=4, changepoint_range=0.8, yearly=0, weekly=2)
    train = growth.prepare(rows_of(spark, {"a": curve(700, 60, 0, -3, 8, -6, 0.4) + week}), F.lit(60.0))
    fitted = growth.fit(train, model)
    row = fitted.first()
    assert row.converged and row.sigma * row.y_scale < 0.3
    shown = growth.predict(train.select("symbol", "ds", "cap", "floor", "y"), fitted, model).join(train, ["symbol", "ds"])
    assert shown.agg(F.avg(F.abs(F.col("yhat") - F.col("y")))).first()[0] < 0.3


def test_empty_and_impossible_rows(spark):
    bars = rows_of(spark, {"a": [1.0, 2.0, 3.0]})
    assert growth.fit(growth.prepare(bars.limit(0), F.lit(5.0)), TREND).count() == 0
    assert growth.fit(growth.prepare(bars, F.lit(0.0)), TREND).count() == 0  # no room under the capacity
    assert growth.fit(growth.prepare(bars, F.lit(None)), TREND).count() == 0


def test_intervals_grow_with_the_horizon(spark):
    """The closed form against drawn paths of Poisson changes with Laplace sizes."""
    model = forecast.Model(changepoints=10, changepoint_range=0.8)
    deltas, ahead = [0.3, -0.1, 0.2, 0.0, -0.4, 0.1, 0.05, -0.05, 0.3, -0.2], 0.6
    given = spark.createDataFrame([(deltas, ahead)], "d array<double>, h double")
    variance = given.select(forecast.trend_variance(F.col("d"), F.col("h"), model)).first()[0]
    rng, drawn = np.random.default_rng(5), []
    for _ in range(40_000):
        n = rng.poisson(10 / 0.8 * ahead)
        at = rng.uniform(0, ahead, n)
        drawn.append((rng.laplace(0, np.mean(np.abs(deltas)), n) * (ahead - at)).sum())
    assert variance == pytest.approx(np.var(drawn), rel=0.05)

    roof, model = 40 - 0.1 * np.abs(np.arange(400) - 200), forecast.Model(yearly=0)
    train = forecast.prepare(rows_of(spark, {"a": roof}))
    rows = forecast.predict(forecast.future_frame(train, 200), forecast.fit(train, model), model).orderBy("ds").collect()
    widths = np.array([r.yhat_upper - r.yhat_lower for r in rows])
    assert np.ptp(widths[:400]) < 1e-9 and (np.diff(widths[400:]) > 0).all() and widths[-1] > 2 * widths[0]


def test_holidays(spark):
    known = {2000: "04-23", 2008: "03-23", 2011: "04-24", 2019: "04-21", 2024: "03-31", 2025: "04-20", 2038: "04-25", 1818: "03-22"}
    years = spark.createDataFrame([(y,) for y in known], "y int")
    got = {r.y: f"{r.e:%m-%d}" for r in years.select("y", holidays.easter_sunday(F.col("y")).alias("e")).collect()}
    assert got == known

    def named(country, *days):
        frame = spark.createDataFrame([(dt.date.fromisoformat(d) if d else None,) for d in days], "date date")
        return [r[0] for r in frame.select(holidays.of(country, F.col("date"))).collect()]

    assert named("BR", "2024-02-13", "2024-05-30", "2024-03-29") == [["Carnival Tuesday"], ["Corpus Christi"], ["Good Friday"]]
    assert named("GB", "2021-12-27", "2021-12-28", "2022-05-30") == [
        ["Christmas Day (observed)"], ["Boxing Day (observed)"], ["Spring Bank Holiday"]]
    assert named("US", "2021-12-31", "2022-01-01", "2020-06-19", "2021-06-18") == [
        ["New Year's Day (observed)"], ["New Year's Day"], [], ["Juneteenth (observed)"]]
    assert named("SE", "2024-06-22", "2024-11-02", "2024-06-21") == [["Midsummer Day"], ["All Saints' Day"], []]
    assert named("DE", "2024-05-20", None) == [["Whit Monday"], []]
    frame = spark.createDataFrame([(dt.date(2024, 12, 25),), (dt.date(2024, 12, 24),)], "date date")
    wide = holidays.with_columns(frame, "IT").orderBy("date").collect()
    assert [r["Christmas Day"] for r in wide] == [0.0, 1.0] and len(wide[0]) == 1 + len(holidays.names("IT"))
