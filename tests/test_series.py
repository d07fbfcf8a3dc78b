"""Indicators and risk figures against pandas, plain and on split series."""

import frames
import numpy as np
import pandas as pd
import pytest

from candleworks.functions.quantiles import exact_quantiles, value_counts
from candleworks.functions.recursive import memory, with_ema
from candleworks.functions.series import own_rows, split_long
from candleworks.operators import analytics, corrections, features
from candleworks.operators.correlation import correlation


@pytest.fixture(scope="module")
def walk():
    return frames.random_bars(days=3000)


@pytest.fixture(scope="module")
def bars(spark, walk):
    return frames.to_spark(spark, walk).cache()


def expected_features(g):
    c, h, l, v = g["close"], g["high"], g["low"], g["volume"]
    delta = c.diff()
    gain = delta.where(delta > 0, 0).rolling(14).apply(np.mean)
    loss = (-delta.where(delta < 0, 0)).rolling(14).apply(np.mean)
    macd = c.ewm(span=12, adjust=False).mean() - c.ewm(span=26, adjust=False).mean()
    ranges = pd.concat([h - l, (h - c.shift()).abs(), (l - c.shift()).abs()], axis=1).max(axis=1)
    up, down = h.diff().clip(lower=0), (-l.diff()).clip(lower=0)
    out = {f"sma_{n}": c.rolling(n).mean() for n in (5, 10, 20, 50)}
    out |= {f"ema_{n}": c.ewm(span=n, adjust=False).mean() for n in (12, 26)}
    out |= {
        "rsi": 100 - 100 / (1 + gain / loss),
        "macd": macd,
        "macd_signal": macd.ewm(span=9, adjust=False).mean(),
        "roc": (c - c.shift(12)) / c.shift(12) * 100,
        "bb_upper": c.rolling(20).mean() + 2 * c.rolling(20).std(),
        "atr": ranges.rolling(14).mean(),
        "obv": (np.sign(delta).fillna(0) * v).cumsum(),
        "vwap": ((h + l + c) / 3 * v).cumsum() / v.cumsum(),
        "return_5d": c.pct_change(5) * 100,
        "log_return": np.log(c / c.shift()),
        "trend_strength": up.rolling(14).mean() - down.rolling(14).mean(),
    }
    return pd.DataFrame(out).assign(symbol=g["symbol"], datetime=g["datetime"])


@pytest.mark.parametrize("split", [False, True])
def test_features_match_pandas(bars, walk, split):
    chosen = features.all_features(bars.columns)
    need = features.needed_lookback(chosen)
    frame = split_long(bars, need, span_rows=need + 150) if split else bars
    ours = features.apply_features(frame, chosen).toPandas()
    theirs = pd.concat(expected_features(g) for _, g in walk.groupby("symbol"))
    assert len(ours) == len(walk)
    both = theirs.merge(ours, on=["symbol", "datetime"], suffixes=("_p", ""))
    assert len(both) == len(walk)
    for name in theirs.columns.drop(["symbol", "datetime"]):
        np.testing.assert_allclose(
            both[name].astype(float), both[f"{name}_p"].astype(float), rtol=1e-8, atol=1e-7, err_msg=name
        )


@pytest.mark.parametrize("spans", [(1, 2), (2, 200), (50,)])
def test_ema_spans(spark, bars, walk, spans):
    wanted = {f"e{n}": ("close", n) for n in spans}
    ours = with_ema(bars, wanted).toPandas().sort_values(["symbol", "datetime"])
    for n in spans:
        theirs = walk.groupby("symbol")["close"].transform(lambda c: c.ewm(span=n, adjust=False).mean())
        np.testing.assert_allclose(ours[f"e{n}"], theirs, rtol=1e-9)
    assert memory(200) > memory(26) > memory(2)


def test_split_keeps_rows_once(bars):
    cut = split_long(bars, 40, span_rows=100)
    sizes = cut.groupBy("symbol", "_span").count().toPandas()
    assert sizes["count"].max() <= 140
    assert own_rows(cut).count() == bars.count()


@pytest.mark.parametrize("fn", [analytics.summary, analytics.drawdown, analytics.volatility])
def test_risk_is_the_same_on_split_series(bars, fn):
    plain = fn(bars).toPandas().sort_values("symbol").reset_index(drop=True)
    cut = split_long(bars, analytics.RISK_LOOKBACK, span_rows=70)
    split = fn(cut).toPandas().sort_values("symbol").reset_index(drop=True)
    pd.testing.assert_frame_equal(plain, split, rtol=1e-10)


def test_drawdown_is_never_positive(bars):
    assert analytics.drawdown_rows(bars).where("drawdown > 0").count() == 0


def test_periodic_returns_keep_empty_periods(spark):
    pdf = frames.random_bars(symbols=2, days=400, skip=0.93)
    bars = frames.to_spark(spark, pdf)
    for rule, fn, name in (("W", analytics.weekly_returns, "weekly_return"), ("ME", analytics.monthly_returns, "monthly_return")):
        ours = fn(bars).toPandas()
        for symbol, g in pdf.groupby("symbol"):
            close = g.resample(rule, on="datetime")["close"].last()
            theirs = close.ffill().pct_change().to_numpy()
            mine = ours[ours.symbol == symbol].sort_values("period_end")
            assert len(mine) == len(close)
            np.testing.assert_allclose(mine["close"].to_numpy(dtype=float), close.to_numpy())
            np.testing.assert_allclose(mine[name].to_numpy(dtype=float), theirs, atol=1e-12)


def test_correlation_matches_pandas(bars, walk):
    ours = correlation(bars).toPandas()
    wide = pd.DataFrame(
        {s: g.set_index("datetime")["close"].pct_change() for s, g in walk.groupby("symbol")}
    )
    theirs = wide.corr()
    for r in ours.itertuples():
        assert r.correlation == pytest.approx(theirs.loc[r.symbol_a, r.symbol_b], abs=1e-9)
    assert len(ours) == 6


@pytest.mark.parametrize("kind", ["walk", "copies", "signs", "single"])
def test_exact_quantiles(spark, kind):
    rng = np.random.default_rng(3)
    values = {
        "walk": rng.normal(1e4, 50, 501),
        "copies": rng.integers(0, 4, 1000).astype(float),
        "signs": np.concatenate([rng.normal(0, 1e-3, 300), [0.0, 0.0, -1e9, 1e9]]),
        "single": np.array([4.5]),
    }[kind]
    frame = spark.createDataFrame(pd.DataFrame({"symbol": "A", "x": values}))
    wanted = {"a": 0.25, "b": 0.5, "c": 0.75, "d": 0.0, "e": 1.0}
    row = exact_quantiles(value_counts(frame, ["symbol"], ["x"]), ["symbol"], wanted).collect()[0]
    for name, q in wanted.items():
        assert row[name] == pytest.approx(np.quantile(values, q), rel=1e-12)


def test_quantiles_of_crowded_bins(spark):
    """Two symbols in one frame: thousands of prices within a percent, and half of them within
    a millionth; bins are cut until none has more than 20 distinct values."""
    rng = np.random.default_rng(5)
    values = {
        "even": 100 + rng.random(6000),
        "clustered": np.concatenate([50 + rng.random(1500) * 1e-6, 50 + rng.random(1500) * 0.5, np.full(99, 50.25)]),
        "few": np.array([-3.0, 0.0, 0.0, 7.0]),
    }
    frame = pd.concat([pd.DataFrame({"symbol": s, "x": v}) for s, v in values.items()])
    counts = value_counts(spark.createDataFrame(frame), ["symbol"], ["x"])
    wanted = {"a": 0.25, "b": 0.5, "c": 0.755, "d": 0.0, "e": 1.0}
    rows = {r.symbol: r for r in exact_quantiles(counts, ["symbol"], wanted, most=20).collect()}
    for symbol, v in values.items():
        for name, q in wanted.items():
            assert rows[symbol][name] == pytest.approx(np.quantile(v, q), rel=1e-12), (symbol, name)
    none = exact_quantiles(counts.where("n < 0"), ["symbol"], wanted, most=20)
    assert none.count() == 0 and none.columns == ["symbol", *wanted]


def test_volume_stats_of_repeated_and_missing_volumes(spark):
    volumes = {"A": [5, 5, 5, 0, None, 9], "B": [None, None], "C": [7]}
    rows = [(s, v) for s, vs in volumes.items() for v in vs]
    stats = analytics.volume_stats(spark.createDataFrame(rows, "symbol string, volume long")).collect()
    got = {r.symbol: tuple(r)[1:] for r in stats}
    assert got == {"A": (4, 3, 5, 9, 0, 1), "B": (None, None, None, None, None, 0), "C": (7, None, 7, 7, 7, 0)}


def test_corrected_layer_properties(spark, bars, walk):
    fixed = corrections.corrected_layer(bars).toPandas()
    keys = set(zip(fixed.symbol, fixed.date))
    assert set(zip(walk.symbol, walk.date)) <= keys
    assert len(keys) == len(fixed)
    for _, g in fixed.sort_values("date").groupby("symbol"):
        runs = g["is_filled"].groupby((~g["is_filled"]).cumsum()).sum()
        assert runs.max() <= corrections.MAX_FILL
        assert list(g["ingest_seq"]) == list(range(1, len(g) + 1))


def test_interpolation_matches_pandas(spark):
    pdf = frames.random_bars(symbols=2, days=300, skip=0.4)
    rng = np.random.default_rng(5)
    pdf.loc[rng.random(len(pdf)) < 0.3, "adj_close"] = np.nan
    pdf.loc[[0, 1], "adj_close"] = np.nan
    pdf.loc[pdf.index[-4:], "adj_close"] = np.nan
    # NaN stands for a missing value only in pandas.
    bars = frames.to_spark(spark, pdf.astype({"adj_close": object}).where(pdf.notna(), None))
    ours = corrections.fill_short_runs(bars).toPandas()
    for symbol, g in pdf.groupby("symbol"):
        g = g.set_index("datetime")
        every = pd.date_range(g.index.min(), g.index.max(), freq="D")
        missing = every.difference(g.index).to_series()
        run = (missing.diff() != pd.Timedelta(days=1)).cumsum()
        short = missing[missing.groupby(run).transform("size") <= 2].index
        full = g.reindex(g.index.union(short))
        mine = ours[ours.symbol == symbol].sort_values("datetime")
        assert len(mine) == len(full)
        for c in ("open", "close", "adj_close"):
            theirs = full[c].astype(float).interpolate(method="linear", limit=2)
            np.testing.assert_allclose(mine[c].to_numpy(dtype=float), theirs.to_numpy(), rtol=1e-12)


def test_weekday_calendar_leaves_weekends_out(spark):
    import datetime as dt

    days = ["2025-01-09", "2025-01-14", "2025-01-16", "2025-01-23"]
    bars = frames.bars(spark, [{"date": dt.date.fromisoformat(d)} for d in days])
    filled = corrections.fill_short_runs(bars, calendar="weekdays").where("is_filled").collect()
    assert sorted(str(r.date) for r in filled) == ["2025-01-10", "2025-01-13", "2025-01-15"]
    runs = corrections.missing_runs(bars, calendar="weekdays").collect()
    assert sorted((str(r.run_start), r.run_days) for r in runs) == [
        ("2025-01-10", 2),
        ("2025-01-15", 1),
        ("2025-01-17", 4),
    ]


def test_averages_sort_twice(bars):
    rows = features.apply_features(bars, [features.ema()])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 2
