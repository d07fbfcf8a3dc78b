"""Small bars frames for tests."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd

from candleworks.schema import BARS


def bars(spark, rows):
    """Rows are dicts; what is missing gets the values of a plain valid bar."""
    full = []
    for i, row in enumerate(rows):
        day = row.get("date", dt.date(2025, 1, 1) + dt.timedelta(days=i))
        base = {
            "datetime": dt.datetime.combine(day, dt.time()) if day else None,
            "date": day,
            "symbol": "TEST",
            "open": 100.0,
            "high": 105.0,
            "low": 95.0,
            "close": 102.0,
            "adj_close": 102.0,
            "volume": 1000,
            "currency": "USD",
            "exchange": "US",
            "ingest_seq": i,
        }
        full.append({**base, **row})
    return spark.createDataFrame([tuple(r[f.name] for f in BARS) for r in full], BARS)


def base_rows(**changes):
    """The six-row frame of the validation goldens; changes are {column: {row: value}}."""
    rows = []
    for i in range(6):
        row = {
            "open": 100.0 + i,
            "high": 105.0 + i,
            "low": 95.0 + i,
            "close": 102.0 + i,
            "adj_close": 102.0 + i,
            "volume": 1000 + 100 * i,
        }
        rows.append({**row, **{c: v[i] for c, v in changes.items() if i in v}})
    return rows


def random_bars(symbols=3, days=900, seed=7, skip=0.2):
    """A pandas frame of random walks with missing days."""
    rng = np.random.default_rng(seed)
    frames = []
    for s in range(symbols):
        when = pd.date_range("2015-01-01", periods=days, freq="D")
        when = when[rng.random(days) > skip]
        n = len(when)
        close = np.round(100 * np.exp(np.cumsum(rng.normal(0, 0.03, n))), 2)
        # Flat stretches: no gain and no loss.
        close[50:70] = close[min(50, n - 1)]
        spread = np.abs(rng.normal(0, 1, n)) + 0.05
        frames.append(
            pd.DataFrame(
                {
                    "datetime": when,
                    "date": when.date,
                    "symbol": f"S{s}",
                    "open": close - spread / 2,
                    "high": close + spread,
                    "low": close - spread,
                    "close": close,
                    "adj_close": close,
                    "volume": rng.integers(0, 10_000, n),
                    "currency": "USD",
                    "exchange": "US",
                    "ingest_seq": np.arange(n),
                }
            )
        )
    return pd.concat(frames, ignore_index=True)


def to_spark(spark, pdf):
    return spark.createDataFrame(pdf, BARS)
