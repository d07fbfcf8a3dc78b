"""The ledger of merged batches."""

import datetime as dt

import pytest

from candleworks.schema import ORIGINAL
from candleworks.sources import store
from candleworks.streaming import bars as streams

SCHEMA = (
    "datetime timestamp_ntz, date date, symbol string, open double, high double, low double, close double, adj_close double, "
    "volume long, currency string, exchange string, ingest_seq long"
)


def batch(spark, closes, first=0):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=first + i) for i in range(len(closes))]
    rows = [(dt.datetime.combine(d, dt.time()), d, "a", c, c, c, c, c, 1, "USD", "US", first + i) for i, (d, c) in enumerate(zip(days, closes))]
    return spark.createDataFrame(rows, SCHEMA)


def closes(target):
    return [r.close for r in target.bars(ORIGINAL).orderBy("date").collect()]


def test_batches_are_merged_once(spark, tmp_path):
    target = store.BarStore(spark, str(tmp_path))
    ledger = streams.BatchLedger(target, "s")
    merge = streams.upsert_into(target, ORIGINAL, ledger)
    assert ledger.entries().count() == 0 and not ledger.holds(0)
    merge(batch(spark, [1.0, 2.0]), 0)
    merge(batch(spark, [9.0, 9.0]), 0)  # delivered again: not merged
    merge(batch(spark, []), 1)  # brings nothing, and is entered
    merge(batch(spark, [3.0], first=2), 2)
    assert closes(target) == [1.0, 2.0, 3.0]
    assert sorted((r.batch_id, r.rows) for r in ledger.entries().collect()) == [(0, 2), (1, 0), (2, 1)]
    # Another stream has batch ids of its own.
    streams.upsert_into(target, ORIGINAL, streams.BatchLedger(target, "other"))(batch(spark, [4.0], first=3), 0)
    assert closes(target) == [1.0, 2.0, 3.0, 4.0]


def test_crash_between_merge_and_entry(spark, tmp_path, monkeypatch):
    target = store.BarStore(spark, str(tmp_path))
    ledger = streams.BatchLedger(target, "s")
    merge = streams.upsert_into(target, ORIGINAL, ledger)
    with monkeypatch.context() as m:
        m.setattr(streams.BatchLedger, "enter", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            merge(batch(spark, [1.0, 2.0]), 0)
    assert closes(target) == [1.0, 2.0] and not ledger.holds(0)
    merge(batch(spark, [1.0, 2.0]), 0)
    assert closes(target) == [1.0, 2.0] and ledger.holds(0)
