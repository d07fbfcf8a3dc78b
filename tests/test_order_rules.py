"""The order rules along a stream: batches, late rows, restarts, a hot symbol."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from candleworks.operators import rules
from candleworks.streaming import order

SCHEMA = "symbol string, ingest_seq long, datetime timestamp_ntz, close double"
START = dt.datetime(2024, 1, 1)


def rows(spark, *rows):
    """(seq, day or None, close) of symbol a."""
    return spark.createDataFrame([("a", n, None if d is None else START + dt.timedelta(days=d), c) for n, d, c in rows], SCHEMA)


def found(check, closed=False):
    return sorted((r.ingest_seq, r.rule) for r in check.found(closed).collect())


def test_steps_between_batches(spark, tmp_path):
    check = order.OrderRules(spark, str(tmp_path), dt.timedelta(days=5))
    assert found(check) == []
    check(rows(spark, (1, 0, 10.0), (2, 1, 10.0)), 0)
    check(rows(spark), 1)
    check(rows(spark, (3, 10, 20.0), (4, 9, 20.0)), 2)  # a gap to the first batch, then a step back
    assert found(check) == [(3, "vr_gap_suspicious"), (4, "vr_date_order")]
    # The change from 10 to 20 is seen once its rows are due: at day 9, not at the later row 3.
    assert found(check, closed=True) == [(3, "vr_gap_suspicious"), (4, "vr_date_order"), (4, "vr_extreme_variation")]
    check(rows(spark, (5, 16, 20.0)), 3)
    assert (4, "vr_extreme_variation") in found(check)
    check(rows(spark, (6, 8, 99.0)), 4)  # its time is over: late, and no change of price
    assert [f for f in found(check, closed=True) if f[0] == 6] == [(6, "late"), (6, "vr_date_order")]


def test_nulls_and_zero_closes(spark, tmp_path):
    check = order.OrderRules(spark, str(tmp_path), dt.timedelta(0))
    check(rows(spark, (1, None, 1.0), (2, 0, None), (3, 1, 0.0)), 0)
    check(rows(spark, (4, 2, 5.0), (5, 3, None), (6, 4, 5.0)), 1)
    # From zero to anything is extreme; the row without a time comes last, after 5.
    assert found(check, closed=True) == [(1, "vr_extreme_variation"), (4, "vr_extreme_variation")]


def test_batch_again_and_broken_off(spark, tmp_path, monkeypatch):
    check = order.OrderRules(spark, str(tmp_path), dt.timedelta(days=1))
    check(rows(spark, (1, 0, 1.0)), 0)
    write = order.OrderRules._write
    with monkeypatch.context() as m:
        fails = lambda self, frame, table, n: 1 / 0 if table == "clock" else write(self, frame, table, n)
        m.setattr(order.OrderRules, "_write", fails)
        with pytest.raises(ZeroDivisionError):
            check(rows(spark, (2, 20, 1.0)), 1)
    assert found(check) == []  # nothing of a batch that was broken off
    again = order.OrderRules(spark, str(tmp_path), dt.timedelta(days=1))
    for _ in range(2):
        again(rows(spark, (2, 20, 1.0)), 1)
    assert found(again) == [(2, "vr_gap_suspicious")]


def test_equals_the_rules_on_the_whole_table(spark, tmp_path, monkeypatch):
    """Random steps of two symbols, one with nine rows in ten, in blocks of 16 rows."""
    monkeypatch.setattr(order, "SEQ_BLOCK", 16)
    rng, data = random.Random(4), []
    for n in range(400):
        s = "cold" if rng.random() < 0.1 else "hot"
        day = n + rng.choice([-3, 0, 0, 0, 0, 9])
        data.append((s, n, START + dt.timedelta(days=day), rng.choice([None, 0.0, 1.0, 1.1, 1.3, 2.0])))
    check = order.OrderRules(spark, str(tmp_path), dt.timedelta(days=40))
    for k in range(4):
        check(spark.createDataFrame(data[k * 100 : k * 100 + 100], SCHEMA).repartition(3), k)
    ours = {(r.symbol, r.rule): r.n for r in check.found(True).groupBy("symbol", "rule").agg(F.count("*").alias("n")).collect()}
    assert not any(rule == "late" for _, rule in ours)
    bars = spark.createDataFrame(data, SCHEMA)
    for name in ("open", "high", "low", "adj_close"):
        bars = bars.withColumn(name, F.col("close"))
    bars = bars.withColumns({"volume": F.lit(1).cast("long"), "date": F.to_date("datetime")})
    issues = rules.issues(bars, ["vr_date_order", "vr_gap_suspicious", "vr_extreme_variation"]).collect()
    assert ours == {(r.symbol, r.rule_id): r.affected for r in issues}
