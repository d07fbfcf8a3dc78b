"""Validation goldens, and rules that must not depend on how series are cut."""

import datetime as dt

import frames
import pytest

from candleworks.operators import rules


def of_stage(*stages):
    return [r for r in rules.DATA_RULES if rules.CATALOGUE[r].stage in stages]


def found(bars, stages):
    rows = rules.issues(bars, of_stage(*stages)).collect()
    return sorted((r.rule_id, r.field or "", r.affected, r.severity) for r in rows)


C, W, I = "CRITICAL", "WARNING", "INFO"

FINANCIAL = {
    "valid": ({}, []),
    "negative": (
        {"open": {1: -50.0}, "close": {2: 0.0}},
        [
            ("vr_low_gt_close", "", 1, W),
            ("vr_low_gt_open", "", 1, W),
            ("vr_price_nonpositive", "close", 1, C),
            ("vr_price_nonpositive", "open", 1, C),
        ],
    ),
    "volume": (
        {"volume": {1: 0, 2: -100}},
        [("vr_volume_negative", "volume", 1, C), ("vr_volume_zero_rows", "volume", 1, W)],
    ),
    "ohlc": (
        {"low": {1: 110.0, 2: 105.0}, "high": {3: 95.0}},
        [
            ("vr_high_lt_close", "", 1, W),
            ("vr_high_lt_open", "", 1, W),
            ("vr_low_gt_close", "", 2, W),
            ("vr_low_gt_high", "", 2, C),
            ("vr_low_gt_open", "", 2, W),
        ],
    ),
    "identical": (
        {c: {1: 100.0} for c in ("open", "high", "low", "close")},
        [("vr_ohlc_identical", "", 1, W)],
    ),
    "tolerance": ({"low": {1: 100.005}, "open": {1: 100.0}}, []),
}


@pytest.mark.parametrize("case", FINANCIAL)
def test_financial_stage(spark, case):
    changes, expected = FINANCIAL[case]
    assert found(frames.bars(spark, frames.base_rows(**changes)), [2]) == expected


TEMPORAL = {
    "normal": ("01-06 01-07 01-08 01-09 01-10 01-13 01-14", [], (1, 0, 5)),
    "duplicate": (
        "01-06 01-07 01-07 01-08 01-08",
        [("vr_date_duplicate", 2, 2.0), ("vr_sparse_series", 2, 50.0)],
        (0, 0, 2),
    ),
    "unordered": (
        "01-06 01-08 01-07 01-10 01-09",
        [("vr_date_order", 2, None), ("vr_sparse_series", 0, 0.0)],
        (2, 0, 0),
    ),
    "long gaps": (
        "01-06 01-07 01-20 01-21 02-10",
        [("vr_gap_suspicious", 2, 20.0), ("vr_sparse_series", 2, 50.0)],
        (0, 0, 2),
    ),
    "weekend": ("01-06 01-07 01-11 01-12 01-13", [("vr_weekend_trading", 2, None)], (0, 1, 3)),
    "sparse": (
        "01-01 01-05 01-10 01-15 01-20",
        [("vr_sparse_series", 0, 0.0), ("vr_weekend_trading", 1, None)],
        (0, 4, 0),
    ),
}


@pytest.mark.parametrize("block", [2, 65_536])
@pytest.mark.parametrize("case", TEMPORAL)
def test_temporal_stage(spark, monkeypatch, case, block):
    monkeypatch.setattr(rules, "SEQ_BLOCK", block)
    days, expected, stats = TEMPORAL[case]
    rows = [{"date": dt.date.fromisoformat(f"2025-{d}")} for d in days.split()]
    issues = rules.issues(frames.bars(spark, rows), of_stage(3)).collect()
    last = [r for r in issues if r.rule_id == "vr_temporal_stats"]
    assert [(r.metric, r.metric_2, r.affected) for r in last] == [stats]
    rest = sorted((r.rule_id, r.affected, r.metric) for r in issues if r not in last)
    assert rest == expected


def test_basic_stage(spark):
    short = frames.bars(spark, frames.base_rows(close={0: None}, adj_close={1: None})[:2])
    assert found(short, [1]) == [
        ("vr_min_rows", "", 2, C),
        ("vr_null_critical", "close", 1, C),
        ("vr_null_optional", "adj_close", 1, W),
    ]
    assert found(frames.bars(spark, frames.base_rows()), [1]) == []


def test_field_rules(spark):
    raw = spark.createDataFrame(
        [
            ("A", {"open": "x", "close": "1", "volume": "10"}),
            ("A", {"open": "2", "close": "1", "volume": "1.5"}),
            ("B", {c: "1" for c in rules.BAR_COLUMNS}),
        ],
        "symbol string, fields map<string,string>",
    )
    rows = {(r.symbol, r.rule_id): r for r in rules.field_issues(raw).collect()}
    assert set(rows) == {
        ("A", "vr_missing_columns"),
        ("A", "vr_non_numeric"),
        ("A", "vr_volume_type"),
    }
    assert rows["A", "vr_missing_columns"].affected == 8
    assert rows["A", "vr_volume_type"].severity == W


def test_empty_symbols(spark):
    asked = spark.createDataFrame([("TEST",), ("NONE",)], "symbol string")
    rows = rules.empty_issues(asked, frames.bars(spark, frames.base_rows())).collect()
    assert [(r.symbol, r.severity) for r in rows] == [("NONE", C)]


@pytest.mark.parametrize("share, severity", [(1, W), (2, C)])
def test_zero_volume_share(spark, share, severity):
    rows = [{"volume": 0 if i < share else 5} for i in range(11)]
    issues = rules.issues(frames.bars(spark, rows), ["vr_volume_zero_share"]).collect()
    assert [(r.affected, r.severity) for r in issues] == [(share, severity)]


def test_variation_counts_copies_and_year_borders(spark, monkeypatch):
    """Steps between copies, across blocks and across years are all counted."""
    monkeypatch.setattr(rules, "SEQ_BLOCK", 2)
    day = dt.date(2024, 12, 30)
    closes = [
        (day, 100.0),
        (day, 150.0),
        (day, None),
        (day, 151.0),
        (day + dt.timedelta(1), 152.0),
        (dt.date(2025, 1, 2), None),
        (dt.date(2025, 1, 3), 300.0),
        (dt.date(2025, 1, 4), 0.0),
        (dt.date(2025, 1, 5), 5.0),
    ]
    rows = [{"date": d, "close": c} for d, c in closes]
    issues = rules.issues(
        frames.bars(spark, rows), ["vr_extreme_variation", "vr_date_duplicate"]
    ).collect()
    by_rule = {r.rule_id: r for r in issues}
    # 100 -> 150, 152 -> 300, 300 -> 0 and 0 -> 5.
    assert by_rule["vr_extreme_variation"].affected == 4
    assert by_rule["vr_extreme_variation"].metric == float("inf")
    assert (by_rule["vr_date_duplicate"].affected, by_rule["vr_date_duplicate"].metric) == (3, 1.0)


@pytest.mark.parametrize("block", [3, 65_536])
def test_violations(spark, monkeypatch, block):
    monkeypatch.setattr(rules, "SEQ_BLOCK", block)
    days = "01-06 01-07 01-20 01-19 01-19 01-22"
    rows = [{"date": dt.date.fromisoformat(f"2025-{d}")} for d in days.split()]
    rows[0]["low"] = -1.0
    hits = {(r.ingest_seq, r.rule_id) for r in rules.violations(frames.bars(spark, rows)).collect()}
    assert hits == {
        (0, "vr_price_nonpositive"),
        (2, "vr_gap_suspicious"),
        (3, "vr_date_order"),
        (3, "vr_weekend_trading"),
        (4, "vr_weekend_trading"),
        (4, "vr_date_duplicate"),
    }


def test_summary_and_gate(spark):
    good = frames.bars(spark, frames.base_rows())
    bad = frames.bars(spark, frames.base_rows(open={0: -1.0})).withColumn("symbol", rules.F.lit("BAD"))
    bars = good.unionByName(bad)
    issues = rules.issues(bars)
    valid = {r.symbol: r.is_valid for r in rules.summary(bars, issues).collect()}
    assert valid == {"TEST": True, "BAD": False}
    assert {r.symbol for r in rules.accepted(bars, issues).collect()} == {"TEST"}
    assert [r.reasons for r in rules.rejects(issues).collect()] == ["vr_price_nonpositive"]


def test_validate_skips_data_rules_of_unreadable_symbols(spark):
    asked = spark.createDataFrame([("TEST",), ("BAD",), ("NONE",)], "symbol string")
    bad = frames.bars(spark, frames.base_rows(low={0: -1.0}))
    bars = bad.unionByName(bad.withColumn("symbol", rules.F.lit("BAD")))
    fields = {c: "1" for c in rules.BAR_COLUMNS}
    raw = spark.createDataFrame(
        [("TEST", fields), ("BAD", {**fields, "open": "x"})],
        "symbol string, fields map<string,string>",
    )
    rows = rules.validate(asked, bars, raw).where("severity = 'CRITICAL'").collect()
    assert sorted((r.symbol, r.rule_id) for r in rows) == [
        ("BAD", "vr_non_numeric"),
        ("NONE", "vr_empty"),
        ("TEST", "vr_price_nonpositive"),
    ]


def test_unknown_rule(spark):
    with pytest.raises(ValueError):
        rules.issues(frames.bars(spark, []), ["vr_other"])
