"""Registered queries against DuckDB. CANDLEWORKS_ALL=1 runs every one (minutes)."""

import os

import oracle
import pytest

from candleworks.catalog.oracles import SQL
from candleworks.catalog.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

QUICK = (
    "src_timeseries_json src_values_json src_payload_errors sink_csv proj_exchange_from_symbol "
    "proj_compact_100 join_returns_align set_provider_precedence set_merge_upsert "
    "set_missing_dates vr_date_duplicate vr_iqr_outlier vr_issues vr_missing_columns "
    "vr_violations vr_gate fix_interpolate fix_missing_runs dq_gap_distribution "
    "dq_orig_vs_corrected ana_weekly_return ana_monthly_return ana_summary ana_volume_stats "
    "ana_correlation ana_compare_periods ft_all fm_all fm_compare_models pipe_daily st_ohlc_bars"
).split()
CHOSEN = sorted(SQL) if os.environ.get("CANDLEWORKS_ALL") else QUICK


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", CHOSEN)
def test_same_as_sql(spark, duck, name):
    assert oracle.differences(spark, duck, SF_DIR, QUERIES[name], SQL[name]) == []


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_fitted_forecasts_beat_nothing_known(spark):
    scores = QUERIES["fc_evaluate"](spark, SF_DIR).collect()
    assert scores and all(r["rmse"] > 0 for r in scores)
