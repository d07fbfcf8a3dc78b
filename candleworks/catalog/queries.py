"""One registered query per operator: name -> f(spark, sf_dir) -> DataFrame.

All of them run over the whole given tables, or over bars that Spark derives from
them. Results are projected to plain columns (dates instead of midnight timestamps),
and sums of doubles are rounded where engines add in different orders.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleworks.catalog import fixtures as fx
from candleworks.operators import analytics as an
from candleworks.operators import corrections as fix
from candleworks.operators import features as ft
from candleworks.operators import forecast as fc
from candleworks.operators import growth
from candleworks.operators import holidays as hd
from candleworks.operators import metrics as fm
from candleworks.operators import projections as proj
from candleworks.operators import quality as dq
from candleworks.operators import relational as rel
from candleworks.operators import rules
from candleworks.operators.correlation import correlation
from candleworks.plans import daily, reports
from candleworks.schema import BAR_COLUMNS, CORRECTED, ORIGINAL, SEQ, SYMBOL
from candleworks.session import fresh_folder, staged
from candleworks.sources import payloads, store, universe
from candleworks.streaming import bars as streams
from candleworks.streaming.order import OrderRules

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

_BARS = [c for c in BAR_COLUMNS if c != "datetime"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _plain(frame: DataFrame, digits: dict[str, int] | None = None) -> DataFrame:
    """datetime as date, the named doubles rounded."""
    columns = {c: F.round(c, d) for c, d in (digits or {}).items()}
    if "datetime" in frame.columns:
        dated = F.col("datetime").cast("date")
        if "date" not in frame.columns:
            columns["date"] = dated
        frame = frame.withColumns(columns).drop("datetime")
        return frame
    return frame.withColumns(columns) if columns else frame


# --- sources ---------------------------------------------------------------


def _daily_documents(spark, sf_dir, name="Time Series (Daily)"):
    return payloads.render_series(fx.bars_by_brand(spark, sf_dir), F.year("date"), name)


@query
def src_timeseries_json(spark, sf_dir):
    return payloads.timeseries_bars(_daily_documents(spark, sf_dir)).select(*_BARS)


@query
def src_timeseries_json_generic(spark, sf_dir):
    rows = payloads.timeseries_generic(_daily_documents(spark, sf_dir))
    return rows.drop("datetime")


@query
def src_values_json(spark, sf_dir):
    landed = payloads.render_values(fx.bars_by_brand(spark, sf_dir), F.year("date"))
    return payloads.values_bars(landed).select(*_BARS)


@query
def src_interval_json(spark, sf_dir):
    """Daily and weekly documents landed together; the weekly ones are read."""
    weekly = payloads.render_series(
        fx.weekly_bars(spark, sf_dir), F.year("date"), "Weekly Time Series"
    ).withColumn("interval", F.lit("1wk"))
    every_day = _daily_documents(spark, sf_dir).withColumn("interval", F.lit("1d"))
    return payloads.interval_bars(weekly.unionByName(every_day), "1wk").select(*_BARS)


@query
def src_quote_json(spark, sf_dir):
    latest = proj.latest_price(fx.bars_by_brand(spark, sf_dir))
    return payloads.quotes(payloads.render_quotes(latest))


@query
def src_payload_errors(spark, sf_dir):
    """Documents of every fourth brand are replaced by refusals."""
    number = fx.brand_number()
    refusal = (
        F.when(number % 4 == 0, F.lit('{"Error Message": "Invalid API call"}'))
        .when(number % 4 == 1, F.lit('{"Information": "Our standard call frequency is 5 per minute"}'))
        .when(number % 8 == 2, F.lit('{"Meta Data": {}}'))
        .when(number % 8 == 3, F.lit('{"status": "error", "message": "symbol not found", "values": []}'))
    )
    landed = _daily_documents(spark, sf_dir).withColumn("payload", F.coalesce(refusal, "payload"))
    return payloads.payload_errors(landed).groupBy(SYMBOL, "status", "detail").agg(
        F.count("*").alias("documents")
    )


@query
def src_series_variants(spark, sf_dir):
    """Numbered, adjusted and plain field names, repeated ones, empty and broken values."""
    return payloads.timeseries_bars(fx.variant_documents(spark, sf_dir)).select(*_BARS)


@query
def src_point_errors(spark, sf_dir):
    found = payloads.point_errors(fx.variant_documents(spark, sf_dir))
    return found.groupBy(SYMBOL, "detail").agg(F.count("*").alias("points"))


_STORES: dict[tuple[str, str], str] = {}


def _stored(spark: SparkSession, sf_dir: str) -> store.BarStore:
    """A store with both layers of the mixed bars, written once per application and input."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORES:
        target = store.BarStore(spark, fresh_folder(spark, "store"))
        bars = staged(fx.mixed_bars(spark, sf_dir), "bars")
        found = staged(fix.run_issues(bars, staged(rules.issues(bars), "issues")), "run-issues")
        corrected = fix.corrected_layer(rules.accepted(bars, found))
        target.save(bars, corrected, found, csv=True)
        _STORES[key] = target.root
    return store.BarStore(spark, _STORES[key])


@query
def src_parquet_snapshot(spark, sf_dir):
    target = _stored(spark, sf_dir)
    rows = target.snapshots(CORRECTED)
    return rows.select(*_BARS, "is_filled", "as_of_year", "as_of_month")


@query
def src_snapshot_read(spark, sf_dir):
    """One snapshot of one symbol: the folders prune by month, the row groups by symbol."""
    target = _stored(spark, sf_dir)
    first = target.metadata().orderBy(SYMBOL).select(SYMBOL, *store.AS_OF).first()
    return target.read(*first).select(*_BARS, "is_filled", *store.AS_OF)


@query
def src_metadata(spark, sf_dir):
    return _stored(spark, sf_dir).metadata().drop(
        "compression", "last_updated", "run_id", "has_corrections"
    )


@query
def src_list_symbols(spark, sf_dir):
    return store.list_symbols(_stored(spark, sf_dir).snapshots())


@query
def src_list_periods(spark, sf_dir):
    return store.list_periods(fx.year_snapshots(spark, sf_dir))


@query
def src_universe(spark, sf_dir):
    """Core symbols (brands 1 to 5) and all symbols concatenated; repeats stay."""
    every = fx.symbols(spark, sf_dir)
    return universe.union_universe(every.where(fx.brand_number() <= 5), every)


# --- sinks -----------------------------------------------------------------


@query
def sink_parquet_layers(spark, sf_dir):
    """What the two layers of the bars table hold after a save."""
    target = _stored(spark, sf_dir)
    both = target.bars(ORIGINAL).unionByName(target.bars(CORRECTED))
    return both.groupBy("layer", SYMBOL, "year").agg(
        F.count("*").alias("n_rows"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.sum("volume").alias("volume"),
    )


@query
def sink_dataset_upsert(spark, sf_dir):
    """Two saves of overlapping rows; the second one wins and leaves a backup."""
    bars = fx.bars_by_brand(spark, sf_dir).withColumn("is_filled", F.lit(False))
    months = {"year": F.year("date"), "month": F.month("date")}
    target = store.BarStore(spark, fresh_folder(spark, "upsert"))
    first = bars.where(F.col(SEQ) % 3 != 0)
    second = bars.where(F.col(SEQ) % 2 == 0).withColumn("close", F.col("close") * 2)
    for rows in (first, second):
        target.upsert(rows.withColumns(months), ORIGINAL, "bars", store.OWN_MONTH)
    return target.bars(ORIGINAL).select(SYMBOL, "date", "open", "close", "volume")


@query
def sink_csv(spark, sf_dir):
    target = fresh_folder(spark, "csv")
    store.write_csv(fx.bars_by_brand(spark, sf_dir).drop(SEQ), target)
    schema = fx.bars_by_brand(spark, sf_dir).drop(SEQ).schema
    return spark.read.schema(schema).option("header", True).csv(target).select(*_BARS)


def _second_saves(spark, sf_dir) -> store.BarStore:
    """A store after two saves of overlapping rows and a third in a later month.

    Both of the first two deliver each symbol's last bar before 2001, so they meet in one
    snapshot; the third delivers everything from 2000 on. Written once per application
    and input; the issues are those of the whole history.
    """
    key = (spark.sparkContext.applicationId, f"{sf_dir} again")
    if key not in _STORES:
        target = store.BarStore(spark, fresh_folder(spark, "second-saves"))
        bars = staged(fx.bars_by_brand(spark, sf_dir), "bars")
        found = staged(rules.issues(bars), "issues")
        early = bars.where(F.year("date") <= 2000)
        last = early.groupBy(SYMBOL).agg(F.max("date").alias("date")).withColumn("_last", F.lit(True))
        early = early.join(last, [SYMBOL, "date"], "left")
        always = F.col("_last").isNotNull()
        first = early.where(always | (F.col(SEQ) % 3 != 0)).drop("_last")
        second = early.where(always | (F.col(SEQ) % 2 == 0)).drop("_last").withColumn("close", F.col("high"))
        for rows in (first, second, bars.where(F.year("date") >= 2000)):
            target.save(rows, fix.corrected_layer(rules.accepted(rows, found)), found, csv=True)
        _STORES[key] = target.root
    return store.BarStore(spark, _STORES[key])


@query
def src_metadata_second_save(spark, sf_dir):
    rows = _second_saves(spark, sf_dir).metadata()
    return rows.select(
        SYMBOL, *store.AS_OF, "original_records", "original_duplicates_removed", "start_date", "end_date"
    )


@query
def sink_csv_second_save(spark, sf_dir):
    rows = _second_saves(spark, sf_dir).csv(ORIGINAL)
    return rows.select(SYMBOL, "date", "close", "volume")


@query
def dq_report_two_snapshots(spark, sf_dir):
    """Quality of both snapshots of a symbol, each from its own rows."""
    target = _second_saves(spark, sf_dir)
    report = dq.report(target.snapshots(), target.metadata())
    return report.select(
        SYMBOL,
        *store.AS_OF,
        "period",
        "completeness.original_records",
        "date_range.total_days",
        "data_integrity.has_duplicates",
        "data_integrity.is_sorted",
    )


@query
def pipe_report_latest(spark, sf_dir):
    """Report data of the latest snapshot alone, though the store holds two."""
    target = _second_saves(spark, sf_dir)
    rows = reports.report_dataset(target.snapshots(), target.metadata())
    return rows.select(
        SYMBOL, "quality.period", "comparison.original_records", "comparison.original_total_volume", "financial.end_price"
    )


@query
def sink_backups_on_disk(spark, sf_dir):
    """Six saves of one snapshot leave five backups, of which four stay on disk."""
    target = store.BarStore(spark, fresh_folder(spark, "six-saves"))
    rows = fx.bars_by_brand(spark, sf_dir).withColumn("is_filled", F.lit(False))
    rows = staged(rows.join(proj.snapshot_period(rows), SYMBOL), "bars")
    for _ in range(6):
        target.upsert(rows, ORIGINAL, "snapshots", store.AS_OF, backup=True)
    on_disk = spark.read.parquet(f"{target.root}/backups")
    return on_disk.groupBy(SYMBOL, "layer").agg(
        F.countDistinct("backup_id").alias("backups"), F.count("*").alias("n_rows")
    )


@query
def sink_metadata(spark, sf_dir):
    bars = fx.bars_by_brand(spark, sf_dir)
    verdict = rules.summary(bars, rules.issues(bars))
    return store.run_metadata(bars, fix.corrected_layer(bars), bars, verdict)


@query
def sink_backup_retention(spark, sf_dir):
    """Every year of bars taken as one backup: the newest four per symbol stay."""
    backups = fx.bars_by_brand(spark, sf_dir).withColumns(
        {"layer": F.lit(ORIGINAL), "backup_id": F.year("date").cast("string")}
    )
    kept = store.retained_backups(backups)
    return kept.groupBy(SYMBOL, "layer", "backup_id").agg(F.count("*").alias("n_rows"))


@query
def sink_report_json(spark, sf_dir):
    target = _stored(spark, sf_dir)
    dataset = reports.report_dataset(target.snapshots(), target.metadata())
    text = reports.report_json(dataset)
    number = lambda path: F.get_json_object("report", path)
    return text.select(
        SYMBOL,
        number("$.quality.completeness.original_records").cast("bigint").alias("original_records"),
        number("$.quality.gaps.gaps_filled_by_validation").cast("bigint").alias("gaps_filled"),
        number("$.financial.trading_days").cast("bigint").alias("trading_days"),
        number("$.volume.max_volume").cast("bigint").alias("max_volume"),
        number("$.comparison.added_records").cast("bigint").alias("added_records"),
    )


# --- projections -----------------------------------------------------------


@query
def proj_bars_schema(spark, sf_dir):
    prices = fx.bars_by_brand(spark, sf_dir).select("datetime", SYMBOL, "open", "high", "low", "close", "volume")
    return proj.to_bars_schema(prices).select(*_BARS)


@query
def proj_exchange_from_symbol(spark, sf_dir):
    """Supplier numbers become tickers of eight exchanges or none."""
    suffix = F.array(*[F.lit(x) for x in (".AS", ".L", ".DE", ".PA", ".MI", ".SW", ".ST", "")])
    ticker = F.concat(
        F.lit("S"), F.col("s_suppkey"), F.element_at(suffix, (F.col("s_suppkey") % 8 + 1).cast("int"))
    )
    tickers = fx.table(spark, sf_dir, "supplier").select(ticker.alias(SYMBOL))
    return proj.with_exchange(tickers)


@query
def proj_normalize_types(spark, sf_dir):
    bars = fx.bars_by_brand(spark, sf_dir)
    text = bars.select(*[F.col(c).cast("string").alias(c) for c in BAR_COLUMNS])
    holes = text.withColumn("volume", F.when(F.col("volume") != "10", F.col("volume")))
    return proj.normalize_types(holes).select(*_BARS)


@query
def proj_numeric_coerce(spark, sf_dir):
    raw = fx.raw_fields(spark, sf_dir).select(
        SYMBOL, SEQ, *[F.try_element_at("fields", F.lit(c)).alias(c) for c in ("open", "close", "volume")]
    )
    return proj.coerce_numeric(raw, ["open", "close", "volume"])


@query
def filt_null_prices(spark, sf_dir):
    kept = proj.drop_null_prices(fx.dirty_bars(spark, sf_dir))
    return kept.select(SYMBOL, SEQ, "date", "high")


@query
def proj_compact_100(spark, sf_dir):
    return proj.compact(fx.bars_by_brand(spark, sf_dir), "3mo").select(SYMBOL, "date", "close")


@query
def proj_latest_price(spark, sf_dir):
    return proj.latest_price(fx.bars_by_brand(spark, sf_dir))


@query
def proj_year_month(spark, sf_dir):
    return proj.snapshot_period(fx.bars_by_brand(spark, sf_dir))


# --- joins and sets --------------------------------------------------------


def _wide_names(frame: DataFrame) -> DataFrame:
    return frame.select(
        F.col("datetime").cast("date").alias("date"),
        *[F.col(f"`{c}`").alias(c.replace("#", "_").lower()) for c in frame.columns if c != "datetime"],
    )


@query
def join_compare_symbols(spark, sf_dir):
    return _wide_names(rel.compare_symbols(fx.bars_by_brand(spark, sf_dir)))


@query
def join_returns_align(spark, sf_dir):
    wide = _wide_names(rel.compare_symbols(fx.bars_by_brand(spark, sf_dir), metric="returns"))
    return wide.select("date", *[F.round(c, 8).alias(c) for c in wide.columns if c != "date"])


@query
def join_compare_symbols_long(spark, sf_dir):
    """The same for many symbols: one row per supplier and date instead of columns."""
    return _plain(rel.symbol_values(fx.bars_by_supplier(spark, sf_dir), "close"))


@query
def join_returns_align_long(spark, sf_dir):
    return _plain(rel.symbol_values(fx.bars_by_supplier(spark, sf_dir), "returns"), {"value": 8})


@query
def join_original_corrected(spark, sf_dir):
    return rel.original_corrected(fx.two_layers(spark, sf_dir))


@query
def join_regressors(spark, sf_dir):
    """Orders per day as an external series of every symbol that traded."""
    bars = fx.bars_by_brand(spark, sf_dir)
    orders = (
        fx.table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderdate").cast("date").cast("timestamp_ntz").alias("datetime"))
        .agg(F.count("*").alias("orders"))
    )
    per_symbol = bars.select(SYMBOL, "datetime").join(orders, "datetime")
    joined = rel.with_regressors(bars.select(SYMBOL, "datetime", "close"), per_symbol)
    return _plain(joined)


@query
def join_forecast_actual(spark, sf_dir):
    """Yesterday's close as the forecast, for every day that has a bar."""
    bars = fx.bars_by_brand(spark, sf_dir)
    ahead = bars.select(
        SYMBOL,
        (F.col("datetime") + F.expr("interval 1 day")).alias("datetime"),
        F.col("close").alias("predicted_price"),
    )
    return _plain(rel.forecast_with_actual(ahead, bars))


def _requested(spark, sf_dir):
    """All brands, and the region names as symbols nobody delivers."""
    regions = fx.table(spark, sf_dir, "region").select(F.col("r_name").alias(SYMBOL))
    return fx.symbols(spark, sf_dir).unionByName(regions)


@query
def anti_missing_symbols(spark, sf_dir):
    return rel.missing_symbols(_requested(spark, sf_dir), fx.bars_by_brand(spark, sf_dir))


@query
def set_provider_precedence(spark, sf_dir):
    chosen = rel.first_provider(fx.providers(spark, sf_dir))
    return chosen.select(SYMBOL, "date", "close", "priority")


@query
def set_merge_upsert(spark, sf_dir):
    bars = fx.bars_by_brand(spark, sf_dir)
    old = bars.where(F.col(SEQ) % 3 != 0)
    new = bars.where(F.col(SEQ) % 2 == 0).withColumn("close", F.col("close") * 2)
    return rel.merge_upsert(old, new).select(SYMBOL, "date", "close", "volume")


@query
def set_dedup_keep_last(spark, sf_dir):
    return rel.dedup_keep_last(fx.dirty_bars(spark, sf_dir)).select(SYMBOL, "date", SEQ, "close")


@query
def set_missing_dates(spark, sf_dir):
    return rel.missing_dates(fx.bars_by_brand(spark, sf_dir))


# --- validation ------------------------------------------------------------

# Rules whose issues carry figures besides the count, and the digits to compare.
_RULE_METRICS = {
    "vr_volume_zero_share": {"metric": 6},
    "vr_date_duplicate": {"metric": 0},
    "vr_gap_suspicious": {"metric": 0},
    "vr_sparse_series": {"metric": 6},
    "vr_temporal_stats": {"metric": 0, "metric_2": 0},
    "vr_extreme_variation": {"metric": 6},
    "vr_iqr_outlier": {"metric": 4, "metric_2": 4},
}


def _issue_rows(found: DataFrame, digits: dict[str, int]) -> DataFrame:
    return found.select(
        SYMBOL,
        "rule_id",
        F.coalesce("field", F.lit("")).alias("field"),
        "issue_type",
        "severity",
        "affected",
        *[F.round(c, d).alias(c) for c, d in digits.items()],
    )


def _register_rules() -> None:
    def on_bars(rule: str) -> Query:
        digits = _RULE_METRICS.get(rule, {})
        return lambda spark, sf_dir: _issue_rows(
            rules.issues(fx.dirty_bars(spark, sf_dir), [rule]), digits
        )

    def on_fields(rule: str) -> Query:
        return lambda spark, sf_dir: _issue_rows(
            rules.field_issues(fx.raw_fields(spark, sf_dir), [rule]), {}
        )

    for rule in rules.CATALOGUE:
        if rule in rules.DATA_RULES:
            QUERIES[rule] = on_bars(rule)
        elif rule != "vr_empty":
            QUERIES[rule] = on_fields(rule)


_register_rules()


@query
def vr_min_rows(spark, sf_dir):
    """Bars per brand and year-month series: some months have fewer than five bars."""
    month = F.concat_ws(":", SYMBOL, F.date_format("date", "yyyy-MM"))
    series = fx.bars_by_brand(spark, sf_dir).withColumn(SYMBOL, month)
    return _issue_rows(rules.issues(series, ["vr_min_rows"]), {})


@query
def vr_empty(spark, sf_dir):
    found = rules.empty_issues(_requested(spark, sf_dir), fx.bars_by_brand(spark, sf_dir))
    return _issue_rows(found, {})


@query
def vr_issues(spark, sf_dir):
    return _issue_rows(rules.issues(fx.dirty_bars(spark, sf_dir)), {})


@query
def vr_violations(spark, sf_dir):
    rows = rules.violations(fx.dirty_bars(spark, sf_dir))
    return rows.withColumn("field", F.coalesce("field", F.lit("")))


@query
def vr_summary(spark, sf_dir):
    """Issues of the validation, and of the repair for the symbols that pass."""
    bars = staged(fx.mixed_bars(spark, sf_dir), "bars")
    return rules.summary(bars, fix.run_issues(bars, staged(rules.issues(bars), "issues")))


@query
def vr_gate(spark, sf_dir):
    """Accepted symbols with their rows, rejected ones with their reasons."""
    bars = staged(fx.mixed_bars(spark, sf_dir), "bars")
    found = staged(rules.issues(bars), "issues")
    accepted = rules.accepted(bars, found).groupBy(SYMBOL).agg(F.count("*").alias("n_rows"))
    good = accepted.select(SYMBOL, F.lit(True).alias("accepted"), "n_rows", F.lit("").alias("reasons"))
    bad = rules.rejects(found).select(
        SYMBOL, F.lit(False).alias("accepted"), F.lit(0).cast("bigint").alias("n_rows"), "reasons"
    )
    return good.unionByName(bad)


# --- corrections -----------------------------------------------------------


@query
def fix_dedup_date(spark, sf_dir):
    return fix.dedup_date(fx.dirty_bars(spark, sf_dir)).select(SYMBOL, "date", SEQ)


@query
def fix_sort(spark, sf_dir):
    return fix.sort_flags(fx.mixed_bars(spark, sf_dir))


def _repairs(bars: DataFrame, issue_type: str) -> DataFrame:
    return fix.correction_issues(bars).where(F.col("issue_type") == issue_type)


@query
def fix_dedup_date_issues(spark, sf_dir):
    return _repairs(fx.dirty_bars(spark, sf_dir), "duplicate_dates")


@query
def fix_sort_issues(spark, sf_dir):
    """Every fifth bar of the odd brands comes late: its ingest_seq lies behind all others."""
    late = (fx.brand_number() % 2 == 1) & (F.col(SEQ) % 5 == 0)
    moved = F.when(late, F.col(SEQ) + 10_000_000).otherwise(F.col(SEQ))
    return _repairs(fx.bars_by_brand(spark, sf_dir).withColumn(SEQ, moved), "out_of_order")


@query
def fix_interpolate_issues(spark, sf_dir):
    return _repairs(fx.bars_by_brand(spark, sf_dir), "missing_dates")


@query
def fix_missing_runs(spark, sf_dir):
    return fix.missing_runs(fx.bars_by_brand(spark, sf_dir))


@query
def fix_insert_short_runs(spark, sf_dir):
    rows = fix.insert_short_runs(fx.bars_by_brand(spark, sf_dir))
    return rows.select(SYMBOL, "date", "close", "volume", "currency", "exchange", "is_filled")


@query
def fix_interpolate(spark, sf_dir):
    rows = fix.fill_short_runs(fx.adjusted_gaps(spark, sf_dir))
    return rows.select(SYMBOL, "date", "open", "high", "low", "close", "adj_close", "is_filled", SEQ)


@query
def fix_types(spark, sf_dir):
    """Bars as text, volume 10 missing: repaired types and how many symbols needed it."""
    bars = fx.bars_by_brand(spark, sf_dir)
    text = bars.withColumn("volume", F.when(F.col("volume") != 10, F.col("volume")))
    typed = proj.normalize_types(text)
    changed = fix.correction_issues(text).where(F.col("issue_type") == "wrong_type")
    return (
        typed.groupBy(SYMBOL)
        .agg(F.sum("volume").alias("volume"), F.count_if(F.col("volume") == 0).alias("zeros"))
        .join(changed.select(SYMBOL, "issue_type", "affected"), SYMBOL, "left")
        .select(SYMBOL, "volume", "zeros", F.coalesce("affected", F.lit(0)).alias("columns_changed"))
    )


@query
def fix_corrected_layer(spark, sf_dir):
    """The whole chain on the symbols that pass the gate."""
    bars = fx.mixed_bars(spark, sf_dir)
    found = rules.issues(bars)
    rows = fix.corrected_layer(rules.accepted(bars, found))
    return rows.select(*_BARS, "is_filled", SEQ)


# --- quality ---------------------------------------------------------------


@query
def dq_completeness(spark, sf_dir):
    return dq.completeness(fx.two_layers(spark, sf_dir))


@query
def dq_gap_distribution(spark, sf_dir):
    found = dq.gap_distribution(fx.bars_by_brand(spark, sf_dir))
    text = F.array_join(
        F.array_sort(
            F.transform(
                F.map_entries("gap_distribution"),
                lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
            )
        ),
        ",",
    )
    return found.withColumn("gap_distribution", text)


@query
def dq_gaps_filled(spark, sf_dir):
    return dq.gaps_filled(_stored(spark, sf_dir).metadata())


@query
def dq_forecast_readiness(spark, sf_dir):
    return dq.forecast_readiness(fx.bars_by_brand(spark, sf_dir))


@query
def dq_null_counts(spark, sf_dir):
    return dq.null_counts(fx.dirty_bars(spark, sf_dir))


@query
def dq_duplicate_dates(spark, sf_dir):
    return dq.duplicate_dates(fx.dirty_bars(spark, sf_dir))


@query
def dq_is_sorted(spark, sf_dir):
    return dq.is_sorted(fx.mixed_bars(spark, sf_dir))


@query
def dq_report(spark, sf_dir):
    """The nested report, flattened."""
    target = _stored(spark, sf_dir)
    report = dq.report(target.snapshots(), target.metadata())
    return report.select(
        SYMBOL,
        "period",
        "date_range.total_days",
        "completeness.original_records",
        "completeness.corrected_records",
        "completeness.completeness_original_pct",
        "completeness.completeness_corrected_pct",
        "gaps.total_gaps",
        "gaps.gaps_filled_by_validation",
        "gaps.largest_gap_days",
        F.col("validation_issues.is_valid").alias("is_valid"),
        F.col("data_integrity.has_nulls.close").alias("close_nulls"),
        "data_integrity.has_duplicates",
        "data_integrity.is_sorted",
    )


_LAYER_DIGITS = {f"{x}_{y}_close": 3 for x in (ORIGINAL, CORRECTED) for y in ("mean", "std")}


@query
def dq_orig_vs_corrected(spark, sf_dir):
    return _plain(dq.original_vs_corrected(fx.two_layers(spark, sf_dir)), _LAYER_DIGITS)


# --- analytics -------------------------------------------------------------


@query
def ana_daily_return(spark, sf_dir):
    return _plain(an.daily_returns(fx.bars_by_brand(spark, sf_dir)), {"daily_return": 8})


@query
def ana_weekly_return(spark, sf_dir):
    return _plain(an.weekly_returns(fx.bars_by_brand(spark, sf_dir)), {"weekly_return": 8})


@query
def ana_monthly_return(spark, sf_dir):
    return _plain(an.monthly_returns(fx.bars_by_brand(spark, sf_dir)), {"monthly_return": 8})


_VOLATILITY = {
    "daily_volatility": 6,
    "annualized_volatility_pct": 4,
    "current_rolling_vol": 6,
    "max_rolling_vol": 6,
    "min_rolling_vol": 6,
}


@query
def ana_volatility(spark, sf_dir):
    return _plain(an.volatility(fx.bars_by_brand(spark, sf_dir)), _VOLATILITY)


@query
def ana_rolling_volatility(spark, sf_dir):
    return _plain(an.rolling_volatility(fx.bars_by_brand(spark, sf_dir)), {"rolling_vol": 6})


_DRAWDOWN = {"maximum_drawdown_pct": 6, "current_drawdown_pct": 6}


@query
def ana_drawdown(spark, sf_dir):
    return _plain(an.drawdown(fx.bars_by_brand(spark, sf_dir)), _DRAWDOWN)


@query
def ana_drawdown_days(spark, sf_dir):
    return an.drawdown_days(fx.bars_by_brand(spark, sf_dir))


@query
def ana_summary(spark, sf_dir):
    return _plain(
        an.summary(fx.bars_by_brand(spark, sf_dir)),
        {"total_return_pct": 6, **_VOLATILITY, **_DRAWDOWN},
    )


@query
def ana_summary_by_supplier(spark, sf_dir):
    """The same over many symbols: one per supplier."""
    return _plain(
        an.summary(fx.bars_by_supplier(spark, sf_dir)),
        {"total_return_pct": 6, **_VOLATILITY, **_DRAWDOWN},
    )


@query
def ana_volume_stats(spark, sf_dir):
    return an.volume_stats(fx.bars_by_brand(spark, sf_dir))


@query
def ana_volume_anomaly(spark, sf_dir):
    return _plain(an.volume_anomalies(fx.bars_by_brand(spark, sf_dir)), {"zscore": 6})


@query
def ana_volume_top10_share(spark, sf_dir):
    return _plain(
        an.top_volume_share(fx.bars_by_brand(spark, sf_dir)), {"top_10_days_volume_pct": 6}
    )


@query
def ana_correlation(spark, sf_dir):
    return _plain(correlation(fx.bars_by_brand(spark, sf_dir)), {"correlation": 6})


@query
def ana_compare_periods(spark, sf_dir):
    snapshots = fx.year_snapshots(spark, sf_dir)
    found = None
    for metric in ("return", "volatility", "volume"):
        rows = an.compare_periods(snapshots, metric).withColumn("metric", F.lit(metric))
        found = rows if found is None else found.unionByName(rows)
    return _plain(found, {"value": 4})


# --- features --------------------------------------------------------------

_PRICE = 2
_FEATURES = {
    "ft_sma": (ft.sma(), {f"sma_{n}": 3 for n in ft.SMA_PERIODS}),
    "ft_ema": (ft.ema(), {f"ema_{n}": _PRICE for n in ft.EMA_PERIODS}),
    "ft_rsi": (ft.rsi(), {"rsi": 6}),
    "ft_macd": (ft.macd(), {c: _PRICE for c in ("macd", "macd_signal", "macd_hist")}),
    "ft_roc": (ft.roc(), {"roc": 6}),
    "ft_bollinger": (
        ft.bollinger(),
        {"bb_middle": _PRICE, "bb_upper": _PRICE, "bb_lower": _PRICE, "bb_width": 6},
    ),
    "ft_atr": (ft.atr(), {"atr": _PRICE}),
    "ft_obv": (ft.obv(), {}),
    "ft_vwap": (ft.vwap(), {"vwap": _PRICE}),
    "ft_returns": (ft.returns(), {f"return_{k}d": 6 for k in ft.RETURN_PERIODS}),
    "ft_log_return": (ft.log_return(), {"log_return": 8}),
    "ft_trend_strength": (ft.trend_strength(), {"trend_strength": _PRICE}),
}


def _register_features() -> None:
    def one(feature: ft.Feature, digits: dict[str, int]) -> Query:
        def run(spark, sf_dir):
            rows = ft.apply_features(fx.bars_by_brand(spark, sf_dir), [feature])
            new = [c for c in rows.columns if c not in BAR_COLUMNS and c != SEQ]
            return _plain(rows.select(SYMBOL, "date", *new), digits)

        return run

    for name, (feature, digits) in _FEATURES.items():
        QUERIES[name] = one(feature, digits)


_register_features()


@query
def ft_all(spark, sf_dir):
    rows = ft.add_all_features(fx.bars_by_brand(spark, sf_dir))
    digits = {k: v for _, ds in _FEATURES.values() for k, v in ds.items() if k in rows.columns}
    return _plain(rows.drop("currency", "exchange", SEQ), digits).drop("datetime")


# --- accuracy --------------------------------------------------------------

_METRIC_DIGITS = {"rmse": 4, "mae": 4, "mape": 6, "r2": 6, "directional_accuracy": 6, "smape": 6}
_METRIC_QUERIES = {
    "fm_rmse": "rmse",
    "fm_mae": "mae",
    "fm_mape": "mape",
    "fm_r2": "r2",
    "fm_directional": "directional_accuracy",
    "fm_smape": "smape",
}


def _register_metrics() -> None:
    def one(metric: str) -> Query:
        return lambda spark, sf_dir: _plain(
            fm.evaluate(fx.forecast_pairs(spark, sf_dir), [metric]), {metric: _METRIC_DIGITS[metric]}
        )

    for name, metric in _METRIC_QUERIES.items():
        QUERIES[name] = one(metric)


_register_metrics()


@query
def fm_all(spark, sf_dir):
    return _plain(fm.evaluate(fx.forecast_pairs(spark, sf_dir)), _METRIC_DIGITS)


@query
def fm_compare_models(spark, sf_dir):
    scores = fm.evaluate(fx.forecast_pairs(spark, sf_dir))
    return _plain(fm.compare_models(scores), {"value": 4})


# --- forecast --------------------------------------------------------------

# Held out for fc_evaluate and fc_model_table alone.
_TRAIN_UNTIL = "2000-12-31"


def _split(spark, sf_dir):
    bars = fx.bars_by_brand(spark, sf_dir)
    train = F.col("date") <= F.lit(_TRAIN_UNTIL).cast("date")
    return bars.where(train), bars.where(~train)


def _training(spark, sf_dir):
    return fc.prepare(fx.bars_by_brand(spark, sf_dir))


def _fitted(spark, sf_dir):
    return fc.fit(_training(spark, sf_dir))


@query
def fc_prepare(spark, sf_dir):
    holes = fx.dirty_bars(spark, sf_dir).withColumn("close", F.when(F.col("volume") != 0, F.col("close")))
    return fc.prepare(holes).select(SYMBOL, F.col("ds").cast("date").alias("ds"), "y")


@query
def fc_fit(spark, sf_dir):
    return _fitted(spark, sf_dir).select(
        SYMBOL, "n", "days", "y_scale", "sigma", *[F.round(F.col("coefficients")[i], 6).alias(f"c{i}") for i in range(4)]
    )


@query
def fc_future_frame(spark, sf_dir):
    rows = fc.future_frame(fc.prepare(fx.bars_by_brand(spark, sf_dir)), 30)
    return rows.select(SYMBOL, F.col("ds").cast("date").alias("ds"))


@query
def fc_predict(spark, sf_dir):
    train = _training(spark, sf_dir)
    rows = fc.predict(fc.future_frame(train, 30), fc.fit(train))
    return rows.withColumn("ds", F.col("ds").cast("date")).drop("train_end")


@query
def fc_predictions(spark, sf_dir):
    train = _training(spark, sf_dir)
    return _plain(fc.predictions(fc.predict(fc.future_frame(train, 30), fc.fit(train))))


@query
def fc_evaluate(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    return fc.evaluate(test, fc.fit(fc.prepare(train)))


#: A straight line by ordinary least squares, which SQL can fit as well.
_LINE = fc.Model(changepoints=0, yearly=0, weekly=0, trend_prior=float("inf"), seasonality_prior=float("inf"))


@query
def fc_fit_line(spark, sf_dir):
    fitted = fc.fit(_training(spark, sf_dir), _LINE)
    level = lambda x: F.round(x * F.col("y_scale"), 4)
    return fitted.select(
        SYMBOL,
        "n",
        "days",
        level(F.col("coefficients")[0]).alias("start_level"),
        level(F.col("coefficients")[1]).alias("change"),
        level(F.col("sigma")).alias("deviation"),
    )


@query
def fc_predict_line(spark, sf_dir):
    train = _training(spark, sf_dir)
    rows = fc.predictions(fc.predict(fc.future_frame(train, 30), fc.fit(train, _LINE), _LINE))
    digits = {"predicted_price": 4, "lower_bound": 4, "upper_bound": 4}
    return _plain(rows, digits)


@query
def fc_evaluate_line(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    scores = fc.evaluate(test, fc.fit(fc.prepare(train), _LINE), _LINE)
    return _plain(scores, {k: v for k, v in _METRIC_DIGITS.items() if k in scores.columns}).select(SYMBOL, "rmse", "mae")


#: A line with one bend by ordinary least squares, for SQL too.
_BEND = fc.Model(
    changepoints=1, changepoint_range=0.5, changepoint_prior=float("inf"), yearly=0, weekly=0,
    trend_prior=float("inf"), seasonality_prior=float("inf"),
)


@query
def fc_fit_bend(spark, sf_dir):
    fitted = fc.fit(_training(spark, sf_dir), _BEND)
    level = lambda x: F.round(x * F.col("y_scale"), 4)
    b = F.col("coefficients")
    return fitted.select(
        SYMBOL, level(b[0]).alias("start_level"), level(b[1]).alias("change"), level(b[2]).alias("bend"),
        level(F.col("sigma")).alias("deviation"),
    )


@query
def fc_predict_bend(spark, sf_dir):
    """Intervals that grow with the horizon, by the trend changes that may come."""
    train = _training(spark, sf_dir)
    rows = fc.predictions(fc.predict(fc.future_frame(train, 400), fc.fit(train, _BEND), _BEND))
    return _plain(rows, {"predicted_price": 3, "lower_bound": 3, "upper_bound": 3})


@query
def fc_changepoints_bend(spark, sf_dir):
    rows = fc.changepoints(fc.fit(_training(spark, sf_dir), _BEND), _BEND)
    return _plain(rows.withColumn("delta", F.round("delta", 4)))


#: Logistic growth of the trend alone.
_GROWTH = fc.Model(changepoints=0, yearly=0, weekly=0)


def _growth_rows(spark, sf_dir):
    """Closes under a capacity of 1.3 times the symbol's highest close, above a floor of half its lowest."""
    bars = fx.bars_by_brand(spark, sf_dir)
    ends = bars.groupBy(SYMBOL).agg((F.max("close") * 1.3).alias("cap"), (F.min("close") * 0.5).alias("floor"))
    return growth.prepare(bars.join(ends, SYMBOL), F.col("cap"), F.col("floor"))


def _growth_columns(fitted: DataFrame, coefficients: str) -> list:
    b = F.col(coefficients)
    return [F.round(b[0], 5).alias("level"), F.round(b[1], 5).alias("rate")]


@query
def fc_logistic_step(spark, sf_dir):
    """One Gauss-Newton step of the logistic fit, from the line through the logits."""
    rows, ranges = growth.placed_rows(_growth_rows(spark, sf_dir), _GROWTH)
    state = growth.improved(rows, growth.start(rows, ranges, _GROWTH), _GROWTH)
    return state.select(SYMBOL, "n", *_growth_columns(state, "theta"))


@query
def fc_fit_logistic(spark, sf_dir):
    fitted = growth.fit(_growth_rows(spark, sf_dir), _GROWTH)
    deviation = F.round(F.col("sigma") * F.col("y_scale"), 4).alias("deviation")
    return fitted.select(SYMBOL, "n", *_growth_columns(fitted, "coefficients"), deviation, "converged")


@query
def fc_predict_logistic(spark, sf_dir):
    train = _growth_rows(spark, sf_dir)
    ends = train.select(SYMBOL, "cap", "floor").distinct()
    ahead = fc.future_frame(train, 30, include_history=False).join(ends, SYMBOL)
    rows = fc.predictions(growth.predict(ahead, growth.fit(train, _GROWTH), _GROWTH))
    return _plain(rows, {"predicted_price": 3, "lower_bound": 3, "upper_bound": 3})


@query
def fc_changepoints(spark, sf_dir):
    return _plain(fc.changepoints(_fitted(spark, sf_dir)))


@query
def fc_model_table(spark, sf_dir):
    """Fitted models written to a table and used after reading them back."""
    path = fresh_folder(spark, "models")
    train, test = _split(spark, sf_dir)
    fc.save_models(fc.fit(fc.prepare(train)), path)
    return fc.evaluate(test, fc.load_models(spark, path))


@query
def fc_holidays(spark, sf_dir):
    rows = fc.with_holidays(fx.bars_by_brand(spark, sf_dir), "US")
    return rows.select(SYMBOL, "date", *fc.holiday_columns("US"))


@query
def fc_holiday_table(spark, sf_dir):
    """All US federal holidays as columns, movable ones too: rows that have one."""
    bars = fx.bars_by_brand(spark, sf_dir).select(SYMBOL, "date")
    names = fc.us_holiday_names()
    rows = fc.with_holiday_table(bars, fc.us_holidays(bars), names)
    kept = F.array_compact(F.array(*[F.when(F.col(f"`{n}`") == 1, F.lit(n)) for n in names]))
    return rows.select(SYMBOL, "date", F.explode(kept).alias("holiday"))


@query
def fc_country_holidays(spark, sf_dir):
    """Bars on a public holiday of any country that has rules, movable and observed days too."""
    days = fx.bars_by_brand(spark, sf_dir).select(SYMBOL, "date")
    pairs = [F.struct(F.lit(c).alias("country"), hd.of(c, F.col("date")).alias("names")) for c in sorted(hd.RULES)]
    rows = days.select(SYMBOL, "date", F.explode(F.array(*pairs)).alias("c"))
    return rows.select(SYMBOL, "date", "c.country", F.explode("c.names").alias("holiday"))


@query
def fc_fit_with_holidays(spark, sf_dir):
    """The fit with holiday columns as regressors."""
    names = fc.holiday_columns("US")
    train = fc.with_holidays(fx.bars_by_brand(spark, sf_dir), "US")
    fitted = fc.fit(fc.prepare(train, names), fc.Model(regressors=tuple(names)))
    return fitted.select(SYMBOL, "n", "sigma", F.size("coefficients").alias("n_coefficients"))


# --- runs ------------------------------------------------------------------


@query
def pipe_daily(spark, sf_dir):
    """A dry run over all requested symbols."""
    delivered = fx.mixed_bars(spark, sf_dir).withColumn("priority", F.lit(1))
    return daily.run_daily(_requested(spark, sf_dir), delivered).status.withColumn(
        "reasons", F.coalesce("reasons", F.lit(""))
    )


@query
def pipe_batch(spark, sf_dir):
    """A run that stores: batch frames first, single-symbol frames for what is missing."""
    bars = fx.bars_by_brand(spark, sf_dir)
    batch = bars.where(fx.brand_number() % 2 == 0).withColumn("priority", F.lit(1))
    single = bars.withColumn("priority", F.lit(2))
    target = store.BarStore(spark, fresh_folder(spark, "batch"))
    result = daily.run_daily(_requested(spark, sf_dir), batch.unionByName(single), target)
    stored = target.bars(CORRECTED).groupBy(SYMBOL).agg(F.count("*").alias("stored"))
    return (
        result.status.join(stored, SYMBOL, "left")
        .select(SYMBOL, "status", "records", F.coalesce("stored", F.lit(0)).alias("stored"))
    )


@query
def pipe_bulk_collect(spark, sf_dir):
    return daily.bulk_status(_requested(spark, sf_dir), fx.bars_by_brand(spark, sf_dir))


@query
def pipe_run_stats(spark, sf_dir):
    delivered = fx.mixed_bars(spark, sf_dir).withColumn("priority", F.lit(1))
    return daily.run_statistics(
        daily.run_daily(_requested(spark, sf_dir), delivered).status
    )


@query
def pipe_report_dataset(spark, sf_dir):
    target = _stored(spark, sf_dir)
    rows = reports.report_dataset(target.snapshots(), target.metadata())
    return rows.select(
        SYMBOL,
        "quality.period",
        "quality.completeness.corrected_records",
        "financial.start_price",
        "financial.end_price",
        "volume.median_volume",
        "volume.anomalous_volume_days",
        "comparison.original_total_volume",
    )


# --- streams ---------------------------------------------------------------


def _drained(stream: DataFrame, target: str, checkpoint: str, mode: str = "append") -> None:
    started = (
        stream.writeStream.outputMode(mode)
        .format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()


def _landed_stream(spark, sf_dir, label):
    """The dirty bars landed as files and read as a stream, two files at a time."""
    landing = fresh_folder(spark, label)
    fx.dirty_bars(spark, sf_dir).repartition(4, SYMBOL).write.parquet(landing)
    schema = spark.read.parquet(landing).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(landing)


@query
def st_ingest_upsert(spark, sf_dir):
    rows = _landed_stream(spark, sf_dir, "landing")
    target = store.BarStore(spark, fresh_folder(spark, "stream-store"))
    # The files are not in time order, so copies are left to the merge, which keeps no state.
    started = (
        rows.writeStream.foreachBatch(streams.upsert_into(target, ORIGINAL))
        .option("checkpointLocation", fresh_folder(spark, "stream-state"))
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
    return target.bars(ORIGINAL).select(SYMBOL, "date", SEQ, "close", "volume")


@query
def st_ingest_falling_order(spark, sf_dir):
    """The copies of a date come in files of their own, the higher ingest_seq first."""
    landing = fresh_folder(spark, "falling")
    rows = staged(fx.dirty_bars(spark, sf_dir), "bars")
    target = store.BarStore(spark, fresh_folder(spark, "falling-store"))
    late = F.col(SEQ) > 1_000_000
    for part in (rows.where(late), rows.where(~late)):
        part.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(rows.schema).parquet(landing)
        started = (
            stream.writeStream.foreachBatch(streams.upsert_into(target, ORIGINAL))
            .option("checkpointLocation", f"{landing}-state")
            .trigger(availableNow=True)
            .start()
        )
        started.awaitTermination()
    return target.bars(ORIGINAL).select(SYMBOL, "date", SEQ, "close", "volume")


def _run_ingest(rows: DataFrame, target, state: str, ledger) -> None:
    merge = streams.upsert_into(target, ORIGINAL, ledger)
    started = rows.writeStream.foreachBatch(merge).option("checkpointLocation", state).trigger(availableNow=True).start()
    started.awaitTermination()


def _ingest_once(spark, sf_dir):
    """Bars land quarter by quarter with each file sent twice, and then some of it once more;
    the stream's state drops the repeats, and the ledger the batches that are run again."""
    landing = fresh_folder(spark, "once")
    bars = staged(fx.bars_by_brand(spark, sf_dir), "bars")
    target = store.BarStore(spark, fresh_folder(spark, "once-store"))
    ledger = streams.BatchLedger(target, "landing")
    for years in ((0, 1994), (1995, 1996), (1997, 9999)):
        part = bars.where(F.year("date").between(*years))
        for _ in range(2):
            part.write.mode("append").parquet(landing)
        rows = streams.first_copies(spark.readStream.schema(bars.schema).parquet(landing), "4000 days")
        _run_ingest(rows, target, f"{landing}-state", ledger)
    # A restart that has lost its own record of batch 0 delivers it again.
    streams.upsert_into(target, ORIGINAL, ledger)(bars.where(F.year("date") <= 1994).withColumn("close", F.lit(-1.0)), 0)
    return target, ledger


@query
def st_ingest_once(spark, sf_dir):
    target, _ = _ingest_once(spark, sf_dir)
    return target.bars(ORIGINAL).select(SYMBOL, "date", SEQ, "close", "volume")


@query
def st_batch_ledger(spark, sf_dir):
    """Rows that the state let through and dates, over the batches that brought any."""
    _, ledger = _ingest_once(spark, sf_dir)
    return ledger.entries().where("rows > 0").select("rows", "first_date", "last_date")


@query
def st_row_rules(spark, sf_dir):
    flagged = streams.flag_rows(_landed_stream(spark, sf_dir, "landing"))
    rows = flagged.where(F.size("broken") > 0).select(
        SYMBOL, SEQ, "date", F.array_join(F.array_sort("broken"), ",").alias("broken")
    )
    target = fresh_folder(spark, "stream-rules")
    _drained(rows, target, fresh_folder(spark, "stream-state"))
    return spark.read.parquet(target)


@query
def st_order_rules(spark, sf_dir):
    """The order rules with memory: three parts in the order of arrival and then the copies, each
    read by a stream that starts again where the one before it ended."""
    landing = fresh_folder(spark, "ordered")
    bars = staged(fx.dirty_bars(spark, sf_dir), "bars")
    check = OrderRules(spark, f"{landing}-rules", dt.timedelta(days=30))
    copies = F.col(SEQ) > 1_000_000
    parts = [~copies & F.year("date").between(*years) for years in ((0, 1994), (1995, 1996), (1997, 9999))]
    for part in (*parts, copies):
        bars.where(part).write.mode("append").parquet(landing)
        rows = spark.readStream.schema(bars.schema).parquet(landing)
        state = f"{landing}-state"
        rows.writeStream.foreachBatch(check).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return check.found(closed=True).select(SYMBOL, SEQ, F.col("datetime").cast("date").alias("date"), "rule")


@query
def st_ohlc_bars(spark, sf_dir):
    """Hourly bars of the event stream: the windows that the watermark has closed."""
    schema = fx.table(spark, sf_dir, "events").schema
    events = (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )
    target = fresh_folder(spark, "stream-bars")
    _drained(streams.ohlc(fx.ticks(events)), target, fresh_folder(spark, "stream-state"))
    rows = spark.read.parquet(target)
    return rows.withColumn("bar_start", F.date_format("bar_start", "yyyy-MM-dd HH:mm:ss"))


@query
def ohlc_bars(spark, sf_dir):
    """The same hourly bars of the whole table as a batch: every window, the last ones too."""
    rows = streams.ohlc(fx.ticks(fx.table(spark, sf_dir, "events")))
    return rows.withColumn("bar_start", F.date_format("bar_start", "yyyy-MM-dd HH:mm:ss"))
