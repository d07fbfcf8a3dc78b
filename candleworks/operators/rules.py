"""The rule catalogue and the validation of bars tables.

Raw bars may hold any number of copies and one symbol may hold a large share of
all rows, so no rule sorts a whole symbol. Row rules are plain counts. Rules that
compare neighbours run inside blocks (of ingest order, or of months) and add the
step between a block's last row and the next block's first one afterwards.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candleworks.functions.columns import change, days_between, flag_count, is_weekend, ratio
from candleworks.functions.joins import spread_join
from candleworks.functions.quantiles import exact_quantiles, value_counts
from candleworks.functions.series import before
from candleworks.schema import BAR_COLUMNS, DATETIME, OHLC, PRICES, SEQ, SYMBOL
from candleworks.session import staged

CRITICAL, WARNING, INFO = "CRITICAL", "WARNING", "INFO"

# Thresholds of the rules.
TOLERANCE = 0.01
MIN_ROWS = 5
MAX_VARIATION = 0.20
LONG_GAP_DAYS = 7
MIN_DAILY_SHARE = 0.6
ZERO_VOLUME_SHARE = 0.1
IQR_FACTOR = 1.5

SEQ_BLOCK = 65_536


@dataclass(frozen=True)
class Rule:
    rule_id: str
    issue_type: str
    severity: str
    stage: int


# Rule id, issue type, severity (of the usual case) and stage.
CATALOGUE = {
    r.rule_id: r
    for r in (
        Rule("vr_empty", "missing_data", CRITICAL, 1),
        Rule("vr_missing_columns", "missing_data", CRITICAL, 1),
        Rule("vr_non_numeric", "invalid_type", CRITICAL, 1),
        Rule("vr_volume_type", "invalid_type", WARNING, 1),
        Rule("vr_null_critical", "missing_data", CRITICAL, 1),
        Rule("vr_null_optional", "missing_data", WARNING, 1),
        Rule("vr_min_rows", "missing_data", CRITICAL, 1),
        Rule("vr_price_nonpositive", "negative_price", CRITICAL, 2),
        Rule("vr_volume_negative", "zero_volume", CRITICAL, 2),
        Rule("vr_volume_zero_rows", "zero_volume", WARNING, 2),
        Rule("vr_low_gt_open", "price_inconsistency", WARNING, 2),
        Rule("vr_low_gt_high", "price_inconsistency", CRITICAL, 2),
        Rule("vr_low_gt_close", "price_inconsistency", WARNING, 2),
        Rule("vr_high_lt_open", "price_inconsistency", WARNING, 2),
        Rule("vr_high_lt_close", "price_inconsistency", WARNING, 2),
        Rule("vr_ohlc_identical", "price_inconsistency", WARNING, 2),
        Rule("vr_date_duplicate", "date_duplicate", CRITICAL, 3),
        Rule("vr_date_order", "date_order", WARNING, 3),
        Rule("vr_gap_suspicious", "date_gap", WARNING, 3),
        Rule("vr_weekend_trading", "date_gap", WARNING, 3),
        Rule("vr_sparse_series", "date_gap", INFO, 3),
        Rule("vr_temporal_stats", "date_gap", INFO, 3),
        Rule("vr_extreme_variation", "extreme_variation", WARNING, 4),
        Rule("vr_volume_zero_share", "volume_zero", WARNING, 4),
        Rule("vr_iqr_outlier", "outlier", INFO, 4),
    )
}

ISSUE_COLUMNS = [
    SYMBOL,
    "rule_id",
    "field",
    "issue_type",
    "severity",
    "stage",
    "affected",
    "metric",
    "metric_2",
]

_FIELD_RULES = ("vr_missing_columns", "vr_non_numeric", "vr_volume_type")
_ORDER_RULES = ("vr_date_order", "vr_gap_suspicious", "vr_sparse_series", "vr_temporal_stats")
DATA_RULES = [r for r in CATALOGUE if r != "vr_empty" and r not in _FIELD_RULES]


def row_rules() -> dict[tuple[str, str | None], Column]:
    """(rule id, field) -> condition on one row."""
    low, high, open_, close = (F.col(c) for c in ("low", "high", "open", "close"))
    volume = F.col("volume")
    near = lambda c: F.abs(open_ - c) <= TOLERANCE
    rules = {("vr_null_critical", c): F.col(c).isNull() for c in [*OHLC, DATETIME]}
    rules |= {("vr_null_optional", c): F.col(c).isNull() for c in ("volume", "adj_close")}
    rules |= {("vr_price_nonpositive", c): F.col(c) <= 0 for c in OHLC}
    rules |= {
        ("vr_volume_negative", "volume"): volume < 0,
        ("vr_volume_zero_rows", "volume"): volume == 0,
        ("vr_low_gt_open", None): low > open_ + TOLERANCE,
        ("vr_low_gt_high", None): low > high + TOLERANCE,
        ("vr_low_gt_close", None): low > close + TOLERANCE,
        ("vr_high_lt_open", None): high + TOLERANCE < open_,
        ("vr_high_lt_close", None): high + TOLERANCE < close,
        ("vr_ohlc_identical", None): near(high) & near(low) & near(close),
        ("vr_weekend_trading", None): is_weekend(DATETIME),
    }
    return rules


def catalogue(spark) -> DataFrame:
    return spark.createDataFrame([vars(r) for r in CATALOGUE.values()])


def _issue(
    rule: str,
    affected: Column,
    hit: Column | None = None,
    field: str | Column | None = None,
    metric: Column | None = None,
    metric_2: Column | None = None,
    severity: Column | None = None,
) -> Column:
    """A candidate issue as a struct; ``hit`` says whether it is one."""
    spec = CATALOGUE[rule]
    number = lambda c: (F.lit(None) if c is None else c).cast("double")
    field = field if isinstance(field, Column) else F.lit(field)
    return F.struct(
        (affected > 0 if hit is None else hit).alias("hit"),
        F.lit(rule).alias("rule_id"),
        field.cast("string").alias("field"),
        F.lit(spec.issue_type).alias("issue_type"),
        (F.lit(spec.severity) if severity is None else severity).alias("severity"),
        F.lit(spec.stage).alias("stage"),
        affected.cast("bigint").alias("affected"),
        number(metric).alias("metric"),
        number(metric_2).alias("metric_2"),
    )


def _as_rows(per_symbol: DataFrame, candidates: list[Column]) -> DataFrame:
    return (
        per_symbol.select(SYMBOL, F.inline(F.array(*candidates)))
        .where(F.coalesce("hit", F.lit(False)))
        .select(*ISSUE_COLUMNS)
    )


# --- row rules and the order of rows ---------------------------------------


def _row_candidates(conditions: dict, wanted: Collection[str]) -> list[Column]:
    n, zero = F.col("n"), F.col("zero")
    found = []
    for i, (rule, field) in enumerate(conditions):
        hits = F.col(f"c{i}")
        # Rules of the later stages need two rows.
        hit = hits > 0 if CATALOGUE[rule].stage < 3 else (hits > 0) & (n >= 2)
        found.append(_issue(rule, hits, hit, field))
    if "vr_min_rows" in wanted:
        found.append(_issue("vr_min_rows", n, n < MIN_ROWS))
    if "vr_volume_zero_share" in wanted:
        severity = F.when(zero < n * ZERO_VOLUME_SHARE, WARNING).otherwise(CRITICAL)
        hit = (zero > 0) & (n >= 2)
        share = ratio(zero, n) * 100
        found.append(
            _issue("vr_volume_zero_share", zero, hit, "volume", metric=share, severity=severity)
        )
    return found


def _order_candidates(wanted: Collection[str]) -> list[Column]:
    n, one = F.col("n"), F.col("one")
    share = ratio(one, n - 1)
    found = {
        "vr_date_order": _issue("vr_date_order", F.col("back")),
        "vr_gap_suspicious": _issue("vr_gap_suspicious", F.col("long"), metric=F.col("max_gap")),
        "vr_sparse_series": _issue(
            "vr_sparse_series", one, share < MIN_DAILY_SHARE, metric=share * 100
        ),
        "vr_temporal_stats": _issue(
            "vr_temporal_stats", one, n > 1, metric=F.col("weekend"), metric_2=F.col("holiday")
        ),
    }
    return [issue for rule, issue in found.items() if rule in wanted]


def _steps(now: str, prev: str) -> dict[str, Column]:
    """What the step from one row to the next counts as."""
    days = days_between(prev, now)
    return {
        "back": F.col(now) < F.col(prev),
        "one": days == 1,
        "weekend": days.between(2, 3),
        "holiday": days.between(4, LONG_GAP_DAYS),
        "long": days > LONG_GAP_DAYS,
    }


def _ingest_blocks(bars: DataFrame) -> DataFrame:
    """Rows with the datetime of the row before them in the same ingest block."""
    w = Window.partitionBy(SYMBOL, "_block").orderBy(SEQ)
    return bars.withColumn("_block", F.floor(F.col(SEQ) / SEQ_BLOCK)).withColumn(
        "_prev", F.lag(DATETIME).over(w)
    )


def _block_ends(blocks: DataFrame, *more: Column) -> DataFrame:
    """One row per block with its first and last datetime and the last one before it."""
    in_order = Window.partitionBy(SYMBOL).orderBy("_block")
    return (
        blocks.groupBy(SYMBOL, "_block")
        .agg(
            F.min(SEQ).alias("_first_seq"),
            F.min_by(DATETIME, SEQ).alias("_first"),
            F.max_by(DATETIME, SEQ).alias("_last"),
            *more,
        )
        .withColumn("_before", F.lag("_last").over(in_order))
    )


def _pass_by_ingest(bars: DataFrame, wanted: Collection[str]) -> DataFrame:
    """Row rules, and in the same pass (if asked for) the rules on the order of rows."""
    conditions = {k: v for k, v in row_rules().items() if k[0] in wanted}
    counts = {f"c{i}": flag_count(cond) for i, cond in enumerate(conditions.values())}
    counts["n"] = F.count("*")
    counts["zero"] = flag_count(F.col("volume") == 0)
    candidates = _row_candidates(conditions, wanted) + _order_candidates(wanted)
    if not set(_ORDER_RULES) & set(wanted):
        total = bars.groupBy(SYMBOL).agg(*[c.alias(k) for k, c in counts.items()])
        return _as_rows(total, candidates)
    inside = {k: flag_count(c) for k, c in _steps(DATETIME, "_prev").items()}
    blocks = _block_ends(
        _ingest_blocks(bars),
        *[c.alias(k) for k, c in {**counts, **inside}.items()],
        F.max(days_between("_prev", DATETIME)).alias("max_gap"),
    )
    total = blocks.groupBy(SYMBOL).agg(
        *[F.sum(k).alias(k) for k in counts],
        *[(F.sum(k) + flag_count(c)).alias(k) for k, c in _steps("_first", "_before").items()],
        F.greatest(F.max("max_gap"), F.max(days_between("_before", "_first"))).alias("max_gap"),
    )
    return _as_rows(total, candidates)


# --- copies and changes along the datetime ---------------------------------


def variation(now: Column, prev: Column) -> Column:
    """Absolute relative change; from zero to anything else it is infinite."""
    from_zero = (prev == 0) & (now != 0)
    return F.when(from_zero, F.lit(float("inf"))).otherwise(F.abs(change(now, prev)))


def _fold_changes(parts: DataFrame, into: list[str], order: list[str], *more: Column) -> DataFrame:
    """Merge neighbouring stretches of a series into one stretch per key ``into``.

    A stretch has its first and last known close, its rows, and the number and size
    of the extreme changes in it; merging adds the steps between neighbours.
    """
    w = Window.partitionBy(*into).orderBy(*order)
    step = variation(F.col("first"), F.last("last", ignorenulls=True).over(before(w)))
    hit = F.col("step") > MAX_VARIATION
    place = F.struct(*order)
    return (
        parts.withColumn("step", step)
        .groupBy(*into)
        .agg(
            F.sum("n").alias("n"),
            (F.sum("hits") + flag_count(hit)).alias("hits"),
            F.greatest(F.max("largest"), F.max(F.when(hit, F.col("step")))).alias("largest"),
            F.min_by("first", F.when(F.col("first").isNotNull(), place)).alias("first"),
            F.max_by("last", F.when(F.col("last").isNotNull(), place)).alias("last"),
            *more,
        )
    )


def _mark_copies(times: DataFrame, w) -> DataFrame:
    """_again: rows beyond the first of their datetime; _new_date: first such row of a date."""
    same = F.col(DATETIME).eqNullSafe(F.lag(DATETIME).over(w)) & (F.row_number().over(w) > 1)
    date = F.coalesce(F.col(DATETIME).cast("date"), F.lit("0001-01-01").cast("date"))
    last_date = F.last("_date", ignorenulls=True).over(before(w))
    return (
        times.withColumn("_again", F.col("n") - F.when(same, 0).otherwise(1))
        .withColumn("_date", F.when(F.col("_again") > 0, date))
        .withColumn("_new_date", (F.col("_again") > 0) & ~F.col("_date").eqNullSafe(last_date))
    )


def _pass_by_time(bars: DataFrame, wanted: Collection[str]) -> DataFrame:
    """Copies of a datetime are merged first, then months, then the whole symbol."""
    rows = bars.select(
        SYMBOL,
        SEQ,
        # A row without datetime sorts behind all others.
        F.coalesce(F.year(DATETIME) * 12 + F.month(DATETIME), F.lit(200_000)).alias("_month"),
        DATETIME,
        F.floor(F.col(SEQ) / SEQ_BLOCK).alias("_block"),
        F.lit(1).alias("n"),
        F.lit(0).alias("hits"),
        F.lit(None).cast("double").alias("largest"),
        F.col("close").alias("first"),
        F.col("close").alias("last"),
    )
    times = _fold_changes(rows, [SYMBOL, "_month", DATETIME, "_block"], [SEQ])
    month, along = [SYMBOL, "_month"], [DATETIME, "_block"]
    marked = _mark_copies(times, Window.partitionBy(*month).orderBy(*along))
    months = _fold_changes(
        marked,
        month,
        along,
        F.sum("_again").alias("again"),
        flag_count(F.col("_new_date")).alias("dates"),
    )
    total = _fold_changes(
        months, [SYMBOL], ["_month"], F.sum("again").alias("again"), F.sum("dates").alias("dates")
    )
    hits = F.col("hits")
    found = {
        "vr_date_duplicate": _issue("vr_date_duplicate", F.col("again"), metric=F.col("dates")),
        "vr_extreme_variation": _issue(
            "vr_extreme_variation",
            hits,
            (hits > 0) & (F.col("n") >= 2),
            "close",
            metric=F.col("largest"),
        ),
    }
    return _as_rows(total, [issue for rule, issue in found.items() if rule in wanted])


# --- outliers --------------------------------------------------------------


def iqr_bounds(counts: DataFrame) -> DataFrame:
    """(symbol, field, lower, upper) from value counts."""
    quartiles = exact_quantiles(counts, [SYMBOL, "field"], {"q1": 0.25, "q3": 0.75})
    reach = (F.col("q3") - F.col("q1")) * IQR_FACTOR
    return quartiles.select(
        SYMBOL, "field", (F.col("q1") - reach).alias("lower"), (F.col("q3") + reach).alias("upper")
    )


def _outlier_issues(bars: DataFrame) -> DataFrame:
    # A single row lies on both quartiles, so no rule on the number of rows is needed.
    counts = staged(value_counts(bars, [SYMBOL], [*OHLC, "volume"]), "values")
    value = F.col("value")
    outside = (value < F.col("lower")) | (value > F.col("upper"))
    per_field = (
        spread_join(counts, iqr_bounds(counts), [SYMBOL, "field"], "value")
        .groupBy(SYMBOL, "field")
        .agg(
            F.sum(F.when(outside, F.col("n")).otherwise(0)).alias("hits"),
            F.max("lower").alias("lower"),
            F.max("upper").alias("upper"),
        )
    )
    found = _issue(
        "vr_iqr_outlier",
        F.col("hits"),
        field=F.col("field"),
        metric=F.col("lower"),
        metric_2=F.col("upper"),
    )
    return _as_rows(per_field, [found])


# --- public ----------------------------------------------------------------


def issues(bars: DataFrame, only: Collection[str] | None = None) -> DataFrame:
    """The issues table: one row per symbol, rule and field, with the affected row count.

    ``only`` restricts the work to some rules; a branch nobody asked for is not run.
    """
    wanted = set(DATA_RULES if only is None else only)
    unknown = wanted - set(DATA_RULES)
    if unknown:
        raise ValueError(f"not rules on bars: {sorted(unknown)}")
    by_time = {"vr_date_duplicate", "vr_extreme_variation"}
    branches = []
    if wanted - by_time - {"vr_iqr_outlier"}:
        branches.append(_pass_by_ingest(bars, wanted))
    if wanted & by_time:
        branches.append(_pass_by_time(bars, wanted))
    if "vr_iqr_outlier" in wanted:
        branches.append(_outlier_issues(bars))
    found = branches[0]
    for more in branches[1:]:
        found = found.unionByName(more)
    return found


def empty_issues(requested: DataFrame, bars: DataFrame) -> DataFrame:
    """An issue for every requested symbol without a row."""
    absent = requested.select(SYMBOL).join(bars.select(SYMBOL).distinct(), SYMBOL, "left_anti")
    return _as_rows(absent, [_issue("vr_empty", F.lit(0), F.lit(True))])


def field_issues(raw: DataFrame, only: Collection[str] | None = None) -> DataFrame:
    """Rules on the raw text layer: (symbol, fields MAP<STRING, STRING>).

    A column is missing when no row of the symbol has the field.
    """
    wanted = set(_FIELD_RULES if only is None else only)
    text = lambda c: F.try_element_at("fields", F.lit(c))
    no_number = lambda c: text(c).isNotNull() & text(c).try_cast("double").isNull()
    fractional = F.col("_volume").isNotNull() & (F.col("_volume") != F.floor("_volume"))
    total = (
        raw.withColumn("_volume", text("volume").try_cast("double"))
        .groupBy(SYMBOL)
        .agg(
            *[flag_count(F.map_contains_key("fields", c)).alias(f"has_{c}") for c in BAR_COLUMNS],
            *[flag_count(no_number(c)).alias(f"bad_{c}") for c in [*PRICES, "volume"]],
            flag_count(fractional).alias("fractional"),
        )
    )
    absent = F.array_compact(
        F.array(*[F.when(F.col(f"has_{c}") == 0, F.lit(c)) for c in BAR_COLUMNS])
    )
    bad, odd = F.col("bad_volume"), F.col("fractional")
    found = {
        "vr_missing_columns": [
            _issue(
                "vr_missing_columns",
                F.size("absent"),
                field=F.array_join(F.array_sort("absent"), ","),
            )
        ],
        "vr_non_numeric": [_issue("vr_non_numeric", F.col(f"bad_{c}"), field=c) for c in PRICES],
        "vr_volume_type": [
            _issue(
                "vr_volume_type",
                F.when(bad > 0, bad).otherwise(odd),
                field="volume",
                severity=F.when(bad > 0, CRITICAL).otherwise(WARNING),
            )
        ],
    }
    chosen = [c for rule, cs in found.items() if rule in wanted for c in cs]
    return _as_rows(total.withColumn("absent", absent), chosen)


def validate(requested: DataFrame, bars: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    """All issues of a run: absent symbols, raw fields (if given), then the data rules.

    Symbols whose raw fields have a critical issue skip the data rules.
    """
    found = empty_issues(requested, bars)
    if raw is not None:
        fields = field_issues(raw)
        found = found.unionByName(fields)
        bars = accepted(bars, fields)
    return found.unionByName(issues(bars))


def violations(bars: DataFrame) -> DataFrame:
    """(symbol, ingest_seq, date, rule_id, field): the rows behind the issues."""
    named = [
        F.struct(
            F.coalesce(cond, F.lit(False)).alias("hit"),
            F.lit(rule).alias("rule_id"),
            F.lit(field).cast("string").alias("field"),
        )
        for (rule, field), cond in row_rules().items()
    ]
    hits = F.filter(F.array(*named), lambda r: r["hit"])
    out = [SYMBOL, SEQ, "date", "rule_id", "field"]
    by_row = (
        bars.select(SYMBOL, SEQ, F.col(DATETIME).cast("date").alias("date"), F.inline(hits))
        .select(*out)
    )
    return by_row.unionByName(_duplicate_rows(bars, out)).unionByName(_order_rows(bars, out))


def _duplicate_rows(bars: DataFrame, out: list[str]) -> DataFrame:
    """Second and later rows of a datetime, found by a join with the repeated keys."""
    repeated = (
        bars.groupBy(SYMBOL, DATETIME)
        .agg(F.min(SEQ).alias("_first"), F.count("*").alias("_n"))
        .where(F.col("_n") > 1)
    )
    return (
        bars.select(SYMBOL, SEQ, DATETIME)
        .transform(spread_join, repeated, [SYMBOL, DATETIME], SEQ)
        .where(F.col(SEQ) > F.col("_first"))
        .withColumns(
            {
                "date": F.col(DATETIME).cast("date"),
                "rule_id": F.lit("vr_date_duplicate"),
                "field": F.lit(None).cast("string"),
            }
        )
        .select(*out)
    )


def _order_rows(bars: DataFrame, out: list[str]) -> DataFrame:
    def flagged(frame: DataFrame, seq: str, now: str, prev: str) -> DataFrame:
        found = F.array_compact(
            F.array(
                F.when(F.col(now) < F.col(prev), F.lit("vr_date_order")),
                F.when(days_between(prev, now) > LONG_GAP_DAYS, F.lit("vr_gap_suspicious")),
            )
        )
        return frame.select(
            SYMBOL,
            F.col(seq).alias(SEQ),
            F.col(now).cast("date").alias("date"),
            F.explode(found).alias("rule_id"),
            F.lit(None).cast("string").alias("field"),
        ).select(*out)

    blocks = _ingest_blocks(bars)
    inside = flagged(blocks, SEQ, DATETIME, "_prev")
    return inside.unionByName(flagged(_block_ends(blocks), "_first_seq", "_first", "_before"))


def summary(symbols: DataFrame, found: DataFrame) -> DataFrame:
    """Per symbol: validity and the number of issues by severity.

    ``symbols`` lists all validated symbols, so those without issues appear too.
    """
    per_severity = found.groupBy(SYMBOL).agg(
        F.count("*").alias("total_issues"),
        *[
            F.count_if(F.col("severity") == s).alias(f"{s.lower()}_count")
            for s in (CRITICAL, WARNING, INFO)
        ],
    )
    numbers = ["total_issues", "critical_count", "warning_count", "info_count"]
    counted = symbols.select(SYMBOL).distinct().join(per_severity, SYMBOL, "left")
    counted = counted.na.fill(0, numbers)
    valid = F.col("critical_count") == 0
    return counted.select(
        SYMBOL, valid.alias("is_valid"), *numbers, valid.alias("has_corrections")
    )


def accepted(bars: DataFrame, found: DataFrame) -> DataFrame:
    """Bars of symbols without a critical issue."""
    critical = found.where(F.col("severity") == CRITICAL).select(SYMBOL).distinct()
    return spread_join(bars, critical, [SYMBOL], SEQ, "left_anti")


def rejects(found: DataFrame) -> DataFrame:
    """(symbol, critical_issues, reasons): why a symbol was turned away."""
    return (
        found.where(F.col("severity") == CRITICAL)
        .groupBy(SYMBOL)
        .agg(
            F.count("*").alias("critical_issues"),
            F.array_join(F.array_sort(F.collect_set("rule_id")), ",").alias("reasons"),
        )
    )
