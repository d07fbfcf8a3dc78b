"""Automatic repair of bars that passed validation.

The repaired layer is daily: after :func:`dedup_date` a symbol has one row per date,
so windows by symbol are bounded by the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candleworks.functions.columns import is_weekend, time_of_day
from candleworks.functions.series import before, so_far
from candleworks.operators.projections import normalize_types
from candleworks.operators.quality import is_sorted
from candleworks.operators.rules import accepted
from candleworks.schema import BAR_COLUMNS, DATETIME, OHLC, PRICES, SEQ, SYMBOL

# Fixed value: the longest run of missing days that is filled.
MAX_FILL = 2

# The repair behind each type of finding.
REPAIRS = {
    "duplicate_dates": "fix_dedup_date",
    "out_of_order": "fix_sort",
    "missing_dates": "fix_interpolate",
    "wrong_type": "fix_types",
}

CALENDARS = ("all_days", "weekdays")


def _line(*order: str | Column):
    return Window.partitionBy(SYMBOL).orderBy(*(order or (DATETIME,)))


def dedup_date(bars: DataFrame) -> DataFrame:
    """One row per symbol and date: the one that came in last."""
    newest = Window.partitionBy(SYMBOL, "date").orderBy(F.desc(SEQ))
    return bars.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") == 1).drop("_n")


def sort_flags(bars: DataFrame) -> DataFrame:
    """(symbol, was_sorted, out_of_order): whether rows came in datetime order.

    Spark tables have no row order to repair, so only the finding remains.
    """
    return is_sorted(bars).select(
        SYMBOL, F.col("is_sorted").alias("was_sorted"), (~F.col("is_sorted")).alias("out_of_order")
    )


def _missing_after(calendar: str, limit: int | None) -> Column:
    """Missing days between this date and the next one, as an array of dates.

    With a limit, gaps that are surely longer give an empty array instead of a long one.
    """
    nxt = F.lead("date").over(_line("date"))
    gap = F.datediff(nxt, "date") - 1
    days = F.sequence(F.date_add("date", 1), F.date_sub(nxt, 1))
    if calendar == "weekdays":
        days = F.filter(days, lambda d: ~is_weekend(d))
    none = F.array().cast("array<date>")
    if limit is None:
        return F.coalesce(F.when(gap >= 1, days), none)
    # Weekends may lie between the missing weekdays.
    longest = limit if calendar == "all_days" else limit + 2 * (limit // 5 + 1)
    days = F.coalesce(F.when(gap.between(1, longest), days), none)
    return F.when(F.size(days) <= limit, days).otherwise(none)


def missing_runs(bars: DataFrame, calendar: str = "all_days") -> DataFrame:
    """(symbol, run_start, run_days): runs of consecutive missing days."""
    dates = bars.select(SYMBOL, "date")
    if calendar == "all_days":
        days = F.datediff(F.lead("date").over(_line("date")), "date") - 1
        runs = dates.withColumns({"run_start": F.date_add("date", 1), "run_days": days})
    else:
        runs = dates.withColumn("_days", _missing_after(calendar, None)).withColumns(
            {"run_start": F.try_element_at("_days", F.lit(1)), "run_days": F.size("_days")}
        )
    return runs.where(F.col("run_days") >= 1).select(SYMBOL, "run_start", "run_days")


def _with_fill_days(bars: DataFrame, calendar: str, max_fill: int) -> DataFrame:
    if calendar not in CALENDARS:
        raise ValueError(f"calendar must be one of {CALENDARS}")
    return bars.withColumn("_fill", _missing_after(calendar, max_fill))


def _first_of(name: str) -> Column:
    whole = _line().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return F.first(name).over(whole)


def _placed_rows(bars: DataFrame) -> DataFrame:
    """Repeat each bar for itself (_k = 0) and for every day to fill behind it."""
    return bars.select(
        "*",
        F.posexplode(F.concat(F.array("date"), F.col("_fill"))).alias("_k", "_date"),
    )


def _filled_columns(prices: dict[str, Column]) -> list[Column]:
    """The canonical columns, with inserted rows (_k > 0) built from the bar before."""
    inserted = F.col("_k") > 0
    columns = {
        DATETIME: F.when(inserted, F.col("_date").cast("timestamp_ntz") + F.col("_time")).otherwise(
            F.col(DATETIME)
        ),
        "date": F.col("_date"),
        SYMBOL: F.col(SYMBOL),
        "volume": F.when(inserted, F.lit(0).cast("bigint")).otherwise(F.col("volume")),
        "currency": F.when(inserted, F.coalesce("_currency", F.lit("USD"))).otherwise(F.col("currency")),
        "exchange": F.when(inserted, F.coalesce("_exchange", F.lit("UNKNOWN"))).otherwise(
            F.col("exchange")
        ),
        **prices,
    }
    return [columns[c].alias(c) for c in BAR_COLUMNS] + [inserted.alias("is_filled")]


_FIRSTS = {"_currency": "currency", "_exchange": "exchange"}


def insert_short_runs(
    bars: DataFrame, calendar: str = "all_days", max_fill: int = MAX_FILL
) -> DataFrame:
    """Add a row with null prices and volume 0 for every day of a short missing run."""
    frame = _with_fill_days(bars, calendar, max_fill).withColumns(
        {**{k: _first_of(c) for k, c in _FIRSTS.items()}, "_time": time_of_day(_first_of(DATETIME))}
    )
    prices = {c: F.when(F.col("_k") == 0, F.col(c)) for c in PRICES}
    return _placed_rows(frame).select(*_filled_columns(prices))


def fill_short_runs(
    bars: DataFrame, calendar: str = "all_days", max_fill: int = MAX_FILL
) -> DataFrame:
    """Insert short missing runs and interpolate prices linearly by row position.

    OHLC of a valid bar is never null, so an inserted row lies between the bar before
    and the bar behind it. adj_close may have nulls of its own: at most ``max_fill``
    rows behind a known value are filled, and only where the symbol got a new row.
    The output has ``is_filled`` and a new ingest_seq, the position in time order.
    """
    line = _line()
    adjusted = F.col("adj_close")
    added_before = F.coalesce(F.sum(F.size("_fill")).over(before(line)), F.lit(0))
    known = F.when(adjusted.isNotNull(), F.struct(adjusted.alias("v"), F.col("_pos").alias("p")))
    next_line = before(_line(F.desc(DATETIME)))
    everything = Window.partitionBy(SYMBOL)
    frame = (
        _with_fill_days(bars, calendar, max_fill)
        .withColumns(
            {
                "_pos": F.row_number().over(line) + added_before,
                "_time": time_of_day(_first_of(DATETIME)),
                **{k: _first_of(c) for k, c in _FIRSTS.items()},
                **{f"_next_{c}": F.lead(c).over(line) for c in OHLC},
            }
        )
        .withColumns(
            {
                "_behind": F.last(known, ignorenulls=True).over(so_far(line)),
                "_any": F.max(F.size("_fill")).over(everything) > 0,
            }
        )
        .withColumn("_ahead", F.last(known, ignorenulls=True).over(next_line))
    )
    step, width = F.col("_k"), F.size("_fill") + 1
    prices = {
        c: F.when(step == 0, F.col(c)).otherwise(
            F.col(c) + (F.col(f"_next_{c}") - F.col(c)) * step / width
        )
        for c in OHLC
    }
    here = F.col("_pos") + step
    value, place = F.col("_behind.v"), F.col("_behind.p")
    distance = here - place
    slope = (F.col("_ahead.v") - value) * distance / (F.col("_ahead.p") - place)
    guess = value + F.coalesce(slope, F.lit(0.0))
    prices["adj_close"] = (
        F.when((step == 0) & adjusted.isNotNull(), adjusted)
        .when(F.col("_any") & (distance <= max_fill), guess)
    )
    return _placed_rows(frame).select(*_filled_columns(prices), here.cast("bigint").alias(SEQ))


def corrected_layer(
    bars: DataFrame, calendar: str = "all_days", max_fill: int = MAX_FILL
) -> DataFrame:
    """The whole repair chain for bars of accepted symbols."""
    return (
        bars.transform(dedup_date)
        .transform(normalize_types)
        .transform(fill_short_runs, calendar=calendar, max_fill=max_fill)
    )


def correction_issues(
    bars: DataFrame, calendar: str = "all_days", max_fill: int = MAX_FILL
) -> DataFrame:
    """What the repair changed: (symbol, issue_type, severity, affected)."""
    copies = (
        bars.groupBy(SYMBOL, "date")
        .agg((F.count("*") - 1).alias("extra"))
        .groupBy(SYMBOL)
        .agg(F.sum("extra").alias("affected"))
        .withColumn("issue_type", F.lit("duplicate_dates"))
    )
    kept = dedup_date(bars)
    disorder = (
        sort_flags(kept)
        .where("out_of_order")
        .select(SYMBOL, F.lit(1).cast("bigint").alias("affected"), F.lit("out_of_order").alias("issue_type"))
    )
    filled = (
        _with_fill_days(kept, calendar, max_fill)
        .groupBy(SYMBOL)
        .agg(F.sum(F.size("_fill")).alias("affected"))
        .withColumn("issue_type", F.lit("missing_dates"))
    )
    # With a fixed schema only a null volume still changes its type on the way.
    types = (
        kept.groupBy(SYMBOL)
        .agg(F.max(F.col("volume").isNull().cast("bigint")).alias("affected"))
        .withColumn("issue_type", F.lit("wrong_type"))
    )
    found = copies
    for more in (disorder, filled, types):
        found = found.unionByName(more)
    return found.where(F.col("affected") > 0).select(
        SYMBOL, "issue_type", F.lit("INFO").alias("severity"), "affected"
    )


def run_issues(bars: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` and, for the symbols it lets pass, what their repair changes, as issues."""
    changed = correction_issues(accepted(bars, found))
    names = F.create_map(*[F.lit(x) for pair in REPAIRS.items() for x in pair])
    rows = changed.select(SYMBOL, names[F.col("issue_type")].alias("rule_id"), "issue_type", "severity", "affected")
    return found.unionByName(rows, allowMissingColumns=True)
