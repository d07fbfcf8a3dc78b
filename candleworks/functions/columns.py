"""Small column expressions used by several operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Exchange suffix of a ticker and the city it stands for.
EXCHANGE_CITIES = {
    "AS": "Amsterdam",
    "L": "London",
    "DE": "Frankfurt",
    "PA": "Paris",
    "MI": "Milan",
}


def col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio(a: str | Column, b: str | Column) -> Column:
    """a / b, null where b is zero."""
    return F.try_divide(col(a), col(b))


def change(now: str | Column, before: str | Column) -> Column:
    """Relative change from ``before`` to ``now``."""
    return ratio(now, before) - F.lit(1.0)


def no_nan(x: str | Column) -> Column:
    """The library knows missing values as NULL only."""
    return F.when(~F.isnan(col(x)), col(x))


def code_map(values: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(v) for pair in values.items() for v in pair])


def exchange_of(symbol: str | Column) -> Column:
    """City (or bare code) behind the first dot of a ticker, 'US' without a dot."""
    code = F.split(col(symbol), r"\.").getItem(1)
    known = F.try_element_at(code_map(EXCHANGE_CITIES), code)
    return F.when(F.contains(col(symbol), F.lit(".")), F.coalesce(known, code)).otherwise("US")


def time_of_day(ts: str | Column) -> Column:
    """Interval since midnight, free of any time zone."""
    return col(ts) - col(ts).cast("date").cast("timestamp_ntz")


def days_between(before: str | Column, now: str | Column) -> Column:
    """Whole days from ``before`` to ``now``, rounded down (also when negative)."""
    not_full = time_of_day(now) < time_of_day(before)
    return F.datediff(col(now), col(before)) - not_full.cast("int")


def at_midnight(date: str | Column) -> Column:
    return col(date).cast("timestamp_ntz")


def is_weekend(date: str | Column) -> Column:
    return F.weekday(col(date)) >= 5


def flag_count(condition: Column) -> Column:
    """Rows for which the condition holds; 0 for an empty input."""
    return F.count_if(F.coalesce(condition, F.lit(False)))
