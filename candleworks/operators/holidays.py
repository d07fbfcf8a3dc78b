"""Public holidays of countries as rules over a date column.

A rule is data: a fixed day, a weekday of a month, a number of days from Easter Sunday, or a
weekday next to a fixed day. Easter is a Column expression in integers (the Gregorian
computus), so every date is judged where it lies: nothing is joined and no calendar is built.
A holiday that falls on a weekend may be observed on another day; that day then carries the
name with " (observed)".
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """on: month and day. nth: month, weekday (Monday is 0) and which one (-1: the last).
    easter: days from Easter Sunday. near: month, day and weekday: that weekday on the day or
    next after it. First and last year; observed: moved from Saturday and Sunday by so many
    days (0: not)."""

    on: tuple[int, int] | None = None
    nth: tuple[int, int, int] | None = None
    easter: int | None = None
    near: tuple[int, int, int] | None = None
    since: int = 1
    until: int = 9999
    observed: tuple[int, int] = (0, 0)


_AMERICAN = (-1, 1)  # Saturday to Friday, Sunday to Monday
_BRITISH = (2, 1)  # Saturday and Sunday to Monday


def _christian(**names: int) -> dict[str, Rule]:
    return {n.replace("_", " "): Rule(easter=days) for n, days in names.items()}


# Public holidays of the countries whose exchanges are in use, and of the US and Brazil.
RULES: dict[str, dict[str, Rule]] = {
    "US": {
        "New Year's Day": Rule(on=(1, 1), observed=_AMERICAN),
        "Martin Luther King Day": Rule(nth=(1, 0, 3), since=1986),
        "Washington's Birthday": Rule(nth=(2, 0, 3)),
        "Memorial Day": Rule(nth=(5, 0, -1)),
        "Juneteenth": Rule(on=(6, 19), since=2021, observed=_AMERICAN),
        "Independence Day": Rule(on=(7, 4), observed=_AMERICAN),
        "Labor Day": Rule(nth=(9, 0, 1)),
        "Columbus Day": Rule(nth=(10, 0, 2)),
        "Veterans Day": Rule(on=(11, 11), observed=_AMERICAN),
        "Thanksgiving": Rule(nth=(11, 3, 4)),
        "Christmas Day": Rule(on=(12, 25), observed=_AMERICAN),
    },
    "BR": {
        "New Year's Day": Rule(on=(1, 1)),
        **_christian(Carnival_Monday=-48, Carnival_Tuesday=-47, Good_Friday=-2, Corpus_Christi=60),
        "Tiradentes": Rule(on=(4, 21)),
        "Labour Day": Rule(on=(5, 1)),
        "Independence Day": Rule(on=(9, 7)),
        "Our Lady of Aparecida": Rule(on=(10, 12)),
        "All Souls' Day": Rule(on=(11, 2)),
        "Republic Day": Rule(on=(11, 15)),
        "Black Consciousness Day": Rule(on=(11, 20), since=2024),
        "Christmas Day": Rule(on=(12, 25)),
    },
    "DE": {
        "New Year's Day": Rule(on=(1, 1)),
        **_christian(Good_Friday=-2, Easter_Monday=1, Ascension_Day=39, Whit_Monday=50),
        "Labour Day": Rule(on=(5, 1)),
        "Unity Day": Rule(on=(10, 3), since=1990),
        "Christmas Day": Rule(on=(12, 25)),
        "Second Christmas Day": Rule(on=(12, 26)),
    },
    "FR": {
        "New Year's Day": Rule(on=(1, 1)),
        **_christian(Easter_Monday=1, Ascension_Day=39, Whit_Monday=50),
        "Labour Day": Rule(on=(5, 1)),
        "Victory Day": Rule(on=(5, 8)),
        "Bastille Day": Rule(on=(7, 14)),
        "Assumption Day": Rule(on=(8, 15)),
        "All Saints' Day": Rule(on=(11, 1)),
        "Armistice Day": Rule(on=(11, 11)),
        "Christmas Day": Rule(on=(12, 25)),
    },
    "GB": {
        "New Year's Day": Rule(on=(1, 1), since=1974, observed=_BRITISH),
        **_christian(Good_Friday=-2, Easter_Monday=1),
        "Early May Bank Holiday": Rule(nth=(5, 0, 1), since=1978),
        "Spring Bank Holiday": Rule(nth=(5, 0, -1), since=1971),
        "Summer Bank Holiday": Rule(nth=(8, 0, -1), since=1971),
        "Christmas Day": Rule(on=(12, 25), observed=(2, 2)),
        "Boxing Day": Rule(on=(12, 26), observed=(2, 2)),
    },
    "NL": {
        "New Year's Day": Rule(on=(1, 1)),
        **_christian(Good_Friday=-2, Easter_Monday=1, Ascension_Day=39, Whit_Monday=50),
        "King's Day": Rule(on=(4, 27), since=2014),
        "Christmas Day": Rule(on=(12, 25)),
        "Second Christmas Day": Rule(on=(12, 26)),
    },
    "ES": {
        "New Year's Day": Rule(on=(1, 1)),
        "Epiphany": Rule(on=(1, 6)),
        **_christian(Good_Friday=-2),
        "Labour Day": Rule(on=(5, 1)),
        "Assumption Day": Rule(on=(8, 15)),
        "National Day": Rule(on=(10, 12)),
        "All Saints' Day": Rule(on=(11, 1)),
        "Constitution Day": Rule(on=(12, 6), since=1979),
        "Immaculate Conception": Rule(on=(12, 8)),
        "Christmas Day": Rule(on=(12, 25)),
    },
    "IT": {
        "New Year's Day": Rule(on=(1, 1)),
        "Epiphany": Rule(on=(1, 6)),
        **_christian(Easter_Monday=1),
        "Liberation Day": Rule(on=(4, 25)),
        "Labour Day": Rule(on=(5, 1)),
        "Republic Day": Rule(on=(6, 2)),
        "Assumption Day": Rule(on=(8, 15)),
        "All Saints' Day": Rule(on=(11, 1)),
        "Immaculate Conception": Rule(on=(12, 8)),
        "Christmas Day": Rule(on=(12, 25)),
        "Saint Stephen's Day": Rule(on=(12, 26)),
    },
    "CH": {
        "New Year's Day": Rule(on=(1, 1)),
        **_christian(Good_Friday=-2, Easter_Monday=1, Ascension_Day=39, Whit_Monday=50),
        "National Day": Rule(on=(8, 1), since=1994),
        "Christmas Day": Rule(on=(12, 25)),
    },
    "BE": {
        "New Year's Day": Rule(on=(1, 1)),
        **_christian(Easter_Monday=1, Ascension_Day=39, Whit_Monday=50),
        "Labour Day": Rule(on=(5, 1)),
        "National Day": Rule(on=(7, 21)),
        "Assumption Day": Rule(on=(8, 15)),
        "All Saints' Day": Rule(on=(11, 1)),
        "Armistice Day": Rule(on=(11, 11)),
        "Christmas Day": Rule(on=(12, 25)),
    },
    "SE": {
        "New Year's Day": Rule(on=(1, 1)),
        "Epiphany": Rule(on=(1, 6)),
        **_christian(Good_Friday=-2, Easter_Monday=1, Ascension_Day=39),
        "Labour Day": Rule(on=(5, 1)),
        "National Day": Rule(on=(6, 6), since=2005),
        "Midsummer Day": Rule(near=(6, 20, 5)),
        "All Saints' Day": Rule(near=(10, 31, 5)),
        "Christmas Day": Rule(on=(12, 25)),
        "Second Christmas Day": Rule(on=(12, 26)),
    },
}


def easter_sunday(year: Column) -> Column:
    """The date of Easter Sunday of a year of the Gregorian calendar."""
    golden = year % 19
    century = F.floor(year / 100)
    leap = F.floor(century / 4)
    moon = (century - leap - F.floor((8 * century + 13) / 25) + 19 * golden + 15) % 30
    moon = moon - F.when((moon == 29) | ((moon == 28) & (golden > 10)), 1).otherwise(0)
    to_sunday = (year + F.floor(year / 4) + moon + 2 - century + leap) % 7
    return F.date_add(F.make_date(year, F.lit(3), F.lit(28)), (moon - to_sunday).cast("int"))


def _facts(day: Column) -> Column:
    """What the rules look at, worked out once per date."""
    parts = {"day": day, "year": F.year(day), "month": F.month(day), "number": F.dayofmonth(day), "weekday": F.weekday(day)}
    parts["easter"] = F.datediff(day, easter_sunday(F.year(day)))
    return F.struct(*[v.alias(k) for k, v in parts.items()])


def _falls(rule: Rule, at: Column) -> Column:
    """Whether a date is the holiday itself."""
    if rule.on:
        found = (at["month"] == rule.on[0]) & (at["number"] == rule.on[1])
    elif rule.nth:
        m, w, n = rule.nth
        week = F.month(F.date_add(at["day"], 7)) != m if n < 0 else F.ceil(at["number"] / 7) == n
        found = (at["month"] == m) & (at["weekday"] == w) & week
    elif rule.near:
        m, d, w = rule.near
        after = F.datediff(at["day"], F.make_date(at["year"], F.lit(m), F.lit(d)))
        found = (at["weekday"] == w) & after.between(0, 6)
    else:
        found = at["easter"] == rule.easter
    return found & at["year"].between(rule.since, rule.until)


def _observed(rule: Rule, at: Column) -> Column:
    """Whether a date is where a fixed holiday on a Saturday or Sunday is moved to."""
    found = F.lit(False)
    for weekday, days in zip((5, 6), rule.observed):
        if days:
            own = F.date_add(at["day"], -days)
            fits = (F.month(own) == rule.on[0]) & (F.dayofmonth(own) == rule.on[1]) & (F.weekday(own) == weekday)
            found = found | (fits & F.year(own).between(rule.since, rule.until))
    return found


def names(country: str) -> list[str]:
    """Of all columns that :func:`with_columns` adds, in order."""
    rules = RULES[country]
    return [*rules, *(f"{n} (observed)" for n, r in rules.items() if any(r.observed))]


def of(country: str, day: Column) -> Column:
    """The names of the holidays that fall on a date, an array."""
    rules = RULES[country]

    def named(at: Column) -> Column:
        own = [F.when(_falls(r, at), F.lit(n)) for n, r in rules.items()]
        moved = [F.when(_observed(r, at), F.lit(f"{n} (observed)")) for n, r in rules.items() if any(r.observed)]
        return F.array_compact(F.array(*own, *moved))

    return F.transform(F.array(_facts(day)), named)[0]


def with_columns(frame: DataFrame, country: str, date_column: str = "date") -> DataFrame:
    """Adds one 0/1 column per holiday, as regressors of a forecast."""
    found = of(country, F.col(date_column))
    return frame.withColumns({n: F.array_contains(found, n).cast("double") for n in names(country)})
