"""Exact interpolated quantiles without holding a group's values in one task.

Equal values are counted first, then the values are placed in bins of about one
percent width, ordered like the values. Running bin counts (a few thousand bins
per group at most) tell in which bins the wanted ranks lie. While such a bin has
too many distinct values for one task, all bins with wanted ranks are cut into
equal parts between their smallest and largest value, and the parts with wanted
ranks stay: a crowded bin has values at both ends, so each round makes it smaller.
Only what is left is sorted by value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candleworks.functions.series import before
from candleworks.session import staged

_BINS_PER_E = 64
#: Distinct values of a bin that a task may sort, and the parts of a bin beyond that.
MOST = 100_000
_PARTS = 1_024


def value_counts(frame: DataFrame, by: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """(by..., field, value, n): how often each value that is not null occurs."""
    pairs = F.array(
        *[F.struct(F.lit(f).alias("field"), F.col(f).cast("double").alias("value")) for f in fields]
    )
    return (
        frame.select(*by, F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy(*by, "field", "value")
        .agg(F.count("*").alias("n"))
    )


def _bin(value: Column) -> Column:
    """A whole number that never falls when the value rises."""
    size = F.floor(F.ln(F.abs(value)) * _BINS_PER_E) + F.lit(100_000)
    return F.when(value > 0, size).when(value < 0, -size - 1).otherwise(F.lit(0)).cast("long")


def _wanted_bins(rows: DataFrame, by: list[str], within: list[str], wanted: Mapping[str, float], total: Column) -> DataFrame:
    """The bins that hold a wanted rank: the rows below them, how many distinct values they
    have, the smallest and largest, and the ranks (two neighbouring ones per quantile)."""
    along = Window.partitionBy(*by, *within).orderBy("_bin")
    sums = {"_in_bin": F.sum("n"), "_values": F.count("*"), "_low": F.min("value"), "_high": F.max("value"), "_start": F.max("_start")}
    if within:
        sums["_of"] = F.max("_total")
    ahead = F.coalesce(F.sum("_in_bin").over(before(along)), F.lit(0))
    sized = (
        rows.groupBy(*by, *within, "_bin")
        .agg(*[c.alias(k) for k, c in sums.items()])
        .withColumns({"_below": F.col("_start") + ahead, "_total": total})
    )
    places = F.array(
        *[
            F.struct(
                F.lit(f"{name}_{side}").alias("_slot"),
                rounding((F.col("_total") - 1) * F.lit(float(q))).cast("long").alias("_rank"),
            )
            for name, q in wanted.items()
            for side, rounding in (("lo", F.floor), ("hi", F.ceil))
        ]
    )
    here = F.filter(
        places,
        lambda p: (p["_rank"] >= F.col("_below")) & (p["_rank"] < F.col("_below") + F.col("_in_bin")),
    )
    return (
        sized.withColumn("_slots", here)
        .where(F.size("_slots") > 0)
        .select(*by, "_bin", "_below", "_total", "_values", "_low", "_high", "_slots")
    )


def exact_quantiles(
    counts: DataFrame, by: Sequence[str], wanted: Mapping[str, float], most: int = MOST
) -> DataFrame:
    """One row per group of ``by`` with a column per wanted quantile.

    ``counts`` has the columns ``by``, value and n, and is best a stored table, since it is
    read at once. Ranks between two values are interpolated linearly, as numpy and pandas do.
    """
    by = list(by)
    bins = [*by, "_bin"]
    # A bin is the list of its number and those of the parts it was cut into.
    rows = counts.withColumns({"_bin": F.array(_bin(F.col("value"))), "_start": F.lit(0).cast("long")})
    total = F.sum("_in_bin").over(Window.partitionBy(*by))
    targets = _wanted_bins(rows, by, [], wanted, total)
    while (targets.agg(F.max("_values")).first()[0] or 0) > most:
        part = F.least(F.floor((F.col("value") - F.col("_low")) / (F.col("_high") - F.col("_low")) * _PARTS), F.lit(_PARTS - 1))
        part = F.when(F.col("_high") > F.col("_low"), part).otherwise(0).cast("long")
        inside = rows.select(*bins, "value", "n").join(targets.withColumnRenamed("_below", "_start"), bins)
        inside = inside.withColumns({"_within": F.col("_bin"), "_bin": F.concat("_bin", F.array(part))})
        rows = staged(inside.select(*by, "value", "n", "_bin", "_within", "_start", "_total"), "open")
        targets = _wanted_bins(rows, by, ["_within"], wanted, F.max("_of").over(Window.partitionBy(*by)))

    inside = before(Window.partitionBy(*bins).orderBy("value"))
    placed = (
        rows.select(*bins, "value", "n")
        .join(targets.select(*bins, "_below", "_total", "_slots"), bins)
        .withColumn("_from", F.col("_below") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .withColumn(
            "_slots",
            F.filter(
                "_slots",
                lambda p: (p["_rank"] >= F.col("_from")) & (p["_rank"] < F.col("_from") + F.col("n")),
            ),
        )
        .where(F.size("_slots") > 0)
    )
    has = lambda slot: F.exists("_slots", lambda p: p["_slot"] == slot)
    at = lambda slot: F.max(F.when(has(slot), F.col("value"))).alias(slot)
    slots = placed.groupBy(*by).agg(
        F.max("_total").alias("_total"),
        *[at(f"{name}_{side}") for name in wanted for side in ("lo", "hi")],
    )

    def interpolated(name: str, q: float) -> Column:
        place = (F.col("_total") - 1) * F.lit(float(q))
        low, high = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        return (low + (high - low) * (place - F.floor(place))).alias(name)

    return slots.select(*by, *[interpolated(name, q) for name, q in wanted.items()])
