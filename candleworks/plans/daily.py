"""The daily run over all symbols at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleworks.functions.joins import spread_join
from candleworks.operators import corrections, rules
from candleworks.operators.relational import first_provider
from candleworks.schema import SEQ, SYMBOL
from candleworks.session import staged
from candleworks.sources.store import BarStore

SUCCESSFUL, FAILED, SKIPPED = "successful", "failed", "skipped"


@dataclass
class RunResult:
    """``status``: one row per requested symbol; ``issues``: what validation found and what
    the repair of the accepted symbols changed."""

    status: DataFrame
    issues: DataFrame


def status_of(
    requested: DataFrame, bars: DataFrame, found: DataFrame, saved: DataFrame
) -> DataFrame:
    """(symbol, status, records, reasons).

    Symbols without data are skipped, those with critical issues failed. ``saved`` has
    the rows that count for the successful ones.
    """
    collected = bars.groupBy(SYMBOL).agg(F.count("*").alias("_collected"))
    records = saved.groupBy(SYMBOL).agg(F.count("*").alias("_saved"))
    status = (
        F.when(F.col("_collected").isNull(), SKIPPED)
        .when(F.col("reasons").isNotNull(), FAILED)
        .otherwise(SUCCESSFUL)
    )
    return (
        requested.select(SYMBOL)
        .distinct()
        .join(collected, SYMBOL, "left")
        .join(rules.rejects(found), SYMBOL, "left")
        .join(records, SYMBOL, "left")
        .withColumn("status", status)
        .select(
            SYMBOL,
            "status",
            F.when(F.col("status") == SUCCESSFUL, F.col("_saved")).otherwise(0).alias("records"),
            "reasons",
        )
    )


def run_statistics(status: DataFrame) -> DataFrame:
    """One row: symbols by outcome, records, success rate in percent (one decimal)."""
    count = lambda name: F.count_if(F.col("status") == name).alias(name)
    total = status.agg(
        F.count("*").alias("total_symbols"),
        count(SUCCESSFUL),
        count(FAILED),
        count(SKIPPED),
        F.coalesce(F.sum("records"), F.lit(0)).alias("total_records"),
    )
    rate = F.round(F.try_divide(F.col(SUCCESSFUL), F.col("total_symbols")) * 100, 1)
    return total.withColumn("success_rate", rate)


def run_daily(
    requested: DataFrame,
    delivered: DataFrame,
    store: BarStore | None = None,
    backup: bool = True,
    raw: DataFrame | None = None,
) -> RunResult:
    """Choose providers, validate, repair and store.

    ``delivered`` holds bars with a provider ``priority``. Without a store this is a dry
    run. With ``raw`` (the text fields of the same symbols) the field rules run as well.
    The chosen bars and the issues are used several times, so they are staged.
    """
    asked = requested.select(SYMBOL).distinct()
    bars = spread_join(first_provider(delivered), asked, [SYMBOL], SEQ, "left_semi")
    bars = staged(bars.drop("priority"), "chosen")
    found = staged(rules.validate(requested, bars, raw), "issues")
    found = staged(corrections.run_issues(bars, found), "run-issues")
    corrected = corrections.corrected_layer(rules.accepted(bars, found))
    if store is not None:
        store.save(bars, corrected, found, backup=backup)
        # Both layers are stored now; the counts come from the smaller scan.
        corrected = corrected.select(SYMBOL)
    return RunResult(status_of(requested, bars, found, corrected), found)


def bulk_status(requested: DataFrame, collected: DataFrame) -> DataFrame:
    """Success and failure lists of a bulk collection, and its success rate."""
    status = (
        requested.select(SYMBOL)
        .distinct()
        .join(collected.select(SYMBOL).distinct().withColumn("_ok", F.lit(True)), SYMBOL, "left")
        .withColumn("success", F.coalesce("_ok", F.lit(False)))
    )
    rate = F.try_divide(F.count_if("success"), F.count("*")) * 100
    return status.agg(
        F.count("*").alias("total_symbols"),
        F.count_if("success").alias("successful"),
        F.count_if(~F.col("success")).alias("failed"),
        F.round(rate, 1).alias("success_rate"),
    )
