"""Forecast accuracy per symbol and model over pairs (symbol, model, datetime, y, p)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candleworks.functions.columns import ratio
from candleworks.schema import DATETIME, SYMBOL

KEYS = [SYMBOL, "model"]

# In which direction a metric is better. smape is not ranked.
LOWER_IS_BETTER = ("rmse", "mae", "mape")
HIGHER_IS_BETTER = ("r2", "directional_accuracy")


def _expressions() -> dict[str, Column]:
    y, p = F.col("y"), F.col("p")
    error = y - p
    size = F.abs(y) + F.abs(p)
    right = (F.col("_dy") > 0) == (F.col("_dp") > 0)
    return {
        "rmse": F.sqrt(F.avg(error * error)),
        "mae": F.avg(F.abs(error)),
        "mape": F.avg(F.when(y != 0, F.abs(ratio(error, y)))) * 100,
        "r2": 1 - ratio(F.sum(error * error), F.var_pop(y) * F.count(y)),
        "directional_accuracy": F.avg(right.cast("double")) * 100,
        "smape": F.avg(F.when(size != 0, ratio(2.0 * F.abs(error), size))) * 100,
    }


METRICS = ("rmse", "mae", "mape", "r2", "directional_accuracy", "smape")


def evaluate(pairs: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """One row per symbol and model with the wanted metrics."""
    frame = pairs
    if "directional_accuracy" in metrics:
        w = Window.partitionBy(*KEYS).orderBy(DATETIME)
        frame = pairs.withColumns(
            {f"_d{c}": F.col(c) - F.lag(c).over(w) for c in ("y", "p")}
        )
    chosen = _expressions()
    return frame.groupBy(*KEYS).agg(*[chosen[m].alias(m) for m in metrics])


def compare_models(scores: DataFrame) -> DataFrame:
    """(symbol, metric, best_model, value); the first model by name on ties."""
    candidates = []
    for m in (*LOWER_IS_BETTER, *HIGHER_IS_BETTER):
        cost = -F.col(m) if m in HIGHER_IS_BETTER else F.col(m)
        rank = F.struct(cost.alias("cost"), F.col("model"), F.col(m).alias("value"))
        candidates.append(F.min(F.when(F.col(m).isNotNull(), rank)).alias(m))
    best = scores.groupBy(SYMBOL).agg(*candidates)
    rows = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"),
                F.col(f"{m}.model").alias("best_model"),
                F.col(f"{m}.value").alias("value"),
            )
            for m in (*LOWER_IS_BETTER, *HIGHER_IS_BETTER)
        ]
    )
    return best.select(SYMBOL, F.inline(rows)).where(F.col("best_model").isNotNull())
