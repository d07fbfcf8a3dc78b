"""Logistic growth: forecasts that saturate at a capacity, for many symbols in one job.

y = floor + (cap - floor) / (1 + exp(-u)) + seasons, with u a line in time that may bend at
the model's knots (a rate that changes, with the offset that keeps the curve continuous, is
such a line). It is fitted by damped Gauss-Newton steps. In a round Spark derives each row's
gradient and residual at the symbol's present coefficients, and the sums of their products
are added up over runs of rows as in :mod:`forecast`; a step is a small solve per symbol. A
step that makes the fit worse is taken back and tried shorter. Symbols leave when they have
converged, so late rounds scan few rows. Every round is written to the shared work folder.

Rows without y, cap or a positive room between floor and cap are left out; a symbol with one
row, or with equal times, has a level and no slope.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candleworks.functions.columns import ratio
from candleworks.functions.joins import spread_join
from candleworks.operators import forecast as fc
from candleworks.schema import DATETIME, SYMBOL
from candleworks.session import staged

ROUNDS = 60
#: A step is the last when it changes no coefficient by more than this share.
SETTLED = 1e-11
#: Shares of the capacity between which the first line is fitted.
_EDGES = (0.01, 0.99)


def prepare(bars: DataFrame, cap: Column, floor: Column | None = None) -> DataFrame:
    """(symbol, ds, y, cap, floor): the training frame without nulls; the floor is 0 by default."""
    floor = F.lit(0.0) if floor is None else floor
    return bars.select(
        SYMBOL, F.col(DATETIME).alias("ds"), F.col("close").alias("y"), cap.cast("double").alias("cap"),
        floor.cast("double").alias("floor"),
    ).na.drop()


def _dot(terms: Column, coefficients: Column) -> Column:
    return F.aggregate(F.zip_with(terms, coefficients, lambda x, b: x * b), F.lit(0.0), lambda a, x: a + x)


def _parts(model: fc.Model) -> tuple[Column, Column, int]:
    """Terms of u, terms of the seasons and regressors, and the number of the former."""
    terms, q = fc._design(model), 2 + model.changepoints
    return F.slice(terms, 1, q), F.slice(terms, q + 1, max(model.size() - q, 1)), q


def _curve(model: fc.Model, room: Column, coefficients: Column) -> tuple[Column, Column]:
    """The value above the floor, and its derivative by u."""
    trend, rest, q = _parts(model)
    share = 1 / (1 + F.exp(-_dot(trend, F.slice(coefficients, 1, q))))
    value = room * share
    if model.size() > q:
        value = value + _dot(rest, F.slice(coefficients, q + 1, model.size() - q))
    return value, room * share * (1 - share)


def _first_line(rows: DataFrame) -> DataFrame:
    """Least squares of the logit of y over the capacity: where the steps start."""
    share = F.least(F.greatest(F.col("y") / F.col("cap"), F.lit(_EDGES[0])), F.lit(_EDGES[1]))
    rows = rows.select(SYMBOL, "t", F.log(share / (1 - share)).alias("z"))
    sums = rows.groupBy(SYMBOL).agg(
        F.regr_slope("z", "t").alias("slope"), F.regr_intercept("z", "t").alias("level"), F.avg("z").alias("mean")
    )
    return sums.select(
        SYMBOL,
        F.when(F.col("slope").isNotNull(), F.col("level")).otherwise(F.col("mean")).alias("level"),
        F.coalesce("slope", F.lit(0.0)).alias("slope"),
    )


def placed_rows(training: DataFrame, model: fc.Model = fc.Model()) -> tuple[DataFrame, DataFrame]:
    """Rows in units of each symbol's scale (symbol, ds, t, y, cap, _start, _length, _run),
    and one row per symbol (symbol, n, _start, _length, train_end, y_scale)."""
    known = training.where("y is not null and cap > floor")
    ranges = known.groupBy(SYMBOL).agg(
        F.count("*").alias("n"),
        F.min(fc._days("ds")).alias("_start"),
        (F.max(fc._days("ds")) - F.min(fc._days("ds"))).alias("_length"),
        F.max("ds").alias("train_end"),
        F.max(F.abs(F.col("y") - F.col("floor"))).alias("y_scale"),
    )
    scale = F.when(F.col("y_scale") > 0, F.col("y_scale")).otherwise(1.0)
    ranges = staged(ranges.withColumn("y_scale", scale), "growth-ranges")
    rows = spread_join(known, ranges.drop("train_end"), [SYMBOL], "ds").select(
        SYMBOL,
        "ds",
        "_start",
        "_length",
        F.coalesce(ratio(fc._days("ds") - F.col("_start"), "_length"), F.lit(0.0)).alias("t"),
        ((F.col("y") - F.col("floor")) / F.col("y_scale")).alias("y"),
        ((F.col("cap") - F.col("floor")) / F.col("y_scale")).alias("cap"),
        F.pmod(F.xxhash64("ds"), F.ceil(F.col("n") / fc.GRAM_ROWS)).alias("_run"),
        *model.regressors,
    )
    return staged(rows, "growth-rows"), ranges


def _products(rows: DataFrame, state: DataFrame, model: fc.Model) -> DataFrame:
    """(symbol, products): sums over rows of the products of (gradient, residual)."""
    joined = spread_join(rows, state.select(SYMBOL, "theta"), [SYMBOL], "ds")
    trend, rest, q = _parts(model)
    value, slope = _curve(model, F.col("cap"), F.col("theta"))
    gradient = F.transform(trend, lambda x: x * F.col("_slope"))
    parts = [gradient, rest] if model.size() > q else [gradient]
    rows = joined.withColumns({"_residual": F.col("y") - value, "_slope": slope}).select(
        SYMBOL, "_run", F.concat(*parts, F.array("_residual")).alias("row")
    )
    return (
        rows.repartition(SYMBOL, "_run")
        .sortWithinPartitions(SYMBOL)
        .select(SYMBOL, "row")
        .mapInArrow(fc._gram(model.size()), "symbol string, products array<double>")
        .groupBy(SYMBOL)
        .agg(vector_to_array(Summarizer.sum(array_to_vector("products"))).alias("products"))
    )


def _step(model: fc.Model):
    """One damped Gauss-Newton step per row of the state."""
    size = model.size()
    deltas = (np.arange(size) >= 2) & (np.arange(size) < 2 + model.changepoints)
    rest = np.arange(size) >= 2 + model.changepoints
    upper = np.triu_indices(size + 1)

    def cost(theta: np.ndarray, loss: float, n: int) -> float:
        """Minus the log posterior: Laplace changes, normal seasons, the deviation profiled."""
        fit = 0.5 * n * np.log(max(loss, 1e-300))
        return fit + np.abs(theta[deltas]).sum() / model.changepoint_prior + (theta[rest] ** 2).sum() / (2 * model.seasonality_prior**2)

    def solve(theta: np.ndarray, products: np.ndarray, n: int, damping: float) -> np.ndarray:
        m = np.zeros((size + 1, size + 1))
        m[upper] = products
        m = np.triu(m) + np.triu(m, 1).T
        noise = max(m[size, size] / max(n, 1), 1e-12)
        weight = np.zeros(size)
        weight[rest] = 1 / model.seasonality_prior**2
        weight[deltas] = 1 / (model.changepoint_prior * np.maximum(np.abs(theta[deltas]), 1e-6))
        left = m[:size, :size] + noise * np.diag(weight) + damping * np.diag(np.diag(m)[:size])
        return np.linalg.lstsq(left, m[:size, size] - noise * weight * theta, rcond=None)[0]

    def one(row) -> tuple:
        theta, n = np.array(row.theta), row.n
        now = cost(theta, row.products[-1], n)
        first = row.best is None or not len(row.best)
        if first or now <= row.cost + 1e-12 * max(1.0, abs(row.cost)):  # but for rounding
            best, products, damping = theta, np.array(row.products), row.damping / 10
        else:
            best, products, damping, now = np.array(row.best), np.array(row.at_best), max(row.damping, 1e-6) * 10, row.cost
        change = solve(best, products, n, damping if damping > 1e-9 else 0.0)
        small = np.abs(change).max() <= SETTLED * (1 + np.abs(best).max())
        done = bool(small or damping > 1e9)
        return best + change, best, products, now, damping, done

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["theta", "best", "at_best", "cost", "damping", "done"]
        for batch in batches:
            found = [one(r) for r in batch.itertuples()]
            kept = batch.drop(columns=["products", *names])
            yield kept.assign(rounds=batch["rounds"] + 1, **{c: [f[i] for f in found] for i, c in enumerate(names)})

    return run


_STATE = (
    "symbol string, n long, _start double, _length double, train_end timestamp_ntz, y_scale double, theta array<double>, "
    "best array<double>, at_best array<double>, cost double, damping double, rounds int, done boolean"
)


def start(rows: DataFrame, ranges: DataFrame, model: fc.Model = fc.Model()) -> DataFrame:
    """The state before the first round."""
    others = [F.lit(0.0)] * (model.size() - 2)
    none = F.lit(None)
    return ranges.join(_first_line(rows), SYMBOL).select(
        SYMBOL,
        "n",
        "_start",
        "_length",
        "train_end",
        "y_scale",
        F.array("level", "slope", *others).alias("theta"),
        none.cast("array<double>").alias("best"),
        none.cast("array<double>").alias("at_best"),
        none.cast("double").alias("cost"),
        F.lit(0.0).alias("damping"),
        F.lit(0).alias("rounds"),
        F.lit(False).alias("done"),
    )


def improved(rows: DataFrame, state: DataFrame, model: fc.Model = fc.Model()) -> DataFrame:
    """The state after one more round of the symbols that are not done."""
    live = state.where("not done")
    columns = [c.split()[0] for c in _STATE.split(", ")]
    stepped = live.join(_products(rows, live, model), SYMBOL).select(*columns, "products").mapInPandas(_step(model), _STATE)
    return stepped.unionByName(state.where("done"))


def fit(training: DataFrame, model: fc.Model = fc.Model(), rounds: int = ROUNDS) -> DataFrame:
    """The coefficient table, with the columns of :func:`forecast.fit`, rounds and converged.

    training: symbol, ds, y, cap and floor (see :func:`prepare`)."""
    rows, ranges = placed_rows(training, model)
    state = staged(start(rows, ranges, model), "growth")
    for _ in range(rounds):
        state = staged(improved(rows, state, model), "growth")
        if state.where("not done").isEmpty():
            break
    return state.select(
        SYMBOL,
        "n",
        F.col("_start").alias("start_day"),
        F.col("_length").alias("days"),
        "train_end",
        "y_scale",
        F.col("best").alias("coefficients"),
        F.sqrt(F.greatest(F.element_at("at_best", -1), F.lit(0.0)) / F.col("n")).alias("sigma"),
        "rounds",
        F.col("done").alias("converged"),
    )


def predict(frame: DataFrame, fitted: DataFrame, model: fc.Model = fc.Model()) -> DataFrame:
    """(symbol, ds, yhat, yhat_lower, yhat_upper, train_end) for rows with cap and floor.

    The deviation of trend changes to come passes through the slope of the curve, so the
    interval closes again where the curve saturates."""
    coefficients = fitted.withColumnsRenamed({"start_day": "_start", "days": "_length"})
    joined = spread_join(frame, coefficients, [SYMBOL], "ds")
    room = (F.col("cap") - F.col("floor")) / F.col("y_scale")
    value, slope = _curve(model, room, F.col("coefficients"))
    ahead = fc.trend_variance(F.slice("coefficients", 3, model.changepoints), fc._ahead(), model)
    reach = F.sqrt(F.col("sigma") * F.col("sigma") + slope * slope * ahead) * F.col("y_scale") * fc.INTERVAL_80
    named = joined.select(
        SYMBOL, "ds", (value * F.col("y_scale") + F.col("floor")).alias("yhat"), reach.alias("_reach"), "train_end"
    )
    return named.select(
        SYMBOL, "ds", "yhat", (F.col("yhat") - F.col("_reach")).alias("yhat_lower"),
        (F.col("yhat") + F.col("_reach")).alias("yhat_upper"), "train_end",
    )
