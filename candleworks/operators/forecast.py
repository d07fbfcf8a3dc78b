"""Trend-and-seasonality forecasts for many symbols in one job.

The model is additive (Taylor & Letham, "Forecasting at Scale", 2018): a piecewise
linear trend, Fourier terms for the seasons, optional regressors. It is fitted as a
penalised least-squares problem; without changes, seasons and priors that is ordinary
least squares. Spark builds the design vectors, every task adds up their products per
symbol, and the sums of all tasks are merged by an aggregate, so a fit never needs a
symbol's rows in one place. Only the solving of one small system
per symbol runs as a numpy helper.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candleworks.functions.columns import ratio
from candleworks.functions.joins import spread_join
from candleworks.operators import metrics
from candleworks.operators.relational import forecast_with_actual
from candleworks.schema import DATETIME, SYMBOL

# Half-width of an 80 % interval in standard deviations.
INTERVAL_80 = 1.2816

# Public holidays on fixed dates, by country.
FIXED_HOLIDAYS = {
    "US": {
        "New Year's Day": "01-01",
        "Independence Day": "07-04",
        "Veterans Day": "11-11",
        "Christmas Day": "12-25",
    },
    "BR": {
        "New Year's Day": "01-01",
        "Tiradentes": "04-21",
        "Labour Day": "05-01",
        "Independence Day": "09-07",
        "Our Lady of Aparecida": "10-12",
        "All Souls' Day": "11-02",
        "Republic Day": "11-15",
        "Christmas Day": "12-25",
    },
}


# US holidays on a weekday of a month: month, weekday (Monday is 0), first
# and last day of the month it can fall on.
MOVABLE_US = {
    "Martin Luther King Day": (1, 0, 15, 21),
    "Washington's Birthday": (2, 0, 15, 21),
    "Memorial Day": (5, 0, 25, 31),
    "Labor Day": (9, 0, 1, 7),
    "Columbus Day": (10, 0, 8, 14),
    "Thanksgiving": (11, 3, 22, 28),
}
# Fixed value: first year of Juneteenth, on June 19.
JUNETEENTH_FROM = 2021


@dataclass(frozen=True)
class Model:
    """What is fitted; the defaults are those of the method's reference implementation."""

    changepoints: int = 25
    changepoint_range: float = 0.8
    changepoint_prior: float = 0.05
    seasonality_prior: float = 10.0
    trend_prior: float = 5.0
    yearly: int = 10
    weekly: int = 3
    daily: int = 0
    regressors: tuple[str, ...] = ()

    def seasons(self) -> list[tuple[float, int]]:
        """(period in days, Fourier order)"""
        every = [(365.25, self.yearly), (7.0, self.weekly), (1.0, self.daily)]
        return [(days, order) for days, order in every if order]

    def knots(self) -> list[float]:
        n = self.changepoints
        return [self.changepoint_range * (i + 1) / n for i in range(n)]

    def size(self) -> int:
        return 2 + self.changepoints + 2 * sum(o for _, o in self.seasons()) + len(self.regressors)


def prepare(bars: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(symbol, ds, y, ...): the training frame without nulls."""
    return bars.select(
        SYMBOL, F.col(DATETIME).alias("ds"), F.col("close").alias("y"), *keep
    ).na.drop()


def with_holidays(frame: DataFrame, country: str, date_column: str = DATETIME) -> DataFrame:
    """Add a 0/1 column per fixed-date holiday of the country (see holiday_columns)."""
    day = F.date_format(date_column, "MM-dd")
    dates = zip(holiday_columns(country), FIXED_HOLIDAYS[country].values())
    return frame.withColumns({name: (day == date).cast("double") for name, date in dates})


def us_holidays(dates: DataFrame) -> DataFrame:
    """(date, holiday): the US federal holidays among the values of a ``date`` column."""
    d = F.col("date")
    fixed = [F.when(F.date_format(d, "MM-dd") == day, F.lit(name)) for name, day in FIXED_HOLIDAYS["US"].items()]
    movable = [
        F.when((F.month(d) == m) & (F.weekday(d) == w) & F.dayofmonth(d).between(a, b), F.lit(name))
        for name, (m, w, a, b) in MOVABLE_US.items()
    ]
    june = F.when((F.date_format(d, "MM-dd") == "06-19") & (F.year(d) >= JUNETEENTH_FROM), F.lit("Juneteenth"))
    named = F.explode(F.array_compact(F.array(*fixed, *movable, june)))
    return dates.select("date").distinct().select("date", named.alias("holiday"))


def us_holiday_names() -> list[str]:
    return [*FIXED_HOLIDAYS["US"], *MOVABLE_US, "Juneteenth"]


def with_holiday_table(frame: DataFrame, holidays: DataFrame, names: Sequence[str]) -> DataFrame:
    """The same for movable holidays, from a table (date, holiday) with the given names."""
    wide = holidays.groupBy("date").pivot("holiday", list(names)).agg(F.max(F.lit(1.0)))
    return spread_join(frame, wide, ["date"], SYMBOL, "left").na.fill(0.0, list(names))


def holiday_columns(country: str) -> list[str]:
    names = FIXED_HOLIDAYS[country]
    return ["holiday_" + "".join(c if c.isalnum() else "_" for c in n).lower() for n in names]


def _days(ts: str) -> Column:
    """Days since 1970 with their fraction, free of time zones."""
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return F.datediff(F.col(ts).cast("date"), F.lit("1970-01-01").cast("date")) + seconds / 86400.0


def _design(model: Model) -> Column:
    """The design vector of a row that has ds, _start and _length (days)."""
    day = _days("ds")
    t = F.coalesce(ratio(day - F.col("_start"), "_length"), F.lit(0.0))
    terms = [F.lit(1.0), t]
    terms += [F.greatest(t - knot, F.lit(0.0)) for knot in model.knots()]
    for period, order in model.seasons():
        for k in range(1, order + 1):
            angle = day * (2 * math.pi * k / period)
            terms += [F.sin(angle), F.cos(angle)]
    terms += [F.col(r).cast("double") for r in model.regressors]
    return F.array(*terms)


#: Rows whose products are added up in one task before they are sent on.
GRAM_ROWS = 65_536


def _gram(size: int):
    """Sums of products of (design, y) per run of rows of a symbol, as upper triangles.

    The rows come sorted by symbol: a task holds one matrix, whatever it meets.
    """
    width = size + 1
    upper = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total = None, None
        for batch in batches:
            rows = batch.column("row").flatten().to_numpy().reshape(-1, width)
            coded = batch.column("symbol").dictionary_encode()
            names, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
            done: list[tuple[str, np.ndarray]] = []
            for first, end in zip(cuts, cuts[1:]):
                if first == end:
                    continue
                symbol, part = names[codes[first]], rows[first:end].T @ rows[first:end]
                if symbol == current:
                    total = total + part
                    continue
                if current is not None:
                    done.append((current, total[upper]))
                current, total = symbol, part
            if done:
                yield _triangles(done)
        if current is not None:
            yield _triangles([(current, total[upper])])

    return run


def _triangles(rows: list[tuple[str, np.ndarray]]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.list_(pa.float64()))
    columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, names=["symbol", "products"])


def _solve(model: Model):
    size = model.size()
    trend = np.arange(size) < 2
    deltas = (np.arange(size) >= 2) & (np.arange(size) < 2 + model.changepoints)
    upper = np.triu_indices(size + 1)

    def one(products: np.ndarray, n: int) -> tuple[np.ndarray, float]:
        m = np.zeros((size + 1, size + 1))
        m[upper] = products
        m = np.triu(m) + np.triu(m, 1).T
        xx, xy, yy = m[:size, :size], m[:size, size], m[size, size]
        beta = np.zeros(size)
        noise = max(yy / max(n, 1), 1e-12)
        # The trend changes have a Laplace prior, which is reweighted to a ridge.
        weight = np.full(size, 1 / model.seasonality_prior**2)
        weight[trend] = 1 / model.trend_prior**2
        for _ in range(20):
            size_now = np.maximum(np.abs(beta[deltas]), 1e-6) if beta.any() else model.changepoint_prior
            weight[deltas] = 1 / (model.changepoint_prior * size_now)
            new = np.linalg.lstsq(xx + noise * np.diag(weight), xy, rcond=None)[0]
            rest = yy - 2 * new @ xy + new @ xx @ new
            noise = max(rest / max(n, 1), 1e-12)
            done = np.allclose(new, beta, rtol=1e-6, atol=1e-9)
            beta = new
            if done:
                break
        return beta, math.sqrt(noise)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            solved = [one(p, n) for p, n in zip(batch["products"], batch["n"])]
            yield batch.drop(columns="products").assign(
                coefficients=[b for b, _ in solved], sigma=[s for _, s in solved]
            )

    return run


def fit(training: DataFrame, model: Model = Model()) -> DataFrame:
    """The coefficient table: one row per symbol.

    ``training`` comes from :func:`prepare`. Columns: symbol, n, start_day, days,
    train_end, y_scale, coefficients, sigma (in units of y_scale).
    """
    ranges = training.groupBy(SYMBOL).agg(
        F.count("*").alias("n"),
        F.min(_days("ds")).alias("_start"),
        (F.max(_days("ds")) - F.min(_days("ds"))).alias("_length"),
        F.max("ds").alias("train_end"),
        F.max(F.abs("y")).alias("y_scale"),
    )
    scaled = F.coalesce(ratio("y", "y_scale"), F.lit(0.0))
    # Short rows are shuffled and not their products: a symbol's rows meet in runs of
    # GRAM_ROWS, however many symbols there are, and a long series is spread over tasks.
    run = F.pmod(F.xxhash64("ds"), F.ceil(F.col("n") / GRAM_ROWS))
    joined = training.join(ranges.drop("train_end"), SYMBOL).withColumn("_run", run)
    rows = joined.repartition(SYMBOL, "_run").sortWithinPartitions(SYMBOL).select(
        SYMBOL, F.concat(_design(model), F.array(scaled)).alias("row")
    )
    sums = (
        rows.mapInArrow(_gram(model.size()), "symbol string, products array<double>")
        .groupBy(SYMBOL)
        .agg(vector_to_array(Summarizer.sum(array_to_vector("products"))).alias("products"))
    )
    return (
        ranges.join(sums, SYMBOL)
        .select(
            SYMBOL,
            "n",
            F.col("_start").alias("start_day"),
            F.col("_length").alias("days"),
            "train_end",
            "y_scale",
            "products",
        )
        .mapInPandas(
            _solve(model),
            "symbol string, n long, start_day double, days double, train_end timestamp_ntz, "
            "y_scale double, coefficients array<double>, sigma double",
        )
    )


_STEP_DAYS = {"D": "1 day", "W": "7 days", "H": "1 hour"}


def future_frame(
    training: DataFrame, periods: int = 30, freq: str = "D", include_history: bool = True
) -> DataFrame:
    """(symbol, ds): ``periods`` steps after each symbol's last row, with history or without."""
    step = F.expr(f"interval {_STEP_DAYS[freq]}")
    last = training.groupBy(SYMBOL).agg(F.max("ds").alias("_last"))
    # Without history the first step is always one day ahead.
    first = F.col("_last") + (step if include_history else F.expr("interval 1 day"))
    ahead = last.select(
        SYMBOL, F.explode(F.sequence(first, first + step * (periods - 1), step)).alias("ds")
    )
    return training.select(SYMBOL, "ds").unionByName(ahead) if include_history else ahead


def _ahead() -> Column:
    """How far a row lies behind the training data, in lengths of it; 0 within."""
    return F.greatest(F.coalesce(ratio(_days("ds") - F.col("_start"), "_length"), F.lit(0.0)) - 1, F.lit(0.0))


def trend_variance(changes: Column, ahead: Column, model: Model) -> Column:
    """Variance of the trend from changes that may come after the training data.

    They come as often as the model's changes did, as a Poisson process of rate S, with
    Laplace sizes of the scale of the fitted ones. A change at s adds delta (h - s) at
    horizon h, so the variance is S 2 scale^2 times the integral of (h - s)^2: in closed
    form 2/3 S scale^2 h^3, and no path is drawn.
    """
    if not model.changepoints:
        return F.lit(0.0)
    scale = F.aggregate(changes, F.lit(0.0), lambda a, d: a + F.abs(d)) / model.changepoints
    rate = model.changepoints / model.changepoint_range
    return scale * scale * ahead * ahead * ahead * (2.0 / 3.0 * rate)


def predict(frame: DataFrame, fitted: DataFrame, model: Model = Model()) -> DataFrame:
    """(symbol, ds, yhat, yhat_lower, yhat_upper) for the rows of ``frame``.

    The interval holds the residual deviation and, beyond the last training row, that of
    trend changes to come (see :func:`trend_variance`), which grows with the horizon.
    """
    coefficients = fitted.withColumnsRenamed({"start_day": "_start", "days": "_length"})
    joined = spread_join(frame, coefficients, [SYMBOL], "ds")
    products = F.zip_with(_design(model), "coefficients", lambda x, b: x * b)
    fit_value = F.aggregate(products, F.lit(0.0), lambda a, x: a + x) * F.col("y_scale")
    changes = F.slice("coefficients", 3, model.changepoints)
    spread = F.sqrt(F.col("sigma") * F.col("sigma") + trend_variance(changes, _ahead(), model))
    reach = spread * F.col("y_scale") * INTERVAL_80
    return joined.withColumn("yhat", fit_value).select(
        SYMBOL,
        "ds",
        "yhat",
        (F.col("yhat") - reach).alias("yhat_lower"),
        (F.col("yhat") + reach).alias("yhat_upper"),
        "train_end",
    )


def predictions(forecast: DataFrame, future_only: bool = True) -> DataFrame:
    """(symbol, datetime, predicted_price, lower_bound, upper_bound)."""
    rows = forecast.where(F.col("ds") > F.col("train_end")) if future_only else forecast
    return rows.select(
        SYMBOL,
        F.col("ds").alias(DATETIME),
        F.col("yhat").alias("predicted_price"),
        F.col("yhat_lower").alias("lower_bound"),
        F.col("yhat_upper").alias("upper_bound"),
    )


def evaluate(
    test: DataFrame, fitted: DataFrame, model: Model = Model(), name: str = "trend_seasons"
) -> DataFrame:
    """The six accuracy metrics of the model on the dates of ``test`` bars."""
    wanted = prepare(test, model.regressors).drop("y")
    forecast = predictions(predict(wanted, fitted, model), future_only=False)
    pairs = forecast_with_actual(forecast, test).withColumn("model", F.lit(name))
    return metrics.evaluate(pairs)


def changepoints(fitted: DataFrame, model: Model = Model()) -> DataFrame:
    """(symbol, position, datetime, delta, rank): trend changes, rank 1 is the strongest.

    The array of changes is sorted inside its row; nothing is shuffled.
    """
    changes = F.slice("coefficients", 3, model.changepoints)
    knots = F.array(*[F.lit(k) for k in model.knots()])
    at = F.zip_with(
        changes, knots, lambda d, k: F.struct(-F.abs(d), k.alias("knot"), d.alias("delta"))
    )
    rows = fitted.select(
        SYMBOL, "start_day", "days", F.posexplode(F.array_sort(at)).alias("_i", "_c")
    )
    day = F.col("start_day") + F.col("_c.knot") * F.col("days")
    moment = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        F.floor(day).cast("int"),
        F.lit(0),
        F.lit(0),
        ((day - F.floor(day)) * 86400).cast("decimal(18,6)"),
    )
    return rows.select(
        SYMBOL, (F.col("_i") + 1).alias("rank"), moment.alias(DATETIME), F.col("_c.delta").alias("delta")
    )


def save_models(fitted: DataFrame, path: str) -> None:
    fitted.write.mode("overwrite").parquet(path)


def load_models(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)
