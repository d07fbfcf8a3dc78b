"""Technical indicators along each symbol's price series.

Every indicator is a Feature: columns that look at single steps, windows over those
(``rolls``, one stage after the other) and the final values. ``apply_features`` merges the
features asked for, so that they share one sort and no window is computed twice. On frames split with ``split_long`` use a lookback of at least
``needed_lookback(features)`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from candleworks.functions.columns import change, ratio
from candleworks.functions.recursive import memory, with_ema
from candleworks.functions.series import (
    own_rows,
    padded,
    rolling,
    running_sum,
    timeline,
    with_carry,
)

SMA_PERIODS = (5, 10, 20, 50, 200)
EMA_PERIODS = (12, 26)
RETURN_PERIODS = (1, 5, 10)


@dataclass
class Feature:
    """``steps``, ``rolls`` and ``values`` are functions of the window along the series."""

    steps: dict = field(default_factory=dict)
    rolls: list[dict] = field(default_factory=list)
    values: dict = field(default_factory=dict)
    sums: tuple[str, ...] = ()
    ema: dict = field(default_factory=dict)
    signal: tuple[str, float] | None = None
    lookback: int = 0


def _delta(name: str):
    return lambda w: F.col(name) - F.lag(name).over(w)


def _roll(fn, name: str, n: int):
    return lambda w: rolling(fn, name, w, n)


# Longer sums than this are put together from shorter ones.
_LONGEST_DIRECT = 10


def sma(periods: Sequence[int] = SMA_PERIODS) -> Feature:
    """Means of the last n closes.

    Spark adds up a sliding frame anew for every row. A long sum is therefore made of
    equal shorter ones: the sum of 200 is four sums of 50, which are five sums of 10.
    A missing close makes every sum over it null.
    """
    needed: dict[int, int | None] = {}
    todo = sorted(set(periods), reverse=True)
    while todo:
        n = todo.pop(0)
        parts = [m for m in range(n // 2, 1, -1) if n % m == 0 and n // m <= _LONGEST_DIRECT]
        known = [m for m in parts if m in periods]
        needed[n] = None if n <= _LONGEST_DIRECT or not parts else (known or parts)[0]
        if needed[n] and needed[n] not in needed:
            todo = sorted({*todo, needed[n]}, reverse=True)

    def depth(n: int) -> int:
        return 0 if needed[n] is None else 1 + depth(needed[n])

    def total(n: int):
        part = needed[n]
        if part is None:
            return _roll(F.sum, "close", n)

        def joined(w: WindowSpec) -> Column:
            sums = F.col(f"_sum_{part}")
            for k in range(1, n // part):
                sums = sums + F.lag(f"_sum_{part}", k * part).over(w)
            return sums

        return joined

    stages = [{} for _ in range(1 + max(depth(n) for n in needed))]
    for n in needed:
        stages[depth(n)][f"_sum_{n}"] = total(n)
    means = {f"sma_{n}": (lambda w, n=n: F.col(f"_sum_{n}") / n) for n in periods}
    return Feature(rolls=stages, values=means, lookback=max(periods) - 1)


def ema(periods: Sequence[int] = EMA_PERIODS) -> Feature:
    return Feature(
        ema={f"ema_{n}": ("close", n) for n in periods}, lookback=max(memory(n) for n in periods)
    )


def rsi(period: int = 14) -> Feature:
    """Simple averages of gains and losses; the first step counts as no change."""

    def part(sign: int):
        step = lambda w: F.coalesce(_delta("close")(w) * sign, F.lit(0.0))
        return lambda w: F.greatest(step(w), F.lit(0.0))

    def value(w: WindowSpec) -> Column:
        gain, loss = F.col("_mean_gain"), F.col("_mean_loss")
        strength = 100 - 100 / (1 + ratio(gain, loss))
        return F.when((loss == 0) & (gain > 0), 100.0).otherwise(strength)

    return Feature(
        steps={"_gain": part(1), "_loss": part(-1)},
        rolls=[
            {"_mean_gain": _roll(F.avg, "_gain", period), "_mean_loss": _roll(F.avg, "_loss", period)}
        ],
        values={"rsi": value},
        lookback=period,
    )


def macd(fast: int = 12, slow: int = 26, signal: int = 9) -> Feature:
    return Feature(
        ema={"_fast": ("close", fast), "_slow": ("close", slow)},
        signal=("macd", signal),
        lookback=memory(max(fast, slow)) + memory(signal),
    )


def roc(period: int = 12) -> Feature:
    def value(w: WindowSpec) -> Column:
        then = F.lag("close", period).over(w)
        return ratio(F.col("close") - then, then) * 100

    return Feature(values={"roc": value}, lookback=period)


def bollinger(period: int = 20, deviations: float = 2) -> Feature:
    def band(side: int):
        return lambda w: F.col("_band_mean") + F.col("_band_std") * (deviations * side)

    return Feature(
        rolls=[
            {
                "_band_mean": _roll(F.avg, "close", period),
                "_band_std": _roll(F.stddev_samp, "close", period),
            }
        ],
        values={
            "bb_middle": lambda w: F.col("_band_mean"),
            "bb_upper": band(1),
            "bb_lower": band(-1),
            "bb_width": lambda w: ratio(band(1)(w) - band(-1)(w), "_band_mean"),
        },
        lookback=period - 1,
    )


def atr(period: int = 14) -> Feature:
    def true_range(w: WindowSpec) -> Column:
        close = F.lag("close").over(w)
        return F.greatest(
            F.col("high") - F.col("low"), F.abs(F.col("high") - close), F.abs(F.col("low") - close)
        )

    return Feature(
        steps={"_range": true_range},
        values={"atr": _roll(F.avg, "_range", period)},
        lookback=period,
    )


def obv() -> Feature:
    def signed(w: WindowSpec) -> Column:
        close, before = F.col("close"), F.lag("close").over(w)
        return F.when(close > before, F.col("volume")).when(close < before, -F.col("volume")).otherwise(0)

    return Feature(steps={"_signed": signed}, values={"obv": "_signed"}, sums=("_signed",), lookback=1)


def vwap() -> Feature:
    def turnover(w: WindowSpec) -> Column:
        return (F.col("high") + F.col("low") + F.col("close")) / 3 * F.col("volume")

    return Feature(
        steps={"_turnover": turnover, "_volume": lambda w: F.col("volume")},
        values={"vwap": ("_turnover", "_volume")},
        sums=("_turnover", "_volume"),
    )


def returns(periods: Sequence[int] = RETURN_PERIODS) -> Feature:
    """Percent change over k rows; a null close counts as unchanged."""

    def percent(k: int):
        return lambda w: change("_known", F.lag("_known", k).over(w)) * 100

    return Feature(
        steps={"_known": lambda w: padded("close", w)},
        values={f"return_{k}d": percent(k) for k in periods},
        lookback=max(periods),
    )


def log_return() -> Feature:
    # ln is null for ratios that are not positive.
    return Feature(
        values={"log_return": lambda w: F.ln(ratio("close", F.lag("close").over(w)))}, lookback=1
    )


def trend_strength(period: int = 14) -> Feature:
    def risen(name: str, sign: int):
        def value(w: WindowSpec) -> Column:
            move = (F.col(name) - F.lag(name).over(w)) * sign
            return F.when(move < 0, 0.0).otherwise(move)

        return value

    return Feature(
        steps={"_up": risen("high", 1), "_down": risen("low", -1)},
        values={
            "trend_strength": lambda w: rolling(F.avg, "_up", w, period)
            - rolling(F.avg, "_down", w, period)
        },
        lookback=period,
    )


def all_features(columns: Sequence[str]) -> list[Feature]:
    """Every indicator that the given columns allow."""
    has_range = {"high", "low"} <= set(columns)
    has_volume = "volume" in columns
    chosen = [sma((5, 10, 20, 50)), ema(), rsi(), macd(), roc(), bollinger(), returns(), log_return()]
    if has_range:
        chosen += [atr(), trend_strength()]
    if has_volume:
        chosen.append(obv())
    if has_range and has_volume:
        chosen.append(vwap())
    return chosen


def needed_lookback(features: Sequence[Feature]) -> int:
    return max(f.lookback for f in features)


def _value(frame: DataFrame, spec, w: WindowSpec) -> Column:
    if isinstance(spec, str):
        return running_sum(frame, spec, w)
    if isinstance(spec, tuple):
        return ratio(running_sum(frame, spec[0], w), running_sum(frame, spec[1], w))
    return spec(w)


def apply_features(bars: DataFrame, features: Sequence[Feature]) -> DataFrame:
    """bars plus the columns of all given features."""
    w = timeline(bars)
    steps = {k: fn(w) for f in features for k, fn in f.steps.items()}
    sums = {k: F.col(k) for f in features for k in f.sums}
    frame = bars.withColumns(steps) if steps else bars
    if sums:
        frame = with_carry(frame, sums, F.sum)
    rolled = [k for f in features for stage in f.rolls for k in stage]
    for level in range(max(len(f.rolls) for f in features)):
        stage = [f.rolls[level] for f in features if level < len(f.rolls)]
        frame = frame.withColumns({k: fn(w) for columns in stage for k, fn in columns.items()})
    values = {k: _value(frame, spec, w) for f in features for k, spec in f.values.items()}
    if values:
        frame = frame.withColumns(values)
    averages = {k: spec for f in features for k, spec in f.ema.items()}
    if averages:
        frame = with_ema(frame, averages)
    for f in features:
        if f.signal:
            name, span = f.signal
            frame = frame.withColumn(name, F.col("_fast") - F.col("_slow"))
            frame = with_ema(frame, {f"{name}_signal": (name, span)})
            frame = frame.withColumn(f"{name}_hist", F.col(name) - F.col(f"{name}_signal"))
    helpers = [*steps, *rolled, *[f"_carry_{k}" for k in sums], "_fast", "_slow"]
    return own_rows(frame.drop(*helpers))


def add_all_features(bars: DataFrame) -> DataFrame:
    return apply_features(bars, all_features(bars.columns))
