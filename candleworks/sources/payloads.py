"""Landed provider payloads (one JSON document per row) to bars.

Input frames have ``symbol`` and ``payload`` (text). Payloads are parsed by Spark's
JSON functions row by row; nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candleworks.functions.columns import no_nan
from candleworks.operators.projections import drop_null_prices, to_bars_schema
from candleworks.schema import DATETIME, OHLC, SYMBOL

# Texts by which providers mark series and refusals.
SERIES_MARK = "Time Series"
ERROR_FIELD = "Error Message"
NOTICE_FIELD = "Information"
CALL_LIMIT_TEXT = "call frequency"

# Payload interval and the name of its series.
INTERVALS = {"1d": "daily", "1wk": "weekly", "1mo": "monthly"}

_DOCUMENT = "map<string,string>"
_SERIES = "map<string,map<string,string>>"
_VALUES = (
    "struct<status:string,code:string,message:string,values:array<struct<datetime:string,"
    "open:string,high:string,low:string,close:string,volume:string>>>"
)
_QUOTE = (
    "struct<chart:struct<result:array<struct<meta:struct<symbol:string,"
    "regularMarketPrice:double,currency:string>>>>>"
)


def read_payloads(spark, path: str) -> DataFrame:
    """(path, payload) of a folder of JSON documents, one file per document."""
    return spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("path"), F.col("value").alias("payload")
    )


def _series_of(payload: Column) -> Column:
    """The series object (as text) under the first key that names one."""
    document = F.from_json(payload, _DOCUMENT)
    series = F.filter(F.map_entries(document), lambda e: F.contains(e["key"], F.lit(SERIES_MARK)))
    return F.try_element_at(series, F.lit(1))["value"]


def _points(landed: DataFrame) -> DataFrame:
    """One row per point: the landed columns, _date (text) and _fields, an array of
    (name, value) with names without 'N. ' prefixes. A name may occur more than once."""
    kept = [c for c in landed.columns if c != "payload"]
    series = F.from_json(_series_of(F.col("payload")), _SERIES)
    points = landed.select(*kept, F.explode(series).alias("_date", "_raw"))
    plain = lambda e: F.struct(
        F.regexp_replace(e["key"], r"^\d+\. ", "").alias("name"), e["value"].alias("value")
    )
    return points.withColumn("_fields", F.transform(F.map_entries("_raw"), plain)).drop("_raw")


def _named(field: str) -> Column:
    return F.filter("_fields", lambda e: e["name"] == field)


def _number(field: str) -> Column:
    """The first field of that name as a double; empty or bad text is null."""
    return no_nan(F.try_element_at(_named(field), F.lit(1))["value"].try_cast("double"))


def _volume(number: Column) -> Column:
    """A whole volume: 0 where there is none, null where it is too large."""
    return F.when(number.isNull(), F.lit(0)).otherwise(number.try_cast("bigint"))


def timeseries_bars(landed: DataFrame) -> DataFrame:
    """Series documents to bars; points of unknown shape are skipped.

    A series without a recognised point gives no rows here and shows up in
    :func:`payload_errors`.
    """
    kept = [c for c in landed.columns if c not in ("payload", SYMBOL)]
    known = F.size(_named("open")) > 0
    rows = (
        _points(landed)
        .where(known)
        .select(
            F.col("_date").try_cast("timestamp_ntz").alias(DATETIME),
            SYMBOL,
            *[_number(c).alias(c) for c in OHLC],
            _number("adjusted close").alias("adj_close"),
            _volume(_number("volume")).alias("volume"),
            *kept,
        )
    )
    return drop_null_prices(to_bars_schema(rows))


def timeseries_generic(landed: DataFrame) -> DataFrame:
    """Series documents to (symbol, datetime, date, OHLC, volume) without further checks."""
    return _points(landed).select(
        SYMBOL,
        F.col("_date").try_cast("timestamp_ntz").alias(DATETIME),
        F.col("_date").try_cast("date").alias("date"),
        *[_number(c).alias(c) for c in [*OHLC, "volume"]],
    )


def values_bars(landed: DataFrame) -> DataFrame:
    """'values' documents to bars; bad numbers become null, a missing volume 0."""
    number = lambda c: no_nan(F.col(c).try_cast("double"))
    parsed = F.from_json("payload", _VALUES)
    rows = landed.select(SYMBOL, F.inline(parsed["values"]))
    return to_bars_schema(
        rows.select(
            F.col("datetime").try_cast("timestamp_ntz").alias(DATETIME),
            SYMBOL,
            *[number(c).alias(c) for c in OHLC],
            _volume(number("volume")).alias("volume"),
        )
    )


def interval_bars(landed: DataFrame, interval: str) -> DataFrame:
    """Bars of the payloads landed for one interval (column ``interval``)."""
    if interval not in INTERVALS:
        raise ValueError(f"interval must be one of {sorted(INTERVALS)}")
    return timeseries_bars(landed.where(F.col("interval") == interval).drop("interval"))


def quotes(landed: DataFrame) -> DataFrame:
    """(symbol, price, currency) from quote documents."""
    meta = F.from_json("payload", _QUOTE)["chart"]["result"][0]["meta"]
    return landed.select(
        meta["symbol"].alias(SYMBOL),
        meta["regularMarketPrice"].alias("price"),
        meta["currency"].alias("currency"),
    ).where(F.col(SYMBOL).isNotNull())


def classify(landed: DataFrame) -> DataFrame:
    """landed plus ``status``: ok, provider_error, rate_limited, no_series or not_json."""
    document = F.from_json("payload", _DOCUMENT)
    field = lambda name: F.try_element_at("_doc", F.lit(name))
    series = _series_of(F.col("payload"))
    filled = (series.isNotNull() & (series != "{}")) | (
        field("values").isNotNull() & (field("values") != "[]")
    )
    status = (
        F.when(F.col("_doc").isNull(), "not_json")
        .when(field(ERROR_FIELD).isNotNull() | (field("status") == "error"), "provider_error")
        .when(F.contains(F.lower(field(NOTICE_FIELD)), F.lit(CALL_LIMIT_TEXT)), "rate_limited")
        .when(filled | field("chart").isNotNull(), "ok")
        .otherwise("no_series")
    )
    return landed.withColumn("_doc", document).withColumn("status", status).drop("_doc")


def payload_errors(landed: DataFrame) -> DataFrame:
    """(symbol, status, detail) of the documents that hold no data."""
    document = F.from_json("payload", _DOCUMENT)
    texts = [F.try_element_at(document, F.lit(c)) for c in (ERROR_FIELD, NOTICE_FIELD, "message")]
    bad = classify(landed).where(F.col("status") != "ok")
    return bad.select(SYMBOL, "status", F.coalesce(*texts).alias("detail"))


def point_errors(landed: DataFrame) -> DataFrame:
    """(symbol, date_text, detail) of the points that parsed in part only.

    None of them stops a run: of repeated names the first counts, a date that is none and
    a volume beyond 64 bits become null.
    """
    number = _number("volume")
    details = F.array_compact(
        F.array(
            F.when(F.size(F.array_distinct(F.transform("_fields", lambda e: e["name"]))) < F.size("_fields"), "repeated_name"),
            F.when(F.col("_date").try_cast("timestamp_ntz").isNull(), "bad_date"),
            F.when(number.isNotNull() & number.try_cast("bigint").isNull(), "volume_overflow"),
        )
    )
    return _points(landed).select(SYMBOL, F.col("_date").alias("date_text"), F.explode(details).alias("detail"))


# --- rendering -------------------------------------------------------------


def render_series(bars: DataFrame, by: Column | None = None, name: str = "Time Series (Daily)") -> DataFrame:
    """Bars back to series documents, one per symbol and value of ``by``.

    Used to land test payloads. ``by`` keeps documents small: one per year, for example.
    """
    text = lambda c: F.col(c).cast("string")
    point = F.create_map(
        *[
            part
            for label, c in (
                ("1. open", "open"),
                ("2. high", "high"),
                ("3. low", "low"),
                ("4. close", "close"),
                ("5. volume", "volume"),
            )
            for part in (F.lit(label), text(c))
        ]
    )
    entry = F.struct(F.date_format("date", "yyyy-MM-dd").alias("key"), point.alias("value"))
    part = F.lit(0) if by is None else by
    documents = bars.groupBy(SYMBOL, part.alias("part")).agg(F.collect_list(entry).alias("_e"))
    series = F.map_from_entries("_e")
    meta = F.create_map(F.lit("2. Symbol"), F.col(SYMBOL))
    return documents.select(
        SYMBOL,
        "part",
        F.concat(
            F.lit('{"Meta Data":'), F.to_json(meta), F.lit(f',"{name}":'), F.to_json(series), F.lit("}")
        ).alias("payload"),
    )


def render_values(bars: DataFrame, by: Column | None = None) -> DataFrame:
    """Bars to 'values' documents (all numbers as text)."""
    point = F.struct(
        F.date_format("date", "yyyy-MM-dd").alias("datetime"),
        *[F.col(c).cast("string").alias(c) for c in [*OHLC, "volume"]],
    )
    part = F.lit(0) if by is None else by
    documents = bars.groupBy(SYMBOL, part.alias("part")).agg(F.collect_list(point).alias("values"))
    return documents.select(
        SYMBOL, "part", F.to_json(F.struct(F.lit("ok").alias("status"), "values")).alias("payload")
    )


def render_quotes(latest: DataFrame) -> DataFrame:
    """(symbol, price, currency) to quote documents."""
    meta = F.struct(
        F.col(SYMBOL).alias("symbol"), F.col("price").alias("regularMarketPrice"), "currency"
    )
    result = F.struct(F.array(F.struct(meta.alias("meta"))).alias("result"))
    return latest.select(SYMBOL, F.to_json(F.struct(result.alias("chart"))).alias("payload"))
