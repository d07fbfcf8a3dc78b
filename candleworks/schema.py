"""The canonical bars table and the constants shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

SYMBOL = "symbol"
DATETIME = "datetime"
SEQ = "ingest_seq"

# The column order of a bars table.
BAR_COLUMNS = [
    "datetime",
    "date",
    "symbol",
    "open",
    "high",
    "low",
    "close",
    "adj_close",
    "volume",
    "currency",
    "exchange",
]
OHLC = ["open", "high", "low", "close"]
PRICES = OHLC + ["adj_close"]

BARS = T.StructType(
    [
        T.StructField("datetime", T.TimestampNTZType()),
        T.StructField("date", T.DateType()),
        T.StructField("symbol", T.StringType()),
        *[T.StructField(name, T.DoubleType()) for name in PRICES],
        T.StructField("volume", T.LongType()),
        T.StructField("currency", T.StringType()),
        T.StructField("exchange", T.StringType()),
        T.StructField("ingest_seq", T.LongType()),
    ]
)

ORIGINAL = "original"
CORRECTED = "corrected"

# A snapshot of a symbol: its history as known in a month.
AS_OF = ["as_of_year", "as_of_month"]
