"""Small text helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that one numpy step works on; it bounds a task's memory, not its result.
STEP_CHARS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """The UTF-8 words of a text: runs without space, tab, line feed, \\v, \\f and \\r."""
    return text.encode().split() if text else []


def in_slices(texts: list[str | None], chars: int = STEP_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(index of the first, texts) in slices of about so many characters; null is empty."""
    start, held, size = 0, [], 0
    for i, text in enumerate(texts):
        held.append(text or "")
        size += len(held[-1])
        if size >= chars:
            yield start, held
            start, held, size = i + 1, [], 0
    if held:
        yield start, held


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All code points one after the other, and where each text starts and ends."""
    joined = "".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    return codes, ends - [len(t) for t in texts], ends


# Odd multipliers of the rolling hash, one per place in an n-gram.
_PLACES = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1, 0xD3A2646D)


def ngram_buckets(codes: np.ndarray, n: int, bits: int) -> np.ndarray:
    """A bucket for the n-gram that starts at each place; empty when there are fewer than n."""
    count = len(codes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint32)
    h = np.full(count, n * 0x7FEB352D & 0xFFFFFFFF, dtype=np.uint32)
    for k in range(n):
        h += codes[k : k + count] * np.uint32(_PLACES[k])
        h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(13)
    return h >> np.uint32(32 - bits)


def span_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of values[start:end) in integers, so that equal spans have equal sums."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    ends = np.minimum(ends, len(values))
    return np.where(ends > starts, total[np.maximum(ends, 0)] - total[np.minimum(starts, len(values))], 0)


def sample_share(rows: int, bound: int) -> float:
    """The share of rows to take so that about ``bound`` remain."""
    return min(1.0, bound / max(rows, 1))


def in_share(column: str, share: float):
    """True for a fixed share of the values of a column, chosen by their hash."""
    return F.pmod(F.xxhash64(F.lit(7), F.col(column)), F.lit(1 << 30)) < int(share * (1 << 30))


def spare_name(frame: DataFrame, wanted: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in frame.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted

