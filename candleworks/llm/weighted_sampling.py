"""Document fingerprints by consistent weighted sampling.

A document is the multiset of its words, each weighted by its count. For every sample k
and term two gamma(2, 1) values r, c and a uniform b are drawn from a hash of both; with
weight w, t = floor(log(w) / r + b), and the term with the least log(c) - r (t + 1 - b)
is taken together with t. Two documents take the same (term, t) with a probability equal
to their generalised Jaccard similarity (sum of least over sum of greatest weights), so
the share of equal samples estimates it. A sample is kept as 16 bits of a hash.

A document without words has the empty fingerprint, like only to another such one. Equal
texts have equal fingerprints; repeated rows are fingerprinted each.

The text that follows a document in descending order of doc_id is brought next to it by
cutting the ids into ranges: each range is one task's, and the first document of a range
is also sent to the range before. The whole text is shuffled once; nothing but the
bounds of the ranges reaches the driver. Rows without an id come last; rows of equal id follow by text.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candleworks.llm.text import words
from candleworks.session import staged

SAMPLES = 64
#: (term, weight) pairs whose values are remembered, in each of two generations.
REMEMBERED = 1 << 17
#: Pairs drawn at once.
STEP = 2_048


def _mixed(x: np.ndarray) -> np.ndarray:
    out = x >> np.uint64(30)
    out ^= x
    out *= np.uint64(0xBF58476D1CE4E5B9)
    high = out >> np.uint64(27)
    out ^= high
    out *= np.uint64(0x94D049BB133111EB)
    np.right_shift(out, np.uint64(31), out=high)
    out ^= high
    return out


def _upper(x: np.ndarray) -> np.ndarray:
    """A uniform in (0, 1) from the upper half of the bits."""
    out = (x >> np.uint64(32)).astype(np.float64)
    out += 0.5
    out /= 2**32
    return out


def _log_of_two(x: np.ndarray) -> np.ndarray:
    """The log of the product of two uniforms, from the upper and the lower half of the bits."""
    low = (x & np.uint64(0xFFFFFFFF)).astype(np.float64)
    low += 0.5
    low /= 2**32
    low *= _upper(x)
    return np.log(low, out=low)


_KEYS = _mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _steps(seed: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r, b and t of the seeds of (term, sample)."""
    b = _upper(_mixed(seed + np.uint64(0xE7037ED1A0B428DB)))
    r = _log_of_two(_mixed(seed))
    np.negative(r, out=r)
    t = np.log(weights) / r
    t += b
    return r, b, np.floor(t, out=t)


def draw(terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The value to be least, per pair and sample."""
    seed = terms[:, None] ^ _KEYS[None, :]
    r, b, t = _steps(seed, weights[:, None])
    t += 1
    t -= b
    t *= r
    c = _log_of_two(_mixed(seed + np.uint64(0xA0761D6478BD642F)))
    np.negative(c, out=c)
    np.log(c, out=c)
    c -= t
    return c.astype(np.float32)


def marked(terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The 16 bits that stand for (term, t) of the pair that each sample takes."""
    seed = terms ^ _KEYS
    t = _steps(seed, weights)[2]
    taken = t.astype(np.int64).view(np.uint64) * np.uint64(0x8EBC6AF09C88C6E3)
    mark = _mixed(_mixed(seed + np.uint64(0x589965CC75374CC3)) ^ taken) >> np.uint64(48)
    return mark.astype(np.uint16)


#: A word that occurs once, or a word and its count; most are met once, and a plain key is found sooner.
Pair = bytes | tuple[bytes, int]


class Sampler:
    """Fingerprints as arrays of 16-bit samples.

    The values drawn for a pair are kept in a table of fixed size with two generations. When the
    younger one is full, the older one is forgotten and filled anew; pairs that are met again
    move to the younger one, so frequent words stay. Marks are worked out for the pairs taken alone.
    """

    def __init__(self) -> None:
        self.values = np.empty((2 * REMEMBERED, SAMPLES), np.float32)
        self.terms = np.empty(2 * REMEMBERED, np.uint64)
        self.weights = np.empty(2 * REMEMBERED, np.float64)
        self.known: list[dict[Pair, int]] = [{}, {}]
        self.young = 0

    def _rows(self, pairs: list[Pair]) -> np.ndarray:
        """Where the table holds the values of at most STEP pairs."""
        row = self.known[self.young]
        places = list(map(row.get, pairs))
        if None in places:
            missing = [p for p, place in zip(pairs, places) if place is None]
            if len(row) + len(missing) > REMEMBERED:
                self.young ^= 1
                row = self.known[self.young] = {}
                missing = pairs
            self._add(row, missing)
            places = list(map(row.__getitem__, pairs))
        return np.array(places, np.int64)

    def _add(self, row: dict[Pair, int], pairs: list[Pair]) -> None:
        """Pairs the younger generation lacks: from the older one, or drawn."""
        old = self.known[self.young ^ 1]
        met = [p for p in pairs if p in old]
        new = [p for p in pairs if p not in old] if met else pairs
        for some in (met, new):
            if not some:
                continue
            at = self.young * REMEMBERED + len(row)
            here = slice(at, at + len(some))
            if some is met:
                before = np.array([old[p] for p in some], np.int64)
                for kept in (self.values, self.terms, self.weights):
                    kept[here] = kept[before]
            else:
                single = [type(p) is bytes for p in some]
                self.terms[here] = [xxhash.xxh64_intdigest(p if one else p[0]) for p, one in zip(some, single)]
                self.weights[here] = [1 if one else p[1] for p, one in zip(some, single)]
                self.values[here] = draw(self.terms[here], self.weights[here])
            row.update(zip(some, range(at, at + len(some))))

    def sample(self, text: str | None) -> np.ndarray:
        pairs = [w if n == 1 else (w, n) for w, n in Counter(words(text)).items()]
        if not pairs:
            return np.zeros(0, np.uint16)
        best, step = None, min(STEP, REMEMBERED)
        for at in range(0, len(pairs), step):  # bounds the memory of very long texts
            part = self._rows(pairs[at : at + step])
            values = self.values[part]
            least = values.argmin(0)
            taken = part[least]
            v, term, weight = values[least, np.arange(SAMPLES)], self.terms[taken], self.weights[taken]
            if best is None:
                best, terms, weights = v, term, weight
            else:
                better = v < best
                best, terms, weights = (
                    np.where(better, x, y) for x, y in ((v, best), (term, terms), (weight, weights))
                )
        return marked(terms, weights)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal samples; an estimate of the generalised Jaccard similarity."""
    if len(a) != len(b):
        return 0.0
    return float((a == b).mean()) if len(a) else 1.0


def as_text(samples: np.ndarray) -> str:
    return samples.astype(">u2").tobytes().hex()


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sampler = Sampler()
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "fingerprint": [as_text(sampler.sample(t)) for t in batch["text"]]})

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_next(documents: DataFrame, ranges: int) -> DataFrame:
    """The rows of each range in descending order of doc_id, and after them a copy of the
    row that follows (``copy`` is true), which for the last range is the first row of all."""
    cuts = documents.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)] or [0.5], max(10_000, 20 * ranges))).first()[0]
    bounds = np.unique(np.array(cuts or [], np.int64))
    last = len(bounds)

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        out = np.full(len(ids), last, np.int32)
        out[known] = last - np.searchsorted(bounds, ids[known].astype(np.int64).to_numpy(), side="left")
        return pd.Series(out)

    rows = documents.select("doc_id", "text").withColumn("range", place("doc_id"))
    # One row per range: its first id, and the range before it (for the first, the last).
    heads = staged(rows.groupBy("range").agg(F.max("doc_id").alias("head")), "heads")
    end = F.lit(heads.agg(F.max("range")).first()[0]).cast("int")
    before = F.coalesce(F.lag("range").over(Window.orderBy("range")), end)
    heads = F.broadcast(heads.withColumn("before", before))  # bounded by the number of ranges
    own = F.struct(F.col("range").alias("range"), F.lit(False).alias("copy"))
    sent = F.struct(F.col("before").alias("range"), F.lit(True).alias("copy"))
    is_head = F.col("doc_id").eqNullSafe(F.col("head"))
    spread = rows.join(heads, "range").select(
        "doc_id", "text", F.explode(F.when(is_head, F.array(own, sent)).otherwise(F.array(own))).alias("to")
    )
    dealt = spread.select("doc_id", "text", "to.range", "to.copy").repartitionById(last + 1, F.col("range"))
    return dealt.sortWithinPartitions("range", "copy", F.desc_nulls_last("doc_id"), F.asc_nulls_first("text"))


def compared(documents: DataFrame, ranges: int | None = None) -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next one."""
    spark = documents.sparkSession
    ranges = ranges or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    kind = documents.schema["doc_id"].dataType.simpleString()
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sampler = Sampler()
        held, closed = None, None  # the row before, and the range whose copy was seen
        for batch in batches:
            out = []
            for doc, text, place, copy in zip(batch["doc_id"], batch["text"], batch["range"], batch["copy"]):
                if copy and closed == place:
                    continue  # rows of equal id: the first is the one that follows
                doc, text = None if pd.isna(doc) else doc, text or ""
                mark = sampler.sample(text)
                if held is not None:
                    before, old, own = held
                    new = edited(old, text)
                    other = sampler.sample(new)
                    digest = hashlib.sha256(new.encode()).hexdigest()
                    out.append((before, len(old), digest, as_text(own), as_text(other), likeness(own, other), likeness(own, mark)))
                held, closed = (None, place) if copy else ((doc, text, mark), closed)
            if out:
                yield pd.DataFrame(out, columns=columns)

    return with_next(documents, ranges).mapInPandas(
        run,
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
