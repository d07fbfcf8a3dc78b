"""Quality rules: fixed counts and a log-likelihood ratio of hashed n-grams.

Two multinomials over hashed character n-grams are counted: the target from trusted
documents, the raw one from every document. A document's ratio is the sum of
log(target / raw) over its n-grams, divided by their number. Every document is held
against one threshold, which is read off the scores of all labelled documents; nothing
is drawn at random, so a document's verdict depends on its text and the tables alone.

Nulls and empty texts have no words, fail the base rules and score 0. Repeated rows and
ties get equal verdicts. Without labels the target equals the raw corpus, all scores
are 0 and only the base rules decide. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleworks.llm.text import code_points, in_share, in_slices, ngram_buckets, sample_share, span_sums, words
from candleworks.session import staged

BITS = 16
NGRAMS = (2, 3, 4)
#: Trusted documents that the target counts, chosen by the hash of their id. All corpus
#: counts and the labels behind the threshold are whole.
MAX_TRUSTED = 200_000
#: Pseudo-counts per bucket.
SMOOTHING = 0.5
#: Scores are kept in units of 1/65536, so that sums are exact in any order.
UNIT = 65536
#: Width of the score bins from which the threshold is chosen.
BIN = 0.01

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_SYMBOLS = tuple("#*$%&|<>")
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


@dataclass(frozen=True)
class QualityModel:
    """ratios: log(target / raw) by bucket, in units of 1/65536. threshold: least score kept."""

    ratios: np.ndarray
    threshold: float


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text."""
    tokens = words(text)
    if not tokens:
        return 0, 0, sum(map(text.count, _SYMBOLS)) if text else 0, 0, 0
    joined = b"".join(tokens)
    chars = len(joined) if joined.isascii() else len(joined.decode())
    symbols = sum(map(text.count, _SYMBOLS))
    lines = [line for line in text.encode().split(b"\n") if line.strip()]
    n = len(tokens)
    repeated = 0
    windows = list(zip(tokens, tokens[1:], tokens[2:]))
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        covered = bytearray(n)
        for i, window in enumerate(windows):
            if times[window] > 1:
                covered[i : i + 3] = b"\1\1\1"
        repeated = sum(covered)
    return n, chars, symbols, len(lines) - len(set(lines)), repeated


def _add_counts(texts: list[str], into: np.ndarray) -> None:
    for _, part in in_slices(texts):
        codes, _, ends = code_points(part)
        for n in NGRAMS:
            buckets = ngram_buckets(codes, n, BITS)
            inside = np.ones(len(buckets), bool)
            for k in range(1, n):  # n-grams that reach into the next text don't count
                cut = ends - k
                inside[cut[(cut >= 0) & (cut < len(buckets))]] = False
            into += np.bincount(buckets[inside], minlength=len(into))


def count_ngrams(documents: DataFrame, trusted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts by bucket over all documents, and over those whose id is in ``trusted``.

    A task sends its counts as 64 short vectors, summed per vector: what is shuffled is
    a fixed amount per task, whatever the texts hold.
    """
    shared = documents.sparkSession.sparkContext.broadcast(trusted)
    size, parts = 1 << BITS, 64

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        raw, target = np.zeros(size, np.int64), np.zeros(size, np.int64)
        known = shared.value
        for batch in batches:
            chosen = batch["doc_id"].isin(known).to_numpy()
            _add_counts(batch["text"][~chosen].tolist(), raw)
            _add_counts(batch["text"][chosen].tolist(), target)
        yield pd.DataFrame(
            {"part": range(parts), "raw": list((raw + target).reshape(parts, -1)), "target": list(target.reshape(parts, -1))}
        )

    def total(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, raw, target in zip(batch["part"], batch["raw"], batch["target"]):
                both = np.stack([raw, target])
                sums[part] = sums[part] + both if part in sums else both
        if sums:
            yield pd.DataFrame(
                {"part": list(sums), "raw": [v[0] for v in sums.values()], "target": [v[1] for v in sums.values()]}
            )

    schema = "part int, raw array<long>, target array<long>"
    per_task = documents.select("doc_id", "text").mapInPandas(count, schema)
    summed = per_task.repartition(F.col("part")).mapInPandas(total, schema)
    raw, target = np.zeros((parts, size // parts), np.int64), np.zeros((parts, size // parts), np.int64)
    for row in summed.toLocalIterator():  # 64 rows of 1,024 numbers
        raw[row["part"]], target[row["part"]] = row["raw"], row["target"]
    return raw.ravel(), target.ravel()


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    if not target.sum():
        return np.zeros(len(raw), np.int64)
    log = [np.log((c + SMOOTHING) / (c.sum() + SMOOTHING * len(c))) for c in (target, raw)]
    return np.round((log[0] - log[1]) * UNIT).astype(np.int64)


def llr_scores(texts: list[str | None], ratios: np.ndarray) -> np.ndarray:
    """The mean log ratio of each text's n-grams; 0 for a text shorter than two characters."""
    out = np.zeros(len(texts))
    for first, part in in_slices(texts):
        codes, starts, ends = code_points(part)
        sums, counts = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
        for n in NGRAMS:
            sums += span_sums(ratios[ngram_buckets(codes, n, BITS)], starts, ends - n + 1)
            counts += np.maximum(ends - n + 1 - starts, 0)
        out[first : first + len(part)] = sums / UNIT / np.maximum(counts, 1)
    return out


def trusted_ids(labels: DataFrame) -> np.ndarray:
    """Ids of trusted documents, at most about MAX_TRUSTED of them."""
    trusted = labels.where("quality = 1 and doc_id is not null").select("doc_id")
    share = sample_share(trusted.count(), MAX_TRUSTED)
    return np.unique(np.array([r[0] for r in trusted.where(in_share("doc_id", share)).collect()], np.int64))


def score(documents: DataFrame, ratios: np.ndarray) -> DataFrame:
    """doc_id, the base counts, base_failed and score of every document."""
    shared = documents.sparkSession.sparkContext.broadcast(ratios)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            counts = pd.DataFrame([base_counts(t) for t in texts], columns=[c.split()[0] for c in BASE.split(", ")])
            counts.insert(0, "doc_id", batch["doc_id"])
            counts["score"] = llr_scores(texts, shared.value)
            yield counts

    kind = documents.schema["doc_id"].dataType.simpleString()
    scored = documents.select("doc_id", "text").mapInPandas(measure, f"doc_id {kind}, {BASE}, score double")
    return scored.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    )


def best_threshold(bins: list[tuple[float, int, int]]) -> float:
    """The cut that best parts good from bad: greatest share kept of good minus of bad.

    bins: (lower edge, good, bad). The cut lies in the middle of the empty space below the
    lowest of the best bins, or below all of them when nothing is to be gained.
    """
    bins = sorted(bins)
    good, bad = sum(b[1] for b in bins), sum(b[2] for b in bins)
    if not good or not bad:
        return float("-inf")
    best, cut, g, b, below = 0.0, float("-inf"), 0, 0, None
    for edge, more_good, more_bad in bins:
        gain = (good - g) / good - (bad - b) / bad
        if below is not None and gain > best + 1e-12:
            best, cut = gain, (below + BIN + edge) / 2
        g, b, below = g + more_good, b + more_bad, edge
    return cut


def threshold(scored: DataFrame, labels: DataFrame) -> float:
    """The best cut over all labelled documents that pass the base rules."""
    edge = F.floor(F.col("score") / BIN) * BIN
    joined = scored.where("not base_failed").join(labels.select("doc_id", "quality"), "doc_id")
    bins = joined.groupBy(edge.alias("edge")).agg(
        F.sum((F.col("quality") == 1).cast("long")), F.sum((F.col("quality") == 0).cast("long"))
    )
    return best_threshold([(r[0], r[1] or 0, r[2] or 0) for r in bins.collect()])  # at most some 3,000 bins


def judge(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, base counts, base_failed, score and kept of every document."""
    scored = staged(score(documents, log_ratios(*count_ngrams(documents, trusted_ids(labels)))), "quality")
    cut = threshold(scored, labels)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(cut)))


def fit(documents: DataFrame, labels: DataFrame) -> QualityModel:
    """Counts over all documents; the threshold from all labelled ones, as in judge.

    For a stage that passes documents on: their ids don't have to be joined with verdicts.
    """
    ratios = log_ratios(*count_ngrams(documents, trusted_ids(labels)))
    scored = staged(score(documents, ratios).select("doc_id", "base_failed", "score"), "quality-scores")
    return QualityModel(ratios, threshold(scored, labels))


def base_fails(n_words: int, _chars: int, _symbols: int, _lines: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


def keeper(spark, model: QualityModel) -> Callable:
    """A column function from text to the verdict."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def keep(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            rows = batch.tolist()
            passed = np.array([not base_fails(*base_counts(t)) for t in rows], bool)
            yield pd.Series(passed & (llr_scores(rows, shared.value.ratios) >= shared.value.threshold))

    return keep
