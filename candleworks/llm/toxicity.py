"""Toxicity by averaged subword-bag embeddings and a linear softmax.

A text is read as overlapping windows of a few words; each window is the bag of its
character n-grams, whose embeddings are averaged and read by a linear softmax. The text
scores by its worst window and the mean of its TOP worst, so a few words count the same in
a short and a long text. Embeddings and softmax are trained jointly in numpy: first on
whole texts, then in rounds on the worst windows of each text. Unseen misspellings share
most of their n-grams, and so their vectors, with the words they come from. A logistic
curve over both margins, fitted on a held-back part of the sample, gives the chance.

Null and empty texts, and texts without letters, score what the curve gives for a margin
below all that were seen, next to 0. Equal texts get equal scores. Without labels every
score is 0. The training sample is bounded; every document is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleworks.llm.subwords import SubwordSoftmax, bags, prepared, together
from candleworks.llm.text import in_share, in_slices, ngram_buckets, sample_share, span_sums

BITS = 17
WIDTH = 12
NGRAMS = (3, 4, 5)
WINDOW, STRIDE = 2, 1
#: Worst windows that count together.
TOP = 3
#: Labelled documents the model is fitted on, at most about so many of either class, and
#: the longest of them.
MAX_TRAINING = 3_000
MAX_TRAINING_CHARS = 12_000
WHOLE_ROUNDS, ROUNDS = 3, 12
BATCH = 32
RATE = 0.5
HELD_BACK = 0.25
THRESHOLD = 0.7
UNIT = 1 << 16
#: The margin of a text without a window.
LOWEST = -30.0


@dataclass(frozen=True)
class ToxicityModel:
    """margins: what each bucket adds to the logit of class 1 over class 0, in fixed point."""

    margins: np.ndarray
    bias: float
    curve: np.ndarray
    known: bool = True

    def worst(self, texts: list[str | None]) -> np.ndarray:
        """The margin of each text's worst window, the mean of its TOP worst, and 1."""
        out = np.full((len(texts), 3), LOWEST)
        out[:, 2] = 1
        for first, part in in_slices(texts):
            codes, starts, ends = prepared(part)
            w_start, w_end, owner = windows(codes, starts, ends)
            if len(owner):
                margin = window_margins(codes, w_start, w_end, self.margins) + self.bias
                order, place = _worst_first(margin, owner)
                text, value = owner[order] + first, margin[order]
                out[text[place == 0], 0] = value[place == 0]
                top = place < TOP
                counts = np.bincount(text[top], minlength=len(texts))
                sums = np.bincount(text[top], value[top], minlength=len(texts))
                has = counts > 0
                out[has, 1] = sums[has] / counts[has]
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not self.known:
            return np.zeros(len(texts))
        z = self.worst(texts) @ self.curve
        return np.round(1 / (1 + np.exp(-np.clip(z, -40, 40))), 9)


def windows(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of each window of WINDOW words, one every STRIDE words.

    A window starts and ends with the space around its words.
    """
    letter = codes != 32
    first = np.flatnonzero(letter[1:] & ~letter[:-1])  # the space before each word
    last = np.flatnonzero(letter[:-1] & ~letter[1:]) + 2  # behind the space after it
    owner = np.searchsorted(ends, first, side="right")
    counts = np.bincount(owner, minlength=len(starts))
    base = np.concatenate([[0], np.cumsum(counts)[:-1]])
    place = np.arange(len(first)) - base[owner]
    at = np.flatnonzero((place % STRIDE == 0) & ((place == 0) | (place + STRIDE < counts[owner])))
    stop = np.minimum(at + WINDOW, base[owner[at]] + counts[owner[at]]) - 1
    return first[at], last[stop], owner[at]


def window_margins(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, margins: np.ndarray) -> np.ndarray:
    sums, counts = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    for n in NGRAMS:
        sums += span_sums(margins[ngram_buckets(codes, n, BITS)], starts, ends - n + 1)
        counts += np.maximum(ends - n + 1 - starts, 0)
    return sums / UNIT / np.maximum(counts, 1)


def _worst_first(margin: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by text and falling margin, and each one's place in its text."""
    order = np.lexsort((-margin, owner))
    sorted_owner = owner[order]
    first = np.flatnonzero(np.append(True, sorted_owner[1:] != sorted_owner[:-1]))
    return order, np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))


def _fixed(model: SubwordSoftmax) -> tuple[np.ndarray, float]:
    both = model.bucket_logits()
    return np.round((both[:, 1] - both[:, 0]) * UNIT).astype(np.int64), float(model.bias[1] - model.bias[0])


def _curve(x: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a logistic curve over the two margins and 1, by Newton steps with a prior.

    Neither margin may count against toxicity; one that would is left out.
    """
    centre, scale = x.mean(0), x.std(0) + 1e-6
    centre[2], scale[2] = 0, 1
    z = (x - centre) / scale
    used = np.ones(3, bool)
    while True:
        w, prior = np.zeros(3), 0.05 * np.eye(used.sum())
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            u = z[:, used]
            h = (u * (weight * p * (1 - p))[:, None]).T @ u + prior
            w[used] += np.linalg.solve(h, u.T @ (weight * (labels - p)) - prior @ w[used])
        wrong = used & (w < 0)
        wrong[2] = False
        if not wrong.any():
            break
        used[np.argmin(np.where(wrong, w, 0))] = False
    out = w / scale
    out[2] = w[2] - (w[:2] * centre[:2] / scale[:2]).sum()
    return out


def train(texts: list[str], labels: list[int], counts: tuple[int, int] | None = None) -> ToxicityModel:
    """counts: how many documents of class 0 and 1 the sample stands for, by default itself."""
    y = np.asarray(labels, np.int64)
    own_counts = np.bincount(y, minlength=2)
    if not own_counts.all():
        return ToxicityModel(np.zeros(1 << BITS, np.int64), 0.0, np.zeros(3), known=False)
    stands_for = (np.asarray(counts or own_counts) / own_counts)[y]
    weight = np.sqrt(own_counts.max() / own_counts)[y].astype(np.float32)
    random = np.random.default_rng(0)
    back = random.random(len(y)) < HELD_BACK
    if len(set(y[~back])) < 2 or len(set(y[back])) < 2:
        back[:] = False
    model = SubwordSoftmax(BITS, WIDTH, 2)

    def steps(x, classes, weights, rate):
        for rows in np.array_split(random.permutation(len(x)), max(1, len(x) // BATCH)):
            model.step(x.take(rows), classes[rows], weights[rows], rate)

    # In slices of the sample, which bound the memory of the n-gram arrays.
    slices = [(np.arange(first, first + len(part)), *prepared(part)) for first, part in in_slices(texts)]
    # First whole texts, so that the windows are not chosen by chance.
    for _ in range(WHOLE_ROUNDS):
        for rows, codes, starts, ends in slices:
            own = ~back[rows]
            steps(bags(codes, starts[own], ends[own], NGRAMS, BITS), y[rows[own]], weight[rows[own]], RATE)
    for turn in range(ROUNDS):
        table, worst, owners = _fixed(model)[0], [], []
        for rows, codes, starts, ends in slices:
            w_start, w_end, owner = windows(codes, starts, ends)
            order, place = _worst_first(window_margins(codes, w_start, w_end, table), owner)
            top = order[(place < TOP) & ~back[rows[owner[order]]]]
            worst.append(bags(codes, w_start[top], w_end[top], NGRAMS, BITS))
            owners.append(rows[owner[top]])
        owner = np.concatenate(owners)
        steps(together(worst), y[owner], weight[owner], RATE * (1 - turn / ROUNDS))
    margins, bias = _fixed(model)
    check = back if back.any() else ~back
    worst = ToxicityModel(margins, bias, np.zeros(3)).worst([t for t, c in zip(texts, check) if c])
    seen = worst[:, 0] > LOWEST
    return ToxicityModel(margins, bias, _curve(worst[seen], y[check][seen], stands_for[check][seen]))


def fit(documents: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Trains on about MAX_TRAINING labelled documents of either class.

    The ids of the sample are broadcast: their number is bounded by the parameter. Of labels
    that contradict each other for one id the more frequent counts, at a tie the toxic one.
    """
    given = labels.where("toxic in (0, 1) and doc_id is not null")
    known = given.groupBy("doc_id").agg((2 * F.sum("toxic") >= F.count("*")).cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    counts = (counts.get(0, 0), counts.get(1, 0))
    taken = [in_share("doc_id", sample_share(n, MAX_TRAINING)) & (F.col("toxic") == k) for k, n in enumerate(counts)]
    chosen = F.broadcast(known.where(taken[0] | taken[1]))
    texts = documents.select("doc_id", "text").where(F.length("text") <= MAX_TRAINING_CHARS)
    frame = texts.join(chosen, "doc_id").toPandas().sort_values(["doc_id", "text"])
    return train(frame["text"].tolist(), frame["toxic"].tolist(), counts)


def scored(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score and predicted of every document."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = shared.value.scores(batch["text"].tolist())
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": scores, "predicted": (scores >= THRESHOLD).astype("int32")})

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, score double, predicted int")
