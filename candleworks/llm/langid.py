"""Language identification by averaged hashed subword embeddings and a linear softmax.

The model is trained on a bounded share of the labelled documents, chosen by the hash of
their id, by stochastic gradient descent in numpy. A part of that sample is held back to
fit a temperature (so that scores are probabilities) and a rejection level: the score
under which less than one in a thousand of the rightly named held-back texts fall.

Null texts and texts without a letter are ``und`` with score 0 and rejected. Equal texts
get equal answers. When no document has a language, every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleworks.llm.subwords import SubwordSoftmax, bags, prepared, softmax
from candleworks.llm.text import in_share, in_slices, ngram_buckets, sample_share, span_sums, spare_name

BITS = 15
WIDTH = 16
NGRAMS = (1, 2, 3)
#: Labelled documents the model is fitted on, at most about so many, and the longest of them.
MAX_TRAINING = 4_000
MAX_TRAINING_CHARS = 20_000
EPOCHS = 8
BATCH = 32
RATE = 0.5
#: Share of the sample held back for calibration.
HELD_BACK = 0.2
#: Share of rightly named held-back texts that may score under the rejection level.
REJECT_SHARE = 0.001
UNKNOWN = "und"
UNIT = 1 << 20


@dataclass(frozen=True)
class LanguageModel:
    """logits: by bucket and language in fixed point, already divided by the temperature."""

    languages: tuple[str, ...]
    logits: np.ndarray
    bias: np.ndarray
    reject_below: float

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        """lang_pred, score and rejected of each text; the whole text counts."""
        names, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
        if self.languages:
            for first, part in in_slices(texts):
                codes, starts, ends = prepared(part)
                letters = span_sums((codes != 32).astype(np.int64), starts, ends)
                sums = np.zeros((len(part), len(self.languages)), np.int64)
                count = np.zeros(len(part), np.int64)
                for n in NGRAMS:
                    buckets = ngram_buckets(codes, n, BITS)
                    count += np.maximum(ends - n + 1 - starts, 0)
                    for k in range(len(self.languages)):
                        sums[:, k] += span_sums(self.logits[k][buckets], starts, ends - n + 1)
                chances = softmax(sums / UNIT / np.maximum(count, 1)[:, None] + self.bias)
                rows = np.flatnonzero(letters) + first
                best = chances.argmax(1)[letters > 0]
                names[rows] = np.array(self.languages, object)[best]
                scores[rows] = chances.max(1)[letters > 0]
        return pd.DataFrame({"lang_pred": names, "score": scores, "rejected": scores < self.reject_below})


def train(texts: list[str], langs: list[str]) -> LanguageModel:
    languages = tuple(sorted(set(langs)))
    if not languages:
        return LanguageModel((), np.zeros((0, 1 << BITS), np.int64), np.zeros(0), 0.5)
    codes, starts, ends = prepared(texts)
    x = bags(codes, starts, ends, NGRAMS, BITS)
    y = np.array([languages.index(v) for v in langs])
    random = np.random.default_rng(0)
    order = random.permutation(len(y))
    back = order[: int(len(y) * HELD_BACK)]
    own = order[len(back) :]
    # Rare languages weigh more, so that the softmax does not lean to the frequent ones.
    weight = (1 / np.sqrt(np.maximum(np.bincount(y[own], minlength=len(languages)), 1))).astype(np.float32)
    weight /= weight[y[own]].mean() if len(own) else 1
    model = SubwordSoftmax(BITS, WIDTH, len(languages))
    for epoch in range(EPOCHS):
        for rows in np.array_split(random.permutation(own), max(1, len(own) // BATCH)):
            model.step(x.take(rows), y[rows], weight[y[rows]], RATE * (1 - epoch / EPOCHS))
    check = back if len(back) else own
    logits = model.logits(x.take(check))
    grid = np.geomspace(0.1, 10, 81)
    loss = [-np.log(softmax(logits / t)[np.arange(len(check)), y[check]] + 1e-12).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    chances = softmax(logits / temperature)
    right = np.sort(chances.max(1)[chances.argmax(1) == y[check]])
    level = float(right[int(len(right) * REJECT_SHARE)]) if len(right) else 0.0
    scaled = np.round(model.bucket_logits().T / temperature * UNIT).astype(np.int64)
    return LanguageModel(languages, scaled, model.bias / temperature, level)


def fit(documents: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> LanguageModel:
    """Trains on about MAX_TRAINING of the documents whose language is known."""
    known = documents.where(
        F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull() & (F.length(text) <= MAX_TRAINING_CHARS)
    )
    share = sample_share(known.count(), MAX_TRAINING)
    sample = known.where(in_share(key, share)).select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l"))
    frame = sample.toPandas().sort_values(["k", "t"])
    return train(frame["t"].tolist(), frame["l"].tolist())


def predictor(spark, model: LanguageModel) -> Callable:
    """A column function from text to struct(lang_pred, score, rejected)."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield shared.value.predict(batch.tolist())

    return predict.asNondeterministic()  # evaluated once, not per field


def identify(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """All columns of documents, and lang_pred, score and rejected in a struct ``language``."""
    name = spare_name(documents, "language")
    return documents.withColumn(name, predictor(documents.sparkSession, model)("text"))
