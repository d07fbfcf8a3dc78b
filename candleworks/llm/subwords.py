"""Averaged hashed subword embeddings under a linear softmax, trained jointly in numpy.

A text, or a window of it, is the bag of its character n-grams. Each n-gram has a row of
a hashed embedding table; the rows are averaged and a linear softmax reads the average.
Table and softmax are trained together by stochastic gradient descent. Since the mean is
linear, scoring needs one number per bucket and class: embeddings times weights.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from candleworks.llm.text import code_points, ngram_buckets

_SPACE = 32
#: An n-gram holds a small share of its text, so embeddings take longer steps than weights,
#: up to the full step for an n-gram that is all of its text.
EMBEDDING_RATE = 20


def _is_letter() -> np.ndarray:
    out = np.zeros(0x110000, bool)
    out[[c for c in range(0x30000) if chr(c).isalpha()]] = True
    return out


_LETTER: list[np.ndarray] = []


def letters_only(codes: np.ndarray) -> np.ndarray:
    """Code points with everything but letters replaced by a space."""
    if not _LETTER:
        _LETTER.append(_is_letter())
    return np.where(_LETTER[0][codes], codes, np.uint32(_SPACE))


def prepared(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased letters and spaces, a space before and after each text; starts and ends."""
    return _letters([f" {t.lower()} " for t in texts])


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes, starts, ends = code_points(texts)
    return letters_only(codes), starts, ends


@dataclass(frozen=True)
class Bags:
    """Rows of distinct buckets and their shares: row i is columns[offsets[i]:offsets[i + 1]]."""

    columns: np.ndarray
    shares: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def take(self, rows: np.ndarray) -> Bags:
        sizes = (self.offsets[1:] - self.offsets[:-1])[rows]
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(offsets[-1]) + np.repeat(self.offsets[rows] - offsets[:-1], sizes)
        return Bags(self.columns[at], self.shares[at], offsets)


def bags(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, ngrams: tuple[int, ...], bits: int) -> Bags:
    """One bag per span of ``codes``."""
    found = [ngram_buckets(codes, n, bits) for n in ngrams]
    columns, shares = [], []
    for s, e in zip(starts, ends):
        b = np.concatenate([f[s : max(s, e - n + 1)] for f, n in zip(found, ngrams)])
        distinct, times = np.unique(b, return_counts=True)
        columns.append(distinct)
        shares.append((times / max(len(b), 1)).astype(np.float32))
    sizes = [len(c) for c in columns]
    return Bags(
        np.concatenate([*columns, np.zeros(0, np.uint32)]).astype(np.int64),
        np.concatenate([*shares, np.zeros(0, np.float32)]),
        np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
    )


def together(parts: list[Bags]) -> Bags:
    """The rows of several Bags, one after the other."""
    sizes = np.concatenate([np.diff(p.offsets) for p in parts])
    return Bags(
        np.concatenate([p.columns for p in parts]),
        np.concatenate([p.shares for p in parts]),
        np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
    )


class SubwordSoftmax:
    """The trained parameters: embeddings (buckets x width), weights (width x classes), bias."""

    def __init__(self, bits: int, width: int, classes: int, seed: int = 0):
        random = np.random.default_rng(seed)
        self.embeddings = random.normal(0, 1 / width, (1 << bits, width)).astype(np.float32)
        self.weights = random.normal(0, 1 / np.sqrt(width), (width, classes)).astype(np.float32)
        self.bias = np.zeros(classes, np.float32)

    def averages(self, x: Bags) -> np.ndarray:
        rows = self.embeddings[x.columns] * x.shares[:, None]
        # A zero row at the end lets empty bags have a place to start at.
        out = np.add.reduceat(np.vstack([rows, np.zeros((1, rows.shape[1]), np.float32)]), x.offsets[:-1], axis=0)
        out[x.offsets[1:] == x.offsets[:-1]] = 0
        return out

    def logits(self, x: Bags) -> np.ndarray:
        return self.averages(x) @ self.weights + self.bias

    def step(self, x: Bags, classes: np.ndarray, weight: np.ndarray, rate: float) -> None:
        """One descent step on the mean cross entropy of a small batch."""
        average = self.averages(x)
        error = softmax(average @ self.weights + self.bias)
        error[np.arange(len(classes)), classes] -= 1
        error *= weight[:, None]
        back = error @ self.weights.T
        self.weights -= rate * average.T @ error / len(x)
        self.bias -= rate * error.mean(0)
        reach = np.minimum(x.shares * EMBEDDING_RATE, 1)[:, None]
        np.subtract.at(self.embeddings, x.columns, rate * reach * np.repeat(back, np.diff(x.offsets), axis=0))

    def bucket_logits(self) -> np.ndarray:
        """What each bucket adds to each class before the mean is taken."""
        return self.embeddings @ self.weights


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)
