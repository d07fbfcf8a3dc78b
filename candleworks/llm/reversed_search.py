"""Ranked lexical search the other way round: documents stream past an index of the items.

The items (queries) are indexed by term. Every task sends the term counts of its documents
through that index and keeps a heap of the best documents per item; the heaps of all tasks
are merged, first in groups of tasks and then per item. No list of postings over the
documents is built, and what a task holds depends on the items alone.

Two scans of the documents: the first counts documents, terms and the document frequency of
the items' terms, the second scores. The items are taken in blocks of bounded size (rows and
characters), each with its own two scans, so that the index that is broadcast never outgrows
its bound however many items there are.

Terms are the maximal runs of ASCII letters, digits and code points beyond ASCII, of the whole
text, only A-Z lower-cased. A term's weight is floor(1000 ln((2N+2)/(2df+1))); a document of n
terms has m = 75 + (25 n N) div L, and scores w * ((10^9 tf) div (1000 tf + 12 m)) per term of
the item, repeats included, in 64-bit integers.

Null and empty texts have no terms: such documents are never returned, and such items have no
rows. Ties are ranked by ascending doc_id, rows without an id last. Repeated documents are
ranked each; repeated items get a list each. Empty tables give an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candleworks.llm.text import in_slices
from candleworks.session import staged

TOP = 20
#: Bounds of one block of items.
BLOCK_ITEMS, BLOCK_CHARS = 2_000, 4_000_000
#: Scores and postings that one numpy step works on.
STEP = 1 << 21
#: Tasks whose heaps are merged before the last merge.
GROUPS = 64

# A-Z to a-z; every other ASCII character that is neither a letter nor a digit to a space.
_PLAIN = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: str | None) -> list[bytes]:
    return text.encode().translate(_PLAIN).split() if text else []


@dataclass(frozen=True)
class Index:
    """Postings of a block of items: those of term t are at starts[t]:starts[t + 1]."""

    number: dict[bytes, int]
    starts: np.ndarray
    items: np.ndarray
    times: np.ndarray
    ids: list

    @staticmethod
    def of(rows: list[tuple]) -> Index:
        """rows: (item_id, text)"""
        number: dict[bytes, int] = {}
        found = []
        for item, (_, text) in enumerate(rows):
            for term, times in Counter(terms(text)).items():
                found.append((number.setdefault(term, len(number)), item, times))
        found.sort()
        table = np.array(found, np.int64).reshape(-1, 3)
        starts = np.searchsorted(table[:, 0], np.arange(len(number) + 1))
        return Index(number, starts, table[:, 1].copy(), table[:, 2].copy(), [r[0] for r in rows])


@dataclass(frozen=True)
class Statistics:
    documents: int
    terms: int
    frequency: np.ndarray  # documents that hold a term of the index

    def weights(self) -> np.ndarray:
        n = 2 * self.documents + 2
        return np.array([math.floor(1000 * math.log(n / (2 * int(df) + 1))) for df in self.frequency], np.int64)


def statistics(documents: DataFrame, index: Index) -> Statistics:
    """One scan; tasks send one count per term of the index."""
    shared = documents.sparkSession.sparkContext.broadcast(index)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = shared.value.number
        frequency, rows, total = Counter(), 0, 0
        for batch in batches:
            for text in batch["text"]:
                found = terms(text)
                rows += bool(found)
                total += len(found)
                frequency.update(number.keys() & set(found))
        counts = {number[t]: n for t, n in frequency.items()} | {-1: rows, -2: total}
        yield pd.DataFrame({"term": list(counts), "n": list(counts.values())})

    sums = documents.select("text").mapInPandas(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r["term"]: r["n"] for r in sums.collect()}  # at most the index's terms
    frequency = np.array([found.get(t, 0) for t in range(len(index.number))], np.int64)
    return Statistics(found.get(-1, 0), found.get(-2, 0), frequency)


class _Worst:
    """Orders entries so that the root of a heap is the one to go first."""

    __slots__ = ("key",)

    def __init__(self, score: int, doc):
        self.key = (-score, doc is None, doc)

    def __lt__(self, other: _Worst) -> bool:
        return self.key[:2] > other.key[:2] if self.key[:2] != other.key[:2] or self.key[1] else self.key[2] > other.key[2]


class Heaps:
    """The best ``top`` documents per item."""

    def __init__(self, items: int, top: int):
        self.top, self.held = top, [[] for _ in range(items)]
        self.least = np.ones(items, np.int64)  # the score that a document needs

    def offer(self, docs: list, scores: np.ndarray) -> None:
        """scores: documents by items. Equal scores may still enter by a smaller id."""
        need = self.least
        if len(docs) > self.top:
            need = np.maximum(need, np.partition(scores, -self.top, axis=0)[-self.top])
        for row, item in zip(*(a.tolist() for a in np.nonzero(scores >= need))):
            heap, entry = self.held[item], _Worst(int(scores[row, item]), docs[row])
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.top:
                self.least[item] = -heap[0].key[0]

    def rows(self) -> Iterator[tuple]:
        for item, heap in enumerate(self.held):
            for entry in heap:
                yield item, entry.key[2], -entry.key[0]


def scores(counts: list[tuple[int, dict[int, int]]], index: Index, stats: Statistics, weights: np.ndarray) -> np.ndarray:
    """Documents by items. counts: (terms of the document, times by term of the index)."""
    out = np.zeros((len(counts), len(index.ids)), np.int64)
    rows = np.repeat(np.arange(len(counts)), [len(c) for _, c in counts])
    term = np.fromiter((t for _, c in counts for t in c), np.int64, len(rows))
    tf = np.fromiter((n for _, c in counts for n in c.values()), np.int64, len(rows))
    m = np.array([75 + 25 * n * stats.documents // stats.terms for n, _ in counts], np.int64)
    value = weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[rows]))
    lengths = index.starts[term + 1] - index.starts[term]
    reach = np.cumsum(lengths)
    flat = out.reshape(-1)
    at = 0
    while at < len(term):  # postings of about STEP at once
        end = max(at + 1, int(np.searchsorted(reach, (reach[at - 1] if at else 0) + STEP, side="right")))
        n = lengths[at:end]
        places = np.arange(n.sum()) + np.repeat(index.starts[term[at:end]] - (np.cumsum(n) - n), n)
        np.add.at(flat, np.repeat(rows[at:end], n) * out.shape[1] + index.items[places], np.repeat(value[at:end], n) * index.times[places])
        at = end
    return out


def _best(documents: DataFrame, index: Index, top: int, kind: str) -> DataFrame:
    """item, item_id, part, doc_id and score: the heaps of every task."""
    stats = statistics(documents, index)
    shared = documents.sparkSession.sparkContext.broadcast((index, stats, stats.weights()))
    columns = ["item", "item_id", "part", "doc_id", "score"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, stats, weights = shared.value
        heaps, get = Heaps(len(index.ids), top), index.number.get
        most = max(1, STEP // max(1, len(index.ids)))
        for batch in batches:
            for first, texts in in_slices(batch["text"].tolist()):
                docs, counts = [], []
                for doc, text in zip(batch["doc_id"].iloc[first : first + len(texts)], texts):
                    found = terms(text)
                    times = Counter(map(get, found))
                    times.pop(None, None)
                    if times:
                        docs.append(None if pd.isna(doc) else doc)
                        counts.append((len(found), times))
                for at in range(0, len(docs), most):
                    heaps.offer(docs[at : at + most], scores(counts[at : at + most], index, stats, weights))
        part = TaskContext.get().partitionId()
        rows = [(item, index.ids[item], part, doc, score) for item, doc, score in heaps.rows()]
        if rows:
            yield pd.DataFrame(rows, columns=columns)

    doc_kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInPandas(
        run, f"item long, item_id {kind}, part int, doc_id {doc_kind}, score long"
    )


def search(documents: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id and score: the ``top`` documents of each row of ``items``."""
    kind = items.schema["item_id"].dataType.simpleString()
    numbered = staged(items.select("item_id", "text", F.monotonically_increasing_id().alias("number")), "items")
    rows, chars = numbered.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, math.ceil(rows / BLOCK_ITEMS), math.ceil(chars / BLOCK_CHARS))
    found = None
    for block in range(blocks):
        own = numbered.where(F.pmod(F.xxhash64("number"), F.lit(blocks)) == block).orderBy("number")
        index = Index.of([(r["item_id"], r["text"]) for r in own.collect()])  # one bounded block
        best = _best(documents, index, top, kind).withColumn("block", F.lit(block))
        found = best if found is None else found.unionByName(best)

    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    group = (F.col("part") % GROUPS).alias("group")
    some = Window.partitionBy("block", "item", group).orderBy(*order)
    whole = Window.partitionBy("block", "item").orderBy(*order)
    merged = found.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
    merged = merged.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= top)
    return merged.select("item_id", "rank", "doc_id", "score")
