"""Spelling variants: words one edit apart, found in k-d trees over letter counts.

One inserted or deleted letter changes a word's letter counts by 1 in L1 distance, one
replaced letter by exactly 2. Words of equal length are therefore searched for within
distance 2, words one letter longer within distance 1; what is found is verified letter by
letter. A k-d tree prunes by the distance of a word's counts to a node's box.

The words of every length have a tree whose leaves are cells of bounded size, built on a
bounded sample (MAX_SAMPLE words). A word is stored in one cell and sent to every other cell
of its own length and of the next that its ball reaches, so each cell is a task's small job
that builds a tree of its own and streams the words that were sent. No pair is emitted: a cell
gives each word its number of near words and the best of them, and these are added up.

Words are maximal runs of letters (A-Z, a-z and U+00C0 to U+00FF) with only A-Z lower-cased;
in one (document, run) of 199, chosen by crc32 of ``<doc_id>:<run>``, one letter is deleted.
They are counted with map-side combine; those of LEAST_LENGTH letters and LEAST_COUNT
occurrences are grouped. A word's form is its near word of largest count (ties: the smallest
word) if that is at least RATIO times its own; the root follows forms to the last one by
pointer doubling, which takes few rounds since counts grow along a chain.

Null and empty texts have no words; a null doc_id counts as empty text. Repeated rows count
each. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleworks.llm.text import in_share, sample_share
from candleworks.session import staged

LEAST_LENGTH, LEAST_COUNT, RATIO, DELETED = 6, 5, 5, 199
#: Words that a cell should hold, and words on which the trees are built.
CELL, MAX_SAMPLE = 4_096, 200_000
#: Points in a leaf of a cell's own tree, and queries looked up at once.
LEAF, QUERIES = 64, 4_096
#: Numbers that one numpy step works on.
STEP = 1 << 22
#: Distinct words a task counts before it passes them on.
COUNTED = 300_000

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_DIMENSIONS = 26 + 64


def spellings(doc_id: str, text: str | None) -> Counter:
    """The words of a text of at least LEAST_LENGTH letters, with their counts."""
    found: Counter = Counter()
    if not text:
        return found
    prefix = zlib.crc32(f"{doc_id}:".encode())
    for run, times in Counter(_RUN.findall(text.encode().lower().decode())).items():
        if len(run) < LEAST_LENGTH:
            continue
        h = zlib.crc32(run.encode(), prefix)
        if h % DELETED == 0:
            run = run[: h % len(run)] + run[h % len(run) + 1 :]
        if len(run) >= LEAST_LENGTH:
            found[run] += times
    return found


def word_counts(documents: DataFrame) -> DataFrame:
    """word and n over all documents."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"]):
                held.update(spellings(doc or "", text))
                if len(held) >= COUNTED:
                    yield pd.DataFrame({"word": list(held), "n": list(held.values())})
                    held = Counter()
        if held:
            yield pd.DataFrame({"word": list(held), "n": list(held.values())})

    rows = documents.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return rows.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def letters(words: list[str]) -> np.ndarray:
    """The code points of words of one length, a row per word."""
    joined = "".join(words).encode("utf-32-le")
    return np.frombuffer(joined, np.uint32).reshape(len(words), -1)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    place = np.where(codes < 128, codes - 97, codes - 0xC0 + 26).astype(np.int64)
    out = np.zeros((len(codes), _DIMENSIONS), np.int32)
    rows = np.arange(len(codes))
    for k in range(codes.shape[1]):
        out[rows, place[:, k]] += 1
    return out


class Tree:
    """A k-d tree over rows of counts. Leaves are numbered in order of their making."""

    def __init__(self, points: np.ndarray, leaf: float):
        self.points, self.most = points, leaf
        self.nodes: list[tuple] = []  # (dimension, cut, node up to cut, node above); a leaf is ~number
        self.leaves: list[np.ndarray] = []
        self.root = self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray) -> int:
        part = self.points[rows]
        spread = part.var(0) if len(rows) > self.most else np.zeros(1)
        if not spread.max() > 0:  # small enough, or all points equal
            self.leaves.append(rows)
            return ~(len(self.leaves) - 1)
        dimension = int(spread.argmax())
        values = part[:, dimension]
        cut = int(min(np.floor(np.median(values)), values.max() - 1))
        low, high = self._build(rows[values <= cut]), self._build(rows[values > cut])
        self.nodes.append((dimension, cut, low, high))
        return len(self.nodes) - 1

    def reach(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of the queries whose distance to the leaf's box is at most the radius)"""
        start = np.arange(len(queries)), np.zeros(len(queries), np.int64)
        waiting = [(self.root, *start, {})]
        while waiting:
            node, rows, distance, box = waiting.pop()
            if not len(rows):
                continue
            if node < 0:
                yield ~node, rows
                continue
            dimension, cut, low, high = self.nodes[node]
            x = queries[rows, dimension]
            least, most = box.get(dimension, (0, np.iinfo(np.int32).max))
            # The distance along this dimension is replaced by that to the narrower box.
            below = distance - np.maximum(x - most, 0) + np.maximum(x - cut, 0)
            above = distance - np.maximum(least - x, 0) + np.maximum(cut + 1 - x, 0)
            for child, far, edge in ((low, below, (least, cut)), (high, above, (cut + 1, most))):
                near = far <= radius
                waiting.append((child, rows[near], far[near], {**box, dimension: edge}))

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows of queries, rows of points) at exactly the radius: one replaced letter
        is at 2 and one more letter at 1; nearer ones are permutations of the same letters."""
        for leaf, rows in self.reach(queries, radius):
            own = self.leaves[leaf]
            used = np.flatnonzero(self.points[own].any(0))
            points = self.points[own][:, used]
            size = max(1, STEP // max(1, points.size))
            for at in range(0, len(rows), size):
                some = queries[rows[at : at + size]]
                rest = some.sum(1) - some[:, used].sum(1)
                distance = np.abs(some[:, None, used] - points[None]).sum(2) + rest[:, None]
                a, b = np.nonzero(distance == radius)
                if len(a):
                    yield rows[at + a], own[b]


def replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows that differ in exactly one place."""
    return (a != b).sum(1) == 1


def inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Rows of ``long`` that are those of ``short`` with one more letter."""
    length = short.shape[1]
    places = np.arange(length)
    first = np.where(short != long[:, :-1], places, length).min(1, initial=length)
    last = np.where(short != long[:, 1:], places, -1).max(1, initial=-1)
    return last < first


class _Found:
    """Near words of a batch: their number and the best as (-n, word)."""

    def __init__(self, words: list[str], n: np.ndarray):
        self.words, self.n = words, n
        self.near = np.zeros(len(words), np.int64)
        self.best: list[tuple | None] = [None] * len(words)

    def add(self, rows: np.ndarray, other: _Found, others: np.ndarray) -> None:
        np.add.at(self.near, rows, 1)
        for row, o in zip(rows.tolist(), others.tolist()):
            key = (-int(other.n[o]), other.words[o])
            if self.best[row] is None or key < self.best[row]:
                self.best[row] = key

    def frames(self) -> Iterator[pd.DataFrame]:
        rows = [(w, k, -b[0], b[1]) for w, k, b in zip(self.words, self.near.tolist(), self.best) if b]
        if rows:
            yield pd.DataFrame(rows, columns=["word", "near", "best_n", "best"])


class Cell:
    """The words stored in one cell. ``meet`` finds the near ones of words sent to it."""

    def __init__(self, words: list[str], n: np.ndarray):
        self.found = _Found(words, n)
        self.codes = letters(words)
        self.tree = Tree(letter_counts(self.codes), LEAF)

    def meet(self, words: list[str], n: np.ndarray) -> Iterator[pd.DataFrame]:
        """Results of the words sent; what they are to shorter words' cells is kept in found."""
        for at in range(0, len(words), QUERIES):
            some = words[at : at + QUERIES]
            codes, sent = letters(some), _Found(some, n[at : at + QUERIES])
            same = codes.shape[1] == self.codes.shape[1]
            for rows, points in self.tree.within(letter_counts(codes), 2 if same else 1):
                step = max(1, STEP // self.codes.shape[1])
                for k in range(0, len(rows), step):
                    a, b = rows[k : k + step], points[k : k + step]
                    near = (replaced if same else inserted)(codes[a], self.codes[b])
                    sent.add(a[near], self.found, b[near])
                    if not same:
                        self.found.add(b[near], sent, a[near])
            yield from sent.frames()


def _plan(words: DataFrame) -> dict[int, Tree]:
    """A tree per word length, on a bounded sample; its leaves are that length's cells."""
    total = words.count()
    share = sample_share(total, MAX_SAMPLE)
    sample = sorted(r["word"] for r in words.where(in_share("word", share)).select("word").collect())
    by_length: dict[int, list[str]] = {}
    for word in sample:
        by_length.setdefault(len(word), []).append(word)
    trees = {}
    for length, some in sorted(by_length.items()):
        trees[length] = Tree(letter_counts(letters(some)), max(1.0, CELL * share))
        trees[length].points = None  # the cells are known by their boxes
        trees[length].leaves = [None] * len(trees[length].leaves)
    return trees


def _dealt(words: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """length, cell, role, word and n: every word in its own cell (role 0) and in those of
    its length (1) and of the next length (2) that it may have near words in."""
    shared = words.sparkSession.sparkContext.broadcast(trees)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees = shared.value
        for batch in batches:
            for length, part in batch.groupby(batch["word"].str.len(), sort=True):
                part = part.reset_index(drop=True)
                codes = letters(part["word"].tolist())
                for at in range(0, len(part), QUERIES):
                    counts = letter_counts(codes[at : at + QUERIES])
                    own = np.full(len(counts), -1)
                    # A length that the sample missed is one cell.
                    places = lambda size, radius: trees[size].reach(counts, radius) if size in trees else [(0, np.arange(len(counts)))]  # noqa: E731, B023
                    for cell, rows in places(length, 0):
                        own[rows] = cell
                    for size, radius, role in ((length, 2, 1), (length + 1, 1, 2)):
                        for cell, rows in places(size, radius):
                            chosen = part.iloc[at + rows]
                            home = (own[rows] == cell) if role == 1 else np.zeros(len(rows), bool)
                            yield chosen.assign(length=size, cell=cell, role=np.where(home, 0, role))

    return words.select("word", "n").mapInPandas(deal, "word string, n long, length int, cell int, role int")


def _search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by (length, cell, role, longest first within a role)."""
    current, cell, waiting = None, None, []

    def opened() -> Cell | None:
        if not waiting:
            return None
        rows = pd.concat(waiting)
        return Cell(rows["word"].tolist(), rows["n"].to_numpy())

    for batch in batches:
        for key, part in batch.groupby(["length", "cell", "role"], sort=True):
            if key[:2] != current:
                if waiting:
                    cell, waiting = opened(), []
                    yield from cell.meet(cell.found.words, cell.found.n)
                if cell is not None:
                    yield from cell.found.frames()
                current, cell = key[:2], None
            if key[2] == 0:
                waiting.append(part)
                continue
            if waiting:
                cell, waiting = opened(), []
                yield from cell.meet(cell.found.words, cell.found.n)
            if cell is not None:
                yield from cell.meet(part["word"].tolist(), part["n"].to_numpy())
    if waiting:
        cell = opened()
        yield from cell.meet(cell.found.words, cell.found.n)
    if cell is not None:
        yield from cell.found.frames()


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, best_n and best: the number of near words of each word that has some,
    and the best of them. words: word and n, one row per word."""
    dealt = _dealt(words, _plan(words)).repartition("length", "cell").sortWithinPartitions("length", "cell", "role", "word")
    found = dealt.mapInPandas(_search, "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best")
    )


def roots(forms: DataFrame) -> DataFrame:
    """word and root of (word, form) rows; forms never lead back."""
    at = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = staged(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        at = moved.select("word", "root")
        if moved.where("next is not null").isEmpty():
            return at


def grouped(documents: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word."""
    words = staged(word_counts(documents).where(F.col("n") >= LEAST_COUNT), "words")
    strong = F.col("best_n") >= RATIO * F.col("n")
    found = staged(
        words.join(near_words(words), "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(strong, F.col("best")).alias("form"),
            F.when(strong, F.col("best_n")).alias("form_n"),
        ),
        "variants",
    )
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
