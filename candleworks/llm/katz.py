"""Language-model scores by Katz backoff over words.

P(w | h) = d(c) c(hw) / c(h) if hw was seen, else alpha(h) P(w | shorter h). The discounts d
are Good-Turing's for counts up to RELIABLE, from the counts of counts of each order; larger
counts give up as much as RELIABLE does, so that every history keeps mass for what it has not
seen. alpha(h) divides that mass by the shorter history's probability of all that h has not
seen, so the probabilities of all known words and the one unknown word add up to 1 exactly.
The unknown word has the mass that discounting leaves at order 1.

Nothing of the model passes through the driver but the counts of counts. N-grams are keyed by
64-bit hashes, and their tables are dealt over parts by key:

1. Tasks turn documents into slices of bounded size: the hashes of the slice's words, and
   the tokens as numbers.
2. Each slice sends every distinct n-gram once to the part that owns it, with its count in
   the documents that are learnt from. The part adds up, keeps its table, and answers the
   slice with the totals. An n-gram that fills a third of the corpus is one key per slice.
3. With totals and discounts a slice knows every probability but alpha. It sends, per history,
   the mass left over and the probability seen (each n-gram is reported by one slice, which
   its part has named), and asks for the histories it backs off from.
4. The part that owns a history adds up and answers alpha c(h); the slice adds the logarithms
   to its documents' scores.

Parts grow in number with the tokens, slices with the characters. Results of steps 1 to 3 are
tables in the shared work folder, so a lost executor costs a step's tasks.

Null and empty texts have one token, the end. Documents without an id are scored as any other
and keep a null id. Repeated rows count and are scored each. Without documents to learn from
all words are unknown and every score is 0. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candleworks.session import drop_folder, fresh_folder

ORDER = 2
#: Larger counts are not Good-Turing discounted.
RELIABLE = 5
#: Characters of a slice (at least one document), and n-grams that a part should hold.
SLICE_CHARS, PART_GRAMS, LEAST_PARTS = 4_000_000, 4_000_000, 64

_END, _BEGIN = (np.uint64(xxhash.xxh64_intdigest(mark)) for mark in (b"", b" "))  # no words


def tokens(text: str | None) -> list[bytes]:
    """The lower-cased words; the end is not among them."""
    return text.encode().lower().split() if text else []


def _joined(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The key of an n-gram from those of its history and its last word."""
    x = (history ^ (history >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25) + word
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _packed(values: np.ndarray) -> bytes:
    """Numbers with like bytes side by side, compressed: sorted keys and small counts shrink."""
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.compress(planes.tobytes(), 1) if len(values) else b""


def _unpacked(block: bytes, kind=np.uint64) -> np.ndarray:
    if not block:
        return np.zeros(0, kind)
    planes = np.frombuffer(zstandard.decompress(block), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return planes.T.copy().view(kind).ravel()


@dataclass
class Slice:
    """Some documents: words holds the keys of BEGIN, END and the words; codes has the
    tokens of all documents, each document's with BEGIN before and END after."""

    words: np.ndarray
    codes: np.ndarray
    sizes: np.ndarray  # tokens of each document, with END and without BEGIN
    learnt: np.ndarray

    @staticmethod
    def of(texts: list[list[bytes]], learnt: list[bool]) -> Slice:
        number: dict[bytes, int] = {b" ": 0, b"": 1}
        marked = chain.from_iterable((b" ", *t, b"") for t in texts)
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        total = int(sizes.sum()) + len(sizes)
        codes = np.fromiter((number.setdefault(w, len(number)) for w in marked), np.uint32, total)
        keys = np.fromiter(map(xxhash.xxh64_intdigest, number), np.uint64, len(number))
        return Slice(keys, codes, sizes, np.array(learnt, bool))


@dataclass
class Grams:
    """The distinct n-grams of one order in a slice. of: the n-gram that ends at each token
    (-1: none). history and shorter: places among those of the order below (for order 2,
    history is a word's place)."""

    of: np.ndarray
    keys: np.ndarray
    learnt: np.ndarray
    history: np.ndarray
    shorter: np.ndarray


def grams(part: Slice, order: int) -> tuple[list[Grams], np.ndarray]:
    """The n-grams of orders 1 to ``order``, and the document of each token."""
    ends = np.cumsum(part.sizes + 1)
    starts = ends - part.sizes - 1
    document = np.repeat(np.arange(len(part.sizes)), part.sizes + 1)
    place = np.arange(len(part.codes)) - starts[document]  # 0 is BEGIN
    codes = part.codes.astype(np.int64)
    counted = (place > 0) & part.learnt[document]
    width = len(part.words)
    none = np.zeros(0, np.int64)
    found = [Grams(np.where(place > 0, codes, -1), part.words, np.bincount(codes[counted], minlength=width), none, none)]
    before = codes  # the history's number, for order 2 a word's and BEGIN's
    for k in range(2, order + 1):
        at = np.flatnonzero(place >= k - 1)
        both = before[at - 1] * width + codes[at]
        _, first, inverse = np.unique(both, return_index=True, return_inverse=True)
        of = np.full(len(codes), -1)
        of[at] = inverse
        history = before[at[first] - 1]
        keys = _joined(found[-1].keys[history], part.words[codes[at[first]]])
        learnt = np.bincount(inverse[counted[at]], minlength=len(first))
        found.append(Grams(of, keys, learnt, history, found[-1].of[at[first]]))
        before = of
    return found, document


def _parts(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part of each key; parts are ranges of keys."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _by_part(keys: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """(part, places of its keys in ascending order of key)"""
    order = np.argsort(keys, kind="stable")
    dealt = _parts(keys[order], parts)
    cuts = np.searchsorted(dealt, np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(cuts)).tolist():
        yield p, order[cuts[p] : cuts[p + 1]]


@dataclass
class Discounts:
    """share[c]: the discount of count c, up to RELIABLE; beyond it counts lose ``less``."""

    share: np.ndarray
    less: float

    @staticmethod
    def of(spectrum: np.ndarray) -> Discounts:
        """spectrum[r]: n-grams of count r, up to RELIABLE + 1. Where Good-Turing's discounts
        are not between 0 and 1 (few or odd counts), absolute ones take their place."""
        r = np.arange(1, RELIABLE + 1)
        n = spectrum[1 : RELIABLE + 2].astype(float)
        with np.errstate(all="ignore"):
            beyond = (RELIABLE + 1) * n[RELIABLE] / n[0]
            share = ((r + 1) * n[1:] / n[:-1] / r - beyond) / (1 - beyond)
        if not (np.isfinite(share).all() and (share > 0).all() and (share < 1).all()):
            even = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
            share = (r - even) / r
        return Discounts(np.concatenate([[0.0], share]), float(RELIABLE * (1 - share[-1])))

    def kept(self, counts: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        small = self.share[np.minimum(counts, RELIABLE)] * counts
        return np.where(counts > RELIABLE, counts - self.less, small)


@dataclass
class Totals:
    """What the driver knows of the model: sums over all parts."""

    documents: int = 0
    tokens: int = 0
    words: int = 0
    unknown: float = 1.0  # the probability of the unknown word
    discounts: list[Discounts] = field(default_factory=list)


def _slices(documents: DataFrame, learn: Column, path: str) -> DataFrame:
    """Step 1. One row per slice."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 33
        ids, held, learnt, size = [], [], [], 0

        def closed() -> pd.DataFrame:
            part = Slice.of(held, learnt)
            row = (number, ids, learnt, part.sizes, _packed(part.words), _packed(part.codes))
            return pd.DataFrame([row], columns=["slice", "ids", "learnt", "sizes", "words", "codes"])

        for batch in batches:
            for doc, text, known in zip(batch["doc_id"], batch["text"], batch["learn"]):
                ids.append(None if pd.isna(doc) else doc)
                held.append(tokens(text))
                learnt.append(bool(known))
                size += len(text or "")
                if size >= SLICE_CHARS:
                    yield closed()
                    number, ids, held, learnt, size = number + 1, [], [], [], 0
        if ids:
            yield closed()

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", "text", F.coalesce(learn, F.lit(True)).alias("learn"))
    schema = f"slice long, ids array<{kind}>, learnt array<boolean>, sizes array<long>, words binary, codes binary"
    rows.mapInPandas(run, schema).write.parquet(path)
    return documents.sparkSession.read.parquet(path)


def _read(row) -> Slice:
    return Slice(
        _unpacked(row.words), _unpacked(row.codes, np.uint32), np.array(row.sizes), np.array(row.learnt, bool)
    )


def _counted(slices: DataFrame, order: int, parts: int, path: str) -> DataFrame:
    """Step 2. Rows with a slice are answers to it (2 total + 1 if it reports the n-gram, in
    the order of its keys); rows without one are the tables of n-grams and counts."""

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                found, _ = grams(_read(row), order)
                for k, g in enumerate(found, 1):
                    skip = 1 if k == 1 else 0  # BEGIN is no word
                    keys, learnt = g.keys[skip:], g.learnt[skip:]
                    rows = [
                        (p, row.slice, k, _packed(keys[at]), _packed(learnt[at])) for p, at in _by_part(keys, parts)
                    ]
                    yield pd.DataFrame(rows, columns=["part", "slice", "n", "keys", "learnt"])

    def add(blocks: pd.DataFrame) -> pd.DataFrame:
        out = []
        for k, own in blocks.sort_values(["n", "slice"]).groupby("n"):
            held = [_unpacked(b) for b in own["keys"]]
            keys, first, inverse = np.unique(np.concatenate(held), return_index=True, return_inverse=True)
            learnt = np.concatenate([_unpacked(b, np.int64) for b in own["learnt"]])
            totals = np.zeros(len(keys), np.int64)
            np.add.at(totals, inverse, learnt)
            answers = 2 * totals[inverse]
            answers[first] += 1
            ends = np.cumsum([len(h) for h in held])
            for slice_, end, h in zip(own["slice"], ends, held):
                out.append((blocks["part"].iloc[0], slice_, k, None, _packed(answers[end - len(h) : end]), None))
            seen = totals > 0
            spectrum = np.bincount(np.minimum(totals[seen], RELIABLE + 2), minlength=RELIABLE + 3).tolist()
            sums = [*spectrum, int(totals.sum()), int(totals[keys == _END].sum())]
            out.append((blocks["part"].iloc[0], None, k, _packed(keys[seen]), _packed(totals[seen]), sums))
        return pd.DataFrame(out, columns=["part", "slice", "n", "keys", "counts", "sums"])

    sent = slices.select("slice", "ids", "learnt", "sizes", "words", "codes").mapInPandas(
        send, "part int, slice long, n int, keys binary, learnt binary"
    )
    added = sent.groupBy("part").applyInPandas(add, "part int, slice long, n int, keys binary, counts binary, sums array<long>")
    added.write.parquet(path)
    return slices.sparkSession.read.parquet(path)


def _totals(counted: DataFrame, order: int) -> Totals:
    """Sums over the tables' parts; a handful of numbers per order."""
    rows = counted.where("slice is null").select("n", F.posexplode("sums").alias("i", "v"))
    sums = {(r["n"], r["i"]): r["v"] for r in rows.groupBy("n", "i").agg(F.sum("v").alias("v")).collect()}
    spectra = np.array([[sums.get((k, i), 0) for i in range(RELIABLE + 5)] for k in range(1, order + 1)], np.int64)
    discounts = [Discounts.of(s[: RELIABLE + 3]) for s in spectra]
    types, total = spectra[0, 1 : RELIABLE + 3], int(spectra[0, RELIABLE + 3])
    r = np.arange(1, RELIABLE + 1)
    left = ((1 - discounts[0].share[1:]) * r * types[:RELIABLE]).sum() + discounts[0].less * types[RELIABLE:].sum()
    return Totals(int(spectra[0, RELIABLE + 4]), total, int(types.sum()), float(left / total) if total else 1.0, discounts)


def _measure(row, answers: pd.DataFrame, order: int, parts: int, totals: Totals) -> pd.DataFrame:
    """Step 3 for one slice: a row of its documents and rows for the owners of histories."""
    found, document = grams(_read(row), order)
    answers = answers.sort_values(["n", "part"])
    counts, reports = [], []
    for k, g in enumerate(found, 1):
        skip = 1 if k == 1 else 0
        own = answers.loc[answers["n"] == k, "counts"]
        given = np.concatenate([_unpacked(b, np.int64) for b in own]) if len(own) else np.zeros(0, np.int64)
        told = np.zeros(len(g.keys), np.int64)
        told[skip + np.argsort(g.keys[skip:], kind="stable")] = given
        counts.append(told >> 1)
        reports.append((told & 1).astype(bool))
    counts[0][0] = totals.documents  # BEGIN, as a history

    # Direct probabilities of all seen n-grams.
    direct = [totals.discounts[0].kept(counts[0]) / max(totals.tokens, 1)]
    for k in range(2, order + 1):
        direct.append(totals.discounts[k - 1].kept(counts[k - 1]) / np.maximum(counts[k - 2][found[k - 1].history], 1))

    is_token = found[0].of >= 0
    log = np.zeros(len(document))
    waiting = is_token.copy()
    out, pending = [], []
    for k in range(order, 0, -1):
        g = found[k - 1]
        here = np.flatnonzero(waiting & (g.of >= 0))
        seen = counts[k - 1][g.of[here]] > 0
        hit = here[seen]
        log[hit] += np.log10(direct[k - 1][g.of[hit]])
        waiting[hit] = False
        miss = here[~seen]
        if k == 1:
            log[miss] += math.log10(totals.unknown)
            continue
        history = g.history[g.of[miss]]
        known = counts[k - 2][history] > 0  # else the shorter history is taken as it is
        asked, which = np.unique(history[known], return_inverse=True)
        log -= np.bincount(miss[known], np.log10(counts[k - 2][history[known]]), minlength=len(log))
        by_key = np.argsort(found[k - 2].keys[asked], kind="stable")
        rank = np.empty(len(asked), np.int64)
        rank[by_key] = np.arange(len(asked))
        pending.append((k, document[miss[known]], rank[which]))
        # Sums per history over the n-grams that this slice reports.
        own = np.flatnonzero(reports[k - 1] & (counts[k - 1] > 0))
        histories, inverse = np.unique(g.history[own], return_inverse=True)
        c = counts[k - 1][own]
        left = np.bincount(inverse, c - totals.discounts[k - 1].kept(c), minlength=len(histories))
        covered = np.bincount(inverse, direct[k - 2][g.shorter[own]], minlength=len(histories))
        asks = {p: _packed(found[k - 2].keys[asked][at]) for p, at in _by_part(found[k - 2].keys[asked], parts)}
        sums = dict(_by_part(found[k - 2].keys[histories], parts))
        none = np.zeros(0, np.int64)
        for p in sorted(asks.keys() | sums.keys()):
            at = sums.get(p, none)
            keys = found[k - 2].keys[histories][at]
            out.append({"slice": row.slice, "n": k, "part": p, "keys": _packed(keys), "left": _packed(left[at]),
                        "covered": _packed(covered[at]), "asks": asks.get(p, b"")})

    size = len(row.ids)
    words = counts[0][found[0].of[is_token]]
    base = np.log10((words + 1) / (totals.tokens + totals.words + 1))
    own = document[is_token]
    out.append({
        "slice": row.slice, "ids": row.ids, "learnt": row.learnt, "n_tokens": np.bincount(own, minlength=size),
        "n_known": np.bincount(own, words > 0, minlength=size).astype(np.int64),
        "base": np.bincount(own, base, minlength=size), "log": np.bincount(document, log, minlength=size),
        "pending": [(k, _packed(d.astype(np.uint32)), _packed(a.astype(np.uint32))) for k, d, a in pending],
    })
    return pd.DataFrame([[o.get(c) for c in _MEASURED] for o in out], columns=_MEASURED)


_MEASURED = "slice n part keys left covered asks ids learnt n_tokens n_known base log pending".split()


def _measured(slices: DataFrame, counted: DataFrame, order: int, parts: int, totals: Totals, path: str) -> DataFrame:
    """Step 3."""

    def run(own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        return _measure(next(own.itertuples()), answers, order, parts, totals)

    kind = slices.schema["ids"].dataType.simpleString()
    schema = (
        f"slice long, n int, part int, keys binary, left binary, covered binary, asks binary, ids {kind}, learnt array<boolean>, "
        "n_tokens array<long>, n_known array<long>, base array<double>, log array<double>, "
        "pending array<struct<n: int, document: binary, ask: binary>>"
    )
    answers = counted.where("slice is not null").select("slice", "n", "part", "counts")
    both = slices.groupBy("slice").cogroup(answers.groupBy("slice")).applyInPandas(run, schema)
    both.write.parquet(path)
    return slices.sparkSession.read.parquet(path)


def _histories(measured: DataFrame, path: str) -> DataFrame:
    """Step 4, at the owners. Rows with a slice are answers to what it asked, alpha(h) c(h);
    rows without one are the tables of histories."""

    def add(blocks: pd.DataFrame) -> pd.DataFrame:
        out, part = [], blocks["part"].iloc[0]
        for k, own in blocks.sort_values(["n", "slice"]).groupby("n"):
            keys, inverse = np.unique(np.concatenate([_unpacked(b) for b in own["keys"]]), return_inverse=True)
            left, covered = np.zeros(len(keys)), np.zeros(len(keys))
            np.add.at(left, inverse, np.concatenate([_unpacked(b, float) for b in own["left"]]))
            np.add.at(covered, inverse, np.concatenate([_unpacked(b, float) for b in own["covered"]]))
            weight = left / np.maximum(1 - covered, 1e-15)
            for slice_, asks in zip(own["slice"], own["asks"]):
                if asks:
                    out.append((part, slice_, k, None, _packed(weight[np.searchsorted(keys, _unpacked(asks))])))
            out.append((part, None, k, _packed(keys), _packed(weight)))
        return pd.DataFrame(out, columns=["part", "slice", "n", "keys", "weights"])

    sent = measured.where("part is not null").select("part", "slice", "n", "keys", "left", "covered", "asks")
    added = sent.groupBy("part").applyInPandas(add, "part int, slice long, n int, keys binary, weights binary")
    added.write.parquet(path)
    return measured.sparkSession.read.parquet(path)


def scored(documents: DataFrame, learn: Column, order: int = ORDER) -> DataFrame:
    """doc_id, learnt, n_tokens, n_known, train_tokens, base_score and score of every row.

    learn: true for the documents whose n-grams are counted. base_score is that of single
    words with one added to each count.
    """
    spark = documents.sparkSession
    root = fresh_folder(spark, "katz")
    slices = _slices(documents, learn, f"{root}/slices")
    total = slices.select(F.explode("sizes").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = max(LEAST_PARTS, math.ceil(total * order / PART_GRAMS))
    counted = _counted(slices, order, parts, f"{root}/ngrams")
    totals = _totals(counted, order)
    measured = _measured(slices, counted, order, parts, totals, f"{root}/measured")
    drop_folder(spark, f"{root}/slices")
    answers = _histories(measured, f"{root}/histories").where("slice is not null").select("slice", "n", "part", "weights")

    def run(own: pd.DataFrame, weights: pd.DataFrame) -> pd.DataFrame:
        row = next(own.itertuples())
        score, weights = np.array(row.log), weights.sort_values(["n", "part"])
        for waiting in row.pending:
            told = weights.loc[weights["n"] == waiting["n"], "weights"]
            if len(told):
                given = np.log10(np.concatenate([_unpacked(b, float) for b in told]))
                ask, document = (_unpacked(waiting[c], np.uint32) for c in ("ask", "document"))
                score += np.bincount(document, given[ask], minlength=len(score))
        return pd.DataFrame(
            {"doc_id": row.ids, "learnt": row.learnt, "n_tokens": row.n_tokens, "n_known": row.n_known,
             "train_tokens": totals.tokens, "base_score": row.base, "score": score}
        )

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, learnt boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    of_documents = measured.where("part is null").select("slice", "ids", "learnt", "n_tokens", "n_known", "base", "log", "pending")
    return of_documents.groupBy("slice").cogroup(answers.groupBy("slice")).applyInPandas(run, schema)
