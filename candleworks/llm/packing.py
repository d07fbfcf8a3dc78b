"""Packing of token sequences by vector bin packing.

A bin has limits on three things at once: tokens, segments (pieces of documents) and
loss-bearing tokens. While a bin is open, of all waiting items that fit the one is placed
whose demand has the largest dot product with what is left of the bin, both as shares of
the limits. When none fits, the largest item that the other two limits allow is cut to
fill the tokens exactly, and its rest waits on. A document longer than a bin, or with more
loss tokens than a bin may hold, is cut to the limits first. Loss tokens are counted exactly
in each piece, from the spans of the document that bear loss.

Each task packs its own rows in windows of bounded size, so nothing is shuffled and no
group is gathered. What is left when a task ends is cut into bins whose sizes are powers
of two, which need no padding. Bin numbers are the task's number and a running number;
rows come in file order, so a task that runs again gives the same bins.

Null and empty texts have one token, the end id. Equal rows are packed one by one. An
empty table gives no pieces.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleworks.llm.text import in_slices

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
#: Tokens that wait for a bin in one task at most, besides one document.
WINDOW_TOKENS = 1 << 21
WINDOW_ITEMS = 512
#: Bytes that remembered words and their ids may take in a worker, in each of two generations.
REMEMBERED = 64_000_000
# How byte-level tokenizers write bytes: those without a shape of their own follow U+00FF.
_SHAPED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_VISIBLE = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _SHAPED)}
_ENTRY = 240  # bytes that a remembered word takes besides its letters and ids
_ENDS = b"!#$%&()*+,-./:;<=>?@[]^_{|}~"
_WIDTH = 4  # bytes of an id


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 512
    loss_tokens: int = 4096


class _Known(dict):
    """Ids by word. A word that is missing moves over from the older generation, or is encoded."""

    def __init__(self, tokenizer, older: dict[bytes, bytes]):
        super().__init__()
        self.tokenizer, self.merged, self.older, self.size = tokenizer, tokenizer.model.tokenize, older, 0

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.pop(word, None) or self._encoded(word)
        self[word] = ids
        self.size += len(word) + len(ids) + _ENTRY
        return ids

    def _encoded(self, word: bytes) -> bytes:
        stem = word if b"<|" in word else word.rstrip(_ENDS)
        if len(stem) < len(word) and stem[-1:].isalpha():
            return self[stem] + self[word[len(stem) :]]
        text = word.decode()
        if text.isalpha() and max(text) < "\u0100":
            text = text.lower()
            text = text if text.isascii() else text.encode().decode("latin-1").translate(_VISIBLE)
            return array("I", [t.id for t in self.merged(text)]).tobytes()
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


class WordIds:
    """Ids of a text as little-endian bytes, exactly those of the tokenizer.

    No token spans white space, and normalisation (NFC, lower case) does not reach across
    it, so words are encoded apart and remembered. Signs after a letter at a word's end start
    a token of their own. Letters up to U+00FF need no normalisation but lower case and are
    one piece, which goes to the merges at once. When the younger of two generations has
    taken its share of memory, the older one is forgotten.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are parallel already
        self.tokenizer = Tokenizer.from_file(path)
        self.known = _Known(self.tokenizer, {})

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out = []
        for text in texts:
            if self.known.size > REMEMBERED:
                self.known.older.clear()
                self.known = _Known(self.tokenizer, self.known)
            out.append(b"".join(map(self.known.__getitem__, _words(text))) if text else b"")
        return out


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One per Python worker, so that the words of earlier tasks are still known."""
    return WordIds(path)


def _words(text: str) -> list[bytes]:
    # Lower-casing must not turn a text into the name of a special token.
    return (text.encode() if "<|" in text else text.encode().lower()).split()


@dataclass
class _Item:
    doc: object
    ids: bytes
    start: int  # of these ids in the document
    total: int  # ids of the document
    bearing: np.ndarray | None = None  # loss tokens before each place of the document; None: all bear loss

    @property
    def tokens(self) -> int:
        return len(self.ids) // _WIDTH

    def loss(self, length: int) -> int:
        """Loss tokens among the first ones."""
        if self.bearing is None:
            return length
        return int(self.bearing[self.start + length] - self.bearing[self.start])

    def fitting(self, tokens: int, loss: int) -> int:
        """How many of the first tokens keep to both limits."""
        most = min(self.tokens, tokens)
        if self.bearing is None:
            return min(most, loss)
        ahead = self.bearing[self.start : self.start + most + 1]
        return int(np.searchsorted(ahead, ahead[0] + loss, side="right")) - 1

    def cut(self, length: int) -> _Item:
        """The first tokens; the rest stays here."""
        head = _Item(self.doc, self.ids[: length * _WIDTH], self.start, self.total, self.bearing)
        self.ids, self.start = self.ids[length * _WIDTH :], self.start + length
        return head


def loss_before(total: int, spans) -> np.ndarray | None:
    """Loss tokens before each place of a document, from (start, end) spans of its tokens.

    Spans may overlap and are cut to the document; None, or a null bound, takes the end.
    """
    if spans is None:
        return None
    steps = np.zeros(total + 1, np.int64)
    for start, end in spans:
        start = 0 if start is None else min(max(int(start), 0), total)
        end = total if end is None else min(max(int(end), start), total)
        steps[start] += 1
        steps[end] -= 1
    return np.concatenate([[0], np.cumsum(np.cumsum(steps[:-1]) > 0)]).astype(np.int32)


class Packer:
    """Takes (doc, ids) one by one; ``ready`` and ``finish`` give rows of pieces."""

    def __init__(self, limits: Limits, first_bin: int = 0):
        if min(limits.tokens, limits.segments, limits.loss_tokens) < 1:
            raise ValueError("every limit is at least 1")
        self.limits, self.bin = limits, first_bin
        self.caps = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
        self.waiting: list[_Item] = []
        self.held = 0

    def add(self, doc, ids: bytes, bearing: np.ndarray | None = None) -> Iterator[tuple]:
        """bearing: as ``loss_before`` gives it; by default all tokens bear loss."""
        rest = _Item(doc, ids, 0, len(ids) // _WIDTH, bearing)
        tokens, loss = self.limits.tokens, self.limits.loss_tokens
        while rest.tokens >= tokens or rest.loss(rest.tokens) > loss:
            piece = rest.cut(rest.fitting(tokens, loss))
            if piece.tokens == tokens:
                yield self._row(piece, 0)
                self.bin += 1
            else:  # cut by the loss: tokens without loss may still join it
                self.waiting.append(piece)
                self.held += piece.tokens
                yield from self.ready()
        if rest.tokens:
            self.waiting.append(rest)
            self.held += rest.tokens

    def _row(self, item: _Item, offset: int) -> tuple:
        return item.doc, item.start, item.tokens, item.ids, item.total, self.bin, offset, item.loss(item.tokens)

    def ready(self) -> Iterator[tuple]:
        """Packs when a window is full, down to a half of it."""
        if self.held >= WINDOW_TOKENS or len(self.waiting) >= WINDOW_ITEMS:
            yield from self._pack(self.held // 2)

    def _demand(self, item: _Item) -> np.ndarray:
        return np.array([item.tokens, 1, item.loss(item.tokens)]) / self.caps

    def _pack(self, leave: int) -> Iterator[tuple]:
        tokens = np.array([i.tokens for i in self.waiting], float)
        loss = np.array([i.loss(i.tokens) for i in self.waiting], float)
        demand = np.stack([tokens, np.ones(len(tokens)), loss], 1) / self.caps
        here = np.ones(len(tokens), bool)
        held = self.held
        while held > max(leave, 0) and held >= self.limits.tokens:
            left, offset = [self.limits.tokens, self.limits.segments, self.limits.loss_tokens], 0
            while left[0] and left[1]:
                room = np.array(left) / self.caps
                fits = here & (demand <= room + 1e-12).all(1)
                if fits.any():
                    at = int(np.argmax(np.where(fits, demand @ room, -1)))
                    length = self.waiting[at].tokens
                else:
                    # Cut the largest item that may begin here to what the tokens and the loss allow.
                    wanted, length = here.copy(), 0
                    while not length and wanted.any():
                        at = int(np.argmax(np.where(wanted, tokens, -1)))
                        length = self.waiting[at].fitting(left[0], left[2])
                        wanted[at] = False
                    if not length:
                        break
                item = self.waiting[at]
                here[at] = length < item.tokens
                piece = item.cut(length)
                yield self._row(piece, offset)
                offset, held = offset + length, held - length
                left = [left[0] - length, left[1] - 1, left[2] - piece.loss(length)]
                if here[at]:
                    tokens[at], demand[at] = item.tokens, self._demand(item)
            self.bin += 1
        self.waiting = [i for i, h in zip(self.waiting, here) if h]
        self.held = held

    def finish(self) -> Iterator[tuple]:
        """Packs what waits; the last tokens go to bins of a power of two each."""
        yield from self._pack(0)
        size = 0
        while self.waiting:
            if not size:
                size = min(1 << (self.held.bit_length() - 1), self.limits.tokens)
                room, offset, segments, loss = size, 0, 0, 0
            item = self.waiting[0]
            length = item.fitting(room, self.limits.loss_tokens - loss)
            if segments == self.limits.segments or length < 1:
                self.bin, size = self.bin + 1, 0
                continue
            piece = item.cut(length)
            yield self._row(piece, offset)
            offset, room, segments, loss = offset + length, room - length, segments + 1, loss + piece.loss(length)
            self.held -= length
            if not item.tokens:
                self.waiting.pop(0)
            if not room:
                self.bin, size = self.bin + 1, 0


_COLUMNS = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "loss_tokens"]


def packed(documents: DataFrame, limits: Limits = Limits(), path: str | None = None, loss: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset and loss_tokens. path: the tokenizer's file on the executors.

    loss: a column of arrays of (start, end) structs, the spans of a document's tokens that
    bear loss (the end id is its last token). Without it, or where it is null, all tokens bear
    loss; in an empty array none does.
    """
    texts = documents.select("doc_id", "text", *([F.col(loss).alias("spans")] if loss else []))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = word_ids(path or public_tokenizers.path(VOCABULARY))
        packer = Packer(limits, TaskContext.get().partitionId() << 33)
        end = np.array([END_ID], "<u4").tobytes()
        rows, size = [], 0
        for batch in batches:
            for first, texts in in_slices(batch["text"].tolist()):
                docs = batch["doc_id"].iloc[first : first + len(texts)]
                spans = batch["spans"].iloc[first : first + len(texts)] if loss else repeat(None)
                for doc, ids, own in zip(docs, words.encode(texts), spans):
                    doc = None if pd.isna(doc) else doc
                    ids += end
                    bearing = None if own is None else loss_before(len(ids) // _WIDTH, [_bounds(s) for s in own])
                    for row in (*packer.add(doc, ids, bearing), *packer.ready()):
                        rows.append(row)
                        size += row[2]
                if size >= WINDOW_TOKENS:
                    yield pd.DataFrame(rows, columns=_COLUMNS)
                    rows, size = [], 0
        rows += packer.finish()
        if rows:
            yield pd.DataFrame(rows, columns=_COLUMNS)

    kind = documents.schema["doc_id"].dataType.simpleString()
    return texts.mapInPandas(
        run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, loss_tokens long"
    )


def _bounds(span) -> tuple:
    """A span as (start, end), whatever its fields are called; a null span is empty."""
    if span is None:
        return 0, 0
    return tuple(span.values() if isinstance(span, dict) else span)
