"""SentencePiece BPE by a table of last tokens, and back.

For every prefix of a word the table holds the last token of the prefix's encoding. That
token is unique: of all pieces that end where the prefix ends (found by an Aho-Corasick
automaton) it is the one that is compatible with the last token of the prefix before it.
Two tokens are compatible when their joined surface encodes to just the two of them; an
encoding is right exactly if all its neighbours are. The ids are recovered from the end of
the table backwards. Characters without a piece fall back to their bytes.

A text is cut into words first, where no piece reaches across: before runs of the space
mark, and between an ASCII letter and an ASCII character that is none (checked against the vocabulary when it is
loaded; without it, at space marks alone). Words are encoded once and remembered.

Null is the empty text: no ids, and the empty text back. Equal texts get equal ids.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame

VOCABULARY = "piece_bpe_32k.model"
SPACE = "▁"
#: Distinct words and token pairs a task remembers.
REMEMBERED_WORDS = 400_000
REMEMBERED_PAIRS = 1_000_000

_SAME = r"(?:[A-Za-z]+|[\x00-\x1f!-@\[-`{-\x7f]+)"
_BY_KIND = re.compile(rf" *{_SAME}(?:[^\x00-\x7f]+{_SAME}?)*| *(?:[^\x00-\x7f]+{_SAME}?)+| +")
_BY_SPACE = re.compile(r" *[^ ]+| +")


class PieceTable:
    """The vocabulary of a model file, an encoder and a decoder that equal the library's."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        special = {i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        self.byte_id = {int(model.id_to_piece(i)[3:5], 16): i for i in ids if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.surface = ["" if i in special else model.id_to_piece(i) for i in ids]
        normal = [i for i in ids if i not in special and i not in self.byte_of]
        # The better the score, the earlier two neighbours are merged into that piece.
        self.id_of = {self.surface[i]: i for i in normal}
        self.rank = {self.surface[i]: -model.get_score(i) for i in normal}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.id_of.items():
            if self._merged(piece) == [piece]:  # others can't come out of merging
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        plain = [p.replace(SPACE, " ") for p in self.id_of]
        self.words = next(p for p in (_BY_KIND, _BY_SPACE) if all(p.fullmatch(w) for w in plain))
        self.pairs: dict[tuple[int, int], bool] = {}
        self.known: dict[str, tuple[int, bytes, str]] = {}

    def _merged(self, text: str) -> list[str]:
        """Merging by definition, for short texts: the best pair first, the leftmost of equals."""
        parts = list(text)
        rank = self.rank
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= REMEMBERED_PAIRS:
                self.pairs.clear()
            a, b = self.surface[left], self.surface[right]
            known = self.pairs[key] = self._merged(a + b) == [a, b]
        return known

    def encode_word(self, word: str) -> list[int]:
        """Ids of a text in which spaces are already marked."""
        n = len(word)
        last: list[int | None] = [None] * (n + 1)
        size = [1] * (n + 1)
        pairs, compatible = self.pairs, self.compatible
        for end, (token, length) in self.automaton.iter(word):
            end += 1
            if last[end] is not None:
                continue
            before = last[end - length]
            if before is not None and end > length:
                fits = pairs.get((before, token))
                if not (compatible(before, token) if fits is None else fits):
                    continue
            # At the start of the word, or after a character without a piece, any piece fits.
            last[end], size[end] = token, length
        out: list[int] = []
        while n:
            token = last[n]
            if token is None:
                out += [self.byte_id[b] for b in reversed(word[n - 1].encode())]
            else:
                out.append(token)
            n -= size[n]
        return out[::-1]

    def _word(self, word: str) -> tuple[int, bytes, str]:
        ids = self.encode_word(word.replace(" ", SPACE))
        back = self._joined(ids)
        if len(self.known) >= REMEMBERED_WORDS:
            self.known.clear()
        value = self.known[word] = len(ids), ",".join(map(str, ids)).encode(), word if back == word else back
        return value

    def _split(self, text: str | None) -> list[str]:
        return self.words.findall(f" {text.replace(SPACE, ' ')}") if text else []

    def encode(self, text: str | None) -> list[int]:
        return [i for word in self._split(text) for i in self.encode_word(word.replace(" ", SPACE))]

    def _joined(self, ids: list[int]) -> str:
        out, held = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                held.append(self.byte_of[i])
                continue
            if held:
                out.append(held.decode(errors="replace"))
                held.clear()
            out.append(self.surface[i])
        out.append(held.decode(errors="replace"))
        return "".join(out).replace(SPACE, " ")

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the space that encoding puts in front goes."""
        return self._joined(ids).removeprefix(" ")

    def digests(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, and SHA-256 of the ids in decimal with commas and of the decoded text."""
        known, word = self.known, self._word
        parts = [known.get(w) or word(w) for w in self._split(text)]
        ids = b",".join([p[1] for p in parts])
        back = "".join([p[2] for p in parts]).removeprefix(" ")
        return sum([p[0] for p in parts]), hashlib.sha256(ids).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


@lru_cache(maxsize=2)
def piece_table(path: str) -> PieceTable:
    """One per Python worker, so that the words of earlier tasks are still known."""
    return PieceTable(path)


def encoded(documents: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids and the decoded text of every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = piece_table(path or public_tokenizers.path(VOCABULARY))
        for batch in batches:
            ids = [table.encode(t) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "ids": ids, "decoded": [table.decode(i) for i in ids]})

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, ids array<int>, decoded string")


def encoded_digests(documents: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = piece_table(path or public_tokenizers.path(VOCABULARY))
        for batch in batches:
            rows = pd.DataFrame([table.digests(t) for t in batch["text"]], columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            rows.insert(0, "doc_id", batch["doc_id"])
            yield rows

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInPandas(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
