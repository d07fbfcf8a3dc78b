"""Chat formatting of typed content parts.

A turn's content is text, or a list of parts of type text, image, audio or document. A
visitor flattens the parts in order: text is escaped, an attachment becomes one
placeholder, and its reference and expanded token count are recorded beside it. A part of
any other type becomes the placeholder ``<|unknown|>`` of one token, recorded under the type
it names. The template marks turns:

    <|im_start|>role\\ncontent<|im_end|>\\n

Control strings inside texts are made harmless reversibly: every ``<``, backslashes and
``|`` in a row gets one more backslash, so an escaped text never holds ``<|``. The loss
mask is a span of code points within the turn: the text of an assistant's turn.

Nulls: a null text or part text is empty, a null role is the empty role, a null turn
comes first; rows of equal turn follow by role and text, repeated rows are kept. An empty
table gives no rows. A conversation may be of any length: turns are formatted one by one,
and reading back streams over them in order.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
ROLE_WITH_LOSS = "assistant"
_BARE, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str | None) -> str:
    return _BARE.sub(r"<\\\1|", text or "")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str | None) -> str:
    return escape((role or "").replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text))


@dataclass(frozen=True)
class Rates:
    """How many tokens attachments expand to."""

    image_patch: int = 28  # pixels of a patch's side
    image_most: int = 1280
    audio_per_second: float = 25.0
    document_per_page: int = 640


@dataclass
class Flattened:
    """What the visitor gathers: the text, the places of its plain texts, attachments."""

    content: str = ""
    attachments: list[dict] = field(default_factory=list)


class Visitor:
    """Flattens parts in order; one method per type."""

    def __init__(self, rates: Rates = Rates()):
        self.rates = rates

    def flatten(self, parts: list[dict]) -> Flattened:
        out = Flattened()
        for part in parts:
            kind = part.get("type") or "text"
            visit = getattr(self, f"visit_{kind}", None) or self.visit_unknown
            visit(part, out)
        return out

    def visit_text(self, part: dict, out: Flattened) -> None:
        out.content += escape(part.get("text"))

    def visit_image(self, part: dict, out: Flattened) -> None:
        side = self.rates.image_patch
        patches = math.ceil((part.get("width") or side) / side) * math.ceil((part.get("height") or side) / side)
        self._attach("image", part, min(patches, self.rates.image_most), out)

    def visit_audio(self, part: dict, out: Flattened) -> None:
        self._attach("audio", part, math.ceil((part.get("seconds") or 0) * self.rates.audio_per_second), out)

    def visit_document(self, part: dict, out: Flattened) -> None:
        self._attach("document", part, (part.get("pages") or 1) * self.rates.document_per_page, out)

    def visit_unknown(self, part: dict, out: Flattened) -> None:
        self._attach("unknown", part, 1, out, part.get("type"))

    def _attach(self, kind: str, part: dict, tokens: int, out: Flattened, named: str | None = None) -> None:
        placeholder = f"<|{kind}|>"
        out.attachments.append(
            {"type": named or kind, "ref": part.get("ref"), "tokens": max(1, tokens), "start": len(out.content), "length": len(placeholder)}
        )
        out.content += placeholder


PART = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("ref", T.StringType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("pages", T.IntegerType()),
    ]
)
_ATTACHMENTS = "array<struct<type:string,ref:string,tokens:int,start:int,length:int>>"
FORMATTED = (
    "role string, text string, formatted string, content_start int, content_length int, "
    f"loss boolean, attachments {_ATTACHMENTS}"
)


def format_turn(role: str | None, parts: list[dict], visitor: Visitor) -> dict:
    flat = visitor.flatten(parts)
    head = f"{START}{escape_role(role)}\n"
    attachments = [a | {"start": a["start"] + len(head)} for a in flat.attachments]
    return {
        "formatted": f"{head}{flat.content}{END}\n",
        "content_start": len(head),
        "content_length": len(flat.content),
        "loss": role == ROLE_WITH_LOSS,
        "attachments": attachments,
    }


def formatted(conversations: DataFrame, rates: Rates = Rates()) -> DataFrame:
    """One row per turn: conv_id, turn, role, order_text, formatted, the span of its
    content, whether it bears loss, and its attachments.

    Content is the column ``parts`` (an array of PART) where there is one, else ``text``.
    A conversation's text is that of its rows by turn, role and order_text.
    """
    typed = "parts" in conversations.columns
    content = "parts" if typed else "text"
    kinds = {c: conversations.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        visitor = Visitor(rates)
        for batch in batches:
            rows = []
            for role, value in zip(batch["role"], batch["content"]):
                parts = [{"type": "text", "text": value}] if not typed else [p for p in (value if value is not None else ())]
                rows.append(format_turn(role, parts, visitor))
            columns = ["formatted", "content_start", "content_length", "loss", "attachments"]
            out = pd.DataFrame(rows, columns=columns)
            for c in ("order_text", "role", "turn", "conv_id"):
                out.insert(0, c, batch[c])
            yield out

    order = F.to_json(F.col("parts")) if typed else F.col("text")
    turns = conversations.select("conv_id", "turn", "role", order.alias("order_text"), F.col(content).alias("content"))
    return turns.mapInPandas(
        run,
        f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, order_text string, formatted string, "
        f"content_start int, content_length int, loss boolean, attachments {_ATTACHMENTS}",
    )


def parse_turns(text: str) -> list[tuple[str, str]]:
    """(role, escaped content) of each turn of a formatted text."""
    out = []
    for piece in text.split(START)[1:]:
        head, _, rest = piece.partition("\n")
        out.append((unescape_role(head), rest.rpartition(END)[0]))
    return out


class _Reading:
    def __init__(self, conv):
        self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, start: int, length: int, loss: bool) -> None:
        for role, content in parse_turns(text):
            self.all.update(f"{role}\n{unescape(content)}\n".encode())
            self.turns += 1
        if loss:
            masked = unescape(text[start : start + length])
            self.loss.update(masked.encode())
            self.loss_chars += len(masked)
        self.chars += len(text)

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(turns: DataFrame) -> DataFrame:
    """Digests per conversation, read from the formatted turns.

    A digest runs over a conversation from start to end, so its turns meet in one task;
    they are sorted there (spilling if need be) and streamed, never held together.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        open_one: _Reading | None = None
        for batch in batches:
            done = []
            for conv, *rest in zip(batch["conv_id"], batch["formatted"], batch["content_start"], batch["content_length"], batch["loss"]):
                conv = None if pd.isna(conv) else conv
                if open_one is None or open_one.conv != conv:
                    if open_one is not None:
                        done.append(open_one.row())
                    open_one = _Reading(conv)
                open_one.add(*rest)
            if done:
                yield pd.DataFrame(done, columns=columns)
        if open_one is not None:
            yield pd.DataFrame([open_one.row()], columns=columns)

    kind = turns.schema["conv_id"].dataType.simpleString()
    by_conversation = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "order_text")
    return by_conversation.select("conv_id", "formatted", "content_start", "content_length", "loss").mapInPandas(
        run,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
