"""Format-preserving pseudonyms for personal data.

Values are recognised by pattern and validated (check digits, octets, calendar dates).
What they carry is a number below a size given by the format: the digits of a card but
its check digit, the days from 1900 to 2099, the letters and digits of an address. A
keyed Feistel network, walked until it lands below that size, permutes those numbers, and
the result is written in the same format with new check digits. The permutation is
turned into one without fixed points, so no value keeps itself. Equal values become
equal pseudonyms in every document; without the key they can't be led back.

Numbers that fail validation stay as they are. Null stays null, empty stays empty;
repeated rows get equal texts.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleworks.llm.text import spare_name

#: A deployment passes its own secret.
KEY = b"candleworks"
ROUNDS = 8
KINDS = ("email", "iban", "card", "date", "national_id", "ip", "phone", "secret")


class Permutation:
    """Keyed bijections of the numbers below a size, one for each label."""

    def __init__(self, key: bytes = KEY):
        self.key = key

    def _round(self, label: bytes, k: int, half: int, bits: int) -> int:
        data = label + bytes([k]) + half.to_bytes((bits + 15) // 8, "big")
        out = hashlib.blake2b(data, key=self.key[:64], digest_size=min(64, (bits + 7) // 8)).digest()
        return int.from_bytes(out, "big") & ((1 << bits) - 1)

    def _feistel(self, x: int, label: bytes, bits: int, order: list[int]) -> int:
        low = (1 << bits) - 1
        left, right = x >> bits, x & low
        for k in order:
            left, right = right, left ^ self._round(label, k, right, bits)
        return right << bits | left

    def _walk(self, x: int, size: int, label: bytes, order: list[int]) -> int:
        bits = max(1, ((size - 1).bit_length() + 1) // 2)
        while True:
            x = self._feistel(x, label, bits, order)
            if x < size:
                return x

    def forward(self, x: int, size: int, label: bytes) -> int:
        return self._walk(x, size, label, list(range(ROUNDS)))

    def backward(self, x: int, size: int, label: bytes) -> int:
        return self._walk(x, size, label, list(range(ROUNDS))[::-1])

    def pseudonym(self, x: int, size: int, label: bytes) -> int:
        """A conjugate of "add one": a bijection that moves every number."""
        if size < 2:
            return x
        return self.backward((self.forward(x, size, label) + 1) % size, size, label)

    def original(self, x: int, size: int, label: bytes) -> int:
        if size < 2:
            return x
        return self.backward((self.forward(x, size, label) - 1) % size, size, label)


_LOWER, _UPPER, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def _alphabet(c: str, sets: tuple[str, ...]) -> str | None:
    return next((s for s in sets if c in s), None)


def _spell(text: str, label: bytes, move: Callable, sets: tuple[str, ...] = (_DIGIT, _LOWER, _UPPER)) -> str:
    """Moves the characters within their sets, as one mixed-radix number; others stay."""
    kinds = [_alphabet(c, sets) for c in text]
    value, size = 0, 1
    for c, kind in zip(text, kinds):
        if kind:
            value, size = value * len(kind) + kind.index(c), size * len(kind)
    value = move(value, size, label)
    out = []
    for c, kind in zip(reversed(text), reversed(kinds)):
        if kind:
            value, at = divmod(value, len(kind))
            c = kind[at]
        out.append(c)
    return "".join(reversed(out))


def _into(shape: str, digits: str) -> str:
    """The digits written over those of shape."""
    rest = iter(digits)
    return "".join(next(rest) if c.isdigit() else c for c in shape)


def luhn_digit(payload: str) -> str:
    total = 0
    for i, c in enumerate(reversed(payload)):
        v = int(c) * (2 - i % 2)
        total += v - 9 * (v > 9)
    return str(-total % 10)


def _card(text: str, move: Callable) -> str | None:
    digits = "".join(c for c in text if c.isdigit())
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    payload = _spell(digits[:-1], b"card", move)
    return _into(text, payload + luhn_digit(payload))


def iban_check(country: str, account: str) -> str:
    number = int("".join(str(int(c, 36)) for c in account + country + "00"))
    return f"{98 - number % 97:02d}"


def _iban(text: str, move: Callable) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or iban_check(plain[:2], plain[4:]) != plain[2:4]:
        return None
    account = _spell(plain[4:], plain[:2].encode(), move)
    rest = iter(plain[:2] + iban_check(plain[:2], account) + account)
    return "".join(c if c == " " else next(rest) for c in text)


_FIRST_DAY, _DAYS = dt.date(1900, 1, 1).toordinal(), dt.date(2100, 1, 1).toordinal() - dt.date(1900, 1, 1).toordinal()


def _date(text: str, move: Callable) -> str | None:
    """Year first, or day first; with slashes month first where that is the only valid reading."""
    parts = re.findall(r"\d+", text)
    order = (0, 1, 2) if len(parts[0]) == 4 else (2, 1, 0)
    for y, m, d in (order, (2, 0, 1)) if len(parts[0]) != 4 else (order,):
        try:
            day = dt.date(int(parts[y]), int(parts[m]), int(parts[d])).toordinal() - _FIRST_DAY
        except ValueError:
            continue
        if 0 <= day < _DAYS:
            new = dt.date.fromordinal(_FIRST_DAY + move(day, _DAYS, b"date"))
            while (y, m) == (2, 0) and new.day <= 12:  # or it would be read as day first
                new = dt.date.fromordinal(_FIRST_DAY + move(new.toordinal() - _FIRST_DAY, _DAYS, b"date"))
            values = {y: f"{new.year:04d}", m: f"{new.month:02d}", d: f"{new.day:02d}"}
            seps = re.findall(r"\D", text)
            return values[0] + seps[0] + values[1] + seps[1] + values[2]
    return None


def _ip(text: str, move: Callable) -> str | None:
    octets = [int(p) for p in text.split(".")]
    if max(octets) > 255:
        return None
    value = move(int.from_bytes(bytes(octets), "big"), 1 << 32, b"ip")
    return ".".join(map(str, value.to_bytes(4, "big")))


def _national_id(text: str, move: Callable) -> str | None:
    area, group, serial = (int(p) for p in text.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    value = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    value, serial = divmod(move(value, 898 * 99 * 9999, b"national"), 9999)
    area, group = divmod(value, 99)
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def _phone(text: str, move: Callable) -> str | None:
    head = re.match(r"\+\d{1,3}(?=[ .(-])|\+\d", text)[0]
    rest = "".join(c for c in text[len(head) :] if c.isdigit())
    if not 7 <= len(rest) + len(head) - 1 <= 15:
        return None
    return head + _into(text[len(head) :], _spell(rest, b"phone" + head.encode(), move))


def _email(text: str, move: Callable) -> str | None:
    local, _, domain = text.rpartition("@")
    return f"{_spell(local, domain.lower().encode(), move)}@{domain}"


def _secret(text: str, move: Callable) -> str | None:
    letters = _UPPER[:6] if any(c in _UPPER for c in text) else _LOWER[:6]
    return _spell(text, b"secret", move, (_DIGIT + letters,))


_WRITERS = {
    "email": _email, "iban": _iban, "card": _card, "date": _date, "national_id": _national_id,
    "ip": _ip, "phone": _phone, "secret": _secret,
}

#: Lengths of the IBANs of a country; the others are tried at every length.
_IBAN_LENGTHS = {
    c: int(n) for n, names in (
        ("15", "NO"), ("16", "BE"), ("18", "DK FI FO GL NL SD FK"), ("19", "MK SI"), ("20", "AT BA EE KZ LT LU XK MN"),
        ("21", "CH CR HR LI LV"), ("22", "BG BH DE GB GE IE ME RS VA"), ("23", "AE GI IL IQ TL OM SO"),
        ("24", "AD CZ ES MD PK RO SA SE SK TN VG"), ("25", "LY PT ST"), ("26", "IS TR"),
        ("27", "BI DJ FR GR IT MC MR SM"), ("28", "AL AZ BY CY DO GT HU LB NI PL SV"), ("29", "BR EG PS QA UA"),
        ("30", "JO KW MU YE"), ("31", "MT SC"), ("32", "LC"), ("33", "RU"),
    ) for c in names.split()
}


def _shorter(kind: str, text: str) -> Iterator[str]:
    """Shorter readings of a match that failed validation, longest first: a card ends with
    one of its groups or digits, an IBAN where its country's account numbers end."""
    known = _IBAN_LENGTHS.get(text[:2]) if kind == "iban" else None
    least = {"card": 13, "iban": 15}.get(kind)
    places = [i for i, c in enumerate(text) if c.isalnum()] if least else []
    for count in range(len(places) - 1, (least or 1) - 1, -1):
        end = places[count - 1] + 1
        if text[end : end + 1].isalnum() or known not in (None, count):
            continue  # a value ends before a separator
        yield text[:end]


_PATTERN = re.compile(
    r"""(?P<email>(?<![\w.+-])[\w.+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)
    |(?P<phone>\+\d{1,3}[ .-]?(?:\(\d{2,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d))
    |(?<![\w.])(?:
      (?P<ip>\d{1,3}(?:\.\d{1,3}){3})(?![\w]|\.\d)
    | (?P<date>\d{4}([-/.])\d{1,2}\5\d{1,2}|\d{1,2}([-/.])\d{1,2}\6\d{4})(?![^\WT]|T(?!\d{2}:?\d{2})|[-/.]\d)
    | (?P<national_id>\d{3}-\d{2}-\d{4})(?![\w-])
    | (?P<card>\d(?:[ -]?\d){12,18})(?![\w]|-\d)
    | (?P<iban>[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,4})?)(?![\w])
    | (?i:token|key|secret|password)["']?\s*[=:]\s*["']?(?P<secret>[0-9a-fA-F]{16,})(?![\w])
    )""",
    re.VERBOSE,
)
_MAY_HOLD = re.compile(r"[0-9@]")


class Pseudonymiser:
    """Rewrites texts; ``back`` leads pseudonyms to the originals with the same key."""

    def __init__(self, key: bytes = KEY, back: bool = False):
        permutation = Permutation(key)
        move = permutation.original if back else permutation.pseudonym

        @lru_cache(maxsize=1 << 14)
        def one(kind: str, value: str) -> str | None:
            return _WRITERS[kind](value, move)

        self._one = one

    def rewrite(self, text: str | None) -> tuple[str | None, list[tuple[str, int, int]]]:
        """The new text, and (kind, start, end) of each pseudonym in it."""
        if not text or not _MAY_HOLD.search(text):
            return text, []
        out, found, at, length = [], [], 0, 0
        match = _PATTERN.search(text)
        while match:
            kind = match.lastgroup
            start, end = match.span(kind)
            new = self._one(kind, match[kind])
            if new is None:
                for part in _shorter(kind, match[kind]):
                    new, end = self._one(kind, part), start + len(part)
                    if new is not None:
                        break
            if new is not None:
                out += [text[at:start], new]
                length += start - at
                found.append((kind, length, length + len(new)))
                length, at = length + len(new), end
            match = _PATTERN.search(text, end if new is not None else match.end())
        return ("".join([*out, text[at:]]) if found else text), found


_RESULT = "text string, found array<struct<kind:string,start:int,end:int>>"


def rewriter(key: bytes = KEY) -> Callable:
    """A column function from text to struct(text, found)."""

    @F.pandas_udf(_RESULT)
    def rewrite(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        one = Pseudonymiser(key)
        for batch in texts:
            rows = [one.rewrite(t) for t in batch]
            yield pd.DataFrame(
                {
                    "text": [r[0] for r in rows],
                    "found": [[{"kind": k, "start": s, "end": e} for k, s, e in r[1]] for r in rows],
                }
            )

    return rewrite.asNondeterministic()  # evaluated once, not per field


def pseudonymised(documents: DataFrame, key: bytes = KEY) -> DataFrame:
    """documents with pseudonyms in ``text``; ``n_chars``, where there is one, follows it."""
    name = spare_name(documents, "rewritten")
    out = documents.withColumn(name, rewriter(key)("text"))
    changed = {"text": F.col(f"{name}.text")}
    if "n_chars" in documents.columns:
        new = F.length(f"{name}.text").cast(documents.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.size(f"{name}.found") > 0, new).otherwise(F.col("n_chars"))
    return out.withColumns(changed).select(*documents.columns)
