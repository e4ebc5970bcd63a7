"""Personal data by anchor expansion.

One pass of an Aho-Corasick automaton over each whole text finds anchors: at-signs,
plus signs, digits, address schemes and identifier cues.  From an anchor a small
deterministic parser walks to the boundaries of what it may belong to, to the left no
further than the match before, and validates it.  The parsers take what the base
patterns of the four kinds take, leftmost and without overlap in each kind:

email    ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
ip       four numbers of at most 255 with dots between them
card     16 to 19 digits, single spaces or hyphens between them, that pass Luhn
phone    a plus sign and 8 to 15 digits with spaces, brackets, dots and hyphens

and two kinds of their own:

url      a scheme and an address that holds a user name and a password
account  an account number with valid check digits (modulo 97) after two letters

NULL counts as empty.  Positions count code points, ends are exclusive.  Every row
gives one row; rows that repeat are handled one by one, and other columns are not
read.  A text is scanned once from left to right, so its cost is its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE = KINDS[:4]

Span = tuple[str, int, int]

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_DIGITS = frozenset("0123456789")
_LABEL = frozenset(_LETTERS + "0123456789-")
_LOCAL = frozenset(_LETTERS + "0123456789._%+-")
_PHONE = frozenset("0123456789 ().-")
_CAPITALS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_ACCOUNT = _CAPITALS | _DIGITS

#: Identifier cues, followed by an account number.
CUES = ("IBAN", "Iban", "iban")
SCHEMES = ("http://", "https://", "ftp://", "sftp://", "ssh://")


@lru_cache(maxsize=1)
def anchors():
    """The automaton: each anchor's kind and length."""
    import ahocorasick

    found = ahocorasick.Automaton()
    found.add_word("@", ("email", 1))
    found.add_word("+", ("phone", 1))
    for d in "0123456789":
        found.add_word(d, ("digit", 1))
    for s in SCHEMES:
        found.add_word(s, ("url", len(s)))
    for c in CUES:
        found.add_word(c, ("account", len(c)))
    found.make_automaton()
    return found


def _run(text: str, at: int, allowed: frozenset[str]) -> int:
    """The first place from ``at`` on whose character is not allowed."""
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def parse_email(text: str, sign: int, floor: int) -> tuple[int, int] | None:
    start = sign
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    end = _run(text, sign + 1, _LABEL)
    if start == sign or end == sign + 1:
        return None
    labels = 0
    while end < len(text) and text[end] == "." and (stop := _run(text, end + 1, _LABEL)) > end + 1:
        end, labels = stop, labels + 1
    return (start, end) if labels else None


def parse_ip(text: str, start: int) -> tuple[int, int, bool] | None:
    """End of the first digits if no four numbers follow; else the end and whether they are small enough."""
    parts, end = [], start
    for k in range(4):
        stop = _run(text, end, _DIGITS)
        if stop == end:
            return None
        parts.append(text[end:stop])
        end = stop
        if k < 3:
            if end >= len(text) or text[end] != ".":
                return None
            end += 1
    return start, end, all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in parts)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if k % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def parse_card(text: str, start: int) -> tuple[int, bool]:
    """The end of the run of digits with single spaces or hyphens, and whether it is a card number."""
    end, n = start + 1, len(text)
    while True:
        if end < n and text[end] in _DIGITS:
            end += 1
        elif end + 1 < n and text[end] in " -" and text[end + 1] in _DIGITS:
            end += 2
        else:
            break
    if end - start < 16:
        return end, False
    digits = text[start:end].replace(" ", "").replace("-", "")
    return end, 16 <= len(digits) <= 19 and luhn(digits)


def parse_phone(text: str, sign: int) -> tuple[int, bool] | None:
    if sign + 1 >= len(text) or text[sign + 1] not in _DIGITS:
        return None
    end = _run(text, sign + 2, _PHONE)
    while end > sign and text[end - 1] not in _DIGITS:
        end -= 1
    if end < sign + 4:
        return None
    return end, 8 <= sum(c in _DIGITS for c in text[sign:end]) <= 15


def parse_url(text: str, start: int, after: int) -> tuple[int, int] | None:
    """A scheme, a name, a colon, a password, an at-sign and a host."""
    stop = after
    while stop < len(text) and not text[stop].isspace() and text[stop] not in "/\"'<>":
        stop += 1
    user, sign, host = text[after:stop].rpartition("@")
    name, colon, password = user.partition(":")
    return (start, stop) if sign and colon and name and password and host else None


def parse_account(text: str, after: int) -> tuple[int, int] | None:
    """Two capitals, two digits and 11 to 30 more letters or digits, in groups of any size, whose check digits are right."""
    start = after
    while start < len(text) and text[start] in " :=#.":
        start += 1
    if not (text[start : start + 2].isascii() and text[start : start + 2].isupper() and len(text[start : start + 2]) == 2 and text[start : start + 2].isalpha()):
        return None
    end, taken, best = start, "", None
    while end < len(text) and len(taken) < 34:
        if text[end] in _ACCOUNT:
            taken += text[end]
            end += 1
            if len(taken) >= 15 and (end == len(text) or text[end] not in _ACCOUNT) and taken[2:4].isdigit():
                moved = "".join(str(int(c, 36)) for c in taken[4:] + taken[:4])
                if int(moved) % 97 == 1:
                    best = start, end
        elif text[end] == " " and end + 1 < len(text) and text[end + 1] in _ACCOUNT:
            end += 1
        else:
            break
    return best


def find(text: str) -> list[Span]:
    """All spans of a text, by kind as listed, then by start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    past = dict.fromkeys(KINDS, 0)  # where each kind's last match ended
    digits_end = 0
    for at, (kind, length) in anchors().iter(text):
        start = at - length + 1
        if kind == "digit":
            if start >= past["card"]:
                end, valid = parse_card(text, start)
                past["card"] = end
                if valid:
                    found["card"].append((start, end))
            if start >= past["ip"] and start >= digits_end:
                got = parse_ip(text, start)
                if got is None:
                    digits_end = _run(text, start, _DIGITS)
                else:
                    past["ip"] = got[1]
                    if got[2]:
                        found["ip"].append(got[:2])
        elif kind == "email":
            email = parse_email(text, start, past["email"])
            if email:
                found["email"].append(email)
                past["email"] = email[1]
        elif kind == "phone":
            if start >= past["phone"] and (phone := parse_phone(text, start)):
                past["phone"] = phone[0]
                if phone[1]:
                    found["phone"].append((start, phone[0]))
        elif start >= past[kind]:
            span = parse_url(text, start, at + 1) if kind == "url" else parse_account(text, at + 1)
            if span:
                found[kind].append(span)
                past[kind] = span[1]
    return [(k, a, b) for k in KINDS for a, b in found[k]]


def _find_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    for batch in batches:
        spans = [[{"kind": k, "start": a, "end": b} for k, a, b in find(t)] if t else [] for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(span))], ["doc_id", "spans"])


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: doc_id and spans, an array of (kind, start, end)."""
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_find_batches, f"doc_id {kind}, spans array<struct<kind string, start long, end long>>")
