"""Words and five-word windows of many texts at once, as 64-bit hashes.

Texts are worked on as one array of UTF-8 bytes.  A word is a run without ASCII
white space; its hash is a polynomial in the bytes modulo 2**64, mixed with its
length, so equal words have equal hashes wherever they stand.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_AS_IS = np.arange(256, dtype=np.uint64) + np.uint64(1)
_AS_IS[_SPACE] = 0
_LOWERED = _AS_IS.copy()
_LOWERED[65:91] += np.uint64(32)

@lru_cache(maxsize=1)
def _power_tables() -> list[np.ndarray]:
    """Powers of the base and of its inverse as far as this process has needed them; not shipped with functions that use them."""
    return [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, 0 to n - 1 at least."""
    tables = _power_tables()
    if len(tables[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            tables[k] = np.multiply.accumulate(steps)
    return tables


def release() -> None:
    """Give back what earlier work in this process has left: tables sized by its longest slice, and unused Arrow memory."""
    _power_tables.cache_clear()
    pa.default_memory_pool().release_unused()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x *= MIX_1
    x ^= x >> np.uint64(27)
    x *= MIX_2
    x ^= x >> np.uint64(31)
    return x


class Words(NamedTuple):
    bytes: np.ndarray  #: all texts, one after the other
    offsets: np.ndarray  #: where each text begins, and the end
    hashes: np.ndarray  #: of each word
    starts: np.ndarray  #: first byte of each word
    ends: np.ndarray  #: first byte after each word
    doc: np.ndarray  #: the text of each word


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array without NULL, and each text's offset in them."""
    wide = texts.cast(pa.large_string())
    _, offsets, data = wide.buffers()
    offsets = np.frombuffer(offsets, np.int64)[wide.offset : wide.offset + len(wide) + 1] if len(wide) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(texts: pa.Array, lower: bool) -> Words:
    data, offsets = text_bytes(texts)
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(data, offsets, none.astype(np.uint64), none, none, none)
    inside = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    power, inverse = _powers(n)
    if len(starts):
        sums = np.add.reduceat((_LOWERED if lower else _AS_IS)[data] * power[:n], starts)
        hashes = mixed(sums * inverse[starts] + (ends - starts).astype(np.uint64) * GOLDEN)
    else:
        hashes = np.zeros(0, np.uint64)
    return Words(data, offsets, hashes, starts, ends, np.searchsorted(offsets, starts, "right") - 1)


def _moved(w: Words, joins: np.ndarray) -> np.ndarray:
    """The words' ends, each moved on to the next place between two characters that ``joins`` does not have side by side."""
    data, n = w.bytes, len(w.bytes)
    cuts = w.ends.copy()
    todo = np.arange(len(cuts))
    edge = np.zeros(n + 1, bool)
    edge[w.offsets] = True
    while len(todo):
        at = cuts[todo]
        todo = todo[~edge[at]]
        at = cuts[todo]
        left, right = data[at - 1], data[at]
        mark = (right == 0xE2) & (data[np.minimum(at + 1, n - 1)] == 0x96) & (data[np.minimum(at + 2, n - 1)] == 0x81)
        right = np.where(mark, 32, right)
        mark = (left == 0x81) & (data[np.maximum(at - 2, 0)] == 0x96) & (data[np.maximum(at - 3, 0)] == 0xE2)
        left = np.where(mark, 32, left)
        todo = todo[joins[left, right] | (right & 0xC0 == 0x80)]
        cuts[todo] += 1
    return cuts


def spaced_words(w: Words, joins: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts cut behind each word, so that each part is a word and the white space before it.

    Hash, first byte, end and text of each part; what follows a text's last word is a
    part too, and the first part of a text has a hash of its own kind.  ``joins`` tells
    for two bytes, the mark of a space counting as one, whether they must stay together
    where one ends a character and the next begins one; such cuts move on.
    """
    cuts = np.unique(np.concatenate([w.offsets, w.ends if joins is None else _moved(w, joins)]))
    starts, ends = cuts[:-1], cuts[1:]
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    power, inverse = _powers(len(w.bytes))
    sums = np.add.reduceat((w.bytes.astype(np.uint64) + np.uint64(1)) * power[: len(w.bytes)], starts)
    doc = np.searchsorted(w.offsets, starts, "right") - 1
    first = (starts == w.offsets[doc]).astype(np.uint64)
    return mixed(sums * inverse[starts] + ((ends - starts).astype(np.uint64) * np.uint64(2) + first) * GOLDEN), starts, ends, doc


def windows(w: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of ``size`` words within a text, and the place of its first word."""
    n = len(w.hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = (total ^ w.hashes[k : k + n]) * MIX_2 + GOLDEN
    at = np.flatnonzero(w.doc[:n] == w.doc[size - 1 :])
    return mixed(total[at]), at


def distinct_shingles(texts: pa.Array, size: int = 5, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingles of each text, flat, and where each text's begin.

    A text with fewer words than ``size`` has one shingle, the whole sequence; a text
    without words has none.
    """
    w = words(texts, lower)
    rows = len(texts)
    per_doc = np.bincount(w.doc, minlength=rows)
    hashes, at = windows(w, size)
    doc = w.doc[at]
    short = np.flatnonzero((per_doc > 0) & (per_doc < size))
    if len(short):
        first = np.cumsum(per_doc) - per_doc
        whole = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            has = per_doc[short] > k
            whole[has] = (whole[has] ^ w.hashes[first[short][has] + k]) * MIX_1 + GOLDEN
        hashes, doc = np.concatenate([hashes, mixed(whole)]), np.concatenate([doc, short])
        order = np.argsort(doc, kind="stable")
        hashes, doc = hashes[order], doc[order]
    bounds = np.searchsorted(doc, np.arange(rows + 1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a > 1:
            hashes[a:b].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    counts = np.bincount(doc[new], minlength=rows)
    return hashes[new], np.concatenate([[0], np.cumsum(counts)])
