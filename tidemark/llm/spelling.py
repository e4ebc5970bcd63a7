"""Grouping spelling variants: words one edit apart, found through one-edit neighbourhoods over a reduced alphabet.

Letters are hashed to ``SYMBOLS`` symbols.  Two words one edit apart have reduced words
at most one edit apart, so every word looks up all reduced words within one edit of its
own: itself, each symbol replaced, each symbol deleted, each symbol put in anywhere.
A reduced word alone fits many words.  But an edit leaves one half of the word as it is,
so each key also has the hash of that half in full letters: a neighbour edited in the
right half asks for words that begin with the same letters, one edited in the left half
for words that end with them.  Each entry of the vocabulary answers to three lengths
and two halves.  What meets is verified on the original strings, and counted only on the
side where the first difference lies, so no pair is found twice.

Reduced words are polynomials modulo 2**64, so a neighbour's hash is a sum of prefix,
symbol and suffix, computed for all words of a batch at once; equal hashes of different
strings only add pairs that verification drops.  Every look-up is a join of short rows
on a selective key; no group emits all its pairs.

Runs of letters are counted per slice of texts before they are shuffled.  NULL texts and
texts without letters have no words; a NULL doc_id is written as nothing.  Repeated rows
count as often as they occur.  Of near words of equal count the least one is the form.
An empty table has no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, written
from tidemark.llm.shingles import GOLDEN, MIX_1, mixed

SYMBOLS = 4

#: Runs of letters, the lower-casing of A to Z alone, least length and count, and how many runs lose a letter: fixed values.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
MIN_LENGTH, MIN_COUNT, DAMAGED = 5, 3, 97

#: Distinct runs that a task counts before it hands them on.
_HELD = 1 << 17

#: Keys that a task makes at once.
_KEYS = 1 << 18

_BASE = 0xD1342543DE82EF95
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[str] = Counter()

    def flushed() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array(list(held.values()), pa.int64())], ["word", "n"])
        held.clear()
        return batch

    for batch, texts in slices(batches, 1):
        for doc_id, text in zip(batch.column(0).to_pylist(), texts.to_pylist(), strict=True):
            state = zlib.crc32(f"{doc_id or ''}:".encode())
            for run, n in Counter(RUN.findall(text.translate(_LOWER))).items():
                h = zlib.crc32(run.encode(), state)
                if h % DAMAGED == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                held[run] += n
        if len(held) > _HELD:
            yield flushed()
    if held:
        yield flushed()


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of all documents' runs of letters, lower-cased, some of them damaged, of a least length and count."""
    source = docs.select(F.col(f"`{doc_id}`").cast("string").alias("doc"), F.col(f"`{text}`").alias("text"))
    counts = source.mapInArrow(_count, "word string, n long").where(F.length("word") >= min_length)
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words, where each begins, and their lengths."""
    text = "".join(words.to_pylist())
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.asarray(pa.compute.utf8_length(words)).astype(np.int64)
    return codes, np.cumsum(lengths) - lengths, lengths


def reduced(codes: np.ndarray, symbols: int = SYMBOLS) -> np.ndarray:
    """The symbol of each letter, from 1."""
    return mixed(codes * GOLDEN) % np.uint64(symbols) + np.uint64(1)


def _prefixes(values: np.ndarray) -> np.ndarray:
    """Of each row of values, the polynomial of its first 0, 1, ... values."""
    n, width = values.shape
    out = np.zeros((n, width + 1), np.uint64)
    np.cumsum(values * _powers(width), axis=1, dtype=np.uint64, out=out[:, 1:])
    return out


def _powers(n: int) -> np.ndarray:
    steps = np.full(max(n, 1), _BASE, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)[:n]


def _key(word: np.ndarray, half: np.ndarray, length: int, asked: int, side: int) -> np.ndarray:
    """The join key of a reduced word of ``length`` symbols, asked for by words of ``asked`` letters with that half in common."""
    tag = np.uint64(((length * 1_000_003 + asked) * 2 + side) * int(GOLDEN) % (1 << 64))
    return mixed(mixed(word + tag) ^ (half * MIX_1)).view(np.int64)


def _halves(letters: np.ndarray, asked: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the letters before the middle of a word of ``asked`` letters and of as many as follow it, at the word's end."""
    middle = asked // 2
    before, after = letters[:, :middle], letters[:, letters.shape[1] - (asked - middle) :]
    return (before * _powers(before.shape[1])).sum(axis=1, dtype=np.uint64), (after * _powers(after.shape[1])).sum(axis=1, dtype=np.uint64)


def neighbour_keys(letters: np.ndarray, symbols: int = SYMBOLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the whole one-edit neighbourhood of words of one length: key, word's row and side (0: the left half is kept)."""
    n, length = letters.shape
    d = reduced(letters, symbols)
    p = _prefixes(d)
    total, power = p[:, -1], _powers(length + 1)
    base = np.uint64(_BASE)
    keys, rows, sides = [], [], []
    everyone = np.arange(n)

    def add(word: np.ndarray, kept: np.ndarray, new_length: int, side: int) -> None:
        where = everyone[kept]
        keys.append(_key(word[kept], halves[side][kept], new_length, length, side))
        rows.append(where)
        sides.append(np.full(len(where), side, np.int8))

    halves = _halves(letters, length)
    middle, all_rows = length // 2, np.ones(n, bool)
    with np.errstate(over="ignore"):
        for side, (begin, end) in enumerate(((middle, length), (0, middle))):
            add(total, all_rows, length, side)
            for at in range(begin, end):
                suffix = total - p[:, at + 1]
                fresh = all_rows if at == begin else d[:, at] != d[:, at - 1]
                add(p[:, at] + suffix * _INVERSE, fresh, length - 1, side)
                for step in range(1, symbols):
                    other = (d[:, at] - np.uint64(1) + np.uint64(step)) % np.uint64(symbols) + np.uint64(1)
                    add(total + (other - d[:, at]) * power[at], all_rows, length, side)
            for at in range(begin, end + (side == 0)):
                moved = p[:, at] + (total - p[:, at]) * base
                for symbol in range(1, symbols + 1):
                    fresh = all_rows if at == begin else d[:, at - 1] != symbol
                    add(moved + np.uint64(symbol) * power[at], fresh, length + 1, side)
    return np.concatenate(keys), np.concatenate(rows), np.concatenate(sides)


def entry_keys(letters: np.ndarray, symbols: int = SYMBOLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys under which words of one length are found, by words one letter shorter, as long, or longer."""
    n, length = letters.shape
    word = _prefixes(reduced(letters, symbols))[:, -1]
    keys, rows, sides = [], [], []
    for asked in (length - 1, length, length + 1):
        if asked < 1:
            continue
        for side, half in enumerate(_halves(letters, asked)):
            keys.append(_key(word, half, length, asked, side))
            rows.append(np.arange(n))
            sides.append(np.full(n, side, np.int8))
    return np.concatenate(keys), np.concatenate(rows), np.concatenate(sides)


def _keyed(batches: Iterator[pa.RecordBatch], entries: bool, symbols: int) -> Iterator[pa.RecordBatch]:
    """Rows (key, side, word[, n]) of the vocabulary's words, made for words of one length at a time."""
    make = entry_keys if entries else neighbour_keys
    names = ["key", "side", "word"] + ["n"] * entries
    for batch in batches:
        codes, begins, lengths = _letters(batch.column(0))
        for length in np.unique(lengths).tolist():
            chosen = np.flatnonzero(lengths == length)
            step = max(1, _KEYS // ((2 * symbols + 1) * (length + 1)))
            for at in range(0, len(chosen), step):
                part = chosen[at : at + step]
                keys, rows, sides = make(codes[begins[part, None] + np.arange(length)], symbols)
                picked = pa.array(part[rows])
                columns = [pa.array(keys), pa.array(sides), *(batch.column(k).take(picked) for k in range(1 + entries))]
                yield pa.RecordBatch.from_arrays(columns, names)


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(word, other, n): all ordered pairs of words of a (word, n) frame one edit apart, with the other's count."""
    asked = words.mapInArrow(partial(_keyed, entries=False, symbols=symbols), "key long, side tinyint, word string")
    found = words.mapInArrow(partial(_keyed, entries=True, symbols=symbols), "key long, side tinyint, word string, n long")
    pairs = asked.join(found.withColumnsRenamed({"word": "other", "side": "other_side"}), "key")
    middle = F.floor(F.length("word") / 2).cast("int")
    begins_alike = F.substr("word", F.lit(1), middle) == F.substr("other", F.lit(1), middle)
    here = (F.col("side") == F.col("other_side")) & (begins_alike == (F.col("side") == 0))
    return pairs.where(here & (F.levenshtein("word", "other", 1) == 1)).select("word", "other", "n")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of all words with a form, by pointer doubling; counts at least double with each step, so rounds are few."""
    roots = forms.select("word", F.col("form").alias("root"))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = written(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not roots.where("moved").limit(1).count():
            return roots.select("word", "root")
        roots = roots.select("word", "root")


def variant_groups(vocabulary: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """Per word of a (word, n) frame: its form, the root of its group, n, n_near and form_n.

    The form is the near word of the greatest count, if that is at least twice the
    word's own; the root is reached from form to form.
    """
    words = written(vocabulary.select("word", "n"), "vocabulary")
    best = near_words(words, symbols).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), F.col("other"))).alias("best"))
    has_form = -F.col("best.less") >= 2 * F.col("n")
    formed = written(
        words.join(best, "word", "left").select(
            "word",
            F.when(has_form, F.col("best.other")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(has_form, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(formed.where(F.col("form").isNotNull()))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
