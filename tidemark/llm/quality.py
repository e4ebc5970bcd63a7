"""Quality rules: a linear-chain conditional random field labels the lines of a document.

Each line is described by a few bucketed measures (share of capitals, marks and
pipes per word, repeated neighbours, word lengths, whether it is repeated, ...).  A
conditional random field with two labels, boilerplate and content, scores the
buckets and the change of label from line to line; Viterbi decoding labels all lines of a
document together, and the share of bytes in content lines decides whether the
document stays.

The field is fitted by gradient ascent on its exact log-likelihood, on the driver, on
at most ``train_rows`` labelled documents of at most ``train_chars`` characters: of
each label those whose ids have the least hash.  A line's training label is its
document's.  The threshold on the share is where the shares of good and of other
documents kept of a held-out third differ most, which labels that are wrong here
and there do not move; of thresholds within ``lost`` of that it is the middle of the
lowest ones that are alike, of which those up to a half and those above it are not.

Counts are exact and cover whole texts.  NULL counts as empty; a document without
words fails by rule.  Rows are handled one by one, so repeated rows give repeated
results; other columns are not read.  Without labels, rules alone decide, and a warning
says so.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices
from tidemark.llm.shingles import GOLDEN, mixed, windows, words

TRAIN_ROWS, TRAIN_CHARS, LOST, SEED = 3000, 20_000, 0.002, 7

#: Bytes of the sample that the driver counts at once.
TRAIN_SLICE = 1 << 19

_ALL = np.arange(256, dtype=np.uint64) + np.uint64(1)
_BASE = np.uint64(0xD6E8FEB86659FD93)


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, np.uint64)
    out[list(chars)] = 1
    return out


_UPPER, _LOWER = _class(bytes(range(65, 91))), _class(bytes(range(97, 123)))
_DIGIT, _SYMBOL, _SHOUT, _PIPE = _class(b"0123456789"), _class(b"#*$%&|<>"), _class(b"!?"), _class(b"|")
_VISIBLE = np.ones(256, np.uint64)
_VISIBLE[[9, 10, 11, 12, 13, 32]] = 0
_POINT = _VISIBLE.copy()
_POINT[128:192] = 0  # bytes that continue a code point
_HALF = np.uint64(32)

#: Upper bounds of the buckets of each measure.
BUCKETS = {
    "capitals": (0.05, 0.15, 0.3, 0.6),
    "symbols": (0.01, 0.1, 0.3, 0.7),
    "shouts": (0.01, 0.1, 0.3, 0.7),
    "pipes": (0.01, 0.1, 0.3),
    "repeats": (0.01, 0.1, 0.3, 0.6),
    "words": (0.5, 1.5, 3.5, 8.5, 20.5, 60.5),
    "length": (2.5, 4.0, 5.5, 7.0, 9.0, 13.0),
    "digits": (0.01, 0.1, 0.3),
    "copy": (0.5,),
}
_OFFSETS = np.cumsum([0] + [len(b) + 1 for b in BUCKETS.values()])
WIDTH = int(_OFFSETS[-1])


class Counted(NamedTuple):
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    codes: np.ndarray  #: lines by measures: the bucket's number among all buckets
    line_bytes: np.ndarray
    line_bounds: np.ndarray  #: where each document's lines begin, and the end


def _per_doc(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def count(texts: pa.Array) -> Counted:
    """The counts of each text and the measures of its lines."""
    w = words(texts, lower=False)
    data, offsets, rows = w.bytes, w.offsets, len(texts)
    n_words = np.bincount(w.doc, minlength=rows)
    hashes, at = windows(w)
    repeated = np.zeros(len(w.hashes) + 5, np.int64)
    if len(at):
        _, place, counts = np.unique(mixed(hashes ^ mixed(w.doc[at].astype(np.uint64) * GOLDEN)), return_inverse=True, return_counts=True)
        twice = at[counts[place] > 1]
        np.add.at(repeated, twice, 1)
        np.add.at(repeated, twice + 5, -1)
    in_repeat = np.cumsum(repeated)[: len(w.hashes)] > 0
    n_repeat = np.bincount(w.doc[in_repeat], minlength=rows)

    breaks = np.flatnonzero(data == 10) + 1
    starts = np.unique(np.concatenate([offsets[:-1], breaks[breaks < len(data)]])) if len(data) else np.zeros(0, np.int64)
    starts = starts[starts < len(data)]
    bounds = np.searchsorted(starts, offsets)
    if not len(starts):
        none = np.zeros((0, len(BUCKETS)), np.int64)
        zero = np.zeros(rows, np.int64)
        return Counted(n_words, zero, zero, zero, n_repeat, none, np.zeros(0, np.int64), bounds)
    stops = np.append(starts[1:], len(data))

    def sums(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        both = np.add.reduceat((low | high << _HALF)[data], starts)
        return (both & np.uint64(0xFFFFFFFF)).astype(np.int64), (both >> _HALF).astype(np.int64)

    upper, lower = sums(_UPPER, _LOWER)
    digit, symbol = sums(_DIGIT, _SYMBOL)
    shout, pipe = sums(_SHOUT, _PIPE)
    visible, points = sums(_VISIBLE, _POINT)
    line_of = np.searchsorted(starts, w.starts, "right") - 1
    per_line = np.bincount(line_of, minlength=len(starts))
    same = np.zeros(len(starts), np.int64)
    if len(w.hashes) > 1:
        pair = np.flatnonzero((w.hashes[1:] == w.hashes[:-1]) & (line_of[1:] == line_of[:-1]))
        same = np.bincount(line_of[pair], minlength=len(starts))
    doc_of = np.searchsorted(offsets, starts, "right") - 1
    newline = (data[stops - 1] == 10).astype(np.int64)
    power = np.multiply.accumulate(np.full(int((stops - starts).max()), _BASE))
    inside = np.arange(len(data)) - np.repeat(starts, stops - starts)
    whole = np.add.reduceat(np.where(data == 10, np.uint64(0), _ALL[data] * power[inside]), starts)
    whole = mixed(whole + (stops - starts - newline).astype(np.uint64) * GOLDEN)
    worded = per_line > 0
    key = mixed(whole ^ mixed(doc_of.astype(np.uint64) * GOLDEN))
    _, first = np.unique(key[worded], return_index=True)
    copy = worded.copy()
    copy[np.flatnonzero(worded)[first]] = False

    count_of = np.maximum(per_line, 1)
    measures = {
        "capitals": upper / np.maximum(upper + lower, 1),
        "symbols": symbol / count_of,
        "shouts": shout / count_of,
        "pipes": pipe / count_of,
        "repeats": same / count_of,
        "words": per_line,
        "length": visible / count_of,
        "digits": digit / np.maximum(visible, 1),
        "copy": copy,
    }
    codes = np.stack([_OFFSETS[i] + np.searchsorted(BUCKETS[m], v) for i, (m, v) in enumerate(measures.items())], axis=1)
    line_offsets = bounds
    return Counted(
        n_words, _per_doc(points, line_offsets), _per_doc(symbol, line_offsets), _per_doc(copy, line_offsets), n_repeat, codes, visible, bounds
    )


@dataclass(frozen=True)
class Field:
    """Weights of the buckets and of the change from label to label (0 boilerplate, 1 content), and the share to reach."""

    emit: np.ndarray
    move: np.ndarray
    share: float

    def shares(self, codes: np.ndarray, sizes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Of each document, the share of bytes in lines that Viterbi decoding labels content; 0 without any."""
        score = self.emit[:, codes].sum(axis=2).T
        labels = viterbi(score, self.move, bounds)
        total, good = _per_doc(sizes, bounds), _per_doc(sizes * labels, bounds)
        return good / np.maximum(total, 1)


def _by_place(bounds: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each place in a document, the documents that reach it."""
    counts = np.diff(bounds)
    order = np.argsort(-counts, kind="stable")
    sorted_counts = -counts[order]
    for k in range(int(counts.max(initial=0))):
        yield k, order[: np.searchsorted(sorted_counts, -k, "left")]


def viterbi(score: np.ndarray, move: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The best label of each line: ``score`` by line and label, ``move`` from label to label."""
    n = len(score)
    back, best = np.zeros((n, 2), np.int8), score.astype(float).copy()
    places = list(_by_place(bounds))
    for k, docs in places[1:]:
        line = bounds[docs] + k
        ways = best[line - 1][:, :, None] + move[None]
        back[line] = ways.argmax(axis=1)
        best[line] += ways.max(axis=1)
    labels = np.zeros(n, np.int64)
    last = bounds[1:][np.diff(bounds) > 0] - 1
    labels[last] = best[last].argmax(axis=1)
    for k, docs in reversed(places[1:]):
        line = bounds[docs] + k
        labels[line - 1] = back[line, labels[line]]
    return labels


def log_likelihood(score: np.ndarray, move: np.ndarray, bounds: np.ndarray, labels: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Of the labels given the lines; with each line's label probabilities and the expected moves, by forward and backward sums."""
    alpha, beta = score.astype(float).copy(), np.zeros((len(score), 2))
    places = list(_by_place(bounds))
    for k, docs in places[1:]:
        line = bounds[docs] + k
        alpha[line] += np.logaddexp(alpha[line - 1, 0, None] + move[0], alpha[line - 1, 1, None] + move[1])
    for k, docs in reversed(places[1:]):
        line = bounds[docs] + k
        after = score[line] + beta[line]
        beta[line - 1] = np.logaddexp(move[:, 0] + after[:, 0, None], move[:, 1] + after[:, 1, None])
    last = bounds[1:][np.diff(bounds) > 0] - 1
    total = np.logaddexp(alpha[last, 0], alpha[last, 1])
    of_line = np.repeat(total, np.diff(bounds)[np.diff(bounds) > 0])
    marginal = np.exp(alpha + beta - of_line[:, None])
    follows = np.ones(len(score), bool)
    follows[bounds[:-1][np.diff(bounds) > 0]] = False
    line = np.flatnonzero(follows)
    joint = np.exp(alpha[line - 1][:, :, None] + move[None] + (score[line] + beta[line])[:, None, :] - of_line[line, None, None])
    value = score[np.arange(len(score)), labels].sum() + move[labels[line - 1], labels[line]].sum() - total.sum()
    return float(value), marginal, joint.sum(axis=0)


def fit(codes: np.ndarray, bounds: np.ndarray, labels: np.ndarray, steps: int = 80, rate: float = 0.2, decay: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights by gradient ascent (Adam) on the mean log-likelihood less a small penalty."""
    emit, move = np.zeros((2, WIDTH)), np.zeros((2, 2))
    n = max(len(codes), 1)
    seen = np.zeros((2, WIDTH))
    for y in (0, 1):
        np.add.at(seen[y], codes[labels == y].ravel(), 1)
    follows = np.ones(len(codes), bool)
    follows[bounds[:-1][np.diff(bounds) > 0]] = False
    line = np.flatnonzero(follows)
    moves = np.zeros((2, 2))
    np.add.at(moves, (labels[line - 1], labels[line]), 1)
    first, second = np.zeros(2 * WIDTH + 4), np.zeros(2 * WIDTH + 4)
    for t in range(1, steps + 1):
        _, marginal, joint = log_likelihood(emit[:, codes].sum(axis=2).T, move, bounds, labels)
        expected = np.stack([np.bincount(codes.ravel(), np.repeat(marginal[:, y], codes.shape[1]), WIDTH) for y in (0, 1)])
        slope = np.concatenate([((seen - expected) / n - decay * emit).ravel(), ((moves - joint) / n - decay * move).ravel()])
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        step = rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
        emit, move = emit + step[: 2 * WIDTH].reshape(2, WIDTH), move + step[2 * WIDTH :].reshape(2, 2)
    return emit, move


def threshold(good: np.ndarray, bad: np.ndarray, lost: float) -> float:
    """Where the parts of good and bad documents with at least that share differ most, over all shares; a half parts those that are alike."""
    good, bad = np.sort(good), np.sort(bad)
    at = np.unique(np.concatenate([good, bad, [0.5]]))
    gain = np.searchsorted(bad, at) / len(bad) - np.searchsorted(good, at) / len(good)
    first = int(np.flatnonzero(gain >= gain.max() - lost)[0])
    below = float(at[first - 1]) if first else 0.0
    return (below + float(at[first])) / 2 if gain[first] > 0 else 0.0


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS, lost: float = LOST) -> Field | None:
    """The field fitted on at most ``rows`` labelled documents; None if one of the labels is missing."""
    order = F.xxhash64(doc_id, F.lit(SEED))
    marked = labels.select(F.col(doc_id), F.col("quality").cast("int").alias("__y")).filter("__y IN (0, 1)")
    short = docs.select(F.col(f"`{doc_id}`").alias(doc_id), F.col(f"`{text}`").alias("__text")).filter(F.length("__text").between(1, chars))
    sample = []
    for y in (0, 1):
        usable = marked.filter(F.col("__y") == y).select(doc_id).distinct().join(short.select(doc_id), doc_id, "left_semi")
        chosen = usable.orderBy(order, doc_id).limit(rows // 2)
        sample += [(r["__text"], y) for r in short.join(F.broadcast(chosen), doc_id).orderBy(order, doc_id, "__text").limit(rows // 2).collect()]
    if len({y for _, y in sample}) < 2:
        warnings.warn("no field for the lines: labelled documents of one quality are missing, rules alone decide", stacklevel=2)
        return None
    table = pa.RecordBatch.from_arrays([pa.array([t for t, _ in sample])], ["text"])
    parts = [count(text) for _, text in slices(iter([table]), 0, TRAIN_SLICE)]
    all_codes, all_bytes = np.concatenate([c.codes for c in parts]), np.concatenate([c.line_bytes for c in parts])
    all_sizes = np.concatenate([np.diff(c.line_bounds) for c in parts])
    y = np.array([y for _, y in sample])
    held = np.random.default_rng(SEED).random(len(y)) < 1 / 3
    if not (held & (y == 1)).any() or not (held & (y == 0)).any() or not (~held & (y == 1)).any() or not (~held & (y == 0)).any():
        held[:] = False

    def part(which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        line = np.repeat(which, all_sizes)
        return all_codes[line], all_bytes[line], np.concatenate([[0], np.cumsum(all_sizes[which])]), np.repeat(y[which], all_sizes[which])

    codes, _, bounds, line_labels = part(~held)
    emit, move = fit(codes, bounds, line_labels)
    codes, sizes, bounds, _ = part(held if held.any() else ~held)
    shares = Field(emit, move, 0.5).shares(codes, sizes, bounds)
    judged_y = y[held if held.any() else ~held]
    return Field(emit, move, threshold(shares[judged_y == 1], shares[judged_y == 0], lost))


def verdicts(texts: pa.Array, field: Field | None) -> tuple[Counted, np.ndarray, np.ndarray, np.ndarray]:
    """The counts of each text, its content share, whether it fails by rule, and whether it stays."""
    c = count(texts)
    share = np.ones(len(texts)) if field is None else field.shares(c.codes, c.line_bytes, c.line_bounds)
    failed = (c.n_words < 10) | (100 * c.n_repeat_words > 20 * c.n_words)
    return c, share, failed, ~failed & (share >= (0 if field is None else field.share))


def _judge(batches: Iterator[pa.RecordBatch], field: Field | None) -> Iterator[pa.RecordBatch]:
    for batch, text in slices(batches, 1):
        c, share, failed, kept = verdicts(text, field)
        numbers = [pa.array(v.astype(np.int64)) for v in (c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat_words)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *numbers, pa.array(failed), pa.array(kept), pa.array(share.astype(float))],
            ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share"],
        )


def judged(docs: DataFrame, field: Field | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: doc_id, the counts, base_failed, kept and content_share."""
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        partial(_judge, field=field),
        f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double",
    )


def _keep(batches: Iterator[pa.RecordBatch], field: Field | None, column: int) -> Iterator[pa.RecordBatch]:
    for batch, text in slices(batches, column):
        yield batch.filter(pa.array(verdicts(text, field)[3]))


def without_rejected(docs: DataFrame, field: Field | None, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return docs.mapInArrow(partial(_keep, field=field, column=docs.columns.index(text)), docs.schema)
