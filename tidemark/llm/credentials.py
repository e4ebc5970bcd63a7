"""Secrets: fixed patterns, and a character convolutional network over every other candidate.

Base spans, leftmost and without overlap in each kind:

assign   a name for a secret, a colon or equals sign, and a value of 8 or more characters
access   ``AKIA`` and capitals or digits, 16 or more characters together
hex      32 or more lower-case hexadecimal digits

Candidates are every run of 16 or more characters of ``A-Za-z0-9+/_=-``, and every string
of 8 or more characters but white space and quotes behind a cue word (end marks are left
off).  Where a base span touches one, its parts outside base spans are candidates, however
short.  A small network written in NumPy reads each with its surroundings: one-hot
characters, one convolution of width 5, the greatest response of each filter over the
candidate and over its context, and a logistic layer.  Long candidates are read whole, in
overlapping windows, and the highest score counts.  A candidate whose calibrated score
reaches the threshold becomes a span of kind ``model``, one with those it overlaps.

The network is trained on the driver on labelled findings: the base spans of at most
``rows`` documents (texts of at most ``chars`` characters, least hash of the id first) are
secrets, as are the values of their assignments alone; the other candidates of the same
documents and up to ``WORDS`` ordinary words of each are not; but candidates
that may be keys of no base kind (digits with letters, or letters of changing case, as
mixed as random ones), what stands beside a base span and values behind a cue that are
not plain words have no label.  On a held-out third, scores are calibrated by a
logistic fit.  The threshold is the least, from 0.5 on, that at most ``harm`` of the
harmless runs reach, but never above what still recalls ``recall`` of the secrets.
Without findings there is no network and base spans stand alone.

NULL counts as empty; rows are handled one by one, so repeated rows repeat their spans;
columns are addressed by name.  Positions count code points, ends are exclusive.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import islice, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices

KINDS = ("assign", "access", "hex", "model")
BASE = KINDS[:3]
ROWS, CHARS, RECALL, HARM, SEED = 1500, 20_000, 0.95, 0.001, 11

#: Fixed patterns of the base kinds; a failing match is dropped.
ASSIGN = re.compile(r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")

#: Part of each name that a text must have, in lower case, before the pattern is tried.
NAMES = ("passw", "secret", "token", "apikey", "api_key")

RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Words that announce a secret, and the string behind one.
CUES = ("pass", "pwd", "secret", "token", "key", "auth", "bearer", "credential")
CUED = re.compile(
    r"(?ai)(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|key|auth(?:orization)?|bearer|credentials?)[\"']?(?:[ \t]*(?:[:=]>?|=>|\bis\b)[ \t]*|[ \t]+)(?:(?:bearer|basic|token)[ \t]+)?[\"'`]?([^\s\"'`<>]{8,})"
)
MARKS = ".,;:!?)]}"
PLAIN = re.compile(r"[^\W\d_]+[-'’]?[^\W\d_]*[.,;:!?)\]}|%$&#*]*")
WORD, WORDS = re.compile(r"(?<![^\s])[a-z]{8,15}(?![^\s])"), 4
DIGIT, ALNUM = re.compile(r"[0-9]"), re.compile(r"[^\W_]")

Span = tuple[str, int, int]

#: Characters before and after a candidate that the network sees, characters of one window, and how far windows move.
BEFORE, AFTER, WINDOW, STEP = 16, 8, 48, 24
WIDTH, FILTERS = 5, 24

#: Windows that the network reads at once; each takes some 30 KB as it does.
VIEWS = 1024

#: Groups of characters that share a one-hot place; anything else has the last one.
GROUPS = ("aeiou", "bcdfghjklmnpqrstvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "+/", "_-", "=", ":", "\"'", " ", "\n", ".,;!?", "@", "#$%&*|<>()[]{}")
_PLACE = {c: i for i, group in enumerate(GROUPS) for c in group}
HEX_LETTERS, OTHER, OUTSIDE = len(GROUPS), len(GROUPS) + 1, len(GROUPS) + 2
CHANNELS = len(GROUPS) + 2


def base_spans(text: str) -> list[Span]:
    """By start, then kind as listed."""
    out: list[Span] = []
    low = text.lower() if text.isascii() else text.translate(_ASCII_LOWER)
    if any(n in low for n in NAMES):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


_ASCII_LOWER = {i: i + 32 for i in range(65, 91)}


def candidates(text: str, taken: list[Span]) -> list[tuple[int, int, str]]:
    """Start, end and sort of each candidate outside base spans: a ``run``, what is ``cued``, or ``part`` of one that a base span touches."""
    found = dict.fromkeys((m.span() for m in RUN.finditer(text)), "run")
    low = text.lower()
    if any(c in low for c in CUES):
        at = 0
        while (m := CUED.search(text, at)) is not None:
            a, b = m.span(1)
            at = a  # the string behind a cue may be a cue itself
            b = a + len(text[a:b].rstrip(MARKS))
            if b - a >= 8:
                found.setdefault((a, b), "cued")
    out: dict[tuple[int, int], str] = {}
    spans, first = sorted((s, e) for _, s, e in taken), 0
    for (a, b), sort in sorted(found.items()):
        while first < len(spans) and spans[first][1] <= a:
            first += 1
        at, touched = a, False
        for k in range(first, len(spans)):
            s, e = spans[k]
            if s >= b:
                break
            if e > at:
                touched = True
                if s > at and ALNUM.search(text, at, s):
                    out[at, s] = "part"
                at = e
        if not touched:
            out[a, b] = sort
        elif at < b and ALNUM.search(text, at, b):
            out[at, b] = "part"
    return [(a, b, sort) for (a, b), sort in out.items()]


def may_be_key(run: str) -> bool:
    """Whether a run is as mixed as a random key: no example of what is harmless."""
    if len(set(run)) < 10 or not any(c.isalpha() for c in run):
        return False
    rises = sum(a.islower() and b.isupper() for a, b in pairwise(run))
    return DIGIT.search(run) is not None or 5 * rises >= len(run)


def _code(c: str) -> int:
    return HEX_LETTERS if c in "abcdef" else _PLACE.get(c, OTHER)


def views(text: str, start: int, end: int) -> list[list[int]]:
    """Character codes of each window of a candidate, with its surroundings; candidate codes are shifted behind context codes."""
    out = []
    size = BEFORE + WINDOW + AFTER
    for at in range(start, max(end - WINDOW + STEP, start + 1), STEP):
        stop = min(at + WINDOW, end)
        left, body, right = text[max(at - BEFORE, 0) : at], text[at:stop], text[stop : stop + AFTER]
        codes = [OUTSIDE] * (BEFORE - len(left)) + [_code(c) for c in left] + [CHANNELS + 1 + _code(c) for c in body]
        codes += [OUTSIDE] * (WINDOW - len(body)) + [_code(c) for c in right]
        out.append(codes + [OUTSIDE] * (size - len(codes)))
    return out


def _embedding() -> np.ndarray:
    """One-hot characters with a mark for being part of the candidate."""
    table = np.zeros((2 * (CHANNELS + 1), CHANNELS + 1), np.float32)
    for i in range(CHANNELS):
        table[i, i] = 1
        table[CHANNELS + 1 + i, i] = table[CHANNELS + 1 + i, CHANNELS] = 1
    return table


@dataclass(frozen=True)
class Network:
    kernel: np.ndarray  #: width x channels by filters
    bias: np.ndarray
    out: np.ndarray
    slope: float
    shift: float
    threshold: float

    def probability(self, codes: np.ndarray) -> np.ndarray:
        """Calibrated probability that each view shows a secret."""
        score = _forward(codes, self.kernel, self.bias, self.out)[0]
        return 1 / (1 + np.exp(-np.clip(self.slope * score + self.shift, -60, 60)))


def _patches(codes: np.ndarray) -> np.ndarray:
    x = _embedding()[codes]
    view = np.lib.stride_tricks.sliding_window_view(x, WIDTH, axis=1)
    return np.ascontiguousarray(view.transpose(0, 1, 3, 2)).reshape(len(codes), view.shape[1], -1)


def _forward(codes: np.ndarray, kernel: np.ndarray, bias: np.ndarray, out: np.ndarray) -> tuple[np.ndarray, tuple]:
    patches = _patches(codes)
    response = np.maximum(patches @ kernel + bias, 0)
    best = response.argmax(axis=1)
    peak = np.take_along_axis(response, best[:, None], 1)[:, 0]
    share = response.mean(axis=1) * 8
    features = np.concatenate([peak, share, np.ones((len(codes), 1), np.float32)], axis=1)
    return features @ out, (patches, response, best, features)


def _logistic(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a calibration by a few Newton steps, with targets drawn in from 0 and 1."""
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    w = np.array([1.0, 0.0])
    x = np.stack([score, np.ones_like(score)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        w = w + np.clip(np.linalg.solve(hess, x.T @ (target - p) - 1e-3 * w), -1, 1)
    return float(w[0]), float(w[1])


def fit(codes: np.ndarray, y: np.ndarray, recall: float = RECALL, harm: float = HARM, steps: int = 300, batch: int = 128, rate: float = 0.01) -> Network:
    """A network trained by Adam on two thirds of the examples, calibrated and cut on the rest."""
    rng = np.random.default_rng(SEED)
    held = np.zeros(len(y), bool)
    for label in (0, 1):
        mine = rng.permutation(np.flatnonzero(y == label))
        held[mine[: len(mine) // 3]] = True
    train = np.flatnonzero(~held)
    weights = [
        rng.normal(0, 0.2, (WIDTH * (CHANNELS + 1), FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.2, 2 * FILTERS + 1).astype(np.float32),
    ]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    good, bad = train[y[train] == 1], train[y[train] == 0]
    for t in range(1, steps + 1):
        rows = np.concatenate([rng.choice(good, batch // 2), rng.choice(bad, batch // 2)])
        score, (patches, response, best, features) = _forward(codes[rows], *weights)
        error = ((1 / (1 + np.exp(-score)) - y[rows]) / len(rows)).astype(np.float32)
        peak, share = np.outer(error, weights[2][:FILTERS]), np.outer(error, weights[2][FILTERS:-1]) * 8 / response.shape[1]
        down = np.repeat(share[:, None], response.shape[1], axis=1)
        np.put_along_axis(down, best[:, None], np.take_along_axis(down, best[:, None], 1) + peak[:, None], 1)
        down *= response > 0
        slopes = [np.einsum("npc,npf->cf", patches, down, optimize=True), down.sum(axis=(0, 1)), features.T @ error]
        for k, slope in enumerate(slopes):
            slope = slope + 1e-4 * weights[k]
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.999 * second[k] + 0.001 * slope**2
            weights[k] = weights[k] - rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    rest = np.flatnonzero(held) if held.any() and len(set(y[held])) == 2 else np.arange(len(y))
    score = _forward(codes[rest], *weights)[0].astype(float)
    slope, shift = _logistic(score, y[rest].astype(float))
    p = 1 / (1 + np.exp(-np.clip(slope * score + shift, -60, 60)))
    secrets, harmless = np.sort(p[y[rest] == 1]), np.sort(p[y[rest] == 0])
    bound = float(np.nextafter(harmless[-1 - int(harm * len(harmless))], 2))
    threshold = min(float(secrets[int((1 - recall) * len(secrets))]), max(bound, 0.5))
    return Network(*weights, slope, shift, threshold)


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rows: int = ROWS, chars: int = CHARS, recall: float = RECALL) -> Network | None:
    """The network trained on the findings in at most ``rows`` documents; None, with a warning, without any.

    The documents are those with cues whose hashes are least.  They are counted first, so
    that each task passes on only hashes that can be among them: what reaches the driver
    does not grow with the input.
    """
    low = F.lower("__text")
    cue = F.contains(F.col("__text"), F.lit("AKIA"))
    for name in NAMES:
        cue = cue | F.contains(low, F.lit(name))
    source = docs.select(F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`"), F.lit(SEED)).alias("__order"), F.col(f"`{text}`").alias("__text"))
    cued = source.filter(F.length("__text") <= chars).filter(cue)
    # Twice as many as are wanted lie below the bound, give or take a few in a hundred.
    share = 2 * rows / max(cued.count(), 1)
    near = cued if share >= 1 else cued.filter(F.col("__order") < int(share * 2**64) - 2**63)
    sample = near.orderBy("__order", "__text").limit(rows)
    codes, y = [], []
    for row in sample.collect():
        t = row["__text"]
        spans = base_spans(t)
        good = [(a, b) for _, a, b in spans] + [m.span(2) for m in ASSIGN.finditer(t) if len(m.group(2)) >= 8]
        bad = [(a, b) for a, b, sort in candidates(t, spans) if (sort == "run" and not may_be_key(t[a:b])) or (sort == "cued" and PLAIN.fullmatch(t, a, b))]
        bad += [m.span() for m in islice(WORD.finditer(t), WORDS)]
        for label, places in ((1, good), (0, bad)):
            for a, b in places:
                seen = views(t, a, b)
                codes += seen
                y += [label] * len(seen)
    if min(y.count(0), y.count(1)) < 10:
        warnings.warn("no network for secrets: too few findings to learn from, base patterns alone decide", stacklevel=2)
        return None
    return fit(np.array(codes, np.int16), np.array(y), recall)


def find(texts: list[str | None], network: Network | None) -> list[list[Span]]:
    """All spans of each text, by start, then kind as listed; candidates of all texts are scored together."""
    out = [base_spans(t) if t else [] for t in texts]
    if network is None:
        return out
    places, codes = [], []
    for i, t in enumerate(texts):
        for a, b, _ in candidates(t, out[i]) if t else []:
            for view in views(t, a, b):
                places.append((i, a, b))
                codes.append(view)
    extra = set()
    for at in range(0, len(codes), VIEWS):
        p = network.probability(np.array(codes[at : at + VIEWS], np.int16))
        extra.update(places[at + int(k)] for k in np.flatnonzero(p >= network.threshold))
    ends = [0] * len(texts)
    for i, a, b in sorted(extra):
        if a < ends[i]:
            _, start, end = out[i].pop()
            out[i].append(("model", start, max(end, b)))
        else:
            out[i].append(("model", a, b))
        ends[i] = max(ends[i], b)
    return [sorted(s, key=lambda s: (s[1], KINDS.index(s[0]))) for s in out]


def _find_batches(batches: Iterator[pa.RecordBatch], network: Network | None) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    for batch, text in slices(batches, 1):
        found = find(text.to_pylist(), network)
        spans = [[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in found]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(span))], ["doc_id", "spans"])


def secrets(docs: DataFrame, network: Network | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: doc_id and spans, an array of (kind, start, end)."""
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(partial(_find_batches, network=network), f"doc_id {kind}, spans array<struct<kind string, start long, end long>>")


def _hide(batches: Iterator[pa.RecordBatch], network: Network | None, column: int, count: int | None, mask: str) -> Iterator[pa.RecordBatch]:
    for batch, _ in slices(batches, column):
        texts = batch.column(column).to_pylist()
        new = []
        for t, spans in zip(texts, find(texts, network), strict=True):
            parts, at = [], 0
            for _, a, b in spans:
                if b > at:
                    parts += [t[at : max(a, at)], mask if a >= at else ""]
                    at = b
            new.append("".join([*parts, t[at:]]) if parts else t)
        columns = batch.columns
        columns[column] = pa.array(new, batch.schema.field(column).type)
        if count is not None:
            columns[count] = pa.array([None if t is None else len(t) for t in new], batch.schema.field(count).type)
        yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)


def without_secrets(docs: DataFrame, network: Network | None, text: str = "text", chars: str = "n_chars", mask: str = "[secret]") -> DataFrame:
    """All rows of ``docs``, each span (or run of overlapping spans) in the text replaced by ``mask``; ``chars`` counts anew where there is such a column."""
    count = docs.columns.index(chars) if chars in docs.columns else None
    return docs.mapInArrow(partial(_hide, network=network, column=docs.columns.index(text), count=count, mask=mask), docs.schema)
