"""Text canonicalisation and name similarity."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.weeks import as_column

UNKNOWN_CATEGORY = "UNK"
MISSING_LIST = "NA"


def canonical_list(c: Column | str) -> Column:
    """Comma-joined list with trimmed, sorted items; NULL becomes empty text."""
    items = F.transform(F.split(F.coalesce(as_column(c), F.lit("")), ","), lambda x: F.trim(x))
    return F.array_join(F.array_sort(items), ",")


def strip_counts(c: Column | str) -> Column:
    """Canonical list without its ``2x `` style count prefixes."""
    return canonical_list(F.regexp_replace(as_column(c), r"\d+x ", ""))


def normalise_name(c: Column | str) -> Column:
    """Trim, and turn each pair of spaces into one, in a single pass."""
    return F.regexp_replace(F.trim(as_column(c)), "  ", " ")


def clean_category(c: Column | str, fill: str | None = None) -> Column:
    """Spaces to underscores; NULL to the fill value when there is one."""
    cleaned = F.replace(as_column(c), F.lit(" "), F.lit("_"))
    return cleaned if fill is None else F.coalesce(cleaned, F.lit(fill))


def text_length(c: Column | str) -> Column:
    return F.length(as_column(c))


# Cells of one character matrix handled at a time: small enough for the processor
# cache, and a bound on the memory of a batch that holds very long texts.
_MATRIX_CELLS = 200_000
_BAG_SLOTS = 64


def _codes(texts: list[str], width: int) -> np.ndarray:
    out = np.zeros((len(texts), width), dtype=np.uint32)
    for i, t in enumerate(texts):
        if t:
            out[i, : len(t)] = np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32)
    return out


def _common_prefix(a: np.ndarray, b: np.ndarray, la: np.ndarray, lb: np.ndarray) -> np.ndarray:
    k = min(4, a.shape[1], b.shape[1])
    agree = (a[:, :k] == b[:, :k]) & (np.arange(k)[None, :] < np.minimum(la, lb)[:, None])
    return np.cumprod(agree, axis=1).sum(axis=1)


def _similarity_block(a: np.ndarray, b: np.ndarray, la: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """Jaro-Winkler similarity in 0..1 of aligned rows of character codes, all rows at once."""
    n, wa, wb = len(la), a.shape[1], b.shape[1]
    reach = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    cols, rows = np.arange(wb), np.arange(n)
    open_b = cols[None, :] < lb[:, None]
    hit_a = np.zeros((n, wa), dtype=bool)
    hit_b = np.zeros((n, wb), dtype=bool)
    furthest = int(reach.max()) if n else 0
    for i in range(wa):
        lo, hi = max(0, i - furthest), min(wb, i + furthest + 1)
        if lo >= hi:
            continue
        near = open_b[:, lo:hi] & (b[:, lo:hi] == a[:, i : i + 1])
        near &= np.abs(cols[None, lo:hi] - i) <= reach[:, None]
        near &= (i < la)[:, None]
        found = np.flatnonzero(near.any(axis=1))
        where = near[found].argmax(axis=1) + lo
        hit_a[found, i] = True
        hit_b[rows[found], where] = True
        open_b[rows[found], where] = False
    m = hit_a.sum(axis=1)
    span = max(min(wa, wb), 1)
    seq_a = np.take_along_axis(a, np.argsort(~hit_a, axis=1, kind="stable"), axis=1)[:, :span]
    seq_b = np.take_along_axis(b, np.argsort(~hit_b, axis=1, kind="stable"), axis=1)[:, :span]
    live = np.arange(span)[None, :] < m[:, None]
    swaps = ((seq_a != seq_b) & live).sum(axis=1) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(m > 0, (m / la + m / lb + (m - swaps) / m) / 3.0, 0.0)
    jaro = np.where((la == 0) & (lb == 0), 1.0, jaro)
    return np.where(jaro > 0.7, jaro + 0.1 * _common_prefix(a, b, la, lb) * (1.0 - jaro), jaro)


def _bags(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Character counts per text; characters that share a slot can only raise an overlap."""
    out = np.zeros((len(codes), _BAG_SLOTS), dtype=np.int32)
    for j in range(codes.shape[1]):
        inside = np.flatnonzero(lengths > j)
        out[inside, codes[inside, j] % _BAG_SLOTS] += 1
    return out


def similarity_scores(left: pd.Series, right: pd.Series, at_least: float = 0.0) -> pd.Series:
    """Aligned similarities; NULL in, NULL out.

    Each distinct text of a batch is encoded once.  A pair whose characters in
    common cannot lift it to ``at_least`` gets 0 without being aligned.  Pairs
    go by length, so that one long text does not widen the matrix of the others.
    """
    known = (left.notna() & right.notna()).to_numpy()
    out = np.full(len(left), np.nan)
    where = np.flatnonzero(known)
    if not len(where):
        return pd.Series(out)
    ids, texts = pd.factorize(pd.concat([left, right], ignore_index=True))
    li, ri = ids[: len(left)][where], ids[len(left) :][where]
    lengths = np.array([len(t) for t in texts])
    width = np.maximum(np.maximum(lengths[li], lengths[ri]), 1)
    order = np.argsort(width, kind="stable")
    score = np.zeros(len(where))
    start = 0
    while start < len(order):
        rough = int(np.searchsorted(width[order[start:]], 2 * width[order[start]], side="right"))
        wide = width[order[start + rough - 1]]
        part = order[start : start + max(1, min(rough, _MATRIX_CELLS // int(wide)))]
        start += len(part)
        here, local = np.unique(np.concatenate([li[part], ri[part]]), return_inverse=True)
        codes = _codes([texts[i] for i in here], int(wide))
        size = lengths[here]
        a, b = local[: len(part)], local[len(part) :]
        if at_least > 0:
            bags = _bags(codes, size)
            common = np.minimum(bags[a], bags[b]).sum(axis=1)
            with np.errstate(divide="ignore", invalid="ignore"):
                best = np.where(common > 0, (common / size[a] + common / size[b] + 1) / 3, 0.0)
            best = np.where((size[a] == 0) & (size[b] == 0), 1.0, best)
            best = best + 0.1 * _common_prefix(codes[a], codes[b], size[a], size[b]) * (1 - best)
            keep = best >= at_least - 1e-9
            part, a, b = part[keep], a[keep], b[keep]
        if len(part):
            score[part] = _similarity_block(codes[a], codes[b], size[a], size[b])
    out[where] = score
    return pd.Series(out)


def jaro_winkler(a: Column | str, b: Column | str, ignore_case: bool = True, at_least: int = 0) -> Column:
    """Jaro-Winkler similarity as a whole number 0..100, rounded down.

    Spark has no such function, so it runs as an Arrow UDF over whole batches.
    With ``at_least``, pairs that cannot reach that score may give 0.
    """
    a, b = as_column(a), as_column(b)
    if ignore_case:
        a, b = F.lower(a), F.lower(b)

    @F.pandas_udf(T.DoubleType())
    def score(left: pd.Series, right: pd.Series) -> pd.Series:
        return similarity_scores(left, right, at_least / 100)

    return F.floor(score(a, b) * 100 + F.lit(1e-9)).cast("int")
