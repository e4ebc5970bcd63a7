"""Fuzzy name matching: a Jaro-Winkler join that never compares all pairs.

The score of a pair can only reach the threshold when the two names share enough
characters.  With a common prefix of ``p`` characters (at most 4), a score of
``t`` needs a plain Jaro value of ``j = (t - p/10) / (1 - p/10)``, hence at least
``(3j - 1) * a*b / (a+b)`` common characters for lengths ``a`` and ``b``, which is
never less than ``(3j - 2) * a``.  Two sets with that overlap agree on at least
``w`` of the ``a - need + w`` rarest members of each, so those rare characters,
``w`` at a time and together with the prefix, serve as join keys.  No true match
is lost, and only pairs that agree on a key are ever compared.

Names that share a key are dealt into tiles.  In a tile the names' signatures, a bit per
character occurrence, are compared as arrays: ``x`` bits of difference leave at most
``(a + b - x) / 2`` common characters.  What cannot reach the score never becomes a row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.text import similarity_scores
from tidemark.operators.scale import fan_out_join, settled
from tidemark.session import shuffle_partitions

# Rare characters per key for a common prefix of 0, 1, 2, 3 and 4 characters: the
# longer the prefix in the key, the fewer are needed to keep a key selective.  More
# characters give more keys per name and fewer names per key; any choice is lossless.
KEY_WIDTHS = (2, 2, 1, 1, 1)
_EPS = 1e-9

# Names of each side in a tile, pairs compared at once, and bits of a signature.
TILE = 1024
_PAIRS_AT_ONCE = 1 << 19
_SIGNATURE_BITS = 256
_SIGNATURE = [f"bits_{k}" for k in range(_SIGNATURE_BITS // 64)]


def _floor_share(min_score: float, p: int) -> float:
    """Least share of a name's characters that a partner must have in common with it."""
    share = 3 * (min_score / 100 - 0.1 * p) / (1 - 0.1 * p) - 2
    if share <= 0:
        raise ValueError("the threshold is too low for a lossless pre-filter")
    return share


def _marks(name: str, rarity: dict[str, int]) -> list[str]:
    """A name's character occurrences (``a0``, ``a1`` ...) in one global order, rarest first."""
    seen: dict[str, int] = {}
    order = []
    for ch in name:
        k = seen.get(ch, 0)
        seen[ch] = k + 1
        order.append((-k, rarity.get(ch, 0), ch))
    return [f"{ch}{-k}" for k, _, ch in sorted(order)]


def name_keys(
    name: str, min_score: float, rarity: dict[str, int], widths: tuple[int, ...] = KEY_WIDTHS
) -> list[str]:
    marks = _marks(name, rarity)
    a = len(marks)
    keys = set()
    for p in range(0, min(4, a) + 1):
        share = _floor_share(min_score, p)
        need = math.ceil(a * share - _EPS)

        def width_at(length: int) -> int:
            return min(widths[p], math.ceil(length * share - _EPS))

        partners = range(max(1, need), math.floor(a / share + _EPS) + 1)
        for width in {min(width_at(a), width_at(b)) for b in partners}:
            for combo in combinations(marks[: a - need + width], width):
                keys.add(f"{p}|{name[:p]}|{''.join(combo)}")
    return sorted(keys)


def _signature(name: str) -> int:
    """The name's character occurrences as a set of bits; names that differ in ``d`` occurrences differ in at most ``d`` bits."""
    seen: dict[str, int] = {}
    bits = 0
    for ch in name:
        k = seen.get(ch, 0)
        seen[ch] = k + 1
        bits |= 1 << ((ord(ch) * 0x9E3779B1 + k * 0x85EBCA77 >> 7) % _SIGNATURE_BITS)
    return bits


def _keyed_rows(
    batches: Iterator[pa.RecordBatch], min_score: float, rarity: dict[str, int], widths: tuple[int, ...]
) -> Iterator[pa.RecordBatch]:
    """A row per name and key: the names as given and folded, the common prefix that the key stands for, and the signature."""
    for batch in batches:
        names = batch.column(1).to_pylist()
        keys = [name_keys(n, min_score, rarity, widths) for n in names]
        place = np.repeat(np.arange(len(names)), [len(k) for k in keys])
        flat = [k for per_name in keys for k in per_name]
        bits = np.frombuffer(b"".join(_signature(n).to_bytes(_SIGNATURE_BITS // 8, "little") for n in names), "<i8").reshape(-1, _SIGNATURE_BITS // 64)
        rows = pa.array(place)
        columns = [*(c.take(rows) for c in batch.columns), pa.array(flat, pa.string()), pa.array([int(k[0]) for k in flat], pa.int8())]
        columns += [pa.array(bits[place, k]) for k in range(bits.shape[1])]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "key", "p", *_SIGNATURE])


def _jaro_needed(min_score: float, p: np.ndarray) -> np.ndarray:
    """The plain similarity that lifts a pair with ``p`` characters of prefix to the score."""
    return (min_score / 100 - 0.1 * p) / (1 - 0.1 * p)


class _Tile:
    """Rows of whole tiles, left and right, as arrays."""

    def __init__(self, rows: pa.Table, min_score: float) -> None:
        folded = rows["folded"].to_pylist()
        self.names = rows["name"].combine_chunks()
        self.bits = [np.asarray(rows[c]).view(np.uint64) for c in _SIGNATURE]
        self.size = np.array([len(n) for n in folded], np.int64)
        self.head = np.array(folded, "U4").view(np.uint32).reshape(-1, 4)
        self.p = np.asarray(rows["p"]).astype(np.int64)
        self.jaro = _jaro_needed(min_score, self.p)
        right = np.asarray(rows["is_right"])
        tile = np.cumsum(_changes(rows)) - 1
        self.left, self.right = np.flatnonzero(~right), np.flatnonzero(right)
        self.first = np.searchsorted(tile[self.right], tile[self.left])
        self.partners = np.searchsorted(tile[self.right], tile[self.left], "right") - self.first

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of left and right names of one tile that can reach the score, a bounded number compared at a time."""
        done = np.concatenate([[0], np.cumsum(self.partners)])
        start = 0
        while start < len(self.left):
            stop = max(start + 1, int(np.searchsorted(done, done[start] + _PAIRS_AT_ONCE, "right")) - 1)
            n = self.partners[start:stop]
            l = np.repeat(self.left[start:stop], n)
            r = self.right[np.repeat(self.first[start:stop] - (done[start:stop] - done[start]), n) + np.arange(len(l))]
            unlike = sum(np.bitwise_count(b[l] ^ b[r]).astype(np.int64) for b in self.bits)
            a, b = self.size[l], self.size[r]
            near = (3 * self.jaro[l] - 1) * a * b <= ((a + b - unlike) / 2 + 1e-6) * (a + b)
            l, r = l[near], r[near]
            agree = (self.head[l] == self.head[r]) & (self.head[l] != 0)
            own = np.cumprod(agree, axis=1).sum(axis=1) == self.p[l]
            yield l[own], r[own]
            start = stop


def _changes(rows: pa.Table) -> np.ndarray:
    """True where a row begins another tile than the row before."""
    out = np.ones(len(rows), bool)
    if len(rows) > 1:
        out[1:] = False
        for c in ("k", "lt", "rt"):
            v = np.asarray(rows[c])
            out[1:] |= v[1:] != v[:-1]
    return out


def _compared(batches: Iterator[pa.RecordBatch], min_score: float) -> Iterator[pa.RecordBatch]:
    """Pairs of names from rows in order of tile, whose signatures, lengths and prefixes allow the score."""

    def survivors(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        tile = _Tile(rows, min_score)
        for l, r in tile.pairs():
            if len(l):
                yield pa.RecordBatch.from_arrays([tile.names.take(pa.array(l)), tile.names.take(pa.array(r))], ["l_name", "r_name"])

    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        last = int(np.flatnonzero(_changes(held))[-1]) if len(held) else 0
        if last:
            yield from survivors(held.slice(0, last))
            held = held.slice(last)
    if held is not None and len(held):
        yield from survivors(held)


def tiles(keyed: DataFrame, tile: int) -> DataFrame:
    """Keyed names of both sides, dealt into tiles of about ``tile`` by ``tile`` names per key.

    A key that many names share is cut on both sides by the names' hashes; each left
    part meets each right part in a tile of its own.  Keys of one side only are dropped.
    """
    keyed = keyed.withColumn("k", F.xxhash64("key")).drop("key")
    sizes = keyed.groupBy("k").agg(F.count_if(~F.col("is_right")).alias("n_left"), F.count_if("is_right").alias("n_right"))
    sizes = sizes.where((F.col("n_left") > 0) & (F.col("n_right") > 0))
    parts = {"lt": F.ceil(F.col("n_left") / tile), "rt": F.ceil(F.col("n_right") / tile)}
    numbers = sizes.select("k", *[c.cast("int").alias(f"{n}s") for n, c in parts.items()])
    own = lambda n: F.pmod(F.xxhash64("name"), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    dealt = keyed.join(numbers, "k").withColumns(
        {
            "lt": F.when(F.col("is_right"), every("lts")).otherwise(F.array(own("lts"))),
            "rt": F.when(F.col("is_right"), F.array(own("rts"))).otherwise(every("rts")),
        }
    )
    return dealt.drop("lts", "rts").withColumn("lt", F.explode("lt")).withColumn("rt", F.explode("rt"))


def fuzzy_pairs(
    left: DataFrame,
    right: DataFrame,
    min_score: int = 93,
    ignore_case: bool = True,
    widths: tuple[int, ...] = KEY_WIDTHS,
    tile: int = TILE,
) -> DataFrame:
    """(l_name, r_name, score) of all pairs of two distinct-name frames at or above the score.

    Names meet key by key in tiles of bounded size.  Within a tile a signature bounds the
    characters that two names share; only pairs that it lets through become rows, and
    only those are scored.  NULL names match nothing.
    """
    names = _distinct_names(left, right, "l_name", "r_name", ignore_case)
    return _near_pairs(names, _character_ranks(names), min_score, ignore_case, widths, tile)


def _distinct_names(left: DataFrame, right: DataFrame, l_name: str, r_name: str, ignore_case: bool) -> DataFrame:
    """Both sides' names as one written table (name, n rows, folded, is_right): much smaller than what they are taken from."""

    def counted(df: DataFrame, column: str, is_right: bool) -> DataFrame:
        return df.groupBy(F.col(column).alias("name")).agg(F.count(F.lit(1)).alias("n")).withColumn("is_right", F.lit(is_right))

    given = counted(left, l_name, False).unionByName(counted(right, r_name, True))
    folded = F.lower("name") if ignore_case else F.col("name")
    return settled(given.where(F.col("name").isNotNull()).select("name", "n", folded.alias("folded"), "is_right"), "names")


def _near_pairs(
    names: DataFrame, rarity: dict[str, int], min_score: int, ignore_case: bool, widths: tuple[int, ...], tile: int
) -> DataFrame:
    names = names.select("name", "folded", "is_right")
    rows = partial(_keyed_rows, min_score=float(min_score), rarity=rarity, widths=widths)
    schema = "name string, folded string, is_right boolean, key string, p tinyint, " + ", ".join(f"{c} long" for c in _SIGNATURE)
    dealt = tiles(spread(names, "name").mapInArrow(rows, schema), tile)
    near = (
        spread(dealt, "k", "lt", "rt")
        .sortWithinPartitions("k", "lt", "rt")
        .mapInArrow(partial(_compared, min_score=float(min_score)), "l_name string, r_name string")
    )
    # Small rows, much work each: the explicit spread keeps them from being packed into few tasks.
    return spread(near, "l_name", "r_name").distinct().mapInPandas(_scorer(min_score, ignore_case), "l_name string, r_name string, score int")


def _scorer(min_score: int, ignore_case: bool):
    """Batch function that scores pairs and passes on those at or above the score."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pairs in batches:
            l, r = pairs["l_name"], pairs["r_name"]
            if ignore_case:
                l, r = l.str.lower(), r.str.lower()
            points = np.floor(similarity_scores(l, r, min_score / 100) * 100 + 1e-9).to_numpy()
            keep = points >= min_score
            yield pairs[keep].assign(score=points[keep].astype("int32"))

    return score


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Hash the rows over all shuffle partitions, without packing small ones together."""
    return df.repartition(shuffle_partitions(df.sparkSession), *columns)


def _character_ranks(names: DataFrame) -> dict[str, int]:
    """Rank of all characters by frequency, rarest lowest; the alphabet bounds their number.

    The order only steers which keys are used; any order gives the same matches.
    """
    counts = (
        names.select(F.explode(F.split("folded", "")).alias("ch"))
        .where(F.col("ch") != "")
        .groupBy("ch")
        .count()
        .orderBy(F.desc("count"), "ch")
        .collect()
    )
    return {r["ch"]: len(counts) - i for i, r in enumerate(counts)}


def fuzzy_match(
    left: DataFrame,
    right: DataFrame,
    l_name: str,
    r_name: str,
    min_score: int = 93,
    ignore_case: bool = True,
    widths: tuple[int, ...] = KEY_WIDTHS,
) -> DataFrame:
    """Rows of ``left`` joined to the rows of ``right`` whose name is most similar.

    Scores run from ``min_score`` to 100; ties for the best score are all kept.
    Names are compared once per distinct value.  A name with an exact partner
    already has the top score, so only the others go through the similarity
    search.  A name may have many rows on both sides: rows meet in tasks of bounded
    output.  Distinct rows on both sides give distinct rows.
    """
    names = _distinct_names(left, right, l_name, r_name, ignore_case)
    ours, theirs = names.where("not is_right"), names.where("is_right")
    ln = ours.select(F.col("name").alias("l_name"), "folded")
    exact = ln.join(theirs.select(F.col("name").alias("r_name"), "folded"), "folded").select("l_name", "r_name", F.lit(100).alias("score"))
    open_names = ours.join(theirs.select("folded"), "folded", "left_anti").select(names.columns)
    # Scoring is the dear step and this keeps it single.  Each task drops its own
    # lower ranks before the shuffle, so a name arrives with its best partners only.
    by_name = W.partitionBy("l_name").orderBy(F.desc("score"))
    near = _near_pairs(open_names.unionByName(theirs), _character_ranks(names), min_score, ignore_case, widths, TILE)
    near = near.withColumn("r", F.rank().over(by_name)).where("r = 1").drop("r")
    pairs = settled(exact.unionByName(near), "matches").withColumn("match_rank", F.lit(1))
    sizes = (
        pairs.join(ours.select(F.col("name").alias("l_name"), "n"), "l_name").groupBy("r_name").agg(F.sum("n").alias("_m"))
        .join(theirs.select(F.col("name").alias("r_name"), F.col("n").alias("_n")), "r_name")
    )
    matched = left.join(pairs.withColumnRenamed("l_name", l_name), l_name)
    matched = matched.select("r_name", *[c for c in matched.columns if c != "r_name"])
    # Every name of a match has rows on the right, so that none is left without a partner.
    return fan_out_join(matched, right.withColumnRenamed(r_name, "r_name"), "r_name", sizes=sizes).withColumnRenamed("r_name", r_name)


def rank_best(df: DataFrame, key: str, score: str) -> DataFrame:
    """Rows that hold the best score of their key, ties kept."""
    best = df.groupBy(key).agg(F.max(score).alias(score))
    return df.join(best, [key, score], "left_semi").withColumn("match_rank", F.lit(1))
