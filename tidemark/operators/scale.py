"""Building blocks that keep a group of any size off a single task.

Ordered statistics (exact quantiles, cumulative shares, exact k-of-n picks) are
usually written as one window or one ``percentile`` per group, and then a group
with a third of all rows becomes one task.  The helpers here first count values,
then cut the value range into slots whose totals are small tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import scratch_path, shuffle_partitions, shuffles_removed

_SLOTS = 4096
# Tasks that a join dealt by its output is spread over at most.
_MOST_TASKS = 10_000


def settled(df: DataFrame, name: str = "step") -> DataFrame:
    """The frame written as a table in the shared folder and read back.

    Its lineage is cut, its size is known to the planner, and unlike cached blocks it
    outlives the executors that computed it.  The files go when the driver ends; what was
    shuffled to compute it goes at once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scalars(df: DataFrame, **aggs: Column) -> Column:
    """One-row aggregates of a frame as a struct column for use in another plan.

    Planned as a scalar subquery: computed once, no join.
    """
    return df.agg(F.struct(*[c.alias(k) for k, c in aggs.items()]).alias("s")).scalar()


def attach_group_stats(df: DataFrame, keys: list[str], **aggs: Column) -> DataFrame:
    """Group aggregates joined back to every row.

    A window would bring all rows of a key into one task; here the aggregate is
    combined before its shuffle and the join's hot partitions can be split.
    """
    stats = df.dropna(subset=keys).groupBy(*keys).agg(*[c.alias(k) for k, c in aggs.items()])
    return df.join(stats, keys, "left")


def fan_out_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    only: Column | None = None,
    pairs_per_part: int = 1 << 20,
    sizes: DataFrame | None = None,
    by: list[str] | None = None,
) -> DataFrame:
    """Left join in which a key may have many rows on both sides; ``only`` names the left rows that look for a partner.

    Spark splits joins by the bytes that come in, but here it is the rows that come out
    which count.  A key whose pairs exceed ``pairs_per_part`` is dealt into as many parts:
    its left rows by hash, its right rows repeated in each.  Other keys have one part and
    are joined as ever.  The number of tasks goes by all pairs, about two parts each.
    ``sizes`` holds the rows of each key on both sides (key, ``_m``, ``_n``), where they are known.
    Otherwise only keys with many right rows are counted on the left: where a key has few,
    as many rows come out as go in, but for a small factor, and without any such key
    the left rows are neither counted nor dealt.  ``by`` names left columns that tell the
    rows of a key apart, if not all are needed for that.
    """
    seeking = F.lit(True) if only is None else only
    if sizes is None:
        theirs = right.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        many = settled(theirs.where(F.col("_n") > pairs_per_part >> 14), "many")
        if many.isEmpty():
            right = right.withColumnRenamed(key, "_right_key")
            return left.join(right, (F.col(key) == F.col("_right_key")) & seeking, "left").drop("_right_key")
        sizes = left.where(seeking).groupBy(key).agg(F.count(F.lit(1)).alias("_m")).join(many, key)
    pairs = F.col("_m") * F.col("_n")
    hot = sizes.groupBy(F.when(pairs > pairs_per_part, F.col(key)).alias("_hot")).agg(F.sum(pairs).alias("_pairs"))
    hot = settled(hot, "hot")
    parts = hot.dropna(subset=["_hot"]).select("_hot", F.ceil(F.col("_pairs") / pairs_per_part).cast("int").alias("_parts"))
    own = F.when(F.col("_parts").isNotNull(), F.pmod(F.xxhash64(*(by or left.columns)), F.col("_parts")).cast("int")).otherwise(0)
    dealt = left.join(parts, F.col(key) == F.col("_hot"), "left").withColumn("_part", own).drop("_hot", "_parts")
    every = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    repeated = right.join(parts, F.col(key) == F.col("_hot"), "left").withColumn("_right_part", F.explode(every)).drop("_hot", "_parts")
    repeated = repeated.withColumnRenamed(key, "_right_key")
    # Parts are small until they are joined; a set number keeps them from being packed into few tasks.
    total = hot.agg(F.sum("_pairs")).first()[0] or 0
    n = max(shuffle_partitions(left.sparkSession), min(total // (2 * pairs_per_part), _MOST_TASKS))
    dealt, repeated = dealt.repartition(n, key, "_part"), repeated.repartition(n, "_right_key", "_right_part")
    same = (F.col(key) == F.col("_right_key")) & (F.col("_part") == F.col("_right_part")) & seeking
    return dealt.join(repeated, same, "left").drop("_part", "_right_part", "_right_key")


def value_counts(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    return df.dropna(subset=[value, *by]).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))


def ranked_values(df: DataFrame, value: str, by: list[str] | None = None, counted: bool = False) -> DataFrame:
    """Distinct values with ``n``, the rows ``before`` them and the group ``total``.

    Two monotone cuts (a logarithmic one, then an even one inside each slot)
    bound every window: at most a few thousand slots per group, and inside the
    last cut only the distinct values that share one slot.
    """
    by = list(by or [])
    counts = df if counted else value_counts(df, value, by)
    v = F.col(value).cast("double")
    # Infinities get the outermost slots, which no finite value reaches.
    coarse = counts.withColumn("_c", F.floor(F.signum(v) * F.least(F.log1p(F.abs(v)) * 64, F.lit(60_000.0))).cast("int"))
    slots = coarse.groupBy(*by, "_c").agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"), F.sum("n").alias("_cn"))
    whole = W.partitionBy(*by)
    slots = slots.select(
        *by,
        "_c",
        "_lo",
        "_hi",
        (F.sum("_cn").over(whole.orderBy("_c").rowsBetween(W.unboundedPreceding, 0)) - F.col("_cn")).alias("_cb"),
        F.sum("_cn").over(whole).alias("total"),
    )
    share = (v - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    fine = coarse.join(slots, [*by, "_c"]).withColumn(
        "_f",
        F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor(share * _SLOTS), F.lit(_SLOTS - 1))).otherwise(0).cast("int"),
    )
    cells = fine.groupBy(*by, "_c", "_f").agg(F.sum("n").alias("_fn"))
    in_slot = W.partitionBy(*by, "_c").orderBy("_f").rowsBetween(W.unboundedPreceding, 0)
    cells = cells.select(*by, "_c", "_f", (F.sum("_fn").over(in_slot) - F.col("_fn")).alias("_fb"))
    in_cell = W.partitionBy(*by, "_c", "_f").orderBy(value).rowsBetween(W.unboundedPreceding, 0)
    return (
        fine.join(cells, [*by, "_c", "_f"])
        .withColumn("before", F.col("_cb") + F.col("_fb") + F.sum("n").over(in_cell) - F.col("n"))
        .select(*by, value, "n", "before", "total")
    )


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """Linear-interpolated quantiles, exact, one column per named probability."""
    by = list(by or [])
    ranked = ranked_values(df, value, by)
    v = F.col(value).cast("double")
    picks = []
    for name, p in probs.items():
        spot = (F.col("total") - 1) * F.lit(float(p))
        for side, index in (("lo", F.floor(spot)), ("hi", F.ceil(spot))):
            inside = (F.col("before") <= index) & (index < F.col("before") + F.col("n"))
            picks.append(F.max(F.when(inside, v)).alias(f"_{name}_{side}"))
    picked = ranked.groupBy(*by).agg(F.max("total").alias("_total"), *picks)
    out = []
    for name, p in probs.items():
        spot = (F.col("_total") - 1) * F.lit(float(p))
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        between = spot - F.floor(spot)
        out.append(F.when((lo == hi) | (between == 0), lo).otherwise(lo + (hi - lo) * between).alias(name))
    return picked.select(*by, *out)


def hash_threshold(df: DataFrame, by: list[str], key: str, wanted: DataFrame, seed: int = 42) -> DataFrame:
    """Per group, the (hash, key) pair at which exactly ``k`` rows lie at or below.

    ``wanted`` has the group columns and ``k``.  Counts per hash slot find the
    slot that holds the k-th row; only that slot (1/65536 of a group) is sorted.
    """
    h = F.xxhash64(F.lit(seed), F.col(key))
    slotted = df.select(*by, F.col(key).alias("_id"), h.alias("_h"), F.shiftright(h, 48).alias("_s"))
    per_slot = slotted.groupBy(*by, "_s").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(W.partitionBy(*by).orderBy("_s").rowsBetween(W.unboundedPreceding, 0))
    edge = (
        per_slot.withColumn("_upto", upto)
        .join(wanted, by)
        .where((F.col("_upto") - F.col("_n") < F.col("k")) & (F.col("k") <= F.col("_upto")))
        .select(*by, "_s", (F.col("k") - F.col("_upto") + F.col("_n")).alias("_need"))
    )
    order = W.partitionBy(*by).orderBy("_h", "_id")
    return (
        slotted.join(edge, [*by, "_s"])
        .withColumn("_rn", F.row_number().over(order))
        .where(F.col("_rn") == F.col("_need"))
        .select(*by, F.col("_h").alias("edge_hash"), F.col("_id").alias("edge_id"))
    )


def mark_lowest(df: DataFrame, by: list[str], key: str, wanted: DataFrame, seed: int = 42) -> DataFrame:
    """Add ``picked``: true for exactly ``k`` rows of each group, chosen by seeded hash.

    ``key`` must identify a row.  The rows themselves are never shuffled by
    group; they meet only the one-row-per-group thresholds.
    """
    edges = hash_threshold(df, by, key, wanted, seed)
    h = F.xxhash64(F.lit(seed), F.col(key))
    below = (h < F.col("edge_hash")) | ((h == F.col("edge_hash")) & (F.col(key) <= F.col("edge_id")))
    return (
        df.join(edges, by, "left").withColumn("picked", F.coalesce(below, F.lit(False))).drop("edge_hash", "edge_id")
    )
