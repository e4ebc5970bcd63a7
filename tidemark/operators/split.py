"""Stratified, seeded train/test split over churn-time classes."""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.weeks import as_column
from tidemark.operators.scale import mark_lowest

BIN_DAYS = (365, 730, 1095, 1460)


def time_class(target: Column | str, bins: tuple[int, ...] = BIN_DAYS) -> Column:
    """Class 1.. of half-open bins (lo, hi]; the last class has no upper end.

    Zero, negative and missing targets have no class.
    """
    t = as_column(target)
    label = reduce(lambda acc, ib: acc.when(t <= ib[1], F.lit(ib[0] + 1)), enumerate(bins), F.when(t <= 0, None))
    return label.when(t.isNotNull(), F.lit(len(bins) + 1))


def bin_target(df: DataFrame, target: str, bins: tuple[int, ...] = BIN_DAYS) -> DataFrame:
    return df.withColumn("sample_class", time_class(target, bins)).where(F.col("sample_class").isNotNull())


def class_counts(df: DataFrame) -> dict[int, int]:
    """Rows per class: one entry per bin, so at most a handful come back."""
    return {r["sample_class"]: r["count"] for r in df.groupBy("sample_class").count().collect()}


def merge_plan(counts: dict[int, int], minimum: int, keep_all: bool) -> dict[int, int | None]:
    """Where each class goes: itself, a neighbour when too small, or nowhere.

    In class order, a small class joins the one below it, or the one above it if
    there is none below; sizes are updated as classes merge.
    """
    if not keep_all:
        return {c: c if n >= minimum else None for c, n in counts.items()}
    size = dict(counts)
    goes = {c: c for c in counts}
    for c in sorted(counts):
        if c not in size or size[c] >= minimum or len(size) == 1:
            continue
        below = [x for x in size if x < c]
        target = max(below) if below else min(x for x in size if x > c)
        size[target] += size.pop(c)
        goes = {k: target if v == c else v for k, v in goes.items()}
    return goes


def apply_merge(df: DataFrame, goes: dict[int, int | None]) -> DataFrame:
    moved = reduce(
        lambda acc, kv: acc.when(F.col("sample_class") == kv[0], F.lit(kv[1])), sorted(goes.items()), F.when(F.lit(False), None)
    ) if goes else F.col("sample_class")
    return df.withColumn("sample_class", moved.cast("int")).where(F.col("sample_class").isNotNull())


def drop_top_class(df: DataFrame) -> DataFrame:
    top = df.agg(F.max("sample_class")).scalar()
    return df.where(F.col("sample_class") != top)


def effective_test_size(counts: dict[int, int], test_size: float, minimum: int) -> tuple[float, bool]:
    """Test share and whether the split is by class.

    The share rises to one row of the smallest class; when that would take more
    than half, or a class is below the minimum, classes are ignored.
    """
    smallest = min(counts.values())
    if smallest < minimum:
        return test_size, False
    if smallest * test_size >= 1:
        return test_size, True
    raised = 1.0 / smallest
    return (test_size, False) if raised > 0.5 else (max(raised, test_size), True)


def assign_split(
    df: DataFrame, key: str, counts: dict[int, int], test_size: float, by_class: bool, seed: int = 42
) -> DataFrame:
    """Add ``split``: exactly ``round(n * share)`` rows of each class (or of all) are test rows.

    Rows are drawn by seeded hash of their key, so the split is repeatable and
    independent of partitioning.
    """
    stratum = F.col("sample_class") if by_class else F.lit(0)
    sizes = counts if by_class else {0: sum(counts.values())}
    spark = df.sparkSession
    wanted = spark.createDataFrame([(c, int(round(n * test_size))) for c, n in sizes.items()], "stratum int, k long")
    marked = mark_lowest(df.withColumn("stratum", stratum), ["stratum"], key, wanted, seed)
    return marked.withColumn("split", F.when(F.col("picked"), "test").otherwise("train")).drop("stratum", "picked")


def prepared(
    df: DataFrame, target: str, bins: tuple[int, ...], min_class: int, keep_all: bool, drop_last: bool
) -> tuple[DataFrame, dict[int, int]]:
    """Binned rows with the top class dropped and small classes merged, and the class sizes.

    One count per class comes to the driver (a handful of rows); everything else is
    decided from it without another pass.
    """
    binned = bin_target(df, target, bins)
    counts = class_counts(binned)
    if drop_last and counts:
        counts.pop(max(counts))
    goes = merge_plan(counts, min_class, keep_all)
    merged: dict[int, int] = {}
    for c, to in goes.items():
        if to is not None:
            merged[to] = merged.get(to, 0) + counts[c]
    ready = apply_merge(binned, goes).withColumn("no_of_renewals", F.col("sample_class") - 1)
    return ready, merged


def stratified_split(
    df: DataFrame,
    target: str,
    key: str = "account_id",
    bins: tuple[int, ...] = BIN_DAYS,
    test_size: float = 0.2,
    min_class: int = 2,
    keep_all: bool = True,
    drop_last: bool = True,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, test, report) with exact class proportions.  ``key`` identifies a row."""
    ready, counts = prepared(df, target, bins, min_class, keep_all, drop_last)
    if not counts:
        raise ValueError("no rows with a class to split")
    share, by_class = effective_test_size(counts, test_size, min_class)
    if not by_class:
        warnings.warn("classes too small: splitting without regard to class", stacklevel=2)
    labelled = assign_split(ready, key, counts, share, by_class, seed)
    features = labelled.drop(target)
    return (
        features.where(F.col("split") == "train").drop("split"),
        features.where(F.col("split") == "test").drop("split"),
        split_report(labelled, target),
    )


def split_report(labelled: DataFrame, target: str) -> DataFrame:
    """Per class and side: rows, share of the side, and target range."""
    counted = labelled.groupBy("split", "sample_class").agg(
        F.count(F.lit(1)).alias("n"), F.min(target).alias("target_min"), F.max(target).alias("target_max")
    )
    return counted.withColumn("proportion", F.col("n") / F.sum("n").over(W.partitionBy("split")))


def class_statistics(df: DataFrame, target: str) -> DataFrame:
    """Target statistics per class.  Whole days take few values, so the built-in median is safe."""
    return df.groupBy("sample_class").agg(
        F.avg(target).alias("mean_target"),
        F.median(target).alias("median_target"),
        F.stddev_samp(target).alias("std_target"),
        F.min(target).alias("min_target"),
        F.max(target).alias("max_target"),
        F.count(target).alias("n"),
    )
