"""Projections, filters, joins, deduplication, sorting and set operations."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.coerce import is_numeric
from tidemark.functions.weeks import as_column, date_to_week

DAYS_SENTINEL, WEEKS_SENTINEL = 9999, 1000


# --- projections ----------------------------------------------------------------


def select_existing(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns that the frame has, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def drop_existing(df: DataFrame, unwanted: list[str]) -> DataFrame:
    return df.drop(*unwanted)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema if is_numeric(f.dataType) and f.name not in exclude]


def metric_columns(df: DataFrame, priority: list[str], exclude: tuple[str, ...], limit: int | None = None) -> list[str]:
    """Numeric columns to report on, prioritised ones first; all of them unless a ``limit`` is asked for."""
    numeric = numeric_columns(df, exclude)
    first = [c for c in priority if c in numeric]
    return (first + [c for c in numeric if c not in first])[:limit]


def prefix_columns(df: DataFrame, prefix: str, keys: list[str]) -> DataFrame:
    """Prefix every non-key column, so that a join cannot make names collide."""
    return df.select(*[F.col(c) if c in keys else F.col(c).alias(f"{prefix}{c}") for c in df.columns])


def stamp(df: DataFrame, environment: str, created_at: Column) -> DataFrame:
    """Literal provenance columns for a report."""
    return df.withColumns({"created_at": created_at, "environment": F.lit(environment)})


# --- filters --------------------------------------------------------------------


def since(df: DataFrame, date_column: str, start: str) -> DataFrame:
    return df.where(F.col(date_column) >= F.lit(start).cast("date"))


def since_first_date(df: DataFrame, candidates: list[str], start: str) -> DataFrame:
    """Date floor on the first of the candidate columns that exists; no-op without one."""
    present = [c for c in candidates if c in df.columns]
    return since(df, present[0], start) if present else df


def since_week(df: DataFrame, start: str, week: str = "yyyywk") -> DataFrame:
    return df.where(F.col(week) >= date_to_week(F.lit(start).cast("date")))


def since_year(df: DataFrame, year: int, week: str = "yyyywk") -> DataFrame:
    return df.where(F.col(week) >= year * 100 + 1)


def is_churned(flag: str = "churned_flag") -> Column:
    return F.col(flag) == 1


def is_active(flag: str = "churned_flag") -> Column:
    return F.col(flag) == 0


def is_not_churned(flag: str = "churned_flag") -> Column:
    """``flag <> 1`` with SQL NULL logic: NULL without a flag."""
    return F.col(flag) != 1


def churned_only(df: DataFrame, flag: str = "churned_flag") -> DataFrame:
    return df.where(is_churned(flag))


def active_only(df: DataFrame, flag: str = "churned_flag") -> DataFrame:
    return df.where(is_active(flag))


def not_churned(df: DataFrame, flag: str = "churned_flag") -> DataFrame:
    return df.where(is_not_churned(flag))


def members_of(df: DataFrame, keys: DataFrame, on: str, key: str | None = None) -> DataFrame:
    """Rows whose key is in the key set."""
    return df.join(keys.select(F.col(key or on).alias(on)).dropna(), on, "left_semi")


def with_week(df: DataFrame, week: str = "yyyywk") -> DataFrame:
    return df.dropna(subset=[week])


def non_negative(df: DataFrame, metric: str) -> DataFrame:
    return df.where(F.col(metric) >= 0)


def positive(df: DataFrame, metric: str) -> DataFrame:
    return df.where(F.col(metric) > 0)


def any_present(df: DataFrame, metrics: list[str]) -> DataFrame:
    """Rows with at least one metric."""
    return df.where(F.coalesce(*[F.col(m).cast("double") for m in metrics]).isNotNull())


def below_sentinel(df: DataFrame, metric: str, sentinel: int = DAYS_SENTINEL) -> DataFrame:
    return df.where(F.col(metric) < sentinel)


def sample_entities(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """All rows of ``n`` entities drawn by seeded hash (MD5 of seed and key); the same draw every time."""
    drawn = df.select(key).dropna().distinct().orderBy(F.md5(F.concat_ws(":", F.lit(seed), F.col(key)).cast("binary")), key).limit(n)
    return df.join(drawn, key, "left_semi")


# --- joins ----------------------------------------------------------------------


def keep_known(facts: DataFrame, fact_key: str, accounts: DataFrame, key: str = "account_id") -> DataFrame:
    """Inner join to the account list when only its keys are wanted.

    A semi join: no account column travels, and a repeated account does not
    repeat facts.  The fact key takes the account key's name.
    """
    named = facts if fact_key == key else facts.withColumnRenamed(fact_key, key)
    return named.join(accounts.select(key), key, "left_semi")


def full_outer_by_date(frames: list[DataFrame], key: str, date: str) -> DataFrame:
    """Full outer join of frames that hold one row per (key, date).

    Written as one union and one grouping: a single shuffle for any number of
    frames, NULL dates meet NULL dates, and map-side combining applies.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    rest = [c for c in stacked.columns if c not in (key, date)]
    return stacked.groupBy(key, date).agg(*[F.max(c).alias(c) for c in rest])


def full_outer_coalesce(
    left: DataFrame, right: DataFrame, key: str, left_date: str, right_date: str
) -> DataFrame:
    """Full outer join on key and differently named dates; ``left_date`` is filled from the right.

    Dates may be NULL on both sides and then match, so the comparison is null-safe.
    """
    l, r = left.alias("l"), right.withColumnRenamed(key, "_rk").alias("r")
    joined = l.join(
        r, (F.col(f"l.{key}").eqNullSafe(F.col("_rk"))) & (F.col(f"l.{left_date}").eqNullSafe(F.col(f"r.{right_date}"))), "full"
    )
    return joined.withColumns(
        {key: F.coalesce(F.col(key), F.col("_rk")), left_date: F.coalesce(F.col(left_date), F.col(right_date))}
    ).drop("_rk")


def left_join(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Left join; Spark broadcasts the other side only when its size allows."""
    return df.join(other, key, "left")


def first_activity_with_account(first_week: DataFrame, accounts: DataFrame, key: str = "account_id") -> DataFrame:
    return accounts.join(first_week, key, "inner")


# --- distinct and dedupe ----------------------------------------------------------


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def distinct_projection(df: DataFrame, *columns: Column | str) -> DataFrame:
    return df.select(*columns).distinct()


def nulls_last(c: Column | str, descending: bool = False) -> list[Column]:
    """Sort fields that put NULL behind every value inside a struct comparison."""
    c = as_column(c)
    return [c.isNull(), -c if descending else c]


def dedupe_keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first under ``order``, then under all other columns.

    An aggregate rather than a ranking window, so repeated keys are combined
    before the shuffle; each column travels once, as the sort field that breaks ties.
    Rows with a NULL key drop out.
    """
    payload = [c for c in df.columns if c not in keys]
    fields = [o.alias(f"_o{i}") for i, o in enumerate(order)]
    for i, c in enumerate(payload):
        missing, value = nulls_last(c)
        fields += [missing.alias(f"_n{i}"), value.alias(f"_v{i}")]
    best = df.dropna(subset=keys).groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_b"))
    return best.select(*keys, *[F.col(f"_b._v{i}").alias(c) for i, c in enumerate(payload)]).select(*df.columns)


def first_present_per_key(df: DataFrame, keys: list[str], columns: list[str], order: list[Column]) -> DataFrame:
    """Per key and column, the first non-NULL value under ``order``; ties take the smallest value.

    Columns are picked independently, so one output row can mix input rows.
    """
    return df.dropna(subset=keys).groupBy(*keys).agg(*_first_present(columns, order))


#: Types whose running minimum a hash aggregate keeps in place.
FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _first_present(columns: list[str], order: list[Column]) -> list[Column]:
    fields = [o.alias(f"_o{i}") for i, o in enumerate(order)]
    return [
        F.min(F.when(F.col(c).isNotNull(), F.struct(*fields, F.col(c).alias("v")))).getField("v").alias(c) for c in columns
    ]


def dedupe_most_complete(
    df: DataFrame, keys: list[str], length_of: str, mode: str = "column", normal: Callable[[Column], Column] | None = None
) -> DataFrame:
    """One row per key, preferring the longest ``length_of`` text.

    ``mode='column'`` fills each column with its first non-NULL value in that
    order; ``mode='row'`` keeps one whole row.  Texts of equal length go by the
    alphabet, equal texts by the smaller value.  ``normal`` is applied to the texts first.

    By column, rows of a key that have the same text are combined before anything is
    shuffled, in fixed-width buffers; the text travels once with each of them, as a key,
    and is normalised then.  Ranks stand for texts in what follows.
    """
    prepared = normal or (lambda c: c)
    if mode == "row":
        df = df.withColumn(length_of, prepared(F.col(length_of)))
        length = -F.coalesce(F.length(length_of), F.lit(-1))
        return dedupe_keep_first(df, keys, [length, *nulls_last(length_of)])
    rest = [c for c in df.columns if c not in (*keys, length_of)]
    # Values that no fixed-width buffer can hold are keys of the first grouping.
    wide = [c for c in rest if not isinstance(df.schema[c].dataType, FIXED_WIDTH)]
    grouped = df.dropna(subset=keys).groupBy(*keys, length_of, *wide)
    narrow = [c for c in rest if c not in wide]
    texts = (grouped.agg(*[F.min(c).alias(c) for c in narrow]) if narrow else grouped.agg(F.lit(1).alias("_"))).withColumn(
        length_of, prepared(F.col(length_of))
    )
    by_text = W.partitionBy(*keys).orderBy(F.length(length_of).desc_nulls_last(), length_of)
    ranked = texts.withColumn("_r", F.rank().over(by_text))
    return ranked.groupBy(*keys).agg(*_first_present([length_of, *rest], [F.col("_r")])).select(*df.columns)


# --- sort, top, sets ----------------------------------------------------------------


def sort_rows(df: DataFrame, *order: tuple[str, bool]) -> DataFrame:
    """Sort by (column, ascending) pairs."""
    return df.orderBy(*[F.col(c).asc() if up else F.col(c).desc() for c, up in order])


def largest(df: DataFrame, metric: str, n: int, ties: str) -> DataFrame:
    return df.orderBy(F.col(metric).desc(), F.col(ties)).limit(n)


def last_rows(df: DataFrame, order: str, n: int) -> DataFrame:
    """The ``n`` highest rows of a report under one order column."""
    return df.orderBy(F.col(order).desc()).limit(n)


def extremes(df: DataFrame, label: str, metric: str) -> DataFrame:
    """Labels and values of the highest and lowest row; the smallest label wins ties."""
    top = F.min(F.struct((-F.col(metric)).alias("m"), F.col(label).alias("l")))
    low = F.min(F.struct(F.col(metric).alias("m"), F.col(label).alias("l")))
    return df.agg(top.alias("t"), low.alias("b")).select(
        F.col("t.l").alias("max_label"),
        (-F.col("t.m")).alias("max_value"),
        F.col("b.l").alias("min_label"),
        F.col("b.m").alias("min_value"),
    )


def append(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def common_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).intersect(b.select(key))


def missing_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).subtract(b.select(key))


def all_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).union(b.select(key)).distinct()
