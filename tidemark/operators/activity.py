"""Weekly activity, lifecycle, distributions and readiness."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.weeks import month_of, weeks_between
from tidemark.operators.churn import with_top_segments
from tidemark.operators.relational import active_only, any_present, is_active, largest, numeric_columns
from tidemark.operators.scale import exact_quantiles, ranked_values, scalars, settled

DURATION_EDGES = (13, 26, 52, 104)
DURATION_LABELS = ("< 3 months", "3-6 months", "6-12 months", "1-2 years", "> 2 years")


# --- weekly series ------------------------------------------------------------------


def weekly_totals(df: DataFrame, metrics: list[str], week: str = "yyyywk") -> DataFrame:
    return df.dropna(subset=[week]).groupBy(week).agg(*[F.sum(m).alias(m) for m in metrics])


def weekly_activity(
    df: DataFrame, metrics: list[str], week: str = "yyyywk", key: str = "account_id", flag: str = "churned_flag"
) -> DataFrame:
    """Weekly totals and active accounts of rows that are unique per account and week, in one grouping."""
    active = F.count_if(is_active(flag) & F.col(key).isNotNull()).alias("active_customers")
    return df.dropna(subset=[week]).groupBy(week).agg(*[F.sum(m).alias(m) for m in metrics], active)


def weekly_metric_stats(df: DataFrame, metric: str, week: str = "yyyywk") -> DataFrame:
    """Sum, mean and count of known values per week; a week without any has NULL and is left out."""
    stats = df.dropna(subset=[week]).groupBy(week).agg(
        F.sum(metric).alias("total"), F.avg(metric).alias("mean"), F.count(metric).alias("n")
    )
    return stats.where(F.col("total").isNotNull())


def weekly_active(
    df: DataFrame, week: str = "yyyywk", key: str = "account_id", flag: str = "churned_flag", approx: bool = False
) -> DataFrame:
    """Distinct active accounts per week; without an account column, the sum of the active flag.

    Exact counting first reduces the rows to distinct (week, account) pairs, so a
    week with many rows is no heavier than its accounts.
    """
    rows = df.dropna(subset=[week])
    active = F.col(flag) == 0
    if key not in df.columns:
        return rows.groupBy(week).agg(F.count_if(active).alias("active_customers"))
    if approx:
        return rows.groupBy(week).agg(F.approx_count_distinct(F.when(active, F.col(key))).alias("active_customers"))
    pairs = rows.groupBy(week, key).agg(F.coalesce(F.bool_or(active), F.lit(False)).alias("_a"))
    return pairs.groupBy(week).agg(F.count_if(F.col("_a") & F.col(key).isNotNull()).alias("active_customers"))


def active_bitmaps(df: DataFrame, week: str = "yyyywk", key: str = "account_id", flag: str = "churned_flag") -> DataFrame:
    """(week, bucket, bits): the active accounts of each week as bitmaps of 32,768 whole-number keys each.

    Bitmaps are made within each task, so a week's rows are shuffled as a few kilobytes
    per bucket whatever their number, and they merge: coarser periods need no second
    scan.
    """
    active = df.where((F.col(flag) == 0) & F.col(key).isNotNull()).dropna(subset=[week])
    return active.groupBy(week, F.bitmap_bucket_number(key).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bits")
    )


def active_per_period(bitmaps: DataFrame, period: Column, name: str = "period") -> DataFrame:
    """Exact number of distinct active accounts per period, from weekly bitmaps."""
    merged = bitmaps.groupBy(period.alias(name), "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(name).agg(F.sum(F.bitmap_count("bits")).alias("active_customers"))


def weekly_overview(df: DataFrame, metrics: list[str], docs: str = "documents_opened") -> DataFrame:
    """Weekly totals, distinct accounts and documents per account (0 when unknown)."""
    per_account = df.groupBy("yyyywk", "account_id").agg(*[F.sum(m).alias(m) for m in metrics])
    weekly = per_account.dropna(subset=["yyyywk"]).groupBy("yyyywk").agg(
        *[F.sum(m).alias(m) for m in metrics], F.count("account_id").alias("customers")
    )
    per_customer = F.coalesce(F.try_divide(F.col(docs), F.col("customers")), F.lit(0.0))
    return any_present(weekly, metrics).withColumn("docs_per_customer", per_customer)


def weekly_by_status(df: DataFrame, metric: str, week: str = "yyyywk", flag: str = "churned_flag") -> DataFrame:
    """Weekly mean of a metric for churned, active and all accounts."""
    return df.dropna(subset=[week]).groupBy(week).agg(
        F.avg(F.when(F.col(flag) == 1, F.col(metric))).alias("churned_mean"),
        F.avg(F.when(F.col(flag) == 0, F.col(metric))).alias("active_mean"),
        F.avg(metric).alias("all_mean"),
    )


def week_over_week(weekly: DataFrame, metric: str, week: str = "yyyywk") -> DataFrame:
    """Percentage change from the week before, over an aggregated weekly table."""
    before = F.lag(metric).over(W.orderBy(week))
    return weekly.select(week, metric, (F.try_divide(F.col(metric) - before, before) * 100).alias("growth_pct"))


def mean_growth(weekly: DataFrame, metric: str, week: str = "yyyywk") -> DataFrame:
    """Mean of the finite week-over-week changes."""
    return week_over_week(weekly, metric, week).agg(F.avg("growth_pct").alias("mean_growth_pct"))


# --- accounts ------------------------------------------------------------------------


def lifecycle(df: DataFrame, docs: str = "documents_opened", flag: str = "churned_flag") -> DataFrame:
    """First, last and number of weeks, documents and flag per account."""
    return (
        df.dropna(subset=["account_id"])
        .groupBy("account_id")
        .agg(
            F.min("yyyywk").alias("first_week"),
            F.max("yyyywk").alias("last_week"),
            F.count("yyyywk").alias("n_weeks"),
            F.coalesce(F.sum(docs), F.lit(0)).alias("documents"),
            F.min(flag).alias("is_churned"),
        )
        .withColumn("weeks_active", F.col("last_week") - F.col("first_week"))
    )


def lifecycle_by_status(stats: DataFrame) -> DataFrame:
    return stats.dropna(subset=["is_churned"]).groupBy("is_churned").agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg("weeks_active").alias("mean_weeks_active"),
        F.avg("n_weeks").alias("mean_weeks"),
        F.sum("documents").alias("documents"),
    )


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """Most frequent values; equal counts in value order."""
    counts = df.dropna(subset=[column]).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return largest(counts, "count", n, column)


def activity_tiers(df: DataFrame, docs: str = "documents_opened") -> DataFrame:
    """Accounts per tier; the tiers are cut at the 0.33 and 0.67 quantiles of documents per account."""
    per_account = df.groupBy("account_id").agg(F.sum(docs).alias("docs")).dropna()
    cuts = exact_quantiles(per_account, "docs", {"low": 0.33, "high": 0.67}).select(F.struct("low", "high")).scalar()
    placed = per_account.withColumn("_c", cuts)
    tier = F.when(F.col("docs") <= F.col("_c.low"), "low").when(F.col("docs") <= F.col("_c.high"), "medium").otherwise("high")
    return placed.groupBy(tier.alias("tier")).agg(F.count(F.lit(1)).alias("customers"))


def activity_duration(df: DataFrame) -> DataFrame:
    """Weeks, months and years between first and last activity per account, with a bucket."""
    span = df.dropna(subset=["account_id", "yyyywk"]).groupBy("account_id").agg(
        F.min("yyyywk").alias("first_week"), F.max("yyyywk").alias("last_week"), F.count("yyyywk").alias("n_weeks")
    )
    weeks = weeks_between("first_week", "last_week")
    return span.withColumn("weeks", weeks).withColumns(
        {
            "months": F.col("weeks") / F.lit(4.33),
            "years": F.col("weeks") / F.lit(52),
            "duration": duration_bucket(F.col("weeks")),
        }
    )


def duration_bucket(weeks: Column) -> Column:
    """Bucket of right-closed week ranges; nothing for zero or less."""
    label = reduce(
        lambda acc, el: acc.when(weeks <= el[0], F.lit(el[1])),
        zip(DURATION_EDGES, DURATION_LABELS),
        F.when(weeks <= 0, None),
    )
    return label.when(weeks.isNotNull(), F.lit(DURATION_LABELS[-1]))


def duration_buckets(durations: DataFrame) -> DataFrame:
    return durations.groupBy("duration").agg(F.count(F.lit(1)).alias("customers"))


def duration_stats(durations: DataFrame) -> DataFrame:
    """Whole weeks take few values, so the built-in exact median is safe here."""
    return durations.agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg("weeks").alias("mean_weeks"),
        F.median("weeks").alias("median_weeks"),
        F.min("weeks").alias("min_weeks"),
        F.max("weeks").alias("max_weeks"),
        F.stddev_samp("weeks").alias("std_weeks"),
    )


def registrations_per_month(accounts: DataFrame, date: str) -> DataFrame:
    return accounts.dropna(subset=[date]).groupBy(month_of(date).alias("month")).agg(F.count(F.lit(1)).alias("registrations"))


# --- distributions --------------------------------------------------------------------


def histogram(df: DataFrame, value: str, bins: int | None = None, by: str | None = None, max_bins: int = 30) -> DataFrame:
    """Equal-width histogram over the range of all groups; the last bin is closed.

    Without ``bins`` the number is ``min(max_bins, floor(sqrt(n)))``, at least 1.
    """
    rows = df.dropna(subset=[value])
    v = F.col(value).cast("double")
    edge = scalars(rows, lo=F.min(v), hi=F.max(v), n=F.count(v))
    binned = rows.withColumn("_e", edge)
    count = (
        F.lit(bins)
        if bins is not None
        else F.greatest(F.least(F.lit(max_bins), F.floor(F.sqrt(F.col("_e.n"))).cast("int")), F.lit(1))
    )
    width = (F.col("_e.hi") - F.col("_e.lo")) / count
    index = F.when(width > 0, F.least(F.floor((v - F.col("_e.lo")) / width).cast("int"), count - 1)).otherwise(0)
    groups = [] if by is None else [by]
    return binned.groupBy(*groups, index.alias("bin"), (F.col("_e.lo") + index * width).alias("bin_start")).agg(
        F.count(F.lit(1)).alias("n")
    )


def quantile_stats(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """Mean, deviation, quartiles, min and max; quartiles are exact at any size."""
    by = list(by or [])
    rows = df.dropna(subset=[value, *by])
    basic = rows.groupBy(*by).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).cast("double").alias("min"),
        F.max(value).cast("double").alias("max"),
    )
    quartiles = exact_quantiles(rows, value, {"q25": 0.25, "median": 0.5, "q75": 0.75}, by)
    if by:
        return basic.join(quartiles, by)
    names = [c for c in quartiles.columns]
    return basic.withColumn("_q", quartiles.select(F.struct(*names)).scalar()).select("*", "_q.*").drop("_q")


def five_numbers(df: DataFrame, value: str, by: str) -> DataFrame:
    """Minimum, quartiles and maximum per group."""
    return exact_quantiles(df, value, {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p100": 1.0}, [by])


def cumulative_share(df: DataFrame, value: str) -> DataFrame:
    """Empirical distribution: each distinct value with the percentage of rows at or below it."""
    ranked = ranked_values(df, value)
    return ranked.select(value, ((F.col("before") + F.col("n")) / F.col("total") * 100).alias("cum_pct"))


def describe_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """count, mean, std, min, quartiles and max, one row per numeric column."""
    chosen = columns or numeric_columns(df)
    melted = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in chosen])).alias("m")
    ).select("m.column", "m.value")
    return quantile_stats(melted, "value", ["column"])


def mean_of_means(df: DataFrame, value: str, key: str = "account_id") -> DataFrame:
    return df.dropna(subset=[key]).groupBy(key).agg(F.avg(value).alias("m")).agg(F.avg("m").alias("mean_of_means"))


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, in one pass over the data."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    listed = [
        F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"c{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)
        for x, y in ([(a, b), (b, a)] if a != b else [(a, b)])
    ]
    return row.select(F.explode(F.array(*listed)).alias("r")).select("r.*")


def class_proportions(df: DataFrame, side: str, label: str) -> DataFrame:
    """Share of each class within its side; the window runs over class counts only."""
    counted = df.groupBy(side, label).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("proportion", F.col("n") / F.sum("n").over(W.partitionBy(side)))


# --- completeness and readiness ----------------------------------------------------------


def completeness(df: DataFrame, top: int | None = None) -> DataFrame:
    """Percentage of known values per column, one pass; optionally the most complete ones."""
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    listed = [
        F.struct(F.lit(c).alias("column"), F.coalesce(F.try_divide(F.col(c), F.col("_n")) * 100, F.lit(0.0)).alias("complete_pct"))
        for c in df.columns
    ]
    table = row.select(F.explode(F.array(*listed)).alias("r")).select("r.*")
    return table if top is None else largest(table, "complete_pct", top, "column")


def missing_share(bundle: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns and percentage of missing cells per table."""
    parts = []
    for name, df in bundle.items():
        cells = reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in df.columns])
        parts.append(
            df.agg(F.count(F.lit(1)).alias("records"), cells.alias("_m")).select(
                F.lit(name).alias("dataset"),
                "records",
                F.lit(len(df.columns)).cast("long").alias("columns"),
                (F.try_divide(F.col("_m"), F.col("records") * len(df.columns)) * 100).alias("missing_pct"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def entities_per_dataset(bundle: dict[str, DataFrame], key: str = "account_id") -> DataFrame:
    parts = [
        df.select(F.lit(name).alias("dataset"), F.col(key)).dropna().distinct()
        for name, df in bundle.items()
        if key in df.columns
    ]
    return reduce(DataFrame.unionByName, parts).groupBy("dataset").agg(F.count(key).alias("customers"))


def entities_by_flag(bundle: dict[str, DataFrame], key: str = "account_id", flag: str = "churned_flag") -> DataFrame:
    """Distinct accounts per dataset and flag."""
    parts = [
        df.select(F.lit(name).alias("dataset"), F.col(flag).cast("int").alias("flag"), F.col(key)).dropna(subset=[key]).distinct()
        for name, df in bundle.items()
    ]
    return reduce(DataFrame.unionByName, parts).groupBy("dataset", "flag").agg(F.count(key).alias("customers"))


def readiness(bundle: dict[str, DataFrame], min_weeks: int = 12, min_rows: int = 1000) -> DataFrame:
    """Checklist over a live bundle: inputs present, weeks covered, rows in total.

    ``bundle`` may have ``weekly``, ``metadata`` and ``features``.
    """
    spark = next(iter(bundle.values())).sparkSession
    zero = spark.range(1).select(F.lit(0).cast("long").alias("n"))

    def rows(name: str) -> DataFrame:
        return bundle[name].agg(F.count(F.lit(1)).alias("n")) if name in bundle else zero

    def distinct(name: str, column: str) -> DataFrame:
        if name not in bundle:
            return zero
        return bundle[name].select(column).dropna().distinct().agg(F.count(F.lit(1)).alias("n"))

    total = reduce(DataFrame.unionByName, [rows(name) for name in bundle]).agg(F.sum("n").alias("n"))
    checks = [
        ("time series data", rows("weekly"), 1 if "weekly" in bundle else None, 0),
        ("customer metadata", distinct("metadata", "account_id"), 1 if "metadata" in bundle else None, 0),
        ("feature data", rows("features"), 1 if "features" in bundle else None, 0),
        ("time coverage", distinct("weekly", "yyyywk"), 1, min_weeks),
        ("data volume", total, 1, min_rows),
    ]
    lines = [
        df.select(
            F.lit(name).alias("criterion"),
            F.when(F.lit(present is not None) & (F.col("n") >= least), "READY").otherwise("NOT READY").alias("status"),
            F.col("n").alias("amount"),
        )
        for name, df, present, least in checks
    ]
    return reduce(DataFrame.unionByName, lines)


def active_summary(
    accounts: DataFrame, weekly: DataFrame, risk: DataFrame | None = None, top_n: int = 5, score: str = "risk_score"
) -> DataFrame:
    """Headline figures of the active accounts as one row; the accounts are computed once."""
    accounts = settled(accounts, "accounts")
    active = active_only(accounts)
    row = accounts.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(F.col("churned_flag") == 0).alias("active_customers"),
        F.count_if(F.col("churned_flag") == 1).alias("churned_customers"),
    ).withColumn("active_rate_pct", F.try_divide(F.col("active_customers"), F.col("total_customers")) * 100)
    per_account = weekly.dropna(subset=["account_id"]).groupBy("account_id").agg(F.count(F.lit(1)).alias("n"))
    parts = [
        per_account.agg(
            F.count(F.lit(1)).alias("active_customers_with_usage"),
            F.avg("n").alias("avg_weeks_of_usage"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_usage_records"),
        )
    ]
    if risk is not None:
        scores = risk.join(active.select(F.col("account_id").alias("account_number")), "account_number", "left_semi")
        stats = quantile_stats(scores, score)
        parts.append(
            stats.select(
                F.col("mean").alias("avg_risk_score_active"),
                F.col("median").alias("median_risk_score_active"),
                F.col("std").alias("std_risk_score_active"),
            )
        )
    for part in parts:
        row = row.withColumn("_p", part.select(F.struct(*part.columns)).scalar()).select("*", "_p.*").drop("_p")
    top = top_values(active, "segment", top_n).withColumnRenamed("count", "total_count")
    row = with_top_segments(row, top, top_n, ["segment", "total_count"], ["name", "count"])
    shares = [
        (F.col(f"segment_{i}_count") / F.col("active_customers") * 100).alias(f"segment_{i}_pct") for i in range(1, top_n + 1)
    ]
    return row.select("*", *shares)


# --- monitoring ---------------------------------------------------------------------------


def monitoring_tables(features: DataFrame) -> dict[str, DataFrame]:
    """The tables behind the monitoring view of a feature dataset."""
    return {
        "segments": top_values(features.select("account_id", "segment").distinct(), "segment", 10),
        "weekly_documents": weekly_metric_stats(features, "documents_opened"),
        "weekly_storage": weekly_metric_stats(features, "storage_mb"),
        "flags": features.groupBy("churned_flag").agg(F.count(F.lit(1)).alias("count")),
        "days_to_churn": quantile_stats(features.where(F.col("days_to_churn").between(0, 9998)), "days_to_churn"),
        "log_documents": features.where(F.col("documents_opened") > 0).select(
            "account_id", "yyyywk", F.log1p(F.col("documents_opened").cast(T.DoubleType())).alias("log_documents")
        ),
    }
