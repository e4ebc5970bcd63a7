"""Churn counts, rates, lifespans and their distribution over time and segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.weeks import calendar_parts, date_to_week, month_of, weeks_between
from tidemark.operators.relational import churned_only, largest
from tidemark.operators.scale import exact_quantiles, scalars, settled


def first_active_week(usage: DataFrame, key: str = "account_id", week: str = "yyyywk") -> DataFrame:
    return usage.groupBy(key).agg(F.min(week).alias(week))


def first_week_of(usage: DataFrame, accounts: DataFrame, flag: int | None = None) -> DataFrame:
    """First active week of all accounts, or of those with the given churn flag."""
    chosen = accounts if flag is None else accounts.where(F.col("churned_flag") == flag)
    return first_active_week(usage).join(chosen.select("account_id", "churned_flag", "churn_date"), "account_id")


def churn_totals(accounts: DataFrame) -> DataFrame:
    totals = accounts.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(F.col("churned_flag") == 1).alias("churned_customers"),
        F.count_if(F.col("churned_flag") == 0).alias("active_customers"),
    )
    return totals.withColumn("churn_rate_pct", F.try_divide(F.col("churned_customers"), F.col("total_customers")) * 100)


def churned_with_date(accounts: DataFrame, since: str | None = None) -> DataFrame:
    rows = churned_only(accounts).where(F.col("churn_date").isNotNull())
    return rows if since is None else rows.where(F.col("churn_date") >= F.lit(since).cast("date"))


def monthly_churn(accounts: DataFrame, since: str | None = None) -> DataFrame:
    """Months with churn: count, first and last churn date, label."""
    month = month_of("churn_date").alias("month")
    return (
        churned_with_date(accounts, since)
        .groupBy(month)
        .agg(
            F.count(F.lit(1)).alias("customers_churned"),
            F.min("churn_date").alias("first_churn_date"),
            F.max("churn_date").alias("last_churn_date"),
        )
        .withColumn("month_label", F.date_format("month", "yyyy-MM"))
    )


def fill_months(monthly: DataFrame, month: str = "month", count: str = "customers_churned") -> DataFrame:
    """A monthly table with its empty months as 0, from its first month to its last."""
    span = monthly.agg(F.min(month).alias("a"), F.max(month).alias("b"))
    months = span.select(F.explode(F.expr("sequence(a, b, interval 1 month)")).alias(month))
    return months.join(monthly.select(month, count), month, "left").withColumn(count, F.coalesce(count, F.lit(0)))


def monthly_churn_stats(accounts: DataFrame, since: str | None = None) -> DataFrame:
    """Mean, sample deviation, median, min and max per month, empty months counted as 0."""
    c = "customers_churned"
    filled = fill_months(monthly_churn(accounts, since))
    total = scalars(accounts, n=F.count(F.lit(1)))
    return filled.agg(
        F.avg(c).alias("monthly_churn_mean"),
        F.stddev_samp(c).alias("monthly_churn_std"),
        F.median(c).alias("monthly_churn_median"),
        F.min(c).cast("double").alias("monthly_churn_min"),
        F.max(c).cast("double").alias("monthly_churn_max"),
    ).withColumn("monthly_churn_rate_mean_pct", F.try_divide(F.col("monthly_churn_mean"), total.getField("n")) * 100)


def cumulative_churn(monthly: DataFrame) -> DataFrame:
    """Running total over a monthly table; its months, not the data, bound the window."""
    upto = W.orderBy("month").rowsBetween(W.unboundedPreceding, 0)
    return monthly.withColumn("cumulative_churned", F.sum("customers_churned").over(upto))


def lifespans(accounts: DataFrame, first_week: DataFrame) -> DataFrame:
    """Weeks from first activity to churn per churned account.

    ``lifespan_weeks`` is the difference of the two week keys, as reported so
    far; ``lifespan_weeks_exact`` counts real weeks.
    """
    start = first_week.select("account_id", F.col("yyyywk").alias("first_week"))
    return churned_only(accounts).join(start, "account_id", "left").select(
        "account_id",
        (date_to_week("churn_date") - F.col("first_week")).alias("lifespan_weeks"),
        weeks_between("first_week", date_to_week("churn_date"), exact=True).alias("lifespan_weeks_exact"),
    )


def lifespan_stats(accounts: DataFrame, first_week: DataFrame) -> DataFrame:
    """Mean, median and deviation of the positive lifespans.

    Whole weeks take few distinct values, so the built-in exact median is safe.
    """
    w = "lifespan_weeks"
    return lifespans(accounts, first_week).where(F.col(w) > 0).agg(
        F.avg(w).alias("avg_lifespan_weeks"),
        (F.avg(w) * 7).alias("avg_lifespan_days"),
        F.median(w).alias("median_lifespan_weeks"),
        F.stddev_samp(w).alias("std_lifespan_weeks"),
    )


def churn_by_segment(accounts: DataFrame, segment: str = "segment") -> DataFrame:
    return (
        accounts.dropna(subset=[segment])
        .groupBy(segment)
        .agg(
            F.count_if(F.col("churned_flag") == 1).alias("churned_count"),
            F.count("account_id").alias("total_count"),
        )
        .withColumn("churn_rate_pct", F.try_divide(F.col("churned_count"), F.col("total_count")) * 100)
    )


def top_segments(accounts: DataFrame, n: int = 5, segment: str = "segment") -> DataFrame:
    return largest(churn_by_segment(accounts, segment), "total_count", n, segment)


def churn_by_year(accounts: DataFrame) -> DataFrame:
    year = F.year("churn_date").alias("year")
    return churned_with_date(accounts).groupBy(year).agg(F.count(F.lit(1)).alias("customers_churned"))


def yearly_trend(accounts: DataFrame) -> DataFrame:
    """Churn in the first and the last year, and whether it rose."""
    ends = churn_by_year(accounts).agg(
        F.max_by("customers_churned", "year").alias("latest_year_churn"),
        F.min_by("customers_churned", "year").alias("earliest_year_churn"),
    )
    return ends.withColumn("churn_trend_increasing", F.col("latest_year_churn") > F.col("earliest_year_churn"))


def risk_by_status(accounts: DataFrame, risk: DataFrame, score: str = "risk_score") -> DataFrame:
    """Risk score statistics per churn flag; the score column is a parameter."""
    scored = accounts.join(risk.select(F.col("account_number").alias("account_id"), score), "account_id", "left")
    scored = scored.dropna(subset=[score, "churned_flag"])
    basic = scored.groupBy("churned_flag").agg(
        F.avg(score).alias("avg_risk"), F.stddev_samp(score).alias("std_risk"), F.count(score).alias("n")
    )
    return basic.join(exact_quantiles(scored, score, {"median_risk": 0.5}, ["churned_flag"]), "churned_flag")


def churn_distribution(accounts: DataFrame, since: str | None = None) -> DataFrame:
    """Distribution of monthly churn over the months that have any (population deviation)."""
    monthly = monthly_churn(accounts, since)
    c = F.col("customers_churned")
    q = F.percentile(c, F.array(*[F.lit(p) for p in (0.25, 0.5, 0.75, 0.9, 0.95)]))
    peak = F.min(F.struct((-c).alias("c"), F.col("month_label").alias("m")))
    low = F.min(F.struct(c.alias("c"), F.col("month_label").alias("m")))
    d = monthly.agg(
        F.avg(c).alias("mean_churns_per_month"),
        F.stddev_pop(c).alias("std_churns_per_month"),
        F.min(c).alias("min_churns_per_month"),
        F.max(c).alias("max_churns_per_month"),
        F.count(F.lit(1)).alias("total_months"),
        F.sum(c).alias("total_churned_customers"),
        q.alias("_q"),
        peak.alias("_p"),
        low.alias("_l"),
    )
    return d.select(
        "mean_churns_per_month",
        F.col("_q")[1].alias("median_churns_per_month"),
        "std_churns_per_month",
        "min_churns_per_month",
        "max_churns_per_month",
        "total_months",
        "total_churned_customers",
        F.coalesce(F.try_divide(F.col("std_churns_per_month"), F.col("mean_churns_per_month")), F.lit(0.0)).alias(
            "coefficient_of_variation"
        ),
        F.col("_q")[0].alias("percentile_25"),
        F.col("_q")[2].alias("percentile_75"),
        F.col("_q")[3].alias("percentile_90"),
        F.col("_q")[4].alias("percentile_95"),
        (F.col("_q")[2] - F.col("_q")[0]).alias("iqr"),
        F.col("_p.m").alias("peak_churn_month"),
        (-F.col("_p.c")).alias("peak_churn_count"),
        F.col("_l.m").alias("lowest_churn_month"),
        F.col("_l.c").alias("lowest_churn_count"),
    )


def _by_calendar(accounts: DataFrame, since: str | None, *parts: str) -> DataFrame:
    """Churned accounts per year and month (a small table), ready to roll up."""
    p = calendar_parts("churn_date")
    columns = [p.getField(x).alias(x) for x in ("year", "quarter", "month", "month_name")]
    monthly = (
        churned_with_date(accounts, since).select(*columns).groupBy("year", "quarter", "month", "month_name").count()
    )
    return monthly.select(*parts, "year", "count") if "year" not in parts else monthly.select(*parts, "count")


def churn_by_quarter(accounts: DataFrame, since: str | None = None) -> DataFrame:
    return _by_calendar(accounts, since, "year", "quarter").groupBy("year", "quarter").agg(
        F.sum("count").alias("customers_churned")
    )


def churn_by_season(accounts: DataFrame, since: str | None = None) -> DataFrame:
    """Churn by quarter over all years; the average is per year in which the quarter had churn."""
    return _by_calendar(accounts, since, "quarter").groupBy("quarter").agg(
        F.sum("count").alias("total_churns"),
        (F.sum("count") / F.count_distinct("year")).alias("avg_churns"),
    )


def churn_per_year(accounts: DataFrame, since: str | None = None) -> DataFrame:
    return (
        _by_calendar(accounts, since, "year", "month")
        .groupBy("year")
        .agg(F.sum("count").alias("customers_churned"), F.count_distinct("month").alias("months_with_churn"))
        .withColumn("avg_monthly_churn", F.col("customers_churned") / F.col("months_with_churn"))
    )


def churn_by_month_of_year(accounts: DataFrame, since: str | None = None) -> DataFrame:
    """Churn by calendar month; the average is per year in which the month had churn."""
    return _by_calendar(accounts, since, "month", "month_name").groupBy("month", "month_name").agg(
        F.sum("count").alias("total_churns"),
        (F.sum("count") / F.count_distinct("year")).alias("avg_churns"),
    )


def churn_year_month_grid(accounts: DataFrame, since: str | None = None) -> DataFrame:
    """Year by month table of churn counts, 0 where there is none."""
    grid = _by_calendar(accounts, since, "year", "month").groupBy("year").pivot("month", list(range(1, 13)))
    return grid.agg(F.sum("count")).fillna(0).withColumnsRenamed({str(m): f"m{m:02d}" for m in range(1, 13)})


def churn_summary(
    accounts: DataFrame, first_week: DataFrame, risk: DataFrame | None = None, top_n: int = 5, score: str = "risk_score"
) -> DataFrame:
    """All headline churn figures as one row; the accounts are computed once."""
    accounts = settled(accounts, "accounts")
    row = churn_totals(accounts)
    parts = [monthly_churn_stats(accounts), lifespan_stats(accounts, first_week), yearly_trend(accounts)]
    if risk is not None:
        by_flag = risk_by_status(accounts, risk, score)
        parts.append(
            by_flag.agg(
                F.max(F.when(F.col("churned_flag") == 1, F.col("avg_risk"))).alias("avg_risk_score_churned"),
                F.max(F.when(F.col("churned_flag") == 0, F.col("avg_risk"))).alias("avg_risk_score_active"),
            )
        )
    for i, part in enumerate(parts):
        fields = part.columns
        row = row.withColumn("_p", part.select(F.struct(*fields)).scalar()).select("*", *[F.col(f"_p.{f}") for f in fields])
        row = row.drop("_p")
    return with_top_segments(row, top_segments(accounts, top_n), top_n, ["segment", "churn_rate_pct", "total_count"],
                             ["name", "churn_rate_pct", "total_customers"])


def with_top_segments(row: DataFrame, top: DataFrame, n: int, fields: list[str], names: list[str]) -> DataFrame:
    """Spread the at most ``n`` rows of a top list over columns of a one-row frame."""
    size = "total_count"
    ranked = F.array_sort(F.collect_list(F.struct((-F.col(size)).alias("_r"), F.col("segment").alias("_s"), *[F.col(f).alias(a) for f, a in zip(fields, names)])))
    listed = top.agg(ranked.alias("t")).scalar()
    row = row.withColumn("_t", listed)
    spread = [
        F.get(F.col("_t"), F.lit(i)).getField(a).alias(f"segment_{i + 1}_{a}") for i in range(n) for a in names
    ]
    return row.select("*", *spread).drop("_t")
