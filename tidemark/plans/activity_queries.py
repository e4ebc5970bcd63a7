"""Weekly activity, lifecycle, distributions, completeness and readiness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.weeks import week_midpoint
from tidemark.operators import activity as A
from tidemark.operators.relational import active_only
from tidemark.operators.scale import settled
from tidemark.plans.expression_queries import monday_sql
from tidemark.plans.inputs import Inputs, week_sql
from tidemark.plans.registry import add, longs, rounded, shown

BETWEEN = "((last_week // 100 - first_week // 100) * 52 + last_week % 100 - first_week % 100 + 1)"
SPANS = f"""spans AS (SELECT *, {BETWEEN} AS weeks FROM (SELECT account_id, min(yyyywk) AS first_week, max(yyyywk) AS last_week, count(*) AS n_weeks
    FROM weekly GROUP BY 1))"""
BUCKET = """CASE WHEN weeks <= 0 THEN NULL WHEN weeks <= 13 THEN '< 3 months' WHEN weeks <= 26 THEN '3-6 months' WHEN weeks <= 52 THEN '6-12 months'
    WHEN weeks <= 104 THEN '1-2 years' ELSE '> 2 years' END"""

add(
    "weekly_totals", "A24",
    lambda t: longs(A.weekly_totals(t.weekly, ["documents_opened", "storage_mb"])),
    "SELECT yyyywk::BIGINT AS yyyywk, documents_opened, storage_mb FROM weekly_totals",
)
add(
    "weekly_metric_stats", "A25 P8",
    lambda t: shown(A.weekly_metric_stats(t.weekly, "storage_mb")),
    """SELECT yyyywk::BIGINT AS yyyywk, sum(storage_mb)::BIGINT AS total, round(avg(storage_mb), 6) AS mean, count(storage_mb) AS n
        FROM weekly GROUP BY 1 HAVING sum(storage_mb) IS NOT NULL""",
)
add(
    "weekly_active", "A26",
    lambda t: longs(A.weekly_active(t.weekly)),
    "SELECT yyyywk::BIGINT AS yyyywk, count(DISTINCT account_id) FILTER (WHERE churned_flag = 0) AS active_customers FROM weekly GROUP BY 1",
)
add(
    "weekly_active_flag_sum", "A26",
    lambda t: longs(A.weekly_active(t.weekly.drop("account_id"))),
    "SELECT yyyywk::BIGINT AS yyyywk, count(*) FILTER (WHERE churned_flag = 0) AS active_customers FROM weekly GROUP BY 1",
)
add(
    "weekly_active_approx", "A26",
    lambda t: longs(
        A.weekly_active(t.weekly).join(A.weekly_active(t.weekly, approx=True).withColumnRenamed("active_customers", "about"), "yyyywk").select(
            "yyyywk", "active_customers", (F.abs(F.col("about") - F.col("active_customers")) <= 1 + 0.2 * F.col("active_customers")).alias("close")
        )
    ),
    """SELECT yyyywk::BIGINT AS yyyywk, count(DISTINCT account_id) FILTER (WHERE churned_flag = 0) AS active_customers, true AS close FROM weekly GROUP BY 1""",
)


def active_at_two_grains(t: Inputs) -> DataFrame:
    """Active accounts per week and per month of the weeks' middle days, from one table of bitmaps."""
    bitmaps = settled(A.active_bitmaps(t.weekly), "bitmaps")
    weeks = A.active_per_period(bitmaps, F.col("yyyywk").cast("long")).withColumn("grain", F.lit("week"))
    month = F.date_format(week_midpoint("yyyywk"), "yyyyMM").cast("long")
    return weeks.unionByName(A.active_per_period(bitmaps, month).withColumn("grain", F.lit("month")))


add(
    "active_by_week_and_month", "A26",
    active_at_two_grains,
    """WITH active AS (SELECT DISTINCT yyyywk::BIGINT AS yyyywk, account_id FROM weekly WHERE churned_flag = 0 AND account_id IS NOT NULL)
        SELECT 'week' AS grain, yyyywk AS period, count(*) AS active_customers FROM active GROUP BY yyyywk UNION ALL
        SELECT 'month', strftime(CAST(date_trunc('week', make_date(yyyywk // 100, 1, 4)) AS DATE) + CAST((yyyywk % 100 - 1) * 7 + 2 AS INTEGER), '%Y%m')::BIGINT AS m,
        count(DISTINCT account_id) FROM active GROUP BY m""",
)
add(
    "weekly_overview", "A24 A27 P10",
    lambda t: shown(A.weekly_overview(t.weekly, ["documents_opened", "storage_mb"])),
    """SELECT yyyywk::BIGINT AS yyyywk, sum(documents_opened)::BIGINT AS documents_opened, sum(storage_mb)::BIGINT AS storage_mb,
        count(DISTINCT account_id) AS customers, round(coalesce(sum(documents_opened) / count(DISTINCT account_id), 0), 6) AS docs_per_customer
        FROM weekly GROUP BY 1""",
)
add(
    "weekly_by_status", "A28",
    lambda t: shown(A.weekly_by_status(t.weekly, "documents_opened")),
    """SELECT yyyywk::BIGINT AS yyyywk, round(avg(documents_opened) FILTER (WHERE churned_flag = 1), 6) AS churned_mean,
        round(avg(documents_opened) FILTER (WHERE churned_flag = 0), 6) AS active_mean, round(avg(documents_opened), 6) AS all_mean FROM weekly GROUP BY 1""",
)
add(
    "week_over_week", "W6",
    lambda t: shown(A.week_over_week(t.weekly_totals, "documents_opened")),
    """SELECT yyyywk::BIGINT AS yyyywk, documents_opened, round((documents_opened - lag(documents_opened) OVER (ORDER BY yyyywk))
        / nullif(lag(documents_opened) OVER (ORDER BY yyyywk), 0) * 100, 6) AS growth_pct FROM weekly_totals""",
)
add(
    "mean_growth", "W6",
    lambda t: rounded(A.mean_growth(t.weekly_totals, "storage_mb")),
    """SELECT round(avg(g), 6) AS mean_growth_pct FROM (SELECT (storage_mb - lag(storage_mb) OVER (ORDER BY yyyywk))
        / nullif(lag(storage_mb) OVER (ORDER BY yyyywk), 0) * 100 AS g FROM weekly_totals)""",
)
LIFE = """life AS (SELECT account_id, min(yyyywk)::BIGINT AS first_week, max(yyyywk)::BIGINT AS last_week, count(*) AS n_weeks,
    coalesce(sum(documents_opened), 0)::BIGINT AS documents, min(churned_flag)::BIGINT AS is_churned, (max(yyyywk) - min(yyyywk))::BIGINT AS weeks_active
    FROM weekly GROUP BY 1)"""
add("lifecycle", "A29 F8", lambda t: longs(A.lifecycle(t.weekly)), f"WITH {LIFE} SELECT * FROM life")
add(
    "lifecycle_by_status", "A29",
    lambda t: shown(A.lifecycle_by_status(A.lifecycle(t.weekly))),
    f"""WITH {LIFE} SELECT is_churned, count(*) AS customers, round(avg(weeks_active), 6) AS mean_weeks_active, round(avg(n_weeks), 6) AS mean_weeks,
        sum(documents)::BIGINT AS documents FROM life GROUP BY 1""",
)
add(
    "top_values", "A30 O3",
    lambda t: A.top_values(t.raw("lineitem").join(t.raw("part"), F.col("l_partkey") == F.col("p_partkey")), "p_name", 10),
    "SELECT p_name, count(*) AS count FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
add(
    "activity_tiers", "A31 T8",
    lambda t: A.activity_tiers(t.weekly),
    """WITH d AS (SELECT account_id, sum(documents_opened) AS docs FROM weekly GROUP BY 1 HAVING sum(documents_opened) IS NOT NULL),
        q AS (SELECT quantile_cont(docs, 0.33) AS lo, quantile_cont(docs, 0.67) AS hi FROM d)
        SELECT CASE WHEN docs <= lo THEN 'low' WHEN docs <= hi THEN 'medium' ELSE 'high' END AS tier, count(*) AS customers FROM d, q GROUP BY 1""",
)
add(
    "activity_duration", "A32 D13",
    lambda t: shown(A.activity_duration(t.weekly)),
    f"""WITH {SPANS} SELECT account_id, first_week::BIGINT AS first_week, last_week::BIGINT AS last_week, n_weeks, weeks::BIGINT AS weeks,
        round(weeks / 4.33::DOUBLE, 6) AS months, round(weeks / 52, 6) AS years, {BUCKET} AS duration FROM spans""",
)
add("duration_buckets", "A32", lambda t: A.duration_buckets(A.activity_duration(t.weekly)), f"WITH {SPANS} SELECT {BUCKET} AS duration, count(*) AS customers FROM spans GROUP BY 1")
add(
    "duration_stats", "A32 A34",
    lambda t: shown(A.duration_stats(A.activity_duration(t.weekly))),
    f"""WITH {SPANS} SELECT count(*) AS customers, round(avg(weeks), 6) AS mean_weeks, median(weeks)::DOUBLE AS median_weeks, min(weeks)::BIGINT AS min_weeks,
        max(weeks)::BIGINT AS max_weeks, round(stddev_samp(weeks), 6) AS std_weeks FROM spans""",
)
add(
    "duration_ecdf", "W5",
    lambda t: shown(A.cumulative_share(A.activity_duration(t.weekly), "weeks")),
    f"WITH {SPANS} SELECT DISTINCT weeks::BIGINT AS weeks, round(cume_dist() OVER (ORDER BY weeks) * 100, 6) AS cum_pct FROM spans",
)
add(
    "price_ecdf", "W5",
    lambda t: rounded(A.cumulative_share(t.txn, "amount_due"), 6),
    "SELECT DISTINCT amount_due, round(cume_dist() OVER (ORDER BY amount_due) * 100, 6) AS cum_pct FROM txn",
)
add(
    "registrations_per_month", "A38",
    lambda t: A.registrations_per_month(t.account, "registered_on"),
    "SELECT CAST(date_trunc('month', registered_on) AS DATE) AS month, count(*) AS registrations FROM account WHERE registered_on IS NOT NULL GROUP BY 1",
)


def histogram_sql(table: str, value: str, bins: str, by: str = "") -> str:
    return f"""WITH e AS (SELECT min({value})::DOUBLE AS lo, max({value})::DOUBLE AS hi, ({bins})::INTEGER AS b FROM {table}),
        h AS (SELECT {by + ',' if by else ''} lo, (hi - lo) / b AS width, least(CAST(floor(({value} - lo) / ((hi - lo) / b)) AS INTEGER), b - 1) AS bin
              FROM {table}, e WHERE {value} IS NOT NULL)
        SELECT {by + ',' if by else ''} bin::BIGINT AS bin, round(lo + bin * width, 6) AS bin_start, count(*) AS n FROM h GROUP BY ALL"""


add("price_histogram", "A33", lambda t: shown(A.histogram(t.txn, "amount_due", 50)), histogram_sql("txn", "amount_due", "50"))
add(
    "risk_histogram_sized", "A33",
    lambda t: shown(A.histogram(t.risk, "risk_score")),
    histogram_sql("risk", "risk_score", "greatest(least(30, floor(sqrt(count(risk_score)))), 1)"),
)
add(
    "histogram_by_status", "A33 P10",
    lambda t: shown(A.histogram(t.weekly.where("documents_opened > 0"), "documents_opened", 20, by="churned_flag")),
    "WITH w AS (SELECT *, churned_flag::BIGINT AS flag FROM weekly WHERE documents_opened > 0), "
    + histogram_sql("w", "documents_opened", "20", "flag")[5:].replace("SELECT flag, bin", "SELECT flag AS churned_flag, bin"),
)
add(
    "price_quantiles_by_status", "A34 T8",
    lambda t: rounded(A.quantile_stats(t.orders, "o_totalprice", ["o_orderstatus"]), 3),
    """SELECT o_orderstatus, count(*) AS n, round(avg(o_totalprice), 3) AS mean, round(stddev_samp(o_totalprice), 3) AS std, min(o_totalprice) AS min,
        max(o_totalprice) AS max, round(quantile_cont(o_totalprice, 0.25), 3) AS q25, round(quantile_cont(o_totalprice, 0.5), 3) AS median,
        round(quantile_cont(o_totalprice, 0.75), 3) AS q75 FROM orders GROUP BY 1""",
)
DAYS = f"""days AS (SELECT account_id, date_diff('day', {monday_sql('yyyywk', 3)}, churn_date) AS d FROM weekly WHERE churned_flag = 1)"""
add(
    "days_to_churn_quantiles", "A34 P11",
    lambda t: rounded(A.quantile_stats(t.weekly.where("churned_flag = 1").select(
        F.datediff("churn_date", F.date_add(F.trunc(F.make_date(F.floor(F.col("yyyywk") / 100).cast("int"), F.lit(1), F.lit(4)), "week"),
                                            ((F.col("yyyywk") % 100 - 1) * 7 + 2).cast("int"))).alias("d")), "d"), 6),
    f"""WITH {DAYS} SELECT count(*) AS n, round(avg(d), 6) AS mean, round(stddev_samp(d), 6) AS std, min(d)::DOUBLE AS min, max(d)::DOUBLE AS max,
        round(quantile_cont(d, 0.25), 6) AS q25, round(quantile_cont(d, 0.5), 6) AS median, round(quantile_cont(d, 0.75), 6) AS q75 FROM days""",
)
add(
    "yearly_five_numbers", "A40 T8",
    lambda t: shown(A.five_numbers(t.orders.withColumn("year", F.year("o_orderdate")), "o_totalprice", "year"), 3),
    """SELECT year(o_orderdate)::BIGINT AS year, min(o_totalprice) AS p0, round(quantile_cont(o_totalprice, 0.25), 3) AS p25,
        round(quantile_cont(o_totalprice, 0.5), 3) AS p50, round(quantile_cont(o_totalprice, 0.75), 3) AS p75, max(o_totalprice) AS p100 FROM ord GROUP BY 1""",
)


def describe_sql(column: str, table: str) -> str:
    return f"""SELECT '{column}' AS "column", count({column}) AS n, round(avg({column}), 3) AS mean, round(stddev_samp({column}), 3) AS std,
        min({column})::DOUBLE AS min, max({column})::DOUBLE AS max, round(quantile_cont({column}::DOUBLE, 0.25), 3) AS q25,
        round(quantile_cont({column}::DOUBLE, 0.5), 3) AS median, round(quantile_cont({column}::DOUBLE, 0.75), 3) AS q75 FROM {table}"""


DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]
add(
    "numeric_describe", "A41",
    lambda t: rounded(A.describe_numeric(t.raw("lineitem"), DESCRIBED), 3),
    " UNION ALL ".join(describe_sql(c, "lineitem") for c in DESCRIBED),
)
add(
    "mean_of_means", "A42",
    lambda t: rounded(A.mean_of_means(t.weekly, "documents_opened")),
    "SELECT round(avg(m), 6) AS mean_of_means FROM (SELECT avg(documents_opened) AS m FROM weekly GROUP BY account_id)",
)
CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
add(
    "correlation_matrix", "A44",
    lambda t: rounded(A.correlation_matrix(t.raw("lineitem"), CORR)),
    " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM lineitem" for a in CORR for b in CORR),
)
add(
    "column_completeness", "A35 V17",
    lambda t: rounded(A.completeness(t.weekly.select("account_id", "documents_opened", "storage_mb", "churn_date"), 3)),
    """SELECT * FROM (SELECT 'account_id' AS "column", 100.0::DOUBLE AS complete_pct UNION ALL
        SELECT 'documents_opened', round(count(documents_opened) / count(*) * 100, 6) FROM weekly UNION ALL
        SELECT 'storage_mb', round(count(storage_mb) / count(*) * 100, 6) FROM weekly UNION ALL
        SELECT 'churn_date', round(count(churn_date) / count(*) * 100, 6) FROM weekly) ORDER BY complete_pct DESC, "column" LIMIT 3""",
)


def small_bundle(t: Inputs) -> dict[str, DataFrame]:
    return {"weekly": t.weekly, "account": t.account.select("account_id", "segment", "churned_flag", "churn_date")}


add(
    "missing_share", "A35",
    lambda t: rounded(A.missing_share(small_bundle(t))),
    """SELECT 'weekly' AS dataset, count(*) AS records, 7::BIGINT AS columns, round((2 * count(*) - count(documents_opened) - count(storage_mb)
        + count(*) - count(churn_date)) / (count(*) * 7) * 100, 6) AS missing_pct FROM weekly
        UNION ALL SELECT 'account', count(*), 4, round((count(*) - count(churn_date)) / (count(*) * 4) * 100, 6) FROM account""",
)
add(
    "entities_per_dataset", "A36",
    lambda t: A.entities_per_dataset(small_bundle(t)),
    """SELECT 'weekly' AS dataset, count(DISTINCT account_id) AS customers FROM weekly UNION ALL SELECT 'account', count(DISTINCT account_id) FROM account""",
)
add(
    "entities_by_flag", "A46 A36",
    lambda t: longs(A.entities_by_flag(small_bundle(t))),
    """SELECT 'weekly' AS dataset, churned_flag::BIGINT AS flag, count(DISTINCT account_id) AS customers FROM weekly GROUP BY 2
        UNION ALL SELECT 'account', churned_flag, count(DISTINCT account_id) FROM account GROUP BY 2""",
)
add(
    "readiness", "A37",
    lambda t: A.readiness({"weekly": t.weekly, "metadata": active_only(t.account)}),
    """WITH w AS (SELECT count(*) AS n, count(DISTINCT yyyywk) AS k FROM weekly), a AS (SELECT count(*) AS n FROM account WHERE churned_flag = 0)
        SELECT 'time series data' AS criterion, 'READY' AS status, n AS amount FROM w UNION ALL
        SELECT 'customer metadata', 'READY', n FROM a UNION ALL SELECT 'feature data', 'NOT READY', 0 UNION ALL
        SELECT 'time coverage', CASE WHEN k >= 12 THEN 'READY' ELSE 'NOT READY' END, k FROM w UNION ALL
        SELECT 'data volume', CASE WHEN w.n + a.n >= 1000 THEN 'READY' ELSE 'NOT READY' END, w.n + a.n FROM w, a""",
)
add(
    "active_summary", "A23 A16",
    lambda t: rounded(A.active_summary(t.account, t.weekly.where("churned_flag = 0"), t.risk, 2), 4),
    """WITH act AS (SELECT * FROM account WHERE churned_flag = 0),
        seg AS (SELECT segment, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, segment) AS rk FROM act GROUP BY 1),
        per AS (SELECT account_id, count(*) AS n FROM weekly WHERE churned_flag = 0 GROUP BY 1)
        SELECT * REPLACE (round(active_rate_pct, 4) AS active_rate_pct), round(segment_1_count / active_customers * 100, 4) AS segment_1_pct,
            round(segment_2_count / active_customers * 100, 4) AS segment_2_pct
        FROM (SELECT count(*) AS total_customers, count(*) FILTER (WHERE churned_flag = 0) AS active_customers, count(*) FILTER (WHERE churned_flag = 1) AS churned_customers,
                count(*) FILTER (WHERE churned_flag = 0) / count(*) * 100 AS active_rate_pct FROM account),
             (SELECT count(*) AS active_customers_with_usage, round(avg(n), 4) AS avg_weeks_of_usage, sum(n)::BIGINT AS total_usage_records FROM per),
             (SELECT round(avg(risk_score), 4) AS avg_risk_score_active, round(quantile_cont(risk_score, 0.5), 4) AS median_risk_score_active,
                round(stddev_samp(risk_score), 4) AS std_risk_score_active FROM risk JOIN act ON account_id = account_number),
             (SELECT max(segment) FILTER (WHERE rk = 1) AS segment_1_name, max(n) FILTER (WHERE rk = 1) AS segment_1_count,
                max(segment) FILTER (WHERE rk = 2) AS segment_2_name, max(n) FILTER (WHERE rk = 2) AS segment_2_count FROM seg)""",
)


def monitored(t: Inputs) -> dict[str, DataFrame]:
    return A.monitoring_tables(t.weekly.withColumn("days_to_churn", F.when(F.col("churned_flag") == 1, F.datediff("churn_date", F.lit("1995-01-01").cast("date"))).otherwise(9999)))


add(
    "monitoring_segments", "PL9 A30",
    lambda t: monitored(t)["segments"],
    "SELECT segment, count(DISTINCT account_id) AS count FROM weekly GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
add(
    "monitoring_days_to_churn", "PL9 A34 P11",
    lambda t: rounded(monitored(t)["days_to_churn"]),
    """WITH x AS (SELECT date_diff('day', DATE '1995-01-01', churn_date) AS d FROM weekly WHERE churned_flag = 1)
        SELECT count(*) AS n, round(avg(d), 6) AS mean, round(stddev_samp(d), 6) AS std, min(d)::DOUBLE AS min, max(d)::DOUBLE AS max,
        round(quantile_cont(d, 0.25), 6) AS q25, round(quantile_cont(d, 0.5), 6) AS median, round(quantile_cont(d, 0.75), 6) AS q75 FROM x""",
)
add(
    "monitoring_log_documents", "PL9",
    lambda t: shown(monitored(t)["log_documents"]),
    "SELECT account_id, yyyywk::BIGINT AS yyyywk, round(ln(1 + documents_opened), 6) AS log_documents FROM weekly WHERE documents_opened > 0",
)
add(
    "monitoring_flags", "PL9 A30",
    lambda t: longs(monitored(t)["flags"]),
    "SELECT churned_flag::BIGINT AS churned_flag, count(*) AS count FROM weekly GROUP BY 1",
)
