"""Churn counts, rates, lifespans and distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import churn
from tidemark.plans.inputs import Inputs
from tidemark.plans.registry import add, longs, rounded, shown

SINCE = "1996-06-01"
CHURNED = "ch AS (SELECT * FROM account WHERE churned_flag = 1 AND churn_date IS NOT NULL)"
RECENT = f"ch AS (SELECT * FROM account WHERE churned_flag = 1 AND churn_date >= DATE '{SINCE}')"
MONTHLY = """mo AS (SELECT CAST(date_trunc('month', churn_date) AS DATE) AS month, count(*) AS customers_churned, min(churn_date) AS first_churn_date,
    max(churn_date) AS last_churn_date, strftime(date_trunc('month', churn_date), '%Y-%m') AS month_label FROM ch GROUP BY ALL)"""
FILLED = """filled AS (SELECT month, coalesce(customers_churned, 0) AS customers_churned FROM (
    SELECT CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM mo) LEFT JOIN mo USING (month))"""
SPAN = """span AS (SELECT account_id, isoyear(churn_date) * 100 + weekofyear(churn_date) - yyyywk AS w,
    date_diff('day', CAST(date_trunc('week', make_date(yyyywk // 100, 1, 4)) AS DATE) + CAST((yyyywk % 100 - 1) * 7 AS INTEGER),
              CAST(date_trunc('week', churn_date) AS DATE)) // 7 AS e
    FROM account LEFT JOIN first_week USING (account_id) WHERE churned_flag = 1)"""

add(
    "churn_totals", "A11",
    lambda t: rounded(churn.churn_totals(t.account)),
    """SELECT count(*) AS total_customers, count(*) FILTER (WHERE churned_flag = 1) AS churned_customers,
        count(*) FILTER (WHERE churned_flag = 0) AS active_customers, round(count(*) FILTER (WHERE churned_flag = 1) / count(*) * 100, 6) AS churn_rate_pct FROM account""",
)
add("monthly_churn", "A17 D15", lambda t: churn.monthly_churn(t.account, SINCE), f"WITH {RECENT}, {MONTHLY} SELECT * FROM mo")
add("months_filled", "W8", lambda t: churn.fill_months(churn.monthly_churn(t.account)), f"WITH {CHURNED}, {MONTHLY}, {FILLED} SELECT * FROM filled")
MONTH_STATS = """round(avg(customers_churned), 6) AS monthly_churn_mean, round(stddev_samp(customers_churned), 6) AS monthly_churn_std,
    median(customers_churned)::DOUBLE AS monthly_churn_median, min(customers_churned)::DOUBLE AS monthly_churn_min, max(customers_churned)::DOUBLE AS monthly_churn_max,
    round(avg(customers_churned) / (SELECT count(*) FROM account) * 100, 6) AS monthly_churn_rate_mean_pct"""
add(
    "monthly_churn_stats", "A12 T6",
    lambda t: rounded(churn.monthly_churn_stats(t.account)),
    f"WITH {CHURNED}, {MONTHLY}, {FILLED} SELECT {MONTH_STATS} FROM filled",
)
add(
    "cumulative_churn", "W4",
    lambda t: churn.cumulative_churn(churn.fill_months(churn.monthly_churn(t.account))),
    f"WITH {CHURNED}, {MONTHLY}, {FILLED} SELECT *, sum(customers_churned) OVER (ORDER BY month)::BIGINT AS cumulative_churned FROM filled",
)
add(
    "lifespans", "J8 D13",
    lambda t: longs(churn.lifespans(t.account, t.first_week)),
    f"WITH {SPAN} SELECT account_id, w::BIGINT AS lifespan_weeks, e::BIGINT AS lifespan_weeks_exact FROM span",
)
LIFE_STATS = """round(avg(w), 6) AS avg_lifespan_weeks, round(avg(w) * 7, 6) AS avg_lifespan_days, median(w)::DOUBLE AS median_lifespan_weeks,
    round(stddev_samp(w), 6) AS std_lifespan_weeks"""
add(
    "lifespan_stats", "A13",
    lambda t: rounded(churn.lifespan_stats(t.account, t.first_week)),
    f"WITH {SPAN} SELECT {LIFE_STATS} FROM span WHERE w > 0",
)
SEGMENTS = """SELECT segment, count(*) FILTER (WHERE churned_flag = 1) AS churned_count, count(*) AS total_count,
    round(count(*) FILTER (WHERE churned_flag = 1) / count(*) * 100, 6) AS churn_rate_pct FROM account WHERE segment IS NOT NULL GROUP BY 1"""
add("churn_by_segment", "A14", lambda t: rounded(churn.churn_by_segment(t.account)), SEGMENTS)
add("top_segments", "A14 O3", lambda t: rounded(churn.top_segments(t.account, 3)), f"SELECT * FROM ({SEGMENTS}) ORDER BY total_count DESC, segment LIMIT 3")
add(
    "churn_by_year", "A15",
    lambda t: longs(churn.churn_by_year(t.account)),
    f"WITH {CHURNED} SELECT year(churn_date)::BIGINT AS year, count(*) AS customers_churned FROM ch GROUP BY 1",
)
YEARLY = """SELECT arg_max(n, y) AS latest_year_churn, arg_min(n, y) AS earliest_year_churn, arg_max(n, y) > arg_min(n, y) AS churn_trend_increasing
    FROM (SELECT year(churn_date) AS y, count(*) AS n FROM ch GROUP BY 1)"""
add("yearly_trend", "A15 O4", lambda t: churn.yearly_trend(t.account), f"WITH {CHURNED} {YEARLY}")
RISKS = """SELECT churned_flag::BIGINT AS churned_flag, round(avg(risk_score), 4) AS avg_risk, round(stddev_samp(risk_score), 4) AS std_risk,
    count(risk_score) AS n, round(quantile_cont(risk_score, 0.5), 4) AS median_risk
    FROM account JOIN risk ON account_number = account_id WHERE risk_score IS NOT NULL GROUP BY 1"""
add("risk_by_status", "A16 J9", lambda t: longs(rounded(churn.risk_by_status(t.account, t.risk), 4)), RISKS)
add(
    "churn_distribution", "A18 A19 PL8 T6 T8",
    lambda t: rounded(churn.churn_distribution(t.account, SINCE)),
    f"""WITH {RECENT}, {MONTHLY} SELECT round(avg(customers_churned), 6) AS mean_churns_per_month, median(customers_churned)::DOUBLE AS median_churns_per_month,
        round(stddev_pop(customers_churned), 6) AS std_churns_per_month, min(customers_churned) AS min_churns_per_month, max(customers_churned) AS max_churns_per_month,
        count(*) AS total_months, sum(customers_churned)::BIGINT AS total_churned_customers,
        round(stddev_pop(customers_churned) / avg(customers_churned), 6) AS coefficient_of_variation,
        round(quantile_cont(customers_churned, 0.25), 6) AS percentile_25, round(quantile_cont(customers_churned, 0.75), 6) AS percentile_75,
        round(quantile_cont(customers_churned, 0.9), 6) AS percentile_90, round(quantile_cont(customers_churned, 0.95), 6) AS percentile_95,
        round(quantile_cont(customers_churned, 0.75) - quantile_cont(customers_churned, 0.25), 6) AS iqr,
        first(month_label ORDER BY customers_churned DESC, month_label) AS peak_churn_month, max(customers_churned) AS peak_churn_count,
        first(month_label ORDER BY customers_churned, month_label) AS lowest_churn_month, min(customers_churned) AS lowest_churn_count FROM mo""",
)
add(
    "churn_by_quarter", "A20",
    lambda t: longs(churn.churn_by_quarter(t.account, SINCE)),
    f"WITH {RECENT} SELECT year(churn_date)::BIGINT AS year, quarter(churn_date)::BIGINT AS quarter, count(*) AS customers_churned FROM ch GROUP BY 1, 2",
)
add(
    "churn_by_season", "A20",
    lambda t: shown(churn.churn_by_season(t.account, SINCE)),
    f"""WITH {RECENT} SELECT quarter(churn_date)::BIGINT AS quarter, count(*) AS total_churns,
        round(count(*) / count(DISTINCT year(churn_date)), 6) AS avg_churns FROM ch GROUP BY 1""",
)
add(
    "churn_per_year", "A21",
    lambda t: shown(churn.churn_per_year(t.account, SINCE)),
    f"""WITH {RECENT} SELECT year(churn_date)::BIGINT AS year, count(*) AS customers_churned, count(DISTINCT month(churn_date)) AS months_with_churn,
        round(count(*) / count(DISTINCT month(churn_date)), 6) AS avg_monthly_churn FROM ch GROUP BY 1""",
)
add(
    "churn_by_month_of_year", "A22 D15",
    lambda t: shown(churn.churn_by_month_of_year(t.account, SINCE)),
    f"""WITH {RECENT} SELECT month(churn_date)::BIGINT AS month, monthname(churn_date) AS month_name, count(*) AS total_churns,
        round(count(*) / count(DISTINCT year(churn_date)), 6) AS avg_churns FROM ch GROUP BY 1, 2""",
)
GRID = ", ".join(f"count(*) FILTER (WHERE month(churn_date) = {m}) AS m{m:02d}" for m in range(1, 13))
add(
    "churn_year_month_grid", "A39",
    lambda t: longs(churn.churn_year_month_grid(t.account, SINCE)),
    f"WITH {RECENT} SELECT year(churn_date)::BIGINT AS year, {GRID} FROM ch GROUP BY 1",
)


def top_columns(n: int, fields: dict[str, str]) -> str:
    return ", ".join(f"max({src}) FILTER (WHERE rk = {i}) AS segment_{i}_{name}" for i in range(1, n + 1) for name, src in fields.items())


add(
    "churn_summary", "PL7 A11 A12 A13 A14 A15 A16",
    lambda t: rounded(churn.churn_summary(t.account, t.first_week, t.risk, 3), 4),
    f"""WITH {CHURNED}, {MONTHLY}, {FILLED}, {SPAN},
        top AS (SELECT *, row_number() OVER (ORDER BY total_count DESC, segment) AS rk FROM ({SEGMENTS}))
        SELECT * REPLACE (round(churn_rate_pct, 4) AS churn_rate_pct) FROM
        (SELECT count(*) AS total_customers, count(*) FILTER (WHERE churned_flag = 1) AS churned_customers, count(*) FILTER (WHERE churned_flag = 0) AS active_customers,
            count(*) FILTER (WHERE churned_flag = 1) / count(*) * 100 AS churn_rate_pct FROM account),
        (SELECT COLUMNS(*)::DOUBLE FROM (SELECT {MONTH_STATS.replace(', 6)', ', 4)')} FROM filled)), (SELECT {LIFE_STATS.replace(', 6)', ', 4)')} FROM span WHERE w > 0), ({YEARLY}),
        (SELECT max(avg_risk) FILTER (WHERE churned_flag = 1) AS avg_risk_score_churned, max(avg_risk) FILTER (WHERE churned_flag = 0) AS avg_risk_score_active FROM ({RISKS})),
        (SELECT {top_columns(3, {'name': 'segment', 'churn_rate_pct': 'round(churn_rate_pct, 4)', 'total_customers': 'total_count'})} FROM top)""",
)
