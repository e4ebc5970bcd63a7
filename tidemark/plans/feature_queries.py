"""Weekly features, static features, rollups, training and live tables, splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import activity, features, split
from tidemark.operators.merge import STANDARD_METRICS, merge_sources
from tidemark.operators.relational import active_only, churned_only
from tidemark.plans.expression_queries import monday_sql
from tidemark.plans.inputs import START, Inputs, week_sql
from tidemark.plans.join_queries import MERGED
from tidemark.plans.registry import add, longs, rounded, shown
from tidemark.plans.runs import live_load, training_load

AS_OF = "2002-01-01"
MONEY = ("amount_due", "functional_amount")
WEEKLY = f"""ts AS (SELECT account_id, coalesce(yyyywk, {week_sql('month')}) AS yyyywk, month, documents_opened, storage_mb, revline_total,
        amount_due, functional_amount FROM merged),
    feats AS (SELECT * EXCLUDE (month) FROM ts WHERE yyyywk >= 199601
        QUALIFY row_number() OVER (PARTITION BY account_id, yyyywk ORDER BY month NULLS LAST) = 1)"""
GUARD = """guarded AS (SELECT f.* FROM feats f LEFT JOIN (SELECT account_id AS k, churned_flag, isoyear(churn_date) * 100 + weekofyear(churn_date) AS w FROM account)
        ON k = account_id WHERE NOT coalesce(churned_flag = 1, false) OR yyyywk <= w)"""
SHOW_WEEKLY = """account_id, yyyywk::BIGINT AS yyyywk, documents_opened, storage_mb, round(revline_total, 4) AS revline_total,
    round(amount_due, 2) AS amount_due, round(functional_amount, 2) AS functional_amount"""


def weekly_shown(df: DataFrame) -> DataFrame:
    return longs(df.withColumns({**{c: F.round(c, 2) for c in MONEY}, "revline_total": F.round("revline_total", 4)}))


add(
    "weekly_features", "PL5 A4 D16 P7 P8",
    lambda t: weekly_shown(features.weekly_features(merge_sources(t.bundle, START, metrics=STANDARD_METRICS), START)),
    f"WITH {MERGED}, {WEEKLY} SELECT {SHOW_WEEKLY} FROM feats",
)
add(
    "leak_guarded_weeks", "P9",
    lambda t: weekly_shown(training_load(t.bundle, START, tables=["weekly"]).weekly),
    f"WITH {MERGED}, {WEEKLY}, {GUARD} SELECT {SHOW_WEEKLY} FROM guarded",
)
STRIPPED = "array_to_string(list_sort(list_transform(string_split(regexp_replace({0}, '[0-9]+x ', '', 'g'), ','), lambda x: trim(x))), ',')"


def static_sql(fill: bool, extra: list[str], source: str) -> str:
    def first(c: str) -> str:
        return f"first({c} ORDER BY month NULLS LAST, {c}) FILTER (WHERE {c} IS NOT NULL)"

    cats = ", ".join(
        (f"coalesce(replace({first(c)}, ' ', '_'), 'UNK')" if fill else f"replace({first(c)}, ' ', '_')") + f" AS {c}"
        for c in ("business_risk", "payment_rating")
    )
    items = first("line_items")
    items = f"coalesce({items}, 'NA')" if fill else items
    others = "".join(f", round({first(c)}, 4) AS {c}" for c in extra)
    return f"SELECT account_id, round({first('risk_score')}, 4) AS risk_score, round({first('delinquency')}, 4) AS delinquency, {cats}, {STRIPPED.format(items)} AS line_items{others} FROM {source} GROUP BY 1"


STATIC = static_sql(True, ["lifespan_months", "days_to_churn"], "merged")
add(
    "static_features", "A6 F2 F4 T4 T11",
    lambda t: shown(training_load(t.bundle, START, tables=["static"]).static, 4),
    f"WITH {MERGED} {STATIC.replace('round(first(days_to_churn', 'first(days_to_churn').replace('IS NOT NULL), 4) AS days_to_churn', 'IS NOT NULL) AS days_to_churn')}",
)


def stats_sql(c: str, digits: int, with_max: bool) -> str:
    cast = "::BIGINT" if digits == 0 else ""
    total = f"coalesce(sum({c}), 0)::BIGINT" if digits == 0 else f"round(coalesce(sum({c}), 0), 2)"
    out = f"{total} AS {c}_sum, round(avg({c}), 4) AS {c}_mean, round(stddev_samp({c}), 3) AS {c}_std"
    return out + (f", max({c}){cast} AS {c}_max" if with_max else "")


ROLLUP_SQL = f"""SELECT account_id, {stats_sql('documents_opened', 0, True)}, {stats_sql('storage_mb', 0, True)},
    min(yyyywk)::BIGINT AS yyyywk_min, max(yyyywk)::BIGINT AS yyyywk_max, count(yyyywk) AS total_weeks,
    (max(yyyywk) - min(yyyywk))::BIGINT AS usage_duration_weeks,
    (date_diff('day', {monday_sql('min(yyyywk)')}, {monday_sql('max(yyyywk)')}) // 7)::BIGINT AS usage_duration_exact FROM {{0}} GROUP BY 1"""


def rollup_shown(df: DataFrame) -> DataFrame:
    means = {c: F.round(c, 4) for c in df.columns if c.endswith("_mean")}
    devs = {c: F.round(c, 3) for c in df.columns if c.endswith("_std")}
    return longs(df.withColumns({**means, **devs}))


USAGE_SPEC = {k: features.ROLLUP[k] for k in ("documents_opened", "storage_mb")}
add(
    "account_rollup", "A7 A8 D13",
    lambda t: rollup_shown(features.entity_rollup(t.weekly, USAGE_SPEC)),
    ROLLUP_SQL.format("weekly"),
)
add(
    "account_money_rollup", "A7 T3",
    lambda t: rollup_shown(
        features.entity_rollup(
            training_load(t.bundle, START, tables=["weekly"]).weekly, {k: ("sum",) for k in (*MONEY, "revline_total")}
        ).select("account_id", *[F.round(f"{k}_sum", 2 if k != "revline_total" else 4).alias(f"{k}_sum") for k in (*MONEY, "revline_total")], "total_weeks")
    ),
    f"""WITH {MERGED}, {WEEKLY}, {GUARD} SELECT account_id, round(coalesce(sum(amount_due), 0), 2) AS amount_due_sum,
        round(coalesce(sum(functional_amount), 0), 2) AS functional_amount_sum, round(coalesce(sum(revline_total), 0), 4) AS revline_total_sum,
        count(yyyywk) AS total_weeks FROM guarded GROUP BY 1""",
)
META = "meta AS (SELECT DISTINCT account_id, account_name, churned_flag::BIGINT AS churned_flag, churn_date, segment, segment_level FROM account)"
TRAINING = f"""WITH {MERGED}, {WEEKLY}, {GUARD}, st AS ({STATIC}), ro AS ({ROLLUP_SQL.format('guarded')}), {META}
    SELECT account_id, round(risk_score, 4) AS risk_score, delinquency, business_risk, payment_rating, st.line_items, round(lifespan_months, 4) AS lifespan_months, documents_opened_sum,
        documents_opened_mean, storage_mb_sum, storage_mb_max, total_weeks, usage_duration_weeks, account_name, churned_flag, churn_date, segment, segment_level
    FROM st FULL JOIN ro USING (account_id) LEFT JOIN meta USING (account_id)"""
add(
    "training_table", "A9 J6 PL1",
    lambda t: rollup_shown(training_load(t.bundle, START, tables=["table"]).table).select(
        "account_id", F.round("risk_score", 4).alias("risk_score"), F.round("delinquency", 4).alias("delinquency"), "business_risk", "payment_rating", "line_items", F.round("lifespan_months", 4).alias("lifespan_months"),
        "documents_opened_sum", "documents_opened_mean", "storage_mb_sum", "storage_mb_max", "total_weeks", "usage_duration_weeks",
        "account_name", "churned_flag", "churn_date", "segment", "segment_level",
    ),
    TRAINING,
)
FEATURES = f"""SELECT {SHOW_WEEKLY}, churned_flag::BIGINT AS churned_flag, churn_date, segment, segment_level,
    CASE WHEN churned_flag = 1 THEN date_diff('day', {monday_sql('yyyywk', 3)}, churn_date) ELSE 9999 END::BIGINT AS days_to_churn,
    round(CASE WHEN churned_flag = 1 THEN date_diff('day', {monday_sql('yyyywk', 3)}, churn_date) ELSE 9999 END / 7.0::DOUBLE, 4) AS weeks_to_churn"""
add(
    "feature_dataset", "PL6 J7 D17",
    lambda t: weekly_shown(training_load(t.bundle, START, tables=["features"]).features).withColumn("weeks_to_churn", F.round("weeks_to_churn", 4)),
    f"WITH {MERGED}, {WEEKLY}, {GUARD} SELECT DISTINCT * FROM ({FEATURES} FROM guarded LEFT JOIN account USING (account_id))",
)
LIVE_MERGED = MERGED.replace("FROM payment GROUP BY ALL", "FROM payment SEMI JOIN live ON account_id = customer_no GROUP BY ALL").replace(
    "FROM revenue GROUP BY ALL", "FROM revenue SEMI JOIN live USING (account_id) GROUP BY ALL").replace(
    "FROM txn GROUP BY ALL", "FROM txn SEMI JOIN live ON account_id = account_number GROUP BY ALL").replace(
    "line_start FROM contract_line)", "line_start FROM contract_line SEMI JOIN live USING (account_id))").replace(
    f"FROM usage WHERE contract_start >= DATE '{START}'", f"FROM usage SEMI JOIN live USING (account_id) WHERE contract_start >= DATE '{START}'")
LIVE = f"live AS (SELECT account_id FROM account WHERE churned_flag = 0), {LIVE_MERGED}"
add(
    "live_feature_dataset", "PL2 PL6 J7",
    lambda t: weekly_shown(live_load(t.bundle, START, AS_OF, tables=["features"]).features),
    f"""WITH {LIVE}, {WEEKLY} SELECT DISTINCT {SHOW_WEEKLY}, churned_flag::BIGINT AS churned_flag, segment, segment_level, final_earliest_date
        FROM feats LEFT JOIN account USING (account_id)
        LEFT JOIN (SELECT account_id, min(final_earliest_date) AS final_earliest_date FROM merged GROUP BY 1) USING (account_id)""",
)
add(
    "live_static_features", "PL2 A6 D19 T11 F4",
    lambda t: rounded(longs(live_load(t.bundle, START, AS_OF, tables=["static"]).static), 4),
    f"""WITH {LIVE}, timed AS (SELECT *, date_diff('day', final_earliest_date, DATE '{AS_OF}')::BIGINT AS days_elapsed,
        date_diff('day', final_earliest_date, DATE '{AS_OF}') / 30.0::DOUBLE AS months_elapsed FROM merged)
        {static_sql(False, ['days_elapsed', 'months_elapsed'], 'timed').replace('round(first(days_elapsed', 'first(days_elapsed').replace('IS NOT NULL), 4) AS days_elapsed', 'IS NOT NULL) AS days_elapsed')}""",
)
add(
    "live_rollup", "PL2 A7",
    lambda t: rollup_shown(live_load(t.bundle, START, AS_OF, tables=["rollup"]).rollup).select(
        "account_id", "documents_opened_sum", "documents_opened_mean", "storage_mb_max", "total_weeks", "yyyywk_min", "yyyywk_max"
    ),
    f"""WITH {LIVE}, {WEEKLY} SELECT account_id, coalesce(sum(documents_opened), 0)::BIGINT AS documents_opened_sum,
        round(avg(documents_opened), 4) AS documents_opened_mean, max(storage_mb)::BIGINT AS storage_mb_max, count(yyyywk) AS total_weeks,
        min(yyyywk)::BIGINT AS yyyywk_min, max(yyyywk)::BIGINT AS yyyywk_max FROM feats GROUP BY 1""",
)

# --- splitting --------------------------------------------------------------------------------

LIFETIME = "lifetime AS (SELECT o_orderkey AS account_id, o_custkey, date_diff('day', o_orderdate, DATE '1999-06-01')::BIGINT AS days_to_churn FROM ord)"
CLASS = """CASE WHEN days_to_churn <= 0 THEN NULL WHEN days_to_churn <= 365 THEN 1 WHEN days_to_churn <= 730 THEN 2
    WHEN days_to_churn <= 1095 THEN 3 WHEN days_to_churn <= 1460 THEN 4 ELSE 5 END"""
BINNED = f"{LIFETIME}, binned AS (SELECT *, {CLASS} AS sample_class FROM lifetime WHERE {CLASS} IS NOT NULL)"


def lifetimes(t: Inputs) -> DataFrame:
    """One row per order with the days left to a fixed day; the order stands in for the account."""
    left = F.datediff(F.lit("1999-06-01").cast("date"), "o_orderdate").cast("bigint")
    return t.orders.select(F.col("o_orderkey").alias("account_id"), "o_custkey", left.alias("days_to_churn"))


add(
    "binned_target", "M1",
    lambda t: longs(split.bin_target(lifetimes(t), "days_to_churn")),
    f"WITH {BINNED} SELECT * REPLACE (sample_class::BIGINT AS sample_class) FROM binned",
)
add(
    "top_class_dropped", "M2",
    lambda t: longs(split.drop_top_class(split.bin_target(lifetimes(t), "days_to_churn")).groupBy("sample_class").agg(F.count(F.lit(1)).alias("n"))),
    f"WITH {BINNED} SELECT sample_class::BIGINT AS sample_class, count(*) AS n FROM binned WHERE sample_class <> (SELECT max(sample_class) FROM binned) GROUP BY 1",
)


SMALL_BINS = (1, 365, 730, 1095)


def small_classes(t: Inputs) -> DataFrame:
    """Classes of which the first spans one day only and may be too small to stand."""
    ready, _ = split.prepared(lifetimes(t), "days_to_churn", SMALL_BINS, 50, True, True)
    return longs(ready.groupBy("sample_class", "no_of_renewals").agg(F.count(F.lit(1)).alias("n")))


add(
    "small_classes_merged", "M3 M4",
    small_classes,
    f"""WITH {LIFETIME}, c AS (SELECT CASE WHEN days_to_churn <= 1 THEN 1 WHEN days_to_churn <= 365 THEN 2 WHEN days_to_churn <= 730 THEN 3 ELSE 4 END AS c
            FROM lifetime WHERE days_to_churn BETWEEN 1 AND 1095),
        m AS (SELECT CASE WHEN c = 1 AND (SELECT count(*) FROM c WHERE c = 1) < 50 THEN 2 ELSE c END AS c FROM c)
        SELECT c::BIGINT AS sample_class, (c - 1)::BIGINT AS no_of_renewals, count(*) AS n FROM m GROUP BY 1, 2""",
)


def split_counts(t: Inputs) -> DataFrame:
    _, _, report = split.stratified_split(lifetimes(t), "days_to_churn")
    return longs(rounded(report))


add(
    "stratified_split", "M4 M5 M6 A45 O5",
    lambda t: split_counts(t).drop("target_min", "target_max"),
    f"""WITH {BINNED}, n AS (SELECT sample_class, count(*) AS n FROM binned WHERE sample_class < (SELECT max(sample_class) FROM binned) GROUP BY 1),
        k AS (SELECT sample_class, 'test' AS split, CAST(round_even(n * 0.2, 0) AS BIGINT) AS n FROM n
              UNION ALL SELECT sample_class, 'train', n - CAST(round_even(n * 0.2, 0) AS BIGINT) FROM n)
        SELECT split, sample_class::BIGINT AS sample_class, n, round(n / sum(n) OVER (PARTITION BY split), 6) AS proportion FROM k""",
)
add(
    "class_statistics", "A43",
    lambda t: longs(rounded(split.class_statistics(split.bin_target(lifetimes(t), "days_to_churn"), "days_to_churn"), 4)),
    f"""WITH {BINNED} SELECT sample_class::BIGINT AS sample_class, round(avg(days_to_churn), 4) AS mean_target, median(days_to_churn) AS median_target,
        round(stddev_samp(days_to_churn), 4) AS std_target, min(days_to_churn) AS min_target, max(days_to_churn) AS max_target, count(*) AS n
        FROM binned GROUP BY 1""",
)
add(
    "class_proportions", "A45",
    lambda t: rounded(activity.class_proportions(t.account, "churned_flag", "segment").withColumn("churned_flag", F.col("churned_flag").cast("bigint"))),
    """SELECT churned_flag::BIGINT AS churned_flag, segment, n, round(n / sum(n) OVER (PARTITION BY churned_flag), 6) AS proportion
        FROM (SELECT churned_flag, segment, count(*) AS n FROM account GROUP BY 1, 2)""",
)
