"""Projections, filters, joins, deduplication, sorting, set operations and the merge of sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import jaro_winkler
from tidemark.functions.weeks import date_to_week
from tidemark.operators import match, merge
from tidemark.operators import relational as R
from tidemark.operators.activity import weekly_activity
from tidemark.operators.scale import fan_out_join
from tidemark.plans.inputs import START, Inputs, week_sql
from tidemark.plans.registry import add, longs, rounded, shown

add(
    "weekly_order_activity", "D6 A24 A26",
    lambda t: shown(weekly_activity(orders_weekly(t), ["orders", "amount"]), 2),
    f"""SELECT {week_sql('o_orderdate')}::BIGINT AS yyyywk, count(*) AS orders, round(sum(o_totalprice), 2) AS amount,
        count(DISTINCT CASE WHEN churned_flag = 0 THEN account_id END) AS active_customers
        FROM ord JOIN account ON account_id = o_custkey GROUP BY 1""",
)


def orders_weekly(t: Inputs) -> DataFrame:
    """Orders per account and week with the churn flag."""
    per = t.orders.groupBy(F.col("o_custkey").alias("account_id"), date_to_week("o_orderdate").alias("yyyywk")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("o_totalprice").alias("amount")
    )
    return per.join(t.account.select("account_id", "churned_flag"), "account_id")


# --- projections and filters ---------------------------------------------------------------

add(
    "column_choices", "P1 P2 P3 P12 P14",
    lambda t: R.stamp(
        R.rename(R.drop_existing(R.select_existing(t.txn, ["account_number", "trx_date", "amount_due", "absent"]), ["absent", "trx_date"]), {"account_number": "account_id"}),
        "test", F.lit("2002-01-01").cast("timestamp"),
    ),
    "SELECT account_number AS account_id, amount_due, TIMESTAMP '2002-01-01' AS created_at, 'test' AS environment FROM txn",
)
add(
    "numeric_columns", "P12 A1",
    lambda t: rounded(
        t.raw("supplier").agg(*[F.sum(c).cast("double").alias(c) for c in R.metric_columns(t.raw("supplier"), ["s_acctbal"], ("s_suppkey",))]), 2
    ),
    "SELECT round(sum(s_acctbal), 2) AS s_acctbal, sum(s_nationkey)::DOUBLE AS s_nationkey FROM supplier",
)
add(
    "all_metric_columns", "P1",
    lambda t: rounded(
        t.raw("lineitem").join(t.raw("part"), F.col("l_partkey") == F.col("p_partkey")).join(t.raw("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).transform(
            lambda df: df.agg(*[F.sum(c).cast("double").alias(c) for c in R.metric_columns(df, ["l_tax"], ("l_partkey", "l_suppkey"))])
        ), 1
    ),
    f"""SELECT {", ".join(f"round(sum({c})::DOUBLE, 1) AS {c}" for c in ("l_tax", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "p_partkey", "p_size", "p_retailprice", "s_suppkey", "s_nationkey", "s_acctbal"))}
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""",
)
add(
    "date_and_week_floors", "P4 P7",
    lambda t: longs(
        R.since_week(R.since_year(R.since_first_date(R.since(t.usage, "contract_start", START), ["absent", "period"], "1997-01-15"), 1997), "1997-06-30")
        .select("account_id", "contract_number", "period", "yyyywk")
    ),
    """SELECT account_id, contract_number, period, yyyywk::BIGINT AS yyyywk FROM usage
        WHERE contract_start >= DATE '1996-01-01' AND period >= DATE '1997-01-15' AND yyyywk >= 199701 AND yyyywk >= 199727""",
)
add(
    "flag_filters", "P5",
    lambda t: t.account.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(R.is_churned()).alias("churned"),
        F.count_if(R.is_active()).alias("active"),
        F.count_if(R.is_not_churned()).alias("not_churned"),
    ),
    """SELECT count(*) AS total, count(*) FILTER (WHERE churned_flag = 1) AS churned, count(*) FILTER (WHERE churned_flag = 0) AS active,
        count(*) FILTER (WHERE churned_flag <> 1) AS not_churned FROM account""",
)
add(
    "key_membership", "P6",
    lambda t: R.members_of(t.txn, R.churned_only(t.account), "account_number", "account_id"),
    "SELECT * FROM txn WHERE account_number IN (SELECT account_id FROM account WHERE churned_flag = 1)",
)
add(
    "metric_filters", "P8 P10 P11",
    lambda t: longs(
        R.below_sentinel(R.any_present(R.positive(R.non_negative(R.with_week(t.weekly), "storage_mb"), "documents_opened"), ["documents_opened", "storage_mb"]), "documents_opened", 100)
        .select("account_id", "yyyywk", "documents_opened", "storage_mb")
    ),
    """SELECT account_id, yyyywk::BIGINT AS yyyywk, documents_opened, storage_mb FROM weekly
        WHERE storage_mb >= 0 AND documents_opened > 0 AND documents_opened < 100""",
)
add(
    "entity_sample", "P13",
    lambda t: R.sample_entities(t.txn, "account_number", 50),
    """SELECT * FROM txn WHERE account_number IN
        (SELECT account_number FROM (SELECT DISTINCT account_number FROM txn) ORDER BY md5('42:' || account_number), account_number LIMIT 50)""",
)

# --- joins -----------------------------------------------------------------------------------

add(
    "known_payments", "J1",
    lambda t: R.keep_known(t.payment, "customer_no", R.active_only(t.account)),
    "SELECT customer_no AS account_id, receipt_date, entered_amount, functional_amount, receipt_id FROM payment JOIN account ON customer_no = account_id WHERE churned_flag = 0",
)
add(
    "known_revenue", "J2",
    lambda t: rounded(R.keep_known(t.revenue, "account_id", R.churned_only(t.account)), 4),
    "SELECT r.account_id, invoice_date, invoice_number, round(revline_total, 4) AS revline_total FROM revenue r JOIN account a USING (account_id) WHERE churned_flag = 1",
)
SUMMED = """p AS (SELECT customer_no AS account_id, receipt_date AS month, receipt_date, sum(functional_amount) AS functional_amount FROM payment GROUP BY ALL),
    r AS (SELECT account_id, invoice_date AS month, invoice_date, sum(revline_total) AS revline_total FROM revenue GROUP BY ALL),
    x AS (SELECT account_number AS account_id, trx_date AS month, trx_date, sum(amount_due) AS amount_due FROM txn GROUP BY ALL)"""
TIMELINE = """SELECT account_id, month, receipt_date, functional_amount, invoice_date, revline_total, trx_date, amount_due
    FROM p FULL JOIN r USING (account_id, month) FULL JOIN x USING (account_id, month)"""
add(
    "financial_timeline", "J3 A1",
    lambda t: merge.financial_timeline(t.bundle).withColumns(
        {c: F.round(c, d) for c, d in (("functional_amount", 2), ("revline_total", 4), ("amount_due", 2))}
    ),
    f"""WITH {SUMMED} SELECT * REPLACE (round(functional_amount, 2) AS functional_amount, round(revline_total, 4) AS revline_total,
        round(amount_due, 2) AS amount_due) FROM ({TIMELINE})""",
)
add(
    "contract_alignment", "J4 D21",
    lambda t: rounded(
        R.full_outer_coalesce(
            merge.dated_sums(t.txn, t.account, "account_number", "trx_date", ["amount_due"]),
            t.contract_line.select("account_id", "line_start", "line_status"), "account_id", "month", "line_start",
        ), 2
    ),
    f"""WITH {SUMMED} SELECT coalesce(x.account_id, c.account_id) AS account_id, trx_date, round(amount_due, 2) AS amount_due, line_start, line_status,
        coalesce(month, line_start) AS month FROM x FULL JOIN contract_line c ON x.account_id = c.account_id AND month = line_start""",
)
add(
    "renewal_fan_out", "J5 W2",
    lambda t: longs(
        fan_out_join(
            t.account.select("account_id", "segment"),
            merge.with_bounds(R.keep_known(t.renewal.distinct(), "bill_to", t.account), "account_id", "coverage_start", "coverage_end", "renewal"),
            "account_id",
        )
    ),
    """WITH w AS (SELECT *, min(coverage_start) OVER (PARTITION BY bill_to) AS renewal_earliest, max(coverage_end) OVER (PARTITION BY bill_to) AS renewal_latest
            FROM (SELECT DISTINCT * FROM renewal))
        SELECT account_id, segment, coverage_start, coverage_end, renewal_earliest, renewal_latest FROM account LEFT JOIN w ON bill_to = account_id""",
)
add(
    "contract_bounds", "W2",
    lambda t: merge.with_bounds(t.contract_line, "account_id", "line_start", "line_end", "sub"),
    """SELECT *, min(line_start) OVER (PARTITION BY account_id) AS sub_earliest, max(line_end) OVER (PARTITION BY account_id) AS sub_latest FROM contract_line""",
)
add(
    "earliest_activity", "W3 D20",
    lambda t: R.left_join(
        t.account.select("account_id", "registered_on"),
        t.contract_line.groupBy("account_id").agg(F.min("line_start").alias("first_contract")), "account_id",
    ).withColumn("earliest", F.least("registered_on", "first_contract")),
    """SELECT account_id, registered_on, first_contract, least(registered_on, first_contract) AS earliest FROM account
        LEFT JOIN (SELECT account_id, min(line_start) AS first_contract FROM contract_line GROUP BY 1) USING (account_id)""",
)
add(
    "first_week_with_account", "J8 J11",
    lambda t: longs(R.left_join(R.churned_only(t.account).select("account_id", "churn_date"), t.first_week, "account_id")),
    "SELECT account_id, churn_date, yyyywk::BIGINT AS yyyywk FROM account LEFT JOIN first_week USING (account_id) WHERE churned_flag = 1",
)
add(
    "risk_joined", "J9",
    lambda t: longs(R.left_join(t.account.select("account_id", "churned_flag"), t.risk.withColumnRenamed("account_number", "account_id"), "account_id")),
    "SELECT account_id, churned_flag::BIGINT AS churned_flag, risk_score, delinquency, business_risk, payment_rating FROM account LEFT JOIN risk ON account_number = account_id",
)
add(
    "prefixed_join", "J14",
    lambda t: longs(R.prefix_columns(t.raw("supplier").withColumnRenamed("s_nationkey", "k"), "supplier_", ["k"]).join(
        R.prefix_columns(t.raw("nation").withColumnRenamed("n_nationkey", "k"), "nation_", ["k"]), "k"
    )),
    """SELECT n_nationkey::BIGINT AS k, s_suppkey AS supplier_s_suppkey, s_name AS supplier_s_name, s_acctbal AS supplier_s_acctbal,
        n_name AS nation_n_name, n_regionkey::BIGINT AS nation_n_regionkey FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
add(
    "fuzzy_pairs", "J10 F5",
    lambda t: longs(
        match.fuzzy_pairs(
            t.named_accounts.select(F.col("account_name").alias("l_name")).distinct(),
            t.named_usage.select(F.col("usage_name").alias("r_name")).distinct(),
        )
    ),
    """SELECT * FROM (SELECT l_name, r_name, CAST(floor(jaro_winkler_similarity(lower(l_name), lower(r_name)) * 100 + 1e-9) AS BIGINT) AS score
        FROM (SELECT DISTINCT account_name AS l_name FROM named_accounts)
        CROSS JOIN (SELECT DISTINCT usage_name AS r_name FROM named_usage)) WHERE score >= 93""",
)
add(
    "best_scores_with_ties", "W1",
    lambda t: longs(
        match.rank_best(
            t.orders.select("o_custkey", "o_orderkey", (F.floor(F.col("o_totalprice") / 50000)).cast("bigint").alias("score")), "o_custkey", "score"
        )
    ),
    """SELECT *, 1::BIGINT AS match_rank FROM (SELECT o_custkey, o_orderkey, CAST(floor(o_totalprice / 50000) AS BIGINT) AS score FROM orders)
        QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY score DESC) = 1""",
)

# --- aggregation and dedupe -----------------------------------------------------------------

add(
    "sums_by_key_and_date", "A1 T1 T3",
    lambda t: shown(merge.sum_by_key_date(t.payment, "customer_no", "receipt_date"), 2),
    """SELECT customer_no, receipt_date, round(sum(entered_amount), 2) AS entered_amount, round(sum(functional_amount), 2) AS functional_amount,
        sum(receipt_id)::BIGINT AS receipt_id FROM payment GROUP BY 1, 2""",
)
add(
    "counts_by_key_and_date", "A1",
    lambda t: merge.sum_by_key_date(t.payment.select("customer_no", "receipt_date"), "customer_no", "receipt_date"),
    "SELECT customer_no, receipt_date, count(*) AS count FROM payment GROUP BY 1, 2",
)
add(
    "distinct_rows", "A2 A3",
    lambda t: longs(R.distinct_rows(t.usage.select("account_id", "yyyywk", "documents_opened"))),
    "SELECT DISTINCT account_id, yyyywk::BIGINT AS yyyywk, documents_opened FROM usage",
)
add(
    "first_per_account_week", "A4",
    lambda t: longs(
        R.dedupe_keep_first(t.usage.select("account_id", "yyyywk", "contract_number", "period", "documents_opened"), ["account_id", "yyyywk"], [F.col("period"), F.col("contract_number")])
    ),
    """SELECT account_id, yyyywk::BIGINT AS yyyywk, contract_number, period, documents_opened FROM usage
        QUALIFY row_number() OVER (PARTITION BY account_id, yyyywk ORDER BY period, contract_number, documents_opened NULLS LAST) = 1""",
)
DEDUPED = ["contract_number", "contract_start", "documents_opened", "storage_mb", "line_items"]
CANONICAL = "array_to_string(list_sort(list_transform(string_split(coalesce(line_items, ''), ','), lambda x: trim(x))), ',')"
RECENT = f"recent AS (SELECT * REPLACE ({CANONICAL} AS line_items) FROM usage WHERE contract_start >= DATE '{START}')"
MOST_COMPLETE = ", ".join(
    f"first({c} ORDER BY length(line_items) DESC, line_items, {c}) FILTER (WHERE {c} IS NOT NULL) AS {c}"
    for c in ["contract_number", "contract_start", "contract_end", "period", "documents_opened", "storage_mb", "line_items", "churn_date"]
)
CLEAN = f"clean AS (SELECT account_id, yyyywk, {MOST_COMPLETE} FROM recent GROUP BY 1, 2)"
add(
    "cleaned_usage", "PL3 A5 T4 T5",
    lambda t: longs(merge.clean_usage(t.usage, START)),
    f"WITH {RECENT}, {CLEAN} SELECT * REPLACE (yyyywk::BIGINT AS yyyywk) FROM clean",
)
add(
    "cleaned_usage_whole_rows", "A5",
    lambda t: longs(merge.clean_usage(t.usage, START, mode="row").select("account_id", "yyyywk", "line_items", "contract_number")),
    f"""WITH {RECENT} SELECT account_id, yyyywk::BIGINT AS yyyywk, line_items, contract_number FROM recent
        QUALIFY row_number() OVER (PARTITION BY account_id, yyyywk ORDER BY length(line_items) DESC, line_items, contract_number) = 1""",
)

# --- merge ----------------------------------------------------------------------------------------

MERGE_PARTS = f"""{SUMMED}, t AS ({TIMELINE}),
    l AS (SELECT DISTINCT account_id, line_start FROM contract_line),
    c AS (SELECT coalesce(t.account_id, l.account_id) AS account_id, coalesce(month, line_start) AS month, receipt_date, functional_amount,
          invoice_date, revline_total, trx_date, amount_due, line_start FROM t FULL JOIN l ON t.account_id = l.account_id AND t.month = l.line_start),
    {RECENT}, {CLEAN},
    u AS (SELECT *, CAST(date_trunc('week', make_date(yyyywk // 100, 1, 4)) AS DATE) + CAST((yyyywk % 100 - 1) * 7 + 2 AS INTEGER) AS usage_month FROM clean)"""
BOUNDS = """v AS (SELECT bill_to, min(coverage_start) AS coverage_start, min(coverage_start) AS renewal_earliest, max(coverage_end) AS renewal_latest
    FROM renewal GROUP BY 1)"""
ROWS = """v AS (SELECT bill_to, coverage_start, min(coverage_start) OVER (PARTITION BY bill_to) AS renewal_earliest,
    max(coverage_end) OVER (PARTITION BY bill_to) AS renewal_latest FROM (SELECT DISTINCT * FROM renewal))"""
JOINED = """j AS (SELECT c.*, coverage_start, renewal_earliest, renewal_latest, risk_score, delinquency, business_risk, payment_rating
        FROM c LEFT JOIN v ON bill_to = c.account_id LEFT JOIN risk k ON k.account_number = c.account_id),
    m AS (SELECT coalesce(j.account_id, u.account_id) AS account_id, coalesce(j.month, usage_month) AS month, receipt_date, functional_amount,
          invoice_date, revline_total, trx_date, amount_due, line_start, coverage_start, renewal_earliest, renewal_latest, risk_score, delinquency,
          business_risk, payment_rating, yyyywk, contract_start, period, documents_opened, storage_mb, line_items, churn_date, usage_month
          FROM j FULL JOIN u ON j.account_id = u.account_id AND j.month = u.usage_month),
    e AS (SELECT *, min(least(receipt_date, invoice_date, trx_date, line_start, coverage_start)) OVER (PARTITION BY account_id) AS final_earliest_date FROM m),
    merged AS (SELECT DISTINCT *, date_diff('day', final_earliest_date, churn_date) / 30.0::DOUBLE AS lifespan_months,
          date_diff('day', final_earliest_date, churn_date)::BIGINT AS days_to_churn FROM e)"""
MERGED = f"{MERGE_PARTS}, {BOUNDS}, {JOINED}"
MERGED_ROWS = f"{MERGE_PARTS}, {ROWS}, {JOINED}"
MERGED_OUT = """SELECT * REPLACE (round(functional_amount, 2) AS functional_amount, round(revline_total, 4) AS revline_total,
    round(amount_due, 2) AS amount_due, round(lifespan_months, 2) AS lifespan_months, yyyywk::BIGINT AS yyyywk) FROM merged"""


def merged_shown(df: DataFrame) -> DataFrame:
    return longs(df.withColumns({c: F.round(c, 2) for c in ("functional_amount", "amount_due", "lifespan_months")})).withColumn(
        "revline_total", F.round("revline_total", 4)
    )


add("merged_sources", "PL4 J1 J2 J3 J4 J5 W2 T2", lambda t: merged_shown(merge.merge_sources(t.bundle, START, metrics=merge.STANDARD_METRICS, written=True)), f"WITH {MERGED} {MERGED_OUT}")
add(
    "merged_sources_all_metrics", "PL4 A1",
    lambda t: longs(
        merge.merge_sources(t.bundle, START).where(F.coalesce("receipt_date", "invoice_date", "trx_date").isNotNull()).select(
            "account_id", "month", F.round("entered_amount", 2).alias("entered_amount"), F.round("functional_amount", 2).alias("functional_amount"),
            "receipt_id", "invoice_number", F.round("revline_total", 4).alias("revline_total"), F.round("amount_due", 2).alias("amount_due"), "txn_id",
        )
    ),
    """WITH p AS (SELECT customer_no AS account_id, receipt_date AS month, sum(entered_amount) AS entered_amount, sum(functional_amount) AS functional_amount,
            sum(receipt_id)::BIGINT AS receipt_id FROM (SELECT DISTINCT * FROM payment) GROUP BY 1, 2),
        r AS (SELECT account_id, invoice_date AS month, sum(invoice_number)::BIGINT AS invoice_number, sum(revline_total) AS revline_total
            FROM (SELECT DISTINCT * FROM revenue) GROUP BY 1, 2),
        x AS (SELECT account_number AS account_id, trx_date AS month, sum(amount_due) AS amount_due, sum(txn_id)::BIGINT AS txn_id
            FROM (SELECT DISTINCT * FROM txn) GROUP BY 1, 2)
        SELECT account_id, month, round(entered_amount, 2) AS entered_amount, round(functional_amount, 2) AS functional_amount, receipt_id, invoice_number,
            round(revline_total, 4) AS revline_total, round(amount_due, 2) AS amount_due, txn_id
        FROM p FULL JOIN r USING (account_id, month) FULL JOIN x USING (account_id, month)""",
)
add(
    "merged_sources_every_renewal", "PL4 J5 T12",
    lambda t: longs(
        merge.merge_sources(t.bundle, START, renewals="rows", metrics=merge.STANDARD_METRICS).groupBy("account_id").agg(
            F.count(F.lit(1)).alias("rows"), F.count_distinct("coverage_start").alias("renewals"), F.min("final_earliest_date").alias("earliest")
        )
    ),
    f"""WITH {MERGED_ROWS} SELECT account_id, count(*) AS rows, count(DISTINCT coverage_start) AS renewals, min(final_earliest_date) AS earliest
        FROM merged GROUP BY 1""",
)

# --- sorting and sets -------------------------------------------------------------------------------

add(
    "mixed_sort", "O1 O2",
    lambda t: longs(R.sort_rows(t.first_week.withColumnRenamed("yyyywk", "first"), ("account_id", True), ("first", False))),
    "SELECT account_id, yyyywk::BIGINT AS first FROM first_week ORDER BY account_id, first DESC",
)
add(
    "largest_orders", "O3",
    lambda t: R.largest(t.txn, "amount_due", 100, "txn_id"),
    "SELECT * FROM txn ORDER BY amount_due DESC, txn_id LIMIT 100",
)
add(
    "extreme_days", "O4 A19",
    lambda t: R.extremes(t.orders.groupBy("o_orderdate").agg(F.count(F.lit(1)).alias("n")), "o_orderdate", "n"),
    """WITH d AS (SELECT o_orderdate AS d, count(*) AS n FROM ord GROUP BY 1)
        SELECT first(d ORDER BY n DESC, d) AS max_label, max(n) AS max_value, first(d ORDER BY n, d) AS min_label, min(n) AS min_value FROM d""",
)
add(
    "appended_rows", "O5 O6",
    lambda t: R.append(t.txn.select("account_number", "amount_due"), t.txn.select("account_number", "trx_date")),
    "SELECT account_number, amount_due, NULL::DATE AS trx_date FROM txn UNION ALL SELECT account_number, NULL, trx_date FROM txn",
)
add(
    "key_sets", "O7",
    lambda t: _sets(t),
    """WITH a AS (SELECT DISTINCT customer_no AS k FROM payment), b AS (SELECT DISTINCT bill_to AS k FROM renewal)
        SELECT 'both' AS "set", count(*) AS keys FROM (SELECT k FROM a INTERSECT SELECT k FROM b)
        UNION ALL SELECT 'left only', count(*) FROM (SELECT k FROM a EXCEPT SELECT k FROM b)
        UNION ALL SELECT 'all', count(*) FROM (SELECT k FROM a UNION SELECT k FROM b)""",
)


def _sets(t: Inputs) -> DataFrame:
    a, b = t.payment.select(F.col("customer_no").alias("k")), t.renewal.select(F.col("bill_to").alias("k"))

    def size(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("keys")).select(F.lit(name).alias("set"), "keys")

    return size("both", R.common_keys(a, b, "k")).union(size("left only", R.missing_keys(a, b, "k"))).union(size("all", R.all_keys(a, b, "k")))
