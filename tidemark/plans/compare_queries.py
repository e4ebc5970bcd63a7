"""Training data against live data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import compare as N
from tidemark.plans.inputs import Inputs
from tidemark.plans.registry import add, longs, rounded, shown

FLAGGED = """w AS (SELECT weekly.*, CASE WHEN k.account_id IS NULL THEN 1 ELSE 0 END AS new_data FROM weekly LEFT JOIN train_keys k ON k.account_id = weekly.account_id),
    m AS (SELECT account.*, CASE WHEN k.account_id IS NULL THEN 1 ELSE 0 END AS new_data FROM account LEFT JOIN train_keys k ON k.account_id = account.account_id)"""


def flagged(t: Inputs) -> dict[str, DataFrame]:
    return {"weekly": N.flag_new(t.weekly, t.train_keys), "metadata": N.flag_new(t.account, t.train_keys)}


def with_unflagged(t: Inputs) -> dict[str, DataFrame]:
    return {**flagged(t), "risk": t.risk.withColumnRenamed("account_number", "account_id")}


add(
    "new_data_flag", "J13",
    lambda t: longs(flagged(t)["metadata"].select("account_id", "segment", "new_data")),
    f"WITH {FLAGGED} SELECT account_id, segment, new_data::BIGINT AS new_data FROM m",
)
add(
    "key_overlap", "J12 V16",
    lambda t: rounded(N.key_overlap(t.train_keys, t.renewal.withColumnRenamed("bill_to", "account_id"))),
    """WITH v AS (SELECT DISTINCT bill_to AS account_id FROM renewal), j AS (SELECT k.account_id AS a, v.account_id AS b FROM train_keys k FULL JOIN v ON k.account_id = v.account_id)
        SELECT count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) AS common, count(*) FILTER (WHERE b IS NULL) AS only_train,
        count(*) FILTER (WHERE a IS NULL) AS only_live, round(count(*) FILTER (WHERE a IS NULL) / count(b) * 100, 6) AS new_rate_pct FROM j""",
)


def dataset_sql(name: str, table: str) -> str:
    return f"""SELECT '{name}' AS dataset_name, true AS has_new_flag, count(*) AS total_records, count(*) FILTER (WHERE new_data = 0) AS train_records,
        count(*) FILTER (WHERE new_data = 1) AS new_records, count(DISTINCT account_id) AS unique_customers,
        count(DISTINCT account_id) FILTER (WHERE new_data = 0) AS train_customers, count(DISTINCT account_id) FILTER (WHERE new_data = 1) AS new_customers,
        round(count(*) FILTER (WHERE new_data = 0) * 100 / count(*), 6) AS train_pct, round(count(*) FILTER (WHERE new_data = 1) * 100 / count(*), 6) AS new_pct,
        round(count(DISTINCT account_id) FILTER (WHERE new_data = 0) * 100 / count(DISTINCT account_id), 6) AS train_customers_pct,
        round(count(DISTINCT account_id) FILTER (WHERE new_data = 1) * 100 / count(DISTINCT account_id), 6) AS new_customers_pct FROM {table}"""


COMPARED = f"""cmp AS ({dataset_sql('weekly', 'w')} UNION ALL {dataset_sql('metadata', 'm')} UNION ALL
    SELECT 'risk', false, count(*), 0, 0, count(DISTINCT account_number), 0, 0, 0, 0, 0, 0 FROM risk)"""
add(
    "datasets_compared", "N1",
    lambda t: longs(N.compare_datasets(with_unflagged(t), digits=6)),
    f"WITH {FLAGGED}, {COMPARED} SELECT * FROM cmp",
)
OVERALL = """SELECT count(*) AS total_datasets, count(*) FILTER (WHERE has_new_flag) AS datasets_with_flag, sum(total_records)::BIGINT AS total_records,
    sum(train_records)::BIGINT AS total_train_records, sum(new_records)::BIGINT AS total_new_records,
    round(sum(train_records) * 100 / sum(total_records), 6) AS overall_train_pct, round(sum(new_records) * 100 / sum(total_records), 6) AS overall_new_pct FROM cmp"""
add("overall_comparison", "N2", lambda t: N.overall_summary(N.compare_datasets(with_unflagged(t)), digits=6), f"WITH {FLAGGED}, {COMPARED} {OVERALL}")


def by_sql(group: str, table: str) -> str:
    return f"""SELECT {group}, sum(new_data)::BIGINT AS new_count, count(*) AS total_count, round(sum(new_data) / count(*), 6) AS new_ratio,
        count(DISTINCT account_id) AS unique_customers, (count(*) - sum(new_data))::BIGINT AS train_count,
        round(round(sum(new_data) / count(*), 6) * 100, 6) AS new_pct, round(100 - round(sum(new_data) / count(*), 6) * 100, 6) AS train_pct
        FROM {table} WHERE {group} IS NOT NULL GROUP BY 1"""


add("segments_compared", "N3", lambda t: longs(N.compare_by(flagged(t)["metadata"], "segment", digits=6)), f"WITH {FLAGGED} {by_sql('segment', 'm')}")
add(
    "recent_weeks_compared", "N4 W9",
    lambda t: longs(N.recent_weeks(flagged(t)["weekly"], 12, digits=6)),
    f"WITH {FLAGGED} SELECT * REPLACE (yyyywk::BIGINT AS yyyywk) FROM ({by_sql('yyyywk', 'w')}) ORDER BY yyyywk DESC LIMIT 12",
)
add(
    "comparison_insights", "N5 O4",
    lambda t: rounded(N.insights(N.compare_datasets(flagged(t), digits=6))),
    f"""WITH {FLAGGED}, {COMPARED}, c AS (SELECT * FROM cmp WHERE has_new_flag)
        SELECT 'most new data' AS insight, first(dataset_name ORDER BY new_pct DESC, dataset_name) AS dataset, max(new_pct)::DOUBLE AS value FROM c
        UNION ALL SELECT 'largest dataset', first(dataset_name ORDER BY total_records DESC, dataset_name), max(total_records)::DOUBLE FROM c""",
)
add(
    "comparison_alerts", "N6",
    lambda t: rounded(N.alerts(N.compare_datasets(with_unflagged(t)), threshold=5.0), 2),
    f"""WITH {FLAGGED}, {COMPARED}, o AS ({OVERALL}) SELECT 'high_new_data' AS alert, round(overall_new_pct, 2) AS value FROM o WHERE overall_new_pct > 5
        UNION ALL SELECT 'missing_flag', count(*)::DOUBLE FROM cmp WHERE NOT has_new_flag HAVING count(*) > 0""",
)
add(
    "flag_validity", "N7",
    lambda t: N.flag_validity(flagged(t)),
    f"""WITH {FLAGGED} SELECT 'weekly' AS dataset_name, count(*) AS total, count(*) FILTER (WHERE new_data NOT IN (0, 1)) AS invalid FROM w
        UNION ALL SELECT 'metadata', count(*), count(*) FILTER (WHERE new_data NOT IN (0, 1)) FROM m""",
)


def conflicting(t: Inputs) -> dict[str, DataFrame]:
    """Two datasets flagged against different training sets, so that some accounts disagree."""
    other = t.renewal.select(F.col("bill_to").alias("account_id")).distinct()
    return {"weekly": N.flag_new(t.weekly, t.train_keys), "metadata": N.flag_new(t.account, other)}


CONFLICT = f"""{FLAGGED}, m2 AS (SELECT account_id, CASE WHEN account_id IN (SELECT bill_to FROM renewal) THEN 0 ELSE 1 END AS new_data FROM account),
    b AS (SELECT account_id, min(new_data) AS lo, max(new_data) AS hi FROM (SELECT account_id, new_data FROM w UNION ALL SELECT * FROM m2) GROUP BY 1)"""
add("flag_conflicts", "N7", lambda t: N.inconsistent_accounts(conflicting(t)), f"WITH {CONFLICT} SELECT account_id FROM b WHERE lo <> hi")
add(
    "account_overlap", "N11 O7",
    lambda t: N.account_overlap(conflicting(t)),
    f"""WITH {CONFLICT} SELECT count(*) FILTER (WHERE hi = 1) AS new_customers, count(*) FILTER (WHERE lo = 0) AS training_customers,
        count(*) FILTER (WHERE lo = 0 AND hi = 1) AS overlapping_customers, count(*) AS total_customers FROM b""",
)
add(
    "first_new_week", "N8",
    lambda t: longs(N.first_new_week(flagged(t)["weekly"])),
    f"WITH {FLAGGED} SELECT min(yyyywk) FILTER (WHERE new_data = 1)::BIGINT AS first_new_week FROM w",
)
add(
    "account_sources", "N10",
    lambda t: N.account_sources(flagged(t)["metadata"]),
    f"WITH {FLAGGED} SELECT account_id, account_name, segment, CASE WHEN new_data = 1 THEN 'new' ELSE 'training' END AS data_source FROM m",
)
add(
    "weekly_accounts_by_flag", "N9",
    lambda t: longs(N.weekly_by_flag(flagged(t)["weekly"])),
    f"WITH {FLAGGED} SELECT yyyywk::BIGINT AS yyyywk, new_data::BIGINT AS new_data, count(DISTINCT account_id) AS customers FROM w GROUP BY 1, 2",
)
add(
    "segment_flag_pivot", "A39",
    lambda t: N.segment_flag_pivot(flagged(t)["metadata"]),
    f"""WITH {FLAGGED} SELECT segment, count(*) FILTER (WHERE new_data = 0) AS train, count(*) FILTER (WHERE new_data = 1) AS "new" FROM m GROUP BY 1""",
)
