"""Schema inference, validation, profiling and quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import compare, quality as V
from tidemark.plans.expression_queries import DIRTY_DATE, DIRTY_NUMBER, dirty_dates, dirty_numbers
from tidemark.plans.inputs import Inputs
from tidemark.plans.registry import add, longs, rounded, shown
from tidemark.plans.source_queries import DIRTY_ORDERS, ORDER_SCHEMA, dirty_orders

NUMBER = "'^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$'"
DATE = r"""(regexp_matches(v, '^\d{4}-\d{2}-\d{2}$') OR regexp_matches(v, '^\d{4}-\d{2}$') OR regexp_matches(v, '^\d{2}/\d{2}/\d{4}$')
    OR regexp_matches(v, '^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$') OR regexp_matches(v, '^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}'))
    AND NOT regexp_matches(lower(v), 'latest|current|previous|next|last')"""


def wide(t: Inputs) -> DataFrame:
    """A table with columns of many kinds, some dirty."""
    k = F.col("o_orderkey")
    dates = dirty_dates(t).withColumnRenamed("x", "mixed_date")
    return t.orders.join(dates, "o_orderkey").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "mixed_date", "o_orderpriority",
        (k % 2).alias("two"), (k % 7).cast("string").alias("digit_text"), F.floor("o_totalprice").cast("double").alias("whole"),
        F.when(k % 3 == 0, "Yes").otherwise("no").alias("yes_no"), F.lit(None).cast("string").alias("nothing"),
        F.when(k % 4 == 0, F.col("o_custkey").cast("string")).alias("key_text"), (F.col("o_totalprice").cast("string")).alias("price_text"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day_text"), F.lit("x").alias("constant"), (k % 5 == 0).alias("fifth"),
    )


WIDE = f"""wide AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, {DIRTY_DATE} AS mixed_date, o_orderpriority, o_orderkey % 2 AS two,
    CAST(o_orderkey % 7 AS VARCHAR) AS digit_text, floor(o_totalprice) AS whole, CASE WHEN o_orderkey % 3 = 0 THEN 'Yes' ELSE 'no' END AS yes_no,
    NULL::VARCHAR AS nothing, CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_custkey AS VARCHAR) END AS key_text, CAST(o_totalprice AS VARCHAR) AS price_text,
    strftime(o_orderdate, '%Y-%m-%d') AS day_text, 'x' AS constant, o_orderkey % 5 = 0 AS fifth FROM ord)"""
STORED = {
    "o_orderkey": "int", "o_orderstatus": "text", "o_totalprice": "float", "o_orderdate": "datetime", "mixed_date": "text", "o_orderpriority": "text",
    "two": "int", "digit_text": "text", "whole": "float", "yes_no": "text", "nothing": "text", "key_text": "text", "price_text": "text",
    "day_text": "text", "constant": "text", "fifth": "bool",
}


def fact_sql(c: str, kind: str) -> str:
    value = f"CASE WHEN {c} = floor({c}) THEN CAST(CAST({c} AS BIGINT) AS VARCHAR) ELSE CAST({c} AS VARCHAR) END" if kind == "float" else f"CAST({c} AS VARCHAR)"
    return f"""SELECT '{c}' AS "column", '{kind}' AS st, count(*) AS total, count(*) - count(v) AS missing, count(DISTINCT v) AS u,
        bool_and(regexp_matches(trim(v), {NUMBER})) AS num, bool_and(TRY_CAST(trim(v) AS DOUBLE) = floor(TRY_CAST(trim(v) AS DOUBLE))) AS whl,
        count(*) FILTER (WHERE {DATE}) AS dates, min(lower(trim(v))) AS lo, max(lower(trim(v))) AS hi FROM (SELECT {value} AS v FROM wide)"""


FACTS = "facts AS (" + " UNION ALL ".join(fact_sql(c, k) for c, k in STORED.items()) + ")"
PAIR = "(u = 2 AND (lo, hi) IN (('false','true'), ('no','yes'), ('n','y'), ('0','1'), ('0.0','1.0'), ('active','inactive')))"
SMALL = "CASE WHEN u = 2 THEN 'bin_int' WHEN u <= 10 THEN 'cat_int(' || u || ')' ELSE {0} END"
KIND = f"""CASE WHEN total = missing THEN 'str' WHEN st = 'datetime' THEN 'datetime' WHEN st = 'bool' THEN CASE WHEN u = 2 THEN 'bin' ELSE 'str(' || u || ')' END
    WHEN st = 'int' OR (st = 'float' AND whl) THEN {SMALL.format("'int'")} WHEN st = 'float' THEN 'num'
    WHEN num AND NOT whl THEN 'num' WHEN num THEN {SMALL.format("'cat_high_card(' || u || ')'")} WHEN dates >= (total - missing) * 0.5 THEN 'datetime'
    WHEN u = 2 THEN 'bin' WHEN u > 10 THEN 'cat_high_card(' || u || ')' WHEN u > 1 THEN 'cat(' || u || ')' ELSE 'str(' || u || ')' END"""
TYPE = f"""CASE WHEN total = missing THEN 'str' WHEN st IN ('datetime', 'bool') THEN st WHEN st = 'int' OR (st = 'float' AND whl) THEN 'int' WHEN st = 'float' THEN 'float'
    WHEN num AND NOT whl THEN 'float' WHEN num THEN 'int' WHEN dates >= (total - missing) * 0.5 THEN 'datetime' WHEN {PAIR} THEN 'bool' ELSE 'str' END"""
add(
    "inferred_types", "V1 V6",
    lambda t: V.infer_types(wide(t)),
    f"""WITH {WIDE}, {FACTS} SELECT "column", {KIND} AS kind, {TYPE} AS type, missing > 0 AS nullable, missing, u AS n_unique FROM facts""",
)
add(
    "numeric_text", "V3",
    lambda t: V.numeric_text(wide(t)),
    f"""WITH {WIDE}, {FACTS} SELECT "column", CASE WHEN NOT num THEN 'no' WHEN whl THEN 'integer' ELSE 'float' END AS numeric_text
        FROM facts WHERE st = 'text' AND missing < total""",
)
add(
    "date_patterns", "V2",
    lambda t: rounded(V.date_pattern_share(wide(t))),
    f"""WITH {WIDE}, {FACTS} SELECT "column", round(dates / (total - missing), 6) AS date_share, dates / (total - missing) >= 0.5 AS is_datetime
        FROM facts WHERE st = 'text' AND missing < total""",
)
add(
    "binary_pairs", "V4",
    lambda t: V.binary_pairs(wide(t)),
    f"""WITH {WIDE}, {FACTS} SELECT "column", lo AS low, hi AS high, {PAIR} AS is_binary FROM facts WHERE u = 2""",
)
add(
    "whole_number_columns", "V5",
    lambda t: V.whole_numbers(t.raw("lineitem")),
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", bool_and({c} = floor({c})) AS all_whole FROM lineitem"""
        for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ),
)


def inferred_schema(t: Inputs) -> DataFrame:
    schema = V.infer_schema(wide(t))
    return t.spark.createDataFrame(
        [(f.name, f.dataType.simpleString(), f.nullable, int(f.metadata["n_unique"])) for f in schema],
        "column string, spark_type string, nullable boolean, n_unique long",
    )


add(
    "inferred_schema", "V6 S8",
    inferred_schema,
    f"""WITH {WIDE}, {FACTS} SELECT "column", CASE {TYPE} WHEN 'int' THEN 'bigint' WHEN 'float' THEN 'double' WHEN 'bool' THEN 'boolean'
        WHEN 'datetime' THEN 'timestamp' ELSE 'string' END AS spark_type, missing > 0 AS nullable, u AS n_unique FROM facts""",
)
SAMPLES = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", array_to_string(list_sort(list(v))[1:10], ' | ') AS samples FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM wide WHERE {c} IS NOT NULL)"""
    for c in ("o_orderkey", "o_orderstatus", "mixed_date", "o_orderpriority", "digit_text", "yes_no", "nothing", "day_text", "o_orderdate")
)
add(
    "column_profile", "V8 V9",
    lambda t: rounded(V.profile(wide(t).select("o_orderkey", "o_orderstatus", "mixed_date", "o_orderpriority", "digit_text", "yes_no", "nothing", "day_text", "o_orderdate"))),
    f"""WITH {WIDE}, {FACTS}, samples AS ({SAMPLES}) SELECT f."column", {KIND} AS kind, {TYPE} AS type, missing, round(missing / total * 100, 6) AS missing_pct,
        u AS n_unique, coalesce(samples, '') AS samples FROM facts f JOIN samples s ON f."column" = s."column" """,
)
add(
    "text_table_profile", "V1 V8",
    lambda t: V.infer_types(t.raw("documents")).unionByName(V.infer_types(t.raw("pages"))).unionByName(V.infer_types(t.raw("conversations").drop("text"))),
    """SELECT * FROM (SELECT 'doc_id' AS "column", 'int' AS kind, 'int' AS type, false AS nullable, 0::BIGINT AS missing, count(DISTINCT doc_id) AS n_unique FROM documents UNION ALL
        SELECT 'text', 'cat_high_card(' || count(DISTINCT text) || ')', 'str', count(text) < count(*), count(*) - count(text), count(DISTINCT text) FROM documents UNION ALL
        SELECT 'lang', 'cat(' || count(DISTINCT lang) || ')', 'str', count(lang) < count(*), count(*) - count(lang), count(DISTINCT lang) FROM documents UNION ALL
        SELECT 'source', CASE WHEN count(DISTINCT source) > 10 THEN 'cat_high_card(' ELSE 'cat(' END || count(DISTINCT source) || ')', 'str', count(source) < count(*), count(*) - count(source), count(DISTINCT source) FROM documents UNION ALL
        SELECT 'n_chars', 'int', 'int', count(n_chars) < count(*), count(*) - count(n_chars), count(DISTINCT n_chars) FROM documents UNION ALL
        SELECT 'page_id', 'int', 'int', false, 0, count(DISTINCT page_id) FROM pages UNION ALL
        SELECT 'url', 'cat_high_card(' || count(DISTINCT url) || ')', 'str', false, 0, count(DISTINCT url) FROM pages UNION ALL
        SELECT 'html', 'cat_high_card(' || count(DISTINCT html) || ')', 'str', false, 0, count(DISTINCT html) FROM pages UNION ALL
        SELECT 'conv_id', 'int', 'int', false, 0, count(DISTINCT conv_id) FROM conversations UNION ALL
        SELECT 'turn', CASE WHEN count(DISTINCT turn) <= 10 THEN 'cat_int(' || count(DISTINCT turn) || ')' ELSE 'int' END, 'int', false, 0, count(DISTINCT turn) FROM conversations UNION ALL
        SELECT 'role', CASE WHEN count(DISTINCT role) = 2 THEN 'bin' ELSE 'cat(' || count(DISTINCT role) || ')' END, 'str', false, 0, count(DISTINCT role) FROM conversations)""",
)
BAD = {
    "o_orderkey": "TRY_CAST(o_orderkey AS DOUBLE) IS NULL",
    "when": """"when" IS NOT NULL AND try_strptime("when", ['%Y-%m-%d', '%Y-%m', '%m/%d/%Y', '%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S']) IS NULL""",
    "price": "price IS NOT NULL AND TRY_CAST(trim(price) AS DOUBLE) IS NULL",
}
add(
    "validation_errors", "V7",
    lambda t: V.validation_errors(dirty_orders(t), ORDER_SCHEMA),
    f"""WITH dirty AS ({DIRTY_ORDERS}) SELECT 'o_orderkey' AS "column", 'type' AS rule, count(*) FILTER (WHERE {BAD['o_orderkey']}) AS failures FROM dirty UNION ALL
        SELECT 'o_orderkey', 'required', count(*) - count(o_orderkey) FROM dirty UNION ALL SELECT 'when', 'type', count(*) FILTER (WHERE {BAD['when']}) FROM dirty UNION ALL
        SELECT 'paid', 'type', 0 FROM (SELECT count(*) FROM dirty) UNION ALL SELECT 'paid', 'required', count(*) - count(paid) FROM dirty UNION ALL
        SELECT 'open', 'type', 0 FROM (SELECT count(*) FROM dirty) UNION ALL SELECT 'price', 'type', count(*) FILTER (WHERE {BAD['price']}) FROM dirty""",
)
ANY_BAD = f"({BAD['when']}) OR paid IS NULL OR ({BAD['price']})"
add(
    "validation_summary", "V7",
    lambda t: rounded(V.validate(dirty_orders(t), ORDER_SCHEMA)),
    f"""WITH dirty AS ({DIRTY_ORDERS}) SELECT count(*) FILTER (WHERE NOT ({ANY_BAD})) AS valid_rows, count(*) FILTER (WHERE {ANY_BAD}) AS invalid_rows,
        round(count(*) FILTER (WHERE NOT ({ANY_BAD})) / count(*), 6) AS validation_rate FROM dirty""",
)
COERCED = f"""rep AS (SELECT 'orders' AS "table", 'o_orderkey' AS "column", 'string' AS from_type, 'bigint' AS to_type, 0::BIGINT AS nulls_before, 0::BIGINT AS nulls_after,
        0::BIGINT AS failures FROM (SELECT count(*) FROM dirty) UNION ALL
    SELECT 'orders', 'when', 'string', 'timestamp', 0, count(*) FILTER (WHERE {BAD['when']}), count(*) FILTER (WHERE {BAD['when']}) FROM dirty UNION ALL
    SELECT 'orders', 'paid', 'string', 'int', count(*) - count(paid), count(*) - count(paid), 0 FROM dirty UNION ALL
    SELECT 'orders', 'open', 'string', 'boolean', 0, 0, 0 FROM (SELECT count(*) FROM dirty) UNION ALL
    SELECT 'orders', 'price', 'string', 'double', 0, count(*) FILTER (WHERE {BAD['price']}), count(*) FILTER (WHERE {BAD['price']}) FROM dirty)"""
add(
    "coercion_report", "V11",
    lambda t: V.coercion_report(dirty_orders(t), ORDER_SCHEMA, "orders"),
    f"WITH dirty AS ({DIRTY_ORDERS}), {COERCED} SELECT * FROM rep",
)
LINES = {"fields": {"x": {"type": "float", "required": False}, "l_linenumber": {"type": "int", "required": True}}}
add(
    "coercion_totals", "V11",
    lambda t: V.coercion_totals(V.coercion_report(dirty_orders(t), ORDER_SCHEMA, "orders").unionByName(V.coercion_report(dirty_numbers(t), LINES, "lines"))),
    f"""WITH dirty AS ({DIRTY_ORDERS}), {COERCED}, nums AS (SELECT {DIRTY_NUMBER} AS x FROM lineitem)
        SELECT 'orders' AS "table", 5::BIGINT AS columns_changed, 2::BIGINT AS to_int, 1::BIGINT AS to_float, 1::BIGINT AS to_datetime, 1::BIGINT AS to_bool,
            sum(failures)::BIGINT AS failures FROM rep
        UNION ALL SELECT 'lines', 2, 1, 1, 0, 0, count(*) FILTER (WHERE x IS NOT NULL AND TRY_CAST(trim(x) AS DOUBLE) IS NULL) FROM nums""",
)
add(
    "query_profile", "V10",
    lambda t: V.query_profile(t.raw("supplier").join(t.raw("nation"), F.col("s_nationkey") == F.col("n_nationkey"))),
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{k}' AS dtype, count(*) AS rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS n_unique FROM supplier JOIN nation ON s_nationkey = n_nationkey"""
        for c, k in (("s_suppkey", "bigint"), ("s_name", "string"), ("s_nationkey", "int"), ("s_acctbal", "double"), ("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int"))
    ),
)
add(
    "query_profile_all_columns", "V10",
    lambda t: V.query_profile(t.raw("orders").join(t.raw("customer"), F.col("o_custkey") == F.col("c_custkey"))).select("column", "rows", "nulls", "n_unique"),
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS n_unique FROM orders JOIN customer ON o_custkey = c_custkey"""
        for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    ),
)
add(
    "dtype_histogram", "V10",
    lambda t: V.dtype_histogram(t.raw("part")),
    """SELECT d AS dtype, c::BIGINT AS columns, (SELECT count(*) FROM part) AS rows FROM (VALUES ('bigint', 1), ('string', 3), ('int', 1), ('double', 1)) v(d, c)""",
)
add(
    "dataset_metrics", "V12",
    lambda t: rounded(V.dataset_metrics(t.usage.select("account_id", "yyyywk", "documents_opened", "storage_mb"))),
    """WITH g AS (SELECT account_id, yyyywk, documents_opened, storage_mb, count(*) AS n FROM usage GROUP BY ALL),
        s AS (SELECT sum(n)::BIGINT AS rows, sum(n - 1)::BIGINT AS dup, sum(n * (CAST(documents_opened IS NULL AS INT) + CAST(storage_mb IS NULL AS INT))) AS miss FROM g)
        SELECT rows, 4::BIGINT AS columns, dup AS duplicate_rows, round(miss * 100 / (rows * 4), 6) AS missing_pct, dup > 0 AS warn_duplicates,
        miss * 100 / (rows * 4) > 50 AS warn_missing FROM s""",
)
add(
    "repeated_keys", "V13",
    lambda t: longs(V.key_duplicates(t.usage, ["account_id", "yyyywk"])),
    "SELECT account_id, yyyywk::BIGINT AS yyyywk, count(*) AS n FROM usage GROUP BY 1, 2 HAVING count(*) > 1",
)
add(
    "key_density", "V13",
    lambda t: rounded(V.key_density(t.usage)),
    """SELECT count(*) AS rows, count(DISTINCT account_id) AS n_keys, count(*) - (SELECT count(*) FROM (SELECT DISTINCT account_id, yyyywk FROM usage)) AS repeated_rows,
        count(DISTINCT yyyywk) AS n_weeks, round(count(*) / (count(DISTINCT account_id) * count(DISTINCT yyyywk)), 6) AS density FROM usage""",
)
TARGET = "tg AS (SELECT churned_flag, CASE WHEN churned_flag = 1 THEN date_diff('day', DATE '1998-01-01', churn_date) ELSE 9999 END AS days_to_churn FROM weekly)"


def targets(t: Inputs) -> DataFrame:
    days = F.when(F.col("churned_flag") == 1, F.datediff("churn_date", F.lit("1998-01-01").cast("date"))).otherwise(9999)
    return t.weekly.withColumn("days_to_churn", days.cast("bigint"))


add(
    "target_stats", "V14",
    lambda t: rounded(V.target_stats(targets(t))),
    f"""WITH {TARGET} SELECT count(*) AS rows, count(*) FILTER (WHERE churned_flag = 1) AS churned_rows, count(*) FILTER (WHERE churned_flag = 0) AS active_rows,
        min(days_to_churn) FILTER (WHERE churned_flag = 1) AS target_min, max(days_to_churn) FILTER (WHERE churned_flag = 1) AS target_max,
        round(avg(days_to_churn) FILTER (WHERE churned_flag = 1), 6) AS target_mean, count(*) FILTER (WHERE churned_flag = 1 AND days_to_churn < 0) AS negative_targets FROM tg""",
)
add(
    "required_columns", "V14",
    lambda t: V.required_columns(t.weekly, ["account_id", "yyyywk", "churn_date", "days_to_churn"]),
    """SELECT 'account_id' AS "column", true AS present, 0::BIGINT AS missing FROM (SELECT count(*) FROM weekly) UNION ALL SELECT 'yyyywk', true, 0
        UNION ALL SELECT 'churn_date', true, count(*) - count(churn_date) FROM weekly UNION ALL SELECT 'days_to_churn', false, count(*) FROM weekly""",
)
CONTRADICTING = """CASE WHEN account_id % 50 = 0 THEN 1 - churned_flag ELSE churned_flag END"""
add(
    "flag_against_date", "V15",
    lambda t: longs(V.flag_date_check(t.account.withColumn("churned_flag", F.when(F.col("account_id") % 50 == 0, 1 - F.col("churned_flag")).otherwise(F.col("churned_flag"))))),
    f"""SELECT f::BIGINT AS flag, churn_date IS NOT NULL AS has_date, count(*) AS n, (f = 1 AND churn_date IS NULL) OR (f = 0 AND churn_date IS NOT NULL) AS contradiction
        FROM (SELECT {CONTRADICTING} AS f, churn_date FROM account) GROUP BY ALL""",
)
add(
    "key_coverage", "V16",
    lambda t: compare.key_overlap(t.account, t.contract_line).drop("new_rate_pct"),
    """WITH c AS (SELECT DISTINCT account_id AS k FROM contract_line) SELECT count(*) FILTER (WHERE account_id IS NOT NULL AND k IS NOT NULL) AS common,
        count(*) FILTER (WHERE k IS NULL) AS only_train, count(*) FILTER (WHERE account_id IS NULL) AS only_live FROM account FULL JOIN c ON account_id = k""",
)
add(
    "column_summary", "V17 A35",
    lambda t: rounded(V.column_summary(t.weekly.select("account_id", "yyyywk", "documents_opened", "segment", "churn_date"))),
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(count({c}) * 100 / count(*), 6) AS complete_pct, count(DISTINCT {c}) AS n_unique FROM weekly"""
        for c in ("account_id", "yyyywk", "documents_opened", "segment", "churn_date")
    ),
)
add(
    "sample_formatting", "V9",
    lambda t: _formatted(t),
    """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) ELSE CAST(floor(o_totalprice) + 0.5 AS VARCHAR) END AS price,
        CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y-%m-%d') || ' 06:00:00' END AS moment FROM ord""",
)


def _formatted(t: Inputs) -> DataFrame:
    k = F.col("o_orderkey")
    df = t.orders.select(
        "o_orderkey",
        F.when(k % 2 == 0, F.floor("o_totalprice").cast("double")).otherwise(F.floor("o_totalprice") + F.lit(0.5)).cast("double").alias("price"),
        (F.col("o_orderdate").cast("timestamp") + F.when(k % 3 == 0, F.expr("interval 0 hours")).otherwise(F.expr("interval 6 hours"))).alias("moment"),
    )
    return df.select("o_orderkey", *[V.text_form(df.schema[c]).alias(c) for c in ("price", "moment")])
