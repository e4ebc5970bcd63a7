"""Scans, sources, sinks and the query catalogue."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.expression_queries import DIRTY_DATE, DIRTY_NUMBER, dirty_dates, dirty_numbers
from tidemark.plans.inputs import START, Inputs, week_sql
from tidemark.plans.registry import add, longs, rounded, shown
from tidemark.session import scratch_path
from tidemark.sources import files, schemas, tables
from tidemark.operators.quality import infer_schema, schema_json

add(
    "table_scan", "S1",
    lambda t: longs(tables.scan(
        t.spark, f"{t.folder}/orders.parquet", ["o_orderkey", "o_custkey", "o_totalprice"],
        "o_totalprice > 100000 AND o_orderstatus = 'F'", ["o_totalprice desc", "o_orderkey"],
    )),
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F'""",
)
add(
    "table_scan_top", "S1 S4 O1",
    lambda t: tables.scan(
        t.spark, t.orders, ["o_orderkey", "o_orderstatus", "o_totalprice"], None, ["o_orderstatus", "o_totalprice desc", "o_orderkey"], 500
    ),
    """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderstatus, o_totalprice DESC, o_orderkey LIMIT 500""",
)
add(
    "sql_text", "S2",
    lambda t: tables.run_sql(
        t.spark,
        """SELECT segment, count(*) AS accounts, sum(churned_flag) AS churned FROM {account} GROUP BY segment""",
        {"account": t.account},
    ),
    "SELECT segment, count(*) AS accounts, sum(churned_flag)::BIGINT AS churned FROM account GROUP BY segment",
)
add(
    "table_listing", "S5 S8",
    lambda t: longs(schemas.table_fields(t.raw("part")).drop("nullable").join(
        schemas.schema_fields(t.spark, t.raw("part").schema).select("column", "type"), "column"
    ).withColumn("rows", t.raw("part").agg(F.count(F.lit(1))).scalar())),
    """SELECT ordinal::BIGINT AS position, c AS "column", s AS spark_type, ty AS type, (SELECT count(*) FROM part) AS rows
        FROM (VALUES (0, 'p_partkey', 'bigint', 'int'), (1, 'p_name', 'string', 'str'), (2, 'p_brand', 'string', 'str'),
              (3, 'p_type', 'string', 'str'), (4, 'p_size', 'int', 'int'), (5, 'p_retailprice', 'double', 'float')) v(ordinal, c, s, ty)""",
)

# A schema in the stored JSON form, over a deliberately dirty order table.
ORDER_SCHEMA = {
    "fields": {
        "o_orderkey": {"type": "int", "required": True},
        "when": {"type": "Optional[datetime]", "required": False, "metadata": {"actual_dtype": "inferred_datetime"}},
        "paid": {"type": "int", "required": True, "validator": "bool_to_int"},
        "open": {"type": "bool", "required": False},
        "price": {"type": "Optional[float]", "required": False},
        "not_there": {"type": "int", "required": False},
    }
}
DIRTY_ORDERS = f"""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, {DIRTY_DATE} AS "when", o_orderstatus,
    CASE o_orderstatus WHEN 'F' THEN 'Y' WHEN 'O' THEN 'no' END AS paid, CASE o_orderstatus WHEN 'O' THEN 'Active' ELSE 'n' END AS open,
    CASE WHEN o_orderkey % 4 = 0 THEN 'none' ELSE ' ' || CAST(o_totalprice AS VARCHAR) END AS price FROM ord"""
ENFORCED = """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey,
    try_strptime("when", ['%Y-%m-%d', '%Y-%m', '%m/%d/%Y', '%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S']) AS "when", o_orderstatus,
    CASE paid WHEN 'Y' THEN 1 WHEN 'no' THEN 0 END::BIGINT AS paid, open = 'Active' AS open,
    TRY_CAST(trim(price) AS DOUBLE) AS price FROM dirty"""


def dirty_orders(t: Inputs) -> DataFrame:
    status, key = F.col("o_orderstatus"), F.col("o_orderkey")
    dates = dirty_dates(t).withColumnRenamed("x", "when")
    return (
        t.orders.join(dates, "o_orderkey").select(
            key.cast("string").alias("o_orderkey"), "when", "o_orderstatus",
            F.when(status == "F", "Y").when(status == "O", "no").alias("paid"),
            F.when(status == "O", "Active").otherwise("n").alias("open"),
            F.when(key % 4 == 0, "none").otherwise(F.concat(F.lit(" "), F.col("o_totalprice").cast("string"))).alias("price"),
        )
    )


add(
    "enforced_scan", "S6",
    lambda t: longs(tables.scan_enforced(t.spark, dirty_orders(t), ORDER_SCHEMA, where="o_orderstatus <> 'P'")),
    f"WITH dirty AS ({DIRTY_ORDERS}) {ENFORCED} WHERE o_orderstatus <> 'P'",
)
add(
    "enforced_query", "S7",
    lambda t: longs(tables.query_enforced(t.spark, "SELECT * FROM {d} WHERE paid IS NOT NULL", {"d": dirty_orders(t)}, ORDER_SCHEMA)),
    f"WITH dirty AS ({DIRTY_ORDERS}) {ENFORCED} WHERE paid IS NOT NULL",
)
add(
    "enforced_query_default", "S7",
    lambda t: longs(tables.query_enforced(
        t.spark, "SELECT o_orderkey AS account_id, paid AS churned_flag, o_orderstatus FROM {d}", {"d": dirty_orders(t)}, None
    )),
    f"""WITH dirty AS ({DIRTY_ORDERS}) SELECT CAST(o_orderkey AS BIGINT) AS account_id,
        CASE paid WHEN 'Y' THEN 1 WHEN 'no' THEN 0 END::BIGINT AS churned_flag, o_orderstatus FROM dirty""",
)


def looked_up_schema(t: Inputs) -> DataFrame:
    """The schema inferred from a table, put down for joined data and found from the raw context, which falls back on it."""
    base = scratch_path(t.spark, "schemas")
    schemas.save_schema(t.spark, schema_json(infer_schema(t.raw("customer"))), f"{base}/join_rules/customer_schema.json")
    return schemas.schema_fields(t.spark, schemas.load_schema(schemas.find_schema("customer", base, "raw")))


add(
    "schema_listing", "S8 S9",
    looked_up_schema,
    """SELECT c AS "column", ty AS type, s AS spark_type, nullable FROM (VALUES ('c_custkey', 'int', 'bigint', false),
        ('c_name', 'str', 'string', false), ('c_nationkey', 'int', 'bigint', false), ('c_acctbal', 'float', 'double', false),
        ('c_mktsegment', 'str', 'string', false)) v(c, ty, s, nullable)
        WHERE EXISTS (SELECT 1 FROM customer)""",
)

# --- files ------------------------------------------------------------------------------


def csv_copy(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    files.write_csv(t.orders.withColumn("ts", F.col("o_orderdate").cast("timestamp")), path, ["o_orderkey", "o_orderstatus", "o_totalprice", "ts"])
    return files.read_csv(t.spark, path)


add(
    "csv_round_trip", "S10 S14 S15",
    csv_copy,
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, printf('%.6f', o_totalprice) AS o_totalprice,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ts FROM orders""",
)
# Fixed text: a column description in the marker format.
DESCRIPTION = """
(+) l_orderkey: identifier of the order
(=) l_linenumber and its number
(-) l_partkey is not needed
(+) x a value that may be a number
"""


def described_copy(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    files.write_csv(dirty_numbers(t), path)
    return files.read_csv_described(t.spark, path, DESCRIPTION)


add(
    "csv_by_description", "S11 S13",
    described_copy,
    f"""SELECT l_orderkey::DOUBLE AS l_orderkey, l_linenumber::DOUBLE AS l_linenumber, TRY_CAST(trim(x) AS DOUBLE) AS x
        FROM (SELECT l_orderkey, l_linenumber, {DIRTY_NUMBER} AS x FROM lineitem)""",
)


def csv_folder(t: Inputs) -> DataFrame:
    """Rows and columns of each CSV of a folder, one of which has not even a header."""
    path = scratch_path(t.spark, "csvdir")
    for name in ("nation", "supplier"):
        files.write_csv(t.raw(name), f"{path}/{name}.csv")
    t.raw("nation").limit(0).coalesce(1).write.csv(f"{path}/broken.csv")
    found, failed = files.read_csv_dir(t.spark, path)
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows", F.lit(len(df.columns)).cast("long").alias("columns"))
        for n, df in sorted(found.items())
    ]
    none = t.spark.createDataFrame([(n, 0, 0) for n in failed], "table string, rows long, columns long")
    return reduce(DataFrame.unionByName, [none, *counts])


add(
    "csv_folder", "S12",
    csv_folder,
    """SELECT 'nation' AS "table", count(*) AS rows, 3::BIGINT AS columns FROM nation UNION ALL SELECT 'supplier', count(*), 4 FROM supplier
        UNION ALL SELECT 'broken', 0, 0""",
)


# Column kinds by the distinct count {u}.
INT_KIND = "CASE WHEN {u} = 2 THEN 'bin_int' WHEN {u} <= 10 THEN 'cat_int(' || {u} || ')' ELSE 'int' END"
TEXT_KIND = "CASE WHEN {u} = 2 THEN 'bin' WHEN {u} > 10 THEN 'cat_high_card(' || {u} || ')' ELSE 'cat(' || {u} || ')' END"


def exported(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "export")
    done, failed = files.export_many({"supplier": t.raw("supplier"), "nation": t.raw("nation")}, path)
    parts = [
        files.read_csv(t.spark, paths["profile"]).select(F.lit(name).alias("table"), "column", "kind", F.col("n_unique").cast("long").alias("n_unique"))
        for name, paths in sorted(done.items())
    ]
    return parts[0].unionByName(parts[1])


add(
    "export_bundle", "S16 V8",
    exported,
    " UNION ALL ".join(
        f"""SELECT '{table}' AS "table", '{c}' AS "column", {kind.format(u=f'count(DISTINCT {c})')} AS kind, count(DISTINCT {c}) AS n_unique FROM {table}"""
        for table, c, kind in (
            ("supplier", "s_suppkey", INT_KIND), ("supplier", "s_name", TEXT_KIND), ("supplier", "s_nationkey", INT_KIND), ("supplier", "s_acctbal", "'num'"),
            ("nation", "n_nationkey", INT_KIND), ("nation", "n_name", TEXT_KIND), ("nation", "n_regionkey", INT_KIND),
        )
    ),
)


def summary_files(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "summary")
    totals = t.account.agg(F.count(F.lit(1)).alias("accounts"), F.sum("churned_flag").alias("churned"))
    written = files.save_summary(totals, path)
    as_csv = files.read_csv(t.spark, written[0]).select(F.lit("csv").alias("format"), *[F.col(c).cast("long").alias(c) for c in ("accounts", "churned")])
    return as_csv.unionByName(t.spark.read.json(written[1]).select(F.lit("json").alias("format"), "accounts", "churned"))


add(
    "summary_files", "S17",
    summary_files,
    """SELECT f AS format, count(*) AS accounts, sum(churned_flag)::BIGINT AS churned FROM account CROSS JOIN (VALUES ('csv'), ('json')) v(f) GROUP BY 1""",
)


def typed_copy(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "typed")
    files.write_table(t.account, f"{path}/a", compression="zstd")
    files.write_table(files.read_table(t.spark, f"{path}/a"), f"{path}/b", "orc", compression="snappy")
    return longs(files.read_table(t.spark, f"{path}/b", "orc"))


add("typed_round_trip", "S18", typed_copy, "SELECT * REPLACE (churned_flag::BIGINT AS churned_flag) FROM account")


def retained(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "retained")
    monthly = t.orders.groupBy(F.trunc("o_orderdate", "month").alias("month")).agg(F.count(F.lit(1)).alias("orders"))
    files.append_with_retention(monthly.where("month < date'2001-07-01'"), path, "month", "2001-07-01")
    return files.append_with_retention(monthly.where("month >= date'2001-07-01'"), path, "month", "2001-08-01", 90)


add(
    "append_with_retention", "S19 O6",
    retained,
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS orders FROM ord GROUP BY 1 HAVING month >= DATE '2001-08-01' - 90""",
)
add(
    "first_rows", "S20",
    lambda t: files.first_rows(t.txn, ["account_number", "txn_id"], 1000),
    "SELECT * FROM txn ORDER BY account_number, txn_id LIMIT 1000",
)


def bundle_counts(t: Inputs, live: bool) -> DataFrame:
    b = t.bundle.live() if live else t.bundle
    counts = [getattr(b, n).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows") for n in b.__dataclass_fields__]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def counts_sql(live: bool) -> str:
    active = " WHERE account_id IN (SELECT account_id FROM account WHERE churned_flag = 0)" if live else ""
    names = ["account", "payment", "revenue", "txn", "contract_line", "renewal", "risk", "usage", "first_week"]
    cut = {"account", "usage", "first_week"}
    return " UNION ALL ".join(
        f"""SELECT '{n}' AS "table", count(*) AS rows FROM {n}{active if n in cut else ''}""" for n in names
    )


add("load_bundle", "S21 PL1", lambda t: bundle_counts(t, False), counts_sql(False))
add("load_live_bundle", "S21 PL2", lambda t: bundle_counts(t, True), counts_sql(True))

# --- catalogue ----------------------------------------------------------------------------

CATALOGUE_TABLES = """names AS (SELECT a.*, churned_flag, churn_date FROM named_accounts a JOIN account USING (account_id)),
    clean AS (SELECT DISTINCT contract_number, regexp_replace(trim(usage_name, ' '), '  ', ' ', 'g') AS usage_name, yyyywk FROM named_usage),
    pairs AS (SELECT l, r, CAST(floor(jaro_winkler_similarity(lower(l), lower(r)) * 100 + 1e-9) AS BIGINT) AS score
              FROM (SELECT DISTINCT account_name AS l FROM names) CROSS JOIN (SELECT DISTINCT usage_name AS r FROM clean)),
    best AS (SELECT * FROM pairs WHERE score BETWEEN 93 AND 100 QUALIFY rank() OVER (PARTITION BY l ORDER BY score DESC) = 1)"""
MATCHED = """SELECT account_id, account_name, churned_flag::BIGINT AS churned_flag, churn_date, contract_number, usage_name,
    yyyywk::BIGINT AS yyyywk, score, 1::BIGINT AS match_rank
    FROM names JOIN best ON l = account_name JOIN clean ON usage_name = r"""


def catalogue_tables(t: Inputs) -> dict[str, DataFrame]:
    people = t.named_accounts.join(t.account.select("account_id", "churned_flag", "churn_date"), "account_id")
    return {"account": people, "usage": t.named_usage}


add(
    "fuzzy_matched_usage", "J10 W1 A3 F3 F5 S3",
    lambda t: longs(tables.run_query("usage_latest", catalogue_tables(t))),
    f"WITH {CATALOGUE_TABLES} {MATCHED}",
)
add(
    "fuzzy_matched_active_usage", "J10 W1 S3",
    lambda t: longs(tables.run_query("active_usage_latest", catalogue_tables(t))),
    f"WITH {CATALOGUE_TABLES} {MATCHED} WHERE churned_flag = 0",
)


def first_weeks(t: Inputs, name: str) -> DataFrame:
    return longs(tables.run_query(name, {"account": t.account, "usage": t.usage.select("account_id", "yyyywk")}))


FIRST = "SELECT account_id, f.yyyywk::BIGINT AS yyyywk, churned_flag::BIGINT AS churned_flag, churn_date FROM first_week f JOIN account USING (account_id)"
add("customers_first_week", "J11 A10 S3", lambda t: first_weeks(t, "customers_first_week"), FIRST)
add("churned_first_week", "J11 A10 S3", lambda t: first_weeks(t, "churned_first_week"), FIRST + " WHERE churned_flag = 1")
add("active_first_week", "J11 A10 S3", lambda t: first_weeks(t, "active_first_week"), FIRST + " WHERE churned_flag = 0")
add(
    "capped_query", "S4 S3",
    lambda t: longs(
        tables.run_query("customers_first_week", {"account": t.account, "usage": t.usage.select("account_id", "yyyywk")}, row_limit=100)
        .agg(F.count(F.lit(1)).alias("n"))
    ),
    f"SELECT least(count(*), 100) AS n FROM ({FIRST})",
)
