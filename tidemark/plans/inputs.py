"""The engine's input tables, derived from the order-processing tables of the test data.

Each table is given twice: as a DataFrame over the parquet files, and as SQL text
(a common table expression) for the side-by-side check.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.weeks import date_to_week
from tidemark.operators.churn import first_active_week
from tidemark.operators.merge import Bundle
from tidemark.session import size_tasks

CUTOFF = "2000-01-01"
START = "1996-01-01"


class Inputs:
    """Lazy input tables below one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._bytes: dict[str, int] = {}

    def raw(self, name: str) -> DataFrame:
        """A table as it is in the folder; tasks are sized for all tables read so far."""
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name not in self._bytes:
            self._bytes[name] = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
            size_tasks(self.spark, sum(self._bytes.values()))
        return table

    @cached_property
    def orders(self) -> DataFrame:
        return self.raw("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.raw("lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))

    @cached_property
    def account(self) -> DataFrame:
        """Customers; one whose last order lies before the cut-off has churned on that day."""
        ordered = self.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
            F.max("o_orderdate").alias("last_order"), F.min("o_orderdate").alias("registered_on")
        )
        gone = F.col("last_order") < F.lit(CUTOFF).cast("date")
        return (
            self.raw("customer")
            .join(ordered, "c_custkey", "left")
            .select(
                F.col("c_custkey").alias("account_id"),
                F.col("c_name").alias("account_name"),
                F.col("c_mktsegment").alias("segment"),
                F.concat(F.lit("L"), (F.col("c_nationkey") % 4).cast("string")).alias("segment_level"),
                F.when(gone, 1).otherwise(0).alias("churned_flag"),
                F.when(gone, F.col("last_order")).alias("churn_date"),
                "registered_on",
            )
        )

    @cached_property
    def payment(self) -> DataFrame:
        return self.orders.where(F.col("o_orderstatus") != "O").select(
            F.col("o_custkey").alias("customer_no"),
            F.date_add("o_orderdate", 14).alias("receipt_date"),
            F.col("o_totalprice").alias("entered_amount"),
            F.col("o_totalprice").alias("functional_amount"),
            F.col("o_orderkey").alias("receipt_id"),
        )

    @cached_property
    def _sold(self) -> DataFrame:
        o = self.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
        return self.lineitem.join(o, "l_orderkey")

    @cached_property
    def revenue(self) -> DataFrame:
        return self._sold.select(
            F.col("o_custkey").alias("account_id"),
            F.col("l_shipdate").alias("invoice_date"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("invoice_number"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revline_total"),
        )

    @cached_property
    def txn(self) -> DataFrame:
        return self.orders.select(
            F.col("o_custkey").alias("account_number"),
            F.col("o_orderdate").alias("trx_date"),
            F.col("o_totalprice").alias("amount_due"),
            F.col("o_orderkey").alias("txn_id"),
        )

    @cached_property
    def contract_line(self) -> DataFrame:
        return self.orders.where(F.col("o_orderpriority") == "1-URGENT").select(
            F.col("o_custkey").alias("account_id"),
            F.col("o_orderdate").alias("line_start"),
            F.date_add("o_orderdate", 365).alias("line_end"),
            F.col("o_orderstatus").alias("line_status"),
        )

    @cached_property
    def renewal(self) -> DataFrame:
        return self.orders.where(F.col("o_orderpriority") == "2-HIGH").select(
            F.col("o_custkey").alias("bill_to"),
            F.date_sub("o_orderdate", 30).alias("coverage_start"),
            F.date_add("o_orderdate", 335).alias("coverage_end"),
        )

    @cached_property
    def risk(self) -> DataFrame:
        bal = F.col("c_acctbal")
        return self.raw("customer").select(
            F.col("c_custkey").alias("account_number"),
            bal.alias("risk_score"),
            (bal / 100).alias("delinquency"),
            F.when(bal < 0, None)
            .when(bal < 3000, "LOW RISK")
            .when(bal < 7000, "MEDIUM RISK")
            .otherwise("HIGH RISK")
            .alias("business_risk"),
            F.when(F.col("c_nationkey") % 3 == 0, "A A").when(F.col("c_nationkey") % 3 == 1, "B B").alias("payment_rating"),
        )

    @cached_property
    def usage(self) -> DataFrame:
        items = F.concat(
            F.col("l_linenumber").cast("string"), F.lit("x "), "p_name", F.lit(", "), "p_brand", F.lit(","), "p_type"
        )
        part = self.raw("part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand", "p_type")
        churn = self.account.select(F.col("account_id").alias("o_custkey"), "churn_date")
        return (
            self._sold.join(part, "l_partkey", "left")
            .join(churn, "o_custkey", "left")
            .select(
                F.col("o_custkey").alias("account_id"),
                F.col("l_orderkey").alias("contract_number"),
                F.col("o_orderdate").alias("contract_start"),
                F.date_add("o_orderdate", 365).alias("contract_end"),
                F.col("l_shipdate").alias("period"),
                F.when(F.col("l_linenumber") != 7, F.col("l_quantity").cast("bigint")).alias("documents_opened"),
                F.when(F.col("l_linenumber") != 6, F.col("l_partkey") % 1000).alias("storage_mb"),
                items.alias("line_items"),
                date_to_week("l_shipdate").alias("yyyywk"),
                "churn_date",
            )
        )

    @cached_property
    def first_week(self) -> DataFrame:
        sold = self._sold.select(F.col("o_custkey").alias("account_id"), date_to_week("l_shipdate").alias("yyyywk"))
        return first_active_week(sold)

    @cached_property
    def bundle(self) -> Bundle:
        return Bundle(
            self.account,
            self.payment,
            self.revenue,
            self.txn,
            self.contract_line,
            self.renewal,
            self.risk,
            self.usage,
            self.first_week,
        )

    @cached_property
    def weekly(self) -> DataFrame:
        """Weekly activity per account straight from the order lines, with the churn flag."""
        sold = self._sold.select(
            F.col("o_custkey").alias("account_id"),
            date_to_week("l_shipdate").alias("yyyywk"),
            F.when(F.col("l_linenumber") != 7, F.col("l_quantity").cast("bigint")).alias("documents_opened"),
            F.when(F.col("l_linenumber") != 6, F.col("l_partkey") % 1000).alias("storage_mb"),
        )
        summed = sold.groupBy("account_id", "yyyywk").agg(
            F.sum("documents_opened").alias("documents_opened"), F.sum("storage_mb").alias("storage_mb")
        )
        return summed.join(self.account.select("account_id", "churned_flag", "churn_date", "segment"), "account_id")

    @cached_property
    def weekly_totals(self) -> DataFrame:
        return self.weekly.groupBy("yyyywk").agg(
            F.sum("documents_opened").alias("documents_opened"), F.sum("storage_mb").alias("storage_mb")
        )

    @cached_property
    def weekly_segments(self) -> DataFrame:
        return self.weekly.groupBy("segment", "yyyywk").agg(F.sum("documents_opened").alias("documents_opened"))

    @cached_property
    def train_keys(self) -> DataFrame:
        """Accounts with an order before 1996, standing in for a training set."""
        return self.orders.where(F.col("o_orderdate") < F.lit("1996-01-01").cast("date")).select(
            F.col("o_custkey").alias("account_id")
        ).distinct()

    @cached_property
    def named_accounts(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("account_id"), F.concat_ws(" ", "p_name", "p_brand").alias("account_name")
        )

    @cached_property
    def named_usage(self) -> DataFrame:
        """Usage rows under names with doubled spaces, other case, changed and added letters."""
        kind = F.col("p_partkey") % 4
        name = (
            F.when(kind == 0, F.concat(F.lit(" "), "p_name", F.lit("  "), "p_brand", F.lit(" ")))
            .when(kind == 1, F.concat_ws(" ", F.replace("p_name", F.lit("e"), F.lit("ee")), "p_brand"))
            .when(kind == 2, F.concat_ws(" ", F.upper("p_name"), "p_brand"))
            .otherwise(F.concat_ws(" ", "p_name", "p_brand", F.lit("ltd")))
        )
        return self.raw("part").select(F.col("p_partkey").alias("contract_number"), name.alias("usage_name"), F.col("p_size").alias("yyyywk"))


WEEK = "CAST(isoyear({0}) * 100 + weekofyear({0}) AS INTEGER)"


def week_sql(expression: str) -> str:
    return WEEK.format(expression)


CTES: dict[str, str] = {
    "ord": "SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders",
    "li": "SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM lineitem",
    "account": f"""
        SELECT c_custkey AS account_id, c_name AS account_name, c_mktsegment AS segment,
               'L' || CAST(c_nationkey % 4 AS VARCHAR) AS segment_level,
               CASE WHEN last_order < DATE '{CUTOFF}' THEN 1 ELSE 0 END AS churned_flag,
               CASE WHEN last_order < DATE '{CUTOFF}' THEN last_order END AS churn_date,
               registered_on
        FROM customer LEFT JOIN (
            SELECT o_custkey, max(o_orderdate) AS last_order, min(o_orderdate) AS registered_on FROM ord GROUP BY 1
        ) ON o_custkey = c_custkey""",
    "payment": """
        SELECT o_custkey AS customer_no, o_orderdate + 14 AS receipt_date, o_totalprice AS entered_amount,
               o_totalprice AS functional_amount, o_orderkey AS receipt_id FROM ord WHERE o_orderstatus <> 'O'""",
    "sold": "SELECT li.*, o_custkey, o_orderdate FROM li JOIN ord ON l_orderkey = o_orderkey",
    "revenue": """
        SELECT o_custkey AS account_id, l_shipdate AS invoice_date, l_orderkey * 10 + l_linenumber AS invoice_number,
               l_extendedprice * (1 - l_discount) AS revline_total FROM sold""",
    "txn": """
        SELECT o_custkey AS account_number, o_orderdate AS trx_date, o_totalprice AS amount_due, o_orderkey AS txn_id
        FROM ord""",
    "contract_line": """
        SELECT o_custkey AS account_id, o_orderdate AS line_start, o_orderdate + 365 AS line_end,
               o_orderstatus AS line_status FROM ord WHERE o_orderpriority = '1-URGENT'""",
    "renewal": """
        SELECT o_custkey AS bill_to, o_orderdate - 30 AS coverage_start, o_orderdate + 335 AS coverage_end
        FROM ord WHERE o_orderpriority = '2-HIGH'""",
    "risk": """
        SELECT c_custkey AS account_number, c_acctbal AS risk_score, c_acctbal / 100 AS delinquency,
               CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 3000 THEN 'LOW RISK'
                    WHEN c_acctbal < 7000 THEN 'MEDIUM RISK' ELSE 'HIGH RISK' END AS business_risk,
               CASE c_nationkey % 3 WHEN 0 THEN 'A A' WHEN 1 THEN 'B B' END AS payment_rating
        FROM customer""",
    "usage": f"""
        SELECT o_custkey AS account_id, l_orderkey AS contract_number, o_orderdate AS contract_start,
               o_orderdate + 365 AS contract_end, l_shipdate AS period,
               CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS BIGINT) END AS documents_opened,
               CASE WHEN l_linenumber <> 6 THEN l_partkey % 1000 END AS storage_mb,
               CAST(l_linenumber AS VARCHAR) || 'x ' || p_name || ', ' || p_brand || ',' || p_type AS line_items,
               {week_sql('l_shipdate')} AS yyyywk, churn_date
        FROM sold LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN account ON account_id = o_custkey""",
    "first_week": f"SELECT o_custkey AS account_id, min({week_sql('l_shipdate')}) AS yyyywk FROM sold GROUP BY 1",
    "weekly": f"""
        SELECT account_id, yyyywk, documents_opened, storage_mb, churned_flag, churn_date, segment FROM (
            SELECT o_custkey, {week_sql('l_shipdate')} AS yyyywk,
                   CAST(sum(CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS BIGINT) END) AS BIGINT) AS documents_opened,
                   CAST(sum(CASE WHEN l_linenumber <> 6 THEN l_partkey % 1000 END) AS BIGINT) AS storage_mb
            FROM sold GROUP BY 1, 2) JOIN account ON account_id = o_custkey""",
    "weekly_totals": """
        SELECT yyyywk, CAST(sum(documents_opened) AS BIGINT) AS documents_opened,
               CAST(sum(storage_mb) AS BIGINT) AS storage_mb FROM weekly GROUP BY 1""",
    "weekly_segments": """
        SELECT segment, yyyywk, CAST(sum(documents_opened) AS BIGINT) AS documents_opened FROM weekly GROUP BY 1, 2""",
    "train_keys": "SELECT DISTINCT o_custkey AS account_id FROM ord WHERE o_orderdate < DATE '1996-01-01'",
    "named_accounts": "SELECT p_partkey AS account_id, p_name || ' ' || p_brand AS account_name FROM part",
    "named_usage": """
        SELECT p_partkey AS contract_number,
               CASE p_partkey % 4 WHEN 0 THEN ' ' || p_name || '  ' || p_brand || ' '
                    WHEN 1 THEN replace(p_name, 'e', 'ee') || ' ' || p_brand
                    WHEN 2 THEN upper(p_name) || ' ' || p_brand
                    ELSE p_name || ' ' || p_brand || ' ltd' END AS usage_name,
               p_size AS yyyywk FROM part""",
}


def sql_with(body: str) -> str:
    """The SQL with the input tables it names (directly or through one another) in front."""
    needed: list[str] = []

    def visit_name(name: str) -> None:
        body_ = CTES[name]
        for other in CTES:
            if other != name and other not in needed and re.search(rf"\b(FROM|JOIN) {other}\b", body_):
                visit_name(other)
        if name not in needed:
            needed.append(name)

    for name in CTES:
        if name not in needed and re.search(rf"\b(FROM|JOIN|,) *{name}\b", body):
            visit_name(name)
    if not needed:
        return body
    front = ",\n".join(f"{n} AS ({CTES[n]})" for n in needed)
    text = body.strip()
    if text.upper().startswith("WITH "):
        return f"WITH {front},\n{text[5:]}"
    return f"WITH {front}\n{text}"
