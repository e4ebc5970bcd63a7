"""Table scans, SQL text and the catalogue of named queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import normalise_name
from tidemark.operators.churn import first_week_of
from tidemark.operators.match import fuzzy_match
from tidemark.operators.relational import active_only, distinct_projection
from tidemark.sources.schemas import enforce_defaults, enforce_schema


def scan(
    spark: SparkSession,
    table: str | DataFrame,
    columns: list[str] | None = None,
    where: str | None = None,
    order_by: list[str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Project, filter, order and limit a table name, a parquet path or a frame.

    Columns that are no list mean all columns, and a falsy limit means none.
    """
    if isinstance(table, DataFrame):
        df = table
    else:
        df = spark.read.parquet(table) if "/" in table else spark.table(table)
    if where:
        df = df.where(where)
    if order_by:
        df = df.orderBy(*[F.expr(o[:-5]).desc() if o.lower().endswith(" desc") else F.expr(o) for o in order_by])
    if isinstance(columns, (list, tuple)) and columns:
        df = df.select(*columns)
    return df.limit(limit) if limit else df


def scan_enforced(spark: SparkSession, table: str | DataFrame, schema: dict, **options) -> DataFrame:
    """A scan whose columns have the schema's types."""
    return enforce_schema(scan(spark, table, **options), schema)


def run_sql(spark: SparkSession, text: str, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """SQL text; ``{name}`` in it stands for a frame of ``tables``."""
    return spark.sql(text, **(tables or {}))


def query_enforced(spark: SparkSession, text: str, tables: dict[str, DataFrame], schema: dict | None) -> DataFrame:
    """SQL text with the schema's types, or with the default coercions when there is none."""
    df = run_sql(spark, text, tables)
    return enforce_defaults(df) if schema is None else enforce_schema(df, schema)


@dataclass(frozen=True)
class NamedQuery:
    """A catalogue entry; ``build`` takes the tables by name."""

    description: str
    build: Callable[[dict[str, DataFrame]], DataFrame]
    output_name: str
    limit_default: int | None = None


USAGE_COLUMNS = (
    "contract_number",
    "usage_name",
    "contract_start",
    "contract_end",
    "documents_opened",
    "storage_mb",
    "line_items",
    "period",
    "yyyywk",
)


def usage_names(usage: DataFrame) -> DataFrame:
    """Distinct usage rows under their normalised customer name."""
    present = [c for c in USAGE_COLUMNS if c in usage.columns]
    return distinct_projection(usage, *[normalise_name(c).alias(c) if c == "usage_name" else F.col(c) for c in present])


def matched_usage(accounts: DataFrame, usage: DataFrame, min_score: int = 93) -> DataFrame:
    """Usage rows of the best-matching usage names of each account, without repeats: both sides are made distinct before they meet."""
    people = accounts.select("account_id", "account_name", "churned_flag", "churn_date").distinct()
    return fuzzy_match(people, usage_names(usage), "account_name", "usage_name", min_score)


CATALOGUE: dict[str, NamedQuery] = {
    "usage_latest": NamedQuery(
        "usage matched to accounts by name", lambda t: matched_usage(t["account"], t["usage"]), "usage_latest"
    ),
    "active_usage_latest": NamedQuery(
        "the same for active accounts", lambda t: matched_usage(active_only(t["account"]), t["usage"]), "active_usage_latest"
    ),
    "customers_first_week": NamedQuery(
        "first active week of all accounts", lambda t: first_week_of(t["usage"], t["account"]), "customers_first_week"
    ),
    "churned_first_week": NamedQuery(
        "first active week of churned accounts", lambda t: first_week_of(t["usage"], t["account"], 1), "churned_first_week"
    ),
    "active_first_week": NamedQuery(
        "first active week of active accounts", lambda t: first_week_of(t["usage"], t["account"], 0), "active_first_week"
    ),
}


def run_query(name: str, tables: dict[str, DataFrame], row_limit: int | None = None) -> DataFrame:
    """A catalogue query, capped when a row limit is asked for."""
    entry = CATALOGUE[name]
    df = entry.build(tables)
    limit = row_limit or entry.limit_default
    return df.limit(limit) if limit else df
