"""Weekly and per-account feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.coerce import coerce_numeric
from tidemark.functions.text import MISSING_LIST, UNKNOWN_CATEGORY, canonical_list, clean_category, strip_counts
from tidemark.functions.weeks import date_to_week, days_to_event, fill_week, weeks_between
from tidemark.operators.relational import (
    dedupe_keep_first,
    first_present_per_key,
    nulls_last,
    select_existing,
    since_week,
)

METRICS = ["documents_opened", "storage_mb", "revline_total", "amount_due", "functional_amount"]
STATIC_COLUMNS = ["risk_score", "delinquency", "business_risk", "payment_rating", "line_items"]
TRAIN_STATIC = [*STATIC_COLUMNS, "lifespan_months", "days_to_churn"]
LIVE_STATIC = [*STATIC_COLUMNS, "days_elapsed", "months_elapsed"]


def weekly_features(merged: DataFrame, since: str = "2020-01-01", metrics: list[str] = METRICS) -> DataFrame:
    """One row per account and week with the weekly metrics, nothing imputed.

    The week of a row is its own week key, else the week of its date.  Of several
    rows in a week the one with the earliest date is kept.
    """
    filled = merged.withColumn("yyyywk", fill_week("yyyywk", "month"))
    rows = since_week(select_existing(filled, ["account_id", "yyyywk", "month", *metrics]).dropna(subset=["yyyywk"]), since)
    return dedupe_keep_first(rows, ["account_id", "yyyywk"], nulls_last("month")).drop("month")


def static_features(
    merged: DataFrame, columns: list[str] = TRAIN_STATIC, fill_missing: bool = True
) -> DataFrame:
    """First known value of each static column per account, in date order.

    ``fill_missing`` gives missing categories a value of their own; the live
    table leaves them NULL.
    """
    present = [c for c in columns if c in merged.columns]
    first = first_present_per_key(merged, ["account_id"], present, nulls_last("month"))
    unknown = UNKNOWN_CATEGORY if fill_missing else None
    cleaned = {c: clean_category(c, unknown) for c in ("business_risk", "payment_rating") if c in present}
    if "line_items" in present:
        items = F.coalesce("line_items", F.lit(MISSING_LIST)) if fill_missing else F.col("line_items")
        cleaned["line_items"] = F.when(items.isNotNull(), strip_counts(items))
    return first.withColumns(cleaned) if cleaned else first


def leak_guard(weekly: DataFrame, accounts: DataFrame) -> DataFrame:
    """Drop the weeks of churned accounts that lie after their churn week."""
    churn = accounts.select("account_id", F.col("churned_flag").alias("_flag"), date_to_week("churn_date").alias("_week"))
    churned = F.coalesce(F.col("_flag") == 1, F.lit(False))
    return weekly.join(churn, "account_id", "left").where(~churned | (F.col("yyyywk") <= F.col("_week"))).drop("_flag", "_week")


ROLLUP = {
    "documents_opened": ("sum", "mean", "std", "max"),
    "storage_mb": ("sum", "mean", "std", "max"),
    "revline_total": ("sum", "mean", "std"),
    "amount_due": ("sum", "mean", "std"),
    "functional_amount": ("sum", "mean", "std"),
}


def entity_rollup(weekly: DataFrame, spec: dict[str, tuple[str, ...]] = ROLLUP) -> DataFrame:
    """Per-account statistics of the weekly metrics and of the weeks themselves.

    ``usage_duration_weeks`` is the plain difference of two week keys, as model
    inputs have always had it; ``usage_duration_exact`` counts real weeks.
    """
    make = {
        "sum": lambda c: F.coalesce(F.sum(c), F.lit(0)),
        "mean": F.avg,
        "std": F.stddev_samp,
        "max": F.max,
    }
    aggs = [make[s](c).alias(f"{c}_{s}") for c, stats in spec.items() for s in stats]
    rolled = weekly.dropna(subset=["account_id"]).groupBy("account_id").agg(
        *aggs,
        F.min("yyyywk").alias("yyyywk_min"),
        F.max("yyyywk").alias("yyyywk_max"),
        F.count("yyyywk").alias("total_weeks"),
    )
    return rolled.withColumns(
        {
            "usage_duration_weeks": F.col("yyyywk_max") - F.col("yyyywk_min"),
            "usage_duration_exact": weeks_between("yyyywk_min", "yyyywk_max", exact=True),
        }
    )


def account_metadata(accounts: DataFrame) -> DataFrame:
    return select_existing(
        accounts, ["account_id", "account_name", "churned_flag", "churn_date", "segment", "segment_level"]
    ).distinct()


def training_table(static: DataFrame, rollup: DataFrame, metadata: DataFrame) -> DataFrame:
    """Static and aggregated features with the account's metadata, one row per account."""
    return static.join(rollup, "account_id", "full").join(metadata, "account_id", "left")


def feature_dataset(
    weekly: DataFrame, metadata: DataFrame, static: DataFrame | None = None, sentinel: int = 9999
) -> DataFrame:
    """Weekly rows with metadata, chosen static columns and the time left to churn.

    Active accounts get the sentinel.  Missing metrics stay missing.
    """
    meta = select_existing(metadata, ["account_id", "churned_flag", "churn_date", "segment", "segment_level"]).distinct()
    data = weekly.join(meta, "account_id", "left")
    if static is not None:
        data = data.join(static, "account_id", "left")
    data = coerce_numeric(data, METRICS)
    if "churn_date" in data.columns:
        data = data.withColumn("days_to_churn", days_to_event("churned_flag", "churn_date", "yyyywk", sentinel))
        data = data.withColumn("weeks_to_churn", F.col("days_to_churn") / F.lit(7.0))
    return data.distinct()


def canonical_usage_items(usage: DataFrame) -> DataFrame:
    return usage.withColumn("line_items", canonical_list("line_items"))
