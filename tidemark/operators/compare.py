"""Training data against live data: new accounts, shares and alerts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.relational import last_rows


def flag_new(df: DataFrame, train_keys: DataFrame, key: str = "account_id") -> DataFrame:
    """Add ``new_data``: 0 when the key is in the training set, else 1."""
    known = train_keys.select(key).dropna().distinct().withColumn("_known", F.lit(True))
    return df.join(known, key, "left").withColumn("new_data", F.when(F.col("_known"), 0).otherwise(1)).drop("_known")


def key_overlap(train: DataFrame, live: DataFrame, key: str = "account_id") -> DataFrame:
    """Distinct keys in both, only in train, only in live, and the share of live keys that are new."""
    t = train.select(key).dropna().distinct().withColumn("t", F.lit(1))
    v = live.select(key).dropna().distinct().withColumn("v", F.lit(1))
    both = t.join(v, key, "full")
    counts = both.agg(
        F.count_if(F.col("t").isNotNull() & F.col("v").isNotNull()).alias("common"),
        F.count_if(F.col("v").isNull()).alias("only_train"),
        F.count_if(F.col("t").isNull()).alias("only_live"),
    )
    live_total = F.col("common") + F.col("only_live")
    return counts.withColumn("new_rate_pct", F.coalesce(F.try_divide(F.col("only_live"), live_total) * 100, F.lit(0.0)))


def _per_account(df: DataFrame, by: list[str], key: str) -> DataFrame:
    """Rows and new rows per group and account; the distinct counts below build on it."""
    return df.groupBy(*by, key).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum("new_data").alias("_new"),
        F.count_if(F.col("new_data") == 0).alias("_train"),
    )


def compare_dataset(df: DataFrame, name: str, key: str = "account_id", digits: int = 2) -> DataFrame:
    """Records and accounts of one dataset, new and known, as one row."""
    has_flag = "new_data" in df.columns
    if not has_flag:
        df = df.withColumn("new_data", F.lit(None).cast("int"))
    base = _per_account(df, [], key).agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum("_train"), F.lit(0)).alias("train_records"),
        F.coalesce(F.sum("_new"), F.lit(0)).alias("new_records"),
        F.count(key).alias("unique_customers"),
        F.count_if((F.col("_train") > 0) & F.col(key).isNotNull()).alias("train_customers"),
        F.count_if((F.col("_new") > 0) & F.col(key).isNotNull()).alias("new_customers"),
    )

    def pct(part: str, whole: str):
        return F.coalesce(F.bround(F.try_divide(F.col(part) * 100.0, F.col(whole)), digits), F.lit(0.0))

    return base.select(
        F.lit(name).alias("dataset_name"),
        F.lit(has_flag).alias("has_new_flag"),
        "*",
        pct("train_records", "total_records").alias("train_pct"),
        pct("new_records", "total_records").alias("new_pct"),
        pct("train_customers", "unique_customers").alias("train_customers_pct"),
        pct("new_customers", "unique_customers").alias("new_customers_pct"),
    )


def compare_datasets(bundle: dict[str, DataFrame], key: str = "account_id", digits: int = 2) -> DataFrame:
    """One comparison row per dataset; shares are rounded half-even."""
    return reduce(DataFrame.unionByName, [compare_dataset(df, name, key, digits) for name, df in bundle.items()])


def overall_summary(compared: DataFrame, digits: int = 2) -> DataFrame:
    sums = compared.agg(
        F.count(F.lit(1)).alias("total_datasets"),
        F.count_if("has_new_flag").alias("datasets_with_flag"),
        F.sum("total_records").alias("total_records"),
        F.sum("train_records").alias("total_train_records"),
        F.sum("new_records").alias("total_new_records"),
    )

    def pct(part: str):
        return F.coalesce(F.bround(F.try_divide(F.col(part) * 100.0, F.col("total_records")), digits), F.lit(0.0))

    return sums.withColumns(
        {"overall_train_pct": pct("total_train_records"), "overall_new_pct": pct("total_new_records")}
    )


def compare_by(df: DataFrame, group: str, key: str = "account_id", digits: int = 2) -> DataFrame:
    """New and known rows per group value, with ratios and distinct accounts."""
    counted = (
        _per_account(df.dropna(subset=[group]), [group], key)
        .groupBy(group)
        .agg(
            F.sum("_new").alias("new_count"),
            F.sum("_rows").alias("total_count"),
            F.count(key).alias("unique_customers"),
        )
    )
    ratio = F.bround(F.col("new_count") / F.col("total_count"), digits)
    return counted.select(
        group,
        "new_count",
        "total_count",
        ratio.alias("new_ratio"),
        "unique_customers",
        (F.col("total_count") - F.col("new_count")).alias("train_count"),
        F.bround(ratio * 100, digits).alias("new_pct"),
        F.bround(100 - ratio * 100, digits).alias("train_pct"),
    )


def recent_weeks(
    df: DataFrame, n: int = 12, week: str = "yyyywk", key: str = "account_id", digits: int = 2
) -> DataFrame:
    """The comparison per week for the last ``n`` weeks."""
    return last_rows(compare_by(df, week, key, digits), week, n)


def insights(compared: DataFrame) -> DataFrame:
    """The dataset with the largest new share and the one with most records; first name on ties."""

    def leader(title: str, metric: str) -> DataFrame:
        best = F.min(F.struct((-F.col(metric)).cast("double").alias("m"), F.col("dataset_name").alias("d")))
        return compared.agg(best.alias("b")).select(
            F.lit(title).alias("insight"), F.col("b.d").alias("dataset"), (-F.col("b.m")).alias("value")
        )

    return leader("most new data", "new_pct").unionByName(leader("largest dataset", "total_records"))


def alerts(compared: DataFrame, threshold: float = 50.0) -> DataFrame:
    """Alert rows: overall new share above the threshold, and datasets without the flag."""
    high = overall_summary(compared).where(F.col("overall_new_pct") > threshold).select(
        F.lit("high_new_data").alias("alert"), F.col("overall_new_pct").cast("double").alias("value")
    )
    missing = (
        compared.agg(F.count_if(~F.col("has_new_flag")).alias("n"))
        .where(F.col("n") > 0)
        .select(F.lit("missing_flag").alias("alert"), F.col("n").cast("double").alias("value"))
    )
    return high.unionByName(missing)


def _keyed_flags(bundle: dict[str, DataFrame], key: str) -> DataFrame:
    """Lowest and highest flag per account over all datasets."""
    flags = [df.select(key, "new_data") for df in bundle.values()]
    return reduce(DataFrame.unionByName, flags).dropna(subset=[key]).groupBy(key).agg(
        F.min("new_data").alias("lo"), F.max("new_data").alias("hi")
    )


def flag_validity(bundle: dict[str, DataFrame]) -> DataFrame:
    """Rows per dataset whose flag is neither 0 nor 1."""
    rows = [
        df.agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(~F.coalesce(F.col("new_data").isin(0, 1), F.lit(False))).alias("invalid"),
        ).select(F.lit(name).alias("dataset_name"), "*")
        for name, df in bundle.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def inconsistent_accounts(bundle: dict[str, DataFrame], key: str = "account_id") -> DataFrame:
    """Accounts flagged new in one place and known in another."""
    return _keyed_flags(bundle, key).where(F.col("lo") != F.col("hi")).select(key)


def first_new_week(df: DataFrame, week: str = "yyyywk") -> DataFrame:
    return df.agg(F.min(F.when(F.col("new_data") == 1, F.col(week))).alias("first_new_week"))


def account_sources(metadata: DataFrame) -> DataFrame:
    """Accounts with segment and where they come from."""
    label = F.when(F.col("new_data") == 1, "new").otherwise("training").alias("data_source")
    return metadata.select("account_id", "account_name", "segment", label).distinct()


def account_overlap(bundle: dict[str, DataFrame], key: str = "account_id") -> DataFrame:
    """Distinct new, training, overlapping and total accounts over all datasets."""
    return _keyed_flags(bundle, key).agg(
        F.count_if(F.col("hi") == 1).alias("new_customers"),
        F.count_if(F.col("lo") == 0).alias("training_customers"),
        F.count_if((F.col("lo") == 0) & (F.col("hi") == 1)).alias("overlapping_customers"),
        F.count(F.lit(1)).alias("total_customers"),
    )


def weekly_by_flag(df: DataFrame, week: str = "yyyywk", key: str = "account_id") -> DataFrame:
    """Distinct accounts per week and flag."""
    return df.select(week, "new_data", key).distinct().groupBy(week, "new_data").agg(F.count(key).alias("customers"))


def segment_flag_pivot(metadata: DataFrame) -> DataFrame:
    grid = metadata.groupBy("segment").pivot("new_data", [0, 1]).agg(F.count(F.lit(1)))
    return grid.fillna(0, ["0", "1"]).withColumnsRenamed({"0": "train", "1": "new"})
