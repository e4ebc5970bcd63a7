import datetime as dt
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import activity, churn, compare, features, merge, quality, trend
from tidemark.operators import relational as R
from tidemark.operators.activity import histogram, readiness, weekly_active, weekly_metric_stats
from tidemark.plans.inputs import START, Inputs
from tidemark.plans.runs import live_load, training_load
from tidemark.sources import files, schemas, tables
from tidemark.streaming import weekly
from tests.conftest import rows

DAY = dt.date(2020, 1, 1)


def test_first_known_value_per_column(spark):
    df = spark.createDataFrame(
        [(1, 10, "a,b", None, 5), (1, 10, "a,b,c", 7, None), (1, 10, "z", 1, 1), (2, 10, None, 3, 4), (None, 10, "x", 1, 1)],
        "k int, w int, items string, a int, b int",
    )
    assert rows(R.dedupe_most_complete(df, ["k", "w"], "items")) == [(1, 10, "a,b,c", 7, 5), (2, 10, None, 3, 4)]
    assert rows(R.dedupe_most_complete(df, ["k", "w"], "items", mode="row")) == [(1, 10, "a,b,c", 7, None), (2, 10, None, 3, 4)]


def test_equal_lengths_have_one_answer(spark):
    df = spark.createDataFrame([(1, 1, "b", 2), (1, 1, "a", 3)], "k int, w int, items string, v int")
    for parts in (1, 2, 5):
        assert rows(R.dedupe_most_complete(df.repartition(parts), ["k", "w"], "items")) == [(1, 1, "a", 3)]


def test_full_outer_joins_match_missing_dates(spark):
    a = spark.createDataFrame([(1, None, 5), (1, DAY, 6)], "k int, d date, x int")
    b = spark.createDataFrame([(1, None, 7), (2, DAY, 8)], "k int, e date, y int")
    got = rows(R.full_outer_coalesce(a, b, "k", "d", "e").select("k", "d", "x", "y"))
    assert got == [(1, None, 5, 7), (1, DAY, 6, None), (2, DAY, None, 8)]
    both = R.full_outer_by_date([a, b.withColumnRenamed("e", "d")], "k", "d")
    assert rows(both.select("k", "d", "x", "y")) == got


def test_sums_ignore_null_keys_and_read_missing_as_zero(spark):
    df = spark.createDataFrame([(1, DAY, None), (None, DAY, 3.0), (2, DAY, 1.0), (2, DAY, 2.0), (3, None, 1.0)], "k int, d date, m double")
    assert rows(merge.sum_by_key_date(df, "k", "d")) == [(1, DAY, 0.0), (2, DAY, 3.0)]
    assert rows(merge.sum_by_key_date(df.select("k", "d"), "k", "d")) == [(1, DAY, 1), (2, DAY, 2)]


def naive_merge(b, since):
    """The chain of joins, one after the other."""
    acc = b.account.select("account_id").distinct()
    t = merge.dated_sums(b.payment, acc, "customer_no", "receipt_date", ["functional_amount"])
    for part in (
        merge.dated_sums(b.revenue, acc, "account_id", "invoice_date", ["revline_total"]),
        merge.dated_sums(b.txn, acc, "account_number", "trx_date", ["amount_due"]),
    ):
        t = t.join(part, ["account_id", "month"], "full")
    lines = R.keep_known(b.contract_line.select("account_id", "line_start").distinct(), "account_id", acc)
    t = R.full_outer_coalesce(t, lines, "account_id", "month", "line_start")
    cover = merge.bounds(R.keep_known(b.renewal.distinct(), "bill_to", acc), "account_id", "coverage_start", "coverage_end", "renewal")
    t = t.join(cover.withColumn("coverage_start", F.col("renewal_earliest")), "account_id", "left")
    t = t.join(R.keep_known(b.risk.distinct(), "account_number", acc), "account_id", "left")
    u = R.keep_known(merge.clean_usage(b.usage, since), "account_id", acc).withColumn("usage_month", merge.week_midpoint("yyyywk"))
    return R.full_outer_coalesce(t, u, "account_id", "month", "usage_month")


def test_single_grouping_equals_the_chain_of_joins(spark, tiny):
    b = Inputs(spark, tiny).bundle
    fast = merge.merge_sources(b, START)
    slow = naive_merge(b, START)
    common = [c for c in fast.columns if c in slow.columns]
    assert len(common) > 20
    rounded = [F.round(c, 3).alias(c) if c in ("functional_amount", "revline_total", "amount_due") else F.col(c) for c in common]
    assert fast.count() == slow.count()
    assert fast.select(*rounded).exceptAll(slow.select(*rounded)).count() == 0


def test_every_renewal_mode_changes_no_later_result(spark, tiny):
    b = Inputs(spark, tiny).bundle
    once, each = merge.merge_sources(b, START), merge.merge_sources(b, START, renewals="rows")
    assert each.count() > once.count()
    weekly = [features.weekly_features(m, START).select("account_id", "yyyywk", "documents_opened", "storage_mb") for m in (once, each)]
    assert weekly[0].exceptAll(weekly[1]).count() == 0 and weekly[1].exceptAll(weekly[0]).count() == 0
    static = [features.static_features(m) for m in (once, each)]
    assert static[0].exceptAll(static[1]).count() == 0
    assert weekly[0].groupBy("account_id", "yyyywk").count().where("count > 1").count() == 0


def test_rows_per_renewal_carry_no_text_and_meet_once(spark, tiny):
    """An account with many renewals, some of one start: as many rows as its days and starts; counting them shuffles no text."""
    b = Inputs(spark, tiny).bundle
    account = b.renewal.first()["bill_to"]
    more = spark.range(300).select(F.lit(account).alias("bill_to"), F.date_add(F.lit(DAY), (F.col("id") % 200).cast("int")).alias("coverage_start"),
                                   F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("coverage_end"))
    b = replace(b, renewal=b.renewal.union(more))
    once, each = merge.merge_sources(b, START), merge.merge_sources(b, START, renewals="rows")
    dated = F.coalesce("receipt_date", "invoice_date", "trx_date", "line_start").isNotNull()
    starts = b.renewal.groupBy("bill_to").agg(F.count_distinct("coverage_start").alias("n")).withColumnRenamed("bill_to", "account_id")
    want = once.join(starts, "account_id", "left").select("account_id", "final_earliest_date", F.when(dated, F.coalesce("n", F.lit(1))).otherwise(1).alias("n"))
    want = want.groupBy("account_id").agg(F.sum("n").alias("rows"), F.min("final_earliest_date").alias("earliest"))
    got = each.groupBy("account_id").agg(F.count(F.lit(1)).alias("rows"), F.min("final_earliest_date").alias("earliest"))
    assert rows(got) == rows(want) and each.distinct().count() == each.count()
    few = merge.merge_sources(Inputs(spark, tiny).bundle, START, renewals="rows").groupBy("account_id").count()
    assert "line_items" not in few._jdf.queryExecution().executedPlan().toString()


def odd_bundle(spark):
    """A repeated account; unknown and missing keys and dates; repeated facts; weeks that cannot be read."""
    other = dt.date(2020, 2, 3)
    make = spark.createDataFrame
    return merge.Bundle(
        make([(1, 1, dt.date(2020, 3, 1)), (1, 1, dt.date(2020, 3, 1)), (2, 0, None)], "account_id long, churned_flag int, churn_date date"),
        make([(1, MEETS, 5.0, 7), (1, MEETS, 5.0, 7), (1, MEETS, float("nan"), 8), (9, MEETS, 1.0, 9), (None, MEETS, 1.0, 9), (1, None, 1.0, 9)], "customer_no long, receipt_date date, functional_amount double, id long"),
        make([(1, MEETS, 2.0), (1, other, 3.0)], "account_id long, invoice_date date, revline_total double"),
        make([(2, other, 4.0)], "account_number long, trx_date date, amount_due double"),
        make([(1, None, None, "O"), (1, None, DAY, "O"), (1, other, None, "O"), (None, DAY, None, "O")], "account_id long, line_start date, line_end date, line_status string"),
        make([(1, dt.date(2019, 1, 1), DAY), (1, dt.date(2019, 5, 1), MEETS)], "bill_to long, coverage_start date, coverage_end date"),
        make([(1, 0.5, "LOW"), (2, 0.25, None)], "account_number long, risk_score double, business_risk string"),
        make(
            [(1, 202002, MEETS, "b,a", None, 3, None), (1, 202002, MEETS, "c", None, 9, 4), (1, 202077, MEETS, "x", None, 1, 1), (1, 202088, MEETS, "y", None, 2, 2),
             (2, 202010, MEETS, None, None, 6, 6), (9, 202002, MEETS, "z", None, 1, 1), (None, 202002, MEETS, "z", None, 1, 1), (2, 202011, DAY.replace(1990), "old", None, 1, 1)],
            "account_id long, yyyywk int, contract_start date, line_items string, churn_date date, documents_opened long, contract_number long",
        ),
        make([(1, 202002)], "account_id long, yyyywk int"),
    )


MEETS = dt.date(2020, 1, 8)  # the Wednesday of 202002


@pytest.mark.parametrize("written", [False, True])
def test_merge_of_odd_rows(spark, written):
    """Each day of a known account is one row; usage meets its day, usage of an unreadable week and lines without a day meet nothing."""
    other, first = dt.date(2020, 2, 3), dt.date(2019, 1, 1)
    got = merge.merge_sources(odd_bundle(spark), START, written=written)
    assert not {"contract_number", "contract_end", "_dated"} & set(got.columns)
    shown = ["account_id", "month", "functional_amount", "revline_total", "amount_due", "receipt_date", "line_start", "yyyywk", "usage_month", "line_items", "documents_opened", "coverage_start", "risk_score", "final_earliest_date"]
    assert rows(got.select(*shown)) == sorted([
        (1, MEETS, 5.0, 2.0, None, MEETS, None, 202002, MEETS, "a,b", 3, first, 0.5, first),
        (1, other, None, 3.0, None, None, other, None, None, None, None, first, 0.5, first),
        (1, None, None, None, None, None, None, None, None, None, None, first, 0.5, first),
        (1, None, None, None, None, None, None, 202077, None, "x", 1, None, None, first),
        (1, None, None, None, None, None, None, 202088, None, "y", 2, None, None, first),
        (2, other, None, None, 4.0, None, None, None, None, None, None, None, 0.25, other),
        (2, dt.date(2020, 3, 4), None, None, None, None, None, 202010, dt.date(2020, 3, 4), "", 6, None, None, other),
    ], key=lambda t: [(v is not None, str(type(v)), v) for v in t])


def test_stacked_sources_are_shuffled_once(spark, tiny):
    """Between the cleaned usage and the merge lies one exchange."""
    plan = merge.merge_sources(Inputs(spark, tiny).bundle, START, written=True)._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    scan = next(i for i, line in enumerate(plan) if "FileScan" in line and "line_items" in line)
    above, least = [], depth[scan]
    for i in range(scan, -1, -1):
        if depth[i] < least:
            above, least = [*above, plan[i]], depth[i]
    assert sum("Exchange" in line for line in above) == 1


def test_a_load_writes_what_its_table_is_made_of(spark, tiny):
    """A load of weekly tables writes no texts; its tables are those of the whole load."""
    for load, names in ((training_load, ("weekly", "static")), (live_load, ("features", "table"))):
        whole = load(Inputs(spark, tiny).bundle, START)
        for name in names:
            part = load(Inputs(spark, tiny).bundle, START, tables=[name])
            assert ("line_items" in part.merged.columns) == (name in ("static", "table"))
            a, b = getattr(whole, name), getattr(part, name)
            summed = [F.round(c, 3).alias(c) if t == "double" else F.col(c) for c, t in a.dtypes]
            a, b = a.select(*summed), b.select(*summed)
            assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_no_week_after_the_churn_week(spark):
    weekly = spark.createDataFrame([(1, 202001), (1, 202002), (1, 202003), (2, 202010), (3, 202010), (4, 202010)], "account_id long, yyyywk int")
    acc = spark.createDataFrame([(1, 1, dt.date(2020, 1, 8)), (2, 0, None), (3, None, None), (4, 1, None)], "account_id long, churned_flag int, churn_date date")
    assert rows(features.leak_guard(weekly, acc)) == [(1, 202001), (1, 202002), (2, 202010), (3, 202010)]


def test_single_week_accounts_have_no_deviation(spark):
    weekly = spark.createDataFrame([(1, 202001, 5)], "account_id long, yyyywk int, docs int")
    r = features.entity_rollup(weekly, {"docs": ("sum", "std")}).first()
    assert r["docs_sum"] == 5 and r["docs_std"] is None and r["usage_duration_weeks"] == 0


def test_duration_across_years(spark):
    weekly = spark.createDataFrame([(1, 202052, 1), (1, 202101, 1)], "account_id long, yyyywk int, docs int")
    r = features.entity_rollup(weekly, {"docs": ("sum",)}).first()
    assert r["usage_duration_weeks"] == 49 and r["usage_duration_exact"] == 2


def test_empty_months_count_as_zero(spark):
    acc = spark.createDataFrame(
        [(1, 1, dt.date(2020, 1, 5)), (2, 1, dt.date(2020, 4, 5)), (3, 0, None)], "account_id long, churned_flag int, churn_date date"
    )
    filled = churn.fill_months(churn.monthly_churn(acc))
    assert [r[1] for r in rows(filled)] == [1, 0, 0, 1]
    s = churn.monthly_churn_stats(acc).first()
    assert s["monthly_churn_mean"] == 0.5 and s["monthly_churn_std"] == pytest.approx(np.std([1, 0, 0, 1], ddof=1))
    dist = churn.churn_distribution(acc).first()
    assert dist["std_churns_per_month"] == 0.0 and dist["total_months"] == 2 and dist["peak_churn_month"] == "2020-01"


def test_period_averages_count_churns(spark):
    acc = spark.createDataFrame(
        [(100, 1, dt.date(2020, 1, 5)), (200, 1, dt.date(2020, 1, 6)), (300, 1, dt.date(2021, 1, 5))], "account_id long, churned_flag int, churn_date date"
    )
    assert rows(churn.churn_by_month_of_year(acc)) == [(1, "January", 3, 1.5)]


def test_all_null_weeks_are_left_out(spark):
    df = spark.createDataFrame([(202001, None), (202001, None), (202002, 3.0), (202002, None)], "yyyywk int, m double")
    assert rows(weekly_metric_stats(df, "m")) == [(202002, 3.0, 3.0, 1)]


def test_active_accounts_count_once(spark):
    df = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (1, 2, 1), (1, None, 0), (2, 2, 1)], "yyyywk int, account_id int, churned_flag int")
    assert rows(weekly_active(df)) == [(1, 1), (2, 0)]


def test_histogram_of_one_value_and_of_edges(spark):
    same = spark.createDataFrame([(2.0,)] * 5, "v double")
    assert [(r["bin"], r["n"]) for r in histogram(same, "v", 4).collect()] == [(0, 5)]
    edge = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (4.0,)], "v double")
    assert {r["bin"]: r["n"] for r in histogram(edge, "v", 4).collect()} == {0: 1, 1: 1, 2: 1, 3: 1}


def test_missing_inputs_are_not_ready(spark):
    weekly = spark.createDataFrame([(1, 202001)], "account_id int, yyyywk int")
    assert {r["criterion"]: r["status"] for r in readiness({"weekly": weekly}).collect()} == {
        "time series data": "READY", "customer metadata": "NOT READY", "feature data": "NOT READY", "time coverage": "NOT READY", "data volume": "NOT READY",
    }


# --- trend -------------------------------------------------------------------------------


def slow_lowess(x, y, frac, iters):
    """One point at a time, by weighted least squares."""
    n, k = len(x), int(frac * len(x) + 1e-10)
    fit, robust = y.astype(float), np.ones(len(x))
    for _ in range(iters + 1):
        fit = np.empty(n)
        for i in range(n):
            near = np.sort(np.argsort(np.abs(x - x[i]), kind="stable")[:k])
            h = np.abs(x[near] - x[i]).max()
            u = np.abs(x[near] - x[i]) / h
            w = np.where(u < 0.999, (1 - u**3) ** 3, 0) * robust[near]
            if w.sum() <= 0:
                fit[i] = y[i]
                continue
            c, s = np.average(x[near], weights=w), np.average(y[near], weights=w)
            var = np.average((x[near] - c) ** 2, weights=w)
            slope = np.average((x[near] - c) * (y[near] - s), weights=w) / max(var, 1e-12)
            fit[i] = s + slope * (x[i] - c)
        r = np.abs(y - fit)
        r = r / (6 * np.median(r))
        robust = np.where(r <= 0.001, 1, np.where(r < 0.999, (1 - r**2) ** 2, 0))
    return fit


def test_smoothing_against_the_slow_form():
    rng = np.random.default_rng(1)
    x = np.sort(rng.random(60) * 10)
    y = np.sin(x) + rng.normal(scale=0.2, size=60)
    y[10] = 9
    assert np.abs(trend.lowess_fit(x, y) - slow_lowess(x, y, 0.3, 3)).max() < 1e-6


def test_smoothing_of_short_and_straight_series(spark):
    assert list(trend.lowess_fit(np.array([0.0, 1.0]), np.array([5.0, 1.0]))) == [5.0, 1.0]
    x = np.arange(30.0)
    assert np.abs(trend.lowess_fit(x, 2 * x + 1) - (2 * x + 1)).max() < 1e-9
    df = spark.createDataFrame([("a", float(i), float(i * i)) for i in range(20)] + [("b", 0.0, 1.0)], "s string, x double, y double")
    out = trend.lowess(df, ["s"], "x", "y")
    assert out.count() == 21 and out.where("s = 'b'").first()["smoothed"] == 1.0


def points(spark, ys):
    return spark.createDataFrame([("s", i, float(y)) for i, y in enumerate(ys)], "s string, x int, y double")


def test_turning_points_and_edges(spark):
    up_down = points(spark, [0, 1, 2, 3, 4, 3, 2, 1, 0])
    assert [(r["i"], r["change"]) for r in trend.inflections(up_down, ["s"], "x", "y").collect()] == [(5, "growth_to_decline")]
    first = trend.smoothed_derivative(points(spark, [0, 3, 3, 3, 3, 3]), ["s"], "x", "y").where("x = 1").first()
    assert first["smoothed_slope"] == pytest.approx((3 + 3 + 0) / 3)
    assert trend.inflections(points(spark, [0, 1, 0, 1]), ["s"], "x", "y").count() == 0


@pytest.mark.parametrize(
    "ys,status",
    [([0, 1, 2, 3, 4, 5, 6, 7, 8, 9], "increasing"), ([9, 8, 7, 6, 5, 4, 3, 2, 1, 0], "decreasing"), ([5] * 10, "stable"),
     ([1], "stable"), ([0, 4, 8, 12, 6, 2, 8, 14, 20, 26, 32, 38], "mixed")],
)
def test_health(spark, ys, status):
    assert trend.trend_health(points(spark, ys), ["s"], "x", "y").first()["status"] == status


def test_status_in_both_senses(spark):
    falling = points(spark, [10, 9, 8, 7, 6, 5])
    assert trend.recent_status(falling, ["s"], "x", "y").first()["status"] == "alarm"
    assert trend.recent_status(falling, ["s"], "x", "y", inverse=True).first()["status"] == "ok"
    assert trend.recent_alarm(falling, ["s"], "x", "y").first()["alarm"] == "declining"
    assert trend.recent_direction(falling, ["s"], "x", "y").first()["direction"] == "decreasing"


# --- quality, schemas, files -----------------------------------------------------------------


def test_kinds_of_columns(spark):
    df = spark.createDataFrame(
        [(f"{i}", f"{i}.5", "Yes" if i % 2 else "no", f"2020-01-{i + 1:02d}", f"t{i}", i % 3, float(i), None, True) for i in range(12)],
        "ints string, floats string, yn string, day string, txt string, three int, whole double, none string, yes boolean",
    )
    kinds = {r["column"]: (r["kind"], r["type"]) for r in quality.infer_types(df).collect()}
    assert kinds == {
        "ints": ("cat_high_card(12)", "int"), "floats": ("num", "float"), "yn": ("bin", "bool"), "day": ("datetime", "datetime"),
        "txt": ("cat_high_card(12)", "str"), "three": ("cat_int(3)", "int"), "whole": ("int", "int"), "none": ("str", "str"), "yes": ("str(1)", "bool"),
    }


def test_accumulators_send_one_row_per_task(spark):
    """Forms, ends and counts over odd values; numeric and date tests shuffle a row per task, and no text groups."""
    texts = ["1", "2.5", " 3 ", "x", "2020-01-01", "latest 2020", "", None, "1e999", "z" * 500, "z" * 500 + "a", "NaN"]
    df = spark.createDataFrame([(t, float("nan") if t == "x" else 2.0, "Yes" if i % 2 else "no", "long " * 100 + str(i % 2)) for i, t in enumerate(texts)], "t string, f double, yn string, two string")
    facts = {r["column"]: r for r in quality.column_facts(df).collect()}
    assert facts["t"]["n_unique"] == 11 and facts["t"]["missing"] == 1 and facts["t"]["date_rows"] == 1 and facts["t"]["forms"] == 15
    assert facts["f"]["n_unique"] == 2 and not facts["f"]["all_numeric"] and facts["yn"]["low"] == "no"
    assert rows(quality.binary_pairs(df).select("column", "is_binary")) == [("f", False), ("two", False), ("yn", True)]
    assert rows(quality.binary_pairs(df.limit(1))) == []
    found = {r["column"]: r["samples"] for r in quality.profile(df).collect()}
    assert found["two"] == " | ".join("long " * 100 + k for k in "01")
    assert found["t"].split(" | ") == sorted(t for t in texts if t is not None)[:10]
    big = spark.range(100_000).repartition(6).select(F.concat(F.lit("k"), "id").alias("text"))
    for report in (quality.numeric_text, quality.date_pattern_share):
        plan = report(big)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange SinglePartition") == 1 and "hashpartitioning" not in plan
    assert quality.infer_types(df.where("false")).count() == 0


def test_optional_types_are_enforced(spark):
    schema = {"fields": {"a": {"type": "Optional[int]", "required": False}, "f": {"type": "int", "validator": "bool_to_int", "required": True}}}
    df = spark.createDataFrame([("7", "Y", "k"), ("x", None, "k")], "a string, f string, other string")
    assert rows(schemas.enforce_schema(df, schema)) == [(None, None, "k"), (7, 1, "k")]
    assert quality.validate(df, schema).first()["invalid_rows"] == 1
    found = quality.infer_schema(df)
    assert schemas.enforce_schema(df, found).schema["a"].dataType.simpleString() == "string"
    with pytest.raises(ValueError):
        schemas.schema_rules({"a": "int64"})


def test_schema_lookup(tmp_path):
    for folder in ("raw", "join_rules"):
        (tmp_path / folder).mkdir()
    (tmp_path / "join_rules" / "t_schema.json").write_text('{"fields": {}}')
    assert schemas.find_schema("t", str(tmp_path), "raw").endswith("join_rules/t_schema.json")
    (tmp_path / "raw" / "t_schema.json").write_text('{"fields": {}}')
    path = schemas.find_schema("t", str(tmp_path), "raw")
    assert path.endswith("raw/t_schema.json") and schemas.load_schema(path) == {"fields": {}}
    assert schemas.find_schema("t", str(tmp_path), "join_rules").endswith("join_rules/t_schema.json")
    assert schemas.find_schema("t", str(tmp_path), override=path) == path
    with pytest.raises(FileNotFoundError):
        schemas.find_schema("absent", str(tmp_path))


def test_csv_reading(spark, tmp_path):
    (tmp_path / "one.csv").write_text(',a,b\n0,1,x\n1,,"y, z"\n')
    (tmp_path / "two.csv").write_text("c\n5\n")
    (tmp_path / "empty.csv").write_text("")
    got, failed = files.read_csv_dir(spark, str(tmp_path))
    assert sorted(got) == ["one", "two"] and failed == ["empty"]
    assert rows(got["one"]) == [(None, "y, z"), ("1", "x")]
    assert rows(files.read_csv_described(spark, str(tmp_path / "one.csv"), "(+) a\n(-) b")) == [(None,), (1.0,)]
    assert files.keep_list("(=) total a\n(+) c\nno mark b", ["a", "b", "c", "d"]) == ["a", "c"]


def test_folder_of_written_csvs(spark, tmp_path):
    """Folders of parts count as CSVs, one folder name inside another too; a schema put down by Spark is found and read."""
    folder = str(tmp_path / "csv" / "csv")
    files.write_csv(spark.range(3), f"{folder}/three rows.csv")
    files.write_csv(spark.range(2).repartition(2), f"{folder}/csv.csv")
    spark.range(0).coalesce(1).write.csv(f"{folder}/broken.csv")
    got, failed = files.read_csv_dir(spark, folder)
    assert {n: df.count() for n, df in got.items()} == {"three rows": 3, "csv": 2} and failed == ["broken"]
    schemas.save_schema(spark, {"fields": {"a": {"type": "int"}}}, f"{folder}/raw/t_schema.json")
    assert schemas.load_schema(schemas.find_schema("t", f"file://{folder}", "join_rules")) == {"fields": {"a": {"type": "int"}}}


def test_bitmaps_count_as_distinct(spark):
    data = [(k % 3, k * 7919 % 100_000, int(k % 5 == 0)) for k in range(3000)] + [(0, None, 0), (None, 1, 0), (1, 5, None), (2, -4, 0), (2, -4, 0)]
    df = spark.createDataFrame(data, "yyyywk int, account_id long, churned_flag int")
    want = {w: len({k for x, k, f in data if x == w and f == 0 and k is not None}) for w in (0, 1, 2)}
    bitmaps = activity.active_bitmaps(df)
    assert {r["period"]: r["active_customers"] for r in activity.active_per_period(bitmaps, F.col("yyyywk")).collect()} == want
    every = len({k for w, k, f in data if w is not None and f == 0 and k is not None})
    assert activity.active_per_period(bitmaps, F.lit(1)).first()["active_customers"] == every
    assert activity.active_bitmaps(df.limit(0)).count() == 0


def test_stream_closes_weeks_and_leaves_late_rows_out(spark, tmp_path):
    events, table, state = (str(tmp_path / n) for n in ("events", "table", "state"))

    def arrive(*data):
        spark.createDataFrame(data, "ts timestamp, user_id long, value double").coalesce(1).write.mode("append").parquet(events)

    def run():
        weekly.drain(weekly.weekly_blocks(weekly.event_stream(spark, events)), table, state)
        return rows(weekly.weekly_activity(spark.read.schema("week date, bucket long, bits binary, events long, total double").parquet(table)))

    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    arrive((day(1), 1, 1.0), (day(7, 23), 40_000, 2.0), (day(3), 1, 4.0), (day(3), None, 8.0), (None, 9, 1.0), (day(8), 1, 1.0))
    assert run() == []
    arrive((day(2), 2, 16.0), (day(10), 2, 1.0))
    first = (dt.date(2024, 1, 1), 5, 31.0, 3)
    assert run() == [first]
    arrive((day(5), 3, 100.0), (day(9), 3, 1.0))
    assert run() == [first]
    arrive((day(20), 3, 1.0))
    assert run() == [first, (dt.date(2024, 1, 8), 3, 3.0, 3)]
    assert run() == [first, (dt.date(2024, 1, 8), 3, 3.0, 3)]


def test_failed_exports_are_listed(spark, tmp_path):
    good = spark.range(3)
    bad = spark.range(3).select(F.raise_error(F.lit("no")).alias("x"))
    done, failed = files.export_many({"good": good, "bad": bad}, str(tmp_path))
    assert list(done) == ["good"] and list(failed) == ["bad"]


def test_scan_options(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    assert [r["k"] for r in tables.scan(spark, df, ["k"], "k > 1", ["k desc"], 1).collect()] == [3]
    assert tables.scan(spark, df, "*", limit=0).count() == 3


def test_flags_against_training_keys(spark):
    live = spark.createDataFrame([(1,), (2,), (2,), (None,)], "account_id long")
    flagged = compare.flag_new(live, spark.createDataFrame([(1,), (1,)], "account_id long"))
    assert rows(flagged) == [(None, 1), (1, 0), (2, 1), (2, 1)]
    r = compare.compare_dataset(flagged, "live").first()
    assert (r["total_records"], r["new_records"], r["unique_customers"], r["new_customers"]) == (4, 3, 2, 1)
    assert compare.alerts(compare.compare_datasets({"live": flagged, "other": live}), 30.0).count() == 2


def test_sums_take_nan_as_missing(spark):
    from tidemark.operators.merge import sum_by_key_date

    df = spark.createDataFrame([("a", "d", 1.0), ("a", "d", float("nan")), ("b", "d", float("nan"))], "k string, d string, v double")
    assert rows(sum_by_key_date(df, "k", "d")) == [("a", "d", 1.0), ("b", "d", 0.0)]


def test_retention_holds_after_a_repeated_run(spark, tmp_path):
    import datetime

    from tidemark.sources.files import append_with_retention

    path, day = str(tmp_path / "store"), datetime.date
    old = spark.createDataFrame([(1, day(2024, 1, 1)), (2, day(2024, 5, 1))], "n int, d date")
    append_with_retention(old, path, "d", "2024-01-01")
    new = spark.createDataFrame([(3, day(2024, 6, 1))], "n int, d date")
    for _ in range(2):
        got = append_with_retention(new, path, "d", "2024-06-01")
        assert rows(got) == [(2, day(2024, 5, 1)), (3, day(2024, 6, 1))]
        assert spark.read.parquet(path).count() == 2


def test_all_numeric_columns_are_reported(spark):
    from tidemark.operators.quality import query_profile
    from tidemark.operators.relational import metric_columns

    df = spark.range(3).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(14)])
    assert metric_columns(df, ["c7"], ("c0",)) == ["c7", *[f"c{i}" for i in range(1, 14) if i != 7]]
    assert metric_columns(df, ["c7"], ("c0",), 2) == ["c7", "c1"]
    assert query_profile(df).count() == 14
    assert query_profile(df, 3).count() == 3
