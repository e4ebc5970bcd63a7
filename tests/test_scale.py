import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import match, scale, split
from tidemark.operators.activity import quantile_stats
from tidemark.plans.inputs import Inputs
from tidemark.plans.runs import live_load, training_load
from tidemark.sources import tables
from tests.conftest import rows
from tests.test_functions import plain_similarity

SHAPES = {
    "one hot value": lambda rng: np.where(rng.random(3000) < 0.4, 7.0, rng.normal(size=3000)),
    "wild range": lambda rng: np.exp(rng.normal(scale=20, size=3000)) * rng.choice([-1, 1], 3000),
    "packed": lambda rng: 1e9 + rng.random(3000) * 1e-3,
    "whole": lambda rng: rng.integers(-50, 50, 3000).astype(float),
    "constant": lambda rng: np.full(100, 3.5),
}


@pytest.mark.parametrize("shape", list(SHAPES))
def test_quantiles_are_exact(spark, shape):
    values = SHAPES[shape](np.random.default_rng(3))
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    probs = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.67, "e": 1.0}
    got = scale.exact_quantiles(df, "v", probs).first()
    for name, p in probs.items():
        assert got[name] == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_quantiles_with_infinities(spark):
    inf = float("inf")
    for values in ([1.0, 2.0, inf], [-inf, -inf, 3.0, inf], [inf, inf], [-1e308, 1e308, inf]):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        got = scale.exact_quantiles(df, "v", {"lo": 0.0, "mid": 0.5, "hi": 1.0}).first()
        middle = values[len(values) // 2] if len(values) % 2 else (values[0] if values[0] == values[1] else None)
        assert (got["lo"], got["hi"]) == (values[0], values[-1])
        assert middle is None or len(values) == 4 or got["mid"] == middle


def test_quantiles_by_group_with_a_hot_group(spark):
    rng = np.random.default_rng(4)
    data = [("hot", float(v)) for v in rng.normal(size=4000)] + [(f"g{i % 50}", float(i)) for i in range(2000)] + [(None, 1.0)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r["g"]: r["median"] for r in quantile_stats(df, "v", ["g"]).collect()}
    assert set(got) == {g for g, _ in data if g is not None}
    for g in ("hot", "g0", "g49"):
        assert got[g] == pytest.approx(np.median([v for k, v in data if k == g]), rel=1e-12)


def test_ranked_values_match_a_running_count(spark):
    rng = np.random.default_rng(8)
    values = np.round(np.exp(rng.normal(scale=4, size=2000)), 3)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    for r in scale.ranked_values(df, "v").collect():
        assert r["before"] == int((values < r["v"]).sum()) and r["n"] == int((values == r["v"]).sum()) and r["total"] == 2000


def test_exactly_k_rows_are_marked(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), F.when(F.col("id") < 4000, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 3).cast("string"))).alias("g"))
    wanted = spark.createDataFrame([("hot", 1234), ("g0", 0), ("g1", 1), ("g2", 333)], "g string, k long")
    marked = scale.mark_lowest(df, ["g"], "k", wanted, seed=7)
    counts = {r["g"]: r["n"] for r in marked.groupBy("g").agg(F.count_if("picked").alias("n")).collect()}
    assert counts == {"hot": 1234, "g0": 0, "g1": 1, "g2": 333}
    again = scale.mark_lowest(df.repartition(13), ["g"], "k", wanted, seed=7)
    assert rows(again.where("picked").select("k")) == rows(marked.where("picked").select("k"))
    other = scale.mark_lowest(df, ["g"], "k", wanted, seed=8)
    assert rows(other.where("picked").select("k")) != rows(marked.where("picked").select("k"))


def test_group_stats_reach_every_row(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2), (None, 9)], "k string, v int")
    assert rows(scale.attach_group_stats(df, ["k"], top=F.max("v"))) == [(None, 9, None), ("a", 1, 3), ("a", 3, 3), ("b", 2, 2)]


def test_hot_keys_fan_out_over_parts(spark):
    """A key with a third of all rows and a thousand partners: the same rows as a plain join, in tasks of bounded output."""
    left = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"), (F.col("id") % 7 > 0).alias("seeks"))
    left = left.unionByName(spark.createDataFrame([(None, -1, True), (None, -2, False)], "k long, v long, seeks boolean"))
    right = spark.range(3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("w"))
    got = scale.fan_out_join(left, right, "k", F.col("seeks"), pairs_per_part=100_000)
    r = right.withColumnRenamed("k", "rk")
    want = left.join(r, (F.col("k") == F.col("rk")) & F.col("seeks"), "left").drop("rk")
    assert got.columns == want.columns and got.count() == want.count()
    assert got.exceptAll(want).count() == 0
    assert scale.fan_out_join(left, right.limit(0), "k").count() == left.count()
    parts = left.where("k = 0 and seeks").count() * 1000 // 100_000
    tasks = got.where("k = 0").groupBy(F.spark_partition_id()).count().collect()
    assert parts > 20 and len(tasks) > 1


def names(n, seed, alphabet="abcdefg "):
    rng = np.random.default_rng(seed)
    base = ["".join(rng.choice(list(alphabet), rng.integers(1, 16))) for _ in range(n)]
    out = list(base)
    for b in base:
        chars = list(b)
        for _ in range(rng.integers(0, 3)):
            i = rng.integers(0, len(chars))
            chars[i] = rng.choice(list(alphabet))
        if rng.random() < 0.4 and len(chars) > 2:
            i = rng.integers(0, len(chars) - 1)
            chars[i], chars[i + 1] = chars[i + 1], chars[i]
        out.append("".join(chars) + ("s" if rng.random() < 0.3 else ""))
    return sorted(set(out))


@pytest.mark.parametrize(
    "seed,least,widths", [(1, 93, match.KEY_WIDTHS), (2, 93, (4, 3, 3, 2, 2)), (3, 88, match.KEY_WIDTHS), (4, 93, (1, 1, 1, 1, 1))]
)
def test_fuzzy_join_loses_no_pair(spark, seed, least, widths):
    left, right = names(150, seed), names(150, seed) + names(60, seed + 10)
    l = spark.createDataFrame([(x,) for x in left], "l_name string")
    r = spark.createDataFrame([(x,) for x in sorted(set(right))], "r_name string")
    got = {(x["l_name"], x["r_name"]): x["score"] for x in match.fuzzy_pairs(l, r, least, widths=widths).collect()}
    want = {}
    for a in left:
        for b in set(right):
            s = int(np.floor(plain_similarity(a, b) * 100 + 1e-9))
            if s >= least:
                want[(a, b)] = s
    assert got == want and len(want) > 100


def test_dense_keys_are_cut_into_tiles(spark):
    """Names of one rare character: tiles of any size find the same pairs, and no tile holds many more names than it should."""
    left = [f"zeta {k:03d}" for k in range(120)]
    right = [f"zeta {k:03d}s" for k in range(140)]
    l = spark.createDataFrame([(x,) for x in left], "l_name string")
    r = spark.createDataFrame([(x,) for x in right], "r_name string")
    want = {(a, b) for a in left for b in right if int(np.floor(plain_similarity(a, b) * 100 + 1e-9)) >= 93}
    for tile in (7, 64, match.TILE):
        got = match.fuzzy_pairs(l, r, 93, tile=tile).collect()
        assert len(got) == len(want) and {(x["l_name"], x["r_name"]) for x in got} == want
    keyed = spark.range(5000).select(F.concat(F.lit("n"), "id").alias("name"), (F.col("id") % 2 == 0).alias("is_right"), F.lit("hot").alias("key"))
    sizes = match.tiles(keyed, 500).groupBy("lt", "rt", "is_right").count()
    per_tile = [r["count"] for r in sizes.collect()]
    assert len(per_tile) == 2 * 25 and max(per_tile) < 700
    assert match.tiles(keyed.where("is_right"), 500).count() == 0


def test_best_matches_keep_ties_and_exact_names(spark):
    left = spark.createDataFrame([(1, "acme tools"), (2, "Acme Toolz"), (3, "zzz"), (4, None)], "id int, name string")
    right = spark.createDataFrame([("ACME TOOLS", 1), ("acme tools", 2), ("acme toolx", 3), ("acme tooly", 4), ("q", 5)], "other string, u int")
    got = {(r["id"], r["u"], r["score"], r["match_rank"]) for r in match.fuzzy_match(left, right, "name", "other").collect()}
    assert {(i, u) for i, u, _, _ in got} == {(1, 1), (1, 2), (2, 1), (2, 2), (2, 3), (2, 4)}
    assert all(s == 100 for i, _, s, _ in got if i == 1) and all(m == 1 for *_, m in got)


def test_matches_of_a_common_name_are_spread(spark):
    """Many rows under one name on both sides: right rows, no repeats, and more tasks than the few bytes of input would give."""
    people = spark.range(3000).select(F.col("id").alias("account_id"), F.lit("acme tools").alias("account_name"), F.lit(0).alias("churned_flag"), F.lit(None).cast("date").alias("churn_date"))
    usage = spark.range(2000).select(F.col("id").alias("contract_number"), F.lit("Acme  tools").alias("usage_name"))
    got = tables.matched_usage(people.union(people.limit(100)), usage.union(usage.limit(100)))
    per_task = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 3000 * 2000 and len(per_task) > 2 and max(per_task) < 3_500_000
    sums = got.agg(F.sum("account_id"), F.sum("contract_number"), F.min("score")).first()
    assert tuple(sums) == (2000 * sum(range(3000)), 3000 * sum(range(2000)), 100)


def test_tasks_are_sized_by_the_input(spark, tiny):
    """Shuffles of a query start with a partition for each 2 MB of its tables; a small input keeps the session's number, and so does what runs next."""
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    grouped = lambda: spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()._jdf.queryExecution().executedPlan().toString()
    t = Inputs(session.tune(spark), tiny)
    assert t.raw("orders").count() > 0 and session.shuffle_partitions(spark) == own
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "8m"
    t._bytes["orders"] = 1 << 30
    t.raw("customer")
    assert session.shuffle_partitions(spark) == 512 and ", 512)" in grouped()
    session.size_tasks(spark, 1 << 45)
    assert session.shuffle_partitions(spark) == 2000
    session.tune(spark)
    assert session.shuffle_partitions(spark) == own and f", {own})" in grouped()


def test_a_load_derives_its_accounts_once(spark, tiny):
    """What follows the merge of a load reads the written accounts, not the tables they are derived from."""
    for load in (training_load, live_load):
        made = load(Inputs(session.tune(spark), tiny).bundle, "1996-01-01")
        for table in (made.features, made.table):
            assert not [f for f in table.inputFiles() if tiny in f]


def test_a_written_step_leaves_no_shuffle_files(spark):
    """What was shuffled for a step is gone once it is written; other queries keep theirs."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {b for b in disk.getAllBlocks().mkString(" ").split() if b.startswith("shuffle_")}
    df = spark.range(100_000).groupBy((F.col("id") % 1000).alias("k")).count()
    before = shuffled()
    step = scale.settled(df)
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffled() - before and step.count() == 1000
    assert len(df.collect()) == 1000 and shuffled() - before


def test_low_thresholds_are_refused(spark):
    with pytest.raises(ValueError):
        match.name_keys("abc", 60.0, {})


def test_merging_small_classes():
    assert split.merge_plan({1: 5, 2: 1, 3: 5}, 2, True) == {1: 1, 2: 1, 3: 3}
    assert split.merge_plan({1: 1, 2: 5}, 2, True) == {1: 2, 2: 2}
    assert split.merge_plan({1: 1, 2: 1, 3: 1}, 2, True) == {1: 2, 2: 2, 3: 2}
    assert split.merge_plan({1: 1}, 2, True) == {1: 1}
    assert split.merge_plan({1: 1, 2: 4}, 2, False) == {1: None, 2: 2}


def test_test_share_grows_for_small_classes():
    assert split.effective_test_size({1: 100, 2: 50}, 0.2, 2) == (0.2, True)
    assert split.effective_test_size({1: 100, 2: 4}, 0.2, 2) == (0.25, True)
    assert split.effective_test_size({1: 100, 2: 1}, 0.2, 1) == (0.2, False)
    assert split.effective_test_size({1: 100, 2: 1}, 0.2, 2) == (0.2, False)


def test_split_edges_and_proportions(spark):
    data = [(i, v) for i, v in enumerate([0, -3, None, 365, 366, 1460, 1461, 730, 731] + [100] * 50 + [500] * 30)]
    df = spark.createDataFrame(data, "account_id long, days int")
    classes = {r["days"]: r["sample_class"] for r in split.bin_target(df, "days").collect()}
    assert classes == {365: 1, 366: 2, 1460: 4, 1461: 5, 730: 2, 731: 3, 100: 1, 500: 2}
    train, test, report = split.stratified_split(df, "days", test_size=0.2)
    assert "days" not in train.columns and "no_of_renewals" in train.columns
    ids = rows(train.select("account_id")) + rows(test.select("account_id"))
    assert len(ids) == len(set(ids))
    assert sum(r["n"] for r in report.collect()) == len(ids)
