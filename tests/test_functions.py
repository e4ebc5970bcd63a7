import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions import coerce as C
from tidemark.functions import text as X
from tidemark.functions import weeks as K


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(column.alias("v")).first()["v"]


def d(text):
    return F.lit(text).cast("date")


@pytest.mark.parametrize(
    "day,week",
    [("2020-12-31", 202053), ("2021-01-03", 202053), ("2021-01-04", 202101), ("2024-12-31", 202501), ("2024-12-29", 202452), ("2016-01-01", 201553)],
)
def test_week_of_year_ends(spark, day, week):
    assert one(spark, K.date_to_week(d(day))) == week


@pytest.mark.parametrize("week,ok", [(202053, True), (202453, False), (202400, False), (202101, True), (99999, False), (1234567, False), (-1, False)])
def test_week_validity(spark, week, ok):
    assert one(spark, K.is_valid_week(F.lit(week))) is ok
    assert (one(spark, K.week_to_date(F.lit(week))) is not None) is ok


def test_every_day_of_fifty_years_round_trips(spark):
    days = spark.sql("select explode(sequence(date'1990-01-01', date'2040-12-31', interval 1 day)) d")
    back = K.week_to_date(K.date_to_week("d"), K.iso_parts("d").getField("iso_weekday"))
    assert days.where(~back.eqNullSafe(F.col("d"))).count() == 0


def test_week_details(spark):
    assert one(spark, K.week_to_date(F.lit(202053), 3)) == dt.date(2020, 12, 30)
    assert one(spark, K.week_midpoint(F.lit(202053), "thursday")) == dt.date(2020, 12, 31)
    assert one(spark, K.week_midpoint(F.lit("202053"), "arithmetic")) == dt.date(2020, 12, 31)
    info = one(spark, K.week_info(F.lit(202053)))
    assert info["weeks_in_year"] == 53 and len(info["days"]) == 7 and info["days"][6] == dt.date(2021, 1, 3)
    assert one(spark, K.week_days_diff(F.lit(202052), F.lit(202102))) == 21
    assert one(spark, K.weeks_between(F.lit(202052), F.lit(202102))) == 3
    assert one(spark, K.weeks_between(F.lit(202052), F.lit(202102), exact=True)) == 3
    assert one(spark, K.weeks_between(F.lit(202050), F.lit(202110), exact=True)) == 13
    assert [one(spark, K.is_leap_year(F.lit(y))) for y in (1900, 2000, 2023, 2024)] == [False, True, False, True]


def test_days_to_event_and_missing_week(spark):
    assert one(spark, K.days_to_event(F.lit(1), d("2021-01-10"), F.lit(202053))) == 11
    assert one(spark, K.days_to_event(F.lit(0), d("2021-01-10"), F.lit(202053))) == 9999
    assert one(spark, K.fill_week(F.lit(None), d("2021-01-03"))) == 202053
    assert one(spark, K.earliest(F.lit(None).cast("date"), d("2021-01-03"), d("2020-01-01"))) == dt.date(2020, 1, 1)


@pytest.mark.parametrize(
    "text,as_long,as_double",
    [("1", 1, 1.0), ("2.7", 2, 2.7), ("-2.7", -2, -2.7), ("invalid", None, None), ("", None, None), (" 7 ", 7, 7.0), (None, None, None),
     ("1d", None, None), ("nan", None, None), ("1e3", 1000, 1000.0), (".5", 0, 0.5), ("1_000", None, None)],
)
def test_number_coercion(spark, text, as_long, as_double):
    value = F.lit(text).cast("string")
    assert one(spark, C.to_long(value)) == as_long
    assert one(spark, C.to_double(value)) == as_double


@pytest.mark.parametrize(
    "text,expected",
    [("2020-02-03", dt.datetime(2020, 2, 3)), ("2020-02", dt.datetime(2020, 2, 1)), ("02/03/2020", dt.datetime(2020, 2, 3)),
     ("2020-02-03 04:05:06", dt.datetime(2020, 2, 3, 4, 5, 6)), ("2020-02-03T04:05:06", dt.datetime(2020, 2, 3, 4, 5, 6)),
     ("Latest Month", None), ("last 2020-02-03", None), ("2020-13-45", None), ("x", None), ("", None), (None, None)],
)
def test_date_coercion(spark, text, expected):
    assert one(spark, C.to_ts(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize(
    "text,flag,truth",
    [("Y", 1, True), ("n", 0, False), ("Yes ", 1, True), ("NO", 0, False), ("true", 1, True), ("False", 0, False), ("1", 1, True), ("0", 0, False),
     ("2.5", 1, True), ("0.0", 0, True), ("maybe", None, True), ("active", None, True), ("inactive", None, False), ("", None, False), (None, None, None)],
)
def test_flags(spark, text, flag, truth):
    value = F.lit(text).cast("string")
    assert one(spark, C.flag_to_int(value)) == flag
    assert one(spark, C.to_bool(value)) is truth


def test_flags_of_other_types(spark):
    assert one(spark, C.flag_to_int(F.lit(True))) == 1
    assert one(spark, C.flag_to_int(F.lit(0))) == 0
    assert one(spark, C.flag_to_int(F.lit(3.0))) == 1


def test_float_columns(spark):
    df = spark.createDataFrame([(1.0, 1.5, None), (2.0, 2.0, None)], "a double, b double, c double")
    assert dict(C.narrow_floats(df).dtypes) == {"a": "bigint", "b": "double", "c": "double"}
    assert C.to_float(spark.createDataFrame([("1.5", "x")], "a string, b string")).first() == (1.5, None)
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (1.0,)], "a double")
    assert [r.a for r in C.nan_to_null(odd).collect()] == [None, float("inf"), 1.0]


def test_lists_and_names(spark):
    assert one(spark, X.canonical_list(F.lit("b, a"))) == "a,b"
    assert one(spark, X.canonical_list(F.lit(None).cast("string"))) == ""
    assert one(spark, X.strip_counts(F.lit("2x b,a, 10x c"))) == "a,b,c"
    assert one(spark, X.canonical_list(F.lit("a,a"))) == "a,a"
    assert one(spark, X.normalise_name(F.lit("  a  b   c "))) == "a b  c"
    assert one(spark, X.clean_category(F.lit("A B C"), "UNK")) == "A_B_C"
    assert one(spark, X.clean_category(F.lit(None).cast("string"), "UNK")) == "UNK"
    assert one(spark, X.clean_category(F.lit(None).cast("string"))) is None


def plain_similarity(a, b):
    """Jaro-Winkler written out pair by pair."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used = [False] * len(b)
    left = []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == ch:
                used[j] = True
                left.append(ch)
                break
    m = len(left)
    if m == 0:
        return 0.0
    right = [b[j] for j in range(len(b)) if used[j]]
    swaps = sum(x != y for x, y in zip(left, right)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


def test_similarity_against_the_written_out_form():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 14))) for _ in range(1500)] + ["x" * 300, "x" * 299 + "y", "", "a"]
    left, right = [rng.choice(words) for _ in range(4000)], [rng.choice(words) for _ in range(4000)]
    got = X.similarity_scores(pd.Series(left), pd.Series(right))
    want = [plain_similarity(a, b) for a, b in zip(left, right)]
    assert max(abs(g - w) for g, w in zip(got, want)) < 1e-12
    bounded = X.similarity_scores(pd.Series(left), pd.Series(right), 0.8)
    assert all((g >= 0.8 - 1e-9) == (w >= 0.8 - 1e-9) for g, w in zip(bounded, want))


def test_similarity_of_missing_and_known_pairs(spark):
    assert X.similarity_scores(pd.Series(["a", None]), pd.Series([None, "b"])).isna().all()
    assert one(spark, X.jaro_winkler(F.lit("MARTHA"), F.lit("marhta"))) == 96
    assert one(spark, X.jaro_winkler(F.lit("same"), F.lit("SAME"), ignore_case=False)) == 0
