"""Scalar functions: weeks and dates, coercion, text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import coerce as C
from tidemark.functions import text as X
from tidemark.functions import weeks as K
from tidemark.plans.inputs import Inputs, week_sql
from tidemark.plans.registry import add, longs, rounded, shown

# Week keys over the orders: the key of the order date, some of them broken on purpose.
MIXED_WEEK = """CASE o_orderkey % 5 WHEN 3 THEN isoyear(o_orderdate) * 100 + 53 WHEN 4 THEN isoyear(o_orderdate) * 100
    ELSE isoyear(o_orderdate) * 100 + weekofyear(o_orderdate) END"""
LAST_WEEK = "weekofyear(make_date(CAST(floor(w / 100) AS INTEGER), 12, 28))"
VALID = f"(w % 100 BETWEEN 1 AND {LAST_WEEK})"


def monday_sql(w: str, weekday: int = 1) -> str:
    return (
        f"CAST(date_trunc('week', make_date(CAST(floor({w} / 100) AS INTEGER), 1, 4)) AS DATE)"
        f" + CAST(({w} % 100 - 1) * 7 + {weekday - 1} AS INTEGER)"
    )


def mixed_weeks(t: Inputs) -> DataFrame:
    o = t.orders
    year = K.week_year(K.date_to_week("o_orderdate"))
    w = F.when(F.col("o_orderkey") % 5 == 3, year * 100 + 53).when(F.col("o_orderkey") % 5 == 4, year * 100)
    return o.select("o_orderkey", "o_custkey", "o_orderdate", w.otherwise(K.date_to_week("o_orderdate")).alias("w"))


def weeks_from(select: str) -> str:
    return f"WITH m AS (SELECT o_orderkey, o_custkey, o_orderdate, {MIXED_WEEK} AS w FROM ord) {select}"


add(
    "date_to_week", "D6 D5",
    lambda t: longs(
        t.orders.select("o_orderkey", K.date_to_week("o_orderdate").alias("yyyywk"), K.iso_parts("o_orderdate").alias("p"))
        .select("o_orderkey", "yyyywk", "p.*")
    ),
    f"""SELECT o_orderkey, {week_sql('o_orderdate')}::BIGINT AS yyyywk, isoyear(o_orderdate)::BIGINT AS iso_year,
        weekofyear(o_orderdate)::BIGINT AS iso_week, isodow(o_orderdate)::BIGINT AS iso_weekday FROM ord""",
)
add(
    "week_to_date", "D1 D4 D14",
    lambda t: mixed_weeks(t).select(
        "o_orderkey", K.week_to_date("w").alias("monday"), K.week_to_date("w", 3).alias("wednesday"),
        K.week_range("w").getField("week_end").alias("week_end"),
    ),
    weeks_from(f"""SELECT o_orderkey, CASE WHEN {VALID} THEN {monday_sql('w')} END AS monday,
        CASE WHEN {VALID} THEN {monday_sql('w', 3)} END AS wednesday,
        CASE WHEN {VALID} THEN {monday_sql('w', 7)} END AS week_end FROM m"""),
)
add(
    "week_validity", "D2 D3 D7 D10",
    lambda t: longs(
        mixed_weeks(t).select(
            "o_orderkey", K.week_year("w").alias("iso_year"), K.week_number("w").alias("iso_week"),
            K.is_valid_week("w").alias("is_valid"), K.weeks_in_year(K.week_year("w")).alias("weeks_in_year"),
            K.is_leap_year(K.week_year("w")).alias("is_leap"),
        )
    ),
    weeks_from(f"""SELECT o_orderkey, CAST(floor(w / 100) AS BIGINT) AS iso_year, (w % 100)::BIGINT AS iso_week,
        {VALID} AS is_valid, {LAST_WEEK}::BIGINT AS weeks_in_year,
        (floor(w / 100) % 4 = 0 AND floor(w / 100) % 100 <> 0) OR floor(w / 100) % 400 = 0 AS is_leap FROM m"""),
)
add(
    "week_info", "D9",
    lambda t: longs(
        mixed_weeks(t).select("w").distinct().select("w", K.week_info("w").alias("i")).select(
            "w", F.col("i.is_valid").alias("is_valid"), F.col("i.days")[0].alias("first_day"),
            F.col("i.days")[6].alias("last_day"), F.size(F.array_compact("i.days")).alias("n_days"),
            F.col("i.weeks_in_year").alias("weeks_in_year"),
        )
    ),
    weeks_from(f"""SELECT DISTINCT w, {VALID} AS is_valid, CASE WHEN {VALID} THEN {monday_sql('w')} END AS first_day,
        CASE WHEN {VALID} THEN {monday_sql('w', 7)} END AS last_day,
        CASE WHEN {VALID} THEN 7 ELSE 0 END::BIGINT AS n_days, {LAST_WEEK}::BIGINT AS weeks_in_year FROM m"""),
)
add(
    "current_week", "D8 D19",
    lambda t: rounded(
        longs(
            t.orders.select(
                "o_orderkey",
                K.date_to_week(F.lit("2002-01-15").cast("date")).alias("as_of_week"),
                K.elapsed("o_orderdate", F.lit("2002-01-15").cast("date")).alias("e"),
            ).select("o_orderkey", "as_of_week", "e.*")
        )
    ),
    """SELECT o_orderkey, 200203::BIGINT AS as_of_week, date_diff('day', o_orderdate, DATE '2002-01-15')::BIGINT AS days_elapsed,
        round(date_diff('day', o_orderdate, DATE '2002-01-15') / 30.0::DOUBLE, 6) AS months_elapsed FROM ord""",
)
add(
    "week_midpoints", "D11 D12",
    lambda t: longs(
        t.orders.select("o_orderkey", K.date_to_week("o_orderdate").alias("a")).select(
            "o_orderkey", K.week_midpoint("a").alias("wednesday"), K.week_midpoint("a", "thursday").alias("thursday"),
            K.week_midpoint("a", "arithmetic").alias("arithmetic"),
            K.week_days_diff("a", F.lit(200201)).alias("days_to_200201"),
        )
    ),
    f"""SELECT o_orderkey, {monday_sql('w', 3)} AS wednesday, {monday_sql('w', 4)} AS thursday,
        {monday_sql('w', 4)} AS arithmetic, date_diff('day', {monday_sql('w', 3)}, DATE '2002-01-02')::BIGINT AS days_to_200201
        FROM (SELECT o_orderkey, {week_sql('o_orderdate')} AS w FROM ord)""",
)
add(
    "weeks_between", "D13",
    lambda t: longs(
        t.orders.select(
            "o_orderkey", K.weeks_between(K.date_to_week("o_orderdate"), F.lit(200201)).alias("weeks"),
            K.weeks_between(K.date_to_week("o_orderdate"), F.lit(200201), exact=True).alias("weeks_exact"),
        )
    ),
    f"""SELECT o_orderkey, ((2002 - isoyear(o_orderdate)) * 52 + 1 - weekofyear(o_orderdate) + 1)::BIGINT AS weeks,
        (date_diff('day', CAST(date_trunc('week', o_orderdate) AS DATE), DATE '2001-12-31') / 7)::BIGINT AS weeks_exact FROM ord""",
)
add(
    "calendar_parts", "D15",
    lambda t: longs(t.orders.select("o_orderkey", K.calendar_parts("o_orderdate").alias("p")).select("o_orderkey", "p.*")),
    """SELECT o_orderkey, year(o_orderdate)::BIGINT AS year, quarter(o_orderdate)::BIGINT AS quarter,
        month(o_orderdate)::BIGINT AS month, strftime(o_orderdate, '%Y-%m') AS month_label,
        monthname(o_orderdate) AS month_name FROM ord""",
)
add(
    "fill_week_and_dates", "D16 D20 D21 D18",
    lambda t: rounded(
        longs(
            t.orders.withColumn("ship", F.when(F.col("o_orderkey") % 3 == 0, F.date_sub("o_orderdate", 5)))
            .withColumn("w", F.when(F.col("o_orderkey") % 2 == 0, F.lit(199901)))
            .select(
                "o_orderkey", K.fill_week("w", "o_orderdate").alias("yyyywk"),
                K.earliest("ship", "o_orderdate").alias("earliest"), K.first_present("ship", "o_orderdate").alias("present"),
                K.days_between("o_orderdate", F.lit("2002-01-01").cast("date")).alias("days"),
                K.months_between_30("o_orderdate", F.lit("2002-01-01").cast("date")).alias("months"),
            )
        )
    ),
    f"""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 199901 ELSE {week_sql('o_orderdate')} END::BIGINT AS yyyywk,
        CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate - 5 ELSE o_orderdate END AS earliest,
        CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate - 5 ELSE o_orderdate END AS present,
        date_diff('day', o_orderdate, DATE '2002-01-01')::BIGINT AS days,
        round(date_diff('day', o_orderdate, DATE '2002-01-01') / 30.0::DOUBLE, 6) AS months FROM ord""",
)
add(
    "days_to_churn", "D17",
    lambda t: rounded(
        longs(
            t.weekly.select(
                "account_id", "yyyywk",
                K.days_to_event("churned_flag", "churn_date", "yyyywk").alias("days_to_churn"),
                (K.days_to_event("churned_flag", "churn_date", "yyyywk") / 7.0).alias("weeks_to_churn"),
            )
        )
    ),
    f"""SELECT account_id, yyyywk::BIGINT AS yyyywk, d::BIGINT AS days_to_churn, round(d / 7.0::DOUBLE, 6) AS weeks_to_churn
        FROM (SELECT account_id, yyyywk, CASE WHEN churned_flag = 1
              THEN date_diff('day', {monday_sql('yyyywk', 3)}, churn_date) ELSE 9999 END AS d FROM weekly)""",
)

# --- coercion -----------------------------------------------------------------------

DIRTY_NUMBER = """CASE l_linenumber % 7 WHEN 0 THEN CAST(l_quantity AS VARCHAR) WHEN 1 THEN ' ' || CAST(l_orderkey AS VARCHAR) || ' '
    WHEN 2 THEN 'n/a' WHEN 3 THEN '' WHEN 4 THEN NULL WHEN 5 THEN CAST(l_extendedprice AS VARCHAR)
    ELSE '-' || CAST(l_partkey AS VARCHAR) END"""


def dirty_numbers(t: Inputs) -> DataFrame:
    k = F.col("l_linenumber") % 7
    x = (
        F.when(k == 0, F.col("l_quantity").cast("string"))
        .when(k == 1, F.concat(F.lit(" "), F.col("l_orderkey").cast("string"), F.lit(" ")))
        .when(k == 2, "n/a").when(k == 3, "").when(k == 4, None)
        .when(k == 5, F.col("l_extendedprice").cast("string"))
        .otherwise(F.concat(F.lit("-"), F.col("l_partkey").cast("string")))
    )
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", x.alias("x"))


add(
    "coerce_numbers", "C1 C2 C7",
    lambda t: longs(dirty_numbers(t).select("l_orderkey", "l_linenumber", "l_partkey", C.to_long("x").alias("as_long"), C.to_double("x").alias("as_double"))),
    f"""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey,
        TRY_CAST(trunc(TRY_CAST(trim(x) AS DOUBLE)) AS BIGINT) AS as_long, TRY_CAST(trim(x) AS DOUBLE) AS as_double
        FROM (SELECT *, {DIRTY_NUMBER} AS x FROM lineitem)""",
)
add(
    "coerce_listed_columns", "C7 C8",
    lambda t: rounded(
        longs(C.coerce_numeric(dirty_numbers(t), ["x"]).groupBy("l_linenumber").agg(F.count("x").alias("known"), F.sum("x").alias("total"))), 2
    ),
    f"""SELECT l_linenumber::BIGINT AS l_linenumber, count(x) AS known, round(sum(x), 2) AS total FROM
        (SELECT l_linenumber, TRY_CAST(trim({DIRTY_NUMBER}) AS DOUBLE) AS x FROM lineitem) GROUP BY 1""",
)
add(
    "all_columns_to_float", "C8",
    lambda t: C.to_float(t.raw("part").select("p_partkey", "p_name", "p_size", "p_retailprice"), 64),
    """SELECT p_partkey::DOUBLE AS p_partkey, TRY_CAST(p_name AS DOUBLE) AS p_name, p_size::DOUBLE AS p_size, p_retailprice FROM part""",
)
add(
    "narrow_whole_floats", "C4",
    lambda t: C.narrow_floats(t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_tax"))
    .withColumn("quantity_type", F.typeof("l_quantity")).withColumn("tax_type", F.typeof("l_tax"))
    .groupBy("quantity_type", "tax_type").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"), F.count(F.lit(1)).alias("n")),
    "SELECT 'bigint' AS quantity_type, 'double' AS tax_type, sum(l_quantity)::BIGINT AS quantity, count(*) AS n FROM lineitem",
)
DIRTY_DATE = """CASE o_orderkey % 7 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m')
    WHEN 2 THEN strftime(o_orderdate, '%m/%d/%Y') WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 13:14:15'
    WHEN 4 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T13:14:15' WHEN 5 THEN 'Latest Month' ELSE 'unknown' END"""


def dirty_dates(t: Inputs) -> DataFrame:
    k, d = F.col("o_orderkey") % 7, F.col("o_orderdate")
    day = F.date_format(d, "yyyy-MM-dd")
    x = (
        F.when(k == 0, day).when(k == 1, F.date_format(d, "yyyy-MM")).when(k == 2, F.date_format(d, "MM/dd/yyyy"))
        .when(k == 3, F.concat(day, F.lit(" 13:14:15"))).when(k == 4, F.concat(day, F.lit("T13:14:15")))
        .when(k == 5, "Latest Month").otherwise("unknown")
    )
    return t.orders.select("o_orderkey", x.alias("x"))


add(
    "coerce_dates", "C3",
    lambda t: dirty_dates(t).select("o_orderkey", C.to_ts("x").alias("as_ts"), C.is_date_text("x").alias("looks_like_date")),
    f"""SELECT o_orderkey, try_strptime(x, ['%Y-%m-%d', '%Y-%m', '%m/%d/%Y', '%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S']) AS as_ts,
        try_strptime(x, ['%Y-%m-%d', '%Y-%m', '%m/%d/%Y', '%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S']) IS NOT NULL AS looks_like_date
        FROM (SELECT o_orderkey, {DIRTY_DATE} AS x FROM ord)""",
)
# Flag spellings, by order number.
FLAGS = ["Y", "N", " yes", "No ", "TRUE", "false", "1", "0", "2.5", "maybe", "active", "inactive", ""]


def dirty_flags(t: Inputs) -> DataFrame:
    spelled = F.element_at(F.array(*[F.lit(x) for x in FLAGS]), (F.col("o_orderkey") % len(FLAGS) + 1).cast("int"))
    return t.orders.select("o_orderkey", spelled.alias("x"))


FLAG_LIST = "[" + ", ".join(f"'{x}'" for x in FLAGS) + "]"
add(
    "coerce_flags", "C5 C6 F7 F8",
    lambda t: longs(dirty_flags(t).select("o_orderkey", C.fold_text("x").alias("folded"), C.to_bool("x").alias("as_bool"), C.flag_to_int("x").alias("as_flag"))),
    f"""SELECT o_orderkey, f AS folded,
        CASE WHEN f IN ('true', 'yes', 'y', '1', 'active') THEN true WHEN f IN ('false', 'no', 'n', '0', 'inactive') THEN false
             ELSE length(x) > 0 END AS as_bool,
        CASE WHEN f IN ('true', 'yes', 'y', '1') THEN 1 WHEN f IN ('false', 'no', 'n', '0') THEN 0
             ELSE CAST(TRY_CAST(f AS DOUBLE) <> 0 AS INTEGER) END::BIGINT AS as_flag
        FROM (SELECT o_orderkey, x, lower(trim(x)) AS f FROM
              (SELECT o_orderkey, {FLAG_LIST}[o_orderkey % {len(FLAGS)} + 1] AS x FROM ord))""",
)

# --- text -----------------------------------------------------------------------------

add(
    "canonical_lists", "F1 F2 F6",
    lambda t: longs(
        t.usage.select("line_items").distinct().select(
            "line_items", X.canonical_list("line_items").alias("canonical"), X.strip_counts("line_items").alias("stripped"),
            X.text_length("line_items").alias("n_chars"),
        )
    ),
    """SELECT DISTINCT line_items, array_to_string(list_sort(list_transform(string_split(line_items, ','), lambda x: trim(x))), ',') AS canonical,
        array_to_string(list_sort(list_transform(string_split(regexp_replace(line_items, '[0-9]+x ', '', 'g'), ','), lambda x: trim(x))), ',') AS stripped,
        length(line_items)::BIGINT AS n_chars FROM usage""",
)
add(
    "clean_text", "F3 F4",
    lambda t: t.raw("documents").select(
        "doc_id", X.normalise_name("text").alias("normalised"), X.clean_category("source", "UNK").alias("source_filled"),
        X.clean_category(F.when(F.col("doc_id") % 3 != 0, F.col("lang"))).alias("lang_kept"),
        X.clean_category(F.when(F.col("doc_id") % 3 != 0, F.col("lang")), "NA").alias("lang_filled"),
    ),
    """SELECT doc_id, regexp_replace(trim(text, ' '), '  ', ' ', 'g') AS normalised, coalesce(replace(source, ' ', '_'), 'UNK') AS source_filled,
        CASE WHEN doc_id % 3 <> 0 THEN replace(lang, ' ', '_') END AS lang_kept,
        CASE WHEN doc_id % 3 <> 0 THEN replace(lang, ' ', '_') ELSE 'NA' END AS lang_filled FROM documents""",
)
add(
    "name_similarity", "F5",
    lambda t: longs(
        t.named_usage.join(t.named_accounts, F.col("contract_number") == F.col("account_id")).select(
            "account_id", X.jaro_winkler("account_name", "usage_name").alias("score"),
            X.jaro_winkler("account_name", "usage_name", ignore_case=False).alias("score_cased"),
        )
    ),
    """SELECT account_id, CAST(floor(jaro_winkler_similarity(lower(account_name), lower(usage_name)) * 100 + 1e-9) AS BIGINT) AS score,
        CAST(floor(jaro_winkler_similarity(account_name, usage_name) * 100 + 1e-9) AS BIGINT) AS score_cased
        FROM named_accounts JOIN named_usage ON account_id = contract_number""",
)
add(
    "arithmetic", "C2 D17",
    lambda t: rounded(
        t.orders.select(
            "o_orderkey", F.log1p("o_totalprice").alias("log_price"), (F.col("o_totalprice") / 4.33).alias("monthly"),
            (F.col("o_totalprice") / 52).alias("yearly"), F.bround(F.col("o_totalprice") / 7, 2).alias("rounded"),
        ), 4,
    ),
    """SELECT o_orderkey, round(ln(1 + o_totalprice), 4) AS log_price, round(o_totalprice / 4.33::DOUBLE, 4) AS monthly,
        round(o_totalprice / 52, 4) AS yearly, round(round_even(o_totalprice / 7, 2), 4) AS rounded FROM orders""",
)
