"""Schema inference, validation, profiling and data-quality reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.coerce import is_date_text, is_number_text, is_numeric, to_double
from tidemark.operators.scale import scalars
from tidemark.sources.schemas import FieldRule, schema_rules

# Class limits, sample sizes and the recognised word pairs.
MAX_CATEGORIES = 10
SAMPLE_VALUES = 10
DATE_SHARE = 0.5
HEAD = 64
WHOLE_NUMBER, NUMBER, DATE, OTHER_FORM = 1, 2, 4, 8
BINARY_PAIRS = (("false", "true"), ("no", "yes"), ("n", "y"), ("0", "1"), ("0.0", "1.0"), ("active", "inactive"))


# --- column values --------------------------------------------------------------------


def text_form(f: T.StructField) -> Column:
    """A value as report text: dates without an empty time, whole numbers without decimals."""
    c = F.col(f.name)
    if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
        midnight = F.date_trunc("day", c) == c
        return F.when(midnight, F.date_format(c, "yyyy-MM-dd")).otherwise(F.date_format(c, "yyyy-MM-dd HH:mm:ss"))
    if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
        whole = (c == F.floor(c)) & (F.abs(c) < 1e15)
        return F.when(whole, F.when(whole, c).cast("bigint").cast("string")).otherwise(c.cast("string"))
    if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(c)
    return c.cast("string")


def column_values(df: DataFrame) -> DataFrame:
    """(column, head, digest, n) for the distinct values of all columns at once; NULL is a value here.

    A value is known by its first ``HEAD`` characters and, where it is longer, by its
    SHA-256: no free text is a grouping key.  One shuffle for any number of columns,
    combined before it.
    """
    cells = F.array(*[F.struct(F.lit(f.name).alias("column"), text_form(f).alias("value")) for f in df.schema])
    melted = df.select(F.explode(cells).alias("cell")).select("cell.column", *_known_by(F.col("cell.value")))
    return melted.groupBy("column", "head", "digest").agg(F.count(F.lit(1)).alias("n"))


def _known_by(v: Column) -> tuple[Column, Column]:
    return F.substring(v, 1, HEAD).alias("head"), F.when(F.length(v) > HEAD, F.unhex(F.sha2(v, 256))).alias("digest")


def _lookup(names: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[F.col("column")]


def _storage(dtype: T.DataType) -> str:
    if isinstance(dtype, T.BooleanType):
        return "bool"
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "float"
    if is_numeric(dtype):
        return "int"
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    return "text"


def accumulated(df: DataFrame) -> DataFrame:
    """Per column what one scan can say: counts, the forms its values have, and the least and greatest of them.

    Every accumulator merges, so a task sends one row, however many values it has read.
    ``forms`` has a bit for each form that a text value has taken.  All rows count, not a
    sample.  An empty frame has no facts.
    """
    aggs, facts = [F.count(F.lit(1)).alias("_total")], []
    for i, f in enumerate(df.schema):
        v, stored = text_form(f), _storage(f.dataType)
        c = F.col(f.name)
        aggs += [F.count(c).alias(f"_known{i}"), F.min(v).alias(f"_low{i}"), F.max(v).alias(f"_high{i}")]
        forms, dates = F.lit(WHOLE_NUMBER if stored == "int" else OTHER_FORM), F.lit(0)
        if stored == "text":
            # The form is looked for once per value; both accumulators read it.
            aggs += [F.bit_or(text_forms(v)).alias(f"_forms{i}"), F.count_if(text_forms(v) == DATE).alias(f"_dates{i}")]
            forms, dates = F.coalesce(F.col(f"_forms{i}"), F.lit(0)), F.col(f"_dates{i}")
        elif stored == "float":
            number = F.when(F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")), OTHER_FORM)
            aggs.append(F.bit_or(F.when(c.isNotNull(), number.when(c == F.floor(c), WHOLE_NUMBER).otherwise(NUMBER))).alias(f"_forms{i}"))
            forms = F.coalesce(F.col(f"_forms{i}"), F.lit(0))
        facts.append(
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(stored).alias("storage"),
                F.col("_total").alias("total"),
                (F.col("_total") - F.col(f"_known{i}")).alias("missing"),
                forms.alias("forms"),
                dates.cast("long").alias("date_rows"),
                F.col(f"_low{i}").alias("least"),
                F.col(f"_high{i}").alias("greatest"),
            )
        )
    rows = df.agg(*aggs).where(F.col("_total") > 0).select(F.explode(F.array(*facts)).alias("f")).select("f.*")
    # Where a column has two values, these are they; so the word pair follows from the ends.
    ends = [F.lower(F.trim("least")), F.lower(F.trim("greatest"))]
    return rows.withColumns(
        {
            "all_numeric": F.col("forms").bitwiseAND(DATE | OTHER_FORM) == 0,
            "all_whole": F.col("forms").bitwiseAND(NUMBER) == 0,
            "low": F.least(*ends),
            "high": F.greatest(*ends),
        }
    )


def text_forms(v: Column) -> Column:
    """The bit of the form that a text value has; NULL for NULL."""
    number = to_double(v)
    form = F.when(is_number_text(v), F.when(number == F.floor(number), WHOLE_NUMBER).otherwise(NUMBER))
    return F.when(v.isNotNull(), form.when(is_date_text(v), DATE).otherwise(OTHER_FORM))


def column_facts(df: DataFrame, values: DataFrame | None = None) -> DataFrame:
    """Counts and yes/no facts per column from which its kind follows, with the exact count of distinct values."""
    values = column_values(df) if values is None else values
    distinct = values.groupBy("column").agg(F.count("head").alias("n_unique"))
    return accumulated(df).join(distinct, "column")


def kind_and_type() -> tuple[Column, Column]:
    """Column kind (``cat(3)``, ``num`` ...) and value type from the facts."""
    u, storage = F.col("n_unique"), F.col("storage")
    known = F.col("total") - F.col("missing")
    counted = lambda name: F.format_string(f"{name}(%d)", u)
    pair = reduce(
        lambda a, b: a | b, [(F.col("low") == lo) & (F.col("high") == hi) for lo, hi in BINARY_PAIRS]
    ) & (u == 2)
    number = F.col("all_numeric")
    whole = number & F.col("all_whole")
    small_int = F.when(u == 2, "bin_int").when(u <= MAX_CATEGORIES, counted("cat_int"))
    text = (
        F.when(number & ~F.col("all_whole"), "num")
        .when(whole, F.coalesce(small_int, counted("cat_high_card")))
        .when(F.col("date_rows") >= known * DATE_SHARE, "datetime")
        .when(u == 2, "bin")
        .when(u > MAX_CATEGORIES, counted("cat_high_card"))
        .when(u > 1, counted("cat"))
        .otherwise(counted("str"))
    )
    kind = (
        F.when(known == 0, "str")
        .when(storage == "datetime", "datetime")
        .when(storage == "bool", F.when(u == 2, "bin").otherwise(counted("str")))
        .when((storage == "int") | ((storage == "float") & whole), F.coalesce(small_int, F.lit("int")))
        .when(storage == "float", "num")
        .otherwise(text)
    )
    text_type = (
        F.when(number & ~F.col("all_whole"), "float")
        .when(whole, "int")
        .when(F.col("date_rows") >= known * DATE_SHARE, "datetime")
        .when(pair, "bool")
        .otherwise("str")
    )
    vtype = (
        F.when(known == 0, "str")
        .when(storage.isin("datetime", "bool"), storage)
        .when((storage == "int") | ((storage == "float") & whole), "int")
        .when(storage == "float", "float")
        .otherwise(text_type)
    )
    return kind, vtype


def infer_types(df: DataFrame, values: DataFrame | None = None) -> DataFrame:
    """One row per column: kind, type, nullability, missing and distinct counts."""
    kind, vtype = kind_and_type()
    return column_facts(df, values).select(
        "column",
        kind.alias("kind"),
        vtype.alias("type"),
        (F.col("missing") > 0).alias("nullable"),
        "missing",
        "n_unique",
    )


def numeric_text(df: DataFrame) -> DataFrame:
    """Text columns whose known values are all numbers, and whether all are whole; one row per task is shuffled."""
    facts = accumulated(df).where((F.col("storage") == "text") & (F.col("missing") < F.col("total")))
    verdict = F.when(~F.col("all_numeric"), "no").when(F.col("all_whole"), "integer").otherwise("float")
    return facts.select("column", verdict.alias("numeric_text"))


def date_pattern_share(df: DataFrame) -> DataFrame:
    """Share of the known values of each text column that look like dates, and the verdict; one row per task is shuffled."""
    facts = accumulated(df).where((F.col("storage") == "text") & (F.col("missing") < F.col("total")))
    share = F.col("date_rows") / (F.col("total") - F.col("missing"))
    return facts.select("column", share.alias("date_share"), (share >= DATE_SHARE).alias("is_datetime"))


def binary_pairs(df: DataFrame) -> DataFrame:
    """Columns that hold exactly one of the recognised word pairs.

    A column has two values if its ends differ and a second scan meets nothing else, so
    no values are made distinct.
    """
    ends = scalars(df, **{f"_{side}{i}": pick(text_form(f)) for i, f in enumerate(df.schema) for side, pick in (("a", F.min), ("b", F.max))})
    marked = df.withColumn("_ends", ends)
    between = [
        F.count_if((text_form(f) != F.col(f"_ends._a{i}")) & (text_form(f) != F.col(f"_ends._b{i}"))).alias(f"_n{i}") for i, f in enumerate(df.schema)
    ]
    rows = marked.agg(F.first("_ends").alias("_ends"), *between)
    listed = [
        F.struct(
            F.lit(f.name).alias("column"), F.col(f"_ends._a{i}").alias("a"), F.col(f"_ends._b{i}").alias("b"), F.col(f"_n{i}").alias("others")
        )
        for i, f in enumerate(df.schema)
    ]
    two = rows.select(F.explode(F.array(*listed)).alias("r")).select("r.*").where((F.col("a") != F.col("b")) & (F.col("others") == 0))
    ends = [F.lower(F.trim("a")), F.lower(F.trim("b"))]
    found = two.select("column", F.least(*ends).alias("low"), F.greatest(*ends).alias("high"))
    match = reduce(lambda a, b: a | b, [(F.col("low") == lo) & (F.col("high") == hi) for lo, hi in BINARY_PAIRS])
    return found.select("column", "low", "high", F.coalesce(match, F.lit(False)).alias("is_binary"))


def whole_numbers(df: DataFrame) -> DataFrame:
    """Numeric columns and whether all their known values are whole."""
    numeric = [f.name for f in df.schema if is_numeric(f.dataType)]
    row = df.agg(*[F.bool_and(F.col(c) == F.floor(c)).alias(c) for c in numeric])
    listed = [F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c), F.lit(False)).alias("all_whole")) for c in numeric]
    return row.select(F.explode(F.array(*listed)).alias("r")).select("r.*")


def infer_schema(df: DataFrame) -> T.StructType:
    """A schema from the data; one small row per column comes to the driver."""
    types = {"int": T.LongType(), "float": T.DoubleType(), "bool": T.BooleanType(), "datetime": T.TimestampType()}
    found = {r["column"]: r for r in infer_types(df).collect()}
    fields = []
    for name in df.columns:
        r = found.get(name)
        if r is None:
            fields.append(T.StructField(name, T.StringType(), True))
            continue
        meta = {"kind": r["kind"], "type": r["type"], "missing": r["missing"], "n_unique": r["n_unique"]}
        fields.append(T.StructField(name, types.get(r["type"], T.StringType()), r["nullable"], meta))
    return T.StructType(fields)


def schema_json(schema: T.StructType) -> dict:
    """The JSON form of an inferred schema, as the schema files have it."""
    names = {"int": "int", "float": "float", "bool": "bool", "datetime": "datetime"}

    def entry(f: T.StructField) -> dict:
        base = names.get(f.metadata.get("type", "str"), "str")
        return {
            "type": f"Optional[{base}]" if f.nullable else base,
            "required": not f.nullable,
            "metadata": {
                "inferred_type": f.metadata.get("kind"),
                "actual_dtype": base,
                "unique_count": f.metadata.get("n_unique"),
                "missing_count": f.metadata.get("missing"),
            },
        }

    return {"fields": {f.name: entry(f) for f in schema}}


def lowest_values(df: DataFrame, values: DataFrame, count: int = SAMPLE_VALUES) -> DataFrame:
    """(column, value): the ``count`` lowest distinct values of each column.

    Heads order as their values do, so the lowest heads, ties included, have the lowest
    values among them.  Only long values among those are fetched, by their digests.
    """
    by_head = W.partitionBy("column").orderBy("head")
    # The rank filter is applied within each task before the shuffle.
    low = values.where(F.col("head").isNotNull()).withColumn("r", F.rank().over(by_head)).where(F.col("r") <= count)
    short = low.where(F.col("digest").isNull()).select("column", F.col("head").alias("value"))
    texts = [f for f in df.schema if _storage(f.dataType) == "text"]
    if texts:
        cells = F.array(*[F.struct(F.lit(f.name).alias("column"), text_form(f).alias("value")) for f in texts])
        long = df.select(F.explode(F.filter(cells, lambda c: F.length(c["value"]) > HEAD)).alias("cell")).select("cell.*")
        wanted = low.where(F.col("digest").isNotNull()).select("column", "head", "digest")
        fetched = long.withColumns(dict(zip(("head", "digest"), _known_by(F.col("value")), strict=True))).join(wanted, ["column", "head", "digest"], "left_semi")
        short = short.unionByName(fetched.select("column", "value").distinct())
    by_value = W.partitionBy("column").orderBy("value")
    return short.withColumn("r", F.row_number().over(by_value)).where(F.col("r") <= count).select("column", "value")


def profile(df: DataFrame) -> DataFrame:
    """Kind, missing count and share, distinct count and the ten lowest values of each column."""
    values = column_values(df)
    samples = lowest_values(df, values).groupBy("column").agg(
        F.array_join(F.array_sort(F.collect_list("value")), " | ").alias("samples")
    )
    kind, vtype = kind_and_type()
    facts = column_facts(df, values)
    share = F.try_divide(F.col("missing"), F.col("total")) * 100
    return facts.join(samples, "column", "left").select(
        "column", kind.alias("kind"), vtype.alias("type"), "missing", share.alias("missing_pct"), "n_unique",
        F.coalesce("samples", F.lit("")).alias("samples"),
    )


# --- validation ---------------------------------------------------------------------------


def _breaches(df: DataFrame, schema: dict | T.StructType) -> list[tuple[FieldRule, str, Column]]:
    """Per rule, the condition under which a row breaks it."""
    stored = {f.name: f.dataType for f in df.schema}
    out = []
    for rule in schema_rules(schema):
        if rule.name not in stored:
            continue
        c = F.col(rule.name)
        out.append((rule, "type", c.isNotNull() & rule.convert(stored[rule.name]).isNull()))
        if rule.required:
            out.append((rule, "required", c.isNull()))
    return out


def validation_errors(df: DataFrame, schema: dict | T.StructType) -> DataFrame:
    """Failures per column and rule over all rows, in one pass."""
    checks = _breaches(df, schema)
    row = df.agg(*[F.count_if(bad).alias(f"_{i}") for i, (_, _, bad) in enumerate(checks)])
    listed = [
        F.struct(F.lit(rule.name).alias("column"), F.lit(what).alias("rule"), F.col(f"_{i}").alias("failures"))
        for i, (rule, what, _) in enumerate(checks)
    ]
    return row.select(F.explode(F.array(*listed)).alias("r")).select("r.*")


def validate(df: DataFrame, schema: dict | T.StructType) -> DataFrame:
    """Valid and invalid rows and the validation rate, over all rows."""
    broken = reduce(lambda a, b: a | b, [bad for _, _, bad in _breaches(df, schema)], F.lit(False))
    counts = df.agg(F.count_if(~broken).alias("valid_rows"), F.count_if(broken).alias("invalid_rows"))
    rate = F.try_divide(F.col("valid_rows"), F.col("valid_rows") + F.col("invalid_rows"))
    return counts.withColumn("validation_rate", F.coalesce(rate, F.lit(0.0)))


def coercion_report(raw: DataFrame, schema: dict | T.StructType, table: str = "") -> DataFrame:
    """Per changed column: types and NULLs before and after, and the failures between."""
    stored = {f.name: f.dataType for f in raw.schema}
    changed = [r for r in schema_rules(schema) if r.name in stored and stored[r.name] != r.spark_type]
    aggs = []
    for i, r in enumerate(changed):
        aggs.append(F.count_if(F.col(r.name).isNull()).alias(f"_b{i}"))
        aggs.append(F.count_if(r.convert(stored[r.name]).isNull()).alias(f"_a{i}"))
    row = raw.agg(F.count(F.lit(1)).alias("_n"), *aggs)
    listed = [
        F.struct(
            F.lit(table).alias("table"),
            F.lit(r.name).alias("column"),
            F.lit(stored[r.name].simpleString()).alias("from_type"),
            F.lit(r.spark_type.simpleString()).alias("to_type"),
            F.col(f"_b{i}").alias("nulls_before"),
            F.col(f"_a{i}").alias("nulls_after"),
            (F.col(f"_a{i}") - F.col(f"_b{i}")).alias("failures"),
        )
        for i, r in enumerate(changed)
    ]
    return row.select(F.explode(F.array(*listed)).alias("r")).select("r.*")


def coercion_totals(reports: DataFrame) -> DataFrame:
    """Changed columns and failures per table, most changed first."""
    return reports.groupBy("table").agg(
        F.count(F.lit(1)).alias("columns_changed"),
        F.count_if(F.col("to_type").isin("int", "bigint")).alias("to_int"),
        F.count_if(F.col("to_type") == "double").alias("to_float"),
        F.count_if(F.col("to_type") == "timestamp").alias("to_datetime"),
        F.count_if(F.col("to_type") == "boolean").alias("to_bool"),
        F.sum("failures").alias("failures"),
    )


# --- reports ------------------------------------------------------------------------------


def query_profile(df: DataFrame, first: int | None = None) -> DataFrame:
    """Rows, NULLs and distinct values of a query result's columns, or of its ``first`` ones."""
    lead = df.select(*df.columns[:first])
    facts = column_facts(lead)
    dtypes = _lookup({f.name: f.dataType.simpleString() for f in lead.schema})
    return facts.select(
        "column",
        dtypes.alias("dtype"),
        F.col("total").alias("rows"),
        F.col("missing").alias("nulls"),
        "n_unique",
    )


def dtype_histogram(df: DataFrame) -> DataFrame:
    """Columns per storage type, with the row count."""
    kinds: dict[str, int] = {}
    for f in df.schema:
        kinds[f.dataType.simpleString()] = kinds.get(f.dataType.simpleString(), 0) + 1
    listed = [F.struct(F.lit(k).alias("dtype"), F.lit(n).cast("long").alias("columns")) for k, n in kinds.items()]
    return df.agg(F.count(F.lit(1)).alias("rows")).select(F.explode(F.array(*listed)).alias("r"), "rows").select("r.*", "rows")


def dataset_metrics(df: DataFrame, max_missing_pct: float = 50.0) -> DataFrame:
    """Rows, columns, repeated rows and missing share, with warnings."""
    holes = reduce(lambda a, b: a + b, [F.when(F.col(f"`{c}`").isNull(), 1).otherwise(0) for c in df.columns])
    rows = df.withColumn("_holes", holes).groupBy(*df.columns, "_holes").agg(F.count(F.lit(1)).alias("_n"))
    m = rows.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum(F.col("_n") * F.col("_holes")), F.lit(0)).alias("_missing"),
    )
    width = len(df.columns)
    pct = F.coalesce(F.try_divide(F.col("_missing") * 100, F.col("rows") * width), F.lit(0.0))
    return m.select(
        "rows",
        F.lit(width).cast("long").alias("columns"),
        "duplicate_rows",
        pct.alias("missing_pct"),
        (F.col("duplicate_rows") > 0).alias("warn_duplicates"),
        (pct > max_missing_pct).alias("warn_missing"),
    )


def key_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def key_density(df: DataFrame, key: str = "account_id", week: str = "yyyywk") -> DataFrame:
    """Rows, distinct keys and weeks, repeats, and rows relative to a full grid."""
    pairs = df.dropna(subset=[key, week]).groupBy(key, week).agg(F.count(F.lit(1)).alias("n"))
    per_key = pairs.groupBy(key).agg(F.sum("n").alias("n"), F.sum(F.col("n") - 1).alias("extra"))
    totals = per_key.agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("n_keys"), F.sum("extra").alias("repeated_rows")
    )
    weeks = df.select(week).dropna().distinct().agg(F.count(F.lit(1))).scalar()
    return totals.withColumn("n_weeks", weeks).withColumn(
        "density", F.try_divide(F.col("rows"), F.col("n_keys") * F.col("n_weeks"))
    )


def target_stats(df: DataFrame, target: str = "days_to_churn", sentinel: int = 9999, flag: str = "churned_flag") -> DataFrame:
    """Target range of churned rows and counts by flag; flags are 0 and 1."""
    t = F.when((F.col(flag) == 1) & (F.col(target) < sentinel), F.col(target))
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(flag) == 1).alias("churned_rows"),
        F.count_if(F.col(flag) == 0).alias("active_rows"),
        F.min(t).alias("target_min"),
        F.max(t).alias("target_max"),
        F.avg(t).alias("target_mean"),
        F.count_if(t < 0).alias("negative_targets"),
    )


def required_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """Required columns, whether they exist, and how many rows lack a value."""
    present = [c for c in required if c in df.columns]
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in present])
    listed = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(c in present).alias("present"),
            (F.col(c) if c in present else F.col("_n")).alias("missing"),
        )
        for c in required
    ]
    return row.select(F.explode(F.array(*listed)).alias("r")).select("r.*")


def flag_date_check(accounts: DataFrame, flag: str = "churned_flag", date: str = "churn_date") -> DataFrame:
    """Accounts by flag and presence of a churn date; flag 1 without and flag 0 with one are contradictions."""
    has = F.col(date).isNotNull()
    grouped = accounts.groupBy(F.col(flag).alias("flag"), has.alias("has_date")).agg(F.count(F.lit(1)).alias("n"))
    contradiction = ((F.col("flag") == 1) & ~F.col("has_date")) | ((F.col("flag") == 0) & F.col("has_date"))
    return grouped.withColumn("contradiction", contradiction)


def column_summary(df: DataFrame) -> DataFrame:
    """Completeness and distinct values per column."""
    facts = column_facts(df)
    pct = F.coalesce(F.try_divide((F.col("total") - F.col("missing")) * 100, F.col("total")), F.lit(0.0))
    return facts.select("column", pct.alias("complete_pct"), "n_unique")

