"""Table schemas: rules, lookup, enforcement and listing.

A schema is a dictionary ``{"fields": {column: {"type", "required", "validator",
"metadata"}}}`` (the JSON form) or a ``StructType``.  Enforcement converts what
it can and turns the rest into NULL; it never fails on data.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.coerce import flag_to_int, is_numeric, to_bool, to_double, to_long, to_ts

SPARK_TYPES: dict[str, T.DataType] = {
    "flag": T.IntegerType(),
    "int": T.LongType(),
    "float": T.DoubleType(),
    "bool": T.BooleanType(),
    "datetime": T.TimestampType(),
    "str": T.StringType(),
}
SEARCH_ORDERS = {"raw": ("raw", "join_rules"), "join_rules": ("join_rules", "raw")}


@dataclass(frozen=True)
class FieldRule:
    """What a column must be: ``target`` is a key of :data:`SPARK_TYPES`."""

    name: str
    target: str
    required: bool

    @property
    def spark_type(self) -> T.DataType:
        return SPARK_TYPES[self.target]

    def convert(self, source: T.DataType, column: Column | None = None) -> Column:
        c = F.col(self.name) if column is None else column
        if self.target == "flag":
            return flag_to_int(c)
        if self.target == "int":
            return c.try_cast("bigint") if is_numeric(source) else to_long(c)
        if self.target == "float":
            return c.cast("double") if is_numeric(source) else to_double(c)
        if self.target == "bool":
            return c if isinstance(source, T.BooleanType) else to_bool(c)
        if self.target == "datetime":
            timed = (T.DateType, T.TimestampType, T.TimestampNTZType)
            return c.cast("timestamp") if isinstance(source, timed) else to_ts(c)
        return c.cast("string")


def _target(field: dict) -> str:
    base = str(field.get("type") or field.get("metadata", {}).get("actual_dtype", "str"))
    base = base.removeprefix("Optional[").removesuffix("]").removeprefix("inferred_")
    if base == "int" and field.get("validator") == "bool_to_int":
        return "flag"
    return base if base in SPARK_TYPES else "str"


def _target_of_type(dtype: T.DataType) -> str:
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "int"
    if is_numeric(dtype):
        return "float"
    if isinstance(dtype, T.BooleanType):
        return "bool"
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    return "str"


def schema_rules(schema: dict | T.StructType) -> list[FieldRule]:
    """One rule per field.  ``Optional[...]`` counts as its inner type."""
    if isinstance(schema, T.StructType):
        return [
            FieldRule(f.name, "flag" if f.metadata.get("validator") == "bool_to_int" else _target_of_type(f.dataType), not f.nullable)
            for f in schema
        ]
    if "fields" not in schema:
        raise ValueError("a schema needs a 'fields' entry")
    return [FieldRule(n, _target(f), bool(f.get("required", False))) for n, f in schema["fields"].items()]


def enforce_schema(df: DataFrame, schema: dict | T.StructType) -> DataFrame:
    """Cast the columns the schema names, leave the others; one projection."""
    rules = {r.name: r for r in schema_rules(schema)}
    return df.select(
        *[rules[f.name].convert(f.dataType).alias(f.name) if f.name in rules else F.col(f.name) for f in df.schema]
    )


def enforce_defaults(df: DataFrame, flag: str = "churned_flag", key: str = "account_id") -> DataFrame:
    """What a query without a schema gets: its churn flag and its account key coerced."""
    known = {flag: flag_to_int(flag), key: to_long(key)}
    return df.select(*[known[c].alias(c) if c in known else F.col(c) for c in df.columns])


def schema_fields(spark: SparkSession, schema: dict | T.StructType) -> DataFrame:
    """Listing of a schema: column, declared type, Spark type, nullable."""
    rows = [(r.name, r.target, r.spark_type.simpleString(), not r.required) for r in schema_rules(schema)]
    return spark.createDataFrame(rows, "column string, type string, spark_type string, nullable boolean")


def table_fields(df: DataFrame) -> DataFrame:
    """Listing of a table's own columns."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, spark_type string, nullable boolean")


def find_schema(
    table: str, base_dir: str, context: str = "raw", override: str | None = None, fallbacks: tuple[str, ...] = ()
) -> str:
    """Path of a table's schema file: the override if it exists, else by context, else the fallbacks."""
    if override and _exists(override):
        return override
    if context not in SEARCH_ORDERS:
        raise ValueError(f"context must be one of {sorted(SEARCH_ORDERS)}")
    places = [os.path.join(base_dir, d) for d in SEARCH_ORDERS[context]] + list(fallbacks)
    tried = [os.path.join(p, f"{table}_schema.json") for p in places]
    for path in tried:
        if _exists(path):
            return path
    raise FileNotFoundError(f"no schema for {table}; looked at {tried}")


def load_schema(path: str) -> dict:
    """A schema file's content; what is no local file, a folder of parts or a remote path, Spark reads."""
    if os.path.isfile(path):
        with open(path, encoding="utf-8") as f:
            return json.load(f)
    return json.loads(SparkSession.active().read.text(path, wholetext=True).first()[0])


def save_schema(spark: SparkSession, schema: dict, path: str) -> None:
    """Write a schema file where ``load_schema`` finds it, on any store."""
    spark.createDataFrame([(json.dumps(schema),)], "value string").coalesce(1).write.text(path)


def _exists(path: str) -> bool:
    if os.path.exists(path):
        return True
    if "://" not in path:
        return False
    try:
        SparkSession.active().read.text(path)
    except AnalysisException:
        return False
    return True
