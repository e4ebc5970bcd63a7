"""CSV, JSON and parquet files in and out."""

from __future__ import annotations

import os
import re
from urllib.parse import unquote, urlparse

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.coerce import to_double
from tidemark.operators.quality import infer_schema, profile

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
FLOAT_DIGITS = 6
_INDEX_COLUMN = re.compile(r"^(_c\d+|Unnamed.*)?$")


# --- CSV in -----------------------------------------------------------------------------


def read_csv(spark: SparkSession, path: str, keep: list[str] | None = None) -> DataFrame:
    """CSV with header, as text, without unnamed index columns; optionally only some columns."""
    df = spark.read.csv(path, header=True, multiLine=False, escape='"')
    named = [c for c in df.columns if not _INDEX_COLUMN.match(c)]
    return df.select(*[F.col(f"`{c}`") for c in named if keep is None or c in keep])


def keep_list(metadata: str, columns: list[str]) -> list[str]:
    """Columns that a description text keeps.

    The first marked line that mentions a column decides: ``(+)`` and ``(=)``
    keep it, ``(-)`` and ``(?)`` drop it.  A column without a line is dropped.
    """
    lines = [line.strip() for line in metadata.splitlines()]

    def mark(column: str) -> str | None:
        return next((s[:3] for s in lines if column in s and s[:3] in ("(+)", "(=)", "(-)", "(?)")), None)

    return [c for c in columns if mark(c) in ("(+)", "(=)")]


def read_csv_described(spark: SparkSession, path: str, metadata: str) -> DataFrame:
    """CSV reduced to the columns its description keeps, with numeric values only."""
    df = read_csv(spark, path)
    return numeric_values(df.select(*keep_list(metadata, df.columns)))


def read_csv_dir(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], list[str]]:
    """Every CSV of a folder by stem, each with its own columns, and the names that failed; one failure stops no other.

    A CSV is a file, or a folder of parts as Spark writes them, on any store.
    """
    options = {"pathGlobFilter": "*.csv", "recursiveFileLookup": "true"}
    top = urlparse(folder if "://" in folder else os.path.abspath(folder)).path.rstrip("/") + "/"
    listed = spark.read.options(**options).text(folder).inputFiles()
    inside = [unquote(urlparse(f).path).removeprefix(top) for f in listed]
    tables: dict[str, DataFrame] = {}
    failed = []
    for name in sorted({f.split("/", 1)[0] for f in inside}):
        stem = name.removesuffix(".csv")
        try:
            df = read_csv(spark, f"{folder}/{name}")
            if not df.columns:
                raise ValueError("no columns")
            tables[stem] = df
        except (AnalysisException, PySparkException, ValueError):
            failed.append(stem)
    return tables, failed


def numeric_values(df: DataFrame) -> DataFrame:
    """Numeric text to numbers, other text to NULL; columns of other types stay."""
    return df.select(
        *[to_double(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema]
    )


# --- CSV and JSON out ---------------------------------------------------------------------


def csv_text(df: DataFrame) -> DataFrame:
    """Columns as the CSV format wants them: floats with six decimals, plain timestamps."""
    out = []
    for f in df.schema:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = F.format_string(f"%.{FLOAT_DIGITS}f", c.cast("double"))
            c = F.when(F.col(f.name).isNotNull(), c)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, TIMESTAMP_FORMAT)
        out.append(c.alias(f.name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """CSV folder with header; NULL is empty.  Written in parallel, one part per partition."""
    chosen = df.select(*columns) if columns else df
    csv_text(chosen).write.mode("overwrite").csv(path, header=True, nullValue="", emptyValue="", escape='"')


def save_summary(summary: DataFrame, path: str, fmt: str = "both") -> list[str]:
    """A small report as CSV, JSON or both; gives the paths written."""
    if fmt not in ("csv", "json", "both"):
        raise ValueError("fmt is csv, json or both")
    done = []
    if fmt in ("csv", "both"):
        write_csv(summary, f"{path}.csv")
        done.append(f"{path}.csv")
    if fmt in ("json", "both"):
        summary.write.mode("overwrite").json(f"{path}.json", ignoreNullFields=False)
        done.append(f"{path}.json")
    return done


# --- typed storage -------------------------------------------------------------------------


def write_table(df: DataFrame, path: str, fmt: str = "parquet", columns: list[str] | None = None, compression: str | None = None) -> None:
    """Type-preserving storage (parquet, orc) or text (csv, json)."""
    if fmt == "csv":
        write_csv(df, path, columns)
        return
    writer = (df.select(*columns) if columns else df).write.mode("overwrite").format(fmt)
    (writer.option("compression", compression) if compression else writer).save(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def export_bundle(df: DataFrame, path: str) -> dict[str, str]:
    """Data as CSV, its inferred schema and its column profile side by side."""
    spark = df.sparkSession
    write_csv(df, f"{path}/data")
    schema = infer_schema(df)
    spark.createDataFrame([(schema.json(),)], "value string").write.mode("overwrite").text(f"{path}/schema")
    write_csv(profile(df), f"{path}/profile")
    return {"data": f"{path}/data", "schema": f"{path}/schema", "profile": f"{path}/profile"}


def export_many(tables: dict[str, DataFrame], path: str) -> tuple[dict[str, dict[str, str]], dict[str, str]]:
    """Export several tables; one that fails does not stop the others."""
    done: dict[str, dict[str, str]] = {}
    failed: dict[str, str] = {}
    for name, df in tables.items():
        try:
            done[name] = export_bundle(df, f"{path}/{name}")
        except PySparkException as problem:
            failed[name] = str(problem).splitlines()[0]
    return done, failed


def append_with_retention(df: DataFrame, path: str, date_column: str, as_of: str, days: int = 90) -> DataFrame:
    """Put a report into a date-partitioned store and keep the store's last ``days`` days.

    A day is a partition: one that the report has replaces the one in the store, so a
    repeated run doubles nothing, and older ones are removed from the store.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date_column).parquet(path)
    floor = F.date_sub(F.lit(as_of).cast("date"), days)
    old = spark.read.parquet(path).where(F.col(date_column) < floor).select(F.col(date_column).cast("string")).distinct()
    for (day,) in old.collect():
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{date_column}={day}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return spark.read.schema(df.schema).parquet(path).where(F.col(date_column) >= floor).select(*df.columns)


def first_rows(df: DataFrame, key: list[str], n: int = 1000) -> DataFrame:
    """The first ``n`` rows in key order, for a look at a dataset."""
    return df.orderBy(*key).limit(n)
