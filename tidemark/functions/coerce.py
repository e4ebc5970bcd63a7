"""Forgiving type coercion: a value that does not convert becomes NULL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.weeks import as_column

# The words and patterns the coercions recognise.
TRUE_WORDS = ("true", "yes", "y", "1")
FALSE_WORDS = ("false", "no", "n", "0")
ACTIVE_WORD, INACTIVE_WORD = "active", "inactive"
RELATIVE_DATE_WORDS = "latest|current|previous|next|last"
NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
DATE_PATTERNS = (
    r"^\d{4}-\d{2}-\d{2}$",
    r"^\d{4}-\d{2}$",
    r"^\d{2}/\d{2}/\d{4}$",
    r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$",
    r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}",
)

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, NUMERIC_TYPES)


def _text(c: Column | str) -> Column:
    return F.trim(as_column(c).cast("string"))


def _word(c: Column | str) -> Column:
    return F.lower(_text(c))


def is_number_text(c: Column | str) -> Column:
    """True for decimal text; type suffixes and the words for NaN are not numbers."""
    return _text(c).rlike(NUMBER_PATTERN)


def to_double(c: Column | str) -> Column:
    return F.when(is_number_text(c), _text(c).try_cast("double"))


def to_long(c: Column | str) -> Column:
    """Integer by way of a double, so ``'2.7'`` becomes 2."""
    return to_double(c).try_cast("bigint")


def is_date_text(c: Column | str) -> Column:
    """True when the text has one of the five date shapes and is no relative phrase."""
    text = _text(c)
    shaped = reduce(lambda a, b: a | b, [text.rlike(p) for p in DATE_PATTERNS])
    return shaped & ~F.lower(text).rlike(RELATIVE_DATE_WORDS)


def to_ts(c: Column | str) -> Column:
    text = _text(c)
    parsed = F.coalesce(text.try_cast("timestamp"), F.try_to_timestamp(text, F.lit("MM/dd/yyyy")))
    return F.when(is_date_text(c), parsed)


def to_bool(c: Column | str) -> Column:
    """Word map first; any other non-empty text counts as true."""
    word = _word(c)
    return (
        F.when(word.isin(*TRUE_WORDS, ACTIVE_WORD), F.lit(True))
        .when(word.isin(*FALSE_WORDS, INACTIVE_WORD), F.lit(False))
        .otherwise(F.length(as_column(c).cast("string")) > 0)
    )


def flag_to_int(c: Column | str) -> Column:
    """1 or 0 over mixed encodings (Y/N, Yes/No, true/false, numbers); NULL for the rest."""
    word = _word(c)
    return (
        F.when(word.isin(*TRUE_WORDS), F.lit(1))
        .when(word.isin(*FALSE_WORDS), F.lit(0))
        .otherwise((to_double(c) != 0).cast("int"))
    )


def fold_text(c: Column | str) -> Column:
    """Case-folded, stripped text."""
    return _word(c)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating column; done once, on ingest."""
    return df.select(
        *[
            F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.FloatType, T.DoubleType))
            else F.col(f.name)
            for f in df.schema
        ]
    )


def coerce_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Numeric coercion of those listed columns that exist."""
    return df.select(
        *[to_double(c).alias(c) if c in columns and not is_numeric(df.schema[c].dataType) else F.col(c) for c in df.columns]
    )


def to_float(df: DataFrame, bits: int = 32) -> DataFrame:
    """Every column as 32- or 64-bit float."""
    target = {32: "float", 64: "double"}[bits]
    return df.select(*[to_double(c).cast(target).alias(c) for c in df.columns])


def narrow_floats(df: DataFrame) -> DataFrame:
    """Integer type for floating columns that hold whole numbers only.

    Looks at the data once: one aggregate, one row back, whatever the size.
    """
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    if not floats:
        return df
    whole = df.agg(
        *[
            (F.coalesce(F.bool_and(F.col(c) == F.floor(c)), F.lit(False)) & (F.max(F.abs(F.col(c))) < 9.0e18)).alias(c)
            for c in floats
        ]
    ).first()
    return df.select(*[F.col(c).cast("bigint").alias(c) if c in floats and whole[c] else F.col(c) for c in df.columns])
