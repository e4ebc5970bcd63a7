"""Registry of runnable queries and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.inputs import Inputs, sql_with
from tidemark.session import tune


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    build: Callable[[Inputs], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Inputs(tune(spark), folder))


QUERIES: dict[str, Query] = {}


def add(name: str, covers: str, build: Callable[[Inputs], DataFrame], sql: str | None = None) -> None:
    """Register a query: the inventory entries it covers and, where SQL can say it, its SQL."""
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")
    QUERIES[name] = Query(name, tuple(covers.split()), build, None if sql is None else sql_with(sql))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Floating columns rounded, so that summation order cannot show."""
    floating = (T.DoubleType, T.FloatType)
    return df.select(
        *[F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, floating) else F.col(f.name) for f in df.schema]
    )


def longs(df: DataFrame) -> DataFrame:
    """Integer columns widened to one type."""
    small = (T.IntegerType, T.ShortType, T.ByteType)
    return df.select(
        *[F.col(f.name).cast("bigint").alias(f.name) if isinstance(f.dataType, small) else F.col(f.name) for f in df.schema]
    )


def shown(df: DataFrame, digits: int = 6) -> DataFrame:
    return longs(rounded(df, digits))
