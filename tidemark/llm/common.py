"""Small helpers shared by the operators: cutting lineage, bounded membership filters, slicing Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

#: 64-bit words of a membership filter: 2**18 words are 16 million bits, a few MB as a broadcast table.
FILTER_WORDS = 1 << 18

#: Bytes of text that a Python step works on at once, unless one text alone is longer.
SLICE_BYTES = 2 << 20


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written as a table in the shared folder and read back: its lineage is cut and its size known.

    A checkpoint would carry over the size that was estimated for the plan behind it, and
    in a loop of joins such estimates grow without bound.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(df: DataFrame) -> DataFrame:
    return written(df, "step")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _slot(words: int, *keys: Column) -> tuple[Column, Column]:
    place = F.pmod(F.xxhash64(*keys), F.lit(words * 64))
    return F.floor(place / 64).cast("long"), F.pmod(place, F.lit(64)).cast("int")


def member_bits(df: DataFrame, *keys: Column, words: int = FILTER_WORDS) -> DataFrame:
    """A Bloom filter of the keys with one hash, as rows (__word, __bits): at most ``words`` rows at any input size."""
    word, bit = _slot(words, *keys)
    return (
        df.select(word.alias("__word"), bit.alias("__bit"))
        .groupBy("__word")
        .agg(F.bit_or(F.expr("shiftleft(1L, __bit)")).alias("__bits"))
    )


def marked(df: DataFrame, bits: DataFrame, name: str, *keys: Column, words: int = FILTER_WORDS) -> DataFrame:
    """The frame with a boolean column: false proves that the keys are not in the filter.

    The filter's size is bounded by its number of words, so broadcasting it is safe
    at any input size.  A full filter says true more often, never false wrongly.
    """
    word, bit = _slot(words, *keys)
    found = F.broadcast(bits.withColumnsRenamed({"__word": f"__word_{name}", "__bits": f"__bits_{name}"}))
    kept = df.columns
    return (
        df.withColumn("__at", word)
        .join(found, F.col("__at") == F.col(f"__word_{name}"), "left")
        .select(*[F.col(f"`{c}`") for c in kept], (F.coalesce(F.getbit(F.col(f"__bits_{name}"), bit), F.lit(0)) == 1).alias(name))
    )


def slices(batches: Iterator[pa.RecordBatch], column: int, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Row ranges of at most ``limit`` bytes of text (one row at least), with the text column, NULL as empty."""
    for batch in batches:
        text = batch.column(column)
        text = pc.fill_null(text, "") if text.null_count else text
        sizes = pc.binary_length(text).to_pylist()
        start = total = 0
        for i, n in enumerate(sizes):
            if i > start and total + n > limit:
                yield batch.slice(start, i - start), text.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < len(sizes):
            yield batch.slice(start), text.slice(start)
