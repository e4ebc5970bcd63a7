"""Exact deduplication by progressive refinement: length, then a hash of the beginning, then a hash of the whole.

Texts are equal when they are identical without white space (the six ASCII
characters).  One pass finds each text's length and the hash of its beginning, and
counts them; the counts are combined before the shuffle, so a group of copies with
a third of all rows is one row per task.  Lengths, and then (length, beginning)
pairs, that occur once settle their rows.  In a second pass the whole text is hashed
only where both occur repeatedly, and those digests alone are grouped.  What is
repeated travels as a membership filter of fixed size, so no text is shuffled, and a
filter that is full costs more hashing but changes no result.

Built-in expressions only.  NULL counts as the empty text, and all texts without a
visible character are equal.  Of equal texts the longest original stays, then the
smallest id; rows that repeat a kept row with its id are all marked as kept.  Columns
are addressed by name, all others are left alone whatever their names, and an empty table
gives an empty result.  An id comes before a missing one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import marked, member_bits, settled

WHITE_SPACE = " \t\n\x0b\x0c\r"

#: Characters whose hash stands for the beginning of a text.
PREFIX = 64


def without_white_space(text: Column) -> Column:
    return reduce(lambda c, ch: F.replace(c, F.lit(ch), F.lit("")), WHITE_SPACE, F.coalesce(text, F.lit("")))


def digest(text: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of the text without white space."""
    return F.sha2(without_white_space(text).cast("binary"), 256)


def _refined(docs: DataFrame, text: str, prefix: int, digest_all: bool) -> DataFrame:
    """The rows with __n (length of the original), __settled and __sha."""
    bare = docs.withColumn("__bare", without_white_space(F.col(f"`{text}`")))
    length, start = F.length("__bare"), F.xxhash64(F.substring("__bare", 1, prefix))
    pairs = settled(bare.groupBy(length.alias("__length"), start.alias("__start")).agg(F.count(F.lit(1)).alias("__rows")))
    lengths = pairs.groupBy("__length").agg(F.sum("__rows").alias("__rows")).filter("__rows > 1")
    by_length = member_bits(lengths, F.col("__length"))
    by_start = member_bits(pairs.filter("__rows > 1"), F.col("__length"), F.col("__start"))
    rows = marked(bare.withColumn("__length", length), by_length, "__same_length", F.col("__length"))
    rows = rows.withColumn("__start", F.when(F.col("__same_length"), F.xxhash64(F.substring("__bare", 1, prefix))))
    rows = marked(rows, by_start, "__same_start", F.col("__length"), F.col("__start"))
    settled_by = (
        F.when(~F.col("__same_length"), F.lit("length")).when(~F.col("__same_start"), F.lit("prefix")).otherwise(F.lit("full"))
    )
    whole = F.sha2(F.col("__bare").cast("binary"), 256)
    return rows.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.length(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("__n"),
        settled_by.alias("__settled"),
        (whole if digest_all else F.when(F.col("__same_length") & F.col("__same_start"), whole)).alias("__sha"),
    )


def _groups(rows: DataFrame, doc_id: str) -> DataFrame:
    """Of each digest that several rows have: the row that stays, and the number of rows."""
    return (
        rows.filter("__settled = 'full'")
        .groupBy(F.col("__sha").alias("__key"))
        .agg(F.count(F.lit(1)).alias("__size"), F.min(F.struct(-F.col("__n"), F.col(doc_id).isNull(), F.col(doc_id).alias("id"))).alias("__first"))
        .filter("__size > 1")
        .select("__key", "__size", F.col("__first.id").alias("__keep"))
    )


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", prefix: int = PREFIX, digest_all: bool = False) -> DataFrame:
    """One row per row of ``docs``: the id, keep_id, group_size, kept, settled_by and text_sha256.

    settled_by names the step that decided: ``length``, ``prefix`` or ``full``.
    text_sha256 is NULL where the whole text was never hashed, unless ``digest_all``
    asks for the digests of all rows.
    """
    key = F.col("__id")
    source = docs.select(F.col(f"`{doc_id}`").alias("__id"), F.col(f"`{text}`").alias("__text"))
    rows = settled(_refined(source, "__text", prefix, digest_all).drop("__text"))
    groups = settled(_groups(rows, "__id"))
    early = rows.filter("__settled <> 'full'").withColumns({"__size": F.lit(None).cast("long"), "__keep": key})
    late = rows.filter("__settled = 'full'").join(groups, F.col("__sha") == F.col("__key"), "left").drop("__key")
    alone = F.col("__size").isNull()
    return early.unionByName(late).select(
        key.alias(doc_id),
        F.when(alone, key).otherwise(F.col("__keep")).alias("keep_id"),
        F.coalesce("__size", F.lit(1)).alias("group_size"),
        (alone | F.col("__keep").eqNullSafe(key)).alias("kept"),
        F.col("__settled").alias("settled_by"),
        F.col("__sha").alias("text_sha256"),
    )


def without_exact_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", prefix: int = PREFIX) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows that length or beginning settle pass straight through; only rows that share
    both with another row are joined with the choice of their group.
    """
    boxed = docs.select(F.col(f"`{doc_id}`").alias("__id"), F.col(f"`{text}`").alias("__text"), F.struct("*").alias("__row"))
    rows = _refined(boxed, "__text", prefix, False)
    groups = settled(_groups(rows.select("__id", "__n", "__settled", "__sha"), "__id"))
    early = rows.filter("__settled <> 'full'").select("__row.*")
    late = rows.filter("__settled = 'full'").join(groups, F.col("__sha") == F.col("__key"), "left")
    return early.unionByName(late.filter(F.col("__size").isNull() | F.col("__keep").eqNullSafe(F.col("__id"))).select("__row.*"))
