"""A corpus pipeline from documents to packed training sequences.

Every stage reads what the one before wrote and works on all of it:

1. quality rules: documents that the rules or the line labels reject go;
2. exact deduplication: of equal texts one document stays;
3. near deduplication: of each group of near copies one document stays;
4. secret scan: secrets in the texts are replaced by a mask, and characters counted anew;
5. packing: the texts' tokens in sequences of at most 4096.

Stages 1 to 4 return the columns of their input.  NULL texts count as empty and are
rejected by stage 1.  An empty table passes through all stages as an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import credentials, quality
from tidemark.llm.common import table, written
from tidemark.llm.exact import without_exact_copies
from tidemark.llm.near import without_near_copies
from tidemark.llm.packing import packed
from tidemark.llm.tokens import vocabulary_path
from tidemark.session import tune

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rules and the labelled lines keep; the field is fitted on this stage's labelled documents."""
    tune(spark)
    return quality.without_rejected(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    tune(spark)
    return without_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    tune(spark)
    return without_near_copies(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the secrets in their texts; the network is trained on this stage's findings."""
    tune(spark)
    return credentials.without_secrets(docs, credentials.train(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a sequence, with its token ids."""
    tune(spark)
    return packed(docs, vocabulary_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: The stages cannot be said in SQL; a brute-force version tests them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of ``sf_dir``, each stage's rows written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
