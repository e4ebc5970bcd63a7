"""The registered queries of this package and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import conversations, credentials, pii, quality, spelling, warc
from tidemark.llm.common import scratch_path, table, written
from tidemark.llm.exact import exact_groups
from tidemark.llm.html import main_texts
from tidemark.llm.near import near_components
from tidemark.llm.packing import packed
from tidemark.llm.pieces import encoded
from tidemark.llm.separators import document_counts, flat_tokens
from tidemark.llm.simple8b import read_tokens, write_tokens
from tidemark.llm.tokens import vocabulary_path

#: The end-of-document id of flat token files: the vocabulary's own, which ordinary text never yields.
END_OF_DOCUMENT = 49407


def _listed(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _span_digest(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Counts of each base kind, the digest of the base spans, and all spans as text."""
    spans = F.col("spans")
    found_kinds = F.transform(spans, lambda s: s["kind"])
    counts = [(F.size("spans") - F.size(F.array_remove(found_kinds, k))).cast("long").alias(f"n_{k}") for k in kinds]
    base = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return found.select("doc_id", *counts, F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"), _listed(spans).alias("spans"))


def op1_html(spark: SparkSession, folder: str) -> DataFrame:
    return main_texts(table(spark, folder, "pages"))


def op2_separators(spark: SparkSession, folder: str) -> DataFrame:
    blocks = written(flat_tokens(table(spark, folder, "documents"), vocabulary_path(), END_OF_DOCUMENT), "flat")
    return document_counts(blocks, END_OF_DOCUMENT)


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(table(spark, folder, "documents"), digest_all=True).drop("settled_by")


def op9_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_components(table(spark, folder, "documents"))


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    return _span_digest(pii.personal_data(table(spark, folder, "documents")), pii.BASE)


def op5_pieces(spark: SparkSession, folder: str) -> DataFrame:
    path = vocabulary_path("piece_bpe_32k.model")
    found = encoded(table(spark, folder, "documents"), path, decode=True)
    return found.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"),
        "score",
        F.array_join(F.transform("others", lambda o: o["score"].cast("decimal(20,1)").cast("string")), ",").alias("other_scores"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.judged(docs, quality.train(docs, table(spark, folder, "labels"))).drop("content_share")


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return _span_digest(credentials.secrets(docs, credentials.train(docs)), credentials.BASE)


def op8_simple8b(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "simple8b")
    write_tokens(table(spark, folder, "documents"), path, vocabulary_path())
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packed(table(spark, folder, "documents"), vocabulary_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    pages = table(spark, folder, "pages")
    warc.write_archive(pages, path)
    key = pages.schema["page_id"].dataType
    found = warc.captures(warc.read_archive(spark, path))
    return found.withColumns({"page_id": F.col("row_key").cast(key), "refers_to": F.col("refers_to").cast(key)}).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variant_groups(spelling.vocabulary(table(spark, folder, "documents")))


def op13_conversations(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repaired(conversations.damaged(table(spark, folder, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html": op1_html,
    "op2_separators": op2_separators,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_pii": op4_pii,
    "op5_pieces": op5_pieces,
    "op6_quality": op6_quality,
    "op7_secrets": op7_secrets,
    "op8_simple8b": op8_simple8b,
    "op9_near_dedup": op9_near_dedup,
    "op10_packing": op10_packing,
    "op11_warc": op11_warc,
    "op12_spelling": op12_spelling,
    "op13_conversations": op13_conversations,
}

SQL: dict[str, str] = {
    "op3_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare, length(coalesce(text, '')) AS n
            FROM documents),
        h AS (SELECT doc_id, n, sha256(bare) AS text_sha256, length(bare) AS len FROM d),
        g AS (
            SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
                first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id
            FROM h)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g""",
    # Five hexadecimal digits are twenty bits, four letters in base 32.
    "op11_warc": """
        WITH d AS (SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
        g AS (
            SELECT *, row_number() OVER (PARTITION BY html ORDER BY page_id NULLS LAST, url NULLS LAST) AS place,
                first_value(page_id) OVER (PARTITION BY html ORDER BY page_id NULLS LAST, url NULLS LAST) AS first
            FROM d),
        b AS (SELECT *, flatten([[(('0x' || substr(hex, 5 * i + 1, 5))::INTEGER >> s) & 31 for s in [15, 10, 5, 0]] for i in range(8)]) AS letters FROM g)
        SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
            array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', k + 1, 1) for k in letters], '') AS payload_digest,
            CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN place > 1 THEN first END AS refers_to
        FROM b""",
}
