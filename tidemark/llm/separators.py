"""Token counts of documents in flat token files that have no index.

A flat file is a sequence of ids of a fixed width; a document ends at an
end-of-document id and may stretch over any number of blocks.  Every block is searched
for the id on its own, vectorised.  What a block cannot know, how many documents ended
before it and where the last of them did, is carried over by a prefix scan: over the
blocks of a chunk, then over the chunks of a file, so that a file with any number of blocks
is no single task's work but for one row per chunk.

Blocks are rows (file, block, first, data), ``first`` counting tokens; NULL or empty data
has no tokens.  A file whose last tokens are not ended has an open last document.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import settled, slices
from tidemark.llm.tokens import encoder, with_end

#: Tokens per block, bytes per token, and blocks per chunk of the prefix scan.
BLOCK, WIDTH, CHUNK = 1 << 16, 4, 1024

BLOCKS = "file {kind}, block long, first long, data binary"


def _flat(batches: Iterator[pa.RecordBatch], vocabulary: str, end: int, block: int, width: int) -> Iterator[pa.RecordBatch]:
    file = TaskContext.get().partitionId()
    encode = encoder(vocabulary, special_as_text=True)
    rest = np.zeros(0, np.uint32)
    number = 0

    def cut(ids: np.ndarray, last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal number, rest
        at = 0
        while len(ids) - at >= block or (last and at < len(ids)):
            data = ids[at : at + block].astype(f"<u{width}").tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int64()), pa.array([number], pa.int64()), pa.array([number * block], pa.int64()), pa.array([data], pa.binary())],
                ["file", "block", "first", "data"],
            )
            at, number = at + block, number + 1
        rest = ids[at:]

    for _, text in slices(batches, 0):
        ids, _ = with_end(*encode(text), end)
        yield from cut(np.concatenate([rest, ids]), False)
    yield from cut(rest, True)


def flat_tokens(docs: DataFrame, vocabulary: str, end: int, text: str = "text", block: int = BLOCK, width: int = WIDTH) -> DataFrame:
    """The documents of each partition as one flat file of ids, every document followed by ``end``, cut into blocks."""
    return docs.select(text).mapInArrow(partial(_flat, vocabulary=vocabulary, end=end, block=block, width=width), BLOCKS.format(kind="long"))


def flat_files(spark: SparkSession, path: str, block: int = BLOCK, width: int = WIDTH) -> DataFrame:
    """Blocks of flat binary files below ``path``; a file is read by one task, so files of up to a gigabyte are meant."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")
    size = F.floor(F.length("content") / width).cast("long")
    numbers = F.sequence(F.lit(0).cast("long"), F.floor((size - 1) / block).cast("long"))
    blocks = files.filter(size > 0).select("file", "content", F.explode(numbers).alias("block"))
    data = F.substring("content", (F.col("block") * block * width + 1).cast("int"), F.lit(block * width))
    return blocks.select("file", "block", (F.col("block") * block).alias("first"), data.alias("data"))


def _search(batches: Iterator[pa.RecordBatch], end: int, width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data = batch.column(3).to_pylist()
        found, tokens = [], []
        for d in data:
            ids = np.frombuffer(d or b"", f"<u{width}")
            tokens.append(len(ids))
            found.append(np.flatnonzero(ids == end).astype(np.int32))
        bounds = np.concatenate([[0], np.cumsum([len(f) for f in found])])
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(found) if found else np.zeros(0, np.int32)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(tokens, pa.int64()), lists], ["file", "block", "first", "tokens", "ends"]
        )


def document_counts(blocks: DataFrame, end: int, width: int = WIDTH, chunk: int = CHUNK) -> DataFrame:
    """One row per document: file, document (its number in the file), start, n_tokens (without the end) and ended."""
    source = blocks.select("file", "block", "first", "data")
    kind = source.schema["file"].dataType.simpleString()
    found = settled(
        source.mapInArrow(partial(_search, end=end, width=width), f"file {kind}, block long, first long, tokens long, ends array<int>")
    ).withColumn("chunk", F.floor(F.col("block") / chunk))
    here, last = F.size("ends").cast("long"), F.col("first") + F.element_at("ends", -1)
    each = found.select("file", "chunk", "block", "first", "tokens", "ends", here.alias("here"), F.when(F.size("ends") > 0, last).alias("last"))

    def before(*by: str, order: str) -> list:
        w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return [F.coalesce(F.sum("here").over(w), F.lit(0)), F.max("last").over(w)]

    chunks = each.groupBy("file", "chunk").agg(F.sum("here").alias("here"), F.max("last").alias("last"))
    count, end_before = before("file", order="chunk")
    chunks = chunks.select("file", "chunk", count.alias("docs_before"), end_before.alias("end_before"))
    count, end_before = before("file", "chunk", order="block")
    scanned = (
        each.select("file", "chunk", "block", "first", "ends", count.alias("in_chunk"), end_before.alias("end_in_chunk"))
        .join(chunks, ["file", "chunk"])
        .select(
            "file",
            "first",
            "ends",
            (F.col("docs_before") + F.col("in_chunk")).alias("document"),
            (F.coalesce("end_in_chunk", "end_before", F.lit(-1)) + 1).alias("start"),
        )
    )
    rows = scanned.select("file", "first", "document", "start", "ends", F.posexplode("ends").alias("k", "at")).select(
        "file",
        (F.col("document") + F.col("k")).alias("document"),
        F.when(F.col("k") == 0, F.col("start")).otherwise(F.col("first") + F.get("ends", F.col("k") - 1) + 1).alias("start"),
        (F.col("first") + F.col("at")).alias("end"),
        F.lit(True).alias("ended"),
    )
    files = each.groupBy("file").agg(F.sum("here").alias("document"), F.max("last").alias("last"), F.max(F.col("first") + F.col("tokens")).alias("end"))
    start = F.coalesce(F.col("last") + 1, F.lit(0))
    open_ = files.filter(start < F.col("end")).select("file", "document", start.alias("start"), "end", F.lit(False).alias("ended"))
    return rows.unionByName(open_).select("file", "document", "start", (F.col("end") - F.col("start")).alias("n_tokens"), "ended")
