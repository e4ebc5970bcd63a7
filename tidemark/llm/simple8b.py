"""Token files in Simple-8b: word-aligned coding of ids, written in id order and read back.

A file is a sequence of blocks.  A block holds whole documents, at least
``BLOCK_IDS`` ids unless the file ends, and is decoded on its own:

* its distinct ids by falling frequency (32-bit numbers), so frequent ids have small ranks;
* the ranks, in 64-bit words: the top four bits select how many values of how many bits
  share the other 60; selector 0 is an escape, after which a whole word holds one value
  that 60 bits cannot;
* the ids of its documents and how many tokens each has, and where the block's first
  token stands in the file.

Blocks are rows of a Parquet table, one Spark partition per file number, so they are
committed, retried and read on any store as every other table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import slices
from tidemark.llm.tokens import encoder, with_end

BLOCK_IDS, END = 1 << 16, 2

#: Fixed values of the format: how many values a word holds at selectors 1 to 15, and their bits.
COUNTS = (120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)


def pack(values: np.ndarray) -> np.ndarray:
    """Unsigned values as 64-bit words; each word takes the most values that fit."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64)
    bits = np.zeros(n, np.int16)
    high = values.copy()
    while high.any():
        bits += high > 0
        high >>= np.uint64(1)
    here = np.arange(n, dtype=np.int64)
    chosen = np.zeros(n, np.int8)  # selector by which a word would begin at each place; 0 is the escape
    for selector in range(15, 0, -1):
        count, width = COUNTS[selector - 1], BITS[selector - 1]
        too_wide = np.where(bits > width, here, n)
        first_bad = np.minimum.accumulate(too_wide[::-1])[::-1]
        chosen[(first_bad - here >= count) & (here + count <= n)] = selector
    step = np.array((1, *COUNTS), np.int64)[chosen].tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += step[at]
    first = np.array(starts, np.int64)
    kind = chosen[first]
    size = np.where(kind == 0, 2, 1)
    place = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint64)
    for selector in np.unique(kind).tolist():
        mine = kind == selector
        if selector == 0:
            out[place[mine] + 1] = values[first[mine]]
            continue
        count, width = COUNTS[selector - 1], BITS[selector - 1]
        word = np.full(int(mine.sum()), np.uint64(selector) << np.uint64(60), np.uint64)
        if width:
            for k in range(count):
                word |= values[first[mine] + k] << np.uint64(k * width)
        out[place[mine]] = word
    return out


def unpack(words: np.ndarray) -> np.ndarray:
    """The values of 64-bit words, all words of a selector at once."""
    n = len(words)
    kind = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(n, bool)
    for i in np.flatnonzero(kind == 0).tolist():  # an escaped value may itself look like an escape
        if not raw[i]:
            raw[i + 1] = True
    counts = np.where(raw, 0, np.array((1, *COUNTS), np.int64)[kind])
    ends = np.cumsum(counts)
    begin = ends - counts
    out = np.zeros(int(ends[-1]) if n else 0, np.uint64)
    escapes = np.flatnonzero((kind == 0) & ~raw)
    out[begin[escapes]] = words[escapes + 1]
    for selector in range(1, 16):
        mine = np.flatnonzero((kind == selector) & ~raw)
        count, width = COUNTS[selector - 1], BITS[selector - 1]
        if width:
            mask = np.uint64((1 << width) - 1)
            for k in range(count):
                out[begin[mine] + k] = (words[mine] >> np.uint64(k * width)) & mask
    return out


def encode_block(ids: np.ndarray) -> tuple[bytes, bytes]:
    """A block's distinct ids by falling frequency, and its ranks packed."""
    known, rank_of, counts = np.unique(ids, return_inverse=True, return_counts=True)
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(order), np.uint64)
    rank[order] = np.arange(len(order), dtype=np.uint64)
    return known[order].astype("<u4").tobytes(), pack(rank[rank_of]).astype("<u8").tobytes()


def decode_block(symbols: bytes, packed: bytes) -> np.ndarray:
    return np.frombuffer(symbols, "<u4")[unpack(np.frombuffer(packed, "<u8")).astype(np.int64)]


BLOCK_SCHEMA = "file long, block long, first long, symbols binary, packed binary, doc_ids array<{kind}>, counts array<long>"


def _write(batches: Iterator[pa.RecordBatch], vocabulary: str, end: int, block_ids: int) -> Iterator[pa.RecordBatch]:
    file = TaskContext.get().partitionId()
    encode = encoder(vocabulary)
    held: list[np.ndarray] = []
    names: list[pa.Array] = []
    sizes: list[np.ndarray] = []
    first = block = waiting = 0

    def flushed() -> pa.RecordBatch:
        nonlocal first, block, waiting
        symbols, packed = encode_block(np.concatenate(held))
        docs = pa.concat_arrays(names)
        out = pa.RecordBatch.from_arrays(
            [
                pa.array([file], pa.int64()),
                pa.array([block], pa.int64()),
                pa.array([first], pa.int64()),
                pa.array([symbols], pa.binary()),
                pa.array([packed], pa.binary()),
                pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs),
                pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), pa.array(np.concatenate(sizes), pa.int64())),
            ],
            ["file", "block", "first", "symbols", "packed", "doc_ids", "counts"],
        )
        first, block, waiting = first + waiting, block + 1, 0
        for kept in (held, names, sizes):
            kept.clear()
        return out

    for batch, text in slices(batches, 1):
        ids, offsets = with_end(*encode(text), end)
        a = 0
        while a < len(text):
            b = int(np.searchsorted(offsets, offsets[a] + block_ids - waiting))
            full = b <= len(text)
            b = min(max(b, a + 1), len(text))
            held.append(ids[offsets[a] : offsets[b]])
            names.append(batch.column(0).slice(a, b - a))
            sizes.append(np.diff(offsets[a : b + 1]))
            waiting += int(offsets[b] - offsets[a])
            a = b
            if full:
                yield flushed()
    if waiting:
        yield flushed()


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str, doc_id: str = "doc_id", text: str = "text", end: int = END, block_ids: int = BLOCK_IDS
) -> None:
    """Write the token ids of all texts, each followed by ``end``, in ascending order of ``doc_id``.

    Spark cuts the ids' range into files by a sample and sorts within each; a task
    holds one block at a time.  NULL texts are empty, rows that repeat an id follow each
    other, and an empty table gives an empty folder.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    ordered = docs.select(doc_id, text).repartitionByRange(doc_id).sortWithinPartitions(doc_id, text)
    blocks = ordered.mapInArrow(partial(_write, vocabulary=vocabulary, end=end, block_ids=block_ids), BLOCK_SCHEMA.format(kind=kind))
    blocks.write.option("compression", "zstd").parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            file, first, symbols, packed, names, counts = (batch.column(k).slice(i, 1) for k in range(6))
            sizes = np.asarray(counts.flatten())
            ids = decode_block(symbols[0].as_py(), packed[0].as_py()).astype("<u4", copy=False)
            ends = np.cumsum(sizes)
            data = pa.py_buffer(ids.tobytes())
            at = pa.py_buffer(np.concatenate([[0], ends * 4]).astype(np.int64))
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    names.flatten(),
                    pa.array(np.full(n, file[0].as_py()), pa.int64()),
                    pa.array(first[0].as_py() + ends - sizes, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.Array.from_buffers(pa.large_binary(), n, [None, at, data]).cast(pa.binary()),
                ],
                ["doc_id", "file", "place", "n_tokens", "ids"],
            )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents before it), n_tokens and ids (32-bit little-endian).

    Where each file begins is one row per file, and there are no more files than the
    writing session had shuffle partitions, so that this small table is broadcast and
    the ids are not shuffled.
    """
    blocks = spark.read.parquet(path)
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    totals = blocks.groupBy("file").agg(F.max(F.col("first") + F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("total"))
    before = totals.select("file", (F.sum("total").over(Window.orderBy("file")) - F.col("total")).alias("before"))
    rows = blocks.select("file", "first", "symbols", "packed", "doc_ids", "counts").mapInArrow(
        _read, f"doc_id {kind}, file long, place long, n_tokens long, ids binary"
    )
    return rows.join(F.broadcast(before), "file").select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids")
