"""Packing documents into fixed-length sequences: first-fit decreasing over a tournament tree, in random groups.

Each document's tokens are cut into full sequences and one rest.  Rests are dealt by a
hash of the row and of the partition it is read in into groups of about ``group_docs`` documents, and every group is packed on its
own: rests by falling length, each into the first sequence with room, which a
tournament tree over the sequences' free places finds in logarithmic time.  At last a
group's open sequences are closed: the emptiest one is cut up to fill the gaps of the
others, and what then remains is cut into sequences whose lengths are powers of two,
which need no padding.

The plan depends only on the rows and the partition each is read in, not on their order,
so a repeated task gives the same sequences.  Rows with one id, or without one, are dealt
by their texts, and equal rows by their partitions, so no id makes a group large.  A task
holds one group: rests of less than a sequence each.  Long documents'
full sequences are dealt apart from the rests and evenly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices
from tidemark.llm.shingles import GOLDEN, mixed, release
from tidemark.llm.tokens import encoder, with_end

LENGTH, END, GROUP_DOCS, GROUP_CHARS = 4096, 2, 2000, 16 << 20

#: Bytes of text encoded at once, unless one text alone is longer: tokens and pieces of a slice stand in memory beside it.
SLICE = 1 << 20

#: Sequences of one group have numbers below this.
GROUP_SEQUENCES = 1 << 24


class TournamentTree:
    """Free places of a row of bins; each inner node knows the most free one below it."""

    def __init__(self, bins: int, capacity: int) -> None:
        self.leaves = 1 << max(bins - 1, 0).bit_length()
        self.most = [capacity] * (2 * self.leaves)

    def take(self, size: int) -> int:
        """The first bin with room for ``size``, whose room shrinks by it."""
        most, node = self.most, 1
        while node < self.leaves:
            node *= 2
            if most[node] < size:
                node += 1
        bin_ = node - self.leaves
        most[node] -= size
        while node > 1:
            node //= 2
            best = most[2 * node] if most[2 * node] >= most[2 * node + 1] else most[2 * node + 1]
            if most[node] == best:
                break
            most[node] = best
        return bin_


Part = tuple[int, int, int]  #: (item, first of its tokens, number of tokens)


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[list[Part]]:
    """Sequences of whole items; equal sizes keep their order."""
    tree = TournamentTree(len(sizes), capacity)
    bins: list[list[Part]] = []
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = tree.take(sizes[item])
        if at == len(bins):
            bins.append([])
        bins[at].append((item, 0, sizes[item]))
    return bins


def without_gaps(bins: list[list[Part]], capacity: int) -> list[list[Part]]:
    """The same tokens in sequences that are full or have a power of two as their length."""
    full = [b for b in bins if sum(p[2] for p in b) == capacity]
    rest = sorted(([*b] for b in bins if sum(p[2] for p in b) < capacity), key=lambda b: -sum(p[2] for p in b))
    loose: list[Part] = []
    while rest:
        bin_ = rest.pop(0)
        room = capacity - sum(p[2] for p in bin_)
        while room and (loose or rest):
            if not loose:
                loose = rest.pop()
            item, first, size = loose.pop()
            used = min(size, room)
            bin_.append((item, first, used))
            room -= used
            if used < size:
                loose.append((item, first + used, size - used))
        if room:
            loose = bin_
            break
        full.append(bin_)
    left = sum(p[2] for p in loose)
    for power in (1 << k for k in range(left.bit_length() - 1, -1, -1) if left >> k & 1):
        bin_, room = [], power
        while room:
            item, first, size = loose.pop()
            used = min(size, room)
            bin_.append((item, first, used))
            room -= used
            if used < size:
                loose.append((item, first + used, size - used))
        full.append(bin_)
    return full


def _cut(batches: Iterator[pa.RecordBatch], vocabulary: str, end: int, length: int, groups: int, full_groups: int) -> Iterator[pa.RecordBatch]:
    release()
    encode = encoder(vocabulary)
    small = encode.full.get_vocab_size() <= 1 << 16
    for batch, text in slices(batches, 1, SLICE):
        ids, offsets = with_end(*encode(text), end)
        total = np.diff(offsets)
        pieces = -(-total // length)
        doc = np.repeat(np.arange(len(total)), pieces)
        start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * length
        size = np.minimum(length, total[doc] - start)
        random = np.asarray(batch.column(2)).view(np.uint64)[doc]
        apart = mixed(random + (start // (16 * length) + 1).astype(np.uint64) * GOLDEN) % np.uint64(full_groups)
        key = np.where(size < length, (mixed(random) % np.uint64(groups)).astype(np.int64), groups + apart.astype(np.int64))
        flat = ids.astype("<u2" if small else "<u4", copy=False)
        at = pa.py_buffer(np.append(offsets[doc] + start, offsets[-1]).astype(np.int64) * flat.itemsize)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(key),
                batch.column(0).take(pa.array(doc)),
                pa.array(start),
                pa.array(size),
                pa.array(total[doc]),
                pa.Array.from_buffers(pa.large_binary(), len(doc), [None, at, pa.py_buffer(flat.tobytes())]).cast(pa.binary()),
            ],
            ["key", "doc", "start", "length", "total", "ids"],
        )


def _pack(group: pa.Table, groups: int, length: int) -> pa.Table:
    key = group["key"][0].as_py()
    width = len(group["ids"][0].as_py()) // group["length"][0].as_py()
    docs, starts = group["doc"].to_pylist(), group["start"].to_pylist()
    sizes, totals, ids = group["length"].to_pylist(), group["total"].to_pylist(), group["ids"].to_pylist()
    order = sorted(range(len(group)), key=lambda i: (docs[i] is not None, docs[i], starts[i], totals[i], ids[i]))
    if key < groups:
        bins = without_gaps(first_fit_decreasing([sizes[i] for i in order], length), length)
    else:
        bins = [[(k, 0, length)] for k in range(len(order))]
    if len(bins) >= GROUP_SEQUENCES:
        raise ValueError("a group has too many sequences; make groups smaller")
    out: dict[str, list] = {c: [] for c in ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")}
    for number, parts in enumerate(bins):
        offset = 0
        for item, first, size in parts:
            i = order[item]
            data = np.frombuffer(ids[i], f"<u{width}")[first : first + size].astype("<u4").tobytes()
            row = (docs[i], starts[i] + first, size, data, totals[i], key * GROUP_SEQUENCES + number, offset)
            for column, value in zip(out.values(), row, strict=True):
                column.append(value)
            offset += size
    return pa.table([pa.array(out["doc_id"], group.schema.field("doc").type), *[pa.array(v, pa.binary() if c == "ids" else pa.int64()) for c, v in out.items() if c != "doc_id"]], names=list(out))


def packed(
    docs: DataFrame,
    vocabulary: str,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    end: int = END,
    group_docs: int = GROUP_DOCS,
    group_chars: int = GROUP_CHARS,
    seed: int = 0,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (32-bit little-endian), doc_tokens, sequence_id and offset.

    Every text gets ``end`` after its ids, so NULL and empty texts are one token.  The
    number of groups follows the number of rows and characters; an empty table has no
    pieces.  Rows that repeat an id are packed as documents of their own.
    """
    source = docs.select(F.col(f"`{doc_id}`").alias("doc"), F.col(f"`{text}`").alias("text"))
    rows, chars = source.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    groups, full_groups = max(1, -(-rows // group_docs)), max(1, -(-chars // group_chars))
    kind = source.schema["doc"].dataType.simpleString()
    pieces = source.withColumn("random", F.xxhash64("doc", "text", F.lit(seed), F.spark_partition_id())).mapInArrow(
        partial(_cut, vocabulary=vocabulary, end=end, length=length, groups=groups, full_groups=full_groups),
        f"key long, doc {kind}, start long, length long, total long, ids binary",
    )

    def pack(group: pa.Table) -> pa.Table:
        return _pack(group, groups, length)

    return pieces.groupBy("key").applyInArrow(
        pack,
        f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
    )
