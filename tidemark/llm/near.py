"""Near duplicates by fast similarity sketching, banding and exact verification.

A document is the set of its distinct shingles of five words (letters A to Z in
lower case; a shorter text is one shingle, a text without words none).  Two
documents are linked when their sets have a Jaccard similarity of at least 0.75,
and linked documents form components.

1. *Sketch.*  Each set is thrown into ``bins`` bins in rounds (Dahlgaard, Knudsen and
   Thorup, 2017).  In round i a set's elements go to random bins with the value i plus a
   random fraction, and each bin keeps its least value; from round ``bins`` on, all
   elements go to bin i - ``bins``.  A set is done when all its bins are filled, usually
   after two rounds, so a sketch costs little more than one hash per shingle, and as many
   coordinates agree as sets are similar.
2. *Classes.*  Rows with the same set are one class, found by a combined aggregate, so
   thousands of copies count once.
3. *Banding.*  Four coordinates make a band; two sets with similarity 0.75 share none of
   the 32 bands with a probability of 0.000005, and 0.0000003 at 0.8.
4. *Verification on full sets.*  The class that shares most buckets is a bucket's pivot,
   as a rule the text that the others are copies of.  Each class is compared with the
   best of its pivots.  Buckets that then still hold several components get one
   reference, the best pivot of their largest component, and each of their classes is
   compared with it; those outside that component also with the next best ones.
   Classes of different components in such a bucket are left; of each,
   its overlap b with the reference is known.  Two sets of n and m shingles can only be
   linked if min(b, b') is large enough for n + m, which ranges of size find, or if they
   share shingles that the reference lacks, which a join on those finds and counts.
   Shingles of that kind with many owners are added to the reference before, so that each
   class meets few others by each of the rest.  Pairs that either way leaves open are
   compared.  So no bucket is cut off and no partner left
   out, yet of a large group of copies around one text only those pairs meet that changed
   alike.

Rows of a hot class or bucket are combined before the shuffle or split by Spark in
joins.  Nothing is collected to the driver but the counts of what is left to do.

NULL texts count as empty.  Rows that repeat an id with different texts are documents of
their own, each linked by its own text; rows without an id belong to the component of other rows with their set, or to none, and no
filter drops them.  Other columns may have any names, and an empty table has no components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import marked, member_bits, settled, slices
from tidemark.llm.shingles import GOLDEN, MIX_1, distinct_shingles, mixed

BINS, ROWS, SIZE, PERCENT, REFERENCES = 128, 4, 5, 75, 3


def _salt(i: int) -> np.uint64:
    return np.uint64(i * int(GOLDEN) % (1 << 64))


def sketches(shingles: np.ndarray, offsets: np.ndarray, bins: int = BINS) -> np.ndarray:
    """A row of ``bins`` values per set; ``bins`` is a power of two, empty sets get the largest value throughout."""
    rows = len(offsets) - 1
    empty = np.iinfo(np.uint64).max
    out = np.full(rows * bins, empty, np.uint64)
    doc = np.repeat(np.arange(rows), np.diff(offsets))
    items = shingles
    open_rows = np.diff(offsets) > 0
    for i in range(2 * bins):
        x = mixed(items + _salt(i + 1))
        bin_ = (x & np.uint64(bins - 1)).astype(np.int64) if i < bins else i - bins
        np.minimum.at(out, doc * bins + bin_, (np.uint64(i) << np.uint64(54)) | (x >> np.uint64(10)))
        open_rows &= (out.reshape(rows, bins) == empty).any(axis=1)
        if not open_rows.any():
            break
        rest = open_rows[doc]
        items, doc = items[rest], doc[rest]
    return out.reshape(rows, bins)


def band_keys(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One key per ``rows`` neighbouring coordinates; the band's number is part of it."""
    bands = sketch.shape[1] // rows
    parts = sketch.reshape(len(sketch), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * GOLDEN, (len(sketch), bands)).copy()
    for k in range(rows):
        key = mixed((key ^ parts[:, :, k]) * MIX_1)
    return key


def _set_keys(shingles: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums of differently mixed elements: equal for equal sets, and as 128 bits for no others."""
    out = []
    for salt in (1, 2):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(shingles ^ _salt(salt)), dtype=np.uint64)])
        out.append(sums[offsets[1:]] - sums[offsets[:-1]])
    return out[0], out[1]


def _sketch_batches(batches: Iterator[pa.RecordBatch], bins: int, rows: int, size: int) -> Iterator[pa.RecordBatch]:
    for batch, text in slices(batches, 1):
        shingles, offsets = distinct_shingles(text, size)
        low, high = _set_keys(shingles, offsets)
        keys = band_keys(sketches(shingles, offsets, bins), rows).view(np.int64)
        counts = np.diff(offsets)
        per_row = np.where(counts > 0, keys.shape[1], 0)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_row)]), pa.int32()), pa.array(keys[counts > 0].ravel()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(low.view(np.int64)), pa.array(high.view(np.int64)), lists],
            ["__id", "__n", "__low", "__high", "__bands"],
        )


def _set_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch, text in slices(batches, 1):
        shingles, offsets = distinct_shingles(text, size)
        low, high = _set_keys(shingles, offsets)
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(shingles.view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(low.view(np.int64)), pa.array(high.view(np.int64)), lists], ["__id", "__low", "__high", "__set"])


def _node(id_: Column) -> Column:
    """A class as a node of the graph: its least id, which orders it, and its set's keys, so that texts which share an id stay apart; NULL without an id."""
    return F.when(id_.isNotNull(), F.struct(id_.alias("id"), F.col("__low").alias("low"), F.col("__high").alias("high")))


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (x, y) with the sizes na and nb of their full sets and the size of the intersection."""
    a = sets.select(F.col("__id").alias("x"), F.col("__set").alias("__a"))
    b = sets.select(F.col("__id").alias("y"), F.col("__set").alias("__b"))
    both = F.size(F.array_intersect("__a", "__b"))
    return pairs.join(a, "x").join(b, "y").select("x", "y", F.size("__a").alias("na"), F.size("__b").alias("nb"), both.alias("both"))


def _enough(both: Column, percent: int) -> Column:
    """Whether sets of na and nb elements with so many in common are similar enough."""
    return 100 * both >= percent * (F.col("na") + F.col("nb") - both)


#: Rows that a file of a step's table holds, and the fewest files that a step may write.
ROWS_PER_FILE, FEWEST_FILES = 20_000, 12


def _gathered(df: DataFrame, rows: int) -> DataFrame:
    """A step of at most ``rows`` narrow rows, written in files that hold many of them.

    A shuffle may have far more partitions than a step of few rows needs, and a file for
    each costs more than the step; such a table is also read and broadcast as larger than
    it is.  Partitions are put together, never split, and rows stay where their key is.
    """
    return settled(df.coalesce(max(FEWEST_FILES, rows // ROWS_PER_FILE)))


def components(links: DataFrame) -> DataFrame:
    """Of each node of the links (x, y): the least node it is connected with, as (node, component).

    Each round gives every node the least label among its neighbours' and its own, and
    then the label's own label, until nothing changes; the nodes of long chains halve
    their distance to the least one each time.
    """
    edges = _gathered(links.select("x", "y").union(links.select("y", "x")).distinct(), 2 * links.count())
    rows = edges.count()
    labels = _gathered(edges.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.first("x")).alias("component")), rows)
    while True:
        seen = edges.join(labels.withColumnRenamed("node", "y"), "y").groupBy(F.col("x").alias("node")).agg(F.min("component").alias("__near"))
        own = labels.join(seen, "node").select("node", "component", F.least("component", "__near").alias("__least"))
        far = labels.select(F.col("node").alias("__least"), F.col("component").alias("__far"))
        new = _gathered(
            own.join(far, "__least", "left").select("node", F.coalesce("__far", "__least").alias("__new"), "component"), rows
        )
        changed = new.filter(F.col("__new") != F.col("component")).limit(1).count()
        labels = new.select("node", F.col("__new").alias("component"))
        if not changed:
            return labels


def _labelled(members: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """The component of the node in ``column``, which is the node itself where it has no link yet."""
    found = labels.select(F.col("node").alias(column), F.col("component").alias("__found"))
    return members.join(found, column, "left").withColumn("component", F.coalesce("__found", column)).drop("__found")


def _with_references(members: DataFrame, degrees: DataFrame, labels: DataFrame) -> DataFrame:
    """The members (key, x, component) of open buckets, with the component that most of the bucket's are in as ``main`` and its centre as ``pivot``."""
    rows = members.count()
    known = _open(members.select("key", "x"), labels)
    centres = _labelled(degrees, labels, "x").groupBy("component").agg(F.max(F.struct("degree", "x")).alias("__centre"))
    sizes = known.groupBy("key", "component").agg(F.count(F.lit(1)).alias("__in"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("__in", "component")).alias("__most")).select("key", "__most.component")
    references = _gathered(largest.join(centres, "component").select("key", F.col("component").alias("main"), F.col("__centre.x").alias("pivot")), rows)
    return _gathered(known.select("key", "x", "component").join(references, "key"), rows)


#: Sizes in one class differ by less than this factor.
SIZE_CLASS = 1.04


#: Shingles that more classes around a reference have are counted as part of the reference.
FREQUENT = 32


def _remaining(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes around a reference that can still be linked.

    Members are (pivot, x, component, n, b), b the overlap with the reference.  What the
    reference lacks but many members have is added to it, so every other shingle has few
    owners.  One side of a pair is outside the reference's largest component.
    """
    own = members.select("pivot", "x").join(sets.select(F.col("__id").alias("x"), F.col("__set").alias("__x")), "x")
    own = own.join(sets.select(F.col("__id").alias("pivot"), F.col("__set").alias("__p")), "pivot")
    own = settled(own.select("pivot", "x", F.explode(F.array_except("__x", "__p")).alias("shingle")))
    owners = own.groupBy("pivot", "shingle").agg(F.count(F.lit(1)).alias("__owners")).filter("__owners > 1")
    own = _gathered(own.join(owners, ["pivot", "shingle"]), own.count())
    added = own.filter(F.col("__owners") > FREQUENT).groupBy("pivot", "x").agg(F.count(F.lit(1)).alias("__added"))
    rare = own.filter(F.col("__owners") <= FREQUENT).drop("__owners")
    count = members.count()
    members = _gathered(members.join(added, ["pivot", "x"], "left").withColumn("b", F.col("b") + F.coalesce("__added", F.lit(0))).drop("__added"), count)

    sizes = members.groupBy("pivot", "component").agg(F.count(F.lit(1)).alias("__in"))
    largest = _gathered(sizes.groupBy("pivot").agg(F.max(F.struct("__in", "component")).alias("__most")), count)
    a = _gathered(members.join(largest, "pivot").filter(F.col("component") != F.col("__most.component")).drop("__most"), count)
    a = a.select("pivot", "x", F.col("component").alias("ca"), F.col("n").alias("na"), F.col("b").alias("ba"))
    b = members.select("pivot", F.col("x").alias("y"), F.col("component").alias("cb"), F.col("n").alias("nb"), F.col("b").alias("bb"))
    inside = F.least("ba", "bb")

    def size_class(n: Column) -> Column:
        return F.floor(F.log(n) / F.log(F.lit(SIZE_CLASS))).cast("int")

    ratio = percent / 100
    least = F.col("na") * ratio
    most = F.least(F.col("na") / ratio, F.col("ba") * (1 + 1 / ratio) - F.col("na"))
    ranges = a.filter(most >= least).withColumn("class", F.explode(F.sequence(size_class(least) - 1, size_class(most) + 1)))
    by_size = ranges.join(b.withColumn("class", size_class(F.col("nb"))), ["pivot", "class"])
    by_size = by_size.filter((F.col("ca") != F.col("cb")) & _enough(inside, percent)).select("x", "y")

    met = rare.join(a, ["pivot", "x"]).join(rare.withColumnRenamed("x", "y").join(b, ["pivot", "y"]), ["pivot", "shingle"])
    counts = met.filter(F.col("ca") != F.col("cb")).groupBy("pivot", "x", "y", "na", "nb", "ba", "bb").agg(F.count(F.lit(1)).alias("__outside"))
    by_shingle = counts.filter(_enough(inside + F.col("__outside"), percent)).select("x", "y")
    return by_size.union(by_shingle)


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members, with their components, of the buckets that hold several components."""
    rows = members.count()
    known = _labelled(members, labels, "x")
    several = _gathered(known.groupBy("key").agg(F.min("component").alias("__a"), F.max("component").alias("__b")).filter("__a <> __b").select("key"), rows)
    return _gathered(known.join(several, "key", "left_semi"), rows)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).filter("x <> y").distinct()


def near_components(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = SIZE,
    percent: int = PERCENT,
    bins: int = BINS,
    rows: int = ROWS,
    references: int = REFERENCES,
) -> DataFrame:
    """One row per row of ``docs``: the id, n_shingles, component_id (the least id reachable) and kept."""
    source = docs.select(F.col(f"`{doc_id}`").alias("__id"), F.col(f"`{text}`").alias("__text"))
    kind = source.schema["__id"].dataType.simpleString()
    base = settled(
        source.mapInArrow(
            partial(_sketch_batches, bins=bins, rows=rows, size=size),
            f"__id {kind}, __n long, __low long, __high long, __bands array<long>",
        )
    )
    classes = settled(
        base.filter("__n > 0").groupBy("__low", "__high").agg(F.min("__id").alias("__least"), F.any_value("__n").alias("n"), F.any_value("__bands").alias("bands"))
        .select("__low", "__high", _node(F.col("__least")).alias("x"), "n", "bands")
    )
    banded = classes.select("x", "n", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("__in")).filter("__in > 1")
    bands = bins // rows
    shared = _gathered(shared, classes.count() * bands // 2)
    bits = member_bits(shared, F.col("key"))
    members = _gathered(marked(banded, bits, "__hit", F.col("key")).filter("__hit").drop("__hit").join(shared, "key"), classes.count() * bands)
    count = members.count()

    nodes = member_bits(members, F.col("x.id"))
    sets = settled(
        marked(source, nodes, "__hit", F.col("__id"))
        .filter("__hit")
        .select("__id", "__text")
        .mapInArrow(partial(_set_batches, size=size), f"__id {kind}, __low long, __high long, __set array<long>")
        .select(_node(F.col("__id")).alias("__id"), "__set")
        .join(members.select(F.col("x").alias("__id")).distinct(), "__id", "left_semi")
        .dropDuplicates(["__id"])
    )
    degrees = _gathered(members.groupBy("x").agg(F.sum("__in").alias("degree")), count)
    ranked = members.select("key", "x").join(degrees, "x")
    pivots = _gathered(ranked.groupBy("key").agg(F.max(F.struct("degree", "x")).alias("__best")).select("key", "__best.*").withColumnRenamed("x", "pivot"), count)
    members = _gathered(members.select("key", "x").join(pivots, "key"), count)
    best = members.filter("x <> pivot").groupBy("x").agg(F.max(F.struct("degree", "pivot")).alias("__best"))
    known = settled(_overlaps(_ordered(best.select("x", F.col("__best.pivot").alias("y"))), sets))
    labels = components(known.filter(_enough(F.col("both"), percent)))

    members = _with_references(members, degrees, labels)
    known = known.union(settled(_overlaps(_ordered(members.select("x", F.col("pivot").alias("y"))).join(known, ["x", "y"], "left_anti"), sets)))
    labels = components(known.filter(_enough(F.col("both"), percent)))

    for _ in range(references - 1):
        degrees = degrees.join(members.select(F.col("pivot").alias("x")).distinct(), "x", "left_anti")
        apart = _with_references(members, degrees, labels).filter("component <> main")
        wanted = _gathered(_ordered(apart.select("x", F.col("pivot").alias("y"))).join(known, ["x", "y"], "left_anti"), count)
        found = settled(_overlaps(wanted, sets))
        known = known.union(found)
        if not found.filter(_enough(F.col("both"), percent)).isEmpty():
            labels = components(known.filter(_enough(F.col("both"), percent)))
        degrees = degrees.join(apart.select(F.col("pivot").alias("x")).distinct(), "x", "left_anti")

    around = _open(members.select("key", "x", "pivot"), labels).select("pivot", "x", "component").distinct()
    either = known.select("x", F.col("y").alias("pivot"), F.col("na").alias("n"), F.col("both").alias("b"))
    either = either.union(known.select("y", "x", "nb", "both"))
    itself = sets.select(F.col("__id").alias("x"), F.col("__id").alias("pivot"), F.size("__set").alias("n"), F.size("__set").alias("b"))
    around = _gathered(around.join(either.union(itself), ["x", "pivot"]), count)
    wanted = _ordered(_remaining(around, sets, percent)).join(known, ["x", "y"], "left_anti")
    found = settled(_overlaps(wanted, sets))
    if not found.filter(_enough(F.col("both"), percent)).isEmpty():
        labels = components(known.union(found).filter(_enough(F.col("both"), percent)))
    ids = classes.select(F.col("__low").alias("l"), F.col("__high").alias("h"), "x")
    by_class = _gathered(_labelled(ids, labels, "x").select("l", "h", F.col("component.id").alias("component")), classes.count())
    named = base.filter("__n > 0").join(by_class, (F.col("__low") == F.col("l")) & (F.col("__high") == F.col("h")), "left")
    alone = base.filter("__n = 0").withColumn("component", F.col("__id"))
    columns = [
        F.col("__id").alias(doc_id),
        F.col("__n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.col("component").eqNullSafe(F.col("__id")).alias("kept"),
    ]
    return named.select(columns).unionByName(alone.select(columns))


def without_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options: int) -> DataFrame:
    """The rows of ``docs`` that stay, one document of each component, with all their columns."""
    found = settled(near_components(docs, doc_id, text, **options))
    dropped = found.filter(~F.col("kept")).select(F.col(doc_id).alias("__drop")).distinct()
    boxed = docs.select(F.col(f"`{doc_id}`").alias("__id"), F.struct("*").alias("__row"))
    split = marked(boxed, member_bits(dropped, F.col("__drop")), "__maybe", F.col("__id"))
    rest = split.filter("__maybe").join(dropped, F.col("__id") == F.col("__drop"), "left_anti")
    return split.filter(~F.col("__maybe")).select("__row.*").unionByName(rest.select("__row.*"))
