"""Web archives: pages written as WARC records, and records read back, segments put together and chunks decoded.

**Writing.**  Of the pages with equal payloads the one with the least page_id (NULL
last, then the least url) is a ``response``; the others are ``revisit`` records that
name it and carry no payload.  Payloads of more than ``chunk_bytes`` are sent in chunked
transfer framing, as servers do.  A record whose block is longer than ``segment_bytes``
is cut: the first part stays in the record, the others become ``continuation`` records
with the origin's identifier and a segment number, the last with the total length.  Rows
become records in the task that reads them; only pages that lose their payload meet the
choice of their group.  Spark's text writer puts the records down as gzip files on any
store and commits them, so a lost executor leaves no half file.

**Reading.**  Files are read by Spark's text source with a record's first line as the
separator: gzip files stream record by record, plain ones are also split, and no task
ever holds more than a record and a batch.  A payload may hold the separator itself; the
declared length tells, and the pieces are put together again, across splits too (a split
begins with a record if its first row starts with whole WARC fields).  Records that are
not segmented are decoded where they are read.  The others are dealt by origin
identifier, sorted by segment number and put together as a stream, one record at a time.

``problem`` is NULL, or says why a record has no payload: ``incomplete`` (segments or
bytes are missing, or the total length differs), ``framing`` (chunks cannot be decoded),
``digest`` (the payload is not the one that was written).  Segments that repeat a number
count once.  Repeated pages are records of their own.  NULL html is an empty payload;
NULL urls are left out and read as NULL; characters that a header line cannot hold are
percent-encoded in urls and read so.  An empty table gives an archive without pages.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime
from functools import partial
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import written

SEPARATOR = b"WARC/1.0\r\n"
CHUNK_BYTES, SEGMENT_BYTES = 8 << 10, 32 << 10

#: Characters of a url, beside letters and digits, that stand for themselves in a header line; the percent sign is one.
_PLAIN_URL = "%!#$&'()*+,/:;=?@[]~"

_RECORD = (
    "record_id string, record_type string, target_uri string, row_key string, refers_to_id string, payload_digest string, "
    "origin_id string, segment_number int, segment_total long, payload binary, problem string"
)
_PARSED = f"{_RECORD}, file string, split long, place long, needs long"
_COLUMNS = [c.split()[0] for c in _RECORD.split(", ")]


def payload_digest(payload: bytes) -> str:
    """Bare base32 SHA-1, upper case."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """A payload in chunked transfer framing."""
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(data: bytes) -> bytes:
    """The payload of chunked transfer framing; chunk extensions and trailers are passed over.  ValueError if it is broken."""
    parts, at = [], 0
    while True:
        end = data.find(b"\r\n", at)
        if end < 0:
            raise ValueError("a chunk's size is missing")
        digits = data[at:end].split(b";")[0].strip()
        if not digits or digits.strip(b"0123456789abcdefABCDEF"):
            raise ValueError("a chunk's size is no number")
        size, at = int(digits, 16), end + 2
        if not size:
            return b"".join(parts)
        parts.append(data[at : at + size])
        if len(parts[-1]) < size or data[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk has not its size")
        at += size + 2


def _fields(head: bytes) -> dict[str, str]:
    """Named fields of a header, names in lower case; a line that begins with white space goes on with the one before."""
    fields: dict[str, str] = {}
    name = ""
    for line in head.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in " \t" and name:
            fields[name] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            name = name.strip().lower()
            fields[name] = value.strip()
    return fields


def http_payload(block: bytes) -> bytes:
    """The payload of an HTTP response: what follows its header, its framing decoded.  ValueError if it is broken."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("a response without a header's end")
    fields = _fields(head)
    if fields.get("transfer-encoding", "").lower() == "chunked":
        return unchunked(body)
    if "content-length" in fields:
        if not fields["content-length"].isdigit() or int(fields["content-length"]) != len(body):
            raise ValueError("a body has not its length")
    return body


def _record(kind: str, record_id: str, date: str, block: bytes, **fields: str | int | None) -> bytes:
    """A record without its separator and the two line ends behind it, which the text writer adds."""
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": date}
    head |= {f"WARC-{k.replace('_', '-')}": v for k, v in fields.items() if v is not None}
    head["Content-Length"] = len(block)
    return "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block


def _identifier(run: int, row: int, segment: int = 0) -> str:
    """A record's identifier; segments after the first use the bits that row numbers leave free."""
    return f"urn:uuid:{uuid.UUID(int=(run << 64) ^ (segment << 100) ^ row)}"


def _write_batches(batches: Iterator[pa.RecordBatch], run: int, date: str, chunk_bytes: int, segment_bytes: int) -> Iterator[pa.RecordBatch]:
    out: list[bytes] = [_record("warcinfo", f"urn:uuid:{uuid.uuid4()}", date, b"format: WARC File Format 1.0\r\n")]
    size = 0
    for batch in batches:
        for row, key, url, digest, first, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            record_id = _identifier(run, row)
            fields = {
                "Target_URI": None if url is None else quote(url, safe=_PLAIN_URL),
                "Row_Key": None if key is None else quote(key),
                "Payload_Digest": f"sha1:{base64.b32encode(digest).decode()}",
            }
            ok = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            if first is not None:
                fields |= {"Refers_To": f"<{_identifier(run, first)}>", "Profile": "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"}
                out.append(_record("revisit", record_id, date, ok + b"\r\n", **fields))
                continue
            if len(payload) > chunk_bytes:
                block = b"".join([ok, b"Transfer-Encoding: chunked\r\n\r\n", chunked(payload, chunk_bytes)])
            else:
                block = b"".join([ok, b"Content-Length: %d\r\n\r\n" % len(payload), payload])
            if len(block) <= segment_bytes:
                out.append(_record("response", record_id, date, block, **fields))
            else:
                out.append(_record("response", record_id, date, block[:segment_bytes], **fields, Segment_Number=1))
                last = -(-len(block) // segment_bytes)
                for number in range(2, last + 1):
                    part = block[(number - 1) * segment_bytes : number * segment_bytes]
                    ends = {"Segment_Total_Length": len(block)} if number == last else {}
                    out.append(_record("continuation", _identifier(run, row, number), date, part, Segment_Origin_ID=f"<{record_id}>", Segment_Number=number, **ends))
            size += len(block)
            if size > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])


def write_archive(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    chunk_bytes: int = CHUNK_BYTES,
    segment_bytes: int = SEGMENT_BYTES,
    min_revisit_bytes: int = 0,
    date: datetime | None = None,
) -> None:
    """Write one record per page below ``path``; payloads of fewer than ``min_revisit_bytes`` are never revisited.

    The rows are first written as a table, so that their numbers hold whatever is
    computed again.
    """
    payload = F.coalesce(F.col(f"`{html}`").cast("binary"), F.lit(b""))
    rows = written(
        pages.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{page_id}`").alias("key"), F.col(f"`{url}`").cast("string").alias("url"), payload.alias("payload"))
        .withColumn("digest", F.unhex(F.sha1("payload"))),
        "pages",
    )
    order = F.struct(F.col("key").isNull().alias("none"), F.col("key"), F.col("url").isNull().alias("bare"), F.col("url"), F.col("row"))
    narrow = rows.where(F.octet_length("payload") >= min_revisit_bytes).select("row", "key", "url", "digest")
    firsts = narrow.groupBy("digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", F.col("first.row").alias("first"))
    revisits = written(narrow.join(firsts, "digest").where("row <> first").select("row", "first"), "revisits")
    records = (
        rows.join(revisits, "row", "left")
        .select("row", F.col("key").cast("string").alias("key"), "url", "digest", "first", F.when(F.col("first").isNull(), F.col("payload")).alias("payload"))
        .mapInArrow(
            partial(
                _write_batches,
                run=uuid.uuid4().int >> 64,
                date=(date or datetime.now(UTC)).strftime("%Y-%m-%dT%H:%M:%SZ"),
                chunk_bytes=chunk_bytes,
                segment_bytes=segment_bytes,
            ),
            "value binary",
        )
    )
    line = F.concat(F.lit(SEPARATOR), F.col("value")).cast("string").alias("value")
    records.select(line).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def _bare(value: str | None) -> str | None:
    return None if value is None else value.strip("<>")


def _number(value: str | None) -> int | None:
    return int(value) if value is not None and value.isdigit() else None


def _decoded(record: dict) -> dict:
    """A whole record, its block turned into the payload and checked against its digest."""
    if record["problem"] is None and record["record_type"] == "response":
        try:
            record["payload"] = http_payload(record["payload"])
        except ValueError:
            record["payload"], record["problem"] = None, "framing"
        else:
            if record["payload_digest"] is not None and payload_digest(record["payload"]) != record["payload_digest"]:
                record["payload"], record["problem"] = None, "digest"
    elif record["record_type"] == "revisit":
        record["payload"] = None
    return record


def _opened(raw: bytes) -> tuple[dict, int] | None:
    """A record from the bytes behind its separator, and its block's length; None if they are no record's beginning."""
    head, gap, block = raw.partition(b"\r\n\r\n")
    fields = _fields(head) if gap else {}
    size = _number(fields.get("content-length"))
    if size is None or "warc-type" not in fields or "warc-record-id" not in fields:
        return None
    digest = fields.get("warc-payload-digest")
    key = fields.get("warc-row-key")
    record = {
        "record_id": _bare(fields["warc-record-id"]),
        "record_type": fields["warc-type"],
        "target_uri": fields.get("warc-target-uri"),
        "row_key": None if key is None else unquote(key),
        "refers_to_id": _bare(fields.get("warc-refers-to")),
        "payload_digest": digest[5:] if digest is not None and digest[:5].lower() == "sha1:" else None,
        "origin_id": _bare(fields.get("warc-segment-origin-id")),
        "segment_number": _number(fields.get("warc-segment-number")),
        "segment_total": _number(fields.get("warc-segment-total-length")),
        "payload": block[:size],
        "problem": None,
    }
    return record, size - len(block)


def _closed(record: dict) -> dict:
    if record["segment_number"] is None:
        return _decoded(record)
    record["origin_id"] = record["origin_id"] or record["record_id"]
    return record


def _rows(records: list[dict], names: list[str], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in records], types[c]) for c in names], names)


def _types(schema: str) -> dict[str, pa.DataType]:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return {name: kinds[kind] for name, kind in (c.split() for c in schema.split(", "))}


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the rows of a task; a record that its split does not end, and rows that begin none, go on as they are.

    Such rows have no record_id or a number of bytes that they still need; ``split`` and
    ``place`` tell where they stand in their file.
    """
    types = _types(_PARSED)
    where, place = (None, None), 0
    record, parts, needs = None, [], 0
    out: list[dict] = []

    def ended() -> dict:
        record["payload"] = b"".join([record["payload"], *parts])
        if needs > 0:
            return record | {"file": where[0], "split": where[1], "place": place, "needs": needs}
        return _closed(record) | dict.fromkeys(("file", "split", "place", "needs"))

    for batch in batches:
        size = 0
        for raw, file, split in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (file, split) != where:
                if record is not None:
                    out.append(ended())
                record, where, place = None, (file, split), 0
            place += 1
            if record is not None and needs > 0:
                data = SEPARATOR + raw
                parts.append(data[:needs])
                needs -= len(data)
                continue
            if record is not None:
                out.append(ended())
            opened = _opened(raw)
            if opened is not None:
                (record, needs), parts = opened, []
            else:
                record = None
                if place > 1 or split:
                    out.append(dict.fromkeys(types) | {"payload": SEPARATOR + raw, "file": file, "split": split, "place": place, "needs": 0})
            size += len(raw)
            if size > 4 << 20:
                yield _rows(out, list(types), types)
                out, size = [], 0
        if out:
            yield _rows(out, list(types), types)
            out = []
    if record is not None:
        yield _rows([ended()], list(types), types)


def _stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records that splits have cut, from their rows in order: an open record takes the loose rows behind it."""
    types = _types(_RECORD)
    names = list(types)
    record, file, needs = None, None, 0

    def ended() -> pa.RecordBatch:
        if needs > 0:
            record["payload"], record["problem"] = None, "incomplete"
        return _rows([_closed(record)], names, types)

    for batch in batches:
        for row in batch.to_pylist():
            if row["record_id"] is not None:
                if record is not None:
                    yield ended()
                record, file, needs = row, row["file"], row["needs"]
            elif record is not None and file == row["file"] and needs > 0:
                record["payload"] += row["payload"][:needs]
                needs -= len(row["payload"])
    if record is not None:
        yield ended()


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segmented records from their segments by origin and number."""
    types = _types(_RECORD)
    names = list(types)
    origin: str | None = None
    record: dict | None = None
    parts: list[bytes] = []
    number, total, broken = 0, None, False

    def ended() -> pa.RecordBatch:
        whole = record or (dict.fromkeys(names) | {"record_id": origin, "origin_id": origin, "record_type": "response"})
        size = sum(map(len, parts))
        if record is None or broken or total != size:
            whole |= {"payload": None, "problem": "incomplete"}
        else:
            whole |= {"payload": b"".join(parts), "segment_total": total}
        return _rows([_decoded(whole)], names, types)

    for batch in batches:
        for row in batch.to_pylist():
            if row["origin_id"] != origin:
                if origin is not None:
                    yield ended()
                origin, record, parts, number, total, broken = row["origin_id"], None, [], 0, None, False
            if row["segment_number"] == number:
                continue
            broken |= row["segment_number"] != number + 1 or total is not None or row["payload"] is None
            number = row["segment_number"]
            if number == 1:
                record = row
            total = row["segment_total"]
            if broken:
                parts = []
            else:
                parts.append(row["payload"])
    if origin is not None:
        yield ended()


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the files below ``path``, continuations put into the records that they go on with.

    Segments and records that splits have cut are written as a table first, so the files
    are read twice at most.  Columns: record_id, record_type, target_uri, row_key, refers_to_id, payload_digest
    (as declared), origin_id and segment_number (of segmented records), segment_total,
    payload (of revisits NULL) and problem.
    """
    raw = spark.read.option("lineSep", SEPARATOR.decode()).text(path)
    parsed = raw.select(
        F.col("value").cast("binary").alias("raw"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split")
    ).mapInArrow(_read_batches, _PARSED)
    whole = F.col("file").isNull() & F.col("segment_number").isNull()
    parts = written(parsed.where(~whole), "segments")
    stitched = (
        parts.where(F.col("file").isNotNull()).repartition("file").sortWithinPartitions("file", "split", "place").mapInArrow(_stitch, _RECORD)
    )
    assembled = (
        parts.where(F.col("file").isNull())
        .select(*_COLUMNS)
        .unionByName(stitched.where(F.col("segment_number").isNotNull()))
        .repartition("origin_id")
        .sortWithinPartitions("origin_id", "segment_number")
        .mapInArrow(_assemble, _RECORD)
    )
    return parsed.where(whole).select(*_COLUMNS).unionByName(stitched.where(F.col("segment_number").isNull())).unionByName(assembled)


def captures(records: DataFrame) -> DataFrame:
    """One row per response and revisit: row_key, payload_bytes, payload_digest, record_type, refers_to and problem.

    A revisit's bytes are those of the response that it names; ``problem`` is
    ``unresolved`` where the archive has no such response with that digest.
    """
    narrow = written(
        records.where(F.col("record_type").isin("response", "revisit")).select(
            "record_id", "record_type", "row_key", "refers_to_id", "payload_digest", F.octet_length("payload").cast("long").alias("payload_bytes"), "problem"
        ),
        "captures",
    )
    responses = narrow.where("record_type = 'response'")
    named = responses.select(
        F.col("record_id").alias("refers_to_id"), F.col("row_key").alias("refers_to"), F.col("payload_bytes").alias("n"), F.col("payload_digest").alias("d")
    )
    lost = F.when(F.col("n").isNull() | ~F.col("d").eqNullSafe(F.col("payload_digest")), F.lit("unresolved"))
    revisits = narrow.where("record_type = 'revisit'").join(named, "refers_to_id", "left")
    columns = ["row_key", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem"]
    return responses.withColumn("refers_to", F.lit(None).cast("string")).select(*columns).unionByName(
        revisits.withColumns({"payload_bytes": F.col("n"), "problem": F.coalesce("problem", lost)}).select(*columns)
    )
