"""Web archives: exact round trips, broken archives, and the query beside its SQL."""

import base64
import gzip
import hashlib
import os
import random
import re

import duckdb
import pytest

from tidemark.llm import warc
from tidemark.llm.queries import SQL, op11_warc

WARC_TEXT = "About archives: WARC/1.0\r\nWARC-Type: response\r\n\r\nWARC/1.0"
PAGES = [
    (1, "http://a/ü?x=1 2%20", "WARC/1.0"), (2, None, None), (3, "u", ""), (4, "v", "é" * 3000), (5, "v", WARC_TEXT * 9), (6, "w", "WARC/1.0\r\n" * 300),
    (None, "n", "é" * 3000), (4, "v", "é" * 3000), (0, "z", "é" * 3000), (8, "r\r\nX: y", "same"), (8, "r\r\nX: y", "same"), (7, None, "same"), (None, None, "none"),
    (9, "long", "<p>0123456789\r\n\r\n" * 200_000),
]


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def captures_by_hand(pages, least=0):
    first = {}
    order = sorted(range(len(pages)), key=lambda i: [(v is None, v or 0) if k == 0 else (v is None, v or "") for k, v in enumerate(pages[i][:2])])
    out = []
    for i in order:
        key, _, html = pages[i]
        size = len((html or "").encode())
        revisit = size >= least and (html or "") in first
        out.append((None if key is None else str(key), size, digest(html), "revisit" if revisit else "response", first[html or ""] if revisit else None, None))
        first.setdefault(html or "", None if key is None else str(key))
    return sorted(out, key=str)


def frame(spark, rows):
    """Pages with more columns, named as the operator names its own."""
    return spark.createDataFrame([(*r, 5, "k", b"p") for r in rows], "page_id long, url string, html string, row int, key string, payload binary")


@pytest.mark.parametrize("chunk,segment,least", [(1000, 777, 0), (7, 100, 0), (8192, 32768, 5)])
def test_round_trip(spark, tmp_path, chunk, segment, least):
    pages = PAGES if chunk > 7 else PAGES[:-1]
    path = str(tmp_path / "archive")
    warc.write_archive(frame(spark, pages).repartition(3), path, chunk_bytes=chunk, segment_bytes=segment, min_revisit_bytes=least)
    records = warc.read_archive(spark, path)
    got = sorted(map(tuple, warc.captures(records).collect()), key=str)
    assert got == captures_by_hand(pages, least)
    payloads = [(r["row_key"], bytes(r["payload"])) for r in records.where("record_type = 'response'").collect()]
    texts = {(None if k is None else str(k), (h or "").encode()) for k, _, h in pages}
    assert set(payloads) <= texts and {p for _, p in payloads} == {t for _, t in texts}
    urls = {r["target_uri"] for r in records.collect()}
    assert "http://a/%C3%BC?x=1%202%20" in urls and "r%0D%0AX:%20y" in urls


def test_files_are_archives_by_hand(spark, tmp_path):
    """The files hold what the format asks for: records one after the other, each as long as it says."""
    path = str(tmp_path / "archive")
    warc.write_archive(frame(spark, PAGES[:7]).coalesce(1), path, segment_bytes=500)
    data = b"".join(gzip.open(f"{path}/{f}").read() for f in sorted(os.listdir(path)) if f.endswith(".gz"))
    kinds, segments = [], {}
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.0\r\nWARC-Type: ")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        size = int(fields["Content-Length"])
        assert rest[size : size + 4] == b"\r\n\r\n" and {"WARC-Record-ID", "WARC-Date"} <= fields.keys()
        kinds.append(fields["WARC-Type"])
        if "WARC-Segment-Number" in fields:
            segments.setdefault(fields.get("WARC-Segment-Origin-ID", fields["WARC-Record-ID"]), []).append((int(fields["WARC-Segment-Number"]), size, fields.get("WARC-Segment-Total-Length")))
        data = rest[size + 4 :]
    assert kinds.count("warcinfo") == 1 and kinds.count("response") == 5 and kinds.count("revisit") == 2 and kinds.count("continuation") > 4
    for parts in segments.values():
        assert [p[0] for p in parts] == list(range(1, len(parts) + 1))
        assert [p[2] for p in parts[:-1]] == [None] * (len(parts) - 1) and int(parts[-1][2]) == sum(p[1] for p in parts)


def test_splits_of_plain_files(spark, tmp_path):
    """Files without compression are split anywhere; records that splits cut come back whole."""
    path = str(tmp_path / "archive")
    warc.write_archive(frame(spark, PAGES[:-1]).coalesce(1), path, segment_bytes=1500)
    plain = tmp_path / "plain"
    plain.mkdir()
    (plain / "one.warc").write_bytes(b"".join(gzip.open(f"{path}/{f}").read() for f in os.listdir(path) if f.endswith(".gz")))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (997, 4099, 1 << 20):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            got = sorted(map(tuple, warc.captures(warc.read_archive(spark, str(plain))).collect()), key=str)
            assert got == captures_by_hand(PAGES[:-1])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_broken_archives(spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_archive(frame(spark, [(k, "u", f"{k}" * 4000) for k in range(6)]).coalesce(1), path, chunk_bytes=1000, segment_bytes=1500)
    text = b"".join(gzip.open(f"{path}/{f}").read() for f in os.listdir(path) if f.endswith(".gz"))
    records = [b"WARC/1.0\r\n" + r for r in text.split(b"WARC/1.0\r\n")[1:]]
    parts = {k: [r for r in records if r.count(b"%d" % k * 200)] for k in range(6)}
    chunk = re.compile(rb"\r\n3e8\r\n")
    kept = (
        parts[0][::-1]  # segments in another order
        + parts[1][:1] + parts[1][2:]  # one is missing
        + parts[2] + parts[2][1:2]  # one is there twice
        + [r.replace(b"3333", b"3334", 1) for r in parts[3]]  # another payload
        + [chunk.sub(b"\r\n3e9\r\n", r, count=1) for r in parts[4]]  # a chunk of another size
        + parts[5][1:]  # no first segment
        + [records[-1][: len(records[-1]) // 2]]  # the file ends early
    )
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "x.warc").write_bytes(b"".join(kept))
    got = {(r["row_key"], r["problem"], r["payload"] is not None) for r in warc.read_archive(spark, str(broken)).where("record_type = 'response'").collect()}
    assert got >= {("0", None, True), ("1", "incomplete", False), ("2", None, True), ("3", "digest", False), ("4", "framing", False), (None, "incomplete", False)}


def test_chunks():
    rng = random.Random(1)
    for _ in range(200):
        data = rng.randbytes(rng.randrange(0, 3000))
        assert warc.unchunked(warc.chunked(data, rng.randrange(1, 500))) == data
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: t\r\n\r\n") == b"abc"
    for bad in (b"", b"3\r\nab", b"x\r\nab\r\n0\r\n\r\n", b"2\r\nabc\r\n0\r\n\r\n", b"3\r\nabc\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(bad)


def test_empty_table(spark, tmp_path):
    warc.write_archive(frame(spark, []), str(tmp_path / "archive"))
    assert warc.captures(warc.read_archive(spark, str(tmp_path / "archive"))).count() == 0


def test_query_equals_sql(spark, tiny):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tiny}/pages.parquet'")
    want = con.execute(SQL["op11_warc"])
    names = [c[0] for c in want.description]
    assert set(map(tuple, op11_warc(spark, tiny).select(*names).collect())) == set(want.fetchall())
