"""Token operators: equal to the library, exact round trips, plain versions of the packers and scans."""

import itertools
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import packing, pieces, separators, simple8b, tokens

ODD = [
    "Don't <|endoftext|>x ΣΑΣ İ é a b ½ ²  '' x's 123 abc123 日本語  z", None, "", "  ", "'s 's'S ###", "ªº µm ǅ", "a\x1cb", "é!! !!e .a.b,c", "# #", "The quick, brown. " * 300,
]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(["the", "er", "é", "tion", "Qu", "!!", "#"]) for _ in range(rng.randrange(1, 6)))
    texts = ODD + [" ".join(word() for _ in range(rng.choice([1, 20, 400, 9000 if k % 20 == 0 else 30]))) for k in range(120)]
    return list(enumerate(texts)) + [(7, "twice the same id"), (7, "twice the same id")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    data = [(i, t, b"x", 1, "f") for i, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, ids binary, key long, file string").repartition(3, "doc_id")


@pytest.fixture(scope="module")
def want(rows):
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(tokens.vocabulary_path())
    return [(i, full.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_the_library(rows, name):
    encode = tokens.Encoder(tokens.vocabulary_path(name))
    texts = [t or "" for _, t in rows]
    ids, offsets = encode(pa.array(texts))
    assert encode.by_word == name.startswith("word")
    for k, e in enumerate(encode.full.encode_batch(texts, add_special_tokens=False)):
        assert ids[offsets[k] : offsets[k + 1]].tolist() == e.ids
    assert encode(pa.array([], pa.string()))[1].tolist() == [0]


def test_simple8b_words():
    rng = np.random.default_rng(4)
    cases = [[], [0], [0] * 300, [1 << 63, 5, 0, (1 << 64) - 1, (1 << 60) - 1, 1 << 60, 1 << 62], rng.integers(0, 2000, 5000), rng.zipf(1.3, 5000) % 50_000]
    for case in cases:
        values = np.array(case, np.uint64)
        packed = simple8b.pack(values)
        assert (simple8b.unpack(packed) == values).all()
    assert len(simple8b.pack(np.zeros(240, np.uint64))) == 2
    assert len(simple8b.pack(np.full(10, 63, np.uint64))) == 1


@pytest.mark.parametrize("block_ids", [1, 1000, 1 << 16])
def test_simple8b_files(spark, docs, want, tmp_path, block_ids):
    path = str(tmp_path / "files")
    simple8b.write_tokens(docs, path, tokens.vocabulary_path(), block_ids=block_ids)
    got = sorted((r["doc_id"], r["start"], r["n_tokens"], bytes(r["ids"])) for r in simple8b.read_tokens(spark, path).collect())
    start, out = 0, []
    for i, ids in sorted(want):
        out.append((i, start, len(ids), np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert sorted(g[:1] + g[2:] for g in got) == sorted(o[:1] + o[2:] for o in out)
    assert [g for g in got if g[0] != 7] == [o for o in out if o[0] != 7]
    assert sum(g[2] for g in got if g[0] == 7) == sum(len(ids) for i, ids in want if i == 7)
    simple8b.write_tokens(docs.limit(0), path + "-none", tokens.vocabulary_path())
    assert simple8b.read_tokens(spark, path + "-none").count() == 0


def test_first_fit_decreasing():
    rng = random.Random(5)
    for n in (0, 1, 7, 300):
        sizes = [rng.randrange(1, 100) for _ in range(n)]
        plain = []
        for i in sorted(range(n), key=lambda i: -sizes[i]):
            at = next((b for b in plain if sum(sizes[j] for j in b) + sizes[i] <= 100), None)
            if at is None:
                plain.append([i])
            else:
                at.append(i)
        bins = packing.first_fit_decreasing(sizes, 100)
        assert [[p[0] for p in b] for b in bins] == plain
        closed = packing.without_gaps(bins, 100)
        lengths = [sum(p[2] for p in b) for b in closed]
        assert all(x == 100 or x & (x - 1) == 0 for x in lengths)
        covered = defaultdict(list)
        for i, first, size in itertools.chain(*closed):
            covered[i] += range(first, first + size)
        assert {i: sorted(c) for i, c in covered.items()} == {i: list(range(s)) for i, s in enumerate(sizes)}


@pytest.mark.parametrize("group_docs", [10, 2000])
def test_packed(docs, want, group_docs):
    got = packing.packed(docs, tokens.vocabulary_path(), length=512, group_docs=group_docs, group_chars=5000).collect()
    left, sequences = Counter(), defaultdict(list)
    for i, ids in want:
        left.update((i, k, t) for k, t in enumerate(ids))
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0
        left.subtract((r["doc_id"], r["start"] + k, t) for k, t in enumerate(ids))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert r["doc_tokens"] in {len(ids) for i, ids in want if i == r["doc_id"]}
    assert not any(left.values())
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end == 512 or end & (end - 1) == 0
    assert packing.packed(docs.limit(0), tokens.vocabulary_path()).count() == 0


def test_packing_groups_of_rows_without_an_id(spark):
    """Rows that share an id, or have none, are spread over groups by their texts."""
    rows = [(None if k % 3 else 4, f"text number {k} " + "word " * (k % 50)) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = packing.packed(docs, tokens.vocabulary_path(), length=512, group_docs=20).collect()
    groups = Counter(r["sequence_id"] // packing.GROUP_SEQUENCES for r in got)
    assert len(groups) >= 25 and max(groups.values()) < 60
    assert sum(r["length"] for r in got) == sum(len(i) for i in tokens.encoder(tokens.vocabulary_path()).full.encode_batch([t for _, t in rows], add_special_tokens=False)) + len(rows)


@pytest.mark.parametrize("block,width", [(64, 4), (1000, 2), (1 << 16, 4)])
def test_document_counts(docs, want, block, width):
    flat = separators.flat_tokens(docs, tokens.vocabulary_path(), 49407, block=block, width=width)
    got = separators.document_counts(flat, 49407, width=width, chunk=4).collect()
    encode = tokens.Encoder(tokens.vocabulary_path(), special_as_text=True)
    ids, offsets = encode(pa.array([r["text"] or "" for r in docs.select("text").collect()]))
    assert 49407 not in ids
    assert Counter(r["n_tokens"] for r in got) == Counter(np.diff(offsets).tolist())
    at = Counter()
    for r in sorted(got, key=lambda r: (r["file"], r["document"])):
        assert r["ended"] and r["start"] == at[r["file"]]
        at[r["file"]] += r["n_tokens"] + 1
    assert separators.document_counts(flat.limit(0), 49407, width=width).count() == 0


def test_flat_files(spark, tmp_path):
    """Binary files without index: open ends, empty documents, separators at block edges."""
    streams = {"a.bin": [5, 6, 9, 9, 1, 9, 7, 7, 7, 7, 7], "b.bin": [9], "c.bin": [1, 2, 3], "d.bin": []}
    for name, ids in streams.items():
        np.array(ids, "<u2").tofile(tmp_path / name)
    blocks = separators.flat_files(spark, str(tmp_path), block=3, width=2)
    got = separators.document_counts(blocks, 9, width=2, chunk=2).collect()
    assert sorted((r["file"][-5:], r["document"], r["start"], r["n_tokens"], r["ended"]) for r in got) == [
        ("a.bin", 0, 0, 2, True), ("a.bin", 1, 3, 0, True), ("a.bin", 2, 4, 1, True), ("a.bin", 3, 6, 5, False), ("b.bin", 0, 0, 0, True), ("c.bin", 0, 0, 3, False),
    ]


@pytest.fixture(scope="module")
def model():
    return tokens.vocabulary_path("piece_bpe_32k.model")


def all_ways(lattice, text):
    ways = []

    def go(at, ids, score):
        if at == len(text):
            ways.append((score, tuple(ids)))
            return
        single = False
        for end in range(at + 1, len(text) + 1):
            k = lattice.ids.get(text[at:end])
            if k is not None:
                single |= end == at + 1
                go(end, ids + [k], score + lattice.score[k])
        if not single:
            go(at + 1, ids + [lattice.bytes[b] for b in text[at].encode()], score + lattice.unknown)

    go(0, [], 0.0)
    return sorted(ways, key=lambda w: -w[0])


def test_pieces_by_enumeration(spark, model):
    texts = ["hello world", "a b", "the thé ñ", "x  y\nzz", "", " ", "\n", "日本 a", "one one one", "the\tthe  ", "aaaaaaaaaaaa", None]
    frame = spark.createDataFrame([(i, t, b"z") for i, t in enumerate(texts)], "doc_id long, text string, ids binary")
    lattice = pieces.lattice(model)
    for r in pieces.decoded(pieces.encoded(frame, model), model).collect():
        text = texts[r["doc_id"]] or ""
        ways = all_ways(lattice, (pieces.SPACE + text.replace(" ", pieces.SPACE)) if text else "")
        best = np.frombuffer(r["ids"], "<u4").tolist()
        assert [round(w[0], 6) for w in ways[:4]] == [round(s, 6) for s in (r["score"], *(o["score"] for o in r["others"]))]
        scores, seen = {w[1]: w[0] for w in ways}, {tuple(best)}
        assert scores[tuple(best)] == pytest.approx(r["score"])
        for other in r["others"]:
            ids = list(best)
            for e in sorted(other["edits"], key=lambda e: -e["start"]):
                ids[e["start"] : e["end"]] = e["ids"]
            assert scores[tuple(ids)] == pytest.approx(other["score"])
            seen.add(tuple(ids))
        assert len(seen) == 1 + len(r["others"])
        assert r["decoded"] == text
    assert pieces.encoded(frame.limit(0), model).count() == 0


def test_pieces_across_line_ends_by_enumeration(model):
    """Carriage returns belong to pieces with what stands before them, and a literal space mark joins a space."""
    lattice = pieces.lattice(model)
    texts = ["foo;\r\nbar", "a }\r\n\r\nb.\r", "x\ry);\r\r z", "no,\r é\r\n", ";\r", "\r\na:\r", "日\r\n日", "a\u2581 b", "a;\r\u2581 b"]
    for text, (ids, score, others) in zip(texts, pieces.Segmenter(model, 4)(pa.array(texts)), strict=True):
        ways = all_ways(lattice, pieces.SPACE + text.replace(" ", pieces.SPACE))
        assert [w[0] for w in ways[:4]] == pytest.approx([score, *(s for s, _ in others)]), text
        assert dict((w[1], w[0]) for w in ways)[tuple(ids.tolist())] == pytest.approx(score)
        assert lattice.decode(ids).decode() == text.replace(pieces.SPACE, " ")
    ids, *_ = next(iter(pieces.Segmenter(model, 1)(pa.array(["foo;\r\nbar"]))))
    assert lattice.ids[";\r"] in ids


def test_pieces_of_documents_decode(spark, tiny, model):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    got = pieces.decoded(pieces.encoded(docs, model), model).join(docs, "doc_id")
    assert got.filter("decoded <> text").count() == 0


def test_long_words_end(model):
    lattice = pieces.lattice(model)
    for text in ("x" * 3000, "ab" * 1500):
        assert len(lattice.n_best(text, 4)) == 4


def test_words_together_as_alone(model):
    """Pieces, scores and losses of many words at once are those of each word alone, also of long and strange ones."""
    lattice, rng = pieces.lattice(model), random.Random(5)
    parts = ["a", "e", "th", "ing", pieces.SPACE, "é", "日", "😀", "\r", "\n", ";", "0", "\x00", "🜁", *list(lattice.ids)[300:30000:500]]
    texts = ["".join(rng.choice(parts) for _ in range(rng.choice([1, 2, 5, 12, 40, 90]))) for _ in range(600)]
    texts += ["x" * pieces.LONG, "x" * (pieces.LONG + 1)]
    size = np.array([len(t) for t in texts])
    chars = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
    ids, first, count, extra = lattice.best_of(chars, np.cumsum(size) - size, size)
    for k, text in enumerate(texts):
        assert (tuple(ids[first[k] : first[k] + count[k]].tolist()), *extra[k].tolist()) == lattice.best(text), text


def test_memory_of_pieces_does_not_grow_with_the_words_met(model):
    segment, rng = pieces.Segmenter(model, 1), random.Random(6)

    def some_words():
        list(segment(pa.array([" ".join("".join(rng.choices("abcdefghijklmnop", k=8)) for _ in range(2000))])))

    some_words()
    tracemalloc.start()
    try:
        some_words()
        before = tracemalloc.get_traced_memory()[0]
        for _ in range(10):
            some_words()
        assert tracemalloc.get_traced_memory()[0] - before < 300_000
    finally:
        tracemalloc.stop()


def test_pieces_decoded_at_once(spark, docs, model):
    """Decoding within the same pass gives what the second operator gives."""
    plain = docs.select("doc_id", "text")
    at_once = pieces.encoded(plain, model, decode=True)
    after = pieces.decoded(pieces.encoded(plain, model), model)
    assert at_once.columns == after.columns
    assert at_once.exceptAll(after).count() == after.exceptAll(at_once).count() == 0
