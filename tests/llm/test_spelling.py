"""Spelling variants against comparing all words with each other."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from tidemark.llm import spelling
from tidemark.llm.queries import op12_spelling

LOWER = {c: c + 32 for c in range(65, 91)}


def words_by_hand(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[at + (len(a) >= len(b)) :] == b[at + (len(b) >= len(a)) :]


def groups_by_hand(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


@pytest.mark.parametrize("symbols", [1, 2, 4, 16])
def test_keys_meet_for_all_words_one_edit_apart(symbols):
    rng = random.Random(symbols)
    letters = "abcé÷"
    code = lambda w: np.array([[ord(c) for c in w]], np.uint64)
    for _ in range(400):
        a = "".join(rng.choice(letters) for _ in range(rng.randrange(5, 11)))
        at, kind = rng.randrange(len(a)), rng.randrange(3)
        b = a[:at] + rng.choice(letters) * (kind > 0) + a[at + (kind < 2) :]
        keys, _, sides = spelling.neighbour_keys(code(a), symbols)
        assert len(set(zip(keys.tolist(), sides.tolist(), strict=True))) == len(keys)
        if a != b:
            found, _, entry_sides = spelling.entry_keys(code(b), symbols)
            side = int(a[: len(a) // 2] != b[: len(a) // 2])
            assert set(keys[sides == side].tolist()) & set(found[entry_sides == side].tolist())


def frame(spark, rows):
    """Documents with more columns, named as the operator names its own."""
    return spark.createDataFrame([(i, t, "w", 1, 2) for i, t in rows], "doc_id long, text string, word string, n int, key int")


@pytest.mark.parametrize("symbols", [2, 4])
def test_variant_groups(spark, symbols):
    rng = random.Random(9)
    stems = ["abcde", "Abcdé", "aabbaab", "hello", "hellos", "yellow", "ÀBCDE", "aaaaaaa", "aaaaaaaa", "÷×÷×÷"]

    def word():
        w = rng.choice(stems)
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
            at = rng.randrange(len(w))
            w = w[:at] + rng.choice(["", "a", "b", "é", "ae"]) + w[at + rng.randrange(2) :]
        return w

    rows = [(i, rng.choice([" ", ", ", "1"]).join(word() for _ in range(rng.choice([1, 30, 200])))) for i in range(150)]
    rows += [(None, "nullid nullid nullid"), (1, None), (2, ""), (3, "12 34"), (4, "repeated row"), (4, "repeated row"), (4, "repeated row")]
    rows += [(5, "chain " * 3 + "chaim " * 6 + "claim " * 12 + "claims " * 24 + "clams " * 3)]
    rows += [(6, "x" * 300_000 + " " + "verylong " * 50_000)]
    words = words_by_hand(rows)
    got = spelling.variant_groups(spelling.vocabulary(frame(spark, rows).repartition(4)), symbols).collect()
    assert len(got) == len(words)
    assert set(map(tuple, got)) == groups_by_hand(words)


def test_words_of_an_empty_table(spark):
    assert spelling.variant_groups(spelling.vocabulary(frame(spark, []))).count() == 0


def test_query(spark, tiny):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{tiny}/documents.parquet'").fetchall()
    got = list(map(tuple, op12_spelling(spark, tiny).collect()))
    want = groups_by_hand(words_by_hand(rows))
    assert set(got) == want and len(got) == len(want)
