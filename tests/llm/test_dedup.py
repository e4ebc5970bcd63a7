"""Exact and near deduplication against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

from tidemark.llm import near
from tidemark.llm.exact import exact_groups, without_exact_copies
from tidemark.llm.near import near_components, without_near_copies

SPACE = "[ \t-\r]"


def exact_by_hand(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(SPACE, "", t or "")].append((-len(t or ""), i))
    out = set()
    for bare, members in groups.items():
        keep = min(members)[1]
        out |= {(i, keep, len(members), i == keep, hashlib.sha256(bare.encode()).hexdigest()) for _, i in members}
    return out


TEXTS = ["one two", "one  two", "onetwo", " one\ttwo\n", None, "", " \n", "é x", "é x", "x" * 100, "y" * 100, "x" * 99 + "y", "x" * 64 + "z" * 36, "onetwo"]


def frame(spark, rows):
    """Documents with more columns, named as the operators name theirs."""
    data = [(i, t, "k", i or 0, True, "s") for i, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, __sha string, n_chars long, kept boolean, __id string")


@pytest.mark.parametrize("digest_all", [False, True])
def test_exact_groups(spark, digest_all):
    rows = list(enumerate(TEXTS)) + [(100 + i, "hot copy of one text") for i in range(50)]
    got = exact_groups(frame(spark, rows), digest_all=digest_all).collect()
    want = exact_by_hand(rows)
    assert {r[:4] for r in map(tuple, got)} == {w[:4] for w in want}
    for r in got:
        assert r["text_sha256"] is None or (*r[:4], r["text_sha256"]) in want
        assert r["text_sha256"] is not None or not digest_all
        assert r["settled_by"] == "full" or r["group_size"] == 1
    assert {r["settled_by"] for r in got} == {"length", "prefix", "full"}


def test_exact_repeated_rows_missing_ids_and_empty_table(spark):
    got = exact_groups(frame(spark, [(1, "a"), (1, "a"), (None, "a"), (None, "b")])).collect()
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"]) for r in got) == [
        ("1", "1", 3, True),
        ("1", "1", 3, True),
        ("None", "1", 3, False),
        ("None", "None", 1, True),
    ]
    assert exact_groups(frame(spark, [])).count() == 0
    assert without_exact_copies(frame(spark, [])).count() == 0


def test_without_exact_copies_keeps_columns(spark):
    rows = list(enumerate(TEXTS))
    docs = frame(spark, rows)
    kept = without_exact_copies(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {w[0] for w in exact_by_hand(rows) if w[3]}


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in re.split(SPACE + "+", low) if x]
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components_by_hand(rows):
    sets = {i: shingles(t) for i, t in rows}
    least = {i: i for i in sets}
    changed = True
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in pairs:
            m = min(least[a], least[b])
            changed |= (least[a], least[b]) != (m, m)
            least[a] = least[b] = m
    return {(i, len(sets[i]), least[i], least[i] == i) for i in sets}


def edited(rng, words, rate):
    out = []
    for w in words:
        if rng.random() < rate:
            out.append(f"new{rng.randrange(10**6)}")
        else:
            out.append(w)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_near_components(spark, seed):
    """A large group around one text whose members are often too far from each other, chains, copies and shared passages."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    base = [word() for _ in range(160)]
    texts = [" ".join(base)] + [" ".join(edited(rng, base, rng.choice([0.01, 0.02, 0.03, 0.04]))) for _ in range(90)]
    for _ in range(8):  # chains: each text is an edit of the one before
        t = [word() for _ in range(60)]
        for _ in range(5):
            texts.append(" ".join(t))
            t = edited(rng, t, 0.02)
    passage = " ".join(word() for _ in range(60))
    texts += [passage + " " + " ".join(word() for _ in range(rng.randrange(10, 60))) for _ in range(40)]
    texts += ["Short Text", "short text", "short\ttext", "a b c d e", "A B C D E", None, "", "  "] + [texts[0].upper()] * 5
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = near_components(frame(spark, rows)).collect()
    assert {tuple(r) for r in got} == components_by_hand(rows)


def test_near_rows_that_repeat_and_empty_table(spark):
    rows = [(3, "a b c d e f"), (3, "a b c d e f"), (2, "A b c d e f"), (None, "a b c d e f"), (None, "x"), (9, None)]
    got = near_components(frame(spark, rows)).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in got) == [
        ("2", "2", True),
        ("3", "2", False),
        ("3", "2", False),
        ("9", "9", True),
        ("None", "2", False),
        ("None", "None", True),
    ]
    docs = frame(spark, rows)
    kept = without_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "9", "None", "None"]
    assert near_components(frame(spark, [])).count() == 0


def test_near_ids_with_several_texts_lose_no_link(spark):
    """Rows that share an id are linked each by its own text, whichever of them stands for the id."""
    rng = random.Random(3)
    a, b, c = (" ".join(f"{k}{rng.randrange(5000)}" for _ in range(60)) for k in "abc")
    rows = [(5, a), (5, b), (7, a + " more"), (9, b + " more"), (11, c), (12, c + " more"), (12, c + " more"), (13, "one other text of six words")]
    got = near_components(frame(spark, rows)).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted(
        (i, len(shingles(t)), {5: 5, 7: 5, 9: 5, 11: 11, 12: 11, 13: 13}[i]) for i, t in rows
    )


def test_near_steps_of_few_rows_write_few_files(spark, monkeypatch):
    """Many more shuffle partitions than rows: steps on links and labels do not write a file for each partition."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(3000)}" for _ in range(160)]
    rows = list(enumerate([" ".join(edited(rng, base, 0.02)) for _ in range(60)] + [f"alone {k} " + " ".join(f"v{rng.randrange(10**6)}" for _ in range(30)) for k in range(20)]))
    files = []

    def counted(df, write=near.settled):
        out = write(df)
        files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(near, "settled", counted)
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        got = near.near_components(frame(spark, rows)).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {tuple(r) for r in got} == components_by_hand(rows)
    assert sum(n > near.FEWEST_FILES for n in files) < len(files) / 4
