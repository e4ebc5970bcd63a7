"""Repair of conversations against a search over all edits, and of the query against a plain version."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from tidemark.llm import conversations as cv
from tidemark.llm.queries import op13_conversations

NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest_by_search(rows):
    """rows: (initial, fault).  Uniform-cost search over (row, state); of equal costs the least edits come first."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, state = heapq.heappop(heap)
        if (at, state) in seen:
            continue
        seen.add((at, state))
        if at == len(rows) and state in ("", "a"):
            return cost, audit
        for initial in "ua":
            if (state, initial) in NEXT:
                heapq.heappush(heap, (cost + 2, audit + "I", at, NEXT[state, initial]))
        if at < len(rows):
            initial, fault = rows[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, state))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if (state, initial) in NEXT:
                    heapq.heappush(heap, (cost + extra, audit + "K", at + 1, NEXT[state, initial]))
                for new in "ua":
                    if (state, new) in NEXT:
                        heapq.heappush(heap, (cost + 2 + extra, audit + "R", at + 1, NEXT[state, new]))
    raise AssertionError


def damaged_by_hand(rows):
    out, ids = defaultdict(list), set()
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        ids.add(conv)
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    return ids, out


def repaired_by_hand(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    faults, seen = [], set()
    for _, role, text in order:
        bare = re.sub("[ \t-\r]", "", text)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    cost, audit = cheapest_by_search([(r[1][:1], f) for r, f in zip(order, faults, strict=True)])
    out, at, state = [], 0, ""
    for edit in audit:
        wanted = "assistant" if state == "u" else "user"
        if edit == "I":
            out.append((wanted, "", edit))
        else:
            role, text = order[at][1:]
            at += 1
            if edit == "D":
                continue
            out.append((wanted if edit == "R" else role, text, edit))
        state = NEXT[state, out[-1][0][0]]
    turns = [r[0] for r in order if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[1][:1] for r in order]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t, _ in out).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest), out


def test_matrices_equal_a_search():
    rng = random.Random(1)
    faults = {"x": "blank"}
    for k in range(600):
        sequence = "".join(rng.choice(cv.SYMBOLS) for _ in range(rng.randrange(1, 12)))
        rules = [("ua", ""), ("", ""), ("xx", ""), ("uS", "")][: k % 5]
        matrix = cv.sequence_matrix(sequence, rules, cv.rule_matrices(rules))
        rows = [(s.lower() if s not in "oOx" else "?", faults.get(s, "truncated" if s.isupper() else None)) for s in sequence]
        assert cv.cheapest(matrix[0]) == cheapest_by_search(rows), sequence


def test_ropes():
    rng = random.Random(2)
    ropes = [cv.leaf(t) for t in ("", "a", "ab", "b", "aba")]
    for _ in range(400):
        ropes.append(cv.joined(rng.choice(ropes), rng.choice(ropes[-9:])))
    for _ in range(2000):
        a, b = rng.choice(ropes[:60]), rng.choice(ropes[:60])
        assert cv.less(a, b) == (str(a) < str(b))


WORDS = ["Yes.", "no", "", " \n", "Why?", "a b c", "x!\v", "é"]


def fixture():
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "user", "assistant", "tool", None, ""]), rng.choice([*WORDS, f"{c} {t}.", None])) for c in range(150) for t in range(rng.randrange(1, 9))]
    rows += [(None, None, "user", "a."), (None, 1, None, None), (None, 1, None, None), (200, None, "user", "Hi.")]
    rows += [(300, t, "user" if t % 2 else "assistant", f"{t % 700}.") for t in range(2000)]
    rows += [(301, 4, "user", "the same.") for _ in range(300)]
    rows.append((302, 1, "user", "long " * 200_000 + "."))
    return rows


def frame(spark, rows):
    """Conversations with more columns, named as the operator names its own."""
    data = [(*r, 1, "f", b"d", True) for r in rows]
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string, row int, fault string, digest binary, present boolean")


@pytest.mark.parametrize("piece", [7, cv.PIECE])
def test_repaired(spark, piece):
    rows = fixture()
    ids, by_conv = damaged_by_hand(rows)
    damaged = cv.damaged(frame(spark, rows).repartition(5)).cache()
    got = {r["conv_id"]: tuple(r)[1:] for r in cv.repaired(damaged, piece).collect()}
    want = {i: repaired_by_hand(by_conv[i]) for i in ids}
    assert got == {i: w[0] for i, w in want.items()}
    turns = defaultdict(list)
    for r in sorted(map(tuple, cv.repaired_turns(damaged, piece).collect()), key=lambda r: r[1]):
        turns[r[0]].append(r[2:])
    assert turns == {i: w[1] for i, w in want.items() if w[1]}
    damaged.unpersist()


def test_empty_table_and_absent_rows(spark):
    assert cv.repaired(cv.damaged(frame(spark, []))).count() == 0
    absent = spark.createDataFrame([(1, 2, "user", "a.", False)], "conv_id long, turn long, role string, text string, present boolean")
    assert list(map(tuple, cv.repaired(absent).collect())) == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_query(spark, tiny):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{tiny}/conversations.parquet'").fetchall()
    ids, by_conv = damaged_by_hand(rows)
    got = {tuple(r) for r in op13_conversations(spark, tiny).collect()}
    assert got == {(i, *repaired_by_hand(by_conv[i])[0]) for i in ids}
