"""SentencePiece encoding with the n best segmentations, and decoding.

The pieces of a vocabulary that fit a text form a lattice.  A forward Viterbi pass finds
the best score of every prefix; searching backward from the end with A*, those scores are
exact estimates of what is still to come, so the first ``n`` complete paths that leave
the agenda are the n best segmentations in order, and nothing beyond them is expanded.

The lattice of a text falls apart wherever no piece of the vocabulary has the two
characters side by side: behind every word, but for the few characters of white space
(as carriage returns) that pieces have behind others; there it does so behind these.
The distinct words of a slice of texts, each with the space before it, are looked at together, position by position, for
their best segmentation and how much worse the next one is (forward and backward scores
tell); nothing about them is kept for the next slice.  The n best of a whole text are the least
``n`` sums of at most one loss per word, for which the n - 1 words with the least first
losses are enough; A* finds those words' n best.  Scores are the vocabulary's; a character of no
piece becomes its UTF-8 bytes' pieces at a fixed penalty.

NULL and empty texts have no pieces, one segmentation and score 0.  Texts are encoded
whole and one by one, so repeated rows repeat their result.  Of equal scores the search
order decides, which depends on the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices
from tidemark.llm.shingles import spaced_words, words

SPACE, BEST = "▁", 4

#: Characters of words that are looked at together, and the longest of these words; longer ones are looked at alone.
CELLS, LONG = 1 << 16, 64

#: Bytes of text looked at together, unless one text alone is longer.
SLICE_BYTES = 512 << 10

#: How much worse an unknown character is than the worst ordinary piece; scores below the bound mark pieces kept out of use.
PENALTY, OUT_OF_USE = 10.0, -1e8

Way = tuple[float, tuple[int, ...]]  #: a segmentation's score and ids
Edge = tuple[int, tuple[int, ...], float]  #: where a piece begins, its ids and its score


class Lattice:
    """The pieces of a SentencePiece vocabulary and their scores."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.bytes: dict[int, int] = {}
        self.score: list[float] = []
        plain: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.score.append(model.get_score(i))
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                plain.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                plain.append(b"")
            else:
                self.ids[piece] = i
                plain.append(piece.replace(SPACE, " ").encode())
        self.unknown = min(self.score[i] for i in self.ids.values() if self.score[i] > OUT_OF_USE) - PENALTY
        usable = {p: ((i,), self.score[i]) for p, i in self.ids.items()}
        self.starts = {p[:k]: usable.get(p[:k]) for p in self.ids for k in range(1, len(p) + 1)}  # None: only the start of pieces
        self.joins = np.zeros((256, 256), bool)  # bytes that some piece has side by side
        for p in self.ids:
            b = np.frombuffer(p.replace(SPACE, " ").encode(), np.uint8)
            self.joins[b[:-1], b[1:]] = True
        number = {"": 0} | {p: k for k, p in enumerate(self.starts, 1)}
        steps = sorted((number[p[:-1]] << 21 | ord(p[-1]), k) for p, k in number.items() if p)
        self.steps = np.array([s for s, _ in steps], np.int64)  # from a start of pieces by a character
        self.to = np.array([k for _, k in steps], np.int64)  # to a longer one
        ends = [None, *self.starts.values()]
        self.piece_at = np.array([-1 if e is None else e[0][0] for e in ends], np.int32)
        self.score_at = np.array([-np.inf if e is None else e[1] for e in ends])
        self.longest = max(map(len, self.ids))
        self.flat = np.frombuffer(b"".join(plain), np.uint8)
        self.size = np.array([len(p) for p in plain], np.int64)
        self.begin = np.cumsum(self.size) - self.size

    def _edges(self, text: str) -> tuple[list[float], list[list[Edge]]]:
        """The best score of every prefix, and the pieces that end at each place."""
        end, starts = len(text), self.starts
        best = [0.0] + [-np.inf] * end
        into: list[list[Edge]] = [[] for _ in range(end + 1)]
        for i in range(end):
            here, single = best[i], False
            for j in range(i + 1, end + 1):
                piece = starts.get(text[i:j], starts)
                if piece is starts:
                    break
                if piece is not None:
                    ids, score = piece
                    into[j].append((i, ids, score))
                    if here + score > best[j]:
                        best[j] = here + score
                    if j == i + 1:
                        single = True
            if not single:
                ids = tuple(self.bytes[b] for b in text[i].encode())
                into[i + 1].append((i, ids, self.unknown))
                best[i + 1] = max(best[i + 1], here + self.unknown)
        return best, into

    def best(self, text: str) -> tuple[tuple[int, ...], float, float]:
        """The best segmentation, its score, and how much worse the next one is.

        Every other segmentation has a piece that the best one lacks, so the next one's
        score is the best of a path through such a piece, from the scores of prefixes
        and suffixes.
        """
        before, into = self._edges(text)
        end, total = len(text), before[-1]
        after = [-np.inf] * end + [0.0]
        for j in range(end, 0, -1):
            behind = after[j]
            for i, _, score in into[j]:
                if behind + score > after[i]:
                    after[i] = behind + score
        ids: list[tuple[int, ...]] = []
        next_best, on = -np.inf, end
        for j in range(end, 0, -1):
            mine = None
            for edge in into[j]:
                through = before[edge[0]] + edge[2] + after[j]
                if j == on and mine is None and before[edge[0]] + edge[2] == before[j]:
                    mine = edge
                elif through > next_best:
                    next_best = through
            if mine is not None:
                ids.append(mine[1])
                on = mine[0]
        return tuple(k for part in reversed(ids) for k in part), total, total - next_best

    def best_of(self, chars: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """What ``best`` finds for many words, given as code points: all ids, where each word's begin, their number, (score, loss)."""
        n = len(begin)
        first, count, extra = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros((n, 2))
        found, total = [], 0
        order = np.argsort(size, kind="stable")
        a, short = 0, int(np.count_nonzero(size <= LONG))
        while a < n:
            if a < short:
                b = min(short, a + CELLS // int(size[order[a]]))
                b = min(b, a + CELLS // int(size[order[b - 1]]))
                own = order[a:b]
                ids, counts, extra[own] = self._best_together(chars, begin[own], size[own])
            else:
                b, own = a + 1, order[a : a + 1]
                word = chars[begin[own[0]] : begin[own[0]] + size[own[0]]].astype("<u4").tobytes().decode("utf-32-le")
                way, *scores = self.best(word)
                ids, counts, extra[own] = np.array(way, np.uint32), np.array([len(way)]), scores
            count[own], first[own] = counts, total + np.cumsum(counts) - counts
            found.append(ids)
            total += len(ids)
            a = b
        return np.concatenate(found) if found else np.zeros(0, np.uint32), first, count, extra

    def _best_together(self, chars: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``best`` with a column per word and a row per place; places behind a word's end have no pieces."""
        n, rows, each = len(size), int(size.max()), np.arange(len(size))
        place = np.arange(rows)[:, None]
        inside = place < size
        text = np.where(inside, chars[np.minimum(begin + place, len(chars) - 1)], -1).astype(np.int64)
        # Score and id of the piece of k + 1 characters that begins at each place.
        score = np.full((min(self.longest, rows), rows, n), -np.inf)
        piece = np.full(score.shape, -1, np.int32)
        at, start, deep, letters = np.flatnonzero(inside), 0, 1, text.ravel()
        for k in range(len(score)):
            here = at + k * n < rows * n
            at, start = at[here], start if k == 0 else start[here]
            step = start << 21 | letters[at + k * n]  # -1 behind a word's end
            found = np.minimum(np.searchsorted(self.steps, step), len(self.steps) - 1)
            hit = self.steps[found] == step
            at, start = at[hit], self.to[found[hit]]
            if not len(at):
                break
            score[k].ravel()[at], piece[k].ravel()[at] = self.score_at[start], self.piece_at[start]
            deep = k + 1
        strange = inside & (piece[0] < 0)
        score[0][strange], piece[0][strange] = self.unknown, -2
        before = np.full((rows + 1, n), -np.inf)
        before[0] = 0
        for j in range(1, rows + 1):
            for k in range(1, min(deep, j) + 1):
                np.maximum(before[j], before[j - k] + score[k - 1, j - k], out=before[j])
        after = np.full((rows + 1, n), -np.inf)
        after[size, each] = 0
        for j in range(rows, 0, -1):
            for k in range(1, min(deep, j) + 1):
                np.maximum(after[j - k], after[j] + score[k - 1, j - k], out=after[j - k])
        on = np.zeros((rows + 1, n), bool)
        on[size, each] = True
        chosen, next_best = np.full((rows, n), -1, np.int32), np.full(n, -np.inf)
        for j in range(rows, 0, -1):
            open_ = on[j].copy()
            for k in range(min(deep, j), 0, -1):
                here = before[j - k] + score[k - 1, j - k]
                mine = open_ & (here == before[j])
                np.maximum(next_best, np.where(mine, -np.inf, here + after[j]), out=next_best)
                chosen[j - k][mine] = piece[k - 1, j - k][mine]
                on[j - k] |= mine
                open_ &= ~mine
        total = before[size, each]
        taken = chosen.T != -1
        ids, counts = chosen.T[taken], taken.sum(1)
        if strange.any():
            odd = ids == -2
            char = text.T[taken][odd]
            width = np.ones(len(ids), np.int64)
            width[odd] += (char >= 0x80).astype(np.int64) + (char >= 0x800) + (char >= 0x10000)
            doc = np.repeat(each, counts)
            odd, ids, counts = np.repeat(odd, width), np.repeat(ids, width), np.bincount(np.repeat(doc, width), minlength=n)
            ids[odd] = [self.bytes[b] for b in "".join(map(chr, char.tolist())).encode()]
        return ids.astype(np.uint32), counts, np.stack([total, total - next_best], 1)

    def n_best(self, text: str, n: int) -> list[Way]:
        """The n best segmentations of a string whose spaces are written as the vocabulary's, best first."""
        end = len(text)
        best, into = self._edges(text)
        found: list[Way] = []
        agenda: list[tuple] = [(-best[end], end, 0, 0.0, None)]
        pushed, left = 0, [n] * (end + 1)  # no place is left more than n times: worse endings can't be among the n best
        while agenda and len(found) < n:
            _, at, _, behind, path = heappop(agenda)
            if not left[at]:
                continue
            left[at] -= 1
            if at == 0:
                whole: list[int] = []
                while path is not None:
                    whole += path[0]
                    path = path[1]
                found.append((behind, tuple(whole)))
                continue
            for start, ids, score in into[at]:
                if left[start]:
                    pushed += 1
                    heappush(agenda, (-(best[start] + behind + score), start, pushed, behind + score, (ids, path)))
        return found

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of a sequence of pieces; the space put before the text is taken off."""
        sizes = self.size[ids]
        ends = np.cumsum(sizes)
        data = self.flat[np.repeat(self.begin[ids] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        return data[1:] if data.startswith(b" ") else data


@lru_cache(maxsize=2)
def lattice(path: str) -> Lattice:
    return Lattice(path)


def _characters(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parts of UTF-8 texts as code points, spaces as the vocabulary's, one more put before the first part of a text; where each begins, its length."""
    sizes = ends - starts
    before = np.cumsum(sizes) - sizes
    own = data[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]
    chars = np.frombuffer(own.tobytes().decode().encode("utf-32-le"), "<u4").copy()
    chars[chars == 32] = ord(SPACE)
    begun = np.concatenate([[0], np.cumsum((own & 0xC0) != 0x80)])
    length = begun[before + sizes] - begun[before]
    chars = np.insert(chars, begun[before[first]], ord(SPACE))
    length += first
    return chars, np.cumsum(length) - length, length


class Segmenter:
    def __init__(self, path: str, n: int) -> None:
        self.lattice, self.n = lattice(path), n
        self.ways = lru_cache(maxsize=1 << 12)(lambda text: self.lattice.n_best(text, n))

    def __call__(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, float, list[tuple[float, list[tuple[int, int, tuple[int, ...]]]]]]]:
        """For each text: the best ids, their score, and the other segmentations as (score, [(start, end, ids)]) against the best."""
        w = words(texts, lower=False)
        hashes, starts, ends, doc = spaced_words(w, self.lattice.joins)
        data = w.bytes.tobytes()
        first = np.zeros(len(starts), bool)
        first[np.searchsorted(starts, w.offsets[:-1][np.diff(w.offsets) > 0])] = True

        def string(k: int) -> str:
            part = data[starts[k] : ends[k]].decode().replace(" ", SPACE)
            return SPACE + part if first[k] else part

        _, at, place = np.unique(hashes, return_index=True, return_inverse=True)
        found, begin, count, extra = self.lattice.best_of(*_characters(w.bytes, starts[at], ends[at], first[at]))
        sizes = count[place]
        id_ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = found[np.repeat(begin[place] - id_ends[:-1], sizes) + np.arange(id_ends[-1])]
        extra = extra[place]
        bounds = np.searchsorted(doc, np.arange(len(texts) + 1)).tolist()
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            score = float(extra[a:b, 0].sum())
            yield ids[id_ends[a] : id_ends[b]], score, self._others(extra[a:b, 1], a, score, ids, id_ends, string)

    def _others(self, losses: np.ndarray, a: int, score: float, ids: np.ndarray, id_ends: np.ndarray, string) -> list:
        if self.n < 2 or not len(losses):
            return []
        k = min(self.n - 1, len(losses))
        near = np.sort(np.argpartition(losses, k - 1)[:k]) if k < len(losses) else np.arange(len(losses))
        sums: list[tuple[float, tuple[tuple[int, int], ...]]] = [(0.0, ())]
        choices = {}
        for u in near.tolist():
            chosen = tuple(ids[id_ends[a + u] : id_ends[a + u + 1]].tolist())
            ways = self.ways(string(a + u))
            top = ways[0][0]
            choices[u] = [(top - s, way) for s, way in ways if way != chosen][: self.n - 1]
            sums = sorted(sums + [(s + loss, (*taken, (u, j))) for s, taken in sums for j, (loss, _) in enumerate(choices[u])])[: self.n]
        out = []
        for loss, taken in sums[1:]:
            edits = [(int(id_ends[a + u] - id_ends[a]), int(id_ends[a + u + 1] - id_ends[a]), choices[u][j][1]) for u, j in taken]
            out.append((score - loss, edits))
        return out


@lru_cache(maxsize=2)
def segmenter(path: str, n: int) -> Segmenter:
    return Segmenter(path, n)


_EDIT = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("ids", pa.list_(pa.int32()))])
_OTHER = pa.struct([("score", pa.float64()), ("edits", pa.list_(_EDIT))])
_OTHER_SQL = "array<struct<score double, edits array<struct<start long, end long, ids array<int>>>>>"


def _encode(batches: Iterator[pa.RecordBatch], path: str, n: int, decode: bool = False) -> Iterator[pa.RecordBatch]:
    segment = segmenter(path, n)
    for batch, text in slices(batches, 1, SLICE_BYTES):
        ids, scores, others = [], [], []
        for best, score, rest in segment(text):
            ids.append(best.astype("<u4").tobytes())
            scores.append(score)
            others.append([{"score": s, "edits": [{"start": a, "end": b, "ids": list(i)} for a, b, i in edits]} for s, edits in rest])
        out = pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(ids, pa.binary()), pa.array(scores, pa.float64()), pa.array(others, pa.list_(_OTHER))],
            ["doc_id", "ids", "score", "others"],
        )
        yield out.append_column("decoded", _decoded(segment.lattice, ids)) if decode else out


def encoded(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", n: int = BEST, decode: bool = False) -> DataFrame:
    """One row per row: doc_id, ids of the best segmentation (32-bit little-endian), its score, and the next n - 1.

    Each of ``others`` has its score and what differs from the best: from piece
    ``start`` to before piece ``end`` it has the pieces ``ids``.  With ``decode``, ids are read back
    as ``decoded`` does, by the same workers, so that no second one per task holds the vocabulary.
    """
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`"))
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids binary, score double, others {_OTHER_SQL}" + ", decoded string" * decode
    return source.mapInArrow(partial(_encode, path=path, n=n, decode=decode), schema)


def _decoded(pieces: Lattice, column: list[bytes | None]) -> pa.Array:
    return pa.array([pieces.decode(np.frombuffer(b or b"", "<u4")).decode("utf-8", "replace") for b in column], pa.string())


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    pieces = lattice(path)
    for batch in batches:
        column = batch.column(batch.schema.get_field_index("ids")).to_pylist()
        yield batch.append_column("decoded", _decoded(pieces, column))


def decoded(frame: DataFrame, path: str) -> DataFrame:
    """The frame with a column ``decoded``, the text of the pieces in ``ids``; NULL decodes to the empty text."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema)
    return frame.mapInArrow(partial(_decode, path=path), f"{schema}, decoded string")
