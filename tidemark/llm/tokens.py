"""Token ids of whole columns of text, each distinct word encoded once per process."""

from __future__ import annotations

import json
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

from tidemark.llm.shingles import words

#: Distinct words that a process remembers before it starts anew.
CACHE_WORDS = 1 << 20

#: Distinct parts of words that a process remembers; they serve new words only.
CACHE_PARTS = 1 << 17

#: A word that the vocabulary's own rules split into a run of letters and a run of marks; anything else takes the long way.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([.,!|%$&#*;:?]*)")


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte in a byte-level vocabulary: itself if printable, else the next free letter from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in own}
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + len(table) - len(own))
    return [table[b] for b in range(256)]


class _Grown:
    """An array that grows at its end, in place most of the time."""

    def __init__(self, dtype: type) -> None:
        self.room, self.size = np.zeros(1024, dtype), 0

    def add(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self.room):
            wider = np.zeros(max(need, self.size * 3 // 2), self.room.dtype)
            wider[: self.size] = self.room[: self.size]
            self.room = wider
        self.room[self.size : need] = values
        self.size = need

    @property
    def values(self) -> np.ndarray:
        return self.room[: self.size]


class Known:
    """Ids of strings already met in this process, found by the strings' hashes.

    Hashes are sorted in two parts: most of them, and those learnt since, which join the
    others when they are an eighth of them.  So a slice's few new strings cost little,
    however many are known.
    """

    def __init__(self) -> None:
        self.forget()

    def forget(self) -> None:
        none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.parts = [none, none]
        self.flat, self.begin, self.size = _Grown(np.uint32), _Grown(np.int64), _Grown(np.int64)

    def __len__(self) -> int:
        return self.size.size

    def unknown(self, keys: np.ndarray) -> np.ndarray:
        return self.slot(keys) < 0

    def learn(self, keys: np.ndarray, found: list) -> None:
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        slots = len(self) + np.arange(len(found))
        self.begin.add(self.flat.size + np.cumsum(sizes) - sizes)
        self.flat.add(np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())))
        self.size.add(sizes)
        most, late = self.parts
        late = self._merged(late, (keys, slots))
        if 8 * len(late[0]) > len(most[0]):
            most, late = self._merged(most, late), (late[0][:0], late[1][:0])
        self.parts = [most, late]

    @staticmethod
    def _merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        keys, slots = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
        order = np.argsort(keys, kind="stable")
        return keys[order], slots[order]

    def slot(self, keys: np.ndarray) -> np.ndarray:
        """Where each string is kept; -1 for those not known."""
        out = np.full(len(keys), -1, np.int64)
        for known, slots in self.parts:
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                hit = known[at] == keys
                out[hit] = slots[at[hit]]
        return out

    def ids(self, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a sequence of slots, flat, and where each slot's end."""
        sizes = self.size.values[slot]
        ends = np.cumsum(sizes)
        return self.flat.values[np.repeat(self.begin.values[slot] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)], ends


class Encoder:
    """Encodes with a vocabulary file of the tokenizers library, without added special tokens.

    A vocabulary that drops white space and marks word ends gives a word the same ids
    wherever it stands, so texts are cut at ASCII white space, distinct words are found
    by hash, and only those not yet known are encoded.  Other vocabularies encode
    whole texts.  ``special_as_text`` treats the strings of special tokens as ordinary
    text.
    """

    def __init__(self, path: str, special_as_text: bool = False) -> None:
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        self.full.encode_special_tokens = special_as_text
        # Only the normalizer's part of the file is read again: the vocabulary is large as Python objects.
        normalizer = json.loads(self.full.normalizer.__getstate__()) if self.full.normalizer is not None else {}
        steps = [n.get("type") for n in normalizer.get("normalizers", [])]
        self.by_word = getattr(self.full.model, "end_of_word_suffix", None) == "</w>" and steps == ["NFC", "Replace", "Lowercase"]
        self.model, self.letters = self.full.model, _byte_letters()
        self.parts: dict[str, tuple[int, ...]] = {}
        self.known = Known()

    def _part(self, part: str) -> tuple[int, ...]:
        got = self.parts.get(part)
        if got is None:
            spelled = part if part.isascii() else "".join(map(self.letters.__getitem__, part.encode()))
            if len(self.parts) >= CACHE_PARTS:
                self.parts.clear()
            got = self.parts[part] = tuple([t.id for t in self.model.tokenize(spelled)])
        return got

    def word(self, word: str) -> tuple[int, ...] | list[int]:
        plain = _PLAIN.fullmatch(word)
        if plain is None:
            return self.full.encode(word, add_special_tokens=False).ids
        core, tail = plain.groups()
        if not tail:
            return self._part(core.lower())
        return self._part(core.lower()) + self._part(tail) if core else self._part(tail)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, flat, and where each text's begin."""
        rows = len(texts)
        if not self.by_word:
            got = [e.ids for e in self.full.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            sizes = np.fromiter(map(len, got), np.int64, rows)
            return np.fromiter(chain.from_iterable(got), np.uint32, int(sizes.sum())), np.concatenate([[0], np.cumsum(sizes)])
        w = words(texts, lower=False)
        if not len(w.hashes):
            return np.zeros(0, np.uint32), np.zeros(rows + 1, np.int64)
        unique, first, place = np.unique(w.hashes, return_index=True, return_inverse=True)
        if len(self.known) > CACHE_WORDS:
            self.known.forget()
        new = self.known.unknown(unique)
        if new.any():
            data, a, b = w.bytes.tobytes(), w.starts[first[new]].tolist(), w.ends[first[new]].tolist()
            self.known.learn(unique[new], [self.word(data[i:j].decode()) for i, j in zip(a, b, strict=True)])
        ids, ends = self.known.ids(self.known.slot(unique)[place])
        bounds = np.searchsorted(w.doc, np.arange(rows + 1))
        return ids, np.concatenate([[0], ends])[bounds]


@lru_cache(maxsize=4)
def encoder(path: str, special_as_text: bool = False) -> Encoder:
    """One encoder per process, vocabulary and mode."""
    return Encoder(path, special_as_text)


def with_end(ids: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with an end id after each text."""
    return np.insert(ids, offsets[1:], end).astype(np.uint32, copy=False), offsets + np.arange(len(offsets))
