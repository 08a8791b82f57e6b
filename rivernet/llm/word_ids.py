"""Ids of whole texts by the ``tokenizers`` library, each distinct word encoded once.

Plain texts are cut into the library's own words with numpy.  Words are told
apart by a 64-bit polynomial of their characters, and every occurrence is
compared, character by character, with the word that stands for its number; a
batch with two words of one number goes to the library as it is.  The library's
model encodes each word that the worker has not met; the library encodes whole
texts that are not plain or hold one of its special strings.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd

from rivernet.llm.common import chunks
from rivernet.llm.presplit import CLASS, END, ODD, _codes, _split

#: Words that a worker keeps (about 50 bytes each); beyond it they are forgotten.
KEPT_WORDS = 2_000_000
#: Characters split and looked up together.
TOGETHER = 1_000_000
#: Any odd number with mixed bits.
BASE = 0x9E3779B97F4A7C15


def byte_letters() -> dict[int, str]:
    """Characters that stand for the bytes 0 to 255 in byte-level vocabularies,
    by their public rule: printable Latin-1 as it is, the others from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*shown}))}


def ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places begin, begin + 1, ... of each stretch, one after the other."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin - ends + size, size)


class Words:
    """Known words by number: their characters, to be sure, and their ids."""

    def __init__(self) -> None:
        self.number = np.empty(0, dtype=np.uint64)  # sorted
        self.entry = np.empty(0, dtype=np.int64)    # where a number's word is in what follows
        self.letters, self.letter_end = np.empty(0, dtype=np.uint16), np.zeros(1, dtype=np.int64)
        self.ids, self.id_end = np.empty(0, dtype=np.uint32), np.zeros(1, dtype=np.int64)

    def find(self, number: np.ndarray) -> np.ndarray:
        """Entries of the numbers, -1 where unknown."""
        if not len(self.number):
            return np.full(len(number), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.number, number), len(self.number) - 1)
        return np.where(self.number[at] == number, self.entry[at], -1)

    def add(self, number: np.ndarray, letters: np.ndarray, sizes: np.ndarray, ids: list[list[int]]) -> None:
        both = np.concatenate([self.number, number])
        entry = np.concatenate([self.entry, np.arange(len(number)) + len(self.entry)])
        by = np.argsort(both, kind="stable")
        self.number, self.entry = both[by], entry[by]
        self.letters = np.concatenate([self.letters, letters])
        self.letter_end = np.concatenate([self.letter_end, self.letter_end[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, np.fromiter((i for x in ids for i in x), dtype=np.uint32)])
        self.id_end = np.concatenate([self.id_end, self.id_end[-1] + np.cumsum([len(x) for x in ids])])


class WordIds:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        spec = json.loads(self.tokenizer.to_str())
        if spec["normalizer"] or spec["pre_tokenizer"] != {
                "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
            raise ValueError(f"not a plain byte-level tokenizer: {path}")
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.letter = str.maketrans({chr(b): c for b, c in byte_letters().items()})
        self.words = Words()
        self._powers(TOGETHER)

    def _powers(self, n: int) -> None:
        self.power, self.inverse = np.ones(n, dtype=np.uint64), np.ones(n, dtype=np.uint64)
        for out, factor in ((self.power, BASE), (self.inverse, pow(BASE, -1, 1 << 64))):
            out[1:] = factor
            np.multiply.accumulate(out, out=out)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _model(self, word: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(word.encode().decode("latin-1").translate(self.letter))]

    def encode(self, rows: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text, in order."""
        for _, part in chunks(rows, TOGETHER):
            easy = [not any(s in t for s in self.special) and "\x00" not in t for t in part]
            plain = [t for t, e in zip(part, easy, strict=True) if e]
            done = iter(self._plain(plain))
            for t, e in zip(part, easy, strict=True):
                yield next(done) if e else self.whole(t)

    def _plain(self, rows: list[str]) -> list[np.ndarray]:
        """Ids of texts without special strings and zero characters."""
        if not rows:
            return []
        joined = "\x00".join(rows) + "\x00"
        codes = _codes(joined)
        odd = np.flatnonzero(CLASS[np.minimum(codes, len(CLASS) - 1)] == ODD)
        ends = np.flatnonzero(codes == END_MARK)
        if len(odd):
            hard = {*np.searchsorted(ends, odd).tolist()}
            rest = iter(self._plain([t for i, t in enumerate(rows) if i not in hard]))
            return [self.whole(t) if i in hard else next(rest) for i, t in enumerate(rows)]
        begin, end = _split(joined, True)
        found = self._words(joined, codes, begin, end)
        if found is None:
            return [self.whole(t) for t in rows]
        at, size = found
        ids = self.words.ids[ragged(at, size)]
        upto = np.append(0, np.cumsum(size))[np.searchsorted(begin, ends)]
        return np.split(ids, upto[:-1])

    def _words(self, joined: str, codes: np.ndarray, begin: np.ndarray,
               end: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Where the ids of each word begin and how many they are; None if two
        words have one number."""
        if len(codes) > len(self.power):
            self._powers(len(codes))
        upto = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum(codes * self.power[:len(codes)], out=upto[1:])
        number = (upto[end] - upto[begin]) * self.inverse[begin]
        kind, numbers = pd.factorize(number)
        size = end - begin
        first = np.empty(len(numbers), dtype=np.int64)
        first[kind[::-1]] = np.arange(len(kind) - 1, -1, -1)
        one = begin[first][kind]
        if (size != size[first][kind]).any() or (codes[ragged(one, size)] != codes[ragged(begin, size)]).any():
            return None
        entry = self.words.find(numbers)
        if len(self.words.number) + (entry < 0).sum() > KEPT_WORDS:
            self.words = Words()
            entry[:] = -1
        own, own_size = begin[first], size[first]
        old = np.flatnonzero(entry >= 0)
        known = self.words.letter_end[entry[old]]
        if (self.words.letter_end[entry[old] + 1] - known != own_size[old]).any() or (
                self.words.letters[ragged(known, own_size[old])] != codes[ragged(own[old], own_size[old])]).any():
            return None
        new = np.flatnonzero(entry < 0)
        if len(new):
            entry[new] = len(self.words.entry) + np.arange(len(new))
            ids = [self._model(joined[b:e]) for b, e in zip(own[new].tolist(), (own + own_size)[new].tolist(), strict=True)]
            self.words.add(numbers[new], codes[ragged(own[new], own_size[new])].astype(np.uint16), own_size[new], ids)
        at = self.words.id_end[entry]
        return at[kind], (self.words.id_end[entry + 1] - at)[kind]


#: Stands between joined texts.
END_MARK = 0
assert CLASS[END_MARK] == END


@lru_cache(maxsize=2)
def load(path: str) -> WordIds:
    """One for each worker process and file."""
    return WordIds(path)
