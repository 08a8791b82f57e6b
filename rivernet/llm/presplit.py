"""Splitting of texts into the words that byte-pair encoders work on.

Both patterns below are public; they are applied with numpy to whole batches
of texts whose characters are all *plain* (the classes of these are the same
in every Unicode version), and with a regular expression or the library
itself to the others.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import regex

#: The split patterns of the two public tokenizers.
BYTE_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: What may follow an apostrophe in both patterns.
CONTRACTIONS = ("s", "t", "m", "d", "re", "ve", "ll")

BYTE_RE = regex.compile(BYTE_PATTERN)

ODD, LETTER, NUMBER, OTHER, SPACE, END = 0, 1, 2, 3, 4, 5
_LIMIT = 0x2100


def _classes() -> np.ndarray:
    """Class of each code point under 0x2100; ODD where only a library decides."""
    out = np.zeros(_LIMIT + 1, dtype=np.uint8)
    plain = [9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0x180),
             *range(0x2010, 0x2028), *range(0x2030, 0x205F), 0x20AC]
    for c in plain:
        kind = unicodedata.category(chr(c))
        out[c] = (SPACE if c in (9, 10, 13, 32) else LETTER if kind[0] == "L"
                  else NUMBER if kind[0] == "N" else OTHER)
    out[[0x130, 0xAD]] = ODD  # changes its length in lower case; invisible
    out[0] = END  # stands between texts; a text that holds it is not plain
    return out


CLASS = _classes()


def _codes(joined: str) -> np.ndarray:
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def is_plain(text: str) -> bool:
    if "\x00" in text:
        return False
    return bool(CLASS[np.minimum(_codes(text), _LIMIT)].all()) if text else True


def _contractions(codes: np.ndarray, kind: np.ndarray, start: np.ndarray) -> None:
    """Cut 's, 't, 're ... off where an apostrophe begins a word."""
    at = np.flatnonzero(start & (codes == 0x27))
    at = at[kind[at + 1] == LETTER]
    if not len(at):
        return
    one, two = codes[at + 1], codes[np.minimum(at + 2, len(codes) - 1)]
    length = np.zeros(len(at), dtype=np.int64)
    for c in CONTRACTIONS:
        hit = one == ord(c[0])
        if len(c) == 2:
            hit &= two == ord(c[1])
        length[hit] = len(c) + 1
    at, length = at[length > 0], length[length > 0]
    start[at + 1] = False
    start[at + length] = True


def _split(joined: str, keep_space: bool) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every word of texts joined and closed by a zero character."""
    codes = _codes(joined)
    kind = CLASS[np.minimum(codes, _LIMIT)]
    start = np.empty(len(kind), dtype=bool)
    start[0] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    start |= kind == END
    if keep_space:
        # the last white space before a word stands alone, or joins it if a blank
        last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & (kind[1:] != END))
        start[last] = True
        start[last[codes[last] == 0x20] + 1] = False
    else:
        start |= kind == NUMBER
    _contractions(codes, kind, start)
    begin = np.flatnonzero(start)
    end = np.append(begin[1:], len(kind))
    keep = kind[begin] != END
    if not keep_space:
        keep &= kind[begin] != SPACE
    return begin[keep], end[keep]


def split_plain(texts: list[str], keep_space: bool) -> tuple[str, list[int], list[int], np.ndarray]:
    """The joined text, begins and ends of its words, and for each text the
    number of words up to and including it.  The texts must be plain."""
    joined = "\x00".join(texts) + "\x00"
    begin, end = _split(joined, keep_space)
    closes = np.cumsum([len(t) + 1 for t in texts])
    upto = np.searchsorted(begin, closes)
    return joined, begin.tolist(), end.tolist(), upto
