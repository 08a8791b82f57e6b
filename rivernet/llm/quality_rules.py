"""Quality rules on repeated text (operator 7).

The words of each text are sorted by suffix; intervals of the longest-common-
prefix table give its maximal repeated word strings; the spans of all their
occurrences are united, and a text is kept if the covered share and the
longest repeat stay under their limits.

The suffixes of many texts are sorted together by prefix doubling, each text
closed by a mark of its own, so that no repeat crosses texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rivernet.llm.common import chunks, ship, texts

#: Fixed value: the characters counted as symbols.
SYMBOLS = "[#*$%&|<>]"
_SYMBOL_BYTES = SYMBOLS[1:-1].encode()


@dataclass(frozen=True)
class Limits:
    """least_words: shortest repeat that counts; covered: largest share of a
    text's words inside repeats; longest: most words of one repeat."""

    least_words: int = 10
    covered: float = 0.4
    longest: int = 200


def suffix_array(codes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sorted suffixes, and for k = 0, 1, ... ranks that are equal where the
    first 2**k codes are.  The last code must occur once."""
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    place = np.arange(n)
    new = np.append(True, codes[order[1:]] != codes[order[:-1]])
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, place, 0))
    ranks, width = [rank.astype(np.int32)], 1
    tied = place[~(new & np.append(new[1:], True))]
    while len(tied):  # only suffixes that still tie are sorted again
        rows = order[tied]
        key = rank[rows] * (n + 1) + np.where(rows + width < n, rank[np.minimum(rows + width, n - 1)] + 1, 0)
        by = np.argsort(key, kind="stable")
        rows, key = rows[by], key[by]
        order[tied] = rows
        new = np.append(True, key[1:] != key[:-1])
        rank[rows] = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
        tied = tied[~(new & np.append(new[1:], True))]
        width *= 2
        ranks.append(rank.astype(np.int32))
    return order, ranks


def common_prefixes(order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """Words that each sorted suffix shares with the one before it."""
    n = len(order)
    out = np.zeros(n, dtype=np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    for k in range(len(ranks) - 1, -1, -1):
        same = ranks[k][np.minimum(a, n - 1)] == ranks[k][np.minimum(b, n - 1)]
        same &= (a < n) & (b < n)
        step = same.astype(np.int64) << k
        a += step
        b += step
    out[1:] = b - order[1:]
    return out


def covered(start: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """Marks of the positions inside the union of the spans."""
    edge = np.bincount(start, minlength=n + 1) - np.bincount(start + length, minlength=n + 1)
    return np.cumsum(edge[:n]) > 0


def repeats(words: list[list[bytes]], limits: Limits) -> list[tuple[int, int, int]]:
    """For each text: words in repeated 3-word windows, words covered by
    repeats of ``least_words`` or more, words of the longest repeat."""
    number: dict[bytes, int] = {}
    codes: list[int] = []
    for k, text in enumerate(words):
        codes += [number.setdefault(w, len(number)) for w in text]
        codes.append(-1 - k)  # a mark of its own
    order, ranks = suffix_array(np.array(codes, dtype=np.int64))
    # a word of one text is another word in the next: the interval of a
    # repeat is searched among the suffixes of one text
    n = len(codes)
    text_of = np.repeat(np.arange(len(words)), [len(w) + 1 for w in words])
    side = np.argsort(text_of[order], kind="stable")
    order = order[side]
    shared = common_prefixes(order, ranks)
    shared[1:][text_of[order[1:]] != text_of[order[:-1]]] = 0
    longest = np.zeros(n, dtype=np.int64)
    longest[order] = np.maximum(shared, np.append(shared[1:], 0))
    # a repeat that also extends to the left lies inside the one that begins before it
    maximal = np.append(True, longest[:-1] <= longest[1:])
    begin = np.flatnonzero(maximal & (longest >= limits.least_words))
    long_cover = covered(begin, longest[begin], n)
    window = np.flatnonzero(longest >= 3)
    window_cover = covered(window, np.full(len(window), 3), n)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = ends - np.array([len(w) + 1 for w in words])
    return [(int(window_cover[a:e].sum()), int(long_cover[a:e].sum()), int(longest[a:e].max()))
            for a, e in zip(starts.tolist(), ends.tolist(), strict=True)]


def line_repeats(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def quality_rules(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id",  # noqa: B008
                  text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept, covered_words, longest_repeat.

    A null or empty text has no word and fails the base rules.  Repeated rows
    and ids give one row each; other columns are not read.  Each text is
    judged by itself where it is read: no shuffle, and a very long text is
    one row's work.
    """
    ship(docs.sparkSession)
    source = texts(docs, id_col, text_col)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[int | bool]] = [[] for _ in range(9)]
            for _, part in chunks(batch.column("text").to_pylist()):
                raw = [t.encode("utf-8", "surrogatepass") for t in part]
                words = [t.split() for t in raw]
                for text, plain, own, (three, inside, longest) in zip(
                        raw, part, words, repeats(words, limits), strict=True):
                    n = len(own)
                    failed = n < 50 or 100 * three > 50 * n
                    fine = not failed and inside <= limits.covered * n and longest <= limits.longest
                    blanks = sum(map(text.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
                    row = (n, len(plain) - blanks, len(text) - len(text.translate(None, _SYMBOL_BYTES)),
                           line_repeats(text), three, failed, fine, inside, longest)
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))],
                ["doc_id", *names, "base_failed", "kept", "covered_words", "longest_repeat"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{x} bigint" for x in names)
                             + ", base_failed boolean, kept boolean, covered_words bigint, longest_repeat bigint")
