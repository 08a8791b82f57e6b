"""Periodic runs of words (operator 11).

A run is a longest stretch of words in which words ``period`` apart are equal,
``times`` periods and ``least`` words long or longer, with its smallest period.

Seed and extend on diagonals.  A run with period q matches itself, moved by q,
over at least ``max(least - q, (times - 1) * q)`` words.  For the lags up to
``k`` that are not covered by a shorter gram, ``k`` (a power of two) is at most
that overlap and at least the lag, so the first k-gram of the run occurs again
exactly ``period`` words later, and nowhere in between: a k-gram as long as the
period that came back earlier would make the period shorter.  It is enough to
pair each occurrence of a k-gram with the next one of the same text.  For each
lag a table holds how far its diagonal is covered, and pairs inside are not
extended again.

The k-grams of many texts are named together by doubling; words of different
texts are different symbols.  A gram that occurs once is dropped, and with it
all longer ones at its place, so few places are left after the first rounds.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivernet.llm.common import chunks, ship, texts

RUNS_TYPE = "array<struct<start:bigint,length:bigint,period:bigint>>"


@dataclass(frozen=True)
class RunRule:
    """least: fewest words of a run; times: fewest periods (3 or more, so that
    each gram length serves the lags up to itself)."""

    least: int = 24
    times: int = 3

    def __post_init__(self) -> None:
        if self.times < 3 or self.least < 1:
            raise ValueError("runs need three periods or more and one word or more")

    @property
    def first_gram(self) -> int:
        """Largest power of two that every run's overlap reaches."""
        overlap = min(max(self.least - q, (self.times - 1) * q) for q in range(1, self.least + 1))
        return 1 << (overlap.bit_length() - 1)


def named(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in order of their key (ties in order of place), the names 0, 1,
    ... of equal keys in that order, and which of them share their name."""
    order = np.argsort(key, kind="stable")
    at = key[order]
    new = np.append(True, at[1:] != at[:-1])
    return order, np.cumsum(new) - 1, ~(new & np.append(new[1:], True))


def seeds(symbols: np.ndarray, rule: RunRule) -> Iterator[tuple[np.ndarray, int]]:
    """Places of k-grams and the lag to their next occurrence, one lag at a time."""
    n, k, first = len(symbols), 1, rule.first_gram
    place, key = np.arange(n), symbols.astype(np.int64)
    name = np.empty(n, dtype=np.int64)
    while len(place):
        order, names, shared = named(key)
        order, names = order[shared], names[shared]
        if k >= first and len(order):
            at = place[order]
            lag = at[1:] - at[:-1]
            fits = (names[1:] == names[:-1]) & (lag <= k) & ((lag > k // 2) | (k == first))
            begin, lag = at[:-1][fits], lag[fits]
            by = np.lexsort((begin, lag))
            begin, lag = begin[by], lag[by]
            # neighbours on one diagonal begin one stretch
            head = np.ones(len(lag), dtype=bool)
            head[1:] = (lag[1:] != lag[:-1]) | (begin[1:] != begin[:-1] + 1)
            begin, lag = begin[head], lag[head]
            for own in np.split(np.arange(len(lag)), np.flatnonzero(lag[1:] != lag[:-1]) + 1):
                if len(own):
                    yield begin[own], int(lag[own[0]])
        # the gram twice as long: the name of its first half and of its second
        name[:] = -1
        name[place[order]] = names
        place = np.sort(place[order])
        place = place[place + k < n]
        second = name[place + k]
        place, second = place[second >= 0], second[second >= 0]
        key = name[place] * (len(names) + n + 1) + second
        k *= 2


def matched(symbols: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """First and one past the last place around ``at`` whose symbol comes again
    ``lag`` places later without a break."""
    n, step, end = len(symbols) - lag, 32, at
    while end < n:
        differ = np.flatnonzero(symbols[end:min(end + step, n)] != symbols[end + lag:min(end + step, n) + lag])
        if len(differ):
            end += int(differ[0])
            break
        end, step = min(end + step, n), step * 2
    step, begin = 32, at
    while begin > 0:
        low = max(0, begin - step)
        differ = np.flatnonzero(symbols[low:begin] != symbols[low + lag:begin + lag])
        if len(differ):
            begin = low + int(differ[-1]) + 1
            break
        begin, step = low, step * 2
    return begin, end


def runs_of(symbols: np.ndarray, rule: RunRule) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period.  Texts are
    told apart by their symbols, and a mark of its own closes each."""
    covered: dict[int, int] = {}
    found = []
    for places, lag in seeds(symbols, rule):
        for at in places.tolist():
            if at < covered.get(lag, 0):
                continue
            begin, end = matched(symbols, at, lag)
            covered[lag] = end
            length = end - begin + lag
            if length >= max(rule.least, rule.times * lag):
                found.append((begin, length, lag))
    return sorted(found, key=lambda r: (r[0], r[2]))


def symbols_of(rows: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """One symbol for each word of each text and for the mark that closes it,
    and the place at which each text begins."""
    number: dict[bytes, int] = {}
    codes = [number.setdefault(w, len(number)) for words in rows for w in words]
    sizes = np.array([len(words) for words in rows], dtype=np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    out = np.empty(int(sizes.sum()) + len(rows), dtype=np.int64)
    inside = np.ones(len(out), dtype=bool)
    inside[begins + sizes] = False
    width = len(number) + 1
    out[inside] = np.array(codes, dtype=np.int64) + np.repeat(np.arange(len(rows)), sizes) * width
    out[~inside] = np.arange(len(rows)) * width + width - 1
    return out, begins


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words that no run holds after its first period."""
    drop = np.zeros(len(words), dtype=bool)
    for start, length, period in runs:
        drop[start + period:start + length] = True
    return [words[i] for i in np.flatnonzero(~drop).tolist()]


def find_runs(docs: DataFrame, rule: RunRule = RunRule(), id_col: str = "doc_id",  # noqa: B008
              text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, ``runs`` (by start, then period)
    and ``collapsed``, the words that no run holds after its first period,
    joined by one space.

    Words are ``[^\\x20\\x09-\\x0D]+``; a null or empty text has none, no run
    and an empty ``collapsed``.  Repeated rows and ids give one row each; other
    columns are not read.  Each text is judged where it is read: no shuffle;
    a very long text is one row's work, linear in its words times the
    logarithm of its longest period.
    """
    ship(docs.sparkSession)
    source = texts(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))
        for batch in batches:
            every: list[list[tuple[int, int, int]]] = []
            collapsed: list[bytes] = []
            for _, part in chunks(batch.column("text").cast(pa.binary()).to_pylist()):
                rows = [t.split() for t in part]
                symbols, begins = symbols_of(rows)
                own: list[list[tuple[int, int, int]]] = [[] for _ in rows]
                found = runs_of(symbols, rule)
                text = np.searchsorted(begins, [r[0] for r in found], side="right") - 1
                for t, (start, length, period) in zip(text.tolist(), found, strict=True):
                    own[t].append((start - int(begins[t]), length, period))
                every += own
                collapsed += [b" ".join(kept_words(w, r) if r else w)
                              for w, r in zip(rows, own, strict=True)]
            structs = [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in every]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(structs, kind),
                 pa.array(collapsed, pa.binary()).cast(pa.string())], ["doc_id", "runs", "collapsed"])

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {id_type}, runs {RUNS_TYPE}, collapsed string")


def plant_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text of ``docs``, where a text in ten (by crc32 of its id)
    repeats a stretch of its words to its end.  A null id counts as empty."""
    ship(docs.sparkSession)
    source = texts(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            chosen = {i: h // 10 for i, d in enumerate(ids)
                      if (h := zlib.crc32(b"" if d is None else str(d).encode())) % 10 == 0}
            column = batch.column("text").cast(pa.binary()).to_pylist()
            for i, g in chosen.items():
                words = column[i].split()
                if n := len(words):
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    again = words[a:a + p] * -(-(n - a) // p)
                    column[i] = b" ".join(words[:a] + again[:n - a])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(column, pa.binary()).cast(pa.string())], ["doc_id", "text"])

    return source.mapInArrow(run, source.schema)


def run_digests(found: DataFrame) -> DataFrame:
    """The columns of the registered query from those of :func:`find_runs`:
    the run with most periods (exactly compared; ties: smallest start, then
    period) and digests of all runs and of the collapsed text."""
    best = F.reduce(
        F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))), F.element_at("runs", 1),
        lambda a, b: F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a))
    best = F.when(F.size("runs") > 0, best)
    line = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")
