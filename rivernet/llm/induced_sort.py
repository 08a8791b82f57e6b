"""Suffix sorting with common prefixes by external induced sorting.

After Bingmann, Fischer and Osipov, *Inducing Suffix and LCP Arrays in
External Memory* (2013): the suffixes at the left-most S positions are sorted
by naming their substrings and sorting the string of names, recursively; from
them all L suffixes are induced in one scan from the smallest bucket on, and
from those all S suffixes in one scan from the largest.  The scans read from
and write to a queue by first character whose entries are tuples (position,
common prefix with the entry before); entries beyond a bound of memory lie on
disk until their bucket is scanned.  Tuples of one bucket are handled as numpy
arrays.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import IO

import numpy as np

from rivernet.llm.quality_rules import common_prefixes, suffix_array

#: Strings of names up to this length are sorted directly.
DIRECT = 6_000_000
#: Bytes of queue entries held in memory.
MEMORY = 64_000_000
#: Entries scanned, or characters hashed, at a time.
PIECE = 1 << 18
_ENTRY = np.dtype([("at", "<i4"), ("lcp", "<i2")])


@dataclass
class BucketQueue:
    """A priority queue by bucket, first in first out inside a bucket, whose
    entries move to an unnamed file of the task when ``memory`` is used up."""

    memory: int = MEMORY
    held: dict[int, list[np.ndarray]] = field(default_factory=dict)
    spilled: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    used: int = 0
    file: IO[bytes] | None = None

    def push(self, bucket: int, entries: np.ndarray) -> None:
        self.held.setdefault(bucket, []).append(entries)
        self.used += entries.nbytes
        if self.used > self.memory:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()  # has no name; gone with the task
        self.file.seek(0, 2)
        for bucket, parts in self.held.items():
            entries = np.concatenate(parts)
            self.spilled.setdefault(bucket, []).append((self.file.tell(), len(entries)))
            self.file.write(entries.tobytes())
        self.held.clear()
        self.used = 0

    def pop(self, bucket: int) -> np.ndarray:
        """All entries of a bucket so far, in the order in which they came."""
        parts = []
        for where, n in self.spilled.pop(bucket, []):
            assert self.file is not None
            self.file.seek(where)
            parts.append(np.frombuffer(self.file.read(n * _ENTRY.itemsize), dtype=_ENTRY))
        for entries in self.held.pop(bucket, []):
            self.used -= entries.nbytes
            parts.append(entries)
        return np.concatenate(parts) if parts else np.zeros(0, dtype=_ENTRY)


class _Inducer:
    """One scan: entries come in order, each with its common prefix with the
    entry before; the suffixes one to their left go to their buckets with
    theirs: one more than the least common prefix since the last entry that
    went to the same bucket.  With a ``cap`` of 0 common prefixes are left out."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, buckets: int, cap: int, queue: BucketQueue) -> None:
        self.text, self.wanted, self.cap, self.queue = text, wanted, cap, queue
        self.least = np.zeros(buckets, dtype=np.int16)  # no entry yet: no common prefix

    def scan(self, at: np.ndarray, lcp: np.ndarray) -> None:
        for a in range(0, len(at), PIECE):
            self._scan(at[a:a + PIECE], lcp[a:a + PIECE])

    def _scan(self, at: np.ndarray, lcp: np.ndarray) -> None:
        left = at - 1
        ok = (left >= 0) & self.wanted[left]
        here = np.flatnonzero(ok)
        if not self.cap:  # only the order is wanted
            target = self.text[left[here]]
            by = np.argsort(target, kind="stable")
            here, target = here[by], target[by]
            entries = np.zeros(len(here), dtype=_ENTRY)
            entries["at"] = left[here]
            bounds = np.append(np.flatnonzero(np.append(True, target[1:] != target[:-1])), len(here))
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if b > a:
                    self.queue.push(int(target[a]), entries[a:b])
            return
        floors = _RangeMin(lcp)
        everything = floors.least(np.zeros(1, dtype=np.int64), np.array([len(lcp) - 1]))[0]
        touched = np.zeros(0, dtype=np.int64)
        if len(here):
            target = self.text[left[here]]
            by = np.argsort(target, kind="stable")
            here, target = here[by], target[by]
            first = np.append(True, target[1:] != target[:-1])
            begin = np.where(first, 0, np.append(0, here[:-1] + 1))
            least = floors.least(begin, here)
            least = np.where(first, np.minimum(least, self.least[target]), least)
            entries = np.empty(len(here), dtype=_ENTRY)
            entries["at"] = left[here]
            entries["lcp"] = np.minimum(least + 1, self.cap)
            bounds = np.append(np.flatnonzero(first), len(here))
            touched = target[bounds[:-1]]
            for bucket, a, b in zip(touched.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                self.queue.push(bucket, entries[a:b])
            last = here[bounds[1:] - 1]
        np.minimum(self.least, everything, out=self.least)
        if len(touched):
            rest = np.full(len(touched), self.cap, dtype=np.int16)
            more = last + 1 < len(lcp)
            rest[more] = floors.least(last[more] + 1, np.full(int(more.sum()), len(lcp) - 1))
            self.least[touched] = rest


class _RangeMin:
    """Least values of ranges, by a table of powers of two."""

    def __init__(self, values: np.ndarray) -> None:
        self.rows = [values]
        width = 1
        while 2 * width <= len(values):
            above = self.rows[-1]
            self.rows.append(np.minimum(above[:-width], above[width:]))
            width *= 2

    def least(self, begin: np.ndarray, last: np.ndarray) -> np.ndarray:
        out = np.empty(len(begin), dtype=self.rows[0].dtype)
        level = np.frexp((last - begin + 1).astype(np.float64))[1] - 1
        for k in np.unique(level).tolist():
            some = level == k
            row = self.rows[k]
            out[some] = np.minimum(row[begin[some]], row[last[some] - (1 << k) + 1])
        return out


def s_types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one, piece by piece from the end."""
    out = np.empty(len(text), dtype=bool)
    out[-1:] = True
    for b in range(len(text) - 1, 0, -PIECE):
        a = max(0, b - PIECE)
        part = text[a:b + 1]
        change = np.flatnonzero(part[1:] != part[:-1])
        tail = a + (change[-1] + 1 if len(change) else 0)
        out[a:tail] = np.repeat(part[change] < part[change + 1], np.diff(np.append(-1, change)))
        out[tail:b] = out[b]  # equal to the character after the piece
    return out


def _run(text: np.ndarray, at: int, cap: int) -> int:
    """How often the character at ``at`` stands there in a row, at most ``cap`` times."""
    other = np.flatnonzero(text[at:at + cap] != text[at])
    return int(other[0]) if len(other) else min(cap, len(text) - at)


def _meet(text: np.ndarray, a: int, b: int, cap: int) -> int:
    """An L and an S suffix of one character share the shorter of their runs."""
    return min(_run(text, int(a), cap), _run(text, int(b), cap))


def _induce(text: np.ndarray, types: np.ndarray, lms: np.ndarray, lms_lcp: np.ndarray,
            alone: int, cap: int, memory: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Scan from sorted LMS suffixes: for each character, from the largest on,
    its L suffixes and its S suffixes as tuples, the latter from the largest on.
    Characters under ``alone`` occur once and are scanned as one bucket, which is
    not put out.  What was put out is not held any longer."""
    size = int(text.max()) + 1
    queue = BucketQueue(memory)
    ups = _Inducer(text, ~types, size, cap, queue)
    bound = np.searchsorted(text[lms], np.arange(alone, size + 1))  # LMS suffixes are sorted by character first
    large: list[np.ndarray] = []
    ups.scan(lms[:bound[0]], lms_lcp[:bound[0]])
    for c in range(alone, size):
        parts = []
        while len(entries := queue.pop(c)):
            if not parts:
                entries["lcp"][0] = 0  # the entry before begins with another character
            parts.append(entries)
            ups.scan(entries["at"], entries["lcp"])
        large.append(np.concatenate(parts) if parts else np.zeros(0, dtype=_ENTRY))
        a, b = bound[c - alone], bound[c - alone + 1]
        if b > a:
            common = lms_lcp[a:b].copy()
            common[0] = _meet(text, large[-1]["at"][-1], lms[a], cap) if len(large[-1]) else 0
            ups.scan(lms[a:b], common)
    downs = _Inducer(text, types, size, cap, queue)
    for c in range(size - 1, alone - 1, -1):
        parts = []
        while len(entries := queue.pop(c)):
            if not parts:
                entries["lcp"][0] = 0
            parts.append(entries)
            downs.scan(entries["at"], entries["lcp"])
        small = np.concatenate(parts) if parts else np.zeros(0, dtype=_ENTRY)
        entries = large.pop()
        if len(entries):
            # backwards, each entry's common prefix is the one its follower had
            common = np.append(0, entries["lcp"][:0:-1]).astype(np.int16)
            common[0] = _meet(text, entries["at"][-1], small["at"][-1], cap) if len(small) else 0
            downs.scan(entries["at"][::-1], common)
        yield entries, small


def _hashes(text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the substrings [begin, end], both ascending: differences of
    running sums, which are kept only where a substring begins or ends."""
    step = 0xD6E8FEB86659FD93
    back = pow(step, -1, 1 << 64)
    powers, backs = np.full(PIECE, step, dtype=np.uint64), np.full(PIECE, back, dtype=np.uint64)
    powers[0] = backs[0] = 1
    np.cumprod(powers, out=powers)
    np.cumprod(backs, out=backs)
    out, before = np.empty(len(begin), dtype=np.uint64), np.empty(len(begin), dtype=np.uint64)
    scale = np.empty(len(begin), dtype=np.uint64)
    total, ahead, behind = np.uint64(0), 1, 1  # the sum up to a piece, step to its place, and the inverse
    for a in range(0, len(text), PIECE):
        x = (text[a:a + PIECE].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xC2B2AE3D27D4EB4F)
        x *= powers[:len(x)] * np.uint64(ahead)
        sums = np.append(np.zeros(1, np.uint64), np.cumsum(x)) + total
        lo, hi = np.searchsorted(begin, [a, a + len(x)])
        at = begin[lo:hi] - a
        before[lo:hi], scale[lo:hi] = sums[at], backs[at] * np.uint64(behind)
        lo, hi = np.searchsorted(end, [a, a + len(x)])
        out[lo:hi] = sums[end[lo:hi] - a + 1]
        total = sums[-1]
        ahead, behind = ahead * pow(step, PIECE, 1 << 64) % (1 << 64), behind * pow(back, PIECE, 1 << 64) % (1 << 64)
    return (out - before) * scale


def _extended(text: np.ndarray, a: np.ndarray, b: np.ndarray, have: np.ndarray, cap: int) -> np.ndarray:
    """Common prefixes of the suffixes a and b, of which ``have`` is known."""
    out = np.empty(len(a), dtype=np.int16)
    for k in range(0, len(a), PIECE):
        out[k:k + PIECE] = _extended_part(text, a[k:k + PIECE], b[k:k + PIECE], have[k:k + PIECE], cap)
    return out


def _extended_part(text: np.ndarray, a: np.ndarray, b: np.ndarray, have: np.ndarray, cap: int) -> np.ndarray:
    out = np.minimum(have, cap).astype(np.int16)
    open_ = np.flatnonzero(out < cap)
    while len(open_):
        x, y = a[open_] + out[open_], b[open_] + out[open_]
        inside = np.maximum(x, y) < len(text)
        open_ = open_[inside]
        open_ = open_[text[x[inside]] == text[y[inside]]]
        out[open_] += 1
        open_ = open_[out[open_] < cap]
    return out


def _sorted_lms(text: np.ndarray, types: np.ndarray, alone: int, cap: int, memory: int,
                direct: int) -> tuple[np.ndarray, np.ndarray]:
    """LMS positions sorted by suffix, with common prefixes (at most ``cap``)."""
    lms = np.flatnonzero(types[1:] & ~types[:-1]) + 1
    nothing = np.zeros(len(lms), dtype=np.int16)
    rough = lms[np.argsort(text[lms], kind="stable")]
    is_lms = np.zeros(len(text), dtype=bool)
    is_lms[lms] = True
    by_substring = []
    for _, small in _induce(text, types, rough, nothing, alone, 0, memory):
        at = small["at"][::-1]
        by_substring.append(at[is_lms[at]])
    order = np.concatenate([rough[text[rough] < alone], *by_substring[::-1]]).astype(np.int64)
    del by_substring, rough, is_lms, nothing
    # names: equal substrings, up to and with the next LMS position, get equal numbers
    ends = np.append(lms[1:], len(text) - 1)
    place = np.empty(len(text), dtype=np.int32)
    place[lms] = np.arange(len(lms))
    rank = place[order]
    del place
    h, n = _hashes(text, lms, ends), ends - lms
    new = np.append(True, (h[rank[1:]] != h[rank[:-1]]) | (n[rank[1:]] != n[rank[:-1]]))
    del h, n, ends
    have = np.zeros(len(lms), dtype=np.int64)
    if not new.all():
        names = np.empty(len(lms), dtype=np.int64)
        names[rank] = np.cumsum(new) - 1
        if len(names) <= direct:
            rank, ranks = suffix_array(names)
            shared = common_prefixes(rank, ranks)
            del ranks
        else:
            rank, shared = sort_suffixes(names, 1, cap, memory, direct)
            rank, shared = np.append(len(names) - 1, rank), np.append(0, shared)  # the last name is the least
        del names
        order = lms[rank]
        ahead = np.append(lms, len(text))
        have[1:] = ahead[np.minimum(rank[1:] + shared[1:], len(lms))] - lms[rank[1:]]
    lcp = np.zeros(len(lms), dtype=np.int16)
    lcp[1:] = _extended(text, order[:-1], order[1:], have[1:], cap)
    return order, lcp


def sorted_parts(text: np.ndarray, alone: int, cap: int, memory: int = MEMORY,
                 direct: int = DIRECT) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The suffixes of each character from ``alone`` on, sorted, and their common
    prefixes with the one before, at most ``cap`` (0 for the first): one part for
    each character, the largest first."""
    types = s_types(text)
    lms, lms_lcp = _sorted_lms(text, types, alone, cap, memory, direct)
    for large, small in _induce(text, types, lms, lms_lcp, alone, cap, memory):
        a, b = large["at"], small["at"][::-1]
        # common prefixes of S suffixes were kept with the follower
        common = np.append(0, small["lcp"][:0:-1]).astype(np.int16)
        if len(a) and len(b):
            common[0] = _meet(text, a[-1], b[0], cap)
        yield np.concatenate([a, b]), np.concatenate([large["lcp"], common[:len(b)]])


def sort_suffixes(text: np.ndarray, alone: int, cap: int, memory: int = MEMORY,
                  direct: int = DIRECT) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes that begin with a character from ``alone`` on, sorted, and
    their common prefixes with the one before, at most ``cap``.  The last
    character must be 0, and characters under ``alone`` occur once."""
    parts = list(sorted_parts(text, alone, cap, memory, direct))[::-1]
    return (np.concatenate([np.zeros(0, np.int64), *(at for at, _ in parts)]),
            np.concatenate([np.zeros(0, np.int64), *(lcp for _, lcp in parts)]))


def repeated_starts(blocks: list[bytes], length: int, memory: int = MEMORY, direct: int = DIRECT) -> list[np.ndarray]:
    """For each block the positions where a string of ``length`` bytes begins
    that begins at another place of the blocks as well."""
    full = [b for b in blocks if b]
    if len(full) < len(blocks):  # an empty block holds nothing
        found = iter(repeated_starts(full, length, memory, direct))
        return [next(found) if b else np.zeros(0, np.int64) for b in blocks]
    m = len(blocks)
    if not m:
        return []
    sizes = np.array([len(b) for b in blocks], dtype=np.int64)
    ends = np.cumsum(sizes + 1) - 1
    text = np.zeros(int(ends[-1]) + 1, dtype=np.int32)
    for block, end, n in zip(blocks, ends.tolist(), sizes.tolist(), strict=True):
        text[end - n:end] = np.frombuffer(block, dtype=np.uint8)
    text += m
    text[ends] = np.arange(m)[::-1]  # each block ends with a character of its own, the last with the least
    hit = np.zeros(len(text), dtype=bool)
    for at, lcp in sorted_parts(text, m, length, memory, direct):
        twice = np.flatnonzero(lcp >= length)
        hit[at[twice]] = True
        hit[at[twice - 1]] = True
    starts = ends - sizes
    return [np.flatnonzero(hit[a:a + n]) for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
