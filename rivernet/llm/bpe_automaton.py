"""BPE encoding and decoding by a tokenization automaton (operator 2).

The merges of a tokenizer are compiled, in rank order, into a deterministic
automaton over tokens that accepts exactly the token sequences the merges
produce (Berglund, Martens, van der Merwe: *Constructing a BPE tokenization
DFA*, 2024).  The gadget of a merge (u, v) -> uv, with q the state that all
u-arcs enter: q is copied to q' without its v-arc, the u-arcs are led to q',
and every state with a u-arc gets a uv-arc to the state that v leads to.

All arcs of one token enter one state, so a state is stored as the token and
the rank of the merge that made the copy, and an arc is read from integer
tables: an arc younger than the state exists where its left part does, an
older one where the state copied from has it, unless a gadget removed it.

Each string has one accepted sequence, so each prefix of a word is reached on
one path at most; encoding walks the word from left to right, longest arc
first, and steps back at dead ends.  Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import hashlib
import json
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame

from rivernet.llm.common import chunks, kept, lean, ship, texts
from rivernet.llm.presplit import BYTE_RE, is_plain, split_plain

#: Words whose encoding a worker keeps; beyond it the store is emptied.
KEPT_WORDS = 500_000
#: Arcs that it keeps, likewise.
KEPT_ARCS = 500_000


def byte_characters() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each
    byte, built by their public rule: printable Latin-1 stands for itself, the
    other bytes follow from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Automaton:
    """Token automaton of a merge list over any alphabet of one-character symbols."""

    def __init__(self, alphabet: list[str], merges: list[tuple[str, str]]) -> None:
        self.index = {a: i for i, a in enumerate(alphabet)}
        self.born = [0] * len(alphabet)       # rank of the merge that made a token
        self.left = list(range(len(alphabet)))
        self.enters = [0] * len(alphabet)     # state that the arcs of a token enter
        # a state: the token whose gadget made it, and the rank of that merge
        self.of, self.since = [-1], [0]
        self.origin = [0] * len(alphabet)     # state that a token's first copy is made from
        self.ranks: list[list[int]] = [[] for _ in alphabet]   # of the copies for a token
        self.copies: list[list[int]] = [[] for _ in alphabet]
        self.lost: list[dict[int, int]] = [{} for _ in alphabet]  # arc: rank that removed it
        for rank, (u, v) in enumerate(merges, 1):
            self._gadget(rank, u, v)
        self.labels = list(self.index)
        #: Each beginning of a token, with the token if it is one itself.
        self.heads = {t[:n]: -1 for t in self.labels for n in range(1, len(t))} | self.index
        self.known: dict[tuple[int, int], bool] = {}  # arcs already looked up

    def _gadget(self, rank: int, left: str, right: str) -> None:
        u, v = self.index.get(left), self.index.get(right)
        if u is None or v is None:
            return  # a part that no merge makes
        state, after = self.enters[u], self.enters[v]
        if left + right in self.index or not self.arc(state, v):
            return  # no path u, v is left: the merge never applies
        self.of.append(u)
        self.since.append(rank)
        self.enters[u] = len(self.of) - 1
        self.ranks[u].append(rank)
        self.copies[u].append(self.enters[u])
        self.lost[u][v] = rank
        self.index[left + right] = len(self.born)
        self.born.append(rank)
        self.left.append(u)
        self.enters.append(after)
        self.origin.append(after)
        self.ranks.append([])
        self.copies.append([])
        self.lost.append({})

    def arc(self, state: int, token: int) -> bool:
        """Whether ``state`` has an arc labelled ``token``."""
        born = self.born[token]
        while state:
            if born >= self.since[state]:
                token = self.left[token]
                born = self.born[token]
                continue
            u = self.of[state]
            if self.lost[u].get(token, born) > born and self.lost[u][token] <= self.since[state]:
                return False
            # the last copy for u that is not younger than the token, or what u's copies began from
            k = bisect_right(self.ranks[u], born)
            state = self.copies[u][k - 1] if k else self.origin[u]
        return True

    def encode(self, word: str) -> list[int]:
        """Labels (as indexes) of the accepting path of ``word``."""
        heads, enters, known = self.heads, self.enters, self.known
        path: list[int] = []
        untried: list[list[int]] = []  # for each label of the path, the shorter ones
        at, state, n = 0, 0, len(word)
        choice: list[int] | None = None
        while at < n or choice is not None:
            if choice is None:
                choice, end = [], at + 1
                while end <= n:
                    token = heads.get(word[at:end])
                    if token is None:
                        break
                    if token >= 0:
                        choice.append(token)
                    end += 1
            while choice:
                token = choice.pop()
                has = known.get((state, token))
                if has is None:
                    if len(known) >= KEPT_ARCS:
                        known.clear()
                    has = known[state, token] = self.arc(state, token)
                if has:
                    path.append(token)
                    untried.append(choice)
                    at, state, choice = at + len(self.labels[token]), enters[token], None
                    break
            else:
                if not path:
                    raise ValueError("a symbol outside the alphabet")
                at -= len(self.labels[path.pop()])
                state, choice = (enters[path[-1]] if path else 0), untried.pop()
        return path


class ByteBpe:
    """Encoder and decoder of a byte-level ``tokenizers`` file."""

    def __init__(self, path: str) -> None:
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        byte_of = byte_characters()
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        plain = {c: chr(b) for c, b in byte_of.items()}
        latin = lambda token: "".join(map(plain.__getitem__, token))
        self.automaton = Automaton([chr(b) for b in range(256)],
                                   [(latin(u), latin(v)) for u, v in merges])
        ids = model["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = [-1] * len(self.automaton.labels)
        for token, i in ids.items():
            if token not in special and latin(token) in self.automaton.index:
                self.ids[self.automaton.index[latin(token)]] = i
        self.special = special
        self.label = {i: self.automaton.labels[k].encode("latin-1") for k, i in enumerate(self.ids)}
        self.label |= {i: s.encode() for s, i in special.items()}
        self.words: dict[str, tuple[bytes, bytes]] = {}

    def word(self, word: str) -> tuple[bytes, bytes]:
        """Decimal ids joined by commas, and the bytes that they decode to."""
        got = self.words.get(word)
        if got is None:
            if len(self.words) >= KEPT_WORDS:
                self.words.clear()
            symbols = word.encode("utf-8").decode("latin-1")
            ids = [self.ids[k] for k in self.automaton.encode(symbols)]
            got = ",".join(map(str, ids)).encode(), self.decode(ids)
            self.words[word] = got
        return got

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.label.__getitem__, ids))

    def _pieces(self, text: str) -> Iterator[tuple[bytes, bytes]]:
        """Words of any text; strings of special tokens are tokens of their own."""
        if not self.special:
            yield from map(self.word, BYTE_RE.findall(text))
            return
        first = min(((at, -len(s), s) for s in self.special if (at := text.find(s)) >= 0), default=None)
        while first:
            at, _, s = first
            yield from map(self.word, BYTE_RE.findall(text[:at]))
            yield str(self.special[s]).encode(), s.encode()
            text = text[at + len(s):]
            first = min(((at, -len(s), s) for s in self.special if (at := text.find(s)) >= 0), default=None)
        yield from map(self.word, BYTE_RE.findall(text))

    def encode_rows(self, rows: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """For each text the ids joined by commas and the decoded bytes."""
        for _, part in chunks(rows):
            easy = [t for t in part if self._easy(t)]
            done = iter(self._easy_rows(easy))
            for t in part:
                if self._easy(t):
                    yield next(done)
                else:
                    got = list(self._pieces(t))
                    yield b",".join([g[0] for g in got]), b"".join([g[1] for g in got])

    def _easy(self, text: str) -> bool:
        return is_plain(text) and not any(s in text for s in self.special)

    def _easy_rows(self, rows: list[str]) -> Iterator[tuple[bytes, bytes]]:
        if not rows:
            return
        joined, begin, end, upto = split_plain(rows, keep_space=True)
        at, word, words = 0, self.word, self.words
        for to in upto.tolist():
            got = [words.get(w := joined[b:e]) or word(w)
                   for b, e in zip(begin[at:to], end[at:to], strict=True)]
            yield b",".join([g[0] for g in got]), b"".join([g[1] for g in got])
            at = to


@kept
@lru_cache(maxsize=2)
def load(path: str) -> ByteBpe:
    """One automaton for each worker process and file, until tasks of another kind run there."""
    return ByteBpe(path)


def bpe_round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                   with_ids: bool = False) -> DataFrame:
    """Encode and decode every whole text; one row per row of ``docs``.

    Columns: doc_id (as it is), n_tokens, ids_sha256, decoded_sha256, and with
    ``with_ids`` also ``ids`` (array<int>) and ``decoded``.  A null or empty
    text has no token; its digests are those of the empty string.  Repeated
    rows and ids give one row each; other columns of ``docs`` are not read.  No shuffle: each row is encoded where it is read, so a very
    long text is one row's work and nothing is gathered.
    """
    ship(docs.sparkSession)
    source = texts(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", ids array<int>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        for batch in batches:
            out: list[list[Any]] = [[], [], [], [], []]
            for ids, decoded in bpe.encode_rows(batch.column("text").to_pylist()):
                out[0].append(ids.count(b",") + 1 if ids else 0)
                out[1].append(hashlib.sha256(ids).hexdigest())
                try:
                    text = decoded.decode() if with_ids else None
                    if not with_ids and not decoded.isascii():
                        decoded.decode()
                except UnicodeDecodeError:
                    text = decoded.decode(errors="replace")
                    decoded = text.encode()
                out[2].append(hashlib.sha256(decoded).hexdigest())
                if with_ids:
                    out[3].append([int(i) for i in ids.split(b",")] if ids else [])
                    out[4].append(text)
            columns = [batch.column("doc_id"), pa.array(out[0], pa.int64()),
                       pa.array(out[1], pa.string()), pa.array(out[2], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns += [pa.array(out[3], pa.list_(pa.int32())), pa.array(out[4], pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return source.mapInArrow(lean(run, load), schema)
