"""Token ids in compact files (operator 13).

A token file is a folder of three Parquet tables, so Spark commits and reads
them on any file system:

* ``codebook`` (id, bits): code lengths of a canonical Huffman code, no longer
  than ``max_bits``, by package-merge from the counts of all ids;
* ``blocks`` (part, block, first, doc_ids, sizes, payload, every, checkpoints):
  consecutive whole documents of about ``block_ids`` ids; ``payload`` holds
  their codes, highest bit first; ``checkpoints`` the bit at which every
  ``every``-th id begins; ``first`` counts the ids before it in its part;
* ``parts`` (part, base): ids before each part.

Blocks are decoded one by one in any order, and the stretches between
checkpoints side by side: each step looks up the next bits of all stretches in
one table of 2**(longest code) entries.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivernet.llm.common import cut, ship, shuffle_width, texts
from rivernet.llm.word_ids import load

@dataclass(frozen=True)
class Layout:
    """block_ids: ids after which a block ends with its document; every: ids
    from one checkpoint to the next; max_bits: longest code (24 at most)."""

    block_ids: int = 65_536
    every: int = 256
    max_bits: int = 18

    def __post_init__(self) -> None:
        if not 1 <= self.max_bits <= 24 or self.block_ids < 1 or self.every < 1:
            raise ValueError("max_bits is 1 to 24, the others are 1 or more")


# --- ids of texts ---------------------------------------------------------

def id_bytes(vocabulary: str) -> int:
    """Bytes that hold every id of a ``tokenizers`` file: 2 or 4."""
    with open(vocabulary, encoding="utf-8") as f:
        spec = json.load(f)
    top = max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
    return 2 if top < 1 << 16 else 4


def encode_texts(docs: DataFrame, vocabulary: str, end_id: int, width: int = 4, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id and ``ids`` (unsigned, little-endian, ``width`` bytes each) of
    every whole text, closed by ``end_id``.  A null text counts as empty.  No
    shuffle."""
    ship(docs.sparkSession)
    source = texts(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = load(vocabulary)
        for batch in batches:
            ids = [np.append(x, end_id).astype(f"<u{width}").tobytes()
                   for x in words.encode(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, ids binary")


# --- the code -------------------------------------------------------------

def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Bits of each symbol in a prefix code of least total length whose codes
    have ``limit`` bits at most (package-merge).  Counts are positive."""
    n = len(counts)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols do not fit codes of {limit} bits")
    if n <= 1:
        return np.ones(n, dtype=np.int64)
    by = np.argsort(counts, kind="stable")
    leaves = counts[by].astype(np.int64)
    packages = np.empty(0, dtype=np.int64)
    is_leaf = []
    for _ in range(limit):
        items = np.append(leaves, packages)
        order = np.argsort(items, kind="stable")
        is_leaf.append(order < n)
        items = items[order][:len(items) // 2 * 2]
        packages = items[0::2] + items[1::2]
    bits = np.zeros(n, dtype=np.int64)
    take = 2 * n - 2
    for flags in reversed(is_leaf):
        own = int(flags[:take].sum())
        bits[:own] += 1
        take = 2 * (take - own)
    out = np.empty(n, dtype=np.int64)
    out[by] = bits
    return out


class Code:
    """Canonical code of ``ids`` with ``bits`` each: codes of one length are
    consecutive numbers in order of the ids, after all shorter ones."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray) -> None:
        by = np.lexsort((ids, bits))
        self.ids, self.bits = ids[by].astype(np.int64), bits[by].astype(np.int64)
        self.longest = int(self.bits[-1]) if len(ids) else 1
        span = 1 << (self.longest - self.bits)
        self.left = np.cumsum(span) - span  # each code, filled up with zeros to the longest

    def _encoder(self) -> tuple[np.ndarray, np.ndarray]:
        size = int(self.ids.max()) + 1
        code, bits = np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=np.int64)
        code[self.ids] = self.left >> (self.longest - self.bits)
        bits[self.ids] = self.bits
        return code, bits

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Codes one after the other, highest bit first, and where each begins."""
        if not hasattr(self, "by_id"):
            self.by_id = self._encoder()
        code, bits = self.by_id[0][ids], self.by_id[1][ids]
        ends = np.cumsum(bits)
        at = ends - bits
        if not len(ids):
            return b"", at
        word, room = at >> 6, 64 - (at & 63) - bits
        inside = np.where(room >= 0, code << np.maximum(room, 0).astype(np.uint64),
                          code >> np.maximum(-room, 0).astype(np.uint64))
        packed = np.zeros(int(ends[-1] + 63 >> 6) + 1, dtype=np.uint64)
        head = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        packed[word[head]] = np.bitwise_or.reduceat(inside, head)
        over = np.flatnonzero(room < 0)  # the rest of a code, at the front of the next word
        packed[word[over] + 1] |= code[over] << (64 + room[over]).astype(np.uint64)
        return packed.astype(">u8").tobytes()[:int(ends[-1] + 7 >> 3)], at

    def _decoder(self) -> tuple[np.ndarray, np.ndarray]:
        span = 1 << (self.longest - self.bits)
        size = 1 << self.longest
        ids, bits = np.zeros(size, dtype=np.uint32), np.zeros(size, dtype=np.uint8)
        filled = int(span.sum())
        ids[:filled], bits[:filled] = np.repeat(self.ids, span), np.repeat(self.bits, span)
        return ids, bits

    def decode(self, payloads: list[bytes], checkpoints: list[np.ndarray], every: int) -> list[np.ndarray]:
        """Ids of each payload, its last stretch filled up with any id."""
        if not hasattr(self, "by_bits"):
            self.by_bits = self._decoder()
        table, bits = self.by_bits
        joined = np.frombuffer(b"".join(payloads) + bytes(8), dtype=np.uint8).astype(np.uint32)
        window = joined[:-3] << 24 | joined[1:-2] << 16 | joined[2:-1] << 8 | joined[3:]
        begins = np.cumsum([0, *map(len, payloads)])[:-1] * 8
        at = np.concatenate([c + b for c, b in zip(checkpoints, begins.tolist(), strict=True)])
        out = np.empty((every, len(at)), dtype=np.uint32)
        last, drop = len(window) - 1, np.uint32(32 - self.longest)
        for step in out:
            ahead = window[np.minimum(at >> 3, last)] << (at & 7).astype(np.uint32) >> drop
            step[:] = table[ahead]
            at += bits[ahead]
        rows = np.cumsum([len(c) for c in checkpoints])[:-1]
        return [x.reshape(-1) for x in np.split(np.ascontiguousarray(out.T), rows)]


# --- files ----------------------------------------------------------------

def id_counts(frame: DataFrame, width: int = 4) -> DataFrame:
    """(id, n) over all rows of ``frame(ids)``; a task counts what it reads first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for batch in batches:
            own = np.frombuffer(b"".join(batch.column("ids").to_pylist()), dtype=f"<u{width}")
            if width == 2:
                n = np.bincount(own, minlength=1 << 16)
                ids = np.flatnonzero(n)
                n = n[ids]
            else:
                ids, n = np.unique(own, return_counts=True)
            for i, c in zip(ids.tolist(), n.tolist(), strict=True):
                total[i] = total.get(i, 0) + c
        yield pa.RecordBatch.from_arrays([pa.array(total, pa.int64()), pa.array(total.values(), pa.int64())], ["id", "n"])

    return frame.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def block_schema(kind: str) -> str:
    return (f"part int, block bigint, first bigint, doc_ids array<{kind}>, sizes array<bigint>, "
            "payload binary, every int, checkpoints array<bigint>")


def write_token_file(frame: DataFrame, path: str, layout: Layout = Layout(), width: int = 4) -> None:  # noqa: B008
    """Write ``frame(doc_id, ids)`` (unsigned, little-endian, ``width`` bytes each) to a
    new folder, in ascending order of doc_id (nulls first; equal ids in order
    of their content).

    ``frame`` is read several times: pass a stored table.  Range partitions
    deal rows out by id, content and place, so a hot id is spread as well.  A
    task holds one block: ``block_ids`` ids and the last document.  The driver
    gets the count of each distinct id, at most 2**max_bits, and a row for each
    write task.
    """
    spark = frame.sparkSession
    ship(spark)
    kind = frame.schema["doc_id"].dataType.simpleString()
    counted = id_counts(frame, width).limit((1 << layout.max_bits) + 1).toPandas().sort_values("id")
    ids, n = counted["id"].to_numpy(np.int64), counted["n"].to_numpy(np.int64)
    bits = code_lengths(n, layout.max_bits)
    spark.createDataFrame(list(zip(ids.tolist(), bits.tolist(), strict=True)), "id bigint, bits int") \
        .coalesce(1).write.parquet(f"{path}/codebook")
    dealt = (frame.withColumns({"_content": F.xxhash64("ids"), "_place": F.monotonically_increasing_id()})
             .repartitionByRange(shuffle_width(spark), "doc_id", "_content", "_place")
             .sortWithinPartitions("doc_id", "_content", "ids").select("doc_id", "ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, part = Code(ids, bits), TaskContext.get().partitionId()
        names: list[Any] = []
        held: list[bytes] = []
        first, block, size = 0, 0, 0

        def closed() -> pa.RecordBatch:
            sizes = [len(x) // width for x in held]
            own = np.frombuffer(b"".join(held), dtype=f"<u{width}")
            payload, at = code.encode(own)
            row = [part, block, first, names, sizes, payload, layout.every, at[::layout.every]]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.list_(doc_kind), pa.list_(pa.int64()), pa.binary(),
                     pa.int32(), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays(
                [pa.array([x], k) for x, k in zip(row, kinds, strict=True)],
                ["part", "block", "first", "doc_ids", "sizes", "payload", "every", "checkpoints"])

        for batch in batches:
            doc_kind = batch.schema.field("doc_id").type
            for doc_id, packed in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                names.append(doc_id)
                held.append(packed.as_py())
                size += len(held[-1]) // width
                if size >= layout.block_ids or len(held) >= layout.block_ids:
                    yield closed()
                    first, block, size, names, held = first + size, block + 1, 0, [], []
        if held:
            yield closed()

    dealt.mapInArrow(run, block_schema(kind)).write.parquet(f"{path}/blocks")
    done = (spark.read.schema(block_schema(kind)).parquet(f"{path}/blocks")
            .select("part", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
            .groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect())
    base, rows = 0, []
    for r in done:
        rows.append((r["part"], base))
        base += r["n"]
    spark.createDataFrame(rows, "part int, base bigint").coalesce(1).write.parquet(f"{path}/parts")


def read_token_file(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """One row per document of a token file: doc_id, ``start`` (ids of all
    documents before it), ``ids`` (unsigned 32-bit, little-endian).  Blocks are
    decoded where they are read."""
    ship(spark)
    book = spark.read.schema("id bigint, bits int").parquet(f"{path}/codebook").toPandas()
    ids, bits = book["id"].to_numpy(np.int64), book["bits"].to_numpy(np.int64)
    parts = spark.read.schema("part int, base bigint").parquet(f"{path}/parts")
    blocks = spark.read.schema(block_schema(id_type)).parquet(f"{path}/blocks")
    # a row for each write task
    blocks = (blocks.join(F.broadcast(parts), "part")
              .select((F.col("base") + F.col("first")).alias("first"), "doc_ids", "sizes", "payload", "every", "checkpoints"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(ids, bits)
        for batch in batches:
            for k in range(0, batch.num_rows, 16):  # blocks decoded side by side
                some = batch.slice(k, 16)
                marks = [np.asarray(c.values, dtype=np.int64) for c in some.column("checkpoints")]
                decoded = code.decode(some.column("payload").to_pylist(), marks, some.column("every")[0].as_py())
                for first, names, sizes, got in zip(some.column("first").to_pylist(), some.column("doc_ids"),
                                                    some.column("sizes"), decoded, strict=True):
                    ends = np.cumsum(np.asarray(sizes.values, dtype=np.int64))
                    packed = got[:ends[-1]].astype("<u4").tobytes()
                    offsets = np.append(0, ends) * 4
                    # ids of a document lie one after the other: no copy for each
                    yield pa.RecordBatch.from_arrays(
                        [names.values, pa.array(first + ends - np.asarray(sizes.values), pa.int64()),
                         pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [
                             None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(packed)]).cast(pa.binary())],
                        ["doc_id", "start", "ids"])

    return blocks.mapInArrow(run, f"doc_id {id_type}, start bigint, ids binary")


def store_tokens(docs: DataFrame, vocabulary: str, path: str, end_id: int = 0, layout: Layout = Layout(),  # noqa: B008
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text, write a token file to ``path`` (a new folder)
    and return what :func:`read_token_file` reads from it.

    One row per row of ``docs``; a null or empty text is ``end_id`` alone;
    repeated rows and ids give one row each; an empty table gives a file
    without blocks; other columns are not read.
    """
    width = id_bytes(vocabulary)
    encoded = cut(encode_texts(docs, vocabulary, end_id, width, id_col, text_col), "ids")
    write_token_file(encoded, path, layout, width)
    return read_token_file(docs.sparkSession, path, encoded.schema["doc_id"].dataType.simpleString())


def token_digests(stored: DataFrame) -> DataFrame:
    """The columns of the registered query from those of :func:`read_token_file`."""
    return stored.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                         F.crc32("ids").alias("ids_crc32"))
