"""Exact substring deduplication over all texts (operator 5).

Every byte inside a string of 200 bytes that also begins elsewhere is removed.

1. Each window of 200 bytes is led by the least hash of its 32-byte strings;
   neighbouring windows with one leader form a block.  Equal windows have one
   leader, so a block whose leader stands in no other block, and once in its
   own, holds no repeat.  Blocks that are alike are one block with a count.
2. One copy of each other block goes to the shard of its leader.  A shard's
   blocks are sorted by suffix with :mod:`induced_sort` (external induced
   sorting with common prefixes); suffixes that share 200 bytes with a
   neighbour are repeats, and all windows of a block that occurs twice are.
   A leader whose blocks would fill more than a shard is not brought to one:
   its windows are dealt by a hash of all their 200 bytes and counted, since
   equal windows have one hash.
3. The repeats go back to all occurrences of their block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivernet.llm.common import cut, lean, ship, shuffle_width
from rivernet.llm.induced_sort import repeated_starts

#: Bytes of the strings whose hashes lead windows.
SEED = 32
#: Bytes of blocks in a shard, in the mean.
SHARD = 8_000_000
#: Bytes that are hashed at once; a longer text is read in overlapping pieces.
PIECE = 1 << 20
_PLACE = np.uint64(20)
_rnd = np.random.default_rng(91)
_BYTE = _rnd.integers(1, 2**63, 256, dtype=np.uint64)
_STEP = 0xA0761D6478BD642F
_BACK = pow(_STEP, -1, 1 << 64)
_BLOCK = np.dtype([("lead", "<u8"), ("block", "<i8"), ("row", "<i8"), ("start", "<i8"), ("windows", "<i4"),
                   ("again", "u1")])
_REPEATS = "block bigint, first array<bigint>, n array<bigint>"


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _least_of(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each ``width`` neighbours (van Herk)."""
    n = len(values) - width + 1
    whole = -(-len(values) // width) * width
    padded = np.full(whole, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:len(values)] = values
    table = padded.reshape(-1, width)
    down = np.minimum.accumulate(table, axis=1).ravel()
    up = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(up[:n], down[width - 1:width - 1 + n])


def piece_blocks(raw: bytes, ends: np.ndarray, length: int, seed: int) -> np.ndarray:
    """Blocks of pieces of texts that lie one behind another in ``raw``;
    ``row`` holds the number of the piece, ``start`` is relative to it."""
    if len(raw) < length:
        return np.zeros(0, dtype=_BLOCK)
    b = np.frombuffer(raw, dtype=np.uint8)
    sums = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[b] * _powers(_STEP, len(b)), out=sums[1:])
    back = _powers(_BACK, len(b) + 1)

    def hashed(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (sums[end] - sums[begin]) * back[begin]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xE7037ED1A0B428DB)
        return h ^ (h >> np.uint64(32))

    at = np.arange(len(b) - seed + 1)
    h = hashed(at, at + seed)
    # the least hash, and of equal ones the first place, in one number
    least = _least_of((h >> _PLACE << _PLACE) | at.astype(np.uint64), length - seed + 1)
    lead, place = least >> _PLACE, (least & np.uint64((1 << 20) - 1)).astype(np.int64)
    piece = np.searchsorted(ends, np.arange(len(least)), side="right")
    inside = np.arange(len(least)) + length <= ends[piece]
    new = np.append(True, (lead[1:] != lead[:-1]) | (piece[1:] != piece[:-1]) | ~inside[:-1])
    first = np.flatnonzero(new & inside)
    if not len(first):
        return np.zeros(0, dtype=_BLOCK)
    run = np.cumsum(new)
    count = np.bincount(run[inside])
    out = np.empty(len(first), dtype=_BLOCK)
    out["windows"] = count[run[first]]
    last = first + out["windows"] - 1
    out["lead"], out["row"] = h[place[first]], piece[first]
    # a block that holds its leader twice may hold one window twice
    out["again"] = place[first] != place[last]
    out["block"] = hashed(first, last + length).view(np.int64) ^ out["windows"]
    begins = np.append(0, ends[:-1])
    out["start"] = first - begins[piece[first]]
    return out


def window_hashes(raw: bytes, length: int) -> np.ndarray:
    """A hash of each window of ``length`` bytes; it depends on nothing else."""
    b = np.frombuffer(raw, dtype=np.uint8)
    n = len(b) - length + 1
    out = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        sums = np.append(np.uint64(0), np.cumsum(_BYTE[b] * _powers(_STEP, len(b)), dtype=np.uint64))
        out = (sums[length:] - sums[:n]) * _powers(_BACK, n)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xE7037ED1A0B428DB)
    return out ^ (out >> np.uint64(32))


def crowded_leads(asked: DataFrame, length: int, most: int) -> DataFrame:
    """Leaders whose distinct blocks have more than ``most`` bytes: column crowd."""
    size = F.sum(F.col("windows") + (length - 1))
    return cut(asked.groupBy(F.col("lead").alias("crowd")).agg(size.alias("size")).where(F.col("size") > most)
               .select("crowd"), "crowded")


def counted_repeats(source: DataFrame, asked: DataFrame, length: int) -> DataFrame:
    """Repeats of the blocks of crowded leaders by counts of their windows."""
    by_row = (asked.withColumnRenamed("row", "wanted").groupBy("wanted")
              .agg(F.collect_list(F.struct("block", "start", "windows")).alias("wants")))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, wants in zip(batch.column("text").to_pylist(), batch.column("wants").to_pylist(), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                for w in wants:
                    h = window_hashes(raw[w["start"]:w["start"] + w["windows"] + length - 1], length)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h.view(np.int64)), pa.array(np.full(len(h), w["block"], np.int64)),
                         pa.array(np.arange(len(h)))], ["window", "block", "at"])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, n = [], []
            for places in batch.column("places").to_pylist():
                at = np.array(places, dtype=np.int64)
                heads = np.flatnonzero(np.append(True, np.diff(at) > 1))
                first.append(at[heads])
                n.append(np.diff(np.append(heads, len(at))))
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(first, pa.list_(pa.int64())),
                                              pa.array(n, pa.list_(pa.int64()))], ["block", "first", "n"])

    # written first, so that the join below can split a window that very many blocks have
    windows = cut(source.select("row", "text").join(by_row, F.col("row") == F.col("wanted"), "inner")
                  .select("text", "wants").mapInArrow(lean(fetch), "window bigint, block bigint, at bigint"), "crowd-windows")
    twice = (windows.groupBy(F.col("window").alias("met")).agg(F.count("*").alias("c")).where("c > 1").select("met"))
    found = (windows.join(twice, F.col("window") == F.col("met"), "inner").groupBy("block")
             .agg(F.array_sort(F.collect_set("at")).alias("places")).mapInArrow(lean(runs), _REPEATS))
    whole = asked.where("times > 1").select("block", F.array(F.lit(0).cast("long")).alias("first"),
                                            F.array(F.col("windows").cast("long")).alias("n"))
    return found.unionByName(whole)


def text_blocks(rows: list[int], raws: list[bytes], length: int, seed: int) -> Iterator[np.ndarray]:
    """Blocks of texts with their row numbers and starts within the text."""
    parts: list[bytes] = []
    of: list[tuple[int, int]] = []
    size = 0

    def done() -> np.ndarray:
        found = piece_blocks(b"".join(parts), np.cumsum([len(p) for p in parts]), length, seed)
        where = np.array(of, dtype=np.int64).reshape(-1, 2)
        number = found["row"].copy()
        found["row"] = where[number, 0]
        found["start"] += where[number, 1]
        return found

    for row, raw in zip(rows, raws, strict=True):
        if len(raw) < length:
            continue
        step = PIECE - length + 1
        for begin in range(0, max(1, len(raw) - length + 1), step):
            piece = raw[begin:begin + PIECE]
            if size + len(piece) > PIECE:
                yield done()
                parts.clear()
                of.clear()
                size = 0
            parts.append(piece)
            of.append((row, begin))
            size += len(piece)
    if parts:
        yield done()


def shared_blocks(source: DataFrame, length: int, seed: int) -> DataFrame:
    """Occurrences (lead, block, row, start, windows) of the blocks that may
    hold repeats.  A leader that very many blocks share comes to its task once
    from each batch of rows, not once from each row."""
    width = shuffle_width(source.sparkSession)
    shards = 16 * width

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = [t.encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
            found = list(text_blocks(batch.column("row").to_pylist(), raws, length, seed))
            if not found:
                continue
            blocks = np.concatenate(found)
            blocks = blocks[np.argsort(blocks["lead"], kind="stable")]
            same = blocks["lead"][1:] == blocks["lead"][:-1]
            known = np.append(False, same) | np.append(same, False) | (blocks["again"] > 0)
            head = np.append(True, ~same)
            # of leaders met twice here one entry asks the other batches; all occurrences are sure
            blocks["again"] = known
            asking = blocks[head]
            shard = (asking["lead"] % np.uint64(shards)).astype(np.int64)
            asking = asking[np.argsort(shard, kind="stable")]
            bounds = np.concatenate([[0], np.cumsum(np.bincount(shard, minlength=shards))]).tolist()
            out = [(k, asking[a:b].tobytes()) for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if b > a]
            sure = blocks[known & ~head]
            if len(sure):
                out.append((int(sure["row"][0]) % shards, sure.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()),
                                              pa.array([x[1] for x in out], pa.binary()),
                                              pa.array([k < len(out) - bool(len(sure)) for k in range(len(out))])],
                                             ["shard", "blocks", "asking"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asking = [np.zeros(0, dtype=_BLOCK)]
        for batch in batches:
            for raw, asks in zip(batch.column("blocks"), batch.column("asking").to_pylist(), strict=True):
                rows = np.frombuffer(raw.as_buffer(), dtype=_BLOCK)
                if asks:
                    asking.append(rows)
                else:
                    yield _occurrences(rows)
        rows = np.concatenate(asking)
        rows = rows[np.argsort(rows["lead"], kind="stable")]
        same = rows["lead"][1:] == rows["lead"][:-1]
        keep = np.append(False, same) | np.append(same, False) | (rows["again"] > 0)
        yield _occurrences(rows[keep])

    return cut(source.select("row", "text").mapInArrow(lean(emit), "shard int, blocks binary, asking boolean")
               .repartition(width, "shard").mapInArrow(
                   lean(meet), "lead bigint, block bigint, row bigint, start bigint, windows int"), "blocks")


def _occurrences(rows: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.ascontiguousarray(rows["lead"]).view(np.int64), pa.int64()),
         *(pa.array(np.ascontiguousarray(rows[k])) for k in ("block", "row", "start", "windows"))],
        ["lead", "block", "row", "start", "windows"])


def block_repeats(source: DataFrame, occurrences: DataFrame, length: int) -> DataFrame:
    """For each block the runs of windows that are repeated: block, first, n (arrays)."""
    spark = source.sparkSession
    one = (occurrences.groupBy("block")
           .agg(F.min(F.struct("row", "start", "windows", "lead")).alias("at"), F.count("*").alias("times")))
    asked = cut(one.select("block", "at.*", "times"), "asked")
    crowded = crowded_leads(asked, length, SHARD)
    crowd = None
    if crowded.limit(1).count():
        marked = asked.join(crowded, F.col("lead") == F.col("crowd"), "left")
        crowd = counted_repeats(source, marked.where(F.col("crowd").isNotNull()).drop("crowd"), length)
        asked = marked.where(F.col("crowd").isNull()).drop("crowd")
    size = asked.agg(F.sum(F.col("windows") + length)).first()[0] or 0
    by_row = (asked.withColumnRenamed("row", "wanted").groupBy("wanted")
              .agg(F.collect_list(F.struct("block", "lead", "start", "windows", "times")).alias("wants")))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int, bytes]] = []
            for text, wants in zip(batch.column("text").to_pylist(), batch.column("wants").to_pylist(), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                out += [(w["lead"], w["block"], w["times"], raw[w["start"]:w["start"] + w["windows"] + length - 1])
                        for w in wants]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in out], t) for k, t in
                 enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))], ["lead", "block", "times", "bytes"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        times: list[int] = []
        raws: list[bytes] = []
        for batch in batches:
            ids += batch.column("block").to_pylist()
            times += batch.column("times").to_pylist()
            raws += batch.column("bytes").to_pylist()
        known = dict(zip(ids, range(len(ids)), strict=True))  # rows repeated with their id ask twice
        keep = sorted(known.values())
        found = repeated_starts([raws[i] for i in keep], length)
        first: list[np.ndarray] = []
        n: list[np.ndarray] = []
        for i, starts in zip(keep, found, strict=True):
            if times[i] > 1:
                starts = np.arange(len(raws[i]) - length + 1)
            heads = np.flatnonzero(np.append(True, np.diff(starts) > 1)) if len(starts) else np.zeros(0, np.int64)
            first.append(starts[heads])
            n.append(np.diff(np.append(heads, len(starts))))
        some = [k for k in range(len(keep)) if len(first[k])]
        yield pa.RecordBatch.from_arrays(
            [pa.array([ids[keep[k]] for k in some], pa.int64()), pa.array([first[k] for k in some], pa.list_(pa.int64())),
             pa.array([n[k] for k in some], pa.list_(pa.int64()))], ["block", "first", "n"])

    sent = (source.select("row", "text").join(by_row, F.col("row") == F.col("wanted"), "inner")
            .select("text", "wants").mapInArrow(lean(fetch), "lead bigint, block bigint, times bigint, bytes binary"))
    width = max(shuffle_width(spark), int(size) // SHARD + 1)
    found = sent.repartition(width, "lead").mapInArrow(lean(sort), _REPEATS)
    return cut(found if crowd is None else found.unionByName(crowd), "block-repeats")


def removed_spans(source: DataFrame, length: int = 200, seed: int = SEED) -> DataFrame:
    """For each row with repeats: row, begins and ends of bytes to remove, in order and apart."""
    occurrences = shared_blocks(source, length, seed)
    repeats = block_repeats(source, occurrences, length).withColumnRenamed("block", "of")
    spans = (occurrences.join(repeats, F.col("block") == F.col("of"), "inner")
             .select("row", F.explode(F.arrays_zip("first", "n")).alias("run"), "start")
             .select("row", (F.col("start") + F.col("run.first")).alias("begin"),
                     (F.col("start") + F.col("run.first") + F.col("run.n") + (length - 1)).alias("end")))
    return spans.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("begin", "end"))).alias("spans"))


def merged(spans: list[dict[str, int]] | None) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s in spans or []:
        if out and s["begin"] <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], s["end"])
        else:
            out.append((s["begin"], s["end"]))
    return out


def remove_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text",
                   with_text: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans,
    kept_sha256; with ``with_text`` also ``kept`` (the rest as text, bytes of
    characters cut in two left out) and the columns named in ``carry``.

    Texts are UTF-8 bytes; a null text is empty.  A string may overlap itself
    and may repeat within one text.  Rows repeated with id and text are
    repeats of each other.  Other columns are not read.
    """
    ship(docs.sparkSession)
    plain = docs.select(*(F.col(c).alias(f"carry_{c}") for c in carry),
                        docs[id_col].alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    source = plain.withColumn("row", F.xxhash64("doc_id", "text"))
    spans = removed_spans(source, length).withColumnRenamed("row", "at")
    met = source.join(spans, F.col("row") == F.col("at"), "left").drop("row", "at")
    kind = met.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    if with_text:
        schema += ", kept string" + "".join(f", carry_{c} {met.schema[f'carry_{c}'].dataType.simpleString()}" for c in carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[int | str]] = [[], [], [], [], []]
            for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                raw, gone = text.encode("utf-8", "surrogatepass"), merged(found)
                at, parts = 0, []
                for a, b in gone:
                    parts.append(raw[at:a])
                    at = b
                kept = b"".join([*parts, raw[at:]])
                for column, value in zip(out, (len(raw), sum(b - a for a, b in gone), len(gone),
                                               hashlib.sha256(kept).hexdigest(),
                                               kept.decode(errors="ignore") if with_text else ""), strict=True):
                    column.append(value)
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            more = [f"carry_{c}" for c in carry] if with_text else []
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k, _ in zip(out, kinds, names, strict=False)),
                 *(batch.column(c) for c in more)], ["doc_id", *names, *more])

    return met.mapInArrow(lean(run), schema)
