"""Repair of conversation structure (operator 12).

The rows of a conversation, in order of turn, are edited until the initials of
their roles read ``(s?(ua)+)?``: Keep (cost 0), Rerole to user or assistant (1),
Delete (2; blank and repeated rows must go), Insert an empty row (5); a
truncated row that stays costs 5 more.  Of the cheapest edits those are taken
whose initials, read in order, come first in ASCII.

A node is a row and the state of that pattern before it.  A cost DP from the
end gives each node its cost to go; an arc is optimal if it loses nothing.
The optimal arcs of a node have different initials, so the least of them is
where its least path goes on.  Prefix doubling then ranks the nodes by what
their paths read first: by one symbol, by two, by four, ...; a rank and the
rank of the node that the doubled pointer leads to give the rank of twice the
length.  Nodes of one rank read the same, so one path of each rank is written
out, through the doubled pointers.

Only small rows (role, digest of the text, flags) are worked on.  They are
numbered by a range sort and cut into blocks, so that no task holds a whole
conversation: a block is summed up by the cheapest way from each state to each
(a min-plus matrix); costs to go reach the blocks of a conversation by a scan
over these, the states in which its path enters them by a second one.  Texts
move once, to be put out in order.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rivernet.llm.common import cut, ship, shuffle_width

#: Costs of the edits, and of keeping a truncated row.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: The states before anything, after a system, user and assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: State that a user or assistant row (whichever fits) leads to, and its role.
NEXT = np.array([USER, USER, ASSISTANT, USER])
ROLE = ["user", "user", "assistant", "user"]
#: Out of reach.
FAR = 1 << 40
#: Cost to go after the last row.
END = np.array([0, 2 * INSERT, INSERT, 0], dtype=np.int64)
#: Symbols of a path, least initial first; 0 ends it.
SYMBOLS = ["", "D", "Ia", "Iu", "K", "Ra", "Ru"]
_SPACE = r"\x20\x09-\x0D"
#: A row's kind: initial of its role (s, u, a, other) * 4 + (2: must go) + (1: truncated).
KINDS = 16


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each kind and state: state and cost of Keep, cost of Rerole; and the
    cheapest way through a row, inserts before it included, from state to state."""
    legal = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}
    keep_to = np.zeros((KINDS, 4), dtype=np.int64)
    keep, rerole = np.full((KINDS, 4), FAR), np.full((KINDS, 4), FAR)
    through = np.full((KINDS, 4, 4), FAR)
    for kind in range(KINDS):
        initial, must, short = kind >> 2, kind >> 1 & 1, kind & 1
        for state in range(4):
            if not must:
                rerole[kind, state] = REROLE + TRUNCATED * short
                if (state, initial) in legal:
                    keep_to[kind, state], keep[kind, state] = legal[state, initial], TRUNCATED * short
        for state in range(4):
            at, paid = state, 0
            for _ in range(3):  # no insert, one, two
                for to, cost in ((at, DELETE), (NEXT[at], rerole[kind, at]), (keep_to[kind, at], keep[kind, at])):
                    through[kind, state, to] = min(through[kind, state, to], paid + cost)
                at, paid = NEXT[at], paid + INSERT
    return keep_to, keep, rerole, through


KEEP_TO, KEEP, RE, THROUGH = _tables()


def products(mats: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Min-plus product of each stretch of matrices, by halving."""
    while len(sizes) and sizes.max() > 1:
        place = np.arange(len(mats)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        left = np.flatnonzero(place % 2 == 0)
        pair = np.append(place, 0)[left + 1] == place[left] + 1
        out = mats[left]
        a, b = out[pair], mats[left[pair] + 1]
        out[pair] = np.minimum((a[:, :, :, None] + b[:, None, :, :]).min(2), FAR)
        mats, sizes = out, (sizes + 1) // 2
    return mats


@dataclass
class Paths:
    """Least paths of the blocks of a batch; nodes are numbered layer by layer,
    four to a layer, a block of n rows having n + 1 layers."""

    first: np.ndarray    # first node of each block
    to_go: np.ndarray    # cost to go of each node
    symbol: np.ndarray   # what the path of a node reads there
    extra: np.ndarray    # copies to delete with the row of a node
    doubled: list[np.ndarray]  # node 1, 2, 4, ... steps on
    rank: np.ndarray
    steps: np.ndarray    # symbols up to the end of the block

    def exits(self) -> np.ndarray:
        """State at the end of each block for each state before it."""
        return self.doubled[-1][self.first[:, None] + np.arange(4)] % 4


def least_paths(kind: np.ndarray, extra: np.ndarray, sizes: np.ndarray, after: np.ndarray, last: np.ndarray) -> Paths:
    """``after``: cost to go after each block; ``last``: whether inserts may end it."""
    layers = np.cumsum(sizes + 1) - sizes - 1
    closing = layers + sizes
    row_layer = np.setdiff1d(np.arange(int((sizes + 1).sum())), closing, assume_unique=True)
    own = np.zeros(len(row_layer) + len(sizes), dtype=np.int64)
    own[row_layer] = kind
    more = np.zeros(len(own), dtype=np.int64)
    more[row_layer] = extra * DELETE
    to_go = np.full((len(own), 4), FAR)
    to_go[closing] = after
    for back in range(1, int(sizes.max()) + 1 if len(sizes) else 1):  # all blocks at once
        at = (closing - back)[sizes >= back]
        to_go[at] = np.minimum((THROUGH[own[at]] + to_go[at + 1][:, None, :]).min(2) + more[at, None], FAR)
    # the optimal arc with the least initial
    node = np.arange(to_go.size).reshape(to_go.shape)
    follow = np.append(to_go[1:], [[FAR] * 4], axis=0)
    inner = np.ones(len(own), dtype=bool)
    inner[closing] = False
    state = np.arange(4)
    pay = more[:, None]
    side = np.where(NEXT[state] == USER, 1, 0)  # user: the later symbol of the two
    ways = [
        (inner[:, None] & (DELETE + pay + follow == to_go), 1 + 0 * side, node + 4),
        (np.isin(np.arange(len(own)), closing[~last], invert=True)[:, None] & (INSERT + to_go[:, NEXT] == to_go),
         2 + side, node - state + NEXT),
        (inner[:, None] & (KEEP[own] + pay + np.take_along_axis(follow, KEEP_TO[own], 1) == to_go),
         4 + 0 * side, node + 4 - state + KEEP_TO[own]),
        (inner[:, None] & (RE[own] + pay + follow[:, NEXT] == to_go), 5 + side, node + 4 - state + NEXT),
    ]
    symbol, pointer = np.zeros(node.shape, dtype=np.int64), node.copy()
    for fits, what, to in reversed(ways):
        fits = fits & (to_go < FAR)
        symbol = np.where(fits, what, symbol)
        pointer = np.where(fits, to, pointer)
    symbol, pointer = symbol.ravel(), pointer.ravel()
    rank, steps, doubled = symbol, (symbol > 0).astype(np.int64), [pointer]
    while (symbol[pointer] > 0).any():
        steps = steps + steps[pointer]
        rank = np.unique(rank * (len(rank) + len(SYMBOLS)) + rank[pointer], return_inverse=True)[1]
        pointer = pointer[pointer]
        doubled.append(pointer)
    copies = np.zeros(len(own), dtype=np.int64)
    copies[row_layer] = extra
    return Paths(layers * 4, to_go.ravel(), symbol, np.repeat(copies, 4), doubled, rank, steps)


def written(paths: Paths, starts: np.ndarray) -> list[np.ndarray]:
    """Nodes of the path from each start.  Starts of one rank read alike: their
    paths differ by where they begin only, so one of them is followed."""
    _, one, like = np.unique(paths.rank[starts], return_index=True, return_inverse=True)
    heads = starts[one]
    out: list[np.ndarray] = [np.empty(0, dtype=np.int64)] * len(heads)
    rounds = np.ceil(np.log2(np.maximum(paths.steps[heads], 1))).astype(int)
    for k in np.unique(rounds).tolist():
        own = np.flatnonzero(rounds == k)
        nodes = heads[own][:, None]
        for pointer in reversed(paths.doubled[:k]):
            nodes = np.stack([nodes, pointer[nodes]], axis=2).reshape(len(own), -1)
        for i, path in zip(own.tolist(), nodes, strict=True):
            out[i] = path[:paths.steps[heads[i]]]
    return [out[i] for i in like.tolist()]


def row_edits(paths: Paths, starts: np.ndarray, sizes: np.ndarray, extra: np.ndarray) -> list[str]:
    """What happens at each row, in symbols; what follows a block's last row is
    added to it."""
    out: list[str] = []
    names = np.array(SYMBOLS, dtype=object)
    at = 0
    for n, path in zip(sizes.tolist(), written(paths, starts), strict=True):
        rows, row = [""] * (n + 1), 0
        for s in names[paths.symbol[path]].tolist():
            rows[row] += s
            if s[0] != "I":
                rows[row] += "D" * int(extra[at + row])
                row += 1
        rows[n - 1] += rows[n]
        out += rows[:n]
        at += n
    return out


# --- Spark ----------------------------------------------------------------

def small_rows(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest, copies, kind flags, and ``place``: a number
    that grows with the order of the rows.  Stored."""
    text = F.coalesce(F.col("text"), F.lit(" "))
    rows = turns.select(
        "conv_id", "turn", F.coalesce(F.col("role"), F.lit(" ")).alias("role"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        (~text.rlike(f"[^{_SPACE}]")).alias("blank"),
        (~text.rlike(rf"[.!?][{_SPACE}]*\z")).alias("open"))
    key = ["conv_id", "turn", "role", "digest"]
    rows = rows.groupBy(*key).agg(F.count("*").alias("copies"), F.first("blank").alias("blank"),
                                  F.first("open").alias("open"))
    return cut(rows.repartitionByRange(shuffle_width(turns.sparkSession), *key).sortWithinPartitions(*key)
               .withColumn("place", F.monotonically_increasing_id()), "turns")


def _same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def _on(a: DataFrame, b: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Join on columns of one name, nulls being equal; those of ``a`` stay."""
    other = b.withColumnsRenamed({n: f"_{n}" for n in names})
    cond = F.lit(True)
    for n in names:
        cond = cond & _same(a[n], other[f"_{n}"])
    return a.join(other, cond, how).drop(*[f"_{n}" for n in names])


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` with ``again`` (role and text seen earlier) and ``kind``."""
    seen = rows.groupBy("conv_id", "role", "digest").agg(F.min("place").alias("before"))
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    must = F.col("blank") | F.col("again")
    return (_on(rows, seen, ["conv_id", "role", "digest"])
            .withColumn("again", ~F.col("blank") & (F.col("place") > F.col("before"))).drop("before")
            .withColumn("kind", code * 4 + F.when(must, 2).otherwise(0)
                        + F.when(~must & F.col("open"), 1).otherwise(0)))


def counts(rows: DataFrame) -> DataFrame:
    """Gaps and faults of each conversation, summed up by turn first."""
    n = F.col("copies")
    by_turn = rows.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("blank"), n).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(n - 1 + F.col("again").cast("long"))).alias("duplicate"),
        F.sum((F.col("kind") % 4 == 1).cast("long")).alias("truncated"))
    return by_turn.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])


def _illegal(initial: np.ndarray, after: np.ndarray) -> np.ndarray:
    pair = initial * 4 + after
    return ~np.isin(pair, [0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1])  # su, ua, au


def summed(blocks: DataFrame) -> DataFrame:
    """conv_id, block, mat (16 numbers), head, tail (initials), illegal (pairs inside)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("rows")
            sizes = np.asarray(pc.list_value_length(rows), dtype=np.int64)
            kind = np.asarray(rows.flatten().field("kind"), dtype=np.int64)
            extra = np.asarray(rows.flatten().field("copies"), dtype=np.int64) - 1
            mats = products(THROUGH[kind] + (extra * DELETE)[:, None, None], sizes)
            ends = np.cumsum(sizes)
            initial = kind >> 2
            pairs = extra.copy()
            pairs[1:] += _illegal(initial[:-1], initial[1:])
            pairs[(ends - sizes)[1:]] = extra[(ends - sizes)[1:]]  # not across blocks
            bad = np.append(0, np.cumsum(pairs))
            kinds = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("block"), pa.array(mats.reshape(len(sizes), 16).tolist(), kinds),
                 pa.array(initial[ends - sizes]), pa.array(initial[ends - 1]), pa.array(bad[ends] - bad[ends - sizes])],
                ["conv_id", "block", "mat", "head", "tail", "illegal"])

    return blocks.mapInArrow(run, f"conv_id {_kind(blocks)}, block bigint, mat array<bigint>, head bigint, "
                                  "tail bigint, illegal bigint")


def _kind(frame: DataFrame) -> str:
    return frame.schema["conv_id"].dataType.simpleString()


def carried(mats: DataFrame, start: np.ndarray, backward: bool, fan: int) -> DataFrame:
    """What reaches each block of a conversation (conv_id, block, vec) when
    ``start`` goes through its blocks' matrices, from the last or the first on.
    ``fan`` blocks are one of the next round, until a conversation is one."""
    grouped = mats.withColumn("up", F.expr(f"block div {fan}")).groupBy("conv_id", "up").agg(
        F.sort_array(F.collect_list(F.struct("block", "mat"))).alias("items"))
    if grouped.groupBy("conv_id").count().where("count > 1").isEmpty():
        grouped = grouped.withColumn("vec", F.lit(start.tolist()).cast("array<bigint>"))
    else:
        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                items = batch.column("items")
                own = np.array(items.flatten().field("mat").to_pylist(), dtype=np.int64).reshape(-1, 4, 4)
                out = products(own, np.asarray(pc.list_value_length(items), dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("conv_id"), batch.column("up"), pa.array(out.reshape(-1, 16).tolist(), pa.list_(pa.int64()))],
                    ["conv_id", "block", "mat"])

        above = cut(grouped.mapInArrow(multiply, f"conv_id {_kind(mats)}, block bigint, mat array<bigint>"), "groups")
        grouped = _on(grouped, carried(above, start, backward, fan).withColumnRenamed("block", "up"), ["conv_id", "up"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for conv, items, vec in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "items", "vec")), strict=True):
                v = np.array(vec, dtype=np.int64)
                for item in reversed(items) if backward else items:
                    out.append((conv, item["block"], v.tolist()))
                    m = np.array(item["mat"], dtype=np.int64).reshape(4, 4)
                    v = np.minimum((m + v).min(1) if backward else (m + v[:, None]).min(0), FAR)
            if not out:
                continue
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), (batch.schema.field("conv_id").type, pa.int64(),
                                                          pa.list_(pa.int64())), strict=True)], ["conv_id", "block", "vec"])

    return grouped.mapInArrow(run, f"conv_id {_kind(mats)}, block bigint, vec array<bigint>")


def _solved(batch: pa.RecordBatch) -> tuple[Paths, np.ndarray, np.ndarray]:
    rows = batch.column("rows")
    sizes = np.asarray(pc.list_value_length(rows), dtype=np.int64)
    flat = rows.flatten()
    extra = np.asarray(flat.field("copies"), dtype=np.int64) - 1
    paths = least_paths(np.asarray(flat.field("kind"), dtype=np.int64), extra, sizes,
                        np.array(batch.column("vec").to_pylist(), dtype=np.int64).reshape(-1, 4),
                        np.asarray(batch.column("last").to_pylist(), dtype=bool))
    return paths, sizes, extra


@dataclass(frozen=True)
class Repair:
    """report: conv_id, gaps, blank, duplicate, truncated, illegal, cost of each
    conversation that has rows; edits: conv_id, turn, role, digest of the text,
    and ``edit``, what is done with the rows that are equal in these."""

    report: DataFrame
    edits: DataFrame


def find_edits(turns: DataFrame, block: int = 256, fan: int = 256) -> Repair:
    """Cheapest repair of every conversation of ``turns(conv_id, turn, role, text)``.

    A null role or text counts as one space; a null turn comes first, a null
    conv_id is a conversation of its own.  Rows of one turn are in order of
    role, then of the digest of their text; equal rows are neighbours.  An empty
    table has no result; other columns are not read.
    """
    ship(turns.sparkSession)
    rows = cut(faults(small_rows(turns)), "faults")
    blocks = cut(rows.withColumn("block", F.expr(f"place div {block}")).groupBy("conv_id", "block").agg(
        F.sort_array(F.collect_list(F.struct("place", "turn", "role", "digest", F.col("kind").cast("long").alias("kind"), "copies")))
        .alias("rows")), "blocks")
    mats = cut(summed(blocks), "mats")
    ends = mats.groupBy("conv_id").agg(F.max("block").alias("top"), F.min("block").alias("bottom"))
    long = cut(_on(mats, ends.where("top > bottom"), ["conv_id"]), "long")  # conversations of several blocks
    costs = cut(carried(long, END, True, fan), "costs")
    end = F.lit(END.tolist()).cast("array<bigint>")
    placed = (_on(_on(blocks, ends, ["conv_id"]), costs, ["conv_id", "block"], "left")
              .withColumns({"vec": F.coalesce("vec", end), "last": F.col("block") == F.col("top"),
                            "first": F.col("block") == F.col("bottom")}))

    def ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            exits = _solved(batch)[0].exits()
            mat = np.where(exits[:, :, None] == np.arange(4), 0, FAR).reshape(-1, 16)
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("block"),
                                              pa.array(mat.tolist(), pa.list_(pa.int64()))], ["conv_id", "block", "mat"])

    shape = f"conv_id {_kind(blocks)}, block bigint, mat array<bigint>"
    steps = cut(placed.where("top > bottom").drop("top", "bottom", "first").mapInArrow(ways, shape), "ways")
    begin = np.array([0, FAR, FAR, FAR])
    entries = carried(steps, begin, False, fan).select("conv_id", "block", F.col("vec").alias("entry"))
    ready = (_on(placed.drop("top", "bottom"), entries, ["conv_id", "block"], "left")
             .withColumn("entry", F.coalesce(F.array_position("entry", 0) - 1, F.lit(START)).cast("long")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, sizes, extra = _solved(batch)
            starts = paths.first + np.asarray(batch.column("entry"), dtype=np.int64)
            flat = batch.column("rows").flatten()
            cost = np.where(np.asarray(batch.column("first").to_pylist(), dtype=bool), paths.to_go[starts], 0)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            head = np.append(True, owner[1:] != owner[:-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id").take(pa.array(owner)), *(flat.field(c) for c in ("turn", "role", "digest")),
                 pa.array(row_edits(paths, starts, sizes, extra), pa.string()),
                 pa.array(np.where(head, cost[owner], 0))], ["conv_id", "turn", "role", "digest", "edit", "cost"])

    turn = rows.schema["turn"].dataType.simpleString()
    edits = cut(ready.mapInArrow(write, f"conv_id {_kind(blocks)}, turn {turn}, role string, digest binary, "
                                        "edit string, cost bigint"), "edits")
    return Repair(_report(rows, mats, long, edits), edits.drop("cost"))


def _report(rows: DataFrame, mats: DataFrame, long: DataFrame, edits: DataFrame) -> DataFrame:
    before = F.lag("tail").over(Window.partitionBy("conv_id").orderBy("block"))  # of blocks, not of rows
    legal = (F.col("before") * 4 + F.col("head")).isin(1, 6, 9)
    across = long.withColumn("before", before).where("before is not null").select(
        "conv_id", (~legal).cast("long").alias("illegal"))
    illegal = mats.select("conv_id", "illegal").unionByName(across).groupBy("conv_id").agg(F.sum("illegal").alias("illegal"))
    cost = edits.groupBy("conv_id").agg(F.sum("cost").alias("cost"))
    return _on(_on(counts(rows), illegal, ["conv_id"]), cost, ["conv_id"]).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")


_PIECE = re.compile("[DK]|[IR][au]")


def _in_order(turns: DataFrame, edits: DataFrame) -> DataFrame:
    """Edits and texts of each conversation together, in order.  The rows of one
    conversation go to one task, which passes them on one by one."""
    text = F.coalesce(F.col("text"), F.lit(" "))
    said = turns.select("conv_id", "turn", F.coalesce(F.col("role"), F.lit(" ")).alias("role"),
                        F.unhex(F.sha2(text, 256)).alias("digest"), F.lit(None).cast("string").alias("edit"),
                        text.alias("text"))
    both = edits.withColumn("text", F.lit(None).cast("string")).unionByName(said)
    return (both.repartition(shuffle_width(turns.sparkSession), "conv_id")
            .sortWithinPartitions("conv_id", "turn", "role", "digest", F.col("edit").desc()))


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, audit letters, rows put out) of each edit, in order."""
    edit = None
    for batch in batches:
        for conv, role, symbols, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "edit", "text")),
                                             strict=True):
            if symbols is not None:
                edit = symbols
            elif edit is not None:  # the first of equal rows; the others go
                rows = [(role, text) if p == "K" else ("user" if p[1] == "u" else "assistant", "" if p[0] == "I" else text)
                        for p in _PIECE.findall(edit) if p != "D"]
                yield conv, re.sub("[au]", "", edit), rows
                edit = None


def repaired_rows(turns: DataFrame, edits: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), role, text."""
    kind = to_arrow_type(turns.schema["conv_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch() -> pa.RecordBatch:
            columns = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
                columns, (kind, pa.int64(), pa.string(), pa.string()), strict=True)], ["conv_id", "place", "role", "text"])

        out: list[tuple] = []
        now: object = run
        for conv, _, rows in _lines(batches):
            now, place = conv, 0 if conv != now else place
            for role, text in rows:
                out.append((conv, place, role, text))
                place += 1
            if len(out) >= 1000:
                yield batch()
                out = []
        if out:
            yield batch()

    return _in_order(turns, edits).mapInArrow(run, f"conv_id {_kind(turns)}, place bigint, role string, text string")


def repair_digests(turns: DataFrame, edits: DataFrame) -> DataFrame:
    """conv_id, audit and the digest of the repaired rows (``role:text``, joined
    by line ends), taken while they pass."""
    kind = to_arrow_type(turns.schema["conv_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([now], kind), pa.array(["".join(audit)], pa.string()), pa.array([digest.hexdigest()], pa.string())],
                ["conv_id", "audit", "repaired_sha256"])

        now: object = run
        audit: list[str] = []
        for conv, letters, rows in _lines(batches):
            if conv != now:
                if now is not run:
                    yield batch()
                now, audit, digest, link = conv, [], hashlib.sha256(), ""
            audit.append(letters)
            for role, text in rows:
                digest.update(f"{link}{role}:{text}".encode())
                link = "\n"
        if now is not run:
            yield batch()

    return _in_order(turns, edits).mapInArrow(run, f"conv_id {_kind(turns)}, audit string, repaired_sha256 string")


def plant_damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with one fault in four rows, by crc32 of
    ``conv_id:turn``: dropped, emptied, without sentence ends, repeated, or said
    by the user.  Nulls count as one space."""
    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn"))) % 20
    text = (F.when(fault == 1, "").when(fault == 2, F.regexp_replace(plain("text"), "[.!?]", ""))
            .otherwise(plain("text")))
    return conversations.where(fault != 0).select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(plain("role")).alias("role"), text.alias("text"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")
    ).drop("_copy")


def repair_report(conversations: DataFrame, turns: DataFrame, repair: Repair) -> DataFrame:
    """The columns of the registered query: every conv_id of ``conversations``."""
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    every = conversations.select("conv_id").distinct()
    out = _on(_on(every, repair.report, ["conv_id"], "left"), repair_digests(turns, repair.edits), ["conv_id"], "left")
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in numbers],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
