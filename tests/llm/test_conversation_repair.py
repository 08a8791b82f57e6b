"""Conversation repair against a search over all edits, on blocks of any size."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivernet.llm import conversation_repair as R
from rivernet.llm.conversation_repair import find_edits, plant_damage, repair_digests, repair_report, repaired_rows

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
LEGAL = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
BLANK = re.compile(r"[\x20\x09-\x0D]*")


def damaged(rows):
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2].encode(),
                                       hashlib.sha256(r[3].encode()).digest()))


def cheapest(rows, must, short, insert=5, delete=2):
    """Least (cost, audit) by a heap over (cost, audit, row, state)."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, audit, out
        for role in ("user", "assistant"):
            if (state, role[0]) in LEGAL:
                heapq.heappush(heap, (cost + insert, audit + "I", i, role[0], (*out, (role, ""))))
                if i < len(rows) and not must[i]:
                    heapq.heappush(heap, (cost + 1 + 5 * short[i], audit + "R", i + 1, role[0], (*out, (role, rows[i][3]))))
        if i < len(rows):
            heapq.heappush(heap, (cost + delete, audit + "D", i + 1, state, out))
            if not must[i] and (state, rows[i][2][:1]) in LEGAL:
                heapq.heappush(heap, (cost + 5 * short[i], audit + "K", i + 1, rows[i][2][:1], (*out, rows[i][2:])))
    raise AssertionError


def brute(rows):
    rows = in_order(rows)
    blank = [BLANK.fullmatch(r[3]) is not None for r in rows]
    again = [not b and r[2:] in {x[2:] for x in rows[:i]} for i, (r, b) in enumerate(zip(rows, blank, strict=True))]
    short = [not b and not d and re.sub(r"[\x20\x09-\x0D]+\Z", "", r[3])[-1] not in ".!?"
             for r, b, d in zip(rows, blank, again, strict=True)]
    turns = {r[1] for r in rows} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    cost, audit, out = cheapest(rows, [a or b for a, b in zip(blank, again, strict=True)], short)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return gaps, sum(blank), sum(again), sum(short), illegal, cost, audit, digest, out


def test_inserts_where_they_are_cheap(monkeypatch):
    """With the contract's costs deleting the partner is always cheaper than an insert."""
    for name, value in (("INSERT", 1), ("DELETE", 3), ("END", np.array([0, 2, 1, 0]))):
        monkeypatch.setattr(R, name, value)
    for name, value in zip(("KEEP_TO", "KEEP", "RE", "THROUGH"), R._tables(), strict=True):
        monkeypatch.setattr(R, name, value)
    rnd = random.Random(5)
    blocks = [[(rnd.randint(0, 3), rnd.random() < 0.2, rnd.random() < 0.3, rnd.choice([0, 0, 0, 2]))
               for _ in range(rnd.randint(1, 12))] for _ in range(200)]
    flat = [r for b in blocks for r in b]
    kind = np.array([i * 4 + 2 * must + (short and not must) for i, must, short, _ in flat])
    extra, sizes = np.array([r[3] for r in flat]), np.array([len(b) for b in blocks])
    paths = R.least_paths(kind, extra, sizes, np.tile(R.END, (len(blocks), 1)), np.ones(len(blocks), dtype=bool))
    edits, at, seen = R.row_edits(paths, paths.first, sizes, extra), 0, set()
    for k, own in enumerate(blocks):
        rows = [("", "", "suax"[i], "") for i, _, _, n in own for _ in range(n + 1)]
        must = [bool(m or j) for _, m, _, n in own for j in range(n + 1)]
        short = [s and not m and not j for _, m, s, n in own for j in range(n + 1)]
        cost, audit, _ = cheapest(rows, must, short, 1, 3)
        assert re.sub("[au]", "", "".join(edits[at:at + len(own)])) == audit and paths.to_go[paths.first[k]] == cost
        at += len(own)
        seen |= {*audit}
    assert seen == {*"DIKR"}


def conversations(seed, n, longest):
    rnd = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rnd.randint(1, longest)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            if rnd.random() < 0.7:
                role = "user" if turn % 2 == 0 else "assistant"
            text = rnd.choice(["Yes.", "No", "a b!\n", " ", "", None, "Why? ", "x y z é.", "end. ", " ", "...no"])
            rows.append((conv, rnd.choice([turn, turn, turn, turn + 2, None]), role, text))
    rows += rows[:5] + [(None, 1, "user", "a."), (None, None, None, None), (n + 1, None, "assistant", "q")]
    return rows


@pytest.mark.parametrize(("block", "fan"), [(256, 256), (3, 2)])
def test_query_equals_brute_force(spark, block, fan):
    rows = conversations(block, 60, 14) + [(1000, i, "user" if i % 3 else "assistant", f"t{i}" + "." * (i % 5)) for i in range(90)]
    rows += [(conv, 0, "user", "Alone.") for conv in range(2000, 2060)]  # some lose their only row
    table = spark.createDataFrame(rows, SCHEMA).select("*", F.lit(1).alias("cost"), F.lit("x").alias("digest"),
                                                       F.lit(2).alias("block"), F.lit(3).alias("place"))
    turns = plant_damage(table)
    repair = find_edits(turns, block, fan)
    got = {r[0]: tuple(r)[1:] for r in repair_report(table, turns, repair).collect()}
    after = defaultdict(list)
    for r in damaged(rows):
        after[r[0]].append(r)
    want = {conv: brute(after[conv]) for conv in {r[0] for r in rows}}
    assert got == {conv: w[:-1] for conv, w in want.items()}
    assert any(w[5] == 0 and w[6] == "" for w in want.values()) and {*"DKR"} == {*"".join(w[6] for w in want.values())}
    put_out = defaultdict(list)
    for r in sorted(repaired_rows(turns, repair.edits).collect(), key=lambda r: r["place"]):
        put_out[r["conv_id"]].append((r["role"], r["text"]))
    assert all(tuple(put_out[conv]) == w[-1] for conv, w in want.items())


def test_undamaged_rows_with_ties(spark):
    rows = [(c, t, "system" if k == 0 else "user" if k % 2 else "assistant", "One." if k == 3 else f"Row {k}.")
            for c in (1, 2) for k, t in enumerate([0, 0, 1, 1, 2, None])] + [(3, 0, "user", "."), (3, 0, "user", ".")]
    turns = spark.createDataFrame(rows, SCHEMA)
    repair = find_edits(turns, 4, 4)
    report = {r[0]: tuple(r)[1:] for r in repair.report.collect()}
    audits = {r["conv_id"]: (r["audit"], r["repaired_sha256"]) for r in repair_digests(turns, repair.edits).collect()}
    for conv in (1, 2, 3):
        want = brute([r for r in rows if r[0] == conv])
        assert report[conv] == want[:6] and audits[conv] == want[6:8]
    nothing = find_edits(turns.limit(0))
    assert nothing.report.collect() == [] and repaired_rows(turns.limit(0), nothing.edits).collect() == []
    assert repair_report(turns.limit(0), turns.limit(0), nothing).collect() == []
