"""Periodic runs against brute force over every lag."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from rivernet.llm.periodic_runs import RunRule, find_runs, plant_runs, run_digests, runs_of, seeds, symbols_of


def brute(words, least=24, times=3):
    out = []
    n = len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            e = i
            while e + q < n and words[e] == words[e + q]:
                e += 1
            length = e - i + q
            if e > i and length >= max(least, times * q) and not any(
                    all(words[j] == words[j + d] for j in range(i, e + q - d)) for d in range(1, q)):
                out.append((i, length, q))
            i = e + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def sample(rnd, n):
    out = []
    while len(out) < n:
        kind = rnd.random()
        if kind < 0.4:
            period = [rnd.choice("ab") for _ in range(rnd.randint(1, 12))]
            out += (period * rnd.randint(2, 9))[:rnd.randint(5, 90)]
        elif kind < 0.6:
            out += [rnd.choice("abc")] * rnd.randint(1, 40)
        else:
            out += [rnd.choice("abcd") for _ in range(rnd.randint(1, 25))]
    return out[:n]


def test_runs_equal_brute_force():
    rnd = random.Random(11)
    for least, times in ((24, 3), (5, 3), (1, 4), (40, 5)):
        rule = RunRule(least, times)
        rows = [[w.encode() for w in sample(rnd, rnd.randint(0, 160))] for _ in range(40)]
        symbols, begins = symbols_of(rows)
        found = runs_of(symbols, rule)
        own = [[] for _ in rows]
        for s, n, p in found:
            t = int(np.searchsorted(begins, s, side="right")) - 1
            own[t].append((s - int(begins[t]), n, p))
        assert own == [brute(w, least, times) for w in rows]


def test_seeds_grow_linearly_on_one_repeated_word():
    symbols = np.zeros(5000, dtype=np.int64)
    assert sum(len(at) for at, _ in seeds(symbols, RunRule())) == 1
    assert runs_of(symbols, RunRule()) == [(0, 5000, 1)]


def test_query_equals_brute_force(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join(sample(rnd, rnd.randint(0, 140)))) for i in range(300)]
    rows += [(None, "x\ty\x0bz\r\n" * 30), (7, None), (8, ""), (9, " \t"), (9, " \t"), (3, rows[3][1]),
             (400, "a b c " * 4000), (401, "é " + "ü ß " * 30), (402, "w " * 23), (403, "w " * 24),
             (404, " ".join(map(str, range(3000))) + " again" * 30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").select(
        "*", F.lit(1).alias("runs"), F.lit("x").alias("start"), F.lit(None).cast("string").alias("collapsed"))
    got = sorted(map(tuple, run_digests(find_runs(plant_runs(docs))).collect()), key=str)
    want = []
    for i, text in rows:
        words = planted(i, text)
        runs = brute(words) if len(words) < 5000 else [(0, 12000, 3)]
        drop = {j for s, n, q in runs for j in range(s + q, s + n)}
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        want.append((i, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                     hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
                     hashlib.sha256(b" ".join(w for j, w in enumerate(words) if j not in drop)).hexdigest()))
    assert got == sorted(want, key=str)
    assert sum(w[1] > 0 for w in want) > 60 and any(w[1] > 1 for w in want)
    assert run_digests(find_runs(plant_runs(docs.limit(0)))).collect() == []


def test_runs_and_text_of_the_operator(spark):
    docs = spark.createDataFrame([(1, "p " + "a b " * 12 + "q")], "doc_id int, text string")
    row = find_runs(docs).first()
    assert [tuple(r) for r in row.runs] == [(1, 24, 2)] and row.collapsed == "p a b q"
    assert find_runs(docs, RunRule(least=30)).first().runs == []
