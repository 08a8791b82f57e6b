"""Reach in logarithmic rounds against a plain breadth-first search."""

import random
from collections import defaultdict, deque

import pytest
from pyspark.sql import functions as F

from rivernet.operators.doubling import diameter, reach


def bfs(arcs, source):
    out = defaultdict(set)
    for a, b in arcs:
        out[a].add(b)
    hop, queue = {source: 0}, deque([source])
    while queue:
        x = queue.popleft()
        for y in out[x]:
            if y not in hop:
                hop[y] = hop[x] + 1
                queue.append(y)
    return {v: h for v, h in hop.items() if v != source}


def graph(rnd, n, forks):
    """Each vertex flows to one, some to more; cycles, loops and repeated arcs occur."""
    arcs = [(v, rnd.randrange(max(0, v - 4), v) if v and rnd.random() < 0.85 else rnd.randrange(n)) for v in range(n)]
    return arcs + [(rnd.randrange(n), rnd.randrange(n)) for _ in range(forks)] + arcs[:2]


@pytest.mark.parametrize("up", [False, True])
def test_reach_equals_bfs(spark, up):
    rnd = random.Random(4 + up)
    rows, sources = [], []
    graphs = {w: graph(rnd, 40, w) for w in range(6)}
    graphs[6] = [(v, v + 1) for v in range(30)]
    graphs[7] = [(v, (v + 1) % 9) for v in range(9)] + [(20 + v, 20 + (v + 1) % 5) for v in range(5)] + [(30, 24)]
    for w, arcs in graphs.items():
        arcs = [(b, a) if up else (a, b) for a, b in arcs]
        graphs[w] = arcs
        rows += [(w, a, b) for a, b in arcs]
        sources += [(w, s) for s in rnd.sample(range(30), 8)] + [(w, 99)]
    got = reach(spark.createDataFrame(rows, "wrid int, a bigint, b bigint"),
                spark.createDataFrame(sources, "wrid int, src bigint")).collect()
    want = sorted((w, s, v, h) for w, s in sources for v, h in bfs(graphs[w], s).items())
    assert sorted(map(tuple, got)) == want
    none = reach(spark.createDataFrame([], "wrid int, a bigint, b bigint"),
                 spark.createDataFrame(sources, "wrid int, src bigint"))
    assert none.collect() == []


def test_diameter_equals_bfs(spark):
    rnd = random.Random(9)
    graphs = {w: graph(rnd, 30, w % 4) for w in range(8)}
    graphs[8] = [(v, v + 1) for v in range(40)]
    graphs[9] = [(v, (v + 1) % 9) for v in range(9)] + [(20 + v, 20 + (v + 1) % 5) for v in range(5)] + [
        (30 + v, 31 + v) for v in range(6)] + [(36, 24)]
    got = diameter(spark.createDataFrame([(w, *x) for w, arcs in graphs.items() for x in arcs], "wrid int, a bigint, b bigint"))
    want = {w: max(max(bfs(arcs, v).values(), default=0) for v in {x for p in arcs for x in p}) for w, arcs in graphs.items()}
    assert {r.wrid: r.diameter for r in got.collect()} == want


def test_long_river_takes_few_rounds(spark, monkeypatch):
    from rivernet.operators import doubling

    writes = []
    plain = doubling.stored
    monkeypatch.setattr(doubling, "stored", lambda df, tag, *more: (writes.append(tag), plain(df, tag, *more))[1])
    n = 10_000
    arcs = spark.range(n - 1).select(F.lit(0).alias("wrid"), F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = reach(arcs, spark.createDataFrame([(0, 0), (0, 5000)], "wrid int, src bigint"))
    assert found.groupBy("src").agg(F.count("*"), F.max("hop")).orderBy("src").collect() == [
        (0, n - 1, n - 1), (5000, n - 5001, n - 5001)]
    assert len(writes) <= 20
