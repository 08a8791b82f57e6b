"""Random river forests (braids, lake borders, parallel arcs, isolated
lakes) against a brute-force breadth-first search in Python."""

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from rivernet.functions.exprs import STATS
from rivernet.operators.network import compile_network
from rivernet.operators.summary import lake_summary


def _forest(seed, n=40):
    rnd = random.Random(seed)
    lines, cat = [], 0
    for v in range(1, n):
        cat += 1
        lines.append((cat, v, rnd.randrange(0, v)))          # flows to an older vertex
        if rnd.random() < 0.1:                              # braid / parallel arc
            cat += 1
            lines.append((cat, v, rnd.randrange(0, v)))
    lakes = {v: round(rnd.uniform(0.5, 5), 2) for v in range(n) if rnd.random() < 0.4}
    lakes[n + 1] = 1.0                                      # isolated lake
    borders = []
    lk = sorted(lakes)
    for _ in range(2):
        a, b = rnd.sample(lk, 2)
        borders.append((a, b))
    return lines, lakes, borders, n


def _expected(lines, lakes, borders, n):
    verts = set(range(n)) | set(lakes) | {x for p in borders for x in p}
    arcs = {(a, b) for _, a, b in lines if a != b}
    arcs |= {(a, b) for a, b in borders} | {(b, a) for a, b in borders}
    und = {v: set() for v in verts}
    for a, b in arcs:
        und[a].add(b)
        und[b].add(a)
    comp = {}
    for v in verts:
        if v in comp:
            continue
        q, seen = [v], {v}
        while q:
            x = q.pop()
            for y in und[x]:
                if y not in seen:
                    seen.add(y)
                    q.append(y)
        for x in seen:
            comp[x] = min(seen)
    nlakes = {}
    for v in lakes:
        nlakes[comp[v]] = nlakes.get(comp[v], 0) + 1
    out = {}
    for lake in lakes:
        if nlakes[comp[lake]] < 2:
            continue

        def bfs(fwd):
            dist, q = {lake: 0}, deque([lake])
            while q:
                x = q.popleft()
                for a, b in arcs:
                    u, w = (a, b) if fwd else (b, a)
                    if u == x and w not in dist:
                        dist[w] = dist[x] + 1
                        q.append(w)
            dist.pop(lake)
            return dist
        down, up = bfs(True), bfs(False)
        dl = ",".join(str(v) for v in sorted((v for v in down if v in lakes), key=lambda v: (down[v], v)))
        ul = ",".join(str(v) for v in sorted((v for v in up if v in lakes), key=lambda v: (up[v], v)))
        out[lake] = (comp[lake], len(up) + 1, dl or None, ul or None)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_summary_matches_brute_force(spark, seed):
    lines, lakes, borders, n = _forest(seed)
    lf = spark.createDataFrame([(1, c, a, b, 10.0) for c, a, b in lines],
                               "wrid int, line_cat long, from_node long, to_node long, length_m double")
    nodes = spark.createDataFrame(
        [(1, v, v, lakes.get(v)) for v in sorted(set(range(n)) | set(lakes))],
        "wrid int, node_id long, lakeid long, area_ha double")
    edges = lf.select("wrid", F.col("line_cat").alias("cat"), "length_m").withColumns(
        {f"{p}_{s}": F.lit(0.0) for p in ("altitude", "slope") for s in STATS})
    adj = spark.createDataFrame([(1, a, b) for a, b in borders],
                                "wrid int, left_lake long, right_lake long")
    got = {r.lakeID: (r.cluster, r.neighborhood_size, r.downstream_lakes, r.upstream_lakes)
           for r in lake_summary(compile_network(lf, nodes, edges, adj)).collect()}
    assert got == _expected(lines, lakes, borders, n)


@pytest.mark.parametrize("seed", [4, 5])
def test_combinations_invariants_on_random_forests(spark, seed):
    from rivernet.operators.paths import lake_combinations
    lines, lakes, borders, n = _forest(seed)
    lf = spark.createDataFrame([(1, c, a, b, 10.0 + c) for c, a, b in lines],
                               "wrid int, line_cat long, from_node long, to_node long, length_m double")
    nodes = spark.createDataFrame(
        [(1, v, v, lakes.get(v)) for v in sorted(set(range(n)) | set(lakes))],
        "wrid int, node_id long, lakeid long, area_ha double")
    edges = lf.select("wrid", F.col("line_cat").alias("cat"), "length_m").withColumns(
        {f"{p}_{s}": F.lit(0.0) for p in ("altitude", "slope") for s in STATS})
    adj = spark.createDataFrame([(1, a, b) for a, b in borders],
                                "wrid int, left_lake long, right_lake long")
    net = compile_network(lf, nodes, edges, adj)
    rows = lake_combinations(net).collect()
    expect = _expected(lines, lakes, borders, n)
    per = {}
    for lake, (cluster, *_rest) in expect.items():
        per[cluster] = per.get(cluster, 0) + 1
    assert len(rows) == sum(k * (k - 1) // 2 for k in per.values())
    for r in rows:
        assert r.from_lake < r.to_lake and expect[r.from_lake][0] == expect[r.to_lake][0] == r.cluster
        along = [int(x) for x in r.lakes_along.split(",")]
        assert r.from_lake in along and r.to_lake in along and along == sorted(set(along))
        parts = [x for x in (r.upstream_length, r.downstream_length) if x != -9999]
        assert abs(sum(parts) - r.total_stream_length) <= 1
