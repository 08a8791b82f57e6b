"""The halved ladder against a search at every threshold."""

import random

from pyspark.sql import functions as F

from rivernet.operators.community import merge_ladder, threshold_clusters
from rivernet.operators.network import Network


def clusters(vertices, edges):
    name = {v: v for v in vertices}

    def root(v):
        while name[v] != v:
            v = name[v]
        return v

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        name[b] = a
    return {v: root(v) for v in vertices}


def random_graphs(seed):
    rnd = random.Random(seed)
    return {w: (range(w + 1, w + 25), [(rnd.randrange(w + 1, w + 25), rnd.randrange(w + 1, w + 25), rnd.choice((0, 1, 4, 5, 9, 12, 40)))
                                       for _ in range(6 * w)]) for w in range(6)}


def test_ladder_equals_search_at_each_step(spark):
    for last, fan in ((0, 8), (1, 2), (12, 2), (12, 4)):
        graphs = random_graphs(last)
        got = merge_ladder(
            spark.createDataFrame([(w, v) for w, (vs, _) in graphs.items() for v in vs], "wrid int, vid bigint"),
            spark.createDataFrame([(w, *e) for w, (_, es) in graphs.items() for e in es], "wrid int, src bigint, dst bigint, low int"),
            last, fan).collect()
        want = {(w, v, i): c for w, (vs, es) in graphs.items() for i in range(last + 1)
                for v, c in clusters(vs, [e[:2] for e in es if e[2] <= i]).items()}
        rows = [((r.wrid, r.vid, i), r.cluster) for r in got for i in range(r.begin, r.until + 1)]
        assert len(rows) == len(want) and dict(rows) == want


def test_both_ways_of_keeping(spark):
    rnd = random.Random(6)
    arcs = [(0, rnd.randrange(20), rnd.randrange(20), rnd.choice((0.0, 0.1, 0.25, 0.3, 0.31, 0.7, 1.5))) for _ in range(30)]
    net = Network(spark.range(20).selectExpr("0 AS wrid", "id AS vid"),
                  spark.createDataFrame(arcs, "wrid int, src bigint, dst bigint, slope double").withColumn("direction", F.lit("downstream")))
    for keep in ("le", "ge"):
        got = {(r.i, r.vid): r.cluster for r in threshold_clusters(net, "slope", 2, 9, 10, keep).collect()}
        want = {(i, v): c for i in range(2, 10) for v, c in clusters(
            range(20), [a[1:3] for a in arcs if (a[3] <= i / 10 if keep == "le" else a[3] >= i / 10)]).items()}
        assert got == want
