"""The five-vertex network of FIXTURES.md section 3.1 with full expected output."""

import pytest
from pyspark.sql import functions as F

from rivernet.functions.exprs import STATS
from rivernet.operators.network import compile_network
from rivernet.operators.paths import lake_combinations
from rivernet.operators.summary import lake_summary

EDGE_COLS = ["cat", "from_node", "to_node", "length_m", "altitude_minimum", "altitude_average",
             "altitude_maximum", "slope_average", "slope_third_quartile", "slope_percentile_90",
             "slope_maximum", "slope_stddev"]
EDGES = [
    (1, 10, 101, 100.0, 12.4, 15.6, 20.5, .10, .20, .30, .50, .05),
    (2, 20, 101, 300.0, 11.0, 18.0, 26.0, .02, .04, .06, .08, .01),
    (3, 101, 30, 50.0, 8.0, 9.0, 10.0, .2, .3, .4, .9, .1),
    (4, 30, 102, 70.0, 1.0, 2.0, 3.0, .01, .02, .03, .04, .005),
]


@pytest.fixture(scope="module")
def net(spark):
    rows = [dict(zip(EDGE_COLS, e)) for e in EDGES]
    e = spark.createDataFrame(rows).withColumn("wrid", F.lit(1))
    for p in ("altitude", "slope"):
        for s in STATS:
            c = f"{p}_{s}"
            if c not in e.columns:
                e = e.withColumn(c, F.lit(0.0))
    lines = e.select("wrid", F.col("cat").alias("line_cat"), "from_node", "to_node", "length_m")
    edges = e.drop("from_node", "to_node")
    nodes = spark.createDataFrame(
        [(1, 10, 10, 1.0), (1, 20, 20, 2.0), (1, 30, 30, 4.0), (1, 101, 101, None), (1, 102, 102, None)],
        "wrid int, node_id long, lakeid long, area_ha double")
    lines = lines.withColumns({"line_cat": F.col("line_cat").cast("long"),
                               "from_node": F.col("from_node").cast("long"),
                               "to_node": F.col("to_node").cast("long")})
    edges = edges.withColumn("cat", F.col("cat").cast("long"))
    adj = spark.createDataFrame([], "wrid int, left_lake long, right_lake long")
    return compile_network(lines, nodes, edges, adj)


def test_vertices(net):
    got = {(r.vid, r.indegree, r.outdegree, r.typ) for r in net.vertices.collect()}
    assert got == {(10, 0, 1, 1), (20, 0, 1, 1), (101, 2, 1, 3), (30, 1, 1, 2), (102, 1, 0, 4)}
    v = net.vertices.first()
    assert v.cluster_lake_area_ha == 7.0 and v.cluster_lake_n == 3 and v.cluster == 10


def test_lake_combinations(net):
    rows = {(r.from_lake, r.to_lake): r for r in lake_combinations(net).collect()}
    assert set(rows) == {(10, 20), (10, 30), (20, 30)}
    up = [f"upstream_{x}" for x in ("length", "altitude_min", "altitude_mean", "altitude_max",
                                    "slope_mean", "slope_third_quart", "slope_perc_90",
                                    "slope_perc_90_max", "slope_max", "slope_max_max", "slope_stddev")]
    down = [c.replace("upstream_", "downstream_") for c in up]
    r = rows[(10, 20)]
    assert (r.lakes_along, r.confluences_along, r.total_stream_length, r.total_slope_max_max) == \
        ("10,20", "101", 400, 2657)
    assert [r[c] for c in up] == [300, 11, 18, 26, 115, 229, 343, 343, 457, 457, 57]
    assert [r[c] for c in down] == [100, 12, 16, 21, 571, 1131, 1670, 1670, 2657, 2657, 286]
    r = rows[(10, 30)]
    assert (r.lakes_along, r.total_stream_length, r.total_slope_max_max) == ("10,30", 150, 4199)
    assert [r[c] for c in up] == [-9999] * 11
    assert [r[c] for c in down] == [150, 8, 13, 21, 759, 1313, 1843, 2180, 3235, 4199, 381]
    r = rows[(20, 30)]
    assert (r.lakes_along, r.confluences_along, r.total_stream_length) == ("20,30", "101", 350)
    assert [r[c] for c in down] == [350, 8, 17, 26, 262, 441, 620, 2180, 1115, 4199, 131]


def test_lake_summary(net):
    rows = {r.lakeID: r for r in lake_summary(net).collect()}
    for lake in (10, 20):
        r = rows[lake]
        assert (r.neighborhood_size, r.downstream_lakes, r.downstream_lakes_n,
                r.downstream_lakes_area_ha, r.first_downstream_lake) == (1, "30", 1, 4.0, 30)
        assert (r.upstream_lakes, r.upstream_lakes_n, r.upstream_lakes_area_ha) == (None, None, None)
    r = rows[30]
    assert r.neighborhood_size == 4
    assert (r.downstream_lakes, r.downstream_lakes_n, r.first_downstream_lake) == (None, None, None)
    assert (r.upstream_lakes, r.upstream_lakes_n, r.upstream_lakes_area_ha) == ("10,20", 2, 3.0)


def test_focal_lakes_only(spark, net):
    focal = spark.createDataFrame([(1, 10), (1, 30)], "wrid int, lakeid long")
    rows = lake_combinations(net, focal=focal).collect()
    assert [(r.from_lake, r.to_lake, r.total_stream_length, r.upstream_length) for r in rows] == \
        [(10, 30, 150, -9999)]
