from pyspark.sql import functions as F

from rivernet.functions.exprs import STATS
from rivernet.operators.doubling import reach
from rivernet.operators.iterate import connected_components
from rivernet.operators.network import Network, add_reverse_arcs
from rivernet.operators.paths import lake_combinations, shortest_paths, walk_arcs


def test_components_chain_and_isolated(spark):
    v = spark.createDataFrame([(1, i) for i in range(1, 8)] + [(2, 1), (2, 2)], "wrid int, vid long")
    e = spark.createDataFrame([(1, 5, 4), (1, 4, 3), (1, 3, 2), (1, 2, 1), (1, 7, 6), (2, 1, 2)],
                              "wrid int, src long, dst long")
    got = {(r.wrid, r.vid): r.component for r in connected_components(v, e).collect()}
    assert got == {(1, 1): 1, (1, 2): 1, (1, 3): 1, (1, 4): 1, (1, 5): 1, (1, 6): 6, (1, 7): 6,
                   (2, 1): 1, (2, 2): 1}


def test_reach_cycle_without_self(spark):
    arcs = spark.createDataFrame([(1, 1, 2), (1, 2, 1), (1, 2, 3)], "wrid int, a long, b long")
    src = spark.createDataFrame([(1, 1), (1, 2)], "wrid int, src long")
    got = {(r.src, r.v, r.hop) for r in reach(arcs, src).collect()}
    assert got == {(1, 2, 1), (1, 3, 2), (2, 1, 1), (2, 3, 1)}


def _net(spark, arcs, areas):
    a = spark.createDataFrame(arcs, "wrid int, src long, dst long, line_cat long, length_m double")
    for p in ("altitude", "slope"):
        for s in STATS:
            a = a.withColumn(f"{p}_{s}", F.lit(0.0))
    a = add_reverse_arcs(a.withColumn("direction", F.lit("downstream")))
    v = spark.createDataFrame([(1, vid, vid, area, 1, 0, 0, 0, 0.0, 0) for vid, area in areas],
                              "wrid int, vid long, lakeid long, area_ha double, cluster long, "
                              "indegree int, outdegree int, typ int, cluster_lake_area_ha double, "
                              "cluster_lake_n int")
    return Network(v, a)


def test_border_pair_up_and_downstream(spark):
    from rivernet.operators.summary import lake_summary
    net = _net(spark, [(1, 1, 2, -1, 0.0), (1, 2, 1, -1, 0.0)], [(1, 1.0), (2, 1.0)])
    rows = {r.lakeID: r for r in lake_summary(net).collect()}
    assert rows[1].downstream_lakes == "2" and rows[1].upstream_lakes == "2"
    assert rows[2].downstream_lakes == "1" and rows[2].upstream_lakes == "1"


def test_square_tie_smaller_arc_ids(spark):
    # square 1-2-4, 1-3-4, all lengths equal: the path over vertex 2 wins
    net = _net(spark, [(1, 1, 2, 10, 5.0), (1, 1, 3, 11, 5.0), (1, 2, 4, 12, 5.0), (1, 3, 4, 13, 5.0)],
               [(1, 1.0), (2, 1.0), (3, 1.0), (4, 1.0)])
    p = shortest_paths(walk_arcs(net), spark.createDataFrame([(1, 1)], "wrid int, src long"))
    best = p.where("v = 4").first()
    assert [a.dst for a in best.arc_ids] == [2, 4] and best.hops == 2
    pairs = {(r.from_lake, r.to_lake): r for r in lake_combinations(net).collect()}
    assert pairs[(1, 4)].lakes_along == "1,2,4"
    assert pairs[(2, 3)].upstream_length == 5 and pairs[(2, 3)].downstream_length == 5


def test_weight_ranks_before_arcs(spark):
    """A longer path that costs less wins, and is walked on from."""
    from rivernet.operators.paths import shortest_paths

    step = "wrid int, a bigint, b bigint, lab int, cat bigint, len_mm bigint, w int"
    arcs = spark.createDataFrame([(1, 1, 4, 1, 9, 5, 1), (1, 1, 2, 0, 1, 5, 0), (1, 2, 3, 0, 2, 5, 0), (1, 3, 4, 0, 3, 5, 0),
                                  (1, 4, 5, 0, 4, 5, 0)], step)
    sources = spark.createDataFrame([(1, 1)], "wrid int, src bigint")
    plain = {r["v"]: r["hops"] for r in shortest_paths(arcs, sources).collect()}
    cheap = {r["v"]: r["hops"] for r in shortest_paths(arcs, sources, weight="w").collect()}
    assert plain[4] == 1 and plain[5] == 2 and cheap[4] == 3 and cheap[5] == 4


def test_offset_is_over_all_lakes(spark):
    """A node id cannot clash with a lake that is known from a border only."""
    from rivernet.operators.network import assign_node_lake

    nodes = spark.createDataFrame([(1, 1, None), (1, 2, 10), (2, 5, None)], "wrid int, node_id bigint, lakeid bigint")
    lakes = spark.createDataFrame([(1, 10), (1, 11), (2, 7)], "wrid int, lakeid bigint")
    got = {(r["wrid"], r["node_id"]): r["lakeid"] for r in assign_node_lake(nodes, lakes).collect()}
    assert got == {(1, 1): 12, (1, 2): 10, (2, 5): 12}


def test_flow_along_a_long_path(spark):
    """A straight path of 300 cells: the last cell drains them all."""
    from rivernet.operators.raster import flow_accumulation

    d8 = spark.range(300).select(F.lit(0).cast("bigint").alias("row"), F.col("id").alias("col"), F.lit(1).alias("d"),
                                 F.lit(0).cast("bigint").alias("nrow"), (F.col("id") + 1).alias("ncol"))
    d8 = d8.withColumn("d", F.when(F.col("col") < 299, F.col("d")))
    got = {r["col"]: r["acc"] for r in flow_accumulation(d8).collect()}
    assert got == {c: c + 1 for c in range(300)}
