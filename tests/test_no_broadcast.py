"""Tables that grow with the input are merged, never sent through the driver."""

from rivernet.operators.doubling import diameter, reach, stored
from rivernet.operators.forest import split_network
from rivernet.operators.iterate import connected_components
from rivernet.operators.network import Network, cluster_stats, collapse_lakes, degrees


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_graph_joins_are_merged(spark):
    arcs = spark.range(200).selectExpr("CAST(id % 3 AS INT) AS wrid", "id AS a", "id + 3 AS b")
    kept, n = stored(arcs, "kept")
    assert n == 200
    ends = arcs.selectExpr("wrid", "a AS src")
    plans = {"stored": kept.join(kept.selectExpr("wrid", "b AS a", "a AS c"), ["wrid", "a"]),
             "components": connected_components(ends, arcs, vertex="src", src="a", dst="b"),
             "reach": reach(arcs, ends), "diameter": diameter(arcs)}
    lines = spark.range(200).selectExpr("CAST(id % 3 AS INT) AS wrid", "id AS line_cat", "id AS from_node", "id + 3 AS to_node")
    nodes = spark.range(203).selectExpr("CAST(id % 3 AS INT) AS wrid", "id AS node_id", "id AS lakeid", "1e0 AS area_ha")
    vertices, flow = collapse_lakes(lines, nodes)
    plans |= {"ends": flow, "degrees": degrees(vertices, flow),
              "clusters": cluster_stats(vertices.selectExpr("*", "wrid AS cluster"))}
    for name, df in plans.items():
        plan = _plan(df)
        assert "Broadcast" not in plan, name
        if name not in ("diameter",):
            assert "SortMergeJoin" in plan, name
    assert sorted(tuple(r) for r in plans["diameter"].collect()) == [(0, 67), (1, 67), (2, 66)]


def test_split_network_is_merged(spark):
    arcs = spark.range(2).selectExpr("CAST(id DIV 9 AS INT) AS wrid", "id + 1 AS src", "2 - id AS dst", "IF(id = 0, 'downstream', 'upstream') AS direction")
    vertices = spark.range(2).selectExpr("CAST(id DIV 9 AS INT) AS wrid", "id + 1 AS vid", "id DIV 9 + 1 AS cluster")
    for part in split_network(Network(vertices, arcs)):
        both = part.arcs.join(part.vertices.selectExpr("wrid", "vid AS src", "cluster"), ["wrid", "src"])
        assert "Broadcast" not in _plan(both)
