"""The gis section end to end on the sf0.001 fixture geometry."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(SF).exists(), reason="no test data")
def test_gis_to_summary(spark):
    from rivernet.operators.network import compile_network
    from rivernet.operators.summary import lake_summary
    from rivernet.plans import spatial_queries as SQ
    from rivernet.plans.gis import gis_section
    out = gis_section(SQ._catchments(spark, SF), SQ._lakes(spark, SF), SQ._streams(spark, SF))
    lines, nodes = out["lines"], out["nodes"]
    # every line end is a node of its region, node ids are unique per region
    ends = (lines.select("wrid", F.col("from_node").alias("node_id"))
            .unionByName(lines.select("wrid", F.col("to_node").alias("node_id"))).distinct())
    assert ends.join(nodes, ["wrid", "node_id"], "left_anti").count() == 0
    assert nodes.groupBy("wrid", "node_id").count().where("count > 1").count() == 0
    # no stream of this table meets a lake: no node carries an area, and none has a lake's id
    assert nodes.where(F.col("area_ha").isNotNull()).count() == 0
    assert nodes.where("lakeid < node_id").count() == 0
    assert lines.where(F.col("length_m") <= 0).count() == 0
    net = compile_network(lines, nodes, out["edges"], out["adjacency"])
    # one summary row for each lake of a kept cluster
    lakes = net.vertices.where("area_ha > 0").select("wrid", "lakeid")
    got = lake_summary(net).select("wrid", F.col("lakeID").alias("lakeid"))
    assert got.exceptAll(lakes).count() == 0 and lakes.exceptAll(got).count() == 0
