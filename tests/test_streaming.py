"""S11 driven by a Structured Streaming file source of region requests."""

from pyspark.sql import functions as F

from rivernet.functions.exprs import STATS
from rivernet.streaming.incremental import refresh_on_arrival


def test_refresh_on_arrival(spark, tmp):
    lines = spark.createDataFrame([(1, 1, 10, 101, 100.0), (1, 2, 20, 101, 300.0),
                                   (1, 3, 101, 30, 50.0)],
                                  "wrid int, line_cat long, from_node long, to_node long, length_m double")
    nodes = spark.createDataFrame([(1, 10, 10, 1.0), (1, 20, 20, 2.0), (1, 30, 30, 4.0),
                                   (1, 101, 101, None)],
                                  "wrid int, node_id long, lakeid long, area_ha double")
    edges = lines.select("wrid", F.col("line_cat").alias("cat"), "length_m").withColumns(
        {f"{p}_{s}": F.lit(0.0) for p in ("altitude", "slope") for s in STATS})
    adj = spark.createDataFrame([], "wrid int, left_lake long, right_lake long")
    spark.createDataFrame([(1,)], "wrid int").write.parquet(f"{tmp}/requests")
    q = refresh_on_arrival(spark, f"{tmp}/requests", f"{tmp}/out", f"{tmp}/stream_ckpt",
                           sections=("network_compilation", "lake_summary"),
                           lines=lines, nodes=nodes, edges=edges, adjacency=adj)
    q.awaitTermination(300)
    got = {r.lakeID: r.downstream_lakes for r in spark.read.parquet(f"{tmp}/out/lake_summary").collect()}
    assert got == {10: "30", 20: "30", 30: None}
