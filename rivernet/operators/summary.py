"""lake_summary (G12): for every lake, the lakes reachable downstream and
upstream, in BFS order, with counts and areas (A13, A14, O1, O2).

Both directions run as one search (a ``dir`` key column) over the natural
arcs: ``down`` walks with the flow, ``up`` against it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import exact_sum, is_lake
from .doubling import reach
from .network import Network

SUMMARY_COLUMNS = ["wrid", "cluster", "lakeID", "typ", "indegree", "outdegree",
                   "neighborhood_size", "cluster_lake_area_ha", "cluster_lake_n",
                   "downstream_lakes", "downstream_lakes_n", "downstream_lakes_area_ha",
                   "first_downstream_lake", "upstream_lakes", "upstream_lakes_n",
                   "upstream_lakes_area_ha"]


def directed_arcs(arcs: DataFrame) -> DataFrame:
    """Natural arcs as ``(wrid, dir, a, b)``: ``down`` = with the flow,
    ``up`` = against it."""
    nat = arcs.where(F.col("direction") == "downstream").select("wrid", "src", "dst")
    return (nat.select("wrid", F.lit("down").alias("dir"), F.col("src").alias("a"),
                       F.col("dst").alias("b"))
            .unionByName(nat.select("wrid", F.lit("up").alias("dir"), F.col("dst").alias("a"),
                                    F.col("src").alias("b"))))


def reach_both(network: Network, sources: DataFrame) -> DataFrame:
    """G6 from ``sources(wrid, src)`` both ways: ``(wrid, dir, src, v, hop)``."""
    arcs = directed_arcs(network.arcs)
    ways = [reach(arcs.where(F.col("dir") == d).drop("dir"), sources).withColumn("dir", F.lit(d)) for d in ("down", "up")]
    return ways[0].unionByName(ways[1]).select("wrid", "dir", "src", "v", "hop")


def _ordered_ids(cond) -> F.Column:
    """O2: ids in BFS order (hop, then id) as a comma list."""
    items = F.array_sort(F.collect_list(F.when(cond, F.struct("hop", "v"))))
    return F.array_join(F.transform(items, lambda x: x["v"].cast("string")), ",")


def lake_summary(network: Network) -> DataFrame:
    """One row per lake of the kept clusters, 16 columns (NULL where a lake
    has no lake downstream / upstream, Q11).

    Only the upstream search runs: lake S lies downstream of lake L exactly
    when L lies upstream of S, as many arcs away."""
    v = network.vertices
    lakes = v.where(is_lake("area_ha"))
    up_arcs = directed_arcs(network.arcs).where(F.col("dir") == "up").select("wrid", "a", "b")
    found = reach(up_arcs, lakes.select("wrid", F.col("vid").alias("src")), keys=("wrid",))
    attrs = v.select("wrid", F.col("vid").alias("v"), is_lake("area_ha").alias("lake"), "area_ha")
    above = found.join(attrs, ["wrid", "v"]).withColumn("dir", F.lit("up"))
    below = (above.where("lake").select("wrid", F.col("v").alias("src"), F.col("src").alias("v"), "hop")
             .join(attrs, ["wrid", "v"]).withColumn("dir", F.lit("down")))
    r = above.unionByName(below)
    down = (F.col("dir") == "down") & F.col("lake")
    up = (F.col("dir") == "up") & F.col("lake")
    agg = r.groupBy("wrid", "src").agg(
        (F.count(F.when(F.col("dir") == "up", 1)) + 1).cast("int").alias("neighborhood_size"),
        _ordered_ids(down).alias("downstream_lakes"),
        F.count(F.when(down, 1)).cast("int").alias("downstream_lakes_n"),
        exact_sum(F.when(down, F.col("area_ha"))).alias("downstream_lakes_area_ha"),
        F.min_by(F.when(down, F.col("v")), F.when(down, F.struct("hop", "v")))
        .alias("first_downstream_lake"),
        _ordered_ids(up).alias("upstream_lakes"),
        F.count(F.when(up, 1)).cast("int").alias("upstream_lakes_n"),
        exact_sum(F.when(up, F.col("area_ha"))).alias("upstream_lakes_area_ha"),
    )
    out = lakes.join(agg.withColumnRenamed("src", "vid"), ["wrid", "vid"], "left")

    def none_if_empty(c, n):
        return F.when(F.col(n) > 0, F.col(c))

    return out.select(
        "wrid", "cluster", F.col("lakeid").alias("lakeID"), "typ", "indegree", "outdegree",
        F.coalesce("neighborhood_size", F.lit(1)).alias("neighborhood_size"),
        "cluster_lake_area_ha",
        "cluster_lake_n",
        none_if_empty("downstream_lakes", "downstream_lakes_n").alias("downstream_lakes"),
        none_if_empty("downstream_lakes_n", "downstream_lakes_n").alias("downstream_lakes_n"),
        none_if_empty("downstream_lakes_area_ha", "downstream_lakes_n")
        .alias("downstream_lakes_area_ha"),
        none_if_empty("first_downstream_lake", "downstream_lakes_n").alias("first_downstream_lake"),
        none_if_empty("upstream_lakes", "upstream_lakes_n").alias("upstream_lakes"),
        none_if_empty("upstream_lakes_n", "upstream_lakes_n").alias("upstream_lakes_n"),
        none_if_empty("upstream_lakes_area_ha", "upstream_lakes_n")
        .alias("upstream_lakes_area_ha"),
    )
