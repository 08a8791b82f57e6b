"""Per-region guards and per-cluster reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import combination_count, is_lake
from .network import Network


def region_guard(lines: DataFrame, nodes: DataFrame, network: Network,
                 all_arcs: DataFrame) -> DataFrame:
    """Per region the figures the reference stops on, in full, and the
    reason a region is skipped (NULL = region kept).  Nothing ends the run:
    failing regions are reported here and left out downstream."""
    regions = (nodes.select("wrid").unionByName(lines.select("wrid"))
               .unionByName(all_arcs.select("wrid")).distinct())
    n_lines = lines.groupBy("wrid").agg(F.count("*").alias("n"))
    n_lakes = (nodes.where(is_lake("area_ha")).groupBy("wrid")
               .agg(F.count_distinct("lakeid").alias("n")))
    n_arcs = all_arcs.groupBy("wrid").agg(F.count("*").alias("n"))
    n_cl = (network.vertices.groupBy("wrid")
            .agg(F.count_distinct("cluster").alias("n")))
    out = regions
    for name, t in (("streams", n_lines), ("lakes", n_lakes), ("arcs", n_arcs),
                    ("clusters", n_cl)):
        out = out.join(t.withColumnRenamed("n", name), "wrid", "left")
    out = out.withColumns({c: F.coalesce(c, F.lit(0)).cast("long")
                           for c in ("streams", "lakes", "arcs", "clusters")})
    reason = (F.when(F.col("streams") == 0, "no streams")
              .when(F.col("lakes") < 2, "fewer than two lakes")
              .when(F.col("arcs") == 0, "no arcs")
              .when(F.col("clusters") == 0, "no cluster with two lakes"))
    return out.withColumn("skip_reason", reason)


def network_report(network: Network) -> DataFrame:
    """A16 + X16: per kept cluster the vertex, arc, lake and pair counts."""
    v = network.vertices
    nat = network.arcs.where(F.col("direction") == "downstream")
    per_v = v.groupBy("wrid", "cluster").agg(
        F.count("*").alias("n_vertices"),
        F.count_distinct(F.when(is_lake("area_ha"), F.col("lakeid"))).alias("n_lakes"),
        F.max("cluster_lake_n").alias("cluster_lake_n"))
    per_a = (nat.join(v.select("wrid", F.col("vid").alias("src"), "cluster"), ["wrid", "src"])
             .groupBy("wrid", "cluster").agg(F.count("*").alias("n_arcs")))
    out = per_v.join(per_a, ["wrid", "cluster"], "left").fillna(0, ["n_arcs"])
    return out.select("wrid", "cluster", F.col("n_vertices").cast("long"),
                      F.col("n_arcs").cast("long"), F.col("n_lakes").cast("long"),
                      combination_count("n_lakes").alias("n_pairs"),
                      (F.col("n_lakes") != F.col("cluster_lake_n")).alias("lake_count_differs"))
