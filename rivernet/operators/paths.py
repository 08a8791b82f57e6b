"""lake_combinations (G8-G11, A10-A12, X7, X13, J11): for every pair of lakes
of a cluster, the path between them and its upstream / downstream statistics.

Path choice (the reference leaves it open, Q2/Q3): fewest arcs, then the
shortest length in whole millimetres, then the smallest list of arc ids, an
arc id being ``struct(dst, lab, cat, src)`` with ``lab`` 0 for an arc walked
with the flow and 1 against it, ``cat`` the stream line (-1 on a lake
border).  Arcs are only walked forward; the reversed copies of G5 make every
undirected move possible, and their label says which way the water runs.

The search is a layered BFS from all sources of all clusters at once: each
level joins the frontier with the arcs and with a precomputed table of the
best two-arc steps (so a level advances one or two arcs and the number of
levels halves), anti-joins the vertices already reached from that source,
and keeps ``min(struct(hops, cost, length, arc_ids))`` per ``(wrid, src, v)``.
Hops and lengths add up and equal-hop arc lists have equal length, so the
best path's prefix is the prefix's best path; the best two-arc step between
two vertices does not depend on what comes before it.  Both make the
level-wise minimum exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import MISSING, is_lake, slope_to_cdeg, weighted_avg
from .forest import split_network, tree_combinations
from .iterate import Layers, merged
from .network import Network

DIRECTION_FIELDS = ["length", "altitude_min", "altitude_mean", "altitude_max", "slope_mean",
                    "slope_third_quart", "slope_perc_90", "slope_perc_90_max", "slope_max",
                    "slope_max_max", "slope_stddev"]
COMBINATION_COLUMNS = (["wrid", "from_lake", "to_lake", "cluster", "lakes_along",
                        "confluences_along", "total_stream_length", "total_slope_max_max"]
                       + [f"{d}_{f}" for d in ("upstream", "downstream") for f in DIRECTION_FIELDS])


def walk_arcs(network: Network) -> DataFrame:
    """Arcs as walked by the search: ``(wrid, a, b, lab, cat, len_mm, ...stats)``."""
    return network.arcs.select(
        "wrid", F.col("src").alias("a"), F.col("dst").alias("b"),
        F.when(F.col("direction") == "upstream", 1).otherwise(0).alias("lab"),
        F.col("line_cat").alias("cat"),
        F.round(F.col("length_m") * 1000).cast("long").alias("len_mm"),
        "length_m", "altitude_minimum", "altitude_average", "altitude_maximum",
        "slope_average", "slope_third_quartile", "slope_percentile_90", "slope_maximum",
        "slope_stddev", "dir_weight")


def shortest_paths(arcs: DataFrame, sources: DataFrame, weight: str | None = None) -> DataFrame:
    """Best path from each source to every reachable vertex.

    ``arcs`` from :func:`walk_arcs` (or any frame with ``wrid, a, b, lab,
    cat, len_mm``); ``sources(wrid, src)``.  Returns ``(wrid, src, v, hops,
    len_mm, arc_ids)``.  ``weight`` names a column of weights >= 0 whose sum
    ranks first; a path of more arcs can then be better, so a vertex is walked
    on from again whenever its best path has improved, until none does.
    """
    spark = arcs.sparkSession
    step_t = "struct<dst:bigint,lab:int,cat:bigint,src:bigint>"
    one = arcs.select("wrid", F.col("a").alias("v"), "b",
                      F.array(F.struct(F.col("b").cast("long").alias("dst"),
                                       F.col("lab").cast("int").alias("lab"),
                                       F.col("cat").cast("long").alias("cat"),
                                       F.col("a").cast("long").alias("src"))).alias("steps"),
                      F.col("len_mm").alias("alen"),
                      (F.col(weight) if weight else F.lit(0)).cast("long").alias("wt"))
    # the best two-arc step between two vertices does not depend on the path
    # before it, so the two-arc table keeps one entry per (v, b)
    first = one.withColumnsRenamed({"b": "_m"})
    second = one.select("wrid", F.col("v").alias("_m"), F.col("b").alias("b2"),
                        F.col("steps").alias("s2"), F.col("alen").alias("l2"), F.col("wt").alias("w2"))
    two = (first.join(merged(second), ["wrid", "_m"])
           .groupBy("wrid", "v", F.col("b2").alias("b"))
           .agg(F.min(F.struct((F.col("wt") + F.col("w2")).alias("wt"),
                               (F.col("alen") + F.col("l2")).alias("alen"),
                               F.concat("steps", "s2").alias("steps"))).alias("m"))
           .select("wrid", "v", "b", F.lit(2).alias("h"), "m.wt", "m.alen", "m.steps"))
    w = (one.select("wrid", "v", "b", F.lit(1).alias("h"), "wt", "alen", "steps")
         .unionByName(two).repartition("wrid", "v").persist())
    near = merged(w)
    order = (["hops", "cost", "len_mm", "arc_ids"] if weight is None
             else ["cost", "hops", "len_mm", "arc_ids"])
    layers = Layers(spark, "paths", ["wrid", "src", "v"])
    seeds = (sources.select("wrid", "src").distinct()
             .select("wrid", "src", F.col("src").alias("v"), F.lit(0).alias("hops"),
                     F.lit(0).cast("long").alias("cost"), F.lit(0).cast("long").alias("len_mm"),
                     F.expr(f"CAST(array() AS array<{step_t}>)").alias("arc_ids")))
    frontier = layers.append(seeds, 0)
    level = 0
    while True:
        level += 1
        cand = frontier.join(near, ["wrid", "v"]).select(
            "wrid", "src", F.col("b").alias("v"),
            (F.col("hops") + F.col("h")).alias("hops"),
            (F.col("cost") + F.col("wt")).alias("cost"),
            (F.col("len_mm") + F.col("alen")).alias("len_mm"),
            F.concat("arc_ids", "steps").alias("arc_ids"))
        if weight is None:  # found earlier is found with fewer arcs
            cand = cand.join(layers.all().select("wrid", "src", "v"), ["wrid", "src", "v"], "left_anti")
        best = cand.groupBy("wrid", "src", "v").agg(F.min(F.struct(*order)).alias("p"))
        if weight is not None:
            old = (layers.all().groupBy("wrid", "src", "v").agg(F.min(F.struct(*order)).alias("old")))
            best = (best.join(merged(old), ["wrid", "src", "v"], "left")
                    .where(F.col("old").isNull() | (F.col("p") < F.col("old"))))
        best = best.select("wrid", "src", "v", "p.hops", "p.cost", "p.len_mm", "p.arc_ids")
        frontier = layers.append(best, level)
        if not layers.has(level):
            break
    w.unpersist()
    if weight is None:
        return layers.all().select("wrid", "src", "v", "hops", "len_mm", "arc_ids")
    return (layers.all().groupBy("wrid", "src", "v").agg(F.min(F.struct(*order)).alias("p"))
            .select("wrid", "src", "v", "p.hops", "p.len_mm", "p.arc_ids"))


def lake_vertices(network: Network, focal: DataFrame | None = None) -> DataFrame:
    """Pair ends: the lakes of each kept cluster (X6), or the focal lakes."""
    v = network.vertices
    if focal is None:
        return v.where(is_lake("area_ha")).select("wrid", "cluster", "vid")
    f = focal.select("wrid", F.col("lakeid").alias("vid")).distinct()
    return v.join(f, ["wrid", "vid"], "left_semi").select("wrid", "cluster", "vid")


def prune_to_paths(network: Network, ends: DataFrame, arcs: DataFrame) -> DataFrame:
    """Arcs of the subgraph induced by the vertices on the best paths from
    the smallest pair end of each cluster to all the others."""
    roots = ends.groupBy("wrid", "cluster").agg(F.min("vid").alias("src"))
    p = shortest_paths(arcs, roots.select("wrid", "src"))
    p = p.join(ends.select("wrid", F.col("vid").alias("v")), ["wrid", "v"], "left_semi")
    keep = merged(p.select("wrid", F.explode(F.array_append(
                F.transform("arc_ids", lambda x: x["dst"]), F.col("src"))).alias("vid"))
            .distinct())
    a = arcs.join(keep.withColumnRenamed("vid", "a"), ["wrid", "a"], "left_semi")
    return a.join(keep.withColumnRenamed("vid", "b"), ["wrid", "b"], "left_semi")


def path_arcs(paths: DataFrame, arcs: DataFrame) -> DataFrame:
    """Long form of the chosen paths, one row per arc with attributes."""
    e = paths.select("wrid", F.col("src").alias("from_lake"), F.col("v").alias("to_lake"),
                     F.posexplode("arc_ids").alias("seq", "arc"))
    e = e.select("wrid", "from_lake", "to_lake", "seq", F.col("arc.src").alias("a"),
                 F.col("arc.dst").alias("b"), F.col("arc.lab").alias("lab"),
                 F.col("arc.cat").alias("cat"))
    return e.join(merged(arcs), ["wrid", "a", "b", "lab", "cat"])


def _direction_stats(lab: int, prefix: str) -> list:
    on = F.col("lab") == lab

    def c(name):
        return F.when(on, F.col(name))

    n = F.count(F.when(on, 1))
    length = c("length_m")
    vals = [
        F.round(F.sum(F.when(on, F.col("len_mm"))) / 1000).cast("int"),
        F.round(F.min(c("altitude_minimum"))).cast("int"),
        F.round(weighted_avg(c("altitude_average"), length)).cast("int"),
        F.round(F.max(c("altitude_maximum"))).cast("int"),
        slope_to_cdeg(weighted_avg(c("slope_average"), length)),
        slope_to_cdeg(weighted_avg(c("slope_third_quartile"), length)),
        slope_to_cdeg(weighted_avg(c("slope_percentile_90"), length)),
        slope_to_cdeg(F.max(c("slope_percentile_90"))),
        slope_to_cdeg(weighted_avg(c("slope_maximum"), length)),
        slope_to_cdeg(F.max(c("slope_maximum"))),
        slope_to_cdeg(weighted_avg(c("slope_stddev"), length)),
    ]
    return [F.when(n > 0, x).otherwise(F.lit(MISSING)).alias(f"{prefix}_{f}")
            for x, f in zip(vals, DIRECTION_FIELDS)]


def lake_combinations(network: Network, focal: DataFrame | None = None,
                      weight: str | None = None) -> DataFrame:
    """One row per lake pair ``from_lake < to_lake`` of a cluster, 30
    columns; an absent direction holds -9999 in its 11 columns (X13).

    Tree clusters need no search (``forest``); the path search runs over the
    others."""
    trees, others = split_network(network)
    parts = []
    if not trees.vertices.isEmpty():
        parts.append(tree_combinations(trees, lake_vertices(trees, focal), weight))
    if not parts or not others.vertices.isEmpty():
        parts.append(searched_combinations(others, focal, weight))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.select(*COMBINATION_COLUMNS)


def searched_combinations(network: Network, focal: DataFrame | None = None,
                          weight: str | None = None) -> DataFrame:
    """:func:`lake_combinations` of any clusters, by the path search."""
    ends = lake_vertices(network, focal)
    arcs = walk_arcs(network)
    pruned = prune_to_paths(network, ends, arcs)
    paths = shortest_paths(pruned, ends.select("wrid", F.col("vid").alias("src")), weight=weight)
    paths = (paths.join(ends.select("wrid", F.col("vid").alias("v"), "cluster"), ["wrid", "v"])
             .where(F.col("v") > F.col("src")))
    long_form = path_arcs(paths, arcs)
    stats = long_form.groupBy("wrid", "from_lake", "to_lake").agg(
        F.round(F.sum("len_mm") / 1000).cast("int").alias("total_stream_length"),
        slope_to_cdeg(F.max("slope_maximum")).alias("total_slope_max_max"),
        *_direction_stats(1, "upstream"), *_direction_stats(0, "downstream"))
    # vertices along: the start and the head of every arc
    vinfo = network.vertices.select("wrid", F.col("vid").alias("x"),
                                    is_lake("area_ha").alias("lake"), "typ")
    along = (paths.select("wrid", F.col("src").alias("from_lake"), F.col("v").alias("to_lake"),
                          F.explode(F.array_append(F.transform("arc_ids", lambda x: x["dst"]),
                                                   F.col("src"))).alias("x"))
             .join(vinfo, ["wrid", "x"])
             .groupBy("wrid", "from_lake", "to_lake")
             .agg(F.array_join(F.array_sort(F.collect_set(F.when(F.col("lake"), F.col("x")))), ",")
                  .alias("lakes_along"),
                  F.array_join(F.array_sort(F.collect_set(F.when(F.col("typ") == 3, F.col("x")))), ",")
                  .alias("confluences_along")))
    pairs = paths.select("wrid", F.col("src").alias("from_lake"), F.col("v").alias("to_lake"),
                         "cluster")
    out = pairs.join(merged(along), ["wrid", "from_lake", "to_lake"]).join(
        merged(stats), ["wrid", "from_lake", "to_lake"])
    return out.select(*COMBINATION_COLUMNS)


def lake_pairs(ends: DataFrame) -> DataFrame:
    """J11 + O3: all unordered lake pairs of a cluster, ``from_lake <
    to_lake``.  The equi-join on ``(wrid, cluster)`` is where a very large
    cluster concentrates; AQE's skew-join split handles the hot key."""
    a = ends.select("wrid", "cluster", F.col("vid").alias("from_lake"))
    b = ends.select("wrid", "cluster", F.col("vid").alias("to_lake"))
    return a.join(b, ["wrid", "cluster"]).where(F.col("from_lake") < F.col("to_lake"))
