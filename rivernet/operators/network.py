"""Network compilation: from lines, nodes, edge statistics and lake borders
to a directed lake graph (vertices, arcs) for all water regions at once.

Inventory rows: J5-J8, J10, G4, G5, A4-A8, X4, X8-X11, X15, U1-U3.
Every join key starts with ``wrid``; ids are unique inside a region only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import (STATS, classify_vertex, direction_weight, exact_avg, exact_sum,
                               fill_edge_stats, is_lake)
from .iterate import connected_components, cut, merged

STAT_COLUMNS = [f"{p}_{s}" for p in ("altitude", "slope") for s in STATS]
ARC_COLUMNS = ["wrid", "src", "dst", "line_cat", "direction", "dir_weight",
               "length_m", *STAT_COLUMNS]
VERTEX_COLUMNS = ["wrid", "vid", "lakeid", "area_ha", "cluster", "indegree", "outdegree",
                  "typ", "cluster_lake_area_ha", "cluster_lake_n"]


@dataclass(frozen=True)
class Network:
    """The compiled graph: one row per vertex, one row per arc (both ways)."""
    vertices: DataFrame
    arcs: DataFrame


def _quantiles(sorted_values, n, prefix: str, quantiles: str) -> list:
    """Quartiles, median and 90th percentile picked from a sorted array.

    Nearest rank (``percentile_disc``): the value at 1-based position
    ``ceil(p * n)``, computed in integers so that 0.9 * 10 is 9, not 9.000..2.
    The median (and ``quantiles="cont"``) interpolates between the two
    neighbouring ranks: ``lo + f * (hi - lo)`` at position ``p * (n - 1)``."""
    def at(pos):                      # 0-based position
        return F.element_at(sorted_values, (pos + 1).cast("int"))

    def disc(k, d):                   # p = k / d
        return at(F.floor((n * k + d - 1) / d) - 1)

    def cont(k, d):
        pos = (n - 1) * k / d
        lo = F.floor(pos)
        f = pos - lo
        a, b = at(lo), at(F.ceil(pos))
        return a + f * (b - a)

    q = disc if quantiles == "disc" else cont
    return [q(1, 4).alias(f"{prefix}_first_quartile"), cont(1, 2).alias(f"{prefix}_median"),
            q(3, 4).alias(f"{prefix}_third_quartile"), q(9, 10).alias(f"{prefix}_percentile_90")]


def edge_profiles(samples: DataFrame, columns, keys=("wrid", "cat"), quantiles: str = "disc",
                  deviation: str = "pop", fixed_scale: int | None = None) -> DataFrame:
    """A4/A5: nine statistics per edge for each ``(value column, prefix)``,
    all from one aggregation (one shuffle of the samples).  The samples move as
    they are: the lists of an edge whose samples lie all over the input would
    be made, sorted and shuffled once for nearly each of its samples.

    Quartiles and the 90th percentile are nearest-rank by default,
    ``quantiles="cont"`` interpolates; the median is the usual interpolated
    median; stddev/variance are population figures unless ``deviation="samp"``.
    The quantiles come from one sorted array per edge (an edge holds the
    cells along one line, bounded by its length); everything else is a plain
    partial aggregate.  ``fixed_scale`` sums the average as integers of
    ``10^-fixed_scale`` so the mean is the same for any partitioning.
    """
    sd = F.stddev_pop if deviation == "pop" else F.stddev_samp
    var = F.var_pop if deviation == "pop" else F.var_samp
    aggs, outs = [], []
    for value, prefix in columns:
        v = F.col(value)
        aggs += [
            F.min(v).alias(f"{prefix}_minimum"),
            F.max(v).alias(f"{prefix}_maximum"),
            (F.avg(v) if fixed_scale is None else exact_avg(v, fixed_scale)).alias(f"{prefix}_average"),
            sd(v).alias(f"{prefix}_stddev"),
            var(v).alias(f"{prefix}_variance"),
            F.array_sort(F.collect_list(v)).alias(f"_{prefix}_sorted"),
            F.count(v).alias(f"_{prefix}_n"),
        ]
        outs += [f"{prefix}_minimum", f"{prefix}_maximum", f"{prefix}_average",
                 f"{prefix}_stddev", f"{prefix}_variance",
                 *_quantiles(F.col(f"_{prefix}_sorted"), F.col(f"_{prefix}_n"), prefix, quantiles)]
    return (samples.select(*keys, *dict.fromkeys(value for value, _ in columns)).repartition(*keys)
            .groupBy(*keys).agg(*aggs).select(*keys, *outs))


def edge_profile(samples: DataFrame, value: str, prefix: str, keys=("wrid", "cat"),
                 quantiles: str = "disc", deviation: str = "pop",
                 fixed_scale: int | None = None) -> DataFrame:
    """A4 or A5 alone: nine statistics of one value column per edge."""
    return edge_profiles(samples.where(F.col(value).isNotNull()), [(value, prefix)], keys,
                         quantiles, deviation, fixed_scale)


def edge_table(lines: DataFrame, samples: DataFrame, keys=("wrid",),
               fixed_scale: int | None = None) -> DataFrame:
    """Edges = lines with their altitude and slope profiles.

    ``samples`` has ``keys + [line_cat, altitude, slope]``; lines without
    samples get 0 statistics, as NaN/NULL become 0 in the reference."""
    k = list(keys)
    stats = edge_profiles(samples, [("altitude", "altitude"), ("slope", "slope")],
                          keys=(*k, "line_cat"), fixed_scale=fixed_scale)
    e = (lines.select(*k, "line_cat", "length_m")
         .join(merged(stats), [*k, "line_cat"], "left")
         .withColumnRenamed("line_cat", "cat"))
    return fill_edge_stats(e, STAT_COLUMNS)


def collapse_lakes(lines: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """G4 with J6: vertices are lake ids, so all in- and outlets of a lake
    merge; arcs run between lake ids.

    ``lines(wrid, line_cat, from_node, to_node)``, ``nodes(wrid, node_id,
    lakeid, area_ha)``.  Returns ``(vertices(wrid, vid, lakeid, area_ha),
    arcs(wrid, src, dst, line_cat))``.
    """
    lid = merged(nodes.select("wrid", "node_id", "lakeid"))
    fr = lid.withColumnsRenamed({"node_id": "from_node", "lakeid": "src"})
    to = lid.withColumnsRenamed({"node_id": "to_node", "lakeid": "dst"})
    arcs = (lines.select("wrid", "line_cat", "from_node", "to_node")
            .join(fr, ["wrid", "from_node"])
            .join(to, ["wrid", "to_node"])
            .select("wrid", "src", "dst", "line_cat"))
    vertices = (nodes.groupBy("wrid", F.col("lakeid").alias("vid"))
                .agg(F.max("area_ha").alias("area_ha"))
                .withColumn("lakeid", F.col("vid"))
                .select("wrid", "vid", "lakeid", "area_ha"))
    return vertices, arcs


def attach_edge_attrs(arcs: DataFrame, edges: DataFrame) -> DataFrame:
    """Statistics onto arcs by ``(wrid, line_cat = cat)``; X8 tag."""
    e = edges.select("wrid", F.col("cat").alias("line_cat"), "length_m", *STAT_COLUMNS)
    out = arcs.join(merged(e), ["wrid", "line_cat"], "left")
    out = out.withColumn("length_m", F.coalesce("length_m", F.lit(0.0)))
    return fill_edge_stats(out, STAT_COLUMNS).withColumn("direction", F.lit("downstream"))


def drop_self_loops(arcs: DataFrame) -> DataFrame:
    """Loops left after the lake collapse."""
    return arcs.where(F.col("src") != F.col("dst"))


def append_adjacency_arcs(vertices: DataFrame, arcs: DataFrame,
                          adjacency: DataFrame) -> tuple[DataFrame, DataFrame]:
    """J10 (+U1): each bordering lake pair links both ways where that arc
    does not exist yet; new arcs carry 0 statistics, ``line_cat`` -1 and
    ``direction='downstream'``.  Lakes only known from borders become
    vertices without attributes (no area, so no lake: Q6)."""
    pairs = adjacency.where((F.col("left_lake") > 0) & (F.col("right_lake") > 0))
    both = (pairs.select("wrid", F.col("left_lake").alias("src"), F.col("right_lake").alias("dst"))
            .unionByName(pairs.select("wrid", F.col("right_lake").alias("src"),
                                      F.col("left_lake").alias("dst")))
            .where(F.col("src") != F.col("dst"))
            .distinct())
    new = both.join(merged(arcs.select("wrid", "src", "dst")), ["wrid", "src", "dst"], "left_anti")
    new = new.withColumns({
        "line_cat": F.lit(-1).cast("long"),
        "length_m": F.lit(0.0),
        **{c: F.lit(0.0) for c in STAT_COLUMNS},
        "direction": F.lit("downstream"),
    })
    arcs = arcs.unionByName(new.select(*arcs.columns))
    ids = (pairs.select("wrid", F.col("left_lake").alias("vid"))
           .unionByName(pairs.select("wrid", F.col("right_lake").alias("vid"))).distinct())
    missing = (ids.join(merged(vertices.select("wrid", "vid")), ["wrid", "vid"], "left_anti")
               .withColumns({"lakeid": F.lit(None).cast("long"),
                             "area_ha": F.lit(None).cast("double")}))
    vertices = vertices.unionByName(missing.select(*vertices.columns))
    return vertices, arcs


def degrees(vertices: DataFrame, arcs: DataFrame) -> DataFrame:
    """A7 + X11: in/out degree (parallel arcs count) and vertex type."""
    outd = arcs.groupBy("wrid", F.col("src").alias("vid")).agg(F.count("*").alias("outdegree"))
    ind = arcs.groupBy("wrid", F.col("dst").alias("vid")).agg(F.count("*").alias("indegree"))
    v = (vertices.join(merged(ind), ["wrid", "vid"], "left").join(merged(outd), ["wrid", "vid"], "left")
         .withColumns({"indegree": F.coalesce("indegree", F.lit(0)).cast("int"),
                       "outdegree": F.coalesce("outdegree", F.lit(0)).cast("int")}))
    return v.withColumn("typ", classify_vertex("indegree", "outdegree"))


def cluster_stats(vertices: DataFrame) -> DataFrame:
    """Lake area sum and distinct lake count of each cluster, on every vertex."""
    lake = is_lake("area_ha")
    per = vertices.groupBy("wrid", "cluster").agg(
        F.coalesce(exact_sum(F.when(lake, F.col("area_ha"))), F.lit(0.0)).alias("cluster_lake_area_ha"),
        F.count_distinct(F.when(lake, F.col("lakeid"))).cast("int").alias("cluster_lake_n"))
    return vertices.join(merged(per), ["wrid", "cluster"])


def drop_small_clusters(vertices: DataFrame, arcs: DataFrame,
                        min_lakes: int = 2) -> tuple[DataFrame, DataFrame]:
    """Clusters with fewer than ``min_lakes`` lakes go, with their arcs."""
    v = vertices.where(F.col("cluster_lake_n") >= min_lakes)
    a = arcs.join(merged(v.select("wrid", F.col("vid").alias("src"))), ["wrid", "src"], "left_semi")
    return v, a


def add_reverse_arcs(arcs: DataFrame, weigh_reversed: bool = False) -> DataFrame:
    """G5 (+X8, X9, U3): every arc copied with ends swapped, ``upstream``.

    ``dir_weight`` (X9) is set before the reversed arcs exist, so these copy
    the 0 of their arc, as in the reference (Q2); with ``weigh_reversed`` they
    get the 1 that is meant for going against the flow."""
    fwd = (arcs.withColumn("direction", F.lit("downstream"))
           .withColumn("dir_weight", direction_weight()))
    rev = fwd.select(*[F.col("dst").alias("src") if c == "src" else
                        F.col("src").alias("dst") if c == "dst" else
                        F.lit("upstream").alias("direction") if c == "direction" else
                        direction_weight(F.lit("upstream")).alias(c) if c == "dir_weight" and weigh_reversed else F.col(c)
                        for c in fwd.columns])
    return fwd.unionByName(rev)


def compile_network(lines: DataFrame, nodes: DataFrame, edges: DataFrame,
                    adjacency: DataFrame | None = None, min_lakes: int = 2,
                    fill_area: bool = False, weigh_reversed: bool = False) -> Network:
    """network_compilation for all regions: G4 -> J8 -> X10 -> J10 -> G7 ->
    A7/X11 -> A8 -> X15 -> G5.

    ``cluster`` is the smallest vertex id of the weak component (the
    reference numbers clusters arbitrarily; compare them as a partition).
    """
    vertices, arcs = collapse_lakes(lines, nodes)
    arcs = drop_self_loops(attach_edge_attrs(arcs, edges))
    if adjacency is not None:
        vertices, arcs = append_adjacency_arcs(vertices, arcs, adjacency)
    if fill_area:
        vertices = vertices.withColumn("area_ha", F.coalesce("area_ha", F.lit(0.0)))
    # written once, read by each step below
    vertices, arcs = merged(cut(vertices, "all-vertices")), merged(cut(arcs, "all-arcs"))
    comp = connected_components(vertices, arcs, keys=("wrid",), vertex="vid")
    v = vertices.join(comp.withColumnRenamed("component", "cluster"), ["wrid", "vid"])
    v = merged(cut(cluster_stats(degrees(v, arcs)).select(*VERTEX_COLUMNS), "vertices"))
    v, arcs = drop_small_clusters(v, arcs, min_lakes)
    arcs = merged(cut(add_reverse_arcs(arcs, weigh_reversed).select(*ARC_COLUMNS), "arcs"))
    return Network(v, arcs)


def max_lake_id(lakes: DataFrame) -> DataFrame:
    """Largest lake id per region (the offset of X5), over all of its
    lakes ``(wrid, lakeid)``, not only those that a node lies on."""
    return lakes.groupBy("wrid").agg(F.max("lakeid").alias("max_lakeid"))


def assign_node_lake(nodes: DataFrame, lakes: DataFrame, cat: str = "node_id") -> DataFrame:
    """Nodes without a lake get ``cat + max(lakeid)`` over the lakes of
    their region, so that every node has a vertex id that cannot clash with a
    lake id."""
    m = max_lake_id(lakes)
    return (nodes.join(m, "wrid", "left")
            .withColumn("lakeid", F.coalesce(F.col("lakeid"),
                                             F.col(cat) + F.coalesce("max_lakeid", F.lit(0))))
            .drop("max_lakeid"))


def attach_lake_area(nodes: DataFrame, lakes: DataFrame) -> DataFrame:
    """``area_ha`` of the node's lake (left join on ``(wrid, lakeid)``)."""
    return nodes.join(lakes.select("wrid", "lakeid", "area_ha"), ["wrid", "lakeid"], "left")
