"""The ``gis`` section: from catchments, lakes, streams and a terrain model
to the inputs of the network compilation, for all regions at once.

select streams and lakes per region (J1, J2) -> islands dropped (A1) -> line
ends snapped (G1) and lines merged where just two meet (G2) -> streams cut at
lakes (J12) -> contiguous pieces chained into lines -> nodes at line
ends (G3) -> nearest lake per node (J4, ``snap``) -> node ids for non-lake
nodes (X5) -> lake areas (A2, J5) -> cells under each line (J14) with
altitude and local slope (R1) -> per-line profiles (A4, A5) -> lake borders
(J9) -> lengths (A3).

Geometry ids inside the section are ``struct(wrid, id)``, so a stream that
crosses two regions is processed once per region, like one run per region of
the reference, and only lakes of the same region cut it or attract its nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import raster as RS
from ..operators import spatial as G
from ..operators.ids import consecutive_ids
from ..operators.iterate import cut
from ..operators.network import STAT_COLUMNS, assign_node_lake, attach_lake_area, edge_table
from ..sources import io


def _keyed(vertices: DataFrame, pairs: DataFrame) -> DataFrame:
    """Vertices of features with ``fid`` replaced by ``struct(wrid, id)``."""
    j = vertices.join(pairs.select(F.col("id").alias("fid"), "wrid"), "fid")
    return j.withColumn("fid", F.struct("wrid", F.col("fid").alias("id"))).drop("wrid")


def joined_streams(streams: DataFrame, snap: float | None = 1.0, merge: bool = True) -> DataFrame:
    """Line vertices with ``fid`` = ``struct(wrid, id)`` after line ends
    closer than ``snap`` metres were made one point (None: no snapping) and, with
    ``merge``, lines that meet where just two line ends meet became one line with
    the id and part of its first.  Only ends are snapped: the vertices of a
    densely drawn line would all become one."""
    v = streams.select("fid", "part", "seq", "x", "y")
    first = v.groupBy("fid", "part").agg(F.min("seq").alias("low"), F.max("seq").alias("high"))
    v = v.join(first, ["fid", "part"])
    if snap is not None:
        ends = v.where((F.col("seq") == F.col("low")) | (F.col("seq") == F.col("high"))).select(
            F.col("fid.wrid").alias("wrid"), F.struct("fid", "part", "seq").alias("pid"), "x", "y")
        moved = G.snap_points(ends, snap, keys=("wrid",)).select(
            F.col("pid.fid").alias("fid"), F.col("pid.part").alias("part"), F.col("pid.seq").alias("seq"),
            F.col("x").alias("sx"), F.col("y").alias("sy"))
        v = v.join(moved, ["fid", "part", "seq"], "left").withColumns(
            {"x": F.coalesce("sx", "x"), "y": F.coalesce("sy", "y")}).drop("sx", "sy")
    v = cut(v, "snapped")
    if not merge:
        return v.select("fid", "part", "seq", "x", "y")
    line = F.struct(F.col("fid.id").alias("id"), "part")
    cats = cut(consecutive_ids(v.select(F.col("fid.wrid").alias("wrid"), line.alias("line")).distinct(),
                               "line", keys=("wrid",), out="cat"), "stream_cats")
    keyed = cut(v.withColumns({"wrid": F.col("fid.wrid"), "line": line, "seq": F.col("seq") - F.col("low")})
                .join(cats, ["wrid", "line"]).select("wrid", F.col("cat").alias("fid"), "seq", "x", "y",
                                                     (F.col("high") - F.col("low") == F.col("seq")).alias("is_last")), "stream_points")
    ends = (keyed.where("seq = 0 OR is_last").groupBy("wrid", "fid")
            .agg(F.min_by(F.struct("x", "y"), "seq").alias("a"), F.max_by(F.struct("x", "y"), "seq").alias("b")))
    points = ends.select("wrid", F.col("a").alias("xy")).union(ends.select("wrid", "b")).distinct()
    nodes = cut(consecutive_ids(points, "xy", keys=("wrid",), out="node"), "stream_nodes")
    at = {e: nodes.select("wrid", F.col("xy").alias(e), F.col("node").alias(n)) for e, n in (("a", "from_node"), ("b", "to_node"))}
    topology = cut(ends.join(at["a"], ["wrid", "a"]).join(at["b"], ["wrid", "b"])
                   .select("wrid", F.col("fid").alias("line_cat"), "from_node", "to_node"), "stream_topology")
    merged = G.merged_points(cut(G.chain_lines(topology), "stream_chains"), keyed)
    return (merged.join(cats.withColumnRenamed("cat", "chain"), ["wrid", "chain"])
            .select(F.struct("wrid", F.col("line.id").alias("id")).alias("fid"), F.col("line.part").alias("part"),
                    "seq", "x", "y"))


def gis_section(catchments: DataFrame, lakes: DataFrame, streams: DataFrame,
                dem: DataFrame | None = None, wrids=None, snap: float = 1.0,
                resolution: float = 10.0, size: float = 1000.0, snap_lines: float | None = 1.0,
                merge: bool = True) -> dict[str, DataFrame]:
    """Returns ``lines(wrid, line_cat, from_node, to_node, length_m)``,
    ``nodes(wrid, node_id, lakeid, area_ha)``, ``edges(wrid, cat, length_m,
    stats)``, ``adjacency(wrid, left_lake, right_lake)`` and ``pieces``.

    ``catchments``/``lakes``: polygon vertices with ``fid`` = region id /
    lake id; ``streams``: line vertices; ``dem``: cells ``(row, col, z)`` of
    ``resolution`` metres with the origin at (0, 0).  ``snap`` is the reach of
    lakes for nodes; ``snap_lines`` and ``merge`` as in :func:`joined_streams`.  ``size``: grid
    cells of the joins with the catchments; those with the lakes choose theirs."""
    sw = G.lines_in_polygons(streams, catchments, size).select(
        F.col("line").alias("id"), F.col("polygon").alias("wrid"))
    lw = G.polygons_intersect(lakes, catchments, size).select(
        F.col("a").alias("id"), F.col("b").alias("wrid"))
    if wrids is not None:
        sw, lw = io.select_region(sw, wrids, "wrid"), io.select_region(lw, wrids, "wrid")
    sw, lw = cut(sw, "streams_in_regions"), cut(lw, "lakes_in_regions")
    streams_k = cut(joined_streams(_keyed(streams, sw), snap_lines, merge), "streams")
    lakes_k = cut(_keyed(G.exterior_lakes(lakes, size), lw), "lakes_ext")   # islands filled
    lakes_full_k = cut(_keyed(lakes, lw), "lakes")                          # for the area

    pieces = cut(G.clip_lines_outside(streams_k, lakes_k, key="wrid"), "pieces")
    # chain contiguous pieces of one stream into one line
    w = Window.partitionBy("fid", "part").orderBy("seq", "t0")
    start = (F.lag("seq").over(w).isNull() | (F.col("t0") > 0)
             | (F.lag("seq").over(w) != F.col("seq") - 1) | (F.lag("t1").over(w) < 1))
    pieces = pieces.withColumn("start", start.cast("int"))
    pieces = pieces.withColumn("line_no", F.sum("start").over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    pieces = pieces.select(F.col("fid.wrid").alias("wrid"), F.col("fid.id").alias("stream"),
                           "part", "line_no", "seq", "t0", "x1", "y1", "x2", "y2")
    per_line = pieces.groupBy("wrid", "stream", "part", "line_no").agg(
        F.min(F.struct("seq", "t0", "x1", "y1")).alias("a"),
        F.max(F.struct("seq", "t0", "x2", "y2")).alias("b"),
        F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))).alias("length_m"))
    per_line = consecutive_ids(per_line.withColumn("k", F.struct("stream", "part", "line_no")),
                               "k", keys=("wrid",), out="line_cat")
    ends = (per_line.select("wrid", F.col("a.x1").alias("x"), F.col("a.y1").alias("y"))
            .unionByName(per_line.select("wrid", F.col("b.x2").alias("x"), F.col("b.y2").alias("y")))
            .distinct().withColumn("xy", F.struct("x", "y")))
    node_ids = cut(consecutive_ids(ends, "xy", keys=("wrid",), out="node_id").drop("xy"), "node_ids")
    fr = node_ids.select("wrid", F.col("x").alias("ax"), F.col("y").alias("ay"),
                         F.col("node_id").alias("from_node"))
    to = node_ids.select("wrid", F.col("x").alias("bx"), F.col("y").alias("by"),
                         F.col("node_id").alias("to_node"))
    lines = (per_line.select("wrid", "line_cat", "stream", "part", "line_no", "length_m",
                             F.col("a.x1").alias("ax"), F.col("a.y1").alias("ay"),
                             F.col("b.x2").alias("bx"), F.col("b.y2").alias("by"))
             .join(fr, ["wrid", "ax", "ay"]).join(to, ["wrid", "bx", "by"]))
    lines = cut(lines.select("wrid", "line_cat", "stream", "part", "line_no", "from_node",
                             "to_node", "length_m"), "lines")

    # nodes: nearest lake within the snap distance, else an id above all lakes
    pts = node_ids.select(F.struct("wrid", F.col("node_id").alias("id")).alias("pid"), "x", "y")
    near = cut(G.nearest_polygon(pts, lakes_k, dmax=snap, key="wrid"), "near")
    nodes = near.select(F.col("pid.wrid").alias("wrid"), F.col("pid.id").alias("node_id"),
                        F.col("lakeid.id").alias("lakeid"))
    nodes = assign_node_lake(nodes, lakes_full_k.select(
        F.col("fid.wrid").alias("wrid"), F.col("fid.id").alias("lakeid")).distinct())
    areas = G.polygon_area_ha(lakes_full_k).select(
        F.col("fid.wrid").alias("wrid"), F.col("fid.id").alias("lakeid"), "area_ha")
    nodes = cut(attach_lake_area(nodes, areas).select("wrid", "node_id", "lakeid", "area_ha"), "nodes")

    border = G.shared_borders(lakes_k, key="wrid").select(
        F.col("left_lake.wrid").alias("wrid"), F.col("left_lake.id").alias("left_lake"),
        F.col("right_lake.id").alias("right_lake"))

    line_keys = pieces.join(lines.select("wrid", "stream", "part", "line_no", "line_cat"),
                            ["wrid", "stream", "part", "line_no"])
    if dem is not None:
        segs = line_keys.select(F.struct("wrid", "line_cat").alias("fid"), "x1", "y1", "x2", "y2")
        on = RS.cells_of_lines(segs, resolution).select(
            F.col("fid.wrid").alias("wrid"), F.col("fid.line_cat").alias("line_cat"), "row", "col")
        on = on.join(dem.select("row", "col", "z"), ["row", "col"])
        mask = on.select("wrid", "row", "col", "z").distinct().withColumn("cat", F.lit(1))
        slope = RS.local_slope(mask, resolution, resolution, keys=("wrid",))
        samples = (on.join(slope, ["wrid", "row", "col"])
                   .select("wrid", "line_cat", F.col("z").alias("altitude"), "slope"))
        edges = edge_table(lines, samples)
    else:
        edges = lines.select("wrid", F.col("line_cat").alias("cat"), "length_m").withColumns(
            {c: F.lit(0.0) for c in STAT_COLUMNS})
    return {"lines": lines.drop("stream", "part", "line_no"), "nodes": nodes, "edges": edges,
            "adjacency": border, "pieces": line_keys}
