"""Planar geometry as DataFrames (no spatial library): J1-J4, J7, J9, J12,
A1-A3, G1-G3.

Data model (metric CRS, planar maths):

* vertices of lines ``(fid, part, seq, x, y)``;
* vertices of polygons ``(fid, part, ring, seq, x, y)``, ring 0 = exterior,
  rings are not closed (the last vertex links back to the first);
* the working form is the **segment table** made by an equi-join of vertex
  ``seq`` with ``seq + 1`` (no per-feature window, so one huge feature is
  not one task).

Every binary operator is an equi-join on grid cells: each segment is
exploded over the cells its bounding box touches, a candidate pair is kept
in one cell only (the cell of the lower-left corner of the two boxes'
overlap), then tested exactly with orientation predicates.  Point-in-polygon
first finds candidate polygons by their bounding box on the grid, then counts
ray crossings against that polygon's segments in the point's horizontal band.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import work_partitions
from .doubling import chains, stored
from .iterate import connected_components, cut

# ---------------------------------------------------------------------------
# construction


def rect_rings(df: DataFrame, fid: str, x1="x1", y1="y1", x2="x2", y2="y2",
               hole_half: str | None = None, keep=()) -> DataFrame:
    """Polygon vertices of axis-parallel rectangles, optionally with a
    centred square hole of half-width ``hole_half``."""
    X1, Y1, X2, Y2 = (F.col(c) for c in (x1, y1, x2, y2))
    pt = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    ext = F.array(pt(X1, Y1), pt(X2, Y1), pt(X2, Y2), pt(X1, Y2))
    rings = F.array(F.struct(F.lit(0).alias("ring"), ext.alias("pts")))
    if hole_half:
        cx, cy, h = (X1 + X2) / 2, (Y1 + Y2) / 2, F.col(hole_half)
        hole = F.array(pt(cx - h, cy - h), pt(cx - h, cy + h), pt(cx + h, cy + h), pt(cx + h, cy - h))
        rings = F.when(F.col(hole_half).isNotNull(), F.array_append(
            rings, F.struct(F.lit(1).alias("ring"), hole.alias("pts")))).otherwise(rings)
    r = df.select(F.col(fid).alias("fid"), *keep, F.explode(rings).alias("r"))
    v = r.select("fid", *keep, F.lit(0).alias("part"), F.col("r.ring").alias("ring"),
                 F.posexplode("r.pts").alias("seq", "p"))
    return v.select("fid", *keep, "part", "ring", "seq", F.col("p.x").alias("x"),
                    F.col("p.y").alias("y"))


def polyline(df: DataFrame, fid: str, points, keep=()) -> DataFrame:
    """Line vertices from a list of (x column, y column) pairs."""
    arr = F.array(*[F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in points])
    v = df.select(F.col(fid).alias("fid"), *keep, F.posexplode(arr).alias("seq", "p"))
    return v.select("fid", *keep, F.lit(0).alias("part"), "seq", F.col("p.x").alias("x"),
                    F.col("p.y").alias("y"))


def line_segments(vertices: DataFrame) -> DataFrame:
    """``(fid, part, seq, x1, y1, x2, y2)`` from line vertices."""
    a = vertices.select("fid", "part", "seq", F.col("x").alias("x1"), F.col("y").alias("y1"))
    b = vertices.select("fid", "part", (F.col("seq") - 1).alias("seq"), F.col("x").alias("x2"),
                        F.col("y").alias("y2"))
    return a.join(b, ["fid", "part", "seq"])


def ring_segments(vertices: DataFrame) -> DataFrame:
    """``(fid, part, ring, seq, x1, y1, x2, y2)``; the last vertex links to the first."""
    k = ["fid", "part", "ring"]
    last = vertices.groupBy(*k).agg(F.max("seq").alias("last"))
    v = vertices.join(last, k)
    a = v.select(*k, "seq", "last", F.col("x").alias("x1"), F.col("y").alias("y1"))
    b = v.select(*k, F.when(F.col("seq") == 0, F.col("last")).otherwise(F.col("seq") - 1)
                 .alias("seq"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    return a.join(b, [*k, "seq"]).drop("last")


# ---------------------------------------------------------------------------
# predicates


def _orient(px, py, qx, qy, rx, ry):
    return F.signum((qx - px) * (ry - py) - (qy - py) * (rx - px))


def _on_box(px, py, qx, qy, rx, ry):
    return ((F.least(px, qx) <= rx) & (rx <= F.greatest(px, qx))
            & (F.least(py, qy) <= ry) & (ry <= F.greatest(py, qy)))


def segments_intersect(ax1, ay1, ax2, ay2, bx1, by1, bx2, by2):
    """Closed segments share at least one point (touching counts)."""
    o1 = _orient(ax1, ay1, ax2, ay2, bx1, by1)
    o2 = _orient(ax1, ay1, ax2, ay2, bx2, by2)
    o3 = _orient(bx1, by1, bx2, by2, ax1, ay1)
    o4 = _orient(bx1, by1, bx2, by2, ax2, ay2)
    return (((o1 != o2) & (o3 != o4))
            | ((o1 == 0) & _on_box(ax1, ay1, ax2, ay2, bx1, by1))
            | ((o2 == 0) & _on_box(ax1, ay1, ax2, ay2, bx2, by2))
            | ((o3 == 0) & _on_box(bx1, by1, bx2, by2, ax1, ay1))
            | ((o4 == 0) & _on_box(bx1, by1, bx2, by2, ax2, ay2)))


def _cells(df: DataFrame, size: float, pad: float = 0.0, xs=("x1", "x2"), ys=("y1", "y2")):
    """Explode each row over the grid cells its (padded) bounding box touches."""
    def lo(cs):
        return F.col(cs[0]) if len(cs) == 1 else F.least(*map(F.col, cs))

    def hi(cs):
        return F.col(cs[0]) if len(cs) == 1 else F.greatest(*map(F.col, cs))

    xlo = F.floor((lo(xs) - pad) / size)
    xhi = F.floor((hi(xs) + pad) / size)
    ylo = F.floor((lo(ys) - pad) / size)
    yhi = F.floor((hi(ys) + pad) / size)
    return (df.withColumn("gx", F.explode(F.sequence(xlo, xhi)))
            .withColumn("gy", F.explode(F.sequence(ylo, yhi))))


def _first_cell_only(size, ax, ay, bx, by):
    """Keep a candidate pair in the cell of the lower-left corner of the
    overlap of the two boxes (given the boxes' lower-left corners)."""
    return ((F.col("gx") == F.floor(F.greatest(ax, bx) / size))
            & (F.col("gy") == F.floor(F.greatest(ay, by) / size)))


def crossing_pairs(sa: DataFrame, sb: DataFrame, size: float = 1000.0) -> DataFrame:
    """Feature pairs ``(a, b)`` with at least one pair of intersecting segments."""
    A = _cells(sa.select(F.col("fid").alias("a"), "x1", "y1", "x2", "y2"), size)
    B = _cells(sb.select(F.col("fid").alias("b"), *[F.col(c).alias("b" + c) for c in
                                                     ("x1", "y1", "x2", "y2")]),
               size, xs=("bx1", "bx2"), ys=("by1", "by2"))
    j = A.join(B, ["gx", "gy"])
    c = F.col
    keep = (_first_cell_only(size, F.least(c("x1"), c("x2")), F.least(c("y1"), c("y2")),
                             F.least(c("bx1"), c("bx2")), F.least(c("by1"), c("by2")))
            & segments_intersect(c("x1"), c("y1"), c("x2"), c("y2"),
                                 c("bx1"), c("by1"), c("bx2"), c("by2")))
    return j.where(keep).select("a", "b").distinct()


def point_in_polygon(points: DataFrame, rings: DataFrame, size: float = 1000.0,
                     band: float = 100.0) -> DataFrame:
    """``(pid, fid)`` for points strictly inside (even-odd, holes count).

    ``points(pid, x, y)``; ``rings`` = polygon vertices.  Candidates come from
    the polygon bounding box on the grid; the crossing count uses only that
    polygon's segments in the point's horizontal band."""
    seg = ring_segments(rings)
    box = seg.groupBy("fid").agg(F.min(F.least("x1", "x2")).alias("bx1"),
                                 F.max(F.greatest("x1", "x2")).alias("bx2"),
                                 F.min(F.least("y1", "y2")).alias("by1"),
                                 F.max(F.greatest("y1", "y2")).alias("by2"))
    boxes = _cells(box, size, xs=("bx1", "bx2"), ys=("by1", "by2"))
    pts = points.select("pid", "x", "y").withColumns(
        {"gx": F.floor(F.col("x") / size), "gy": F.floor(F.col("y") / size)})
    cand = (pts.join(boxes, ["gx", "gy"])
            .where((F.col("x") >= F.col("bx1")) & (F.col("x") <= F.col("bx2"))
                   & (F.col("y") >= F.col("by1")) & (F.col("y") <= F.col("by2")))
            .select("pid", "fid", "x", "y"))
    return _inside(cand, seg, band)


def exterior_only(rings: DataFrame) -> DataFrame:
    """Holes filled: ring 0 of every part."""
    return rings.where(F.col("ring") == 0)


def _key_of(fid: str, key: str | None):
    """The field ``key`` of struct ids; one value for all without it."""
    return F.col(fid)[key] if key else F.lit(0)


def unlike_polygons(rings: DataFrame, key: str | None = None) -> DataFrame:
    """One of each set of polygons with the same border segments (and the same
    ``key``): the smallest id.  Borders are told apart by their number of
    segments, their box and two sums of 64-bit hashes."""
    c = [F.col(n) + 0.0 for n in ("x1", "y1", "x2", "y2")]   # -0.0 is 0.0
    h = [F.sum(F.xxhash64(F.lit(i), *c).cast("decimal(20,0)")).alias(f"h{i}") for i in range(2)]
    g = ring_segments(rings).groupBy("fid").agg(
        F.count("*").alias("n"), F.min(F.least("x1", "x2")).alias("bx1"), F.max(F.greatest("x1", "x2")).alias("bx2"),
        F.min(F.least("y1", "y2")).alias("by1"), F.max(F.greatest("y1", "y2")).alias("by2"), *h)
    one = g.groupBy(_key_of("fid", key).alias("k"), "n", "bx1", "bx2", "by1", "by2", "h0", "h1").agg(F.min("fid").alias("fid"))
    return rings.join(one.select("fid"), "fid", "left_semi")


def cell_size(seg: DataFrame, least: float = 0.0) -> float:
    """Half the median extent of the polygons with segments ``seg``: most of
    them then cover some cells whole, and few of them meet in one cell."""
    box = seg.groupBy("fid").agg(F.greatest(F.max(F.greatest("x1", "x2")) - F.min(F.least("x1", "x2")),
                                            F.max(F.greatest("y1", "y2")) - F.min(F.least("y1", "y2"))).alias("e"))
    half = box.where("e > 0").agg(F.percentile_approx("e", 0.5)).first()[0]
    return max(half / 2 if half else 1000.0, least)


def _passed_cells(df: DataFrame, size: float, pad: float = 0.0, cols=("x1", "y1", "x2", "y2")) -> DataFrame:
    """Explode segments over the grid cells they pass (come within ``pad`` of),
    column by column: as many cells as the segment is long, not its box."""
    x1, y1, x2, y2 = (F.col(n) for n in cols)
    out = df.withColumn("gx", F.explode(F.sequence(F.floor((F.least(x1, x2) - pad) / size),
                                                   F.floor((F.greatest(x1, x2) + pad) / size))))
    left, right = F.col("gx") * size - pad, (F.col("gx") + 1) * size + pad
    slope = F.try_divide(y2 - y1, x2 - x1)

    def at(x):
        return F.greatest(F.least(y1, y2), F.least(F.greatest(y1, y2), y1 + (x - x1) * slope))

    ya = F.when(x1 == x2, y1).otherwise(at(F.greatest(F.least(x1, x2), left)))
    yb = F.when(x1 == x2, y2).otherwise(at(F.least(F.greatest(x1, x2), right)))
    return out.withColumn("gy", F.explode(F.sequence(F.floor((F.least(ya, yb) - pad) / size),
                                                     F.floor((F.greatest(ya, yb) + pad) / size))))


def polygon_cells(seg: DataFrame, size: float) -> tuple[DataFrame, DataFrame]:
    """Cells that polygons with segments ``seg(k, fid, ...)`` cover whole, and
    cells with a border of theirs: two tables ``(k, fid, gx, gy)``.

    A cell without a border is covered when its centre is inside: in each row
    of cells, between every second two crossings of the line of centres."""
    border = cut(_passed_cells(seg.select("k", "fid", "x1", "y1", "x2", "y2"), size, size * 1e-6)
                 .select("k", "fid", "gx", "gy").distinct(), "border_cells")
    x1, y1, x2, y2 = (F.col(n) for n in ("x1", "y1", "x2", "y2"))
    rows = seg.select("k", "fid", "x1", "y1", "x2", "y2", F.explode(F.sequence(
        F.floor(F.least(y1, y2) / size), F.floor(F.greatest(y1, y2) / size))).alias("gy"))
    yc = (F.col("gy") + 0.5) * size
    rows = rows.where((y1 > yc) != (y2 > yc)).select(
        "k", "fid", "gy", (x1 + F.try_divide((yc - y1) * (x2 - x1), y2 - y1)).alias("x"))
    w = Window.partitionBy("k", "fid", "gy").orderBy("x")
    spans = rows.withColumns({"i": F.row_number().over(w), "to": F.lead("x").over(w)}).where("i % 2 = 1 and to is not null")
    first, last = F.floor(F.col("x") / size - 0.5) + 1, F.ceil(F.col("to") / size - 0.5) - 1
    whole = spans.where(first <= last).select("k", "fid", F.explode(F.sequence(first, last)).alias("gx"), "gy")
    return whole.join(border, ["k", "fid", "gx", "gy"], "left_anti"), border


def _inside(cand: DataFrame, seg: DataFrame, band: float) -> DataFrame:
    """Which of the candidate pairs ``(pid, fid, x, y)`` are points strictly
    inside (even-odd), by ray crossings in the point's horizontal band."""
    sb = seg.select("fid", "x1", "y1", "x2", "y2", F.explode(F.sequence(
        F.floor(F.least("y1", "y2") / band), F.floor(F.greatest("y1", "y2") / band))).alias("band"))
    j = cand.withColumn("band", F.floor(F.col("y") / band)).join(sb, ["fid", "band"])
    x, y, x1, y1, x2, y2 = (F.col(c) for c in ("x", "y", "x1", "y1", "x2", "y2"))
    crosses = ((y1 > y) != (y2 > y)) & (x < x1 + F.try_divide((y - y1) * (x2 - x1), y2 - y1))
    return (j.where(crosses).groupBy("pid", "fid").count()
            .where(F.col("count") % 2 == 1).select("pid", "fid"))


# ---------------------------------------------------------------------------
# joins


def lines_in_polygons(lines: DataFrame, polygons: DataFrame, size: float = 1000.0) -> DataFrame:
    """``(line, polygon)`` pairs that intersect: a crossing or touching of
    segments, or the line lying inside (its first vertex is inside)."""
    cross = crossing_pairs(line_segments(lines), ring_segments(polygons), size)
    first = (lines.where(F.col("seq") == 0)
             .select(F.struct("fid", "part").alias("pid"), "x", "y"))
    inside = (point_in_polygon(first, polygons, size)
              .select(F.col("pid.fid").alias("a"), F.col("fid").alias("b")))
    return cross.unionByName(inside).distinct().withColumnsRenamed({"a": "line", "b": "polygon"})


def polygons_intersect(pa: DataFrame, pb: DataFrame, size: float = 1000.0) -> DataFrame:
    """``(a, b)`` polygon pairs that share a point (borders crossing or
    touching, or one inside the other)."""
    cross = crossing_pairs(ring_segments(pa), ring_segments(pb), size)

    def rep(p):
        return (p.where((F.col("ring") == 0) & (F.col("seq") == 0))
                .select(F.struct("fid", "part").alias("pid"), "x", "y"))

    a_in_b = point_in_polygon(rep(pa), pb, size).select(F.col("pid.fid").alias("a"),
                                                         F.col("fid").alias("b"))
    b_in_a = point_in_polygon(rep(pb), pa, size).select(F.col("fid").alias("a"),
                                                         F.col("pid.fid").alias("b"))
    return cross.unionByName(a_in_b).unionByName(b_in_a).distinct()


def streams_in_regions(lines: DataFrame, regions: DataFrame, size: float = 1000.0) -> DataFrame:
    """A row per line and region that intersect, with the region as
    ``water_region_id`` and as a list, ordered by line and region (O5)."""
    pairs = lines_in_polygons(lines, regions, size)
    return (pairs.groupBy("line", "polygon")
            .agg(F.max("polygon").alias("water_region_id"),
                 F.sort_array(F.collect_list("polygon")).alias("water_region_ids"))
            .orderBy("line", "polygon").drop("polygon"))


def lakes_in_regions(lakes: DataFrame, regions: DataFrame, size: float = 1000.0) -> DataFrame:
    """A row per region and lake that meet (Q10), with the region as
    ``water_region_id`` and as a list, ordered by lake and region (O5)."""
    pairs = polygons_intersect(lakes, regions, size)
    return (pairs.groupBy(F.col("a").alias("lakeid"), "b")
            .agg(F.max("b").alias("water_region_id"),
                 F.sort_array(F.collect_list("b")).alias("water_region_ids"))
            .orderBy("lakeid", "b").drop("b"))


def regions_with_features(regions: DataFrame, features: DataFrame, size: float = 1000.0,
                          kind: str = "polygon") -> DataFrame:
    """Ids of regions that intersect any of the (already filtered)
    features, each once (spatial semi-join)."""
    if kind == "polygon":
        pairs = polygons_intersect(regions, features, size)
    else:
        pairs = lines_in_polygons(features, regions, size).withColumnRenamed("polygon", "a")
    return pairs.select(F.col("a").alias("gid")).distinct()


def nearest_polygon(points: DataFrame, polygons: DataFrame, dmax: float = 1.0,
                    size: float | None = None, key: str | None = None) -> DataFrame:
    """For each point ``(pid, x, y)`` the id of the nearest polygon (holes
    filled) within ``dmax``; 0 inside; ties -> smaller id; NULL if none.

    Squared distances are computed without division where the foot of the
    perpendicular falls inside the segment (cross^2 / len^2), so axis-parallel
    borders give exact distances and exact ties.

    A point meets the polygons of its cell only (``size``; :func:`cell_size` if
    None): one of each set of equal ones; where one covers the cell whole, just
    borders in the cell with a smaller id; else no border that is farther from
    all of the cell than another one from any place in it."""
    ext = unlike_polygons(exterior_only(polygons), key)
    seg = cut(ring_segments(ext).select(_key_of("fid", key).alias("k"), "fid", "x1", "y1", "x2", "y2"), "borders")
    size = size or cell_size(seg, dmax)
    whole, border = polygon_cells(seg, size)
    cell = ["k", "gx", "gy"]
    whole = cut(whole.groupBy(*cell).agg(F.min("fid").alias("least")), "covered")
    border = border.join(whole, cell, "left").where("least is null or fid < least").drop("least")

    def far2(x, y):
        """Squared distance of the place (x, y) from the segment."""
        x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
        dx, dy = x2 - x1, y2 - y1
        dot = (x - x1) * dx + (y - y1) * dy
        len2 = dx * dx + dy * dy
        cross = dx * (y - y1) - dy * (x - x1)
        return (F.when(dot <= 0, (x - x1) * (x - x1) + (y - y1) * (y - y1))
                .when(dot >= len2, (x - x2) * (x - x2) + (y - y2) * (y - y2))
                .otherwise(F.try_divide(cross * cross, len2)))

    left, low = F.col("gx") * size, F.col("gy") * size
    gap = lambda lo, hi, a, b: F.greatest(lo - F.greatest(a, b), F.least(a, b) - hi, F.lit(0.0))
    dx, dy = gap(left, left + size, F.col("x1"), F.col("x2")), gap(low, low + size, F.col("y1"), F.col("y2"))
    # the distance from a segment is greatest in a corner of the cell
    most = F.greatest(*[far2(left + i * size, low + j * size) for i in (0, 1) for j in (0, 1)])
    sc = (_passed_cells(seg, size, dmax * (1 + 1e-9) + size * 1e-6).withColumns({"lo": dx * dx + dy * dy, "most": most})
          .join(whole, cell, "left").where(f"least is null or (fid < least and lo <= {1e-9 * size * size!r})"))
    sc = (sc.withColumn("bound", F.min("most").over(Window.partitionBy(*cell)))
          .where(F.col("lo") <= F.col("bound") * (1 + 1e-6) + 1e-9 * size * size)
          .select(*cell, "fid", "x1", "y1", "x2", "y2"))
    pc = points.select("pid", _key_of("pid", key).alias("k"), "x", "y", F.floor(F.col("x") / size).alias("gx"),
                       F.floor(F.col("y") / size).alias("gy"))
    near = (pc.join(sc, cell).select("pid", "fid", far2(F.col("x"), F.col("y")).alias("d2"))
            .where(F.col("d2") <= dmax * dmax))
    inside = (_inside(pc.join(border, cell).select("pid", "fid", "x", "y"), seg, size)
              .union(pc.join(whole, cell).select("pid", "least")).withColumn("d2", F.lit(0.0)))
    best = (near.unionByName(inside)
            .groupBy("pid").agg(F.min(F.struct("d2", "fid")).alias("m"))
            .select("pid", F.col("m.fid").alias("lakeid"), F.sqrt("m.d2").alias("distance")))
    return points.select("pid").distinct().join(best, "pid", "left")


def border_lakes(borders: DataFrame, categories: DataFrame) -> DataFrame:
    """Border rows ``(bid, left_cat, right_cat)`` -> lake ids on both
    sides through the category table ``(cat, lakeid)`` (two left joins)."""
    left = categories.select(F.col("cat").alias("left_cat"), F.col("lakeid").alias("left_lake"))
    right = categories.select(F.col("cat").alias("right_cat"), F.col("lakeid").alias("right_lake"))
    return borders.join(left, "left_cat", "left").join(right, "right_cat", "left")


def shared_borders(polygons: DataFrame, key: str | None = None, size: float | None = None,
                   tolerance: float = 1e-6) -> DataFrame:
    """Pairs of different polygons whose borders share a stretch longer
    than ``tolerance`` (their vertices may differ), ``(left_lake < right_lake)``,
    each pair once.  Borders are one where both ends of a segment lie within
    ``tolerance`` of the line through the other: on a slope, coordinates that
    are rounded to doubles are never exactly on it."""
    s = cut(ring_segments(polygons).select(_key_of("fid", key).alias("k"), "fid", "x1", "y1", "x2", "y2"), "borders")
    size = size or cell_size(s)
    other = s.select("k", F.col("fid").alias("pfid"), *[F.col(c).alias("p" + c) for c in ("x1", "y1", "x2", "y2")])
    c = F.col
    # a pair may meet in more than one cell
    j = (_passed_cells(s, size, tolerance + size * 1e-6)
         .join(_passed_cells(other, size, 0.0, ("px1", "py1", "px2", "py2")), ["k", "gx", "gy"])
         .where(c("fid") < c("pfid")))
    rx, ry = c("x2") - c("x1"), c("y2") - c("y1")

    def off(x, y):   # 0 on the line through the segment
        return (c(x) - c("x1")) * ry - (c(y) - c("y1")) * rx

    def along(x, y):  # place along the segment, times its squared length
        return (c(x) - c("x1")) * rx + (c(y) - c("y1")) * ry

    t1, t2 = along("px1", "py1"), along("px2", "py2")
    length2 = rx * rx + ry * ry
    near = F.sqrt(length2) * tolerance  # distances and places are times the length
    overlap = F.least(F.greatest(t1, t2), length2) - F.greatest(F.least(t1, t2), F.lit(0.0))
    shared = (F.abs(off("px1", "py1")) <= near) & (F.abs(off("px2", "py2")) <= near) & (overlap > near)
    return (j.where(shared).select(c("fid").alias("left_lake"), c("pfid").alias("right_lake")).distinct())


def clip_lines_outside(lines: DataFrame, polygons: DataFrame, size: float | None = None,
                       key: str | None = None) -> DataFrame:
    """Parts of line segments outside all polygons (holes filled).

    Per line segment: parameters ``t`` where it meets polygon borders (from
    the grid join), sorted with 0 and 1 -> pieces -> a piece is kept when its
    midpoint is in no polygon; a piece on a polygon's border is not in it, on
    any side.  Pieces of at most 1e-9 of their segment are dropped.  With
    ``key``, ids are structs and only polygons with the same ``key`` field
    (e.g. the region) cut a line.  Returns ``(fid, part, seq, t0, t1, x1, y1,
    x2, y2)``.

    Where polygons lie on one another, one of each set of equal ones is looked
    at, and nothing in a cell that one polygon covers whole: lines are cut at
    the sides of the cells (``size``; :func:`cell_size` if None) as well, each
    piece is tested against the borders of its cell only, and what was cut at
    a side alone is joined again."""
    ext = unlike_polygons(exterior_only(polygons), key)
    ps = cut(ring_segments(ext).withColumn("k", _key_of("fid", key)), "borders")
    size = size or cell_size(ps)
    whole, border = polygon_cells(ps, size)
    whole = cut(whole.select("k", "gx", "gy").distinct(), "covered")
    ls = (line_segments(lines).where((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))
          .select(F.struct("fid", "part", "seq").alias("sid"), _key_of("fid", key).alias("k"), "x1", "y1", "x2", "y2"))
    ls = cut(ls.repartition(work_partitions(lines.sparkSession), "sid"), "segments")   # small rows, much work for each
    A = _passed_cells(ls, size)
    B = _passed_cells(ps.select("k", F.col("fid").alias("pfid"), *[F.col(c).alias("p" + c) for c in ("x1", "y1", "x2", "y2")]),
                      size, size * 1e-6, ("px1", "py1", "px2", "py2")).join(whole, ["k", "gx", "gy"], "left_anti")
    c = F.col
    j = A.join(B, ["k", "gx", "gy"]).where(
        segments_intersect(c("x1"), c("y1"), c("x2"), c("y2"),
                           c("px1"), c("py1"), c("px2"), c("py2")))
    # crossings and pieces are read several times below
    j = cut(j.select("sid", "pfid", "x1", "y1", "x2", "y2", "px1", "py1", "px2", "py2"), "crossings")
    rx, ry = c("x2") - c("x1"), c("y2") - c("y1")
    sx, sy = c("px2") - c("px1"), c("py2") - c("py1")
    den = rx * sy - ry * sx
    qx, qy = c("px1") - c("x1"), c("py1") - c("y1")
    len2 = rx * rx + ry * ry
    # proper crossing: one t; collinear overlap: both border ends projected
    t_cross = F.array((qx * sy - qy * sx) / den)
    t_both = (((c("px1") - c("x1")) * rx + (c("py1") - c("y1")) * ry) / len2,
              ((c("px2") - c("x1")) * rx + (c("py2") - c("y1")) * ry) / len2)
    t_coll = F.array(*t_both)
    ts = j.select("sid", F.explode(F.when(den != 0, t_cross).otherwise(t_coll)).alias("t"))
    ts = ts.where((F.col("t") > 0) & (F.col("t") < 1))
    tlist = ts.groupBy("sid").agg(F.collect_set("t").alias("ts"))
    none = F.array().cast("array<double>")

    def sides(v1, v2):   # where the segment passes from cell to cell
        lo, hi = F.floor(F.least(v1, v2) / size) + 1, F.floor(F.greatest(v1, v2) / size)
        return F.when(lo <= hi, F.transform(F.sequence(lo, hi), lambda g: (g * size - v1) / (v2 - v1))).otherwise(none)

    seg = (ls.join(tlist, "sid", "left").withColumn("ts", F.coalesce("ts", none))
           .withColumn("cs", F.filter(F.concat(sides(c("x1"), c("x2")), sides(c("y1"), c("y2"))),
                                      lambda g: (g > 1e-9) & (g < 1 - 1e-9)
                                      & ~F.exists("ts", lambda t: F.abs(t - g) <= 1e-9))))
    bounds = F.array_sort(F.concat(F.array(F.lit(0.0), F.lit(1.0)), "ts", "cs"))
    pieces = seg.select("sid", "k", "x1", "y1", "x2", "y2", "ts", F.explode(F.arrays_zip(
        F.slice(bounds, 1, F.size(bounds) - 1), F.slice(bounds, 2, F.size(bounds)))).alias("iv"))
    pieces = pieces.select("sid", "k", "x1", "y1", "x2", "y2", F.col("iv.0").alias("t0"), F.col("iv.1").alias("t1"),
                           F.array_contains("ts", F.col("iv.0")).alias("met")).where(F.col("t1") - F.col("t0") > 1e-9)
    pieces = pieces.withColumns({
        "pid": F.struct("sid", "t0"),
        "x": c("x1") + (c("t0") + c("t1")) / 2 * (c("x2") - c("x1")),
        "y": c("y1") + (c("t0") + c("t1")) / 2 * (c("y2") - c("y1"))})
    pieces = pieces.withColumns({"gx": F.floor(c("x") / size), "gy": F.floor(c("y") / size)})
    pieces = cut(pieces.join(whole, ["k", "gx", "gy"], "left_anti"), "pieces")
    cand = pieces.select("k", "gx", "gy", "pid", "x", "y").join(border, ["k", "gx", "gy"]).select("pid", "fid", "x", "y")
    covered = _inside(cand, ps, size)
    # pieces along a border of the polygon that their midpoint counts into
    touched = (j.where(den == 0).select("sid", F.col("pfid").alias("fid"), F.least(*t_both).alias("lo"),
                                        F.greatest(*t_both).alias("hi")))
    on_border = (pieces.select("sid", "pid", ((F.col("t0") + F.col("t1")) / 2).alias("mid")).join(touched, "sid")
                 .where((F.col("mid") > F.col("lo")) & (F.col("mid") < F.col("hi"))).select("pid", "fid").distinct())
    covered = covered.join(on_border, ["pid", "fid"], "left_anti").select("pid").distinct()
    out = pieces.join(covered, "pid", "left_anti")
    # a cut at the side of a cell is none
    w = Window.partitionBy("sid").orderBy("t0")
    before = F.lag("t1").over(w)
    begins = F.when(before.isNull() | F.col("met") | (F.col("t0") - before > 2e-9), 1).otherwise(0)
    out = (out.withColumn("begins", begins).withColumn("run", F.sum("begins").over(w))
           .groupBy("sid", "run").agg(F.min("t0").alias("t0"), F.max("t1").alias("t1"),
                                      *[F.first(n).alias(n) for n in ("x1", "y1", "x2", "y2")]))
    return out.select(
        F.col("sid.fid").alias("fid"), F.col("sid.part").alias("part"), F.col("sid.seq").alias("seq"),
        "t0", "t1",
        (c("x1") + c("t0") * (c("x2") - c("x1"))).alias("px1"),
        (c("y1") + c("t0") * (c("y2") - c("y1"))).alias("py1"),
        (c("x1") + c("t1") * (c("x2") - c("x1"))).alias("px2"),
        (c("y1") + c("t1") * (c("y2") - c("y1"))).alias("py2"),
    ).withColumnsRenamed({"px1": "x1", "py1": "y1", "px2": "x2", "py2": "y2"})


# ---------------------------------------------------------------------------
# aggregates


def ring_areas(polygons: DataFrame) -> DataFrame:
    """Shoelace area of each ring ``(fid, part, ring, area)`` (unsigned)."""
    s = ring_segments(polygons)
    return (s.groupBy("fid", "part", "ring")
            .agg(F.abs(F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")) / 2)
                 .alias("area")))


def polygon_area_ha(polygons: DataFrame) -> DataFrame:
    """A2: area in hectares with holes subtracted, per feature."""
    a = ring_areas(polygons)
    signed = F.when(F.col("ring") == 0, F.col("area")).otherwise(-F.col("area"))
    return a.groupBy("fid").agg((F.sum(signed) / 10000).alias("area_ha"))


def exterior_lakes(polygons: DataFrame, size: float = 1000.0) -> DataFrame:
    """A1: islands dropped: exterior ring of each part, and parts lying inside
    another part of the same feature (in its hole) swallowed.  Returns the
    vertices of the kept exterior rings."""
    ext = exterior_only(polygons)
    rep = (ext.where(F.col("seq") == 0)
           .select(F.struct("fid", "part").alias("pid"), "x", "y"))
    # test each part's first vertex against the other parts of its feature,
    # holes filled (a part inside a hole of another part is swallowed)
    parts = ext.withColumn("fid", F.struct("fid", "part"))
    inside = point_in_polygon(rep, parts, size)
    swallowed = (inside.where((F.col("pid.fid") == F.col("fid.fid"))
                              & (F.col("pid.part") != F.col("fid.part")))
                 .select(F.col("pid.fid").alias("fid"), F.col("pid.part").alias("part")).distinct())
    return ext.join(swallowed, ["fid", "part"], "left_anti")


def line_length_m(lines: DataFrame) -> DataFrame:
    """A3: length of each line feature in metres."""
    s = line_segments(lines)
    return s.groupBy("fid").agg(
        F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))).alias("length_m"))


# ---------------------------------------------------------------------------
# topology


def line_ends(lines: DataFrame) -> DataFrame:
    """First and last vertex of each line part: ``(fid, part, end, x, y)``
    with ``end`` 0 = start, 1 = end."""
    last = lines.groupBy("fid", "part").agg(F.max("seq").alias("last"))
    v = lines.join(last, ["fid", "part"])
    return (v.where((F.col("seq") == 0) | (F.col("seq") == F.col("last")))
            .select("fid", "part", F.when(F.col("seq") == 0, 0).otherwise(1).alias("end"), "x", "y"))


def build_topology(lines: DataFrame, keys=()) -> DataFrame:
    """Nodes at line ends; node ids are consecutive over the distinct end
    points ordered by ``(x, y)``; rows ``(line_cat, from_node, to_node)``."""
    from .ids import consecutive_ids
    ends = line_ends(lines)
    pts = ends.select(*keys, "x", "y").distinct().withColumn("xy", F.struct("x", "y"))
    if keys:
        ids = consecutive_ids(pts, "xy", keys=keys, out="node")
    else:
        ids = consecutive_ids(pts.withColumn("_k", F.lit(0)), "xy", keys=("_k",), out="node")
        ids = ids.drop("_k")
    e = ends.join(ids.drop("xy"), [*keys, "x", "y"])
    fr = e.where("end = 0").select(*keys, F.col("fid").alias("line_cat"), "part",
                                   F.col("node").alias("from_node"))
    to = e.where("end = 1").select(*keys, F.col("fid").alias("line_cat"), "part",
                                   F.col("node").alias("to_node"))
    return fr.join(to, [*keys, "line_cat", "part"]).drop("part")


def chain_lines(topology: DataFrame) -> DataFrame:
    """Lines that meet where exactly two line ends meet, in order.

    ``topology(wrid, line_cat, from_node, to_node)`` -> ``(wrid, chain, pos,
    line_cat, reversed, from_node, to_node)``: ``chain`` is the smallest
    category, whose line keeps its direction; ``reversed`` lines run against
    it, and their nodes are given as they are passed.  A closed ring begins
    with its smallest line.

    Each line is walked both ways (a number each: twice its category, one more
    against its direction).  The walk after a walk is known at each node of two
    ends; list ranking by doubling tells how many walks follow each, and one of
    the two walks along each chain stays."""
    t = topology.select("wrid", "line_cat", "from_node", "to_node")
    # a walk arrives by one line end and goes on from the other end at the node
    ends = (t.select("wrid", F.col("from_node").alias("node"), (F.col("line_cat") * 2 + 1).alias("arrive"),
                     (F.col("line_cat") * 2).alias("leave"))
            .unionByName(t.select("wrid", F.col("to_node").alias("node"), (F.col("line_cat") * 2).alias("arrive"),
                                  (F.col("line_cat") * 2 + 1).alias("leave"))))
    two = (ends.groupBy("wrid", "node").agg(F.count("*").alias("n"), F.min_by("arrive", "leave").alias("a"),
                                            F.min("leave").alias("la"), F.max_by("arrive", "leave").alias("b"),
                                            F.max("leave").alias("lb")).where("n = 2"))
    step, _ = stored(two.select("wrid", F.col("a").alias("v"), F.col("lb").alias("w"))
                     .union(two.select("wrid", F.col("b"), F.col("la"))), "next")
    walks = t.select("wrid", (F.col("line_cat") * 2).alias("v")).union(t.select("wrid", F.col("line_cat") * 2 + 1))
    size = walks.groupBy("wrid").count().agg(F.max("count")).first()[0] or 0
    last = walks.join(step.select("wrid", "v"), ["wrid", "v"], "left_anti")
    found, rings = chains(step, last, ["wrid"], size, forward=False)
    ring = step.select("wrid", "v").limit(0) if rings is None else stored(rings.distinct(), "rings")[0]
    if rings is not None:  # a ring is cut after its smallest walk
        found, _ = chains(step.join(ring, ["wrid", "v"], "left_anti"), last.union(ring), ["wrid"], size, forward=False)
    found, _ = stored(found, "walks")
    whole = found.groupBy("wrid", "q").agg(F.min("p").alias("least"), F.count("*").alias("n")).where("least % 2 = 0")
    closed = ring.select("wrid", F.col("v").alias("q"), F.lit(True).alias("closed"))
    pos = F.when(F.col("closed"), (F.col("n") - F.col("hop")) % F.col("n")).otherwise(F.col("n") - 1 - F.col("hop"))
    out = (found.join(whole, ["wrid", "q"]).join(closed, ["wrid", "q"], "left")
           .select("wrid", F.expr("least div 2").alias("chain"), pos.alias("pos"), F.expr("p div 2").alias("line_cat"),
                   (F.col("p") % 2 == 1).alias("reversed")))
    return out.join(t, ["wrid", "line_cat"]).select(
        "wrid", "chain", "pos", "line_cat", "reversed",
        F.when(F.col("reversed"), F.col("to_node")).otherwise(F.col("from_node")).alias("from_node"),
        F.when(F.col("reversed"), F.col("from_node")).otherwise(F.col("to_node")).alias("to_node"))


def merge_chains(topology: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row for each chain of :func:`chain_lines`, with the smallest
    category, the summed length and the nodes at which it begins and ends.

    ``lengths(wrid, line_cat, length_m)``.  Returns ``(wrid, line_cat, n_lines,
    length_m, from_node, to_node)``."""
    j = chain_lines(topology).join(lengths.select("wrid", "line_cat", "length_m"), ["wrid", "line_cat"])
    return j.groupBy("wrid", F.col("chain").alias("line_cat")).agg(
        F.count("*").alias("n_lines"), F.sum("length_m").alias("length_m"),
        F.min_by("from_node", "pos").alias("from_node"), F.max_by("to_node", "pos").alias("to_node"))


def merged_points(order: DataFrame, lines: DataFrame) -> DataFrame:
    """The points of merged lines in order: ``order`` from :func:`chain_lines`,
    ``lines(wrid, fid, seq, x, y)`` -> ``(wrid, chain, seq, x, y)``; the point
    at which two lines meet stands once."""
    per = lines.groupBy("wrid", F.col("fid").alias("line_cat")).agg(F.max("seq").alias("top"))
    # a row for each line of a chain, not for each point
    before = Window.partitionBy("wrid", "chain").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    placed = (order.join(per, ["wrid", "line_cat"])
              .withColumn("offset", F.coalesce(F.sum("top").over(before), F.lit(0))))
    p = lines.select("wrid", F.col("fid").alias("line_cat"), "seq", "x", "y").join(placed, ["wrid", "line_cat"])
    at = F.when(F.col("reversed"), F.col("top") - F.col("seq")).otherwise(F.col("seq"))
    return (p.withColumn("at", at).where("at > 0 OR pos = 0")
            .select("wrid", "chain", (F.col("offset") + F.col("at")).cast("long").alias("seq"), "x", "y"))


def snap_points(points: DataFrame, threshold: float = 1.0, size: float | None = None,
                keys=()) -> DataFrame:
    """G1: points closer than ``threshold`` are merged, transitively, within
    equal ``keys``; each point gets the smallest ``(x, y)`` of its group.
    ``points(keys, pid, x, y)``.  Equal points are one point in the search, so
    the ends that meet at a confluence do not pair up."""
    keys = list(keys)
    size = size or max(threshold * 4, 1.0)
    p = points.select(*keys, "pid", "x", "y")
    d = p.select(*keys, "x", "y").distinct()
    A = _cells(d, size, pad=threshold, xs=("x",), ys=("y",))
    B = d.select(*keys, F.col("x").alias("qx"), F.col("y").alias("qy")) \
        .withColumns({"gx": F.floor(F.col("qx") / size), "gy": F.floor(F.col("qy") / size)})
    here, there = F.struct("x", "y"), F.struct(F.col("qx").alias("x"), F.col("qy").alias("y"))
    close = (A.join(B, [*keys, "gx", "gy"])
             .where((here < there)
                    & (F.hypot(F.col("x") - F.col("qx"), F.col("y") - F.col("qy")) < threshold))
             .select(*keys, here.alias("src"), there.alias("dst")))
    # the smallest vertex of a component is its smallest (x, y)
    comp = connected_components(d.select(*keys, here.alias("vid")), close, keys=keys, vertex="vid")
    return (p.withColumn("vid", here).join(comp, [*keys, "vid"])
            .select(*keys, "pid", F.col("component.x").alias("x"), F.col("component.y").alias("y")))
