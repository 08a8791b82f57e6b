"""Rasters as cell tables ``(keys..., row, col, z, cat)``.

A terrain model is a DataFrame of cells; neighbourhoods are equi-joins on
``(row + dr, col + dc)``; flow along the steepest-descent pointers is a
layered iteration like the graph searches.  Cell centres are at
``((col + 0.5) * ewres, (row + 0.5) * nsres)`` (rows grow northwards here).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import work_partitions
from .iterate import connected_components, cut
from .network import edge_profile
from .spatial import _cells, point_in_polygon, ring_segments

# The eight neighbour offsets (d = 1..8) as (drow, dcol, diagonal).
OFFSETS = [(0, 1, False), (-1, 1, True), (-1, 0, False), (-1, -1, True),
           (0, -1, False), (1, -1, True), (1, 0, False), (1, 1, True)]


BLOCK = 1024   # cells of a row or column that one window passes


def _beside(cells: DataFrame, keys, along: str, across: str, value) -> DataFrame:
    """``cells`` with the place in ``along`` and ``value`` of the cells before
    (``p``, ``pv``) and after (``n``, ``nv``) that are at most two away.
    Windows pass blocks of rows or columns; the two cells at each end of a
    block also stand in the next."""
    block, inside = F.floor(F.col(along) / BLOCK), F.pmod(along, F.lit(BLOCK))
    blocks = F.array(block, F.when(inside < 2, block - 1), F.when(inside >= BLOCK - 2, block + 1))
    c = cells.withColumns({"own": block, "value": value}).withColumn("block", F.explode(F.array_compact(blocks)))
    w = Window.partitionBy(*keys, across, "block").orderBy(along)
    c = c.withColumns({"p": F.lag(along).over(w), "pv": F.lag("value").over(w),
                       "n": F.lead(along).over(w), "nv": F.lead("value").over(w)})
    return c.where("block = own").drop("block", "own", "value")


def neighbour_cells(cells: DataFrame, keys=(), only_stream: bool = True) -> DataFrame:
    """``(keys, row, col, d, diagonal, nrow, ncol, z, nz)`` for the 8
    neighbours that exist (and are stream cells when ``only_stream``).

    Places with a cell, or with one beside them in their row, see these three;
    each cell then sees what the places above and below it see: cells move
    twice, not once for each neighbour.  A cell stands once in ``cells``."""
    keys = list(keys)
    c = cells.where(F.col("cat").isNotNull()) if only_stream else cells
    me, none, col = F.struct("z"), F.when(F.lit(False), F.struct("z")), F.col("col")
    c = _beside(c.select(*keys, "row", "col", "z"), keys, "col", "row", me)

    def place(at, mid, west, east):
        return F.struct(at.alias("col"), mid.alias("mid"), west.alias("west"), east.alias("east"))

    # an empty place between two cells comes from the one before it
    places = F.array(place(col, me, F.when(F.col("p") == col - 1, F.col("pv")), F.when(F.col("n") == col + 1, F.col("nv"))),
                     F.when(F.col("n").isNull() | (F.col("n") > col + 1),
                            place(col + 1, none, me, F.when(F.col("n") == col + 2, F.col("nv")))),
                     F.when(F.col("p").isNull() | (F.col("p") < col - 2), place(col - 1, none, none, me)))
    c = c.select(*keys, "row", F.explode(F.array_compact(places)).alias("o")).select(*keys, "row", "o.*")
    c = _beside(c, keys, "row", "col", F.struct("mid", "west", "east")).where("mid is not null")
    c = c.withColumns({"low": F.when(F.col("p") == F.col("row") - 1, F.col("pv")),
                       "high": F.when(F.col("n") == F.col("row") + 1, F.col("nv")), "z": F.col("mid.z")})

    def seen(dr, dc):
        side = {-1: "west", 0: "mid", 1: "east"}[dc]
        return F.col(side) if dr == 0 else F.col("low" if dr < 0 else "high")[side]

    found = F.array_compact(F.array(*[F.when(seen(dr, dc).isNotNull(), F.struct(
        F.lit(i + 1).alias("d"), F.lit(diag).alias("diagonal"), (F.col("row") + dr).alias("nrow"),
        (F.col("col") + dc).alias("ncol"), seen(dr, dc)["z"].alias("nz"))) for i, (dr, dc, diag) in enumerate(OFFSETS)]))
    return c.select(*keys, "row", "col", "z", F.explode(found).alias("o")).select(*keys, "row", "col", "z", "o.*")


def local_slope(cells: DataFrame, nsres: float, ewres: float, formula: str = "reference",
                keys=()) -> DataFrame:
    """Slope of each stream cell towards its lowest stream neighbour.

    ``formula="reference"`` keeps the reference's operator precedence
    (direct ``dz/(ns+ew)/2``, diagonal ``dz/sqrt(ns+ew)``); ``"geometric"``
    divides by the centre distances.  No lower neighbour -> 0; the result is
    the larger of the direct and diagonal slopes."""
    if formula == "reference":
        d_direct, d_diag = (nsres + ewres) * 2, math.sqrt(nsres + ewres)
    else:
        d_direct, d_diag = (nsres + ewres) / 2, math.sqrt(nsres ** 2 + ewres ** 2)
    nb = neighbour_cells(cells, keys)
    g = nb.groupBy(*keys, "row", "col", "z").agg(
        F.min(F.when(~F.col("diagonal"), F.col("nz"))).alias("zd"),
        F.min(F.when(F.col("diagonal"), F.col("nz"))).alias("zg"))
    direct = F.greatest(F.coalesce((F.col("z") - F.col("zd")) / d_direct, F.lit(0.0)), F.lit(0.0))
    diag = F.greatest(F.coalesce((F.col("z") - F.col("zg")) / d_diag, F.lit(0.0)), F.lit(0.0))
    slopes = g.select(*keys, "row", "col", F.greatest(direct, diag).alias("slope"))
    stream = cells.where(F.col("cat").isNotNull()).select(*keys, "row", "col")
    return stream.join(slopes, [*keys, "row", "col"], "left").fillna(0.0, ["slope"])


def d8_direction(cells: DataFrame, nsres: float, ewres: float, keys=()) -> DataFrame:
    """Steepest-descent neighbour of every cell (``d`` 1..8, ties -> the
    smaller ``d``); pits (no lower neighbour) get NULL.  Returns ``(keys,
    row, col, z, d, nrow, ncol, drop)`` with ``drop`` = gradient."""
    nb = neighbour_cells(cells, keys, only_stream=False)
    dist = F.when(F.col("diagonal"), F.lit(math.sqrt(nsres ** 2 + ewres ** 2))).otherwise(
        F.when(F.col("d").isin(1, 5), F.lit(float(ewres))).otherwise(F.lit(float(nsres))))
    nb = nb.withColumn("g", (F.col("z") - F.col("nz")) / dist).where(F.col("g") > 0)
    best = nb.groupBy(*keys, "row", "col").agg(
        F.max(F.struct("g", (-F.col("d")).alias("nd"), "nrow", "ncol")).alias("b"))
    best = best.select(*keys, "row", "col", (-F.col("b.nd")).alias("d"),
                       F.col("b.nrow").alias("nrow"), F.col("b.ncol").alias("ncol"),
                       F.col("b.g").alias("drop"))
    return cells.select(*keys, "row", "col", "z").join(best, [*keys, "row", "col"], "left")


def stream_gradient(d8: DataFrame, keys=()) -> DataFrame:
    """R2: gradient from each cell to the cell it drains to (NULL at pits)."""
    return d8.select(*keys, "row", "col", F.col("drop").alias("gradient"))


def flow_accumulation(d8: DataFrame, keys=()) -> DataFrame:
    """Cells draining through each cell, itself included.

    Pointer doubling on the drainage forest: after k rounds a cell counts the
    cells less than 2^k steps above it and points 2^k steps down, so the rounds
    are logarithmic in the longest flow path.  A round holds only the cells
    whose way goes on that far; what they hand down is added up at the end.
    Every round is written to the checkpoint folder."""
    keys = list(keys)
    k, p = [*keys, "row", "col"], [*keys, "nrow", "ncol"]
    cells = cut(d8.select(*k, F.when(F.col("d").isNotNull(), F.col("nrow")).alias("nrow"),
                          F.when(F.col("d").isNotNull(), F.col("ncol")).alias("ncol"),
                          F.lit(1).cast("long").alias("acc")), "accum")
    moving = cells.where(F.col("nrow").isNotNull())
    total = cells.select(*k, "acc")
    while not moving.isEmpty():
        above = cut(moving.groupBy(*p).agg(F.sum("acc").alias("more"))
                    .withColumnsRenamed({"nrow": "row", "ncol": "col"}), "handed")
        total = total.unionByName(above.withColumnRenamed("more", "acc"))
        ahead = moving.select(*keys, F.col("row").alias("nrow"), F.col("col").alias("ncol"),
                              F.col("nrow").alias("row2"), F.col("ncol").alias("col2"))
        moving = cut(moving.join(ahead, p).join(above, k, "left")
                     .select(*k, F.col("row2").alias("nrow"), F.col("col2").alias("ncol"),
                             (F.col("acc") + F.coalesce("more", F.lit(0))).alias("acc")), "accum")
    return total.groupBy(*k).agg(F.sum("acc").alias("acc"))


def extract_streams(d8: DataFrame, acc: DataFrame, threshold: int = 2000,
                    min_length_m: float = 150.0, resolution: float = 10.0, keys=()) -> DataFrame:
    """Stream cells = accumulation >= threshold; first-order parts (from
    a stream source down to the first stream confluence) shorter than
    ``round(min_length_m / resolution)`` cells are dropped."""
    keys = list(keys)
    k = [*keys, "row", "col"]
    s = cut(acc.where(F.col("acc") >= threshold).select(*k), "stream_cells")
    d = d8.join(s, k, "left_semi").select(*k, "nrow", "ncol")
    nxt = cut(d.join(s.select(*keys, F.col("row").alias("nrow"), F.col("col").alias("ncol")),
                     [*keys, "nrow", "ncol"], "left_semi"), "stream_arcs")
    inflow = nxt.groupBy(*keys, F.col("nrow").alias("row"), F.col("ncol").alias("col")) \
        .agg(F.count("*").alias("inflow"))
    s2 = cut(s.join(inflow, k, "left").fillna(0, ["inflow"]), "inflow")
    # first-order chains are the components, with a source, of the arcs into
    # cells with exactly one stream inflow
    arcs = (nxt.join(s2.select(*keys, F.col("row").alias("nrow"), F.col("col").alias("ncol"),
                               "inflow"), [*keys, "nrow", "ncol"])
            .where("inflow = 1")
            .select(*keys, F.struct("row", "col").alias("src"),
                    F.struct(F.col("nrow").alias("row"), F.col("ncol").alias("col")).alias("dst")))
    cells = s2.select(*keys, F.struct("row", "col").alias("cell"), "inflow")
    chain = cut(connected_components(cells, arcs, keys=keys, vertex="cell").join(cells, [*keys, "cell"]), "chains")
    by_chain = chain.groupBy(*keys, "component").agg(F.count("*").alias("n"), F.min("inflow").alias("least"))
    short = (chain.join(by_chain, [*keys, "component"])
             .where((F.col("least") == 0) & (F.col("n") < round(min_length_m / resolution)))
             .select(*keys, F.col("cell.row").alias("row"), F.col("cell.col").alias("col")))
    return s.join(short, k, "left_anti")


def grid_extent(boxes: DataFrame, keys, pad: float = 100.0, resolution: float = 10.0) -> DataFrame:
    """Bounding box of ``(x1, y1, x2, y2)`` rows per key, padded and
    aligned outwards to the grid."""
    g = boxes.groupBy(*keys).agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"),
                                 F.max("x2").alias("x2"), F.max("y2").alias("y2"))
    r = float(resolution)
    return g.select(*keys,
                    (F.floor((F.col("x1") - pad) / r) * r).alias("xmin"),
                    (F.floor((F.col("y1") - pad) / r) * r).alias("ymin"),
                    (F.ceil((F.col("x2") + pad) / r) * r).alias("xmax"),
                    (F.ceil((F.col("y2") + pad) / r) * r).alias("ymax"))


def cell_profile(cells: DataFrame, prefix: str = "altitude", keys=(),
                 fixed_scale: int | None = None) -> DataFrame:
    """R7 (+A4): statistics of the cell values under each line ``cat``."""
    c = cells.where(F.col("cat").isNotNull())
    return edge_profile(c, "z", prefix, keys=(*keys, "cat"), fixed_scale=fixed_scale)


def points_near_polygons(points: DataFrame, polygons: DataFrame, dmax: float,
                         size: float = 1000.0) -> DataFrame:
    """All ``(pid, fid, d2)`` with the point inside the polygon (d2 = 0) or
    within ``dmax`` of its boundary."""
    seg = ring_segments(polygons).select("fid", "x1", "y1", "x2", "y2")
    pc = _cells(points.select("pid", "x", "y"), size, pad=dmax, xs=("x",), ys=("y",))
    sc = _cells(seg, size)
    x, y, x1, y1, x2, y2 = (F.col(c) for c in ("x", "y", "x1", "y1", "x2", "y2"))
    dx, dy = x2 - x1, y2 - y1
    dot = (x - x1) * dx + (y - y1) * dy
    len2 = dx * dx + dy * dy
    cross = dx * (y - y1) - dy * (x - x1)
    d2 = (F.when(dot <= 0, (x - x1) * (x - x1) + (y - y1) * (y - y1))
          .when(dot >= len2, (x - x2) * (x - x2) + (y - y2) * (y - y2))
          .otherwise(F.try_divide(cross * cross, len2)))
    near = (pc.join(sc, ["gx", "gy"]).select("pid", "fid", d2.alias("d2"))
            .where(F.col("d2") <= dmax * dmax))
    inside = point_in_polygon(points, polygons, size).withColumn("d2", F.lit(0.0))
    return near.unionByName(inside).groupBy("pid", "fid").agg(F.min("d2").alias("d2"))


def mask_cells(cells: DataFrame, regions: DataFrame, distance: float = 30.0,
               nsres: float = 10.0, ewres: float = 10.0, size: float = 1000.0) -> DataFrame:
    """``(fid, row, col)`` for cells whose centre lies in the region or
    within ``distance`` of its border."""
    pts = cells.select(F.struct("row", "col").alias("pid"),
                       ((F.col("col") + 0.5) * ewres).alias("x"),
                       ((F.col("row") + 0.5) * nsres).alias("y"))
    near = points_near_polygons(pts, regions, distance, size)
    return near.select("fid", F.col("pid.row").alias("row"), F.col("pid.col").alias("col"))


def cells_of_lines(segments: DataFrame, resolution: float = 10.0) -> DataFrame:
    """Every cell a line segment touches, ``(fid, row, col)`` distinct.

    Walks the segment column by column (the y-range inside each column gives
    the rows), so the work is proportional to the cells touched.  Segments are
    few bytes each and are dealt by line before they become cells, else one
    task makes the cells of all the segments of its input."""
    r = float(resolution)
    segments = segments.repartition(work_partitions(segments.sparkSession), "fid")
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    s = segments.select("fid", "x1", "y1", "x2", "y2",
                        F.explode(F.sequence(F.floor(F.least(x1, x2) / r),
                                             F.floor(F.greatest(x1, x2) / r))).alias("col"))
    lo_x = F.greatest(F.least(x1, x2), F.col("col") * r)
    hi_x = F.least(F.greatest(x1, x2), (F.col("col") + 1) * r)
    slope = F.try_divide(y2 - y1, x2 - x1)
    ya = F.when(x1 == x2, y1).otherwise(y1 + (lo_x - x1) * slope)
    yb = F.when(x1 == x2, y2).otherwise(y1 + (hi_x - x1) * slope)
    rows = F.sequence(F.floor(F.least(ya, yb) / r), F.floor(F.greatest(ya, yb) / r))
    return s.select("fid", F.explode(rows).alias("row"), "col").distinct()
