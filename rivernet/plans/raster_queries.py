"""Registered raster queries (J13-J15, R1-R7) on the fixture cells (10 m
resolution; ``cat`` marks the stream line on a cell)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions.exprs import fixed_round
from ..operators import raster as RS
from ..operators import spatial as G
from ..operators.iterate import cut
from ..sources.fixtures import register_fixtures
from .oracle import _stat_sql, with_clause

RES = 10.0
THRESHOLD = 5          # FIXTURES.md: random heights drain in few steps
MIN_LENGTH_M = 150.0


def _cells(spark, sf_dir):
    register_fixtures(spark, sf_dir)
    return spark.table("fx_cells").select(F.col("r").alias("row"), F.col("c").alias("col"), "z", "cat")


def _r6(df):
    return df.select(*[fixed_round(c, 6).alias(c) if t == "double" else F.col(c)
                       for c, t in df.dtypes])


def q_mask_cells(spark, sf_dir):
    register_fixtures(spark, sf_dir)
    regions = G.rect_rings(spark.table("fx_catchment"), "gid")
    m = RS.mask_cells(_cells(spark, sf_dir), regions, distance=30.0, nsres=RES, ewres=RES)
    return m.withColumnRenamed("fid", "gid")


def q_cells_of_lines(spark, sf_dir):
    register_fixtures(spark, sf_dir)
    lines = G.polyline(spark.table("fx_stream_line"), "ogc_fid",
                       [("x0", "y0"), ("xm", "y0"), ("xm", "y2")])
    return RS.cells_of_lines(G.line_segments(lines), RES)


def q_neighbour_cells(spark, sf_dir):
    n = RS.neighbour_cells(_cells(spark, sf_dir))
    return n.select("row", "col", "d", "nrow", "ncol")


def q_local_slope(spark, sf_dir):
    return _r6(RS.local_slope(_cells(spark, sf_dir), RES, RES))


def _d8(spark, sf_dir):
    return RS.d8_direction(_cells(spark, sf_dir), RES, RES)


def q_d8(spark, sf_dir):
    return _d8(spark, sf_dir).select("row", "col", "d", "nrow", "ncol")


def q_gradient(spark, sf_dir):
    return _r6(RS.stream_gradient(_d8(spark, sf_dir)))


def q_accumulation(spark, sf_dir):
    return RS.flow_accumulation(_d8(spark, sf_dir))


def q_extract_streams(spark, sf_dir):
    d8 = cut(_d8(spark, sf_dir), "d8")   # read by both steps
    acc = RS.flow_accumulation(d8)
    return RS.extract_streams(d8, acc, threshold=THRESHOLD, min_length_m=MIN_LENGTH_M,
                              resolution=RES)


def q_grid_extent(spark, sf_dir):
    register_fixtures(spark, sf_dir)
    lakes = spark.table("fx_lake_rect")
    pairs = G.polygons_intersect(G.rect_rings(lakes, "id", hole_half="island_half"),
                                 G.rect_rings(spark.table("fx_catchment"), "gid"))
    boxes = pairs.select(F.col("a").alias("id"), F.col("b").alias("gid")).join(lakes, "id")
    return RS.grid_extent(boxes, ["gid"], pad=100.0, resolution=RES)


def q_cell_profile(spark, sf_dir):
    return _r6(RS.cell_profile(_cells(spark, sf_dir), fixed_scale=5))


QUERIES = {
    "J13_mask_cells": q_mask_cells,
    "J14_cells_of_lines": q_cells_of_lines,
    "J15_neighbour_cells": q_neighbour_cells,
    "R1_local_slope": q_local_slope,
    "R2_stream_gradient": q_gradient,
    "R3_d8_direction": q_d8,
    "R4_flow_accumulation": q_accumulation,
    "R5_extract_streams": q_extract_streams,
    "R6_grid_extent": q_grid_extent,
    "R7_A4_cell_profile": q_cell_profile,
}

_OFFS = ", ".join(f"({i + 1}, {dr}, {dc}, {str(dg).lower()})"
                  for i, (dr, dc, dg) in enumerate(RS.OFFSETS))
_DIAG = repr(math.sqrt(RES ** 2 + RES ** 2))

_RASTER_CTES = f""",
cells AS (SELECT r AS "row", c AS col, z, cat FROM fx_cells),
offs AS (SELECT * FROM (VALUES {_OFFS}) t(d, dr, dc, diagonal)),
nb_all AS (
  SELECT a."row", a.col, a.z, o.d, o.diagonal, b."row" AS nrow, b.col AS ncol, b.z AS nz
  FROM cells a CROSS JOIN offs o JOIN cells b ON b."row" = a."row" + o.dr AND b.col = a.col + o.dc),
nb_stream AS (
  SELECT n.* FROM nb_all n
  JOIN cells a ON a."row" = n."row" AND a.col = n.col AND a.cat IS NOT NULL
  JOIN cells b ON b."row" = n.nrow AND b.col = n.ncol AND b.cat IS NOT NULL),
g AS (
  SELECT *, (z - nz) / CASE WHEN diagonal THEN {_DIAG} ELSE {RES} END AS g FROM nb_all),
d8 AS (
  SELECT "row", col, d, nrow, ncol, g AS "drop" FROM (
    SELECT *, row_number() OVER (PARTITION BY "row", col ORDER BY g DESC, d) AS rn
    FROM g WHERE g > 0) t WHERE rn = 1),
walk(sr, sc, r, c) AS (
  SELECT "row", col, "row", col FROM cells
  UNION ALL
  SELECT w.sr, w.sc, d.nrow, d.ncol FROM walk w JOIN d8 d ON d."row" = w.r AND d.col = w.c),
acc AS (SELECT r AS "row", c AS col, count(*) AS acc FROM walk GROUP BY r, c)
"""
_W = with_clause(views=("fx_cells", "fx_catchment", "fx_stream_line", "fx_lake_rect")) + _RASTER_CTES

ORACLE = {
    "J13_mask_cells": _W + """
SELECT g.gid, x."row", x.col FROM cells x JOIN fx_catchment g
ON 10 * x.col + 5 BETWEEN g.x1 - 30 AND g.x2 + 30 AND 10 * x."row" + 5 BETWEEN g.y1 - 30 AND g.y2 + 30
WHERE power(greatest(g.x1 - (10 * x.col + 5), 0, (10 * x.col + 5) - g.x2), 2)
    + power(greatest(g.y1 - (10 * x."row" + 5), 0, (10 * x."row" + 5) - g.y2), 2) <= 900""",
    "J14_cells_of_lines": _W + """
SELECT DISTINCT fid, "row", col FROM (
  SELECT ogc_fid AS fid, CAST(floor(y0 / 10) AS BIGINT) AS "row",
         unnest(range(CAST(floor(least(x0, xm) / 10) AS BIGINT),
                      CAST(floor(greatest(x0, xm) / 10) AS BIGINT) + 1)) AS col FROM fx_stream_line
  UNION ALL
  SELECT ogc_fid, unnest(range(CAST(floor(least(y0, y2) / 10) AS BIGINT),
                               CAST(floor(greatest(y0, y2) / 10) AS BIGINT) + 1)),
         CAST(floor(xm / 10) AS BIGINT) FROM fx_stream_line) t""",
    "J15_neighbour_cells": _W + 'SELECT "row", col, d, nrow, ncol FROM nb_stream',
    "R1_local_slope": _W + f"""
SELECT a."row", a.col, r6(coalesce(greatest(
         greatest(coalesce((a.z - m.zd) / {(RES + RES) * 2}, 0), 0),
         greatest(coalesce((a.z - m.zg) / {math.sqrt(RES + RES)!r}, 0), 0)), 0)) AS slope
FROM cells a LEFT JOIN (
  SELECT "row", col, min(nz) FILTER (WHERE NOT diagonal) AS zd, min(nz) FILTER (WHERE diagonal) AS zg
  FROM nb_stream GROUP BY "row", col) m ON m."row" = a."row" AND m.col = a.col
WHERE a.cat IS NOT NULL""",
    "R2_stream_gradient": _W + """
SELECT c."row", c.col, r6(d."drop") AS gradient FROM cells c
LEFT JOIN d8 d ON d."row" = c."row" AND d.col = c.col""",
    "R3_d8_direction": _W + """
SELECT c."row", c.col, d.d, d.nrow, d.ncol FROM cells c
LEFT JOIN d8 d ON d."row" = c."row" AND d.col = c.col""",
    "R4_flow_accumulation": _W + 'SELECT "row", col, acc FROM acc',
    "R5_extract_streams": _W + f""",
s AS (SELECT "row", col FROM acc WHERE acc >= {THRESHOLD}),
nxt AS (SELECT d."row", d.col, d.nrow, d.ncol FROM d8 d
        JOIN s a ON a."row" = d."row" AND a.col = d.col JOIN s b ON b."row" = d.nrow AND b.col = d.ncol),
inflow AS (SELECT nrow AS "row", ncol AS col, count(*) AS n FROM nxt GROUP BY nrow, ncol),
s2 AS (SELECT s."row", s.col, coalesce(i.n, 0) AS inflow FROM s LEFT JOIN inflow i
       ON i."row" = s."row" AND i.col = s.col),
chain(sr, sc, r, c) AS (
  SELECT "row", col, "row", col FROM s2 WHERE inflow = 0
  UNION ALL
  SELECT ch.sr, ch.sc, x.nrow, x.ncol FROM chain ch JOIN nxt x ON x."row" = ch.r AND x.col = ch.c
  JOIN s2 t ON t."row" = x.nrow AND t.col = x.ncol WHERE t.inflow = 1),
sz AS (SELECT sr, sc, count(*) AS n FROM chain GROUP BY sr, sc),
short AS (SELECT ch.r, ch.c FROM chain ch JOIN sz ON sz.sr = ch.sr AND sz.sc = ch.sc
          WHERE sz.n < {round(MIN_LENGTH_M / RES)})
SELECT s."row", s.col FROM s WHERE NOT EXISTS (
  SELECT 1 FROM short WHERE short.r = s."row" AND short.c = s.col)""",
    "R6_grid_extent": _W + """
SELECT c.gid, floor((min(l.x1) - 100) / 10) * 10 AS xmin, floor((min(l.y1) - 100) / 10) * 10 AS ymin,
       ceil((max(l.x2) + 100) / 10) * 10 AS xmax, ceil((max(l.y2) + 100) / 10) * 10 AS ymax
FROM fx_lake_rect l JOIN fx_catchment c
ON l.x1 <= c.x2 AND l.x2 >= c.x1 AND l.y1 <= c.y2 AND l.y2 >= c.y1 GROUP BY c.gid""",
}
_stats = [f"{p}_{s}" for p in ("altitude",) for s in (
    "minimum", "maximum", "average", "stddev", "variance", "first_quartile", "median",
    "third_quartile", "percentile_90")]
ORACLE["R7_A4_cell_profile"] = _W + f""",
st AS (SELECT cat, {_stat_sql('z', 'altitude')} FROM cells WHERE cat IS NOT NULL GROUP BY cat)
SELECT cat, {', '.join(f'r6({c}) AS {c}' for c in _stats)} FROM st"""
