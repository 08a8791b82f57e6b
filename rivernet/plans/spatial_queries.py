"""Registered spatial queries (J1-J4, J7, J9, J12, A1-A3, G1-G3) on the
fixture rectangles and two-segment streams, with DuckDB twins written as
plain comparisons on the rectangles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import spatial as G
from ..operators.ids import consecutive_ids
from ..sources.fixtures import register_fixtures
from .oracle import with_clause

COUNTIES = ("EUROPE", "ASIA")


def _catchments(spark, sf_dir):
    register_fixtures(spark, sf_dir)
    return G.rect_rings(spark.table("fx_catchment"), "gid")


def _lakes(spark, sf_dir):
    register_fixtures(spark, sf_dir)
    return G.rect_rings(spark.table("fx_lake_rect"), "id", hole_half="island_half")


def _streams(spark, sf_dir):
    register_fixtures(spark, sf_dir)
    return G.polyline(spark.table("fx_stream_line"), "ogc_fid",
                      [("x0", "y0"), ("xm", "y0"), ("xm", "y2")])


def q_streams_in_regions(spark, sf_dir):
    return G.lines_in_polygons(_streams(spark, sf_dir), _catchments(spark, sf_dir)) \
        .select(F.col("line").alias("ogc_fid"), F.col("polygon").alias("gid"))


def q_lakes_in_regions(spark, sf_dir):
    return G.polygons_intersect(_lakes(spark, sf_dir), _catchments(spark, sf_dir)) \
        .select(F.col("a").alias("id"), F.col("b").alias("gid"))


def q_regions_with_lakes(spark, sf_dir):
    register_fixtures(spark, sf_dir)
    chosen = spark.table("fx_catchment").where(F.col("county").isin(*COUNTIES))
    regions = G.rect_rings(chosen, "gid")
    return G.regions_with_features(regions, _lakes(spark, sf_dir))


def _stream_ends(spark, sf_dir):
    ends = G.line_ends(_streams(spark, sf_dir))
    return ends.select(F.struct(F.col("fid").alias("ogc_fid"), F.col("end").alias("end_no"))
                       .alias("pid"), "x", "y")


def q_nearest_lake(spark, sf_dir):
    near = G.nearest_polygon(_stream_ends(spark, sf_dir), _lakes(spark, sf_dir), dmax=25.0)
    return near.select(F.col("pid.ogc_fid").alias("ogc_fid"), F.col("pid.end_no").alias("end_no"),
                       "lakeid")


def q_shared_borders(spark, sf_dir):
    return G.shared_borders(_lakes(spark, sf_dir))


def q_border_lakes(spark, sf_dir):
    """Borders carry lake categories (consecutive ids); map them back."""
    register_fixtures(spark, sf_dir)
    cats = consecutive_ids(spark.table("fx_lake_rect").select(F.lit(0).alias("k"),
                                                              F.col("id").alias("lakeid")),
                           "lakeid", keys=("k",), out="cat").drop("k")
    pairs = G.shared_borders(_lakes(spark, sf_dir))
    borders = (pairs.join(cats.select(F.col("lakeid").alias("left_lake"), F.col("cat").alias("left_cat")),
                          "left_lake")
               .join(cats.select(F.col("lakeid").alias("right_lake"), F.col("cat").alias("right_cat")),
                     "right_lake")
               .select("left_cat", "right_cat"))
    return G.border_lakes(borders, cats).select("left_lake", "right_lake")


def q_clip_lines(spark, sf_dir):
    streams = _streams(spark, sf_dir)
    pieces = G.clip_lines_outside(streams, _lakes(spark, sf_dir))
    lens = pieces.groupBy("fid").agg(
        F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))).alias("outside_m"))
    ids = streams.select("fid").distinct()
    return (ids.join(lens, "fid", "left")
            .select(F.col("fid").alias("ogc_fid"),
                    F.round(F.coalesce("outside_m", F.lit(0.0)), 6).alias("outside_m")))


def q_exterior_lakes(spark, sf_dir):
    ext = G.exterior_lakes(_lakes(spark, sf_dir))
    a = G.ring_areas(ext).groupBy("fid").agg(F.sum("area").alias("exterior_m2"))
    return a.select(F.col("fid").alias("id"), F.round("exterior_m2", 6).alias("exterior_m2"))


def q_polygon_area(spark, sf_dir):
    a = G.polygon_area_ha(_lakes(spark, sf_dir))
    return a.select(F.col("fid").alias("id"), F.round("area_ha", 6).alias("area_ha"))


def q_line_length(spark, sf_dir):
    a = G.line_length_m(_streams(spark, sf_dir))
    return a.select(F.col("fid").alias("ogc_fid"), F.round("length_m", 6).alias("length_m"))


def q_build_topology(spark, sf_dir):
    return G.build_topology(_streams(spark, sf_dir))


def q_merge_chains(spark, sf_dir):
    register_fixtures(spark, sf_dir)
    lines = spark.table("fx_lines")
    m = G.merge_chains(lines.select("wrid", "line_cat", "from_node", "to_node"),
                       lines.select("wrid", "line_cat", "length_m"))
    return m.select("wrid", "line_cat", "n_lines", F.round("length_m", 6).alias("length_m"))


def q_chain_order(spark, sf_dir):
    """The lines of each chain in order, with their direction."""
    register_fixtures(spark, sf_dir)
    return G.chain_lines(spark.table("fx_lines"))


def q_snap_points(spark, sf_dir):
    ends = _stream_ends(spark, sf_dir)
    ends = ends.select((F.col("pid.ogc_fid") % 5).alias("wrid"),
                       (F.col("pid.ogc_fid") * 2 + F.col("pid.end_no")).alias("pid"), "x", "y")
    return G.snap_points(ends, threshold=20.5, keys=("wrid",))


def q_streams_with_regions(spark, sf_dir):
    return (G.streams_in_regions(_streams(spark, sf_dir), _catchments(spark, sf_dir))
            .select(F.col("line").alias("ogc_fid"), "water_region_id",
                    F.array_join(F.col("water_region_ids").cast("array<string>"), ",").alias("water_region_ids")))


def q_lakes_with_regions(spark, sf_dir):
    return (G.lakes_in_regions(_lakes(spark, sf_dir), _catchments(spark, sf_dir))
            .select("lakeid", "water_region_id",
                    F.array_join(F.col("water_region_ids").cast("array<string>"), ",").alias("water_region_ids")))


QUERIES = {
    "J1_O5_streams_in_regions": q_streams_in_regions,
    "J1_O5_streams_with_regions": q_streams_with_regions,
    "J2_O5_lakes_with_regions": q_lakes_with_regions,
    "J2_lakes_in_regions": q_lakes_in_regions,
    "J3_regions_with_lakes": q_regions_with_lakes,
    "J4_nearest_lake": q_nearest_lake,
    "J7_border_lakes": q_border_lakes,
    "J9_adjacent_lakes": q_shared_borders,
    "J12_clip_lines_outside": q_clip_lines,
    "A1_exterior_lakes": q_exterior_lakes,
    "A2_polygon_area_ha": q_polygon_area,
    "A3_line_length_m": q_line_length,
    "G1_snap_points": q_snap_points,
    "G2_merge_chains": q_merge_chains,
    "G2_chain_order": q_chain_order,
    "G3_build_topology": q_build_topology,
}

_SV = ("fx_catchment", "fx_lake_rect", "fx_stream_line")
_W = with_clause(views=_SV)

_OVERLAP = "l.x1 <= c.x2 AND l.x2 >= c.x1 AND l.y1 <= c.y2 AND l.y2 >= c.y1"
_SHARED = """
SELECT DISTINCT a.id AS left_lake, b.id AS right_lake
FROM fx_lake_rect a JOIN fx_lake_rect b ON a.id < b.id
WHERE ((a.x2 = b.x1 OR a.x1 = b.x2) AND a.y1 = b.y1 AND a.y2 = b.y2)
   OR ((a.y2 = b.y1 OR a.y1 = b.y2) AND a.x1 = b.x1 AND a.x2 = b.x2)"""

ORACLE = {
    "J1_O5_streams_in_regions": _W + """
SELECT DISTINCT s.ogc_fid, c.gid FROM fx_stream_line s JOIN fx_catchment c
ON (c.y1 <= s.y0 AND s.y0 <= c.y2 AND least(s.x0, s.xm) <= c.x2 AND greatest(s.x0, s.xm) >= c.x1)
OR (c.x1 <= s.xm AND s.xm <= c.x2 AND least(s.y0, s.y2) <= c.y2 AND greatest(s.y0, s.y2) >= c.y1)""",
    "J1_O5_streams_with_regions": _W + """
SELECT DISTINCT s.ogc_fid, c.gid AS water_region_id, CAST(c.gid AS VARCHAR) AS water_region_ids
FROM fx_stream_line s JOIN fx_catchment c
ON (c.y1 <= s.y0 AND s.y0 <= c.y2 AND least(s.x0, s.xm) <= c.x2 AND greatest(s.x0, s.xm) >= c.x1)
OR (c.x1 <= s.xm AND s.xm <= c.x2 AND least(s.y0, s.y2) <= c.y2 AND greatest(s.y0, s.y2) >= c.y1)""",
    "J2_O5_lakes_with_regions": _W + f"""
SELECT DISTINCT l.id AS lakeid, c.gid AS water_region_id, CAST(c.gid AS VARCHAR) AS water_region_ids
FROM fx_lake_rect l JOIN fx_catchment c ON {_OVERLAP}""",
    "G1_snap_points": with_clause([
        ("sp_pts", """
SELECT ogc_fid % 5 AS wrid, ogc_fid * 2 AS pid, x0 AS x, y0 AS y FROM fx_stream_line
UNION ALL SELECT ogc_fid % 5, ogc_fid * 2 + 1, xm, y2 FROM fx_stream_line"""),
        ("sp_d", "SELECT DISTINCT wrid, x, y FROM sp_pts"),
        ("sp_c", """
SELECT a.wrid, a.x, a.y, b.x AS bx, b.y AS by FROM sp_d a JOIN sp_d b ON a.wrid = b.wrid
AND abs(a.x - b.x) < 20.5 AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) < 20.5"""),
        ("sp_r", """
SELECT wrid, x, y, x AS rx, y AS ry FROM sp_d
UNION SELECT r.wrid, r.x, r.y, c.bx, c.by FROM sp_r r JOIN sp_c c ON r.wrid = c.wrid AND r.rx = c.x AND r.ry = c.y"""),
        ("sp_m", "SELECT wrid, x, y, min(struct_pack(x := rx, y := ry)) AS m FROM sp_r GROUP BY wrid, x, y"),
    ], views=_SV) + """
SELECT p.wrid, p.pid, m.m.x AS x, m.m.y AS y FROM sp_pts p JOIN sp_m m ON m.wrid = p.wrid AND m.x = p.x AND m.y = p.y""",
    "J2_lakes_in_regions": _W + f"""
SELECT DISTINCT l.id, c.gid FROM fx_lake_rect l JOIN fx_catchment c ON {_OVERLAP}""",
    "J3_regions_with_lakes": _W + f"""
SELECT DISTINCT c.gid FROM fx_catchment c JOIN fx_lake_rect l ON {_OVERLAP}
WHERE c.county IN ({', '.join(repr(x) for x in COUNTIES)})""",
    "J4_nearest_lake": _W + """,
pts AS (SELECT ogc_fid, 0 AS end_no, x0 AS x, y0 AS y FROM fx_stream_line
        UNION ALL SELECT ogc_fid, 1, xm, y2 FROM fx_stream_line),
d AS (SELECT p.ogc_fid, p.end_no, l.id,
             greatest(l.x1 - p.x, 0, p.x - l.x2) AS dx, greatest(l.y1 - p.y, 0, p.y - l.y2) AS dy
      FROM pts p JOIN fx_lake_rect l
      ON p.x BETWEEN l.x1 - 25 AND l.x2 + 25 AND p.y BETWEEN l.y1 - 25 AND l.y2 + 25),
b AS (SELECT ogc_fid, end_no, arg_min(id, (dx * dx + dy * dy, id)) AS lakeid FROM d
      WHERE dx * dx + dy * dy <= 625 GROUP BY ogc_fid, end_no)
SELECT p.ogc_fid, p.end_no, b.lakeid FROM pts p LEFT JOIN b USING (ogc_fid, end_no)""",
    "J7_border_lakes": _W + _SHARED,
    "J9_adjacent_lakes": _W + _SHARED,
    "J12_clip_lines_outside": _W + """,
seg AS (
  SELECT ogc_fid, 0 AS s, 'h' AS o, y0 AS c0, least(x0, xm) AS lo, greatest(x0, xm) AS hi FROM fx_stream_line
  UNION ALL
  SELECT ogc_fid, 1, 'v', xm, least(y0, y2), greatest(y0, y2) FROM fx_stream_line),
iv AS (
  SELECT g.ogc_fid, g.s, greatest(g.lo, CASE g.o WHEN 'h' THEN l.x1 ELSE l.y1 END) AS a,
         least(g.hi, CASE g.o WHEN 'h' THEN l.x2 ELSE l.y2 END) AS b
  FROM seg g JOIN fx_lake_rect l
  ON (g.o = 'h' AND l.y1 <= g.c0 AND g.c0 <= l.y2 AND l.x1 < g.hi AND l.x2 > g.lo)
  OR (g.o = 'v' AND l.x1 <= g.c0 AND g.c0 <= l.x2 AND l.y1 < g.hi AND l.y2 > g.lo)),
run AS (
  SELECT ogc_fid, s, a, b, max(b) OVER (PARTITION BY ogc_fid, s ORDER BY a, b
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
  FROM iv),
cov AS (
  SELECT ogc_fid, s, sum(greatest(0e0, b - greatest(a, coalesce(prev, a)))) AS inside FROM run
  GROUP BY ogc_fid, s)
SELECT g.ogc_fid, round(sum(g.hi - g.lo - coalesce(c.inside, 0e0)), 6) AS outside_m
FROM seg g LEFT JOIN cov c USING (ogc_fid, s) GROUP BY g.ogc_fid""",
    "A1_exterior_lakes": _W + """
SELECT id, round((x2 - x1) * (y2 - y1), 6) AS exterior_m2 FROM fx_lake_rect""",
    "A2_polygon_area_ha": _W + """
SELECT id, round(((x2 - x1) * (y2 - y1) - coalesce(4 * island_half * island_half, 0)) / 10000, 6)
       AS area_ha FROM fx_lake_rect""",
    "A3_line_length_m": _W + """
SELECT ogc_fid, round(abs(xm - x0) + abs(y2 - y0), 6) AS length_m FROM fx_stream_line""",
    # the fixture lines have no closed ring: each chain is walked from an end
    "G2_chain_order": with_clause([
        ("co_end", """
SELECT wrid, line_cat, from_node AS node, 2 * line_cat + 1 AS arrive, 2 * line_cat AS leave FROM fx_lines
UNION ALL SELECT wrid, line_cat, to_node, 2 * line_cat, 2 * line_cat + 1 FROM fx_lines"""),
        ("co_two", "SELECT wrid, node FROM co_end GROUP BY wrid, node HAVING count(*) = 2"),
        ("co_next", """
SELECT a.wrid, a.arrive AS v, b.leave AS w FROM co_two t
JOIN co_end a ON a.wrid = t.wrid AND a.node = t.node
JOIN co_end b ON b.wrid = t.wrid AND b.node = t.node AND b.leave <> a.leave"""),
        ("co_walk", """
SELECT wrid, leave AS first, leave AS p, CAST(0 AS BIGINT) AS pos FROM co_end e
WHERE NOT EXISTS (SELECT 1 FROM co_next n WHERE n.wrid = e.wrid AND n.w = e.leave)
UNION ALL
SELECT c.wrid, c.first, n.w, c.pos + 1 FROM co_walk c JOIN co_next n ON n.wrid = c.wrid AND n.v = c.p"""),
        ("co_whole", "SELECT wrid, first, min(p) AS least FROM co_walk GROUP BY wrid, first HAVING min(p) % 2 = 0"),
    ], views=("fx_lines",)) + """
SELECT c.wrid, w.least // 2 AS chain, c.pos, l.line_cat, c.p % 2 = 1 AS "reversed",
       CASE WHEN c.p % 2 = 1 THEN l.to_node ELSE l.from_node END AS from_node,
       CASE WHEN c.p % 2 = 1 THEN l.from_node ELSE l.to_node END AS to_node
FROM co_walk c JOIN co_whole w ON w.wrid = c.wrid AND w.first = c.first
JOIN fx_lines l ON l.wrid = c.wrid AND l.line_cat = c.p // 2""",
    "G2_merge_chains": with_clause(views=("fx_lines",)) + """,
ends AS (SELECT wrid, line_cat, from_node AS node FROM fx_lines
         UNION ALL SELECT wrid, line_cat, to_node FROM fx_lines),
deg AS (SELECT wrid, node FROM ends GROUP BY wrid, node HAVING count(*) = 2),
links AS (SELECT e.wrid, min(e.line_cat) AS a, max(e.line_cat) AS b FROM ends e
          JOIN deg d USING (wrid, node) GROUP BY e.wrid, e.node),
und AS (SELECT wrid, a, b FROM links UNION SELECT wrid, b, a FROM links),
cc AS (SELECT wrid, line_cat AS v, line_cat AS lbl FROM fx_lines
       UNION SELECT c.wrid, u.b, c.lbl FROM cc c JOIN und u ON u.wrid = c.wrid AND u.a = c.v),
comp AS (SELECT wrid, v, min(lbl) AS k FROM cc GROUP BY wrid, v)
SELECT c.wrid, min(l.line_cat) AS line_cat, count(*) AS n_lines, round(sum(l.length_m), 6) AS length_m
FROM comp c JOIN fx_lines l ON l.wrid = c.wrid AND l.line_cat = c.v GROUP BY c.wrid, c.k""",
    "G3_build_topology": _W + """,
ends AS (SELECT ogc_fid, x0 AS x, y0 AS y, xm AS ex, y2 AS ey FROM fx_stream_line),
pts AS (SELECT x, y, row_number() OVER (ORDER BY x, y) AS node
        FROM (SELECT x, y FROM ends UNION SELECT ex, ey FROM ends) t)
SELECT e.ogc_fid AS line_cat, a.node AS from_node, b.node AS to_node
FROM ends e JOIN pts a ON a.x = e.x AND a.y = e.y JOIN pts b ON b.x = e.ex AND b.y = e.ey""",
}
