"""Reference SQL for the correctness gate.

Each registered query has an ANSI-SQL twin that DuckDB runs on the same
parquet tables.  The SQL is built from named common table expressions: the
fixture views (shared text with Spark), then the network compilation
written set-wise (recursive CTEs for components and reachability).  The
SQL is a brute-force restatement of the definitions, not of the Spark plan.
"""

from __future__ import annotations

from ..sources.fixtures import cte_chain

# ---------------------------------------------------------------------------
# network compilation
NETWORK_CTES: list[tuple[str, str]] = [
    ("nw_arcs0", """
SELECT l.wrid, f.lakeid AS src, t.lakeid AS dst, l.line_cat
FROM fx_lines l
JOIN fx_nodes f ON f.wrid = l.wrid AND f.node_id = l.from_node
JOIN fx_nodes t ON t.wrid = l.wrid AND t.node_id = l.to_node"""),
    ("nw_arcs1", "SELECT wrid, src, dst, line_cat FROM nw_arcs0 WHERE src <> dst"),
    ("nw_border", """
SELECT wrid, left_lake AS src, right_lake AS dst FROM fx_adjacency
WHERE left_lake > 0 AND right_lake > 0 AND left_lake <> right_lake
UNION
SELECT wrid, right_lake, left_lake FROM fx_adjacency
WHERE left_lake > 0 AND right_lake > 0 AND left_lake <> right_lake"""),
    ("nw_arcs", """
SELECT wrid, src, dst, line_cat FROM nw_arcs1
UNION ALL
SELECT b.wrid, b.src, b.dst, -1 FROM nw_border b
WHERE NOT EXISTS (SELECT 1 FROM nw_arcs1 a
                  WHERE a.wrid = b.wrid AND a.src = b.src AND a.dst = b.dst)"""),
    ("nw_v0", """
SELECT wrid, lakeid AS vid, lakeid, max(area_ha) AS area_ha FROM fx_nodes GROUP BY wrid, lakeid"""),
    ("nw_v1", """
SELECT wrid, vid, lakeid, area_ha FROM nw_v0
UNION ALL
SELECT DISTINCT b.wrid, b.src, CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE) FROM nw_border b
WHERE NOT EXISTS (SELECT 1 FROM nw_v0 v WHERE v.wrid = b.wrid AND v.vid = b.src)"""),
    ("nw_und", "SELECT wrid, src AS a, dst AS b FROM nw_arcs UNION SELECT wrid, dst, src FROM nw_arcs"),
    ("nw_cc", """
SELECT wrid, vid, vid AS lbl FROM nw_v1
UNION
SELECT c.wrid, u.b, c.lbl FROM nw_cc c JOIN nw_und u ON u.wrid = c.wrid AND u.a = c.vid"""),
    ("nw_comp", "SELECT wrid, vid, min(lbl) AS cluster FROM nw_cc GROUP BY wrid, vid"),
    ("nw_deg", """
SELECT v.wrid, v.vid, v.lakeid, v.area_ha, c.cluster,
       CAST(coalesce(i.n, 0) AS INTEGER) AS indegree, CAST(coalesce(o.n, 0) AS INTEGER) AS outdegree
FROM nw_v1 v
JOIN nw_comp c ON c.wrid = v.wrid AND c.vid = v.vid
LEFT JOIN (SELECT wrid, dst AS vid, count(*) AS n FROM nw_arcs GROUP BY wrid, dst) i
       ON i.wrid = v.wrid AND i.vid = v.vid
LEFT JOIN (SELECT wrid, src AS vid, count(*) AS n FROM nw_arcs GROUP BY wrid, src) o
       ON o.wrid = v.wrid AND o.vid = v.vid"""),
    ("nw_typ", """
SELECT *, CASE WHEN indegree = 0 AND outdegree = 0 THEN 5
               WHEN outdegree = 0 THEN 4
               WHEN indegree > 1 THEN 3
               WHEN indegree = 1 AND outdegree = 1 THEN 2
               WHEN indegree = 0 THEN 1 ELSE 0 END AS typ,
       coalesce(area_ha > 0 AND NOT isnan(area_ha), false) AS lake
FROM nw_deg"""),
    ("nw_cstat", """
SELECT wrid, cluster,
       coalesce(sum(CASE WHEN lake THEN area_ha END), 0e0) AS cluster_lake_area_ha,
       CAST(count(DISTINCT CASE WHEN lake THEN lakeid END) AS INTEGER) AS cluster_lake_n,
       count(*) AS cluster_nv
FROM nw_typ GROUP BY wrid, cluster"""),
    ("nw_vert", """
SELECT t.*, s.cluster_lake_area_ha, s.cluster_lake_n, s.cluster_nv
FROM nw_typ t JOIN nw_cstat s ON s.wrid = t.wrid AND s.cluster = t.cluster
WHERE s.cluster_lake_n >= 2"""),
    ("nw_nat", """
SELECT a.* FROM nw_arcs a
WHERE EXISTS (SELECT 1 FROM nw_vert v WHERE v.wrid = a.wrid AND v.vid = a.src)"""),
]

# reachability both ways from every lake; walks bounded by the cluster size
# (a shortest path has fewer arcs than the cluster has vertices)
REACH_CTES: list[tuple[str, str]] = [
    ("rc_arcs", """
SELECT wrid, 'down' AS dir, src AS a, dst AS b FROM nw_nat
UNION SELECT wrid, 'up', dst, src FROM nw_nat"""),
    ("rc_walk", """
SELECT v.wrid, d.dir, v.vid AS src, v.vid AS v, 0 AS hop, v.cluster_nv AS nv
FROM nw_vert v, (SELECT 'down' AS dir UNION ALL SELECT 'up') d WHERE v.lake
UNION
SELECT w.wrid, w.dir, w.src, a.b, w.hop + 1, w.nv FROM rc_walk w
JOIN rc_arcs a ON a.wrid = w.wrid AND a.dir = w.dir AND a.a = w.v
WHERE w.hop + 1 < w.nv"""),
    ("rc_reach", """
SELECT wrid, dir, src, v, min(hop) AS hop FROM rc_walk WHERE v <> src
GROUP BY wrid, dir, src, v"""),
]


def with_clause(*parts: list[tuple[str, str]], views=()) -> str:
    """WITH RECURSIVE clause of the fixture views ``views`` and the CTE lists."""
    ctes = cte_chain(*views) + [c for p in parts for c in p]
    body = ",\n".join(f"{n} AS (\n{b.strip()}\n)" for n, b in ctes)
    return "WITH RECURSIVE " + body + "\n"


NETWORK_VIEWS = ("fx_nodes", "fx_lines", "fx_adjacency")


LAKE_SUMMARY_SQL = with_clause(NETWORK_CTES, REACH_CTES, views=NETWORK_VIEWS) + """,
rc_attr AS (
SELECT r.*, v.lake, v.area_ha FROM rc_reach r JOIN nw_vert v ON v.wrid = r.wrid AND v.vid = r.v
),
rc_agg AS (
SELECT wrid, src,
       CAST(count(*) FILTER (WHERE dir = 'up') + 1 AS INTEGER) AS neighborhood_size,
       string_agg(CAST(v AS VARCHAR), ',' ORDER BY hop, v) FILTER (WHERE dir = 'down' AND lake)
           AS downstream_lakes,
       CAST(count(*) FILTER (WHERE dir = 'down' AND lake) AS INTEGER) AS downstream_lakes_n,
       sum(area_ha) FILTER (WHERE dir = 'down' AND lake) AS downstream_lakes_area_ha,
       (list(v ORDER BY hop, v) FILTER (WHERE dir = 'down' AND lake))[1] AS first_downstream_lake,
       string_agg(CAST(v AS VARCHAR), ',' ORDER BY hop, v) FILTER (WHERE dir = 'up' AND lake)
           AS upstream_lakes,
       CAST(count(*) FILTER (WHERE dir = 'up' AND lake) AS INTEGER) AS upstream_lakes_n,
       sum(area_ha) FILTER (WHERE dir = 'up' AND lake) AS upstream_lakes_area_ha
FROM rc_attr GROUP BY wrid, src
)
SELECT v.wrid, v.cluster, v.lakeid AS "lakeID", v.typ, v.indegree, v.outdegree,
       coalesce(g.neighborhood_size, 1) AS neighborhood_size,
       round(v.cluster_lake_area_ha, 6) AS cluster_lake_area_ha, v.cluster_lake_n,
       CASE WHEN g.downstream_lakes_n > 0 THEN g.downstream_lakes END AS downstream_lakes,
       CASE WHEN g.downstream_lakes_n > 0 THEN g.downstream_lakes_n END AS downstream_lakes_n,
       CASE WHEN g.downstream_lakes_n > 0 THEN round(g.downstream_lakes_area_ha, 6) END
           AS downstream_lakes_area_ha,
       CASE WHEN g.downstream_lakes_n > 0 THEN g.first_downstream_lake END AS first_downstream_lake,
       CASE WHEN g.upstream_lakes_n > 0 THEN g.upstream_lakes END AS upstream_lakes,
       CASE WHEN g.upstream_lakes_n > 0 THEN g.upstream_lakes_n END AS upstream_lakes_n,
       CASE WHEN g.upstream_lakes_n > 0 THEN round(g.upstream_lakes_area_ha, 6) END
           AS upstream_lakes_area_ha
FROM nw_vert v LEFT JOIN rc_agg g ON g.wrid = v.wrid AND g.src = v.vid
WHERE v.lake
"""


def _stat_sql(col: str, prefix: str) -> str:
    return f"""min({col}) AS {prefix}_minimum, max({col}) AS {prefix}_maximum,
       sum(CAST(round({col} * 1e5) AS BIGINT)) / count({col}) / 1e5 AS {prefix}_average,
       stddev_pop({col}) AS {prefix}_stddev,
       var_pop({col}) AS {prefix}_variance, quantile_disc({col}, 0.25) AS {prefix}_first_quartile,
       median({col}) AS {prefix}_median, quantile_disc({col}, 0.75) AS {prefix}_third_quartile,
       quantile_disc({col}, 0.9) AS {prefix}_percentile_90"""


STAT_NAMES = [f"{p}_{s}" for p in ("altitude", "slope") for s in (
    "minimum", "maximum", "average", "stddev", "variance", "first_quartile", "median",
    "third_quartile", "percentile_90")]


def _zero(c: str, src: str = "s") -> str:
    return f"CASE WHEN {src}.{c} IS NULL OR isnan({src}.{c}) THEN 0e0 ELSE {src}.{c} END AS {c}"


# edge statistics (A4, A5, X4) and arcs with attributes
EDGE_CTES: list[tuple[str, str]] = [
    ("ed_stats", f"""
SELECT CAST(line_cat % 5 AS INT) AS wrid, line_cat,
       {_stat_sql('altitude', 'altitude')},
       {_stat_sql('slope', 'slope')}
FROM fx_samples GROUP BY line_cat"""),
    ("ed_edges", f"""
SELECT l.wrid, l.line_cat AS cat, l.length_m,
       {', '.join(_zero(c) for c in STAT_NAMES)}
FROM fx_lines l LEFT JOIN ed_stats s ON s.wrid = l.wrid AND s.line_cat = l.line_cat"""),
    ("pc_arcs", f"""
SELECT a.wrid, a.src, a.dst, a.line_cat AS cat, coalesce(e.length_m, 0e0) AS length_m,
       {', '.join(f'coalesce(e.{c}, 0e0) AS {c}' for c in STAT_NAMES)}
FROM nw_nat a LEFT JOIN ed_edges e ON e.wrid = a.wrid AND e.cat = a.line_cat"""),
    ("pc_walk", """
SELECT wrid, src AS a, dst AS b, 0 AS lab, cat, CAST(round(length_m * 1000) AS BIGINT) AS len_mm,
       * EXCLUDE (wrid, src, dst, cat) FROM pc_arcs
UNION ALL
SELECT wrid, dst AS a, src AS b, 1 AS lab, cat, CAST(round(length_m * 1000) AS BIGINT) AS len_mm,
       * EXCLUDE (wrid, src, dst, cat) FROM pc_arcs"""),
]

_ARC_T = "STRUCT(dst BIGINT, lab INTEGER, cat BIGINT, src BIGINT)[]"


def _paths_cte(name: str, seeds: str, arcs: str) -> list[tuple[str, str]]:
    """All simple paths from the seeds (brute force), then the best one per
    end by (hops, len_mm, arc list)."""
    return [
        (f"{name}_all", f"""
SELECT wrid, src, src AS v, 0 AS hops, CAST(0 AS BIGINT) AS len_mm,
       CAST([] AS {_ARC_T}) AS arcs, [src] AS vs FROM {seeds}
UNION ALL
SELECT p.wrid, p.src, w.b, p.hops + 1, p.len_mm + w.len_mm,
       list_append(p.arcs, {{'dst': w.b, 'lab': w.lab, 'cat': w.cat, 'src': w.a}}),
       list_append(p.vs, w.b)
FROM {name}_all p JOIN {arcs} w ON w.wrid = p.wrid AND w.a = p.v
WHERE NOT list_contains(p.vs, w.b)"""),
        (f"{name}_best", f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY wrid, src, v
                                            ORDER BY hops, len_mm, arcs) AS rn
               FROM {name}_all) t WHERE rn = 1"""),
    ]


def _dir_sql(lab: int, prefix: str) -> str:
    on = f"FILTER (WHERE lab = {lab})"

    def wavg(c):
        return (f"coalesce(sum({c} * length_m) {on} / nullif(sum(length_m) {on}, 0), 0e0)")

    def cdeg(x):
        return f"CAST(round(degrees(atan({x})) * 100) AS INTEGER)"

    vals = [
        f"CAST(round(sum(len_mm) {on} / 1000e0) AS INTEGER)",
        f"CAST(round(min(altitude_minimum) {on}) AS INTEGER)",
        f"CAST(round({wavg('altitude_average')}) AS INTEGER)",
        f"CAST(round(max(altitude_maximum) {on}) AS INTEGER)",
        cdeg(wavg("slope_average")),
        cdeg(wavg("slope_third_quartile")),
        cdeg(wavg("slope_percentile_90")),
        cdeg(f"max(slope_percentile_90) {on}"),
        cdeg(wavg("slope_maximum")),
        cdeg(f"max(slope_maximum) {on}"),
        cdeg(wavg("slope_stddev")),
    ]
    names = ["length", "altitude_min", "altitude_mean", "altitude_max", "slope_mean",
             "slope_third_quart", "slope_perc_90", "slope_perc_90_max", "slope_max",
             "slope_max_max", "slope_stddev"]
    return ",\n       ".join(
        f"CASE WHEN count(*) {on} > 0 THEN {v} ELSE -9999 END AS {prefix}_{n}"
        for v, n in zip(vals, names))


def combination_ctes(ends_where: str = "lake") -> list[tuple[str, str]]:
    return [
    ("pc_ends", f"SELECT wrid, cluster, vid FROM nw_vert WHERE {ends_where}"),
    ("pc_roots", "SELECT wrid, min(vid) AS src FROM pc_ends GROUP BY wrid, cluster"),
    *_paths_cte("pc_g8", "pc_roots", "pc_walk"),
    ("pc_keep", """
SELECT DISTINCT b.wrid, unnest(b.vs) AS vid FROM pc_g8_best b
JOIN pc_ends e ON e.wrid = b.wrid AND e.vid = b.v"""),
    ("pc_pruned", """
SELECT w.* FROM pc_walk w
WHERE EXISTS (SELECT 1 FROM pc_keep k WHERE k.wrid = w.wrid AND k.vid = w.a)
  AND EXISTS (SELECT 1 FROM pc_keep k WHERE k.wrid = w.wrid AND k.vid = w.b)"""),
    ("pc_seeds", "SELECT wrid, vid AS src FROM pc_ends"),
    *_paths_cte("pc_pp", "pc_seeds", "pc_pruned"),
    ("pc_pairs", """
SELECT b.wrid, b.src AS from_lake, b.v AS to_lake, e.cluster, b.hops, b.len_mm, b.arcs, b.vs
FROM pc_pp_best b JOIN pc_ends e ON e.wrid = b.wrid AND e.vid = b.v
WHERE b.v > b.src"""),
    ("pc_long", """
SELECT p.wrid, p.from_lake, p.to_lake, w.*  EXCLUDE (wrid)
FROM (SELECT wrid, from_lake, to_lake, unnest(arcs) AS arc FROM pc_pairs) p
JOIN pc_walk w ON w.wrid = p.wrid AND w.a = p.arc.src AND w.b = p.arc.dst
              AND w.lab = p.arc.lab AND w.cat = p.arc.cat"""),
    ("pc_stats", f"""
SELECT wrid, from_lake, to_lake,
       CAST(round(sum(len_mm) / 1000e0) AS INTEGER) AS total_stream_length,
       CAST(round(degrees(atan(max(slope_maximum))) * 100) AS INTEGER) AS total_slope_max_max,
       {_dir_sql(1, 'upstream')},
       {_dir_sql(0, 'downstream')}
FROM pc_long GROUP BY wrid, from_lake, to_lake"""),
    ("pc_along", """
SELECT p.wrid, p.from_lake, p.to_lake,
       coalesce(string_agg(CAST(x.vid AS VARCHAR), ',' ORDER BY x.vid) FILTER (WHERE v.lake), '')
           AS lakes_along,
       coalesce(string_agg(CAST(x.vid AS VARCHAR), ',' ORDER BY x.vid) FILTER (WHERE v.typ = 3), '')
           AS confluences_along
FROM pc_pairs p, (SELECT wrid, from_lake, to_lake, unnest(vs) AS vid FROM pc_pairs) x, nw_vert v
WHERE x.wrid = p.wrid AND x.from_lake = p.from_lake AND x.to_lake = p.to_lake
  AND v.wrid = x.wrid AND v.vid = x.vid
GROUP BY p.wrid, p.from_lake, p.to_lake"""),
    ]


COMBINATION_CTES = combination_ctes()

COMBINATION_COLUMNS = (["wrid", "from_lake", "to_lake", "cluster", "lakes_along",
                        "confluences_along", "total_stream_length", "total_slope_max_max"]
                       + [f"{d}_{f}" for d in ("upstream", "downstream") for f in (
                           "length", "altitude_min", "altitude_mean", "altitude_max",
                           "slope_mean", "slope_third_quart", "slope_perc_90",
                           "slope_perc_90_max", "slope_max", "slope_max_max", "slope_stddev")])

COMBINATION_TAIL = f"""
SELECT p.wrid, p.from_lake, p.to_lake, p.cluster, a.lakes_along, a.confluences_along,
       {', '.join('s.' + c for c in COMBINATION_COLUMNS[6:])}
FROM pc_pairs p
JOIN pc_along a USING (wrid, from_lake, to_lake)
JOIN pc_stats s USING (wrid, from_lake, to_lake)
"""
EDGE_VIEWS = NETWORK_VIEWS + ("fx_samples",)
LAKE_COMBINATIONS_SQL = with_clause(NETWORK_CTES, EDGE_CTES, COMBINATION_CTES,
                                    views=EDGE_VIEWS) + COMBINATION_TAIL


# the fixture rivers without bifurcations, borders and merged lakes: trees
TREE_VIEWS: list[tuple[str, str]] = [
    ("ft_lines", "SELECT * FROM fx_lines WHERE line_cat < 1000000"),
    ("ft_nodes", """
SELECT wrid, node_id, node_id AS lakeid,
       CASE WHEN k % 3 = 0 OR k % 7 = 2 THEN 0.5e0 + (node_id % 1000) / 100e0 END AS area_ha
FROM fx_node_raw"""),
    ("ft_adjacency", "SELECT * FROM fx_adjacency WHERE wrid < 0"),
]


def _of_trees(ctes: list[tuple[str, str]]) -> list[tuple[str, str]]:
    out = []
    for name, body in ctes:
        for view, _ in TREE_VIEWS:
            body = body.replace(view.replace("ft_", "fx_"), view)
        out.append((name, body))
    return out


TREE_COMBINATIONS_SQL = with_clause(TREE_VIEWS, _of_trees(NETWORK_CTES), _of_trees(EDGE_CTES), _of_trees(COMBINATION_CTES),
                                    views=EDGE_VIEWS) + COMBINATION_TAIL


def _net(select: str) -> str:
    return with_clause(NETWORK_CTES, views=NETWORK_VIEWS) + select


def _edges(select: str) -> str:
    return with_clause(NETWORK_CTES, EDGE_CTES, views=EDGE_VIEWS) + select


def _pairs(select: str) -> str:
    return with_clause(NETWORK_CTES, EDGE_CTES, COMBINATION_CTES, views=EDGE_VIEWS) + select


def _r9(cols) -> str:
    return ", ".join(f"r6({c}) AS {c}" for c in cols)


def _from(sql: str, cols: str) -> str:
    return f"SELECT {cols} FROM (\n{sql}\n) q"


SLOPE_STATS = ("minimum", "maximum", "average", "stddev", "variance", "first_quartile",
               "median", "third_quartile", "percentile_90")

DIAMETER_CTES = [
    ("dm_walk", """
SELECT wrid, vid AS src, vid AS v, 0 AS hop, cluster_nv AS nv FROM nw_vert
UNION
SELECT w.wrid, w.src, a.dst, w.hop + 1, w.nv FROM dm_walk w
JOIN nw_nat a ON a.wrid = w.wrid AND a.src = w.v
WHERE w.hop + 1 < w.nv"""),
]

FOCAL_COMBINATIONS_SQL = with_clause(
    NETWORK_CTES, EDGE_CTES, combination_ctes("area_ha >= 5"), views=EDGE_VIEWS) + COMBINATION_TAIL

THRESHOLD_SQL = with_clause(NETWORK_CTES, EDGE_CTES, views=EDGE_VIEWS) + """,
th AS (SELECT CAST(i AS INTEGER) AS i, i / 200 AS t FROM range(0, 201) r(i)),
ta AS (SELECT th.i, a.wrid, a.src, a.dst FROM pc_arcs a JOIN th ON a.slope_average <= th.t),
tu AS (SELECT i, wrid, src AS a, dst AS b FROM ta UNION SELECT i, wrid, dst, src FROM ta),
tcc(i, wrid, vid, lbl) AS (
  SELECT th.i, v.wrid, v.vid, v.vid FROM nw_vert v, th
  UNION
  SELECT c.i, c.wrid, u.b, c.lbl FROM tcc c JOIN tu u ON u.i = c.i AND u.wrid = c.wrid AND u.a = c.vid)
SELECT i, i / 200 AS t, wrid, vid, min(lbl) AS cluster FROM tcc GROUP BY i, wrid, vid
"""

#: Lakes of a region: those of its nodes, those on a border, and one far beyond
#: both that no node and no border knows.
REGION_LAKES = """, region_lakes AS (
SELECT wrid, lakeid FROM fx_nodes WHERE area_ha IS NOT NULL
UNION ALL SELECT wrid, left_lake FROM fx_adjacency UNION ALL SELECT wrid, right_lake FROM fx_adjacency
UNION ALL SELECT wrid, 1000000 + max(node_id) FROM fx_nodes WHERE wrid % 2 = 0 GROUP BY wrid)
"""


def _lakes(tail: str) -> str:
    return with_clause(views=("fx_nodes", "fx_adjacency")) + REGION_LAKES + tail


NETWORK_ORACLE: dict[str, str] = {
    "G11_tree_combinations": TREE_COMBINATIONS_SQL,
    "G13_threshold_clusters": THRESHOLD_SQL,
    "G12_lake_summary": LAKE_SUMMARY_SQL,
    "G11_lake_combinations": LAKE_COMBINATIONS_SQL,
    "X7_focal_combinations": FOCAL_COMBINATIONS_SQL,
    "S4_read_topology": with_clause(views=("fx_lines",)) + """
SELECT wrid, CAST(line_cat AS INTEGER) AS line_cat, CAST(from_node AS INTEGER) AS from_node,
       CAST(to_node AS INTEGER) AS to_node FROM fx_lines""",
    "X1_slope_to_cdeg": with_clause(views=("fx_samples",)) + """
SELECT line_cat, slope, CAST(round(degrees(atan(slope)) * 100) AS INTEGER) AS slope_cdeg
FROM fx_samples""",
    "X2_slope_degrees": _edges("SELECT wrid, cat, " + ", ".join(
        f"r6(degrees(atan(slope_{s}))) AS slope_{s}_deg" for s in SLOPE_STATS)
        + " FROM ed_edges"),
    "X3_coerce_scalar": """
WITH t AS (
  SELECT CAST(o_totalprice AS VARCHAR) AS raw FROM orders
  UNION ALL SELECT p_name FROM part
  UNION ALL SELECT CAST(c_custkey AS VARCHAR) FROM customer
), c AS (SELECT raw, TRY_CAST(trim(raw) AS DOUBLE) AS d FROM t)
SELECT raw,
       CASE WHEN d IS NOT NULL AND d = floor(d) AND abs(d) < 9.2e18 THEN CAST(d AS BIGINT) END AS as_long,
       CASE WHEN d IS NOT NULL AND NOT (d = floor(d) AND abs(d) < 9.2e18) THEN d END AS as_double,
       CASE WHEN d IS NULL THEN trim(raw) END AS as_text
FROM c""",
    "X5_assign_node_lake": _lakes("""
SELECT n.wrid, n.node_id,
       coalesce(CASE WHEN n.area_ha IS NOT NULL THEN n.lakeid END, n.node_id + coalesce(m.mx, 0)) AS lakeid
FROM fx_nodes n LEFT JOIN (SELECT wrid, max(lakeid) AS mx FROM region_lakes GROUP BY wrid) m ON m.wrid = n.wrid"""),
    "X6_is_lake": _net("SELECT wrid, vid, lake FROM nw_typ"),
    "X12_canonical_pair": with_clause(views=("fx_adjacency",)) + """
SELECT wrid, greatest(left_lake, right_lake) AS from_lakeid, least(left_lake, right_lake) AS to_lakeid
FROM fx_adjacency""",
    "X14_round_metres": with_clause(views=("fx_lines",)) + """
SELECT wrid, line_cat, CAST(round(length_m) AS INTEGER) AS length_m FROM fx_lines""",
    "G4_collapse_vertices": _net("SELECT wrid, vid, lakeid, area_ha FROM nw_v0"),
    "J6_resolve_endpoints": _net("SELECT wrid, src, dst, line_cat FROM nw_arcs0"),
    "X10_drop_self_loops": _net("SELECT wrid, src, dst, line_cat FROM nw_arcs1"),
    "J10_adjacency_arcs": _net("SELECT wrid, src, dst, line_cat FROM nw_arcs"),
    "U1_distinct_vertices": _net("SELECT wrid, vid, lakeid, area_ha FROM nw_v1"),
    "J8_attach_edge_attrs": _edges(f"""
SELECT a.wrid, a.src, a.dst, a.line_cat AS cat, r6(coalesce(e.length_m, 0e0)) AS length_m,
       {', '.join(f'r6(coalesce(e.{c}, 0e0)) AS {c}' for c in STAT_NAMES)}
FROM nw_arcs a LEFT JOIN ed_edges e ON e.wrid = a.wrid AND e.cat = a.line_cat"""),
    "A4_A5_X4_edge_table": _edges(
        f"SELECT wrid, cat, r6(length_m) AS length_m, {_r9(STAT_NAMES)} FROM ed_edges"),
    "G7_components": _net("SELECT wrid, vid, cluster FROM nw_comp"),
    "A7_X11_degrees_typ": _net("SELECT wrid, vid, indegree, outdegree, typ FROM nw_typ"),
    "A8_cluster_stats": _net("""
SELECT wrid, cluster, round(cluster_lake_area_ha, 6) AS cluster_lake_area_ha, cluster_lake_n
FROM nw_cstat WHERE cluster_lake_n >= 2"""),
    "X15_drop_small_clusters": _net(
        "SELECT wrid, vid, cluster, typ, indegree, outdegree, cluster_lake_n FROM nw_vert"),
    "U2_cluster_set": _net("SELECT DISTINCT wrid, cluster FROM nw_vert"),
    "X9_meant_weight": _net("""
SELECT wrid, src, dst, line_cat, 'downstream' AS direction, 0 AS dir_weight FROM nw_arcs
UNION ALL
SELECT wrid, dst, src, line_cat, 'upstream', 1 FROM nw_arcs"""),
    "G5_X8_X9_U3_arcs": _net("""
SELECT wrid, src, dst, line_cat, 'downstream' AS direction, 0 AS dir_weight FROM nw_nat
UNION ALL
SELECT wrid, dst, src, line_cat, 'upstream', 0 FROM nw_nat"""),
    "A6_max_lake_id": _lakes("SELECT wrid, max(lakeid) AS max_lakeid FROM region_lakes GROUP BY wrid"),
    "J5_attach_lake_area": with_clause(views=("fx_nodes",)) + """
SELECT n.wrid, n.lakeid, n.node_id, l.area_ha
FROM fx_nodes n LEFT JOIN (SELECT DISTINCT wrid, lakeid, area_ha FROM fx_nodes
                           WHERE area_ha IS NOT NULL) l ON l.wrid = n.wrid AND l.lakeid = n.lakeid""",
    "A15_region_guard": _net("""
, rg AS (
  SELECT wrid FROM fx_nodes UNION SELECT wrid FROM fx_lines UNION SELECT wrid FROM nw_arcs
), rg2 AS (
SELECT r.wrid,
       CAST(coalesce((SELECT count(*) FROM fx_lines l WHERE l.wrid = r.wrid), 0) AS BIGINT) AS streams,
       CAST(coalesce((SELECT count(DISTINCT lakeid) FROM fx_nodes n WHERE n.wrid = r.wrid
                            AND n.area_ha > 0), 0) AS BIGINT) AS lakes,
       CAST(coalesce((SELECT count(*) FROM nw_arcs a WHERE a.wrid = r.wrid), 0) AS BIGINT) AS arcs,
       CAST(coalesce((SELECT count(DISTINCT cluster) FROM nw_vert v WHERE v.wrid = r.wrid), 0) AS BIGINT) AS clusters
FROM rg r)
SELECT *, CASE WHEN streams = 0 THEN 'no streams' WHEN lakes < 2 THEN 'fewer than two lakes'
               WHEN arcs = 0 THEN 'no arcs' WHEN clusters = 0 THEN 'no cluster with two lakes'
          END AS skip_reason
FROM rg2"""),
    "A16_X16_network_report": _net("""
SELECT v.wrid, v.cluster, count(*) AS n_vertices,
       coalesce((SELECT count(*) FROM nw_nat a JOIN nw_vert s ON s.wrid = a.wrid AND s.vid = a.src
                 WHERE s.wrid = v.wrid AND s.cluster = v.cluster), 0) AS n_arcs,
       count(DISTINCT CASE WHEN v.lake THEN v.lakeid END) AS n_lakes,
       CAST(count(DISTINCT CASE WHEN v.lake THEN v.lakeid END)
            * (count(DISTINCT CASE WHEN v.lake THEN v.lakeid END) - 1) / 2 AS BIGINT) AS n_pairs,
       count(DISTINCT CASE WHEN v.lake THEN v.lakeid END) <> max(v.cluster_lake_n) AS lake_count_differs
FROM nw_vert v GROUP BY v.wrid, v.cluster"""),
    "O4_assign_category": with_clause(views=("fx_lines",)) + """
SELECT wrid, line_cat, row_number() OVER (PARTITION BY wrid ORDER BY line_cat) AS cat FROM fx_lines""",
    "G6_reach": with_clause(NETWORK_CTES, REACH_CTES, views=NETWORK_VIEWS)
    + "SELECT wrid, dir, src, v, hop FROM rc_reach",
    "G14_diameter": with_clause(NETWORK_CTES, DIAMETER_CTES, views=NETWORK_VIEWS) + """
SELECT wrid, max(h) AS diameter FROM (
  SELECT wrid, src, v, min(hop) AS h FROM dm_walk WHERE v <> src GROUP BY wrid, src, v) t
GROUP BY wrid""",
    "O1_first_downstream_lake": _from(LAKE_SUMMARY_SQL, 'wrid, "lakeID", first_downstream_lake'),
    "O2_ordered_reach_list": _from(LAKE_SUMMARY_SQL, 'wrid, "lakeID", downstream_lakes, upstream_lakes'),
    "A13_reach_totals": _from(LAKE_SUMMARY_SQL, 'wrid, "lakeID", downstream_lakes_n, '
                              'downstream_lakes_area_ha, upstream_lakes_n, upstream_lakes_area_ha'),
    "A14_neighborhood_size": _from(LAKE_SUMMARY_SQL, 'wrid, "lakeID", neighborhood_size'),
    "J11_O3_lake_pairs": _net("""
SELECT a.wrid, a.cluster, a.vid AS from_lake, b.vid AS to_lake
FROM nw_vert a JOIN nw_vert b ON a.wrid = b.wrid AND a.cluster = b.cluster AND a.vid < b.vid
WHERE a.lake AND b.lake"""),
    "G8_prune_to_paths": _pairs("SELECT DISTINCT wrid, vid FROM pc_keep"),
    "G9_shortest_paths": _pairs("""
SELECT wrid, from_lake, to_lake, hops, len_mm,
       array_to_string(list_transform(arcs, lambda x: CAST(x.dst AS VARCHAR) || ':' || CAST(x.lab AS VARCHAR)
                                      || ':' || CAST(x.cat AS VARCHAR)), ',') AS arc_ids
FROM pc_pairs"""),
    "G10_path_subgraph": _pairs("""
SELECT wrid, from_lake, to_lake, CAST(i - 1 AS INTEGER) AS seq, arcs[i].src AS a, arcs[i].dst AS b,
       arcs[i].lab AS lab, arcs[i].cat AS cat
FROM (SELECT *, generate_subscripts(arcs, 1) AS i FROM pc_pairs) t"""),
    "A10_path_totals": _from(LAKE_COMBINATIONS_SQL,
                             "wrid, from_lake, to_lake, total_stream_length, total_slope_max_max"),
    "A11_X13_path_direction_stats": _from(LAKE_COMBINATIONS_SQL, "wrid, from_lake, to_lake, " + ", ".join(
        c for c in COMBINATION_COLUMNS if c.startswith(("upstream", "downstream")))),
    "A12_lakes_along": _from(LAKE_COMBINATIONS_SQL,
                             "wrid, from_lake, to_lake, lakes_along, confluences_along"),
}


def expand_r6(sql: str) -> str:
    """Write ``r6(e)`` out as ``floor((e) * 1e6 + 0.5) / 1e6`` (the rounding
    of ``functions.exprs.fixed_round``), keeping the SQL a single statement."""
    out, i = [], 0
    while True:
        j = sql.find("r6(", i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 3])
            i = j + 3
            continue
        depth, k = 1, j + 3
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = expand_r6(sql[j + 3:k - 1])
        out.append(sql[i:j] + f"(floor(({inner}) * 1e6 + 0.5) / 1e6)")
        i = k
