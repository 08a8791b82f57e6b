"""Registered source/sink queries (S1, S3, S5-S11): each writes its result
region-partitioned under the session's checkpoint folder and returns the
table read back, so the check covers the write path as well."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.iterate import scratch_path
from ..sources import io
from ..sources.fixtures import register_fixtures
from . import catalog as C
from . import oracle as O
from . import pipeline
from .spatial_queries import COUNTIES, q_lakes_in_regions


def q_read_features(spark, sf_dir):
    register_fixtures(spark, sf_dir)
    f = io.read_features(spark, "fx_catchment", "fx_lake_rect", "fx_stream_line", fmt="table")
    return (f["catchments"].select(F.lit("catchment").alias("kind"), F.col("gid").cast("long").alias("id"))
            .unionByName(f["lakes"].select(F.lit("lake").alias("kind"), F.col("id")))
            .unionByName(f["streams"].select(F.lit("stream").alias("kind"), F.col("ogc_fid").alias("id"))))


def q_select_region(spark, sf_dir):
    register_fixtures(spark, sf_dir)
    regions = (spark.table("fx_catchment").where(F.col("county").isin(*COUNTIES))
               .select(F.col("gid").alias("wrid")))
    return io.select_region(q_lakes_in_regions(spark, sf_dir), regions, column="gid")


def q_save_load_network(spark, sf_dir):
    path = scratch_path(spark, "network")
    io.save_network(C.fixture_network(spark, sf_dir), path)
    v = io.load_network(spark, path).vertices
    return v.select("wrid", "vid", "cluster", "typ", "indegree", "outdegree", "cluster_lake_n")


def q_write_edges(spark, sf_dir):
    path = scratch_path(spark, "edges")
    io.write_edges(C.fixture_edges(spark, sf_dir), path)
    return C._r9(spark.read.parquet(path))


def q_write_nodes(spark, sf_dir):
    path = scratch_path(spark, "nodes")
    io.write_nodes(C._inputs(spark, sf_dir)["nodes"].withColumnRenamed("node_id", "gid"), path)
    return spark.read.parquet(path)


def q_write_combinations(spark, sf_dir):
    path = scratch_path(spark, "combinations")
    io.write_combinations(C.q_lake_combinations(spark, sf_dir), path)
    return spark.read.parquet(path)


def q_write_summary(spark, sf_dir):
    path = scratch_path(spark, "summary")
    io.write_summary(C.q_lake_summary(spark, sf_dir), path)
    return spark.read.parquet(path)


def q_export_layers(spark, sf_dir):
    path = scratch_path(spark, "layers")
    net = C.fixture_network(spark, sf_dir)
    io.export_layers(C.fixture_edges(spark, sf_dir).select("wrid", "cat", "length_m"),
                     net.vertices.select("wrid", "vid", "lakeid"), path, id_name="line_id")
    return spark.read.parquet(f"{path}/lines").select("wrid", "line_id", C.X.fixed_round("length_m")
                                                      .alias("length_m"))


def q_refresh(spark, sf_dir):
    """A full run in which two regions lack half of their lines, then a
    rerun of these two with all lines; the other regions keep their rows."""
    out = scratch_path(spark, "sections")
    inp = C._inputs(spark, sf_dir)
    kw = dict(lines=inp["lines"], nodes=inp["nodes"], edges=C.fixture_edges(spark, sf_dir),
              adjacency=inp["adjacency"])
    from ..streaming.incremental import refresh
    parts, some = ("network_compilation", "lake_summary"), [1, 3]
    old = kw["lines"].where(~F.col("wrid").isin(some) | (F.col("line_cat") % 2 == 0))
    pipeline.run(spark, out, sections=parts, **{**kw, "lines": old})
    refresh(spark, out, some, parts, **kw)
    return C._rounded_areas(spark.read.parquet(f"{out}/lake_summary"))


def q_gis_section(spark, sf_dir):
    """The gis section on the fixture geometry and terrain cells (rows-only
    check: every step in it has its own DuckDB-checked query)."""
    from . import raster_queries as RQ
    from . import spatial_queries as SQ
    from .gis import gis_section
    out = gis_section(SQ._catchments(spark, sf_dir), SQ._lakes(spark, sf_dir),
                      SQ._streams(spark, sf_dir),
                      dem=RQ._cells(spark, sf_dir).select("row", "col", "z"), snap=1.0)
    e = out["edges"].select("wrid", F.col("cat").alias("line_cat"), "altitude_average",
                            "slope_average")
    return out["lines"].join(e, ["wrid", "line_cat"])


def _report(spark, df, schema, columns, sep=" ", header=False):
    """``df`` written as text reports, one folder a region, and read back by S4."""
    path = scratch_path(spark, "report")
    # as in the reports, no value is quoted and an absent one is empty
    (df.select("wrid", *(F.col(c).alias(name) for c, name in zip(columns, schema.names, strict=True)))
     .write.partitionBy("wrid").options(sep=sep, header=header).csv(path))
    return io.read_report(spark, path, schema, sep, header).withColumn("wrid", F.col("wrid").cast(df.schema["wrid"].dataType))


def q_read_topology(spark, sf_dir):
    """Typed read of the line reports."""
    register_fixtures(spark, sf_dir)
    got = _report(spark, spark.table("fx_lines"), io.TOPOLOGY_SCHEMA, ("line_cat", "from_node", "to_node"))
    return got.select("wrid", "line_cat", "from_node", "to_node")


def q_read_vertices(spark, sf_dir):
    """Typed read of the vertex attributes."""
    register_fixtures(spark, sf_dir)
    got = _report(spark, spark.table("fx_nodes"), io.VERTEX_ATTR_SCHEMA, ("node_id", "lakeid", "area_ha"), "|", True)
    return got.select("wrid", "cat", "lakeid", "area_ha")


def q_read_adjacency(spark, sf_dir):
    """The border report, which also has the borders of lakes with no lake (-1 or 0)."""
    register_fixtures(spark, sf_dir)
    both = spark.table("fx_adjacency").select("wrid", "left_lake", "right_lake")
    report = (both.union(both.select("wrid", "left_lake", F.lit(-1))).union(both.select("wrid", F.lit(0), "right_lake")))
    got = _report(spark, report, io.ADJACENCY_SCHEMA, ("left_lake", "right_lake"))
    return io.read_adjacency(got).select("wrid", "left_lake", "right_lake")


QUERIES = {
    "S4_read_topology": q_read_topology,
    "S4_read_vertices": q_read_vertices,
    "S4_read_adjacency": q_read_adjacency,
    "S1_read_features": q_read_features,
    "S1_S6_S7_gis_section": q_gis_section,
    "S3_select_region": q_select_region,
    "S5_save_load_network": q_save_load_network,
    "S6_write_edges": q_write_edges,
    "S7_write_nodes": q_write_nodes,
    "S8_write_combinations": q_write_combinations,
    "S9_write_summary": q_write_summary,
    "S10_export_layers": q_export_layers,
    "S11_refresh_regions": q_refresh,
}

_SV = O.with_clause(views=("fx_catchment", "fx_lake_rect", "fx_stream_line"))
ORACLE = {
    "S1_read_features": _SV + """
SELECT 'catchment' AS kind, CAST(gid AS BIGINT) AS id FROM fx_catchment
UNION ALL SELECT 'lake', id FROM fx_lake_rect
UNION ALL SELECT 'stream', ogc_fid FROM fx_stream_line""",
    "S3_select_region": _SV + f"""
SELECT DISTINCT l.id, c.gid FROM fx_lake_rect l JOIN fx_catchment c
ON l.x1 <= c.x2 AND l.x2 >= c.x1 AND l.y1 <= c.y2 AND l.y2 >= c.y1
WHERE c.county IN ({', '.join(repr(x) for x in COUNTIES)})""",
    "S4_read_vertices": O.with_clause(views=("fx_nodes",)) + """
SELECT wrid, CAST(node_id AS INTEGER) AS cat, CAST(lakeid AS INTEGER) AS lakeid, CAST(area_ha AS DOUBLE) AS area_ha
FROM fx_nodes""",
    "S4_read_adjacency": O.with_clause(views=("fx_adjacency",)) + """
SELECT wrid, CAST(left_lake AS INTEGER) AS left_lake, CAST(right_lake AS INTEGER) AS right_lake FROM fx_adjacency""",
    "S5_save_load_network": O.NETWORK_ORACLE["X15_drop_small_clusters"],
    "S6_write_edges": O.NETWORK_ORACLE["A4_A5_X4_edge_table"],
    "S7_write_nodes": O.with_clause(views=("fx_nodes",)) +
    "SELECT wrid, node_id AS gid, lakeid, area_ha FROM fx_nodes",
    "S8_write_combinations": O.LAKE_COMBINATIONS_SQL,
    "S9_write_summary": O.LAKE_SUMMARY_SQL,
    "S10_export_layers": O.with_clause(views=("fx_lines",)) +
    "SELECT wrid, line_cat AS line_id, r6(length_m) AS length_m FROM fx_lines",
    "S11_refresh_regions": O.LAKE_SUMMARY_SQL,
}
