"""Fixture views over the driver's tables.

The river network used by tests, the bench and the registered queries is
derived from the TPC-H-like tables with plain SQL that runs unchanged in
Spark SQL and in DuckDB (``FIXTURES.md``).  ``p_partkey`` is read as a
position on a river: five water regions (``p_partkey % 5``), blocks of 40
nodes, ``k`` the position in a block.  The same text is used to register
Spark temp views and, as common table expressions, in the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Fixed view definitions (must stay equal to FIXTURES.md; portable SQL only).
FIXTURE_VIEWS: dict[str, str] = {
    "fx_node_raw": """
SELECT CAST(p_partkey % 5 AS INT) AS wrid, p_partkey AS node_id,
       CAST(floor(p_partkey / 5) AS BIGINT) AS idx,
       CAST(floor(p_partkey / 5) AS BIGINT) % 40 AS k,
       p_retailprice AS price
FROM part""",
    "fx_nodes": """
SELECT wrid, node_id, lakeid,
       CASE WHEN CAST(floor(lakeid / 5) AS BIGINT) % 40 % 3 = 0
            THEN 0.5e0 + (lakeid % 1000) / 100e0 END AS area_ha
FROM (SELECT wrid, node_id,
             CASE k WHEN 10 THEN node_id - 5 WHEN 5 THEN node_id + 5 ELSE node_id END AS lakeid
      FROM fx_node_raw) t""",
    "fx_lines": """
SELECT wrid, node_id AS line_cat, node_id AS from_node,
       (idx - k + CASE k WHEN 22 THEN 21 ELSE greatest(0, k - 1 - k % 3) END) * 5 + wrid AS to_node,
       100e0 + price AS length_m
FROM fx_node_raw WHERE k NOT IN (0, 39)
UNION ALL
SELECT wrid, 1000000 + node_id, node_id, (idx - k + 11) * 5 + wrid, 250e0 + price
FROM fx_node_raw WHERE k = 19""",
    "fx_adjacency": """
SELECT wrid, node_id AS left_lake, node_id + 15 AS right_lake FROM fx_node_raw WHERE k = 12""",
    "fx_samples": """
SELECT l_partkey AS line_cat, l_extendedprice / 100e0 AS altitude, l_discount AS slope
FROM lineitem
UNION ALL
SELECT 1000000 + l_partkey, l_extendedprice / 90e0, l_tax FROM lineitem
WHERE CAST(floor(l_partkey / 5) AS BIGINT) % 40 = 19""",
    "fx_catchment": """
SELECT n_nationkey AS gid, r_name AS county,
       (n_nationkey % 5) * 1000e0 AS x1, floor(n_nationkey / 5) * 1000e0 AS y1,
       (n_nationkey % 5) * 1000e0 + 1000e0 AS x2, floor(n_nationkey / 5) * 1000e0 + 1000e0 AS y2
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "fx_lake_rect": """
SELECT id, cx - h + (id - k) * 2 * h AS x1, cy - h AS y1,
       cx + h + (id - k) * 2 * h AS x2, cy + h AS y2,
       CASE WHEN id % 4 = 0 THEN h / 2 END AS island_half
FROM (SELECT id, k, (k * 7919) % 5000 + 0e0 AS cx, (k * 104729) % 5000 + 0e0 AS cy, 10e0 + k % 40 AS h
      FROM (SELECT s_suppkey AS id,
                   CASE WHEN s_suppkey % 10 = 9 THEN s_suppkey - 1 ELSE s_suppkey END AS k
            FROM supplier) a) b""",
    "fx_stream_line": """
SELECT ogc_fid, x0, y0, x0 + ogc_fid % 300 AS xm, y0 + ogc_fid % 170 AS y2
FROM (SELECT c_custkey AS ogc_fid, (c_custkey * 3571) % 5000 + 0.25e0 AS x0,
             (c_custkey * 9973) % 5000 + 0.25e0 AS y0 FROM customer) a""",
    "fx_cells": """
SELECT CAST(floor(o_orderkey / 100) AS BIGINT) AS r, o_orderkey % 100 AS c,
       o_totalprice / 1000e0 AS z,
       CASE WHEN (CAST(floor(o_orderkey / 100) AS BIGINT) + 2 * (o_orderkey % 100)) % 3 <> 0
            THEN CAST(floor(o_orderkey / 500) AS BIGINT) * 100 + CAST(floor((o_orderkey % 100) / 5) AS BIGINT)
       END AS cat
FROM orders""",
}

# Views each fixture view reads (for composing CTE chains in the oracle).
_DEPENDS = {
    "fx_nodes": ("fx_node_raw",),
    "fx_lines": ("fx_node_raw",),
    "fx_adjacency": ("fx_node_raw",),
}


def register_base(spark: SparkSession, sf_dir: str, names=BASE_TABLES) -> None:
    for name in names:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def register_fixtures(spark: SparkSession, sf_dir: str) -> None:
    """Register base tables and all fixture views in the session."""
    register_base(spark, sf_dir)
    for name, body in FIXTURE_VIEWS.items():
        spark.sql(f"CREATE OR REPLACE TEMP VIEW {name} AS {body}")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    register_fixtures(spark, sf_dir)
    return spark.table(name)


def cte_chain(*names: str) -> list[tuple[str, str]]:
    """(name, body) pairs for the given views and what they read, in order."""
    wanted: list[str] = []

    def add(n):
        for dep in _DEPENDS.get(n, ()):
            add(dep)
        if n not in wanted:
            wanted.append(n)

    for n in names:
        add(n)
    return [(n, FIXTURE_VIEWS[n].strip()) for n in wanted]


def network_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Inputs of the network compilation, read from the fixture views:
    ``lines``, ``nodes``, ``samples`` (with ``wrid``), ``adjacency``."""
    from pyspark.sql import functions as F

    register_fixtures(spark, sf_dir)
    samples = spark.table("fx_samples").withColumn(
        "wrid", (F.col("line_cat") % 5).cast("int"))
    return {
        "lines": spark.table("fx_lines"),
        "nodes": spark.table("fx_nodes"),
        "samples": samples,
        "adjacency": spark.table("fx_adjacency"),
    }
