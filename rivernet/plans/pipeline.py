"""The sections of the reference as one Spark job each, for all regions:
``gis`` -> ``network_compilation`` -> ``lake_combinations`` -> ``lake_summary``.

Stage cuts are the region-partitioned parquet tables under ``out``; a later
run can start from the saved network (S5) and a rerun for some regions
rewrites only their partitions (S11).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.iterate import cut
from ..operators.network import compile_network
from ..operators.paths import lake_combinations
from ..operators.reports import region_guard
from ..operators.summary import lake_summary
from ..sources import io
from .gis import gis_section

SECTIONS = ("gis", "network_compilation", "lake_combinations", "lake_summary")
#: Products of the gis section and the key their files are sorted by.
GIS_TABLES = {"lines": "line_cat", "nodes": "node_id", "edges": "cat", "adjacency": "left_lake"}


#: Given when read back: a run without any border has no file to tell it.
ADJACENCY = "left_lake bigint, right_lake bigint, wrid bigint"


def _regions(df: DataFrame | None, wrids):
    if df is None or wrids is None:
        return df
    return io.select_region(df, wrids, column="wrid")


def run(spark: SparkSession, out: str, lines: DataFrame | None = None,
        nodes: DataFrame | None = None, edges: DataFrame | None = None,
        adjacency: DataFrame | None = None, wrids=None, sections=None,
        focal: DataFrame | None = None, min_lakes: int = 2,
        features: dict[str, DataFrame] | None = None, gis_options: dict | None = None) -> dict[str, DataFrame]:
    """Run the chosen sections; returns the written tables (read back).
    By default these are all, without gis where no ``features`` are given.

    ``features``: the vertex tables ``catchments``, ``lakes``, ``streams`` and,
    if wanted, the cells ``dem``, as :func:`rivernet.plans.gis.gis_section`
    takes them; ``gis_options`` are its further arguments.  Its products are
    written to ``out/gis`` and are the inputs of what follows; the network
    compilation reads them there if it is given no ``lines``.

    ``lines(wrid, line_cat, from_node, to_node, length_m)``, ``nodes(wrid,
    node_id, lakeid, area_ha)``, ``edges(wrid, cat, length_m, 18 stats)``,
    ``adjacency(wrid, left_lake, right_lake)`` are the products of the gis
    step.  ``wrids`` limits the run to some regions (list or DataFrame);
    without it the run is for the regions of its inputs, or of the guard table
    where it starts from the saved network.  All rows of these regions are
    replaced, also where a region has none any more."""
    results: dict[str, DataFrame] = {}
    sections = sections or (SECTIONS if features else SECTIONS[1:])
    if isinstance(wrids, DataFrame):
        # the region list may be read from a table this run overwrites:
        # store it first so the run does not read files it replaces
        wrids = cut(wrids.select("wrid").distinct(), "wrids")
    if "gis" in sections:
        if features is None:
            raise ValueError("the gis section needs features")
        if wrids is None:
            wrids = cut(features["catchments"].select(F.col("fid").alias("wrid")).distinct(), "wrids")
        made = gis_section(**features, wrids=wrids, **(gis_options or {}))
        for name, key in GIS_TABLES.items():
            io.write_partitioned(made[name], f"{out}/gis/{name}", order=(key,), wrids=wrids)
            results[name] = io.read_partitioned(spark, f"{out}/gis/{name}", wrids, made[name].schema)
        lines, nodes, edges, adjacency = (results[name] for name in GIS_TABLES)
    elif "network_compilation" in sections and lines is None:
        lines, nodes, edges = (io.read_partitioned(spark, f"{out}/gis/{name}", wrids) for name in ("lines", "nodes", "edges"))
        adjacency = io.read_partitioned(spark, f"{out}/gis/adjacency", wrids, ADJACENCY)
    if wrids is None:
        given = ([x.select("wrid") for x in (lines, nodes, edges, adjacency) if x is not None]
                 if "network_compilation" in sections else [io.read_partitioned(spark, f"{out}/regions").select("wrid")])
        wrids = cut(reduce(DataFrame.union, given).distinct(), "wrids")
    if "network_compilation" in sections:
        lines, nodes, edges, adjacency = (_regions(x, wrids) for x in (lines, nodes, edges, adjacency))
        net = compile_network(lines, nodes, edges, adjacency, min_lakes=min_lakes)
        io.save_network(net, f"{out}/network", wrids)
        guard = region_guard(lines, nodes, net, net.arcs.where(F.col("direction") == "downstream"))
        io.write_partitioned(guard, f"{out}/regions", wrids=wrids)
        results["regions"] = io.read_partitioned(spark, f"{out}/regions", wrids)
    net = io.load_network(spark, f"{out}/network", wrids)
    results["vertices"], results["arcs"] = net.vertices, net.arcs
    if "lake_combinations" in sections:
        io.write_combinations(lake_combinations(net, focal=focal), f"{out}/lake_combinations", wrids=wrids)
        results["lake_combinations"] = io.read_partitioned(spark, f"{out}/lake_combinations", wrids)
    if "lake_summary" in sections:
        io.write_summary(lake_summary(net), f"{out}/lake_summary", wrids)
        results["lake_summary"] = io.read_partitioned(spark, f"{out}/lake_summary", wrids)
    return results
