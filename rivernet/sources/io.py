"""Sources and sinks.

Results are parquet tables partitioned by ``wrid``; a rewrite of some
regions replaces exactly their partitions (dynamic partition overwrite), also
those of regions that have no row any more; the other regions stay as they
were.  Writers range-partition on ``(wrid, key)``
first, so a very large region is spread over many tasks and files while
small regions share tasks.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import MISSING
from ..operators.iterate import cut, merged
from ..session import work_partitions

# ---------------------------------------------------------------------------
# schemas of the reports read by S4 (fixed column names and types)
TOPOLOGY_SCHEMA = T.StructType([
    T.StructField("line_cat", T.IntegerType()),
    T.StructField("from_node", T.IntegerType()),
    T.StructField("to_node", T.IntegerType()),
])
VERTEX_ATTR_SCHEMA = T.StructType([
    T.StructField("cat", T.IntegerType()),
    T.StructField("lakeid", T.IntegerType()),
    T.StructField("area_ha", T.DoubleType()),
])
ADJACENCY_SCHEMA = T.StructType([
    T.StructField("left_lake", T.IntegerType()),
    T.StructField("right_lake", T.IntegerType()),
])


def read_table(spark: SparkSession, source: str, fmt: str = "parquet",
               options: dict | None = None) -> DataFrame:
    """One input: a catalog table (``fmt="table"``), a JDBC table
    (``fmt="jdbc"``, ``options`` with url/user/...) or files."""
    if fmt == "table":
        return spark.table(source)
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(dbtable=source, **(options or {})).load()
    return spark.read.options(**(options or {})).format(fmt).load(source)


def read_features(spark: SparkSession, catchments: str, lakes: str, streams: str,
                  fmt: str = "parquet", options: dict | None = None) -> dict[str, DataFrame]:
    """The three feature tables, given by name or path."""
    return {name: read_table(spark, src, fmt, options)
            for name, src in (("catchments", catchments), ("lakes", lakes), ("streams", streams))}


def require_tables(spark: SparkSession, names: Iterable[str]) -> None:
    """Stop before any work if an input table is missing."""
    missing = [n for n in names if not spark.catalog.tableExists(n)]
    if missing:
        raise ValueError(f"missing input tables: {', '.join(missing)}")


def select_region(df: DataFrame, wrids, column: str = "gid") -> DataFrame:
    """S3: rows of the given regions.  ``wrids`` is a list (pushed into the
    scan as an ``IN`` filter) or a DataFrame with a ``wrid`` column (semi-join)."""
    if isinstance(wrids, DataFrame):
        return df.join(wrids.select(F.col("wrid").alias(column)).distinct(), column, "left_semi")
    return df.where(F.col(column).isin(list(wrids)))


def read_report(spark: SparkSession, path: str, schema: T.StructType, sep: str = " ",
                header: bool = False) -> DataFrame:
    """Typed read of a text report (no schema inference)."""
    return spark.read.schema(schema).option("sep", sep).option("header", header).csv(path)


def read_adjacency(df: DataFrame) -> DataFrame:
    """Lake border pairs, only where both sides are lakes."""
    return df.where((F.col("left_lake") > 0) & (F.col("right_lake") > 0))


def write_partitioned(df: DataFrame, path: str, order=(), partitions: int | None = None,
                      mode: str = "overwrite", wrids=None) -> None:
    """Write ``df`` partitioned by ``wrid``; an overwrite replaces only the
    regions present in ``df`` (S6-S9, S11).  With ``wrids`` (list or
    DataFrame) the old rows of these regions go even where ``df`` has none."""
    spark = df.sparkSession
    n = partitions or work_partitions(spark)
    if wrids is not None:
        df = cut(df, "rows")  # may be read from the table that is rewritten
    out = df.repartitionByRange(n, "wrid", *order).sortWithinPartitions("wrid", *order)
    (out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy("wrid").parquet(path))
    if wrids is not None:
        stored = select_region(spark.read.schema(df.schema).parquet(path), wrids, column="wrid").select("wrid").distinct()
        empty = spark.createDataFrame([], df.drop("wrid").schema)
        # one folder for each region that became empty
        for row in stored.join(df.select("wrid").distinct(), "wrid", "left_anti").collect():
            empty.write.mode("overwrite").parquet(f"{path}/wrid={row['wrid']}")


def read_partitioned(spark: SparkSession, path: str, wrids=None, schema=None) -> DataFrame:
    """Read a ``wrid``-partitioned table; a region list prunes partitions.  With
    a ``schema`` the table may be without files."""
    df = spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)
    if wrids is None:
        return df
    return select_region(df, wrids, column="wrid")


def write_edges(edges: DataFrame, path: str, wrids=None) -> None:
    """Edges of the regions in ``edges`` (and of ``wrids``) replace their old rows."""
    write_partitioned(edges, path, order=("cat",), wrids=wrids)


def write_nodes(nodes: DataFrame, path: str, wrids=None) -> None:
    """As S6 for the vertices."""
    write_partitioned(nodes, path, order=("gid",) if "gid" in nodes.columns else ("vid",), wrids=wrids)


def write_combinations(pairs: DataFrame, path: str, sentinel: int | None = MISSING, wrids=None) -> None:
    """Lake pairs; sorted inside files by ``from_lake, to_lake`` so that
    parquet min/max statistics prune look-ups by lake.  ``sentinel``
    replaces the -9999 of an absent direction (``None`` writes NULL)."""
    if sentinel != MISSING:
        cols = [c for c in pairs.columns if c.startswith(("upstream_", "downstream_"))]
        pairs = pairs.withColumns({c: F.when(F.col(c) != MISSING, F.col(c)).otherwise(
            F.lit(sentinel)).cast(pairs.schema[c].dataType) for c in cols})
    write_partitioned(pairs, path, order=("from_lake", "to_lake"), wrids=wrids)


def write_summary(summary: DataFrame, path: str, wrids=None) -> None:
    """Per-lake summary."""
    write_partitioned(summary, path, order=("lakeID",), wrids=wrids)


def save_network(network, path: str, wrids=None) -> None:
    """The compiled graph as two region-partitioned tables."""
    write_partitioned(network.vertices, f"{path}/vertices", order=("vid",), wrids=wrids)
    write_partitioned(network.arcs, f"{path}/arcs", order=("src",), wrids=wrids)


def load_network(spark: SparkSession, path: str, wrids=None):
    """Reload a saved graph (partition-pruned to ``wrids``)."""
    from ..operators.network import Network
    return Network(merged(read_partitioned(spark, f"{path}/vertices", wrids)),
                   merged(read_partitioned(spark, f"{path}/arcs", wrids)))


def export_layers(edges: DataFrame, nodes: DataFrame, path: str, id_name: str = "cat", wrids=None) -> None:
    """Line and point layers with the id column under a chosen name;
    ``wrids`` as in :func:`write_partitioned`."""
    write_partitioned(edges.withColumnRenamed("cat", id_name), f"{path}/lines", order=(id_name,), wrids=wrids)
    key = "vid" if "vid" in nodes.columns else "gid"
    write_partitioned(nodes.withColumnRenamed(key, id_name), f"{path}/points", order=(id_name,), wrids=wrids)
