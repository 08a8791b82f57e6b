"""Consecutive ids per region without one task per region.

``row_number() over (partition by wrid order by key)`` sorts a whole region in
one task; a region may hold a large share of all rows.  Instead the rows are
range-partitioned on ``(wrid, key)`` over all tasks, numbered inside each
partition, and shifted by the rows of the same region in earlier
partitions.  The offset table has one row per (region, partition), so its
size is bounded by the partition count times the regions in a partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import work_partitions
from .iterate import cut


def consecutive_ids(df: DataFrame, key: str, keys=("wrid",), out: str = "cat",
                    partitions: int | None = None) -> DataFrame:
    """``out`` = 1, 2, ... per ``keys`` in ``key`` order (ties: arbitrary)."""
    keys = list(keys)
    n = partitions or work_partitions(df.sparkSession)
    # one range shuffle; inside a partition the rows are sorted, so the
    # generated id grows with (keys, key) and is dense per partition
    local = (df.repartitionByRange(n, *keys, key)
             .sortWithinPartitions(*keys, key)
             .withColumns({"_pid": F.spark_partition_id(),
                           "_m": F.monotonically_increasing_id()}))
    # the id columns are computed once and stored: a second evaluation could
    # sample other range bounds and number the rows differently
    local = cut(local, "ids")
    counts = local.groupBy(*keys, "_pid").agg(F.count("*").alias("_n"),
                                               F.min("_m").alias("_m0"))
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(
            Window.partitionBy(*keys).orderBy("_pid")
            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (local.join(offsets.select(*keys, "_pid", "_m0", "_off"), [*keys, "_pid"])
            .withColumn(out, (F.col("_off") + F.col("_m") - F.col("_m0") + 1).cast("long"))
            .drop("_pid", "_m", "_m0", "_off"))
