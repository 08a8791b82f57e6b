"""Refresh chosen regions, as a call or driven by a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import pipeline


def refresh(spark: SparkSession, out: str, wrids, sections=None,
            **inputs: DataFrame) -> dict[str, DataFrame]:
    """Re-run ``sections`` for ``wrids`` only; other regions keep their rows."""
    return pipeline.run(spark, out, wrids=wrids, sections=sections, **inputs)


def refresh_on_arrival(spark: SparkSession, requests_dir: str, out: str, checkpoint: str,
                       sections=None, available_now: bool = True,
                       **inputs: DataFrame):
    """Watch ``requests_dir`` for parquet files with a ``wrid`` column; every
    micro-batch refreshes the regions it lists.  The stream checkpoint makes
    a restarted query skip request files already done."""
    stream = spark.readStream.schema("wrid int").parquet(requests_dir)

    def each(batch: DataFrame, _epoch: int) -> None:
        regions = batch.where(F.col("wrid").isNotNull()).select("wrid").distinct()
        if regions.isEmpty():
            return
        refresh(spark, out, regions, sections, **inputs)

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
