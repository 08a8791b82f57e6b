"""Iterative graph operators written as repeated DataFrame joins.

* ``connected_components`` (G7): alternating large-star / small-star rounds
  (Kiveris et al., "Connected Components in MapReduce and Beyond", SoCC
  2014).  O(log^2 n) rounds, independent of the river length, so a long
  main stem does not mean thousands of Spark jobs.
* ``Layers``: the levels of a search as one table (the path search of G9).
* ``reach`` (G6) and ``diameter`` (G14) are in ``doubling``.

Every key is composite: the ``keys`` columns (at least ``wrid``) plus the
vertex id, because vertex ids are unique inside one water region only.
Lineage is cut by writing parquet tables into the session's
``spark.checkpoint.dir`` so a lost executor recomputes a few rounds only.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, work_partitions


def scratch_path(spark, tag: str) -> str:
    """A fresh folder under the session's checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/rivernet-{uuid.uuid4().hex}/{tag}"


def cut(df: DataFrame, tag: str = "t") -> DataFrame:
    """Write ``df`` as a parquet table in the checkpoint folder and read it
    back: one job, lineage cut, and the table survives executor loss."""
    path = scratch_path(df.sparkSession, tag)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def merged(df: DataFrame) -> DataFrame:
    """``df`` with the hint to join it by sorting and merging.  A table that
    grows with the input must not be broadcast: files of ids are many times
    smaller than their rows, so the planner takes them for small ones and
    sends them through the driver."""
    return df.hint("merge")


class Layers:
    """The levels of an iterative search as one table in the checkpoint
    folder, partitioned by ``level`` and bucketed on ``keys``.

    A level is appended once and never rewritten.  Because the table is
    bucketed on the anti-join / dedupe keys, joining a new candidate set
    against *all* earlier levels shuffles only the candidates: the stored
    levels are read bucket by bucket, in place.  Without this, every level
    would re-shuffle everything found so far (depth x result volume)."""

    def __init__(self, spark, tag: str, keys: Sequence[str], buckets: int | None = None):
        self.spark = spark
        self.keys = list(keys)
        self.n = buckets or work_partitions(spark)
        self.path = scratch_path(spark, tag)
        self.name = f"rivernet_{tag}_{uuid.uuid4().hex[:12]}"

    def append(self, df: DataFrame, level: int) -> DataFrame:
        """Store ``df`` as ``level``; returns that level read back."""
        (df.withColumn("level", F.lit(level)).write.mode("append")
         .partitionBy("level").bucketBy(self.n, *self.keys)
         .option("path", self.path).saveAsTable(self.name))
        return self.level(level)

    def all(self) -> DataFrame:
        return merged(self.spark.table(self.name))

    def has(self, level: int) -> bool:
        """Whether ``level`` holds rows (one row of it is looked for)."""
        return not self.level(level).isEmpty()

    def level(self, level: int) -> DataFrame:
        return self.all().where(F.col("level") == level).drop("level")



def connected_components(vertices: DataFrame, edges: DataFrame,
                         keys: Sequence[str] = ("wrid",), vertex: str = "vid",
                         src: str = "src", dst: str = "dst") -> DataFrame:
    """Weak components.  Returns ``keys + [vertex, "component"]`` where
    ``component`` is the smallest vertex id of the component.

    ``edges`` direction and parallel edges do not matter; self-loops are
    ignored.  Vertices without edges are their own component.
    """
    keys = list(keys)
    # undirected pair set, stored as (hi, lo) with hi > lo
    pairs = (edges.where(F.col(src) != F.col(dst))
             .select(*keys, F.greatest(src, dst).alias("hi"), F.least(src, dst).alias("lo"))
             .distinct())
    pairs = merged(cut(pairs))
    while True:  # a round that changes nothing ends it; rounds are logarithmic
        # large-star: every pair (hi, lo) -> (hi, m(lo)), m(u) = smallest neighbour of u or u
        m = pairs.groupBy(*keys, F.col("hi").alias("lo")).agg(F.min("lo").alias("m"))
        large = (pairs.join(m, [*keys, "lo"], "left")
                 .select(*keys, "hi", F.coalesce("m", "lo").alias("lo"))
                 .distinct())
        # small-star: node u with smaller neighbours N links N and u to min(N)
        m2 = large.groupBy(*keys, "hi").agg(F.min("lo").alias("m"))
        small = (large.join(m2, [*keys, "hi"])
                 .select(*keys, F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .where(F.col("hi") != F.col("lo"))
                 .unionByName(m2.select(*keys, "hi", F.col("m").alias("lo")))
                 .distinct())
        small = merged(cut(small))
        # converged when the pairs form stars: no lo is itself a hi, each hi has one lo
        his = small.groupBy(*keys, F.col("hi").alias("x")).agg(F.count("*").alias("n"))
        inner = small.select(*keys, F.col("lo").alias("x")).join(his, [*keys, "x"], "left_semi")
        bad = his.where("n > 1").select(*keys, "x").unionByName(inner).limit(1).count()
        pairs = small
        if bad == 0:
            break
    parent = pairs.select(*keys, F.col("hi").alias(vertex), F.col("lo").alias("component"))
    v = vertices.select(*keys, vertex).distinct()
    return (v.join(parent, [*keys, vertex], "left")
            .select(*keys, vertex, F.coalesce("component", vertex).alias("component")))
