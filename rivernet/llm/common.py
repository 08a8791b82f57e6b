"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivernet.session import ensure_checkpoint_dir

#: The characters that the contracts call white space.
ASCII_SPACE = " \t\n\x0b\x0c\r"
_KEPT: list[Callable] = []


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package when the session was started
    elsewhere; on a cluster the package is installed or passed as --py-files."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)


def kept(load: Callable) -> Callable:
    """A cached function whose value a worker keeps for its next task of the
    same kind; tasks of another kind let go of it (:func:`lean`)."""
    _KEPT.append(load)
    return load


def give_back(keeps: Callable | None = None) -> None:
    """Free what is :func:`kept` but for ``keeps``, and return freed memory to the system."""
    for load in _KEPT:
        if load is not keeps:
            load.cache_clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keeps: Callable | None = None
         ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``.  Python workers are used again by the tasks
    of later stages, and what they hold adds up on an executor: a task begins
    and ends without the memory of others, but for what it ``keeps``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back(keeps)
        yield from run(batches)
        give_back(keeps)

    return task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns ``doc_id, text`` of any table; a null text becomes empty."""
    return docs.select(docs[id_col].alias("doc_id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A digest of id and text; a null text counts as an empty one.  Rows have
    one key only if they are repeated with both."""
    return F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def fold(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % n


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage ends here."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, name: str) -> DataFrame:
    """:func:`cut`, and the shuffle files of the write go as it ends, not when
    the driver happens to collect its garbage."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return cut(df, name)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def free(df: DataFrame) -> None:
    """Empty the folder of a frame made by :func:`cut` that is read no more."""
    spark = df.sparkSession
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        df.limit(0).write.mode("overwrite").parquet(path + "-freed")
        spark.read.schema(df.schema).parquet(path + "-freed").write.mode("overwrite").parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def chunks(values: list[str], limit: int = 4_000_000) -> Iterator[tuple[int, list[str]]]:
    """Runs of rows of about ``limit`` characters (one row at least): a bound
    on what a vectorised step holds at once, not on what it reads."""
    first, size = 0, 0
    for i, v in enumerate(values):
        if size and size + len(v) > limit:
            yield first, values[first:i]
            first, size = i, 0
        size += len(v)
    if first < len(values):
        yield first, values[first:]
