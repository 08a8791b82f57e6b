"""Token counts of whole texts with a digest cache (operator 1).

A cache is a Parquet folder of (tokenizer, content, n_tokens): the SHA-256 of
the tokenizer file and of the normalised text.  Counting joins the digests of
the texts to the cache, encodes one text for each digest that is missing, and
appends the new counts.  Normalising turns each run of blanks, tabs and line
ends into one blank, which this tokenizer's own normaliser does as well.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivernet.llm.common import chunks, ship, texts
from rivernet.llm.presplit import is_plain, split_plain

CACHE_SCHEMA = "tokenizer string, content string, n_tokens bigint"
#: Words whose token number a worker keeps; beyond it the store is emptied.
KEPT_WORDS = 600_000
_BLANKS = "[ \\t\\n\\r]+"


class WordCounter:
    """Counts tokens with the ``tokenizers`` library.  Plain texts are split
    into the library's own words with numpy, and the library encodes each
    distinct word once; it encodes all other texts itself."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words: dict[str, int] = {}

    def _learn(self, words: set[str]) -> None:
        if len(self.words) + len(words) > KEPT_WORDS:
            self.words.clear()
        new = [w for w in words if w not in self.words]
        got = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        self.words.update(zip(new, map(len, got), strict=True))

    def _easy(self, text: str) -> bool:
        return is_plain(text) and not any(s in text for s in self.special)

    def count(self, rows: list[str]) -> list[int]:
        out: list[int] = []
        for _, part in chunks(rows):
            easy = [t.lower() for t in part if self._easy(t)]
            done = iter(self._count_plain(easy))
            out += [next(done) if self._easy(t) else
                    len(self.tokenizer.encode(t, add_special_tokens=False)) for t in part]
        return out

    def _count_plain(self, rows: list[str]) -> list[int]:
        if not rows:
            return []
        joined, begin, end, upto = split_plain(rows, keep_space=False)
        words = [joined[b:e] for b, e in zip(begin, end, strict=True)]
        self._learn(set(words).difference(self.words))
        known, out, at = self.words, [], 0
        if any(w not in known for w in set(words)):  # the store was emptied in between
            self._learn(set(words))
        for to in upto.tolist():
            out.append(sum(map(known.__getitem__, words[at:to])))
            at = to
        return out


@lru_cache(maxsize=2)
def load(path: str) -> WordCounter:
    return WordCounter(path)


def file_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def content_digest(text: Column) -> Column:
    return F.sha2(F.regexp_replace(text, _BLANKS, " "), 256)


def open_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts; an empty folder is made where there is none."""
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(path)
    return spark.read.schema(CACHE_SCHEMA).parquet(path).dropDuplicates(["tokenizer", "content"])


def encode_misses(docs: DataFrame, cache: DataFrame, vocabulary: str, tokenizer: str) -> DataFrame:
    """Cache rows of the distinct contents that ``cache`` lacks.

    Only digests and row ids meet the cache; then the text of one row of each
    missing digest moves to the task that encodes it.  A content that a third
    of all rows share is reduced to one row before each shuffle.
    """
    named = docs.withColumn("content", content_digest(F.col("text")))
    stored = cache.where(F.col("tokenizer") == tokenizer).select("content")
    wanted = (named.groupBy("content").agg(F.min("doc_id").alias("one"))
              .join(stored, "content", "left_anti").withColumnRenamed("content", "miss"))
    chosen = (named.join(wanted, (F.col("doc_id").eqNullSafe(F.col("one")))
                         & (F.col("content") == F.col("miss")), "inner")
              .select("content", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load(vocabulary)
        for batch in batches:
            n = counter.count(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array([tokenizer] * len(n), pa.string()), batch.column("content"), pa.array(n, pa.int64())],
                ["tokenizer", "content", "n_tokens"])

    # rows repeated with their id are encoded alike; one stays
    return (chosen.mapInArrow(run, CACHE_SCHEMA).groupBy("tokenizer", "content")
            .agg(F.max("n_tokens").alias("n_tokens")))


def token_counts(docs: DataFrame, vocabulary: str, cache_path: str, limit: int = 2048,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit.

    A null or empty text has 0 bytes and 0 tokens; repeated rows and ids give
    one row each; other columns are not read.  The counts of contents new to
    the cache are written to ``cache_path`` before the result is read, so a
    later call, or a run repeated after a failure, encodes what is missing.  A
    content that was appended twice counts once.
    """
    spark = docs.sparkSession
    ship(spark)
    source = texts(docs, id_col, text_col)
    tokenizer = file_digest(vocabulary)
    cache = open_cache(spark, cache_path)
    encode_misses(source, cache, vocabulary, tokenizer).write.mode("append").parquet(cache_path)
    counts = (spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
              .where(F.col("tokenizer") == tokenizer)
              .groupBy(F.col("content").alias("stored")).agg(F.max("n_tokens").alias("n_tokens")))
    keys = source.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                         content_digest(F.col("text")).alias("content"))
    return (keys.join(counts, F.col("content") == F.col("stored"), "left")
            .select("doc_id", "n_bytes", F.col("n_tokens"),
                    (F.col("n_tokens") > limit).alias("over_limit")))
