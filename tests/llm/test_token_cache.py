"""A content that stands in the cache twice counts once."""

from __future__ import annotations

import public_tokenizers

from rivernet.llm.common import scratch
from rivernet.llm.token_counts import token_counts

FILE = public_tokenizers.path("word_bpe_49k.json")


def test_repeated_append_keeps_rows(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, "three"), (3, None)], "doc_id bigint, text string")
    path = scratch(spark, "cache")
    first = sorted(map(tuple, token_counts(docs, FILE, path).collect()))
    spark.read.parquet(path).write.parquet(f"{path}-copy")
    spark.read.parquet(f"{path}-copy").write.mode("append").parquet(path)  # as a second writer or a repeated append
    assert sorted(map(tuple, token_counts(docs, FILE, path).collect())) == first and len(first) == 3
