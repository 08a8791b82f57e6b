"""Token files: the code against plain Huffman coding, files against the library."""

from __future__ import annotations

import heapq
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rivernet.llm import word_ids
from rivernet.llm.common import scratch
from rivernet.llm.token_files import (Code, Layout, code_lengths, read_token_file, store_tokens, token_digests,
                                      write_token_file)

FILE = public_tokenizers.path("byte_bpe_50k.json")


def huffman_cost(counts):
    heap, cost = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a + b
        heapq.heappush(heap, a + b)
    return cost


def least_cost(counts, limit):
    """Every way to give lengths (as many codes as Kraft's sum allows)."""
    counts = sorted(counts, reverse=True)
    best = [10 ** 9]

    def walk(i, low, left, cost):
        if cost >= best[0]:
            return
        if i == len(counts):
            best[0] = cost
            return
        for b in range(low, limit + 1):
            if left >= 2 ** (limit - b):
                walk(i + 1, b, left - 2 ** (limit - b), cost + b * counts[i])

    walk(0, 1, 2 ** limit, 0)
    return best[0]


def test_code_lengths_are_least():
    rnd = random.Random(2)
    for _ in range(60):
        counts = np.array([rnd.choice((1, 2, 3, 5, 50, 900)) for _ in range(rnd.randint(2, 9))])
        assert int((code_lengths(counts, 20) * counts).sum()) == huffman_cost(counts.tolist())
        limit = rnd.randint(max(1, (len(counts) - 1).bit_length()), 5)
        bits = code_lengths(counts, limit)
        assert bits.max() <= limit and (2.0 ** -bits).sum() <= 1
        assert int((bits * counts).sum()) == least_cost(counts.tolist(), limit)
    assert code_lengths(np.array([7]), 4).tolist() == [1]
    with pytest.raises(ValueError):
        code_lengths(np.ones(5), 2)


def test_codes_round_trip():
    rnd = np.random.default_rng(5)
    for alphabet, every in ((1, 3), (2, 1), (40, 7), (3000, 64)):
        ids = np.sort(rnd.choice(70_000, alphabet, replace=False))
        blocks = [rnd.choice(ids, n, p=(w := rnd.random(alphabet) ** 8 + 1e-9) / w.sum()) for n in (1, 2, 500, 4097)]
        kinds, n = np.unique(np.concatenate(blocks), return_counts=True)
        code = Code(kinds, code_lengths(n, 18))
        texts = {int(i): format(int(c) >> (code.longest - int(b)), f"0{int(b)}b")
                 for i, c, b in zip(code.ids, code.left, code.bits, strict=True)}
        packed, marks = [], []
        for own in blocks:
            payload, at = code.encode(own)
            plain = "".join(texts[i] for i in own.tolist())
            assert payload == int(plain.ljust(-(-len(plain) // 8) * 8, "0"), 2).to_bytes(-(-len(plain) // 8), "big")
            packed.append(payload)
            marks.append(at[::every])
        got = code.decode(packed, marks, every)
        assert all((g[:len(b)] == b).all() for g, b in zip(got, blocks, strict=True))


def test_word_ids_equal_the_library(monkeypatch):
    rnd = random.Random(4)
    library = Tokenizer.from_file(FILE)
    rows = ["".join(rnd.choice(" \n\t'abcdetsrvlmXéÉ€½1239.,!-¿ß’…ŁŸ語\x00İ") for _ in range(rnd.randint(0, 60)))
            for _ in range(400)] + ["", "a" * 40_000, "<|endoftext|>", " x" * 3000]
    want = [x.ids for x in library.encode_batch(rows, add_special_tokens=False)]
    for limit, number in ((2_000_000, word_ids.BASE), (30, word_ids.BASE), (2_000_000, 1)):  # 1: all numbers clash
        monkeypatch.setattr(word_ids, "KEPT_WORDS", limit)
        monkeypatch.setattr(word_ids, "BASE", number)
        words = word_ids.WordIds(FILE)
        for _ in range(2):
            assert [x.tolist() for x in words.encode(rows)] == want


def test_query_equals_the_library(spark):
    rnd = random.Random(8)
    odd = ["", " ", "  a", "\n\n a 's don't ''s <|endoftext|> x<|endoftext|>", "日本語 é é", "\x00\x01", "½²", "🙂🙃",
           "word " * 6000, "x\r\n\t y"]
    rows = [(i * 7 % 1009 - 90, rnd.choice(odd) if i % 9 == 0 else
             "".join(rnd.choice(" \n'abcdetsr É1239.,-ß’") for _ in range(rnd.randint(0, 80)))) for i in range(400)]
    rows += [(None, "no id"), (None, "no id"), (5000, None), (5001, ""), (5001, ""), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").select(
        "*", F.lit(1).alias("ids"), F.lit("x").alias("start"), F.lit(2).alias("part"))
    library = Tokenizer.from_file(FILE)

    def encoded(text):
        return library.encode(text or "", add_special_tokens=False).ids + [0]

    path = scratch(spark, "token-file")
    got = token_digests(store_tokens(docs, FILE, path, layout=Layout(block_ids=300, every=16))).collect()
    got.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    crc = sorted((str(i), len(x := encoded(t)), zlib.crc32(np.array(x, dtype="<u4").tobytes())) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == crc
    blocks = spark.read.parquet(f"{path}/blocks")
    assert blocks.count() > 20 and blocks.selectExpr("sum(size(doc_ids))").first()[0] == len(rows)
    assert token_digests(store_tokens(docs.limit(0), FILE, scratch(spark, "token-file"))).collect() == []


def test_ids_of_any_origin(spark):
    rows = [("b", [1, 2 ** 31, 5]), ("a", []), ("a", [9]), (None, [0])]
    frame = spark.createDataFrame([(d, bytearray(np.array(x, dtype="<u4").tobytes())) for d, x in rows],
                                  "doc_id string, ids binary")
    path = scratch(spark, "token-file")
    write_token_file(frame, path)
    got = read_token_file(spark, path, "string").orderBy("start").collect()
    assert sorted((str(r.doc_id), np.frombuffer(r.ids, dtype="<u4").tolist()) for r in got) == sorted(
        (str(d), x) for d, x in rows)
    assert [r.start for r in got] == sorted(r.start for r in got) and got[-1].doc_id == "b"
