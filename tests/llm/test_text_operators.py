"""Operators that judge each text by itself, against the libraries or brute force."""

from __future__ import annotations

import hashlib
import json
import random
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rivernet.llm import bpe_automaton, html_text, quality_rules, token_counts
from rivernet.llm.common import scratch
from rivernet.llm.presplit import BYTE_RE, split_plain

BYTE_FILE = public_tokenizers.path("byte_bpe_50k.json")
WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "  a", "a  ", "\n\n a 's don't 'sure 'Re''s <|endoftext|> x<|endoftext|>", "a b　c",
       "日本語 é é", "\x00\x01", "½²", "x\r\n\t y", "he'llo", "'", "''", "1'd 2", "🙂🙃", "İ ẞ Å", "word " * 3000]


def random_texts(n: int, seed: int = 1) -> list[str]:
    rnd = random.Random(seed)
    return ["".join(rnd.choice(" \n\t'abcdetsrvlmXéÉ€½1239.,!-¿ß’…ŁŸ") for _ in range(rnd.randint(0, 60)))
            for _ in range(n)]


@pytest.fixture(scope="module")
def documents(spark):
    """Rows with nulls in every column, repeated rows, and columns with clashing names."""
    rows = [(i, t, "en") for i, t in enumerate(ODD + random_texts(40))]
    rows += [(None, "no id", None), (7, None, None), (3, "a  ", "en"), (3, "a  ", "en")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string").select(
        "*", F.lit("x").alias("content"), F.lit(1).alias("row"), F.lit(2).alias("n_tokens"))


def test_vectorised_split_equals_the_pattern():
    plain = [t for t in random_texts(400) if t]
    joined, begin, end, upto = split_plain(plain, keep_space=True)
    at = 0
    for text, to in zip(plain, upto.tolist(), strict=True):
        assert [joined[a:b] for a, b in zip(begin[at:to], end[at:to], strict=True)] == BYTE_RE.findall(text)
        at = to


def test_automaton_accepts_what_the_merges_make():
    rnd = random.Random(4)
    for _ in range(60):
        merges, tokens = [], ["a", "b", "c"]
        for _ in range(rnd.randint(1, 8)):
            pair = rnd.choice(tokens), rnd.choice(tokens)
            if "".join(pair) not in tokens:
                merges.append(pair)
                tokens.append("".join(pair))
        own = bpe_automaton.Automaton(["a", "b", "c"], merges)
        for _ in range(30):
            word = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 12)))
            parts = list(word)
            for left, right in merges:  # apply each merge from left to right, in rank order
                i = 0
                while i + 1 < len(parts):
                    if (parts[i], parts[i + 1]) == (left, right):
                        parts[i:i + 2] = [left + right]
                    i += 1
            assert [own.labels[k] for k in own.encode(word)] == parts


def test_bpe_round_trip_equals_the_library(spark, documents):
    library = Tokenizer.from_file(BYTE_FILE)
    got = bpe_automaton.bpe_round_trip(documents, BYTE_FILE, with_ids=True).collect()
    want = Counter()
    for r in documents.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256(decoded.encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == want
    assert bpe_automaton.bpe_round_trip(documents.limit(0), BYTE_FILE).count() == 0


def test_token_counts_equal_the_library_and_reuse_the_cache(spark, documents):
    library = Tokenizer.from_file(WORD_FILE)
    path = scratch(spark, "test-cache")
    first = token_counts.token_counts(documents, WORD_FILE, path, limit=20).collect()
    want = Counter()
    for r in documents.collect():
        text = r["text"] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        want[r["doc_id"], len(text.encode()), n, n > 20] += 1
    assert Counter(map(tuple, first)) == want
    stored = spark.read.parquet(path)
    n = stored.count()
    assert n == stored.select("content").distinct().count()
    more = documents.select("doc_id", F.concat("text", F.lit("\n\n")).alias("text"))
    assert token_counts.token_counts(more, WORD_FILE, path).where("n_tokens is null").count() == 0
    cache = token_counts.open_cache(spark, path)
    missing = token_counts.encode_misses(documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")),
                                         cache, WORD_FILE, token_counts.file_digest(WORD_FILE))
    assert missing.count() == 0  # every content is in the cache by now
    assert token_counts.token_counts(documents.limit(0), WORD_FILE, path).count() == 0


def test_html_main_text(spark):
    page = ("<html><head><title>T</title><script>var x='<p>no</p>';</script></head><body><nav><ul><li><a href='/'>Home"
            "</a></li></ul></nav><div class='ad'>Buy.</div><article><h1>Head &amp; all</h1><p>One&nbsp;<b>t</b>wo\n three"
            "<br>four.</p><p>&#x41;&lt;p&gt;</p><style>p{}</style></article><section class='comments'><p>Me too.</p>"
            "</section><footer>&copy; us</footer></body></html>")
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (None, "v", "<p"), (1, "u", page), (4, "w", "<<>><!--")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("clash"))
    got = {(r["page_id"], r["url"]): r for r in html_text.extract_main_text(pages).collect()}
    assert got[1, "u"]["text"] == "Head & all One two three four. A<p>"
    assert got[1, "u"]["n_chars"] == len(got[1, "u"]["text"])
    assert got[2, None]["text"] == "" and got[3, "u"]["n_chars"] == 0
    assert html_text.extract_main_text(pages).count() == 6
    assert html_text.extract_main_text(pages.limit(0)).count() == 0


def brute_repeats(words: list[str], least: int) -> tuple[int, int, int]:
    n, best, cover, three = len(words), [], set(), set()
    for i in range(n):
        k_best = 0
        for j in range(n):
            k = 0
            while i != j and i + k < n and j + k < n and words[i + k] == words[j + k]:
                k += 1
            k_best = max(k_best, k)
        best.append(k_best)
        if k_best >= least:
            cover |= set(range(i, i + k_best))
        if k_best >= 3:
            three |= {i, i + 1, i + 2}
    return len(three), len(cover), max(best, default=0)


def test_quality_rules_equal_brute_force(spark):
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice("abc#") for _ in range(rnd.randint(0, 70))) for _ in range(30)]
    texts += ["x y\n \nx y\nz z|<>", "", "\n", "one line\n" * 60]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, None), (2, texts[2])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("kept", F.lit("clash"))
    limits = quality_rules.Limits(least_words=6, covered=0.3, longest=12)
    got = quality_rules.quality_rules(docs, limits).collect()
    want = Counter()
    for i, t in rows:
        text = t or ""
        words = text.encode().split()
        lines = [x for x in text.split("\n") if x.encode().split()]
        three, inside, longest = brute_repeats(words, 6)
        failed = len(words) < 50 or 100 * three > 50 * len(words)
        want[i, len(words), sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"),
             len(lines) - len(set(lines)), three, failed,
             not failed and inside <= 0.3 * len(words) and longest <= 12, inside, longest] += 1
    assert Counter(map(tuple, got)) == want
    assert quality_rules.quality_rules(docs.limit(0)).count() == 0


def test_labelled_pages_are_told_apart():
    from rivernet.llm.html_labels import PAGES

    wrong = total = 0
    for page, main in PAGES:
        found = html_text.blocks(page)
        keep = html_text.decide(html_text.tree(), html_text.describe(found))
        wrong += sum(k != (b.text in main) for b, k in zip(found, keep, strict=True))
        total += len(found)
    assert wrong <= total / 50


def test_byte_characters_are_those_of_the_vocabulary():
    vocabulary = json.load(open(BYTE_FILE))["model"]["vocab"]
    assert set(bpe_automaton.byte_characters()) <= set(vocabulary)
