"""Operators over whole tables, against brute force on small fixtures."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivernet.llm import decontaminate, jaccard_join, langid, lm_score, suffix_dedup, toxicity
from rivernet.llm.induced_sort import repeated_starts, sort_suffixes

SCHEMA = "doc_id bigint, text string, lang string"


def words(rnd: random.Random, n: int, letters: str = "abcdef") -> str:
    return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus() -> list[tuple[int | None, str | None, str | None]]:
    """Copies, near copies, shared passages, self-repeats, blank and null texts, repeated rows."""
    rnd = random.Random(8)
    base, passage = words(rnd, 60), words(rnd, 70)
    rows: list[tuple[int | None, str | None, str | None]] = []
    for i in range(40):
        kind = i % 8
        text = words(rnd, rnd.randint(1, 90))
        if kind == 0:
            text = base
        elif kind == 1:
            w = base.split()
            for _ in range(rnd.randint(1, 3)):
                w[rnd.randrange(len(w))] = "zz"
            text = " ".join(w)
        elif kind == 2:
            text = words(rnd, 15) + " " + passage + " " + words(rnd, 5)
        elif kind == 3:
            text = "é" * 230 + text
        elif kind == 4 and i > 20:
            text = "ABC  abc \n" * 40
        rows.append((i, text, "en"))
    return rows + [(40, None, None), (41, "", "en"), (42, " \n", None), (None, base, None), (5, rows[5][1], "en"),
                   (43, "one two", "en"), (44, "One TWO", "en")]


@pytest.fixture(scope="module")
def documents(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(3).withColumns(
        {"row": F.lit("clash"), "set": F.lit(1), "words": F.lit(2), "label": F.lit(0)})


def brute_removed(texts: list[bytes], length: int) -> list[np.ndarray]:
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        out.append(gone)
    return out


def test_induced_sorting_equals_plain_sorting():
    rnd = random.Random(1)
    for _ in range(150):
        n = rnd.randint(1, 60)
        text = [rnd.randint(1, rnd.choice([2, 3, 5])) for _ in range(n)] + [0]
        at, lcp = sort_suffixes(np.array(text), 1, 1000, memory=rnd.choice([30, 10**9]), direct=rnd.choice([2, 10**6]))
        want = sorted(range(n + 1), key=lambda i: text[i:])[1:]
        assert at.tolist() == want
        for a, b, k in zip(want, want[1:], lcp[1:].tolist(), strict=False):
            assert text[a:a + k] == text[b:b + k] and text[a + k] != text[b + k]
    blocks = [b"", b"abcabcabc", b"xxabcay", b"\x00\xff" * 9, b""]
    seen = Counter(b[i:i + 4] for b in blocks for i in range(len(b) - 3))
    assert [x.tolist() for x in repeated_starts(blocks, 4, memory=20, direct=3)] == [
        [i for i in range(len(b) - 3) if seen[b[i:i + 4]] > 1] for b in blocks]


def test_suffix_dedup_equals_brute_force(spark, documents, corpus):
    got = suffix_dedup.remove_repeats(documents, with_text=True, carry=("lang",)).collect()
    raw = [(t or "").encode() for _, t, _ in corpus]
    want = Counter()
    for (i, _, lang), t, gone in zip(corpus, raw, brute_removed(raw, 200), strict=True):
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        want[i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore"), lang] += 1
    assert Counter(map(tuple, got)) == want
    assert sum(r["n_removed"] > 0 for r in got) > 10
    assert suffix_dedup.remove_repeats(documents.limit(0)).count() == 0


def test_pieces_of_long_texts_meet(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 300)
    rnd = random.Random(2)
    text = bytes(rnd.choice(b"abcd") for _ in range(1500))
    found = np.concatenate(list(suffix_dedup.text_blocks([9], [text], 50, 8)))
    starts = sorted(s for b in found for s in range(int(b["start"]), int(b["start"] + b["windows"])))
    assert starts == list(range(1500 - 50 + 1))


def brute_components(corpus) -> dict[int, int]:
    sets = []
    for _, t, _ in corpus:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(sets)))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                root[find(i)] = find(j)
    least: dict[int, int] = {}
    for k, (i, _, _) in enumerate(corpus):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return Counter((corpus[k][0], len(s), least.get(find(k), corpus[k][0])) for k, s in enumerate(sets))


@pytest.mark.parametrize("hot, chain, block", [(jaccard_join.HOT, jaccard_join.LIST, jaccard_join.BLOCK), (3, 2, 60)])
def test_jaccard_components_equal_brute_force(documents, corpus, hot, chain, block):
    got = jaccard_join.jaccard_components(documents, hot=hot, chain=chain, block=block).collect()
    assert Counter(map(tuple, got)) == brute_components(corpus)


def test_jaccard_of_an_empty_table(documents):
    assert jaccard_join.jaccard_components(documents.limit(0)).count() == 0


def test_t_occurrence_in_blocks():
    rnd = random.Random(5)
    for _ in range(60):
        base = [rnd.sample(range(60), rnd.randint(4, 40)) for _ in range(3)]
        plain = [sorted(set(rnd.choice(base)) ^ set(rnd.sample(range(60), rnd.randint(0, 3)))) for _ in range(20)]
        plain = [p for k, p in enumerate(plain) if p and p not in plain[:k]]
        sets = [np.array(p, dtype=np.uint64) << np.uint64(50) for p in plain]
        n, blocks = len(sets), [k % 3 for k in range(len(sets))]
        links = {(i, j) for i in range(n) for j in range(i)
                 if 100 * len(set(plain[i]) & set(plain[j])) >= 75 * len(set(plain[i]) | set(plain[j]))}
        got = [x for a in range(3) for b in range(a, 3) for ix in [[k for k in range(n) if blocks[k] in (a, b)]]
               for x in jaccard_join.block_links(ix, [sets[k] for k in ix], [blocks[k] for k in ix])]
        assert {(max(x), min(x)) for x in got} <= links
        for pairs in (links, got):
            root = list(range(n))
            for i, j in pairs:
                a, b = jaccard_join._root(root, i), jaccard_join._root(root, j)
                root[max(a, b)] = min(a, b)
            if pairs is links:
                want = [jaccard_join._root(root, i) for i in range(n)]
        assert [jaccard_join._root(root, i) for i in range(n)] == want


def test_decontamination_equals_brute_force(spark):
    rnd = random.Random(6)
    items = [(i, words(rnd, rnd.randint(1, 16), "ab")) for i in range(12)] + [(None, "a"), (50, None), (51, ""), (1, "b b")]
    docs = [(i, words(rnd, rnd.randint(0, 12), "ab") + "\n" + (rnd.choice(items)[1] or "").upper() + "! é" + words(rnd, 9, "ab"))
            for i in range(40)] + [(60, None), (None, "..."), (3, "a")]
    got = decontaminate.contamination(
        spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("words", F.lit(1)),
        spark.createDataFrame(items, "item_id bigint, text string").withColumn("window", F.lit(1)), window=5).collect()
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def of(t: str | None) -> list[str]:
        return pattern.findall("".join(c.lower() if c.isascii() else c for c in t or ""))
    want = Counter()
    for i, t in docs:
        w, hit, found = of(t), set(), set()
        for item, text in items:
            q = of(text)
            for k in range(max(1, len(q) - 4) if q else 0):
                x = q[k:k + 5]
                for s in range(len(w) - len(x) + 1):
                    if w[s:s + len(x)] == x:
                        hit |= set(range(s, s + len(x)))
                        found.add("" if item is None else str(item))
        want[i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)] += 1
    assert Counter(map(tuple, got)) == want
    empty = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert decontaminate.contamination(some, empty).where("contaminated").count() == 0
    assert decontaminate.contamination(some.limit(0), empty).count() == 0


def test_proximity(spark):
    store = decontaminate.training_texts(spark.createDataFrame(
        [(1, "q red w blue green"), (2, "red blue green"), (3, "red x x x x x blue green"), (4, "red")], "doc_id int, text string"))
    windows = decontaminate.benchmark_windows(spark.createDataFrame([(9, "red blue green")], "item_id int, text string"), 10)
    near = decontaminate.proximity_matches(store, windows, within=2).join(store, "row").select("doc_id").distinct()
    assert {r[0] for r in near.collect()} == {1, 2}
    exact = decontaminate.phrase_matches(store, windows).join(store, "row").select("doc_id")
    assert [r[0] for r in exact.collect()] == [2]


def test_language_identification(spark):
    rnd = random.Random(7)
    letters = {"aa": "abcde", "bb": "fghij", "cc": "klmno"}
    rows = [(i, words(rnd, rnd.randint(8, 40), letters[lang]), lang) for i, lang in enumerate(list(letters) * 60)]
    rows += [(900, None, "aa"), (901, "123 --", "bb"), (902, "fg hi", None), (None, "ab ab", None), (1, rows[1][1], "bb")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("clash"))
    got = {r["doc_id"]: r for r in langid.identify_language(docs, bits=10).collect()}
    held = [(r[2], got[r[0]]) for r in rows[:180] if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert len(held) > 30 and all(g["held_out"] for _, g in held)
    assert sum(lang == g["lang_pred"] for lang, g in held) >= 0.95 * len(held)
    assert all(0 <= g["score"] <= 1 for g in got.values())
    assert got[900]["lang_pred"] == got[901]["lang_pred"] == "und" and got[902]["lang_pred"] == "bb"
    assert langid.identify_language(docs.where("doc_id in (900, 902)")).where("lang_pred = 'und'").count() == 2
    assert langid.identify_language(docs.limit(0)).count() == 0


def test_block_max_search_is_exact():
    rnd = np.random.default_rng(3)
    rows = []
    for _ in range(200):
        at = np.sort(rnd.choice(30, rnd.integers(1, 6), replace=False))
        v = rnd.random(len(at))
        rows.append((at, v / np.sqrt(v @ v)))
    index = toxicity.BlockMaxIndex(rows, 30, block=16)
    for at, v in rows[:40]:
        dense = np.zeros(30)
        dense[at] = v
        score = [(-float(dense[a] @ w), i) for i, (a, w) in enumerate(rows) if dense[a] @ w > 0]
        assert [i for _, i in index.nearest(at, v, 7)] == [i for _, i in sorted((round(s, 12), i) for s, i in score)[:7]] or \
            np.allclose([s for s, _ in index.nearest(at, v, 7)], [-s for s, _ in sorted(score)[:7]])


def test_toxicity(spark):
    rnd = random.Random(9)
    docs, labels = [], []
    for i in range(240):
        toxic = i % 4 == 0
        docs.append((i, words(rnd, 40) + (" vilewordx nastyone " if toxic else " ") + words(rnd, 10), "en"))
        labels.append((i, int(toxic)))
    docs += [(500, None, None), (501, "", "en"), (None, "vilewordx nastyone", None), (0, docs[0][1], "en")]
    labels += [(500, None), (None, 1), (1, 0)]
    frame = spark.createDataFrame(docs, SCHEMA).withColumn("toxic", F.lit(1))
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int").withColumn("text", F.lit("clash"))
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(frame, known).collect()}
    assert all(got[i]["predicted"] == (i % 4 == 0) for i in range(240))
    assert got[None]["predicted"] == 1 and got[500]["predicted"] == got[501]["predicted"] == 0
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items() if i is not None)
    assert set(got[4]["evidence"]) <= {i for i in range(0, 240, 4)}
    none = toxicity.score_toxicity(frame, known.where("toxic = 0"))
    assert none.where("score <> 0 or predicted <> 0").count() == 0
    assert toxicity.score_toxicity(frame.limit(0), known).count() == 0


def test_language_model_scores(spark, documents, corpus):
    got = lm_score.score_texts(documents, words=20, tails=8, store=30).collect()
    count: Counter[bytes] = Counter()
    for i, t, _ in corpus:
        if zlib.crc32(str("" if i is None else i).encode()) % 7 != 2:
            count.update(lm_score.tokens(t or ""))
    n, v = sum(count.values()), len(count)
    want = Counter()
    for i, t, _ in corpus:
        own = lm_score.tokens(t or "")
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own)
        held = zlib.crc32(str("" if i is None else i).encode()) % 7 == 2
        want[i, held, len(own), sum(count[w] > 0 for w in own), n, round(base, 6)] += 1
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
                   for r in got) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    assert lm_score.score_texts(documents.limit(0)).count() == 0
    alone = lm_score.score_texts(documents, learn_from=F.lit(False)).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == 0 for r in alone)


def test_probabilities_are_normalised():
    model = lm_score.LogBilinear(np.array([5, 3, 2, 9]), size=4)
    context = np.array([[0, 1]] * 4)
    assert abs((10 ** model.log10_probabilities(context, np.arange(4))).sum() - 1) < 1e-6
