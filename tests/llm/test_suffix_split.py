"""A leading hash of very many blocks is split, with the same result."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np

from rivernet.llm import suffix_dedup


def removed(texts: list[bytes], length: int) -> list[int]:
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        out.append(int(gone.sum()))
    return out


def test_a_crowded_leader_is_split(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD", 4000)
    rnd = random.Random(3)

    def some(n: int) -> str:
        return "".join(rnd.choice("abcdefgh ") for _ in range(n))
    shared = some(150)
    texts = [some(180) + shared + some(180) for _ in range(50)]
    texts += [texts[3][40:420] + some(20), texts[3][100:480], "é" * 250, some(40) + shared + "ab" * 300, some(260), some(260)]
    texts += [texts[5], texts[-1]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    crowds, largest = [], []
    crowded_leads = suffix_dedup.crowded_leads

    def watched(asked, length, most):
        out = crowded_leads(asked, length, most)
        crowds.append(out.count())
        rest = asked.join(out, asked["lead"] == out["crowd"], "left_anti").groupBy("lead").sum("windows").collect()
        largest.append(max(r[1] for r in rest))
        return out
    monkeypatch.setattr(suffix_dedup, "crowded_leads", watched)
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove_repeats(docs).collect()}
    assert [got[i] for i in range(len(texts))] == removed([t.encode() for t in texts], 200)
    assert sum(n > 0 for n in got.values()) >= 6
    assert crowds[0] > 0 and largest[0] <= 4000
