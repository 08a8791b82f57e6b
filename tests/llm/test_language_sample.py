"""A language with few labelled documents is learned."""

from __future__ import annotations

import random

from rivernet.llm import langid


def test_a_rare_language_is_learned(spark):
    rnd = random.Random(7)

    def text(letters: str) -> str:
        return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(2, 5))) for _ in range(30))
    rows = [(i, text("abcde" if i % 2 else "fghij"), "aa" if i % 2 else "bb") for i in range(600)]
    copy = text("fghij")
    rows += [(1000 + i, copy, "bb") for i in range(400)]               # copies take one place
    rows += [(3000 + i, text("uvwxyz"), "dd") for i in range(3)]
    rows += [(5000 + i, text("uvwxyz"), None) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in
           langid.identify_language(docs, learn_from=docs["doc_id"] < 5000, bits=10, sample_rows=40, least=3).collect()}
    assert all(got[i] == "dd" for i in [3000, 3001, 3002, 5000, 5001, 5002, 5003])
    assert sum(got[r[0]] == r[2] for r in rows[:600]) >= 590


def test_rows_are_shared_out():
    assert langid.share_out([500, 500, 3], 103, 2) == 50
    assert langid.share_out([5, 6], 100, 2) == 6
    assert langid.share_out([900] * 50, 100, 20) == 20
