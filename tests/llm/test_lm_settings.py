"""The language model sees what its settings promise."""

from __future__ import annotations

import inspect
import random

import numpy as np

from rivernet.llm import lm_score


def test_model_settings(spark):
    default = {k: p.default for f in (lm_score.score_texts, lm_score.train_model, lm_score.LogBilinear.learn)
               for k, p in inspect.signature(f).parameters.items() if p.default is not p.empty}
    assert (default["words"], default["tails"], default["context"], default["noise"], default["batch_size"]) == (960, 64, 3, 64, 2048)


def test_the_third_token_back_tells(spark):
    """Of two texts alike but for the token three places before the last, the likelier one has the higher score."""
    rnd = random.Random(4)
    rows = []
    for i in range(600):
        out = []
        for _ in range(40):
            k = rnd.choice("ab")
            out += [k, "x", "y", k.upper() + "1"]
        rows.append((i, " ".join(out)))
    rows += [(1000, "a x y a1"), (1001, "b x y a1"), (1002, "b x y b1"), (1003, "a x y b1")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    got = {r["doc_id"]: r["score"] for r in lm_score.score_texts(docs, learn_from=docs["doc_id"] < 1000)
           .where("doc_id >= 1000").collect()}
    assert got[1000] > got[1003] + 0.3 and got[1002] > got[1001] + 0.3


def test_steps_equal_plain_arithmetic():
    """One step of the model against the gradients written out in float64."""
    rnd = np.random.default_rng(5)
    frequency = rnd.integers(1, 90, 30)
    model = lm_score.LogBilinear(frequency, size=6, context=3)
    p = {k: v.astype(np.float64) for k, v in model.p.items()}
    context, target = rnd.integers(0, 30, (50, 3)).astype(np.int32), rnd.integers(0, 30, 50).astype(np.int32)
    drawn = np.random.default_rng(9).choice(30, 8, p=model.noise)
    model.learn(context, target, np.random.default_rng(9), noise=8, rate=0.1)
    grad = {k: np.zeros_like(v) for k, v in p.items()}
    for c, t in zip(context, target, strict=True):
        q = (p["given"][c] * p["place"]).sum(0)
        g_q = np.zeros(6)
        for w, right in [(t, True), *((d, False) for d in drawn)]:
            s = q @ p["next"][w] + p["bias"][w] - np.log(model.noise[w]) - np.log(8)
            g = (1 / (1 + np.exp(-s)) - right) / 50
            grad["next"][w] += g * q
            grad["bias"][w] += g
            g_q += g * p["next"][w]
        for k in range(3):
            grad["given"][c[k]] += g_q * p["place"][k]
            grad["place"][k] += g_q * p["given"][c[k]]
    for k, v in p.items():
        assert np.allclose(model.p[k], v - 0.1 * grad[k] / np.sqrt(1e-2 + grad[k] ** 2), atol=1e-5)
    log_p = model.log10_probabilities(np.repeat(context[:1], 30, 0), np.arange(30))
    assert abs((10 ** log_p).sum() - 1) < 1e-5
