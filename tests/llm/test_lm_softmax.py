"""The softmax of a context as a product of tables, over a wide range of logits."""

import numpy as np
import pytest

from rivernet.llm import lm_score
from rivernet.llm.lm_score import LogBilinear


@pytest.mark.parametrize("table", [0, 2048])
@pytest.mark.parametrize("places", [1, 3])
@pytest.mark.parametrize("scale, bias", [(1, 0), (20, 200), (60, -200), (400, 0)])
def test_log10_probabilities(monkeypatch, table, places, scale, bias):
    monkeypatch.setattr(lm_score, "_TABLE", table, raising=False)
    rnd = np.random.default_rng(3)
    model = LogBilinear(np.arange(40.0), context=places)
    model.p["given"] *= scale
    model.p["next"] *= 5
    model.p["bias"] += np.float32(bias)  # moves all logits alike: no probability changes
    context, target = rnd.integers(0, 40, (700, places)), rnd.integers(0, 40, 700)
    context[:50] = context[0]
    q = (model.p["given"][context] * model.p["place"]).sum(1).astype(np.float64)
    logits = q @ model.p["next"].T.astype(np.float64) + model.p["bias"]
    top = logits.max(1, keepdims=True)
    want = (logits - top - np.log(np.exp(logits - top).sum(1, keepdims=True)))[np.arange(700), target] / np.log(10)
    got = model.log10_probabilities(context, target, block=64)
    assert np.abs(got - want).max() < 1e-4 * max(1, scale / 20)


def test_no_exp_for_each_context(monkeypatch):
    """One exp for each pair of classes and place, not for each context and class."""
    seen = []

    class Counting:
        def __getattr__(self, name):
            f = getattr(np, name)
            return (lambda x, *a, **k: (seen.append(x.size), f(x, *a, **k))[1]) if name == "exp" else f

    monkeypatch.setattr(lm_score, "np", Counting())
    model = LogBilinear(np.ones(16), context=3)
    context = np.stack(np.unravel_index(np.arange(16 ** 3), (16, 16, 16)), axis=1)
    model.log10_probabilities(context, np.arange(16 ** 3) % 16)
    assert sum(seen) == 3 * 16 * 16
