"""Induced sorting in small pieces and with a queue that spills gives what it gives in one piece."""

import random
from collections import Counter

import numpy as np
import pytest

from rivernet.llm import induced_sort


@pytest.mark.parametrize("piece", [1, 3, 64])
def test_pieces_change_nothing(monkeypatch, piece):
    rnd = random.Random(piece)
    monkeypatch.setattr(induced_sort, "PIECE", piece)
    for _ in range(40):
        blocks = [bytes(rnd.choice(b"ab\x00") for _ in range(rnd.randint(0, 40))) for _ in range(rnd.randint(1, 6))]
        blocks += [b"aaaaaaaaaaaa" * rnd.randint(1, 3), b"abababab" * rnd.randint(1, 4)]
        seen = Counter(b[i:i + 5] for b in blocks for i in range(len(b) - 4))
        got = induced_sort.repeated_starts(blocks, 5, memory=rnd.choice([30, 10**9]), direct=rnd.choice([2, 10**6]))
        assert [x.tolist() for x in got] == [[i for i in range(len(b) - 4) if seen[b[i:i + 5]] > 1] for b in blocks]


def test_types_of_suffixes(monkeypatch):
    rnd = random.Random(5)
    for piece in (1, 2, 5, 1000):
        monkeypatch.setattr(induced_sort, "PIECE", piece)
        text = [rnd.randint(1, 3) for _ in range(50)] + [2, 2, 2, 0]
        want = [text[i:] < text[i + 1:] for i in range(len(text) - 1)] + [True]
        assert induced_sort.s_types(np.array(text)).tolist() == want
