"""Chains of lines in order: opposed lines, rings, junctions, points."""

import random

from rivernet.operators.spatial import chain_lines, merge_chains, merged_points


def _topology(spark, rows):
    return spark.createDataFrame(rows, "wrid int, line_cat bigint, from_node bigint, to_node bigint")


def _chains(spark, rows):
    out = {}
    for r in sorted(chain_lines(_topology(spark, rows)).collect(), key=lambda r: (r.wrid, r.chain, r.pos)):
        out.setdefault((r.wrid, r.chain), []).append((r.line_cat, r.reversed, r.from_node, r.to_node))
        assert r.pos == len(out[r.wrid, r.chain]) - 1
    return out


def test_goldens(spark):
    rows = [(1, 5, 10, 11), (1, 3, 12, 11), (1, 9, 12, 13),                     # 10 -5- 11 -3- 12 -9- 13
            (2, 4, 1, 2), (2, 2, 3, 2), (2, 8, 3, 1),                           # a ring
            (3, 1, 1, 2), (3, 2, 2, 3), (3, 3, 2, 4),                           # a junction
            (4, 6, 7, 7), (5, 1, 1, 2), (5, 2, 2, 1)]                           # loops of one and of two lines
    assert _chains(spark, rows) == {
        (1, 3): [(9, True, 13, 12), (3, False, 12, 11), (5, True, 11, 10)],
        (2, 2): [(2, False, 3, 2), (4, True, 2, 1), (8, True, 1, 3)],
        (3, 1): [(1, False, 1, 2)], (3, 2): [(2, False, 2, 3)], (3, 3): [(3, False, 2, 4)],
        (4, 6): [(6, False, 7, 7)], (5, 1): [(1, False, 1, 2), (2, False, 2, 1)]}
    lengths = spark.createDataFrame([(w, c, float(c)) for w, c, _, _ in rows], "wrid int, line_cat bigint, length_m double")
    merged = {(r.wrid, r.line_cat): tuple(r)[2:] for r in merge_chains(_topology(spark, rows), lengths).collect()}
    assert merged[1, 3] == (3, 17.0, 13, 10) and merged[2, 2] == (3, 14.0, 3, 3) and merged[4, 6] == (1, 6.0, 7, 7)
    assert chain_lines(_topology(spark, rows).limit(0)).collect() == []


def test_points_of_merged_lines(spark):
    rows = [(1, 5, 10, 11), (1, 3, 12, 11), (1, 9, 12, 13)]
    points = {5: [(0, 0), (1, 1), (2, 0)], 3: [(4, 0), (3, 5), (2, 0)], 9: [(4, 0), (9, 9)]}
    lines = spark.createDataFrame([(1, f, i, float(x), float(y)) for f, p in points.items() for i, (x, y) in enumerate(p)],
                                  "wrid int, fid bigint, seq int, x double, y double")
    got = sorted((r.seq, r.x, r.y) for r in merged_points(chain_lines(_topology(spark, rows)), lines).collect())
    assert got == [(i, float(x), float(y)) for i, (x, y) in enumerate([(9, 9), (4, 0), (3, 5), (2, 0), (1, 1), (0, 0)])]


def test_random_lines_equal_a_walk(spark):
    rnd = random.Random(8)
    rows = []
    for w in range(5):
        ends = [rnd.sample(range(14 + 4 * w), 2) for _ in range(16)]
        rows += [(w, c, a, b) for c, (a, b) in zip(rnd.sample(range(100), 16), ends, strict=True)]
    got = _chains(spark, rows)
    want = {}
    for w in range(5):
        own = {c: (a, b) for x, c, a, b in rows if x == w}
        at = {}
        for c, (a, b) in own.items():
            at.setdefault(a, []).append((c, 0))
            at.setdefault(b, []).append((c, 1))

        def after(c, back):
            node = own[c][0 if back else 1]
            if len(at[node]) != 2:
                return None
            other = next(e for e in at[node] if e != (c, 0 if back else 1))
            return other[0], other[1] == 1

        left = set(own)
        while left:
            c = min(left)
            chain, walk, step = [(c, False)], None, after(c, False)
            while step and step[0] != c:
                chain.append(step)
                step = after(*step)
            if not step:  # open: what comes before, too
                walk = after(c, True)
                while walk:
                    chain.insert(0, (walk[0], not walk[1]))
                    walk = after(*walk)
            want[w, c] = [(x, back, *(own[x][::-1] if back else own[x])) for x, back in chain]
            left -= {x for x, _ in chain}
    assert got == want and any(len(x) > 3 for x in want.values())
