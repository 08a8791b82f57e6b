"""Polygons that lie on one another: the work follows the lines and points, not their product with the polygons."""

import math
import random

from rivernet.operators import spatial as G


def _written(monkeypatch):
    """Rows of the tables that an operator writes, by tag."""
    rows, cut = {}, G.cut

    def counted(df, tag="t"):
        out = cut(df, tag)
        rows[tag] = out.count()
        return out

    monkeypatch.setattr(G, "cut", counted)
    return rows


def _squares(spark, n, step):
    rows = [(i, i * step, i * step, 100.0 + i * step, 100.0 + i * step) for i in range(n)]
    return G.rect_rings(spark.createDataFrame(rows, "id long, x1 double, y1 double, x2 double, y2 double"), "id")


def _line(spark, pts):
    rows = [(1, 0, i, float(x), float(y)) for i, (x, y) in enumerate(pts)]
    return spark.createDataFrame(rows, "fid long, part int, seq int, x double, y double")


def test_clip_looks_once_at_equal_polygons(spark, monkeypatch):
    rows = _written(monkeypatch)
    out = G.clip_lines_outside(_line(spark, [(-50, 50), (150, 50)]), _squares(spark, 60, 0.0)).collect()
    assert sorted((r.x1, r.x2) for r in out) == [(-50.0, 0.0), (100.0, 150.0)]
    assert rows["crossings"] <= 4 and rows["pieces"] <= 8


def test_clip_passes_by_borders_under_a_polygon(spark, monkeypatch):
    """Sixty different squares, each 0.5 m off the one before: most borders lie well inside another square."""
    rows = _written(monkeypatch)
    out = G.clip_lines_outside(_line(spark, [(-50, 50), (250, 50)]), _squares(spark, 60, 0.5), 4.0).collect()
    assert sorted((round(r.x1, 9), round(r.x2, 9)) for r in out) == [(-50.0, 0.0), (129.5, 250.0)]
    assert rows["crossings"] < 40   # 120 borders are crossed


def test_clip_joins_what_the_grid_cut(spark):
    far = G.rect_rings(spark.createDataFrame([(1, 500.0, 500.0, 510.0, 510.0)],
                                             "id long, x1 double, y1 double, x2 double, y2 double"), "id")
    out = G.clip_lines_outside(_line(spark, [(0.3, 0.7), (97.1, 43.9)]), far).collect()
    assert [(r.t0, r.t1) for r in out] == [(0.0, 1.0)]


def test_nearest_among_many_polygons(spark):
    """Quadrangles on one another, against all distances."""
    rng = random.Random(5)
    rings = {}
    for fid in range(60):
        cx, cy, r, a = rng.uniform(0, 60), rng.uniform(0, 60), rng.uniform(3, 14), rng.uniform(0, 6)
        rings[fid] = [(cx + r * math.cos(a + k * math.pi / 2), cy + r * math.sin(a + k * math.pi / 2)) for k in range(4)]
    rings[60] = rings[7]
    pts = {i: (rng.uniform(-20, 80), rng.uniform(-20, 80)) for i in range(300)}

    def distance(p, ring):
        inside, best = False, math.inf
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            if (ay > p[1]) != (by > p[1]) and p[0] < ax + (p[1] - ay) * (bx - ax) / (by - ay):
                inside = not inside
            t = max(0.0, min(1.0, ((p[0] - ax) * (bx - ax) + (p[1] - ay) * (by - ay)) / ((bx - ax) ** 2 + (by - ay) ** 2)))
            best = min(best, math.hypot(p[0] - ax - t * (bx - ax), p[1] - ay - t * (by - ay)))
        return 0.0 if inside else best

    want = {}
    for i, p in pts.items():
        d, fid = min((distance(p, ring), fid) for fid, ring in rings.items())
        want[i] = fid if d <= 5.0 else None
    polygons = spark.createDataFrame([(f, 0, 0, k, x, y) for f, ring in rings.items() for k, (x, y) in enumerate(ring)],
                                     "fid long, part int, ring int, seq int, x double, y double")
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in pts.items()], "pid long, x double, y double")
    for size in (None, 2.0, 50.0):
        got = {r.pid: r.lakeid for r in G.nearest_polygon(points, polygons, dmax=5.0, size=size).collect()}
        assert got == want


def test_nearest_looks_once_at_equal_polygons(spark, monkeypatch):
    rows = _written(monkeypatch)
    points = spark.createDataFrame([(1, 50.0, 50.0), (2, 100.0, 101.0)], "pid long, x double, y double")
    got = {r.pid: r.lakeid for r in G.nearest_polygon(points, _squares(spark, 60, 0.0)).collect()}
    assert got == {1: 0, 2: 0} and rows["borders"] == 4


def test_full_run_and_borders_choose_cells_by_the_lakes():
    """Cells of the size of a region would pair all lakes of it with all lines."""
    import inspect

    for operator in (G.clip_lines_outside, G.nearest_polygon, G.shared_borders):
        assert inspect.signature(operator).parameters["size"].default is None
