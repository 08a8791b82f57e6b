from pyspark.sql import functions as F

from rivernet.operators import spatial as G


def _rects(spark, rows, hole=False):
    df = spark.createDataFrame(rows, "id long, x1 double, y1 double, x2 double, y2 double, h double")
    return G.rect_rings(df, "id", hole_half="h" if hole else None)


def _line(spark, fid, pts):
    rows = [(fid, 0, i, float(x), float(y)) for i, (x, y) in enumerate(pts)]
    return spark.createDataFrame(rows, "fid long, part int, seq int, x double, y double")


def test_clip_line_through_square(spark):
    sq = _rects(spark, [(1, 4.0, -1.0, 6.0, 1.0, None)])
    out = G.clip_lines_outside(_line(spark, 7, [(0, 0), (10, 0)]), sq).orderBy("t0").collect()
    assert [(round(r.x1, 9), round(r.x2, 9)) for r in out] == [(0.0, 4.0), (6.0, 10.0)]
    inside = G.clip_lines_outside(_line(spark, 8, [(4.5, 0), (5.5, 0)]), sq)
    assert inside.count() == 0


def test_clip_ignores_hole(spark):
    lake = _rects(spark, [(1, 0.0, 0.0, 10.0, 10.0, 2.0)], hole=True)
    out = G.clip_lines_outside(_line(spark, 1, [(-5, 5), (15, 5)]), lake).orderBy("t0").collect()
    assert [(round(r.x1, 9), round(r.x2, 9)) for r in out] == [(-5.0, 0.0), (10.0, 15.0)]


def test_nearest_polygon_dmax_and_ties(spark):
    lakes = _rects(spark, [(1, 0.0, 0.0, 10.0, 10.0, None), (2, 12.0, 0.0, 20.0, 10.0, None),
                           (3, 30.0, 0.0, 40.0, 10.0, None)])
    pts = spark.createDataFrame([(1, 5.0, 5.0), (2, 5.0, 10.99), (3, 5.0, 11.0), (4, 5.0, 11.01),
                                 (5, 11.0, 5.0)], "pid long, x double, y double")
    got = {r.pid: r.lakeid for r in G.nearest_polygon(pts, lakes, dmax=1.0).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: None, 5: 1}


def test_intersections_touch_and_containment(spark):
    a = _rects(spark, [(1, 0.0, 0.0, 1.0, 1.0, None), (2, 5.0, 5.0, 6.0, 6.0, None)])
    b = _rects(spark, [(10, 1.0, 1.0, 2.0, 2.0, None), (11, 4.0, 4.0, 8.0, 8.0, None),
                       (12, 3.0, 0.0, 3.5, 0.5, None)])
    got = {(r.a, r.b) for r in G.polygons_intersect(a, b).collect()}
    assert got == {(1, 10), (2, 11)}
    line = _line(spark, 5, [(4.5, 4.5), (4.6, 4.6)])
    assert {(r.line, r.polygon) for r in G.lines_in_polygons(line, b).collect()} == {(5, 11)}


def test_exterior_and_area(spark):
    lake = _rects(spark, [(1, 0.0, 0.0, 100.0, 100.0, 10.0)], hole=True)
    assert G.polygon_area_ha(lake).first().area_ha == (10000 - 400) / 10000
    # a second part inside the hole of the first part is swallowed
    inner = G.rect_rings(spark.createDataFrame([(1, 45.0, 45.0, 55.0, 55.0)],
                                               "id long, x1 double, y1 double, x2 double, y2 double"),
                         "id").withColumn("part", F.lit(1))
    ext = G.exterior_lakes(lake.unionByName(inner))
    assert {r.part for r in ext.select("part").distinct().collect()} == {0}


def test_shared_borders(spark):
    r = _rects(spark, [(1, 0.0, 0.0, 1.0, 1.0, None), (2, 1.0, 0.0, 2.0, 1.0, None),
                       (3, 5.0, 5.0, 6.0, 6.0, None)])
    assert [tuple(x) for x in G.shared_borders(r).collect()] == [(1, 2)]


def test_snap_keeps_regions_apart(spark):
    """Chains of close points merge inside a region only; equal points are one."""
    rows = [(1, 1, 0.0, 0.0), (1, 2, 0.9, 0.0), (1, 3, 1.8, 0.0), (1, 4, 0.9, 0.0), (1, 5, 9.0, 0.0), (2, 6, 0.5, 0.0)]
    got = G.snap_points(spark.createDataFrame(rows, "wrid int, pid long, x double, y double"), keys=("wrid",))
    assert {r["pid"]: r["x"] for r in got.collect()} == {1: 0.0, 2: 0.0, 3: 0.0, 4: 0.0, 5: 9.0, 6: 0.5}


def test_clip_keeps_lines_along_every_border(spark):
    sq = _rects(spark, [(1, 0.0, 0.0, 4.0, 4.0, None)])
    for k, pts in enumerate([[(0, 1), (0, 3)], [(4, 1), (4, 3)], [(1, 0), (3, 0)], [(1, 4), (3, 4)]]):
        out = G.clip_lines_outside(_line(spark, k, pts), sq).collect()
        assert sum(abs(r.x2 - r.x1) + abs(r.y2 - r.y1) for r in out) == 2.0


def test_borders_shared_in_part(spark):
    """Polygons that meet along a stretch with different vertices are adjacent, at a corner not."""
    sq = _rects(spark, [(1, 0.0, 0.0, 4.0, 4.0, None), (2, 4.0, 1.0, 6.0, 9.0, None), (3, 6.0, 9.0, 8.0, 10.0, None)])
    got = G.shared_borders(sq).collect()
    assert [(r["left_lake"], r["right_lake"]) for r in got] == [(1, 2)]


def test_sloping_borders_are_shared(spark):
    """Vertices rounded to doubles lie beside a sloping border, not on it."""
    from rivernet.operators.spatial import shared_borders

    a, b = (0.1, 0.2), (30.7, 19.3)
    mid = (a[0] + 0.37 * (b[0] - a[0]), a[1] + 0.37 * (b[1] - a[1]))
    rings = {1: [a, b, (30.0, 40.0), (0.0, 40.0)], 2: [b, mid, a, (0.0, -9.0), (30.0, -9.0)],
             3: [b, (50.0, 19.3), (50.0, 40.0)],                                # touches in a point
             4: [(a[0], a[1] - 20), (b[0], b[1] - 20), (40.0, -30.0)]}           # parallel
    rows = []
    for fid, ring in rings.items():
        rows += [(fid, 0, 0, i, x, y) for i, (x, y) in enumerate([*ring, ring[0]])]
    polygons = spark.createDataFrame(rows, "fid bigint, part int, ring int, seq int, x double, y double")
    got = sorted(map(tuple, shared_borders(polygons, size=7.0).collect()))
    assert got == [(1, 2)]
