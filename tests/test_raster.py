import pytest

from rivernet.operators import raster as RS


def _grid(spark, zs):
    rows = [(r, c, float(z), 1) for r, row in enumerate(zs) for c, z in enumerate(row)]
    return spark.createDataFrame(rows, "row long, col long, z double, cat long")


def test_local_slope_reference_and_geometric(spark):
    cells = _grid(spark, [[12, 8, 6], [12, 10, 12], [12, 12, 12]])
    ref = {(r.row, r.col): r.slope for r in RS.local_slope(cells, 10, 10).collect()}
    assert ref[(1, 1)] == pytest.approx(4 / 20 ** 0.5)
    geo = {(r.row, r.col): r.slope for r in RS.local_slope(cells, 10, 10, "geometric").collect()}
    assert geo[(1, 1)] == pytest.approx(4 / 200 ** 0.5)
    low = _grid(spark, [[12, 12, 12], [12, 1, 12], [12, 12, 12]])
    assert {(r.row, r.col): r.slope for r in RS.local_slope(low, 10, 10).collect()}[(1, 1)] == 0.0


def test_d8_and_accumulation(spark):
    # a ramp falling to the east: every cell drains east, accumulation grows
    cells = _grid(spark, [[5, 4, 3, 2]])
    d8 = RS.d8_direction(cells, 10, 10)
    assert {(r.col, r.d) for r in d8.collect()} == {(0, 1), (1, 1), (2, 1), (3, None)}
    acc = {r.col: r.acc for r in RS.flow_accumulation(d8).collect()}
    assert acc == {0: 1, 1: 2, 2: 3, 3: 4}


def test_cells_of_lines(spark):
    seg = spark.createDataFrame([(1, 1.0, 1.0, 25.0, 1.0), (2, 5.0, 5.0, 15.0, 12.0)],
                                "fid long, x1 double, y1 double, x2 double, y2 double")
    got = {(r.fid, r.row, r.col) for r in RS.cells_of_lines(seg, 10).collect()}
    assert got == {(1, 0, 0), (1, 0, 1), (1, 0, 2), (2, 0, 0), (2, 0, 1), (2, 1, 1)}
