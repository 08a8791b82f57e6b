"""What the raster steps move and hold."""

from pyspark.sql import functions as F

from rivernet.operators import raster as RS


def test_neighbours_across_blocks(spark, monkeypatch):
    """Cells at the ends of blocks see each other; cells move twice, not once for each neighbour."""
    monkeypatch.setattr(RS, "BLOCK", 4)
    here = [(r, c) for r in range(-6, 7) for c in range(-6, 7) if (r * 3 + c * 5) % 7]
    cells = spark.createDataFrame([(r, c, r * 100.0 + c if c != 3 else None, 1) for r, c in here],
                                  "row long, col long, z double, cat int")
    got = sorted((r["row"], r["col"], r["d"], r["nrow"], r["ncol"]) for r in RS.neighbour_cells(cells).collect())
    want = sorted((r, c, i + 1, r + dr, c + dc) for r, c in here for i, (dr, dc, _) in enumerate(RS.OFFSETS)
                  if (r + dr, c + dc) in set(here))
    assert got == want
    plan = RS.neighbour_cells(cells)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def _river(spark, n):
    """One way down a column: cell i drains into cell i + 1."""
    return spark.range(n).select(F.col("id").alias("row"), F.lit(0).cast("long").alias("col"), (1.0 * (n - F.col("id"))).alias("z"),
                                 F.when(F.col("id") < n - 1, F.lit(7)).alias("d"), (F.col("id") + 1).alias("nrow"),
                                 F.lit(0).cast("long").alias("ncol"))


def test_rounds_hold_the_cells_that_move_on(spark, monkeypatch):
    rows, cut = [], RS.cut

    def counted(df, tag="t"):
        out = cut(df, tag)
        if tag == "accum":
            rows.append(out.count())
        return out

    monkeypatch.setattr(RS, "cut", counted)
    # 200 ways of two cells and one of 64
    short = spark.range(400).select((F.col("id") % 2).alias("row"), (F.col("id") + 10).alias("col"), F.lit(0.0).alias("z"),
                                    F.when(F.col("id") % 2 == 0, F.lit(1)).alias("d"), F.lit(1).cast("long").alias("nrow"),
                                    (F.col("id") + 11).alias("ncol"))
    got = {(r["row"], r["col"]): r["acc"] for r in RS.flow_accumulation(_river(spark, 64).unionByName(short)).collect()}
    assert len(got) == 464 and all(got[i, 0] == i + 1 for i in range(64)) and got[1, 11] == 2 and got[0, 10] == 1
    assert rows[0] == 464 and rows[1:] == [62, 60, 56, 48, 32, 0]


def test_cells_of_lines_are_made_by_many_tasks(spark):
    segments = spark.range(0, 400, 1, 1).select(F.col("id").alias("fid"), *[F.lit(v).alias(c) for c, v in zip(
        ("x1", "y1", "x2", "y2"), (0.0, 0.0, 300.0, 90.0), strict=True)])
    cells = RS.cells_of_lines(segments)
    assert cells.rdd.glom().filter(len).count() == 4
    assert cells.count() == 400 * cells.where("fid = 0").count()
