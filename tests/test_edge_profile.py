"""The samples of an edge move once, as they are (A4, A5)."""

from rivernet.operators.network import edge_profiles


def test_samples_are_not_listed_before_they_move(spark):
    samples = spark.range(0, 600, 1, 6).selectExpr(
        "CAST(id % 2 AS INT) AS wrid", "id % 50 AS line_cat", "CAST(id AS DOUBLE) AS altitude",
        "IF(id < 50, NULL, id / 8e0) AS slope", "uuid() AS other")
    out = edge_profiles(samples, [("altitude", "altitude"), ("slope", "slope")], ("wrid", "line_cat"), fixed_scale=5)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1
    assert "Aggregate" not in plan[plan.index("Exchange "):]
    rows = {(r["wrid"], r["line_cat"]): r for r in out.collect()}
    assert len(rows) == 50
    r = rows[1, 7]  # altitudes 7, 57, ... 557; the slope of the first is null
    assert (r["altitude_minimum"], r["altitude_first_quartile"], r["altitude_median"], r["altitude_third_quartile"],
            r["altitude_percentile_90"], r["altitude_maximum"], r["altitude_average"]) == (7, 107, 282, 407, 507, 557, 282)
    assert (r["slope_minimum"], r["slope_median"], r["slope_maximum"]) == (57 / 8, 307 / 8, 557 / 8)
