from pyspark.sql import functions as F

from rivernet.functions import exprs as X


def test_slope_to_cdeg(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (100.0,), (None,)], "x double")
    got = [r[0] for r in df.select(X.slope_to_cdeg("x")).collect()]
    assert got == [0, 4500, 8943, None]


def test_weighted_avg(spark):
    df = spark.createDataFrame(list(zip([1.0, 3.0, 4.0, 1.0, 3.0], [3.0, 1.0, 1.0, 10.0, 1.0])),
                               "x double, w double")
    assert df.agg(X.weighted_avg("x", "w")).first()[0] == 1.4375
    zero = spark.createDataFrame([(1.0, 0.0), (2.0, 0.0)], "x double, w double")
    assert zero.agg(X.weighted_avg("x", "w")).first()[0] == 0.0
    nulls = spark.createDataFrame([(None, 1.0), (None, 2.0)], "x double, w double")
    assert nulls.agg(X.weighted_avg("x", "w")).first()[0] == 0.0


def test_classify_vertex(spark):
    expected = {(0, 0): 5, (0, 1): 1, (0, 2): 1, (1, 0): 4, (1, 1): 2, (1, 2): 0,
                (2, 0): 4, (2, 1): 3, (2, 2): 3}
    df = spark.createDataFrame(list(expected), "i int, o int")
    got = {(r.i, r.o): r.t for r in df.select("i", "o", X.classify_vertex("i", "o").alias("t")).collect()}
    assert got == expected


def test_coerce_scalar(spark):
    df = spark.createDataFrame([("12",), ("1.5",), ("abc",), ("3.0",)], "raw string")
    c = X.coerce_scalar("raw")
    got = [tuple(r) for r in df.select(c["as_long"], c["as_double"], c["as_text"]).collect()]
    assert got == [(12, None, None), (None, 1.5, None), (None, None, "abc"), (3, None, None)]


def test_is_lake_and_round(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (None,), (float("nan"),)], "a double")
    assert [r[0] for r in df.select(X.is_lake("a")).collect()] == [True, False, False, False]
    r = spark.createDataFrame([(2.5,), (-2.5,), (0.4074845,)], "x double")
    assert [x[0] for x in r.select(X.round_metres("x")).collect()] == [3, -3, 0]
    assert [x[0] for x in r.select(X.fixed_round("x", 6)).collect()][2] in (0.407484, 0.407485)
