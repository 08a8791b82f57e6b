from pyspark.sql import functions as F

from rivernet.sources import io


def test_region_rewrite_keeps_others(spark, tmp):
    path = f"{tmp}/summary"
    a = spark.createDataFrame([(1, 10, "a"), (1, 11, "b")], "wrid int, lakeID long, v string")
    b = spark.createDataFrame([(2, 20, "c")], "wrid int, lakeID long, v string")
    io.write_summary(a, path)
    io.write_summary(b, path)
    io.write_summary(spark.createDataFrame([(1, 12, "new")], "wrid int, lakeID long, v string"), path)
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("wrid", "lakeID", "v").collect())
    assert got == [(1, 12, "new"), (2, 20, "c")]
    assert io.read_partitioned(spark, path, [2]).count() == 1


def test_sentinel_option(spark, tmp):
    df = spark.createDataFrame([(1, 1, 2, -9999, 5)], "wrid int, from_lake long, to_lake long, "
                               "upstream_length int, downstream_length int")
    io.write_combinations(df, f"{tmp}/c", sentinel=None)
    r = spark.read.parquet(f"{tmp}/c").first()
    assert r.upstream_length is None and r.downstream_length == 5


def test_require_tables(spark):
    import pytest
    with pytest.raises(ValueError):
        io.require_tables(spark, ["no_such_table_here"])


def test_rewrite_empties_regions(spark, tmp):
    """A region of the rewrite without rows loses its old ones, others keep theirs."""
    from rivernet.sources import io

    old = spark.createDataFrame([(1, 10, "a"), (2, 20, "b"), (2, 21, "c"), (3, 30, "d")], "wrid int, cat int, x string")
    io.write_edges(old, f"{tmp}/edges")
    new = spark.createDataFrame([(1, 11, "e")], "wrid int, cat int, x string")
    io.write_edges(new, f"{tmp}/edges", wrids=[1, 2])
    got = spark.read.parquet(f"{tmp}/edges").select("wrid", "cat", "x")
    assert sorted(map(tuple, got.collect())) == [(1, 11, "e"), (3, 30, "d")]
    # rows read from the table itself can be written back
    io.write_edges(got.where("wrid = 3 and cat < 0"), f"{tmp}/edges", wrids=spark.createDataFrame([(3,)], "wrid int"))
    left = spark.read.parquet(f"{tmp}/edges").select("wrid", "cat", "x")
    assert [tuple(r) for r in left.collect()] == [(1, 11, "e")]


def test_full_run_drops_rows_of_a_region_that_became_empty(spark, tmp):
    """Without a region list the regions of the inputs are replaced."""
    from rivernet.operators.network import STAT_COLUMNS
    from rivernet.plans.pipeline import run

    def inputs(regions):
        rows = [(w, i, w * 10 + i, w * 10 + i + 1) for w, lakes in regions.items() for i in range(lakes)]
        nodes = [(w, w * 10 + i, w * 10 + i, 1.0 if i < lakes else None) for w, lakes in regions.items() for i in range(lakes + 1)]
        stats = ", ".join(f"{c} double" for c in STAT_COLUMNS)
        return {"lines": spark.createDataFrame([(*r, 5.0) for r in rows], "wrid int, line_cat bigint, from_node bigint, to_node bigint, length_m double"),
                "nodes": spark.createDataFrame(nodes, "wrid int, node_id bigint, lakeid bigint, area_ha double"),
                "edges": spark.createDataFrame([(w, c, 5.0, *[1.0] * 18) for w, c, _, _ in rows], f"wrid int, cat bigint, length_m double, {stats}"),
                "adjacency": spark.createDataFrame([], "wrid int, left_lake bigint, right_lake bigint")}

    def summary(sections=("network_compilation", "lake_summary"), **given):
        run(spark, f"{tmp}/out", sections=sections, **given)
        return {(r.wrid, r.lakeID) for r in spark.read.parquet(f"{tmp}/out/lake_summary").collect()}

    assert summary(**inputs({1: 2, 2: 3})) == {(1, 10), (1, 11), (2, 20), (2, 21), (2, 22)}
    assert summary(**inputs({2: 1})) == {(1, 10), (1, 11)}
    assert summary(sections=("lake_summary",)) == {(1, 10), (1, 11)}
