"""A full run from feature tables, and the joining of streams before the clip."""

from pyspark.sql import functions as F

LINES = "fid bigint, part int, seq int, x double, y double"


def _square(spark, fid, x1, y1, x2, y2):
    corners = [(x1, y1), (x2, y1), (x2, y2), (x1, y2)]
    return spark.createDataFrame([(fid, 0, 0, i, float(x), float(y)) for i, (x, y) in enumerate(corners)],
                                 "fid bigint, part int, ring int, seq int, x double, y double")


def _streams(spark, *lines):
    return spark.createDataFrame([(fid, 0, i, float(x), float(y)) for fid, pts in lines for i, (x, y) in enumerate(pts)], LINES)


def test_streams_are_snapped_and_merged(spark):
    from rivernet.plans.gis import joined_streams
    # 1 and 2 nearly meet, 2 is drawn against 1; 3 and 4 end in the confluence (9, 0) with 2
    s = _streams(spark, (1, [(0, 0), (4, 0)]), (2, [(9, 0), (6, 1), (4.5, 0)]), (3, [(9, 9), (9, 0.2)]), (4, [(9, 0), (20, 0)]))
    keyed = s.withColumn("fid", F.struct(F.lit(7).cast("long").alias("wrid"), F.col("fid").alias("id")))

    def points(df):
        out = {}
        for r in sorted(df.collect(), key=lambda r: (r["fid"]["id"], r["part"], r["seq"])):
            out.setdefault(r["fid"]["id"], []).append((r["x"], r["y"]))
        return out

    assert points(joined_streams(keyed)) == {1: [(0, 0), (4, 0), (6, 1), (9, 0)], 3: [(9, 9), (9, 0)], 4: [(9, 0), (20, 0)]}
    assert points(joined_streams(keyed, snap=None, merge=False)) == points(keyed)


def test_features_to_summary(spark, tmp_path):
    from rivernet.plans import pipeline
    lakes = _square(spark, 1, 100, 400, 200, 600).union(_square(spark, 2, 800, 400, 900, 600))
    # one river in two parts with a gap of 0.4 m between them
    streams = _streams(spark, (11, [(150, 500), (450, 500)]), (12, [(450.4, 500), (850, 500)]))
    features = {"catchments": _square(spark, 5, 0, 0, 1000, 1000), "lakes": lakes, "streams": streams}
    done = pipeline.run(spark, str(tmp_path), features=features)
    line = done["lines"].collect()
    assert [(r["wrid"], r["length_m"]) for r in line] == [(5, 600.0)]
    lake = {r["node_id"]: r["lakeid"] for r in done["nodes"].collect()}
    assert (lake[line[0]["from_node"]], lake[line[0]["to_node"]]) == (1, 2)
    assert done["adjacency"].count() == 0
    pairs = done["lake_combinations"].collect()
    assert [(r["wrid"], r["from_lake"], r["to_lake"]) for r in pairs] == [(5, 1, 2)]
    assert {r["lakeID"]: r["downstream_lakes"] for r in done["lake_summary"].collect()} == {1: "2", 2: None}
    # the next run loses the river: none of its rows stays
    gone = pipeline.run(spark, str(tmp_path), features={**features, "streams": streams.where("fid = 11")},
                        sections=("gis", "network_compilation", "lake_summary"))
    assert gone["lake_summary"].count() == 0 and gone["lines"].count() == 1
