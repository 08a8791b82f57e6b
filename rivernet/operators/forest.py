"""Lake pairs of tree clusters (G9-G11, A10-A12) without a path search.

A cluster whose vertices flow to one other vertex at most, with one arc fewer
than vertices, is a tree rooted at its outlet.  The path between two lakes
goes down to the vertex where their ways meet and up from there, so its
statistics are those of the two ways down.  They are kept in mergeable
columns (sums, maxima, lists of lakes and confluences passed), not as arcs:

1. vertices on a way down from a pair end are marked, by doubling;
2. what is neither an end nor a place where marked ways meet is jumped over,
   by pointer jumping, so the tree left has less than two vertices an end;
3. the ways down from each end to each vertex left below it are collected by
   doubling (binary lifting);
4. two ends meet where they come from two different branches; a way is dealt
   out to the later branches of its meeting vertex and joined with the ways
   from there, so each pair is made once and nothing else is.

All rounds are logarithmic in the depth of the tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import MISSING, is_lake, slope_to_cdeg
from .doubling import stored
from .iterate import merged
from .network import Network

#: Columns that add up along a way; all but the first two are weighted with the length.
_SUMS = ("len_mm", "len", "altitude_average", "slope_average", "slope_third_quartile", "slope_percentile_90",
         "slope_maximum", "slope_stddev")
#: Columns whose largest value is kept (the lowest altitude with its sign turned).
_MOST = ("low", "altitude_maximum", "most_percentile_90", "most_maximum")
_LISTS = ("lakes", "confluences")
_WAY = (*_SUMS, *_MOST, *_LISTS)
_ID = "wrid"


def _merge(a: str, b: str) -> list[Column]:
    """The way ``a`` and after it the way ``b`` (column prefixes)."""
    return ([(F.col(a + c) + F.col(b + c)).alias(c) for c in _SUMS]
            + [F.greatest(a + c, b + c).alias(c) for c in _MOST]
            + [F.concat(a + c, b + c).alias(c) for c in _LISTS])


def _named(df: DataFrame, prefix: str, **renamed: str) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in _WAY} | renamed)


def tree_clusters(network: Network) -> DataFrame:
    """``(wrid, cluster)`` of the clusters that are trees rooted at an outlet."""
    nat = network.arcs.where(F.col("direction") == "downstream").select(_ID, F.col("src").alias("vid"), "dst").distinct()
    out = nat.groupBy(_ID, "vid").agg(F.count("*").alias("n"))
    v = network.vertices.select(_ID, "vid", "cluster").join(out, [_ID, "vid"], "left")
    return (v.groupBy(_ID, "cluster").agg(F.count("*").alias("vertices"), F.sum("n").alias("arcs"), F.max("n").alias("most"))
            .where("arcs = vertices - 1 AND most = 1").select(_ID, "cluster"))


def split_network(network: Network) -> tuple[Network, Network]:
    """The tree clusters and the others."""
    trees, _ = stored(tree_clusters(network), "trees")
    parts = []
    for how in ("left_semi", "left_anti"):
        v = merged(network.vertices.join(trees, [_ID, "cluster"], how))
        parts.append(Network(v, merged(network.arcs.join(v.select(_ID, F.col("vid").alias("src")), [_ID, "src"], "left_semi"))))
    return parts[0], parts[1]


def _downward(network: Network, weight: str | None) -> DataFrame:
    """``(wrid, v, p, ...way)``: the best arc of each vertex to the one that it
    flows to, and the vertex itself in the lists."""
    rank = F.struct(*([F.col(weight).cast("long").alias("w")] if weight else []),
                    F.round(F.col("length_m") * 1000).cast("long").alias("len_mm"), "line_cat")
    length = F.col("length_m")
    v = network.vertices.select(_ID, F.col("vid").alias("src"), is_lake("area_ha").alias("lake"), "typ")

    def listed(cond: Column) -> Column:
        return F.when(cond, F.array("src")).otherwise(F.array().cast("array<bigint>"))

    best = (network.arcs.where(F.col("direction") == "downstream")
            .groupBy(_ID, "src", "dst").agg(F.min_by(F.struct(*[c for c in network.arcs.columns if c not in (_ID, "src", "dst")]),
                                                     rank).alias("arc"))
            .select(_ID, "src", "dst", "arc.*").join(v, [_ID, "src"]))
    return best.select(
        _ID, F.col("src").alias("v"), F.col("dst").alias("p"),
        F.round(length * 1000).cast("long").alias("len_mm"), length.alias("len"),
        *[(F.col(c) * length).alias(c) for c in _SUMS[2:]],
        (-F.col("altitude_minimum")).alias("low"), "altitude_maximum",
        F.col("slope_percentile_90").alias("most_percentile_90"), F.col("slope_maximum").alias("most_maximum"),
        listed(F.col("lake")).alias("lakes"), listed(F.col("typ") == 3).alias("confluences"))


def _marked(step: DataFrame, ends: DataFrame) -> DataFrame:
    """``(wrid, v)``: the ends and all vertices on their ways down."""
    jump, left = stored(step.select(_ID, "v", "p"), "jump")
    marks, _ = stored(ends.select(_ID, "v").distinct(), "marks")
    while left:
        below = jump.join(marks, [_ID, "v"], "left_semi").select(_ID, F.col("p").alias("v"))
        marks, _ = stored(marks.union(below).distinct(), "marks")
        jump, left = stored(jump.join(jump.select(_ID, F.col("v").alias("p"), F.col("p").alias("q")), [_ID, "p"])
                            .select(_ID, "v", F.col("q").alias("p")), "jump")
    return marks


def _contracted(step: DataFrame, key: DataFrame) -> DataFrame:
    """``step`` between the key vertices only: each way goes down to the next."""
    goal = key.select(_ID, F.col("v").alias("p"), F.lit(True).alias("there"))
    ways, left = stored(step.join(goal, [_ID, "p"], "left").fillna(False, ["there"]), "ways", "not there")
    while left:
        done = ways.where("there")
        after = _named(ways, "b_", p="q", v="p", there="arrived")  # renamed in this order
        longer = (_named(ways.where("not there").drop("there"), "a_").join(after, [_ID, "p"])
                  .select(_ID, "v", F.col("q").alias("p"), *_merge("a_", "b_"), F.col("arrived").alias("there")))
        ways, left = stored(done.unionByName(longer), "ways", "not there")
    return ways.drop("there").join(key, [_ID, "v"], "left_semi")


def _ways_down(step: DataFrame, ends: DataFrame) -> DataFrame:
    """``(wrid, end, x, branch, ...way)``: from each end to each vertex below
    it, and the vertex before x on the way."""
    jump, left = stored(step.withColumn("branch", F.col("v")), "jump")
    found = jump.join(ends, [_ID, "v"], "left_semi").withColumnsRenamed({"v": "end", "p": "x"})
    while left:
        after = _named(jump, "b_", v="x", p="y", branch="before")
        longer = (_named(found, "a_").join(after, [_ID, "x"])
                  .select(_ID, "end", F.col("y").alias("x"), F.col("before").alias("branch"), *_merge("a_", "b_")))
        after = after.withColumnRenamed("x", "p")
        twice = (_named(jump.drop("branch"), "a_").join(after, [_ID, "p"])
                 .select(_ID, "v", F.col("y").alias("p"), *_merge("a_", "b_"), F.col("before").alias("branch")))
        # ways (kind 1) and jumps (kind 0) of a round are one table: one job
        both, left = stored(
            longer.withColumn("kind", F.lit(1)).unionByName(
                twice.withColumnsRenamed({"v": "end", "p": "x"}).withColumn("kind", F.lit(0))), "lift", "kind = 0")
        found = found.unionByName(both.where("kind = 1").drop("kind"))
        jump = both.where("kind = 0").drop("kind").withColumnsRenamed({"end": "v", "x": "p"})
    return found


def _direction(prefix: str, name: str) -> list[Column]:
    """The eleven columns of one direction; -9999 where the way is absent."""
    def c(x: str) -> Column:
        return F.col(prefix + x)

    def mean(x: str) -> Column:
        return F.coalesce(F.try_divide(c(x), F.when(c("len") != 0, c("len"))), F.lit(0.0))

    values = {
        "length": F.round(c("len_mm") / 1000).cast("int"), "altitude_min": F.round(-c("low")).cast("int"),
        "altitude_mean": F.round(mean("altitude_average")).cast("int"),
        "altitude_max": F.round(c("altitude_maximum")).cast("int"), "slope_mean": slope_to_cdeg(mean("slope_average")),
        "slope_third_quart": slope_to_cdeg(mean("slope_third_quartile")),
        "slope_perc_90": slope_to_cdeg(mean("slope_percentile_90")),
        "slope_perc_90_max": slope_to_cdeg(c("most_percentile_90")), "slope_max": slope_to_cdeg(mean("slope_maximum")),
        "slope_max_max": slope_to_cdeg(c("most_maximum")), "slope_stddev": slope_to_cdeg(mean("slope_stddev"))}
    return [F.when(c("len_mm").isNotNull(), v).otherwise(F.lit(MISSING)).alias(f"{name}_{k}") for k, v in values.items()]


def tree_combinations(network: Network, ends: DataFrame, weight: str | None = None) -> DataFrame:
    """Lake pairs ``from_lake < to_lake`` of a network of tree clusters, with
    the columns of ``lake_combinations``; ``ends(wrid, cluster, vid)``."""
    ends, _ = stored(ends.select(_ID, "cluster", F.col("vid").alias("v")), "ends")
    step, _ = stored(_downward(network, weight), "step")
    marks = _marked(step, ends)
    step = step.join(marks, [_ID, "v"], "left_semi")
    meets = step.groupBy(_ID, F.col("p").alias("v")).agg(F.count("*").alias("n")).where("n > 1").select(_ID, "v")
    key, _ = stored(ends.select(_ID, "v").union(meets).distinct(), "key")
    between, _ = stored(_contracted(step, key), "between")
    ways, _ = stored(_ways_down(between, ends), "ways")
    # an end below an end; and two ends that meet from two branches
    nothing = [F.lit(None).cast(t).alias("b_" + c) for c, t in ways.select(*_WAY).dtypes]
    straight = (_named(ways.join(ends.select(_ID, F.col("v").alias("x")), [_ID, "x"], "left_semi").drop("branch"), "a_")
                .select("*", F.col("x").alias("other"), *nothing))
    branches = between.select(_ID, F.col("p").alias("x"), F.col("v").alias("later"))
    dealt = _named(ways, "a_").join(branches, [_ID, "x"]).where("later > branch").drop("branch")
    partner = _named(ways, "b_", end="other", branch="later")
    met = dealt.join(partner, [_ID, "x", "later"]).drop("later")
    pairs = straight.unionByName(met)
    # the smaller end is where the path begins: down its way, then up the other
    turn = F.col("end") > F.col("other")
    pairs = pairs.select(
        _ID, F.least("end", "other").alias("from_lake"), F.greatest("end", "other").alias("to_lake"), "x",
        *[F.when(turn, F.col("b_" + c)).otherwise(F.col("a_" + c)).alias("d_" + c) for c in _WAY],
        *[F.when(turn, F.col("a_" + c)).otherwise(F.col("b_" + c)).alias("u_" + c) for c in _WAY])
    v = network.vertices.select(_ID, F.col("vid").alias("x"), "cluster", is_lake("area_ha").alias("lake"), "typ")
    none = F.array().cast("array<bigint>")

    def along(name: str, here: Column) -> Column:
        parts = [F.coalesce(F.col(p + name), none) for p in ("d_", "u_")]
        return F.array_join(F.array_sort(F.concat(*parts, F.when(here, F.array("x")).otherwise(none))), ",").alias(f"{name}_along")

    return pairs.join(v, [_ID, "x"]).select(
        _ID, "from_lake", "to_lake", "cluster", along("lakes", F.col("lake")), along("confluences", F.col("typ") == 3),
        F.round((F.coalesce("d_len_mm", F.lit(0)) + F.coalesce("u_len_mm", F.lit(0))) / 1000).cast("int").alias("total_stream_length"),
        slope_to_cdeg(F.greatest("d_most_maximum", "u_most_maximum")).alias("total_slope_max_max"),
        *_direction("u_", "upstream"), *_direction("d_", "downstream"))
