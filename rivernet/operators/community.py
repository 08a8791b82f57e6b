"""threshold_clusters (G13): clusters of the lake graph after cutting arcs
by a slope threshold, for a whole ladder of thresholds at once.

The reference's community section cannot run (Q5); this is its intended
computation re-aimed: one long table ``(t, wrid, vid, cluster)``.  An arc is
there from some threshold on, so clusters only merge along the ladder, and the
ladder is divided: components at some thresholds of a range split it into
smaller ranges.  One of these has the arcs that come within it, and between
the components below it, each of which is one vertex from now on.  An arc is
in one range of each round, so a round searches it ``fan`` times at most,
whatever the number of thresholds, and the rounds are logarithmic in it.  A
vertex without arcs in a range keeps its cluster there; it is stored once,
with the range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .doubling import stored
from .iterate import connected_components
from .network import Network


def _cuts(fan: int) -> str:
    """Steps searched in a range: all of a short one, else ``fan - 1`` of them."""
    return (f"IF(until - begin + 1 < {fan}, sequence(begin, until), "
            f"transform(sequence(1, {fan - 1}), j -> begin + CAST(j * (until - begin + 1) div {fan} AS INT)))")


def merge_ladder(vertices: DataFrame, arcs: DataFrame, last: int, fan: int = 16) -> DataFrame:
    """``(wrid, vid, begin, until, cluster)``: the cluster (its smallest vertex) of a
    vertex from step ``begin`` to ``until`` of ``0..last``.

    ``arcs(wrid, src, dst, low)`` are there from step ``low`` on."""
    und = arcs.where((F.col("src") != F.col("dst")) & (F.col("low") <= last)).groupBy(
        "wrid", F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).agg(F.min("low").alias("low"))
    edges, left = stored(und.withColumns({"begin": F.lit(0), "until": F.lit(last)}), "edges")
    # own: the vertices of a range, and which x stands for each
    own = vertices.select("wrid", "vid", F.col("vid").alias("x"), F.lit(0).alias("begin"), F.lit(last).alias("until"))
    key, done = ["wrid", "begin", "until"], []
    while left:
        cuts = F.expr(_cuts(fan))
        ends = edges.select(*key, F.col("src").alias("x")).union(edges.select(*key, "dst")).distinct()
        there = edges.withColumn("at", F.explode(F.filter(cuts, lambda c: c >= F.col("low"))))
        parts, _ = stored(connected_components(ends.withColumn("at", F.explode(cuts)), there, [*key, "at"], "x"), "parts")
        named = own.join(parts, [*key, "x"], "left").withColumn("cuts", cuts)
        after = F.coalesce(F.array_min(F.filter("cuts", lambda c: c > F.col("at"))), F.col("until") + 1)

        def row(state, x, begin, until):
            return F.struct(F.lit(state).alias("open"), x.alias("x"), begin.alias("begin"), until.alias("until"))

        at, comp, x = F.col("at"), F.col("component"), F.col("x")
        # no arc in the range: one cluster from its first to its last step
        rows = F.when(at.isNull(), F.array(row(False, x, F.col("begin"), F.col("until")))).otherwise(F.array(
            row(False, comp, at, at), row(True, comp, at + 1, after - 1),
            row(True, x, F.col("begin"), F.when(at == F.array_min("cuts"), at - 1))))
        named = named.select("wrid", "vid", F.explode(rows).alias("r")).select("wrid", "vid", "r.*").where("begin <= until")
        named, _ = stored(named, "own")
        done.append(named.where("not open").drop("open"))
        own = named.where("open").drop("open")
        # arcs that come between two searched steps, between the components at the lower one
        late = (edges.withColumn("cuts", cuts).where(~F.array_contains("cuts", F.col("low")))
                .withColumns({"at": F.array_max(F.filter("cuts", lambda c: c < F.col("low"))),
                              "next": F.coalesce(F.array_min(F.filter("cuts", lambda c: c > F.col("low"))), F.col("until") + 1)}))
        of = parts.select(*key, "at", F.col("x").alias("src"), F.col("component").alias("a"))
        to = parts.select(*key, "at", F.col("x").alias("dst"), F.col("component").alias("b"))
        late = (late.join(of, [*key, "at", "src"], "left").join(to, [*key, "at", "dst"], "left")
                .select("wrid", "low", F.coalesce("a", "src").alias("a"), F.coalesce("b", "dst").alias("b"),
                        F.coalesce(F.col("at") + 1, "begin").alias("begin"), (F.col("next") - 1).alias("until")))
        edges, left = stored(late.where("a <> b").groupBy(*key, F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"))
                             .agg(F.min("low").alias("low")), "edges")
    done.append(own.select("wrid", "vid", "x", "begin", "until"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.withColumnRenamed("x", "cluster")


def threshold_clusters(network: Network, attr: str = "slope_average", first: int = 0,
                       last: int = 200, denominator: int = 200, keep: str = "le") -> DataFrame:
    """Thresholds ``t = i / denominator`` for ``i`` in ``first..last``.

    ``keep="le"``: an arc stays while ``attr <= t`` (steeper reaches are
    barriers); ``keep="ge"``: it stays while ``attr >= t`` (as the reference
    text reads, arcs below the threshold removed).  Returns ``(i, t, wrid,
    vid, cluster)``, ``cluster`` = smallest vertex id of the component."""
    d = float(denominator)
    nat = network.arcs.where(F.col("direction") == "downstream").select("wrid", "src", "dst", attr)
    x = F.col(attr)
    if keep == "le":
        low = F.greatest(F.lit(first), F.ceil(x * d).cast("int") - 1)
        low = F.when(x <= low / d, low).otherwise(low + 1)
        step, i = low - first, F.col("step") + first
    else:  # from the last threshold down
        high = F.least(F.lit(last), F.floor(x * d).cast("int") + 1)
        high = F.when(x >= high / d, high).otherwise(high - 1)
        step, i = last - high, last - F.col("step")
    arcs = nat.select("wrid", "src", "dst", step.cast("int").alias("low"))
    if keep == "ge":
        arcs = arcs.where(F.col("low") <= last - first)
    ladder = merge_ladder(network.vertices.select("wrid", "vid"), arcs, last - first)
    return (ladder.withColumn("step", F.explode(F.sequence("begin", "until"))).withColumn("i", i)
            .select("i", (F.col("i") / d).alias("t"), "wrid", "vid", "cluster"))
