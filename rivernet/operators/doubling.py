"""Searches that take rounds logarithmic in the length of a river.

``chains`` follows a graph whose vertices have one successor at most: round k
joins what is known within 2^k steps with the table of steps of length 2^k,
and squares that table.  ``reach`` (G6) uses it on any graph: a vertex with
two successors or more ends a chain, as does one vertex of each cycle without
such a vertex; these are the core.  A path is a chain up to the core, a walk
from core vertex to core vertex, and a chain again, so the level search runs
over the core alone, with the chains between as weighted arcs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .iterate import merged, scratch_path

#: Steps that every task may know; more are joined by merging.
FEW = 10_000


def stored(df: DataFrame, tag: str, counted: str = "true") -> tuple[DataFrame, int]:
    """``df`` written to the checkpoint folder and read back (:func:`merged`),
    and how many of its rows are ``counted``, found while they are written."""
    path, seen = scratch_path(df.sparkSession, tag), Observation()
    df.observe(seen, F.count_if(F.expr(counted)).alias("n")).write.parquet(path)
    return merged(df.sparkSession.read.schema(df.schema).parquet(path)), seen.get["n"]


def steps_squared(step: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``step(keys, v, w, hop, least)`` taken twice; ``least``: smallest vertex
    on the way, the first one left out."""
    on = [*keys, "w"]
    after = step.select(*keys, F.col("v").alias("w"), F.col("w").alias("w2"), F.col("hop").alias("hop2"),
                        F.col("least").alias("least2"))
    return step.join(after, on).select(*keys, "v", F.col("w2").alias("w"), (F.col("hop") + F.col("hop2")).alias("hop"),
                                       F.least("least", "least2").alias("least"))


def chains(step: DataFrame, seeds: DataFrame, keys: Sequence[str], n: int,
           forward: bool) -> tuple[DataFrame, DataFrame | None]:
    """All ``(keys, p, q, hop)`` with q ``hop`` steps after p.

    ``step(keys, v, w)``: the successor of v, one at most.  ``seeds(keys, v)``
    are the p (``forward``) or the q.  ``n``: vertices of the largest graph;
    where steps of that length are left there is a cycle, and one vertex of
    each cycle is returned as the second result."""
    keys = list(keys)
    jump = merged(step.select(*keys, "v", "w", F.lit(1).alias("hop"), F.col("w").alias("least")))
    found = seeds.select(*keys, F.col("v").alias("p"), F.col("v").alias("q"), F.lit(0).alias("hop"))
    length, more = 1, True
    while more:
        if forward:
            longer = found.join(jump.select(*keys, F.col("v").alias("q"), "w", F.col("hop").alias("far")), [*keys, "q"]) \
                .select(*keys, "p", F.col("w").alias("q"), (F.col("hop") + F.col("far")).alias("hop"))
        else:
            longer = found.join(jump.select(*keys, "v", F.col("w").alias("p"), F.col("hop").alias("far")), [*keys, "p"]) \
                .select(*keys, F.col("v").alias("p"), "q", (F.col("hop") + F.col("far")).alias("hop"))
        # steps (kind 0) and findings (kind 1) of a round are one table: one job
        both, left = stored(
            steps_squared(jump, keys).select(*keys, F.lit(0).alias("kind"), F.col("v").alias("p"), F.col("w").alias("q"),
                                             "hop", "least")
            .unionByName(longer.withColumns({"kind": F.lit(1), "least": F.lit(None)})), "steps", "kind = 0")
        jump = both.where("kind = 0").select(*keys, F.col("p").alias("v"), F.col("q").alias("w"), "hop", "least")
        if left <= FEW:
            jump = F.broadcast(jump)
        found = found.unionByName(both.where("kind = 1").select(*keys, "p", "q", "hop"))
        length, more = length * 2, left > 0
        if more and length > n:
            return found, jump.where("v = least").select(*keys, "v")
    return found, None


def _core_walks(arcs: DataFrame, keys: list[str]) -> DataFrame:
    """Fewest hops between core vertices over ``arcs(keys, c, d, hop)``: a
    vertex is walked on from whenever its hops have become fewer."""
    arcs = arcs.groupBy(*keys, "c", "d").agg(F.min("hop").alias("hop"))
    arcs, _ = stored(arcs, "core")
    best, _ = stored(arcs.select(*keys, "c").union(arcs.select(*keys, "d")).distinct()
                     .select(*keys, "c", F.col("c").alias("d"), F.lit(0).alias("hop")), "walks")
    front = best
    while True:
        step = arcs.select(*keys, F.col("c").alias("d"), F.col("d").alias("e"), F.col("hop").alias("far"))
        new = (front.join(step, [*keys, "d"])
               .groupBy(*keys, "c", F.col("e").alias("d")).agg(F.min(F.col("hop") + F.col("far")).alias("hop")))
        old = best.withColumnRenamed("hop", "old")
        front, n = stored(new.join(old, [*keys, "c", "d"], "left").where("old is null or hop < old").drop("old"), "front")
        if not n:
            return best
        best, _ = stored(best.unionByName(front).groupBy(*keys, "c", "d").agg(F.min("hop").alias("hop")), "walks")


def _followed(arcs: DataFrame, keys: list[str], n: int, seeds: Callable[[DataFrame], DataFrame],
              forward: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Steps outside the core, the core ``(keys, v)``, and the :func:`chains`
    of ``seeds(core)``."""
    out = arcs.groupBy(*keys, F.col("a").alias("v")).agg(F.count("*").alias("n"), F.min("b").alias("w"))
    out, _ = stored(out, "successors")
    cut_at = None
    while True:
        step, core = out.where("n = 1").select(*keys, "v", "w"), out.where("n > 1").select(*keys, "v")
        if cut_at is not None:
            step, core = step.join(cut_at, [*keys, "v"], "left_anti"), core.union(cut_at)
        found, cycles = chains(step, seeds(core), keys, n, forward)
        if cycles is None:
            return step, core, found
        cut_at, _ = stored(cycles.distinct() if cut_at is None else cut_at.union(cycles).distinct(), "cycles")


def _heads(arcs: DataFrame, core: DataFrame, keys: list[str]) -> DataFrame:
    return arcs.join(merged(core.withColumnRenamed("v", "a")), [*keys, "a"], "left_semi")


def _flow(arcs: DataFrame, keys: list[str], starts: DataFrame | None, ends: DataFrame | None, n: int) -> DataFrame:
    """``(keys, p, q, hop)``: fewest arcs from p to q, for p in ``starts`` or q
    in ``ends(keys, v)`` (the other is None: any vertex); 0 hops included."""
    def seeds(core: DataFrame) -> DataFrame:
        more = core if starts is None else _heads(arcs, core, keys).select(*keys, "b")
        return (ends if starts is None else starts).union(more).distinct()

    _, core, found = _followed(arcs, keys, n, seeds, starts is not None)
    if core.isEmpty():
        return found
    to_core = merged(found.join(merged(core.withColumnRenamed("v", "q")), [*keys, "q"], "left_semi"))
    heads = _heads(arcs, core, keys).select(*keys, F.col("a").alias("d"), F.col("b").alias("p"))
    walks = _core_walks(heads.join(to_core, [*keys, "p"])
                        .select(*keys, F.col("d").alias("c"), F.col("q").alias("d"), (F.col("hop") + 1).alias("hop")), keys)
    # core vertices without a way to another one
    walks = walks.unionByName(core.select(*keys, F.col("v").alias("c"), F.col("v").alias("d"), F.lit(0).alias("hop")))
    last = heads.join(merged(found.withColumnRenamed("hop", "far")), [*keys, "p"]).select(*keys, "d", "q", (F.col("far") + 1).alias("far"))
    beyond = walks.join(merged(last), [*keys, "d"]).groupBy(*keys, "c", "q").agg(F.min(F.col("hop") + F.col("far")).alias("far"))
    beyond, _ = stored(beyond, "beyond")
    onward = (to_core.select(*keys, "p", F.col("q").alias("c"), "hop").join(beyond, [*keys, "c"])
              .select(*keys, "p", "q", (F.col("hop") + F.col("far")).alias("hop")))
    return found.unionByName(onward).groupBy(*keys, "p", "q").agg(F.min("hop").alias("hop"))


def reach(arcs: DataFrame, sources: DataFrame, keys: Sequence[str] = ("wrid",),
          a: str = "a", b: str = "b", src: str = "src") -> DataFrame:
    """All vertices reachable from each source over ``a -> b`` arcs.

    ``sources`` has ``keys + [src]``; ``arcs`` has ``keys + [a, b]``.  Extra key
    columns (for instance a direction tag) run independent searches in one
    job.  Returns ``keys + [src, "v", "hop"]``, the source itself excluded,
    ``hop`` = fewest arcs.  Cycles are safe.

    The search runs with the arcs or against them, whichever way fewer
    vertices have several successors (down a river, nearly none)."""
    keys = list(keys)
    one, _ = stored(arcs.select(*keys, F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "arcs")
    ends = one.select(*keys, "a", F.lit(1).alias("o"), F.lit(0).alias("i")).union(
        one.select(*keys, "b", F.lit(0), F.lit(1)))
    size = ends.groupBy(*keys, "a").agg(F.sum("o").alias("o"), F.sum("i").alias("i")).groupBy(*keys).agg(
        F.count("*").alias("n"), F.sum((F.col("o") > 1).cast("int")).alias("forks"),
        F.sum((F.col("i") > 1).cast("int")).alias("joins"))
    size = size.agg(F.max("n").alias("n"), F.sum("forks").alias("forks"), F.sum("joins").alias("joins")).first()
    seeds, _ = stored(sources.select(*keys, F.col(src).alias("v")).distinct(), "sources")
    if (size["forks"] or 0) <= (size["joins"] or 0):
        found = _flow(one, keys, seeds, None, size["n"] or 1)
        out = found.join(seeds.withColumnRenamed("v", "p"), [*keys, "p"], "left_semi")
        out = out.select(*keys, F.col("p").alias(src), F.col("q").alias("v"), "hop")
    else:
        back = one.select(*keys, F.col("b").alias("a"), F.col("a").alias("b"))
        found = _flow(back, keys, None, seeds, size["n"] or 1)
        out = found.join(seeds.withColumnRenamed("v", "q"), [*keys, "q"], "left_semi")
        out = out.select(*keys, F.col("q").alias(src), F.col("p").alias("v"), "hop")
    return out.where((F.col(src) != F.col("v")))


def diameter(arcs: DataFrame, keys: Sequence[str] = ("wrid",), a: str = "a", b: str = "b") -> DataFrame:
    """The longest shortest path (in arcs) of each key that has an arc.

    Only the core and the chain vertices that lie on a cycle with it search
    for all they reach.  Any other vertex has one way down to the first of
    these, or to an outlet, and what it reaches beyond is that much farther."""
    keys = list(keys)
    one, _ = stored(arcs.select(*keys, F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "arcs")
    n = one.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    step, core, down = _followed(one, keys, n + 1, lambda c: c, False)  # p: chain vertex, q: its core vertex
    step, _ = stored(step, "steps")
    core, some = stored(core.distinct(), "core")
    hard = core
    if some:
        found = reach(one, core.select(*keys, F.col("v").alias("src")), keys)
        ring = down.select(*keys, F.col("q").alias("src"), F.col("p").alias("v")).join(merged(found), [*keys, "src", "v"], "left_semi")
        hard, _ = stored(core.union(ring.select(*keys, "v")).distinct(), "hard")
        far = merged(reach(one, hard.select(*keys, F.col("v").alias("src")), keys).groupBy(*keys, F.col("src").alias("q"))
                     .agg(F.max("hop").alias("far")))
    outlets = one.select(*keys, F.col("b").alias("v")).join(one.select(*keys, F.col("a").alias("v")), [*keys, "v"], "left_anti")
    tails, _ = chains(step.join(hard, [*keys, "v"], "left_anti"), hard.union(outlets).distinct(), keys, n + 1, False)
    if some:
        tails = tails.join(far, [*keys, "q"], "left").withColumn("hop", F.col("hop") + F.coalesce("far", F.lit(0)))
    return tails.groupBy(*keys).agg(F.max("hop").alias("diameter"))
