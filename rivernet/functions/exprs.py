"""Scalar and aggregate column expressions (inventory rows X* and A9).

Everything here returns a ``Column`` (or a DataFrame transformed with
columns only), so it stays inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The nine statistics computed per edge, in this order.
STATS = ("minimum", "maximum", "average", "stddev", "variance",
         "first_quartile", "median", "third_quartile", "percentile_90")

# Fixed value: sentinel written for an absent path direction.
MISSING = -9999


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def slope_to_cdeg(x) -> Column:
    """rise/run slope -> whole hundredths of a degree; NULL stays NULL."""
    return F.round(F.degrees(F.atan(_c(x))) * 100).cast("int")


def add_slope_degrees(edges: DataFrame) -> DataFrame:
    """``slope_<stat>_deg`` = degrees(atan(slope_<stat>)), not rounded."""
    return edges.withColumns(
        {f"slope_{s}_deg": F.degrees(F.atan(F.col(f"slope_{s}"))) for s in STATS})


def coerce_scalar(x) -> Column:
    """Typed reading of a text value: integral -> long, other number ->
    double, else the text.  Returned as ``struct(as_long, as_double, as_text)``
    with exactly one field set."""
    s = F.trim(_c(x).cast("string"))
    as_double = s.try_cast("double")
    integral = as_double.isNotNull() & (as_double == F.floor(as_double)) & \
        (F.abs(as_double) < F.lit(9.2e18))
    return F.struct(
        F.when(integral, as_double.cast("long")).alias("as_long"),
        F.when(as_double.isNotNull() & ~integral, as_double).alias("as_double"),
        F.when(as_double.isNull(), s).alias("as_text"),
    )


def fill_edge_stats(edges: DataFrame, columns=None) -> DataFrame:
    """NULL and NaN statistics become 0."""
    cols = columns or [f"{p}_{s}" for p in ("altitude", "slope") for s in STATS]
    return edges.withColumns({
        c: F.when(F.col(c).isNull() | F.isnan(F.col(c)), F.lit(0.0)).otherwise(F.col(c))
        for c in cols})


def is_lake(area="area_ha") -> Column:
    """A vertex is a lake when its area is > 0; NULL and NaN are not."""
    a = _c(area)
    return F.coalesce(a.isNotNull() & ~F.isnan(a) & (a > 0), F.lit(False))


def direction_weight(direction="direction") -> Column:
    """1 for arcs walked against the flow, else 0."""
    return F.when(_c(direction) == "upstream", 1).otherwise(0)


def classify_vertex(indeg="indegree", outdeg="outdegree") -> Column:
    """X11: vertex type; later rules of the definition win.

    5 isolated, 4 outlet, 3 confluence, 2 connection, 1 source, 0 other."""
    i, o = _c(indeg), _c(outdeg)
    return (F.when((i == 0) & (o == 0), 5)
            .when(o == 0, 4)
            .when(i > 1, 3)
            .when((i == 1) & (o == 1), 2)
            .when(i == 0, 1)
            .otherwise(0))


def canonical_pair(a, b) -> tuple[Column, Column]:
    """(larger, smaller) of two ids."""
    return F.greatest(_c(a), _c(b)), F.least(_c(a), _c(b))


def round_metres(x) -> Column:
    """Whole metres, half away from zero."""
    return F.round(_c(x)).cast("int")


def weighted_avg(x, w) -> Column:
    """A9 (aggregate): sum(x*w)/sum(w) over rows where both are set;
    0 when the weight sum is 0 or there is no such row."""
    xc, wc = _c(x), _c(w)
    both = xc.isNotNull() & wc.isNotNull()
    num = F.sum(F.when(both, xc * wc))
    den = F.sum(F.when(both, wc))
    return F.coalesce(F.try_divide(num, F.when(den != 0, den)), F.lit(0.0))


def combination_count(n) -> Column:
    """Number of unordered pairs of n lakes."""
    nc = _c(n).cast("long")
    return (nc * (nc - 1) / 2).cast("long")


def fixed_round(x, digits: int = 6) -> Column:
    """Half-up rounding written as ``floor(x * 10^d + 0.5) / 10^d``: the same
    IEEE operations in every engine, so equal inputs give equal outputs
    (engines' own ``round`` differ on exact decimal ties)."""
    q = float(10 ** digits)
    return F.floor(_c(x) * q + 0.5) / q


def exact_avg(x, scale: int) -> Column:
    """Average of ``x`` quantised to ``10^-scale``, summed as integers: the
    result does not depend on partitioning or summation order."""
    q = float(10 ** scale)
    return F.sum(F.round(_c(x) * q).cast("long")) / F.count(_c(x)) / q


def exact_sum(x, scale: int = 9):
    """Sum in decimals of ``scale`` places: the same for any partitioning and
    order of the rows.  Values stay below 10^(28 - scale)."""
    return F.sum(_c(x).cast(f"decimal(28,{scale})")).cast("double")
