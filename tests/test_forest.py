"""Lake pairs of tree clusters against the path search."""

import random

from pyspark.sql import functions as F

from rivernet.operators.forest import split_network, tree_clusters
from rivernet.operators.network import STAT_COLUMNS, compile_network
from rivernet.operators.paths import lake_combinations, searched_combinations


def rivers(spark, seed, blocks, n=24):
    """Random rivers: deep and bushy trees, some with parallel lines, a
    bifurcation, a border between lakes or two regions' worth of blocks."""
    rnd = random.Random(seed)
    lines, nodes, borders = [], [], []
    for b in range(blocks):
        wrid, base = b % 2, 100 * b
        kind = b % 6
        reach = 2 if kind in (0, 3) else n
        for v in range(n):
            lake = rnd.random() < (0.15 if kind == 1 else 0.45)
            nodes.append((wrid, base + v, base + v, rnd.randrange(1, 40) / 8 if lake else None))
            if v:
                to = base + rnd.randrange(max(0, v - reach), v)
                lines.append((wrid, base + v, to))
                if rnd.random() < 0.2:
                    lines.append((wrid, base + v, to))          # parallel
        if kind == 4:
            lines.append((wrid, base + n - 1, base))            # bifurcation
        if kind == 5:
            borders.append((wrid, base + 3, base + n - 2))
    lines = [(w, i + 1, a, z, rnd.randrange(8, 4000) / 8) for i, (w, a, z) in enumerate(lines)]
    edges = [(w, cat, length, *[rnd.randrange(0, 800) / 16 for _ in STAT_COLUMNS]) for w, cat, _, _, length in lines]
    stats = ", ".join(f"{c} double" for c in STAT_COLUMNS)
    return compile_network(
        spark.createDataFrame(lines, "wrid int, line_cat bigint, from_node bigint, to_node bigint, length_m double"),
        spark.createDataFrame(nodes, "wrid int, node_id bigint, lakeid bigint, area_ha double"),
        spark.createDataFrame(edges, f"wrid int, cat bigint, length_m double, {stats}"),
        spark.createDataFrame(borders, "wrid int, left_lake bigint, right_lake bigint"))


def test_trees_equal_the_path_search(spark):
    net = rivers(spark, 3, 12)
    got = sorted(map(tuple, lake_combinations(net).collect()))
    assert got == sorted(map(tuple, searched_combinations(net).collect()))
    assert tree_clusters(net).count() == 8 and len(got) > 200
    focal = net.vertices.where("area_ha > 2").select("wrid", "lakeid")
    trees, others = split_network(net)
    assert trees.vertices.count() == 8 * 24 and others.vertices.count() == 4 * 24
    # chosen ends: other lakes lie between them
    assert sorted(map(tuple, lake_combinations(trees, focal).collect())) == sorted(
        map(tuple, searched_combinations(trees, focal).collect()))


def test_weights_choose_among_parallel_lines(spark):
    net = rivers(spark, 5, 2)
    arcs = net.arcs.withColumn("dir_weight", (F.col("line_cat") * 7919 % 13).cast("int"))
    net = type(net)(net.vertices, arcs)
    assert sorted(map(tuple, lake_combinations(net, weight="dir_weight").collect())) == sorted(
        map(tuple, searched_combinations(net, weight="dir_weight").collect()))
