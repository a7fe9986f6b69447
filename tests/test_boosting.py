"""Second-order boosting against a plain version that tries every split of every node."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskspark.operators.boosting import NewtonTrees, NewtonTreesModel, cut_points

FIELDS = "id long, x array<double>, label int, n double"


def brute(rows, rounds, depth, eta=0.1, l2=1.0, least_cover=1.0):
    """Trees as {node: (feature, cut, missing_left) or value}, and margins after each round; exact splits, plain floats."""
    width = len(rows[0][0])
    cuts = []
    for f in range(width):
        seen = sorted({x[f] for x, _, _ in rows if x[f] is not None})
        cuts.append([(a + b) / 2 for a, b in zip(seen, seen[1:])])
    margins, trees, history = [0.0] * len(rows), [], []
    for _ in range(rounds):
        p = [1 / (1 + math.exp(-m)) for m in margins]
        g = [(a - y) * n for a, (_, y, n) in zip(p, rows)]
        h = [a * (1 - a) * n for a, (_, _, n) in zip(p, rows)]
        tree, todo, step = {}, [(1, list(range(len(rows))), 0)], [0.0] * len(rows)
        while todo:
            node, mine, level = todo.pop()
            G, H = math.fsum(g[i] for i in mine), math.fsum(h[i] for i in mine)
            best = None
            if level < depth:
                for f in range(width):
                    for cut in cuts[f]:
                        for missing_left in (False, True):
                            left = [i for i in mine if (rows[i][0][f] is None and missing_left) or (rows[i][0][f] is not None and rows[i][0][f] < cut)]
                            inside = set(left)
                            right = [i for i in mine if i not in inside]
                            if not left or not right:
                                continue
                            gl, hl = math.fsum(g[i] for i in left), math.fsum(h[i] for i in left)
                            if min(hl, H - hl) < least_cover:
                                continue
                            gain = gl * gl / (hl + l2) + (G - gl) ** 2 / (H - hl + l2) - G * G / (H + l2)
                            if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                                best = (gain, f, cut, missing_left, left, right)
            if best is None:
                tree[node] = -eta * G / (H + l2)
                for i in mine:
                    step[i] = tree[node]
            else:
                tree[node] = best[1:4]
                todo += [(2 * node, best[4], level + 1), (2 * node + 1, best[5], level + 1)]
        margins = [m + s for m, s in zip(margins, step)]
        trees.append(tree)
        history.append(list(margins))
    return trees, history


def made_up(seed, size=160, gaps=True):
    rng = random.Random(seed)
    rows = []
    for _ in range(size):
        x = [float(rng.randrange(9)), rng.choice([0.0, 1.0]), rng.choice([0.0, 0.0, 0.0, 1.0]), round(rng.gauss(0, 1), 2)]
        y = int(rng.random() < 1 / (1 + math.exp(-(x[0] - 4) - 2 * x[2] * x[1] + x[3])))
        if gaps and rng.random() < 0.2:
            x[rng.randrange(4)] = None
        rows.append((x, y, float(rng.randrange(1, 4))))
    return rows


def shape(nodes):
    return {n.node: (n.feature, n.cut, n.missing_left) if n.feature is not None else n.value for n in nodes}


@pytest.mark.parametrize("seed,gaps", [(1, False), (2, True)])
def test_trees_equal_brute_force(spark, seed, gaps):
    rows = made_up(seed, gaps=gaps)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], FIELDS).repartition(3)
    model = NewtonTrees(featuresCol="x", weightCol="n", rounds=3, depth=3).fit(df)
    trees, history = brute(rows, 3, 3)
    for got, want in zip(map(shape, model.nodes()), trees):
        assert set(got) == set(want)
        for node, w in want.items():
            if isinstance(w, float):
                assert got[node] == pytest.approx(w, abs=1e-9)
            else:
                assert got[node][:2] == w[:2]
                # Without missing rows in a node both sides gain the same.
                assert got[node][2] == w[2] or not gaps
    scores = {(r.id, r.round): r.score for r in model.round_margins(df, "id").collect()}
    for i, _ in enumerate(rows):
        for k in range(3):
            assert scores[i, k + 1] == pytest.approx(history[k][i], abs=1e-9)
    probabilities = {r.id: r.probability[1] for r in model.transform(df).collect()}
    assert all(p == pytest.approx(1 / (1 + math.exp(-history[-1][i])), abs=1e-9) for i, p in probabilities.items())


def test_order_and_partitions_change_no_bit(spark):
    rows = [(i, *r) for i, r in enumerate(made_up(3, 300))]
    fit = lambda df: NewtonTrees(featuresCol="x", weightCol="n", rounds=2).fit(df).getOrDefault("trees")
    assert fit(spark.createDataFrame(rows, FIELDS).coalesce(1)) == fit(spark.createDataFrame(rows[::-1], FIELDS).repartition(6))


def test_merged_rows_and_vectors_give_the_same_model(spark):
    rows = [(x, y, 1.0) for x, y, _ in made_up(4, 80, gaps=False)]
    single = spark.createDataFrame([(i, *r) for i, r in enumerate(rows * 2)], FIELDS)
    merged = spark.createDataFrame([(i, x, y, 2.0) for i, (x, y, _) in enumerate(rows)], FIELDS).withColumn("x", array_to_vector("x"))
    trees = [NewtonTrees(featuresCol="x", weightCol="n", rounds=2, depth=2).fit(d).getOrDefault("trees") for d in (single, merged)]
    assert trees[0] == trees[1]


def test_many_values_are_cut_at_quantiles(spark):
    df = spark.range(1000).select(F.array(F.col("id").cast("double"), (F.col("id") % 2).cast("double")).alias("x"), (F.col("id") >= 700).cast("int").alias("label"))
    cuts = cut_points(df, "x", 10)
    assert cuts[1] == [0.5] and cuts[0] == pytest.approx([99.9 * i for i in range(1, 10)])
    root = NewtonTrees(featuresCol="x", rounds=1, depth=1, maxBins=10).fit(df).nodes()[0][0]
    assert (root.feature, root.cut) == (0, pytest.approx(699.3))


def test_a_single_class_and_constant_features_give_leaves(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0], 1, 1.0)] * 8, FIELDS)
    nodes = NewtonTrees(featuresCol="x", rounds=2).fit(one).nodes()
    assert [len(t) for t in nodes] == [1, 1] and nodes[0][0].value == pytest.approx(0.1 * 4 / (2 + 1))
    with pytest.raises(ValueError, match="no rows"):
        NewtonTrees(featuresCol="x").fit(one.where("false"))


def test_saved_and_loaded(spark, tmp_path):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(made_up(5))], FIELDS)
    model = NewtonTrees(featuresCol="x", weightCol="n", rounds=2).fit(df)
    model.write().save(str(tmp_path / "model"))
    again = NewtonTreesModel.load(str(tmp_path / "model"))
    assert again.nodes() == model.nodes()
    assert again.tree_table(spark).where("feature is null").count() >= 4
    assert [tuple(r) for r in again.transform(df).select("id", "margin").collect()] == [tuple(r) for r in model.transform(df).select("id", "margin").collect()]
