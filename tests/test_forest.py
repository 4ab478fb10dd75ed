"""Forests against a plain recursion, over partitions and over node sizes."""

import math
import time

import numpy as np
import pytest
from pyspark.ml import PipelineModel

from wardline.operators import models as L
from wardline.operators.forest import Forest, Growth, _kernel, grow_forest

KERNEL = _kernel()


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(5)
    x = np.round(draw.normal(size=(240, 5)), 2)
    x[:, 3] = draw.integers(0, 3, 240)
    x[:, 4] = 7.0  # constant
    return [(x[i].tolist(), int(x[i, 0] + x[i, 1] > 0) + int(x[i, 2] > 1)) for i in range(240)]


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "features array<double>, label int").repartition(4)


def gini(labels):
    n = len(labels)
    return n - sum(labels.count(c) ** 2 for c in set(labels)) / n if n else 0.0


def drawn_tree(growth, key, rows, classes, depth=0):
    """Class counts, and feature, threshold and sides of an extremely randomised tree."""
    labels = [y for _, y in rows]
    counts = tuple(labels.count(c) for c in range(classes))
    leaf = (counts,)
    if len(set(labels)) < 2 or len(rows) < max(growth.min_split, 2 * growth.min_leaf) or depth == growth.max_depth:
        return leaf
    spans = [(min(x[f] for x, _ in rows), max(x[f] for x, _ in rows)) for f in range(len(rows[0][0]))]
    varying = sorted((f for f, (a, b) in enumerate(spans) if b > a), key=lambda f: KERNEL["unit"](key, f))[: math.isqrt(len(spans))]
    best = None
    for f in varying:
        low, high = spans[f]
        at = min(low + KERNEL["unit"](key, f + (1 << 20)) * (high - low), np.nextafter(high, low))
        left, right = [r for r in rows if r[0][f] <= at], [r for r in rows if r[0][f] > at]
        if min(len(left), len(right)) >= growth.min_leaf:
            gain = gini(labels) - gini([y for _, y in left]) - gini([y for _, y in right])
            if best is None or gain > best[0] + 1e-9:
                best = (gain, f, at, left, right)
    if best is None:
        return leaf
    _, f, at, left, right = best
    child = KERNEL["child"]
    return counts, f, at, drawn_tree(growth, child(key, False), left, classes, depth + 1), drawn_tree(growth, child(key, True), right, classes, depth + 1)


def nested(tree, node=0):
    f, at, left, right, counts, _ = tree[node]
    counts = tuple(int(c) for c in counts)
    return (counts,) if f < 0 else (counts, f, at, nested(tree, left), nested(tree, right))


@pytest.mark.parametrize("local_rows", [50_000, 40, 1])
@pytest.mark.parametrize(("min_leaf", "min_split", "max_depth"), [(1, 2, None), (5, 30, 4)])
def test_drawn_trees_equal_a_plain_recursion(rows, table, local_rows, min_leaf, min_split, max_depth):
    if local_rows == 1 and max_depth is None:
        max_depth = 3
    growth = Growth(trees=3, max_depth=max_depth, min_leaf=min_leaf, min_split=min_split, drawn=True, bootstrap=False, seed=9)
    trees, classes, width = grow_forest(table, growth, local_rows=local_rows)
    assert (classes, width) == (3, 5)
    for t, tree in enumerate(trees):
        assert nested(tree) == drawn_tree(growth, KERNEL["root"](growth, t), rows, 3)


def test_searched_split_is_the_best(rows, table):
    growth = Growth(trees=1, max_depth=1, max_features="all", bootstrap=False)
    (tree,), _, _ = grow_forest(table, growth)
    labels = [y for _, y in rows]
    gains = {}
    for f in range(5):
        for at in {x[f] for x, _ in rows}:
            left, right = [y for x, y in rows if x[f] <= at], [y for x, y in rows if x[f] > at]
            if left and right:
                gains[f, at] = gini(labels) - gini(left) - gini(right)
    assert tree[0][5] == pytest.approx(max(gains.values()))
    (coarse,), _, _ = grow_forest(table, growth, local_rows=1)
    assert coarse[0][5] > 0.9 * max(gains.values())


def test_limits_and_bootstrap(rows, table):
    for growth in (Growth(trees=4, min_split=40, seed=3), Growth(trees=4, min_leaf=20, seed=3), Growth(trees=4, max_depth=2, seed=3)):
        trees, _, _ = grow_forest(table, growth, local_rows=60)
        again, _, _ = grow_forest(table.repartition(2), growth, local_rows=60)
        assert len(trees) == len(again) == 4
        for tree in trees:
            assert all(n[4].sum() > 0 for n in tree)
            if growth.max_depth == 2:
                assert len(tree) <= 7
            assert all(n[4].sum() >= growth.min_split * 0.5 for n in tree if n[0] >= 0)
    weights = KERNEL["weights"](Growth(), 0, np.arange(100_000))
    assert abs(weights.mean() - 1) < 0.02 and abs((weights == 0).mean() - math.exp(-1)) < 0.01 and weights.max() < 20


def test_model_predicts_and_is_stored(spark, table, tmp_path):
    model = L.random_forest(numTrees=20, minInstancesPerNode=1).fit(table)
    scored = L.predict(model, table)
    assert scored.where("prediction = label").count() > 230
    assert model.featureImportances.sum() == pytest.approx(1) and model.featureImportances[4] == 0
    path = str(tmp_path / "model")
    PipelineModel([model]).write().save(path)
    back = PipelineModel.load(path)
    want = {tuple(r.features): (r.prediction, tuple(r.probability)) for r in scored.collect()}
    assert {tuple(r.features): (r.prediction, tuple(r.probability)) for r in L.predict(back, table).collect()} == want


def test_odd_tables(spark, table):
    with pytest.raises(ValueError, match="no labelled rows"):
        grow_forest(table.limit(0), Growth(trees=1))
    odd = spark.createDataFrame([([1.0, float("nan")], 0), ([2.0, 5.0], 1), ([3.0, 6.0], None), ([1.0, float("nan")], 0)], "features array<double>, label int")
    model = Forest(Growth(trees=5, drawn=True, bootstrap=False)).fit(odd)
    assert [r.prediction for r in model.transform(odd.where("label IS NOT NULL").orderBy("label")).collect()] == [0.0, 0.0, 1.0]
    one = Forest(Growth(trees=2)).fit(odd.where("label = 0"))
    assert {r.prediction for r in one.transform(odd).collect()} == {0.0}


@pytest.mark.parametrize("growth", [
    Growth(trees=5, seed=3), Growth(trees=4, min_leaf=4, max_depth=5, max_features="all", seed=8), Growth(trees=4, drawn=True, bootstrap=False),
    Growth(trees=4, drawn=True, min_split=9, seed=2), Growth(trees=3, bootstrap=False, max_features=0.7),
])
@pytest.mark.parametrize("local_rows", [50_000, 60])
def test_whole_trees_equal_those_grown_by_all_tasks(spark, table, growth, local_rows):
    gaps = table.selectExpr("transform(features, (v, i) -> if(i = 1 AND v < -1, double('nan'), v)) AS features", "label")
    for rows in (table, gaps):
        stored = spark.createDataFrame(rows.collect(), rows.schema).repartition(3)
        whole, shared = (grow_forest(stored, growth, local_rows=local_rows, whole_bytes=size)[0] for size in (1 << 30, 0))
        assert len(whole) == len(shared) == growth.trees
        for a, b in zip(whole, shared):
            assert nested(a) == nested(b)
            assert [n[5] for n in a] == [n[5] for n in b] and all(n[5] == 0 for n in a if n[0] < 0)


def test_drawn_trees_of_all_tasks_equal_a_plain_recursion(rows, table):
    growth = Growth(trees=3, min_leaf=2, max_depth=6, drawn=True, bootstrap=False, seed=9)
    for t, tree in enumerate(grow_forest(table, growth, local_rows=70, whole_bytes=0)[0]):
        assert nested(tree) == drawn_tree(growth, KERNEL["root"](growth, t), rows, 3)


def test_importances_are_the_summed_gains(table):
    model = L.random_forest(numTrees=7, minInstancesPerNode=2).fit(table)
    want = np.zeros(5)
    for tree in model.trees:
        own = np.zeros(5)
        for feature, _, left, right, counts, gain in tree:
            if feature >= 0:
                parts = [tree[i][4].tolist() for i in (left, right)]
                assert (sum(map(np.array, parts)) == counts).all()
                assert gain == pytest.approx(sum(sum(c) - sum(n * n for n in c) / sum(c) for c in (counts.tolist(),)) - sum(sum(c) - sum(n * n for n in c) / sum(c) for c in parts), abs=1e-9)
                own[feature] += gain
        want += own / own.sum()
    assert model.featureImportances == pytest.approx(want / want.sum())


@pytest.fixture(scope="module")
def long_table(spark):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(30_000, 6))
    label = (x[:, 0] * x[:, 1] > 0).astype(int) + (draw.random(30_000) < 0.2)
    return spark.createDataFrame([(i, x[i].tolist(), int(label[i])) for i in range(30_000)], "id long, features array<double>, label int").repartition(4)


def test_extra_trees_of_many_nodes_end_in_time(long_table):
    began = time.monotonic()
    model = L.extra_trees(numTrees=250).fit(long_table)
    assert len(model.trees) == 250 and all(tree[0][4].sum() == 30_000 for tree in model.trees)
    assert time.monotonic() - began < 45


def test_random_forest_and_importances_of_many_nodes_end_in_time(long_table):
    began = time.monotonic()
    top = L.feature_importance(L.random_forest().fit(long_table), list("abcdef"), 2)
    assert {r["feature"] for r in top.collect()} == {"a", "b"}
    assert time.monotonic() - began < 45


def test_search_of_deep_forests_ends_in_time(long_table):
    began = time.monotonic()
    found = L.random_forest_search(long_table, "id", {"numTrees": (30,), "maxDepth": (None,)}, folds=3)
    assert len(found.bestModel.trees) == 30 and len(found.avgMetrics) == 1
    assert time.monotonic() - began < 45
