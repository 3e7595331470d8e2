"""Forests grown in tasks: the trees of a bootstrap, whatever nodes are split by passes or in tasks."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from statline.ml import forest, models


def _prepared(spark, task, n=1500):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(n, 4)).round(1)
    y = np.sin(x[:, 0] * 2) + x[:, 1] * x[:, 2] + 0.05 * rng.normal(size=n)
    rows = [(i, *map(float, r), float(y[i]), "abc"[int(np.digitize(y[i], [-0.5, 0.5]))], i % 5, i % 4 == 0) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "player_id long, f0 double, f1 double, f2 double, f3 double, y double, label_c string, "
                                     "fold int, is_test boolean").repartition(3).cache()
    names = ["f0", "f1", "f2", "f3"]
    prep = models.Prepared(df, names, "y" if task == "regression" else "label_c", task, ("player_id",))
    prep.scaler = models.fit_standard_scaler(prep.train, names)
    return prep


def _impurity(y, w, classes):
    if classes:
        p = np.bincount(y, w, classes) / w.sum()
        return 1 - (p * p).sum()
    return np.average((y - np.average(y, weights=w)) ** 2, weights=w)


def _plain(bins, y, w, row, shape, tree, heap, depth):
    """The value that plain recursion gives ``row``."""
    classes = shape.classes
    leaf = np.bincount(y, w, classes) / w.sum() if classes else np.array([np.average(y, weights=w)])
    if depth == shape.max_depth or len(set(y.tolist())) == 1:
        return leaf
    chosen = forest.subsets(np.array([heap]), shape, tree)
    best = (1e-12, None)
    for f in (range(shape.features) if chosen is None else chosen[0]):
        for cut in range(forest.BINS):
            left = bins[:, f] <= cut
            if left.all() or not left.any():
                continue
            gain = w.sum() * _impurity(y, w, classes) - sum(w[s].sum() * _impurity(y[s], w[s], classes) for s in (left, ~left))
            if gain > best[0] * (1 + 1e-9):
                best = (gain, (f, cut, left))
    if best[1] is None:
        return leaf
    f, cut, left = best[1]
    side = left if row[f] <= cut else ~left
    return _plain(bins[side], y[side], w[side], row, shape, tree, 2 * heap + (row[f] > cut), depth + 1)


@pytest.mark.parametrize("classes", [0, 3])
def test_a_subtree_is_what_plain_recursion_grows(classes):
    rng = np.random.default_rng(3)
    bins = rng.integers(0, 32, size=(250, 4)).astype(np.uint8)
    y = rng.integers(0, classes, 250) if classes else rng.normal(size=250)
    w = rng.integers(1, 4, 250).astype(np.uint8)
    shape = forest.Shape(4, 2 if classes else 4, classes, 1, 30 if classes else 7, 42)
    data, _ = forest.grow(bins, y, w, shape, 0, 1)
    got = forest.subtree_values(data, bins[:60], classes)
    want = [_plain(bins, y, w.astype(float), row, shape, 0, 1, 0) for row in bins[:60]]
    # equally good splits of a few rows may differ; most rows meet none
    assert np.isclose(got, want, atol=1e-6).all(axis=1).mean() > (0.7 if classes else 0.95)


@pytest.mark.parametrize("places", [2, 3, 6, 8, 24, 32])
def test_splits_from_a_few_rows_are_those_from_sums_by_bin(places):
    rng = np.random.default_rng(places)
    nodes = 300
    size = rng.integers(1, places + 1, nodes)
    bins = rng.integers(0, rng.choice([2, 5, 32], (nodes, 4)), size=(places, nodes, 4)).astype(np.uint8)
    w = rng.integers(1, 4, (places, nodes)) * (np.arange(places)[:, None] < size)
    y = rng.integers(-9, 10, (places, nodes)).astype(float)  # sums without rounding: ties go the same way
    node = np.tile(np.arange(nodes), places)
    slot, at, want, _, _ = forest.best_splits(forest.sums(bins.reshape(-1, 4), node, nodes, None, w.ravel(), y.ravel(), 0), 0)
    feature, cut, gain = forest.few_splits(bins, w.astype(float), y, size)
    some = want > 1e-9
    assert np.allclose(gain[some], want[some]) and (gain[~some] < 1e-9).all() and some.sum() > 60
    assert (feature[some] == slot[some]).mean() > 0.98 and (cut[some] == at[some]).mean() > 0.98


def test_nodes_of_a_few_rows_are_not_summed_by_bin(monkeypatch):
    rng = np.random.default_rng(5)
    bins, y = rng.integers(0, 32, size=(4000, 6)).astype(np.uint8), rng.normal(size=4000)
    y += bins @ rng.normal(size=6)
    summed, plain = [], forest.best_splits
    monkeypatch.setattr(forest, "best_splits", lambda stats, classes: summed.append(len(stats)) or plain(stats, classes))
    data, _ = forest.grow(bins, y, np.ones(4000, np.uint8), forest.Shape(6, 6, 0, 1, 30, 42), 0, 1)
    assert np.frombuffer(data, "<i8", 1)[0] > 7000 and sum(summed) < 700
    assert np.allclose(forest.subtree_values(data, bins, 0)[:, 0], y)


@pytest.mark.parametrize("task", ["regression", "classification"])
def test_large_nodes_split_by_passes_give_the_same_forest(spark, task):
    prep = _prepared(spark, task)
    _, inputs, rows, classes = models._forest_problem(prep)
    whole = forest.fit(rows, inputs, classes, num_trees=4)
    cut = forest.fit(rows.repartition(5), inputs, classes, num_trees=4, limit=100)
    assert all(len(t.heap) == 1 for t in whole.tops.values()) and all(len(t.heap) > 10 for t in cut.tops.values())
    scored = rows.withColumn("__id", F.col("hash"))
    a, b = [m.transform(scored).orderBy("__id").collect() for m in (whole, cut)]
    assert len(a) == len(b) == rows.count()
    same = np.isclose([r.prediction for r in a], [r.prediction for r in b], atol=1e-9)
    assert same.mean() > 0.97  # sums in another order may break a tie the other way
    assert np.allclose(whole.importances, cut.importances, atol=0.01) and abs(sum(cut.importances) - 1) < 1e-9


@pytest.mark.parametrize("task", ["regression", "classification"])
def test_forest_is_as_good_as_spark_mls_and_survives_saving(spark, tmp_path, task):
    prep = _prepared(spark, task)
    model = models.fit(prep, "random_forest", num_trees=30)
    assert isinstance(model, PipelineModel) and not hasattr(model.stages[-1], "_java_obj")  # nodes are not on the driver
    slow = models.build_pipeline(prep, "random_forest", num_trees=30).fit(prep.train)
    name = "r2" if task == "regression" else "accuracy"
    got, want = [{r.metric: r.value for r in models.evaluate_model(m, prep).collect()}[name] for m in (model, slow)]
    assert got > want - 0.03
    mine, theirs = [np.array([v for _, v in models.feature_importance(m, prep)]) for m in (model, slow)]
    assert np.allclose(mine, theirs, atol=0.06)
    models.save_model(model, str(tmp_path / "m"))
    loaded = models.load_model(str(tmp_path / "m"))
    a, b = [models.predict(m, prep.test).orderBy("player_id").collect() for m in (model, loaded)]
    assert a == b and len(a) == prep.test.count()


def test_folds_grown_together_score_rows_that_their_trees_did_not_see(spark):
    prep = _prepared(spark, "regression")
    mean, std = models.cross_validate(prep, "random_forest", num_trees=10)
    one = [models.Prepared(prep.data.where("NOT is_test").withColumn("is_test", F.col("fold") == k), prep.features, "y",
                           "regression", ("player_id",), prep.scaler) for k in range(2)]
    r2 = [{r.metric: r.value for r in models.evaluate_model(models.fit(p, "random_forest", num_trees=10), p).collect()}["r2"]
          for p in one]
    assert abs(mean - np.mean(r2)) < 0.05 and std < 0.05


def test_tiny_and_constant_tables(spark):
    rows = spark.range(3).selectExpr("1D AS a_z", "CAST(id AS DOUBLE) AS b_z", "5D AS label", "0 AS fold", "xxhash64(id) AS hash")
    model = forest.fit(rows, ["a_z", "b_z"], num_trees=20)
    assert [r.prediction for r in model.transform(rows).collect()] == [5.0] * 3
    assert model.transform(rows.limit(0)).count() == 0


def test_rows_that_several_folds_grow_on_are_shipped_once(spark):
    rng = np.random.default_rng(11)
    n, shape = 3000, forest.Shape(4, 2, 3, 2, 30, 42, folds=5)
    bins = rng.integers(0, 32, size=(n, 4)).astype(np.uint8)
    part = bins, rng.integers(0, 3, n), rng.integers(0, 5, n), rng.integers(-2 ** 62, 2 ** 62, n)
    trees = shape.groups(True)[1]
    assert trees == [1, 3, 5, 7, 9] and len(shape.groups(True)) == 2
    tops = {t: forest.Top() for t in shape.all_trees}
    for t in trees:
        tops[t].split(0, 1, 15 if t < 9 else 14)  # one fold's tree splits elsewhere
    drawn, seen = np.zeros((5, n), int), 0
    for heap, rows, w in forest._shipped(part, shape, trees, tops, {}):
        assert len(set(rows.tolist())) == len(rows) and heap in (2, 3)
        seen += len(rows)
        drawn[:, rows] += w
    for f, t in enumerate(trees):
        assert (drawn[f] == np.where(part[2] == f, 0, forest.weights(part[3], shape, t))).all()
    assert seen < 0.68 * n  # of 5 trees, which take 4 x 0.63 x n rows


def test_folds_with_the_same_splits_are_summed_together():
    rng = np.random.default_rng(12)
    n, shape = 2000, forest.Shape(4, 2, 3, 2, 30, 42, folds=3)
    part = rng.integers(0, 32, size=(n, 4)).astype(np.uint8), rng.integers(0, 3, n), rng.integers(0, 3, n), rng.integers(-2 ** 62, 2 ** 62, n)
    top = forest.Top()
    top.split(0, 2, 20)
    together = list(forest._sums_of_alike(part, shape, [0, 2, 4], top, [[1, 2], [2], [1]]))
    alone = [next(forest._sums_of_alike(part, shape, [t], top, [nodes])) for t, nodes in ((0, [1, 2]), (2, [2]), (4, [1]))]
    assert all((a == b).all() and a.sum() > 0 for a, b in zip(together, alone))


@pytest.mark.parametrize("task", ["regression", "classification"])
def test_whole_trees_score_as_their_subtrees_do(spark, task, monkeypatch):
    prep = _prepared(spark, task)
    _, inputs, rows, classes = models._forest_problem(prep)
    model = forest.fit(rows, inputs, classes, num_trees=8, limit=300)
    size = model.trees.agg(F.sum("size"), F.sum(F.length("data"))).first()
    assert size[0] == size[1]
    got = []
    for most in (size[0] // 3, 1):  # sets of whole trees, single subtrees
        monkeypatch.setattr(forest, "TREE_BYTES", most)
        got.append(model.transform(prep.train.join(rows.withColumn("player_id", F.col("hash")).select("hash"), F.xxhash64("player_id") == F.col("hash"))
                                   .withColumns({f"{c}_z": (F.col(c) - m) / s for c, (m, s) in prep.scaler.items()}))
                   .orderBy("player_id").select("prediction").collect())
    assert len(got[0]) == prep.train.count() and np.allclose(got[0], got[1])


def test_a_larger_child_is_not_summed_again(monkeypatch):
    rng = np.random.default_rng(13)
    bins, y = rng.integers(0, 32, size=(20000, 6)).astype(np.uint8), rng.normal(size=20000)
    y += (bins ** 2.0) @ rng.normal(size=6)
    summed, plain = [], forest.sums
    monkeypatch.setattr(forest, "sums", lambda bins, *rest: summed.append(len(bins)) or plain(bins, *rest))
    data, _ = forest.grow(bins, y, np.ones(20000, np.uint8), forest.Shape(6, 6, 0, 1, 30, 42), 0, 1)
    assert np.allclose(forest.subtree_values(data, bins, 0)[:, 0], y)
    assert sum(summed) < 5 * 20000  # more than 9 levels of nodes of over 32 rows
