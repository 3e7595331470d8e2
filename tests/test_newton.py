"""Newton's fits reach the minimum that Spark ML's optimisers approach, in few passes."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from statline.ml import models, newton


def _table(spark, n=400):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 3))
    y = x @ [1.0, -2.0, 0.0] + 0.5 + rng.standard_t(2, size=n)
    top = (x + rng.normal(size=(n, 3))).argmax(axis=1)
    rows = [(i, *map(float, r), float(x[i, 0]), float(y[i]), "abc"[top[i]], i % 5) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "player_id long, f0 double, f1 double, f2 double, twin double, y double, label_c string, fold int")
    return df.withColumn("is_test", F.lit(False)).repartition(3).cache()


def _prepared(spark, task):
    df = _table(spark)
    names = ["f0", "f1", "f2", "twin"]  # twin repeats f0
    prep = models.Prepared(df, names, "y" if task == "regression" else "label_c", task, ("player_id",))
    prep.scaler = models.fit_standard_scaler(prep.train, names)
    return prep


@pytest.mark.parametrize("task, model", [("regression", "kernel_svr"), ("classification", "logistic_regression"),
                                         ("classification", "kernel_svc")])
def test_fits_agree_with_spark_ml(spark, task, model):
    prep = _prepared(spark, task)
    got = models.predict(models.fit(prep, model, rff_components=8), prep.data).orderBy("player_id")
    slow = models.build_pipeline(prep, model, rff_components=8)
    slow.getStages()[-1].setTol(1e-12)
    want = models.predict(slow.fit(prep.train), prep.data).orderBy("player_id")
    a, b = got.collect(), want.collect()
    assert np.allclose([r.prediction for r in a], [r.prediction for r in b], atol=1e-4)
    if task == "classification":
        assert np.allclose([list(r.probability) for r in a], [r.probability.toArray() for r in b], atol=1e-4)
        assert [r.predicted_label for r in a] == [r.predicted_label for r in b]


@pytest.mark.parametrize("task, model", [("regression", "kernel_svr"), ("classification", "logistic_regression")])
def test_folds_fitted_together_score_as_one_by_one(spark, task, model):
    prep = _prepared(spark, task)
    mean, std = models.cross_validate(prep, model, rff_components=8)
    slow = models.grid_search(prep, model, rff_components=8).points[0]
    assert (mean, std) == (pytest.approx(slow[1], abs=3e-3), pytest.approx(slow[2], abs=3e-3))


def test_passes_are_few_and_need_no_convergence_of_hundreds(spark):
    """The optimisers of Spark ML ran a job or more an iteration, up to 1000."""
    prep = _prepared(spark, "classification")
    sc = spark.sparkContext
    sc.setJobGroup("newton", "newton")
    models.cross_validate(prep, "logistic_regression")
    jobs = sc.statusTracker().getJobIdsForGroup("newton")
    sc.setJobGroup(None, None)
    assert len(jobs) <= 60


def test_saved_model_scores_as_the_fitted_one(spark, tmp_path):
    prep = _prepared(spark, "classification")
    m = models.fit(prep, "kernel_svc", rff_components=8)
    models.save_model(m, str(tmp_path / "m"))
    loaded = models.load_model(str(tmp_path / "m"))
    cols = ("player_id", "prediction", "predicted_label")
    assert sorted(models.predict(m, prep.data).select(*cols).collect()) == sorted(models.predict(loaded, prep.data).select(*cols).collect())


def test_one_class_and_a_fold_without_a_class(spark):
    prep = _prepared(spark, "classification")
    prep.data = prep.data.withColumn("label_c", F.lit("a"))
    assert {r[0] for r in models.predict(models.fit(prep, "logistic_regression"), prep.data).select("predicted_label").collect()} == {"a"}
    prep = _prepared(spark, "classification")
    prep.data = prep.data.withColumn("label_c", F.when(F.col("fold") == 0, "a").otherwise(F.col("label_c")))
    prep.data = prep.data.withColumn("label_c", F.when(F.col("player_id") == 0, "z").otherwise(F.col("label_c")))
    mean, std = models.cross_validate(prep, "logistic_regression")
    assert 0 < mean < 1 and std >= 0


def test_sums_are_the_derivatives(spark):
    rng = np.random.default_rng(1)
    x, t = np.hstack([rng.normal(size=(50, 2)), np.ones((50, 1))]), 1e-5
    for loss, y, theta in ((newton.Logistic(3, 4, 0.1), rng.integers(0, 4, 50).astype(float), rng.normal(size=9)),
                           (newton.Huber(3, 0.1), rng.normal(size=50) * 3, np.array([0.3, -0.2, 0.1, 1.2]))):
        _, grad, hess = loss.objective(loss.sums(x, y, theta), theta)
        for i in range(len(theta)):
            up, down = theta.copy(), theta.copy()
            up[i] += t
            down[i] -= t
            a, b = (loss.objective(loss.sums(x, y, v), v) for v in (up, down))
            assert (a[0] - b[0]) / (2 * t) == pytest.approx(grad[i], abs=1e-6)
            assert np.allclose((a[1] - b[1]) / (2 * t), hess[i], atol=1e-4)
