"""Fold sums, curves and rejected cells against direct computation."""

import json

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from statline.ml import curves, folds, models
from statline.sources import payload


def _table(spark, n=400, p=5, seed=0):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(3, 2, (n, p)) * np.array([1, 10, 0.1, 5, 1000])[:p]
    y = x @ rnd.normal(0, 1, p) / np.array([1, 10, 0.1, 5, 1000])[:p].mean() + rnd.normal(0, 1, n) + 50
    fold = rnd.integers(0, 4, n)
    names = [f"x{i}" for i in range(p)]
    rows = [(*map(float, r), float(t), int(f)) for r, t, f in zip(x, y, fold)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names) + ", y double, fold int"), names, x, y, fold


@pytest.mark.parametrize("alpha", [0.0, 3.0, 500.0])
def test_ridge_folds_equal_fits(spark, alpha):
    df, names, x, y, fold = _table(spark)
    sums = folds.fold_sums(df, names, "y")
    z, t = (x - x.mean(0)) / x.std(0), y
    for a, f, r2 in folds.ridge_scores(sums, (alpha,)):
        on, off = fold != f, fold == f
        zc, tc = z[on] - z[on].mean(0), t[on] - t[on].mean()
        w = np.linalg.solve(zc.T @ zc + alpha * np.eye(5), zc.T @ tc)
        pred = t[on].mean() + (z[off] - z[on].mean(0)) @ w
        assert r2 == pytest.approx(1 - ((t[off] - pred) ** 2).sum() / ((t[off] - t[off].mean()) ** 2).sum(), abs=1e-9)
    model = folds.refit(sums, alpha)
    w = np.linalg.solve((z - z.mean(0)).T @ (z - z.mean(0)) + alpha * np.eye(5), z.T @ (t - t.mean()))
    assert np.allclose(model.weights, w / x.std(0))
    got = np.array([r.prediction for r in model.predict(df).collect()])
    assert np.allclose(got, t.mean() + z @ w)


def test_best_strength_and_ties(spark):
    df, names, *_ = _table(spark, n=60)
    found = folds.ridge_search(spark, folds.fold_sums(df, names, "y"), (0.0, 5.0, 1e6, 0.0))
    by_alpha = {r.alpha: r.cv_mean for r in found.summary.collect()}
    assert found.best.alpha == max(by_alpha, key=lambda a: (by_alpha[a], -a)) and by_alpha[1e6] < by_alpha[5.0]
    assert found.scores.groupBy("fold").count().count() == 4


def test_fold_sums_of_odd_rows(spark):
    """Missing features count as 0, rows without a target as none, equal and constant columns share weights."""
    nan, inf = float("nan"), float("inf")
    rows = [(float(i), float(i), 7.0, 2.0 * i + 1, i % 3) for i in range(30)]
    rows += [(None, 1.0, 7.0, 1.0, 0), (nan, 0.0, 7.0, 1.0, 1), (inf, 2.0, 7.0, 1.0, 2), (5.0, 5.0, 7.0, None, 0), (5.0, 5.0, 7.0, nan, 0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double, fold int")
    sums = folds.fold_sums(df, ("a", "b", "c"), "y")
    assert sums.counts.sum() == 33
    clean = np.array([[0 if v is None or not np.isfinite(v) else v for v in r[:3]] for r in rows[:33]])
    y = np.array([r[3] for r in rows[:33]])
    model = folds.refit(sums, 0.0)
    design = np.c_[np.ones(33), clean]
    assert np.allclose(clean @ model.weights + model.intercept, design @ np.linalg.lstsq(design, y, rcond=None)[0])
    assert np.isnan(folds.ridge_scores(folds.fold_sums(df.withColumn("y", F.lit(1.0)), ("a",), "y"), (0.0,))[0][2])


def test_one_aggregation_serves_the_grid(spark):
    df, names, *_ = _table(spark, n=50)
    sums = folds.fold_sums(df, names, "y")
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("grid", "grid")
    folds.ridge_scores(sums, [10.0 ** i for i in range(-5, 6)])
    folds.refit(sums, 1.0)
    assert not jobs.getJobIdsForGroup("grid")
    spark.sparkContext.setJobGroup(None, None)


def _prepared(spark, n=300):
    df, names, *_ = _table(spark, n=n, seed=3)
    df = df.withColumn("player_id", F.monotonically_increasing_id()).withColumn("is_test", F.lit(False))
    prep = models.Prepared(df, names, "y", "regression", ("player_id",))
    prep.scaler = models.fit_standard_scaler(prep.train, names)
    return prep


def test_cross_validation_equals_the_fitting_one(spark):
    prep = _prepared(spark)
    mean, std = models.cross_validate(prep, "linear_regression")
    slow = models.grid_search(prep, "linear_regression").points[0]
    assert (mean, std) == (pytest.approx(slow[1], abs=1e-8), pytest.approx(slow[2], abs=1e-8))


def test_grid_reports_every_point_and_refits_the_best(spark):
    prep = _prepared(spark)
    found = models.grid_search(prep, "linear_regression", {"regParam": [100.0, 0.0], "elasticNetParam": [0.0]})
    assert [p["regParam"] for p, _, _ in found.points] == [100.0, 0.0]
    assert found.best_params["regParam"] == 0.0 and found.points[1][1] > found.points[0][1]
    scaled = VectorAssembler(inputCols=prep.features, outputCol="v").transform(prep.data)
    plain = LinearRegression(featuresCol="v", labelCol="y").fit(scaled)
    got = models.predict(found.best_model, prep.data).select("prediction").collect()
    want = plain.transform(scaled).select("prediction").collect()
    assert np.allclose([r[0] for r in got], [r[0] for r in want], atol=1e-6)


# ------------------------------------------------------------------ curves

def _brute_curve(rows):
    rows = [(s, bool(l)) for s, l in rows if s is not None and s == s and l is not None]
    p, n = sum(l for _, l in rows), sum(not l for _, l in rows)
    out = []
    for t in sorted({s for s, _ in rows}, reverse=True):
        tp, fp = sum(l for s, l in rows if s >= t), sum(not l for s, l in rows if s >= t)
        out.append((t, tp, fp, tp / (tp + fp), tp / p if p else None))
    pairs = [(a > b) + (a == b) / 2 for a, la in rows if la for b, lb in rows if not lb]
    ap, before = 0.0, 0.0
    for _, _, _, precision, recall in out:
        ap, before = ap + precision * ((recall or 0) - before), recall or 0
    return out, (p, n, ap if p else None, sum(pairs) / (p * n) if p * n else None)


@pytest.mark.parametrize("parts", [1, 4])
def test_curves_equal_brute_force(spark, parts):
    rnd = np.random.default_rng(1)
    groups = {"hot": [(float(rnd.integers(0, 12)) / 4, int(rnd.random() < 0.4)) for _ in range(300)],
              "odd": [(0.0, 1), (-0.0, 0), (None, 1), (float("nan"), 1), (float("inf"), 0), (float("-inf"), 1), (1.0, None)],
              "no positive": [(1.0, 0), (2.0, 0)], None: [(1.0, 1)]}
    df = spark.createDataFrame([(g, s, l) for g, rows in groups.items() for s, l in rows], "g string, s double, l int").repartition(3)
    curve = curves.pr_curve(df, "s", "l", ("g",), parts).collect()
    summary = {r.g: tuple(r)[1:] for r in curves.curve_summary(df, "s", "l", ("g",), parts).collect()}
    for g, rows in groups.items():
        want, total = _brute_curve(rows)
        got = sorted(((r.threshold, r.tp, r.fp, r.precision, r.recall) for r in curve if r.g == g), reverse=True)
        assert [x[:3] for x in got] == [x[:3] for x in want]
        assert np.allclose([x[3] for x in got], [x[3] for x in want])
        assert [x[4] for x in got] == pytest.approx([x[4] for x in want])
        assert summary[g] == pytest.approx(total)
    assert curves.pr_curve(df.limit(0), "s", "l").collect() == []


# ------------------------------------------------------------------ payloads

def _landed(spark, tmp_path, docs):
    path = tmp_path / "landed.json"
    path.write_text("\n".join(d if isinstance(d, str) else json.dumps(d) for d in docs))
    return payload.read_payloads(spark, str(path), corrupt=True)


def _document(rows, headers=None):
    return {"parameters": {"Season": "2023-24", "SeasonType": "x", "PlayerID": "9007199254740993"},
            "resultSets": [{"name": "n", "headers": headers, "rowSet": rows}]}


def test_bad_cells_cost_themselves(spark, tmp_path):
    def player(pid, active="1", team="5"):
        return [pid, active, "A B", None, None, None, None, team, "T"]

    raw = _landed(spark, tmp_path, [_document([player("9007199254740993"), player("12.0"), player("1e30"), player("12.5"), player("x"),
                                               player(""), player("7", "3000000000", "99999999999999999999")]), "{not json", "[]"])
    rows = payload.decode_players(raw).collect()
    assert [(r.player_id, r.is_active, r.team_id) for r in rows] == [
        (9007199254740993, 1, 5), (12, 1, 5), (None, 1, 5), (None, 1, 5), (None, 1, 5), (None, 1, 5), (7, None, None)]
    bad = sorted((r.row_number, r.column_name, r.cell, r.reason) for r in payload.rejected_cells(raw, payload.PLAYER_LAYOUT).where("row_number IS NOT NULL").collect())
    assert bad == [(2, "player_id", "1e30", "out of range"), (3, "player_id", "12.5", "not whole"), (4, "player_id", "x", "not a number"),
                   (6, "is_active", "3000000000", "out of range"), (6, "team_id", "99999999999999999999", "out of range")]
    lines = [r.cell for r in payload.rejected_cells(raw, payload.PLAYER_LAYOUT).where("row_number IS NULL").collect()]
    assert "{not json" in lines


def test_dates_and_ids_of_game_logs(spark, tmp_path):
    def game(date, pts):
        row = [None] * 25
        row[2], row[23] = date, pts
        return row

    raw = _landed(spark, tmp_path, [_document([game("2024-01-05", "10"), game("APR 09, 2023", "1e2"), game("not a date", "NaN"), game(None, "ten")])])
    rows = payload.decode_game_logs(raw).collect()
    assert [(r.player_id, str(r.game_date), r.pts) for r in rows] == [
        (9007199254740993, "2024-01-05", 10.0), (9007199254740993, "2023-04-09", 100.0), (9007199254740993, "None", None), (9007199254740993, "None", None)]
    bad = {(r.row_number, r.column_name, r.reason) for r in payload.rejected_cells(raw, payload.GAME_LOG_LAYOUT).collect()}
    assert bad == {(2, "game_date", "not a date"), (2, "pts", "not a number"), (3, "pts", "not a number")}


def test_headers_give_positions(spark, tmp_path):
    raw = _landed(spark, tmp_path, [_document([["T1", "4", "77"]], headers=["TEAM_NAME", "GP", "PLAYER_ID"]),
                                    _document([["78", "N", "5", "T2", "30", "6"]])])
    rows = sorted((r.player_id, r.team_name, r.gp) for r in payload.decode_advanced(raw).collect())
    assert rows == [(77, "T1", 4), (78, "T2", 6)]
