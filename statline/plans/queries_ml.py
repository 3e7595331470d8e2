"""Registered queries: selection, splits and evaluation with exact oracles (L1–L7,
L14–L18), and fitted models checked on rows (L8–L13, L19–L25, K9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import metrics as M, rules
from ..ml import evaluate, models, selection, split
from ..operators import classify, features
from ..session import saved, scratch_path
from ..sources.landed import files_state
from .rule_sql import position_case
from .catalog import fx, quantile_sql, register, with_fixtures
from .queries_features import STATLINE_COLS
from .queries_summary import DASH_SQL, LABELLED_SQL, dash, labelled, numeric

# Numeric candidate columns of the dashboard frame, in column order.
ENGINEERED = (features.BASIC + features.ADVANCED + ("position_score",) + features.HISTORY
              + features.INTERACTIONS)
DASH_NUMERIC = tuple(c for c in STATLINE_COLS if c != "season") + ("ts_pct", "composite_score") \
    + ENGINEERED
KEY = ("player_id", "season")


def _zero(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    return f"CASE WHEN {x} IS NULL OR isnan({x}) OR abs({x}) = 'inf'::DOUBLE THEN 0E0 ELSE {x} END"


# ----------------------------------------------------------------- L1–L3

REG_TARGET = "pts"
REG_FEATS = tuple(c for c in DASH_NUMERIC if c not in ("player_id", REG_TARGET))
CLS_TARGET = "position"
CLS_FEATS = tuple(c for c in DASH_NUMERIC if c != "player_id")


def _freg_sql() -> str:
    cols = ", ".join(f"corr({_zero(c)}, CAST({REG_TARGET} AS DOUBLE)) AS r{i}"
                     for i, c in enumerate(REG_FEATS))
    rows = " UNION ALL ".join(
        f"SELECT {i} AS feature_index, '{c}' AS feature, "
        f"(r{i} * r{i}) / nullif(1E0 - r{i} * r{i}, 0) * (n - 2) AS f_score FROM w"
        for i, c in enumerate(REG_FEATS))
    return f", w AS (SELECT count(*) AS n, {cols} FROM dash)\n{rows}"


def _fclassif_sql() -> str:
    sums = ", ".join(f"sum({_zero(c)}) AS s{i}, sum({_zero(c)} * {_zero(c)}) AS q{i}"
                     for i, c in enumerate(CLS_FEATS))
    tots = ", ".join(f"sum(s{i}) AS ts{i}, sum(q{i}) AS tq{i}, sum(s{i} * s{i} / nc) AS b{i}"
                     for i in range(len(CLS_FEATS)))
    rows = " UNION ALL ".join(
        f"SELECT {i} AS feature_index, '{c}' AS feature, "
        f"((b{i} - ts{i} * ts{i} / n) / (k - 1)) / nullif((tq{i} - b{i}) / (n - k), 0) AS f_score FROM t"
        for i, c in enumerate(CLS_FEATS))
    return (f", pc AS (SELECT {CLS_TARGET}, count(*) AS nc, {sums} FROM dash GROUP BY {CLS_TARGET}),\n"
            f"t AS (SELECT sum(nc) AS n, count(*) AS k, {tots} FROM pc)\n{rows}")


def _scores(spark, d, task):
    if task == "regression":
        return selection.f_regression_scores(numeric(spark, d), REG_FEATS, REG_TARGET)
    return selection.f_classif_scores(dash(spark, d), CLS_FEATS, CLS_TARGET)


register("f_regression", with_fixtures("WITH " + DASH_SQL + _freg_sql(), "statlines"))(
    lambda spark, d: _scores(spark, d, "regression"))

register("f_classif", with_fixtures("WITH " + DASH_SQL + _fclassif_sql(), "statlines"))(
    lambda spark, d: _scores(spark, d, "classification"))


def _rank_sql(score_sql: str, k: int = 20) -> str:
    return (f"WITH {DASH_SQL}{score_sql.replace(chr(10) + 'SELECT', chr(10) + ', sc AS (SELECT', 1)})\n"
            f"SELECT *, f_rank <= {k} AND f_score IS NOT NULL AND NOT isnan(f_score) AS selected FROM (\n"
            f"SELECT *, row_number() OVER (ORDER BY (f_score IS NULL OR isnan(f_score)), f_score DESC, "
            f"feature_index) AS f_rank FROM sc)")


register("selected_features", with_fixtures(_rank_sql(_freg_sql()), "statlines"))(
    lambda spark, d: selection.rank_features(_scores(spark, d, "regression"), 20))

# ----------------------------------------------------------------- L4–L7, L14

HASH_SQL = "substr(md5(concat_ws('|', '42', CAST(player_id AS VARCHAR), season)), 1, 8)"

register("holdout_split", with_fixtures(
    f"SELECT player_id, season, {HASH_SQL} < '33333333' AS is_test FROM statlines", "statlines"))(
    lambda spark, d: split.holdout_split(fx(spark, d).statlines.select(*KEY), KEY))

register("stratified_split", with_fixtures(f"""WITH {LABELLED_SQL}
SELECT player_id, season, position,
  row_number() OVER (PARTITION BY position ORDER BY {HASH_SQL}, player_id, season)
    <= round(count(*) OVER (PARTITION BY position) * 0.2E0) AS is_test
FROM labelled""", "statlines"))(
    lambda spark, d: split.stratified_split(labelled(spark, d).select(*KEY, "position"),
                                            "position", KEY))

FOLD_SQL = (f"CAST({HASH_SQL} >= '33333333' AS INTEGER) + CAST({HASH_SQL} >= '66666666' AS INTEGER)"
            f" + CAST({HASH_SQL} >= '99999999' AS INTEGER) + CAST({HASH_SQL} >= 'cccccccc' AS INTEGER)")

register("cv_folds", with_fixtures(
    f"SELECT player_id, season, {FOLD_SQL} AS fold FROM statlines", "statlines"))(
    lambda spark, d: split.kfold_column(fx(spark, d).statlines.select(*KEY), KEY))

register("stratified_folds", with_fixtures(f"""WITH {LABELLED_SQL}
SELECT player_id, season, position,
  CAST((row_number() OVER (PARTITION BY position ORDER BY {HASH_SQL}, player_id, season) - 1) % 5 AS INTEGER) AS fold
FROM labelled""", "statlines"))(
    lambda spark, d: split.stratified_fold_column(labelled(spark, d).select(*KEY, "position"),
                                                  "position", KEY))

SCALE_COLS = ("pts", "reb", "ast", "min")


def _scaled(spark, d):
    df = split.holdout_split(fx(spark, d).statlines.select(*KEY, *SCALE_COLS), KEY)
    train, test = df.where(~F.col("is_test")), df.where(F.col("is_test"))
    tr, te = split.scale(train, test, SCALE_COLS)
    return tr.unionByName(te).select(*KEY, "is_test", *[f"{c}_z" for c in SCALE_COLS])


register("scaled_features", with_fixtures(f"""WITH s AS (
  SELECT player_id, season, {', '.join(SCALE_COLS)}, {HASH_SQL} < '33333333' AS is_test FROM statlines),
st AS (SELECT {', '.join(f"avg({c}) AS m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1E0) AS s_{c}" for c in SCALE_COLS)}
       FROM s WHERE NOT is_test)
SELECT player_id, season, is_test, {', '.join(f"({c} - m_{c}) / s_{c} AS {c}_z" for c in SCALE_COLS)}
FROM s CROSS JOIN st""", "statlines"))(_scaled)


def _encoded(spark, d):
    out, _ = split.encode_labels(labelled(spark, d).select(*KEY, "position"), "position")
    return out.withColumn("label_index", F.col("label_index").cast("bigint"))


register("encoded_labels", with_fixtures(f"""WITH {LABELLED_SQL}
SELECT player_id, season, position, CAST(dense_rank() OVER (ORDER BY position) - 1 AS BIGINT) AS label_index
FROM labelled""", "statlines"))(_encoded)

# ----------------------------------------------------------------- L8 (one feature, exact)


def _ols_one(spark, d):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    s = fx(spark, d).statlines
    v = VectorAssembler(inputCols=["fga"], outputCol="features").transform(s)
    m = LinearRegression(featuresCol="features", labelCol="pts", solver="normal", regParam=0.0,
                         standardization=False).fit(v)
    return spark.range(1).select(F.lit(float(m.coefficients[0])).alias("slope"),
                                 F.lit(float(m.intercept)).alias("intercept"))


register("linear_one_feature", with_fixtures(
    "SELECT regr_slope(pts, fga) AS slope, regr_intercept(pts, fga) AS intercept FROM statlines",
    "statlines"))(_ols_one)

# ----------------------------------------------------------------- L15–L18 (rule predictions)

POS3_MAP = {"Point Guard": "Guard", "Shooting Guard": "Guard", "Small Forward": "Forward",
            "Power Forward": "Forward", "Center": "Center"}


def rule_predictions(spark, d):
    """Truth = C4 quantile positions; prediction = the C1 rule folded to three positions."""
    s = classify.position_by_quantile3(fx(spark, d).statlines.select(*KEY, "pts", "reb", "ast"),
                                       out="truth")
    c1 = rules.primary_position(pts="pts", reb="reb", ast="ast")
    mapped = F.coalesce(F.create_map(*[F.lit(x) for kv in POS3_MAP.items() for x in kv])[c1],
                        F.lit("Utility"))
    return s.withColumn("prediction", mapped)


RULE_PRED_SQL = f"""WITH q AS (SELECT {quantile_sql('statlines', 'ast', 0.7)} AS aq, {quantile_sql('statlines', 'reb', 0.7)} AS rq),
rp AS (SELECT player_id, season,
  CASE WHEN ast > aq THEN 'Guard' WHEN reb > rq THEN 'Forward' ELSE 'Center' END AS truth,
  CASE WHEN pos IN ('Point Guard', 'Shooting Guard') THEN 'Guard' WHEN pos IN ('Small Forward', 'Power Forward') THEN 'Forward'
       WHEN pos = 'Center' THEN 'Center' ELSE 'Utility' END AS prediction
  FROM (SELECT *, {position_case({'pts': 'pts', 'reb': 'reb', 'ast': 'ast'})} AS pos FROM statlines) CROSS JOIN q),
pairs AS (SELECT truth, prediction AS pred, count(*) AS n FROM rp GROUP BY 1, 2),
tr AS (SELECT truth AS class, sum(n) AS support, sum(CASE WHEN truth = pred THEN n ELSE 0 END) AS tp FROM pairs GROUP BY 1),
pr AS (SELECT pred AS class, sum(n) AS predicted FROM pairs GROUP BY 1),
cc AS (SELECT coalesce(tr.class, pr.class) AS class, CAST(coalesce(support, 0) AS BIGINT) AS support,
         CAST(coalesce(tp, 0) AS BIGINT) AS tp, CAST(coalesce(predicted, 0) AS BIGINT) AS predicted
       FROM tr FULL JOIN pr ON tr.class = pr.class),
prf0 AS (SELECT *, coalesce(tp / nullif(predicted, 0), 0E0) AS precision,
           coalesce(tp / nullif(support, 0), 0E0) AS recall FROM cc),
prf AS (SELECT *, coalesce(precision * recall * 2 / nullif(precision + recall, 0), 0E0) AS f1 FROM prf0)"""


def _rule_pred(spark, d):
    return rule_predictions(spark, d)


register("confusion", with_fixtures(RULE_PRED_SQL + """,
cls AS (SELECT DISTINCT class FROM cc)
SELECT a.class AS label, b.class AS prediction, CAST(coalesce(p.n, 0) AS BIGINT) AS count
FROM cls a CROSS JOIN cls b LEFT JOIN pairs p ON p.truth = a.class AND p.pred = b.class""",
    "statlines"))(lambda spark, d: evaluate.confusion_matrix(_rule_pred(spark, d), "truth",
                                                             "prediction"))

register("class_report", with_fixtures(RULE_PRED_SQL + """
SELECT class, precision, recall, f1, support FROM prf
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM prf
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM prf""", "statlines"))(
    lambda spark, d: evaluate.classification_report(_rule_pred(spark, d), "truth", "prediction"))

register("class_metrics", with_fixtures(RULE_PRED_SQL + """
SELECT sum(tp) / sum(support) AS accuracy, sum(precision * support) / sum(support) AS precision,
  sum(recall * support) / sum(support) AS recall, sum(f1 * support) / sum(support) AS f1 FROM prf""",
    "statlines"))(
    lambda spark, d: evaluate.eval_classification(_rule_pred(spark, d), "truth", "prediction"))

register("regression_metrics", with_fixtures("""
WITH p AS (SELECT pts AS label, fgm * 2 + fg3m + ftm AS prediction FROM statlines)
SELECT avg((prediction - label) * (prediction - label)) AS mse,
  sqrt(avg((prediction - label) * (prediction - label))) AS rmse, avg(abs(prediction - label)) AS mae,
  1E0 - sum((prediction - label) * (prediction - label)) / nullif(var_pop(label) * count(*), 0) AS r2
FROM p""", "statlines"))(
    lambda spark, d: evaluate.eval_regression(fx(spark, d).statlines.select(
        F.col("pts").alias("label"),
        (F.col("fgm") * 2 + F.col("fg3m") + F.col("ftm")).alias("prediction"))))

# ----------------------------------------------------------------- fitted models (rows)


#: Prepared inputs and folders of fitted pipelines by session, folder and state of its files, task and model: queries that
#: need the same full-size model share one fit, and rewritten tables get a new one.
_PREPARED: dict[tuple, models.Prepared] = {}
_FITTED: dict[tuple, str] = {}


def _tables(spark, d):
    return spark.sparkContext.applicationId, d, files_state(spark, d)


def _prep(spark, d, task):
    at = (*_tables(spark, d), task)
    if at not in _PREPARED:
        if task == "regression":
            _PREPARED[at] = models.prepare(numeric(spark, d), REG_TARGET, "regression", engineer=False)
        else:
            _PREPARED[at] = models.prepare(dash(spark, d), CLS_TARGET, "classification", engineer=False)
    return _PREPARED[at]


def _fit(spark, d, task, model):
    """The input and the fitted pipeline, loaded from where its first use saved it."""
    prep, at = _prep(spark, d, task), (*_tables(spark, d), task, model)
    if at not in _FITTED:
        path = scratch_path(spark, "model")
        models.save_model(models.fit(prep, model), path)
        _FITTED[at] = path
    return prep, models.load_model(_FITTED[at])


def _fit_query(task: str, model: str):
    def run(spark, d):
        prep, m = _fit(spark, d, task, model)
        return models.evaluate_model(m, prep).withColumn("model", F.lit(model))
    return run


for _name, _task, _model in (("fit_linear", "regression", "linear_regression"),
                             ("fit_rf_regressor", "regression", "random_forest"),
                             ("fit_kernel_regressor", "regression", "kernel_svr"),
                             ("fit_logistic", "classification", "logistic_regression"),
                             ("fit_rf_classifier", "classification", "random_forest"),
                             ("fit_kernel_classifier", "classification", "kernel_svc")):
    register(_name, None)(_fit_query(_task, _model))


def _cv_query(task: str, model: str, **kw):
    def run(spark, d):
        prep = _prep(spark, d, task)
        mean, std = models.cross_validate(prep, model, **kw)
        metric = "r2" if task == "regression" else "accuracy"
        return spark.range(1).select(F.lit(model).alias("model"), F.lit(metric).alias("metric"),
                                     F.lit(mean).alias("cv_mean"), F.lit(std).alias("cv_std"))
    return run


for _name, _task, _model in (("cv_linear", "regression", "linear_regression"),
                             ("cv_kernel_regressor", "regression", "kernel_svr"),
                             ("cv_logistic", "classification", "logistic_regression"),
                             ("cv_rf_classifier", "classification", "random_forest"),
                             ("cv_kernel_classifier", "classification", "kernel_svc")):
    register(_name, None)(_cv_query(_task, _model))


def _compare(spark, d):
    """L20 + V4: hold-out metrics of every regressor, with the best by r²."""
    parts = []
    for m in models.REGRESSORS:
        prep, fitted = _fit(spark, d, "regression", m)
        parts.append(models.evaluate_model(fitted, prep).withColumn("model", F.lit(m)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = saved(out, "metrics")
    best = evaluate.best_model(out, "r2").select(F.col("model").alias("best_model"))
    return out.crossJoin(best)


register("compare_models", None)(_compare)


def _importance(spark, d):
    prep, m = _fit(spark, d, "regression", "random_forest")
    rows = models.feature_importance(m, prep)
    return spark.createDataFrame(rows, "feature string, importance double")


register("feature_importance", None)(_importance)


def _importance_total(spark, d):
    """Importances are shares: none is negative and together they are 1."""
    return _importance(spark, d).agg(F.count("*").alias("features"), F.round(F.sum("importance"), 9).alias("total"),
                                     F.count_if(F.col("importance") < 0).alias("negative"))


register("importance_total", "SELECT CAST(20 AS BIGINT) AS features, 1E0 AS total, CAST(0 AS BIGINT) AS negative")(_importance_total)


def _projection_complete(spark, d):
    """Every player's last season gets a finite projection."""
    p = F.col("projected_next_pts")
    return _projection(spark, d).select(*KEY, (p.isNotNull() & ~F.isnan(p)).alias("projected"))


register("projection_complete", with_fixtures("""
SELECT player_id, max(season) AS season, true AS projected FROM statlines GROUP BY player_id""", "statlines"))(_projection_complete)


def _linear_two(spark, d):
    """Points on minutes and rebounds by the normal equations."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    df = fx(spark, d).statlines.select("min", "reb", F.col("pts").alias("label"))
    data = VectorAssembler(inputCols=["min", "reb"], outputCol="features").transform(df)
    m = LinearRegression(solver="normal", regParam=0.0, standardization=False).fit(data)
    rows = [(float(m.intercept), float(m.coefficients[0]), float(m.coefficients[1]))]
    return spark.createDataFrame(rows, "b0 double, b_min double, b_reb double") \
        .select(*[F.round(c, 6).alias(c) for c in ("b0", "b_min", "b_reb")])


register("linear_two_features", with_fixtures("""
WITH s AS (SELECT avg(min) AS mx, avg(reb) AS mz, avg(pts) AS my, covar_pop(min, min) AS xx, covar_pop(reb, reb) AS zz,
  covar_pop(min, reb) AS xz, covar_pop(min, pts) AS xy, covar_pop(reb, pts) AS zy FROM statlines),
b AS (SELECT *, (xy * zz - zy * xz) / (xx * zz - xz * xz) AS b1, (zy * xx - xy * xz) / (xx * zz - xz * xz) AS b2 FROM s)
SELECT round(my - b1 * mx - b2 * mz, 6) AS b0, round(b1, 6) AS b_min, round(b2, 6) AS b_reb FROM b""", "statlines"))(_linear_two)


NEW_SHARE = 0.2
TARGETS = {"predicted_pts": ("pts", "regression", "linear_regression"),
           "predicted_position": ("position", "classification", "logistic_regression"),
           "predicted_tier": ("performance_tier", "classification", "logistic_regression")}


def _score_new(spark, d):
    """Points, position and tier for all seasons of players that no model has seen, from raw box rows."""
    raw = split.holdout_split(fx(spark, d).statlines, ("player_id",), NEW_SHARE, col="is_new")
    raw = saved(raw, "players-split")
    known = features.create_features(classify.label_statlines(raw.where(~F.col("is_new")).drop("is_new")))
    new = raw.where("is_new").drop("is_new")
    new = features.create_features(new.withColumn("ts_pct", M.true_shooting()).withColumn("composite_score", M.composite_score()))
    return models.score_new(known, new, [c for c in DASH_NUMERIC if c != "player_id"], TARGETS)


register("score_new_players", None)(_score_new)


def _score_new_complete(spark, d):
    """Which rows got each prediction, and whether labels are of the vocabulary."""
    scored = _score_new(spark, d)
    return scored.select(*KEY, F.col("predicted_pts").isNotNull().alias("has_pts"),
                         F.col("predicted_position").isin(*POSITION_LABELS).alias("position_known"),
                         F.col("predicted_tier").isin(*classify.EQUAL_WIDTH_LABELS).alias("tier_known"))


# Labels of the five-position rule.
POSITION_LABELS = ("Point Guard", "Shooting Guard", "Power Forward", "Center", "Small Forward")

register("score_new_complete", with_fixtures(f"""
SELECT player_id, season, true AS has_pts, true AS position_known, true AS tier_known FROM statlines
WHERE substr(md5('42|' || CAST(player_id AS VARCHAR)), 1, 8) < '{split.hex_threshold(NEW_SHARE)}'""",
    "statlines"))(_score_new_complete)


def _projection(spark, d):
    """Next-season points from this season's features (lead as the target)."""
    from pyspark.sql import Window
    df = numeric(spark, d)
    w = Window.partitionBy("player_id").orderBy("season")
    df = df.withColumn("next_pts", F.lead("pts").over(w))
    known = df.where(F.col("next_pts").isNotNull())
    prep = models.prepare(known, "next_pts", "regression", engineer=False,
                          exclude=("player_id",), exclude_derived=False)
    m = models.fit(prep, "linear_regression")
    latest = df.where(F.col("next_pts").isNull())
    scored = models.predict(m, latest.select(*KEY, *prep.features))
    return scored.select(*KEY, F.col("prediction").alias("projected_next_pts"))


register("season_projection", None)(_projection)


def _roundtrip(spark, d):
    """K9: save a fitted pipeline to the shared folder, load it, score again, compare."""
    prep = _prep(spark, d, "regression")
    m = models.fit(prep, "linear_regression")
    path = scratch_path(spark, "model")
    models.save_model(m, path)
    loaded = models.load_model(path)
    a = models.predict(m, prep.test).select(*KEY, F.col("prediction").alias("p1"))
    b = models.predict(loaded, prep.test).select(*KEY, F.col("prediction").alias("p2"))
    return a.join(b, list(KEY)).select(*KEY, (F.col("p1") == F.col("p2")).alias("same"))


register("model_roundtrip", with_fixtures(f"""
SELECT player_id, season, true AS same FROM statlines
WHERE substr(md5('42|' || CAST(player_id AS VARCHAR) || '|' || season), 1, 8) < '{split.hex_threshold(0.2)}'""",
    "statlines"))(_roundtrip)


def _compare_classifiers(spark, d):
    """L20 + V4/V6: hold-out accuracy, precision, recall and F1 of every classifier,
    with the best model by accuracy."""
    parts = []
    for m in models.CLASSIFIERS:
        prep, fitted = _fit(spark, d, "classification", m)
        parts.append(models.evaluate_model(fitted, prep).withColumn("model", F.lit(m)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = saved(out, "metrics")
    best = evaluate.best_model(out, "accuracy").select(F.col("model").alias("best_model"))
    return out.crossJoin(best)


register("compare_classifiers", None)(_compare_classifiers)
