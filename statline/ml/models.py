"""Model fitting, cross-validation and scoring with Spark ML.

One ``Pipeline`` per model: cleaning of the features (missing, NaN, infinite →
0) → fitted scaling (SQL expressions) → optional random-Fourier-feature map →
``VectorAssembler`` → estimator, so a saved ``PipelineModel`` scores new data of
any size with ``transform``, whatever its features hold.

Kernel models: an exact RBF SVM needs the n × n kernel matrix on one
machine. Random Fourier features (Rahimi & Recht, 2007) approximate the same
kernel with D cosine features computed as ordinary column expressions, after
which a linear model is fitted by distributed Newton steps (:mod:`newton`): Huber
regression for the SVR, a multinomial logistic regression (kernel logistic
regression, one model for all classes) for the SVC.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import IndexToString, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.clean import clean_features
from ..session import checkpoint_dir, drop_scratch, saved
from ..operators.features import create_features
from . import evaluate, folds, forest, newton
from .selection import select_features
from .split import (ScalerParams, fit_standard_scaler, holdout_split, kfold_column, label_indexer,
                    scaler_transformer, stratified_split_folds)

REGRESSORS = ("linear_regression", "random_forest", "kernel_svr")
#: Memory for the statistics of the nodes that one pass over the data splits.
FOREST_MB = 512
CLASSIFIERS = ("logistic_regression", "random_forest", "kernel_svc")


@dataclass
class Prepared:
    """Model-ready data: key, target, selected (cleaned) features, split and fold."""

    data: DataFrame
    features: list[str]
    target: str
    task: str
    key: tuple[str, ...]
    scaler: ScalerParams = field(default_factory=ScalerParams)
    reads: tuple[DataFrame, ...] = ()  #: written tables of its own that ``data`` reads

    @property
    def train(self) -> DataFrame:
        return self.data.where(~F.col("is_test"))

    @property
    def test(self) -> DataFrame:
        return self.data.where(F.col("is_test"))


def prepare(df: DataFrame, target: str, task: str = "regression", k: int = 20,
            key: Sequence[str] = ("player_id", "season"), exclude: Sequence[str] = ("player_id",),
            exclude_derived: bool = False, test_fraction: float = 0.2, seed: int = 42,
            folds: int = 5, engineer: bool = True, written: bool = False) -> Prepared:
    """Features (M20) → selection (L3) → cleaning (P16) → split (L4/L5) → folds.

    The prepared frame is checkpointed once (shared folder), so selection,
    scaling, every fit and every CV fold read the same materialised rows. ``written`` says that ``df`` is
    little work on a table that is written already.
    """
    checkpoint_dir(df.sparkSession)
    feats_df = (create_features(df) if engineer else df).where(F.col(target).isNotNull())
    # one evaluation of the (possibly long) feature lineage; every step below reads it
    feats_df = feats_df if written and not engineer else saved(feats_df)
    selected = select_features(feats_df, target, task, k, exclude, exclude_derived)
    data = clean_features(feats_df, selected).select(*key, target, *selected)
    if task == "regression":
        data = holdout_split(data, key, test_fraction, seed)
        # folds hash with another seed: the split's hash range must not coincide with a fold
        data = saved(kfold_column(data, key, folds, seed + 1))
        reads = (data,)
    else:
        data = stratified_split_folds(data, target, key, test_fraction, folds, seed, written=True)
        reads = data._reads
    prep = Prepared(data, selected, target, task, tuple(key), reads=reads)
    prep.scaler = fit_standard_scaler(prep.train, selected)
    return prep


def rff_weights(d: int, gamma: float, n_components: int = 64, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """The D × d weights and D offsets of the random Fourier features."""
    rng = np.random.default_rng(seed)
    return (rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_components, d)),
            rng.uniform(0.0, 2.0 * math.pi, size=n_components))


def rff_transformer(cols: Sequence[str], gamma: float, n_components: int = 64,
                    seed: int = 42, out_prefix: str = "rff_") -> SQLTransformer:
    """Random Fourier features z_j = √(2/D)·cos(w_j·x + b_j), w ~ N(0, 2γ), b ~ U(0, 2π).

    The D × d weights are parameters drawn once on the driver and embedded as
    literals of D plain sums, which Spark compiles; as a higher-order function over
    literal arrays the same map is interpreted, 64 x 20 boxed steps a row.
    """
    w, b = rff_weights(len(cols), gamma, n_components, seed)
    scale = math.sqrt(2.0 / n_components)

    outs = ", ".join(
        f"{scale!r}D * cos({float(bj)!r}D + ({' + '.join(f'`{c}` * {float(v)!r}D' for c, v in zip(cols, wj))})) AS `{out_prefix}{j}`"
        for j, (wj, bj) in enumerate(zip(w, b)))
    return SQLTransformer(statement=f"SELECT *, {outs} FROM __THIS__")


def _gamma_scale(prep: Prepared) -> float:
    """gamma = 1 / (d · Var(X)) on the scaled training matrix."""
    d = len(prep.features)
    # after z-scaling every column that varies has population variance 1
    var = max((d - len(prep.scaler.constant)) / d, 1e-12)
    return 1.0 / (d * var)


def cleaning_transformer(cols: Sequence[str]) -> SQLTransformer:
    """P16 as a pipeline stage: missing, NaN and infinite features become 0; other columns pass through."""
    cleaned = ", ".join(
        f"CASE WHEN `{c}` IS NULL OR isnan(CAST(`{c}` AS DOUBLE)) OR abs(CAST(`{c}` AS DOUBLE)) = DOUBLE('Infinity') "
        f"THEN 0D ELSE CAST(`{c}` AS DOUBLE) END AS `{c}`" for c in cols)
    return SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(f'`{c}`' for c in cols)}), {cleaned} FROM __THIS__")


def build_pipeline(prep: Prepared, model: str, num_trees: int = 100, max_depth: int = 30,
                   seed: int = 42, rff_components: int = 64, max_iter: int = 1000) -> Pipeline:
    """L8–L13 as one Pipeline each.

    Forests grow to Spark's greatest depth. ``rff_components`` bounds the kernel
    approximation: its error falls as 1/√D, about 0.12 for the default.
    """
    stages = [cleaning_transformer(prep.features), scaler_transformer(prep.scaler, "_z")]
    zcols = [f"{c}_z" for c in prep.features]
    if prep.task == "classification":
        stages.append(label_indexer(prep.target, "label"))
        label = "label"
    else:
        stages.append(SQLTransformer(
            statement=f"SELECT *, CAST(`{prep.target}` AS DOUBLE) AS label FROM __THIS__"))
        label = "label"
    if model.startswith("kernel"):
        stages.append(rff_transformer(zcols, _gamma_scale(prep), rff_components, seed))
        inputs = [f"rff_{j}" for j in range(rff_components)]
    else:
        inputs = zcols
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error"))
    n_train = max(prep.train.count(), 1) if model == "logistic_regression" else 1
    est = {
        ("regression", "linear_regression"): lambda: LinearRegression(
            labelCol=label, solver="normal", regParam=0.0, standardization=False),
        ("regression", "random_forest"): lambda: RandomForestRegressor(
            labelCol=label, numTrees=num_trees, maxDepth=max_depth,
            featureSubsetStrategy="all", seed=seed, maxMemoryInMB=FOREST_MB, cacheNodeIds=True),
        ("regression", "kernel_svr"): lambda: LinearRegression(
            labelCol=label, loss="huber", regParam=1e-4, standardization=False,
            maxIter=max_iter),
        ("classification", "logistic_regression"): lambda: LogisticRegression(
            labelCol=label, family="multinomial", regParam=1.0 / n_train, elasticNetParam=0.0,
            standardization=False, maxIter=max_iter),
        ("classification", "random_forest"): lambda: RandomForestClassifier(
            labelCol=label, numTrees=num_trees, maxDepth=max_depth,
            featureSubsetStrategy="sqrt", seed=seed, maxMemoryInMB=FOREST_MB, cacheNodeIds=True),
        ("classification", "kernel_svc"): lambda: LogisticRegression(
            labelCol=label, family="multinomial", regParam=1e-3, elasticNetParam=0.0,
            standardization=False, maxIter=max_iter),
    }[(prep.task, model)]()
    stages.append(est)
    return Pipeline(stages=stages)


#: Models whose convex loss :mod:`newton` minimises; a ``grid_search`` of them, or of forests, uses Spark ML's estimators.
NEWTON = ("logistic_regression", "kernel_svr", "kernel_svc")


def _newton_problem(prep: Prepared, model: str, seed: int = 42, rff_components: int = 64, max_iter: int = 1000, **_):
    """(stages before the model, its inputs, training rows, design, loss, iterations): same loss and penalty as ``build_pipeline``."""
    stages = [cleaning_transformer(prep.features), scaler_transformer(prep.scaler, "_z")]
    zcols = tuple(f"{c}_z" for c in prep.features)
    classes = 0
    if prep.task == "classification":
        stages.append(label_indexer(prep.target, "label").fit(prep.train))
        classes = len(stages[-1].labels)
    else:
        stages.append(SQLTransformer(statement=f"SELECT *, CAST(`{prep.target}` AS DOUBLE) AS label FROM __THIS__"))
    rows = PipelineModel(stages).transform(prep.train)
    rows = rows.select(*zcols, "label", F.col("fold").cast("int") if "fold" in rows.columns else F.lit(0).alias("fold"))
    if model.startswith("kernel"):
        gamma = _gamma_scale(prep)
        design = newton.Design(zcols, *rff_weights(len(zcols), gamma, rff_components, seed))
        stages.append(rff_transformer(list(zcols), gamma, rff_components, seed))
        inputs = [f"rff_{j}" for j in range(rff_components)]
    else:
        design, inputs = newton.Design(zcols), list(zcols)
    if prep.task == "regression":
        loss = newton.Huber(design.width, 1e-4)
    else:
        reg = 1e-3 if model.startswith("kernel") else 1.0 / max(prep.train.count(), 1)
        loss = newton.Logistic(design.width, classes, reg)
    return stages, inputs, rows, design, loss, max_iter


def _forest_problem(prep: Prepared):
    """(stages before the forest, its inputs, training rows, classes)."""
    stages = [cleaning_transformer(prep.features), scaler_transformer(prep.scaler, "_z")]
    classes = 0
    if prep.task == "classification":
        stages.append(label_indexer(prep.target, "label").fit(prep.train))
        classes = len(stages[-1].labels)
    else:
        stages.append(SQLTransformer(statement=f"SELECT *, CAST(`{prep.target}` AS DOUBLE) AS label FROM __THIS__"))
    inputs = [f"{c}_z" for c in prep.features]
    rows = PipelineModel(stages).transform(prep.train)
    rows = rows.select(*inputs, "label", F.col("fold").cast("int") if "fold" in rows.columns else F.lit(0).alias("fold"),
                       F.xxhash64(*prep.key).alias("hash"))
    return stages, inputs, rows, classes


def _newton_minimum(rows: DataFrame, design, loss, max_iter: int) -> np.ndarray:
    start = loss.start(*newton.label_sums(rows, "label"))
    return newton.minimise(rows, design, loss, {newton.ALL: start}, max_iter)[newton.ALL]


def fit(prep: Prepared, model: str, **kw) -> PipelineModel:
    """Fit one model on the training split."""
    if model == "random_forest":
        stages, inputs, rows, classes = _forest_problem(prep)
        return PipelineModel([*stages, forest.fit(rows, inputs, classes, **kw)])
    if model not in NEWTON:
        return build_pipeline(prep, model, **kw).fit(prep.train)
    stages, inputs, rows, design, loss, max_iter = _newton_problem(prep, model, **kw)
    theta = _newton_minimum(rows, design, loss, max_iter)
    return PipelineModel([*stages, SQLTransformer(statement=newton.statement(loss, theta, inputs))])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Score any number of rows with the feature columns; classifications are decoded to labels.

    The label column is not needed. Missing features count as 0, so every row gets a prediction.
    """
    scored = PipelineModel([s for s in model.stages if not isinstance(s, StringIndexerModel)
                            and "AS label" not in (s.getStatement() or "" if isinstance(s, SQLTransformer) else "")])
    out = scored.transform(df)
    for s in model.stages:
        if isinstance(s, StringIndexerModel):
            out = IndexToString(inputCol="prediction", outputCol="predicted_label", labels=s.labels).transform(out)
    return out


def score_new(known: DataFrame, new: DataFrame, features: Sequence[str], targets: dict[str, tuple[str, str, str]],
              key: Sequence[str] = ("player_id", "season")) -> DataFrame:
    """Every target's prediction for every row of ``new``.

    ``targets`` maps an output column to (target, task, model); each is fitted on
    ``known`` and applied in turn, so no join can lose a row. Both tables need
    the candidate ``features``; ``new`` needs no target. ``known`` is written once for all targets; what one of
    them was fitted on goes when its model is there.
    """
    kept = [*key]
    out = new.select(*key, *features)
    known = saved(known.select(*dict.fromkeys([*key, *[target for target, _, _ in targets.values()], *features])), "known")
    for name, (target, task, model) in targets.items():
        prep = prepare(known.select(*key, target, *[f for f in features if f != target]), target, task, key=key, engineer=False,
                       written=True)
        pred = predict(fit(prep, model), out)
        drop_scratch(*prep.reads)
        kept.append(name)
        out = pred.withColumn(name, F.col("prediction" if task == "regression" else "predicted_label")) \
                  .select(*kept, *features)
    drop_scratch(known)
    return out.select(*kept)


def evaluate_model(model: PipelineModel, prep: Prepared) -> DataFrame:
    """Hold-out metrics as (metric, value) rows."""
    pred = predict(model, prep.test)
    if prep.task == "regression":
        wide = evaluate.eval_regression(pred.withColumn("label", F.col(prep.target).cast("double")))
    else:
        wide = evaluate.eval_classification(pred.withColumn("truth", F.col(prep.target)),
                                            label="truth", prediction="predicted_label")
    cols = wide.columns
    return wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("metric"),
                                                   F.col(c).cast("double").alias("value"))
                                          for c in cols])))


@dataclass
class GridSearch:
    """Mean and standard deviation of every grid point over the folds, and the best point's pipeline fitted on all training rows."""

    points: list[tuple[dict, float, float]]
    best_params: dict
    best_model: PipelineModel


def grid_search(prep: Prepared, model: str, grid: dict | None = None, parallelism: int = 2, **kw) -> GridSearch:
    """K-fold CV of every combination of ``grid`` (parameter of the estimator -> values) with the fold column.

    Scores are r² or accuracy; ties go to the first point. Only the refit of the best point is kept.
    """
    pipe = build_pipeline(prep, model, **kw)
    if prep.task == "regression":
        ev = RegressionEvaluator(metricName="r2", labelCol="label")
    else:
        ev = MulticlassClassificationEvaluator(metricName="accuracy", labelCol="label")
    estimator = pipe.getStages()[-1]
    build = ParamGridBuilder()
    for name, values in (grid or {}).items():
        build = build.addGrid(estimator.getParam(name), list(values))
    points = build.build()
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=points, evaluator=ev,
                        numFolds=prep.data.agg(F.max("fold")).first()[0] + 1,
                        foldCol="fold", parallelism=parallelism, collectSubModels=False)
    cvm = cv.fit(prep.train)
    # PySpark computes stdMetrics with numpy's population std (ddof 0), as NumPy users expect
    scored = [({p.name: v for p, v in point.items()}, float(m), float(s))
              for point, m, s in zip(points, cvm.avgMetrics, cvm.stdMetrics)]
    best = max(range(len(scored)), key=lambda i: (scored[i][1], -i))
    return GridSearch(scored, scored[best][0], cvm.bestModel)


def training_sums(prep: Prepared) -> folds.FoldSums:
    """Fold sums of the training rows, for :func:`folds.ridge_search`."""
    return folds.fold_sums(prep.train, prep.features, prep.target, "fold", prep.scaler)


def cross_validate(prep: Prepared, model: str, parallelism: int = 2, **kw):
    """(mean, population std) of r² or accuracy over the folds of the training split.

    The linear regression needs no fit for that: its folds follow from one pass of sums. The folds of the logistic and
    kernel models are fitted together (:mod:`newton`), those of the forests too (:mod:`forest`).
    """
    if (prep.task, model) == ("regression", "linear_regression"):
        r2 = [r for _, _, r in folds.ridge_scores(training_sums(prep), (0.0,))]
        return float(np.mean(r2)), float(np.std(r2))
    if model in NEWTON:
        _, _, rows, design, loss, max_iter = _newton_problem(prep, model, **kw)
        whole = _newton_minimum(rows, design, loss, max_iter)  # close to the minimum of every fold's problem
        keys = range(prep.data.agg(F.max("fold")).first()[0] + 1)
        thetas = newton.minimise(rows, design, loss, {k: whole for k in keys}, max_iter)
        scores = list(newton.fold_scores(rows, design, loss, thetas).values())
        return float(np.mean(scores)), float(np.std(scores))
    if model == "random_forest":
        _, inputs, rows, classes = _forest_problem(prep)
        keys = prep.data.agg(F.max("fold")).first()[0] + 1
        scored = forest.fit(rows, inputs, classes, folds=keys, **kw).transform(rows)
        wrong = F.col("label") - F.col("prediction")
        score = F.avg((wrong == 0).cast("double")) if classes else 1 - F.sum(wrong * wrong) / (F.var_pop("label") * F.count("*"))
        scores = [r[1] for r in scored.groupBy("fold").agg(score).orderBy("fold").collect()]
        return float(np.mean(scores)), float(np.std(scores))
    _, mean, std = grid_search(prep, model, parallelism=parallelism, **kw).points[0]
    return mean, std


def feature_importance(model: PipelineModel, prep: Prepared) -> list[tuple[str, float]]:
    """Tree-ensemble importances per selected feature (bounded by the feature count)."""
    est = model.stages[-1]
    if not hasattr(est, "featureImportances"):
        raise TypeError("feature importances need a tree ensemble")
    imp = est.featureImportances.toArray()
    return [(f, float(imp[i])) for i, f in enumerate(prep.features)]


def save_model(model: PipelineModel, path: str) -> None:
    """K9: persist the whole fitted pipeline (scaling, encoders, estimator)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
