"""Train-and-score (R3) and the dashboard datasets (R4) as callable plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..ml import evaluate, models
from ..operators import aggregate, classify, clean, dashboard, features, rank


def train_and_score(statlines: DataFrame, target: str, task: str = "regression",
                    model_names: tuple[str, ...] | None = None, cv: bool = True, **kw) -> dict:
    """Features → selection → split → scale → fit all models (+CV) → evaluate.

    Returns the prepared data, fitted models and one metrics table
    (model, metric, value).
    """
    prep = models.prepare(statlines, target, task)
    names = model_names or (models.REGRESSORS if task == "regression" else models.CLASSIFIERS)
    fitted, parts = {}, []
    for name in names:
        m = models.fit(prep, name, **kw)
        fitted[name] = m
        part = models.evaluate_model(m, prep).withColumn("model", F.lit(name))
        if cv:
            mean, std = models.cross_validate(prep, name, **kw)
            metric = "cv_r2" if task == "regression" else "cv_accuracy"
            extra = statlines.sparkSession.range(1).select(
                F.lit(f"{metric}_mean").alias("metric"), F.lit(mean).alias("value"),
                F.lit(name).alias("model")).unionByName(
                statlines.sparkSession.range(1).select(
                    F.lit(f"{metric}_std").alias("metric"), F.lit(std).alias("value"),
                    F.lit(name).alias("model")))
            part = part.unionByName(extra)
        parts.append(part)
    metrics = parts[0]
    for p in parts[1:]:
        metrics = metrics.unionByName(p)
    best_metric = "r2" if task == "regression" else "accuracy"
    return {"prepared": prep, "models": fitted, "metrics": metrics,
            "best": evaluate.best_model(metrics, best_metric)}


def dashboard_datasets(statlines: DataFrame, players: DataFrame | None = None, metrics: DataFrame | None = None,
                       predictions: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every chart dataset of the dashboard, keyed by chart.

    ``players`` adds the team bars. ``metrics`` (model, metric, value), as
    ``train_and_score`` returns them, adds the model comparison and the
    precision–recall points; ``predictions`` (truth, prediction) adds the heat map.
    """
    more = {}
    if players is not None:
        more["team_bars"] = aggregate.value_distribution(players, "team_name")
    if metrics is not None:
        more["model_comparison"] = metrics
        more["precision_recall"] = metrics.where(F.col("metric").isin("precision", "recall"))
    if predictions is not None:
        more["confusion"] = evaluate.confusion_matrix(predictions, "truth", "prediction")
    lab = classify.label_statlines(statlines)
    feat = features.create_features(lab)
    core = ("pts", "reb", "ast", "min", "fg_pct")
    cols = ["player_id", "season", "pts", "reb", "ast", "position", "performance_tier"]
    return {
        "summary": aggregate.describe_stats(statlines, core),
        "position_distribution": aggregate.value_distribution(lab, "position"),
        "tier_distribution": aggregate.value_distribution(lab, "performance_tier"),
        "histogram_pts": dashboard.histogram(statlines, "pts"),
        "histogram_reb": dashboard.histogram(statlines, "reb"),
        "histogram_ast": dashboard.histogram(statlines, "ast"),
        "scatter_pts_reb": dashboard.scatter_grid(statlines, "pts", "reb"),
        "scatter_pts_ast": dashboard.scatter_grid(statlines, "pts", "ast"),
        "scatter_efficiency": dashboard.scatter_grid(lab, "fg_pct", "ts_pct", shade="pts"),
        "top_scorers": rank.top_n(feat, "pts", 10, cols, ("player_id", "season")),
        "top_rebounders": rank.top_n(feat, "reb", 10, cols, ("player_id", "season")),
        "top_playmakers": rank.top_n(feat, "ast", 10, cols, ("player_id", "season")),
        "elite": clean.filter_tier(feat, "Elite"),
        "position_profile": aggregate.group_profile(
            feat, "position", ("pts", "reb", "ast", "true_shooting_percentage", "usage_rate")),
        "position_comparison": dashboard.position_comparison(lab),
        "feature_summary": dashboard.feature_summary(feat, lab.columns),
    } | more
