"""Model evaluation as aggregations over prediction tables.

Regression metrics are one aggregation. Classification metrics come from the
(label, prediction) count table, whose size is bounded by k² for k classes,
so everything after the first aggregation is tiny.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def eval_regression(pred: DataFrame, label: str = "label",
                    prediction: str = "prediction") -> DataFrame:
    """Mse, rmse, mae, r² in one pass (r² = 1 − SS_res / (n · var_pop))."""
    err = F.col(prediction) - F.col(label)
    agg = pred.agg(F.avg(err * err).alias("mse"), F.avg(F.abs(err)).alias("mae"),
                   F.sum(err * err).alias("__ssr"), F.var_pop(label).alias("__var"),
                   F.count(F.lit(1)).alias("__n"))
    return agg.select("mse", F.sqrt("mse").alias("rmse"), "mae",
                      (F.lit(1.0) - F.try_divide(F.col("__ssr"), F.col("__var") * F.col("__n")))
                      .alias("r2"))


def class_counts(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class: true positives, support (true count) and predicted count.

    The class list is the union of true and predicted labels (at most k rows).
    """
    pairs = pred.groupBy(F.col(label).alias("truth"), F.col(prediction).alias("pred")) \
        .agg(F.count(F.lit(1)).alias("n"))
    truth = pairs.groupBy(F.col("truth").alias("class")).agg(
        F.sum("n").alias("support"),
        F.sum(F.when(F.col("truth") == F.col("pred"), F.col("n")).otherwise(0)).alias("tp"))
    predicted = pairs.groupBy(F.col("pred").alias("class")).agg(F.sum("n").alias("predicted"))
    return (truth.join(predicted, "class", "full")
            .select("class",
                    F.coalesce("support", F.lit(0)).cast("bigint").alias("support"),
                    F.coalesce("tp", F.lit(0)).cast("bigint").alias("tp"),
                    F.coalesce("predicted", F.lit(0)).cast("bigint").alias("predicted")))


def _prf(counts: DataFrame) -> DataFrame:
    p = F.coalesce(F.try_divide(F.col("tp"), F.col("predicted")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    c = counts.withColumns({"precision": p, "recall": r})
    f1 = F.coalesce(F.try_divide(F.col("precision") * F.col("recall") * 2,
                                 F.col("precision") + F.col("recall")), F.lit(0.0))
    return c.withColumn("f1", f1)


def classification_report(pred: DataFrame, label: str = "label",
                          prediction: str = "prediction") -> DataFrame:
    """Per-class precision, recall, F1, support plus macro and weighted averages."""
    per = _prf(class_counts(pred, label, prediction))
    rows = per.select(F.col("class").cast("string").alias("class"), "precision", "recall", "f1",
                      "support")
    macro = per.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                    F.sum("support").cast("bigint").alias("support"))
    n = F.sum("support")
    weighted = per.agg(F.lit("weighted avg").alias("class"),
                       (F.sum(F.col("precision") * F.col("support")) / n).alias("precision"),
                       (F.sum(F.col("recall") * F.col("support")) / n).alias("recall"),
                       (F.sum(F.col("f1") * F.col("support")) / n).alias("f1"),
                       n.cast("bigint").alias("support"))
    return rows.unionByName(macro).unionByName(weighted)


def eval_classification(pred: DataFrame, label: str = "label",
                        prediction: str = "prediction") -> DataFrame:
    """Accuracy and support-weighted precision, recall, F1 (0/0 → 0)."""
    per = _prf(class_counts(pred, label, prediction))
    n = F.sum("support")
    return per.agg((F.sum("tp") / n).alias("accuracy"),
                   (F.sum(F.col("precision") * F.col("support")) / n).alias("precision"),
                   (F.sum(F.col("recall") * F.col("support")) / n).alias("recall"),
                   (F.sum(F.col("f1") * F.col("support")) / n).alias("f1"))


def confusion_matrix(pred: DataFrame, label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """Counts for every (label, prediction) pair of the sorted class list, zero-filled.

    The grid is k × k for the k distinct class values (collected as one
    sorted array by an aggregation), so its size is set by the label
    vocabulary, not by the data.
    """
    counts = pred.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")) \
        .agg(F.count(F.lit(1)).alias("count"))
    classes = counts.agg(F.sort_array(F.array_distinct(F.concat(
        F.collect_set("label"), F.collect_set("prediction")))).alias("__c"))
    grid = classes.select(F.explode("__c").alias("label"), "__c") \
        .select("label", F.explode("__c").alias("prediction"))
    return (grid.join(counts, ["label", "prediction"], "left")
            .select("label", "prediction",
                    F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def residuals(pred: DataFrame, label: str = "label", prediction: str = "prediction",
              key=("player_id", "season")) -> DataFrame:
    """Actual, predicted and residual per row, with the range of the actuals."""
    rng = pred.agg(F.min(label).alias("range_min"), F.max(label).alias("range_max"))
    return (pred.select(*key, F.col(label).alias("actual"), F.col(prediction).alias("predicted"),
                        (F.col(label) - F.col(prediction)).alias("residual"))
            .crossJoin(F.broadcast(rng)))


def best_model(metrics: DataFrame, metric: str, model_col: str = "model",
               metric_col: str = "metric", value_col: str = "value") -> DataFrame:
    """Arg-max of one metric over models (ties: alphabetically first model)."""
    m = metrics.where(F.col(metric_col) == metric)
    w = Window.orderBy(F.col(value_col).desc_nulls_last(), F.col(model_col))
    return m.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")
