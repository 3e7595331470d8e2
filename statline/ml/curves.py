"""Precision–recall and ROC curves over all score thresholds (V6).

Rows are counted by score first (tied scores are one point), so what follows has
a row for each distinct score. Cumulative counts run over range parts of the
scores: each part is summed on its own and starts at the total of the parts
before it, so no task holds a whole curve, also where one group has most of the
rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.rank import range_sorted
from ..session import saved


def _points(pred: DataFrame, score: str, label: str, by: Sequence[str], num_partitions: int | None) -> DataFrame:
    """(by…, threshold, pos, neg, tp, fp, all_pos, all_neg), one row for each distinct score."""
    s = F.col(score).cast("double")
    rows = pred.where(s.isNotNull() & ~F.isnan(s) & F.col(label).isNotNull())
    # -0.0 and 0.0 are one threshold
    counted = rows.groupBy(*by, F.when(s == 0, F.lit(0.0)).otherwise(s).alias("threshold")).agg(
        F.count_if(F.col(label).cast("boolean")).alias("pos"), F.count_if(~F.col(label).cast("boolean")).alias("neg"))
    parts = range_sorted(counted, [*[F.col(c).asc_nulls_first() for c in by], F.col("threshold").desc()], num_partitions)
    group = [f"__g{i}" for i in range(len(by))]
    sums = saved(parts.groupBy(F.col("__pid").alias("__of"), *[F.col(c).alias(g) for c, g in zip(by, group)])
                 .agg(F.sum("pos").alias("__pos_of"), F.sum("neg").alias("__neg_of")), "curve-parts")
    before = Window.partitionBy(*group).orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = sums.select("__of", *group,
                          F.coalesce(F.sum("__pos_of").over(before), F.lit(0)).alias("__tp0"),
                          F.coalesce(F.sum("__neg_of").over(before), F.lit(0)).alias("__fp0"),
                          F.sum("__pos_of").over(whole).alias("all_pos"), F.sum("__neg_of").over(whole).alias("all_neg"))
    upto = Window.partitionBy("__pid", *by).orderBy("__pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = parts.withColumns({"__tp": F.sum("pos").over(upto), "__fp": F.sum("neg").over(upto)})
    same = F.col("__pid") == F.col("__of")
    for c, g in zip(by, group):
        same = same & F.col(c).eqNullSafe(F.col(g))
    return local.join(offsets, same).select(
        *by, "threshold", "pos", "neg", (F.col("__tp") + F.col("__tp0")).alias("tp"),
        (F.col("__fp") + F.col("__fp0")).alias("fp"), "all_pos", "all_neg")


def pr_curve(pred: DataFrame, score: str, label: str, by: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """One point for each distinct score: who scores at least ``threshold`` is called positive.

    ``label`` is a boolean or 0 / 1. Rows without score (null or NaN) or label are left out; a group without
    positives has no recall.
    """
    tp, fp = F.col("tp"), F.col("fp")
    return _points(pred, score, label, by, num_partitions).select(
        *by, "threshold", "tp", "fp", (tp / (tp + fp)).alias("precision"), F.try_divide(tp, F.col("all_pos")).alias("recall"))


def curve_summary(pred: DataFrame, score: str, label: str, by: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """(by…, positives, negatives, average_precision, roc_auc).

    Average precision weighs each point's precision by the recall it adds; ties share their point, and
    count half in the ROC area.
    """
    tp, fp, pos, neg = (F.col(c) for c in ("tp", "fp", "pos", "neg"))
    points = _points(pred, score, label, by, num_partitions)
    return points.groupBy(*by).agg(
        F.max("all_pos").alias("positives"), F.max("all_neg").alias("negatives"),
        F.try_divide(F.sum(tp / (tp + fp) * pos), F.max("all_pos")).alias("average_precision"),
        F.try_divide(F.sum(neg * (tp - pos / 2)), F.max("all_pos") * F.max("all_neg")).alias("roc_auc"))
