"""Univariate feature scoring and selection (L1–L3).

Scores for every candidate feature come from ONE aggregation: ``corr`` per
feature for regression, per-class sums and sums of squares (k rows) then a
second tiny aggregation for the one-way ANOVA F. Only one score per feature
reaches the driver, so selection is bounded by the feature count, never by
the row count.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.safe import zero_if_missing
from ..operators.clean import numeric_columns

DEFAULT_EXCLUDE = ("player_id",)
#: Correlations in one aggregate; the code that Spark makes of dozens is too long for the JVM to compile.
TOGETHER = 8


def candidate_features(df: DataFrame, target: str, exclude: Sequence[str] = DEFAULT_EXCLUDE,
                       exclude_derived: bool = False) -> list[str]:
    """Numeric columns other than the target and excluded keys.

    With ``exclude_derived`` the columns whose name contains the target (e.g.
    ``pts_per_min`` for target ``pts``) are dropped to avoid leakage.
    """
    skip = set(exclude) | {target}
    feats = numeric_columns(df, exclude=skip)
    if exclude_derived:
        feats = [c for c in feats if target not in c]
    return feats


def f_regression_scores(df: DataFrame, feats: Sequence[str], target: str) -> DataFrame:
    """L1: F = r² / (1 − r²) · (n − 2) per feature (features cleaned: NULL/NaN/inf → 0)."""
    clean = df.select(*[zero_if_missing(c).alias(c) for c in feats], F.col(target).cast("double"))
    aggs = [F.corr(c, target).alias(f"__s{i}") for i, c in enumerate(feats)]
    wide = clean.agg(F.count(F.lit(1)).alias("__n"), *aggs)
    structs = []
    for i, c in enumerate(feats):
        r2 = F.col(f"__s{i}") * F.col(f"__s{i}")
        fval = F.try_divide(r2, F.lit(1.0) - r2) * (F.col("__n") - 2)
        structs.append(F.struct(F.lit(i).cast("int").alias("feature_index"),
                                F.lit(c).alias("feature"), fval.alias("f_score")))
    return wide.select(F.inline(F.array(*structs)))


def f_classif_scores(df: DataFrame, feats: Sequence[str], label: str) -> DataFrame:
    """L2: one-way ANOVA F per feature: (SSB/(k−1)) / (SSW/(n−k))."""
    clean = df.select(*[zero_if_missing(c).alias(c) for c in feats], F.col(label))
    per_class = clean.groupBy(label).agg(
        F.count(F.lit(1)).alias("__nc"),
        *[F.sum(c).alias(f"__s{i}") for i, c in enumerate(feats)],
        *[F.sum(F.col(c) * F.col(c)).alias(f"__q{i}") for i, c in enumerate(feats)])
    aggs = [F.sum("__nc").alias("__n"), F.count(F.lit(1)).alias("__k")]
    for i in range(len(feats)):
        aggs += [F.sum(f"__s{i}").alias(f"__ts{i}"), F.sum(f"__q{i}").alias(f"__tq{i}"),
                 F.sum(F.col(f"__s{i}") * F.col(f"__s{i}") / F.col("__nc")).alias(f"__b{i}")]
    tot = per_class.agg(*aggs)
    structs = []
    for i, c in enumerate(feats):
        ssb = F.col(f"__b{i}") - F.col(f"__ts{i}") * F.col(f"__ts{i}") / F.col("__n")
        ssw = F.col(f"__tq{i}") - F.col(f"__b{i}")
        fval = F.try_divide(ssb / (F.col("__k") - 1), ssw / (F.col("__n") - F.col("__k")))
        structs.append(F.struct(F.lit(i).cast("int").alias("feature_index"),
                                F.lit(c).alias("feature"), fval.alias("f_score")))
    return tot.select(F.inline(F.array(*structs)))


def rank_features(scores: DataFrame, k: int = 20) -> DataFrame:
    """L3 as a table: F rank (NULL/NaN scores — constant columns — rank last) and
    ``selected`` for the top k. Bounded by the number of features."""
    from pyspark.sql import Window
    good = F.col("f_score").isNotNull() & ~F.isnan("f_score")
    w = Window.orderBy((~good).asc(), F.col("f_score").desc(), F.col("feature_index").asc())
    ranked = scores.withColumn("f_rank", F.row_number().over(w).cast("bigint"))
    return ranked.withColumn("selected", good & (F.col("f_rank") <= k))


def select_features(df: DataFrame, target: str, task: str = "regression", k: int = 20,
                    exclude: Sequence[str] = DEFAULT_EXCLUDE,
                    exclude_derived: bool = False) -> list[str]:
    """L3: names of the top-k features by F score, in their original column order; ``df`` is a written table."""
    feats = candidate_features(df, target, exclude, exclude_derived)
    if task == "regression":  # a few columns of the table at a time, in one job
        parts = [f_regression_scores(df, feats[i:i + TOGETHER], target).withColumn("feature_index", F.col("feature_index") + i)
                 for i in range(0, len(feats), TOGETHER)]
        scores = reduce(DataFrame.unionByName, parts)
    else:
        scores = f_classif_scores(df, feats, target)
    rows = rank_features(scores, min(k, len(feats))).where("selected").collect()
    chosen = {r["feature"] for r in rows}
    return [f for f in feats if f in chosen]
