"""Datasets behind the dashboard charts (V1–V8), not the drawing.

Every chart dataset is bounded by its bin or category count, not by the
data volume: histograms and scatter grids are binned counts, so only
``bins`` (or ``bins²``) rows ever leave the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .aggregate import attach_scalars


def _bin(x, lo, hi, bins: int):
    """0-based fixed-width bin; the maximum goes in the last bin."""
    raw = F.floor((x - lo) / (hi - lo) * bins).cast("int")
    return F.when(hi == lo, F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1)))


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """V1: counts per fixed-width bin over [min, max]; empty bins kept (count 0)."""
    spark = df.sparkSession
    mm = df.agg(F.min(col).alias("__lo"), F.max(col).alias("__hi"))
    binned = (attach_scalars(df.select(col).where(F.col(col).isNotNull()), mm)
              .withColumn("bin", _bin(F.col(col), F.col("__lo"), F.col("__hi"), bins))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    skeleton = attach_scalars(spark.range(bins).select(F.col("id").cast("int").alias("bin")), mm)
    width = (F.col("__hi") - F.col("__lo")) / bins
    return (skeleton.join(binned, "bin", "left")
            .select("bin",
                    (F.col("__lo") + width * F.col("bin")).alias("bin_start"),
                    (F.col("__lo") + width * (F.col("bin") + 1)).alias("bin_end"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count")))


def scatter_grid(df: DataFrame, x: str, y: str, bins: int = 20, shade: str | None = None) -> DataFrame:
    """V3: 2-D binned counts of an (x, y) scatter — at most bins² rows — with the mean of ``shade`` if given."""
    mm = df.agg(F.min(x).alias("__xlo"), F.max(x).alias("__xhi"),
                F.min(y).alias("__ylo"), F.max(y).alias("__yhi"))
    pts = df.select(*dict.fromkeys(c for c in (x, y, shade) if c)).where(F.col(x).isNotNull() & F.col(y).isNotNull())
    j = attach_scalars(pts, mm)
    return (j.withColumns({
        "x_bin": _bin(F.col(x), F.col("__xlo"), F.col("__xhi"), bins),
        "y_bin": _bin(F.col(y), F.col("__ylo"), F.col("__yhi"), bins)})
        .groupBy("x_bin", "y_bin")
        .agg(F.count(F.lit(1)).alias("count"),
             *[F.avg(c).alias(f"mean_{c}") for c in dict.fromkeys(c for c in (x, y, shade) if c)]))


def position_comparison(df: DataFrame, by: str = "position",
                        cols: Sequence[str] = ("pts", "reb", "ast", "ts_pct")) -> DataFrame:
    """V7: mean of several stats per position in one aggregation."""
    return df.groupBy(by).agg(*[F.avg(c).alias(f"mean_{c}") for c in cols])


def feature_summary(engineered: DataFrame, original_columns: Sequence[str],
                    key_features: Sequence[str] = ("true_shooting_percentage",
                                                   "effective_field_goal_pct", "pts_per_min",
                                                   "ast_to_ratio", "usage_rate")) -> DataFrame:
    """V8: column counts (schema metadata) and means of the key features (one pass)."""
    new = [c for c in engineered.columns if c not in set(original_columns)]
    aggs = [F.avg(c).alias(f"mean_{c}") for c in key_features if c in engineered.columns]
    return engineered.agg(*aggs).withColumns({
        "original_features": F.lit(len(original_columns)).cast("bigint"),
        "engineered_features": F.lit(len(new)).cast("bigint"),
        "total_features": F.lit(len(engineered.columns)).cast("bigint"),
    })
