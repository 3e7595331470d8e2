"""Quantile- and range-based labels.

Every threshold comes from aggregations over the whole table (all the
quantiles of a label at once, or min and max) and reaches the rows through a
broadcast of that one row — the reference recomputes the quantiles per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import metrics as M
from ..session import saved
from .aggregate import attach_scalars, quantiles

# Tier labels of the equal-width composite bins, lowest first.
EQUAL_WIDTH_LABELS = ("Bench Player", "Rotation Player", "Starter", "Elite")


def position_by_quantile3(df: DataFrame, out: str = "position", method: str = "count") -> DataFrame:
    """C4: assists above the 70th percentile → Guard, rebounds → Forward, else Center."""
    q = quantiles(df, {"ast": (0.7,), "reb": (0.7,)}, method=method)
    j = attach_scalars(df, q)
    label = (F.when(F.col("ast") > F.col("ast_q70"), "Guard")
             .when(F.col("reb") > F.col("reb_q70"), "Forward").otherwise("Center"))
    return j.withColumn(out, label).drop("ast_q70", "reb_q70")


def tier_by_quantile(df: DataFrame, col: str = "pts", out: str = "performance_tier",
                     method: str = "count") -> DataFrame:
    """Above the 80th/60th/40th percentile → Elite/All-Star/Starter, else Bench."""
    q = quantiles(df, {col: (0.4, 0.6, 0.8)}, method=method)
    j = attach_scalars(df, q)
    x = F.col(col)
    label = (F.when(x > F.col(f"{col}_q80"), "Elite").when(x > F.col(f"{col}_q60"), "All-Star")
             .when(x > F.col(f"{col}_q40"), "Starter").otherwise("Bench"))
    return j.withColumn(out, label).drop(f"{col}_q40", f"{col}_q60", f"{col}_q80")


def position_by_quantile5(df: DataFrame, out: str = "position", method: str = "count",
                          sg_assist_quantile: str = "pts_q50") -> DataFrame:
    """Five positions from points/assists/rebounds percentiles.

    ``sg_assist_quantile`` is the threshold the shooting-guard branch compares
    assists against; the default keeps the dashboard's points median.
    """
    q = quantiles(df, {"ast": (0.5, 0.7), "pts": (0.5, 0.6, 0.7), "reb": (0.7, 0.8)},
                  method=method)
    j = attach_scalars(df, q)
    a, p, r = F.col("ast"), F.col("pts"), F.col("reb")
    label = (F.when((a > F.col("ast_q70")) & (p < F.col("pts_q60")), "Point Guard")
             .when((p > F.col("pts_q70")) & (a < F.col(sg_assist_quantile)), "Shooting Guard")
             .when((r > F.col("reb_q70")) & (p > F.col("pts_q50")), "Power Forward")
             .when(r > F.col("reb_q80"), "Center")
             .otherwise("Small Forward"))
    return j.withColumn(out, label).drop(*[c for c in q.columns])


def equal_width_bin(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """1-based equal-width bin, right-closed, lowest value included.

    Edges are ``lo + k·((hi − lo)/bins)``; the bin is one plus the number of
    inner edges strictly below ``x``. A constant column falls in the middle
    bin (its range is widened symmetrically).
    """
    step = (hi - lo) / bins
    count = F.lit(1)
    for k in range(1, bins):
        count = count + (x > lo + step * k).cast("int")
    return F.when(x.isNull(), F.lit(None)).when(hi == lo, F.lit(bins // 2)).otherwise(count)


def equal_width_tier(df: DataFrame, col: str, labels: Sequence[str] = EQUAL_WIDTH_LABELS,
                     out: str = "performance_tier", bin_col: str | None = None) -> DataFrame:
    """Equal-width bins over [min, max] of ``col``, labelled low → high."""
    mm = df.agg(F.min(col).alias("__lo"), F.max(col).alias("__hi"))
    j = attach_scalars(df, mm)
    b = equal_width_bin(F.col(col), F.col("__lo"), F.col("__hi"), len(labels))
    label = F.element_at(F.array(*[F.lit(s) for s in labels]), b)
    j = j.withColumn(out, label)
    if bin_col:
        j = j.withColumn(bin_col, b)
    return j.drop("__lo", "__hi")


def label_statlines(statlines: DataFrame, method: str = "count") -> DataFrame:
    """Dashboard / model input: true shooting, composite score, C6 position, C7 tier."""
    df = statlines.withColumn("ts_pct", M.true_shooting())
    # quantiles, range and labels read what is written here, so the input is evaluated once
    df = saved(df.withColumn("composite_score", M.composite_score()), "statlines")
    df = position_by_quantile5(df, method=method)
    return equal_width_tier(df, "composite_score")
