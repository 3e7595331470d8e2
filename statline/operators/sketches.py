"""Mergeable statistics stored by season (A5, A7, A10 over S9): a backfill adds its seasons and reads no other.

A state is one row for a season (or any group): exact counts, sums, extremes, and two sketches. HyperLogLog states
give the number of distinct values of a column, KLL states its quantiles; both have a fixed size and merge
with others, so any set of seasons, up to all of them, is answered from a few rows. States live in a versioned table
partitioned by the group, where each refresh publishes one version. Rows that are refreshed twice count once, as a
season's state is replaced as a whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks import versioned

#: log2 of the registers of a HyperLogLog state, and items of a KLL state.
LG_REGISTERS, KLL_ITEMS = 12, 400
#: Bounds that hold for practically all inputs: three standard errors of the distinct count, and the rank error of KLL.
DISTINCT_ERROR, RANK_ERROR = 3 * 1.04 / 2 ** (LG_REGISTERS / 2), 0.02


def _clean(c: str) -> Column:
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def states(df: DataFrame, by: str | Sequence[str], numbers: Sequence[str] = (), distinct: Sequence[str] = ()) -> DataFrame:
    """One state for each group of ``by``; null and NaN are left out of a column's statistics.

    ``numbers`` get count, sum, sum of squares, extremes and a KLL state, ``distinct`` a HyperLogLog state.
    All of it combines before the shuffle.
    """
    by = [by] if isinstance(by, str) else list(by)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in numbers:
        x = _clean(c)
        aggs += [F.count(x).alias(f"{c}_n"), F.sum(x).alias(f"{c}_sum"), F.sum(x * x).alias(f"{c}_squares"),
                 F.min(x).alias(f"{c}_min"), F.max(x).alias(f"{c}_max"),
                 F.kll_sketch_agg_double(x, F.lit(KLL_ITEMS)).alias(f"{c}_kll")]
    for c in distinct:
        aggs.append(F.hll_sketch_agg(F.col(c).cast("string"), F.lit(LG_REGISTERS)).alias(f"{c}_hll"))
    return df.groupBy(*by).agg(*aggs)


def merged(state: DataFrame, by: str | Sequence[str] = ()) -> DataFrame:
    """States of coarser groups from those of finer ones; with no ``by`` one state of everything."""
    by = [by] if isinstance(by, str) else list(by)
    aggs = [F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")]
    for name in state.columns:
        c, _, kind = name.rpartition("_")
        if name in by or not c:
            continue
        if kind in ("n", "sum", "squares"):
            aggs.append(F.sum(name).alias(name))
        elif kind in ("min", "max"):
            aggs.append((F.min if kind == "min" else F.max)(name).alias(name))
        elif kind == "kll":
            aggs.append(F.kll_merge_agg_double(F.when(F.col(f"{c}_n") > 0, F.col(name))).alias(name))
        elif kind == "hll":
            aggs.append(F.hll_union_agg(name).alias(name))
    return state.groupBy(*by).agg(*aggs)


def answers(state: DataFrame, probs: Mapping[str, Sequence[float]] | None = None) -> DataFrame:
    """Statistics of each state: count, mean, sample deviation and extremes (exact); distinct counts and quantiles (estimates).

    ``probs`` names the quantiles of a column (``{col}_q{percent}``); a column without values has nulls.
    """
    kept = [c for c in state.columns if c.rpartition("_")[2] not in ("n", "sum", "squares", "min", "max", "kll", "hll")]
    out = [F.col(c) for c in kept]
    for name in state.columns:
        c, _, kind = name.rpartition("_")
        if kind == "kll":
            n, total = F.col(f"{c}_n"), F.col(f"{c}_sum")
            spread = F.greatest(F.col(f"{c}_squares") - total * total / F.nullif(n, F.lit(0)), F.lit(0.0))
            out += [n.alias(f"{c}_count"), F.try_divide(total, n).alias(f"{c}_mean"),
                    F.sqrt(F.try_divide(spread, n - 1)).alias(f"{c}_std"), F.col(f"{c}_min"), F.col(f"{c}_max")]
            out += [F.when(n > 0, F.kll_sketch_get_quantile_double(F.col(name), F.lit(float(p)))).alias(f"{c}_q{_label(p)}")
                    for p in (probs or {}).get(c, ())]
        elif kind == "hll":
            out.append(F.hll_sketch_estimate(name).alias(f"{c}_distinct"))
    return state.select(*out)


def _label(p: float) -> str:
    return f"{p * 100:.6f}".rstrip("0").rstrip(".").replace(".", "_")


def refresh(spark: SparkSession, facts: DataFrame, path: str, by: str, numbers: Sequence[str] = (), distinct: Sequence[str] = (),
            groups: Sequence | None = None) -> int:
    """Publish the states of ``groups`` (all of ``facts`` if None) in the versioned table at ``path``; returns its version.

    The filter on ``by`` reaches the scan, so a backfill reads its own partitions of ``facts``; states of other groups
    are neither read nor rewritten. A group of ``groups`` without rows in ``facts`` keeps the state it had.
    """
    if groups is not None:
        facts = facts.where(F.col(by).isin(*groups))
    fresh = states(facts, by, numbers, distinct)
    held = versioned.manifest(spark, path)
    mark = (held["version"] if held else 0) + 1
    return versioned.upsert(spark, fresh.withColumn("refreshed", F.lit(mark).cast("long")), path, (by,), ("refreshed",), (by,))


def stored(spark: SparkSession, path: str, by: str, groups: Sequence | None = None) -> DataFrame:
    """The states at ``path``, of ``groups`` only where they are named (other folders are not opened)."""
    held = versioned.read(spark, path, partitions={by: list(groups)} if groups is not None else None)
    return held.drop("refreshed")
