"""Aggregations (A1–A14), quantiles and IQR outlier capping.

Every multi-column statistic is computed in ONE aggregation pass (partial
aggregation on the map side, final merge after the shuffle) and attached to
rows through a broadcast of a single row — a size bound that holds at any
scale. Per-group statistics join back on the group key and leave the
broadcast decision to AQE's runtime size check.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.safe import safe_div
from ..session import drop_scratch, saved

# ------------------------------------------------------------------ A1–A4


def aggregate_game_logs(logs: DataFrame, keys: Sequence[str] = ("player_id", "season")) -> DataFrame:
    """A1–A4: per-key game counts, per-game means, ratio-of-sums shooting, W/L."""
    return (logs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("games_played"),
        F.avg("minutes").alias("avg_minutes_per_game"),
        F.avg("pts").alias("avg_points_per_game"),
        F.avg("reb").alias("avg_rebounds_per_game"),
        F.avg("ast").alias("avg_assists_per_game"),
        F.avg("stl").alias("avg_steals_per_game"),
        F.avg("blk").alias("avg_blocks_per_game"),
        F.avg("tov").alias("avg_turnovers_per_game"),
        safe_div(F.sum("fgm"), F.sum("fga")).alias("field_goal_pct"),
        safe_div(F.sum("fg3m"), F.sum("fg3a")).alias("three_point_pct"),
        safe_div(F.sum("ftm"), F.sum("fta")).alias("free_throw_pct"),
        F.avg("plus_minus").alias("avg_plus_minus"),
        F.count_if(F.col("wl") == "W").alias("wins"),
        F.count_if(F.col("wl") == "L").alias("losses"),
    ).withColumn("win_pct", safe_div(F.col("wins"), F.col("wins") + F.col("losses"))))


# ------------------------------------------------------------------ quantiles


def _pct(c: str, probs: Sequence[float], exact: bool, accuracy: int) -> Column:
    arr = F.array(*[F.lit(float(p)) for p in probs])
    if exact:
        return F.percentile(F.col(c), arr)
    return F.percentile_approx(F.col(c), arr, accuracy)


def quantiles(df: DataFrame, spec: Mapping[str, Sequence[float]], by: Sequence[str] = (),
              method: str = "count", accuracy: int = 100_000) -> DataFrame:
    """A10: quantiles of several columns, one row per ``by`` group (or one row).

    Output columns are ``{col}_q{pct}`` (e.g. ``pts_q70``). Methods:

    * ``"count"`` (default) — exact linear interpolation between order
      statistics, ``lo + (hi − lo)·d`` at position ``(n − 1)·p`` (the pandas /
      numpy definition), found by counting (see ``_counted_quantiles``). NULL
      and NaN are left out; a group without values has NULL.
    * ``"percentile"`` — Spark's exact ``percentile`` aggregate; its final
      merge keeps a value→count map of the whole column in one task per group.
    * ``"approx"`` — the bounded-memory ``percentile_approx`` sketch.
    """
    if method == "count":
        return _counted_quantiles(df, spec, by)
    aggs, names = [], []
    for c, probs in spec.items():
        tmp = f"__q_{c}"
        aggs.append(_pct(c, probs, method == "percentile", accuracy).alias(tmp))
        names.extend((tmp, i, f"{c}_q{_label(p)}") for i, p in enumerate(probs))
    out = df.groupBy(*by).agg(*aggs)
    return out.select(*by, *[F.col(t)[i].alias(n) for t, i, n in names])


# Buckets that a value range is cut into, also the number of rows up to which a range is counted value by value; items
# that a sketch keeps; how far in rank a bracket reaches to each side (three times the sketch's usual error).
SPLITS, SKETCH_ITEMS, BRACKET = 4096, 1000, 0.01


def _magnitude(v: Column) -> Column:
    """Bucket number that rises with ``v``: an eighth of a power of two, signed."""
    size = F.floor((F.least(F.log2(F.abs(v)), F.lit(1025.0)) + 1080) * 8) + 1
    return F.when(v == 0, F.lit(0)).when(v > 0, size).otherwise(-size)


def _part(v: Column, low: Column, high: Column) -> Column:
    """Number of ``v``'s part of the range from ``low`` to ``high``, rising with ``v``.

    Parts are equally wide where both ends are of one sign and like size, else eighths of powers
    of two, so that a range over many magnitudes doesn't need a pass for each twelve bits.
    """
    alike = (low != 0) & (F.signum(low) == F.signum(high)) & (F.greatest(F.abs(low), F.abs(high)) < F.least(F.abs(low), F.abs(high)) * SPLITS)
    even = F.least(F.floor((v - low) / F.nullif(high - low, F.lit(0.0)) * SPLITS), F.lit(SPLITS - 1))
    return F.when(alike, even).otherwise(_magnitude(v))


def _narrowed(hist: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The bucket that holds each wanted rank ``__k``, with the rank inside it."""
    order = ["__s", "__b"] if "__s" in hist.columns else ["__b"]
    upto = F.sum("__n").over(Window.partitionBy(*keys).orderBy(*order))
    running = hist.withColumn("__upto", upto)
    inside = (F.col("__k") <= F.col("__upto")) & (F.col("__k") > F.col("__upto") - F.col("__n"))
    return (wanted.join(running, list(keys)).where(inside)
            .withColumn("__k", F.col("__k") - F.col("__upto") + F.col("__n")).drop("__upto", *order))


def _brackets(wide: DataFrame, spec: Mapping[str, Sequence[float]], by: Sequence[str]) -> DataFrame:
    """One row for each group with a cell for each column: number of values, rank brackets, and their sorted ends.

    One pass builds a sketch of each column, which combines before the shuffle. A bracket reaches from the sketch's
    value a little below a wanted rank to the one a little above; smallest and largest value are ends too.
    """
    aggs, cells = [], []
    for i, (c, probs) in enumerate(spec.items()):
        x = F.when(~F.isnan(f"__v{i}"), F.col(f"__v{i}"))
        aggs += [F.count(x).alias(f"__n{i}"), F.min(x).alias(f"__min{i}"), F.max(x).alias(f"__max{i}"),
                 F.kll_sketch_agg_double(x, F.lit(SKETCH_ITEMS)).alias(f"__sk{i}")]
        lows, highs = [F.array(*[F.kll_sketch_get_quantile_double(F.col(f"__sk{i}"), F.lit(min(max(float(p) + d, 0.0), 1.0)))
                                 for p in probs]) for d in (-BRACKET, BRACKET)]
        cuts = F.array_sort(F.array_distinct(F.concat(F.array(F.col(f"__min{i}"), F.col(f"__max{i}")), lows, highs)))
        cells.append(F.struct(F.col(f"__n{i}").alias("n"), *[F.when(F.col(f"__n{i}") > 0, x).alias(name)
                                                             for name, x in (("cuts", cuts), ("lows", lows), ("highs", highs))]))
    return wide.groupBy(*by).agg(*aggs).select(*by, F.array(*cells).alias("__cells"))


def _counted_quantiles(df: DataFrame, spec: Mapping[str, Sequence[float]], by: Sequence[str]) -> DataFrame:
    """Order statistics in two passes, for almost all data; exact for every distribution and at every size.

    The first pass sketches each column, which gives a bracket of values around each wanted rank. The second counts all
    values: between two ends of brackets by part, at an end as a bucket of its own. A running sum over the exact counts
    names the bucket of each wanted rank, whether or not the sketch was right. As long as a wanted bucket holds more
    than one distinct value (and the rank is not its first or last), its range is cut again, by another pass. All counts
    combine before the shuffle, so rows are neither sorted nor moved, and a value that half of the rows share is one
    number. What passes between rounds has a row for each group, column and probability.
    """
    cols = list(spec)
    grp = [*by, "__c"]
    wide = df.select(*by, *[(F.col(c).cast("double") + 0.0).alias(f"__v{i}") for i, c in enumerate(cols)])
    if not hasattr(df, "_scratch_path"):  # else each pass reads these columns of a table written already
        wide = saved(wide, "quantile-input")
    cells = saved(_brackets(wide, spec, by), "quantile-brackets")
    counted = [F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi")]

    def values(*more: Column) -> DataFrame:
        return F.inline(F.array(*[F.struct(F.lit(i).alias("__c"), F.col(f"__v{i}").alias("__v"), *[m[i] for m in more])
                                  for i in range(len(cols))]))

    here = [F.col("__cells")[i].alias("__cell") for i in range(len(cols))]
    cut = attach_scalars(wide, cells) if not by else wide.join(cells, list(by))
    cut = cut.select(*by, values(here)).where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    v, cuts, most = F.col("__v"), F.col("__cell")["cuts"], max(map(len, spec.values()))
    cut = cut.withColumn("__under", reduce(add, [F.when(F.get(cuts, F.lit(j)) < v, 1).otherwise(0) for j in range(2 * most + 2)]))
    end = F.get(cuts, F.col("__under"))
    near = reduce(or_, [v.between(F.get(F.col("__cell")["lows"], F.lit(j)), F.get(F.col("__cell")["highs"], F.lit(j)))
                        for j in range(most)])
    # even numbers lie between ends, odd ones are ends; what is in no bracket is one bucket
    segment = F.col("__under") * 2 + (end == v).cast("int")
    part = (F.when((end == v) | ~F.coalesce(near, F.lit(False)), F.lit(0.0)).when(F.col("__cell")["n"] * (2 * BRACKET) <= SPLITS, v)
            .otherwise(_part(v, F.get(cuts, F.col("__under") - 1), end).cast("double")))
    hist = cut.groupBy(*grp, segment.alias("__s"), part.alias("__b")).agg(*counted)
    probs = F.array(*[F.array(*[F.lit(float(p)) for p in spec[c]]) for c in cols])
    pos = (F.col("__total") - 1) * F.col("__p")
    wanted = (cells.select(*by, F.posexplode("__cells").alias("__c", "__cell"))
              .select(*grp, F.col("__cell")["n"].alias("__total")).where(F.col("__total") > 0)
              .select(*grp, "__total", F.posexplode(probs[F.col("__c")]).alias("__i", "__p"))
              .select(*grp, "__i", (pos - F.floor(pos)).alias("__d"), F.inline(F.array(
                  F.struct(F.lit(0).alias("__role"), (F.floor(pos) + 1).alias("__k")),
                  F.struct(F.lit(1).alias("__role"), (F.ceil(pos) + 1).alias("__k"))))))
    fields = [*grp, "__i", "__d", "__role", "__k", "__n", "__lo", "__hi"]
    state = saved(_narrowed(hist, wanted, grp).select(*fields), "quantile-ranks")
    found = F.when(F.col("__k") == F.col("__n"), F.col("__hi")).otherwise(F.col("__lo"))
    open_ = (F.col("__lo") < F.col("__hi")) & (F.col("__k") > 1) & (F.col("__k") < F.col("__n"))
    scratch = [wide]
    while state.where(open_).limit(1).count():
        todo = state.where(open_).withColumnsRenamed({"__lo": "__from", "__hi": "__to", "__n": "__rows"})
        ranges = todo.select(*grp, "__from", "__to", "__rows").distinct()
        todo = todo.drop("__rows")
        part = (F.when(F.col("__rows") <= SPLITS, v)
                .otherwise(_part(v, F.col("__from"), F.col("__to")).cast("double")))
        rows = wide.select(*by, values()).where(F.col("__v").isNotNull() & ~F.isnan("__v"))
        hist = (rows.join(ranges, grp).where(F.col("__v").between(F.col("__from"), F.col("__to")))
                .groupBy(*grp, "__from", "__to", part.alias("__b")).agg(*counted))
        scratch.append(state)
        state = saved(state.where(~open_).unionByName(
            _narrowed(hist, todo, [*grp, "__from", "__to"]).select(*fields)), "quantile-ranks")
    q = (state.withColumn("__x", found).groupBy(*grp, "__i")
         .agg(F.max(F.when(F.col("__role") == 0, F.col("__x"))).alias("__lov"),
              F.max(F.when(F.col("__role") == 1, F.col("__x"))).alias("__hiv"), F.max("__d").alias("__d"))
         .withColumn("__q", F.when(F.col("__lov") == F.col("__hiv"), F.col("__lov"))
                     .otherwise(F.col("__lov") + (F.col("__hiv") - F.col("__lov")) * F.col("__d"))))
    out = saved(q.groupBy(*by).agg(*[
        F.max(F.when((F.col("__c") == j) & (F.col("__i") == i), F.col("__q"))).alias(f"{c}_q{_label(p)}")
        for j, c in enumerate(cols) for i, p in enumerate(spec[c])]), "quantiles")
    drop_scratch(*scratch, cells, state)
    return out


def _label(p: float) -> str:
    s = f"{p * 100:.6f}".rstrip("0").rstrip(".")
    return s.replace(".", "_")


def attach_scalars(df: DataFrame, stats: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Put global (or per-group) statistics on every row.

    Global statistics are one row, so broadcasting them is always safe; the
    nested-loop join against one row is a projection. Per-group statistics
    are an equi-join on the group key.
    """
    if not by:
        return df.crossJoin(F.broadcast(stats))
    return df.join(stats, on=list(by), how="left")


def cap_outliers_iqr(df: DataFrame, cols: Sequence[str], k: float = 1.5,
                     by: Sequence[str] = (), method: str = "count") -> DataFrame:
    """Clip each column to [Q1 − k·IQR, Q3 + k·IQR]; NULL stays NULL."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    q = quantiles(df, {c: (0.25, 0.75) for c in cols}, by=by, method=method)
    joined = attach_scalars(df, q, by)
    out = {}
    for c in cols:
        q1, q3 = F.col(f"{c}_q25"), F.col(f"{c}_q75")
        iqr = q3 - q1
        lo, hi = q1 - iqr * k, q3 + iqr * k
        x = F.col(c)
        out[c] = (F.when(x.isNull(), x)
                  .when(x < lo, lo).when(x > hi, hi).otherwise(x))
    drop = [n for c in cols for n in (f"{c}_q25", f"{c}_q75")]
    return joined.withColumns(out).drop(*drop)


# ------------------------------------------------------------------ A5–A14

DESCRIBE_STATS = ("count", "mean", "std", "min", "p25", "p50", "p75", "max")


def describe_stats(df: DataFrame, cols: Sequence[str], method: str = "count") -> DataFrame:
    """A5: count, mean, sample std, min, quartiles, max — one row per column.

    Moments come from one aggregation pass and quartiles from one
    ``quantiles`` call for all columns; the wide row is unpivoted with
    ``inline``.
    """
    aggs = []
    for c in cols:
        x = F.col(c)
        aggs += [F.count(x).cast("bigint").alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).cast("double").alias(f"{c}__min"),
                 F.max(x).cast("double").alias(f"{c}__max")]
    moments = df.agg(*aggs)
    qs = quantiles(df, {c: (0.25, 0.5, 0.75) for c in cols}, method=method)
    wide = moments.crossJoin(F.broadcast(qs))
    return wide.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"{c}__count").alias("count"),
        F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"),
        F.col(f"{c}__min").alias("min"), F.col(f"{c}_q25").alias("p25"),
        F.col(f"{c}_q50").alias("p50"), F.col(f"{c}_q75").alias("p75"),
        F.col(f"{c}__max").alias("max")) for c in cols])))


def value_distribution(df: DataFrame, col: str) -> DataFrame:
    """Count and percentage share per value, most frequent first.

    The counted rows are written once; the total and the shares read them, not the input.
    """
    counts = saved(df.groupBy(col).agg(F.count(F.lit(1)).alias("count")), "value-counts")
    total = counts.agg(F.sum("count").alias("__total"))
    return (attach_scalars(counts, total)
            .withColumn("share_pct", F.col("count") * 100.0 / F.col("__total"))
            .drop("__total")
            .orderBy(F.col("count").desc(), F.col(col).asc_nulls_last()))


def distinct_count(df: DataFrame, col: str, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Number of distinct values (HyperLogLog++ when ``approx``)."""
    f = F.approx_count_distinct(col, rsd) if approx else F.countDistinct(col)
    return df.agg(f.cast("bigint").alias(f"distinct_{col}"))


def group_profile(df: DataFrame, by: str | Sequence[str], cols: Sequence[str],
                  decimals: int | None = 2) -> DataFrame:
    """Mean and sample std per group, rounded half-even (``decimals=None``: unrounded)."""
    by = [by] if isinstance(by, str) else list(by)

    def rnd(c):
        return c if decimals is None else F.bround(c, decimals)

    aggs = []
    for c in cols:
        aggs.append(rnd(F.avg(c)).alias(f"{c}_mean"))
        aggs.append(rnd(F.stddev_samp(c)).alias(f"{c}_std"))
    return df.groupBy(*by).agg(*aggs)


def group_means_sorted(df: DataFrame, by: str, col: str) -> DataFrame:
    """Mean per group, largest first."""
    return (df.groupBy(by).agg(F.avg(col).alias(f"mean_{col}"))
            .orderBy(F.col(f"mean_{col}").desc(), F.col(by)))


def min_max(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Range endpoints of several columns in one pass."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return df.agg(*aggs)


def column_means(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean of each selected column."""
    return df.agg(*[F.avg(c).alias(f"{c}_mean") for c in cols])


def record_totals(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table plus the grand total (one count job per table)."""
    parts = [t.agg(F.count(F.lit(1)).alias("records")).withColumn("table_name", F.lit(n))
             for n, t in tables.items()]
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    return counts.select("table_name", "records")


def column_max(df: DataFrame, col: str) -> DataFrame:
    """High-water mark of a column."""
    return df.agg(F.max(col).alias(f"max_{col}"))
