"""Ranking, sorting and top-k.

``row_number_by`` and ``row_numbers`` number rows in a total order (optionally
within groups) without pulling everything into one task, which is what an
un-partitioned ``row_number() OVER (ORDER BY …)`` does, and without a single hot
group landing in one task for the per-group form:

1. range-partition on the order keys into parts of about a million rows, sort
   within them and write the rows with their part and place: range bounds come
   from a sample, so a recomputation could move rows, the written table can't;
2. one table of row counts by part and group, which combines before its
   shuffle, gives through a window over parts the number of rows of the same
   group in earlier parts;
3. that offset plus the place among the own part's rows is the row number.

Top-k uses ``orderBy().limit()`` (TakeOrderedAndProject: a per-partition
heap, never a full sort) and ``row_number() <= k`` per group, which Spark
turns into a partial WindowGroupLimit before the shuffle, so a hot group
ships at most k rows per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import saved

# Rows of a range partition; the number of partitions follows from the row count alone.
ROWS_PER_RANGE_PARTITION = 1_000_000


def _sort_cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]


def range_sorted(df: DataFrame, keys: list[Column], n: int | None, written: bool = False) -> DataFrame:
    """Rows with their range partition ``__pid`` and their place ``__pos`` in it, written once.

    ``written`` says that ``df`` is little work on a written table, which then is read instead of a copy.
    """
    base = df if written else saved(df, "rank-input")
    n = n or max(1, -(-base.count() // ROWS_PER_RANGE_PARTITION))
    pid = F.spark_partition_id()
    return saved(base.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                 .withColumns({"__pid": pid, "__pos": F.monotonically_increasing_id()
                               - F.shiftleft(pid.cast("long"), 33)}), "ranked")


def row_number_by(df: DataFrame, order: Sequence[Column | str], partition_by: Sequence[str] = (),
                  name: str = "row_number", num_partitions: int | None = None, size: str | None = None,
                  written: bool = False) -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY … ORDER BY …) computed across many tasks.

    ``order`` must end in a unique key so the numbering is deterministic. ``size`` names a column for the group's number
    of rows; ``written`` is that of :func:`range_sorted`. What is returned reads the rows' own written table.
    """
    keys = [F.col(c).asc_nulls_first() for c in partition_by] + _sort_cols(order)
    rows = range_sorted(df, keys, num_partitions, written)
    gcols = [f"__g{i}" for i in range(len(partition_by))]
    counts = rows.groupBy(F.col("__pid").alias("__opid"), *[F.col(c).alias(g) for c, g in zip(partition_by, gcols)]) \
                 .agg(F.count(F.lit(1)).alias("__n"), F.min("__pos").alias("__first"))
    before = Window.partitionBy(*gcols).orderBy("__opid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumns({"__off": F.coalesce(F.sum("__n").over(before), F.lit(0)),
                                  size or "__size": F.sum("__n").over(Window.partitionBy(*gcols))})
    # a few rows for each part, written: their size is known where they are joined
    offsets = saved(offsets.drop("__n", *([] if size else ["__size"])), "rank-counts")
    cond = F.col("__pid") == F.col("__opid")
    for c, g in zip(partition_by, gcols):
        cond = cond & F.col(c).eqNullSafe(F.col(g))
    numbered = rows.join(offsets, cond).withColumn(
        name, (F.col("__off") + F.col("__pos") - F.col("__first") + 1).cast("bigint"))
    numbered = numbered.drop("__pid", "__opid", "__pos", "__off", "__first", *gcols)
    numbered._reads = (rows, offsets)
    return numbered


def row_numbers(df: DataFrame, order: Sequence[Column | str],
                groupings: dict[str, Sequence[str]], num_partitions: int | None = None) -> DataFrame:
    """Several ROW_NUMBER columns sharing one ORDER BY, from ONE range partitioning.

    ``groupings`` maps an output name to its PARTITION BY columns (empty for
    the global number). One table of counts by part and all group columns
    gives every offset; one hash shuffle on the part serves all group windows,
    none of which holds more than a part's rows, so a group with a third of the
    data is still spread over every part.
    """
    rows = range_sorted(df, _sort_cols(order), num_partitions)
    every = list(dict.fromkeys(c for groups in groupings.values() for c in groups))
    counts = saved(rows.groupBy("__pid", *every).agg(F.count(F.lit(1)).alias("__n")), "rank-counts")
    out = rows.repartition("__pid") if every else rows
    for name, groups in groupings.items():
        local = F.row_number().over(Window.partitionBy("__pid", *groups).orderBy("__pos")) if groups else F.col("__pos") + 1
        out = out.withColumn(f"__l_{name}", local)
    drop = ["__pid", "__pos"]
    for i, (name, groups) in enumerate(groupings.items()):
        gcols = [f"__g{i}_{j}" for j in range(len(groups))]
        per = counts.groupBy(F.col("__pid").alias(f"__p{i}"), *[F.col(c).alias(g) for c, g in zip(groups, gcols)]) \
                    .agg(F.sum("__n").alias("__n"))
        before = Window.partitionBy(*gcols).orderBy(f"__p{i}").rowsBetween(Window.unboundedPreceding, -1)
        offsets = per.withColumn(f"__off{i}", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
        cond = F.col("__pid") == F.col(f"__p{i}")
        for c, g in zip(groups, gcols):
            cond = cond & F.col(c).eqNullSafe(F.col(g))
        out = out.join(offsets, cond).withColumn(name, (F.col(f"__off{i}") + F.col(f"__l_{name}")).cast("bigint"))
        drop += [f"__p{i}", f"__off{i}", f"__l_{name}", *gcols]
    return out.drop(*drop)


def top_n(df: DataFrame, by: str, n: int = 10, cols: Sequence[str] | None = None,
          tiebreak: Sequence[str] = ("player_id",)) -> DataFrame:
    """The n largest values of ``by``; missing values excluded, ties by key."""
    out = df.where(F.col(by).isNotNull() & ~F.isnan(F.col(by)))
    order = [F.col(by).desc()] + [F.col(c).asc() for c in tiebreak if c in df.columns]
    out = out.orderBy(*order).limit(n)
    return out.select(*cols) if cols else out


def top_n_per_group(df: DataFrame, group: str | Sequence[str], by: str, n: int = 3,
                    tiebreak: Sequence[str] = ("player_id",), name: str = "group_rank") -> DataFrame:
    """T4: leaders per group; the row-number filter becomes a WindowGroupLimit."""
    group = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*group).orderBy(F.col(by).desc_nulls_last(),
                                           *[F.col(c).asc() for c in tiebreak])
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n) \
             .withColumn(name, F.col(name).cast("bigint"))


def sample_rows(df: DataFrame, n: int = 2, order: Sequence[str] = ()) -> DataFrame:
    """T5: a preview of n rows, the first by ``order`` if given."""
    return (df.orderBy(*order) if order else df).limit(n)
