"""Sinks and table layout (K1–K8).

Writers never pass data through the driver. The partitioned writer
range-partitions on (partition column, cluster keys) before writing, so one
large season is spread over many tasks and files, and each file is sorted by
the cluster keys so Parquet min/max statistics prune row groups on reads.

``upsert`` replaces MERGE for plain Parquet tables: the latest version per
key is picked with ``max_by`` — an aggregate, so every map task first keeps
only its own latest row per key and a key repeated across a third of the
input still ships one row per task — and only the partitions that hold or
get a row of the delta's keys are overwritten (dynamic partition overwrite).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import DEFAULT_AS_OF, as_of_literal
from ..session import drop_scratch, saved
from ..sources.landed import landed_name, path_exists


def write_csv(df: DataFrame, base: str, table: str, season: str) -> str:
    """K1: header row, no index; folder ``{table}_{YYYY_YY}``."""
    path = f"{base.rstrip('/')}/{landed_name(table, season)}"
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_snapshot(df: DataFrame, base: str, table: str,
                   run_ts: str | _dt.datetime = DEFAULT_AS_OF) -> str:
    """K2: timestamped processed copy, one ``run_ts=`` partition per run."""
    path = f"{base.rstrip('/')}/{table}"
    stamp = run_ts.strftime("%Y%m%dT%H%M%S") if isinstance(run_ts, _dt.datetime) else \
        run_ts.replace("-", "").replace(":", "").replace(" ", "T")
    (df.withColumn("run_ts", F.lit(stamp)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run_ts").parquet(path))
    return path


def write_truncate(df: DataFrame, path: str) -> str:
    """K3: replace the table's contents (creates it when absent)."""
    df.write.mode("overwrite").parquet(path)
    return path


#: Rows of one range part of a rebuilt table.
ROWS_PER_FILE = 1_000_000


def materialize_table(df: DataFrame, path: str, partition_by: Sequence[str] = ("season",),
                      cluster_by: Sequence[str] = ("player_id", "team_id"),
                      num_partitions: int | None = None, mode: str = "overwrite") -> str:
    """K4: full rebuild, partitioned by season and clustered by the given keys; files follow from the row count."""
    cluster = [c for c in cluster_by if c in df.columns]
    keys = list(partition_by) + cluster
    rows = saved(df, "clustered")
    n = num_partitions or max(1, -(-rows.count() // ROWS_PER_FILE))
    out = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    out.write.mode(mode).partitionBy(*partition_by).parquet(path)
    drop_scratch(rows)
    return path


def latest_per_key(df: DataFrame, unique_key: Sequence[str], order_key: Sequence[str]) -> DataFrame:
    """Newest row per key (ties broken by the later order keys), as an aggregate."""
    others = [c for c in df.columns if c not in unique_key]
    order = F.struct(*[F.col(c) for c in order_key])
    picked = df.groupBy(*unique_key).agg(
        F.max_by(F.struct(*[F.col(c) for c in others]), order).alias("__v"))
    return picked.select(*unique_key, *[F.col("__v")[c].alias(c) for c in others]) \
        .select(*df.columns)


def rows_of_keys(df: DataFrame, keys: DataFrame, unique_key: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is one of ``keys``; null keys are equal, as in :func:`latest_per_key`."""
    asked = keys.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(unique_key)]).distinct()
    same = [df[c].eqNullSafe(asked[f"__k{i}"]) for i, c in enumerate(unique_key)]
    return df.join(asked, same, "left_semi")


def _partition_filter(rows: Sequence, partition_by: Sequence[str]) -> Column:
    """Literal predicate for a list of partition values, which prunes the scan's folders."""
    if len(partition_by) == 1:
        c, values = partition_by[0], [r[0] for r in rows]
        known = F.col(c).isin([v for v in values if v is not None])
        return known | F.col(c).isNull() if None in values else known
    out = F.lit(False)
    for r in rows:
        one = F.lit(True)
        for c in partition_by:
            one = one & F.col(c).eqNullSafe(F.lit(r[c]))
        out = out | one
    return out


def _drop_partitions(spark: SparkSession, path: str, rows: Sequence, partition_by: Sequence[str]) -> None:
    jvm = spark.sparkContext._jvm
    utils = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for r in rows:
        folder = "/".join([path.rstrip("/"), *[
            f"{utils.escapePathName(c)}=" + (utils.DEFAULT_PARTITION_NAME() if r[c] is None else utils.escapePathName(str(r[c])))
            for c in partition_by]])
        target = jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def upsert(spark: SparkSession, delta: DataFrame, path: str, unique_key: Sequence[str],
           order_key: Sequence[str], partition_by: Sequence[str] = ()) -> str:
    """K5: merge ``delta`` into the Parquet table at ``path`` (created when absent).

    Rewritten are the partitions that the delta has rows for and, where the
    partition is not part of the key, those that now hold one of its keys, so
    a key whose newest version moves leaves no stale row behind. Their list
    (at most one row for each folder of the table) prunes the target's scan.
    The merged rows are written to the shared folder first, so the job never
    reads what it replaces; Spark's commit then swaps the folders, and a run
    that fails before it can be repeated with the same delta.
    """
    touched = []
    delta = saved(delta, "delta")
    if not path_exists(spark, path):
        merged = latest_per_key(delta, unique_key, order_key)
    else:
        target = spark.read.schema(delta.schema).parquet(path)
        if partition_by:
            parts = delta.select(*partition_by)
            if not set(partition_by) <= set(unique_key):
                moved = rows_of_keys(target.select(*dict.fromkeys([*unique_key, *partition_by])), delta, unique_key)
                parts = parts.unionByName(moved.select(*partition_by))
            touched = parts.distinct().collect()
            target = target.where(_partition_filter(touched, partition_by))
        merged = latest_per_key(target.unionByName(delta), unique_key, order_key)
    merged = saved(merged, "merged")
    w = merged.write.mode("overwrite")
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.parquet(path)
    if touched:
        left = {tuple(r) for r in merged.select(*partition_by).distinct().collect()}
        _drop_partitions(spark, path, [r for r in touched if tuple(r) not in left], partition_by)
    drop_scratch(delta, merged)
    return path


def write_manifest(spark: SparkSession, path: str, season: str, records: int,
                   as_of: str | _dt.datetime = DEFAULT_AS_OF) -> None:
    """K6: append one (season, timestamp, records_extracted) row."""
    row = spark.range(1).select(F.lit(season).alias("season"), as_of_literal(as_of).alias("timestamp"),
                                F.lit(int(records)).cast("bigint").alias("records_extracted"))
    row.write.mode("append").parquet(path)


def run_report(spark: SparkSession, stages: Sequence[Mapping]) -> DataFrame:
    """K7: one row per (stage, table) with status, record count and seconds."""
    schema = ("stage string, table_name string, status string, records bigint, "
              "seconds double, error string")
    rows = [(s.get("stage"), s.get("table_name"), s.get("status", "success"),
             s.get("records"), s.get("seconds"), s.get("error")) for s in stages]
    return spark.createDataFrame(rows, schema)


def annotate(df: DataFrame, descriptions: Mapping[str, str]) -> DataFrame:
    """K8: column descriptions as field metadata (written into Parquet/catalog schemas)."""
    for c, text in descriptions.items():
        if c in df.columns:
            df = df.withMetadata(c, {"comment": text})
    return df
