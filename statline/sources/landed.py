"""Landed files, freshness and incremental extraction.

Everything filters with ordinary predicates: a season list or a high-water
mark turned into a literal reaches the Parquet scan as a pushed filter or
prunes ``season=`` partitions, so only new or requested data is read.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import DEFAULT_AS_OF, as_of_literal

# The default seasons of a historical backfill.
DEFAULT_SEASONS = ("2021-22", "2022-23", "2023-24")


def landed_name(table: str, season: str) -> str:
    """``players`` + ``2023-24`` → ``players_2023_24`` (the landing file stem)."""
    return f"{table}_{season.replace('-', '_')}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of the path (HDFS, S3, local…)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def read_landed_csv(spark: SparkSession, base: str, table: str, season: str,
                    schema: T.StructType) -> DataFrame | None:
    """A landed CSV table with an explicit schema, or ``None`` when it was never landed."""
    path = f"{base.rstrip('/')}/{landed_name(table, season)}"
    if not path_exists(spark, path):
        return None
    return spark.read.schema(schema).option("header", True).csv(path)


def freshness_gate(manifest: DataFrame, lookback_days: int = 7,
                   as_of: str | _dt.datetime = DEFAULT_AS_OF, key: str = "season",
                   ts: str = "timestamp") -> DataFrame:
    """Per key, the last landing time and whether a full refresh is due.

    Due when the newest landing is at least ``lookback_days`` old (keys with
    no landing at all are due by definition and simply absent here).
    """
    now = as_of_literal(as_of)
    last = manifest.groupBy(key).agg(F.max(ts).alias("last_update"))
    age = F.expr("timestampdiff(MICROSECOND, last_update, __now)") / 86400000000.0
    return (last.withColumn("__now", now)
            .withColumn("refresh_due", F.coalesce(age >= lookback_days, F.lit(True)))
            .drop("__now"))


def incremental_delta(src: DataFrame, target: DataFrame | None, key: str = "data_loaded_at",
                      lookback: str | None = None,
                      floor: str = "0001-01-01 00:00:00") -> DataFrame:
    """S8 + J4: rows of ``src`` newer than the target's high-water mark.

    The mark is read first, as one value, so that the filter is a literal and
    reaches the scan (an empty or missing target gives ``floor``, so the first
    run loads everything). ``lookback`` (e.g. ``'7 days'``) re-reads a trailing
    window to pick up late arrivals; the upsert that follows makes the overlap
    idempotent.
    """
    if target is None:
        return src
    hwm = F.coalesce(F.max(key), F.to_timestamp_ntz(F.lit(floor)))
    if lookback:
        hwm = hwm - F.expr(f"INTERVAL {lookback}")
    kind = src.schema[key].dataType.simpleString()
    mark = target.agg(hwm.cast("string")).first()[0]
    return src.where(F.col(key) > F.lit(mark).cast(kind))


def season_backfill(df: DataFrame, seasons: Sequence[str] = DEFAULT_SEASONS,
                    col: str = "season") -> DataFrame:
    """Restrict to the seasons of a backfill (partition pruning on ``season=``)."""
    return df.where(F.col(col).isin(*seasons))


def files_state(spark: SparkSession, path: str) -> str:
    """A digest of names, sizes and times of all files under ``path``; it changes when one is written, rewritten or removed.

    Spark lists the files and folds them; their content isn't read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    one = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    n, total = files.select(one.alias("h")).agg(F.count("*"), F.sum("h")).first()
    return f"{n}-{total or 0}"
