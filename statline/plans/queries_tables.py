"""Registered queries: versioned tables with a key index (K3–K5, K8, X1) and bounded de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sinks import versioned
from ..streaming import stage
from .catalog import fx, register, with_fixtures
from .queries_io import CUTOFF, LATEST_SQL, UPSERT_KEY, UPSERT_ORDER, text_dates

#: Overlapping deltas, in order of arrival.
_DELTAS = ((None, "2024-01-10"), ("2024-01-08", "2024-01-20"), ("2024-01-15", None))


def _between(df, low, high):
    at = lambda day: F.to_timestamp_ntz(F.lit(f"{day} 00:00:00"))
    if low:
        df = df.where(F.col("data_loaded_at") >= at(low))
    return df.where(F.col("data_loaded_at") < at(high)) if high else df


def _versions(spark, d):
    """Three deltas whose keys move between days: three versions."""
    arr, path = fx(spark, d).arrivals, scratch_path(spark, "versioned")
    for low, high in _DELTAS:
        versioned.upsert(spark, _between(arr, low, high), path, UPSERT_KEY, UPSERT_ORDER, ("load_day",))
    return path, arr.columns


def _upsert_as_of(spark, d):
    """K5: the second and the third version of one table, read side by side."""
    path, cols = _versions(spark, d)
    parts = [text_dates(versioned.read(spark, path, v).select(*cols)).withColumn("version", F.lit(v).cast("long")) for v in (2, 3)]
    return parts[0].unionByName(parts[1])


register("upsert_as_of", with_fixtures(f"""
SELECT event_id, player_id, team_name, pts, data_loaded_at, CAST(load_day AS VARCHAR) AS load_day, version FROM (
  SELECT *, row_number() OVER (PARTITION BY version, player_id, team_name ORDER BY data_loaded_at DESC, event_id DESC) AS rn
  FROM arrivals JOIN (SELECT CAST(2 AS BIGINT) AS version, TIMESTAMP '{CUTOFF}' AS before_at
                      UNION ALL SELECT 3, TIMESTAMP '9999-01-01 00:00:00') ON data_loaded_at < before_at)
WHERE rn = 1""", "arrivals"))(_upsert_as_of)


def _history(spark, d):
    path, _ = _versions(spark, d)
    return versioned.history(spark, path).select("version", "operation", "rows")


register("table_history", with_fixtures("""
SELECT version, 'upsert' AS operation, count(DISTINCT (player_id, team_name)) AS rows
FROM arrivals JOIN (SELECT CAST(1 AS BIGINT) AS version, TIMESTAMP '2024-01-10 00:00:00' AS before_at
  UNION ALL SELECT 2, TIMESTAMP '2024-01-20 00:00:00' UNION ALL SELECT 3, TIMESTAMP '9999-01-01 00:00:00')
  ON data_loaded_at < before_at GROUP BY version""", "arrivals"))(_history)


def _one_day(spark, d):
    """K4: a rebuilt table, of which only the folder of one day is opened."""
    arr, path = fx(spark, d).arrivals, scratch_path(spark, "versioned")
    versioned.create(spark, arr, path, ("event_id",), ("load_day",), comment="All arrivals")
    return text_dates(versioned.read(spark, path, partitions={"load_day": ["2024-01-12"]}))


register("table_one_day", with_fixtures(
    "SELECT * REPLACE (CAST(load_day AS VARCHAR) AS load_day) FROM arrivals WHERE load_day = DATE '2024-01-12'", "arrivals"))(_one_day)

# Comments and properties of the game-log table.
POINTS_COMMENT = "Points scored in the game"
TABLE_COMMENT = "Game-level box scores, one row for each player and game"
TABLE_PROPERTIES = {"owner": "analytics", "domain": "sports", "freshness": "daily"}


def _options(spark, d):
    """K8: the options that a table was given, and how many rows it holds under them."""
    logs, path = fx(spark, d).game_logs, scratch_path(spark, "versioned")
    versioned.create(spark, logs.select("player_id", "pts", "reb"), path, ("player_id",), buckets=8)
    versioned.set_options(spark, path, TABLE_COMMENT, TABLE_PROPERTIES, {"pts": POINTS_COMMENT})
    return versioned.table_options(spark, path).crossJoin(versioned.read(spark, path).agg(F.count(F.lit(1)).alias("rows")))


register("table_options", with_fixtures(
    "SELECT o.*, n AS rows FROM (SELECT count(*) AS n FROM game_logs) CROSS JOIN (VALUES "
    f"('comment', '', '{TABLE_COMMENT}'), " + ", ".join(f"('property', '{k}', '{v}')" for k, v in TABLE_PROPERTIES.items())
    + f", ('column', 'pts', '{POINTS_COMMENT}')) o(kind, name, text)", "game_logs"))(_options)


def _stream_versions(spark, d):
    """A stream that publishes one version of its table for each micro-batch."""
    arr, base = fx(spark, d).arrivals, scratch_path(spark, "stream")
    arr.write.partitionBy("load_day").parquet(f"{base}/landing")
    schema = spark.read.parquet(f"{base}/landing").schema
    stage.stage_stream(spark, f"{base}/landing", schema, f"{base}/target", f"{base}/_checkpoint", UPSERT_KEY, UPSERT_ORDER,
                       max_files_per_trigger=12, buckets=16, as_versions=True)
    return text_dates(versioned.read(spark, f"{base}/target").select(*arr.columns))


register("stream_upsert_versions", LATEST_SQL)(_stream_versions)

#: Drains of the watermark stream: a new stretch of time each, with a replay of the last day of the one before.
_DRAINS = ((None, "2024-01-10"), ("2024-01-09", "2024-01-20"), ("2024-01-19", None))


def _bounded(spark, d):
    """Stretches of time land one after another, each with the last day again; then the first once more, all late."""
    arr, base = fx(spark, d).arrivals.drop("load_day"), scratch_path(spark, "bounded")
    for i, (low, high) in enumerate((*_DRAINS, _DRAINS[0])):
        _between(arr, low, high).repartition(2).write.parquet(f"{base}/landing/part{i}")
        stage.dedup_stream_watermark(spark, f"{base}/landing/*", arr.schema, f"{base}/out", f"{base}/_checkpoint",
                                     ("event_id",), "data_loaded_at", "2 days")
    return base, arr


def _dedup_watermark(spark, d):
    base, arr = _bounded(spark, d)
    return spark.read.parquet(f"{base}/out").select(*arr.columns)


register("stream_dedup_watermark", with_fixtures(
    "SELECT event_id, player_id, team_name, pts, data_loaded_at FROM arrivals", "arrivals"))(_dedup_watermark)


def _late_rows(spark, d):
    """What came behind the watermark is counted: the last replay of the first stretch."""
    base, _ = _bounded(spark, d)
    return spark.read.parquet(f"{base}/out_progress").agg(F.sum("late_rows").alias("late_rows"), F.sum("input_rows").alias("input_rows"))


register("stream_late_rows", with_fixtures("""
SELECT CAST(count(*) FILTER (data_loaded_at < TIMESTAMP '2024-01-10 00:00:00') AS BIGINT) AS late_rows,
  CAST(count(*) + count(*) FILTER (data_loaded_at < TIMESTAMP '2024-01-10 00:00:00')
    + count(*) FILTER (data_loaded_at >= TIMESTAMP '2024-01-09 00:00:00' AND data_loaded_at < TIMESTAMP '2024-01-10 00:00:00')
    + count(*) FILTER (data_loaded_at >= TIMESTAMP '2024-01-19 00:00:00' AND data_loaded_at < TIMESTAMP '2024-01-20 00:00:00') AS BIGINT) AS input_rows
FROM arrivals""", "arrivals"))(_late_rows)
