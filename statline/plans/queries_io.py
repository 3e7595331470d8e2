"""Registered queries: payload decoding, landed files, incremental loads, upserts,
streaming staging and the ETL run (S1–S9, K1–K7, X1, X2, R1).

Each query writes what it needs under the session's shared checkpoint folder
(a fresh path per call), reads it back with Spark and returns the result;
every input is derived by Spark from the whole test tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import clean
from ..session import drop_scratch, saved, scratch_path
from ..sinks import writers
from ..sources import landed, payload
from ..streaming import stage
from . import etl, mart
from .catalog import AS_OF, AS_OF_SQL, fx, register, trim_sql, with_fixtures
from .queries_mart import PERF_FIXTURES, STAGED_PLAYERS_SQL, performance_sql

def text_dates(df):
    """DATE columns as ISO text in query results (clients convert DATE differently)."""
    return df.withColumns({f.name: F.col(f.name).cast("string") for f in df.schema.fields
                           if isinstance(f.dataType, T.DateType)})


GAME_COLS = ("player_id", "game_date", "wl", "minutes", "fgm", "fga", "fg3m", "fg3a", "ftm", "fta",
             "reb", "ast", "stl", "blk", "tov", "pts", "plus_minus")


def game_log_documents(game_logs, month=None):
    """Inverse of S2 for landing test data: one document per player-season.

    A document holds the games of one player in one calendar month of one
    season — a group bounded by the schedule, never by the data volume.
    """
    cells = []
    by_pos = {i: (n, t) for i, n, t in payload.GAME_LOG_LAYOUT}
    for i in range(25):
        if i in by_pos:
            n, t = by_pos[i]
            cells.append(F.col(n).cast("string") if n in game_logs.columns else F.lit(None).cast("string"))
        else:
            cells.append(F.lit(None).cast("string"))
    row = F.array(*cells)
    season = F.col("season") if "season" in game_logs.columns else F.lit(None).cast("string")
    if month is None:
        month = F.date_trunc("month", F.col("game_date")) if "game_date" in game_logs.columns else F.lit(None)
    return (game_logs.withColumn("__row", row).withColumn("__season", season)
            .groupBy("player_id", "__season", month.alias("__month"))
            .agg(F.collect_list("__row").alias("rowSet"))
            .select(F.create_map(F.lit("PlayerID"), F.col("player_id").cast("string"),
                                 F.lit("Season"), F.col("__season")).alias("parameters"),
                    F.array(F.struct(F.lit("PlayerGameLog").alias("name"),
                                     F.lit(None).cast("array<string>").alias("headers"),
                                     F.col("rowSet").alias("rowSet"))).alias("resultSets")))


def _decode_payload(spark, d):
    """Land game logs as positional JSON payloads, read them back and decode."""
    logs = clean.stage_game_logs(fx(spark, d).games_by_player)
    path = scratch_path(spark, "payload")
    game_log_documents(logs).write.json(path, compression="gzip")
    decoded = payload.decode_game_logs(payload.read_payloads(spark, path))
    # dates leave as ISO text so every client reads the same value
    return decoded.select(*GAME_COLS).withColumn("game_date", F.col("game_date").cast("string"))


register("decode_payload", with_fixtures(
    "SELECT * REPLACE (CAST(game_date AS VARCHAR) AS game_date) "
    f"FROM (SELECT {', '.join(GAME_COLS)} FROM game_logs)", "game_logs"))(_decode_payload)


def _land_roster(players, base):
    """Rosters as payload documents, one per season, team and hundred players."""
    cells = {0: "player_id", 1: "is_active", 2: "player_name", 7: "team_id", 8: "team_name"}
    row = F.array(*[F.col(cells[i]).cast("string") if i in cells else F.lit(None).cast("string")
                    for i in range(9)])
    docs = (players.withColumn("__row", row)
            .groupBy("season", "team_id", F.floor(F.col("player_id") / 100).alias("__chunk"))
            .agg(F.collect_list("__row").alias("rowSet"))
            .select("season", F.create_map(F.lit("Season"), F.col("season")).alias("parameters"),
                    F.array(F.struct(F.lit("CommonAllPlayers").alias("name"),
                                     F.lit(None).cast("array<string>").alias("headers"),
                                     F.col("rowSet").alias("rowSet"))).alias("resultSets")))
    docs.write.partitionBy("season").json(f"{base}/endpoint=commonallplayers")


def _decode_roster(spark, d):
    """Land roster payloads under endpoint=/season= folders, backfill-read them."""
    base = scratch_path(spark, "roster")
    _land_roster(fx(spark, d).players, base)
    schema = T.StructType(payload.PAYLOAD_SCHEMA.fields + [T.StructField("season", T.StringType())])
    raw = spark.read.schema(schema).json(f"{base}/endpoint=commonallplayers")
    return payload.decode_players(landed.season_backfill(raw, ("2000-01",)))


register("decode_roster", with_fixtures(
    "SELECT player_id, player_name, team_id, team_name, season, CAST(is_active AS INTEGER) AS is_active "
    "FROM players WHERE season IN ('2000-01')", "players"))(_decode_roster)


def _csv_roundtrip(spark, d):
    """K1 + S5: staged roster written as landed CSV and read back with its schema."""
    staged = clean.stage_players(fx(spark, d).players, as_of=AS_OF)
    base = scratch_path(spark, "csv")
    writers.write_csv(staged, base, "players", "2000-01")
    return landed.read_landed_csv(spark, base, "players", "2000-01", staged.schema)


register("csv_roundtrip", with_fixtures(
    f"WITH {STAGED_PLAYERS_SQL}\nSELECT * FROM staged_players", "players"))(_csv_roundtrip)

FRESH_AS_OF = "2024-01-28 00:00:00"

register("freshness_due", with_fixtures(f"""
SELECT team_name, max(data_loaded_at) AS last_update,
  coalesce(date_diff('microsecond', max(data_loaded_at), TIMESTAMP '{FRESH_AS_OF}') / 86400000000.0E0 >= 7,
           true) AS refresh_due
FROM arrivals GROUP BY team_name""", "arrivals"))(
    lambda spark, d: landed.freshness_gate(fx(spark, d).arrivals, 7, FRESH_AS_OF, key="team_name",
                                           ts="data_loaded_at"))

CUTOFF = "2024-01-20 00:00:00"


def _delta(spark, d):
    arr = fx(spark, d).arrivals
    loaded = arr.where(F.col("data_loaded_at") < F.to_timestamp_ntz(F.lit(CUTOFF)))
    return text_dates(landed.incremental_delta(arr, loaded, "data_loaded_at"))


register("delta_rows", with_fixtures(f"""
SELECT * REPLACE (CAST(load_day AS VARCHAR) AS load_day) FROM arrivals WHERE data_loaded_at >
  (SELECT coalesce(max(data_loaded_at), TIMESTAMP '0001-01-01 00:00:00') FROM arrivals
   WHERE data_loaded_at < TIMESTAMP '{CUTOFF}')""", "arrivals"))(_delta)

LATEST_SQL = with_fixtures("""
SELECT event_id, player_id, team_name, pts, data_loaded_at, CAST(load_day AS VARCHAR) AS load_day FROM (
  SELECT *, row_number() OVER (PARTITION BY player_id, team_name
                               ORDER BY data_loaded_at DESC, event_id DESC) AS rn FROM arrivals)
WHERE rn = 1""", "arrivals")
UPSERT_KEY = ("player_id", "team_name")
UPSERT_ORDER = ("data_loaded_at", "event_id")


def _upsert(spark, d):
    """K3/K5: load the older part, then upsert an overlapping newer part."""
    arr = fx(spark, d).arrivals
    path = scratch_path(spark, "upsert")
    old = arr.where(F.col("data_loaded_at") < F.to_timestamp_ntz(F.lit(CUTOFF)))
    new = arr.where(F.col("data_loaded_at") >= F.to_timestamp_ntz(F.lit("2024-01-15 00:00:00")))
    writers.upsert(spark, old, path, UPSERT_KEY, UPSERT_ORDER, partition_by=("team_name",))
    writers.upsert(spark, new, path, UPSERT_KEY, UPSERT_ORDER, partition_by=("team_name",))
    return text_dates(spark.read.parquet(path).select(*arr.columns))


register("upsert_latest", LATEST_SQL)(_upsert)


def _upsert_moved(spark, d):
    """K5: the day is the partition but not part of the key, so newer versions move between folders."""
    arr = fx(spark, d).arrivals
    path = scratch_path(spark, "upsert")
    for low, high in ((None, "2024-01-10"), ("2024-01-08", CUTOFF), ("2024-01-15", None)):
        part = arr
        if low:
            part = part.where(F.col("data_loaded_at") >= F.to_timestamp_ntz(F.lit(f"{low[:10]} 00:00:00")))
        if high:
            part = part.where(F.col("data_loaded_at") < F.to_timestamp_ntz(F.lit(f"{high[:10]} 00:00:00")))
        writers.upsert(spark, part, path, UPSERT_KEY, UPSERT_ORDER, partition_by=("load_day",))
    return text_dates(spark.read.parquet(path).select(*arr.columns))


register("upsert_moved", LATEST_SQL)(_upsert_moved)


def _stream_upsert(spark, d):
    """Day files land; a streaming job drains them in micro-batches into the table."""
    arr = fx(spark, d).arrivals
    base = scratch_path(spark, "stream")
    arr.write.partitionBy("load_day").parquet(f"{base}/landing")
    schema = spark.read.parquet(f"{base}/landing").schema
    stage.stage_stream(spark, f"{base}/landing", schema, f"{base}/target", f"{base}/_checkpoint",
                       UPSERT_KEY, UPSERT_ORDER, max_files_per_trigger=8, buckets=16)
    return text_dates(spark.read.parquet(f"{base}/target").select(*arr.columns))


register("stream_upsert", LATEST_SQL)(_stream_upsert)


def _stream_dedup(spark, d):
    """The newest days land first, older ones later, then all again; several triggers each."""
    arr = fx(spark, d).arrivals.drop("load_day")
    base = scratch_path(spark, "dedup")
    at = lambda day: F.to_timestamp_ntz(F.lit(f"{day} 00:00:00"))
    ts = F.col("data_loaded_at")
    args = (spark, f"{base}/landing/*", arr.schema, f"{base}/out", f"{base}/_checkpoint",
            ("event_id",), "data_loaded_at", "7 days")
    parts = {"newest": ts >= at("2024-01-20"), "middle": (ts >= at("2024-01-10")) & (ts < at("2024-01-20")),
             "oldest": ts < at("2024-01-10")}
    for name, days in parts.items():
        arr.where(days).repartition(2).write.parquet(f"{base}/landing/{name}")
        stage.dedup_stream(*args, max_files_per_trigger=1)
    arr.repartition(2).write.parquet(f"{base}/landing/replay")
    stage.dedup_stream(*args, max_files_per_trigger=1)
    return spark.read.schema(arr.schema).parquet(f"{base}/out").select(*arr.columns)


register("stream_dedup", with_fixtures(
    "SELECT event_id, player_id, team_name, pts, data_loaded_at FROM arrivals", "arrivals"))(
    _stream_dedup)

BACKFILL = ("1996-97", "1997-98", "1998-99")


def _backfill(spark, d):
    """K4 + S9: season-partitioned, clustered table; a backfill reads three seasons."""
    perf = mart.player_performance(fx(spark, d).players, fx(spark, d).game_logs,
                                   fx(spark, d).advanced_stats, as_of=AS_OF)
    path = scratch_path(spark, "perf")
    writers.materialize_table(perf, path, ("season",), ("player_id", "team_id"))
    out = landed.season_backfill(spark.read.parquet(path), BACKFILL)
    return out.select(*mart.PERFORMANCE_COLUMNS)


register("season_backfill", with_fixtures(
    performance_sql("season") + f"\nSELECT * FROM perf WHERE season IN {BACKFILL!r}",
    *PERF_FIXTURES))(_backfill)


def _etl(spark, d, times):
    """One folder, one run of the ETL for each point in time; (folder, reports). The source tables are built once."""
    f, out = fx(spark, d), scratch_path(spark, "etl")
    raw = {"players": f.players, "advanced_stats": saved(f.advanced_stats, "source")}
    reports = [etl.run_etl(spark, raw, etl.ETLConfig(output_dir=out, as_of=t)) for t in times]
    drop_scratch(raw["advanced_stats"])
    return out, reports


ETL_TIMES = {"first": "2024-01-01 00:00:00", "within": "2024-01-05 00:00:00", "after": "2024-01-09 00:00:00"}


def _etl_run(spark, d):
    """First run, a run within the look-back that extracts nothing, and a refresh after it."""
    _, reports = _etl(spark, d, ETL_TIMES.values())
    out = None
    for name, r in zip(ETL_TIMES, reports):
        r = r.select(F.lit(name).alias("run"), "stage", "table_name", "status", "records")
        out = r if out is None else out.unionByName(r)
    return out


register("etl_run", with_fixtures("""
SELECT r.run, s.stage, t.table_name,
  CASE WHEN s.stage <> 'extract' THEN 'success' WHEN r.run = 'within' THEN 'reused' ELSE 'landed' END AS status, t.records
FROM (SELECT 'players' AS table_name, count(*) AS records FROM players
      UNION ALL SELECT 'advanced_stats', count(*) FROM advanced_stats) t
CROSS JOIN (SELECT unnest(['extract', 'transform', 'validate', 'snapshot', 'load']) AS stage) s
CROSS JOIN (SELECT unnest(['first', 'within', 'after']) AS run) r""", "players", "advanced_stats"))(_etl_run)


def _etl_manifest(spark, d):
    """K6: the manifest after the three runs: the one within the look-back adds nothing."""
    out, _ = _etl(spark, d, ETL_TIMES.values())
    return spark.read.parquet(f"{out}/manifest")


register("etl_manifest", with_fixtures(f"""
SELECT '2000-01' AS season, t AS timestamp, (SELECT count(*) FROM players) + (SELECT count(*) FROM advanced_stats) AS records_extracted
FROM (SELECT unnest([TIMESTAMP '{ETL_TIMES['first']}', TIMESTAMP '{ETL_TIMES['after']}']) AS t)""",
    "players", "advanced_stats"))(_etl_manifest)


def _etl_tables(spark, d):
    """K2, K3: the rows of the snapshot of the run and of the loaded table, read back."""
    out, _ = _etl(spark, d, [AS_OF])
    snapshot = spark.read.parquet(f"{out}/processed/players").where(F.col("run_ts") == AS_OF.replace("-", "").replace(":", "").replace(" ", "T"))
    load = spark.read.parquet(f"{out}/warehouse/players")
    return snapshot.drop("run_ts").withColumn("copy", F.lit("snapshot")).unionByName(load.withColumn("copy", F.lit("load")))


register("etl_tables", with_fixtures(f"""
SELECT player_id, {trim_sql('player_name')} AS player_name, coalesce(team_id, 0) AS team_id,
  {trim_sql('team_name')} AS team_name, season, coalesce(cast(is_active AS BOOLEAN), false) AS is_active,
  player_id IS NOT NULL AND {trim_sql('player_name')} IS NOT NULL AND coalesce(player_id > 0, false) AS is_valid,
  {AS_OF_SQL} AS processed_at, copy
FROM players CROSS JOIN (SELECT unnest(['snapshot', 'load']) AS copy)""", "players"))(_etl_tables)


def _lookback(spark, d):
    """The delta with a trailing window of three days read again."""
    arr = fx(spark, d).arrivals
    loaded = arr.where(F.col("data_loaded_at") < F.to_timestamp_ntz(F.lit(CUTOFF)))
    return text_dates(landed.incremental_delta(arr, loaded, "data_loaded_at", lookback="3 days"))


register("delta_lookback", with_fixtures(f"""
SELECT * REPLACE (CAST(load_day AS VARCHAR) AS load_day) FROM arrivals WHERE data_loaded_at >
  (SELECT coalesce(max(data_loaded_at), TIMESTAMP '0001-01-01 00:00:00') - INTERVAL 3 DAY FROM arrivals
   WHERE data_loaded_at < TIMESTAMP '{CUTOFF}')""", "arrivals"))(_lookback)


# Position of each cell in a landed row of advanced statistics.
ADVANCED_CELLS = {i: n for i, n, _ in payload.ADVANCED_LAYOUT}


def _land_advanced(spark, d, base):
    """Advanced statistics as payload documents, one per season and hundred players."""
    adv = fx(spark, d).advanced_stats
    width = max(ADVANCED_CELLS) + 1
    cells = [F.col(ADVANCED_CELLS[i]).cast("string") if ADVANCED_CELLS.get(i) in adv.columns else F.lit(None).cast("string")
             for i in range(width)]
    docs = (adv.withColumn("__row", F.array(*cells))
            .groupBy("season", "season_type", F.floor(F.col("player_id") / 100).alias("__chunk"))
            .agg(F.collect_list("__row").alias("rowSet"))
            .select("season", F.create_map(F.lit("Season"), F.col("season"), F.lit("SeasonType"), F.col("season_type")).alias("parameters"),
                    F.array(F.struct(F.lit("LeagueDashPlayerStats").alias("name"), F.lit(None).cast("array<string>").alias("headers"),
                                     F.col("rowSet").alias("rowSet"))).alias("resultSets")))
    docs.write.partitionBy("season").json(f"{base}/endpoint=leaguedashplayerstats")


def _collect_seasons(spark, d):
    """Rosters and advanced statistics land by season; two seasons are collected and decoded."""
    base = scratch_path(spark, "seasons")
    _land_advanced(spark, d, base)
    _land_roster(fx(spark, d).rosters, base)
    got = payload.collect_seasons(spark, base, ("1996-97", "1997-98"))
    names = got["players"].select("player_id", "season", "player_name", "team_id")
    return got["advanced_stats"].drop("player_name", "team_id").join(names, ["player_id", "season"]) \
        .select("player_id", "season", "season_type", "player_name", "team_id", "gp", "min", "off_rating", "ts_pct", "pie")


register("collect_seasons", with_fixtures("""
SELECT a.player_id, a.season, a.season_type, p.player_name, p.team_id, CAST(a.gp AS BIGINT) AS gp, a.min, a.off_rating, a.ts_pct, a.pie
FROM advanced_stats a JOIN rosters p ON p.player_id = a.player_id AND p.season = a.season
WHERE a.season IN ('1996-97', '1997-98')""", "advanced_stats", "rosters"))(_collect_seasons)
