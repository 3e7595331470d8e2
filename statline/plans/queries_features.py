"""Registered queries: metrics, engineered features, history, outliers, quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import metrics as M
from ..operators import aggregate, clean, features, quality
from . import mart
from .catalog import AS_OF, AS_OF_SQL, fx, quantile_sql, register, with_fixtures
from .etl import etl_advanced
from .queries_mart import PERF_FIXTURES, performance_sql

STATLINE_COLS = ("player_id", "season", "games", "min", "pts", "reb", "ast", "fgm", "fga",
                 "fg3m", "fg3a", "ftm", "fta", "stl", "blk", "tov", "plus_minus", "fg_pct")

# SQL twins of the metric formulas (same operand order as the Column versions).
TS = "pts / nullif((fga + fta * 0.44E0) * 2, 0)"
EFG = "(fgm + fg3m * 0.5E0) / nullif(fga, 0)"
USG = "(fga + fta * 0.44E0 + tov) / nullif(min, 0) * 48"
WS48 = "(pts + reb + ast + stl + blk - tov) / nullif(min, 0) * 48"
PER_FG = ("(pts + fg3m * 0.5E0 + (2.0E0 - fg_pct) * fgm + ftm * 0.5E0 * (2.0E0 - fg_pct) + ast - tov"
          " - (fga - fgm) - (fta - ftm) * 0.5E0) / nullif(min, 0) * 48")
GAME_SCORE = ("pts + fgm * 0.4E0 - fga * 0.7E0 - (fta - ftm) * 0.4E0 + reb * 0.7E0 + ast * 0.3E0"
              " + stl + blk * 0.7E0 - tov * 0.4E0")
BPM = "pts + reb * 1.2E0 + ast * 1.5E0 + stl * 2.0E0 + blk * 2.0E0 - tov * 1.5E0"
POS_SCORE = "ast * 0.3E0 + reb * 0.2E0 + blk * 0.5E0"
AST_W = "(2.0E0 - ast_pct / 100)"
PER_BOX = (f"pts + fg3m * 0.5E0 + {AST_W} * fgm + ftm * 0.5E0 * {AST_W} + ast - tov"
           " - (fga - fgm) - (fta - ftm) * 0.5E0")


def _stat(spark, d):
    return fx(spark, d).statlines


# ---------------------------------------------------------------- M1–M13, M21

register("box_metrics", with_fixtures(f"""
SELECT s.*, {PER_BOX.replace('ast_pct', 'a.ast_pct')} AS per_boxscore, {PER_FG} AS per_fgpct,
  {TS} AS true_shooting, {EFG} AS effective_fg, {USG} AS usage_rate, {WS48} AS win_shares_per_48,
  pts / nullif(min, 0) AS pts_per_min, reb / nullif(min, 0) AS reb_per_min,
  ast / nullif(min, 0) AS ast_per_min, ast / nullif(tov + 1, 0) AS ast_to_ratio,
  {GAME_SCORE} AS game_score, {BPM} AS box_plus_minus, {POS_SCORE} AS position_score
FROM statlines s LEFT JOIN (SELECT player_id, season, ast_pct FROM advanced_stats) a
  USING (player_id, season)""", "statlines", "advanced_stats"))(
    lambda spark, d: features.box_metrics(
        _stat(spark, d).join(fx(spark, d).advanced_stats.select("player_id", "season", "ast_pct"),
                             ["player_id", "season"], "left")).drop("ast_pct"))


def _advanced_metrics(spark, d):
    f = fx(spark, d)
    base = f.statlines.join(f.advanced_stats.select("player_id", "season", "ast_pct"),
                            ["player_id", "season"], "left")
    return features.advanced_metrics(base)


register("advanced_metrics", with_fixtures(f"""
SELECT s.*, a.ast_pct, {PER_BOX} AS per, {TS} AS ts_pct, {EFG} AS efg_pct, {USG} AS usg_pct,
  {WS48} AS ws_per_48
FROM statlines s LEFT JOIN (SELECT player_id, season, ast_pct FROM advanced_stats) a
  USING (player_id, season)""", "statlines", "advanced_stats"))(_advanced_metrics)


# ---------------------------------------------------------------- M20, W4, W5

W = "PARTITION BY player_id ORDER BY season"
FEATURES_SQL = f"""
WITH base AS (
  SELECT *, {TS} AS true_shooting_percentage, {EFG} AS effective_field_goal_pct,
    pts / nullif(min, 0) AS pts_per_min, reb / nullif(min, 0) AS reb_per_min,
    ast / nullif(min, 0) AS ast_per_min, ast / nullif(tov + 1, 0) AS ast_to_ratio,
    {USG} AS usage_rate, {PER_FG} AS per, {GAME_SCORE} AS game_score, {WS48} AS ws_per_48,
    {BPM} AS box_plus_minus, {POS_SCORE} AS position_score,
    lag(pts) OVER ({W}) AS prev_season_pts, lag(reb) OVER ({W}) AS prev_season_reb,
    lag(ast) OVER ({W}) AS prev_season_ast,
    last_value(pts IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ff_pts,
    last_value(reb IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ff_reb,
    last_value(ast IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ff_ast
  FROM statlines),
trend AS (
  SELECT *, ff_pts / nullif(lag(ff_pts) OVER ({W}), 0) - 1 AS pts_trend,
    ff_reb / nullif(lag(ff_reb) OVER ({W}), 0) - 1 AS reb_trend,
    ff_ast / nullif(lag(ff_ast) OVER ({W}), 0) - 1 AS ast_trend
  FROM base)
SELECT * EXCLUDE (ff_pts, ff_reb, ff_ast),
  pts * true_shooting_percentage AS pts_eff_interaction,
  usage_rate * true_shooting_percentage AS usage_efficiency,
  pts * reb AS pts_reb_interaction, pts * ast AS pts_ast_interaction,
  stl + blk - tov AS defensive_impact
FROM trend"""

register("engineered_features", with_fixtures(FEATURES_SQL, "statlines"))(
    lambda spark, d: features.create_features(_stat(spark, d)))

register("prev_season", with_fixtures(f"""
SELECT player_id, season, pts, reb, ast, lag(pts) OVER ({W}) AS prev_season_pts,
  lag(reb) OVER ({W}) AS prev_season_reb, lag(ast) OVER ({W}) AS prev_season_ast
FROM statlines""", "statlines"))(
    lambda spark, d: features.lag_features(_stat(spark, d).select("player_id", "season", "pts",
                                                                   "reb", "ast")))

register("stat_trend", with_fixtures(f"""
WITH f AS (SELECT player_id, season, pts, reb, ast,
  last_value(pts IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
  last_value(reb IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fr,
  last_value(ast IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fa
  FROM statlines)
SELECT player_id, season, pts, reb, ast, fp / nullif(lag(fp) OVER ({W}), 0) - 1 AS pts_trend,
  fr / nullif(lag(fr) OVER ({W}), 0) - 1 AS reb_trend, fa / nullif(lag(fa) OVER ({W}), 0) - 1 AS ast_trend
FROM f""", "statlines"))(
    lambda spark, d: features.pct_change(_stat(spark, d).select("player_id", "season", "pts",
                                                                 "reb", "ast")))


# ---------------------------------------------------------------- P9, P15, M4

IQR_COLS = clean.ADVANCED_NUMERIC


def _iqr_sql(cols, table, extra_select="*") -> str:
    qs = ", ".join(f"{quantile_sql(table, c, 0.25)} AS {c}_q1, {quantile_sql(table, c, 0.75)} AS {c}_q3"
                   for c in cols)
    caps = ", ".join(
        f"CASE WHEN {c} IS NULL THEN NULL "
        f"WHEN {c} < {c}_q1 - ({c}_q3 - {c}_q1) * 1.5E0 THEN {c}_q1 - ({c}_q3 - {c}_q1) * 1.5E0 "
        f"WHEN {c} > {c}_q3 + ({c}_q3 - {c}_q1) * 1.5E0 THEN {c}_q3 + ({c}_q3 - {c}_q1) * 1.5E0 "
        f"ELSE {c} END AS {c}" for c in cols)
    return f"""q AS (SELECT {qs}),
capped AS (SELECT t.* REPLACE ({caps}) FROM {table} t CROSS JOIN q)"""


def _adv_double(spark, d):
    """Advanced stats with every numeric column as DOUBLE (``gp`` included)."""
    return clean.coerce_numeric(fx(spark, d).advanced_stats, IQR_COLS)


ADV_DOUBLE_SQL = ("adv AS (SELECT * REPLACE (" +
                  ", ".join(f"cast({c} AS DOUBLE) AS {c}" for c in IQR_COLS) +
                  ") FROM advanced_stats)")

register("iqr_capped", with_fixtures(
    f"WITH {ADV_DOUBLE_SQL},\n{_iqr_sql(IQR_COLS, 'adv')}\nSELECT * FROM capped",
    "advanced_stats"))(
    lambda spark, d: aggregate.cap_outliers_iqr(_adv_double(spark, d), IQR_COLS))


register("etl_advanced", with_fixtures(
    f"WITH {ADV_DOUBLE_SQL},\n{_iqr_sql(IQR_COLS, 'adv')}\n"
    f"SELECT *, gp AS games_played, min AS minutes_per_game, "
    f"coalesce((0E0 * 1.0E0 + 0E0 * 0.8E0 + 0E0 * 1.0E0 + 0E0 * 1.5E0 + 0E0 * 1.5E0 - 0E0 * 1.0E0)"
    f" / nullif(min, 0) * 48, 0E0) AS player_efficiency_rating, {AS_OF_SQL} AS processed_at "
    f"FROM capped", "advanced_stats"))(
    lambda spark, d: etl_advanced(fx(spark, d).advanced_stats))

PER_LIN = ("coalesce((pts * 1.0E0 + reb * 0.8E0 + ast * 1.0E0 + stl * 1.5E0 + blk * 1.5E0"
           " - tov * 1.0E0) / nullif(min, 0) * 48, 0E0)")

register("per_linear", with_fixtures(
    f"SELECT player_id, season, {PER_LIN} AS per_linear FROM statlines", "statlines"))(
    lambda spark, d: _stat(spark, d).select(
        "player_id", "season", M.per_linear(_stat(spark, d).columns).alias("per_linear")))


# ---------------------------------------------------------------- Q1–Q11

def _perf(spark, d):
    f = fx(spark, d)
    return mart.player_performance(f.players, f.game_logs, f.advanced_stats, as_of=AS_OF)


register("quality_rules", with_fixtures(performance_sql("season") + """,
v AS (SELECT count_if(player_id IS NULL) AS v1,
        count_if(NOT regexp_matches(season, '^[0-9]{4}-[0-9]{2}$')) AS v2,
        count_if(minutes_per_game < 0 OR minutes_per_game > 48) AS v3,
        count_if(points_per_game < 0 OR rebounds_per_game < 0 OR assists_per_game < 0) AS v4
      FROM perf)
SELECT rule_name, description, violations, threshold, violations <= threshold AS passed FROM (
  SELECT 'non_null_player_id' AS rule_name, 'Every row names its player' AS description, v1 AS violations, 0::BIGINT AS threshold FROM v
  UNION ALL SELECT 'valid_season_format', 'Seasons read like 2003-04', v2, 0 FROM v
  UNION ALL SELECT 'reasonable_minutes_per_game', 'No player averages below 0 or above 48 minutes', v3, 0 FROM v
  UNION ALL SELECT 'positive_stats', 'Points, rebounds and assists are never below zero', v4, 0 FROM v)""",
    *PERF_FIXTURES))(lambda spark, d: quality.run_rules(_perf(spark, d)))

register("quality_summary", with_fixtures("""
SELECT count(*) AS row_count,
  (count_if(player_id IS NULL) + count_if(player_name IS NULL) + count_if(team_id IS NULL)
   + count_if(team_name IS NULL) + count_if(season IS NULL) + count_if(is_active IS NULL)) AS missing_cells,
  (count_if(player_id IS NULL) + count_if(player_name IS NULL) + count_if(team_id IS NULL)
   + count_if(team_name IS NULL) + count_if(season IS NULL) + count_if(is_active IS NULL))
   / nullif(count(*) * 6, 0) AS missing_share,
  count(*) - count(DISTINCT player_id) - coalesce(max(CAST(player_id IS NULL AS INTEGER)), 0) AS duplicate_keys,
  count(*) >= 10 AS enough_rows,
  coalesce((count_if(player_id IS NULL) + count_if(player_name IS NULL) + count_if(team_id IS NULL)
   + count_if(team_name IS NULL) + count_if(season IS NULL) + count_if(is_active IS NULL))
   / nullif(count(*) * 6, 0) <= 0.1E0, true) AS missing_ok
FROM players""", "players"))(lambda spark, d: quality.quality_summary(fx(spark, d).players))

def _gate_sql(table: str, columns) -> str:
    missing = " + ".join(f"count_if({c} IS NULL)" for c in columns)
    share = f"({missing}) / nullif(count(*) * {len(columns)}, 0)"
    return (f"SELECT '{table}' AS table_name, count(*) AS row_count, {missing} AS missing_cells, {share} AS missing_share, "
            f"count(*) - count(DISTINCT player_id) - coalesce(max(CAST(player_id IS NULL AS INTEGER)), 0) AS duplicate_keys, "
            f"count(*) >= 10 AS enough_rows, coalesce({share} <= 0.1E0, true) AS missing_ok FROM {table}")


ROSTER_COLS = ("player_id", "player_name", "team_id", "team_name", "season", "is_active")
ADVANCED_COLS = ("player_id", "season", "season_type", "gp", "min", "off_rating", "def_rating", "net_rating",
                 "ast_pct", "reb_pct", "usg_pct", "ts_pct", "efg_pct", "pie")

register("quality_gate", with_fixtures(
    _gate_sql("players", ROSTER_COLS) + " UNION ALL " + _gate_sql("advanced_stats", ADVANCED_COLS),
    "players", "advanced_stats"))(
    lambda spark, d: quality.validate({"players": fx(spark, d).players,
                                       "advanced_stats": fx(spark, d).advanced_stats}))

register("quarantine", with_fixtures(performance_sql("season") + """
SELECT *, failed_rules IS NULL AS is_valid FROM (SELECT player_id, season, minutes_per_game, points_per_game,
  nullif(concat_ws(',',
    CASE WHEN coalesce(player_id IS NULL, false) THEN 'non_null_player_id' END,
    CASE WHEN coalesce(NOT regexp_matches(season, '^[0-9]{4}-[0-9]{2}$'), false) THEN 'valid_season_format' END,
    CASE WHEN coalesce(minutes_per_game < 0 OR minutes_per_game > 48, false) THEN 'reasonable_minutes_per_game' END,
    CASE WHEN coalesce(points_per_game < 0 OR rebounds_per_game < 0 OR assists_per_game < 0, false) THEN 'positive_stats' END
  ), '') AS failed_rules
FROM perf)""", *PERF_FIXTURES))(
    lambda spark, d: quality.quarantine(_perf(spark, d))
    .select("player_id", "season", "minutes_per_game", "points_per_game", "failed_rules",
            "is_valid"))

FRESH_AS_OF = "2024-02-01 00:00:00"
register("freshness_check", with_fixtures(f"""
SELECT team_name, max(data_loaded_at) AS last_update,
  date_diff('microsecond', max(data_loaded_at), TIMESTAMP '{FRESH_AS_OF}') / 86400000000.0E0 AS age_days,
  coalesce(date_diff('microsecond', max(data_loaded_at), TIMESTAMP '{FRESH_AS_OF}') / 86400000000.0E0 < 7,
           false) AS is_fresh
FROM arrivals GROUP BY team_name""", "arrivals"))(
    lambda spark, d: quality.freshness_check(fx(spark, d).arrivals, as_of=FRESH_AS_OF,
                                             by=("team_name",)))

