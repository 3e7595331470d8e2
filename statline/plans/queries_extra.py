"""Registered queries: team context features (M15), dashboard shooting clips (P17, P18),
residual rows (L22)."""

from __future__ import annotations

from pyspark.sql import functions as F


from ..ml import evaluate
from ..operators import clean, features
from .catalog import fx, register, season_sql, with_fixtures

KEY = ("player_id", "season")


def team_records(game_logs, players):
    """Per team-season games and wins, from the player game rows of each team."""
    logs = clean.stage_game_logs(game_logs).select("player_id", "season", "wl")
    roster = players.select("player_id", F.col("team_id").cast("bigint").alias("team_id"))
    return (logs.join(roster, "player_id").groupBy("team_id", "season")
            .agg(F.count(F.lit(1)).alias("team_games"),
                 F.count_if(F.col("wl") == "W").alias("team_wins")))


def _team_context(spark, d):
    f = fx(spark, d)
    roster = f.players.select("player_id", F.col("team_id").cast("bigint").alias("team_id"))
    base = f.statlines.join(roster, "player_id").join(team_records(f.game_logs, f.players),
                                                      ["team_id", "season"])
    out = features.create_features(base)
    return out.select(*KEY, "team_id", "team_wins", "team_games", "team_win_pct",
                      "team_context_score")


register("team_context", with_fixtures(f"""
WITH tr AS (SELECT g.season_start, p.team_id, count(*) AS team_games, count_if(g.wl = 'W') AS team_wins
            FROM game_logs g JOIN players p ON g.player_id = p.player_id GROUP BY 1, 2),
trs AS (SELECT {season_sql('season_start')} AS season, team_id, team_games, team_wins FROM tr)
SELECT s.player_id, s.season, p.team_id, trs.team_wins, trs.team_games,
  trs.team_wins / nullif(trs.team_games, 0) AS team_win_pct,
  s.pts * (trs.team_wins / nullif(trs.team_games, 0)) AS team_context_score
FROM statlines s JOIN players p ON s.player_id = p.player_id
JOIN trs ON trs.team_id = p.team_id AND trs.season = s.season""",
    "statlines", "players", "game_logs"))(_team_context)

ABS_COLS = ("pts", "reb", "ast", "min", "fgm", "fga", "fg3m", "fg3a", "ftm", "fta", "stl", "blk",
            "tov")
CLIPS = {"fg_pct": (0.2, 0.8), "fg3_pct": (0.1, 0.6), "ft_pct": (0.5, 1.0)}


def _shooting_clip(spark, d):
    s = fx(spark, d).statlines.select(*KEY, *ABS_COLS)
    s = clean.clip_range(s, {}, absolute=ABS_COLS)
    s = clean.shooting_pcts(s, eps=1e-8)
    return clean.clip_range(s, CLIPS).select(*KEY, *CLIPS)


def _clip_sql(c, lo, hi, made, att):
    x = f"abs({made}) / nullif(abs({att}) + 1E-8, 0)"
    return f"CASE WHEN ({x}) IS NULL THEN NULL ELSE least(greatest({x}, {lo!r}E0), {hi!r}E0) END AS {c}"


register("shooting_clip", with_fixtures(
    "SELECT player_id, season, " + ", ".join([
        _clip_sql("fg_pct", 0.2, 0.8, "fgm", "fga"), _clip_sql("fg3_pct", 0.1, 0.6, "fg3m", "fg3a"),
        _clip_sql("ft_pct", 0.5, 1.0, "ftm", "fta")]) + " FROM statlines", "statlines"))(
    _shooting_clip)

register("residuals", with_fixtures("""
WITH p AS (SELECT player_id, season, pts AS actual, fgm * 2 + fg3m + ftm AS predicted FROM statlines)
SELECT player_id, season, actual, predicted, actual - predicted AS residual,
  (SELECT min(pts) FROM statlines) AS range_min, (SELECT max(pts) FROM statlines) AS range_max
FROM p""", "statlines"))(
    lambda spark, d: evaluate.residuals(fx(spark, d).statlines.select(
        *KEY, F.col("pts").alias("label"),
        (F.col("fgm") * 2 + F.col("fg3m") + F.col("ftm")).alias("prediction"))))




def _bodies(spark, d):
    """Body features from heights and weights derived from the key."""
    df = fx(spark, d).statlines.withColumns({"height": 1.7 + F.col("player_id") % 40 / 100,
                                             "weight": F.col("player_id") % 50 + 70.0})
    return features.create_features(df).select(*KEY, "bmi", "height_weight_ratio")


register("body_features", with_fixtures("""
WITH b AS (SELECT player_id, season, 1.7E0 + player_id % 40 / 100E0 AS height, player_id % 50 + 70E0 AS weight FROM statlines)
SELECT player_id, season, weight / nullif(height * height, 0) AS bmi, height / nullif(weight, 0) AS height_weight_ratio FROM b""",
    "statlines"))(_bodies)

register("numeric_columns", with_fixtures("SELECT pts, data_loaded_at IS NULL AS missing, player_id FROM arrivals", "arrivals"))(
    lambda spark, d: clean.drop_columns(clean.select_numeric(fx(spark, d).arrivals).withColumn("missing", F.lit(False)),
                                        ("event_id", "not_there")))
