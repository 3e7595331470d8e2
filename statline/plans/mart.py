"""Staging → intermediate → mart (R2) as composable DataFrame functions.

``player_performance`` is the intermediate model (per player-season by
default, each with one roster row; ``grain='career'`` is the per-player form,
with the advanced table of all seasons weighted by games, so that no join fans
out). ``mart_summary``
adds positions, tiers, scores and the three rankings.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import metrics, rules
from ..operators.aggregate import aggregate_game_logs
from ..operators.clean import (DEFAULT_AS_OF, as_of_literal, filter_active, stage_advanced,
                               stage_game_logs, stage_players)
from ..operators.joins import attach_advanced, attach_players, attach_players_by_season, career_advanced
from ..operators.rank import row_numbers
from ..session import saved

PERFORMANCE_COLUMNS = (
    "player_id", "player_name", "team_id", "team_name", "season", "games_played",
    "minutes_per_game", "points_per_game", "rebounds_per_game", "assists_per_game",
    "steals_per_game", "blocks_per_game", "turnovers_per_game", "field_goal_pct",
    "three_point_pct", "free_throw_pct", "player_efficiency_rating", "true_shooting_pct",
    "effective_fg_pct", "usage_rate", "win_shares_per_48", "offensive_rating",
    "defensive_rating", "net_rating", "player_impact_estimate", "win_pct",
    "data_processed_at",
)

MART_COLUMNS = (
    "player_id", "player_name", "team_id", "team_name", "season",
    "primary_position", "position_tier", "performance_tier",
    "games_played", "minutes_per_game", "points_per_game", "rebounds_per_game",
    "assists_per_game", "player_efficiency_rating", "true_shooting_pct", "usage_rate",
    "win_shares_per_48", "net_rating", "performance_score", "performance_score_raw",
    "injury_risk_score", "season_rank", "position_rank", "team_rank",
    "steals_per_game", "blocks_per_game", "turnovers_per_game", "field_goal_pct",
    "three_point_pct", "free_throw_pct", "offensive_rating", "defensive_rating",
    "player_impact_estimate", "win_pct", "data_created_at", "data_updated_at",
)


def player_base(players: DataFrame, as_of: str | _dt.datetime = DEFAULT_AS_OF) -> DataFrame:
    """Active, valid roster rows with the standardised team name."""
    staged = filter_active(stage_players(players, as_of))
    return staged.select("player_id", "player_name", "team_id",
                         F.col("standardized_team_name").alias("team_name"), "season")


def player_performance(players: DataFrame, game_logs: DataFrame, advanced: DataFrame,
                       grain: str = "season", min_games: int | None = None,
                       as_of: str | _dt.datetime = DEFAULT_AS_OF) -> DataFrame:
    """Intermediate model: one row per player-season (or per player)."""
    base = player_base(players, as_of)
    logs = stage_game_logs(game_logs)
    adv = stage_advanced(advanced)
    if grain == "season":
        derived = attach_advanced(aggregate_game_logs(logs, ("player_id", "season")), adv, ("player_id", "season"))
        final = attach_players_by_season(base, derived, 5 if min_games is None else min_games)
    elif grain == "career":
        derived = attach_advanced(aggregate_game_logs(logs, ("player_id",)), career_advanced(adv), ("player_id",))
        final = attach_players(base, derived, min_games=10 if min_games is None else min_games)
    else:
        raise ValueError(f"grain must be 'season' or 'career', not {grain!r}")
    return (final.withColumn("data_processed_at", as_of_literal(as_of))
            .select(*PERFORMANCE_COLUMNS))


def classify(perf: DataFrame) -> DataFrame:
    """Positions, tiers and the two clamped scores."""
    return perf.withColumns({
        "primary_position": rules.primary_position(),
        "performance_score_raw": metrics.performance_score_raw(),
        "performance_score": metrics.performance_score(),
        "performance_tier": rules.performance_tier(),
        "injury_risk_score": metrics.injury_risk_score(),
    }).withColumn("position_tier", rules.position_tier())


def rank_key(df: DataFrame) -> list:
    """Score first, then a unique key so ties are numbered deterministically."""
    keys = [F.col("performance_score").desc_nulls_last(), F.col("player_id").asc()]
    if "season" in df.columns:
        keys.append(F.col("season").asc())
    return keys


def mart_summary(perf: DataFrame, as_of: str | _dt.datetime = DEFAULT_AS_OF,
                 num_partitions: int | None = None) -> DataFrame:
    """Mart model: classification, scores and season/position/team ranks."""
    # written once with a number for each row, so that only the columns that ranks depend on are ordered and dealt out
    df = saved(classify(perf).withColumn("__row", F.monotonically_increasing_id()), "classified")
    groupings = {"season_rank": (), "position_rank": ("primary_position",), "team_rank": ("team_id",)}
    keys = [c for c in ("performance_score", "player_id", "season", "primary_position", "team_id") if c in df.columns]
    ranks = row_numbers(df.select("__row", *keys), rank_key(df), groupings, num_partitions=num_partitions)
    df = df.join(ranks.select("__row", *groupings), "__row")
    ts = as_of_literal(as_of)
    return df.withColumns({"data_created_at": ts, "data_updated_at": ts}).select(*MART_COLUMNS)


def build_mart(players: DataFrame, game_logs: DataFrame, advanced: DataFrame,
               grain: str = "season", as_of: str | _dt.datetime = DEFAULT_AS_OF,
               **kw) -> DataFrame:
    """R2 end to end."""
    perf = player_performance(players, game_logs, advanced, grain=grain, as_of=as_of, **kw)
    return mart_summary(perf, as_of=as_of)
