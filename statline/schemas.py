"""Declared table contracts (Q12) and column descriptions (K8).

Where the declared model schema and the SQL output list disagree, the output
list wins (the contract is their union).
"""

from __future__ import annotations

from pyspark.sql import types as T

_L, _S, _D, _B, _TS = T.LongType(), T.StringType(), T.DoubleType(), T.BooleanType(), \
    T.TimestampNTZType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


STAGED_PLAYERS_CONTRACT = _struct(
    ("player_id", _L), ("player_name", _S), ("team_id", _L), ("team_name", _S),
    ("season", _S), ("is_active", _B), ("data_loaded_at", _TS),
    ("standardized_team_name", _S), ("standardized_player_name", _S))

PERFORMANCE_CONTRACT = _struct(
    ("player_id", _L), ("player_name", _S), ("team_id", _L), ("team_name", _S), ("season", _S),
    ("games_played", _L), ("minutes_per_game", _D), ("points_per_game", _D),
    ("rebounds_per_game", _D), ("assists_per_game", _D), ("steals_per_game", _D),
    ("blocks_per_game", _D), ("turnovers_per_game", _D), ("field_goal_pct", _D),
    ("three_point_pct", _D), ("free_throw_pct", _D), ("player_efficiency_rating", _D),
    ("true_shooting_pct", _D), ("effective_fg_pct", _D), ("usage_rate", _D),
    ("win_shares_per_48", _D), ("offensive_rating", _D), ("defensive_rating", _D),
    ("net_rating", _D), ("player_impact_estimate", _D), ("win_pct", _D),
    ("data_processed_at", _TS))

MART_CONTRACT = _struct(
    ("player_id", _L), ("player_name", _S), ("team_id", _L), ("team_name", _S), ("season", _S),
    ("primary_position", _S), ("position_tier", _S), ("performance_tier", _S),
    ("games_played", _L), ("minutes_per_game", _D), ("points_per_game", _D),
    ("rebounds_per_game", _D), ("assists_per_game", _D), ("player_efficiency_rating", _D),
    ("true_shooting_pct", _D), ("usage_rate", _D), ("win_shares_per_48", _D),
    ("net_rating", _D), ("performance_score", _D), ("injury_risk_score", _D),
    ("season_rank", _L), ("position_rank", _L), ("team_rank", _L), ("steals_per_game", _D),
    ("blocks_per_game", _D), ("turnovers_per_game", _D), ("field_goal_pct", _D),
    ("three_point_pct", _D), ("free_throw_pct", _D), ("offensive_rating", _D),
    ("defensive_rating", _D), ("player_impact_estimate", _D), ("win_pct", _D),
    ("data_created_at", _TS), ("data_updated_at", _TS))

DESCRIPTIONS = {
    "player_id": "Unique player identifier",
    "player_name": "Full player name",
    "team_id": "Current team identifier",
    "team_name": "Current team name",
    "season": "Season in YYYY-YY format",
    "is_active": "Whether the player is currently active",
    "games_played": "Games played",
    "minutes_per_game": "Average minutes per game",
    "points_per_game": "Average points per game",
    "player_efficiency_rating": "Simplified player efficiency rating",
    "performance_score": "Composite performance score, 0-100",
    "injury_risk_score": "Injury risk score, 0-100",
    "season_rank": "Rank by performance score over the whole table",
    "position_rank": "Rank by performance score within the primary position",
    "team_rank": "Rank by performance score within the team",
}
