"""Join operators.

Equi-joins are written without hints: AQE sees the runtime size of each
side and turns a sort-merge join into a broadcast join only when one side is
under ``spark.sql.autoBroadcastJoinThreshold`` (a checked bound), and splits
skewed partitions when one key is hot. Global statistics (one row) are the
only thing broadcast explicitly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import per_estimated, win_shares_per_48
from ..functions.safe import safe_div
from .aggregate import attach_scalars  # noqa: F401  (J3 lives with the statistics)

DERIVED_COLUMNS = (
    "games_played", "minutes_per_game", "points_per_game", "rebounds_per_game",
    "assists_per_game", "steals_per_game", "blocks_per_game", "turnovers_per_game",
    "field_goal_pct", "three_point_pct", "free_throw_pct", "offensive_rating",
    "defensive_rating", "net_rating", "assist_percentage", "rebound_percentage",
    "usage_rate", "true_shooting_pct", "effective_fg_pct", "player_impact_estimate",
    "player_efficiency_rating", "win_shares_per_48", "win_pct",
)


def attach_advanced(game_stats: DataFrame, advanced: DataFrame,
                    keys: Sequence[str] = ("player_id", "season"),
                    default_fg_pct: float = 0.45, default_minutes: float = 25.0) -> DataFrame:
    """J1 + P14 + M3 + M8: game aggregates LEFT JOIN staged advanced stats.

    Game statistics win; the advanced table fills gaps (games, minutes).
    ``advanced`` must be unique on ``keys`` (see ``season_fan_out_audit``).
    """
    j = game_stats.join(advanced, on=list(keys), how="left")
    return j.select(
        *keys,
        F.coalesce("games_played", "games_played_advanced").alias("games_played"),
        F.coalesce("avg_minutes_per_game", "minutes_per_game_advanced").alias("minutes_per_game"),
        F.col("avg_points_per_game").alias("points_per_game"),
        F.col("avg_rebounds_per_game").alias("rebounds_per_game"),
        F.col("avg_assists_per_game").alias("assists_per_game"),
        F.col("avg_steals_per_game").alias("steals_per_game"),
        F.col("avg_blocks_per_game").alias("blocks_per_game"),
        F.col("avg_turnovers_per_game").alias("turnovers_per_game"),
        "field_goal_pct", "three_point_pct", "free_throw_pct",
        "offensive_rating", "defensive_rating", "net_rating", "assist_percentage",
        "rebound_percentage", "usage_rate", "true_shooting_pct", "effective_fg_pct",
        "player_impact_estimate",
        per_estimated(pts="avg_points_per_game", ast="avg_assists_per_game",
                      tov="avg_turnovers_per_game", fg_pct="field_goal_pct",
                      minutes="avg_minutes_per_game", default_fg_pct=default_fg_pct,
                      default_minutes=default_minutes).alias("player_efficiency_rating"),
        win_shares_per_48(pts="avg_points_per_game", reb="avg_rebounds_per_game",
                          ast="avg_assists_per_game", stl="avg_steals_per_game",
                          blk="avg_blocks_per_game", tov="avg_turnovers_per_game",
                          minutes="avg_minutes_per_game",
                          default_minutes=default_minutes).alias("win_shares_per_48"),
        safe_div(F.col("wins"), F.col("wins") + F.col("losses")).alias("win_pct"),
    )


def attach_players(players: DataFrame, metrics: DataFrame, min_games: int = 10,
                   key: str = "player_id") -> DataFrame:
    """J2 + P13: roster LEFT JOIN metrics, then the games filter.

    The filter rejects NULL metrics, so Catalyst rewrites the outer join to an
    inner join (EliminateOuterJoin) and pushes the filter below it.
    """
    return (players.join(metrics, on=key, how="left")
            .where(F.col("games_played") >= min_games))


def attach_players_by_season(players: DataFrame, metrics: DataFrame, min_games: int = 5) -> DataFrame:
    """J2 at the (player, season) grain: at most one roster row for each metrics row.

    The roster row of that season counts, else the player's latest; of two
    rows of one season the one with the larger team_id. Players without a
    roster row drop out. ``season`` is the metrics' season.
    """
    card = F.struct("team_id", "team_name", "player_name")
    own = players.groupBy("player_id", "season").agg(F.max(card).alias("__own"))
    latest = own.groupBy("player_id").agg(F.max_by("__own", "season").alias("__latest"))
    out = (metrics.where(F.col("games_played") >= min_games)
           .join(own, ["player_id", "season"], "left").join(latest, "player_id")
           .withColumn("__card", F.coalesce("__own", "__latest")))
    return out.select(*metrics.columns, "__card.*")


def career_advanced(advanced: DataFrame) -> DataFrame:
    """Staged advanced statistics of all seasons as one row per player: games summed, the rest weighted by games."""
    games = F.col("games_played_advanced")
    rest = [f.name for f in advanced.schema.fields
            if f.name not in ("player_id", "games_played_advanced") and f.dataType.typeName() in ("double", "float")]
    return advanced.groupBy("player_id").agg(
        F.sum(games).alias("games_played_advanced"),
        *[safe_div(F.sum(F.col(c) * games), F.sum(F.when(F.col(c).isNotNull(), games))).alias(c) for c in rest])


def season_fan_out_audit(df: DataFrame, keys: Sequence[str] = ("player_id",)) -> DataFrame:
    """Keys with more than one row — the rows a join on ``keys`` would multiply."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_per_key"))
            .where(F.col("rows_per_key") > 1))
