"""Feature engineering (M20, M21) and season history.

``create_features`` adds the 27 modelling columns in one projection plus
one window specification: the three lags and the three trends share the
same ``PARTITION BY player ORDER BY season`` spec, so Catalyst collapses them
into a single Window node (one shuffle, one sort). A player's rows are
bounded by the number of seasons they played, so the per-player window can
never grow with the data volume the way a per-team or per-position one can.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import metrics as M
from ..functions.safe import safe_div

BASIC = ("true_shooting_percentage", "effective_field_goal_pct", "pts_per_min", "reb_per_min",
         "ast_per_min", "ast_to_ratio", "usage_rate")
ADVANCED = ("per", "game_score", "ws_per_48", "box_plus_minus")
HISTORY = ("prev_season_pts", "prev_season_reb", "prev_season_ast", "pts_trend", "reb_trend",
           "ast_trend")
INTERACTIONS = ("pts_eff_interaction", "usage_efficiency", "pts_reb_interaction",
                "pts_ast_interaction", "defensive_impact")


def season_window(key: str = "player_id", order: str = "season"):
    return Window.partitionBy(key).orderBy(F.col(order).asc())


def lag_features(df: DataFrame, cols: Sequence[str] = ("pts", "reb", "ast"),
                 key: str = "player_id", order: str = "season",
                 prefix: str = "prev_season_") -> DataFrame:
    """The previous season's value of each column."""
    w = season_window(key, order)
    return df.withColumns({f"{prefix}{c}": F.lag(c, 1).over(w) for c in cols})


def _trend(c: str, w) -> Column:
    filled = F.last(F.col(c), ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return filled


def pct_change(df: DataFrame, cols: Sequence[str] = ("pts", "reb", "ast"),
               key: str = "player_id", order: str = "season", suffix: str = "_trend") -> DataFrame:
    """Relative change from the previous season.

    Gaps are forward-filled inside the player's history first (pandas
    ``pct_change`` default); a previous value of 0 gives NULL, not inf.
    """
    w = season_window(key, order)
    tmp = {f"__ff_{c}": _trend(c, w) for c in cols}
    out = df.withColumns(tmp)
    out = out.withColumns({f"{c}{suffix}": safe_div(F.col(f"__ff_{c}"),
                                                    F.lag(f"__ff_{c}", 1).over(w)) - 1
                           for c in cols})
    return out.drop(*tmp)


def create_features(df: DataFrame, key: str = "player_id", order: str = "season") -> DataFrame:
    """The full engineered feature set, in the reference's column order."""
    cols = set(df.columns)
    out = df.withColumns({
        "true_shooting_percentage": M.true_shooting(),
        "effective_field_goal_pct": M.effective_fg(),
        "pts_per_min": M.per_minute("pts"),
        "reb_per_min": M.per_minute("reb"),
        "ast_per_min": M.per_minute("ast"),
        "ast_to_ratio": M.ast_to_ratio(),
        "usage_rate": M.usage_rate(),
    })
    out = out.withColumns({
        "per": M.per_fgpct(),
        "game_score": M.game_score(),
        "ws_per_48": M.win_shares_per_48(),
        "box_plus_minus": M.box_plus_minus(),
        "position_score": M.position_score(),
    })
    if {"height", "weight"} <= cols:
        out = out.withColumns({"bmi": M.bmi(), "height_weight_ratio": M.height_weight_ratio()})
    if {"team_wins", "team_games"} <= cols:
        out = out.withColumn("team_win_pct", M.team_win_pct())
        out = out.withColumn("team_context_score", F.col("pts") * F.col("team_win_pct"))
    if order in cols:
        out = lag_features(out, key=key, order=order)
        out = pct_change(out, key=key, order=order)
    return out.withColumns({
        "pts_eff_interaction": F.col("pts") * F.col("true_shooting_percentage"),
        "usage_efficiency": F.col("usage_rate") * F.col("true_shooting_percentage"),
        "pts_reb_interaction": F.col("pts") * F.col("reb"),
        "pts_ast_interaction": F.col("pts") * F.col("ast"),
        "defensive_impact": F.col("stl") + F.col("blk") - F.col("tov"),
    })


def advanced_metrics(df: DataFrame) -> DataFrame:
    """Box-score efficiency, TS%, eFG%, usage and WS/48 together."""
    return df.withColumns({
        "per": M.per_boxscore(),
        "ts_pct": M.true_shooting(),
        "efg_pct": M.effective_fg(),
        "usg_pct": M.usage_rate(),
        "ws_per_48": M.win_shares_per_48(),
    })


def box_metrics(df: DataFrame) -> DataFrame:
    """M1, M2, M5–M13 side by side (one projection)."""
    return df.withColumns({
        "per_boxscore": M.per_boxscore(),
        "per_fgpct": M.per_fgpct(),
        "true_shooting": M.true_shooting(),
        "effective_fg": M.effective_fg(),
        "usage_rate": M.usage_rate(),
        "win_shares_per_48": M.win_shares_per_48(),
        "pts_per_min": M.per_minute("pts"),
        "reb_per_min": M.per_minute("reb"),
        "ast_per_min": M.per_minute("ast"),
        "ast_to_ratio": M.ast_to_ratio(),
        "game_score": M.game_score(),
        "box_plus_minus": M.box_plus_minus(),
        "position_score": M.position_score(),
    })
