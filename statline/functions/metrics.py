"""Box-score metric formulas as ``Column`` expressions.

Every function takes column names (defaults follow the box-score table) and
returns a ``Column``; nothing here triggers a job. Operand order mirrors the
published formulas so results are bit-identical with a SQL engine evaluating
the same expression. Ratios use ``safe_div`` (zero denominator → NULL).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .safe import ColumnOrName, clamp, col, per48, safe_div


def per_boxscore(pts="pts", fg3m="fg3m", fgm="fgm", ftm="ftm", ast="ast", tov="tov",
                 fga="fga", fta="fta", ast_pct="ast_pct") -> Column:
    """M1: unnormalised efficiency with the assist share as the FG weight."""
    w = F.lit(2.0) - col(ast_pct) / 100
    return (col(pts) + col(fg3m) * 0.5 + w * col(fgm) + col(ftm) * 0.5 * w
            + col(ast) - col(tov) - (col(fga) - col(fgm)) - (col(fta) - col(ftm)) * 0.5)


def per_fgpct(pts="pts", fg3m="fg3m", fgm="fgm", ftm="ftm", ast="ast", tov="tov",
              fga="fga", fta="fta", fg_pct="fg_pct", minutes="min") -> Column:
    """M2: efficiency weighted by FG%, per 48 minutes."""
    num = (col(pts) + col(fg3m) * 0.5 + (F.lit(2.0) - col(fg_pct)) * col(fgm)
           + col(ftm) * 0.5 * (F.lit(2.0) - col(fg_pct)) + col(ast) - col(tov)
           - (col(fga) - col(fgm)) - (col(fta) - col(ftm)) * 0.5)
    return per48(num, minutes)


def per_estimated(pts="points_per_game", ast="assists_per_game", tov="turnovers_per_game",
                  fg_pct="field_goal_pct", minutes="minutes_per_game",
                  default_fg_pct: float = 0.45, default_minutes: float = 25.0) -> Column:
    """M3: efficiency estimated from points alone (shot mix assumed from points)."""
    p = col(pts)
    f = F.coalesce(col(fg_pct), F.lit(default_fg_pct))
    num = (p + (p * 0.1) * 0.5 + (F.lit(2.0) - f) * (p * 0.4)
           + (p * 0.2) * 0.5 * (F.lit(2.0) - f) + col(ast) - col(tov)
           - (p * 0.4) * 0.5 - (p * 0.2) * 0.5 * 0.5)
    return safe_div(num, F.coalesce(col(minutes), F.lit(default_minutes))) * 48


def per_linear(df_columns: list[str], pts="pts", reb="reb", ast="ast", stl="stl",
               blk="blk", tov="tov", minutes="min") -> Column:
    """M4: linear efficiency; an absent stat counts 0, absent minutes 1; NULL → 0."""
    def get(name: str, default: float) -> Column:
        return F.col(name) if name in df_columns else F.lit(default)

    num = (get(pts, 0.0) * 1.0 + get(reb, 0.0) * 0.8 + get(ast, 0.0) * 1.0
           + get(stl, 0.0) * 1.5 + get(blk, 0.0) * 1.5 - get(tov, 0.0) * 1.0)
    return F.coalesce(per48(num, get(minutes, 1.0)), F.lit(0.0))


def true_shooting(pts="pts", fga="fga", fta="fta") -> Column:
    """M5: points / (2 · (FGA + 0.44 · FTA))."""
    return safe_div(col(pts), (col(fga) + col(fta) * 0.44) * 2)


def effective_fg(fgm="fgm", fg3m="fg3m", fga="fga") -> Column:
    """M6: (FGM + 0.5 · 3PM) / FGA."""
    return safe_div(col(fgm) + col(fg3m) * 0.5, col(fga))


def usage_rate(fga="fga", fta="fta", tov="tov", minutes="min") -> Column:
    """M7: possessions used per 48 minutes."""
    return per48(col(fga) + col(fta) * 0.44 + col(tov), minutes)


def win_shares_per_48(pts="pts", reb="reb", ast="ast", stl="stl", blk="blk", tov="tov",
                      minutes="min", default_minutes: float | None = None) -> Column:
    """M8: (pts+reb+ast+stl+blk−tov) per 48; the SQL model defaults minutes to 25."""
    m = col(minutes) if default_minutes is None else F.coalesce(col(minutes), F.lit(default_minutes))
    return per48(col(pts) + col(reb) + col(ast) + col(stl) + col(blk) - col(tov), m)


def per_minute(stat: ColumnOrName, minutes="min") -> Column:
    """M9: a counting stat per minute."""
    return safe_div(stat, minutes)


def ast_to_ratio(ast="ast", tov="tov") -> Column:
    """Assists / (turnovers + 1)."""
    return safe_div(col(ast), col(tov) + 1)


def game_score(pts="pts", fgm="fgm", fga="fga", fta="fta", ftm="ftm", reb="reb",
               ast="ast", stl="stl", blk="blk", tov="tov") -> Column:
    """Simplified game score."""
    return (col(pts) + col(fgm) * 0.4 - col(fga) * 0.7 - (col(fta) - col(ftm)) * 0.4
            + col(reb) * 0.7 + col(ast) * 0.3 + col(stl) + col(blk) * 0.7 - col(tov) * 0.4)


def box_plus_minus(pts="pts", reb="reb", ast="ast", stl="stl", blk="blk", tov="tov") -> Column:
    """Box plus/minus components."""
    return (col(pts) + col(reb) * 1.2 + col(ast) * 1.5 + col(stl) * 2.0
            + col(blk) * 2.0 - col(tov) * 1.5)


def position_score(ast="ast", reb="reb", blk="blk") -> Column:
    """guard/forward/centre lean."""
    return col(ast) * 0.3 + col(reb) * 0.2 + col(blk) * 0.5


def bmi(weight="weight", height="height") -> Column:
    """Weight / height²."""
    return safe_div(col(weight), F.pow(col(height), 2))


def height_weight_ratio(height="height", weight="weight") -> Column:
    return safe_div(col(height), col(weight))


def team_win_pct(team_wins="team_wins", team_games="team_games") -> Column:
    """Team win share."""
    return safe_div(col(team_wins), col(team_games))


def performance_score_raw(pts="points_per_game", reb="rebounds_per_game",
                          ast="assists_per_game", stl="steals_per_game",
                          blk="blocks_per_game", tov="turnovers_per_game",
                          per="player_efficiency_rating", ts="true_shooting_pct",
                          ws48="win_shares_per_48") -> Column:
    """M17 before clamping."""
    return (col(pts) * 2.5 + col(reb) * 1.5 + col(ast) * 2.0 + col(stl) * 3.0
            + col(blk) * 3.0 - col(tov) * 1.5 + col(per) * 0.5 + col(ts) * 50.0
            + col(ws48) * 10.0)


def performance_score(**kw) -> Column:
    """Composite 0–100 score (NULL when any input is NULL)."""
    return clamp(performance_score_raw(**kw), 0, 100)


def injury_risk_score(usage="usage_rate", minutes="minutes_per_game",
                      games="games_played", per="player_efficiency_rating") -> Column:
    """0–100 risk from usage, minutes, games and a low-efficiency bump."""
    low = F.when(col(per) < 10, F.lit(15.0)).otherwise(F.lit(0.0))
    raw = F.lit(20.0) + col(usage) * 0.5 + col(minutes) * 0.3 + col(games) * -0.2 + low
    return clamp(raw, 0, 100)


def composite_score(pts="pts", reb="reb", ast="ast", stl="stl", blk="blk",
                    ts="ts_pct") -> Column:
    """Dashboard composite used for equal-width tiers."""
    return (col(pts) * 0.3 + col(reb) * 0.2 + col(ast) * 0.2 + col(stl) * 10.0
            + col(blk) * 10.0 + col(ts) * 100.0)
