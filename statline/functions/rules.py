"""Rule-based classifications (C1–C3) as ``Column`` expressions.

First matching branch wins; a comparison with NULL is not true, so it falls
through to the next branch exactly as SQL ``CASE WHEN`` does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .safe import col


def primary_position(pts="points_per_game", reb="rebounds_per_game",
                     ast="assists_per_game") -> Column:
    """Position from per-game points, rebounds and assists."""
    p, r, a = col(pts), col(reb), col(ast)
    return (F.when((a >= 5.0) & (r < 8.0) & (p < 25.0), "Point Guard")
            .when((p >= 18.0) & (a < 5.0) & (r < 7.0), "Shooting Guard")
            .when((p >= 12.0) & (r >= 5.0) & (r < 10.0) & (a < 6.0), "Small Forward")
            .when((r >= 8.0) & (p >= 10.0) & (a < 5.0), "Power Forward")
            .when((r >= 10.0) & (p >= 8.0) & (a < 4.0), "Center")
            .when((a >= 6.0) & (r >= 6.0), "Combo Forward/Guard")
            .otherwise("Utility Player"))


def position_tier(position="primary_position") -> Column:
    """Court zone of a position."""
    pos = col(position)
    return (F.when(pos.isin("Point Guard", "Shooting Guard"), "Backcourt")
            .when(pos.isin("Small Forward", "Power Forward"), "Frontcourt")
            .when(pos == "Center", "Big Man")
            .otherwise("Utility"))


def performance_tier(per="player_efficiency_rating", pts="points_per_game",
                     minutes="minutes_per_game") -> Column:
    """Tier from efficiency, scoring and minutes."""
    e, p, m = col(per), col(pts), col(minutes)
    return (F.when(((e >= 25) & (p >= 20)) | (e >= 30), "Elite")
            .when(((e >= 20) & (p >= 15)) | ((e >= 25) & (p >= 12)), "All-Star")
            .when(((e >= 15) & (p >= 10)) | ((e >= 18) & (m >= 20)), "Starter")
            .when((e >= 10) & (m >= 10), "Rotation Player")
            .otherwise("Bench Player"))
