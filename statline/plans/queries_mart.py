"""Registered queries: staging, intermediate and mart models (R2 pieces).

The oracles state each result from its contract: what a column is, from which
facts, is listed below, and the SQL is generated from these lists.
"""

from __future__ import annotations

from ..operators import aggregate, clean, joins, rank
from . import mart
from .catalog import AS_OF, AS_OF_SQL, fx, register, season_sql, trim_sql, with_fixtures
from .rule_sql import position_case, tier_case, zone_case

# ----------------------------------------------------------------- SQL blocks

# A team name with one of the marks becomes the full name.
TEAM_NAMES = {
    "Los Angeles Lakers": ("Lakers", "LAL"), "Golden State Warriors": ("Warriors", "GSW"),
    "Boston Celtics": ("Celtics", "BOS"), "Miami Heat": ("Heat", "MIA"), "Brooklyn Nets": ("Nets", "BKN"),
}


def staged_players_sql(source: str = "players") -> str:
    """CTE ``staged_players``: trimmed names, full team names, "last, first" turned round; keys and name required."""
    name, team = trim_sql("player_name"), trim_sql("team_name")
    full = " ".join(f"WHEN {' OR '.join(f'contains({team}, {m!r})' for m in marks)} THEN {n!r}"
                    for n, marks in TEAM_NAMES.items())
    part = lambda i: trim_sql(f"string_split({name}, ',')[{i}]")
    return f"""staged_players AS (
  SELECT CAST(player_id AS BIGINT) AS player_id, {name} AS player_name, CAST(team_id AS BIGINT) AS team_id,
    {team} AS team_name, season, coalesce(is_active = 1, false) AS is_active, {AS_OF_SQL} AS data_loaded_at,
    CASE {full} ELSE {team} END AS standardized_team_name,
    CASE WHEN contains({name}, ',') THEN {part(2)} || ' ' || {part(1)} ELSE {name} END AS standardized_player_name
  FROM {source} WHERE player_id IS NOT NULL AND player_name IS NOT NULL AND team_id IS NOT NULL)"""


STAGED_PLAYERS_SQL = staged_players_sql()

# Result column by the game column that it averages, and by its (made, tried) totals.
AVERAGES = {"minutes": "minutes", "points": "pts", "rebounds": "reb", "assists": "ast", "steals": "stl",
            "blocks": "blk", "turnovers": "tov"}
TOTALS = {"field_goal_pct": ("fgm", "fga"), "three_point_pct": ("fg3m", "fg3a"), "free_throw_pct": ("ftm", "fta")}
# Staged name of an advanced statistic by its landed one.
ADVANCED = {"off_rating": "offensive_rating", "def_rating": "defensive_rating", "net_rating": "net_rating",
            "usg_pct": "usage_rate", "ts_pct": "true_shooting_pct", "efg_pct": "effective_fg_pct",
            "pie": "player_impact_estimate"}


def games_sql(season: bool) -> str:
    """CTE ``games``: one row for each player (and season) with counts, averages and ratios of totals."""
    own = ["player_id"] + [f"{season_sql('season_start')} AS season"] * season
    columns = [*own, "count(*) AS games_played"]
    columns += [f"avg({c}) AS avg_{name}_per_game" for name, c in AVERAGES.items()]
    columns += [f"sum({made}) / nullif(sum({tried}), 0) AS {name}" for name, (made, tried) in TOTALS.items()]
    columns += ["avg(plus_minus) AS avg_plus_minus", "count_if(wl = 'W') AS wins", "count_if(wl = 'L') AS losses"]
    return f"games AS (SELECT {', '.join(columns)} FROM game_logs GROUP BY player_id{', season_start' * season})"


# The efficiency estimate and the win shares of the intermediate model.
def _per_estimate(p: str, a: str, t: str, fg: str, m: str) -> str:
    missed = f"(2E0 - coalesce({fg}, 0.45E0))"
    return (f"({p} + ({p} * 0.1E0) * 0.5E0 + {missed} * ({p} * 0.4E0) + ({p} * 0.2E0) * 0.5E0 * {missed} "
            f"+ {a} - {t} - ({p} * 0.4E0) * 0.5E0 - ({p} * 0.2E0) * 0.5E0 * 0.5E0) / nullif(coalesce({m}, 25E0), 0) * 48")


def performance_sql(grain: str, roster: str = "players") -> str:
    """CTEs up to ``perf``, whose columns are the intermediate model's contract."""
    season = grain == "season"
    avg = {k: f"avg_{k}_per_game" for k in AVERAGES}
    share = " + ".join(avg[k] for k in ("points", "rebounds", "assists", "steals", "blocks")) + f" - {avg['turnovers']}"
    if season:
        extra = f"extra AS (SELECT player_id, season, {', '.join(f'{c} AS {n}' for c, n in ADVANCED.items())} FROM advanced_stats)"
        # the roster row of the season, else the latest one, by one ordering of all of a player's rows
        who = """cards AS (SELECT g.player_id, g.season, s.team_id, s.standardized_team_name AS team_name, s.player_name,
    row_number() OVER (PARTITION BY g.player_id, g.season
      ORDER BY s.season = g.season DESC, s.season DESC, s.team_id DESC, s.standardized_team_name DESC, s.player_name DESC) AS pick
  FROM games g JOIN staged_players s ON s.player_id = g.player_id WHERE s.is_active),
who AS (SELECT * FROM cards WHERE pick = 1)"""
        joined = "games JOIN who USING (player_id, season) LEFT JOIN extra USING (player_id, season)"
    else:
        weighted = ", ".join(f"sum({c} * gp) / nullif(sum(CASE WHEN {c} IS NOT NULL THEN gp END), 0) AS {n}"
                             for c, n in ADVANCED.items())
        extra = f"extra AS (SELECT player_id, {weighted} FROM advanced_stats GROUP BY player_id)"
        who = ("who AS (SELECT player_id, season, team_id, standardized_team_name AS team_name, player_name "
               "FROM staged_players WHERE is_active)")
        joined = "games JOIN who USING (player_id) LEFT JOIN extra USING (player_id)"
    model = {name: name for name in mart.PERFORMANCE_COLUMNS}
    model |= {f"{k}_per_game": v for k, v in avg.items()}
    model["player_efficiency_rating"] = _per_estimate(avg["points"], avg["assists"], avg["turnovers"], "field_goal_pct", avg["minutes"])
    model["win_shares_per_48"] = f"({share}) / nullif(coalesce({avg['minutes']}, 25E0), 0) * 48"
    model["win_pct"] = "wins / nullif(wins + losses, 0)"
    model["data_processed_at"] = AS_OF_SQL
    columns = ",\n    ".join(e if e == n else f"{e} AS {n}" for n, e in model.items())
    return f"""WITH {staged_players_sql(roster)},
{games_sql(season)},
{extra},
{who},
perf AS (SELECT {columns}
  FROM {joined} WHERE games_played >= {5 if season else 10})"""


def _clamp(expr: str) -> str:
    return f"CASE WHEN ({expr}) IS NULL THEN NULL ELSE least(100E0, greatest(0E0, {expr})) END"


# Weights of the performance score and of the risk score.
SCORE_WEIGHTS = (("points_per_game", "2.5E0"), ("rebounds_per_game", "1.5E0"), ("assists_per_game", "2.0E0"),
                 ("steals_per_game", "3.0E0"), ("blocks_per_game", "3.0E0"), ("turnovers_per_game", "-1.5E0"),
                 ("player_efficiency_rating", "0.5E0"), ("true_shooting_pct", "50.0E0"), ("win_shares_per_48", "10.0E0"))
RISK_WEIGHTS = (("usage_rate", "0.5E0"), ("minutes_per_game", "0.3E0"), ("games_played", "-0.2E0"))
SCORE_RAW = "(" + " + ".join(f"{c} * {w}" for c, w in SCORE_WEIGHTS) + ")"
RISK_RAW = ("(20E0 + " + " + ".join(f"{c} * {w}" for c, w in RISK_WEIGHTS)
            + " + CASE WHEN player_efficiency_rating < 10 THEN 15E0 ELSE 0E0 END)")

CLASSIFIED_SQL = f"""classified AS (
  SELECT *, {position_case()} AS primary_position, {tier_case()} AS performance_tier,
    {SCORE_RAW} AS performance_score_raw, {_clamp(SCORE_RAW)} AS performance_score, {_clamp(RISK_RAW)} AS injury_risk_score
  FROM perf)"""


def mart_sql(grain: str = "season", roster: str = "players") -> str:
    order = "ORDER BY performance_score DESC NULLS LAST, player_id" + (", season" if grain == "season" else "")
    ranks = {"season_rank": "", "position_rank": "PARTITION BY primary_position ", "team_rank": "PARTITION BY team_id "}
    model = {name: name for name in mart.MART_COLUMNS}
    model |= {name: f"CAST(row_number() OVER ({by}{order}) AS BIGINT)" for name, by in ranks.items()}
    model |= {"position_tier": zone_case("primary_position"), "data_created_at": AS_OF_SQL, "data_updated_at": AS_OF_SQL}
    columns = ", ".join(e if e == n else f"{e} AS {n}" for n, e in model.items())
    return f"""{performance_sql(grain, roster)},
{CLASSIFIED_SQL},
mart AS (SELECT {columns} FROM classified)"""


PERF_FIXTURES = ("players", "game_logs", "advanced_stats")


def _perf(spark, d, grain="season"):
    f = fx(spark, d)
    return mart.player_performance(f.players, f.game_logs, f.advanced_stats, grain=grain, as_of=AS_OF)


# ----------------------------------------------------------------- queries

TOP_PLAYER_COLS = ("player_id", "player_name", "team_name", "games_played", "points_per_game",
                   "player_efficiency_rating", "win_shares_per_48", "performance_tier")


def top_players(spark, d):
    """Flagship: top 10 active career scorers with efficiency and tier."""
    perf = _perf(spark, d, grain="career")
    tiered = perf.withColumn("performance_tier", mart.rules.performance_tier())
    return rank.top_n(tiered, "points_per_game", 10, cols=list(TOP_PLAYER_COLS))


register("top_players", with_fixtures(f"""{performance_sql('career')},
tiered AS (SELECT *, {tier_case()} AS performance_tier FROM perf)
SELECT {', '.join(TOP_PLAYER_COLS)} FROM tiered WHERE points_per_game IS NOT NULL
ORDER BY points_per_game DESC, player_id LIMIT 10""", *PERF_FIXTURES))(top_players)


register("stage_players", with_fixtures(
    f"WITH {STAGED_PLAYERS_SQL}\nSELECT * FROM staged_players", "players"))(
    lambda spark, d: clean.stage_players(fx(spark, d).players, as_of=AS_OF))


register("etl_players", with_fixtures(f"""
SELECT player_id, {trim_sql('player_name')} AS player_name, coalesce(team_id, 0) AS team_id,
  {trim_sql('team_name')} AS team_name, season, coalesce(cast(is_active AS BOOLEAN), false) AS is_active,
  player_id IS NOT NULL AND {trim_sql('player_name')} IS NOT NULL AND coalesce(player_id > 0, false) AS is_valid,
  {AS_OF_SQL} AS processed_at
FROM players""", "players"))(lambda spark, d: clean.etl_players(fx(spark, d).players, as_of=AS_OF))


def _game_log_sql(season: bool) -> str:
    sel = "player_id, season, " if season else "player_id, "
    return f"""WITH {games_sql(season)}
SELECT {sel}games_played, avg_minutes_per_game, avg_points_per_game, avg_rebounds_per_game,
  avg_assists_per_game, avg_steals_per_game, avg_blocks_per_game, avg_turnovers_per_game,
  field_goal_pct, three_point_pct, free_throw_pct, avg_plus_minus, wins, losses,
  wins / nullif(wins + losses, 0) AS win_pct
FROM games"""


register("game_log_career", with_fixtures(_game_log_sql(False), "game_logs"))(
    lambda spark, d: aggregate.aggregate_game_logs(fx(spark, d).game_logs, ("player_id",)))

register("game_log_season", with_fixtures(_game_log_sql(True), "game_logs"))(
    lambda spark, d: aggregate.aggregate_game_logs(
        clean.stage_game_logs(fx(spark, d).game_logs).drop("season_start"), ("player_id", "season")))

register("player_performance", with_fixtures(
    performance_sql("season") + "\nSELECT * FROM perf", *PERF_FIXTURES))(
    lambda spark, d: _perf(spark, d, "season"))

register("player_performance_career", with_fixtures(
    performance_sql("career") + "\nSELECT * FROM perf", *PERF_FIXTURES))(
    lambda spark, d: _perf(spark, d, "career"))


def _mart(spark, d, grain="season"):
    f = fx(spark, d)
    return mart.build_mart(f.players, f.game_logs, f.advanced_stats, grain=grain, as_of=AS_OF)


register("mart_summary", with_fixtures(mart_sql("season") + "\nSELECT * FROM mart", *PERF_FIXTURES))(
    lambda spark, d: _mart(spark, d, "season"))

register("mart_summary_career", with_fixtures(mart_sql("career") + "\nSELECT * FROM mart",
                                              *PERF_FIXTURES))(
    lambda spark, d: _mart(spark, d, "career"))

ROSTER_FIXTURES = ("rosters", "game_logs", "advanced_stats")


def _roster_perf(spark, d, grain):
    f = fx(spark, d)
    return mart.player_performance(f.rosters, f.game_logs, f.advanced_stats, grain=grain, as_of=AS_OF)


register("player_performance_rosters", with_fixtures(
    performance_sql("season", "rosters") + "\nSELECT * FROM perf", *ROSTER_FIXTURES))(
    lambda spark, d: _roster_perf(spark, d, "season"))

register("player_performance_career_rosters", with_fixtures(
    performance_sql("career", "rosters") + "\nSELECT * FROM perf", *ROSTER_FIXTURES))(
    lambda spark, d: _roster_perf(spark, d, "career"))

register("mart_summary_rosters", with_fixtures(mart_sql("season", "rosters") + "\nSELECT * FROM mart", *ROSTER_FIXTURES))(
    lambda spark, d: mart.mart_summary(_roster_perf(spark, d, "season"), as_of=AS_OF))

LEADER_COLS = ("player_id", "season", "player_name", "team_id", "primary_position",
               "performance_score", "points_per_game")


def _leaders_sql(group: str, n: int = 3) -> str:
    return f"""{performance_sql('season')},
{CLASSIFIED_SQL}
SELECT {', '.join(LEADER_COLS)}, group_rank FROM (
  SELECT *, cast(row_number() OVER (PARTITION BY {group}
      ORDER BY performance_score DESC NULLS LAST, player_id, season) AS BIGINT) AS group_rank
  FROM classified) WHERE group_rank <= {n}"""


def _leaders(spark, d, group, n=3):
    classified = mart.classify(_perf(spark, d, "season"))
    out = rank.top_n_per_group(classified, group, "performance_score", n,
                               tiebreak=("player_id", "season"))
    return out.select(*LEADER_COLS, "group_rank")


register("position_leaders", with_fixtures(_leaders_sql("primary_position"), *PERF_FIXTURES))(
    lambda spark, d: _leaders(spark, d, "primary_position"))
register("team_leaders", with_fixtures(_leaders_sql("team_id"), *PERF_FIXTURES))(
    lambda spark, d: _leaders(spark, d, "team_id"))

register("season_fan_out_audit", with_fixtures(
    "SELECT player_id, count(*) AS rows_per_key FROM advanced_stats GROUP BY player_id "
    "HAVING count(*) > 1", "advanced_stats"))(
    lambda spark, d: joins.season_fan_out_audit(fx(spark, d).advanced_stats, ("player_id",)))
