"""Registered queries: stored mergeable sketches by season (A5, A7, A10, S9) and clustered catalog tables (K4, K8)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import features, sketches
from ..session import scratch_path
from ..sinks import clustered
from . import mart
from .catalog import AS_OF, fx, register, with_fixtures
from .queries_features import W
from .queries_mart import PERF_FIXTURES, performance_sql

NUMBERS, DISTINCT = ("pts", "reb"), ("player_id",)
#: Years whose states are there first; all others come as a backfill.
_FIRST = (1993, 1995)


def _stored(spark, d):
    """Game logs in folders by year, states of some years, then a backfill of the others; years present."""
    logs, base = fx(spark, d).game_logs.select("season_start", "player_id", *NUMBERS), scratch_path(spark, "sketches")
    logs.write.partitionBy("season_start").parquet(f"{base}/facts")
    facts = spark.read.parquet(f"{base}/facts").withColumn("season_start", F.col("season_start").cast("long"))
    years = [r[0] for r in facts.select("season_start").distinct().collect()]  # one row for each season
    for part in ([y for y in years if y in _FIRST], [y for y in years if y not in _FIRST]):
        sketches.refresh(spark, facts, f"{base}/states", "season_start", NUMBERS, DISTINCT, part)
    return facts, sketches.stored(spark, f"{base}/states", "season_start")


def _held_against(facts, state, by):
    """Answers of the states, with each estimate held against exact counts."""
    got = sketches.answers(state, {c: (0.25, 0.5, 0.9) for c in NUMBERS})
    rank = {f"{c}_q{q}": (c, p) for c in NUMBERS for q, p in ((25, 0.25), (50, 0.5), (90, 0.9))}
    rows = facts.join(got, list(by)) if by else facts.crossJoin(F.broadcast(got))
    # counted by themselves: beside a distinct count, every other aggregate would be kept for each season and player
    players = facts.where(F.col("player_id").isNotNull()).select(*by, "player_id").distinct() \
                   .groupBy(*by).agg(F.count("player_id").alias("players"))
    held = rows.groupBy(*by).agg(
        F.first("player_id_distinct").alias("__players"),
        *[F.avg((F.col(c) < F.col(q)).cast("double")).alias(f"__below_{q}") for q, (c, _) in rank.items()],
        *[F.avg((F.col(c) <= F.col(q)).cast("double")).alias(f"__upto_{q}") for q, (c, _) in rank.items()],
        *[F.first(x).alias(x) for c in NUMBERS for x in (f"{c}_count", f"{c}_mean", f"{c}_std", f"{c}_min", f"{c}_max")], F.first("rows").alias("rows"))
    held = held.join(players, list(by), "left") if by else held.crossJoin(F.broadcast(players))
    held = held.withColumn("players", F.coalesce("players", F.lit(0).cast("long")))
    return held.select(
        *by, "rows", "players", *[f"{c}_{x}" for c in NUMBERS for x in ("count", "min", "max")],
        *[F.round(f"{c}_{x}", 6).alias(f"{c}_{x}") for c in NUMBERS for x in ("mean", "std")],
        (F.abs(F.col("__players") - F.col("players")) <= F.col("players") * sketches.DISTINCT_ERROR + 1).alias("players_near"),
        *[((F.col(f"__below_{q}") <= p + sketches.RANK_ERROR) & (F.col(f"__upto_{q}") >= p - sketches.RANK_ERROR)).alias(f"{q}_near")
          for q, (_, p) in rank.items()])


_EXACT_SQL = ("count(*) AS rows, count(DISTINCT player_id) AS players, "
              + ", ".join(f"count({c}) AS {c}_count, round(avg({c}), 6) AS {c}_mean, round(stddev_samp({c}), 6) AS {c}_std, "
                          f"CAST(min({c}) AS DOUBLE) AS {c}_min, CAST(max({c}) AS DOUBLE) AS {c}_max" for c in NUMBERS)
              + ", true AS players_near, " + ", ".join(f"true AS {c}_q{q}_near" for c in NUMBERS for q in (25, 50, 90))
              + " FROM game_logs")


def _by_season(spark, d):
    facts, state = _stored(spark, d)
    return _held_against(facts, state, ("season_start",))


def _all_seasons(spark, d):
    facts, state = _stored(spark, d)
    return _held_against(facts, sketches.merged(state), ())


register("sketch_seasons", with_fixtures(f"SELECT season_start, {_EXACT_SQL} GROUP BY season_start", "game_logs"))(_by_season)
register("sketch_all_seasons", with_fixtures(f"SELECT {_EXACT_SQL}", "game_logs"))(_all_seasons)


# ------------------------------------------------------------------ clustered tables

#: Least number of buckets, and rows that one bucket should hold at most: a task sorts it as a whole.
BUCKETS, ROWS_PER_BUCKET = 8, 500_000


def buckets_for(*tables) -> int:
    """Buckets that hold the largest of ``tables``; tables that join bucket by bucket share the number."""
    return max(BUCKETS, *(-(-t.count() // ROWS_PER_BUCKET) for t in tables))


def clustered_table(spark, df, name, sort=(), buckets=BUCKETS, **options):
    """``df`` as a catalog table of its own for this call."""
    return clustered.save_clustered(df, f"{name}_{uuid.uuid4().hex[:12]}", scratch_path(spark, name), "player_id", sort, buckets, **options)


def _prev_season(spark, d):
    seasons = fx(spark, d).statlines.select("player_id", "season", "pts", "reb", "ast")
    held = clustered_table(spark, seasons, "statlines", ("season",), buckets_for(seasons))
    return features.lag_features(held)


register("prev_season_clustered", with_fixtures(f"""
SELECT player_id, season, pts, reb, ast, lag(pts) OVER ({W}) AS prev_season_pts,
  lag(reb) OVER ({W}) AS prev_season_reb, lag(ast) OVER ({W}) AS prev_season_ast FROM statlines""", "statlines"))(_prev_season)


def performance_clustered(spark, d):
    """J1, J2 over clustered inputs."""
    f = fx(spark, d)
    buckets = buckets_for(f.players, f.game_logs, f.advanced_stats)
    tables = [clustered_table(spark, t, name, buckets=buckets) for t, name in ((f.players, "players"), (f.game_logs, "game_logs"), (f.advanced_stats, "advanced"))]
    return mart.player_performance(*tables, as_of=AS_OF)


register("player_performance_clustered", with_fixtures(performance_sql("season") + "\nSELECT * FROM perf", *PERF_FIXTURES))(performance_clustered)

# Options of the season table.
COMMENT = "One row for each player and season"
PROPERTIES = {"domain": "sports", "team": "analytics"}
COLUMN_COMMENT = "Points per game"


def _options(spark, d):
    name = f"seasons_{uuid.uuid4().hex[:12]}"
    held = clustered.save_clustered(fx(spark, d).statlines, name, scratch_path(spark, "seasons"), "player_id", ("season",), BUCKETS,
                                    COMMENT, PROPERTIES, {"pts": COLUMN_COMMENT})
    return clustered.clustered_options(spark, name).crossJoin(held.agg(F.count(F.lit(1)).alias("rows")))


register("clustered_options", with_fixtures(
    "SELECT o.*, n AS rows FROM (SELECT count(*) AS n FROM statlines) CROSS JOIN (VALUES "
    f"('table', 'Comment', '{COMMENT}'), ('table', 'Num Buckets', '{BUCKETS}'), ('table', 'Bucket Columns', '[`player_id`]'), "
    f"('table', 'Sort Columns', '[`player_id`, `season`]'), ('column', 'pts', '{COLUMN_COMMENT}'), "
    + ", ".join(f"('property', '{k}', '{v}')" for k, v in PROPERTIES.items()) + ") o(kind, name, text)", "statlines"))(_options)
