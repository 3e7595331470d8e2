"""Registered queries: summaries (A5–A14), quantile labels (C4–C7), top-N (T1, P20),
dashboard datasets (V1–V3, V7, V8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import metrics as M
from ..operators import aggregate, classify, clean, dashboard, features, rank
from . import train
from .catalog import fx, quantile_sql, register, with_fixtures
from .queries_features import FEATURES_SQL

# ----------------------------------------------------------------- shared frames

TS_SQL = "pts / nullif((fga + fta * 0.44E0) * 2, 0)"
COMPOSITE_SQL = ("pts * 0.3E0 + reb * 0.2E0 + ast * 0.2E0 + stl * 10.0E0 + blk * 10.0E0"
                 " + ts_pct * 100.0E0")


def _bin_sql(x: str, lo: str, hi: str, bins: int = 4) -> str:
    step = f"(({hi} - {lo}) / {bins})"
    terms = " + ".join(f"CAST({x} > {lo} + {step} * {k} AS INTEGER)" for k in range(1, bins))
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {hi} = {lo} THEN {bins // 2} "
            f"ELSE 1 + {terms} END")


LABELLED_SQL = f"""lab0 AS (SELECT *, {TS_SQL} AS ts_pct FROM statlines),
lab1 AS (SELECT *, {COMPOSITE_SQL} AS composite_score FROM lab0),
labq AS (SELECT {quantile_sql('lab1', 'ast', 0.5)} AS ast_q50, {quantile_sql('lab1', 'ast', 0.7)} AS ast_q70,
           {quantile_sql('lab1', 'pts', 0.5)} AS pts_q50, {quantile_sql('lab1', 'pts', 0.6)} AS pts_q60,
           {quantile_sql('lab1', 'pts', 0.7)} AS pts_q70, {quantile_sql('lab1', 'reb', 0.7)} AS reb_q70,
           {quantile_sql('lab1', 'reb', 0.8)} AS reb_q80),
labmm AS (SELECT min(composite_score) AS lo, max(composite_score) AS hi FROM lab1),
labelled AS (
  SELECT l.*,
    CASE WHEN ast > ast_q70 AND pts < pts_q60 THEN 'Point Guard'
         WHEN pts > pts_q70 AND ast < pts_q50 THEN 'Shooting Guard'
         WHEN reb > reb_q70 AND pts > pts_q50 THEN 'Power Forward'
         WHEN reb > reb_q80 THEN 'Center'
         ELSE 'Small Forward' END AS position,
    ['Bench Player', 'Rotation Player', 'Starter', 'Elite'][{_bin_sql('composite_score', 'lo', 'hi')}]
      AS performance_tier
  FROM lab1 l CROSS JOIN labq CROSS JOIN labmm)"""

DASH_SQL = LABELLED_SQL + ",\n" + FEATURES_SQL.strip()[5:].replace("FROM statlines)", "FROM labelled)") \
    .replace("\nSELECT * EXCLUDE (ff_pts, ff_reb, ff_ast),", ",\ndash AS (SELECT * EXCLUDE (ff_pts, ff_reb, ff_ast),") \
    + ")"


def labelled(spark, d):
    return classify.label_statlines(fx(spark, d).statlines)


def numeric(spark, d):
    """The dashboard frame's numeric columns, without labels and so without their quantiles."""
    df = fx(spark, d).statlines.withColumn("ts_pct", M.true_shooting())
    return features.create_features(df.withColumn("composite_score", M.composite_score()))


def dash(spark, d):
    """Dashboard frame: labelled statlines with the engineered features."""
    return features.create_features(labelled(spark, d))


def sql(body: str, *, dashboard_frame: bool = False, lab: bool = False) -> str:
    if dashboard_frame:
        return with_fixtures("WITH " + DASH_SQL + "\n" + body, "statlines")
    if lab:
        return with_fixtures("WITH " + LABELLED_SQL + "\n" + body, "statlines")
    return with_fixtures(body, "statlines")


# ----------------------------------------------------------------- A5–A14

CORE = ("pts", "reb", "ast", "min", "fg_pct")

register("describe_stats", with_fixtures(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, "
    f"CAST(min({c}) AS DOUBLE) AS min, {quantile_sql('statlines', c, 0.25)} AS p25, "
    f"{quantile_sql('statlines', c, 0.5)} AS p50, {quantile_sql('statlines', c, 0.75)} AS p75, "
    f"CAST(max({c}) AS DOUBLE) AS max FROM statlines" for c in CORE),
    "statlines"))(lambda spark, d: aggregate.describe_stats(fx(spark, d).statlines, CORE))


def _dist_sql(col: str, src: str) -> str:
    return (f"SELECT {col}, count(*) AS count, count(*) * 100.0E0 / sum(count(*)) OVER () AS share_pct "
            f"FROM {src} GROUP BY {col}")


register("position_distribution", sql(_dist_sql("position", "labelled"), lab=True))(
    lambda spark, d: aggregate.value_distribution(labelled(spark, d), "position"))
register("tier_distribution", sql(_dist_sql("performance_tier", "labelled"), lab=True))(
    lambda spark, d: aggregate.value_distribution(labelled(spark, d), "performance_tier"))

TEAM_CLEAN_SQL = "(SELECT regexp_replace(team_name, '^\\s+|\\s+$', '', 'g') AS team_name FROM players)"
register("team_distribution", with_fixtures(_dist_sql("team_name", TEAM_CLEAN_SQL + " t"), "players"))(
    lambda spark, d: aggregate.value_distribution(clean.clean_names(fx(spark, d).players)
                                                  .select("team_name"), "team_name"))

register("distinct_teams", with_fixtures(
    "SELECT count(DISTINCT team_name) AS distinct_team_name FROM players", "players"))(
    lambda spark, d: aggregate.distinct_count(fx(spark, d).players, "team_name"))

PROFILE_COLS = ("pts", "reb", "ast", "true_shooting_percentage", "usage_rate")
register("group_profile", sql(
    "SELECT position, " + ", ".join(
        f"round_even(avg({c}), 2) AS {c}_mean, round_even(stddev_samp({c}), 2) AS {c}_std" for c in PROFILE_COLS)
    + " FROM dash GROUP BY position", dashboard_frame=True))(
    lambda spark, d: aggregate.group_profile(dash(spark, d), "position", PROFILE_COLS))

register("group_means_sorted", sql(
    "SELECT position, avg(pts) AS mean_pts FROM labelled GROUP BY position", lab=True))(
    lambda spark, d: aggregate.group_means_sorted(labelled(spark, d), "position", "pts"))

QSPEC = {"pts": (0.4, 0.5, 0.6, 0.7, 0.8), "reb": (0.7, 0.8), "ast": (0.5, 0.7)}
HOT_SPEC = {"v": (0.0, 0.1, 0.25, 0.5, 0.6, 0.75, 0.99, 1.0)}
register("quantile_hot_value", with_fixtures(
    "WITH hv AS (SELECT CASE WHEN player_id % 2 = 0 THEN 10E0 ELSE pts END AS v FROM statlines) SELECT "
    + ", ".join(f"{quantile_sql('hv', 'v', p)} AS v_q{aggregate._label(p)}" for p in HOT_SPEC["v"]), "statlines"))(
    lambda spark, d: aggregate.quantiles(fx(spark, d).statlines.select(
        F.when(F.col("player_id") % 2 == 0, 10.0).otherwise(F.col("pts")).alias("v")), HOT_SPEC))

register("quantile_table", with_fixtures("SELECT " + ", ".join(
    f"{quantile_sql('statlines', c, p)} AS {c}_q{int(round(p * 100))}"
    for c, ps in QSPEC.items() for p in ps), "statlines"))(
    lambda spark, d: aggregate.quantiles(fx(spark, d).statlines, QSPEC))

register("min_max", with_fixtures(
    "SELECT " + ", ".join(f"min({c}) AS {c}_min, max({c}) AS {c}_max" for c in CORE)
    + " FROM statlines", "statlines"))(
    lambda spark, d: aggregate.min_max(fx(spark, d).statlines, CORE))

register("record_totals", with_fixtures("""
SELECT 'players' AS table_name, count(*) AS records FROM players
UNION ALL SELECT 'game_logs', count(*) FROM game_logs
UNION ALL SELECT 'advanced_stats', count(*) FROM advanced_stats""",
    "players", "game_logs", "advanced_stats"))(
    lambda spark, d: aggregate.record_totals({"players": fx(spark, d).players,
                                              "game_logs": fx(spark, d).game_logs,
                                              "advanced_stats": fx(spark, d).advanced_stats}))

register("high_water_mark", with_fixtures(
    "SELECT max(data_loaded_at) AS max_data_loaded_at FROM arrivals", "arrivals"))(
    lambda spark, d: aggregate.column_max(fx(spark, d).arrivals, "data_loaded_at"))

# ----------------------------------------------------------------- C4–C7

register("position_quantile3", with_fixtures(f"""
WITH q AS (SELECT {quantile_sql('statlines', 'ast', 0.7)} AS aq, {quantile_sql('statlines', 'reb', 0.7)} AS rq)
SELECT player_id, season, pts, reb, ast,
  CASE WHEN ast > aq THEN 'Guard' WHEN reb > rq THEN 'Forward' ELSE 'Center' END AS position
FROM statlines CROSS JOIN q""", "statlines"))(
    lambda spark, d: classify.position_by_quantile3(
        fx(spark, d).statlines.select("player_id", "season", "pts", "reb", "ast")))

register("tier_quantile", with_fixtures(f"""
WITH q AS (SELECT {quantile_sql('statlines', 'pts', 0.4)} AS q40, {quantile_sql('statlines', 'pts', 0.6)} AS q60,
                  {quantile_sql('statlines', 'pts', 0.8)} AS q80)
SELECT player_id, season, pts,
  CASE WHEN pts > q80 THEN 'Elite' WHEN pts > q60 THEN 'All-Star' WHEN pts > q40 THEN 'Starter'
       ELSE 'Bench' END AS performance_tier
FROM statlines CROSS JOIN q""", "statlines"))(
    lambda spark, d: classify.tier_by_quantile(
        fx(spark, d).statlines.select("player_id", "season", "pts")))

register("position_quantile5", sql(
    "SELECT player_id, season, pts, reb, ast, position FROM labelled", lab=True))(
    lambda spark, d: labelled(spark, d).select("player_id", "season", "pts", "reb", "ast",
                                               "position"))

register("tier_equal_width", sql(
    "SELECT player_id, season, composite_score, performance_tier FROM labelled", lab=True))(
    lambda spark, d: labelled(spark, d).select("player_id", "season", "composite_score",
                                               "performance_tier"))

# ----------------------------------------------------------------- T1, P20

TOP_COLS = ("player_id", "season", "pts", "reb", "ast", "position", "performance_tier")


def _top_sql(by: str, cols=TOP_COLS) -> str:
    return sql(f"SELECT {', '.join(cols)} FROM dash WHERE {by} IS NOT NULL AND NOT isnan({by}) "
               f"ORDER BY {by} DESC, player_id, season LIMIT 10", dashboard_frame=True)


def _top(by: str, cols=TOP_COLS):
    return lambda spark, d: rank.top_n(dash(spark, d), by, 10, cols=list(cols),
                                       tiebreak=("player_id", "season"))


register("top_scorers", _top_sql("pts"))(_top("pts"))
register("top_rebounders", _top_sql("reb"))(_top("reb"))
register("top_playmakers", _top_sql("ast"))(_top("ast"))
EFF_COLS = ("player_id", "season", "pts", "true_shooting_percentage", "usage_rate", "position")
register("top_efficiency", _top_sql("true_shooting_percentage", EFF_COLS))(
    _top("true_shooting_percentage", EFF_COLS))

ELITE_COLS = ("player_id", "season", "pts", "reb", "ast", "true_shooting_percentage", "position")
register("elite_players", sql(
    f"SELECT {', '.join(ELITE_COLS)} FROM dash WHERE performance_tier = 'Elite'",
    dashboard_frame=True))(
    lambda spark, d: clean.filter_tier(dash(spark, d), "Elite", cols=list(ELITE_COLS)))

register("sample_rows", with_fixtures(
    "SELECT player_id, season, pts, reb, ast FROM statlines ORDER BY player_id, season LIMIT 2", "statlines"))(
    lambda spark, d: rank.sample_rows(fx(spark, d).statlines.select("player_id", "season", "pts", "reb", "ast"), 2,
                                      ("player_id", "season")))

# ----------------------------------------------------------------- V1, V3, V7, V8


def _hist_sql(col: str, bins: int, src: str = "statlines") -> str:
    return f"""WITH mm AS (SELECT min({col}) AS lo, max({col}) AS hi FROM {src}),
b AS (SELECT CASE WHEN hi = lo THEN 0 ELSE least(CAST(floor(({col} - lo) / (hi - lo) * {bins}) AS INTEGER), {bins - 1}) END AS bin
      FROM {src} CROSS JOIN mm WHERE {col} IS NOT NULL),
c AS (SELECT bin, count(*) AS count FROM b GROUP BY bin)
SELECT r.bin, lo + (hi - lo) / {bins} * r.bin AS bin_start, lo + (hi - lo) / {bins} * (r.bin + 1) AS bin_end,
  coalesce(c.count, 0) AS count
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range({bins})) r CROSS JOIN mm LEFT JOIN c ON r.bin = c.bin"""


register("histogram_points", with_fixtures(_hist_sql("pts", 30), "statlines"))(
    lambda spark, d: dashboard.histogram(fx(spark, d).statlines, "pts", 30))
register("histogram_rebounds", with_fixtures(_hist_sql("reb", 30), "statlines"))(
    lambda spark, d: dashboard.histogram(fx(spark, d).statlines, "reb", 30))


def _grid_sql(x: str, y: str, bins: int, shade: str | None = None) -> str:
    def b(c):
        return (f"CASE WHEN {c}hi = {c}lo THEN 0 ELSE least(CAST(floor(({c}v - {c}lo) / ({c}hi - {c}lo)"
                f" * {bins}) AS INTEGER), {bins - 1}) END")
    more = f", avg(shade) AS mean_{shade}" if shade else ""
    return f"""WITH src AS (SELECT *, pts / nullif(2 * (fga + 0.44E0 * fta), 0) AS ts_pct FROM statlines),
mm AS (SELECT min({x}) AS xlo, max({x}) AS xhi, min({y}) AS ylo, max({y}) AS yhi FROM src),
p AS (SELECT {x} AS xv, {y} AS yv, {shade or x} AS shade FROM src WHERE {x} IS NOT NULL AND {y} IS NOT NULL)
SELECT {b('x')} AS x_bin, {b('y')} AS y_bin, count(*) AS count, avg(xv) AS mean_{x}, avg(yv) AS mean_{y}{more}
FROM p CROSS JOIN mm GROUP BY 1, 2"""


register("scatter_pts_ast", with_fixtures(_grid_sql("pts", "ast", 20), "statlines"))(
    lambda spark, d: dashboard.scatter_grid(fx(spark, d).statlines, "pts", "ast", 20))

register("scatter_efficiency", with_fixtures(_grid_sql("fg_pct", "ts_pct", 20, "pts"), "statlines"))(
    lambda spark, d: dashboard.scatter_grid(fx(spark, d).statlines.withColumn("ts_pct", M.true_shooting()),
                                            "fg_pct", "ts_pct", 20, shade="pts"))

register("histogram_assists", with_fixtures(_hist_sql("ast", 30), "statlines"))(
    lambda spark, d: dashboard.histogram(fx(spark, d).statlines, "ast", 30))

register("scatter_grid", with_fixtures(_grid_sql("pts", "reb", 20), "statlines"))(
    lambda spark, d: dashboard.scatter_grid(fx(spark, d).statlines, "pts", "reb", 20))

register("position_comparison", sql(
    "SELECT position, avg(pts) AS mean_pts, avg(reb) AS mean_reb, avg(ast) AS mean_ast, "
    "avg(ts_pct) AS mean_ts_pct FROM labelled GROUP BY position", lab=True))(
    lambda spark, d: dashboard.position_comparison(labelled(spark, d)))

KEY_FEATURES = ("true_shooting_percentage", "effective_field_goal_pct", "pts_per_min",
                "ast_to_ratio", "usage_rate")


def _feature_summary(spark, d):
    lab = labelled(spark, d)
    return dashboard.feature_summary(features.create_features(lab), lab.columns, KEY_FEATURES)


register("feature_summary", sql(
    "SELECT " + ", ".join(f"avg({c}) AS mean_{c}" for c in KEY_FEATURES)
    + ", CAST(22 AS BIGINT) AS original_features, CAST(23 AS BIGINT) AS engineered_features, "
      "CAST(45 AS BIGINT) AS total_features FROM dash", dashboard_frame=True))(_feature_summary)



def _dashboard_sizes(spark, d):
    """Rows of each chart dataset."""
    charts = train.dashboard_datasets(fx(spark, d).statlines, fx(spark, d).players)
    out = None
    for name in CHARTS:
        n = charts[name].agg(F.lit(name).alias("chart"), F.count("*").alias("rows"))
        out = n if out is None else out.unionByName(n)
    return out


CHARTS = ("summary", "histogram_pts", "histogram_reb", "histogram_ast", "top_scorers", "top_rebounders",
          "position_distribution", "tier_distribution", "position_comparison", "team_bars")

register("dashboard_sizes", with_fixtures("WITH " + LABELLED_SQL + """
SELECT * FROM (VALUES ('summary', 5::BIGINT), ('histogram_pts', 30), ('histogram_reb', 30), ('histogram_ast', 30),
  ('top_scorers', 10), ('top_rebounders', 10)) t(chart, rows)
UNION ALL SELECT 'position_distribution', count(DISTINCT position) FROM labelled
UNION ALL SELECT 'tier_distribution', count(DISTINCT performance_tier) FROM labelled
UNION ALL SELECT 'position_comparison', count(DISTINCT position) FROM labelled
UNION ALL SELECT 'team_bars', count(DISTINCT coalesce(team_name, '-')) FROM players""", "statlines", "players"))(_dashboard_sizes)
