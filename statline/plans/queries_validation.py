"""Registered queries: cross-validation from fold sums (L8, L14), precision–recall curves (V6), rejected payload cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..ml import curves, folds, split
from ..operators import clean
from ..session import scratch_path
from ..sources import payload
from .catalog import fx, register, with_fixtures
from .queries_io import game_log_documents
from .queries_ml import FOLD_SQL, KEY, RULE_PRED_SQL, rule_predictions

# ----------------------------------------------------------------- L14: folds of linear models

ALPHAS = (0.0, 1.0, 10.0, 100.0)

_RIDGE_SQL = f"""WITH s AS (SELECT min AS x1, reb AS x2, pts AS y, {FOLD_SQL} AS fold FROM statlines),
g AS (SELECT avg(x1) AS m1, stddev_pop(x1) AS s1, avg(x2) AS m2, stddev_pop(x2) AS s2 FROM s),
z AS (SELECT fold, (x1 - m1) / s1 AS z1, (x2 - m2) / s2 AS z2, y FROM s CROSS JOIN g),
f AS (SELECT DISTINCT fold FROM z UNION ALL SELECT -1),
m AS (SELECT f.fold, avg(z1) AS a1, avg(z2) AS a2, avg(y) AS ay, covar_pop(z1, z1) * count(*) AS c11,
  covar_pop(z2, z2) * count(*) AS c22, covar_pop(z1, z2) * count(*) AS c12, covar_pop(z1, y) * count(*) AS c1y,
  covar_pop(z2, y) * count(*) AS c2y FROM f JOIN z ON z.fold <> f.fold GROUP BY f.fold),
a AS (SELECT unnest([{', '.join(f'{x!r}E0' for x in ALPHAS)}]) AS alpha),
w AS (SELECT fold, alpha, a1, a2, ay,
  ((c22 + alpha) * c1y - c12 * c2y) / ((c11 + alpha) * (c22 + alpha) - c12 * c12) AS w1,
  ((c11 + alpha) * c2y - c12 * c1y) / ((c11 + alpha) * (c22 + alpha) - c12 * c12) AS w2 FROM m CROSS JOIN a),
r AS (SELECT w.alpha, z.fold, 1 - sum((y - (ay + w1 * (z1 - a1) + w2 * (z2 - a2))) ** 2) / (var_pop(y) * count(*)) AS r2
  FROM z JOIN w ON w.fold = z.fold GROUP BY w.alpha, z.fold)"""


def _ridge(spark, d):
    rows = split.kfold_column(fx(spark, d).statlines.select(*KEY, "min", "reb", "pts"), KEY)
    return folds.ridge_search(spark, folds.fold_sums(rows, ("min", "reb"), "pts"), ALPHAS)


register("cv_ridge_grid", with_fixtures(
    _RIDGE_SQL + "\nSELECT alpha, CAST(fold AS INTEGER) AS fold, round(r2, 9) AS r2 FROM r", "statlines"))(
    lambda spark, d: _ridge(spark, d).scores.withColumn("r2", F.round("r2", 9)))


def _ridge_best(spark, d):
    """The strength with the best mean, and the model refitted with it on all rows."""
    found = _ridge(spark, d)
    best = found.best
    return found.summary.where("is_best").select(
        "alpha", F.round("cv_mean", 9).alias("cv_mean"), F.round("cv_std", 9).alias("cv_std"),
        F.round(F.lit(best.intercept), 6).alias("b0"), F.round(F.lit(float(best.weights[0])), 6).alias("b_min"),
        F.round(F.lit(float(best.weights[1])), 6).alias("b_reb"))


register("cv_ridge_best", with_fixtures(_RIDGE_SQL + """,
t AS (SELECT alpha, avg(r2) AS cv_mean, stddev_pop(r2) AS cv_std FROM r GROUP BY alpha),
b AS (SELECT * FROM t ORDER BY cv_mean DESC, alpha LIMIT 1)
SELECT b.alpha, round(cv_mean, 9) AS cv_mean, round(cv_std, 9) AS cv_std,
  round(ay - w1 * (a1 + m1 / s1) - w2 * (a2 + m2 / s2), 6) AS b0, round(w1 / s1, 6) AS b_min, round(w2 / s2, 6) AS b_reb
FROM b JOIN w ON w.alpha = b.alpha AND w.fold = -1 CROSS JOIN g""", "statlines"))(_ridge_best)

# ----------------------------------------------------------------- V6: curves of rule scores

#: How strongly a row looks like each position.
_SCORES = {"Guard": "ast / (1 + reb)", "Forward": "reb / (1 + ast)", "Center": "1 / (1 + ast + reb)"}
_SCORED_SQL = RULE_PRED_SQL + ",\nsc AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS class, {e.replace('1', '1E0')} AS score, truth = '{c}' AS hit FROM rp JOIN statlines USING (player_id, season)"
    for c, e in _SCORES.items()) + """),
pt AS (SELECT class, score AS threshold, count(*) FILTER (hit) AS pos, count(*) FILTER (NOT hit) AS neg FROM sc GROUP BY 1, 2),
cu AS (SELECT *, sum(pos) OVER up AS tp, sum(neg) OVER up AS fp, sum(pos) OVER (PARTITION BY class) AS p, sum(neg) OVER (PARTITION BY class) AS n
  FROM pt WINDOW up AS (PARTITION BY class ORDER BY threshold DESC))"""


def _scored(spark, d):
    rows = rule_predictions(spark, d)
    return rows.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("class"), F.expr(e).cast("double").alias("score"), (F.col("truth") == c).alias("hit"))
        for c, e in _SCORES.items()])))


register("pr_curve", with_fixtures(_SCORED_SQL + """
SELECT class, threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, tp / (tp + fp) AS precision, tp / p AS recall FROM cu""",
    "statlines"))(lambda spark, d: curves.pr_curve(_scored(spark, d), "score", "hit", ("class",)))

register("average_precision", with_fixtures(_SCORED_SQL + """
SELECT class, CAST(max(p) AS BIGINT) AS positives, CAST(max(n) AS BIGINT) AS negatives,
  round(sum(tp / (tp + fp) * pos) / max(p), 9) AS average_precision,
  round(sum(neg * (tp - pos / 2)) / (max(p) * max(n)), 9) AS roc_auc FROM cu GROUP BY class""", "statlines"))(
    lambda spark, d: curves.curve_summary(_scored(spark, d), "score", "hit", ("class",))
    .withColumns({"average_precision": F.round("average_precision", 9), "roc_auc": F.round("roc_auc", 9)}))

# ----------------------------------------------------------------- S2 + Q10: cells that cannot be converted


def _soiled(spark, d):
    """Game logs landed as payloads, with bad dates and numbers at rows that the key names."""
    logs = clean.stage_game_logs(fx(spark, d).games_by_player)
    logs = logs.withColumns({
        "game_date": F.when(F.col("player_id") % 7 == 2, F.concat(F.lit("day "), F.col("game_date").cast("string")))
        .otherwise(F.col("game_date").cast("string")),
        "pts": F.when(F.col("player_id") % 5 == 1, F.lit("n/a")).when(F.col("player_id") % 5 == 2, F.lit("")).otherwise(F.col("pts").cast("string"))})
    path = scratch_path(spark, "payload-soiled")
    game_log_documents(logs, month=F.substring("game_date", -5, 2)).write.json(path, compression="gzip")
    return payload.read_payloads(spark, path, corrupt=True)


register("decode_bad_rows", with_fixtures("""
SELECT player_id, column_name, cell, reason, count(*) AS cells FROM (
  SELECT player_id, 'game_date' AS column_name, 'day ' || CAST(CAST(game_date AS DATE) AS VARCHAR) AS cell, 'not a date' AS reason
  FROM game_logs WHERE player_id % 7 = 2 AND game_date IS NOT NULL
  UNION ALL SELECT player_id, 'pts', 'n/a', 'not a number' FROM game_logs WHERE player_id % 5 = 1)
GROUP BY ALL""", "game_logs"))(
    lambda spark, d: payload.rejected_cells(_soiled(spark, d).withColumn("player_id", F.col("parameters")["PlayerID"].try_cast("bigint")),
                                            payload.GAME_LOG_LAYOUT, ("player_id",))
    .groupBy("player_id", "column_name", "cell", "reason").agg(F.count(F.lit(1)).alias("cells")))


def _decode_soiled(spark, d):
    """A bad cell costs itself, not its row or the job."""
    rows = payload.decode_game_logs(_soiled(spark, d))
    return rows.select("player_id", F.col("game_date").cast("string").alias("game_date"), "pts", "reb", "ast")


register("decode_soiled", with_fixtures("""
SELECT player_id, CASE WHEN player_id % 7 <> 2 THEN CAST(CAST(game_date AS DATE) AS VARCHAR) END AS game_date,
  CASE WHEN player_id % 5 NOT IN (1, 2) THEN pts END AS pts, reb, ast FROM game_logs""", "game_logs"))(_decode_soiled)
