"""Hand-worked cases for formulas, cleaning, rules, bins, quality and history."""

import math

import pytest
from pyspark.sql import functions as F

from statline.functions import metrics as M
from statline.functions import rules
from statline.functions.safe import clamp
from statline.operators import aggregate, classify, clean, features, quality

PROSPECTS = [
    # id, pts, reb, ast, min, fgm, fga, fg3m, fg3a, ftm, fta, stl, blk, tov
    (999, 20.0, 8.0, 6.0, 30.0, 8.0, 16.0, 3.0, 8.0, 4.0, 5.0, 1.5, 1.0, 3.0),
    (998, 15.0, 6.0, 4.0, 25.0, 6.0, 12.0, 2.0, 5.0, 3.0, 4.0, 1.0, 0.8, 2.0),
    (997, 18.0, 7.0, 5.0, 28.0, 7.0, 14.0, 2.0, 6.0, 4.0, 5.0, 1.2, 0.9, 2.5),
]
COLS = "player_id long, pts double, reb double, ast double, min double, fgm double, fga double, " \
       "fg3m double, fg3a double, ftm double, fta double, stl double, blk double, tov double"


@pytest.fixture(scope="module")
def prospects(spark):
    return spark.createDataFrame(PROSPECTS, COLS)


def test_true_shooting_of_prospect(prospects):
    row = prospects.where("player_id = 999").select(M.true_shooting().alias("ts")).first()
    assert row.ts == pytest.approx(20 / (2 * (16 + 0.44 * 5)), rel=1e-12)
    assert round(row.ts, 6) == 0.549451


def test_metric_formulas_by_hand(prospects):
    r = prospects.where("player_id = 999").select(
        M.effective_fg().alias("efg"), M.usage_rate().alias("usg"), M.game_score().alias("gs"),
        M.box_plus_minus().alias("bpm"), M.ast_to_ratio().alias("atr"),
        M.win_shares_per_48().alias("ws")).first()
    assert r.efg == pytest.approx((8 + 1.5) / 16)
    assert r.usg == pytest.approx((16 + 0.44 * 5 + 3) / 30 * 48)
    assert r.gs == pytest.approx(20 + 3.2 - 11.2 - 0.4 + 5.6 + 1.8 + 1.5 + 0.7 - 1.2)
    assert r.bpm == pytest.approx(20 + 9.6 + 9 + 3 + 2 - 4.5)
    assert r.atr == pytest.approx(6 / 4)
    assert r.ws == pytest.approx((20 + 8 + 6 + 1.5 + 1 - 3) / 30 * 48)


def test_zero_denominators_give_null(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 0.0, 0.0, 0.0)],
                               "pts double, fga double, fta double, min double, fgm double, fg3m double")
    r = df.select(M.true_shooting().alias("ts"), M.effective_fg().alias("efg"),
                  M.per_minute("pts").alias("ppm")).first()
    assert r.ts is None and r.efg is None and r.ppm is None


def test_clamp_keeps_null_and_bounds(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (50.0,), (150.0,)], "x double")
    got = [r.c for r in df.select(clamp("x", 0, 100).alias("c")).collect()]
    assert got == [None, 0.0, 50.0, 100.0]


def test_scores_null_inputs_stay_null(spark):
    cols = ["points_per_game", "rebounds_per_game", "assists_per_game", "steals_per_game",
            "blocks_per_game", "turnovers_per_game", "player_efficiency_rating",
            "true_shooting_pct", "win_shares_per_48"]
    df = spark.createDataFrame([tuple([1.0] * 8 + [None])], ", ".join(f"{c} double" for c in cols))
    assert df.select(M.performance_score().alias("s")).first().s is None


def test_name_and_team_cascades(spark):
    names = [("James, LeBron",), (" A , B ",), ("A,B,C",), ("X,",), ("Plain",), (None,), ("\tTab",)]
    df = clean.standardize_name(clean.clean_names(spark.createDataFrame(names, "player_name string")))
    got = [r.standardized_player_name for r in df.collect()]
    assert got == ["LeBron James", "B A", "B A", " X", "Plain", None, "Tab"]
    teams = [("LAL",), ("Los Angeles Lakers",), ("lakers",), ("Hornets",), ("Nets",)]
    t = clean.standardize_team(spark.createDataFrame(teams, "team_name string"))
    assert [r.standardized_team_name for r in t.collect()] == [
        "Los Angeles Lakers", "Los Angeles Lakers", "lakers", "Hornets", "Brooklyn Nets"]


def test_numeric_coercion(spark):
    df = spark.createDataFrame([("abc",), ("nan",), (" 1.5 ",), ("inf",), (None,)], "x string")
    got = [r.x for r in clean.coerce_numeric(df, ["x"]).collect()]
    assert got[0] is None and got[1] is None and got[2] == 1.5 and math.isinf(got[3])
    assert got[4] is None


def test_rules_fall_through_on_null(spark):
    df = spark.createDataFrame([(None, 3.0, 7.0), (30.0, 2.0, 3.0), (9.0, 12.0, 2.0)],
                               "points_per_game double, rebounds_per_game double, assists_per_game double")
    got = [r.p for r in df.select(rules.primary_position().alias("p")).collect()]
    assert got == ["Utility Player", "Shooting Guard", "Center"]


def test_iqr_cap(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 100]] + [(None,)], "v double")
    got = sorted((r.v for r in aggregate.cap_outliers_iqr(df, ["v"]).collect()),
                 key=lambda v: (v is None, v))
    # q1 = 2, q3 = 4, iqr = 2 → upper bound 7
    assert got == [1.0, 2.0, 3.0, 4.0, 7.0, None]


def test_constant_column_iqr_and_bins(spark):
    df = spark.createDataFrame([(5.0,)] * 4, "v double")
    assert {r.v for r in aggregate.cap_outliers_iqr(df, ["v"]).collect()} == {5.0}
    tiers = classify.equal_width_tier(df, "v", out="t")
    assert {r.t for r in tiers.collect()} == {"Rotation Player"}


def test_equal_width_edges(spark):
    # range 0..4, inner edges 1, 2, 3; right-closed bins, minimum included
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 1.5, 2, 3, 3.5, 4]], "v double")
    got = [r.b for r in classify.equal_width_tier(df, "v", out="t", bin_col="b")
           .orderBy("v").collect()]
    assert got == [1, 1, 2, 2, 3, 4, 4]


def test_quality_gate(spark):
    nine = spark.createDataFrame([(i, "n") for i in range(9)], "player_id long, player_name string")
    with pytest.raises(quality.QualityError):
        quality.validate({"t": nine})
    # 10 rows, 2 columns, 2 missing cells = exactly 10 %: passes
    ten = spark.createDataFrame([(i, None if i < 2 else "n") for i in range(10)],
                                "player_id long, player_name string")
    rep = quality.validate({"t": ten}).first()
    assert rep.missing_share == pytest.approx(0.1) and rep.missing_ok


def test_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,), (None,)], "player_id long")
    assert quality.quality_summary(df).first().duplicate_keys == 3


def test_rules_report_and_quarantine(spark):
    df = spark.createDataFrame(
        [(1, "2023-24", 30.0, 10.0, 5.0, 3.0), (2, "2023-2024", 50.0, -1.0, 5.0, 3.0),
         (None, None, 20.0, 1.0, 1.0, 1.0)],
        "player_id long, season string, minutes_per_game double, points_per_game double, "
        "rebounds_per_game double, assists_per_game double")
    rep = {r.rule_name: r.violations for r in quality.run_rules(df).collect()}
    assert rep == {"non_null_player_id": 1, "valid_season_format": 1,
                   "reasonable_minutes_per_game": 1, "positive_stats": 1}
    q = {r.player_id: r.failed_rules for r in quality.quarantine(df).collect()}
    assert q[1] is None
    assert q[2] == "valid_season_format,reasonable_minutes_per_game,positive_stats"
    assert q[None] == "non_null_player_id"


def test_history_gaps_and_order(spark):
    rows = [(1, "2002-03", 30.0), (1, "2000-01", 10.0), (1, "2001-02", None), (2, "2000-01", 0.0),
            (2, "2001-02", 5.0), (3, "2000-01", 7.0)]
    df = spark.createDataFrame(rows, "player_id long, season string, pts double")
    out = features.pct_change(features.lag_features(df, ["pts"]), ["pts"])
    got = {(r.player_id, r.season): (r.prev_season_pts, r.pts_trend) for r in out.collect()}
    assert got[(1, "2000-01")] == (None, None)
    assert got[(1, "2001-02")] == (10.0, 0.0)          # gap filled forward
    assert got[(1, "2002-03")][1] == pytest.approx(2.0)  # 30 / 10 - 1
    assert got[(2, "2001-02")] == (0.0, None)           # previous 0 → NULL, not inf
    assert got[(3, "2000-01")] == (None, None)


@pytest.mark.parametrize("values", [
    [float(i % 40) for i in range(500)] + [None, float("nan")],
    [10.0] * 300 + [float(i) / 7 for i in range(200)],
    [0.0, -0.0, -5e-324, 5e-324, -1e300, 1e300, -3.5, -3.5, 2.0**-1000, float("inf"), 1.0, 1.0 + 2**-52],
    [1.0 + i * 2**-52 for i in range(300)] + [-1e9, 1e9],
    [7.0],
])
def test_counted_quantiles_equal_sorted(spark, values):
    """Exact for hot values, neighbours of one bit, all magnitudes and both signs."""
    import numpy as np
    df = spark.createDataFrame([(v, i % 3) for i, v in enumerate(values)], "v double, g long")
    good = np.sort([v for v in values if v is not None and not math.isnan(v)])
    probs = (0.0, 0.1, 0.5, 0.73, 1.0)
    got = aggregate.quantiles(df, {"v": probs}).first()
    for p in probs:
        pos = (len(good) - 1) * p
        lo, hi = float(good[math.floor(pos)]), float(good[math.ceil(pos)])
        want = lo if lo == hi else lo + (hi - lo) * (pos - math.floor(pos))
        have = got[f"v_q{aggregate._label(p)}"]
        assert have == pytest.approx(want, rel=1e-12) or math.isnan(want)
    per_group = {r.g: r.v_q50 for r in aggregate.quantiles(df, {"v": (0.5,)}, by=("g",)).collect()}
    for g in range(3):
        own = [v for i, v in enumerate(values) if i % 3 == g and v is not None and not math.isnan(v)]
        if own:
            assert per_group[g] == pytest.approx(float(np.median(own)), nan_ok=True)


@pytest.mark.parametrize("shape", ["normal", "hot", "magnitudes", "steps"])
def test_counted_quantiles_of_many_values(spark, shape, monkeypatch):
    """More values than are counted one by one: brackets are cut into parts; the rounds stay few."""
    import numpy as np
    rng = np.random.default_rng(5)
    n = 300_000
    values = {"normal": rng.normal(size=n), "steps": np.floor(rng.normal(size=n) * 50),
              "hot": np.where(rng.random(n) < 0.4, 3.25, rng.normal(size=n)),
              "magnitudes": np.exp(rng.normal(size=n) * 40) * np.where(rng.random(n) < 0.5, -1, 1)}[shape]
    import pandas as pd
    rounds = []
    write = aggregate.saved
    monkeypatch.setattr(aggregate, "saved", lambda df, name: rounds.append(name) or write(df, name))
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    probs = (0.01, 0.25, 0.5, 0.8, 0.999)
    got = aggregate.quantiles(df, {"v": probs}).first()
    want = np.quantile(values, probs)
    assert [got[f"v_q{aggregate._label(p)}"] for p in probs] == pytest.approx(list(want), rel=1e-12)
    assert rounds.count("quantile-ranks") <= 2


def test_quantiles_need_no_good_sketch(spark, monkeypatch):
    """Brackets that miss every wanted rank cost a pass, not the result."""
    monkeypatch.setattr(aggregate, "BRACKET", -0.2)
    df = spark.range(5000).selectExpr("CAST((id * 7919) % 5003 AS DOUBLE) AS v")
    import numpy as np
    want = np.quantile([(i * 7919) % 5003 for i in range(5000)], [0.3, 0.5])
    got = aggregate.quantiles(df, {"v": (0.3, 0.5)}).first()
    assert (got.v_q30, got.v_q50) == pytest.approx(tuple(want))


def test_quantiles_without_values(spark):
    df = spark.createDataFrame([(None, 1)], "v double, g long")
    assert aggregate.quantiles(df, {"v": (0.5,)}).first().v_q50 is None
    assert aggregate.quantiles(df, {"v": (0.5,)}, by=("g",)).collect() == []


def test_contract_report(spark):
    from statline.operators.quality import check_contract
    from pyspark.sql import types as T
    df = spark.createDataFrame([(1, "a", 2.0)], "player_id long, season string, extra double")
    contract = T.StructType.fromDDL("player_id bigint, season bigint, pts double")
    assert {r["column_name"]: r["status"] for r in check_contract(df, contract)} == {
        "player_id": "ok", "season": "type_mismatch", "pts": "missing", "extra": "undeclared"}


def test_constant_columns_do_not_count_for_gamma(spark):
    from statline.ml import models, split
    df = spark.createDataFrame([(1.0, 5.0, 0.0), (3.0, 5.0, 0.0)], "a double, b double, c double")
    params = split.fit_standard_scaler(df, ["a", "b", "c"])
    assert params.constant == ("b", "c") and params["a"] == (2.0, 1.0) and params["b"] == (5.0, 1.0)
    prep = models.Prepared(df, ["a", "b", "c"], "y", "regression", ("a",), params)
    assert models._gamma_scale(prep) == pytest.approx(1.0)


def test_class_cutoffs_equal_ranks(spark):
    from pyspark.sql import Window
    from statline.ml import split
    df = spark.range(4000).selectExpr("id AS player_id", "'2000-01' AS season",
                                      "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 1000 = 1 THEN NULL ELSE concat('c', id % 5) END AS label")
    got = {r.player_id for r in split.stratified_split(df, "label").where("is_test").collect()}
    h = split.key_hash(("player_id", "season"))
    place = F.row_number().over(Window.partitionBy("label").orderBy(h, "player_id", "season"))
    size = F.count("*").over(Window.partitionBy("label"))
    want = {r.player_id for r in df.withColumn("p", place).withColumn("n", size).where("p <= round(n * 0.2)").collect()}
    assert got == want


def test_features_are_scored_a_few_at_a_time(spark, monkeypatch):
    """Dozens of corr in one aggregate are too much code to compile; the choice is that of all scores together."""
    from statline.ml import selection
    df = spark.range(300).select("id", *[F.sin(F.col("id") * (i + 1)).alias(f"f{i}") for i in range(19)],
                                 (F.sin(F.col("id") * 3) + F.sin(F.col("id") * 18) / 2 + F.rand(5)).alias("y"))
    feats, plain, sizes = [f"f{i}" for i in range(19)], selection.f_regression_scores, []
    want = {r.feature for r in selection.rank_features(plain(df, feats, "y"), 6).where("selected").collect()}
    monkeypatch.setattr(selection, "f_regression_scores", lambda d, f, t: sizes.append(len(f)) or plain(d, f, t))
    assert selection.select_features(df, "y", k=6, exclude=("id",)) == [f for f in feats if f in want]
    assert {"f2", "f17"} <= want and sum(sizes) == 19 and max(sizes) <= selection.TOGETHER
