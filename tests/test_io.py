"""Sources, sinks and small operators not covered by the query catalog."""

import json
import os

from pyspark.sql import functions as F

from statline.functions import metrics as M
from statline.operators import features
from statline.session import scratch_path
from statline.sinks import writers
from statline.sources import landed, payload, views


def test_manifest_and_freshness_gate(spark):
    path = scratch_path(spark, "manifest")
    writers.write_manifest(spark, path, "2023-24", 120, as_of="2024-01-01 00:00:00")
    writers.write_manifest(spark, path, "2022-23", 90, as_of="2023-06-01 00:00:00")
    gate = landed.freshness_gate(spark.read.parquet(path), lookback_days=7,
                                 as_of="2024-01-05 00:00:00")
    due = {r.season: r.refresh_due for r in gate.collect()}
    assert due == {"2023-24": False, "2022-23": True}


def test_incremental_delta_empty_target_and_lookback(spark):
    rows = [(1, "2024-01-01 00:00:00"), (2, "2024-01-05 00:00:00"), (3, "2024-01-09 00:00:00")]
    src = spark.createDataFrame(rows, "id long, t string").withColumn(
        "data_loaded_at", F.to_timestamp_ntz("t")).drop("t")
    empty = src.limit(0)
    assert landed.incremental_delta(src, empty).count() == 3
    loaded = src.where("id <= 2")
    assert sorted(r.id for r in landed.incremental_delta(src, loaded).collect()) == [3]
    assert sorted(r.id for r in landed.incremental_delta(src, loaded, lookback="3 days")
                  .collect()) == [2, 3]


def test_annotate_and_views(spark):
    df = writers.annotate(spark.range(3).withColumnRenamed("id", "player_id"),
                          {"player_id": "Unique player identifier"})
    assert df.schema["player_id"].metadata["comment"] == "Unique player identifier"
    views.register_views({"players_view_test": df})
    assert views.ref(spark, "players_view_test").count() == 3


def test_body_and_team_features_only_when_present(spark):
    base = spark.createDataFrame(
        [(1, "2000-01", 20.0, 8.0, 6.0, 30.0, 8.0, 16.0, 3.0, 4.0, 5.0, 1.0, 1.0, 3.0, 0.5)],
        "player_id long, season string, pts double, reb double, ast double, min double, "
        "fgm double, fga double, fg3m double, ftm double, fta double, stl double, blk double, "
        "tov double, fg_pct double")
    plain = features.create_features(base)
    assert "bmi" not in plain.columns and "team_win_pct" not in plain.columns
    rich = features.create_features(base.withColumns({
        "height": F.lit(2.0), "weight": F.lit(100.0), "team_wins": F.lit(30.0),
        "team_games": F.lit(60.0)}))
    r = rich.first()
    assert r.bmi == 25.0 and r.height_weight_ratio == 0.02
    assert r.team_win_pct == 0.5 and r.team_context_score == 10.0
    assert len(plain.columns) - len(base.columns) == 23


def test_payload_mixed_cells_and_bad_values(spark, tmp_path):
    doc = {"parameters": {"PlayerID": "7", "Season": "2023-24"},
           "resultSets": [{"headers": [], "rowSet": [
               [None, None, "2024-01-02", "LAL vs. GSW", "W", 31, 8, 15, 0.533, 2, 5, 0.4, 4, 4, 1.0,
                1, 5, 6, 7, 1, 0, 2, 3, 22, 5],
               [None, None, "2024-01-04", "LAL @ BOS", "L", "bad", 8, 15, 0.533, 2, 5, 0.4, 4, 4,
                1.0, 1, 5, 6, 7, 1, 0, 2, 3, 22, -5]]}]}
    path = os.path.join(str(tmp_path), "p.json")
    with open(path, "w") as fh:
        fh.write(json.dumps(doc) + "\n")
    rows = payload.decode_game_logs(payload.read_payloads(spark, path)).orderBy("game_date").collect()
    assert [r.player_id for r in rows] == [7, 7]
    assert rows[0].minutes == 31.0 and rows[1].minutes is None
    assert rows[0].pts == 22.0 and rows[1].plus_minus == -5.0 and rows[0].wl == "W"


def test_three_prospects_score_with_a_saved_pipeline(spark):
    # per-48 rate of the first prospect (hand-worked)
    df = spark.createDataFrame([(20.0, 8.0, 6.0, 1.5, 1.0, 3.0, 30.0)],
                               "pts double, reb double, ast double, stl double, blk double, "
                               "tov double, min double")
    assert df.select(M.win_shares_per_48().alias("w")).first().w == (20 + 8 + 6 + 1.5 + 1 - 3) / 30 * 48


def test_collect_seasons_decodes_players_and_advanced(spark, tmp_path):
    base = str(tmp_path)
    adv_row = [7, "Some One", 3, "BOS", 25, 60, 40, 20, 0.667, 31.5, 112.0, 105.0, 7.0, 25.1, 2.1,
               18.0, 3.3, 20.1, 11.2, 9.9, 0.55, 0.6, 24.5, 99.0, 0.12]
    for season in ("2022-23", "2023-24"):
        for endpoint, rows, params in (
                ("commonallplayers", [[7, 1, "One, Some", 0, 0, 0, 0, 3, "BOS"]], {"Season": season}),
                ("leaguedashplayerstats", [adv_row],
                 {"Season": season, "SeasonType": "Regular Season"})):
            d = os.path.join(base, f"endpoint={endpoint}", f"season={season}")
            os.makedirs(d)
            with open(os.path.join(d, "part.json"), "w") as fh:
                fh.write(json.dumps({"parameters": params, "resultSets": [{"rowSet": rows}]}) + "\n")
    got = payload.collect_seasons(spark, base, ["2023-24"])
    p = got["players"].collect()
    a = got["advanced_stats"].collect()
    assert [(r.player_id, r.player_name, r.team_id, r.season, r.is_active) for r in p] == [
        (7, "One, Some", 3, "2023-24", 1)]
    assert len(a) == 1 and a[0].gp == 60 and a[0].pie == 0.12 and a[0].season == "2023-24"
    assert a[0].season_type == "Regular Season" and a[0].ts_pct == 0.6


def test_train_and_score_and_dashboard_plans(spark):
    from conftest import SMALL
    from statline.operators import classify
    from statline.plans import train
    from statline.sources.fixtures import fixtures
    stat = classify.label_statlines(fixtures(spark, SMALL).statlines)
    out = train.train_and_score(stat, "pts", "regression", model_names=("linear_regression",))
    metrics = {(r.model, r.metric): r.value for r in out["metrics"].collect()}
    assert metrics[("linear_regression", "r2")] > 0.5
    assert ("linear_regression", "cv_r2_mean") in metrics
    assert out["best"].first().model == "linear_regression"
    ds = train.dashboard_datasets(fixtures(spark, SMALL).statlines)
    assert ds["histogram_pts"].count() == 30
    assert ds["top_scorers"].count() == 10
    assert ds["summary"].count() == 5


def _deduplicated(spark, rows, per_trigger):
    from statline.streaming import stage
    base = scratch_path(spark, "dedup-test")
    make = lambda some: spark.createDataFrame(some, "k long, n long, t string").select(
        "k", "n", F.col("t").cast("timestamp_ntz").alias("at"))
    schema = make(rows[:1]).schema
    for i, row in enumerate(rows):  # one file each, landed in this order
        make([row]).coalesce(1).write.parquet(f"{base}/landing/{i:02d}")
        os.utime(_local(f"{base}/landing/{i:02d}"), (1_700_000_000 + i, 1_700_000_000 + i))
    for _ in range(2):  # the second run has nothing to do
        stage.dedup_stream(spark, f"{base}/landing/*", schema, f"{base}/out", f"{base}/ckpt", ("k",), "at", "7 days",
                           max_files_per_trigger=per_trigger)
    return sorted(((r.k, r.n) for r in spark.read.schema(schema).parquet(f"{base}/out").collect()), key=str)


def _local(folder):
    import glob
    return glob.glob(folder.removeprefix("file:") + "/*.parquet")[0]


def test_stream_dedup_does_not_depend_on_trigger_size(spark):
    """A key that returns after more than the look-back is a new event, counted from the last kept one."""
    day = "2024-{} 00:00:00".format
    rows = [(1, 0, day("01-01")), (2, 0, day("01-01")), (None, 0, day("01-02")), (2, 1, day("01-06")), (3, 0, day("01-08")), (3, 1, day("01-08")),
            (2, 2, day("01-11")), (2, 3, day("01-18")), (2, 4, "2024-01-18 00:00:01"), (None, 1, day("01-20")), (1, 1, day("01-30"))]
    want = sorted([(1, 0), (1, 1), (2, 0), (2, 2), (2, 4), (3, 0), (None, 0), (None, 1)], key=str)
    for per_trigger in (None, 1, 4):
        assert _deduplicated(spark, rows, per_trigger) == want, per_trigger


def test_stream_dedup_compares_with_the_target_before_it_splits(spark):
    """The 16th repeats the target's 10th, so it must not hide the 20th of its own batch."""
    rows = [(1, 0, "2024-01-10 00:00:00"), (1, 1, "2024-01-16 00:00:00"), (1, 2, "2024-01-20 00:00:00"), (2, 0, None), (2, 1, "2024-01-20 00:00:00"), (2, 2, None)]
    for per_trigger in (None, 1, 2):
        assert _deduplicated(spark, rows, per_trigger) == [(1, 0), (1, 2), (2, 0), (2, 1)], per_trigger


def test_files_state_follows_the_files(spark):
    path = scratch_path(spark, "state")
    spark.range(5).write.parquet(path + "/a.parquet")
    first = landed.files_state(spark, path)
    assert first == landed.files_state(spark, path)
    spark.range(6).write.parquet(path + "/b.parquet")
    second = landed.files_state(spark, path)
    spark.range(5).write.mode("overwrite").parquet(path + "/a.parquet")
    assert len({first, second, landed.files_state(spark, path)}) == 3


def test_rewritten_tables_get_a_new_model(spark, monkeypatch):
    from statline.plans import queries_ml

    path, made = scratch_path(spark, "tables"), []
    spark.range(5).write.parquet(path + "/a.parquet")
    monkeypatch.setattr(queries_ml, "numeric", lambda spark, d: d)
    monkeypatch.setattr(queries_ml.models, "prepare", lambda *args, **kw: made.append(args) or len(made))
    assert [queries_ml._prep(spark, path, "regression") for _ in range(2)] == [1, 1]
    spark.range(7).write.mode("overwrite").parquet(path + "/a.parquet")
    assert queries_ml._prep(spark, path, "regression") == 2


def test_games_land_compressed_after_one_shuffle(spark):
    """Documents are built where the join put a player's games: text rows are never shipped, nor landed as plain text."""
    import glob

    from statline.operators import clean
    from statline.plans.queries_io import _decode_payload, game_log_documents
    from statline.session import checkpoint_dir
    from statline.sources.fixtures import fixtures
    docs = game_log_documents(clean.stage_game_logs(fixtures(spark, "/root/testdata/sf0.001").games_by_player))
    plan = docs._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 2  # base rows of lineitem and part
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{folder}/statline-payload-*"))
    assert _decode_payload(spark, "/root/testdata/sf0.001").count() > 0
    new = set(glob.glob(f"{folder}/statline-payload-*")) - before
    files = [f for p in new for f in glob.glob(f"{p}/part-*")]
    assert files and all(f.endswith(".json.gz") for f in files)


def test_etl_reads_landed_files_once_and_builds_sources_once(spark, monkeypatch):
    """Quantiles and result share one parsed table; extractions share one source table."""
    from conftest import SMALL

    from statline.operators import aggregate
    from statline.plans import etl, queries_io

    written, sources, run, save = [], [], etl.run_etl, aggregate.saved
    plans = []
    monkeypatch.setattr(aggregate, "saved", lambda df, name="table": written.append(name) or save(df, name))
    transform = etl.transform

    def spied(raw, cfg):
        out = transform(raw, cfg)
        plans.append(out["advanced_stats"]._jdf.queryExecution().executedPlan().toString().lower())
        return out

    monkeypatch.setattr(etl, "transform", spied)
    monkeypatch.setattr(etl, "run_etl", lambda s, raw, cfg: sources.append(
        raw["advanced_stats"]._jdf.queryExecution().executedPlan().toString()) or run(s, raw, cfg))
    _, reports = queries_io._etl(spark, SMALL, queries_io.ETL_TIMES.values())
    assert all(r.where("status = 'failed'").count() == 0 for r in reports)
    assert len(plans) == 3 and not any("scan csv" in p for p in plans)
    assert "quantile-input" not in written
    assert len(sources) == 3 and not any("Exchange" in p for p in sources)
