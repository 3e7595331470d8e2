"""Stored sketches by season and clustered catalog tables."""

import math
import re
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from statline.operators import features, sketches
from statline.session import scratch_path
from statline.sinks import clustered, versioned


def _facts(spark, n=6000):
    rows = [(2000 + i % 4, None if i % 50 == 0 else float("nan") if i % 50 == 1 else float((i * 7919) % 1009) / 3, i % 700 if i % 9 else None)
            for i in range(n)]
    return spark.createDataFrame(rows, "season long, pts double, player_id long")


def _exact(rows, season=None):
    own = [r for r in rows if season is None or r.season == season]
    pts = sorted(r.pts for r in own if r.pts is not None and not math.isnan(r.pts))
    return len(own), pts, {r.player_id for r in own} - {None}


def _holds(got, want):
    rows, pts, players = want
    assert (got.rows, got.pts_count, got.pts_min, got.pts_max) == (rows, len(pts), pts[0], pts[-1])
    assert got.pts_mean == pytest.approx(sum(pts) / len(pts))
    mean = sum(pts) / len(pts)
    assert got.pts_std == pytest.approx(math.sqrt(sum((x - mean) ** 2 for x in pts) / (len(pts) - 1)))
    assert abs(got.player_id_distinct - len(players)) <= len(players) * sketches.DISTINCT_ERROR
    for p, q in ((0.1, got.pts_q10), (0.5, got.pts_q50)):
        below, upto = sum(x < q for x in pts) / len(pts), sum(x <= q for x in pts) / len(pts)
        assert below <= p + sketches.RANK_ERROR and upto >= p - sketches.RANK_ERROR


PROBS = {"pts": (0.1, 0.5)}


def test_states_and_merges_hold_against_exact_results(spark):
    facts = _facts(spark)
    rows = facts.collect()
    state = sketches.states(facts, "season", ("pts",), ("player_id",))
    for r in sketches.answers(state, PROBS).collect():
        _holds(r, _exact(rows, r.season))
    _holds(sketches.answers(sketches.merged(state), PROBS).first(), _exact(rows))
    # a merged state is estimated in another way than one built at once, so both are held against the truth
    at_once = sketches.states(facts.withColumn("all", F.lit(1)), "all", ("pts",), ("player_id",))
    _holds(sketches.answers(at_once, PROBS).first(), _exact(rows))


def test_groups_without_values(spark):
    facts = spark.createDataFrame([(1, None, None), (1, float("nan"), None), (2, 4.0, 7)], "season long, pts double, player_id long")
    state = sketches.states(facts, "season", ("pts",), ("player_id",))
    got = {r.season: r for r in sketches.answers(state, PROBS).collect()}
    assert (got[1].rows, got[1].pts_count, got[1].pts_mean, got[1].pts_q50, got[1].player_id_distinct) == (2, 0, None, None, 0)
    assert (got[2].pts_q50, got[2].pts_std, got[2].player_id_distinct) == (4.0, None, 1)
    every = sketches.answers(sketches.merged(state), PROBS).first()
    assert (every.rows, every.pts_count, every.pts_q50) == (3, 1, 4.0)
    none = sketches.answers(sketches.merged(state.where("season > 9")), PROBS).first()
    assert (none.rows, none.pts_count, none.pts_q50) == (0, None, None)


def test_backfill_reads_and_writes_its_seasons_alone(spark):
    base = scratch_path(spark, "sketch-test")
    _facts(spark).write.partitionBy("season").parquet(f"{base}/facts")
    facts = spark.read.parquet(f"{base}/facts")
    path = f"{base}/states"
    assert sketches.refresh(spark, facts, path, "season", ("pts",), ("player_id",), (2000, 2001, 2002)) == 1
    before = {tuple(f["values"]): f["folder"] for f in versioned.manifest(spark, path)["folders"]}
    assert sketches.refresh(spark, facts, path, "season", ("pts",), ("player_id",), (2002, 2003)) == 2
    after = {tuple(f["values"]): f["folder"] for f in versioned.manifest(spark, path)["folders"]}
    assert sorted(after) == [("2000",), ("2001",), ("2002",), ("2003",)]
    assert before[("2000",)] == after[("2000",)] and before[("2002",)] != after[("2002",)]
    plan = facts.where(F.col("season").isin(2002, 2003))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*season#\d+ IN \(2002,2003\)", plan)
    rows = facts.collect()
    for r in sketches.answers(sketches.stored(spark, path, "season"), PROBS).collect():
        _holds(r, _exact(rows, r.season))  # a season that was refreshed twice counts once
    assert [r.season for r in sketches.stored(spark, path, "season", (2001,)).collect()] == [2001]


# ------------------------------------------------------------------ clustered tables


@pytest.fixture
def no_broadcast(spark):
    """As with tables too large to broadcast; equal parts of the key are enough for joins on more columns."""
    held = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
                                                 "spark.sql.requireAllClusterKeysForCoPartition")}
    for k, v in zip(held, ("-1", "-1", "false")):
        spark.conf.set(k, v)
    yield
    for k, v in held.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_window_over_a_clustered_table_needs_no_shuffle_and_no_sort(spark, no_broadcast):
    from statline.plans.queries_sketches import clustered_table
    from statline.sources.fixtures import fixtures
    lines = fixtures(spark, SMALL).statlines.select("player_id", "season", "pts", "reb", "ast")
    assert _exchanges(features.lag_features(lines)) > 0
    held = clustered_table(spark, lines, "statlines", ("season",))
    plan = features.lag_features(held)
    assert _exchanges(plan) == 0
    plain = sorted(map(tuple, features.lag_features(lines).collect()), key=str)
    assert sorted(map(tuple, plan.collect()), key=str) == plain


def test_performance_over_clustered_tables_needs_no_shuffle(spark, no_broadcast):
    from statline.plans.queries_mart import _perf
    from statline.plans.queries_sketches import performance_clustered
    plain, held = _perf(spark, SMALL), performance_clustered(spark, SMALL)
    assert _exchanges(plain) > 0 and _exchanges(held) == 0
    assert sorted(map(str, held.collect())) == sorted(map(str, plain.collect()))


def test_options_with_quotes_and_odd_keys(spark):
    name = f"odd_{uuid.uuid4().hex[:12]}"
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (1, None), (None, "b")], "k long, v string")
    held = clustered.save_clustered(rows, name, scratch_path(spark, "odd"), "k", buckets=3, comment="it's \\ a table", properties={"a'b": "c'd"},
                                    columns={"v": "the 'value'"})
    assert sorted(map(str, held.collect())) == sorted(map(str, rows.collect()))
    got = {(r.kind, r.name): r.text for r in clustered.clustered_options(spark, name).collect()}
    assert got["table", "Comment"] == "it's \\ a table" and got["property", "a'b"] == "c'd" and got["column", "v"] == "the 'value'"
    empty = clustered.save_clustered(rows.limit(0), f"{name}_empty", scratch_path(spark, "odd"), "k", buckets=3)
    assert empty.count() == 0
    assert [r for r in clustered.clustered_options(spark, f"{name}_empty").collect() if r.kind != "table"] == []


def test_exact_side_keeps_no_statistics_for_each_player(spark):
    import re

    from statline.plans import queries_sketches

    plan = queries_sketches._by_season(spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    by_player = re.findall(r"Aggregate\(keys=\[[^\]]*player_id#[^\]]*\], functions=\[([^\]]*)\]", plan)
    assert by_player and not any(by_player)


def test_clustered_tables_get_buckets_for_their_rows(spark, monkeypatch):
    from statline.plans import queries_sketches

    assert queries_sketches.buckets_for(spark.range(10), spark.range(0)) == queries_sketches.BUCKETS
    monkeypatch.setattr(queries_sketches, "ROWS_PER_BUCKET", 50)
    assert queries_sketches.buckets_for(spark.range(1001), spark.range(10)) == 21
    out = queries_sketches.performance_clustered(spark, "/root/testdata/sf0.001")
    assert any(f"SelectedBucketsCount: {n} out of {n}" in out._jdf.queryExecution().toString() for n in range(9, 10_000))
    monkeypatch.undo()
    want = queries_sketches.performance_clustered(spark, "/root/testdata/sf0.001")
    assert sorted(map(str, out.drop(*[c for c, t in out.dtypes if t == "double"]).collect())) == \
        sorted(map(str, want.drop(*[c for c, t in want.dtypes if t == "double"]).collect()))
