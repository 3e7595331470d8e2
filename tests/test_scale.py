"""Invariants, metamorphic checks and plan checks."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SMALL
from statline.ml import split
from statline.operators import rank
from statline.plans.registry import ORACLES, QUERIES
from statline.session import scratch_path
from statline.sinks import writers


def _ties(spark, n=3000, groups=3, seed=7):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice([1.0, 2.0, 3.0, None]), f"g{rnd.randrange(groups)}") for i in range(n)]
    # one hot group with a third of the rows
    rows += [(n + i, rnd.choice([1.0, 2.0]), "hot") for i in range(n // 2)]
    return spark.createDataFrame(rows, "id long, score double, grp string")


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_distributed_row_numbers_equal_window(spark, parts):
    df = _ties(spark)
    order = [F.col("score").desc_nulls_last(), F.col("id").asc()]
    got = rank.row_numbers(df, order, {"g": (), "p": ("grp",)}, num_partitions=parts)
    exp = df.withColumn("g", F.row_number().over(Window.orderBy(*order))) \
        .withColumn("p", F.row_number().over(Window.partitionBy("grp").orderBy(*order)))
    a = sorted((r.id, r.g, r.p) for r in got.collect())
    b = sorted((r.id, r.g, r.p) for r in exp.collect())
    assert a == b


def test_row_number_by_groups_equal_window(spark):
    df = _ties(spark)
    order = [F.col("score").asc_nulls_first(), F.col("id").asc()]
    got = rank.row_number_by(df, order, partition_by=("grp",), name="rn", num_partitions=5)
    exp = df.withColumn("rn", F.row_number().over(Window.partitionBy("grp").orderBy(*order)))
    assert sorted((r.id, r.rn) for r in got.collect()) == sorted((r.id, r.rn) for r in exp.collect())


def test_same_result_for_any_shuffle_partitioning(spark):
    from statline.plans.queries_mart import _mart
    results = []
    for n in ("1", "8", "200"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(sorted(tuple(r) for r in _mart(spark, SMALL).drop(
            "data_created_at", "data_updated_at").collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1] == results[2]


def test_splits_are_disjoint_cover_and_stable(spark):
    df = spark.range(5000).withColumn("season", F.lit("2000-01")).withColumnRenamed("id", "player_id")
    a = split.holdout_split(df).collect()
    b = split.holdout_split(df.repartition(7)).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    share = sum(r.is_test for r in a) / len(a)
    assert 0.17 < share < 0.23


def test_upsert_is_idempotent_and_keeps_latest(spark):
    rows = [(1, "a", 1, 10.0), (1, "a", 2, 20.0), (2, "b", 1, 5.0)]
    delta = spark.createDataFrame(rows, "k long, part string, ver long, v double")
    path = scratch_path(spark, "test-upsert")
    writers.upsert(spark, delta, path, ("k",), ("ver",), partition_by=("part",))
    once = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "part", "ver", "v").collect())
    writers.upsert(spark, delta, path, ("k",), ("ver",), partition_by=("part",))
    twice = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "part", "ver", "v").collect())
    assert once == twice == [(1, "a", 2, 20.0), (2, "b", 1, 5.0)]
    older = spark.createDataFrame([(1, "a", 0, 99.0)], "k long, part string, ver long, v double")
    writers.upsert(spark, older, path, ("k",), ("ver",), partition_by=("part",))
    assert sorted(tuple(r) for r in spark.read.parquet(path).select(
        "k", "part", "ver", "v").collect()) == twice


def test_upsert_moves_keys_between_partitions(spark):
    schema = "k long, part string, ver long"
    path = scratch_path(spark, "test-upsert")
    writers.upsert(spark, spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, None, 1)], schema), path, ("k",), ("ver",), ("part",))
    writers.upsert(spark, spark.createDataFrame([(1, "b", 2), (3, "a b/c", 2), (4, None, 1)], schema), path, ("k",), ("ver",), ("part",))
    got = sorted((r.k, r.part, r.ver) for r in spark.read.schema(schema).parquet(path).collect())
    assert got == [(1, "b", 2), (2, "b", 1), (3, "a b/c", 2), (4, None, 1)]


def test_high_water_mark_reaches_the_scan(spark):
    from statline.sources import landed
    from statline.sources.fixtures import fixtures
    events = fixtures(spark, SMALL).events
    loaded = events.where(F.col("ts") < F.to_timestamp_ntz(F.lit("2024-01-20 00:00:00")))
    plan = _plan(landed.incremental_delta(events, loaded, "ts"))
    assert "GreaterThan(ts,2024-01-19" in plan and "Join" not in plan


def test_quantiles_do_not_sort_rows(spark):
    """Only tables of counts are ordered: no sort or exchange of the values in any plan that ran."""
    from statline.operators import aggregate
    df = spark.range(20_000).selectExpr("CAST(id % 7919 AS DOUBLE) AS v")
    plan = _plan(aggregate.quantiles(df, {"v": (0.5,)}))
    assert "Sort" not in plan and "Exchange" not in plan  # what is returned is one written row


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in ORACLES if not n.startswith(("stream", "upsert",
                                                                              "decode", "csv",
                                                                              "etl", "season_back",
                                                                              "quality_gate",
                                                                              "linear_one"))))
def test_no_python_in_plans(spark, name):
    plan = _plan(QUERIES[name](spark, SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_filters_and_pruning_reach_the_scan(spark):
    from statline.sources.fixtures import fixtures
    f = fixtures(spark, SMALL)
    q = f.game_logs.where(F.col("player_id") == 7).select("player_id", "pts")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_partkey), EqualTo(l_partkey,7)]" in plan
    assert "l_comment" not in plan and "l_orderkey" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_performance_join_is_inner(spark):
    plan = _plan(QUERIES["player_performance"](spark, SMALL))
    assert "LeftOuter" in plan  # advanced stats stay optional
    assert plan.count("Inner") >= 1  # roster join rewritten by the games filter


def test_statlines_ship_each_game_once(spark):
    """The join and the grouping share one hash partitioning of the games; nothing is sorted for the join."""
    from statline.sources.fixtures import fixtures
    f = fixtures(spark, SMALL)
    for table in (f.statlines, f.advanced_stats):
        plan = _plan(table).split("Initial Plan")[-1]
        assert "ShuffledHashJoin" in plan and "Sort " not in plan and "SortMergeJoin" not in plan
        assert plan.count("Exchange hashpartitioning") == 2  # lineitem and part


def test_scoring_new_players_writes_features_once_and_drops_what_was_fitted_on(spark, monkeypatch):
    import os

    from statline.ml import models
    from statline.operators import rank as ranks

    wide, plain = [], models.saved

    def saved(df, name="table"):
        out = plain(df, name)
        if "f0" in df.columns:
            wide.append((name, out._scratch_path.removeprefix("file:")))
        return out

    monkeypatch.setattr(models, "saved", saved)
    monkeypatch.setattr(ranks, "saved", saved)
    rows = spark.range(400).selectExpr("id AS player_id", "'2000-01' AS season", "rand(1) AS f0", "rand(2) AS f1", "rand(3) AS f2")
    rows = rows.withColumns({"y": F.expr("f0 + f1"), "c": F.expr("if(f0 > f1, 'a', 'b')"), "d": F.expr("if(f2 > 0.4, 'p', 'q')")})
    out = models.score_new(rows, rows.select("player_id", "season", "f0", "f1", "f2"), ["f0", "f1", "f2"],
                           {"p1": ("y", "regression", "linear_regression"), "p2": ("c", "classification", "logistic_regression"),
                            "p3": ("d", "classification", "logistic_regression")})
    got = out.join(rows, ["player_id", "season"]).collect()
    assert len(got) == 400 and max(abs(r.p1 - r.y) for r in got) < 1e-6
    assert sum(r.p2 == r.c for r in got) > 360 and sum(r.p3 == r.d for r in got) > 360
    assert [name for name, _ in wide] == ["known", "table", "ranked", "ranked"]  # one table for each fit besides the features
    assert not any(os.path.exists(path) for _, path in wide)
