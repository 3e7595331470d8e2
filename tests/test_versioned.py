"""Versioned tables: crashes between steps, concurrent writers, the key index, old versions; bounded de-duplication."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from statline.session import scratch_path
from statline.sinks import versioned
from statline.streaming import stage

SCHEMA = "id long, day string, at long, v double"
KEY, ORDER = ("id",), ("at",)


def _rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _read(spark, path, version=None):
    return sorted(map(tuple, versioned.read(spark, path, version).collect()), key=repr)


def _brute(*deltas):
    newest = {}
    for rows in deltas:
        for r in rows:
            if r[0] not in newest or r[2] >= newest[r[0]][2]:
                newest[r[0]] = r
    return sorted(newest.values(), key=repr)


FIRST = [(i, f"d{i % 4}", i, float(i)) for i in range(40)] + [(None, None, 1, 1.0)]
SECOND = [(i, f"d{(i + 1) % 5}", 100 + i, -float(i)) for i in range(0, 40, 7)] + [(50, "new", 1, 0.5), (None, "d1", 200, 2.0), (3, "d9", 0, 9.0)]


def _upsert(spark, rows, path, **how):
    return versioned.upsert(spark, _rows(spark, rows), path, KEY, ORDER, **{"partition_by": ("day",), **how})


@pytest.mark.parametrize("how", [{}, {"partition_by": ()}, {"partition_by": (), "buckets": 3}])
def test_versions_equal_newest_rows(spark, how):
    path = scratch_path(spark, "versioned")
    assert [_upsert(spark, rows, path, **how) for rows in (FIRST, SECOND, SECOND)] == [1, 2, 3]
    assert _read(spark, path, 1) == _brute(FIRST) and _read(spark, path) == _read(spark, path, 2) == _brute(FIRST, SECOND)
    assert _upsert(spark, [], path, **how) == 4 and _read(spark, path) == _brute(FIRST, SECOND)


def test_empty_table(spark):
    path = scratch_path(spark, "versioned")
    with pytest.raises(FileNotFoundError):
        versioned.read(spark, path)
    _upsert(spark, [], path)
    assert _read(spark, path) == [] and _upsert(spark, FIRST, path) == 2 and _read(spark, path) == _brute(FIRST)


@pytest.mark.parametrize("stop", ["data written", "index written", "manifest drafted", "published"])
def test_stopped_writer_leaves_a_whole_version(spark, monkeypatch, stop):
    """Whatever step a writer stops at, readers see the old or the new version, and the write can be repeated."""
    path = scratch_path(spark, "versioned")
    _upsert(spark, FIRST, path)

    def fail(name):
        if name == stop:
            raise KeyboardInterrupt(name)

    with monkeypatch.context() as m:
        m.setattr(versioned, "_step", fail)
        with pytest.raises(KeyboardInterrupt):
            _upsert(spark, SECOND, path)
    assert _read(spark, path) == (_brute(FIRST, SECOND) if stop == "published" else _brute(FIRST))
    _upsert(spark, SECOND, path)
    assert _read(spark, path) == _brute(FIRST, SECOND)
    versioned.vacuum(spark, path, keep=1, older_than_hours=-1)
    assert _read(spark, path) == _brute(FIRST, SECOND)
    assert not [s for s in versioned._list(spark, f"{path}/versions") if "_draft" in s.getPath().getName() and not s.getPath().getName().endswith(".crc")]


def test_replace_is_one_step_too(spark, monkeypatch):
    path = scratch_path(spark, "versioned")
    versioned.create(spark, _rows(spark, FIRST), path, KEY, ("day",), comment="c")
    monkeypatch.setattr(versioned, "_step", lambda name: (_ for _ in ()).throw(KeyboardInterrupt()) if name == "index written" else None)
    with pytest.raises(KeyboardInterrupt):
        versioned.create(spark, _rows(spark, SECOND), path, KEY, ("day",))
    assert _read(spark, path) == sorted(FIRST, key=repr)


def test_second_of_two_writers_fails(spark, monkeypatch):
    path = scratch_path(spark, "versioned")
    _upsert(spark, FIRST, path)
    inside = []

    def other_writer(name):
        if name == "data written" and not inside:
            inside.append(name)
            _upsert(spark, SECOND[:2], path)

    monkeypatch.setattr(versioned, "_step", other_writer)
    with pytest.raises(versioned.ConcurrentUpdate):
        _upsert(spark, SECOND, path)
    assert _read(spark, path) == _brute(FIRST, SECOND[:2])
    assert _upsert(spark, SECOND, path) == 3 and _read(spark, path) == _brute(FIRST, SECOND)


def test_index_rules_folders_out(spark):
    """Folders whose bitmap or key range excludes the delta's keys are neither candidates nor opened."""
    path = scratch_path(spark, "versioned")
    rows = [(1000 * d + i, f"d{d}", 1, 0.0) for d in range(30) for i in range(20)]
    _upsert(spark, rows, path)
    held = versioned.manifest(spark, path)
    assert len(held["folders"]) == 30
    delta = _rows(spark, [(7005, "elsewhere", 2, 1.0), (7019, "elsewhere", 2, 1.0)])
    found = versioned.candidates(spark, path, held, delta)
    assert [f["values"] for f in found] == [["d7"]]
    plan = versioned._frame(spark, path, held, found)._jdf.inputFiles()
    assert len(plan) == 1 and found[0]["id"] in plan[0]
    scattered = _rows(spark, [(25, "x", 2, 1.0), (29019, "x", 2, 1.0)])  # the ranges of all folders overlap: bitmaps decide
    ids = {f["values"][0] for f in versioned.candidates(spark, path, held, scattered)}
    assert "d29" in ids and len(ids) < 5
    before = {f["folder"] for f in held["folders"]}
    _upsert(spark, [(7005, "elsewhere", 2, 1.0)], path)
    after = {f["folder"] for f in versioned.manifest(spark, path)["folders"]}
    assert len(before - after) == 1 and len(after - before) == 2
    assert (7005, "elsewhere", 2, 1.0) in _read(spark, path) and len(_read(spark, path)) == 600


def test_index_never_rules_out_a_key(spark):
    path = scratch_path(spark, "versioned")
    rows = [(i * 7919 % 10007, f"d{i % 17}", 1, 0.0) for i in range(5000)] + [(None, "none", 1, 0.0)]
    _upsert(spark, rows, path)
    held = versioned.manifest(spark, path)
    stored = _read(spark, path)
    asked = [r[0] for r in stored if r[0] is None or r[0] % 997 == 3]
    found = {f["values"][0] for f in versioned.candidates(spark, path, held, _rows(spark, [(k, "x", 2, 0.0) for k in asked]))}
    assert {r[1] for r in stored if r[0] in asked} <= found


def test_partitions_open_their_folders_only(spark):
    path = scratch_path(spark, "versioned")
    _upsert(spark, FIRST, path)
    got = versioned.read(spark, path, partitions={"day": ["d2", None]})
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([r for r in FIRST if r[1] in ("d2", None)], key=repr)
    assert len({f.rsplit("/", 2)[1] for f in got.inputFiles()}) == 2
    assert versioned.read(spark, path, partitions={"day": ["nowhere"]}).collect() == []


def test_options_and_history(spark):
    path = scratch_path(spark, "versioned")
    _upsert(spark, FIRST, path)
    versioned.set_options(spark, path, "players", {"owner": "a", "x": "1"}, {"v": "a value"})
    versioned.set_options(spark, path, properties={"x": "2"})
    assert sorted(map(tuple, versioned.table_options(spark, path).collect())) == [
        ("column", "v", "a value"), ("comment", "", "players"), ("property", "owner", "a"), ("property", "x", "2")]
    assert versioned.read(spark, path).schema["v"].metadata == {"comment": "a value"}
    assert [(r.version, r.operation, r.rows) for r in versioned.history(spark, path).collect()] == [(1, "upsert", 41), (2, "options", 41), (3, "options", 41)]
    _upsert(spark, SECOND, path)
    assert versioned.vacuum(spark, path, keep=1) == 0  # all of it is young
    assert versioned.vacuum(spark, path, keep=1, older_than_hours=-1) > 0
    assert versioned.versions(spark, path) == [4] and _read(spark, path) == _brute(FIRST, SECOND)


def test_a_stream_batch_counts_once(spark):
    path = scratch_path(spark, "versioned")
    assert _upsert(spark, FIRST, path, batch_of=("s", 0)) == 1
    assert _upsert(spark, SECOND, path, batch_of=("s", 1)) == 2
    assert _upsert(spark, [(1, "other", 999, 0.0)], path, batch_of=("s", 1)) == 2
    assert _upsert(spark, [(1, "other", 999, 0.0)], path, batch_of=("t", 0)) == 3
    assert (1, "other", 999, 0.0) in _read(spark, path)


# ------------------------------------------------------------------ bounded de-duplication

EVENTS = "id long, k string, ts timestamp_ntz"


def _drain(spark, base, rows, n, delay="2 days"):
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.parquet(f"{base}/landing/part{n}")
    stage.dedup_stream_watermark(spark, f"{base}/landing/*", spark.createDataFrame([], EVENTS).schema, f"{base}/out",
                                 f"{base}/ck", ("id",), "ts", delay)


def test_bounded_dedup_restarts_from_its_checkpoint(spark):
    """Each drain is a new query; repeats inside the delay go, late rows are counted, state does not grow."""
    base, day = scratch_path(spark, "bounded"), dt.datetime(2024, 1, 1)
    at = lambda d: day + dt.timedelta(days=d)
    _drain(spark, base, [(i, "a", at(0)) for i in range(50)] + [(900, "undated", None)], 0)
    _drain(spark, base, [(i, "b", at(1)) for i in range(50)] + [(100, "a", at(1))], 1)  # repeats, known from before the restart
    for n in range(2, 8):
        _drain(spark, base, [(1000 * n + i, "a", at(4 * n)) for i in range(20)], n)
    _drain(spark, base, [(1, "late", at(2)), (2, "late", None)], 8)
    out = spark.read.parquet(f"{base}/out")
    assert sorted(r.id for r in out.where("k = 'a' AND id < 1000").collect()) == [*range(50), 100]
    assert out.where("k <> 'a'").count() == 0 and out.count() == 51 + 6 * 20
    assert {r.id for r in spark.read.parquet(f"{base}/out_undated").collect()} == {900, 2}
    progress = spark.read.parquet(f"{base}/out_progress")
    assert progress.agg(F.sum("late_rows")).first()[0] == 1
    assert progress.agg(F.max("state_rows")).first()[0] <= 51 + 20
    last = progress.orderBy(F.desc("batch_id")).first()
    assert last.state_rows <= 40


def test_bounded_dedup_without_rows(spark):
    base = scratch_path(spark, "bounded")
    _drain(spark, base, [], 0)
    _drain(spark, base, [(1, "a", dt.datetime(2024, 1, 1)), (1, "a", dt.datetime(2024, 1, 1))], 1)
    assert spark.read.parquet(f"{base}/out").count() == 1


def test_bitmaps_are_not_built_in_the_task_that_writes_the_index(spark, tmp_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    from statline.sinks import versioned

    def coalesced(self, n):
        raise AssertionError("merges the tasks before the write")

    monkeypatch.setattr(DataFrame, "coalesce", coalesced)
    rows = spark.range(1000).selectExpr("id", "id % 7 AS part")
    path = str(tmp_path / "t")
    versioned.create(spark, rows, path, ("id",), ("part",))
    versioned.upsert(spark, rows.where("id < 3").selectExpr("id", "part + 1 AS part"), path, ("id",), ("part",), ("part",))
    assert versioned.read(spark, path).count() == 1000
