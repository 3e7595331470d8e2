import re
from collections import Counter, defaultdict

import pytest
from corpus_rows import odd_rows, rows_of

from statline.llm.mixing import mix, mixed, targets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def dealt(sizes: dict, weights=(5, 2, 1), share=1.5, most=2.0) -> dict:
    """Deal by weight, stop at the caps, deal the excess again until nobody is above."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    budget, capped, out = share * sum(sizes.values()), set(), {}
    while True:
        free = [s for s in order if s not in capped]
        left = budget - sum(most * sizes[s] for s in capped)
        total = sum(weight[s] for s in free)
        out = {s: most * sizes[s] for s in capped} | {s: left * weight[s] / total for s in free}
        above = {s for s in free if out[s] > most * sizes[s] + 1e-9}
        if not above:
            return out
        capped |= above


def check(rows, texts):
    sizes, largest = Counter(), Counter()
    for (source, text), n in texts.items():
        words = len(WORD.findall(text or ""))
        sizes[source] += words * n
        largest[source] = max(largest[source], words)
    want = dealt(sizes)
    by_size = defaultdict(Counter)
    for r in rows:
        by_size[r.source_size][r.target] += r.taken
        assert r.taken in (0, r.size, 2 * r.size)
    assert sorted((n, round(t, 6)) for n, ts in by_size.items() for t in ts) == sorted({(sizes[s], round(want[s], 6)) for s in sizes})
    return want, sizes, largest


def test_water_level_equals_dealing_in_turns(spark):
    sizes = {"0a": 10, "0b": 500, "0c": 40, "0d": 0, "0e": 900, "0f": 3, "1": 77}
    got = {r.skey: r.target for r in targets(spark.createDataFrame(list(sizes.items()), "skey string, source_size long")).collect()}
    want = dealt({(None if k == "1" else k): v for k, v in sizes.items()})
    for k in sizes:
        assert got[k] == pytest.approx(want[None if k == "1" else k])


def test_whole_table(spark, docs):
    from conftest import SMALL

    from statline.llm.queries import QUERIES
    rows = QUERIES["op2_mix_sources"](spark, SMALL).collect()
    table = docs.collect()
    want, sizes, largest = check(rows, Counter((r.source, r.text) for r in table))
    source, text = {r.doc_id: r.source for r in table}, {r.doc_id: r.text for r in table}
    taken = Counter()
    for r in rows:
        assert r.size == len(WORD.findall(text[r.doc_id] or ""))
        taken[source[r.doc_id]] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]
    again = QUERIES["op2_mix_sources"](spark, SMALL)
    assert rows_of(again) == sorted((tuple(r) for r in rows), key=repr)


def test_no_python_runs(spark, docs):
    plan = mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_odd_documents(odd):
    rows = mix(odd).collect()
    assert len(rows) == len(odd_rows())
    check(rows, Counter((r[3], r[1]) for r in odd_rows()))
    assert all(r.size == 0 and r.taken == 0 for r in rows if r.doc_id in (3, 4, 5))
    twins = [r.taken for r in rows if r.doc_id == 12]
    assert len(twins) == 2 and twins[0] == twins[1]


def test_empty_and_clashing(empty, odd, clashing):
    assert mix(empty).collect() == []
    assert rows_of(mix(odd)) == rows_of(mix(clashing))


def test_mixed_rows_equal_taken(odd, clashing):
    times = Counter()
    for r in mix(odd).collect():
        times[r.doc_id] += r.taken
    out = mixed(clashing)
    assert out.columns == clashing.columns
    got = Counter()
    for r in out.collect():
        got[r.doc_id] += len(WORD.findall(r.text or ""))
    assert +got == +times


def test_one_source_with_a_third_of_all(spark):
    rows = [(i, "a b c d e f g h", "en", "hot" if i % 3 == 0 else f"s{i % 7}", 1) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    taken, want = Counter(), {}
    source = {r[0]: r[3] for r in rows}
    for r in mix(df).collect():
        taken[source[r.doc_id]] += r.taken
        want[source[r.doc_id]] = r.target
    for s in want:
        assert abs(taken[s] - want[s]) <= 8


def test_state_of_sources_is_one_file(spark, docs, monkeypatch):
    """One row for each source needs no file for each shuffle partition."""
    from statline.llm import mixing

    parts, save = {}, mixing.saved

    def spy(df, name="table"):
        out = save(df, name)
        parts.setdefault(name, []).append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(mixing, "saved", spy)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = mix(docs).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(rows) == docs.count()
    assert {n for name, ns in parts.items() if name != "mix-sizes" for n in ns} == {1}
