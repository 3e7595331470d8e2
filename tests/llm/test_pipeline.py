import re
from collections import Counter

import pytest
from corpus_rows import SCHEMA
from test_mixing import dealt
from test_neardup import brute
from test_packing import check_packing

import corpus_pipeline

MID = "/root/testdata/sf0.01"


def test_each_stage_on_its_own_input(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    columns = docs.columns
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{MID}/labels.parquet").collect()}
    names = []
    for name, stage in corpus_pipeline.STAGES:
        names.append(name)
        before = docs.collect()
        docs = spark.createDataFrame(stage(spark, docs, MID).collect(), docs.schema) if name != "best-fit packing" else stage(spark, docs, MID)
        after = docs.collect()
        if name == "best-fit packing":
            used, least = check_many(after, before)
            assert used <= 1.02 * least + 1
            continue
        assert docs.columns == columns
        ids = {r.doc_id for r in after}
        if name == "quality classifier":
            gone = [r.doc_id for r in before if r.doc_id not in ids]
            assert gone and all(label.get(d, 0) == 0 for d in gone)
            assert sum(1 for r in after if label.get(r.doc_id) == 0) <= 4
        elif name == "language id":
            assert ids == {r.doc_id for r in before}
        elif name == "minhash near-dedup":
            want = brute([(r.doc_id, r.text) for r in before], 5)
            assert sorted(r.doc_id for r in after) == sorted(d for d in want if want[d] == d)
        elif name == "source mix":
            sizes, taken = Counter(), Counter()
            for rows, into in ((before, sizes), (after, taken)):
                for r in rows:
                    into[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
            want, longest = dealt(sizes), max(len(r.text.split()) for r in before)
            assert all(abs(taken[s] - want[s]) <= longest for s in sizes)
    assert len(names) == 5


def check_many(rows, before):
    """Documents may come several times: number the rows of each before comparing."""
    texts = {r.doc_id: r.text for r in before}
    times = Counter(r.doc_id for r in before)
    pieces = Counter((r.doc_id, r.piece) for r in rows)
    assert all(pieces[d, 0] == times[d] for d in times) and all(n == times[d] for (d, _), n in pieces.items())
    seen, first = Counter(), []
    for r in rows:
        seen[r.doc_id, r.piece] += 1
        if seen[r.doc_id, r.piece] == 1:
            first.append(r)
    from collections import defaultdict
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert {d for d in texts} == {r.doc_id for r in first}
    return len(sequences), -(-sum(r.length for r in rows) // 2048)


def test_run_and_registration(spark):
    import __spark_entry__
    from conftest import SMALL
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, SMALL).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


@pytest.mark.parametrize("k", range(5))
def test_stages_take_odd_rows(spark, odd, clashing, empty, k):
    from conftest import SMALL
    name, stage = corpus_pipeline.STAGES[k]
    out = stage(spark, clashing, SMALL)
    assert k == 4 or out.columns == clashing.columns
    assert sorted({r.doc_id for r in out.collect() if r.doc_id is not None}) == sorted({r.doc_id for r in stage(spark, odd, SMALL).collect() if r.doc_id is not None})
    assert stage(spark, empty, SMALL).collect() == [] and SCHEMA and check_packing
