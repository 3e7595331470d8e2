from collections import Counter, defaultdict

from corpus_rows import crc, odd_rows, rows_of

from statline.llm.sharding import schedule, shard


def check(rows, texts, shards):
    """One shard for each text, gapless slots, right sizes; returns bytes by shard."""
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (d, len((t or "").encode()) + 16, crc(t)) for d, t in texts)
    load, slots, of_text = Counter({s: 0 for s in range(shards)}), defaultdict(list), defaultdict(set)
    for r in rows:
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
        of_text[r.text_crc32, r.size].add(r.shard)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for v in of_text.values())
    return load


def test_heap_is_longest_processing_time():
    sizes = sorted((7, 7, 6, 6, 5, 4, 4, 3, 2, 1), reverse=True)
    load = Counter()
    for s, b in zip(sizes, schedule(sizes, 3)):
        assert load[b] == min(load[x] for x in range(3))
        load[b] += s
    assert max(load.values()) - min(load.values()) <= 1


def test_whole_table(spark, docs):
    from conftest import SMALL

    from statline.llm.queries import QUERIES
    load = check(QUERIES["op3_shard"](spark, SMALL).collect(), [(r.doc_id, r.text) for r in docs.collect()], 40)
    mean, largest = sum(load.values()) / 40, max(len(r.text or "") for r in docs.collect())
    assert max(load.values()) <= max(mean * 1.05, 1.1 * largest + mean * 0.05)


def test_odd_documents(odd):
    check(shard(odd, 5).collect(), [r[:2] for r in odd_rows()], 5)


def test_group_of_a_third_stays_together(spark):
    rows = [(i, "copy " * 5 if i % 3 == 0 else f"text {i} " + "x" * (i % 50)) for i in range(3000)]
    load = check(shard(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect(), rows, 8)
    mean = sorted(load.values())[:7]
    assert max(mean) - min(mean) <= 0.01 * sum(mean) / 7


def test_empty_and_clashing(empty, odd, clashing):
    assert shard(empty).collect() == []
    assert rows_of(shard(odd, 4)) == rows_of(shard(clashing, 4))
