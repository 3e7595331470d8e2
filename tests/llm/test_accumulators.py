import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from corpus_rows import odd_rows, rows_of

from statline.llm import accumulators
from statline.llm.accumulators import Shard, ranked, split_terms

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def terms_of(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=50):
    held = [(d, Counter(terms_of(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    big_n, big_l = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(terms_of(text))
    out = []
    for item, terms in asked.items():
        scores = []
        for d, c in held:
            n = sum(c.values())
            m = 100 - 50 + (50 * n * big_n) // big_l
            s = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in terms if c[t])
            if s > 0:
                scores.append((-s, d is None, d))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def found(spark, docs, items, k=50):
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    return rows_of(ranked(docs, spark.createDataFrame(items, ITEMS), k))


def zipfian(n, seed, words=300):
    rnd = random.Random(seed)
    return [(i, " ".join(f"w{int(words * rnd.random() ** 3)}" for _ in range(rnd.randrange(1, 60)))) for i in range(n)]


ODD_ITEMS = [(0, "w1 w2 W3, w399"), (1, "one don't"), (1, "É́ßİ 中文"), (2, ""), (3, None), (None, "w5 w6"), (4, "...  --"), (5, "nowhere"),
             (6, " ".join(f"w{i}" for i in range(400)))]


def test_terms_are_the_pattern():
    texts = [t or "" for _, t, *_ in odd_rows()] + ["A_b`c{d}~\x7fé@Z[9]\x00\u0085x y", ""]
    offsets, codes, names = split_terms(pa.array(texts)[0:])
    names = names.to_pylist()
    assert [[names[c] for c in codes[a:b]] for a, b in zip(offsets, offsets[1:])] == [terms_of(t) for t in texts]
    offsets, codes, names = split_terms(pa.array(texts)[3:6])
    assert len(offsets) == 4


def test_equals_every_score(spark):
    docs = zipfian(600, 1)
    items = [(i, " ".join(f"w{(i * 37 + j * j) % 300}" for j in range(12))) for i in range(30)]
    assert found(spark, docs, items, 5) == brute(docs, items, 5)
    assert found(spark, docs, items, 50) == brute(docs, items, 50)


def test_ties_and_hot_copies(spark):
    docs = [(i, "same words here") for i in range(200)] + [(200 + i, f"same words number{i}") for i in range(100)] + [(7, "here"), (7, "here")]
    items = [(1, "same here"), (2, "words"), (3, "here number7")]
    assert found(spark, docs, items, 20) == brute(docs, items, 20)


def test_odd_rows(spark, odd):
    docs = [r[:2] for r in odd_rows()]
    assert found(spark, docs, ODD_ITEMS) == brute(docs, ODD_ITEMS)


def test_empty_and_clashing(spark, empty, odd, clashing):
    items = spark.createDataFrame(ODD_ITEMS, ITEMS)
    assert ranked(empty, items).collect() == []
    assert ranked(odd, items.limit(0)).collect() == []
    assert rows_of(ranked(odd, items)) == rows_of(ranked(clashing, items))


def test_small_shards_and_blocks(spark, monkeypatch):
    docs, items = zipfian(200, 4), [(i, f"w{i} w{2 * i} w1 w0") for i in range(20)]
    want = brute(docs, items, 10)
    monkeypatch.setattr(accumulators, "SHARD_DOCUMENTS", 16)
    monkeypatch.setattr(accumulators, "BLOCK_TERMS", 16)
    assert found(spark, docs, items, 10) == want
    monkeypatch.setattr(accumulators, "SHARD_POSTINGS", 5)
    assert found(spark, docs, items, 10) == want


@pytest.mark.parametrize("seed", range(4))
def test_stops_making_accumulators(seed):
    """Frequent terms come last and are looked up for survivors only, with the scores of a full pass."""
    rnd = np.random.default_rng(seed)
    n, sizes = 5000, [40, 60, 80, 3000, 4000, 4500]
    doc = [np.sort(rnd.choice(n, s, replace=False)) for s in sizes]
    doc[1][:20] = doc[0][:20]
    doc = [np.unique(d) for d in doc]
    term = np.repeat(np.arange(6), [len(d) for d in doc])
    tf = rnd.integers(1, 4, len(term))
    weights = np.array([max(1, int(1000 * math.log((2 * n + 2) / (2 * len(d) + 1)))) for d in doc])
    shard = Shard(rnd.integers(50, 100, n), term, np.concatenate(doc), tf, weights, n, 75 * n)
    full = np.zeros(n, np.int64)
    np.add.at(full, shard.doc, shard.score)
    rows, scores = shard.best(np.arange(6), 10)
    least = np.sort(full)[-10]
    assert set(rows) == set(np.flatnonzero(full >= least)) and (full[rows] == scores).all()
    assert shard.read < sum(map(len, doc)) / 3 and shard.looked_up < 1000


def test_query_equals_its_sql(spark, duck):
    from conftest import SMALL

    from statline.llm.queries import ORACLES, QUERIES
    want = duck.execute(ORACLES["op11_ranked_search"]).fetchall()
    assert rows_of(QUERIES["op11_ranked_search"](spark, SMALL).select("item_id", "rank", "doc_id", "score")) == sorted(want, key=repr)


def test_terms_of_one_block_are_not_written(spark, monkeypatch):
    names, save = [], accumulators.saved
    monkeypatch.setattr(accumulators, "saved", lambda df, name="table": names.append(name) or save(df, name))
    docs, items = [(i, f"one two{i % 3} three{i}") for i in range(9)], [(1, "two1 three4"), (2, "one")]
    assert found(spark, docs, items) == brute(docs, items)
    assert names == ["index-shards", "found"]
    monkeypatch.setattr(accumulators, "BLOCK_TERMS", 1)
    names.clear()
    assert found(spark, docs, items) == brute(docs, items)
    assert names.count("item-terms") == 1
