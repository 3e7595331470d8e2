import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from corpus_rows import odd_rows, words

from statline.llm import neardup
from statline.llm.components import components
from statline.llm.neardup import minima, most_ones, near_copies, odd_sketch, shingle_sets, without_copies

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    found = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(found[i:i + k]) for i in range(len(found) - k + 1)} if len(found) >= k else {tuple(found)} if found else set()


def brute(docs, k, percent=80):
    """doc_id -> smallest doc_id reachable, over all pairs."""
    sets = [(d, shingles(t, k)) for d, t in docs if d is not None]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, x), (b, y) in combinations(sets, 2):
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {d: find(d) for d in root}


def check(df, docs, k):
    want, sizes = brute(docs, k), {d: len(shingles(t, k)) for d, t in docs}
    got = near_copies(df, words=k).collect()
    assert len(got) == len(docs)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (sizes[r.doc_id], want[r.doc_id], want[r.doc_id] == r.doc_id)


@pytest.mark.parametrize("k", [2, 5])
def test_odd_documents(odd, k):
    check(odd, [r[:2] for r in odd_rows()], k)


def edited(text: str, n: int, seed: int) -> str:
    rnd, out = random.Random(seed), text.split()
    for _ in range(n):
        out[rnd.randrange(len(out))] = f"new{rnd.randrange(10**6)}"
    return " ".join(out)


def family(size: int, edits: int, seed: int = 0):
    base = words(50 + seed, 150, 5000)
    return [edited(base, i % (edits + 1), 1000 * seed + i) for i in range(size)]


@pytest.mark.parametrize("block", [2048, 16])
def test_large_groups_at_every_similarity(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    texts = family(120, 12) + family(40, 25, 1) + [words(900 + i, 60) for i in range(40)] + ["same text here"] * 60
    random.Random(4).shuffle(texts)
    docs = list(enumerate(texts))
    check(spark.createDataFrame(docs, "doc_id long, text string"), docs, 2)


def test_whole_table(spark, docs):
    from conftest import SMALL

    from statline.llm.queries import QUERIES
    table = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(table, 2)
    assert {r.doc_id: r.component_id for r in QUERIES["op7_near_copies"](spark, SMALL).collect()} == want


def test_odd_sketches_estimate_differences():
    rng = np.random.default_rng(5)
    ones = {}
    for share in (0.95, 0.8, 0.5):
        got = []
        for _ in range(60):
            common = rng.integers(0, 2**63, round(1000 * share), dtype=np.uint64)
            a, b = (np.unique(np.concatenate((common, rng.integers(0, 2**63, round(1000 * (1 - share) / 2), dtype=np.uint64)))) for _ in "ab")
            x, y = odd_sketch(minima(a)), odd_sketch(minima(b))
            got.append(int(np.bitwise_count(x.view(np.uint64) ^ y.view(np.uint64)).sum()))
        flips = 2 * neardup.SAMPLES * (1 - share)
        mean = neardup.SKETCH_BITS / 2 * (1 - np.exp(-2 * flips / neardup.SKETCH_BITS))
        assert abs(np.mean(got) - mean) <= 0.1 * mean + 2
        ones[share] = got
    assert max(ones[0.8]) <= most_ones(0.8) and min(ones[0.5]) > np.mean(ones[0.8])


def test_shingles_of_few_words():
    got = shingle_sets(pa.array(["", " ", "a", "A", "a b", "a b a b"]), 2)
    assert [len(s) for s in got] == [0, 0, 1, 1, 1, 2] and got[2].tolist() == got[3].tolist() != got[4].tolist()


def test_components(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, 3), (3, 9), (9, 7), (5, 5), (200, 160), (1, 2), (2, 1)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {200: 100, 3: 3, 7: 3, 9: 3, 1: 1, 2: 1}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_empty(empty):
    assert near_copies(empty).collect() == [] and without_copies(empty).collect() == []


def test_without_copies_keeps_one_row(odd, clashing):
    out = without_copies(clashing)
    assert out.columns == clashing.columns
    want = brute([r[:2] for r in odd_rows()], 5)
    seen, expected = set(), []
    for d, text, *_ in odd_rows():
        if d is None or not shingles(text, 5) or want[d] == d and d not in seen:
            expected.append(d)
            if d is not None:
                seen.add(d)
    assert sorted((r.doc_id for r in out.collect()), key=repr) == sorted(expected, key=repr)


def test_parity_never_exceeds_the_difference():
    rng = np.random.default_rng(6)
    for n in (30, 500, 5000, 40_000):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate((a[n // 10:], rng.integers(0, 2**63, n // 12, dtype=np.uint64))))
        x, y = neardup.parity(a), neardup.parity(b)
        differ = len(np.setxor1d(a, b))
        ones = int(np.bitwise_count(x.view(np.uint64) ^ y.view(np.uint64)).sum())
        assert 0.8 * differ <= ones <= differ
