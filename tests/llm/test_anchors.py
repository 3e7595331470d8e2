import random
from collections import defaultdict

import numpy as np
import pytest

from statline.llm.anchors import Tree, codes_of, compress, largest_component, owners, squared, sums_by_entry, with_label_error

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, parts=4, entries=256, rounds=4):
    """{row number: (code, error)} with plain integers, one distance after another."""
    kept = []
    for vec_id, v, label in rows:
        if v is not None and all(x is not None and np.isfinite(x) for x in v):
            kept.append((vec_id, [int(np.floor(1024 * x)) for x in v], label))
    width = max([-(-max([len(k[1]) for k in kept], default=0) // parts), 1]) if kept else 0
    cut = [[(k[1] + [0] * (width * parts))[p * width:(p + 1) * width] for p in range(parts)] for k in kept]
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:entries]
    out = [["", 0] for _ in kept]
    for p in range(parts):
        book = [list(cut[i][p]) for i in first]

        def nearest(x):
            return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))

        for _ in range(rounds):
            of = defaultdict(list)
            for c in cut:
                of[nearest(c[p])[1]].append(c[p])
            for j, members in of.items():
                book[j] = [sum(col) // len(members) for col in zip(*members)]
        for o, c in zip(out, cut):
            d, j = nearest(c[p])
            o[0] += f"{j:02x}"
            o[1] += d
    of_label = defaultdict(int)
    for o, k in zip(out, kept):
        of_label[k[2]] += o[1]
    return sorted(((k[0], o[0], o[1], of_label[k[2]]) for o, k in zip(out, kept)), key=repr)


def found(spark, rows, **how):
    coded, _ = compress(spark.createDataFrame(rows, SCHEMA).repartition(3), **how)
    return sorted(((r.vec_id, r.code, r.error, r.label_error) for r in with_label_error(coded).collect()), key=repr)


def cloud(n, width=8, seed=0):
    rnd = random.Random(seed)
    return [(i, [rnd.choice((-1, 1)) * rnd.random() for _ in range(width)], rnd.choice((None, 1, 2))) for i in range(n)]


def test_equals_one_by_one(spark):
    rows = cloud(300)
    assert found(spark, rows, entries=24) == brute(rows, entries=24)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = cloud(40, seed=1)
    rows += [(40 + i, rows[0][1], 7) for i in range(60)]  # a hot vector
    rows += [(3, [0.5] * 8, 1), (None, [0.25] * 8, None), (None, [0.25] * 8, None), (200, None, 1), (201, [nan] * 8, 1),
             (202, [inf] + [0.0] * 7, 1), (203, [None] + [0.0] * 7, 1), (204, [0.1, 0.2], 2), (205, [], 2), (206, [0.0] * 8, 2)]
    assert found(spark, rows, entries=16) == brute(rows, entries=16)
    assert found(spark, rows) == brute(rows)


def test_large_components_stay_exact(spark):
    rows = [(i, [x * 200_000 for x in v], label) for i, v, label in cloud(40, seed=2)]
    assert found(spark, rows, entries=8) == brute(rows, entries=8)
    assert found(spark, rows + [(99, [1e18] * 8, 1)], entries=8) == brute(rows, entries=8)
    assert 64 * (2 * largest_component(64)) ** 2 <= 2 ** 62 + 2 ** 40


def test_empty_and_clashing(spark):
    assert found(spark, []) == []
    rows = cloud(30)
    plain = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F
    other = plain.withColumns({c: F.lit("other") for c in ("code", "error", "v", "ids", "points", "part")})
    assert sorted(map(repr, compress(plain)[0].collect())) == sorted(map(repr, compress(other)[0].collect()))


@pytest.mark.parametrize("kind", ["spread", "clusters", "copies"])
def test_tree_and_owners(kind):
    rnd = np.random.default_rng(3)
    points = rnd.integers(-500, 500, (700, 6))
    if kind == "clusters":
        points = points // 20 + rnd.integers(-5, 6, (700, 1)) * 2000
    if kind == "copies":
        points[::3] = points[0]
    tree = Tree.grow(points, leaf=16)
    assert sorted(tree.order) == list(range(700))
    for b in range(len(tree.start)):
        inside = points[tree.order[tree.start[b]:tree.end[b]]]
        assert (tree.sums[b] == inside.sum(axis=0)).all()
        assert np.sqrt(((inside - tree.centre[b]) ** 2).sum(axis=1)).max() <= tree.radius[b] * (1 + 1e-9) + 1e-9
    entries = np.concatenate((points[:20], points[:5]))  # equal entries: the lower one owns
    want = squared(points, entries).argmin(axis=1)
    again = Tree.from_bytes(tree.to_bytes())
    assert (codes_of(again, points, entries) == want).all()
    sums, number = sums_by_entry(tree, points, entries)
    assert (number == np.bincount(want, minlength=25)).all()
    assert all((sums[j] == points[want == j].sum(axis=0)).all() for j in range(25))
    if kind == "clusters":  # most points are counted by their ball, unseen
        middles = np.array([[2000 * c] * 6 for c in range(-5, 6)])
        assert sum(end - start for start, end, ball, _ in owners(tree, points, middles) if ball >= 0) > 600


def test_distances_beyond_doubles():
    points = np.array([[2 ** 28, -(2 ** 28), 1], [3, 4, 5]])
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, e)) for e in points] for p in points]
    assert squared(points, points).tolist() == want


def test_query_equals_its_sql(spark, duck):
    from conftest import SMALL

    from statline.llm.queries import ORACLES, QUERIES
    want = duck.execute(ORACLES["op13_vector_codes"]).fetchdf()
    got = QUERIES["op13_vector_codes"](spark, SMALL)
    names = sorted(want.columns)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want[names].itertuples(index=False, name=None))
