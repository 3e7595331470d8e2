import numpy as np
import pytest

from statline.llm import vectors
from statline.llm.maxscore import Postings, best, top_k
from statline.llm.vamana import Graph, _build, nearest, same_length

SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank string"


def rows(n=600, dim=12, seed=3, copies=150):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)).astype(np.float32)
    x[rng.choice(n, copies, replace=False)] = x[0]  # one very common vector
    out = [(i, x[i].tolist(), 1, 0.5, "z") for i in range(n)]
    out[7] = (7, None, 1, None, None)
    out[8] = (8, [float("nan")] + x[8].tolist()[1:], None, None, None)
    out[9] = (9, [float("inf")] + x[9].tolist()[1:], 1, None, None)
    out[10] = (10, [None] + x[10].tolist()[1:], 1, None, None)
    out[11] = (11, [0.0] * dim, 1, None, None)
    out[12] = (12, [], 1, None, None)
    return out + [(20, x[20].tolist(), 1, None, None), (None, x[5].tolist(), 1, None, None)]


def brute(data, k, kind):
    """Rankings of every query row, by (vec_id, vector): every row but the query's own is a candidate."""
    good = [(i, np.array(v, np.float64)) for i, v, *_ in data
            if i is not None and v and all(c is not None and np.isfinite(c) for c in v)]
    if kind == "int":
        good = [(i, np.floor(64 * v).astype(np.int64)) for i, v in good if 64 * np.abs(v).max() < np.sqrt(2.0 ** 62 / len(v)) - 1]
    else:
        good = [(i, v) for i, v in good if v.any()]
    good.sort(key=lambda r: r[0])
    ids = np.array([i for i, _ in good])
    x = np.array([v for _, v in good])
    out = {}
    for at in np.flatnonzero(ids % 20 == 0) if len(good) else ():
        score = x @ x[at]
        order = np.lexsort((ids, -score))
        order = order[order != at][:k]
        out.setdefault(int(ids[at]), []).append([(int(ids[i]), score[i]) for i in order])
    return {q: sorted(v, key=repr) for q, v in out.items() if any(v)}


def found(df):
    out = {}
    rows_ = sorted(df.collect(), key=lambda r: (r.query_id, getattr(r, "query_row", 0), r.rank))
    for r in rows_:
        lists = out.setdefault(r.query_id, {}).setdefault(getattr(r, "query_row", 0), [])
        lists.append((r.vec_id, r.score))
        assert r.rank == len(lists)
    return {q: sorted(v.values(), key=repr) for q, v in out.items()}


def test_repeated_ids_and_large_components(spark):
    """Rows that share an id are rows of their own; a component whose products overflow leaves its row out."""
    data = rows()[:60] + [(1, [0.9] * 12, 1, 0.0, ""), (1, [0.5] * 12, 1, 0.0, ""), (20, [0.25] * 12, 1, 0.0, ""), (40, [1e18] * 12, 1, 0.0, ""),
                          (41, [1e6] * 12, 1, 0.0, ""), (40, [-1e6] * 12, 1, 0.0, ""), (40, [3e7] * 12, 1, 0.0, "")]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int, score double, rank string")
    assert found(top_k(df)) == brute(data, 20, "int")
    data = [r for r in data if not r[1] or None in r[1] or not np.abs(r[1]).max() > 1e5]
    got, want = found(nearest(spark.createDataFrame(data, df.schema))), brute(data, 20, "float")
    assert {q: len(v) for q, v in got.items()} == {q: len(v) for q, v in want.items()} and recall(got, want) >= 0.9


@pytest.mark.parametrize("shard_rows, query_rows", [(8192, 4096), (100, 7)])
def test_top_k_equals_brute_force(spark, monkeypatch, shard_rows, query_rows):
    monkeypatch.setattr(vectors, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(vectors, "QUERY_ROWS", query_rows)
    data = rows()
    assert found(top_k(spark.createDataFrame(data, SCHEMA), 20)) == brute(data, 20, "int")


def ranked(x, q, own, k):
    score = x @ q
    order = np.lexsort((np.arange(len(x)), -score))
    order = order[order != own][:k]
    return order.tolist(), score[order].tolist()


@pytest.mark.parametrize("block", [300, 3000])
@pytest.mark.parametrize("share, low, high", [(0.04, 1, 60), (0.3, -60, 60), (1.0, -60, 60), (1.0, -60, 0), (0.02, 1, 3)])
def test_essential_lists_stay_exact(share, low, high, block):
    """Sparse, signed, dense, all-negative and much tied rows; every floor up to the k-th score gives the same."""
    rng = np.random.default_rng(0)
    x = np.where(rng.random((3000, 60)) < share, rng.integers(low, high, (3000, 60)), 0)
    blocks = [Postings(x[at:at + block]) for at in range(0, 3000, block)]
    for own in (17, 0, 2999):
        for q in (x[own], -x[own], np.zeros(60, np.int64)):
            rows, scores = ranked(x, q, own, 10)
            for floor in (-(1 << 63), scores[-1] - 5, scores[-1]):
                got, = best(blocks, q[None], 10, [own], [floor])
                assert (got[0].tolist(), got[1].tolist()) == (rows, scores)


@pytest.mark.parametrize("size", [50, 10 ** 8])
def test_many_queries_at_once(size):
    """Batches of queries, sums that doubles hold exactly and sums that they don't."""
    x = np.random.default_rng(2).integers(-size, size, (500, 16))
    got = best([Postings(x[:200]), Postings(x[200:])], x[:150], 20, list(range(150)), [-(1 << 63)] * 150)
    for i, (rows, scores, _) in enumerate(got):
        assert (rows.tolist(), scores.tolist()) == ranked(x, x[i], i, 20)


def test_sparse_postings_are_left_alone():
    """With a floor the lists of frequent, low terms are never traversed: far fewer postings are touched than the query has."""
    rng = np.random.default_rng(0)
    x = np.zeros((4000, 200), np.int64)
    x[:, :20] = rng.integers(0, 3, (4000, 20))  # frequent and low
    x[:, 20:] = np.where(rng.random((4000, 180)) < 0.01, rng.integers(30, 60, (4000, 180)), 0)  # rare and high
    blocks, q = [Postings(x[at:at + 1000]) for at in range(0, 4000, 1000)], x[17]
    rows, scores = ranked(x, q, 17, 10)
    got, = best(blocks, q[None], 10, [17], [scores[-1]])
    assert got[0].tolist() == rows and got[2] < 0.2 * np.count_nonzero(x[:, q != 0])


def test_graph_of_a_shard_is_built_once(spark, monkeypatch):
    """The written graphs have one list of edges for each distinct vector, whatever the number of query blocks, and searches read them."""
    data = rows()
    monkeypatch.setattr(vectors, "SHARD_ROWS", 150)
    calls, index = [], vectors.shard_index

    def counted(base, build):
        calls.append(index(base, build))
        return calls[-1]

    monkeypatch.setattr(vectors, "shard_index", counted)
    df, results = spark.createDataFrame(data, SCHEMA), []
    for query_rows in (4096, 5):
        monkeypatch.setattr(vectors, "QUERY_ROWS", query_rows)
        results.append(found(nearest(df)))
    assert results[0].keys() == results[1].keys() and len(calls) == 2
    want = brute(data, 20, "float")
    assert all(recall(r, want) >= 0.95 for r in results)
    counts = [c.where("size(edges) > 0").groupBy("shard").count().count() for c in calls]
    built = [c.select("row").distinct().count() == c.count() for c in calls]
    assert counts[0] == counts[1] == -(-calls[0].count() // 150) and all(built)


def test_written_edges_are_the_graph():
    x = np.random.default_rng(1).normal(size=(300, 8))
    x[50:90] = x[3]
    lists, distinct = _build(x), np.unique(x, axis=0)
    assert sum(bool(e) for e in lists) == len(distinct) == 260
    assert sorted(map(tuple, (e for e in lists if e))) == sorted(map(tuple, Graph(same_length(distinct)).edges.tolist()))


@pytest.mark.parametrize("n", [0, 1, 2, 15])
def test_few_vectors(spark, n):
    data = rows()[:n] if n > 2 else [(20 * i, [1.0, 2.0 + i], 1, 0.0, "") for i in range(n)]
    df = spark.createDataFrame(data, SCHEMA)
    assert found(top_k(df)) == brute(data, 20, "int")
    got, want = found(nearest(df)), brute(data, 20, "float")
    assert {q: [i for v in some for i, _ in v] for q, some in got.items()} == {q: [i for v in some for i, _ in v] for q, some in want.items()}


def recall(got, want):
    hits = sum(len({i for i, _ in g} & {i for i, _ in v}) for q, some in want.items() for g, v in zip(got.get(q, []), some))
    return hits / sum(len({i for i, _ in v}) for some in want.values() for v in some)


@pytest.mark.parametrize("shard_rows", [8192, 150])
def test_nearest_recall_and_scores(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(vectors, "SHARD_ROWS", shard_rows)
    data = rows()
    got, want = found(nearest(spark.createDataFrame(data, SCHEMA))), brute(data, 20, "float")
    assert set(got) == set(want) and recall(got, want) >= 0.95
    x = {i: np.array(v, np.float64) for i, v, *_ in data if v and None not in v}
    for q, some in got.items():
        for v in some:
            assert len(v) == 20 and all(s == pytest.approx(x[i] @ x[q], rel=1e-12) for i, s in v)
            assert v == sorted(v, key=lambda t: (-t[1], t[0]))


def test_query_recall(spark):
    from statline.llm.queries import QUERIES
    mid = "/root/testdata/sf0.1"
    data = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{mid}/embeddings.parquet").collect()]
    assert recall(found(QUERIES["op10_nearest"](spark, mid)), brute(data, 20, "float")) >= 0.95
    assert found(QUERIES["op1_top_k"](spark, mid)) == brute(data, 20, "int")


def test_graph_is_diverse_and_connected():
    x = np.random.default_rng(1).normal(size=(2000, 16))
    graph = Graph(same_length(x))
    assert (graph.edges >= 0).sum(axis=1).max() <= graph.edges.shape[1]
    reached, front = {graph.start}, [graph.start]
    while front:
        front = [j for i in front for j in graph.edges[i] if j >= 0 and j not in reached and not reached.add(j)]
    assert len(reached) >= 1990
