"""Shards of a vector table against blocks of its queries."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runtime import saved, workers_import_package

#: Vectors of a shard and queries of a block; both bound what one task holds.
SHARD_ROWS, QUERY_ROWS = 8192, 4096
QUERY_EVERY = 20
#: Floor of a query that has none.
LEAST = -(1 << 63)


def usable(vectors: DataFrame, column: str = "embedding", zero: bool = True, scale: int | None = None) -> DataFrame:
    """(vec_id, v) with finite vectors of doubles; rows that repeat an id all stay.

    Rows with a null id, vector or component, an empty vector or a component that isn't finite are
    left out, and all-zero vectors unless ``zero``. With ``scale``, rows are left out too that hold a component x
    for which the inner product of two such vectors of floor(scale * x) might not fit 63 bits
    (floor(scale * x) squared times the width reaches 2^62). Other columns are not looked at.
    """
    v = F.transform(F.col(column), lambda x: x.cast("double"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (vectors.where(F.col("vec_id").isNotNull() & F.col(column).isNotNull() & (F.size(column) > 0))
            .select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(finite))
    if not zero:
        rows = rows.where(F.exists("v", lambda x: x != 0.0))
    if scale:
        most = F.sqrt(F.lit(2.0 ** 62) / F.size("v")) - 1
        rows = rows.where(F.forall("v", lambda x: F.abs(x) * scale < most))
    return rows


def matrix(lists: pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column with one length as a matrix; shorter ones are filled with zeros."""
    parts = [c for c in lists.chunks if len(c)]
    offsets = np.concatenate([np.diff(c.offsets.to_numpy()) for c in parts])
    flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in parts])
    width = int(offsets.max())
    if (offsets == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(offsets), width))
    out[np.repeat(np.arange(len(offsets)), offsets), np.arange(len(flat)) - np.repeat(np.cumsum(offsets) - offsets, offsets)] = flat
    return out


def _sorted_shard(table: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Table]:
    """(ids, row numbers, table) of a shard in order of (id, row number)."""
    ids, row = table.column("vec_id").to_numpy(), table.column("row").to_numpy()
    order = np.lexsort((row, ids))
    return ids[order], row[order], table.take(pa.array(order))


def shard_index(base: DataFrame, build: Callable) -> DataFrame:
    """``base`` (vec_id, v, row, shard) with what ``build(vectors)`` makes of each shard, as a written table.

    ``build`` gets a shard's vectors in order of (vec_id, row) and returns a list of integers for each; they
    are the column ``edges``. A shard is built once, however many blocks of queries search it.
    """
    def run(table: pa.Table) -> pa.Table:
        ids, row, table = _sorted_shard(table)
        edges = build(matrix(table.column("v")))
        return pa.table({"vec_id": ids, "v": table.column("v"), "row": row, "shard": table.column("shard"),
                         "edges": pa.array(edges, pa.list_(pa.int32()))})

    return saved(base.groupBy("shard").applyInArrow(run, "vec_id long, v array<double>, row long, shard int, edges array<int>"), "index")


def search_shards(rows: DataFrame, search: Callable, score: str, k: int, build: Callable | None = None,
                  floors: bool = False) -> DataFrame:
    """Best ``k`` rows for every query: ``search`` runs for each shard and block of queries, results are merged.

    ``rows`` is (vec_id, v); queries are those whose id is divisible by ``QUERY_EVERY``, and each row is a query
    of its own, whose candidates are all other rows: ``query_row``, the row's number, tells the queries of a
    repeated id apart. Shards come from a hash of the row's number. A shard is shuffled once for each block of queries and a block once for
    each shard. ``search(vectors, own, query_vectors, edges, floor)`` gets rows in order of their ids, for each query its own
    row's place, or -1, the lists that ``build`` made of the shard (None without it) and for each query a score that ``k``
    rows of the first shard reach (the least long if unknown). It returns arrays (query number, row number, score), at least the best ``k`` of the
    shard that reach the floor, with ties to smaller ids. With ``floors`` the first shard is searched before all others, for their floors.
    """
    workers_import_package(rows.sparkSession)
    rows = saved(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")  # numbered as it is written, once
    is_query = F.col("vec_id") % QUERY_EVERY == 0
    n, n_queries = rows.agg(F.count("*"), F.count_if(is_query)).first()
    shards, blocks = max(1, math.ceil(n / SHARD_ROWS)), max(1, math.ceil(n_queries / QUERY_ROWS))
    every = lambda first, count: F.explode(F.sequence(F.lit(first), F.lit(count - 1)))
    own = lambda count, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(count)).cast("int")
    base = rows.withColumn("shard", own(shards, 1))
    if build:
        base = shard_index(base, build)
    asked = rows.where(is_query).withColumn("block", own(blocks, 2)).withColumn("floor", F.lit(LEAST))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        kind = pa.int64() if score == "long" else pa.float64()
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "query_row": pa.array([], pa.int64()),
                             "vec_id": pa.array([], pa.int64()), "score": pa.array([], kind)})
        (ids, row, left), (query_ids, query_row, right) = _sorted_shard(left), _sorted_shard(right)
        x, q = matrix(left.column("v")), matrix(right.column("v"))
        width = max(x.shape[1], q.shape[1])
        x, q = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (x, q))
        by_row = np.argsort(row)
        at = np.minimum(np.searchsorted(row[by_row], query_row), len(row) - 1)
        own = np.where(row[by_row][at] == query_row, by_row[at], -1)
        edges = left.column("edges") if build else None
        which, found, value = search(np.ascontiguousarray(x), own, np.ascontiguousarray(q), edges, right.column("floor").to_numpy())
        return pa.table({"query_id": query_ids[which], "query_row": query_row[which], "vec_id": ids[found],
                         "score": pa.array(value, kind)})

    def searched(asked: DataFrame, first: int, count: int) -> DataFrame:
        some = base.where(F.col("shard").between(first, count - 1)).withColumn("block", every(0, blocks))
        return (some.groupBy("shard", "block")
                .cogroup(asked.withColumn("shard", every(first, count)).groupBy("shard", "block"))
                .applyInArrow(run, f"query_id long, query_row long, vec_id long, score {score}"))

    if floors and shards > 1:
        first = saved(searched(asked, 0, 1), "first-shard")
        reached = (first.groupBy(F.col("query_row").alias("row")).agg(F.min("score").alias("known"), F.count("*").alias("n"))
                   .where(F.col("n") >= k).select("row", "known"))
        asked = saved(asked.join(reached, "row", "left").withColumn("floor", F.coalesce("known", "floor")).drop("known"), "floors")
        found = first.unionByName(searched(asked, 1, shards))
    else:
        found = searched(asked, 0, shards)
    best = F.row_number().over(Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", best).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", "query_row")
