"""Approximate nearest neighbours by inner product on robust-pruned directed graphs, one for each shard.

A shard's distinct vectors are the nodes. They are inserted in rounds of doubling size: greedy
searches from the node nearest the mean propose neighbours, and pruning keeps a proposal only if no
kept neighbour is nearer to it by the factor ``ALPHA``, which leaves diverse edges. Edges are added
both ways and pruned again where a node gets too many. Vectors of a round are searched for side by
side in array operations. Each shard's graph is built once and written as a table; blocks of queries read it. A query runs a beam search on each shard's graph, and shards are merged.

For the largest inner product the graph works on vectors with one more component that gives all of
them the same length, so nearness by distance and by product agree; scores are products of the
original vectors in double precision. Equal vectors are one node, whose smallest ids answer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import search_shards, usable

DEGREE, BEAM_BUILD, BEAM_SEARCH, ALPHA = 32, 64, 96, 1.2
FIRST_ROUND = 64


class Graph:
    def __init__(self, points: np.ndarray, edges: np.ndarray | None = None, seed: int = 7):
        """Builds the edges, or takes the ``edges`` of a graph that was built over the same points."""
        self.x = np.ascontiguousarray(points, np.float32)
        n = len(points)
        self.start = int(np.argmax(self.x @ self.x.mean(axis=0)))
        if edges is not None:
            self.edges = edges
            return
        self.edges = np.full((n, DEGREE), -1, np.int32)
        order = np.random.default_rng(seed).permutation(n).astype(np.int32)
        order = np.concatenate(([self.start], order[order != self.start])).astype(np.int32)
        done, size = 1, FIRST_ROUND
        while done < n:
            batch = order[done:done + size]
            if done <= DEGREE:  # too few to search: all of them and the batch itself
                pool = np.tile(order[:min(done + size, n)], (len(batch), 1))
            else:
                beam, seen = self.search(self.x[batch], BEAM_BUILD, keep_seen=True)
                pool = np.concatenate((beam, seen), axis=1)
            self.edges[batch] = self._prune(batch, pool)
            self._add_back(batch)
            done += len(batch)
            size = min(2 * size, max(FIRST_ROUND, n // 8))

    def _dist(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Distance (all vectors have one length) from each of ``a`` to its row of nodes ``b``; -1: infinite."""
        d = 1.0 - np.einsum("id,ijd->ij", a, self.x[b])
        d[b < 0] = np.inf
        return d

    def search(self, queries: np.ndarray, beam: int, keep_seen: bool = False):
        """Nodes found by a beam search of all ``queries`` at once, nearest first, -1 where there are fewer."""
        n = len(queries)
        queries = queries.astype(np.float32)
        nodes = np.full((n, beam), -1, np.int32)
        dist = np.full((n, beam), np.inf, np.float32)
        open_ = np.zeros((n, beam), bool)
        nodes[:, 0], open_[:, 0] = self.start, True
        dist[:, 0] = 1.0 - queries @ self.x[self.start]
        visited = np.zeros((n, len(self.x)), bool)
        visited[:, self.start] = True
        seen = []
        live = np.arange(n)
        while len(live):
            pick = open_[live].argmax(axis=1)  # nearest open node, as beams are sorted
            at = nodes[live, pick]
            open_[live, pick] = False
            if keep_seen:
                step = np.full(n, -1, np.int32)
                step[live] = at
                seen.append(step)
            near = self.edges[at]
            rows = live[:, None]
            fresh = (near >= 0) & ~visited[rows, near]
            near = np.where(fresh, near, -1)
            visited[rows.repeat(near.shape[1], 1)[fresh], near[fresh]] = True
            d = self._dist(queries[live], near).astype(np.float32)
            all_d = np.concatenate((dist[live], d), axis=1)
            best = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
            best = np.take_along_axis(best, np.take_along_axis(all_d, best, 1).argsort(axis=1, kind="stable"), 1)
            dist[live] = np.take_along_axis(all_d, best, 1)
            nodes[live] = np.take_along_axis(np.concatenate((nodes[live], near), axis=1), best, 1)
            open_[live] = np.take_along_axis(np.concatenate((open_[live], fresh), axis=1), best, 1)
            live = live[open_[live].any(axis=1)]
        if keep_seen:
            return nodes, np.stack(seen, axis=1)
        return nodes

    def _prune(self, own: np.ndarray, pool: np.ndarray) -> np.ndarray:
        """At most ``DEGREE`` diverse neighbours of each node of ``own`` from its row of ``pool``."""
        out = np.full((len(own), DEGREE), -1, np.int32)
        for at in range(0, len(own), 512):
            me, from_ = own[at:at + 512], np.sort(pool[at:at + 512], axis=1)
            from_ = np.where((from_ == me[:, None]) | (np.diff(from_, axis=1, prepend=-2) == 0), -1, from_)
            d = self._dist(self.x[me], from_)
            order = d.argsort(axis=1, kind="stable")[:, :2 * BEAM_BUILD]
            from_, d = np.take_along_axis(from_, order, 1), np.take_along_axis(d, order, 1)
            got = self.x[from_]
            between = 1.0 - np.matmul(got, got.transpose(0, 2, 1))
            alive = from_ >= 0
            count = np.zeros(len(me), np.int64)
            rows = np.arange(len(me))
            for _ in range(DEGREE):
                some = alive.any(axis=1)
                if not some.any():
                    break
                pick = alive.argmax(axis=1)
                r, p = rows[some], pick[some]
                out[at + r, count[r]] = from_[r, p]
                count[r] += 1
                alive[r, p] = False
                alive[r] &= ALPHA * between[r, p] > d[r]
        return out

    def _add_back(self, batch: np.ndarray) -> None:
        to = self.edges[batch]
        source = np.repeat(batch, DEGREE)[to.ravel() >= 0]
        target = to.ravel()[to.ravel() >= 0]
        order = np.lexsort((source, target))
        source, target = source[order], target[order]
        nodes, first, counts = np.unique(target, return_index=True, return_counts=True)
        for at in range(0, len(nodes), 2048):
            some, n = nodes[at:at + 2048], counts[at:at + 2048]
            # a node that a whole round points at takes as many proposals as pruning looks at
            width = int(min(n.max(), 2 * BEAM_BUILD))
            column = first[at:at + 2048][:, None] + np.arange(width)[None, :]
            new = np.where(np.arange(width)[None, :] < n[:, None], source[np.minimum(column, len(source) - 1)], -1)
            pool = np.concatenate((self.edges[some], new), axis=1).astype(np.int32)
            pool_size = (np.diff(np.sort(pool, axis=1), axis=1, prepend=-2) != 0).sum(axis=1)
            full = pool_size > DEGREE
            if full.any():
                self.edges[some[full]] = self._prune(some[full], pool[full])
            if (~full).any():
                few = np.sort(pool[~full], axis=1)[:, ::-1]
                few = np.where(np.diff(few, axis=1, prepend=-2) == 0, -1, few)
                self.edges[some[~full]] = -np.sort(-few, axis=1)[:, :DEGREE]


def same_length(vectors: np.ndarray) -> np.ndarray:
    """Vectors scaled by the largest length, with one more component that makes all lengths 1."""
    square = (vectors ** 2).sum(axis=1)
    most = square.max()
    return np.concatenate((vectors, np.sqrt(np.maximum(most - square, 0))[:, None]), axis=1) / np.sqrt(most)


def _nodes(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct vectors, rows by node and in it by id, start of each node in them)."""
    distinct, node_of = np.unique(vectors, axis=0, return_inverse=True)
    members = np.argsort(node_of.ravel(), kind="stable")
    return distinct, members, np.searchsorted(node_of.ravel()[members], np.arange(len(distinct) + 1))


def _build(vectors: np.ndarray) -> list[list[int]]:
    """Edges of each node, by numbers of nodes, at the node's first row; other rows have none."""
    distinct, members, starts = _nodes(vectors)
    out: list[list[int]] = [[] for _ in range(len(vectors))]
    for row, edges in zip(members[starts[:-1]].tolist(), Graph(same_length(distinct)).edges.tolist()):
        out[row] = edges
    return out


def _search(k: int, beam: int):
    def search(vectors, own, queries, edges, floor):
        distinct, members, starts = _nodes(vectors)
        flat = edges.combine_chunks().take(pa.array(members[starts[:-1]])).flatten().to_numpy()
        graph = Graph(same_length(distinct), flat.reshape(len(distinct), DEGREE))
        which, rows, scores = [], [], []
        unit = queries / np.linalg.norm(queries, axis=1, keepdims=True)
        unit = np.concatenate((unit, np.zeros((len(unit), 1))), axis=1)
        for at in range(0, len(queries), 1024):
            found = graph.search(unit[at:at + 1024], min(beam, max(len(distinct), 1)))
            for i, nodes in enumerate(found, at):
                nodes = nodes[nodes >= 0]
                value = distinct[nodes] @ queries[i]
                # k + 1 of equal vectors, as one may be the query itself
                take = [members[starts[n]:min(starts[n] + k + 1, starts[n + 1])] for n in nodes.tolist()]
                row, score = np.concatenate(take), np.repeat(value, [len(t) for t in take])
                other = row != own[i]
                row, score = row[other], score[other]
                order = np.lexsort((row, -score))[:k]
                which.append(np.full(len(order), i))
                rows.append(row[order])
                scores.append(score[order])
        return np.concatenate(which), np.concatenate(rows), np.concatenate(scores)

    return search


def nearest(vectors: DataFrame, k: int = 20, beam: int = BEAM_SEARCH) -> DataFrame:
    """(query_id, rank, vec_id, score, query_row): the ``k`` nearest found of each query by inner product, ties to smaller ids.

    Queries are rows whose vec_id is divisible by 20; all other rows are candidates, rows that repeat the
    query's id too (``query_row`` tells the queries of one id apart). Every row is in its shard's graph. Rows that
    :func:`usable` leaves out and zero vectors take no part; vectors of unequal length count as filled with
    zeros. A query without a candidate has no row.
    """
    return search_shards(usable(vectors, zero=False), _search(k, beam), "double", k, build=_build)
