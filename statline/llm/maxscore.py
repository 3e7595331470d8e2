"""Exact top-k by integer inner product with MaxScore over postings.

A vector's components are its terms. A shard's rows are held in blocks, and in a block each term has a postings list: the rows
where it isn't zero, in order, with their values. Against a query a term's bound is the largest product that a row of the block
can add, or 0 if none adds anything. Terms in order of their bounds split in two: the non-essential ones are the longest run
from the smallest bound whose bounds together cannot reach the score needed; a row that is helped by no other term
cannot reach it either. The postings of the essential terms are traversed, and rows that one of them helps become candidates;
the non-essential lists are only probed for candidates, largest bound first, while a candidate's score and the bounds
left reach the score needed. That is one more than the k-th best of the rows before, which have smaller ids, and no less than the k-th best of
the first shard, which is searched before the others. All sums are integers, so results are exact; ties go to the smaller id.
The shards' best are merged by a ranked window.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from .vectors import search_shards, usable

SCALE = 64
#: Rows of a block: its bounds are its own, and the score needed rises from block to block.
BLOCK = 4096
#: Queries whose essential postings are traversed together, and the filled share from which a block's lists are held as one table.
TOGETHER, FULL = 64, 0.25


class Postings:
    """Postings by term of one block of rows, with the largest and smallest value of each list.

    Lists that are nearly full are a table of terms by rows, so traversing them for many queries is one product.
    """

    def __init__(self, vectors: np.ndarray):
        self.n, self.width = vectors.shape
        self.highest = np.maximum(vectors.max(axis=0), 0)
        self.lowest = np.minimum(vectors.min(axis=0), 0)
        self.most = max(int(self.highest.max()), -int(self.lowest.min()))
        self.full = np.count_nonzero(vectors) >= FULL * vectors.size
        if self.full:
            self.table = np.ascontiguousarray(vectors.T)
            self.floats = self.table.astype(np.float64)
        else:
            term, self.rows = np.nonzero(vectors.T)
            self.values = vectors.T[term, self.rows]
            self.starts = np.searchsorted(term, np.arange(self.width + 1))

    def plan(self, query: np.ndarray, needed: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(terms by rising bound, what the first of them can add together, number of non-essential ones)."""
        bound = np.where(query > 0, query * self.highest, query * self.lowest)
        terms = np.argsort(bound, kind="stable")
        terms = terms[query[terms] != 0]
        reach = np.cumsum(bound[terms])
        return terms, reach, int(np.searchsorted(reach, needed, side="left")) if needed > 0 else 0

    def traverse(self, queries: np.ndarray, essential: list[np.ndarray]) -> tuple[np.ndarray, list[int]]:
        """(scores of the essential terms by query and row, postings touched by query)."""
        part = np.zeros((len(queries), self.width), np.int64)
        for i, terms in enumerate(essential):
            part[i, terms] = queries[i, terms]
        if self.full:
            small = float(np.abs(part).max(initial=0)) * self.most * self.width < 2.0 ** 53  # sums are exact in doubles
            return part.astype(np.float64) @ self.floats if small else part @ self.table, [len(t) * self.n for t in essential]
        score, touched = np.zeros((len(queries), self.n), np.int64), []
        for i, terms in enumerate(essential):
            for t in terms.tolist():
                some = slice(self.starts[t], self.starts[t + 1])
                score[i, self.rows[some]] += part[i, t] * self.values[some]
            touched.append(int((self.starts[terms + 1] - self.starts[terms]).sum()))
        return score, touched

    def probe(self, term: int, rows: np.ndarray) -> np.ndarray:
        """Values of ``rows`` in a list, 0 where it doesn't hold them."""
        if self.full:
            return self.table[term, rows]
        listed, values = (a[self.starts[term]:self.starts[term + 1]] for a in (self.rows, self.values))
        if not len(listed):
            return np.zeros(len(rows), np.int64)
        at = np.minimum(np.searchsorted(listed, rows), len(listed) - 1)
        return np.where(listed[at] == rows, values[at], 0)

    def competing(self, queries: np.ndarray, needed: list[int]):
        """(rows, scores, postings touched) of each query: all rows of the block with at least its score ``needed``.

        A row that no essential term helps has at most 0 from them, less than what is needed beyond the rest.
        """
        plans = [self.plan(q, least) for q, least in zip(queries, needed)]
        scores, counts = self.traverse(queries, [terms[split:] for terms, _, split in plans])
        for query, least, (terms, reach, split), score, touched in zip(queries, needed, plans, scores, counts):
            rows = np.flatnonzero(score >= least - (int(reach[split - 1]) if split else 0))
            score = score[rows].astype(np.int64)
            for i in range(split - 1, -1, -1):
                if not len(rows):
                    break
                touched += len(rows)
                score += query[terms[i]] * self.probe(terms[i], rows)
                left = score >= least - (int(reach[i - 1]) if i else 0)
                if not left.all():
                    rows, score = rows[left], score[left]
            yield rows, score, touched


def best(blocks: list[Postings], queries: np.ndarray, k: int, own, floors) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """For each query (row numbers, scores, postings touched): the ``k`` best rows of all ``blocks`` that reach its floor, best first, without its row ``own``."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), 0) for _ in queries]
    for first in range(0, len(queries), TOGETHER):
        some, at = range(first, min(first + TOGETHER, len(queries))), 0
        for block in blocks:
            needed = [max(int(floors[i]), int(found[i][1][-1]) + 1) if len(found[i][1]) == k else int(floors[i]) for i in some]
            for i, (new, score, n) in zip(some, block.competing(queries[some.start:some.stop], needed)):
                rows, scores, touched = found[i]
                if len(new):
                    new = new + at
                    rows, scores = np.concatenate((rows, new[new != own[i]])), np.concatenate((scores, score[new != own[i]]))
                    if len(scores) > k:
                        reach = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                        rows, scores = rows[reach], scores[reach]
                    order = np.lexsort((rows, -scores))[:k]  # rows are in order of their ids
                    rows, scores = rows[order], scores[order]
                found[i] = rows, scores, touched + n
            at += block.n
    return found


def _search(k: int):
    def search(vectors, own, queries, edges, floor):
        vectors, queries = (np.floor(SCALE * m).astype(np.int64) for m in (vectors, queries))
        blocks = [Postings(vectors[at:at + BLOCK]) for at in range(0, len(vectors), BLOCK)]
        found = best(blocks, queries, k, own, floor)
        which = np.repeat(np.arange(len(found)), [len(rows) for rows, _, _ in found])
        return which, np.concatenate([rows for rows, _, _ in found]), np.concatenate([scores for _, scores, _ in found])

    return search


def top_k(vectors: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score, query_row): the ``k`` highest integer inner products of each query, ties to smaller ids.

    Components become floor(64 * x). Queries are rows whose vec_id is divisible by 20; all other rows
    are candidates, rows that repeat the query's id too (``query_row`` tells the queries of one id apart). Rows that
    :func:`usable` leaves out take no part, among them those whose products might not fit a long; vectors of
    unequal length count as filled with zeros. A query without a candidate has no row.
    """
    return search_shards(usable(vectors, scale=SCALE), _search(k), "long", k, floors=True)
