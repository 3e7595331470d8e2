"""Random forests whose deep trees are grown and kept where their rows are.

Same trees as Spark ML's estimators build: quantile bins of the features, a Poisson bootstrap for each tree, all
features or a random subset of them at a node, splits by variance or Gini, leaves of one row. Spark ML keeps statistics
of every feature and bin for each of millions of nodes, and all nodes on the driver. Here

* nodes of more than ``LIMIT`` rows are split from sums over the distributed rows, one pass a level for all trees;
* the rows of a smaller node are shuffled to one task, which grows all below it;
* grown subtrees are rows of a Parquet table, and rows to score are joined with them.

The driver holds splits of large nodes only. Bootstrap weights and feature subsets are hashes of row key, tree and
node, so retries and other partitionings give the same forest.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Model
from pyspark.ml.linalg import DenseVector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import saved, workers_import_package

#: Rows (bootstrap weight) of a node whose subtree one task grows.
LIMIT = 1 << 20
#: Trees whose nodes at the same place of the tree are grown by one task, where the rows of these nodes are mostly the same.
TOGETHER = 8
BINS = 32
ROWS_PER_STEP = 1 << 15
NODES_PER_STEP = 64
ROWS_PER_WALK = 1 << 16
ROWS_PER_PART = 1 << 18
#: Nodes of up to so many rows (32 at most) are split from their rows in order of each feature, not from sums by bin.
FEW = (2, 3, 4, 6, 8, 12, 16, 24, 32)
CELLS_PER_STEP = 1 << 18
ROWS_PER_FILE = 1 << 19
#: Scored rows are added up in blocks of consecutive row numbers.
BLOCK_BITS = 14
#: Bytes of trees, and rows, that a scoring task takes if it scores with whole trees.
TREE_BYTES = 1 << 25
ROWS_TO_SCORE = 1 << 20
LEAF = 255
_POISSON = np.cumsum([np.exp(-1.0) / f for f in np.cumprod([1.0, *range(1, 15)])])
#: The weight of each range of the hash's first 16 bits, 255 where that range has two.
_WEIGHTS = [np.searchsorted(_POISSON, (np.arange(65536) + e) * 2.0 ** -16 - e * 2.0 ** -53, side="right") for e in (0, 1)]
_WEIGHTS = np.where(_WEIGHTS[0] == _WEIGHTS[1], _WEIGHTS[0], 255).astype(np.uint8)


@dataclass(frozen=True)
class Shape:
    """What every task knows of the forest; ``folds`` > 0 is a forest for each fold, of the rows outside it."""

    features: int
    subset: int
    classes: int  # 0: regression
    trees: int
    max_depth: int
    seed: int
    folds: int = 0

    @property
    def all_trees(self) -> range:
        return range(self.trees * max(self.folds, 1))

    @property
    def whole(self) -> bool:
        """Regression that may split any node on any feature."""
        return not self.classes and self.subset >= self.features

    def groups(self, large: bool) -> list[list[int]]:
        """Trees whose nodes at one place are mostly of the same rows: one tree of every fold's forest, or, if nodes are
        ``large``, some of a forest that tries all features."""
        if self.folds:
            return [[f * self.trees + t for f in range(self.folds)] for t in range(self.trees)]
        n = TOGETHER if self.whole and large else 1
        return [list(range(t, min(t + n, self.trees))) for t in range(0, self.trees, n)]


@dataclass
class Top:
    """The splits of a tree's large nodes; ``left`` is followed by the right child, ends have feature -1."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    heap: list[int] = field(default_factory=lambda: [1])

    def ends(self) -> list[int]:
        return [i for i, f in enumerate(self.feature) if f < 0]

    def split(self, at: int, feature: int, cut: int) -> tuple[int, int]:
        here = len(self.heap)
        self.feature[at], self.cut[at], self.left[at] = feature, cut, here
        for right in (0, 1):
            self.feature.append(-1)
            self.cut.append(0)
            self.left.append(-1)
            self.heap.append(2 * self.heap[at] + right)
        return here, here + 1

    def route(self, bins: np.ndarray) -> np.ndarray:
        return _walk(np.array(self.feature), np.array(self.cut), np.array(self.left), bins)


def _walk(feature: np.ndarray, cut: np.ndarray, left: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """The end that each row reaches from node 0."""
    at = np.zeros(len(bins), np.int64)
    moving = np.arange(len(bins))
    while len(moving):
        here = at[moving]
        inner = feature[here] >= 0
        moving, here = moving[inner], here[inner]
        at[moving] = left[here] + (bins[moving, feature[here]] > cut[here])
    return at


def _mix(x: np.ndarray) -> np.ndarray:
    """Well-spread 64 bits of 64 bits (splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _stream(shape: Shape, tree: int) -> np.uint64:
    """Of hashes; the forests of all folds share theirs, apart from those of a forest of all rows."""
    tree = tree % shape.trees + (shape.trees if shape.folds else 0)
    return _mix(_mix(np.array([shape.seed], np.uint64)) + np.uint64(tree))[0]


def weights(row_hash: np.ndarray, shape: Shape, tree: int) -> np.ndarray:
    """How often the tree's bootstrap takes each row: Poisson with mean 1."""
    drawn = _mix(row_hash.view(np.uint64) ^ _stream(shape, tree))
    w = _WEIGHTS[(drawn >> np.uint64(48)).astype(np.int64)]
    open_ = np.flatnonzero(w == 255)
    w[open_] = np.searchsorted(_POISSON, (drawn[open_] >> np.uint64(11)).astype(float) * 2.0 ** -53, side="right")
    return w


def subsets(heap: np.ndarray, shape: Shape, tree: int) -> np.ndarray | None:
    """(nodes, subset) features that each node may split on; None: all."""
    if shape.subset >= shape.features:
        return None
    node = _mix(heap.astype(np.uint64) ^ _stream(shape, tree))
    drawn = _mix(node[:, None] + np.arange(1, shape.features + 1, dtype=np.uint64)[None, :])
    return np.sort(np.argpartition(drawn, shape.subset - 1, axis=1)[:, :shape.subset], axis=1)


def sums(bins: np.ndarray, node: np.ndarray, nodes: int, chosen: np.ndarray | None, w: np.ndarray, y: np.ndarray,
         classes: int) -> np.ndarray:
    """(nodes, features, channels, bins): weight by class, or weight and weighted label."""
    width = bins.shape[1] if chosen is None else chosen.shape[1]
    channels = classes or 2
    out = np.zeros((nodes, width, channels, BINS))
    for i in range(0, len(w), ROWS_PER_STEP):
        part = slice(i, i + ROWS_PER_STEP)
        at, b, wt = node[part], bins[part], w[part].astype(float)
        if chosen is not None:
            cell = chosen[at]
            cell += np.arange(0, b.size, b.shape[1])[:, None]
            b = b.ravel().take(cell, mode="clip")
        start = (at * classes + y[part]) * BINS if classes else at * BINS
        wy = None if classes else wt * y[part]
        for f, column in enumerate(np.ascontiguousarray(b.T)):  # a feature at a time stays in the processor's cache
            cell = start + column
            if classes:
                out[:, f] += np.bincount(cell, wt, nodes * classes * BINS).reshape(nodes, classes, BINS)
            else:
                out[:, f, 0] += np.bincount(cell, wt, nodes * BINS).reshape(nodes, BINS)
                out[:, f, 1] += np.bincount(cell, wy, nodes * BINS).reshape(nodes, BINS)
    return out


def best_splits(stats: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(slot, cut, gain, weight left, weight) of each node's best split; rows of at most bin ``cut`` go left.

    The gain is the fall of impurity times the node's weight, -inf where no split leaves rows on both sides.
    """
    if classes:
        left = np.cumsum(stats, axis=-1)
        total = left[:, :, :, -1:]
        right = total - left
        nl, nr, ql, qr = left.sum(2), right.sum(2), (left * left).sum(2), (right * right).sum(2)
        n, q = total.sum(2), (total * total).sum(2)
        gain = ql / np.maximum(nl, 1) + qr / np.maximum(nr, 1) - q / np.maximum(n, 1)
        gain[(nl <= 0) | (nr <= 0)] = -np.inf
    else:
        nl, gain = np.cumsum(stats[:, :, 0], axis=-1), np.cumsum(stats[:, :, 1], axis=-1)
        n = nl[:, :, -1:].copy()
        whole = gain[:, :, -1:].copy()
        gain *= n
        gain -= whole * nl
        gain *= gain
        sides = n - nl
        sides *= nl
        empty = sides <= 0
        sides *= n
        gain /= np.maximum(sides, 0.5, out=sides)
        gain[empty] = -np.inf
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(axis=1)
    here = np.arange(len(at))
    return at // BINS, at % BINS, flat[here, at], nl.reshape(flat.shape)[here, at], n[:, 0, 0]


def _sort_first_axis(keys: np.ndarray) -> None:
    """Sort along the (short) first axis in place: Batcher's comparisons, each of whole planes."""
    n, p = len(keys), 1
    low = np.empty_like(keys[0])
    while p < n:
        k = p
        while k:
            for j in range(k % p, n - k, 2 * k):
                for i in range(j, j + min(k, n - j - k)):
                    if i // (2 * p) == (i + k) // (2 * p):
                        np.minimum(keys[i], keys[i + k], out=low)
                        np.maximum(keys[i], keys[i + k], out=keys[i + k])
                        keys[i] = low
            k //= 2
        p *= 2


def few_splits(bins: np.ndarray, w: np.ndarray, y: np.ndarray, size: np.ndarray,
               centred: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, cut, gain) of each node's best split as :func:`best_splits` has it, -inf for none; regression, all features.

    ``bins`` (places, nodes, features), ``w`` and ``y`` (places, nodes) hold the ``size`` rows of each node; places (at
    most ``FEW[-1]``) after these have weight 0; ``centred`` labels have a mean of 0 in each node. Most nodes of a tree
    have a few rows, far fewer than there are bins.
    """
    places, none, n = len(bins), np.uint16(0xFFFF), w.sum(axis=0)[:, None]
    place = np.arange(places, dtype=np.uint16)[:, None, None]
    keys = (bins.astype(np.uint16) << 5) | place
    if (size < places).any():
        keys = np.where(place < size[:, None], keys, none)
    _sort_first_axis(keys)
    at = np.minimum(keys & 31, places - 1).astype(np.int64)
    at *= len(size)
    at += np.arange(len(size))[:, None]
    left, total = np.take(w, at, mode="clip"), np.take(w * y, at, mode="clip")
    for k in range(1, places):
        left[k] += left[k - 1]
        total[k] += total[k - 1]
    gain, left, keys, scale = total[:-1], left[:-1], keys >> 5, n[:, 0]
    if not centred:  # else sums of both sides are opposite
        gain = gain * n - total[-1] * left
        scale = 1 / scale
    gain *= gain
    sides = n - left
    sides *= left
    gain /= np.maximum(sides, 0.5, out=sides)
    np.copyto(gain, -np.inf, where=(keys[:-1] >= keys[1:]) | (keys[1:] >= none >> 5))
    best = gain.max(axis=0)
    feature, here = best.argmax(axis=1), np.arange(len(size))
    after = gain[:, here, feature].argmax(axis=0)
    return feature, keys[after, here, feature], best[here, feature] * scale


class _Subtree:
    """A subtree while it grows: rows in an order in which each node's are neighbours, and nodes by number."""

    def __init__(self, bins: np.ndarray, y: np.ndarray, w: np.ndarray, shape: Shape, tree: int, heap: int):
        n = len(w)
        self.shape, self.tree = shape, tree
        self.whole = shape.whole
        # rows of a power of two bytes are copied fastest
        self.bins = np.zeros((n, 1 << max(shape.features - 1, 1).bit_length()), np.uint8)
        self.bins[:, :shape.features] = bins
        self.w, self.y = w.astype(float), y.copy()
        self.mean = 0 if shape.classes else np.average(y, weights=w)
        self.feature, self.cut = np.full(2 * n, LEAF, np.uint8), np.zeros(2 * n, np.uint8)
        self.first, self.size, self.left, self.heap = np.zeros((4, 2 * n), np.int64)
        self.size[0], self.heap[0], self.nodes = n, heap, 1
        self.importance = np.zeros(shape.features)

    def rows(self, at: np.ndarray) -> slice | np.ndarray:
        """The rows of the nodes ``at``, one node after the other."""
        first, size = self.first[at], self.size[at]
        if (first[1:] == first[:-1] + size[:-1]).all():
            return slice(first[0], first[-1] + size[-1])
        ends = np.cumsum(size)
        return np.arange(ends[-1]) + np.repeat(first - ends + size, size)

    def sums(self, at: np.ndarray, chosen: np.ndarray | None) -> np.ndarray:
        rows = self.rows(at)
        return sums(self.bins[rows, :self.shape.features], np.repeat(np.arange(len(at)), self.size[at]), len(at), chosen,
                    self.w[rows], self.y[rows] - self.mean, self.shape.classes)

    def mixed(self, at: np.ndarray) -> np.ndarray:
        """The nodes of ``at`` that may be split: labels differ, and the tree isn't deep enough."""
        y, start = self.y[self.rows(at)], np.cumsum(self.size[at]) - self.size[at]
        differ = np.minimum.reduceat(y, start) < np.maximum.reduceat(y, start)
        return np.flatnonzero(differ & (self.heap[at] < 1 << self.shape.max_depth))

    def split(self, at: np.ndarray) -> np.ndarray:
        """Put the rows of the nodes ``at``, which have their split, in order of their children; these nodes, right after left."""
        rows, size = self.rows(at), self.size[at]
        start = np.cumsum(size) - size
        held = self.bins[rows]
        n, width = held.shape
        cell = np.repeat(self.feature[at].astype(np.int64), size)
        cell += np.arange(0, n * width, width)
        right = held.ravel().take(cell, mode="clip") > np.repeat(self.cut[at], size)
        upto = np.cumsum(~right)
        before = upto[start] - ~right[start]
        lefts = upto[start + size - 1] - before
        to = np.where(right, np.arange(n) - upto + np.repeat(lefts + before, size), upto + np.repeat(start - 1 - before, size))
        order = np.empty(n, np.int64)
        order[to] = np.arange(n)
        self.bins[rows] = held.take(order, axis=0)
        self.y[rows], self.w[rows] = self.y[rows].take(order), self.w[rows].take(order)
        here, self.nodes = self.nodes, self.nodes + 2 * len(at)
        children = np.arange(here, self.nodes)
        self.left[at] = children[::2]
        for of, one, other in ((self.first, self.first[at], self.first[at] + lefts), (self.size, lefts, size - lefts),
                               (self.heap, 2 * self.heap[at], 2 * self.heap[at] + 1)):
            of[here:self.nodes:2], of[here + 1:self.nodes:2] = one, other
        return children

    def split_by_sums(self, at: np.ndarray, stats: np.ndarray | None) -> list[tuple]:
        """Split nodes; ``stats`` are their sums by bin if every feature's are kept. What is to be split next, as such arguments."""
        some = self.mixed(at)
        if not len(some):
            return []
        at, stats = at[some], None if stats is None else stats[some]
        chosen, size, spread = subsets(self.heap[at], self.shape, self.tree), self.size[at], np.zeros(len(at))
        if not self.shape.classes:
            rows, start = self.rows(at), np.cumsum(size) - size
            w, y = self.w[rows], self.y[rows] - self.mean
            mean = np.add.reduceat(w * y, start) / np.add.reduceat(w, start)
            y -= np.repeat(mean, size)
            spread = np.add.reduceat(w * y * y, start)
        good = np.zeros(len(at), bool)
        for i in range(0, len(at), NODES_PER_STEP):
            part = slice(i, i + NODES_PER_STEP)
            mine = self.sums(at[part], None if chosen is None else chosen[part]) if stats is None else stats[part]
            slot, cut, gain, _, _ = best_splits(mine, self.shape.classes)
            picked = slot if chosen is None else chosen[part][np.arange(len(slot)), slot]
            good[part] = self.keep(at[part], picked, cut, gain, spread[part])
        if not good.any():
            return []
        children = self.split(at[good])
        size, after = self.size[children], None
        more = np.ones(len(children), bool)
        if self.whole:  # sums of the smaller child, and what is left for the other
            more = size > FEW[-1]
            self.few.append(children[~more])
            pairs = np.flatnonzero(more[::2] | more[1::2])
            if not len(pairs):
                return []
            less = 2 * pairs + (size[2 * pairs] > size[2 * pairs + 1])
            after = np.empty((2 * len(pairs), *stats.shape[1:]))
            one = 2 * np.arange(len(pairs)) + less % 2
            after[one] = self.sums(children[less], None)
            after[one ^ 1] = stats[good][pairs] - after[one]
            after = after[more.reshape(-1, 2)[pairs].ravel()]
        children = children[more]
        if after is None:
            return [(children, None)]
        # the sums kept at a time are those of so many rows
        ends = np.flatnonzero(np.diff(np.cumsum(size[more]) // ROWS_PER_WALK)) + 1
        return [(children[p], after[p]) for p in np.split(np.arange(len(children)), ends) if len(p)]

    def keep(self, at: np.ndarray, feature: np.ndarray, cut: np.ndarray, gain: np.ndarray, spread: np.ndarray) -> np.ndarray:
        good = gain > 1e-12 * spread
        self.feature[at[good]], self.cut[at[good]] = feature[good], cut[good]
        self.importance += np.bincount(feature[good], gain[good], self.shape.features)
        return good

    def split_few(self, at: np.ndarray) -> np.ndarray:
        """Split nodes of up to ``FEW[-1]`` rows; their children."""
        at = at[self.mixed(at)]
        size = self.size[at]
        for fewer, places in zip((0, *FEW), FEW):
            small = at[(size > fewer) & (size <= places)]
            per_step = max(1, CELLS_PER_STEP // (self.shape.features * places))
            for i in range(0, len(small), per_step):
                nodes = small[i:i + per_step]
                place, count = np.arange(places)[:, None], self.size[nodes]
                rows = self.first[nodes] + np.minimum(place, count - 1)
                w, y = self.w[rows] * (place < count), self.y[rows]
                y -= (w * y).sum(axis=0) / w.sum(axis=0)
                feature, cut, gain = few_splits(self.bins.take(rows, axis=0)[:, :, :self.shape.features], w, y, count, centred=True)
                self.keep(nodes, feature, cut, gain, (w * y * y).sum(axis=0))
        at = at[self.feature[at] != LEAF]
        return self.split(at) if len(at) else at

    def grow(self) -> None:
        root = np.zeros(1, np.int64)
        self.few = [root[:0]]
        todo = []
        if self.whole and len(self.w) <= FEW[-1]:
            self.few.append(root)
        else:
            todo.append((root, self.sums(root, None) if self.whole else None))
        while todo:
            todo += self.split_by_sums(*todo.pop())
        few = np.concatenate(self.few)
        while len(few):
            few = self.split_few(few)

    def packed(self) -> bytes:
        levels, at = [], np.zeros(1, np.int64)
        while len(at):
            levels.append(at)
            inner = at[self.feature[at] != LEAF]
            at = (self.left[inner][:, None] + np.array([0, 1])).ravel()
        nodes = np.concatenate(levels)
        ends = nodes[self.feature[nodes] == LEAF]
        by_row = np.argsort(self.first[ends])
        start, values = self.first[ends][by_row], np.empty((len(ends), self.shape.classes or 1))
        for c in range(values.shape[1]):
            of = self.w * (self.y == c) if self.shape.classes else self.w * self.y
            values[by_row, c] = np.add.reduceat(of, start) / np.add.reduceat(self.w, start)
        return _subtree(self.feature[nodes], self.cut[nodes], values, self.shape.classes)


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, shape: Shape, tree: int, heap: int) -> tuple[bytes, np.ndarray]:
    """The subtree of the node ``heap`` over its rows, and the gain of each feature in it."""
    subtree = _Subtree(bins, y, w, shape, tree, heap)
    subtree.grow()
    return subtree.packed(), subtree.importance


def _subtree(feature: np.ndarray, cut: np.ndarray, values: np.ndarray, classes: int) -> bytes:
    """Features and cuts by level, then the leaves' values; children follow from the order."""
    data = feature.astype(np.uint8).tobytes() + cut.astype(np.uint8).tobytes() + values.astype("<f4" if classes else "<f8").tobytes()
    return np.array([len(feature)], "<i8").tobytes() + _zstd().compress(data, asbytes=True)


def subtree_values(data: bytes, bins: np.ndarray, classes: int) -> np.ndarray:
    """(rows, classes or 1): the value of the leaf that each row reaches."""
    n = int(np.frombuffer(data, "<i8", 1)[0])
    width = 4 * classes or 8
    data = _zstd().decompress(data[8:], 2 * n + (n + 1) // 2 * width)
    feature = np.frombuffer(data, np.uint8, n).astype(np.int64)
    cut = np.frombuffer(data, np.uint8, n, n)
    values = np.frombuffer(data, "<f4" if classes else "<f8", -1, 2 * n).reshape(-1, classes or 1)
    inner = feature != LEAF
    left = 2 * np.cumsum(inner) - 1
    feature[~inner] = -1
    return values[(np.cumsum(~inner) - 1)[_walk(feature, cut, left, bins)]].astype(float)


# ----------------------------------------------------------------- rows in tasks


def _zstd() -> pa.Codec:
    return pa.Codec("zstd", compression_level=1)


def _pack(n: int, *planes: np.ndarray) -> bytes:
    """Bytes of ``n`` rows, column after column: so they compress to about half."""
    return np.array([n, sum(p.nbytes for p in planes)], "<i8").tobytes() + _zstd().compress(b"".join(p.tobytes() for p in planes), asbytes=True)


def _unpack(data: bytes) -> tuple[int, pa.Buffer]:
    n, size = np.frombuffer(data, "<i8", 2).tolist()
    return n, _zstd().decompress(memoryview(data)[16:], size)


def _bin(columns: Sequence[np.ndarray], thresholds: Sequence[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(t, c, side="left").astype(np.uint8) for c, t in zip(columns, thresholds)])


def _packed(bins: np.ndarray) -> pa.Array:
    """One binary value for each row."""
    ends = np.arange(len(bins) + 1, dtype=np.int32) * bins.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(bins), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(bins))])


def _matrix(batch: pa.RecordBatch, features: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, features)


def _training(batches: Iterator[pa.RecordBatch], shape: Shape, most: int) -> Iterator[tuple]:
    """(bins, label, fold, hash) of up to about ``most`` rows at a time."""
    held, n = [], 0

    def joined():
        return tuple(np.concatenate(part) for part in zip(*held))

    for batch in batches:
        label = batch.column("label").to_numpy(zero_copy_only=False)
        held.append((_matrix(batch, shape.features), label.astype(np.int64) if shape.classes else label,
                     batch.column("fold").to_numpy(), batch.column("hash").to_numpy()))
        n += batch.num_rows
        if n >= most:
            yield joined()
            held, n = [], 0
    if n:
        yield joined()


def _bags(part: tuple, shape: Shape, trees: Sequence[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each tree, the rows of its bootstrap and their weights."""
    _, _, fold, row_hash = part
    of, drawn = None, None
    for tree in trees:
        if tree % shape.trees != of:
            of, drawn = tree % shape.trees, weights(row_hash, shape, tree)
        w = np.where(fold == tree // shape.trees, 0, drawn).astype(np.uint8) if shape.folds else drawn
        taken = np.flatnonzero(w)
        yield tree, taken, w[taken]


def _batch(schema: pa.Schema, columns: Sequence[Sequence]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_SUMS = "tree int, part int, step int, data binary"
_SPLITS = "tree int, open int, feature int, cut int, gain double, left double, total double, value binary"
_ROWS = "trees int, heap long, part int, step int, data binary"
_TREES = "tree int, node int, size long, data binary, importance binary"
_A_SUMS = pa.schema([("tree", pa.int32()), ("part", pa.int32()), ("step", pa.int32()), ("data", pa.binary())])
_A_SPLITS = pa.schema([("tree", pa.int32()), ("open", pa.int32()), ("feature", pa.int32()), ("cut", pa.int32()),
                       ("gain", pa.float64()), ("left", pa.float64()), ("total", pa.float64()), ("value", pa.binary())])
_A_ROWS = pa.schema([("trees", pa.int32()), ("heap", pa.int64()), ("part", pa.int32()), ("step", pa.int32()), ("data", pa.binary())])
_A_TREES = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("size", pa.int64()), ("data", pa.binary()), ("importance", pa.binary())])


def _sums_of_alike(part: tuple, shape: Shape, trees: list[int], top: Top, large: list[list[int]]) -> Iterator[np.ndarray]:
    """The sums of each tree's nodes ``large``; ``trees`` are one of a forest, or of several folds, with the same splits ``top``.

    A row is summed once, by its own fold, which is then left out of that fold's tree.
    """
    bins, y, fold, row_hash = part
    w, folds = weights(row_hash, shape, trees[0]), 1
    if len(trees) > 1:
        folds = shape.folds
    elif shape.folds:
        w[fold == trees[0] // shape.trees] = 0
    taken = np.flatnonzero(w)
    bins, y, fold, w = bins.take(taken, axis=0), y[taken], fold[taken], w[taken]
    nodes = sorted(set().union(*large))
    number = np.full(len(top.heap), -1)
    number[nodes] = np.arange(len(nodes))
    own = number[top.route(bins)]
    keep = np.flatnonzero(own >= 0)
    if len(keep) < len(own):
        own, bins, y, fold, w = own[keep], bins.take(keep, axis=0), y[keep], fold[keep], w[keep]
    chosen = subsets(np.array(top.heap)[nodes], shape, trees[0])
    if folds == 1:
        yield sums(bins, own, len(nodes), chosen, w, y, shape.classes)
        return
    got = sums(bins, own * folds + fold, len(nodes) * folds, None if chosen is None else np.repeat(chosen, folds, axis=0), w, y, shape.classes)
    got = got.reshape(len(nodes), folds, *got.shape[1:])
    for tree, mine in zip(trees, large):
        others = [f for f in range(folds) if f != tree // shape.trees]
        yield got[np.searchsorted(nodes, mine)][:, others].sum(axis=1)


def _split_large(binned: DataFrame, shape: Shape, tops: dict[int, Top], large: dict[int, list[int]]) -> list:
    """The best split of every node of ``large`` (tree -> nodes) from sums over all rows."""
    alike: dict[tuple, list[int]] = {}
    for t in large:  # trees of several folds with the same splits so far
        alike.setdefault((t % shape.trees, *tops[t].feature, *tops[t].cut), []).append(t)

    def within(batches):
        here = TaskContext.get().partitionId()
        for step, part in enumerate(_training(batches, shape, 8 * ROWS_PER_FILE)):
            for trees in alike.values():
                for got, tree in zip(_sums_of_alike(part, shape, trees, tops[trees[0]], [large[t] for t in trees]), trees):
                    yield _batch(_A_SUMS, [[tree], [here], [step], [got.tobytes()]])

    def across(table):
        table = table.sort_by([("part", "ascending"), ("step", "ascending")])
        tree = table.column("tree")[0].as_py()
        nodes = large[tree]
        stats = np.zeros((len(nodes), min(shape.subset, shape.features), shape.classes or 2, BINS))
        for data in table.column("data"):
            stats += np.frombuffer(data.as_buffer()).reshape(stats.shape)
        slot, cut, gain, left, total = best_splits(stats, shape.classes)
        chosen = subsets(np.array(tops[tree].heap)[nodes], shape, tree)
        feature = slot if chosen is None else chosen[np.arange(len(nodes)), slot]
        whole = stats[:, 0].sum(axis=-1)
        value = whole / whole.sum(1, keepdims=True) if shape.classes else whole[:, 1:] / whole[:, :1]
        return pa.Table.from_batches([_batch(_A_SPLITS, [[tree] * len(nodes), range(len(nodes)), feature, cut, gain, left, total,
                                                         [v.astype(float).tobytes() for v in value]])])

    return binned.mapInArrow(within, _SUMS).groupBy("tree").applyInArrow(across, _SPLITS).collect()


def _shipped(part: tuple, shape: Shape, trees: list[int], tops: dict[int, Top], done: dict[int, dict[int, bytes]]):
    """(heap number, rows, (trees, rows) weights): the rows of every place where one of ``trees`` has an end to be grown, once each."""
    ends = {t: [e for e in tops[t].ends() if e not in done.get(t, ())] for t in trees}
    heaps = np.unique([tops[t].heap[e] for t in trees for e in ends[t]])
    n, bits, codes = len(part[1]), (len(trees) - 1).bit_length(), [np.zeros(0, np.int64)]
    for j, (tree, taken, w) in enumerate(_bags(part, shape, trees)):
        top = tops[tree]
        if len(top.heap) > 1 or not ends[tree]:
            number = np.full(len(top.heap), -1)
            number[ends[tree]] = np.searchsorted(heaps, np.array(top.heap)[ends[tree]])
            at = number[top.route(part[0].take(taken, axis=0))]
            keep = np.flatnonzero(at >= 0)
            at, taken, w = at[keep], taken[keep], w[keep]
        else:
            at = np.searchsorted(heaps, top.heap[0])
        codes.append(((at * n + taken << bits) + j << 4) + w)
    codes = np.sort(np.concatenate(codes)) if len(trees) > 1 else np.sort(codes[-1], kind="stable")
    place = codes >> bits + 4
    new = np.diff(place, prepend=-1) > 0
    drawn = np.zeros((len(trees), int(new.sum())), np.uint8)
    drawn[codes >> 4 & (1 << bits) - 1, np.cumsum(new) - 1] = codes & 15
    place = place[new]
    bounds = np.searchsorted(place, np.arange(len(heaps) + 1) * n)
    for heap, a, b in zip(heaps.tolist(), bounds, bounds[1:]):
        if a < b:
            yield heap, place[a:b] % n, drawn[:, a:b]


def _grow_small(binned: DataFrame, shape: Shape, tops: dict[int, Top], done: dict[int, dict[int, bytes]]) -> DataFrame:
    """The subtrees below all ends of ``tops`` but the leaves ``done``: rows go to a task for each place and group of trees."""
    groups = shape.groups(any(len(top.heap) > 1 for top in tops.values()))
    tasks = min(4 * sum(len({tops[t].heap[e] for t in trees for e in tops[t].ends()}) for trees in groups), 4096)
    kind = np.dtype(np.uint8 if shape.classes else "<f8")

    def within(batches):
        here = TaskContext.get().partitionId()
        for step, part in enumerate(_training(batches, shape, ROWS_PER_PART)):
            for g, trees in enumerate(groups):
                out = []
                for heap, rows, drawn in _shipped(part, shape, trees, tops, done):
                    bins = np.ascontiguousarray(part[0].take(rows, axis=0).T)
                    out.append((g, heap, here, step, _pack(len(rows), bins, drawn, part[1][rows].astype(kind))))
                if out:
                    yield _batch(_A_ROWS, list(zip(*out)))

    def one(table):
        table = table.sort_by([("part", "ascending"), ("step", "ascending")])
        trees, heap = groups[table.column("trees")[0].as_py()], table.column("heap")[0].as_py()
        bins, drawn, y = [], [], []
        for data in table.column("data"):
            n, raw = _unpack(data.as_buffer())
            bins.append(np.frombuffer(raw, np.uint8, n * shape.features).reshape(-1, n).T)
            drawn.append(np.frombuffer(raw, np.uint8, n * len(trees), n * shape.features).reshape(-1, n))
            y.append(np.frombuffer(raw, kind, n, n * (shape.features + len(trees))))
        bins, drawn, y = np.concatenate(bins), np.concatenate(drawn, axis=1), np.concatenate(y)
        y, out = y.astype(np.int64 if shape.classes else float), []
        for tree, w in zip(trees, drawn):
            rows = np.flatnonzero(w)
            if len(rows):
                data, importance = grow(bins.take(rows, axis=0), y[rows], w[rows], shape, tree, heap)
                out.append((tree, tops[tree].heap.index(heap), len(data), data, importance.tobytes()))
        return pa.Table.from_batches([_batch(_A_TREES, list(zip(*out)))])

    rows = binned.mapInArrow(within, _ROWS).repartition(tasks, "trees", "heap")
    return rows.groupBy("trees", "heap").applyInArrow(one, _TREES)


def thresholds(rows: DataFrame, inputs: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Cuts between ``bins`` quantile ranges of each input; between all values of an input that has no more of them."""
    counts = rows.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in inputs]).first()
    few = [c for c in inputs if counts[c] <= bins * 1.2]
    values = rows.agg(*[F.collect_set(c).alias(c) for c in few]).first() if few else {}
    many = [c for c in inputs if c not in few or len(values[c]) > bins]
    found = dict(zip(many, rows.approxQuantile(many, [k / bins for k in range(1, bins)], 0.001))) if many else {}
    out = []
    for c in inputs:
        if c in found:
            out.append(np.unique(found[c]))
        else:
            v = np.unique(values[c])
            out.append((v[1:] + v[:-1]) / 2)
    return out


def fit(rows: DataFrame, inputs: Sequence[str], classes: int = 0, num_trees: int = 100, max_depth: int = 30,
        seed: int = 42, folds: int = 0, limit: int = LIMIT) -> ForestModel:
    """A forest of ``rows``: ``inputs`` (double), ``label`` (double; the class number), ``fold`` (int) and ``hash`` (long, of the row's key).

    Regression tries all features at a node, classification the square root of their number.
    """
    spark = rows.sparkSession
    workers_import_package(spark)
    subset = int(np.ceil(np.sqrt(len(inputs)))) if classes else len(inputs)
    shape = Shape(len(inputs), subset, classes, num_trees, max_depth, seed, folds)
    cuts = thresholds(rows, inputs)

    def binning(batches):
        for batch in batches:
            bins = _bin([batch.column(c).to_numpy(zero_copy_only=False) for c in inputs], cuts)
            yield pa.RecordBatch.from_arrays([_packed(bins),
                                              *[batch.column(c) for c in ("label", "fold", "hash")]], ["bins", "label", "fold", "hash"])

    n = rows.count()
    files = max(2 * spark.sparkContext.defaultParallelism, -(-n // ROWS_PER_FILE))
    spread = rows.select(*inputs, "label", "fold", "hash").repartition(files, "hash").sortWithinPartitions("hash", "label", *inputs)
    binned = saved(spread.mapInArrow(binning, "bins binary, label double, fold int, hash long"), "binned")
    tops = {t: Top() for t in shape.all_trees}
    done: dict[int, dict[int, bytes]] = {}
    importance = {t: np.zeros(shape.features) for t in shape.all_trees}
    large = {t: [0] for t in shape.all_trees} if n > limit else {}
    while large:
        following: dict[int, list[int]] = {}
        for s in _split_large(binned, shape, tops, large):
            top, node = tops[s["tree"]], large[s["tree"]][s["open"]]
            if not s["gain"] > 0 or top.heap[node].bit_length() > max_depth:
                done.setdefault(s["tree"], {})[node] = bytes(s["value"])
                continue
            importance[s["tree"]][s["feature"]] += s["gain"]
            for child, weight in zip(top.split(node, s["feature"], s["cut"]), (s["left"], s["total"] - s["left"])):
                if weight > limit:
                    following.setdefault(s["tree"], []).append(child)
        large = following
    grown = _grow_small(binned, shape, tops, done)
    leaves = [(t, node, 0, _subtree(np.array([LEAF]), np.zeros(1), np.frombuffer(v)[None, :], classes), np.zeros(shape.features).tobytes())
              for t, nodes in done.items() for node, v in nodes.items()]
    if leaves:
        grown = grown.unionByName(spark.createDataFrame(leaves, _TREES))
    trees = saved(grown, "forest")
    for tree, part in _importances(trees, shape):
        importance[tree] += part
    shares = [v / v.sum() for v in importance.values() if v.sum() > 0]
    total = np.sum(shares, axis=0) / len(shares) if shares else np.zeros(shape.features)
    return ForestModel(tuple(inputs), shape, [c.tolist() for c in cuts], tops, n, total.tolist(), trees)


def _importances(trees: DataFrame, shape: Shape) -> Iterator[tuple[int, np.ndarray]]:
    def add(table):
        tree = table.column("tree")[0].as_py()
        parts = sorted(zip(table.column("node").to_pylist(), table.column("importance").to_pylist()))
        total = np.sum([np.frombuffer(p) for _, p in parts], axis=0)
        return pa.table({"tree": pa.array([tree], pa.int32()), "importance": pa.array([total.tobytes()], pa.binary())})

    for row in trees.select("tree", "node", "importance").groupBy("tree").applyInArrow(add, "tree int, importance binary").collect():
        yield row["tree"], np.frombuffer(row["importance"])


class _ForestWriter(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        about = {"inputs": list(m.inputs), "shape": m.shape.__dict__, "thresholds": m.thresholds, "trained": m.trained,
                 "importances": m.importances, "tops": {str(t): top.__dict__ for t, top in m.tops.items()}}
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata={"forest": json.dumps(about)})
        m.trees.write.parquet(f"{path}/trees")


class _ForestReader(MLReader):
    def load(self, path: str) -> ForestModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        about = json.loads(meta["forest"])
        model = ForestModel(tuple(about["inputs"]), Shape(**about["shape"]), about["thresholds"],
                            {int(t): Top(**top) for t, top in about["tops"].items()}, about["trained"], about["importances"],
                            self.sparkSession.read.parquet(f"{path}/trees"))
        model._resetUid(meta["uid"])
        return model


class ForestModel(Model, MLWritable, MLReadable):
    """A fitted forest as a pipeline stage: adds ``prediction``, for classes also ``probability``.

    Mean of the trees' leaf values, or the class with the greatest sum of the leaves' class shares. ``transform`` writes
    its input once with row numbers; with folds, a row (column ``fold``) is scored by the trees that did not see its fold.
    """

    def __init__(self, inputs: tuple[str, ...] = (), shape: Shape | None = None, thresholds=(), tops=None, trained: int = 0,
                 importances=(), trees: DataFrame | None = None):
        super().__init__()
        self.inputs, self.shape, self.thresholds, self.tops = inputs, shape, thresholds, tops
        self.trained, self.importances, self.trees = trained, importances, trees

    @property
    def featureImportances(self) -> DenseVector:
        return DenseVector(self.importances)

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader()

    def _transform(self, df: DataFrame) -> DataFrame:
        workers_import_package(df.sparkSession)
        rows = saved(df.withColumn("__row", F.monotonically_increasing_id()), "to-score")
        scored = _scores(rows, self)
        out = rows.join(scored, "__row").drop("__row")
        if not self.shape.classes:
            return out.withColumn("prediction", F.col("__sums")[0]).drop("__sums")
        return out.withColumn("prediction", (F.array_position("__sums", F.array_max("__sums")) - 1).cast("double")) \
                  .withColumnRenamed("__sums", "probability")


def _places(rows: np.ndarray) -> np.ndarray:
    """High and low bytes of numbers under 65,536."""
    return np.array([rows >> 8, rows & 255], np.uint8)


def _scores(rows: DataFrame, model: ForestModel) -> DataFrame:
    """``__row`` and ``__sums``, the mean of the trees' values (for each class).

    A row goes to each of its subtrees. Where whole trees are small enough to be many in a task, it goes to each such set of trees.
    """
    inputs, shape, tops, cuts = model.inputs, model.shape, model.tops, [np.array(t) for t in model.thresholds]
    mask = (1 << BLOCK_BITS) - 1
    width, kind = shape.classes or 1, np.dtype("<f4" if shape.classes else "<f8")
    n = rows.count()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks = max(2 * cores, -(-n // ROWS_PER_FILE))
    sets = -(-(model.trees.agg(F.sum("size")).first()[0] or 1) // TREE_BYTES)
    if 2 * sets > shape.trees:
        sets = 0
        # more rows than were trained on: several tasks for each subtree
        slices = max(1, -(-n // max(model.trained, 1)))
    else:
        slices = max(-(-n // ROWS_TO_SCORE), -(-2 * cores // sets))
    schema = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("slice", pa.int32()), ("block", pa.int64()), ("data", pa.binary())])
    out_schema = pa.schema([("block", pa.int64()), ("tree", pa.int32()), ("node", pa.int32()), ("trees", pa.int32()), ("data", pa.binary())])

    def parts(of, *keys):
        """The rows ``of`` (places in a batch) by their ``keys``."""
        order = np.lexsort(keys)
        new = np.flatnonzero(np.any([np.diff(k[order]) != 0 for k in keys], axis=0)) + 1
        return [of[at] for at in np.split(order, new)] if len(of) else []

    def route(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            bins = _bin([batch.column(c).to_numpy(zero_copy_only=False) for c in inputs], cuts)
            row = batch.column("__row").to_numpy()
            fold = batch.column("fold").to_numpy() if shape.folds else np.zeros(len(row), np.int32)

            def packed(at):
                return _pack(len(at), _places(row[at] & mask), np.ascontiguousarray(bins[at].T), fold[at].astype(np.uint8))

            if sets:
                out = []
                for at in parts(np.arange(len(row)), row >> BLOCK_BITS):
                    b, data = int(row[at[0]]) >> BLOCK_BITS, packed(at)
                    out += [(of, 0, b % slices, b, data) for of in range(sets)]
                yield _batch(schema, list(zip(*out)))
                continue
            for tree in shape.all_trees:
                mine = np.flatnonzero(fold == tree // shape.trees) if shape.folds else np.arange(len(row))
                end = np.zeros(len(row), np.int64)
                end[mine] = tops[tree].route(bins[mine])
                out = []
                for at in parts(mine, end[mine], row[mine] >> BLOCK_BITS):
                    b = int(row[at[0]]) >> BLOCK_BITS
                    out.append((tree, int(end[at[0]]), b % slices, b, packed(at)))
                if out:
                    yield _batch(schema, list(zip(*out)))

    def score(key, left, right):
        out = []
        if left.num_rows and right.num_rows:
            places, bins, folds = [], [], []
            for raw in left.column("data"):
                m, raw = _unpack(raw.as_buffer())
                places.append(np.frombuffer(raw, np.uint8, 2 * m).reshape(2, m))
                bins.append(np.frombuffer(raw, np.uint8, shape.features * m, 2 * m).reshape(-1, m).T)
                folds.append(np.frombuffer(raw, np.uint8, m, (2 + shape.features) * m))
            bins, folds = np.concatenate(bins), np.concatenate(folds)
            if sets:
                total = np.zeros((len(bins), width))
                right = right.sort_by([("tree", "ascending"), ("node", "ascending")])
                last, count = None, set()
                for tree, node, data in zip(right.column("tree").to_pylist(), right.column("node").to_pylist(), right.column("data")):
                    if tree != last:
                        last = tree
                        count.add(tree % shape.trees)
                        mine = np.flatnonzero(folds == tree // shape.trees) if shape.folds else np.arange(len(bins))
                        end = tops[tree].route(bins[mine])
                    at = mine[end == node]
                    if len(at):
                        total[at] += subtree_values(data.as_py(), bins[at], shape.classes)
                values, count = total, len(count)
            else:
                values, count = subtree_values(right.column("data")[0].as_py(), bins, shape.classes).astype(kind), 1
            ends = np.cumsum([p.shape[1] for p in places])[:-1]
            for b, p, v in zip(left.column("block").to_pylist(), places, np.split(values, ends)):
                out.append((b, key[0].as_py(), key[1].as_py(), count, _pack(len(v), p, np.ascontiguousarray(v.T))))
        return pa.Table.from_batches([_batch(out_schema, list(zip(*out)) or [[]] * len(out_schema))])

    def add(table):
        table = table.sort_by([("tree", "ascending"), ("node", "ascending"), ("data", "ascending")])
        block = table.column("block")[0].as_py()
        total, seen = np.zeros((mask + 1, width)), np.zeros(mask + 1)
        for raw, count in zip(table.column("data"), table.column("trees").to_pylist()):
            m, raw = _unpack(raw.as_buffer())
            high, low = np.frombuffer(raw, np.uint8, 2 * m).reshape(2, m)
            at = high.astype(np.int64) << 8 | low
            total[at] += np.frombuffer(raw, float if sets else kind, -1, 2 * m).reshape(width, m).T
            seen[at] += count
        here = np.flatnonzero(seen)
        mean = total[here] / seen[here, None]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(here) + 1) * width, pa.int32()), pa.array(mean.ravel()))
        return pa.table({"__row": pa.array((block << BLOCK_BITS) + here, pa.int64()), "__sums": lists})

    needed = rows.select("__row", *inputs, *(["fold"] if shape.folds else []))
    needed = needed.repartition(tasks, F.shiftright("__row", BLOCK_BITS))
    routed = needed.mapInArrow(route, "tree int, node int, slice int, block long, data binary")
    trees = model.trees.select("tree", "node", "data")
    trees = trees.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    if sets:
        routed = routed.withColumnsRenamed({"tree": "set", "node": "none"})
        trees = trees.withColumns({"set": (F.col("tree") % shape.trees % sets).cast("int"), "none": F.lit(0)})
        keys = ("set", "none", "slice")
    else:
        keys = ("tree", "node", "slice")
    values = routed.groupBy(*keys).cogroup(trees.groupBy(*keys)).applyInArrow(score, "block long, tree int, node int, trees int, data binary")
    return values.groupBy("block").applyInArrow(add, "__row long, __sums array<double>")
