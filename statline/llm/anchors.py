"""Product codes of vectors: integer k-means for each part, sped up by metric trees from the anchors hierarchy.

Vectors become integers and are cut into equal parts. Tasks build, once, one tree for each part of each
chunk of rows, middle-out: about sqrt(n) anchors are spread over the points, each new one at the point
farthest from its anchor, taking from the others the points that are nearer to it (an anchor's points are
kept in order of distance, so only those farther out than half the gap are looked at); anchors with many
points are cut in the same way, and balls are joined from there up, the tightest pair first. A ball holds
its centre, its radius, and the sum and number of its points.

In a round every tree is walked from its root with the list of codebook entries that can own a point of
the ball. A child inherits its parent's list and leaves out each entry that is farther than the nearest
one from all of the ball; once one entry is left the ball is wholly its own, and the cached sum and number
count without a look at the points. Only leaves with several entries left compare points with entries.
Distances that decide are sums of integer squares, so codes are exact and ties go to the lower entry; the
tests that leave entries out allow for rounding. Each task hands over one row for each entry it used, Spark
adds these up, and the driver holds the codebooks alone.
"""

from __future__ import annotations

import hashlib
import io

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import drop_scratch, saved, workers_import_package

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Integer components of a chunk, which bounds what one task holds, and points of a leaf.
CHUNK_CELLS, LEAF = 1 << 19, 128


def largest_component(width: int) -> int:
    """Largest size of an integer component for which no squared distance of ``width`` of them reaches 2^63."""
    return int((2.0 ** 62 / max(width, 1)) ** 0.5) // 2


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of int64 points (rows) and entries (columns)."""
    top = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * points.shape[1] * top * top < 2 ** 53:  # every sum is an integer that a double holds
        p, e = points.astype(np.float64), entries.astype(np.float64)
        return ((p * p).sum(1)[:, None] - 2 * (p @ e.T) + (e * e).sum(1)[None]).astype(np.int64)
    out = np.empty((len(points), len(entries)), np.int64)
    for j, entry in enumerate(entries):
        gap = points - entry
        out[:, j] = (gap * gap).sum(axis=1)
    return out


class Tree:
    """Balls over the rows of ``points``; ball ``b`` holds ``points[order[start[b]:end[b]]]``, the last ball all."""

    FIELDS = ("order", "start", "end", "left", "right", "centre", "radius", "sums")

    def __init__(self, **arrays):
        for name in self.FIELDS:
            setattr(self, name, arrays[name])

    @classmethod
    def grow(cls, points: np.ndarray, leaf: int = LEAF) -> Tree:
        build = _Builder(points, leaf)
        root = build.ball(np.arange(len(points)))
        start, end, order = np.zeros(root + 1, np.int64), np.zeros(root + 1, np.int64), []
        stack, at = [(root, False)], 0
        while stack:
            ball, done = stack.pop()
            if done:
                end[ball] = at
                continue
            start[ball] = at
            stack.append((ball, True))
            if build.left[ball] < 0:
                order.append(build.rows[ball])
                at += len(build.rows[ball])
            else:
                stack += [(build.right[ball], False), (build.left[ball], False)]
        order = np.concatenate(order)
        running = np.zeros((len(points) + 1, points.shape[1]), np.int64)
        np.cumsum(points[order], axis=0, out=running[1:])
        return cls(order=order, start=start, end=end, left=np.array(build.left), right=np.array(build.right),
                   centre=np.array(build.centre), radius=np.array(build.radius), sums=running[end] - running[start])

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{name: getattr(self, name) for name in self.FIELDS})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, held: bytes) -> Tree:
        with np.load(io.BytesIO(held)) as arrays:
            return cls(**{name: arrays[name] for name in cls.FIELDS})


class _Builder:
    def __init__(self, points: np.ndarray, leaf: int):
        self.points, self.leaf = points.astype(np.float64), leaf
        self.left, self.right, self.rows, self.centre, self.radius, self.size = [], [], [], [], [], []

    def _add(self, left, right, rows, centre, radius, size) -> int:
        for held, value in zip((self.left, self.right, self.rows, self.centre, self.radius, self.size),
                               (left, right, rows, centre, radius, size)):
            held.append(value)
        return len(self.left) - 1

    def ball(self, rows: np.ndarray) -> int:
        """A ball over ``rows``: a leaf where they are few or equal, else its anchors' balls joined."""
        here = self.points[rows]
        centre = here.mean(axis=0)
        radius = float(np.sqrt(((here - centre) ** 2).sum(axis=1).max()))
        if len(rows) <= self.leaf or (here == here[0]).all():
            return self._add(-1, -1, rows, centre, radius * (1 + 1e-9), len(rows))
        return self._joined([self.ball(some) for some in self._anchors(rows, int(np.ceil(np.sqrt(len(rows)))))])

    def _anchors(self, rows: np.ndarray, wanted: int) -> list[np.ndarray]:
        """``rows`` dealt to anchors (at most ``wanted``, two at least unless all points are equal)."""
        gap = np.sqrt(((self.points[rows] - self.points[rows[0]]) ** 2).sum(axis=1))
        far = np.argsort(-gap, kind="stable")
        own, away, pivots = [rows[far]], [gap[far]], [self.points[rows[0]]]  # an anchor's points, farthest first
        while len(own) < wanted:
            widest = max(range(len(own)), key=lambda a: away[a][0] if len(away[a]) else -1.0)
            if away[widest][0] <= 0:
                break
            pivot = self.points[own[widest][0]]
            between = np.sqrt(((np.array(pivots) - pivot) ** 2).sum(axis=1))
            taken, taken_away = [], []
            for a in np.flatnonzero(np.array([x[0] if len(x) else -1.0 for x in away]) > between / 2):
                reach = int(np.searchsorted(-away[a], -between[a] / 2))  # nearer points cannot change hands
                now = np.sqrt(((self.points[own[a][:reach]] - pivot) ** 2).sum(axis=1))
                goes = np.concatenate((now < away[a][:reach], np.zeros(len(own[a]) - reach, bool)))
                taken.append(own[a][goes])
                taken_away.append(now[goes[:reach]])
                own[a], away[a] = own[a][~goes], away[a][~goes]
            taken, taken_away = np.concatenate(taken), np.concatenate(taken_away)
            far = np.argsort(-taken_away, kind="stable")
            own.append(taken[far])
            away.append(taken_away[far])
            pivots.append(pivot)
        return [x for x in own if len(x)]

    def _joined(self, balls: list[int]) -> int:
        """One ball over ``balls``, joined two at a time, those whose common ball is smallest first."""
        balls = np.array(balls)
        centre, radius = np.array([self.centre[b] for b in balls]), np.array([self.radius[b] for b in balls])
        size = np.array([self.size[b] for b in balls], np.float64)
        cost = np.sqrt(((centre[:, None] - centre[None]) ** 2).sum(axis=2)) + radius[:, None] + radius[None]
        np.fill_diagonal(cost, np.inf)
        alive = len(balls)
        while alive > 1:
            i, j = sorted(divmod(int(cost.argmin()), len(balls)))
            middle = (centre[i] * size[i] + centre[j] * size[j]) / (size[i] + size[j])
            reach = max(np.sqrt(((centre[x] - middle) ** 2).sum()) + radius[x] for x in (i, j)) * (1 + 1e-9)
            balls[i] = self._add(int(balls[i]), int(balls[j]), None, middle, float(reach), int(size[i] + size[j]))
            centre[i], radius[i], size[i] = middle, reach, size[i] + size[j]
            cost[j], cost[:, j] = np.inf, np.inf
            cost[i] = np.where(np.isinf(cost[i]), np.inf, np.sqrt(((centre - middle) ** 2).sum(axis=1)) + radius + reach)
            cost[i, i] = np.inf
            cost[:, i] = cost[i]
            alive -= 1
        return int(balls[i])


def owners(tree: Tree, points: np.ndarray, entries: np.ndarray):
    """Yield (start, end, ball, entries): who owns the points ``tree.order[start:end]``.

    For a wholly owned ball ``ball`` is its number and ``entries`` one number; for a compared leaf
    ``ball`` is -1 and ``entries`` has one number for each point.
    """
    _, first = np.unique(entries, axis=0, return_index=True)  # of equal entries the lowest owns all
    place = entries.astype(np.float64)
    apart = np.sqrt(((place[:, None] - place[None]) ** 2).sum(axis=2))
    stack = [(len(tree.start) - 1, np.sort(first))]
    while stack:
        ball, listed = stack.pop()
        if len(listed) > 1:
            gap = ((place[listed] - tree.centre[ball]) ** 2).sum(axis=1)
            near = int(gap.argmin())
            # a point of the ball is nearer to ``near`` by at least gap - gap[near] - 2 * radius * apart
            reach = 2 * tree.radius[ball] * apart[listed[near], listed]
            listed = listed[gap - gap[near] <= reach + 1e-9 * (gap + gap[near] + reach + 1)]
        start, end = int(tree.start[ball]), int(tree.end[ball])
        if len(listed) == 1:
            yield start, end, ball, int(listed[0])
        elif tree.left[ball] < 0:
            yield start, end, -1, listed[squared(points[tree.order[start:end]], entries[listed]).argmin(axis=1)]
        else:
            stack += [(int(tree.left[ball]), listed), (int(tree.right[ball]), listed)]


def sums_by_entry(tree: Tree, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, numbers) of the points that each entry owns."""
    sums, number = np.zeros(entries.shape, np.int64), np.zeros(len(entries), np.int64)
    for start, end, ball, own in owners(tree, points, entries):
        if ball >= 0:
            sums[own] += tree.sums[ball]
            number[own] += end - start
        else:
            np.add.at(sums, own, points[tree.order[start:end]])
            number += np.bincount(own, minlength=len(entries))
    return sums, number


def codes_of(tree: Tree, points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The owning entry of every point."""
    out = np.empty(len(points), np.int64)
    for start, end, _, own in owners(tree, points, entries):
        out[tree.order[start:end]] = own
    return out


def integer_vectors(vectors: DataFrame, column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v): components floor(scale * x), without rows that are null or hold null or non-finite ones.

    Rows with a component that :func:`largest_component` rules out for the row's own length take no part
    either, as their distances may not fit a long.
    """
    x = F.transform(F.col(column), lambda c: F.floor(c.cast("double") * scale))
    bound = F.pow(F.lit(2.0), 62) / F.greatest(F.size(column), F.lit(1))
    fits = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c)
                    & (F.abs(c.cast("double")) * scale < F.floor(F.sqrt(bound)) / 2 - 1))
    return vectors.where(F.col(column).isNotNull() & fits).select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", F.transform(x, lambda c: c.cast("long")).alias("v"))


def _padded(lists, width: int) -> np.ndarray:
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(lists).to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width), np.int64)
    ends = np.cumsum(lengths)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(ends - lengths, lengths)] = flat
    return out


def grow_trees(kept: DataFrame, width: int, parts: int = PARTS) -> DataFrame:
    """One row for each chunk of ``kept`` (vec_id, label, v): (ids, labels, points, trees), points in row order."""
    rows = max(1, CHUNK_CELLS // max(width, 1))
    kind = kept.schema["label"].dataType.simpleString()

    def build(batches):
        def chunks():
            held, n = [], 0
            for batch in batches:
                while batch.num_rows:
                    some = batch.slice(0, rows - n)
                    batch = batch.slice(some.num_rows)
                    held.append(some)
                    n += some.num_rows
                    if n == rows:
                        yield pa.Table.from_batches(held)
                        held, n = [], 0
            if n:
                yield pa.Table.from_batches(held)

        def one(array):
            array = array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array
            array = array.chunk(0) if isinstance(array, pa.ChunkedArray) else array
            return pa.ListArray.from_arrays(pa.array([0, len(array)], pa.int32()), array)

        for table in chunks():
            points = _padded(table.column("v").combine_chunks(), width)
            trees = [Tree.grow(p).to_bytes() for p in np.split(points, parts, axis=1)]
            yield pa.RecordBatch.from_arrays(
                [one(table.column("vec_id")), one(table.column("label")), pa.array([points.tobytes()], pa.binary()),
                 pa.array([trees], pa.list_(pa.binary()))], ["ids", "labels", "points", "trees"])

    return kept.mapInArrow(build, f"ids array<long>, labels array<{kind}>, points binary, trees array<binary>")


def _open(batch: pa.RecordBatch, width: int, parts: int):
    """Yield (row, points, trees) of a batch of chunks."""
    for i in range(batch.num_rows):
        points = np.frombuffer(batch.column("points")[i].as_buffer(), np.int64).reshape(-1, width)
        yield i, np.split(points, parts, axis=1), [Tree.from_bytes(t.as_py()) for t in batch.column("trees")[i].values]


def refine(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: ``books`` (part, entry, position) after every entry moved to the floor of its points' mean."""
    spark = trees.sparkSession
    parts, entries, part_width = books.shape
    shared = spark.sparkContext.broadcast(books)

    def add_up(batches):
        books = shared.value
        sums, number = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for _, points, grown in _open(batch, parts * part_width, parts):
                for part in range(parts):
                    s, n = sums_by_entry(grown[part], points[part], books[part])
                    sums[part] += s
                    number[part] += n
        part, entry = np.nonzero(number)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(number[part, entry]),
             pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    added = (trees.mapInArrow(add_up, "part int, entry int, n long, sums array<long>").groupBy("part", "entry")
             .agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i].cast("decimal(38,0)")) for i in range(part_width)]).alias("sums")))
    after = books.copy()
    for row in added.collect():  # one row for each entry of the codebooks
        after[row.part, row.entry] = [int(s) // row.n for s in row.sums]
    shared.unpersist()
    return after


def fit_codebooks(kept: DataFrame, trees: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES,
                  rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, position): the ``entries`` smallest ids' parts, moved ``rounds`` times."""
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    start = np.zeros((len(first), width), np.int64)
    for i, row in enumerate(first):
        start[i, :len(row.v)] = row.v
    books = np.stack(np.split(start, parts, axis=1))
    for _ in range(rounds):
        books = refine(trees, books)
    return books


def digest(books: np.ndarray) -> str:
    """Hex SHA-256 of all entries' components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(trees: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of every row: entry numbers of its parts in hex, and its squared distance to them."""
    shared = trees.sparkSession.sparkContext.broadcast(books)
    parts, entries, part_width = books.shape
    digits = max(2, len(f"{max(entries - 1, 0):x}"))
    label = trees.schema["labels"].dataType.elementType

    def assign(batches):
        books = shared.value
        for batch in batches:
            for i, points, grown in _open(batch, parts * part_width, parts):
                text, error = None, np.zeros(len(points[0]), np.int64)
                for part in range(parts):
                    code = codes_of(grown[part], points[part], books[part])
                    gap = points[part] - books[part][code]
                    error += (gap * gap).sum(axis=1)
                    hexed = np.array([f"{c:0{digits}x}" for c in range(entries)])[code]
                    text = hexed if text is None else np.char.add(text, hexed)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[i].values, batch.column("labels")[i].values, pa.array(text.tolist(), pa.string()),
                     pa.array(error)], ["vec_id", "label", "code", "error"])

    return trees.mapInArrow(assign, f"vec_id long, label {label.simpleString()}, code string, error long")


def compress(vectors: DataFrame, column: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, label, code, error) of every kept row of ``vectors`` (vec_id, label, ``column``), codebooks).

    Rows whose vector is null, holds null or non-finite components, or components whose distances may
    not fit a long (:func:`integer_vectors`) take no part. Vectors of unequal length, empty ones too, count as filled
    with zeros to the longest, rounded up to a multiple of ``parts``. A null vec_id sorts after all others; rows that
    repeat a vec_id all count, in order of their vectors. With fewer rows than ``entries`` there are
    as many entries as rows; an empty table gives an empty one. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    workers_import_package(spark)
    kept = saved(integer_vectors(vectors, column), "integer-vectors")
    longest = kept.agg(F.max(F.size("v"))).first()[0]
    if longest is None:
        return kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), np.zeros((parts, 0, 0), np.int64)
    width = max(1, -(-longest // parts)) * parts
    trees = saved(grow_trees(kept, width, parts), "metric-trees")
    books = fit_codebooks(kept, trees, width, parts, entries, rounds)
    coded = saved(encode(trees, books), "codes")
    drop_scratch(kept, trees)
    return coded, books


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the error summed over rows of the same label; null labels are one."""
    sums = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of_label"))).drop("of_label")
