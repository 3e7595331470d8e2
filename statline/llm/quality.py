"""Text quality by a vote of the nearest labelled documents in a latent-semantic space.

A document's features are its words (letters and digits without marks, lower case; pairs of characters
where a script has no spaces), hashed into ``TERMS`` buckets, how often each word shape occurs (letters
and digits folded, marks kept) and how often a word repeats the one before. Spark takes the document
frequencies of the features over the whole table. Logarithmic counts times inverse document frequency,
with words and marks weighing the same on average, go through a truncated singular value decomposition
of the sparse matrix of labelled rows. Labelled vectors, at most ``LABELLED`` of them, are broadcast;
each document's cosines with all of them come from one matrix product for a block of documents, and its
``NEIGHBOURS`` nearest vote with a power of their similarity.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import drop_scratch, plain_strings, saved, text_slices, workers_import_package
from .words import split_words

#: Bound on labelled documents (those with the smallest hashes teach), latent size, voters.
LABELLED, LATENT, NEIGHBOURS, SHARPNESS = 4096, 48, 15, 12
SHAPES = 511  # one more feature counts repeated words, then come the words
MARKS = SHAPES + 1
TERMS = 1 << 16
FEATURES = MARKS + TERMS
LOW = 0.3
BLOCK = 256
#: Text bytes whose terms are counted at once.
SLICE = 4 << 20
#: The decomposition ends when a round adds less than this share of what its axes hold.
SETTLED, MOST_ROUNDS, SPARE = 1e-4, 60, 16
#: Bytes of features for one task of the fit, labelled rows and features that a task takes at once.
TASK_BYTES, ROWS_AT_ONCE, AXES_AT_ONCE = 64 << 20, 128, 4096
#: Scripts without spaces between words.
_UNSPACED = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]"


def _shape_of(words: pa.Array) -> pa.Array:
    for pattern, letter in ((r"\p{Lu}+", "A"), (r"\p{L}[\p{L}\p{M}]*", "a"), (r"\p{N}+", "9")):
        # capitals become a mark first, or the next pattern would take them for letters
        words = pc.replace_substring_regex(words, pattern, {"A": "\x01", "a": "\x02", "9": "\x03"}[letter])
    return words


def _spread(starts: np.ndarray, picked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and positions of the picked groups; group ``g`` is ``starts[g]:starts[g + 1]``."""
    lengths = np.diff(starts)[picked]
    ends = np.cumsum(lengths)
    return lengths, np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[picked] - (ends - lengths), lengths)


def _terms_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(starts, buckets): word ``i`` has the terms ``buckets[starts[i]:starts[i + 1]]``, marks alone have none."""
    starts, codes, terms = split_words(pc.replace_substring_regex(pc.utf8_lower(words), r"[^\p{L}\p{M}\p{N}]+", " "))
    unspaced = pc.match_substring_regex(terms, _UNSPACED).to_numpy(zero_copy_only=False)
    sizes = np.ones(len(terms), np.int64)
    pairs = terms.filter(pa.array(unspaced, pa.bool_()))
    chars = pc.utf8_length(pairs).to_numpy(zero_copy_only=False).astype(np.int64)
    sizes[unspaced] = np.maximum(chars - 1, 1)
    at = np.concatenate(([0], np.cumsum(sizes)))
    buckets = np.empty(at[-1], np.int64)
    buckets[at[:-1][~unspaced]] = [zlib.crc32(t.encode()) % TERMS for t in terms.filter(pa.array(~unspaced, pa.bool_())).to_pylist()]
    if len(pairs):
        code = np.frombuffer("".join(pairs.to_pylist()).encode("utf-32-le"), "<u4").astype(np.uint64)
        last = np.cumsum(chars) - 1
        after = np.append(code[1:], np.uint64(0))
        after[last] = 0
        keep = np.ones(len(code), bool)
        keep[last[chars > 1]] = False
        pair = (code[keep] * np.uint64(1 << 21) + after[keep]) * np.uint64(0x9E3779B97F4A7C15)
        buckets[_spread(at, np.flatnonzero(unspaced))[1]] = (pair >> np.uint64(40)).astype(np.int64) % TERMS
    lengths, where = _spread(at, codes)
    return np.concatenate(([0], np.cumsum(lengths)))[starts], buckets[where]


def sparse_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, features, counts): features of text ``i``, ascending, and their counts stand at ``starts[i]:starts[i + 1]``."""
    offsets, codes, words = split_words(texts)
    if not len(codes):
        return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
    shapes = _shape_of(words).dictionary_encode()
    bucket = np.array([zlib.crc32(s.encode()) % SHAPES for s in shapes.dictionary.to_pylist()])
    feature = bucket[shapes.indices.to_numpy(zero_copy_only=False)][codes]
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))
    again = np.zeros(len(codes), bool)
    again[1:] = (codes[1:] == codes[:-1]) & (row[1:] == row[:-1])
    starts, terms = _terms_of(words)
    lengths, where = _spread(starts, codes)
    key, n = np.unique(np.concatenate((row * FEATURES + feature, row[again] * FEATURES + SHAPES,
                                       np.repeat(row, lengths) * FEATURES + MARKS + terms[where])), return_counts=True)
    return np.searchsorted(key, np.arange(len(texts) + 1) * FEATURES), key % FEATURES, n.astype(np.float32)


def counts(texts: pa.Array) -> np.ndarray:
    """Feature counts, one row for each text; texts without words have zeros."""
    starts, features, n = sparse_counts(texts)
    out = np.zeros((len(texts), FEATURES), np.float32)
    out[np.repeat(np.arange(len(texts)), np.diff(starts)), features] = n
    return out


def _times(starts: np.ndarray, columns: np.ndarray, values: np.ndarray, dense: np.ndarray) -> np.ndarray:
    """Product of a sparse matrix by rows and a dense one, some rows at a time."""
    out = np.zeros((len(starts) - 1, dense.shape[1]), dense.dtype)
    at = 0
    while at < len(out):
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + (1 << 17), side="right")) - 1)
        a, b = starts[at], starts[to]
        full = np.flatnonzero(starts[at:to] < starts[at + 1:to + 1])
        if len(full):
            out[at + full] = np.add.reduceat(dense[columns[a:b]] * values[a:b, None], starts[at + full] - a, axis=0)
        at = to
    return out


def _weighted(starts: np.ndarray, features: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Values of unit rows: logarithmic counts times inverse document frequency."""
    values = np.log1p(n) * idf[features]
    squares = np.concatenate(([0.0], np.cumsum(values.astype(np.float64) ** 2)))[starts]
    norm = np.sqrt(np.maximum(np.diff(squares), 0))
    return values / np.repeat(np.maximum(norm, 1e-9), np.diff(starts)).astype(values.dtype)


def _orthonormal(block: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the block's columns by their small Gram matrix, columns of no size left out."""
    gram = sum(part.T @ part for part in (block[at:at + 8192].astype(np.float64) for at in range(0, len(block), 8192)))
    size, turn = np.linalg.eigh(gram)
    kept = size > 1e-10 * max(size[-1], 1e-300)
    return block @ (turn[:, kept] / np.sqrt(size[kept])).astype(np.float32)


class _Taught:
    """Labelled rows as a table (doc_id, quality, features, counts) that tasks multiply, each about ``TASK_BYTES`` of it."""

    def __init__(self, table: DataFrame, used: np.ndarray):
        self.used = used
        self.size = table.agg(F.sum(F.octet_length("features") * 2)).first()[0] or 0
        self.table = table.coalesce(max(1, -(-self.size // TASK_BYTES)))

    def main_axes(self, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(main axes, places of the rows on them, mean labels), rows in order of doc_id.

        Rows of one task's size are multiplied, round after round, where they are, and the driver gets the
        result; of more rows each round adds up the products of all tasks.
        """
        if self.size > TASK_BYTES:
            axes = _main_axes(lambda a: self.product(idf, a), len(self.used))
            return axes, *self.places(idf, axes)
        weighted, shared = self._weighted_rows(idf)
        n_used = len(self.used)

        def fit(batches):
            rows, ids, labels = _Slices(), [], []
            for starts, column, values, some in weighted(batches):
                rows.add(starts, column, values)
                ids += some.column("doc_id").to_pylist()
                labels += some.column("quality").to_pylist()
            axes = _main_axes(rows.product, n_used)
            order = np.argsort(np.array(ids), kind="stable")
            for kind, array in enumerate((axes, rows.places(axes)[order], np.array(labels, np.float32)[order])):
                for at in range(0, len(array), AXES_AT_ONCE):
                    yield pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([at], pa.int32()),
                                                      pa.array([array[at:at + AXES_AT_ONCE].tobytes()], pa.binary())], ["kind", "at", "block"])

        got = sorted(self.table.mapInArrow(fit, "kind int, at int, block binary").collect(), key=lambda r: (r["kind"], r["at"]))
        shared.destroy()
        axes, place, marks = (np.frombuffer(b"".join(r["block"] for r in got if r["kind"] == kind), np.float32) for kind in range(3))
        return axes.reshape(n_used, -1), place.reshape(len(marks), -1).astype(np.float64), marks.astype(np.float64)

    def _weighted_rows(self, idf: np.ndarray):
        """(generator function, its broadcast): slices (starts, columns among the used features, values, batch) of weighted rows."""
        place = np.full(FEATURES, -1, np.int32)
        place[self.used] = np.arange(len(self.used), dtype=np.int32)
        shared = self.table.sparkSession.sparkContext.broadcast((place, idf.astype(np.float32)))

        def run(batches):
            place, idf = shared.value
            for batch in batches:
                at = 0
                while at < batch.num_rows:
                    some = batch.slice(at, ROWS_AT_ONCE)
                    at += some.num_rows
                    found = np.frombuffer(b"".join(some.column("features").to_pylist()), "<i4")
                    n = np.frombuffer(b"".join(some.column("counts").to_pylist()), "<f4")
                    sizes = pc.binary_length(some.column("features")).to_numpy(zero_copy_only=False) // 4
                    starts = np.concatenate(([0], np.cumsum(sizes.astype(np.int64))))
                    yield starts, place[found], _weighted(starts, found, n, idf), some

        return run, shared

    def product(self, idf: np.ndarray, axes: np.ndarray) -> np.ndarray:
        """A'(A axes) for the weighted rows A, added up on the executors."""
        width = axes.shape[1]
        asked = self.table.sparkSession.sparkContext.broadcast(axes)

        weighted, shared = self._weighted_rows(idf)

        def add_up(batches):
            out = np.zeros(asked.value.shape, np.float32)
            for starts, column, values, _ in weighted(batches):
                some = _Slices()
                some.add(starts, column, values)
                out += some.product(asked.value)
            for at in range(0, len(out), AXES_AT_ONCE):
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([out[at:at + AXES_AT_ONCE].tobytes()], pa.binary())],
                                                 ["at", "block"])

        def added(table: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(x.as_buffer(), np.float32) for x in table.column("block"))
            return pa.table({"at": table.column("at").slice(0, 1), "block": pa.array([total.tobytes()], pa.binary())})

        frame = self.table.mapInArrow(add_up, "at int, block binary").groupBy("at").applyInArrow(added, "at int, block binary")
        out = np.zeros(axes.shape, np.float32)
        for row in frame.toLocalIterator():
            block = np.frombuffer(row.block, np.float32).reshape(-1, width)
            out[row.at:row.at + len(block)] = block
        asked.destroy()
        shared.destroy()
        return out

    def places(self, idf: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(A axes, mean labels) of the rows in order of doc_id: ``LABELLED`` rows of ``LATENT`` numbers at most."""
        asked = self.table.sparkSession.sparkContext.broadcast(axes)

        weighted, shared = self._weighted_rows(idf)

        def place(batches):
            for starts, column, values, some in weighted(batches):
                left = _times(starts, column, values, asked.value)
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), some.column("quality"), pa.array([r.tobytes() for r in left], pa.binary())],
                                                 ["doc_id", "quality", "place"])

        got = sorted(self.table.mapInArrow(place, "doc_id long, quality double, place binary").collect(), key=lambda r: r.doc_id)
        asked.destroy()
        shared.destroy()
        place = np.frombuffer(b"".join(r.place for r in got), np.float32).reshape(len(got), axes.shape[1])
        return place.astype(np.float64), np.array([r.quality for r in got])

    def block_sizes(self, idf: np.ndarray) -> tuple[float, float]:
        """Mean length of the rows' marks and of their words."""
        def size(batches):
            for batch in batches:
                lengths = [[], []]
                for f, n in zip(batch.column("features").to_pylist(), batch.column("counts").to_pylist()):
                    found = np.frombuffer(f, "<i4")
                    square = (np.log1p(np.frombuffer(n, "<f4")) * idf[found]) ** 2
                    lengths[0].append(float(np.sqrt(square[found < MARKS].sum())))
                    lengths[1].append(float(np.sqrt(square[found >= MARKS].sum())))
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()) for x in lengths], ["marks", "words"])

        return tuple(self.table.mapInArrow(size, "marks double, words double").agg(F.avg("marks"), F.avg("words")).first())


def _main_axes(product, n_used: int) -> np.ndarray:
    """The ``LATENT`` main right singular vectors of the weighted rows, by subspace iteration until they settle.

    ``product(axes)`` is A'(A axes). After ``MOST_ROUNDS`` the axes are taken as they are: still orthonormal, only
    less settled.
    """
    width = min(LATENT + SPARE, n_used)
    axes = _orthonormal(np.random.default_rng(0).standard_normal((n_used, width)).astype(np.float32))
    held = 0.0
    for _ in range(MOST_ROUNDS):
        after = product(axes)
        inner = axes.T.astype(np.float64) @ after.astype(np.float64)
        size, turn = np.linalg.eigh((inner + inner.T) / 2)
        before, held = held, float(size[::-1][:LATENT].sum())
        if held - before <= SETTLED * held:
            break
        axes = _orthonormal(after @ turn[:, ::-1].astype(np.float32))
    return axes @ turn[:, ::-1][:, :LATENT].astype(np.float32)


class _Slices:
    """Weighted rows as dense slices over the columns that each slice has."""

    def __init__(self):
        self.slices = []

    def add(self, starts: np.ndarray, column: np.ndarray, values: np.ndarray) -> None:
        here, at = np.unique(column, return_inverse=True)
        self.slices.append((starts, here, at.astype(np.int32), values))

    def _dense(self):
        for starts, here, at, values in self.slices:
            dense = np.zeros((len(starts) - 1, len(here)), np.float32)
            dense[np.repeat(np.arange(len(dense)), np.diff(starts)), at] = values
            yield here, dense

    def product(self, axes: np.ndarray) -> np.ndarray:
        out = np.zeros(axes.shape, np.float32)
        for here, dense in self._dense():  # few rows have few of all features
            out[here] += dense.T @ (dense @ axes[here])
        return out

    def places(self, axes: np.ndarray) -> np.ndarray:
        return np.concatenate([dense @ axes[here] for here, dense in self._dense()])


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


@dataclass
class QualityModel:
    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    spark: object = None

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, bound: int = LABELLED, marks: bool = True) -> QualityModel:
        """Learn from labelled rows whose crc32(doc_id) mod 5 is not 0; rows without label, id or text teach nothing.

        A document with several labels has their mean. Of repeated ids in ``docs`` the smallest text counts.
        Document frequencies come from all such rows of ``docs``, labelled or not. Without ``marks`` only
        the words count.
        """
        spark = docs.sparkSession
        workers_import_package(spark)
        taught = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
        chosen = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & taught)
                  .groupBy("doc_id").agg(F.avg("quality").alias("quality"))
                  .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound))  # the documented bound of the fit
        rows = (docs.select("doc_id", "text").where(F.col("text").isNotNull())
                .join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("quality").alias("quality")))

        def features(batches):
            for part in text_slices(batches, most=SLICE):
                starts, found, n = sparse_counts(plain_strings(part.column("text")))
                cut = [found.astype("<i4"), n.astype("<f4")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("quality"),
                     *(pa.array([c[a:b].tobytes() for a, b in zip(starts, starts[1:])], pa.binary()) for c in cut)],
                    ["doc_id", "quality", "features", "counts"])

        def frequencies(batches):
            seen, rows_seen = np.zeros(FEATURES, np.int64), 0
            for part in text_slices(batches, most=SLICE):
                seen += np.bincount(sparse_counts(plain_strings(part.column("text")))[1], minlength=FEATURES)
                rows_seen += part.num_rows
            at = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(seen[at], rows_seen))],
                                             ["feature", "n"])

        table = saved(rows.mapInArrow(features, "doc_id long, quality double, features binary, counts binary"), "taught")

        def used_features(batches):
            seen = np.zeros(FEATURES, bool)
            for batch in batches:
                for f in batch.column("features").to_pylist():
                    seen[np.frombuffer(f, "<i4")] = True
            yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(seen), pa.int32())], ["feature"])

        seen_in = table.mapInArrow(used_features, "feature int").distinct().toArrow().column("feature")
        used = np.sort(seen_in.to_numpy()).astype(np.int64)
        if not len(used):  # no labelled row, or none with a word
            marks_of = np.array([r.quality for r in table.select("quality").collect()])
            return cls(np.zeros(FEATURES), np.zeros((FEATURES, 1), np.float32), np.zeros((len(marks_of), 1)), marks_of, spark)
        seen = (docs.where(F.col("text").isNotNull() & taught).select("text").mapInArrow(frequencies, "feature int, n long")
                .groupBy("feature").agg(F.sum("n").alias("n")).toArrow())
        often = np.zeros(FEATURES + 1)
        often[seen.column("feature").to_numpy()] = seen.column("n").to_numpy()  # the last one, -1, counts documents
        idf = np.log((1 + often[-1]) / (1 + often[:-1])) + 0.1
        taught_rows = _Taught(table, used)
        for block, size in zip((slice(0, MARKS), slice(MARKS, None)), taught_rows.block_sizes(idf)):
            idf[block] /= max(size, 1e-9)
        if not marks:
            idf[:MARKS] = 0
        axes, place, quality = taught_rows.main_axes(idf)
        basis = np.zeros((FEATURES, axes.shape[1]), np.float32)
        basis[used] = axes
        drop_scratch(table)
        return cls(idf, basis, _unit(place), quality, spark)

    def votes(self, texts: pa.Array) -> np.ndarray:
        """Score of each text: similarity-weighted mean label of its nearest; without any, the mean label or 0.5."""
        if not len(self.labels):
            return np.full(len(texts), 0.5)
        base, vectors = float(self.labels.mean()), self.vectors.astype(np.float32).T.copy()
        starts, features, n = sparse_counts(texts)
        place = _times(starts, features, _weighted(starts, features, n, self.idf.astype(np.float32)), self.basis)
        out = np.empty(len(texts))
        k = min(NEIGHBOURS, len(self.labels))
        for at in range(0, len(texts), BLOCK):
            cosine = _unit(place[at:at + BLOCK]) @ vectors
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** SHARPNESS
            total = weight.sum(axis=1)
            score = (weight * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-12)
            out[at:at + BLOCK] = np.where(total > 1e-9, score, base)
        return np.clip(out, 0.0, 1.0)

    def score(self, text: Column) -> Column:
        """Score (0 to 1, higher: better) of a text column; null is scored as empty."""
        shared = self.spark.sparkContext.broadcast((self.idf, self.basis, self.vectors, self.labels))

        def vote(texts: pa.Array) -> pa.Array:
            model = QualityModel(*shared.value)
            parts = [model.votes(plain_strings(p.column(0)))
                     for p in text_slices([pa.RecordBatch.from_arrays([texts], ["text"])], most=SLICE)]
            return pa.array(np.concatenate(parts) if parts else np.zeros(0))

        return F.arrow_udf(vote, "double")(text)


def classify(docs: DataFrame, model: QualityModel, low: float = LOW) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``; a null doc_id is not held out."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"),
                        model.score(F.col("text")).alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= low, 1).otherwise(0)))
