"""Near copies by MinHash bands, odd sketches and confirmation on full shingle sets.

1. Documents with one shingle set form a class; its smallest doc_id stands for it.
2. ``BANDS`` bands of ``ROWS`` minima each name buckets. At a similarity of 0.8 a pair misses all
   bands with a probability of (1 - 0.8**4)**32 = 5e-8.
3. The ``BANDS * ROWS`` minima of a document, each flipping one bit of a bitmap, are its odd sketch.
   The ones in the XOR of two sketches tell how many minima differ; a pair is dropped if they are
   over six standard deviations too many for the similarity asked for.
4. A second bitmap has the parity of all shingles instead of samples. Each shingle that only one of two
   sets has flips one bit of their XOR, so its ones never exceed the difference, and a pair with more
   ones than the similarity allows is certainly no link.
5. What remains is confirmed on the full sets, and confirmed links form components.

Not all pairs of a bucket are made. First every member meets the bucket's smallest id, then a random
member; links found join most of a group of copies into one component. Only in buckets where several
components are left, members outside the largest one meet the others, in blocks of bounded size whose
bitmaps are compared inside a task. The most similar pairs of a member and a component leave it first;
what is open after their confirmation leaves it whole, which is only what lies next to the threshold.
So all links between different components are looked at, and a group of copies costs about as much
as it has members.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .runtime import drop_scratch, plain_strings, saved, text_slices, workers_import_package
from .words import split_words

BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
SKETCH_BITS, SKETCH_LONGS = 512, 8
DEVIATIONS = 6
#: Members of a bucket that one task compares with as many others, and pairs that leave it first.
BLOCK, FIRST = 2048, 4
#: Text bytes whose words and shingles a task hashes at once.
SLICE = 4 << 20
#: Bits of the parity of all shingles, by the largest set that has them; longer sets get the last.
PARITY_BITS = ((4096, 2048), (32_768, 16_384), (1 << 62, 65_536))

_rng = np.random.default_rng(20_24)
_FLIP = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)
_TIMES = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint32) | np.uint32(1)
_AGAIN = np.uint32(0x85EBCA6B)
_BIT = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint32) | np.uint32(1)
_BAND = _rng.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
_WORD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted 64-bit hashes of each text's distinct ``words``-word shingles, A-Z lower-cased.

    With fewer words the whole sequence is one shingle; without any there is none.
    """
    offsets, codes, distinct = split_words(pc.ascii_lower(texts))
    hashes = pd.util.hash_array(np.array(distinct.to_pylist(), dtype=object), categorize=False) if len(distinct) else np.zeros(0, np.uint64)
    hashes = hashes[codes].astype(np.uint64)
    rolled = np.zeros(len(hashes), np.uint64)
    for k in range(words):
        rolled[:len(hashes) - k] = rolled[:len(hashes) - k] * _WORD + hashes[k:]
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(_mix(rolled[a:b - words + 1])))
        elif b > a:
            whole = np.full(1, b - a, np.uint64)
            for at in range(a, b):
                whole = _mix(whole) + hashes[at]
            out.append(_mix(whole))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minima(shingles: np.ndarray) -> np.ndarray:
    """Minimum of each of ``SAMPLES`` hash functions over a set."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 2048):
        h = (low[None, at:at + 2048] ^ _FLIP[:, None]) * _TIMES[:, None]
        h ^= h >> np.uint32(15)
        h *= _AGAIN
        np.minimum(out, h.min(axis=1), out=out)
    return out


def odd_sketch(low: np.ndarray) -> np.ndarray:
    """Parity bitmap of a document's minima as signed 64-bit numbers."""
    bit = (low ^ (low >> np.uint32(13))) * _BIT >> np.uint32(32 - SKETCH_BITS.bit_length() + 1)
    odd = (np.bincount(bit, minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view("<i8")


def parity(shingles: np.ndarray) -> np.ndarray:
    """Parity bitmap of a whole set as signed 64-bit numbers."""
    bits = next(b for most, b in PARITY_BITS if len(shingles) <= most)
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def most_ones(similarity: float) -> int:
    """Ones in the XOR of two sketches that a pair of this similarity exceeds about once in a thousand million."""
    differ = SAMPLES * (1 - similarity) + DEVIATIONS * math.sqrt(SAMPLES * similarity * (1 - similarity))
    flips = min(2 * differ, 2 * SAMPLES)
    mean = SKETCH_BITS / 2 * (1 - math.exp(-2 * flips / SKETCH_BITS))
    return math.ceil(mean + math.sqrt(SKETCH_BITS) / 2)


_FEATURES = "doc_id long, text_hash long, n int, key binary, bands array<long>, sketch array<long>, parity array<long>"


def features(docs: DataFrame, words: int) -> DataFrame:
    """Set size, digest of the set, band hashes and odd sketch of every row."""

    def compute(batches):
        for part in text_slices(batches, most=SLICE):
            n, keys, bands, sketches, parities = [], [], [], [], []
            for shingles in shingle_sets(plain_strings(part.column("text")), words):
                n.append(len(shingles))
                keys.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                low = minima(shingles)
                band = _mix((low.reshape(BANDS, ROWS).astype(np.uint64) * _BAND).sum(axis=1, dtype=np.uint64))
                bands.append(_mix(band + np.arange(1, BANDS + 1, dtype=np.uint64) * _WORD).view(np.int64))
                sketches.append(odd_sketch(low))
                parities.append(parity(shingles))
            ends = np.concatenate(([0], np.cumsum([len(p) for p in parities]))).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * width), pa.array(np.concatenate(rows)))
                     for width, rows in ((BANDS, bands), (SKETCH_LONGS, sketches))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_hash"), pa.array(n, pa.int32()),
                                              pa.array(keys, pa.binary()), *lists,
                                              pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parities)))],
                                             ["doc_id", "text_hash", "n", "key", "bands", "sketch", "parity"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text") \
               .mapInArrow(compute, _FEATURES)


def _ones(a: Column, b: Column) -> Column:
    total = F.bit_count(a[0].bitwiseXOR(b[0]))
    for k in range(1, SKETCH_LONGS):
        total = total + F.bit_count(a[k].bitwiseXOR(b[k]))
    return total


def _pairs(a: str, b: str) -> tuple[Column, Column]:
    return F.least(a, b).alias("u"), F.greatest(a, b).alias("v")


def _plausible(pairs: DataFrame, light: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes, odd sketches and parities allow the similarity."""
    a = light.select(F.col("doc_id").alias("u"), F.col("n").alias("n_u"), F.col("sketch").alias("s_u"), F.col("parity").alias("p_u"))
    b = light.select(F.col("doc_id").alias("v"), F.col("n").alias("n_v"), F.col("sketch").alias("s_v"), F.col("parity").alias("p_v"))
    differ = F.aggregate(F.zip_with("p_u", "p_v", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    fits = (F.least("n_u", "n_v") * 100 >= F.greatest("n_u", "n_v") * percent) & \
           (_ones(F.col("s_u"), F.col("s_v")) <= most_ones(percent / 100)) & \
           ((F.size("p_u") != F.size("p_v")) | (differ * (100 + percent) <= (F.col("n_u") + F.col("n_v")) * (100 - percent)))
    return pairs.join(a, "u").join(b, "v").where(fits).select("u", "v")


def _confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs that reach the similarity on their full sets, made again from the texts of these documents alone."""
    ids = pairs.select(F.explode(F.array("u", "v")).alias("id")).distinct()

    def sets(batches):
        for part in text_slices(batches, most=SLICE):
            made = [s.view(np.int64) for s in shingle_sets(plain_strings(part.column("text")), words)]
            ends = np.concatenate(([0], np.cumsum([len(s) for s in made]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(made)))], ["id", "shingles"])

    full = saved(docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(ids, "id", "left_semi")
                 .mapInArrow(sets, "id long, shingles array<long>"), "shingle-sets")
    both = (pairs.join(full.withColumnsRenamed({"id": "u", "shingles": "a"}), "u")
            .join(full.withColumnsRenamed({"id": "v", "shingles": "b"}), "v"))
    shared = F.size(F.array_intersect("a", "b"))
    alike = shared * 100 >= (F.size("a") + F.size("b") - shared) * percent
    out = saved(both.where(alike).select("u", "v").distinct(), "confirmed")
    drop_scratch(full)
    return out


def _groups(batches, keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that are sorted by ``keys``; a group is as large as it is, no more is held."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        marks = np.stack([table.column(k).to_numpy() for k in keys])
        cut = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
        if len(cut):
            yield table.slice(0, int(cut[-1]))
            held = table.slice(int(cut[-1])).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _differences(parities: pa.ListArray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Ones in the XOR of the parities of rows ``i`` and ``j``, 0 where they have unequal lengths."""
    flat, offsets = parities.flatten().to_numpy().view(np.uint64), parities.offsets.to_numpy().astype(np.int64)
    starts, longs = offsets[:-1] - offsets[0], np.diff(offsets)
    out = np.zeros(len(i), np.int64)
    for width in np.unique(longs).tolist():
        at = np.flatnonzero((longs[i] == width) & (longs[j] == width))
        step = max(1, (1 << 20) // max(width, 1))
        for k in range(0, len(at), step):
            some, columns = at[k:k + step], np.arange(width)
            out[some] = np.bitwise_count(flat[starts[i[some]][:, None] + columns] ^ flat[starts[j[some]][:, None] + columns]).sum(axis=1)
    return out


def _block_pairs(limit: int, percent: int, first: bool):
    def compare(batches):
        keys = ["bucket", "a", "b"]
        for table in _groups(batches, keys):
            table = table.combine_chunks()
            marks = np.stack([table.column(k).to_numpy() for k in keys])
            starts = np.concatenate(([0], np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1, [table.num_rows]))
            doc, comp, n, minor = (table.column(c).to_numpy() for c in ("doc_id", "comp", "n", "minor"))
            n = n.astype(np.int64)
            sketch = table.column("sketch").chunk(0).flatten().to_numpy().view(np.uint64).reshape(-1, SKETCH_LONGS)
            parities = table.column("parity").chunk(0)
            us, vs = [], []
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
                few, all_ = np.flatnonzero(minor[s:e] == 1) + s, np.flatnonzero(minor[s:e] == 0) + s
                for at in range(0, len(few), 256):
                    some = few[at:at + 256]
                    ones = np.zeros((len(some), len(all_)), np.int32)
                    for k in range(SKETCH_LONGS):
                        ones += np.bitwise_count(sketch[some, k][:, None] ^ sketch[all_, k][None, :])
                    small, large = np.minimum(n[some][:, None], n[all_]), np.maximum(n[some][:, None], n[all_])
                    i, j = np.nonzero((ones <= limit) & (comp[some][:, None] != comp[all_]) & (small * 100 >= large * percent))
                    i, j = some[i], all_[j]
                    differ = _differences(parities, i, j)
                    fits = differ * (100 + percent) <= (n[i] + n[j]) * (100 - percent)
                    i, j, differ = i[fits], j[fits], differ[fits]
                    if first and len(i):  # the most similar of each member and component
                        order = np.lexsort((differ, comp[j], i))
                        i, j = i[order], j[order]
                        new = np.concatenate(([True], (i[1:] != i[:-1]) | (comp[j[1:]] != comp[j[:-1]])))
                        place = np.arange(len(i)) - np.maximum.accumulate(np.where(new, np.arange(len(i)), 0))
                        i, j = i[place < FIRST], j[place < FIRST]
                    us.append(doc[i])
                    vs.append(doc[j])
            if us:
                u, v = np.concatenate(us), np.concatenate(vs)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], ["u", "v"])

    return compare


def _open_members(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members, with their component, of buckets of three and more that hold several components."""
    known = members.join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left") \
                   .withColumn("comp", F.coalesce("root", "doc_id")).drop("root")
    mixed = known.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("bucket")
    return known.join(mixed, "bucket")


def near_copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text).

    Rows are linked if 100 * shared >= ``percent`` * all of their shingles; ``component_id`` is the
    smallest doc_id that links reach. Null, empty and blank texts have no shingle and stay alone.
    Repeated rows share their class and are kept or not together. Rows without doc_id take no part:
    component null, kept. Rows that repeat an id with another text each follow their own text.
    """
    workers_import_package(docs.sparkSession)
    rows = saved(features(docs, words), "neardup-features")
    linked = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    classes = saved(rows.where(linked).groupBy("key").agg(F.min("doc_id").alias("rep")), "neardup-classes")
    reps = saved(rows.where(linked).join(classes, "key").where("doc_id = rep").select("doc_id", "n", "bands", "sketch", "parity"), "neardup-reps")
    light = reps.select("doc_id", "n", "sketch", "parity")
    entries = reps.select("doc_id", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count("*").alias("c"), F.min("doc_id").alias("pivot")).where("c > 1")
    members = saved(entries.join(shared, "bucket"), "neardup-members")

    def confirm(pairs: DataFrame) -> DataFrame:
        return _confirmed(pairs, docs, words, percent)

    tested = saved(_plausible(members.where("doc_id != pivot").select(*_pairs("doc_id", "pivot")).distinct(), light, percent), "neardup-pairs")
    links = confirm(tested)
    roots = saved(components(links), "neardup-roots")
    members = members.where("c > 2").select("bucket", "doc_id")
    # once more with a random member, which many that miss the smallest id will meet
    known = saved(_open_members(members, roots), "neardup-open")
    if known.limit(1).count():
        pivots = known.groupBy("bucket").agg(F.min_by("doc_id", F.xxhash64("bucket", "doc_id")).alias("pivot"),
                                             F.min_by("comp", F.xxhash64("bucket", "doc_id")).alias("pivot_comp"))
        pairs = known.join(pivots, "bucket").where("comp != pivot_comp").select(*_pairs("doc_id", "pivot")).distinct()
        pairs = saved(_plausible(pairs.join(tested, ["u", "v"], "left_anti"), light, percent), "neardup-pairs")
        tested = tested.unionByName(pairs)
        links = links.unionByName(confirm(pairs))
        roots = saved(components(links), "neardup-roots")
        for first in (True, False):
            known = saved(_open_members(known.select("bucket", "doc_id"), roots), "neardup-open")
            if not known.limit(1).count():
                break
            pairs = saved(_rest(known, light, percent, first).join(tested, ["u", "v"], "left_anti"), "neardup-pairs")
            tested = tested.unionByName(pairs)
            links = links.unionByName(confirm(pairs))
            roots = saved(components(links), "neardup-roots")
    by_class = classes.join(roots, classes.rep == roots.node, "left").select("key", F.coalesce("root", "rep").alias("root"))
    return (rows.join(by_class, "key", "left")
            .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("root")).otherwise(F.col("doc_id"))))
            .select("doc_id", "text_hash", F.col("n").cast("long").alias("n_shingles"), "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))


def _rest(known: DataFrame, light: DataFrame, percent: int, first: bool) -> DataFrame:
    """Plausible pairs over components of open buckets: members outside the largest component against all."""
    sizes = known.groupBy("bucket", "comp").agg(F.count("*").alias("m"))
    per = sizes.groupBy("bucket").agg(F.sum("m").alias("c"), F.max("m").alias("most"), F.max_by("comp", F.struct("m", "comp")).alias("main"))
    per = per.select("bucket", "main", F.ceil(F.col("c") / BLOCK).cast("int").alias("na"),
                     F.ceil((F.col("c") - F.col("most")) / BLOCK).cast("int").alias("nb"))
    full = known.join(per, "bucket").join(light, "doc_id")
    upto = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    columns = ["bucket", "a", "b", "doc_id", "comp", "n", "sketch", "parity"]
    own = lambda n: F.pmod(F.xxhash64("doc_id"), n).cast("int")
    all_ = full.withColumn("a", own(F.col("na"))).withColumn("b", upto(F.col("nb"))).select(*columns, F.lit(0).alias("minor"))
    few = full.where("comp != main").withColumn("b", own(F.col("nb"))).withColumn("a", upto(F.col("na"))) \
              .select(*columns, F.lit(1).alias("minor"))
    return (all_.unionByName(few).repartition("bucket", "a", "b").sortWithinPartitions("bucket", "a", "b")
            .mapInArrow(_block_pairs(most_ones(percent / 100), percent, first), "u long, v long").distinct())


def without_copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near copies; rows without words or id stay."""
    found = saved(near_copies(docs, words, percent), "neardup-result")
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("gone_id"), "text_hash").distinct()
    again = (found.where("kept and doc_id is not null and n_shingles > 0").groupBy(F.col("doc_id").alias("gone_id"), "text_hash")
             .count().where("count > 1").drop("count"))
    own = lambda other: (docs["doc_id"] == other["gone_id"]) & (F.xxhash64(docs["text"]) == other["text_hash"])
    once = docs.join(gone.unionByName(again), own(gone), "left_anti")
    if not again.limit(1).count():
        return once
    return once.unionByName(docs.join(again, own(again), "left_semi").dropDuplicates(["doc_id", "text"]))
