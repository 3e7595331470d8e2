"""Ranked search term by term with limited accumulators, over shards of an inverted index.

Documents are tokenised once. A task turns each chunk of them into a shard: for every term that an item
asks for, the documents of the chunk that hold it and how often. Document frequencies and lengths are added
up over all shards, so scores are the same wherever a document lies. An item goes through a shard term by
term, the term with the fewest documents first. A document that holds a term gets an accumulator as
long as what the remaining terms can add at most (their highest scores in the shard) reaches the k-th best
partial score; from then on a document without an accumulator cannot be among the best, so no more are made,
and the postings of the remaining, frequent terms are only looked up for the survivors, whose scores
stay exact; survivors that cannot reach the k-th partial score any more are left out as well. A task carries
its best scores from shard to shard, so later shards start with a threshold. Tasks' best are merged by a
ranked window.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runtime import drop_scratch, plain_strings, saved, text_slices, workers_import_package
from .words import split_words

BEST = 50
#: Documents and postings of a shard, which bound what a task holds at once.
SHARD_DOCUMENTS, SHARD_POSTINGS = 8192, 1 << 20
#: Pairs of item and term that are broadcast at once; more items go in blocks, each a pass over the documents.
BLOCK_TERMS = 1 << 20

#: A-Z in lower case; digits, letters and all bytes outside ASCII as they are; everything else parts terms.
_BYTES = np.full(256, 0x20, np.uint8)
for _low, _high in ((0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)):
    _BYTES[_low:_high] = np.arange(_low, _high)
_BYTES[0x41:0x5B] = np.arange(0x61, 0x7B)


def split_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(offsets, codes, dictionary) of the terms, runs of ASCII letters and digits and of characters outside ASCII."""
    texts = pa.concat_arrays([texts])  # without an offset
    _, ends, data = texts.buffers()
    if data is None or not data.size:
        return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.int32), pa.array([], pa.string())
    mapped = _BYTES[np.frombuffer(data, np.uint8)]
    return split_words(pa.StringArray.from_buffers(len(texts), ends, pa.py_buffer(mapped)))


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term), each once; rows that repeat an item_id are one item with all their terms."""
    def terms(batches):
        for part in text_slices(batches):
            offsets, codes, names = split_terms(plain_strings(part.column("text")))
            row = np.repeat(np.arange(part.num_rows), np.diff(offsets))
            yield pa.RecordBatch.from_arrays([part.column("item_id").take(pa.array(row)), names.take(pa.array(codes))],
                                             ["item_id", "term"])

    return (items.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").isNotNull())
            .mapInArrow(terms, "item_id long, term string").distinct())


def build_index(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """Shards of an inverted index over ``docs`` (doc_id, text) for the terms of ``vocabulary``, one row each.

    ``ids`` and ``lengths`` (terms with repeats) list the shard's documents, those without a term left
    out; posting ``p`` is document ``doc[p]`` with ``tf[p]`` times term ``term[p]``, sorted by term, then document.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def shards(batches):
        known, held, documents, postings = shared.value, [], 0, 0
        for part in text_slices(batches):
            offsets, codes, names = split_terms(plain_strings(part.column("text")))
            lengths = np.diff(offsets)
            full = np.flatnonzero(lengths)
            number = pc.fill_null(pc.index_in(names, known), -1).to_numpy(zero_copy_only=False)[codes] if len(codes) else codes
            row = np.repeat(np.arange(part.num_rows), lengths)
            asked = number >= 0
            pair, tf = np.unique(row[asked] * np.int64(len(known) + 1) + number[asked], return_counts=True)
            doc, term = pair // (len(known) + 1), pair % (len(known) + 1)
            ids = part.column("doc_id").take(pa.array(full))
            doc = np.searchsorted(full, doc)
            at = 0
            while at < len(full):
                ends = np.searchsorted(doc, np.arange(at, len(full)), side="right")  # postings up to each document
                before = int(np.searchsorted(doc, at))
                fits = int(np.searchsorted(ends - before, SHARD_POSTINGS - postings, side="right"))
                to = min(len(full), at + min(fits, SHARD_DOCUMENTS - documents))
                if to == at and documents:
                    yield _shard(held)
                    held, documents, postings = [], 0, 0
                    continue
                to = max(to, at + 1)
                upto = int(np.searchsorted(doc, to))
                held.append((ids.slice(at, to - at), lengths[full[at:to]], term[before:upto], doc[before:upto] - at + documents, tf[before:upto]))
                documents, postings, at = documents + to - at, postings + upto - before, to
        if documents:
            yield _shard(held)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").isNotNull()).mapInArrow(
        shards, "ids array<long>, lengths array<long>, term array<int>, doc array<int>, tf array<long>")


def _shard(held: list) -> pa.RecordBatch:
    ids, lengths, term, doc, tf = zip(*held)
    term, doc, tf = np.concatenate(term), np.concatenate(doc), np.concatenate(tf)
    order = np.lexsort((doc, term))

    def one(values, kind):
        values = values if isinstance(values, pa.Array) else pa.array(values.astype(kind.to_pandas_dtype()))
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    return pa.RecordBatch.from_arrays(
        [one(pa.concat_arrays(ids), pa.int64()), one(np.concatenate(lengths), pa.int64()), one(term[order], pa.int32()),
         one(doc[order], pa.int32()), one(tf[order], pa.int64())], ["ids", "lengths", "term", "doc", "tf"])


class Shard:
    """Scores of one shard's postings and each term's highest."""

    def __init__(self, lengths, term, doc, tf, weights: np.ndarray, n_documents: int, n_terms: int):
        if 50 * int(lengths.max(initial=0)) * n_documents < 2 ** 63:
            share = (50 * lengths * n_documents) // n_terms
        else:
            share = np.array([50 * int(n) * n_documents // n_terms for n in lengths], np.int64)
        m = 50 + share
        self.documents, self.doc = len(lengths), doc
        self.score = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
        self.terms, start = np.unique(term, return_index=True)
        self.start = np.append(start, len(term))
        self.highest = np.maximum.reduceat(self.score, start) if len(start) else np.zeros(0, np.int64)
        #: Postings read and looked up so far.
        self.read = self.looked_up = 0

    def best(self, terms: np.ndarray, k: int, threshold: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) that reach the k-th best score and ``threshold``, of terms in the order given."""
        at = np.searchsorted(self.terms, terms)
        at = at[(at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == terms)] if len(self.terms) else at[:0]
        rest = np.append(np.cumsum(self.highest[at][::-1])[::-1], 0)  # what the terms from here on can add
        dense, made, i = np.zeros(self.documents, np.int64), np.zeros(self.documents, bool), 0
        for i in range(len(at) + 1):
            if i and rest[i] <= rest[0] - rest[i]:  # else no partial score can pass the rest
                partial = dense[made]
                if len(partial) >= k:
                    threshold = max(threshold, int(np.partition(partial, len(partial) - k)[len(partial) - k]))
            if rest[i] < threshold or i == len(at):
                break  # a document without an accumulator cannot reach the best any more
            some = slice(self.start[at[i]], self.start[at[i] + 1])
            dense[self.doc[some]] += self.score[some]
            made[self.doc[some]] = True
            self.read += some.stop - some.start
        alive = np.flatnonzero(made)
        score = dense[alive]
        for j in range(i, len(at)):
            stays = score + rest[j] >= threshold
            alive, score = alive[stays], score[stays]
            if len(alive) > k:
                threshold = max(threshold, int(np.partition(score, len(score) - k)[len(score) - k]))
            some = slice(self.start[at[j]], self.start[at[j] + 1])
            doc = self.doc[some]
            where = np.minimum(np.searchsorted(doc, alive), len(doc) - 1)
            score = score + np.where(doc[where] == alive, self.score[some][where], 0)
            self.looked_up += len(alive)
        if len(score) > k:
            threshold = max(threshold, int(np.partition(score, len(score) - k)[len(score) - k]))
        stays = score >= threshold
        return alive[stays], score[stays]


def weight(n_documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * frequency + 1)))


def _search_block(docs: DataFrame, pairs: list, k: int) -> DataFrame:
    """Best ``k`` of every task for the items of one block: (item_id, doc_id, score)."""
    spark = docs.sparkSession
    vocabulary = sorted({term for _, term in pairs})
    number = {term: i for i, term in enumerate(vocabulary)}
    index = saved(build_index(docs, pa.array(vocabulary, pa.string())), "index-shards")
    sizes = index.select(F.size("ids").alias("n"), F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("l"))
    n_documents, n_terms = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("l"), F.lit(0))).first()
    frequency = np.zeros(len(vocabulary), np.int64)
    for row in index.select(F.explode("term").alias("term")).groupBy("term").agg(F.count("*").alias("n")).collect():
        frequency[row.term] = row.n  # one row for each term of the block
    weights = np.array([weight(n_documents, int(f)) for f in frequency], np.int64)
    items: dict = {}
    for item, term in pairs:
        items.setdefault(item, []).append(number[term])
    rare_first = {item: np.array(sorted(terms, key=lambda t: (frequency[t], t)), np.int32) for item, terms in items.items()}
    shared = spark.sparkContext.broadcast((rare_first, weights, n_documents, n_terms))

    def search(batches):
        rare_first, weights, n_documents, n_terms = shared.value
        empty = np.zeros(0, np.int64)
        best = {item: (empty, np.zeros(0, bool), empty) for item in rare_first}  # ids, whether null, scores
        for batch in batches:
            for i in range(batch.num_rows):
                ids, lengths, term, doc, tf = (batch.column(c)[i].values for c in ("ids", "lengths", "term", "doc", "tf"))
                no_id = ids.is_null().to_numpy(zero_copy_only=False)
                ids = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
                shard = Shard(*(x.to_numpy(zero_copy_only=False) for x in (lengths, term, doc, tf)), weights, n_documents, n_terms)
                for item, terms in rare_first.items():
                    held = best[item]
                    found, score = shard.best(terms, k, int(held[2][-1]) if len(held[2]) == k else 1)
                    if len(found):
                        ids_now, none_now, score_now = (np.concatenate(x) for x in zip(held, (ids[found], no_id[found], score)))
                        order = np.lexsort((ids_now, none_now, -score_now))[:k]
                        best[item] = ids_now[order], none_now[order], score_now[order]
        for item, (ids, none, score) in best.items():
            if len(score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(score), pa.int64()), pa.array(ids, mask=none), pa.array(score)], ["item_id", "doc_id", "score"])

    found = saved(index.mapInArrow(search, "item_id long, doc_id long, score long"), "found")
    drop_scratch(index)
    shared.unpersist()
    return found


def ranked(docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents with the highest scores above 0 of each item.

    Every row of ``docs`` (doc_id, text) is a document, rows that repeat an id too; equal scores go to
    the smaller doc_id, a null one last. Null texts and texts without a term hold nothing. Rows of ``items``
    (item_id, text) with one item_id, the null one included, are one item with all their terms; an item
    without terms, or whose terms no document holds, has no row. Empty tables give an empty one; other
    columns are not looked at.
    """
    spark = docs.sparkSession
    workers_import_package(spark)
    terms = item_terms(items)
    blocks = max(1, math.ceil(terms.count() / BLOCK_TERMS))
    if blocks > 1:  # each block reads them again
        terms = saved(terms, "item-terms")
    block = F.pmod(F.xxhash64(F.col("item_id")), F.lit(blocks))
    found = None
    for b in range(blocks):
        pairs = [tuple(r) for r in terms.where(block == b).orderBy("item_id", "term").collect()]  # about BLOCK_TERMS
        if pairs:
            some = _search_block(docs, pairs, k)
            found = some if found is None else found.unionByName(some)
    if found is None:
        found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
