"""Best-fit packing of token sequences by hierarchical residual packing.

Every partition packs its pieces best-fit (largest first) into bins of ``capacity`` tokens. Bins
that are nearly full are emitted; the others go on as items of one size each to the next round,
which has an eighth of the partitions (more, if one of them would get over ``ITEMS_PER_TASK``
items). Rounds end when one partition was enough or a round merged nothing, so a corpus of pieces
that cannot share a bin never gathers in one task.
"""

from __future__ import annotations

import zlib
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import plain_strings, saved, text_slices, workers_import_package
from .wordbpe import WordBpe
from .words import split_words

CAPACITY = 2048
#: A bin with no more free tokens than this is emitted as it is.
NEARLY = 16
ITEMS_PER_TASK = 60_000
FAN_IN = 8
#: Text bytes that are tokenized at once: arrays of all their words and ids stand beside each other.
TOKEN_SLICE = 2 << 20

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = _PIECES + ", bin long, offset long, filled int"


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Tokens of each whole text plus ``end_id``, cut into pieces of ``capacity`` tokens.

    A null text counts as empty and gives one piece with ``end_id`` alone. Repeated rows and null
    ids give pieces of their own.
    """
    workers_import_package(docs.sparkSession)

    def pieces(batches):
        bpe = WordBpe.load(tokenizer)
        for part in text_slices(batches, most=TOKEN_SLICE):
            offsets, codes, words = split_words(plain_strings(part.column("text")))
            lengths, starts, ids = bpe.encode_words(words)
            per_word = lengths[codes]
            ends = np.concatenate(([0], np.cumsum(per_word, dtype=np.int64)))
            flat = ids[np.repeat(starts[codes] - ends[:-1], per_word) + np.arange(ends[-1])].astype("<u4")
            rows, piece, start, length, crc = [], [], [], [], []
            tail = np.full(1, end_id, "<u4").tobytes()
            for row, (a, b) in enumerate(pairwise(ends[offsets].tolist())):
                raw, n = flat[a:b].tobytes() + tail, b - a + 1
                for k, at in enumerate(range(0, n, capacity)):
                    one = raw[4 * at:4 * (at + capacity)]
                    rows.append(row)
                    piece.append(k)
                    start.append(at)
                    length.append(len(one) // 4)
                    crc.append(zlib.crc32(one))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(pieces, _PIECES)


def best_fit(sizes, capacity: int) -> np.ndarray:
    """Bin number of each size, in the given order; the fullest bin that still has room takes it.

    Bins wait by the room they have; an integer has a bit for every room that some bin has, so the
    tightest one is its lowest bit at or above the size.
    """
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, bins = 0, 0
    out = np.empty(len(sizes), np.int64)
    for i, size in enumerate(sizes):
        fit = rooms >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            chosen = waiting[room].pop()
            if not waiting[room]:
                rooms &= ~(1 << room)
        else:
            room, chosen, bins = capacity, bins, bins + 1
        out[i] = chosen
        left = room - size
        if left:
            waiting[left].append(chosen)
            rooms |= 1 << left
    return out


def _round(number: int, capacity: int, first: bool):
    def pack(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got).combine_chunks()
        length = table.column("length").to_numpy()
        if first:  # every piece is an item
            item, item_size = np.arange(len(length)), length
            inside = np.zeros(len(length), np.int64)
            tie = [pc.fill_null(table.column("doc_id"), -(1 << 63)).to_numpy(), table.column("piece").to_numpy()]
        else:  # every bin of the round before is one
            names, item = np.unique(table.column("bin").to_numpy(), return_inverse=True)
            item_size = np.bincount(item, weights=length).astype(np.int64)
            inside, tie = table.column("offset").to_numpy(), [names]
        order = np.lexsort([*reversed(tie), -item_size])  # the same whatever order the rows came in
        placed = best_fit(item_size[order].tolist(), capacity)
        by_bin = np.argsort(placed, kind="stable")
        sizes, bins = item_size[order][by_bin], placed[by_bin]
        before = np.cumsum(sizes) - sizes
        filled = np.bincount(placed, weights=item_size[order]).astype(np.int64)
        at = np.empty(len(order), np.int64)
        at[order[by_bin]] = before - (np.cumsum(filled) - filled)[bins]
        bin_of = np.empty(len(order), np.int64)
        bin_of[order] = placed
        row_bin = bin_of[item]
        base = (number << 56) + (TaskContext.get().partitionId() << 32)
        out = table.select(["doc_id", "piece", "start", "length", "ids_crc32"])
        out = out.append_column("bin", pa.array(base + row_bin)).append_column("offset", pa.array(at[item] + inside))
        yield from out.append_column("filled", pa.array(filled[row_bin].astype(np.int32))).to_batches(65_536)

    return pack


def pack(pieces: DataFrame, capacity: int = CAPACITY, nearly: int = NEARLY,
         items_per_task: int = ITEMS_PER_TASK) -> DataFrame:
    """Pack ``pieces`` (each of 1 to ``capacity`` tokens) into bins; adds ``sequence_id`` and ``offset``.

    Offsets are gapless from 0 in each sequence. Ids of sequences are any numbers. An empty table
    gives an empty one.
    """
    workers_import_package(pieces.sparkSession)
    rows = saved(pieces, "pieces")
    n = rows.count()
    parts = max(1, -(-n // items_per_task))
    current = rows.repartition(parts, "doc_id", "piece", "start", "ids_crc32")
    done: list[DataFrame] = []
    number, bins = 0, None
    while True:
        packed = saved(current.mapInArrow(_round(number, capacity, number == 0), _PACKED), "packed")
        full = F.col("filled") >= capacity - nearly
        stats = packed.where(~full).where(F.col("offset") == 0).count()
        if parts == 1 or stats == 0 or (bins is not None and stats >= bins):
            done.append(packed)
            break
        done.append(packed.where(full))
        bins, number = stats, number + 1
        parts = max(-(-stats // items_per_task), -(-parts // FAN_IN))
        current = packed.where(~full).repartition(parts, F.xxhash64("bin"))
    out = done[0]
    for other in done[1:]:
        out = out.unionByName(other)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32",
                      F.col("bin").alias("sequence_id"), F.col("offset"))
