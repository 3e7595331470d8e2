"""Shards of near equal size by longest-processing-time scheduling; rows with one text stay together.

Groups of at least 1/1000 of all bytes, at most a thousand of them, are scheduled one by one. The
many smaller ones are bundled first: every partition of groups orders its own by size, cuts them into
tiers of one half, one quarter, ... of its bytes and deals each tier's groups to bundles with a heap.
One heap over shards then takes the large groups and the bundles, largest first; the last tiers are
so fine that they level what the first leave uneven. The table that it sees is bounded by
``PARTITIONS * TIERS * BUNDLES`` rows however many documents there are.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runtime import saved, workers_import_package

LARGE = 1000
GROUPS_PER_TASK, PARTITIONS = 50_000, 4096
TIERS, BUNDLES = 8, 32
SLOT_ROWS = 50_000


def schedule(sizes, bins: int) -> np.ndarray:
    """Least-loaded bin for each size in the given order; ties go to the lower number."""
    heap = [(0, b) for b in range(bins)]
    out = np.empty(len(sizes), np.int64)
    for i, size in enumerate(sizes):
        load, chosen = heap[0]
        out[i] = chosen
        heapq.heapreplace(heap, (load + size, chosen))
    return out


def _bundle(groups: pd.DataFrame) -> pd.DataFrame:
    groups = groups.sort_values(["bytes", "key"], ascending=[False, True], ignore_index=True)
    sizes = groups["bytes"].to_numpy()
    left = 1 - (np.cumsum(sizes) - sizes) / sizes.sum()  # share of bytes from here on
    tier = np.minimum(np.floor(-np.log2(left)), TIERS - 1).astype(np.int64)
    bundle = np.empty(len(sizes), np.int64)
    for t in np.unique(tier):
        at = tier == t
        bundle[at] = t * BUNDLES + schedule(sizes[at].tolist(), BUNDLES)
    return groups.assign(bundle=groups["part"] * (TIERS * BUNDLES) + bundle)


def _schedule_all(shards: int):
    def run(items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["bytes", "bundle"], ascending=[False, True], ignore_index=True)
        return items.assign(shard=schedule(items["bytes"].tolist(), shards).astype(np.int32))[["bundle", "shard"]]

    return run


def shard(docs: DataFrame, shards: int = 40) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, grown_shard, slot) of every row of ``docs`` (doc_id, text).

    ``size`` is the text's UTF-8 bytes plus 16, of a null text 16. Equal texts share a shard, and
    null texts one with empty ones; a group over the mean shard makes its
    shard that much larger. ``text_crc32`` of a null text is 0. Repeated rows are rows of their own.
    """
    workers_import_package(docs.sparkSession)
    text = F.col("text")
    rows = saved(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("key")), "shard-rows")
    groups = saved(rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "shard-groups")
    total, n_groups, n_rows = groups.agg(F.sum("bytes"), F.count("*"), F.sum("n")).first()
    parts = max(1, min(PARTITIONS, -(-n_groups // GROUPS_PER_TASK)))
    large = F.col("bytes") * LARGE >= F.lit(total or 0)
    # large groups get numbers below 0; md5 keeps them apart, as there are so few
    alone = groups.where(large).select("key", "bytes", (-F.abs(F.xxhash64("key")) - 1).alias("bundle"))
    small = (groups.where(~large).select("key", "bytes", F.pmod(F.xxhash64("key"), F.lit(parts)).alias("part"))
             .groupBy("part").applyInPandas(_bundle, "key string, bytes long, part long, bundle long")
             .select("key", "bytes", "bundle"))
    bundled = saved(alone.unionByName(small), "shard-bundles")
    placed = (bundled.groupBy("bundle").agg(F.sum("bytes").alias("bytes"))
              .groupBy(F.lit(0).alias("all")).applyInPandas(_schedule_all(shards), "bundle long, shard int"))
    by_key = bundled.join(placed, "bundle").select("key", "shard")
    subs = max(1, -(-(n_rows or 0) // (shards * SLOT_ROWS)))
    out = saved(rows.join(by_key, "key").withColumn(
        "sub", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(subs))).drop("key"), "shard-placed")
    before = (out.groupBy("shard", "sub").count()
              .withColumn("before", F.sum("count").over(Window.partitionBy("shard").orderBy("sub")) - F.col("count"))
              .drop("count"))
    slot = F.row_number().over(Window.partitionBy("shard", "sub").orderBy("doc_id", "text_crc32", "size")) - 1
    return (out.withColumn("at", slot).join(before, ["shard", "sub"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    F.lit(None).cast("int").alias("grown_shard"), (F.col("before") + F.col("at")).alias("slot")))
