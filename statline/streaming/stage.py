"""Structured Streaming jobs.

``stage_stream`` replaces the manual high-water mark of incremental staging
with a streaming file source: the checkpoint remembers which files were
processed, ``trigger(availableNow=True)`` drains whatever has landed (in as
many micro-batches as ``max_files_per_trigger`` dictates) and stops, and
each micro-batch is merged into the target with the idempotent ``upsert``
(replaying a batch after a failure rewrites the same rows).

``dedup_stream`` keeps the first arrival of each key. Rows may come in any
order: nothing is dropped for being late, and a key counts as repeated if the
target, or an earlier kept event of the same micro-batch, has it within the
look-back window around its event time.

``dedup_stream_watermark`` is its counterpart with bounded state: keys are held in
the state store until the watermark passes them, nothing of the target is
read, and what comes later than the watermark is left out and counted.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_scratch, saved
from ..sinks import versioned
from ..sinks.writers import upsert
from ..sources.landed import path_exists


def read_landing(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def _drain(src: DataFrame, merge, checkpoint: str) -> None:
    q = (src.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def stage_stream(spark: SparkSession, landing: str, schema: T.StructType, target: str,
                 checkpoint: str, unique_key: Sequence[str], order_key: Sequence[str],
                 partition_by: Sequence[str] = (), fmt: str = "parquet",
                 max_files_per_trigger: int | None = None, buckets: int | None = None,
                 as_versions: bool = False) -> None:
    """Drain the landing folder into the target table with per-batch upserts.

    With ``as_versions`` the target is a versioned table (``sinks.versioned``): every batch is published
    by one rename with its number, so a batch that runs again changes nothing.

    With ``buckets`` the table is partitioned by a hash of the key
    (``key_bucket``): a batch rewrites only the buckets of its keys, and no
    key ever moves.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        parts = list(partition_by)
        if as_versions:
            versioned.upsert(batch.sparkSession, batch, target, unique_key, order_key, parts, buckets, (checkpoint, batch_id))
            return
        if buckets:
            batch = batch.withColumn("key_bucket", F.pmod(F.xxhash64(*unique_key), F.lit(buckets)).cast("int"))
            parts = ["key_bucket"]
        upsert(batch.sparkSession, batch, target, unique_key, order_key, parts)

    _drain(read_landing(spark, landing, schema, fmt, max_files_per_trigger), merge, checkpoint)


def dedup_stream(spark: SparkSession, landing: str, schema: T.StructType, target: str,
                 checkpoint: str, key: Sequence[str], ts: str, lookback: str = "7 days",
                 fmt: str = "parquet", max_files_per_trigger: int | None = None) -> None:
    """First arrival of each key, appended to ``target`` (partitioned by ``event_day``).

    Each micro-batch drops rows whose key the target holds with an event time at
    most ``lookback`` away; only the days in question are read. Of the rest, in
    order of time, a key's first row is kept and then each that comes more than
    ``lookback`` after the last kept one, so rows that land in order of time give
    the same events in one micro-batch as in many. Running a batch again appends
    nothing. Only for keys whose rows in a batch span more than ``lookback`` are
    the distinct event times brought together, 8 bytes each. Rows without an
    event time are one event of their key.
    """
    others = [f.name for f in schema.fields if f.name not in key]
    span = F.expr(f"timestampdiff(MICROSECOND, timestamp'2000-01-01', timestamp'2000-01-01' + INTERVAL {lookback})")

    def micros(of: str):
        return F.expr(f"timestampdiff(MICROSECOND, timestamp'1970-01-01', cast(`{of}` AS timestamp))")

    def earliest(rows: DataFrame, *by: str) -> DataFrame:
        """One row of each group, the earliest, with its place in time (``__at``) and the last one's (``__last``)."""
        return (rows.groupBy(*key, *by).agg(F.min_by(F.struct("__at", *others), F.struct(ts, *[c for c in others if c != ts])).alias("__v"),
                                            F.max("__at").alias("__last")).select(*key, "__v.*", "__last"))

    def same_key(a: DataFrame, b: DataFrame):
        return reduce(and_, [a[k].eqNullSafe(b[k]) for k in key])

    def append(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.select(*key, *others).withColumn("__at", micros(ts)).withColumn("__none", F.col("__at").isNull())
        low, high = rows.agg(F.min(ts).cast("date"), F.max(ts).cast("date")).first()
        if path_exists(spark, target):
            days = F.col("event_day").isNull()
            if low is not None:
                days = days | F.col("event_day").between(F.date_sub(F.lit(low), 1) - F.expr(f"INTERVAL {lookback}"),
                                                         F.date_add(F.lit(high), 1) + F.expr(f"INTERVAL {lookback}"))
            had = spark.read.parquet(target).where(days).select(*key, micros(ts).alias("__had"))
            near = F.coalesce(F.abs(F.col("__at") - F.col("__had")) <= span, F.col("__at").isNull() & F.col("__had").isNull())
            rows = rows.join(had, same_key(rows, had) & near, "left_anti")
        rows = saved(rows, "dedup-rows")
        first = saved(earliest(rows, "__none"), "dedup-first")
        wide = F.coalesce(F.col("__last") - F.col("__at") > span, F.lit(False))
        new = first.select(*key, *others)
        if first.where(wide).limit(1).count():
            some = first.where(wide).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(key)])
            of_wide = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(key)])
            times = (rows.where(~F.col("__none")).join(some, of_wide, "left_semi").groupBy(*key)
                     .agg(F.array_sort(F.collect_set("__at")).alias("__all"), F.any_value(span).alias("__span")))
            kept = times.select(
                *[F.col(k).alias(f"__k{i}") for i, k in enumerate(key)],
                F.explode(F.expr("aggregate(__all, cast(array() AS array<bigint>), (kept, at) -> if("
                                 "size(kept) = 0 or at - element_at(kept, -1) > __span, concat(kept, array(at)), kept))")).alias("__kept"))
            events = earliest(rows.join(kept, of_wide & (F.col("__at") == F.col("__kept")), "left_semi"), "__at")
            new = first.where(~wide).select(*key, *others).unionByName(events.select(*key, *others))
        (new.withColumn("event_day", F.col(ts).cast("date"))
         .write.mode("append").partitionBy("event_day").parquet(target))
        drop_scratch(first)
        drop_scratch(rows)

    _drain(read_landing(spark, landing, schema, fmt, max_files_per_trigger), append, checkpoint)


def dedup_stream_watermark(spark: SparkSession, landing: str, schema: T.StructType, target: str, checkpoint: str,
                           key: Sequence[str], ts: str, delay: str = "7 days", fmt: str = "parquet",
                           max_files_per_trigger: int | None = None) -> None:
    """X2 with bounded state: the first arrival of each key, appended to ``target`` (partitioned by ``event_day``).

    A key stays in the state store until the watermark, the latest event time of the triggers before less ``delay``,
    is more than ``delay`` past its first event; state is bounded by the keys of that time, whatever the
    table's size. A row at or behind the watermark is late: it is left out, and counted in
    ``{target}_progress`` (batch_id, watermark, input_rows, late_rows, state_rows; one row for each trigger
    of a drain). Rows without an event time have no place in it; they go to ``{target}_undated``, repeats
    included. The checkpoint holds state, offsets and what was committed, so a restart goes on where it stopped.
    """
    src = read_landing(spark, landing, schema, fmt, max_files_per_trigger)
    at = F.col(ts).cast("timestamp")
    first = (src.where(F.col(ts).isNotNull()).withColumn("__at", at).withWatermark("__at", delay)
             .dropDuplicatesWithinWatermark(list(key)).drop("__at").withColumn("event_day", F.col(ts).cast("date")))
    base = target.rstrip("/")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "100000")  # every trigger of a drain is reported
    q = (first.writeStream.format("parquet").outputMode("append").partitionBy("event_day")
         .option("path", base).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    undated = (src.where(F.col(ts).isNull()).writeStream.format("parquet").option("path", f"{base}_undated")
               .option("checkpointLocation", f"{checkpoint.rstrip('/')}_undated").trigger(availableNow=True).start())
    q.awaitTermination()
    undated.awaitTermination()
    rows = []
    for p in q.recentProgress:
        state = p.stateOperators[0] if p.stateOperators else None
        rows.append((p.batchId, p.eventTime.get("watermark"), p.numInputRows,
                     state.numRowsDroppedByWatermark if state else 0, state.numRowsTotal if state else 0))
    if rows:
        (spark.createDataFrame(rows, "batch_id long, watermark string, input_rows long, late_rows long, state_rows long")
         .coalesce(1).write.mode("append").parquet(f"{base}_progress"))
