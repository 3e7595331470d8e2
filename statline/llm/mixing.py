"""Mix sources to target weights with hash-threshold histograms, in DataFrame functions alone.

Every document has a 60-bit hash. A histogram sums words by source and leading hash bits; the bucket
where a source's running sum crosses its budget is its boundary, and only rows in that bucket are
summed again by the next bits, until the whole hash is used. What lies under the threshold is taken:
no rows are sorted or ranked, a smaller budget takes a subset of what a larger one takes, and
reruns agree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import saved

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_TIMES = 2.0
LEVELS, BITS = 5, 12

WORD = r"[^\x20\x09-\x0D]+"


def words_in(text: Column) -> Column:
    """Number of white-space words of ``text``; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Sorts as the source does, with null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def hash60(doc_id: Column, text: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(doc_id, text), 64 - LEVELS * BITS)


def targets(totals: DataFrame, weights=WEIGHTS, share: float = SHARE, most_times: float = MOST_TIMES) -> DataFrame:
    """Add ``target`` to (skey, source_size): ``share`` of all sizes dealt by weight.

    Nobody gets over ``most_times`` its size and the excess goes to the others by weight. That ends
    at ``least(cap, level * weight)`` for one level: with sources in order of cap / weight the first
    ones are capped, and the level is what they leave over the weights that remain. The windows
    without partition run over one row for each source.
    """
    rank = (F.row_number().over(Window.orderBy("skey")) - 1) % len(weights)
    weight = reduce(lambda c, i: c.when(rank == i, F.lit(float(weights[i]))), range(1, len(weights)),
                    F.when(rank == 0, F.lit(float(weights[0]))))
    out = (totals.withColumn("weight", weight)
           .withColumn("cap", F.col("source_size") * F.lit(float(most_times)))
           .withColumn("budget", F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share))))
    rising = Window.orderBy(F.col("cap") / F.col("weight"), "skey")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    on = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    out = out.withColumn("level", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                         / F.sum("weight").over(on))
    free = F.when(F.col("level") * F.col("weight") <= F.col("cap"),
                  F.struct(F.col("cap") / F.col("weight"), "skey", F.col("level").alias("level")))
    level = F.min(free).over(Window.partitionBy())["level"]
    return out.select("skey", "source_size",
                      F.least("cap", F.coalesce(level * F.col("weight"), F.col("cap"))).alias("target"))


def _one_file(state: DataFrame) -> DataFrame:
    """One row for each source, written by one task: a file for each shuffle partition costs an executor more than its rows."""
    return saved(state.repartition(1), "mix-sources")


def thresholds(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most_times: float = MOST_TIMES) -> DataFrame:
    """One row for each source: (skey, source_size, target, whole, cut, at_cut).

    A document is taken ``whole`` times, and once more if its hash is under ``cut``, or equal to it
    where ``at_cut`` says so (rows that share the hash go together).
    """
    totals = sized.groupBy("skey").agg(F.sum("size").alias("source_size"))
    state = (targets(totals, weights, share, most_times)
             .withColumn("whole", F.floor(F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))).cast("long"))
             .withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))
             .withColumn("prefix", F.lit(0).cast("long")))
    state = _one_file(state)
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        inside = F.shiftright("h", shift + BITS) == F.col("prefix")
        running = Window.partitionBy("skey").orderBy("bucket")
        sums = (sized.join(state.select("skey", "prefix"), "skey").where(inside)
                .groupBy("skey", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("words"))
                .withColumn("upto", F.sum("words").over(running)))
        edge = (sums.join(state.select("skey", "left"), "skey").where(F.col("upto") > F.col("left"))
                .groupBy("skey").agg(F.min(F.struct("bucket", "words", "upto")).alias("edge")))
        # the last bucket counts whole if nothing crosses
        last = sums.groupBy("skey").agg(F.max(F.struct("bucket", "words", "upto")).alias("last"))
        state = (state.join(last, "skey", "left").join(edge, "skey", "left")
                 .withColumn("edge", F.coalesce("edge", "last")).drop("last")
                 .withColumn("left", F.col("left") - F.coalesce(F.col("edge.upto") - F.col("edge.words"), F.lit(0)))
                 .withColumn("prefix", F.coalesce(F.col("edge.bucket"), F.shiftleft("prefix", BITS)))
                 .withColumn("words", F.coalesce(F.col("edge.words"), F.lit(0))).drop("edge"))
        if level < LEVELS - 1:
            state = state.drop("words")
        state = _one_file(state)
    return state.select("skey", "source_size", "target", "whole", F.col("prefix").alias("cut"),
                        (F.col("left") * 2 > F.col("words")).alias("at_cut"))


def copies() -> Column:
    """How many times the mix takes a row that has ``h`` and its source's thresholds."""
    under = (F.col("h") < F.col("cut")) | ((F.col("h") == F.col("cut")) & F.col("at_cut"))
    return F.col("whole") + F.when(under, F.lit(1)).otherwise(F.lit(0))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most_times: float = MOST_TIMES) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row of ``docs`` (doc_id, text, source).

    ``size``: words of the text, null or empty: 0, which the mix takes as 0 words. Null sources are
    one source, the last. Identical rows share a hash and are taken alike; an empty table gives an
    empty one; other columns are not looked at.
    """
    sized = saved(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), words_in(F.col("text")).alias("size"),
        source_key(F.col("source")).alias("skey"), hash60(F.col("doc_id"), F.col("text")).alias("h")), "mix-sizes")
    cuts = thresholds(sized, weights, share, most_times)
    return sized.join(cuts, "skey").select(
        "doc_id", "size", "source_size", F.col("target").cast("double").alias("target"),
        (F.col("size") * copies()).alias("taken"))


def mixed(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most_times: float = MOST_TIMES) -> DataFrame:
    """The documents of the mix with the columns of ``docs``: each row as often as it is taken.

    Rows without a word have no size to weigh; they come through as often as their hash says.
    """
    names = docs.columns
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
                      source_key(F.col("source")).alias("skey"), hash60(F.col("doc_id"), F.col("text")).alias("h"))
    sized = saved(docs.select(
        words_in(F.col("text")).alias("size"), source_key(F.col("source")).alias("skey"),
        hash60(F.col("doc_id"), F.col("text")).alias("h")), "mix-sizes")
    cuts = thresholds(sized, weights, share, most_times)
    return (row.join(cuts, "skey")
            .select("row", F.explode(F.sequence(F.lit(1), F.greatest(copies(), F.lit(1)).cast("int"))).alias("copy"),
                    copies().alias("times"))
            .where(F.col("times") >= F.col("copy")).select("row.*"))
