"""Drop lines that many documents share, with levelled sorted runs of line hashes; DataFrame functions alone.

A run is a table of line hashes, bucketed and sorted by hash: in how many documents each line was found
(a document belongs to one batch) and the largest doc_id that holds it. Batches of documents come one after
another, the largest ids first. A batch's lines are counted by hash and merge-anti-joined with the runs: what a
run has already settled (found often enough, held by a larger id) needs no entry, so a line that a third of all
documents share is written once and not again by each batch. What is left becomes a new run of the lowest level.
When a level has ``FAN`` runs they are merged into one of the next, so few runs are read at any time and
an entry is rewritten once for each level. Runs have the same buckets, so an anti-join moves no data but
the batch's own entries. At the end the runs, merged, say which lines are shared and who keeps them.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .runtime import delete_path, saved

LEAST_LENGTH, LEAST_DOCUMENTS = 20, 3
BATCHES, FAN = 6, 3
HASH, ENTRY = ["h1", "h2"], "h1 long, h2 long, docs long, keeper long"
_SPACE = " \t\n\x0b\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(_SPACE)), _UPPER, _LOWER)


def lines_of(text: Column) -> Column:
    """Lines of a text; null and empty are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def hashed_lines(docs: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(doc_id, text_hash, pos, h1, h2) of every line of ``docs`` (doc_id, text) whose key is long enough.

    Two 64-bit hashes stand for a key, as one alone would clash within some billions of lines.
    """
    key = line_key(F.col("line"))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
                        F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
            .select("doc_id", "text_hash", "pos", key.alias("line_key")).where(F.char_length("line_key") >= least_length)
            .select("doc_id", "text_hash", "pos", F.xxhash64("line_key").alias("h1"), F.xxhash64(F.lit(1), "line_key").alias("h2")))


class LineRuns:
    """Levelled sorted runs (h1, h2, docs, keeper); ``levels[i]`` lists the runs that were merged ``i`` times."""

    def __init__(self, spark: SparkSession, least: int = LEAST_DOCUMENTS, fan: int = FAN):
        self.spark, self.least, self.fan = spark, least, fan
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]
        self._paths: dict[str, str] = {}

    def _write(self, entries: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex[:12]}"
        self._paths[name] = scratch_path(self.spark, "line-run")
        (entries.write.format("parquet").bucketBy(self.buckets, *HASH).sortBy(*HASH)
         .option("path", self._paths[name]).saveAsTable(name))
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete_path(self.spark, self._paths.pop(name))

    def runs(self) -> list[str]:
        return [name for level in reversed(self.levels) for name in level]

    def merged(self, names: list[str]) -> DataFrame:
        """One entry for each hash of the named runs.

        Read by path, not as bucketed tables: Spark 4.1 takes a union of bucketed scans for
        bucketed itself, leaves out the exchange, and hashes come out once for each run.
        """
        tables = [self.spark.read.schema(ENTRY).parquet(self._paths[name]) for name in names]
        return reduce(DataFrame.unionByName, tables).groupBy(*HASH).agg(F.sum("docs").alias("docs"), F.max("keeper").alias("keeper"))

    def add(self, lines: DataFrame) -> None:
        """Take a batch of hashed lines; no document of it may be in an earlier batch. Null ids are one document."""
        entries = (lines.select(*HASH, "doc_id").distinct()
                   .groupBy(*HASH).agg(F.count("*").alias("docs"), F.max("doc_id").alias("keeper")))
        for name in self.runs():
            settled = self.spark.table(name).where(F.col("docs") >= self.least).select(*HASH, F.col("keeper").alias("held"))
            entries = entries.join(settled, [entries[h] == settled[h] for h in HASH]
                                   + [F.col("held") >= F.coalesce(entries["keeper"], F.col("held"))], "left_anti")
        self.levels[0].append(self._write(entries))
        level = 0
        while len(self.levels[level]) >= self.fan:
            names, self.levels[level] = self.levels[level], []
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._write(self.merged(names)))
            for name in names:
                self._drop(name)
            level += 1

    def shared(self) -> DataFrame:
        """(h1, h2, keeper) of lines found in at least ``least`` documents."""
        return self.merged(self.runs()).where(F.col("docs") >= self.least).select(*HASH, "keeper")

    def drop(self) -> None:
        for name in self.runs():
            self._drop(name)
        self.levels = [[]]


def _batch(docs: DataFrame, batches: int) -> Column:
    """Number of a row's batch, the largest ids in batch 0, rows without an id in the last."""
    share = [i / batches for i in range(1, batches)]
    cuts = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), share, 10000)).first()[0] if share else None
    above = [F.when(F.col("doc_id") > cut, 0).otherwise(1) for cut in dict.fromkeys(cuts or [])]
    return reduce(lambda a, b: a + b, above, F.lit(0)).cast("int")


def shared_lines(docs: DataFrame, least_length: int = LEAST_LENGTH, least: int = LEAST_DOCUMENTS,
                 batches: int = BATCHES, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """(hashed lines of ``docs``, (h1, h2, keeper) of those that at least ``least`` documents share)."""
    spark = docs.sparkSession
    batched = hashed_lines(docs, least_length).withColumn("batch", _batch(docs, batches))
    path = scratch_path(spark, "hashed-lines")
    batched.write.partitionBy("batch").parquet(path)
    stored = spark.read.schema(batched.schema).parquet(path)
    runs = LineRuns(spark, least, fan)
    for b in range(batches):
        runs.add(stored.where(F.col("batch") == b))
    shared = saved(runs.shared(), "shared-lines")
    runs.drop()
    return stored.drop("batch"), shared


def without_shared_lines(docs: DataFrame, least_length: int = LEAST_LENGTH, least: int = LEAST_DOCUMENTS,
                         batches: int = BATCHES, fan: int = FAN) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text) of every row of ``docs`` (doc_id, text), without lines that others keep.

    Lines are split at \\n; null and empty texts are one empty line and come back empty. A line whose key
    (:func:`line_key`) has at least ``least_length`` characters and stands in at least ``least`` documents
    goes from all of them but the one with the largest doc_id, where all its copies stay. Rows that
    repeat a doc_id are one document to the count and share its decisions, each with its own text; rows
    without a doc_id are one document, below all others. Empty tables give an empty one; other columns are not looked at.
    """
    lines, shared = shared_lines(docs, least_length, least, batches, fan)
    goes = (lines.join(shared, HASH).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
            .groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("pos")).alias("gone"))
            .withColumnRenamed("doc_id", "of_doc").withColumnRenamed("text_hash", "of_text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marked = rows.join(goes, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.xxhash64("text") == F.col("of_text")), "left")
    cuts = F.concat(F.array(F.lit(-1)), F.coalesce("gone", F.expr("array()").cast("array<int>")), F.array(F.size("lines")))
    # what stays lies between neighbouring cuts, so the work is one pass over the lines
    between = F.transform(F.sequence(F.lit(1), F.size("cuts") - 1),
                          lambda i: F.slice("lines", F.get("cuts", i - 1) + 2, F.get("cuts", i) - F.get("cuts", i - 1) - 1))
    return (marked.withColumn("lines", lines_of(F.col("text"))).withColumn("cuts", cuts)
            .select("doc_id", F.size("lines").cast("long").alias("n_lines"), (F.size("cuts") - 2).cast("long").alias("n_dropped"),
                    F.array_join(F.flatten(between), "\n").alias("text")))
