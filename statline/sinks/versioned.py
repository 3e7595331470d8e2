"""Versioned Parquet tables: immutable data folders, a manifest for each version, a key index.

A table is a folder with

* ``data/<batch>/__folder=<id>/`` — rows, written once and never changed; ``id`` is a hash of the partition values;
* ``index/<batch>/`` — for each of these folders, the range of the first key column and a bitmap of key hashes;
* ``versions/v<number>.json`` — which folders are the table, with its schema, comment and properties.

A write adds folders and then publishes a manifest with one rename that fails if the version exists. Readers
take the newest manifest, so at any moment, also when the driver is lost between any two steps, they see
the version before or the version after, whole. Of two writers that start from one version the
second gets :class:`ConcurrentUpdate`. Old versions stay readable until :func:`vacuum`.

``upsert`` rewrites the folders that get rows and, where a key may change its partition, those that hold one of the
delta's keys. These are looked for in the folders that the index does not rule out: the key range must
overlap and the bitmaps of table and delta must share a bit. The index can name a folder too many (bitmaps
are small, so a large delta hits most of them), never one too few. What the driver handles is one entry for each folder.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_scratch, saved
from .writers import latest_per_key, rows_of_keys

#: Bits of a folder's bitmap for each of its keys, and the least number of bits (one bitmap of Spark's functions).
BITS_PER_KEY, LEAST_BITS = 32, 32768
#: Bitmap bytes of an index file at most, on average.
INDEX_FILE_BYTES = 256 << 20
_VERSION = re.compile(r"v(\d{12})\.json$")


class ConcurrentUpdate(RuntimeError):
    """Another writer has published the version that this one was about to."""


def _step(name: str) -> None:
    """Called between the steps of a write; a test stops the writer here."""


# ------------------------------------------------------------------ files


def _paths(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, conf, hadoop.getFileSystem(conf), hadoop


def _list(spark: SparkSession, path: str) -> list:
    _, _, fs, hadoop = _paths(spark, path)
    return list(fs.listStatus(hadoop)) if fs.exists(hadoop) else []


def _read_text(spark: SparkSession, path: str) -> str:
    jvm, _, fs, hadoop = _paths(spark, path)
    stream = fs.open(hadoop)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _publish(spark: SparkSession, path: str, manifest: dict) -> None:
    """Write the manifest beside its place and rename it there; the rename never replaces a file."""
    jvm, conf, fs, target = _paths(spark, f"{path}/versions/v{manifest['version']:012d}.json")
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}/versions/_draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    _step("manifest drafted")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(target).toUri(), conf)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(target), options)
    except Exception as e:
        if "FileAlreadyExists" not in str(e):
            raise
        fs.delete(draft, False)
        raise ConcurrentUpdate(f"version {manifest['version']} of {path} exists") from None
    _step("published")


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that can be read, ascending."""
    found = (_VERSION.search(s.getPath().getName()) for s in _list(spark, f"{path}/versions"))
    return sorted(int(m[1]) for m in found if m)


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    """The manifest of a version (default: the newest), or None where there is none."""
    known = versions(spark, path)
    if not known or version is not None and version not in known:
        return None
    return json.loads(_read_text(spark, f"{path}/versions/v{version or known[-1]:012d}.json"))


# ------------------------------------------------------------------ reading


def _frame(spark: SparkSession, path: str, held: dict, folders: Sequence[dict]) -> DataFrame:
    schema = T.StructType.fromJson(held["schema"])
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{f['folder']}" for f in folders])


def read(spark: SparkSession, path: str, version: int | None = None,
         partitions: Mapping[str, Sequence] | None = None) -> DataFrame:
    """The table, or an older version of it; ``partitions`` (column -> values) opens only the folders of these values."""
    held = manifest(spark, path, version)
    if held is None:
        raise FileNotFoundError(f"no version {version or ''} at {path}".replace("  ", " "))
    folders = held["folders"]
    for c, values in (partitions or {}).items():
        at, wanted = held["partition_by"].index(c), {None if v is None else str(v) for v in values}
        folders = [f for f in folders if f["values"][at] in wanted]
    out = _frame(spark, path, held, folders)
    for c, values in (partitions or {}).items():  # two values may share a folder
        known = F.col(c).cast("string").isin([str(v) for v in values if v is not None])
        out = out.where(known | F.col(c).isNull() if None in values else known)
    return out


def history(spark: SparkSession, path: str) -> DataFrame:
    """(version, operation, folders, rows) of every version, one row each."""
    rows = []
    for v in versions(spark, path):
        held = manifest(spark, path, v)
        rows.append((v, held["operation"], len(held["folders"]), sum(f["rows"] for f in held["folders"])))
    return spark.createDataFrame(rows, "version long, operation string, folders long, rows long")


def table_options(spark: SparkSession, path: str) -> DataFrame:
    """K8: (kind, name, text) of the table's comment, its properties and its columns' comments."""
    held = manifest(spark, path)
    rows = [("comment", "", held["comment"])] if held["comment"] else []
    rows += [("property", k, v) for k, v in sorted(held["properties"].items())]
    rows += [("column", f["name"], f["metadata"]["comment"]) for f in held["schema"]["fields"] if f["metadata"].get("comment")]
    return spark.createDataFrame(rows, "kind string, name string, text string")


# ------------------------------------------------------------------ writing


def _folder_id(partition_by: Sequence[str], unique_key: Sequence[str], buckets: int | None) -> Column:
    if buckets:
        return F.format_string("b%06d", F.pmod(F.xxhash64(*unique_key), F.lit(buckets)))
    if not partition_by:
        return F.lit("all")
    return F.lower(F.hex(F.xxhash64(*[F.struct(F.col(c).cast("string").alias("v"), F.col(c).isNull().alias("n")) for c in partition_by])))


def _key_hash(unique_key: Sequence[str]) -> Column:
    return F.xxhash64(*unique_key)


def _slot(bits: Column, h: Column) -> Column:
    return h.bitwiseAND(bits - 1) + 1


def _write_rows(spark: SparkSession, rows: DataFrame, path: str, held: dict) -> list[dict]:
    """Add a batch of folders with its index; entries of the manifest for them."""
    batch = uuid.uuid4().hex
    key, parts = held["unique_key"], held["partition_by"]
    # partitions of a folder are split where they are large and joined where small
    (rows.withColumn("__folder", _folder_id(parts, key, held["buckets"])).hint("rebalance", "__folder")
     .write.partitionBy("__folder").parquet(f"{path}/data/{batch}"))
    _step("data written")
    schema = T.StructType([*rows.schema.fields, T.StructField("__folder", T.StringType())])
    written = spark.read.schema(schema).parquet(f"{path}/data/{batch}")
    values = F.array(*[F.col(c).cast("string") for c in parts]) if parts else F.array().cast("array<string>")
    least = F.lit(LEAST_BITS)
    totals = saved(written.groupBy("__folder").agg(
        F.count(F.lit(1)).alias("rows"), F.any_value(values).alias("values"), F.min(key[0]).alias("low"), F.max(key[0]).alias("high"),
        F.count_if(F.col(key[0]).isNull()).alias("nulls"))
        .withColumn("bits", F.greatest(least, F.pow(2.0, F.ceil(F.log2(F.col("rows") * BITS_PER_KEY))).cast("long"))), "folder-totals")
    sized = written.select("__folder", _key_hash(key).alias("h")).join(totals.select("__folder", "bits"), "__folder")
    slot = _slot(F.col("bits"), F.col("h"))
    bitmaps = (sized.select("__folder", "bits", slot.alias("slot"))
               .groupBy("__folder", "bits", F.bitmap_bucket_number("slot").alias("bucket"))
               .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap")))
    # tasks that build bitmaps stay apart from those that write files: one task of many of them would hold all their sorters
    size = totals.agg(F.coalesce(F.sum("bits"), F.lit(0))).first()[0] // 8
    (bitmaps.join(totals.select("__folder", "low", "high", "nulls"), "__folder").withColumn("batch", F.lit(batch))
     .repartition(max(1, held["index_files"], -(-size // INDEX_FILE_BYTES))).write.parquet(f"{path}/index/{batch}"))
    _step("index written")
    entries = [{"folder": f"data/{batch}/__folder={r['__folder']}", "id": r["__folder"], "batch": batch, "rows": r["rows"],
                "values": list(r["values"]), "bits": r["bits"]} for r in totals.drop("low", "high", "nulls").collect()]
    drop_scratch(totals)
    return entries


def candidates(spark: SparkSession, path: str, held: dict, delta: DataFrame) -> list[dict]:
    """Folders of the version that may hold a key of ``delta``, by key range and bitmaps."""
    key, folders = held["unique_key"], held["folders"]
    batches = sorted({f["batch"] for f in folders})
    if not batches:
        return []
    first = key[0]
    low, high, nulls = delta.agg(F.min(first), F.max(first), F.count_if(F.col(first).isNull())).first()
    kind = T.StructType.fromJson(held["schema"])[first].dataType.simpleString()
    index = spark.read.schema(f"__folder string, bits long, bucket long, bitmap binary, low {kind}, high {kind}, nulls long, batch string") \
        .parquet(*[f"{path}/index/{b}" for b in batches])
    overlaps = F.lit(False) if low is None else (F.col("low") <= F.lit(high)) & (F.col("high") >= F.lit(low))
    if nulls:
        overlaps = overlaps | (F.col("nulls") > 0)
    live = spark.createDataFrame([(f["id"], f["batch"]) for f in folders], "__folder string, batch string")
    index = index.where(F.coalesce(overlaps, F.lit(False))).join(live, ["__folder", "batch"], "left_semi")
    sizes = F.array(*[F.lit(b).cast("long") for b in sorted({f["bits"] for f in folders})])
    slots = delta.select(_key_hash(key).alias("h")).distinct().select("h", F.explode(sizes).alias("bits"))
    slots = slots.select("bits", _slot(F.col("bits"), F.col("h")).alias("slot"))
    asked = slots.groupBy("bits", F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("asked"))
    both = (index.join(asked, ["bits", "bucket"])
            .select("__folder", "batch", "bucket", (F.bitmap_count("bitmap") + F.bitmap_count("asked")).alias("bits_of_both"),
                    F.explode(F.array("bitmap", "asked")).alias("either"))
            .groupBy("__folder", "batch", "bucket", "bits_of_both").agg(F.bitmap_count(F.bitmap_or_agg("either")).alias("together")))
    # bitmaps that share a bit have fewer bits together than one by one
    found = {(r["__folder"], r["batch"]) for r in both.where("together < bits_of_both").select("__folder", "batch").distinct().collect()}
    return [f for f in folders if (f["id"], f["batch"]) in found]


def create(spark: SparkSession, df: DataFrame, path: str, unique_key: Sequence[str], partition_by: Sequence[str] = (),
           buckets: int | None = None, comment: str = "", properties: Mapping[str, str] | None = None) -> int:
    """K3, K4: publish ``df`` as the table's rows, as version 1 or in place of all rows of the version before.

    ``buckets`` parts rows by a hash of the key instead of ``partition_by``. Returns the version.
    """
    before = manifest(spark, path)
    held = {"version": before["version"] + 1 if before else 1, "operation": "replace" if before else "create",
            "schema": json.loads(df.schema.json()), "unique_key": list(unique_key), "partition_by": list(partition_by),
            "buckets": buckets, "index_files": 1, "comment": comment, "properties": dict(properties or {}), "folders": [], "stream": {}}
    held["folders"] = _write_rows(spark, df, path, held)
    _publish(spark, path, held)
    return held["version"]


def upsert(spark: SparkSession, delta: DataFrame, path: str, unique_key: Sequence[str], order_key: Sequence[str],
           partition_by: Sequence[str] = (), buckets: int | None = None, batch_of: tuple[str, int] | None = None) -> int:
    """K5: the newest row of each key of table and ``delta`` as the next version (version 1 where there is no table).

    ``batch_of`` (stream, number) marks the batch of a stream: one that is already in the table changes nothing.
    Returns the version that holds the delta. A delta of no rows gives a version with the same folders.
    """
    before = manifest(spark, path)
    if before is None:
        rows = latest_per_key(delta, unique_key, order_key)
        before = {"version": 0, "schema": json.loads(delta.schema.json()), "unique_key": list(unique_key), "partition_by": list(partition_by),
                  "buckets": buckets, "index_files": 1, "comment": "", "properties": {}, "folders": [], "stream": {}}
        rewritten = []
        delta = None
    else:
        if batch_of and before["stream"].get(batch_of[0], -1) >= batch_of[1]:
            return before["version"]
        delta = saved(delta.select(*T.StructType.fromJson(before["schema"]).fieldNames()), "delta")
        parts, key = before["partition_by"], before["unique_key"]
        folder = _folder_id(parts, key, before["buckets"])
        ids = {r[0] for r in delta.select(folder).distinct().collect()}  # one for each folder at most
        if not before["buckets"] and not set(parts) <= set(key):
            held_keys = _frame(spark, path, before, candidates(spark, path, before, delta)).select(*dict.fromkeys([*key, *parts]))
            moved = rows_of_keys(held_keys, delta, key)
            ids |= {r[0] for r in moved.select(folder).distinct().collect()}
        rewritten = [f for f in before["folders"] if f["id"] in ids]
        rows = latest_per_key(_frame(spark, path, before, rewritten).unionByName(delta), key, order_key)
    gone = {f["folder"] for f in rewritten}
    after = {**before, "version": before["version"] + 1, "operation": "upsert",
             "folders": [f for f in before["folders"] if f["folder"] not in gone] + _write_rows(spark, rows, path, before),
             "stream": {**before["stream"], **({batch_of[0]: batch_of[1]} if batch_of else {})}}
    if delta is not None:
        drop_scratch(delta)
    _publish(spark, path, after)
    return after["version"]


def set_options(spark: SparkSession, path: str, comment: str | None = None, properties: Mapping[str, str] | None = None,
                columns: Mapping[str, str] | None = None) -> int:
    """K8: a version with the same rows and another comment, properties (added to the old ones) or column comments."""
    held = manifest(spark, path)
    schema = json.loads(json.dumps(held["schema"]))
    for f in schema["fields"]:
        if f["name"] in (columns or {}):
            f["metadata"]["comment"] = columns[f["name"]]
    after = {**held, "version": held["version"] + 1, "operation": "options", "schema": schema,
             "comment": held["comment"] if comment is None else comment, "properties": {**held["properties"], **(properties or {})}}
    _publish(spark, path, after)
    return after["version"]


def vacuum(spark: SparkSession, path: str, keep: int = 2, older_than_hours: float = 24.0) -> int:
    """Delete versions before the newest ``keep`` and batches that no kept version reads; returns how many folders went.

    Nothing younger than ``older_than_hours`` goes, so a write that is under way keeps its folders.
    """
    known = versions(spark, path)
    kept = known[-keep:]
    used: dict[str, set] = {}
    for v in kept:
        for f in manifest(spark, path, v)["folders"]:
            used.setdefault(f["batch"], set()).add(f["folder"].rsplit("/", 1)[1])
    before = (time.time() - older_than_hours * 3600) * 1000
    gone = 0
    for status in _list(spark, f"{path}/versions"):
        found = _VERSION.search(status.getPath().getName())
        old = int(found[1]) not in kept if found else status.getPath().getName().startswith("_draft-")
        if old and status.getModificationTime() <= before:
            _paths(spark, path)[2].delete(status.getPath(), False)
    for batch in _list(spark, f"{path}/data"):
        name = batch.getPath().getName()
        if name not in used:
            if batch.getModificationTime() <= before:
                for kind in ("data", "index"):
                    _, _, fs, folder = _paths(spark, f"{path}/{kind}/{name}")
                    fs.delete(folder, True)
                gone += 1
            continue
        for part in _list(spark, f"{path}/data/{name}"):
            if part.getPath().getName().startswith("__folder=") and part.getPath().getName() not in used[name] and part.getModificationTime() <= before:
                _paths(spark, path)[2].delete(part.getPath(), True)
                gone += 1
    return gone
