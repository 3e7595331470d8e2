"""Spark session helpers.

The library never creates a session behind the caller's back: operators take
DataFrames, and only entry points (bench, tests, examples) call
``get_spark``. ``checkpoint_dir`` reads the shared folder from the session
(``spark.checkpoint.dir``); where it is unset, as in tests, a folder in the
warehouse directory takes its place.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "statline",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every entry point wants."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:  # tests and bench; elsewhere the cluster's own setting holds
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("STATLINE_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables and streaming state.

    Order: the SparkContext's checkpoint dir, ``spark.checkpoint.dir``, a folder in the warehouse.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/statline-{name}-{uuid.uuid4().hex[:12]}"


def _file_system(spark: SparkSession, path: str):
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(sc._jsc.hadoopConfiguration()), hadoop


def saved(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet under the shared folder and read it again.

    The plan after it starts at files that outlive any executor. The folder
    goes when the session's JVM ends, or earlier with :func:`drop_scratch`.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    fs, hadoop = _file_system(spark, path)
    fs.deleteOnExit(hadoop)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def drop_scratch(*frames: DataFrame) -> None:
    """Delete what :func:`saved` wrote; only for tables that nothing lazy reads any more."""
    for df in frames:
        path = getattr(df, "_scratch_path", None)
        if path:
            fs, hadoop = _file_system(df.sparkSession, path)
            fs.delete(hadoop, True)


def workers_import_package(spark: SparkSession) -> None:
    """Put this checkout on the Python path of workers that start from now on.

    A cluster that has the package installed, or ships it with ``--py-files``, doesn't need it.
    """
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *paths])
