"""Catalog tables clustered by a key (K4, K8): joins and windows on the key need no shuffle.

Rows are dealt into buckets by a hash of the key and sorted within them, so that two tables with the same buckets
join bucket by bucket, and a window over the key reads its rows in place. A player's rows are few, so no bucket
is hot; the number of buckets should give some hundred MB each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def save_clustered(df: DataFrame, name: str, path: str, key: str | Sequence[str], sort: Sequence[str] = (), buckets: int = 200,
                   comment: str = "", properties: Mapping[str, str] | None = None,
                   columns: Mapping[str, str] | None = None) -> DataFrame:
    """Write ``df`` as catalog table ``name`` at ``path`` in ``buckets`` by ``key``, each in order of ``key`` and ``sort``.

    One shuffle puts a bucket into one task, hence into one file, as several would lose the order. ``comment``,
    ``properties`` and comments of ``columns`` are stored in the catalog.
    """
    spark = df.sparkSession
    key = [key] if isinstance(key, str) else list(key)
    order = [*key, *(c for c in sort if c not in key)]
    out = df.select(*[F.col(c).alias(c, metadata={**df.schema[c].metadata, "comment": columns[c]}) if c in (columns or {}) else F.col(c)
                      for c in df.columns])
    (out.repartition(buckets, *key).write.format("parquet").bucketBy(buckets, *key).sortBy(*order)
     .option("path", path).saveAsTable(name))
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS {_quoted(comment)}")
    if properties:
        pairs = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in sorted(properties.items()))
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")
    return spark.table(name)


def clustered_options(spark: SparkSession, name: str) -> DataFrame:
    """(kind, name, text) of what the catalog holds of the table: comment, buckets, properties, column comments."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name").isin("Comment", "Num Buckets", "Bucket Columns", "Sort Columns"))
    options = described.select(F.lit("table").alias("kind"), F.col("col_name").alias("name"), F.col("data_type").alias("text"))
    properties = spark.sql(f"SHOW TBLPROPERTIES {name}").where(~F.col("key").startswith("transient"))
    properties = properties.select(F.lit("property").alias("kind"), F.col("key").alias("name"), F.col("value").alias("text"))
    comments = [(f.name, f.metadata["comment"]) for f in spark.table(name).schema.fields if "comment" in f.metadata]
    named = spark.createDataFrame(comments, "name string, text string").select(F.lit("column").alias("kind"), "name", "text")
    return options.unionByName(properties).unionByName(named)
