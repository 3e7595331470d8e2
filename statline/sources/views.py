"""Logical table names between models (S6): ``source``/``ref`` as temp views.

Models are plain functions of DataFrames; when a SQL model needs a name,
``register_views`` binds each DataFrame to a session-scoped temporary view
and ``ref`` resolves it. Nothing is materialised by naming.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> list[str]:
    names = []
    for name, df in tables.items():
        view = f"{prefix}{name}"
        df.createOrReplaceTempView(view)
        names.append(view)
    return names


def ref(spark: SparkSession, name: str, prefix: str = "") -> DataFrame:
    return spark.table(f"{prefix}{name}")
