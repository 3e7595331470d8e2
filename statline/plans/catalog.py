"""Registered queries: Spark implementations and their DuckDB oracle SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the WHOLE test tables
(through the fixture derivations). Where the result can be stated in SQL,
``ORACLES[name]`` holds an independent DuckDB statement over the same base
tables; its column names and types match the Spark result.

Conventions shared by both sides: decimal literals carry ``E0`` in SQL so
they stay DOUBLE, every ratio is ``x / nullif(y, 0)`` (Spark ``try_divide``),
integer outputs are BIGINT, timestamps are zone-free.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.fixtures import fixture_ctes, fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF = "2024-01-01 00:00:00"
AS_OF_SQL = f"TIMESTAMP '{AS_OF}'"


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def with_fixtures(body: str, *names: str) -> str:
    """Prefix ``body`` with fixture CTEs, merging a leading ``WITH`` of its own."""
    prefix = fixture_ctes(*names)
    body = body.strip()
    if not prefix:
        return body
    if body[:5].upper() == "WITH ":
        return prefix.rstrip() + ",\n" + body[5:]
    return prefix + body


def fx(spark: SparkSession, sf_dir: str):
    return fixtures(spark, sf_dir)


def trim_sql(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def season_sql(x: str) -> str:
    return (f"concat(cast({x} as string), '-', "
            f"lpad(cast(({x} + 1) % 100 as string), 2, '0'))")


def quantile_sql(src: str, col: str, p: float) -> str:
    """Scalar subquery: linear-interpolated quantile ``lo + (hi - lo) * d`` of ``col``.

    The order statistics come from ``row_number()``; the interpolation is
    plain DOUBLE arithmetic, the same definition the Spark side uses.
    """
    v = f"CAST({col} AS DOUBLE)"
    return (f"(SELECT lo + (hi - lo) * d FROM (SELECT max(CASE WHEN rn = fl THEN v END) AS lo, "
            f"max(CASE WHEN rn = cl THEN v END) AS hi, max(dd) AS d FROM "
            f"(SELECT {v} AS v, row_number() OVER (ORDER BY {v}) AS rn FROM {src} "
            f"WHERE {col} IS NOT NULL AND NOT isnan({v})) s CROSS JOIN "
            f"(SELECT floor(pos) + 1 AS fl, ceil(pos) + 1 AS cl, pos - floor(pos) AS dd FROM "
            f"(SELECT (count({col}) - 1) * {float(p)!r}E0 AS pos FROM {src} "
            f"WHERE {col} IS NOT NULL AND NOT isnan({v})) c0) c))")
