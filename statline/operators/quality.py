"""Data-quality rules, gates and quarantine (Q1–Q12).

All rules over one table are evaluated in ONE aggregation (``count_if`` per
rule), then unpivoted into a report row per rule — never one scan per rule.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .clean import DEFAULT_AS_OF, as_of_literal


@dataclass(frozen=True)
class Rule:
    name: str
    description: str
    violation: Column          # true for a violating row
    threshold: int = 0


def default_rules() -> list[Rule]:
    """Q4–Q7: the declared warehouse rules."""
    return [
        Rule("non_null_player_id", "Every row names its player",
             F.col("player_id").isNull()),
        Rule("valid_season_format", "Seasons read like 2003-04",
             ~F.col("season").rlike(r"^[0-9]{4}-[0-9]{2}$")),
        Rule("reasonable_minutes_per_game", "No player averages below 0 or above 48 minutes",
             (F.col("minutes_per_game") < 0) | (F.col("minutes_per_game") > 48)),
        Rule("positive_stats", "Points, rebounds and assists are never below zero",
             (F.col("points_per_game") < 0) | (F.col("rebounds_per_game") < 0)
             | (F.col("assists_per_game") < 0)),
    ]


def run_rules(df: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Q8: name, description, violations, threshold, passed — one scan for all rules."""
    rules = list(rules or default_rules())
    wide = df.agg(*[F.count_if(r.violation).alias(f"__v{i}") for i, r in enumerate(rules)])
    structs = [F.struct(F.lit(r.name).alias("rule_name"),
                        F.lit(r.description).alias("description"),
                        F.col(f"__v{i}").cast("bigint").alias("violations"),
                        F.lit(r.threshold).cast("bigint").alias("threshold"))
               for i, r in enumerate(rules)]
    return (wide.select(F.inline(F.array(*structs)))
            .withColumn("passed", F.col("violations") <= F.col("threshold")))


def _missing(c: str, dtype: T.DataType) -> Column:
    x = F.col(c)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return x.isNull() | F.isnan(x)
    return x.isNull()


def quality_summary(df: DataFrame, key: str | None = "player_id", min_rows: int = 10,
                    max_missing_share: float = 0.1) -> DataFrame:
    """Q1–Q3 in one pass: row count, missing-cell share, duplicate keys, verdicts.

    Duplicates are extra occurrences with NULL keys counted as equal
    (``count - distinct - [any NULL]``).
    """
    fields = df.schema.fields
    missing = None
    for f in fields:
        term = F.count_if(_missing(f.name, f.dataType))
        missing = term if missing is None else missing + term
    aggs = [F.count(F.lit(1)).alias("row_count"), missing.cast("bigint").alias("missing_cells")]
    if key:
        aggs += [F.countDistinct(key).alias("__distinct"),
                 F.max(F.col(key).isNull().cast("int")).alias("__anynull")]
    out = df.agg(*aggs)
    ncols = len(fields)
    out = out.withColumn("missing_share", F.try_divide(F.col("missing_cells"),
                                                       F.col("row_count") * ncols))
    if key:
        out = out.withColumn("duplicate_keys", (F.col("row_count") - F.col("__distinct")
                                                - F.coalesce(F.col("__anynull"), F.lit(0))
                                                ).cast("bigint")).drop("__distinct", "__anynull")
    else:
        out = out.withColumn("duplicate_keys", F.lit(0).cast("bigint"))
    return out.withColumns({
        "enough_rows": F.col("row_count") >= min_rows,
        "missing_ok": F.coalesce(F.col("missing_share") <= max_missing_share, F.lit(True)),
    })


class QualityError(ValueError):
    pass


def validate(tables: dict[str, DataFrame], key: str = "player_id", min_rows: int = 10,
             max_missing_share: float = 0.1) -> DataFrame:
    """Q9: gate — raise on the first failing table; return the per-table report.

    Each table is checked in one aggregation; its summary row reaches the
    driver, is checked and is what the report holds.
    """
    rows, schema, spark = [], None, None
    for name, df in tables.items():
        rep = quality_summary(df, key if key in df.columns else None, min_rows, max_missing_share) \
            .withColumn("table_name", F.lit(name))
        row = rep.first()
        if not row["enough_rows"]:
            raise QualityError(f"Insufficient data in {name}: {row['row_count']} records")
        if not row["missing_ok"]:
            raise QualityError(f"Too many missing values in {name}: {row['missing_share']:.2%}")
        rows.append(tuple(row))
        schema, spark = rep.schema, df.sparkSession
    return spark.createDataFrame(rows, schema)


def quarantine(df: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Q10: every row with ``failed_rules`` (comma list, NULL when clean) and ``is_valid``."""
    rules = list(rules or default_rules())
    names = [F.when(F.coalesce(r.violation, F.lit(False)), F.lit(r.name)) for r in rules]
    failed = F.concat_ws(",", *names)
    return (df.withColumn("failed_rules", F.when(failed != "", failed))
            .withColumn("is_valid", F.col("failed_rules").isNull()))


def freshness_check(df: DataFrame, ts: str = "data_loaded_at", max_age_days: int = 7,
                    as_of: str | _dt.datetime = DEFAULT_AS_OF, by: Sequence[str] = ()) -> DataFrame:
    """Q11: newest timestamp, its age in days and whether it is within ``max_age_days``."""
    now = as_of_literal(as_of)
    out = df.groupBy(*by).agg(F.max(ts).alias("last_update"))
    micros = F.expr("timestampdiff(MICROSECOND, last_update, __now)")
    out = out.withColumn("__now", now)
    age = micros / 86400000000.0
    return out.withColumns({
        "age_days": age,
        "is_fresh": F.coalesce(age < max_age_days, F.lit(False)),
    }).drop("__now")


def check_contract(df: DataFrame, contract: T.StructType) -> list[dict]:
    """Q12: compare the DataFrame schema with a declared contract (metadata only)."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    report = []
    for f in contract.fields:
        got = actual.get(f.name)
        status = "missing" if got is None else ("ok" if got == f.dataType else "type_mismatch")
        report.append({"column_name": f.name, "expected_type": f.dataType.simpleString(),
                       "actual_type": None if got is None else got.simpleString(),
                       "status": status})
    declared = {f.name for f in contract.fields}
    for name, t in actual.items():
        if name not in declared:
            report.append({"column_name": name, "expected_type": None,
                           "actual_type": t.simpleString(), "status": "undeclared"})
    return report
