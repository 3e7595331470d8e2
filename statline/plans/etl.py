"""ETL run (R1): extract → transform → validate → load, with a run report.

Extraction lands each table as CSV for the season and adds a manifest row;
while the manifest is younger than the look-back, a run reads what is landed
instead. Each transformed table is written once to the shared folder, and
validation, snapshot and load read that. Record counts of writes come from
``DataFrame.observe`` on the write itself.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import metrics as M
from ..operators import aggregate, clean, quality
from ..operators.clean import DEFAULT_AS_OF
from ..session import drop_scratch, saved
from ..sinks import writers
from ..sources import landed


@dataclass
class ETLConfig:
    output_dir: str
    season: str = "2000-01"
    min_rows: int = 10
    max_missing_share: float = 0.1
    lookback_days: int = 7
    outlier_threshold: float = 1.5
    as_of: str = DEFAULT_AS_OF
    tables: tuple = ("players", "advanced_stats")


def etl_advanced(advanced: DataFrame, as_of=DEFAULT_AS_OF, k: float = 1.5) -> DataFrame:
    """Advanced-stats transform: coerce → cap outliers → aliases → linear PER → stamp.

    The order matters and is kept: minutes are capped before they divide the
    efficiency numerator. The input is read and coerced once, into a table that
    quantiles and result read; ``drop_scratch`` of the result drops it.
    """
    coerced = saved(clean.coerce_numeric(advanced, clean.ADVANCED_NUMERIC), "coerced")
    df = aggregate.cap_outliers_iqr(coerced, clean.ADVANCED_NUMERIC, k=k)
    df = clean.alias_metrics(df)
    df = df.withColumn("player_efficiency_rating", M.per_linear(df.columns))
    df = clean.stamp(df, "processed_at", as_of)
    df._scratch_path = coerced._scratch_path
    return df


def transform(raw: dict[str, DataFrame], cfg: ETLConfig) -> dict[str, DataFrame]:
    out = {}
    if "players" in raw:
        out["players"] = clean.etl_players(raw["players"], cfg.as_of)
    if "advanced_stats" in raw:
        out["advanced_stats"] = etl_advanced(raw["advanced_stats"], cfg.as_of,
                                             cfg.outlier_threshold)
    return out


def _timed_write(df: DataFrame, write, name: str, stage: str) -> dict:
    obs = Observation(f"{stage}_{name}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("records"))
    t0 = time.time()
    write(observed)
    return {"stage": stage, "table_name": name, "status": "success",
            "records": int(obs.get["records"]), "seconds": round(time.time() - t0, 3)}


def refresh_due(spark: SparkSession, cfg: ETLConfig) -> bool:
    """Whether the season has to be extracted: never landed, or its newest landing is too old."""
    manifest = f"{cfg.output_dir}/manifest"
    if not landed.path_exists(spark, manifest):
        return True
    gate = landed.freshness_gate(spark.read.parquet(manifest), cfg.lookback_days, cfg.as_of)
    row = gate.where(F.col("season") == cfg.season).first()
    return row is None or row["refresh_due"]


def extract(spark: SparkSession, raw: dict[str, DataFrame], cfg: ETLConfig) -> tuple[dict[str, DataFrame], list[dict]]:
    """Landed tables of the season, landed anew where due, and their report rows."""
    base, out, stages = f"{cfg.output_dir}/landed", {}, []
    due = refresh_due(spark, cfg)
    for name in (t for t in cfg.tables if t in raw):
        t0 = time.time()
        df = None if due else landed.read_landed_csv(spark, base, name, cfg.season, raw[name].schema)
        if df is None:
            row = _timed_write(raw[name], lambda d, n=name: writers.write_csv(d, base, n, cfg.season), name, "extract")
            stages.append(row | {"status": "landed"})
            df = landed.read_landed_csv(spark, base, name, cfg.season, raw[name].schema)
        else:
            stages.append({"stage": "extract", "table_name": name, "status": "reused", "records": df.count(),
                           "seconds": round(time.time() - t0, 3)})
        out[name] = df
    if due:
        writers.write_manifest(spark, f"{cfg.output_dir}/manifest", cfg.season,
                               sum(s["records"] for s in stages), cfg.as_of)
    return out, stages


def run_etl(spark: SparkSession, raw: dict[str, DataFrame], cfg: ETLConfig) -> DataFrame:
    """Run the whole ETL; returns the report (failures are reported, not raised)."""
    stages: list[dict] = []
    data: dict[str, DataFrame] = {}
    try:
        tables, stages = extract(spark, raw, cfg)
        for name, df in transform(tables, cfg).items():
            t0 = time.time()
            data[name] = saved(df, "transformed")
            drop_scratch(df)
            stages.append({"stage": "transform", "table_name": name, "status": "success",
                           "records": data[name].count(), "seconds": round(time.time() - t0, 3)})
        t0 = time.time()
        report = quality.validate(data, min_rows=cfg.min_rows,
                                  max_missing_share=cfg.max_missing_share)
        for r in report.collect():
            stages.append({"stage": "validate", "table_name": r["table_name"],
                           "status": "success", "records": r["row_count"],
                           "seconds": round(time.time() - t0, 3)})
        for name, df in data.items():
            stages.append(_timed_write(
                df, lambda d, n=name: writers.write_snapshot(d, f"{cfg.output_dir}/processed", n,
                                                             cfg.as_of), name, "snapshot"))
            stages.append(_timed_write(
                df, lambda d, n=name: writers.write_truncate(d, f"{cfg.output_dir}/warehouse/{n}"),
                name, "load"))
    except Exception as e:  # the report carries the failure
        stages.append({"stage": "failed", "table_name": None, "status": "failed",
                       "records": None, "seconds": None, "error": f"{type(e).__name__}: {e}"})
    drop_scratch(*data.values())
    return writers.run_report(spark, stages)
