"""Projection, filter and cleaning operators (P1–P22) plus the staging jobs.

All operators are ``DataFrame -> DataFrame`` and lazy. Filters are plain
``where`` clauses so Catalyst pushes them into the Parquet scan; projections
are explicit so column pruning reaches ``ReadSchema``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.safe import (clamp, nan_to_null, season_label, strip_ws, to_double,
                              zero_if_missing)

# Team-name standardisation rules, in priority order
# (case-sensitive LIKE '%pattern%' on the team name → canonical name).
TEAM_RULES: tuple[tuple[tuple[str, ...], str], ...] = (
    (("Lakers", "LAL"), "Los Angeles Lakers"),
    (("Warriors", "GSW"), "Golden State Warriors"),
    (("Celtics", "BOS"), "Boston Celtics"),
    (("Heat", "MIA"), "Miami Heat"),
    (("Nets", "BKN"), "Brooklyn Nets"),
)

DEFAULT_AS_OF = "2024-01-01 00:00:00"


def as_of_literal(as_of: str | _dt.datetime = DEFAULT_AS_OF) -> Column:
    """Run timestamp as a zone-free literal, so results are repeatable."""
    text = as_of.strftime("%Y-%m-%d %H:%M:%S") if isinstance(as_of, _dt.datetime) else as_of
    return F.to_timestamp_ntz(F.lit(text))


def clean_names(df: DataFrame, cols: Sequence[str] = ("player_name", "team_name")) -> DataFrame:
    """Strip whitespace at both ends of text columns."""
    return df.withColumns({c: strip_ws(c) for c in cols if c in df.columns})


def cast_ids(df: DataFrame, cols: Sequence[str] = ("player_id", "team_id")) -> DataFrame:
    """Strict integer cast (ANSI: malformed text raises, as the warehouse does)."""
    return df.withColumns({c: F.col(c).cast("bigint") for c in cols if c in df.columns})


def flag_active(df: DataFrame, col: str = "is_active") -> DataFrame:
    """1 → true; 0, NULL and anything else → false."""
    return df.withColumn(col, F.coalesce(F.col(col) == 1, F.lit(False)))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """team_id → 0, is_active → false when missing."""
    defaults = dict(defaults or {"team_id": 0, "is_active": False})
    out = {}
    for c, v in defaults.items():
        if c not in df.columns:
            continue
        if isinstance(v, bool):
            out[c] = F.coalesce(F.col(c).cast("boolean"), F.lit(v))
        else:
            out[c] = F.coalesce(F.col(c), F.lit(v))
    return df.withColumns(out)


def valid_record(cols: Sequence[str] = ("player_id", "player_name", "team_id")) -> Column:
    """P5 predicate: all key columns present."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def flag_valid_record(df: DataFrame, drop_invalid: bool = True,
                      cols: Sequence[str] = ("player_id", "player_name", "team_id")) -> DataFrame:
    """P5: flag, and by default drop, records missing a key column."""
    if drop_invalid:
        return df.where(valid_record(cols))
    return df.withColumn("is_valid_record", valid_record(cols))


def flag_valid_etl(df: DataFrame) -> DataFrame:
    """Id and name present and id > 0; flags only."""
    ok = (F.col("player_id").isNotNull() & F.col("player_name").isNotNull()
          & F.coalesce(F.col("player_id") > 0, F.lit(False)))
    return df.withColumn("is_valid", ok)


def standardize_team(df: DataFrame, col: str = "team_name",
                     out: str = "standardized_team_name",
                     rules: Iterable[tuple[tuple[str, ...], str]] = TEAM_RULES) -> DataFrame:
    """Ordered, case-sensitive substring cascade; unmatched names pass through."""
    c = F.col(col)
    expr = None
    for patterns, name in rules:
        cond = None
        for p in patterns:
            hit = c.contains(p)
            cond = hit if cond is None else (cond | hit)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return df.withColumn(out, expr.otherwise(c) if expr is not None else c)


def standardize_name(df: DataFrame, col: str = "player_name",
                     out: str = "standardized_player_name") -> DataFrame:
    """P8: "Last, First" → "First Last"; parts after the second are dropped."""
    parts = F.split(F.col(col), ",")
    flipped = F.concat(strip_ws(F.get(parts, 1)), F.lit(" "), strip_ws(F.get(parts, 0)))
    return df.withColumn(out, F.when(F.col(col).contains(","), flipped).otherwise(F.col(col)))


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Non-numeric text → NULL, NaN → NULL; absent columns are skipped.

    Columns that are already numeric are only widened to DOUBLE (no text
    round trip); text columns go through ``try_cast``.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    out = {}
    for c in cols:
        if c not in types:
            continue
        if isinstance(types[c], NUMERIC_TYPES):
            out[c] = nan_to_null(F.col(c).cast("double"))
        else:
            out[c] = to_double(c)
    return df.withColumns(out)


def stamp(df: DataFrame, col: str, as_of: str | _dt.datetime = DEFAULT_AS_OF) -> DataFrame:
    """P10: processing timestamp column, fixed per run."""
    return df.withColumn(col, as_of_literal(as_of))


def alias_metrics(df: DataFrame, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Copy columns under the names downstream models expect."""
    mapping = dict(mapping or {"gp": "games_played", "min": "minutes_per_game"})
    return df.withColumns({new: F.col(old) for old, new in mapping.items() if old in df.columns})


def filter_active(df: DataFrame, col: str = "is_active") -> DataFrame:
    """Active players only."""
    return df.where(F.col(col) == F.lit(True))


def clean_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL, NaN and ±inf → 0."""
    return df.withColumns({c: zero_if_missing(c) for c in cols})


def clip_range(df: DataFrame, bounds: Mapping[str, tuple[float | None, float | None]],
               absolute: Sequence[str] = ()) -> DataFrame:
    """Absolute value for some columns, then clip others to ranges."""
    df = df.withColumns({c: F.abs(F.col(c)) for c in absolute})
    return df.withColumns({c: clamp(c, lo, hi) for c, (lo, hi) in bounds.items()})


def shooting_pcts(df: DataFrame, eps: float | None = None) -> DataFrame:
    """FG%, 3P%, FT% from makes and attempts (``eps`` added to attempts)."""
    out = {}
    for made, att, name in (("fgm", "fga", "fg_pct"), ("fg3m", "fg3a", "fg3_pct"),
                            ("ftm", "fta", "ft_pct")):
        den = F.col(att) + eps if eps else F.col(att)
        out[name] = F.try_divide(F.col(made), den)
    return df.withColumns(out)


NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns by schema (booleans, text, timestamps excluded); no job."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in skip]


def select_numeric(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    return df.select(*numeric_columns(df, exclude))


def filter_tier(df: DataFrame, tier: str = "Elite", tier_col: str = "performance_tier",
                cols: Sequence[str] | None = None, order_by: str = "pts") -> DataFrame:
    """P20: members of one tier, best scorer first."""
    out = df.where(F.col(tier_col) == tier)
    if cols:
        out = out.select(*cols)
    return out.orderBy(F.col(order_by).desc_nulls_last(), *[F.col(c) for c in out.columns if c.endswith("_id")])


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop names that exist; absent names are ignored."""
    return df.drop(*cols)


def project_contract(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Final column list and order of a model."""
    return df.select(*columns)


# ---------------------------------------------------------------- staging jobs

STAGED_PLAYER_COLUMNS = ("player_id", "player_name", "team_id", "team_name", "season",
                         "is_active", "data_loaded_at", "standardized_team_name",
                         "standardized_player_name")


def stage_players(players: DataFrame, as_of: str | _dt.datetime = DEFAULT_AS_OF) -> DataFrame:
    """Staged roster: cast, strip, active flag, drop invalid, standardise names."""
    df = stamp(players, "data_loaded_at", as_of)
    df = cast_ids(df)
    df = clean_names(df)
    df = flag_active(df)
    df = flag_valid_record(df, drop_invalid=True)
    df = standardize_team(df)
    df = standardize_name(df)
    return df.select(*STAGED_PLAYER_COLUMNS)


GAME_STATS = ("minutes", "fgm", "fga", "fg3m", "fg3a", "ftm", "fta", "pts", "reb", "ast",
              "stl", "blk", "tov", "plus_minus")


def stage_game_logs(game_logs: DataFrame) -> DataFrame:
    """Staged game logs: numeric stats, ``YYYY-YY`` season label, W/L flag kept."""
    df = game_logs
    if "season" not in df.columns and "season_start" in df.columns:
        df = df.withColumn("season", season_label("season_start"))
    return df


ADVANCED_NUMERIC = ("gp", "min", "off_rating", "def_rating", "net_rating", "ast_pct",
                    "reb_pct", "usg_pct", "ts_pct", "efg_pct", "pie")


def stage_advanced(advanced: DataFrame) -> DataFrame:
    """Staged advanced stats under the names the performance model reads."""
    return advanced.select(
        "player_id", "season",
        F.col("gp").alias("games_played_advanced"),
        F.col("min").alias("minutes_per_game_advanced"),
        F.col("off_rating").alias("offensive_rating"),
        F.col("def_rating").alias("defensive_rating"),
        "net_rating",
        F.col("ast_pct").alias("assist_percentage"),
        F.col("reb_pct").alias("rebound_percentage"),
        F.col("usg_pct").alias("usage_rate"),
        F.col("ts_pct").alias("true_shooting_pct"),
        F.col("efg_pct").alias("effective_fg_pct"),
        F.col("pie").alias("player_impact_estimate"),
    )


def etl_players(players: DataFrame, as_of: str | _dt.datetime = DEFAULT_AS_OF) -> DataFrame:
    """ETL roster transform: strip names, fill defaults, validity flag, stamp."""
    df = clean_names(players)
    df = fill_defaults(df)
    df = flag_valid_etl(df)
    return stamp(df, "processed_at", as_of)
