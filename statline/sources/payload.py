"""Landed API payloads → flat tables.

A payload is one JSON document ``{"parameters": {...}, "resultSets": [{"headers":
[...], "rowSet": [[...], ...]}]}`` whose rows are positional, mixed-type
arrays. The reader is given an explicit schema (no inference pass); every
cell is read as text and converted so that a malformed one becomes NULL
instead of failing the job; ``rejected_cells`` lists these with a reason, and
lines that are no document with them. Folders are laid out
``endpoint=<name>/season=<YYYY-YY>/`` so a backfill of any set of seasons
is one scan with partition pruning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAYLOAD_SCHEMA = T.StructType([
    T.StructField("parameters", T.MapType(T.StringType(), T.StringType())),
    T.StructField("resultSets", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("headers", T.ArrayType(T.StringType())),
        T.StructField("rowSet", T.ArrayType(T.ArrayType(T.StringType()))),
    ]))),
])

# Positional layout of each endpoint's rows (index → column, type).
PLAYER_LAYOUT = ((0, "player_id", "bigint"), (2, "player_name", "string"),
                 (7, "team_id", "bigint"), (8, "team_name", "string"), (1, "is_active", "int"))
GAME_LOG_LAYOUT = ((2, "game_date", "date"), (3, "matchup", "string"), (4, "wl", "string"),
                   (5, "minutes", "double"), (6, "fgm", "double"), (7, "fga", "double"),
                   (8, "fg_pct", "double"), (9, "fg3m", "double"), (10, "fg3a", "double"),
                   (11, "fg3_pct", "double"), (12, "ftm", "double"), (13, "fta", "double"),
                   (14, "ft_pct", "double"), (15, "oreb", "double"), (16, "dreb", "double"),
                   (17, "reb", "double"), (18, "ast", "double"), (19, "stl", "double"),
                   (20, "blk", "double"), (21, "tov", "double"), (22, "pf", "double"),
                   (23, "pts", "double"), (24, "plus_minus", "double"))
ADVANCED_LAYOUT = ((0, "player_id", "bigint"), (1, "player_name", "string"),
                   (2, "team_id", "bigint"), (3, "team_name", "string"), (4, "age", "double"),
                   (5, "gp", "bigint"), (6, "w", "double"), (7, "l", "double"),
                   (8, "w_pct", "double"), (9, "min", "double"), (10, "off_rating", "double"),
                   (11, "def_rating", "double"), (12, "net_rating", "double"),
                   (13, "ast_pct", "double"), (14, "ast_to", "double"),
                   (15, "ast_ratio", "double"), (16, "oreb_pct", "double"),
                   (17, "dreb_pct", "double"), (18, "reb_pct", "double"),
                   (19, "tov_pct", "double"), (20, "efg_pct", "double"),
                   (21, "ts_pct", "double"), (22, "usg_pct", "double"), (23, "pace", "double"),
                   (24, "pie", "double"))


#: Column that receives the text of a line that is no JSON document.
CORRUPT = "_corrupt_record"
# The second date format, as in ``APR 09, 2023``.
LONG_DATE = "MMM dd, yyyy"


def read_payloads(spark: SparkSession, path: str, corrupt: bool = False) -> DataFrame:
    """Landed payload documents (one JSON document per line) with the fixed schema.

    With ``corrupt`` lines that are no document come along as text in ``_corrupt_record``.
    """
    schema = T.StructType([*PAYLOAD_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())]) if corrupt else PAYLOAD_SCHEMA
    return spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)


def _number(cell: Column) -> Column:
    num = cell.try_cast("double")
    return F.when(F.isnan(num), None).otherwise(num)


def _value(cell: Column, typ: str) -> Column:
    """The text of a cell as ``typ``; what cannot be converted is NULL, never an error.

    Whole numbers are read from their text, so large ids keep every digit; only a text with a fraction or an exponent,
    such as ``12.0``, goes through a double, if its value is whole and a double holds it exactly.
    """
    if typ == "string":
        return cell
    if typ == "double":
        return _number(cell)
    if typ == "date":
        return F.coalesce(cell.try_cast("date"), F.try_to_timestamp(cell, F.lit(LONG_DATE)).cast("date"))
    num = _number(cell)
    whole = F.when((num % 1 == 0) & (F.abs(num) <= 2.0 ** 53), num.try_cast("bigint"))
    exact = F.coalesce(F.trim(cell).try_cast("bigint"), whole)
    return exact if typ == "bigint" else exact.try_cast(typ)


def _raw_cell(idx: int, name: str) -> Column:
    """A row's cell: where the document's headers list the column (upper case), at that place, else at the fixed position."""
    listed = F.array_position(F.col("__h"), name.upper())
    return F.get(F.col("__r"), F.when(listed > 0, listed - 1).otherwise(F.lit(idx)).cast("int"))


def _cell(idx: int, name: str, typ: str) -> Column:
    return _value(_raw_cell(idx, name), typ)


def _rows(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One output row per positional row of the first result set."""
    first = F.get(F.col("resultSets"), 0)
    return raw.select(*keep, "parameters", first.getField("headers").alias("__h"),
                      F.posexplode(first.getField("rowSet")).alias("__i", "__r"))


def rejected_cells(raw: DataFrame, layout: Sequence[tuple[int, str, str]], keep: Sequence[str] = ()) -> DataFrame:
    """Q10 for payloads: (keep…, row_number, column_name, cell, reason) of every cell that could not be converted.

    Reasons: ``not a date``, ``not a number``, ``not whole`` (an id with a fraction), ``out of range``. A null
    or empty cell is missing, not rejected. Lines that are no document (read with ``corrupt``) have reason
    ``corrupt document``, no column and their text as the cell. ``keep`` names columns of ``raw`` to carry along.
    """
    rows = _rows(raw, keep)
    checks = []
    for idx, name, typ in layout:
        if typ == "string":
            continue
        cell = _raw_cell(idx, name)
        number = cell.try_cast("double")
        if typ == "date":
            reason = F.lit("not a date")
        elif typ == "double":
            reason = F.lit("not a number")
        else:
            reason = (F.when(number.isNull() | F.isnan(number), "not a number")
                      .when(number % 1 != 0, "not whole").otherwise("out of range"))
        bad = cell.isNotNull() & (F.trim(cell) != "") & _value(cell, typ).isNull()
        checks.append(F.when(bad, F.struct(F.lit(name).alias("column_name"), cell.alias("cell"), reason.alias("reason"))))
    cells = rows.select(*keep, F.col("__i").cast("long").alias("row_number"),
                        F.inline(F.filter(F.array(*checks), lambda x: x.isNotNull())))
    if CORRUPT not in raw.columns:
        return cells
    # the reader refuses queries of the corrupt text alone, so the condition names a parsed column too
    parsed = F.coalesce(F.size("resultSets"), F.lit(-1)) >= -1
    lines = raw.where(F.col(CORRUPT).isNotNull() & parsed).select(
        *keep, F.lit(None).cast("long").alias("row_number"), F.lit(None).cast("string").alias("column_name"),
        F.col(CORRUPT).alias("cell"), F.lit("corrupt document").alias("reason"))
    return cells.unionByName(lines)


def decode_players(raw: DataFrame, season: str | None = None) -> DataFrame:
    """Roster rows; the season comes from the argument, the request or the path."""
    rows = _rows(raw, [c for c in ("season",) if c in raw.columns])
    season_col = (F.lit(season) if season else
                  F.coalesce(F.col("season") if "season" in raw.columns else F.lit(None),
                             F.col("parameters")["Season"]))
    cols = {n: _cell(i, n, t).alias(n) for i, n, t in PLAYER_LAYOUT}
    return rows.select(cols["player_id"], cols["player_name"], cols["team_id"],
                       cols["team_name"], season_col.alias("season"), cols["is_active"])


def decode_game_logs(raw: DataFrame) -> DataFrame:
    """Game rows; ``player_id`` comes from the request parameters of each document."""
    rows = _rows(raw)
    return rows.select(F.col("parameters")["PlayerID"].try_cast("bigint").alias("player_id"),
                       *[_cell(i, n, t).alias(n) for i, n, t in GAME_LOG_LAYOUT])


def decode_advanced(raw: DataFrame, season: str | None = None,
                    season_type: str | None = None) -> DataFrame:
    """S3: advanced rows plus season and season type from arguments or the request."""
    rows = _rows(raw)
    p = F.col("parameters")
    return rows.select(*[_cell(i, n, t).alias(n) for i, n, t in ADVANCED_LAYOUT],
                       (F.lit(season) if season else p["Season"]).alias("season"),
                       (F.lit(season_type) if season_type else p["SeasonType"]).alias("season_type"))


def collect_seasons(spark: SparkSession, raw_dir: str, seasons: Sequence[str] | None = None) -> dict:
    """Players and advanced stats for any set of seasons in one scan per endpoint.

    ``raw_dir`` holds ``endpoint=<name>/season=<YYYY-YY>/`` folders; the season
    filter prunes partitions before any file is opened.
    """
    schema = T.StructType(PAYLOAD_SCHEMA.fields + [T.StructField("season", T.StringType())])

    def load(endpoint: str) -> DataFrame:
        df = spark.read.schema(schema).json(f"{raw_dir.rstrip('/')}/endpoint={endpoint}")
        return df.where(F.col("season").isin(*seasons)) if seasons else df

    return {"players": decode_players(load("commonallplayers")),
            "advanced_stats": decode_advanced(load("leaguedashplayerstats"))}
