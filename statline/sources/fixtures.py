"""Box-score tables derived from the driver's TPC-H-style test tables.

``part`` plays the player, its brand the team, a line item one game. The
statements are plain SQL that runs unchanged in Spark SQL and DuckDB, so the
same text builds the Spark inputs (through ``spark.sql`` with DataFrame
arguments) and the CTE prefix of every DuckDB oracle query. Nothing is
collected: each fixture is a lazy DataFrame over the whole base tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# The derivation statements (placeholders in braces name the
# base table or an earlier fixture).
FIXTURE_SQL: dict[str, str] = {
    "players": """
select p_partkey as player_id,
  case when p_partkey % 97 = 5 then null
       when p_partkey % 3 = 0 then '  ' || replace(p_name, ' ', ', ') || ' '
       else p_name end as player_name,
  cast(replace(p_brand, 'Brand#', '') as bigint) as team_id,
  case cast(replace(p_brand, 'Brand#', '') as bigint)
       when 1 then 'Lakers ' when 2 then 'GSW' when 3 then 'Celtics' when 4 then 'MIA' when 5 then 'Nets'
       else p_brand end as team_name,
  '2000-01' as season,
  case when p_partkey % 10 = 9 then 0 when p_partkey % 89 = 7 then null else 1 end as is_active
from {part}
""",
    "rosters": """
select player_id, player_name, case when (player_id + k) % 4 = 0 then team_id % 25 + 1 else team_id end as team_id,
  case when (player_id + k) % 4 = 0 then concat('Loan ', cast(team_id as string)) else team_name end as team_name,
  s.season as season, is_active
from {players} join (select 0 as k, '1995-96' as season union all select 1 as k, '1996-97' as season
  union all select 2 as k, '1997-98' as season) s on (player_id + k) % 5 <> 0
""",
    "game_logs": """
select l_partkey as player_id, l_orderkey as game_id, l_linenumber as game_line,
  cast(l_shipdate as date) as game_date,
  cast(case when month(l_shipdate) >= 10 then year(l_shipdate) else year(l_shipdate) - 1 end as bigint) as season_start,
  case l_linestatus when 'F' then 'W' else 'L' end as wl,
  8E0 + (l_partkey % 5) * 6 + l_tax * 100 as minutes,
  4 + l_quantity / 4 as fga,
  (4 + l_quantity / 4) * (0.35E0 + l_discount) as fgm,
  case when l_partkey % 11 = 0 then 0E0 else l_quantity / 8 end as fg3a,
  case when l_partkey % 11 = 0 then 0E0 else l_quantity / 8 * (0.25E0 + l_tax * 2) end as fg3m,
  l_linenumber * 1E0 as fta,
  l_linenumber * (0.6E0 + l_tax * 4) as ftm,
  l_quantity * p_size / 50 as pts,
  l_linenumber * ((l_partkey % 9) + 1) / 3E0 as reb,
  l_discount * 100 * ((l_partkey % 7) + 1) / 5 as ast,
  l_tax * 25 as stl,
  l_discount * 20 as blk,
  l_linenumber / 2E0 as tov,
  l_extendedprice / 10000 - 3 as plus_minus
from {lineitem} join {part} on l_partkey = p_partkey
""",
    "advanced_stats": """
select player_id,
  concat(cast(season_start as string), '-', lpad(cast((season_start + 1) % 100 as string), 2, '0')) as season,
  'Regular Season' as season_type, count(*) as gp, avg(minutes) as min,
  105 + avg(plus_minus) as off_rating, 105 - avg(plus_minus) as def_rating, 2 * avg(plus_minus) as net_rating,
  avg(ast) * 2 as ast_pct, avg(reb) * 1.5E0 as reb_pct,
  sum(fga + 0.44E0 * fta + tov) / sum(minutes) * 48 as usg_pct,
  sum(pts) / (2 * sum(fga + 0.44E0 * fta)) as ts_pct,
  sum(fgm + 0.5E0 * fg3m) / sum(fga) as efg_pct,
  avg(pts + reb + ast) / 3 as pie
from {game_logs} where player_id % 10 <> 4
group by player_id, season_start
""",
    "statlines": """
select player_id,
  concat(cast(season_start as string), '-', lpad(cast((season_start + 1) % 100 as string), 2, '0')) as season,
  count(*) as games, avg(minutes) as min, avg(pts) as pts, avg(reb) as reb, avg(ast) as ast,
  avg(fgm) as fgm, avg(fga) as fga, avg(fg3m) as fg3m, avg(fg3a) as fg3a, avg(ftm) as ftm, avg(fta) as fta,
  avg(stl) as stl, avg(blk) as blk, avg(tov) as tov, avg(plus_minus) as plus_minus,
  sum(fgm) / sum(fga) as fg_pct
from {game_logs} group by player_id, season_start
""",
    "arrivals": """
select event_id, user_id as player_id, event_type as team_name, value as pts, ts as data_loaded_at,
  cast(date_trunc('day', ts) as date) as load_day
from {events}
""",
}

# Which base tables / earlier fixtures each statement reads, in build order.
FIXTURE_DEPS: dict[str, tuple[str, ...]] = {
    "players": ("part",),
    "rosters": ("players",),
    "game_logs": ("lineitem", "part"),
    "advanced_stats": ("game_logs",),
    "statlines": ("game_logs",),
    "arrivals": ("events",),
}

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One base table of the driver's test data."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@dataclass
class Fixtures:
    """Lazily derived fixture DataFrames over one scale-factor folder."""

    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        if name in self._cache:
            return self._cache[name]
        if name in FIXTURE_SQL:
            args = {dep: self.games_by_player if dep == "game_logs" else self.table(dep) for dep in FIXTURE_DEPS[name]}
            df = self.spark.sql(FIXTURE_SQL[name], **args)
        else:
            df = read_table(self.spark, self.sf_dir, name)
        self._cache[name] = df
        return df

    @property
    def games_by_player(self) -> DataFrame:
        """``game_logs`` for work by player: one shuffle of the narrow base rows serves the join and the grouping.

        A broadcast of ``part`` would leave the grouping to ship a partial state, many times as wide, for almost every
        game; a sort-merge join would sort all games for nothing.
        """
        return self.spark.sql(FIXTURE_SQL["game_logs"], lineitem=self.table("lineitem"), part=self.table("part").hint("shuffle_hash"))

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in FIXTURE_SQL and name not in BASE_TABLES:
            raise AttributeError(name)
        return self.table(name)


def fixtures(spark: SparkSession, sf_dir: str) -> Fixtures:
    return Fixtures(spark, sf_dir)


def _closure(names: tuple[str, ...]) -> list[str]:
    order: list[str] = []

    def visit(n: str) -> None:
        if n not in FIXTURE_SQL or n in order:
            return
        for dep in FIXTURE_DEPS[n]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    return order


def fixture_ctes(*names: str) -> str:
    """``WITH`` prefix defining the named fixtures (and what they read) for DuckDB."""
    order = _closure(names)
    if not order:
        return ""
    plain = {t: t for t in BASE_TABLES} | {n: n for n in FIXTURE_SQL}
    parts = [f"{n} AS ({FIXTURE_SQL[n].format(**plain).strip()})" for n in order]
    return "WITH " + ",\n".join(parts) + "\n"
