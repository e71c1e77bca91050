"""Football tables derived from the supplied star-schema tables.

Each text runs unchanged in Spark SQL and in DuckDB, so the Spark operators and
the check SQL start from the same rows. Every view reads its tables whole.
Planted: unplayed matches, missing, negative, textual and impossible scores,
untrimmed and wrong-case names, repeated keys, orphans, unmapped teams.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

from touchline.catalog.scratch import scratch

AS_OF = "2001-12-31"
FIRST_SEASON, FIRST_DAY, LAST_DAY = 1995, "1995-03-01", "2001-06-30"
PERF_SINCE = "1996-01-01"
LINK_SINCE = "1995-06-01"
LAST_SEASON = 2020

_FEED_CODE = "CASE {c} % 5 WHEN 0 THEN 'PL' WHEN 1 THEN 'PD' WHEN 2 THEN 'SA' WHEN 3 THEN 'BL1' ELSE 'FL1' END"
_SNAP_CODE = "CASE {c} % 6 WHEN 0 THEN 'GB1' WHEN 1 THEN 'ES1' WHEN 2 THEN 'IT1' WHEN 3 THEN 'L1' WHEN 4 THEN 'FR1' ELSE 'CL' END"
_AWAY = "(c_nationkey + 5*(1 + o_orderkey % 4)) % 25"
_HOME_GOALS = "CAST(o_orderkey % 5 AS INT)"
_AWAY_GOALS = "CAST(floor((o_orderkey % 20) / 5.0) AS INT)"

SQL: dict[str, str] = {}

SQL["fx_feed"] = f"""
SELECT CASE WHEN o_orderkey % 50 = 1 THEN o_orderkey - 1 ELSE o_orderkey END AS game_id,
  {_FEED_CODE.format(c='c_nationkey')} AS competition_id,
  concat('League ', {_FEED_CODE.format(c='c_nationkey')}) AS competition_name,
  CAST(year(o_orderdate) AS INT) AS season,
  CAST(o_orderdate AS DATE) AS date,
  CAST(o_orderkey % 38 + 1 AS INT) AS round,
  concat('  Team ', CAST(c_nationkey AS STRING), ' FC') AS home_club_name,
  concat('TEAM ', CAST({_AWAY} AS STRING), ' fc') AS away_club_name,
  CAST(c_nationkey AS BIGINT) AS home_club_id,
  CAST({_AWAY} AS BIGINT) AS away_club_id,
  CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 211 = 0 THEN -1 ELSE {_HOME_GOALS} END AS home_club_goals,
  {_AWAY_GOALS} AS away_club_goals,
  CASE WHEN o_orderstatus = 'P' THEN 'SCHEDULED' ELSE 'FINISHED' END AS status
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
"""

# A third of the season rows is played one day later than in the feed.
SQL["fx_season"] = f"""
SELECT competition, season,
  CASE WHEN k % 151 = 0 THEN 'postponed'
    WHEN k % 4 = 0 THEN concat(substr(d, 9, 2), '/', substr(d, 6, 2), '/', substr(d, 1, 4))
    WHEN k % 4 = 1 THEN concat(substr(d, 9, 2), '/', substr(d, 6, 2), '/', substr(d, 3, 2))
    WHEN k % 4 = 2 THEN d
    ELSE concat(CAST(CAST(substr(d, 9, 2) AS INT) AS STRING), '/', CAST(CAST(substr(d, 6, 2) AS INT) AS STRING), '/', substr(d, 1, 4)) END AS date_raw,
  home_raw, away_raw,
  CASE WHEN k % 103 = 0 THEN 'abd' WHEN k % 107 = 0 THEN NULL ELSE CAST(hg AS STRING) END AS fthg,
  CAST(ag AS STRING) AS ftag,
  CASE WHEN hg > ag THEN 'H' WHEN ag > hg THEN 'A' ELSE 'D' END AS ftr,
  CAST(k % 17 AS STRING) AS s_hs, CAST(k % 13 AS STRING) AS s_as,
  CAST(k % 9 AS STRING) AS s_hst, CAST(k % 7 AS STRING) AS s_ast,
  CAST(k % 11 AS STRING) AS s_hc, CAST(k % 10 AS STRING) AS s_ac,
  CAST(k % 5 AS STRING) AS s_hy, CAST(k % 6 AS STRING) AS s_ay,
  CASE WHEN k % 31 = 0 THEN NULL ELSE CAST(k % 2 AS STRING) END AS s_hr, CAST(k % 3 AS STRING) AS s_ar
FROM (
  SELECT o_orderkey AS k, {_FEED_CODE.format(c='c_nationkey')} AS competition,
    CAST(year(o_orderdate) AS INT) AS season,
    CAST(CAST(date_add(CAST(o_orderdate AS DATE), CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END) AS DATE) AS STRING) AS d,
    concat('Team ', CAST(c_nationkey AS STRING)) AS home_raw,
    concat('Team ', CAST({_AWAY} AS STRING)) AS away_raw,
    {_HOME_GOALS} + CASE WHEN o_orderkey % 97 = 0 THEN 1 ELSE 0 END AS hg,
    CASE WHEN o_orderkey % 89 = 0 THEN 25 ELSE {_AWAY_GOALS} END AS ag
  FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
) season_rows
"""

SQL["fx_aliases"] = """
SELECT concat('Team ', CAST(n_nationkey AS STRING), ' FC') AS alias, concat('Team ', CAST(n_nationkey AS STRING)) AS canonical
FROM {nation} WHERE n_nationkey <> 24
UNION ALL
SELECT concat('Team ', CAST(n_nationkey AS STRING)) AS alias, concat('Team ', CAST(n_nationkey AS STRING)) AS canonical
FROM {nation} WHERE n_nationkey <> 24
"""

SQL["fx_players"] = f"""
SELECT CASE WHEN p_partkey % 97 = 1 THEN p_partkey + 1 ELSE p_partkey END AS player_id,
  concat(p_name, ' ', CAST(p_partkey AS STRING)) AS name,
  CAST(date_add(DATE '1972-01-01', CAST((p_partkey * 37) % 4700 AS INT)) AS DATE) AS date_of_birth,
  CASE p_size % 5 WHEN 0 THEN 'Attack' WHEN 1 THEN 'Midfield' WHEN 2 THEN 'Defender' WHEN 3 THEN 'Goalkeeper' ELSE 'Missing' END AS position,
  CASE p_partkey % 4 WHEN 0 THEN 'left' WHEN 1 THEN 'right' WHEN 2 THEN 'both' ELSE NULL END AS foot,
  CAST(165 + p_size % 35 AS INT) AS height_in_cm,
  CASE WHEN p_partkey % 61 = 0 THEN 'Türkiye' WHEN p_partkey % 67 = 0 THEN 'Turkey' WHEN p_partkey % 71 = 0 THEN NULL ELSE p_brand END AS country_of_citizenship,
  p_partkey % 10 + 1 AS current_club_id,
  concat('team ', CAST(p_partkey % 30 AS STRING), ' FC ') AS current_club_name,
  {_SNAP_CODE.format(c='p_partkey')} AS current_club_domestic_competition_id,
  CAST(2016 + p_partkey % 10 AS INT) AS last_season,
  CASE WHEN p_partkey % 19 = 0 THEN NULL WHEN p_partkey % 53 = 0 THEN -1.0e0 ELSE CAST((p_partkey * 7919) % 40000 * 1000 AS DOUBLE) END AS market_value_in_eur,
  CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE CAST((p_partkey * 7919) % 40000 * 1500 AS DOUBLE) END AS highest_market_value_in_eur,
  CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE CAST(p_partkey % 41 AS INT) END AS international_caps,
  CAST(p_partkey % 7 AS INT) AS international_goals
FROM {{part}}
"""

SQL["fx_appearances"] = f"""
SELECT concat(CAST(l_orderkey AS STRING), '_', CAST(l_linenumber AS STRING)) AS appearance_id,
  l_orderkey AS game_id, l_partkey AS player_id, l_suppkey AS player_club_id,
  CAST(l_shipdate AS DATE) AS date,
  concat('Player ', CAST(l_partkey AS STRING)) AS player_name,
  {_SNAP_CODE.format(c='l_suppkey')} AS competition_id,
  CAST(CASE WHEN l_quantity = 50 THEN -1 WHEN l_quantity = 49 THEN NULL ELSE CAST(l_quantity AS INT) % 4 END AS INT) AS goals,
  CAST(l_linenumber % 3 AS INT) AS assists,
  CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INT) AS yellow_cards,
  CAST(CASE WHEN l_quantity = 1 OR l_quantity = 17 THEN 1 ELSE 0 END AS INT) AS red_cards,
  CAST(CASE WHEN l_quantity < 4 THEN 0 ELSE l_quantity * 2 + 21 END AS INT) AS minutes_played
FROM {{lineitem}}
"""

SQL["fx_valuations"] = """
SELECT l_partkey AS player_id,
  CAST(date_add(CAST(l_shipdate AS DATE), CAST(l_linenumber * 5 AS INT)) AS DATE) AS date,
  CASE WHEN l_quantity = 3 THEN -1.0e0 WHEN l_quantity = 7 THEN NULL ELSE round(l_extendedprice * 100, 0) END AS market_value_in_eur
FROM {lineitem}
"""

SQL["fx_clubs"] = f"""
SELECT s_suppkey AS club_id, concat('Team ', CAST(s_suppkey % 30 AS STRING), ' FC') AS name,
  {_SNAP_CODE.format(c='s_nationkey')} AS domestic_competition_id
FROM {{supplier}}
"""

SQL["fx_transfers"] = """
SELECT l_partkey AS player_id,
  CAST(date_add(CAST(l_shipdate AS DATE), CAST(l_linenumber * 30 AS INT)) AS DATE) AS transfer_date,
  l_suppkey AS from_club_id, (l_suppkey * 7 + 3) % 10 AS to_club_id,
  CASE WHEN l_discount = 0 THEN -1.0e0 ELSE round(l_extendedprice * 50, 0) END AS transfer_fee
FROM {lineitem}
"""

SQL["fx_games"] = f"""
SELECT o_orderkey AS game_id, {_SNAP_CODE.format(c='o_orderkey')} AS competition_id,
  CAST(o_orderdate AS DATE) AS date,
  concat('Team ', CAST(c_nationkey AS STRING), ' FC') AS home_club_name,
  concat('team ', CAST({_AWAY} AS STRING)) AS away_club_name,
  {_HOME_GOALS} AS home_club_goals, {_AWAY_GOALS} AS away_club_goals
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
"""

SQL["fx_predictions"] = """
SELECT p_partkey AS player_id, concat(p_name, ' ', CAST(p_partkey AS STRING)) AS name,
  CASE p_size % 4 WHEN 0 THEN 'Attack' WHEN 1 THEN 'Midfield' WHEN 2 THEN 'Defender' ELSE 'Goalkeeper' END AS position,
  CAST(14 + p_partkey % 12 AS INT) AS age_actuel,
  concat('Team ', CAST(p_partkey % 30 AS STRING)) AS current_club_name,
  CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE CAST((p_partkey * 7919) % 40000 * 1000 AS DOUBLE) END AS valeur_actuelle,
  CAST((p_partkey * 104729) % 70000 * 1000 AS DOUBLE) AS valeur_projetee,
  round(CAST(p_partkey % 50 AS DOUBLE) / 64, 4) AS goals_per_90_jeune,
  round(CAST(p_partkey % 20 AS DOUBLE) / 64, 4) AS assists_per_90_jeune,
  CAST(p_partkey % 90 + 1 AS BIGINT) AS matchs_jeune,
  CAST((p_partkey * 31) % 3000 AS BIGINT) AS minutes_jeune,
  CAST((p_partkey * 17) % 1500 * 100000 AS DOUBLE) AS valeur_moyenne_club,
  'global' AS modele_utilise
FROM {part}
"""

_TABLES = ("orders", "customer", "lineitem", "part", "supplier", "nation")


def tables_of(text: str) -> list[str]:
    """Source tables a fixture text names."""
    return [name for _, name, _, _ in string.Formatter().parse(text) if name]


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture computed from the parquet tables of ``sf_dir``."""
    text = SQL[name]
    sources = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(tables_of(text))}
    df = spark.sql(text, **sources)
    return df.withColumnsRenamed(SEASON_COLUMNS) if name == "fx_season" else df


_stored: dict[tuple, str] = {}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture as a stored table, written below the shared checkpoint folder on first use.

    The operators then read it as they read any landed table: pruned columns
    and pushed filters, and none of the deriving arithmetic in their plans.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        path = scratch(spark, name)
        derive(spark, sf_dir, name).write.option("compression", "zstd").parquet(path)
        _stored[key] = path
    return spark.read.parquet(_stored[key])


SEASON_COLUMNS = {
    "date_raw": "Date", "home_raw": "HomeTeam", "away_raw": "AwayTeam", "fthg": "FTHG", "ftag": "FTAG", "ftr": "FTR",
    "s_hs": "HS", "s_as": "AS", "s_hst": "HST", "s_ast": "AST", "s_hc": "HC", "s_ac": "AC",
    "s_hy": "HY", "s_ay": "AY", "s_hr": "HR", "s_ar": "AR",
}


def duckdb_text(name: str) -> str:
    """The same fixture over the plain table names."""
    return SQL[name].format(**{t: t for t in _TABLES})
