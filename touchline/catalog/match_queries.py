"""Match queries: feed, season files, unification, league tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline import constants as C
from touchline.catalog import fixtures as fx
from touchline.catalog.registry import CTES, first_per_key, query, rnd
from touchline.catalog.scratch import scratch
from touchline.functions import columns as X
from touchline.operators import clean, names, quality, reports, stats
from touchline.operators import matches as M
from touchline.schemas import ENRICHED_MATCH, SEASON_REQUIRED, SEASON_STATS
from touchline.sources import readers
from touchline.streaming import incremental

STATS = ", ".join(SEASON_STATS.values())

# --- Spark side --------------------------------------------------------------


def feed(spark, sf):
    return fx.view(spark, sf, "fx_feed")


def aliases(spark, sf):
    return fx.view(spark, sf, "fx_aliases")


def feed_rows(spark, sf):
    return M.feed_for_union(feed(spark, sf), aliases(spark, sf))


def season_rows(spark, sf):
    return M.season_for_union(
        fx.view(spark, sf, "fx_season"), aliases(spark, sf), fx.FIRST_SEASON, fx.FIRST_DAY, fx.LAST_DAY
    )


def unified(spark, sf):
    return M.unify_matches(feed_rows(spark, sf), season_rows(spark, sf))


def league_table(spark, sf):
    return M.standings(M.with_points(unified(spark, sf)))


# --- check SQL ---------------------------------------------------------------

_RESULT = """CASE WHEN {h} > {a} THEN 'home' WHEN {a} > {h} THEN 'away' WHEN {h} = {a} THEN 'draw' ELSE 'unknown' END"""
_POINTS = "CAST(CASE WHEN result = '{side}' THEN 3 WHEN result = 'draw' THEN 1 ELSE 0 END AS INT)"
_ID = "substr(md5(concat(CAST(date AS VARCHAR), '_', competition, '_', home_team, '_', away_team)), 1, 16)"
_LABEL = "CASE {c} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.COMPETITION_LABELS.items())
_SNAPSHOT_CODE = "CASE {c} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.SNAPSHOT_COMPETITIONS.items()) + " END"

CTES["q_alias"] = "SELECT lower(trim(alias)) AS k, min(canonical) AS c FROM fx_aliases GROUP BY 1"

_FEED_COLUMNS = ("competition_id, competition_name, season, date, round, home_club_name, away_club_name,"
                 " home_club_id, away_club_id, home_club_goals, away_club_goals, status")
CTES["q_played"] = f"""
SELECT game_id, competition_id, competition_name, season, date, round, home_club_name, away_club_name,
  home_club_id, away_club_id,
  CASE WHEN home_club_goals >= 0 THEN home_club_goals END AS home_club_goals,
  CASE WHEN away_club_goals >= 0 THEN away_club_goals END AS away_club_goals,
  status, result, home_club_goals + away_club_goals AS total_goals,
  {_POINTS.format(side='home')} AS home_points, {_POINTS.format(side='away')} AS away_points
FROM (SELECT *, {_RESULT.format(h='home_club_goals', a='away_club_goals')} AS result
  FROM ({first_per_key('fx_feed', 'game_id', _FEED_COLUMNS)}) one WHERE status = 'FINISHED') m
"""

CTES["q_feed"] = f"""
SELECT {_ID} AS match_id, * FROM (
  SELECT 'api' AS source, competition_id AS competition, date, season, round,
    coalesce(h.c, trim(home_club_name)) AS home_team, coalesce(a.c, trim(away_club_name)) AS away_team,
    home_club_goals AS home_goals, away_club_goals AS away_goals
  FROM fx_feed LEFT JOIN q_alias h ON h.k = lower(trim(home_club_name))
    LEFT JOIN q_alias a ON a.k = lower(trim(away_club_name))
  WHERE status = 'FINISHED') f
"""

_DATE = """CASE WHEN regexp_full_match(date_raw, '\\d{1,2}/\\d{1,2}/\\d{4}') THEN CAST(try_strptime(date_raw, '%d/%m/%Y') AS DATE)
    WHEN regexp_full_match(date_raw, '\\d{1,2}/\\d{1,2}/\\d{2}') THEN CAST(try_strptime(date_raw, '%d/%m/%y') AS DATE)
    ELSE TRY_CAST(date_raw AS DATE) END"""
_RAW_STATS = {"HS": "s_hs", "AS": "s_as", "HST": "s_hst", "AST": "s_ast", "HC": "s_hc", "AC": "s_ac",
              "HY": "s_hy", "AY": "s_ay", "HR": "s_hr", "AR": "s_ar"}

CTES["q_season"] = f"""
SELECT {_ID} AS match_id, * FROM (
  SELECT 'football_datasets' AS source, competition, {_DATE} AS date, season, CAST(NULL AS INT) AS round,
    coalesce(h.c, trim(home_raw)) AS home_team, coalesce(a.c, trim(away_raw)) AS away_team,
    TRY_CAST(fthg AS INT) AS home_goals, TRY_CAST(ftag AS INT) AS away_goals,
    {', '.join(f'TRY_CAST({_RAW_STATS[s]} AS INT) AS {n}' for s, n in SEASON_STATS.items())}
  FROM fx_season LEFT JOIN q_alias h ON h.k = lower(trim(home_raw)) LEFT JOIN q_alias a ON a.k = lower(trim(away_raw))) s
WHERE season >= {fx.FIRST_SEASON} AND date BETWEEN DATE '{fx.FIRST_DAY}' AND DATE '{fx.LAST_DAY}'
  AND home_goals IS NOT NULL AND away_goals IS NOT NULL
"""

CTES["q_both"] = f"""
SELECT *, {', '.join(f'CAST(NULL AS INT) AS {n}' for n in SEASON_STATS.values())} FROM q_feed
UNION ALL BY NAME SELECT * FROM q_season
"""
_UNIFIED_COLUMNS = f"source, competition, date, season, round, home_team, away_team, home_goals, away_goals, {STATS}"
CTES["q_unified"] = f"""
SELECT *, {_RESULT.format(h='home_goals', a='away_goals')} AS result, home_goals + away_goals AS total_goals
FROM ({first_per_key('q_both', 'match_id', _UNIFIED_COLUMNS, order="CASE source WHEN 'api' THEN 0 ELSE 1 END")}) u
WHERE home_goals BETWEEN 0 AND 20 AND away_goals BETWEEN 0 AND 20
"""
CTES["q_points"] = f"""
SELECT *, {_LABEL.format(c='competition')} ELSE competition END AS competition_name,
  {_POINTS.format(side='home')} AS home_points, {_POINTS.format(side='away')} AS away_points FROM q_unified
"""


def table_sql(source, keys, home, away, hg, ag, conceded=True):
    def side(clubs, win, lose, scored, got, pts):
        return (f"SELECT {keys}, {clubs}, {pts} AS pts, {scored} AS gf, {got} AS ga, result = '{win}' AS w,"
                f" result = 'draw' AS d, result = '{lose}' AS l FROM {source}")
    names_ = ", ".join(c.split(" AS ")[1] for c in home.split(", "))
    more = f", {rnd('ga / nullif(n, 0)', 2)} AS moy_buts_encaisses_par_match" if conceded else ""
    return f"""
SELECT {keys}, {names_}, n AS matchs_joues, pts AS points, gf AS buts_marques, ga AS buts_encaisses,
  w AS victoires, d AS nuls, l AS defaites, gf - ga AS diff_buts, {rnd('gf / nullif(n, 0)', 2)} AS moy_buts_par_match{more}
FROM (SELECT {keys}, {names_}, count(*) AS n, CAST(sum(pts) AS BIGINT) AS pts, CAST(sum(gf) AS BIGINT) AS gf,
    CAST(sum(ga) AS BIGINT) AS ga, count(*) FILTER (w) AS w, count(*) FILTER (d) AS d, count(*) FILTER (l) AS l
  FROM ({side(home, 'home', 'away', hg, ag, 'home_points')} UNION ALL {side(away, 'away', 'home', ag, hg, 'away_points')}) sides
  GROUP BY ALL) t
"""


CTES["q_table"] = table_sql("q_points", "competition, competition_name, season", "home_team AS club_name",
                            "away_team AS club_name", "home_goals", "away_goals")
_ORDER = "points DESC, diff_buts DESC, buts_marques DESC"


# --- sources -----------------------------------------------------------------


def feed_match(df):
    """A match as the feed nests it."""
    team = lambda side: F.struct(F.col(f"{side}_club_id").alias("id"), F.col(f"{side}_club_name").alias("name"))
    return F.struct(
        F.col("game_id").alias("id"),
        F.concat(F.col("date").cast("string"), F.lit("T15:00:00Z")).alias("utcDate"),
        "status", F.col("round").alias("matchday"),
        F.struct(F.concat(F.col("season").cast("string"), F.lit("-08-01")).alias("startDate")).alias("season"),
        team("home").alias("homeTeam"), team("away").alias("awayTeam"),
        F.struct(F.struct(F.col("home_club_goals").alias("home"), F.col("away_club_goals").alias("away"))
                 .alias("fullTime")).alias("score"),
    )


@query("read_match_feed", "SRC-1 PRJ-1", "SELECT * FROM fx_feed")
def _(spark, sf):
    """Feed documents written one per line, read back and flattened."""
    df = feed(spark, sf)
    match = feed_match(df)
    doc = F.struct(
        F.struct(F.col("competition_id").alias("code"), F.col("competition_name").alias("name")).alias("competition"),
        F.array(match).alias("matches"),
    )
    path = scratch(spark, "feed")
    df.select(doc.alias("d")).select("d.*").write.json(path)
    return readers.read_match_feed(spark, path, multi_line=False)


_CSV = ", ".join(f'{r} AS "{n}"' for r, n in fx.SEASON_COLUMNS.items())


@query("read_season_csv", "SRC-2 SC-4 ST-2", f"SELECT competition, season, {_CSV} FROM fx_season")
def _(spark, sf):
    """Season files written per league and season, read back by folder and file name."""
    folder = F.create_map(*[F.lit(x) for k, v in C.LEAGUE_FOLDERS.items() for x in (v, k)])
    yy = lambda y: F.lpad((y % 100).cast("string"), 2, "0")
    df = fx.view(spark, sf, "fx_season").withColumns({
        "league": folder[F.col("competition")],
        "file": F.concat(F.lit("season-"), yy(F.col("season")), yy(F.col("season") + 1), F.lit(".csv")),
    })
    path = scratch(spark, "seasons")
    out = df.drop("competition", "season").hint("rebalance", "league", "file")
    out.write.partitionBy("league", "file").option("header", True).csv(path)
    return readers.read_season_csv(spark, path, fx.FIRST_SEASON)


@query("competitions", "SRC-5", f"""
SELECT competition_id, competition_name, country, confederation, tier, nb_clubs, nb_matchs_saison, transfermarkt_id,
  football_data_id, n_matches FROM (VALUES {', '.join(f"({', '.join(repr(x) for x in row)})" for row in C.COMPETITIONS)})
  AS c(competition_id, competition_name, country, confederation, tier, nb_clubs, nb_matchs_saison, transfermarkt_id, football_data_id)
JOIN (SELECT competition AS competition_id, count(*) AS n_matches FROM q_unified GROUP BY 1) m USING (competition_id)
""")
def _(spark, sf):
    counts = unified(spark, sf).groupBy(F.col("competition").alias("competition_id")).agg(F.count(F.lit(1)).alias("n_matches"))
    return readers.competitions_dim(spark).join(counts, "competition_id")


# --- cleaning ----------------------------------------------------------------


@query("finished_matches", "FLT-1", "SELECT * FROM fx_feed WHERE status = 'FINISHED'")
def _(spark, sf):
    return clean.finished_only(feed(spark, sf))


@query("clean_matches", "FLT-1 PRJ-3 PRJ-5 PRJ-6 PRJ-7 WN-1", "SELECT * FROM q_played")
def _(spark, sf):
    return M.clean_matches(feed(spark, sf))


@query("season_dates", "SC-5", f"SELECT date_raw, {_DATE} AS date FROM fx_season")
def _(spark, sf):
    return fx.view(spark, sf, "fx_season").select(F.col("Date").alias("date_raw"), X.day_first_date("Date").alias("date"))


@query("season_codes", "SC-4", """
SELECT season, code, count(*) AS n FROM (SELECT year(o_orderdate) AS season,
  concat('season-', lpad(CAST(year(o_orderdate) % 100 AS VARCHAR), 2, '0'), lpad(CAST((year(o_orderdate) + 1) % 100 AS VARCHAR), 2, '0')) AS code
  FROM orders) o GROUP BY 1, 2
""")
def _(spark, sf):
    year = F.year("o_orderdate")
    yy = lambda y: F.lpad((y % 100).cast("string"), 2, "0")
    code = F.concat(F.lit("season-"), yy(year), yy(year + 1))
    df = spark.read.parquet(f"{sf}/orders.parquet").select(code.alias("code"))
    return df.groupBy(X.season_start_year("code").cast("bigint").alias("season"), "code").agg(F.count(F.lit(1)).alias("n"))


@query("season_scores", "SC-6 FLT-4", """
SELECT competition, season, home_raw AS home, away_raw AS away, TRY_CAST(fthg AS INT) AS home_goals, TRY_CAST(ftag AS INT) AS away_goals
FROM fx_season WHERE TRY_CAST(fthg AS INT) BETWEEN 0 AND 20 AND TRY_CAST(ftag AS INT) BETWEEN 0 AND 20
""")
def _(spark, sf):
    df = fx.view(spark, sf, "fx_season").select(
        "competition", "season", F.col("HomeTeam").alias("home"), F.col("AwayTeam").alias("away"),
        F.col("FTHG").alias("home_goals"), F.col("FTAG").alias("away_goals"))
    return clean.score_range(df)


@query("season_rows", "FLT-5 SC-5 SC-6 SRC-2", "SELECT * FROM q_season")
def _(spark, sf):
    return season_rows(spark, sf)


@query("top_league_games", "FLT-8", "SELECT * FROM fx_games WHERE competition_id IN ('GB1', 'ES1', 'IT1', 'L1', 'FR1')")
def _(spark, sf):
    return clean.in_leagues(fx.view(spark, sf, "fx_games"), list(C.SNAPSHOT_COMPETITIONS))


# --- names and keys -----------------------------------------------------------


@query("normalized_names", "SC-1", """
SELECT game_id, coalesce(h.c, trim(home_club_name)) AS home_team, coalesce(a.c, trim(away_club_name)) AS away_team
FROM fx_feed LEFT JOIN q_alias h ON h.k = lower(trim(home_club_name)) LEFT JOIN q_alias a ON a.k = lower(trim(away_club_name))
""")
def _(spark, sf):
    df = feed(spark, sf).select("game_id", "home_club_name", "away_club_name")
    df = names.normalize_team(df, aliases(spark, sf), {"home_club_name": "home_team", "away_club_name": "away_team"})
    return df.select("game_id", "home_team", "away_team")


@query("match_ids", "SC-2", """
SELECT game_id, substr(md5(concat(CAST(date AS VARCHAR), '_', competition_id, '_', home_club_name, '_', away_club_name)), 1, 16) AS match_id FROM fx_games
""")
def _(spark, sf):
    df = fx.view(spark, sf, "fx_games")
    return df.select("game_id", X.match_id("date", "home_club_name", "away_club_name", "competition_id").alias("match_id"))


@query("competition_codes", "SC-3 JN-10", f"""
SELECT game_id, competition_id, competition, {_LABEL.format(c='competition')} END AS competition_name, coalesce(competition, competition_id) AS code
FROM (SELECT game_id, competition_id, {_SNAPSHOT_CODE.format(c='competition_id')} AS competition FROM fx_games) g
""")
def _(spark, sf):
    df = fx.view(spark, sf, "fx_games").select("game_id", "competition_id", X.competition_code("competition_id").alias("competition"))
    return df.withColumns({
        "competition_name": X.competition_label("competition"),
        "code": X.competition_code("competition_id", default="competition_id"),
    })


_NAMES = """
SELECT home_club_name AS name FROM fx_feed UNION SELECT away_club_name FROM fx_feed UNION SELECT home_raw FROM fx_season
UNION SELECT away_raw FROM fx_season UNION SELECT home_club_name FROM fx_games UNION SELECT away_club_name FROM fx_games
"""


def every_name(spark, sf):
    club = ["home_club_name", "away_club_name"]
    return names.all_names(
        (feed(spark, sf), club), (fx.view(spark, sf, "fx_season"), ["HomeTeam", "AwayTeam"]), (fx.view(spark, sf, "fx_games"), club)
    )


@query("all_team_names", "ST-3", _NAMES)
def _(spark, sf):
    return every_name(spark, sf)


@query("unmapped_names", "DQ-7", f"SELECT name FROM ({_NAMES}) n WHERE lower(trim(name)) NOT IN (SELECT k FROM q_alias)")
def _(spark, sf):
    return names.unmapped_names(every_name(spark, sf), aliases(spark, sf))


@query("name_overlap", "DQ-13 ST-5 JN-9", """
SELECT name, bool_or(a) AS in_a, bool_or(b) AS in_b FROM (
  SELECT trim(home_club_name) AS name, true AS a, false AS b FROM fx_feed UNION SELECT home_raw, false, true FROM fx_season) n GROUP BY 1
""")
def _(spark, sf):
    a = feed(spark, sf).select(names.trimmed("home_club_name").alias("name"))
    b = fx.view(spark, sf, "fx_season").select(F.col("HomeTeam").alias("name"))
    return quality.name_overlap(a, b)


# --- unified matches ----------------------------------------------------------


@query("unified_matches", "ST-2 WN-2 FLT-4 SC-1 SC-2 PRJ-5 PRJ-6", "SELECT * FROM q_unified")
def _(spark, sf):
    return unified(spark, sf)


@query("score_conflicts", "JN-6", """
SELECT u.match_id, u.home_team, u.away_team, u.home_goals AS api_hg, u.away_goals AS api_ag, s.home_goals AS fd_hg, s.away_goals AS fd_ag
FROM q_unified u JOIN q_season s ON s.match_id = u.match_id
WHERE u.source = 'api' AND (u.home_goals <> s.home_goals OR u.away_goals <> s.away_goals)
""")
def _(spark, sf):
    return M.score_conflicts(unified(spark, sf), season_rows(spark, sf))


@query("matches_in_both", "JN-8", "SELECT f.* FROM q_feed f WHERE match_id IN (SELECT match_id FROM q_season)")
def _(spark, sf):
    return M.common_ids(feed_rows(spark, sf), season_rows(spark, sf))


@query("common_match_ids", "ST-4", "SELECT match_id FROM q_feed INTERSECT SELECT match_id FROM q_season")
def _(spark, sf):
    return M.keys_by_side(feed_rows(spark, sf), season_rows(spark, sf)).filter("in_a and in_b").select("match_id")


@query("season_only_ids", "ST-5", "SELECT match_id FROM q_season EXCEPT SELECT match_id FROM q_feed")
def _(spark, sf):
    return M.keys_by_side(season_rows(spark, sf), feed_rows(spark, sf)).filter("in_a and not in_b").select("match_id")


@query("season_only_matches", "JN-9", "SELECT s.* FROM q_season s WHERE match_id NOT IN (SELECT match_id FROM q_feed)")
def _(spark, sf):
    return quality.only_in(season_rows(spark, sf), feed_rows(spark, sf), "match_id")


@query("enriched_matches", "PRJ-7 PRJ-8 JN-10", f"SELECT {', '.join(ENRICHED_MATCH)} FROM q_points")
def _(spark, sf):
    return M.select_enriched(M.with_points(unified(spark, sf)))


# --- league tables ------------------------------------------------------------


@query("standings", "AG-1 ST-1", "SELECT * FROM q_table")
def _(spark, sf):
    return league_table(spark, sf)


@query("standings_by_club_id", "AG-1 ST-1", table_sql(
    "q_played", "competition_id, competition_name, season", "home_club_id AS club_id, home_club_name AS club_name",
    "away_club_id AS club_id, away_club_name AS club_name", "home_club_goals", "away_club_goals", conceded=False))
def _(spark, sf):
    return M.standings_by_club_id(M.clean_matches(feed(spark, sf)))


@query("league_positions", "TK-1", f"""
SELECT *, CAST(row_number() OVER (PARTITION BY competition, season ORDER BY {_ORDER}, club_name) AS INT) AS position FROM q_table
""")
def _(spark, sf):
    return M.sort_standings(M.league_positions(league_table(spark, sf)))


@query("home_advantage", "AG-2", f"""
SELECT competition, competition_name, season, n AS total_matchs, h AS victoires_domicile, a AS victoires_exterieur, d AS nuls,
  {rnd('h * 100.0 / n', 1)} AS pct_victoires_domicile, {rnd('tg', 2)} AS moy_buts_par_match,
  {rnd('hg', 2)} AS moy_buts_domicile, {rnd('ag', 2)} AS moy_buts_exterieur
FROM (SELECT competition, competition_name, season, count(*) AS n, count(*) FILTER (result = 'home') AS h,
    count(*) FILTER (result = 'away') AS a, count(*) FILTER (result = 'draw') AS d,
    avg(total_goals) AS tg, avg(home_goals) AS hg, avg(away_goals) AS ag FROM q_points GROUP BY ALL) s
""")
def _(spark, sf):
    return M.home_advantage(M.with_points(unified(spark, sf)))


@query("latest_table_head", "TK-7", f"""
SELECT club_name, points, victoires, diff_buts FROM q_table WHERE competition = 'PL' AND season = 2000
ORDER BY {_ORDER}, club_name LIMIT 10
""")
def _(spark, sf):
    return reports.season_table(league_table(spark, sf), "PL", 2000, 10).select("club_name", "points", "victoires", "diff_buts")


@query("season_standings", "BI-1", "SELECT * FROM q_table WHERE competition = 'SA' AND season = 1999")
def _(spark, sf):
    return reports.season_table(league_table(spark, sf), "SA", 1999)


@query("best_attacks", "BI-1", "SELECT * FROM q_table ORDER BY moy_buts_par_match DESC, buts_marques DESC, competition, season, club_name LIMIT 10")
def _(spark, sf):
    return reports.best_attacks(league_table(spark, sf))


@query("best_defences", "BI-1", "SELECT * FROM q_table ORDER BY moy_buts_encaisses_par_match, buts_encaisses, competition, season, club_name LIMIT 10")
def _(spark, sf):
    return reports.best_defences(league_table(spark, sf))


# --- statistics ---------------------------------------------------------------


@query("home_advantage_test", "AG-14", f"""
SELECT n, {rnd('a', 3)} AS mean_a, {rnd('b', 3)} AS mean_b, {rnd('gap', 3)} AS gap, {rnd('gap / (sd / sqrt(n))', 4)} AS t_stat,
  {rnd('won * 100', 1)} AS a_larger_pct, abs(gap / (sd / sqrt(n))) > 1.96 AS rejected
FROM (SELECT count(*) AS n, avg(home_goals) AS a, avg(away_goals) AS b, avg(home_goals - away_goals) AS gap,
  stddev_samp(home_goals - away_goals) AS sd, avg(CAST(home_goals > away_goals AS INT)) AS won FROM q_unified) s
""")
def _(spark, sf):
    return stats.paired_t_test(unified(spark, sf)).drop("p_value")


# The incomplete beta function by its continued fraction, on one row.
@query("home_advantage_p_value", "AG-14", """
SELECT * FROM (WITH RECURSIVE s AS (SELECT count(*) AS n, avg(home_goals - away_goals) / (stddev_samp(home_goals - away_goals) / sqrt(count(*))) AS t FROM q_unified),
a AS (SELECT n, t, (n - 1) / 2.0 AS p, CAST(0.5 AS DOUBLE) AS q, (n - 1) / (n - 1 + t * t) AS x FROM s),
b AS (SELECT *, x < (p + 1) / (p + 2.5) AS direct,
  exp(lgamma(p + 0.5) - lgamma(p) - lgamma(0.5) + p * ln(x) + q * ln(1 - x)) AS front FROM a),
u AS (SELECT n, front, direct, CASE WHEN direct THEN p ELSE q END AS p, CASE WHEN direct THEN q ELSE p END AS q, CASE WHEN direct THEN x ELSE 1 - x END AS x FROM b),
f AS (
  SELECT 0 AS m, p, q, x, CAST(1 AS DOUBLE) AS c, 1 / (1 - (p + q) * x / (p + 1)) AS d, 1 / (1 - (p + q) * x / (p + 1)) AS h FROM u
  UNION ALL
  SELECT m + 1, p, q, x, 1 + o / c1, 1 / (1 + o * d1), h * d1 * c1 * (1 + o / c1) / (1 + o * d1)
  FROM (SELECT *, 1 / (1 + e * d) AS d1, 1 + e / c AS c1 FROM (
    SELECT *, (m + 1) * (q - (m + 1)) * x / ((p + 2 * (m + 1) - 1) * (p + 2 * (m + 1))) AS e,
      -(p + m + 1) * (p + q + m + 1) * x / ((p + 2 * (m + 1)) * (p + 2 * (m + 1) + 1)) AS o FROM f WHERE m < 1000) g) k)
SELECT u.n, round(CASE WHEN direct THEN front * h / u.p ELSE 1 - front * h / u.p END, 9) AS p_value FROM u, f WHERE m = 1000) r
""")
def _(spark, sf):
    return stats.paired_t_test(unified(spark, sf)).select("n", F.round("p_value", 9).alias("p_value"))


@query("matches_by_source", "AG-9", "SELECT source, count(*) AS n FROM q_unified GROUP BY 1")
def _(spark, sf):
    return stats.value_counts(unified(spark, sf), "source")


@query("match_date_span", "AG-11", """
SELECT min(date) AS first_day, max(date) AS last_day, string_agg(DISTINCT CAST(season AS VARCHAR), ',' ORDER BY CAST(season AS VARCHAR)) AS seasons FROM q_unified
""")
def _(spark, sf):
    return stats.date_span(unified(spark, sf)).withColumn("seasons", F.array_join("seasons", ","))


# --- incremental --------------------------------------------------------------

# Every file is landed once; those of two leagues are landed again, with other scores, moved, cancelled and withdrawn
# matches, and some without any match left.
_FILE = "concat(competition_id, '_', CAST(season AS STRING), '_', CAST(game_id % 4 AS STRING))"
LANDED = f"""
SELECT 0 AS landing, {_FILE} AS file, game_id, competition_id, competition_name, season, date, round, home_club_name, away_club_name,
  home_club_goals, away_club_goals, status FROM {{fx_feed}}
UNION ALL
SELECT 1 AS landing, {_FILE} AS file, game_id, competition_id, competition_name, season,
  CAST(date_add(date, CASE WHEN game_id % 11 = 5 THEN 1 ELSE 0 END) AS DATE) AS date, round, home_club_name, away_club_name,
  CAST((home_club_goals + 3) % 7 AS INT) AS home_club_goals, away_club_goals, CASE WHEN game_id % 13 = 6 THEN 'CANCELLED' ELSE status END AS status
FROM {{fx_feed}} WHERE competition_id IN ('PL', 'PD') AND game_id % 7 <> 3 AND NOT (competition_id = 'PD' AND game_id % 4 = 3)
"""
CTES["q_landed"] = LANDED.format(fx_feed="fx_feed")
CTES["q_newest"] = f"""
SELECT {_ID} AS match_id, * FROM (
  SELECT 'api' AS source, competition_id AS competition, date, season, round,
    coalesce(h.c, trim(home_club_name)) AS home_team, coalesce(a.c, trim(away_club_name)) AS away_team,
    home_club_goals AS home_goals, away_club_goals AS away_goals
  FROM q_landed LEFT JOIN q_alias h ON h.k = lower(trim(home_club_name)) LEFT JOIN q_alias a ON a.k = lower(trim(away_club_name))
  WHERE status = 'FINISHED' AND landing = CASE WHEN competition_id IN ('PL', 'PD') THEN 1 ELSE 0 END) f
"""
CTES["q_newest_best"] = f"""
SELECT *, {_LABEL.format(c='competition')} ELSE competition END AS competition_name,
  {_POINTS.format(side='home')} AS home_points, {_POINTS.format(side='away')} AS away_points
FROM (SELECT *, {_RESULT.format(h='home_goals', a='away_goals')} AS result
  FROM ({first_per_key('q_newest', 'competition, season, match_id', 'source, date, round, home_team, away_team, home_goals, away_goals')}) u
  WHERE home_goals BETWEEN 0 AND 20 AND away_goals BETWEEN 0 AND 20) r
"""


@query("incremental_standings", "SS-1", table_sql(
    "q_newest_best", "competition, competition_name, season", "home_team AS club_name", "away_team AS club_name", "home_goals", "away_goals"))
def _(spark, sf):
    """Files are landed in two batches, those of two leagues in both; the newest version of each file counts. A third run finds nothing new."""
    landed = spark.sql(LANDED, fx_feed=feed(spark, sf))
    match = F.struct(
        F.col("game_id").alias("id"), F.col("date").cast("string").alias("utcDate"), "status",
        F.col("round").alias("matchday"), F.struct(F.col("season").cast("string").alias("startDate")).alias("season"),
        F.struct(F.col("home_club_name").alias("name")).alias("homeTeam"),
        F.struct(F.col("away_club_name").alias("name")).alias("awayTeam"),
        F.struct(F.struct(F.col("home_club_goals").alias("home"), F.col("away_club_goals").alias("away")).alias("fullTime")).alias("score"))
    path = scratch(spark, "stream")
    known = landed.filter("landing = 0").select("file", "competition_id", "competition_name").distinct()
    for landing, files in ((0, known), (1, known.filter(F.col("competition_id").isin("PL", "PD"))), (2, None)):
        if files is not None:
            listed = landed.filter(F.col("landing") == landing).groupBy("file", F.col("game_id") % 1000).agg(F.collect_list(match).alias("matches"))
            empty = F.array().cast(listed.schema["matches"].dataType)
            docs = files.join(listed.select("file", "matches"), "file", "left").select(
                "file", F.struct(F.col("competition_id").alias("code"), F.col("competition_name").alias("name")).alias("competition"),
                F.coalesce("matches", empty).alias("matches"))
            docs.hint("rebalance", "file").write.partitionBy("file").json(f"{path}/feed/{landing}")
        incremental.incremental_matches(
            spark, f"{path}/feed", f"{path}/store", f"{path}/checkpoint", aliases(spark, sf), multi_line=False, file_pattern=r"/file=([^/]+)/")
    return incremental.current_standings(spark, f"{path}/store")
