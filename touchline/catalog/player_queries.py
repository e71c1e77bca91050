"""Player queries: cleaned tables, performance, links, periods, features, scouting."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from touchline import constants as C
from touchline.catalog import fixtures as fx
from touchline.catalog import match_queries as mq
from touchline.catalog.registry import CTES, first_per_key, query, rnd
from touchline.catalog.scratch import scratch
from touchline.functions import columns as X
from touchline.operators import clean, dedup, features, models, periods, quality, reports, stats
from touchline.operators import matches as M
from touchline.operators import players as P
from touchline.plans import players as player_plan
from touchline.schemas import MART_INDEXES
from touchline.sources import indexed

# --- Spark side --------------------------------------------------------------


def raw(spark, sf, name):
    return fx.view(spark, sf, f"fx_{name}")


def players(spark, sf):
    return clean.clean_players(raw(spark, sf, "players"))


def performance(spark, sf):
    return player_plan.performance(raw(spark, sf, "appearances"), raw(spark, sf, "players"), fx.PERF_SINCE)


def appearances(spark, sf):
    return clean.clean_appearances(raw(spark, sf, "appearances"))


def valuations(spark, sf):
    return clean.clean_valuations(raw(spark, sf, "valuations"))


def youth(spark, sf):
    """As the projection plan: the linked appearances of the clean players, as recorded."""
    return P.youth_stats(recorded(spark, sf), players(spark, sf))


def predictions(spark, sf):
    return raw(spark, sf, "predictions")


def evaluated(spark, sf):
    known = predictions(spark, sf).filter("valeur_actuelle > 0")
    return reports.evaluate_predictions(known, "valeur_projetee", "valeur_actuelle", "projection")


# --- check SQL ---------------------------------------------------------------

_PLAYER_COLUMNS = ("name, date_of_birth, position, foot, height_in_cm, country_of_citizenship, current_club_id,"
                   " current_club_name, current_club_domestic_competition_id, last_season, market_value_in_eur,"
                   " highest_market_value_in_eur, international_caps, international_goals")
_POSITIVE = "CASE WHEN {c} >= 0 THEN {c} END AS {c}"
CTES["q_players"] = first_per_key(
    f"(SELECT * REPLACE ({_POSITIVE.format(c='market_value_in_eur')}, {_POSITIVE.format(c='highest_market_value_in_eur')}) FROM fx_players)",
    "player_id", _PLAYER_COLUMNS)
_APP_COLUMNS = ("game_id, player_id, player_club_id, date, player_name, competition_id, goals, assists, yellow_cards,"
                " red_cards, minutes_played")
_ZEROED = ", ".join(f"CASE WHEN {c} >= 0 THEN {c} ELSE 0 END AS {c}" for c in clean.STATS)
CTES["q_appearances"] = first_per_key(
    f"(SELECT * REPLACE ({_ZEROED}) FROM fx_appearances WHERE minutes_played > 0)", "appearance_id", _APP_COLUMNS)
CTES["q_recent"] = first_per_key(
    f"(SELECT * REPLACE ({_ZEROED}) FROM fx_appearances WHERE minutes_played > 0 AND date >= DATE '{fx.PERF_SINCE}')",
    "appearance_id", _APP_COLUMNS)
CTES["q_valuations"] = f"SELECT * REPLACE ({_POSITIVE.format(c='market_value_in_eur')}) FROM fx_valuations WHERE market_value_in_eur IS NOT NULL"

CTES["q_performance"] = f"""
SELECT player_id, player_name, position, market_value_in_eur, competition_id, matchs_joues, total_goals, total_assists, total_minutes,
  total_yellow_cards, total_red_cards, {rnd('am', 1)} AS avg_minutes_per_match,
  {rnd('total_goals * 90.0e0 / total_minutes', 3)} AS goals_per_90, {rnd('total_assists * 90.0e0 / total_minutes', 3)} AS assists_per_90,
  {rnd('(total_goals + total_assists) * 90.0e0 / total_minutes', 3)} AS goal_contributions_per_90,
  {rnd('(total_goals + total_assists) * 90.0e0 / total_minutes / (market_value_in_eur / 1000000.0e0)', 4)} AS value_efficiency
FROM (SELECT a.player_id, a.player_name, p.position, p.market_value_in_eur, a.competition_id, count(*) AS matchs_joues,
    CAST(sum(goals) AS BIGINT) AS total_goals, CAST(sum(assists) AS BIGINT) AS total_assists, CAST(sum(minutes_played) AS BIGINT) AS total_minutes,
    CAST(sum(yellow_cards) AS BIGINT) AS total_yellow_cards, CAST(sum(red_cards) AS BIGINT) AS total_red_cards, avg(minutes_played) AS am
  FROM q_recent a JOIN q_players p ON p.player_id = a.player_id WHERE p.market_value_in_eur > 0 GROUP BY 1, 2, 3, 4, 5) t
WHERE total_minutes >= 90
"""
_MEAN = ", ".join(f"{rnd(f'CAST(sum(CAST({c} AS DECIMAL(18,{d}))) AS DOUBLE) / nullif(count({c}), 0)', d)} AS {c}" for c, d in P.RATIOS.items())
CTES["q_rollup"] = f"""
SELECT player_id, CAST(sum(matchs_joues) AS BIGINT) AS matchs_joues_total, CAST(sum(total_goals) AS BIGINT) AS total_goals,
  CAST(sum(total_assists) AS BIGINT) AS total_assists, CAST(sum(total_minutes) AS BIGINT) AS total_minutes, {_MEAN} FROM q_performance GROUP BY 1
"""
_CODE = mq._SNAPSHOT_CODE
CTES["q_linked"] = f"""
SELECT game_id, {mq._ID} AS match_id, competition, home_team AS home_norm, away_team AS away_norm
FROM (SELECT game_id, date, {_CODE.format(c='competition_id')} AS competition, coalesce(h.c, trim(home_club_name)) AS home_team,
    coalesce(a.c, trim(away_club_name)) AS away_team
  FROM fx_games LEFT JOIN q_alias h ON h.k = lower(trim(home_club_name)) LEFT JOIN q_alias a ON a.k = lower(trim(away_club_name))
  WHERE date >= DATE '{fx.LINK_SINCE}') g WHERE competition IS NOT NULL
"""
CTES["q_app_linked"] = f"SELECT a.*, l.* EXCLUDE (game_id) FROM fx_appearances a LEFT JOIN q_linked l ON l.game_id = a.game_id WHERE a.date >= DATE '{fx.LINK_SINCE}'"

_AGE = "CAST(date_part('year', age(CAST({at} AS TIMESTAMP), CAST({born} AS TIMESTAMP))) AS INT)"
CTES["q_youth"] = f"""
SELECT *, {rnd('buts_jeune * 90.0e0 / minutes_jeune', 4)} AS goals_per_90_jeune, {rnd('passes_jeune * 90.0e0 / minutes_jeune', 4)} AS assists_per_90_jeune
FROM (SELECT player_id, count(*) AS matchs_jeune, CAST(sum(goals) AS BIGINT) AS buts_jeune, CAST(sum(assists) AS BIGINT) AS passes_jeune,
    CAST(sum(minutes_played) AS BIGINT) AS minutes_jeune, min(age) AS age_premier_match, count(DISTINCT competition_id) AS nb_competitions_jeune
  FROM (SELECT a.*, {_AGE.format(at='a.date', born='p.date_of_birth')} AS age FROM q_app_linked a JOIN q_players p ON p.player_id = a.player_id) x
  WHERE age BETWEEN 16 AND 21 GROUP BY 1) y WHERE minutes_jeune >= 500
"""
CTES["q_club_values"] = f"""
SELECT current_club_id, {rnd('avg(market_value_in_eur)', 0)} AS valeur_moyenne_club, count(*) AS nb_joueurs_club
FROM q_players WHERE market_value_in_eur IS NOT NULL GROUP BY 1
"""
CTES["q_latest"] = """
SELECT player_id, date, market_value_in_eur FROM (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY date DESC, market_value_in_eur DESC NULLS LAST) AS rn FROM q_valuations) v WHERE rn = 1
"""
_AGE_NOW = _AGE.format(at=f"DATE '{fx.AS_OF}'", born="p.date_of_birth")
CTES["q_dataset"] = f"""
SELECT y.*, p.position, p.foot, p.height_in_cm, p.international_caps, p.international_goals, p.current_club_id,
  coalesce(c.valeur_moyenne_club, 0) AS valeur_moyenne_club, {_AGE_NOW} AS age_actuel, coalesce(v.market_value_in_eur, p.market_value_in_eur) AS valeur_cible
FROM q_youth y JOIN q_players p ON p.player_id = y.player_id LEFT JOIN q_latest v ON v.player_id = y.player_id
  LEFT JOIN q_club_values c ON c.current_club_id = p.current_club_id
WHERE coalesce(v.market_value_in_eur, p.market_value_in_eur) IS NOT NULL AND {_AGE_NOW} BETWEEN 22 AND 35
"""
CTES["q_candidates"] = f"""
SELECT y.*, p.name, p.position, p.foot, p.height_in_cm, p.international_caps, p.international_goals, p.current_club_name, p.current_club_id,
  coalesce(c.valeur_moyenne_club, 0) AS valeur_moyenne_club, {_AGE_NOW} AS age_actuel, p.market_value_in_eur AS valeur_actuelle
FROM q_youth y JOIN q_players p ON p.player_id = y.player_id LEFT JOIN q_club_values c ON c.current_club_id = p.current_club_id
WHERE {_AGE_NOW} BETWEEN 16 AND 22
"""
CTES["q_pairs"] = """
SELECT * FROM (SELECT player_id, date AS t0, lead(date) OVER w AS t1, market_value_in_eur AS v0, lead(market_value_in_eur) OVER w AS v1
  FROM q_valuations WHERE market_value_in_eur > 0 WINDOW w AS (PARTITION BY player_id ORDER BY date, market_value_in_eur)) p WHERE t1 IS NOT NULL
"""
_SUMS = {"goals": "buts_periode", "assists": "assists_periode", "minutes_played": "minutes_periode",
         "yellow_cards": "cartons_j_periode", "red_cards": "cartons_r_periode"}
CTES["q_pair_ids"] = "SELECT *, row_number() OVER () AS pid FROM q_pairs"
CTES["q_periods"] = f"""
SELECT p.player_id, p.t0, p.t1, p.v0, p.v1, count(a.player_id) AS matchs_periode,
  {', '.join(f'CAST(coalesce(sum(a.{c}), 0) AS BIGINT) AS {o}' for c, o in _SUMS.items())}
FROM q_pair_ids p LEFT JOIN q_appearances a ON a.player_id = p.player_id AND a.date >= p.t0 AND a.date < p.t1
GROUP BY p.pid, p.player_id, p.t0, p.t1, p.v0, p.v1
"""
_SINCE = "1995-06-01"
CTES["q_period_rows"] = f"""
SELECT r.player_id, t0 AS date_t0, t1 AS date_t1, v0 AS market_value_t0, v1 AS market_value_t1, duree_jours, v1 - v0 AS delta_value, delta_pct,
  matchs_periode, {', '.join(_SUMS.values())}, position, foot,
  CASE WHEN country_of_citizenship = 'Türkiye' THEN 'Turkey' ELSE country_of_citizenship END AS country, age_a_t1,
  coalesce(international_caps, 0) AS international_caps, coalesce(international_goals, 0) AS international_goals,
  CASE WHEN minutes_periode > 0 THEN {rnd('buts_periode * 90.0e0 / nullif(minutes_periode, 0)', 3)} ELSE 0.0e0 END AS goals_per_90,
  CASE WHEN minutes_periode > 0 THEN {rnd('assists_periode * 90.0e0 / nullif(minutes_periode, 0)', 3)} ELSE 0.0e0 END AS assists_per_90
FROM (SELECT q.*, CAST(t1 - t0 AS INT) AS duree_jours, {rnd('(v1 - v0) / v0 * 100.0e0', 2)} AS delta_pct, p.position, p.foot, p.country_of_citizenship,
    p.international_caps, p.international_goals, {rnd('(t1 - p.date_of_birth) / 365.25e0', 2)} AS age_a_t1
  FROM q_periods_since q JOIN q_players p ON p.player_id = q.player_id
  WHERE p.position IS NOT NULL AND p.position <> 'Missing' AND p.last_season >= {fx.LAST_SEASON}) r
WHERE duree_jours BETWEEN 7 AND 1100 AND delta_pct BETWEEN -90 AND 500 AND age_a_t1 BETWEEN 15 AND 45
"""
CTES["q_pairs_since"] = CTES["q_pairs"].replace("> 0 WINDOW", f"> 0 AND date >= DATE '{_SINCE}' WINDOW")
CTES["q_pair_ids_since"] = "SELECT *, row_number() OVER () AS pid FROM q_pairs_since"
CTES["q_periods_since"] = CTES["q_periods"].replace("q_pair_ids", "q_pair_ids_since").replace(
    "q_appearances a ON", f"(SELECT * FROM q_appearances WHERE date >= DATE '{_SINCE}') a ON")


def _top20(source, column):
    return f"SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {column} LIMIT 20"


CTES["q_temporal"] = f"SELECT *, CASE WHEN country IN ({_top20('q_period_rows', 'country')}) THEN country ELSE 'other' END AS nationality_group FROM q_period_rows"
CTES["q_evaluated"] = f"""
SELECT *, CASE WHEN difference_pct > 20 THEN '{C.UNDER}' WHEN difference_pct < -20 THEN '{C.OVER}' ELSE '{C.FAIR}' END AS evaluation
FROM (SELECT *, round(valeur_projetee, 0) AS predicted_value, valeur_actuelle AS actual_value, 'projection' AS model_name,
    valeur_projetee - valeur_actuelle AS difference, {rnd('(valeur_projetee - valeur_actuelle) / valeur_actuelle * 100.0e0', 1)} AS difference_pct
  FROM fx_predictions WHERE valeur_actuelle > 0) p
"""

# --- cleaned tables -----------------------------------------------------------

_TYPES = {"player_id": "bigint", "name": "string", "date_of_birth": "date", "height_in_cm": "int", "market_value_in_eur": "double", "last_season": "int"}
_TEXT = """
SELECT CAST(player_id AS VARCHAR) AS player_id, name, CASE WHEN player_id % 43 = 0 THEN '1980-02-31' ELSE CAST(date_of_birth AS VARCHAR) END AS date_of_birth,
  CASE WHEN player_id % 41 = 0 THEN 'n/a' ELSE concat(CAST(height_in_cm AS VARCHAR), '.0') END AS height_in_cm,
  CASE WHEN player_id % 37 = 0 THEN 'unknown' ELSE CAST(CAST(market_value_in_eur AS BIGINT) AS VARCHAR) END AS market_value_in_eur,
  CAST(last_season AS VARCHAR) AS last_season FROM fx_players
"""


def player_text(spark, sf):
    k = F.col("player_id")
    return raw(spark, sf, "players").select(
        k.cast("string").alias("player_id"), "name",
        F.when(k % 43 == 0, "1980-02-31").otherwise(F.col("date_of_birth").cast("string")).alias("date_of_birth"),
        F.when(k % 41 == 0, "n/a").otherwise(F.concat(F.col("height_in_cm").cast("string"), F.lit(".0"))).alias("height_in_cm"),
        F.when(k % 37 == 0, "unknown").otherwise(F.col("market_value_in_eur").cast("bigint").cast("string")).alias("market_value_in_eur"),
        F.col("last_season").cast("string").alias("last_season"),
    )


@query("conformed_players", "PRJ-2", f"""
SELECT CAST(player_id AS BIGINT) AS player_id, name, TRY_CAST(date_of_birth AS DATE) AS date_of_birth,
  CAST(TRY_CAST(height_in_cm AS DOUBLE) AS INT) AS height_in_cm, TRY_CAST(market_value_in_eur AS DOUBLE) AS market_value_in_eur,
  CAST(last_season AS INT) AS last_season FROM ({_TEXT}) t
""")
def _(spark, sf):
    return clean.conform(player_text(spark, sf), _TYPES)


@query("cast_rejects", "PRJ-2", f"""
SELECT CAST(0 AS BIGINT) AS player_id, count(*) FILTER (date_of_birth IS NOT NULL AND TRY_CAST(date_of_birth AS DATE) IS NULL) AS date_of_birth,
  count(*) FILTER (height_in_cm IS NOT NULL AND TRY_CAST(height_in_cm AS DOUBLE) IS NULL) AS height_in_cm,
  count(*) FILTER (market_value_in_eur IS NOT NULL AND TRY_CAST(market_value_in_eur AS DOUBLE) IS NULL) AS market_value_in_eur,
  CAST(0 AS BIGINT) AS last_season FROM ({_TEXT}) t
""")
def _(spark, sf):
    return clean.cast_rejects(player_text(spark, sf), _TYPES)


@query("clean_players", "PRJ-3 FLT-2 WN-1", "SELECT * FROM q_players")
def _(spark, sf):
    return players(spark, sf)


@query("clean_clubs", "FLT-2 WN-1", "SELECT * FROM fx_clubs")
def _(spark, sf):
    return clean.clean_clubs(raw(spark, sf, "clubs"))


@query("clean_valuations", "PRJ-3 FLT-2", "SELECT * FROM q_valuations")
def _(spark, sf):
    return valuations(spark, sf)


@query("clean_transfers", "PRJ-3 PRJ-4 FLT-2", f"""
SELECT player_id, CASE WHEN transfer_date <= DATE '{fx.AS_OF}' THEN transfer_date END AS transfer_date, from_club_id, to_club_id,
  {_POSITIVE.format(c='transfer_fee')} FROM fx_transfers
""")
def _(spark, sf):
    return clean.clean_transfers(raw(spark, sf, "transfers"), fx.AS_OF)


@query("clean_appearances", "PRJ-3 FLT-2 FLT-3 WN-1", "SELECT * FROM q_appearances")
def _(spark, sf):
    return appearances(spark, sf)


@query("appearances_with_profile", "JN-1", """
SELECT a.* EXCLUDE (player_name), p.name AS player_name, p.position, p.market_value_in_eur FROM q_appearances a LEFT JOIN q_players p ON p.player_id = a.player_id
""")
def _(spark, sf):
    return P.with_player_profile(appearances(spark, sf), players(spark, sf))


@query("known_positions", "FLT-6", "SELECT player_id, name, position FROM q_players WHERE position IS NOT NULL AND position <> 'Missing'")
def _(spark, sf):
    return clean.known_position(players(spark, sf)).select("player_id", "name", "position")


@query("active_players", "FLT-7", f"SELECT player_id, last_season FROM q_players WHERE last_season >= {fx.LAST_SEASON}")
def _(spark, sf):
    return clean.active_players(players(spark, sf), fx.LAST_SEASON).select("player_id", "last_season")


# --- performance --------------------------------------------------------------


@query("player_performance", "AG-3 SC-9", "SELECT * FROM q_performance")
def _(spark, sf):
    return performance(spark, sf)


@query("player_rollup", "AG-4", "SELECT * FROM q_rollup")
def _(spark, sf):
    return P.player_rollup(performance(spark, sf))


@query("player_rollup_weighted", "AG-4", f"""
SELECT player_id, matchs_joues_total, total_goals, total_assists, total_minutes, {rnd('total_goals * 90.0e0 / total_minutes', 3)} AS goals_per_90_weighted,
  {rnd('total_assists * 90.0e0 / total_minutes', 3)} AS assists_per_90_weighted FROM q_rollup
""")
def _(spark, sf):
    return P.player_rollup_weighted(performance(spark, sf))


@query("top_scorers", "TK-2", """
SELECT player_id, competition_id, total_goals, total_minutes, goals_per_90 FROM q_performance WHERE total_minutes >= 500
ORDER BY goals_per_90 DESC, player_id, competition_id, player_name LIMIT 10
""")
def _(spark, sf):
    return reports.top_scorers(performance(spark, sf))


@query("players_by_competition", "AG-9", "SELECT competition_id, count(*) AS n FROM q_performance GROUP BY 1")
def _(spark, sf):
    return stats.value_counts(performance(spark, sf), "competition_id")


@query("undervalued_players", "BI-2 WN-1", """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY value_efficiency DESC, player_name, competition_id, matchs_joues) AS rn FROM q_performance) p
WHERE rn = 1 ORDER BY value_efficiency DESC, player_id LIMIT 20
""")
def _(spark, sf):
    return reports.undervalued_players(performance(spark, sf))


# --- links and enrichment -----------------------------------------------------


@query("linked_games", "JN-2 SC-2", "SELECT l.*, g.date, g.home_club_goals, g.away_club_goals FROM q_linked l JOIN fx_games g ON g.game_id = l.game_id")
def _(spark, sf):
    return P.link_games(raw(spark, sf, "games"), mq.aliases(spark, sf), fx.LINK_SINCE)


def linked(spark, sf):
    return P.link_appearances(raw(spark, sf, "appearances"), raw(spark, sf, "games"), mq.aliases(spark, sf), fx.LINK_SINCE)


def recorded(spark, sf):
    """What the projection needs of the linked appearances: how often each counts, not with which match."""
    return P.count_links(raw(spark, sf, "appearances"), raw(spark, sf, "games"), mq.aliases(spark, sf), fx.LINK_SINCE)


@query("linked_appearances", "JN-2", "SELECT * FROM q_app_linked")
def _(spark, sf):
    return linked(spark, sf)


@query("link_coverage", "AG-8", f"""
SELECT count(match_id) AS matched, count(*) - count(match_id) AS unmatched, count(*) AS total, {rnd('count(match_id) * 100.0e0 / count(*)', 1)} AS matched_pct FROM q_app_linked
""")
def _(spark, sf):
    return stats.coverage(linked(spark, sf), "match_id")


@query("players_enriched", "JN-3 FLT-6 SC-1 SC-7", f"""
SELECT p.*, coalesce(a.c, trim(p.current_club_name)) AS current_club_normalized, {_CODE.format(c='current_club_domestic_competition_id')} AS current_competition,
  {mq._LABEL.format(c=f"({_CODE.format(c='current_club_domestic_competition_id')})")} END AS current_competition_name,
  {rnd(f"(DATE '{fx.AS_OF}' - p.date_of_birth) / 365.25e0", 1)} AS age, r.* EXCLUDE (player_id), x.valeur_actuelle AS actual_value, x.valeur_projetee AS predicted_value
FROM q_players p LEFT JOIN q_alias a ON a.k = lower(trim(p.current_club_name)) LEFT JOIN q_rollup r ON r.player_id = p.player_id
  LEFT JOIN fx_predictions x ON x.player_id = p.player_id WHERE p.position IS NOT NULL AND p.position <> 'Missing'
""")
def _(spark, sf):
    return P.enrich_players(players(spark, sf), performance(spark, sf), predictions(spark, sf), mq.aliases(spark, sf), fx.AS_OF)


@query("clubs_unified", "SC-1 SC-3 JN-10", f"""
SELECT c.*, coalesce(a.c, trim(c.name)) AS name_normalized, {_CODE.format(c='domestic_competition_id')} AS competition,
  {mq._LABEL.format(c=f"({_CODE.format(c='domestic_competition_id')})")} END AS competition_name FROM fx_clubs c LEFT JOIN q_alias a ON a.k = lower(trim(c.name))
""")
def _(spark, sf):
    return P.unify_clubs(clean.clean_clubs(raw(spark, sf, "clubs")), mq.aliases(spark, sf))


# --- projection tables --------------------------------------------------------


@query("youth_stats", "AG-5 JN-4 SC-8 SC-9", "SELECT * FROM q_youth")
def _(spark, sf):
    return youth(spark, sf)


@query("club_values", "AG-6 SC-17", f"""
SELECT *, CASE WHEN valeur_moyenne_club >= 120000000 THEN 'european elite' WHEN valeur_moyenne_club >= 45000000 THEN 'european top 5'
  WHEN valeur_moyenne_club >= 15000000 THEN 'first division' WHEN valeur_moyenne_club >= 4000000 THEN 'professional'
  WHEN valeur_moyenne_club >= 1000000 THEN 'semi-pro' ELSE 'amateur' END AS club_level,
  CASE WHEN valeur_moyenne_club >= 120000000 THEN 120000000.0e0 WHEN valeur_moyenne_club >= 45000000 THEN 45000000.0e0
  WHEN valeur_moyenne_club >= 15000000 THEN 15000000.0e0 WHEN valeur_moyenne_club >= 4000000 THEN 4000000.0e0
  WHEN valeur_moyenne_club >= 1000000 THEN 1000000.0e0 ELSE 250000.0e0 END AS level_value FROM q_club_values
""")
def _(spark, sf):
    level = X.club_level("valeur_moyenne_club")
    return P.club_values(players(spark, sf)).withColumn("club_level", level).withColumn("level_value", X.club_level_value("club_level"))


@query("latest_valuations", "AG-7", "SELECT * FROM q_latest")
def _(spark, sf):
    return P.latest_by(valuations(spark, sf), "player_id", "date", "market_value_in_eur")


def dataset(spark, sf):
    return features.projection_dataset(youth(spark, sf), players(spark, sf), valuations(spark, sf), fx.AS_OF)


def candidates(spark, sf):
    return features.projection_candidates(youth(spark, sf), players(spark, sf), fx.AS_OF)


@query("projection_dataset", "FE-4 JN-4 JN-5", "SELECT * FROM q_dataset")
def _(spark, sf):
    return dataset(spark, sf)


@query("projection_candidates", "FE-5", "SELECT * FROM q_candidates")
def _(spark, sf):
    return candidates(spark, sf)


@query("label_codes", "FE-3", """
SELECT player_id, position, foot, CAST(dense_rank() OVER (ORDER BY coalesce(position, 'Unknown')) - 1 AS INT) AS position_enc,
  CAST(dense_rank() OVER (ORDER BY coalesce(foot, 'Unknown')) - 1 AS INT) AS foot_enc FROM q_players
""")
def _(spark, sf):
    df = players(spark, sf).select("player_id", "position", "foot")
    out = models.label_encode(df, models.fit_encoders(df))
    return out.withColumns({c: F.col(c).cast("int") for c in ("position_enc", "foot_enc")})


@query("complete_rows", "FLT-10", "SELECT * FROM q_dataset WHERE position IS NOT NULL AND foot IS NOT NULL AND international_caps IS NOT NULL")
def _(spark, sf):
    return clean.drop_incomplete(dataset(spark, sf), ["position", "foot", "international_caps"])


@query("log_targets", "SC-12", f"SELECT player_id, {rnd('ln(1 + valeur_cible)', 6)} AS log_value, {rnd('exp(ln(1 + valeur_cible)) - 1', 2)} AS back FROM q_dataset")
def _(spark, sf):
    log = X.log_value("valeur_cible")
    return dataset(spark, sf).select("player_id", F.round(log, 6).alias("log_value"), F.round(X.unlog_value(log), 2).alias("back"))


# --- periods ------------------------------------------------------------------


def positive(spark, sf):
    return valuations(spark, sf).filter("market_value_in_eur > 0")


@query("valuation_pairs", "WN-3 SC-11 SC-7", f"""
SELECT *, CAST(t1 - t0 AS INT) AS duree_jours, v1 - v0 AS delta_value, {rnd('(v1 - v0) / v0 * 100.0e0', 2)} AS delta_pct FROM q_pairs
""")
def _(spark, sf):
    return periods.consecutive_pairs(positive(spark, sf)).withColumns({
        "duree_jours": F.datediff("t1", "t0"), "delta_value": X.delta("v0", "v1"), "delta_pct": X.delta_pct("v0", "v1")})


@query("period_sums", "JN-7", "SELECT * FROM q_periods")
def _(spark, sf):
    return periods.interval_join(appearances(spark, sf), periods.consecutive_pairs(positive(spark, sf)), _SUMS, count="matchs_periode")


_LONG = "SELECT player_id, t0, CAST(date_add(t1, 90) AS DATE) AS t1, v0, v1, pid FROM q_pair_ids"


@query("overlapping_period_sums", "JN-7", CTES["q_periods"].replace("q_pair_ids", f"({_LONG})"))
def _(spark, sf):
    """Periods that run on for 90 days into the next: a day counts in each period that holds it."""
    longer = periods.consecutive_pairs(positive(spark, sf)).withColumn("t1", F.date_add("t1", 90))
    return periods.overlap_join(appearances(spark, sf), longer, _SUMS, count="matchs_periode")


def temporal(spark, sf):
    return features.temporal_features(
        valuations(spark, sf), appearances(spark, sf), players(spark, sf), _SINCE, fx.LAST_SEASON)


@query("temporal_features", "FE-6 WN-3 JN-7 FE-2 FLT-7 FLT-9 SC-7 SC-9 SC-11", "SELECT * FROM q_temporal")
def _(spark, sf):
    return temporal(spark, sf)


def _dummies(column, prefix, values):
    return ", ".join(f"CASE WHEN {column} = '{v}' THEN 1 ELSE 0 END AS {prefix}_{v}" for v in values)


_POSITIONS = ["Attack", "Defender", "Goalkeeper", "Midfield", "Missing"]
_FEET = ["both", "left", "right"]


@query("one_hot_players", "FE-1", f"SELECT player_id, {_dummies('position', 'pos', _POSITIONS)}, {_dummies('foot', 'foot', _FEET)} FROM q_players")
def _(spark, sf):
    df = players(spark, sf).select("player_id", "position", "foot")
    values = features.vocabularies(df, ["position", "foot"])
    for column, prefix in (("position", "pos"), ("foot", "foot")):
        df = features.one_hot(df, column, prefix, values[column])
    return df.drop("position", "foot")


@query("category_codes", "FE-1", """
SELECT player_id, name, CAST(dense_rank() OVER (ORDER BY name) - 1 AS BIGINT) AS name_code FROM q_players WHERE name IS NOT NULL
UNION ALL SELECT player_id, name, NULL FROM q_players WHERE name IS NULL
""")
def _(spark, sf):
    """As many values as players: encoded by a join with a stored dictionary."""
    return features.code_by_join(players(spark, sf).select("player_id", "name"), "name", "name_code")


@query("nationality_groups", "FE-2", f"""
SELECT country_of_citizenship, CASE WHEN country_of_citizenship IN ({_top20('q_players', 'country_of_citizenship')}) THEN country_of_citizenship ELSE 'other' END AS nationality_group, player_id FROM q_players
""")
def _(spark, sf):
    df = players(spark, sf).select("player_id", "country_of_citizenship")
    return features.top_n_or_other(df, "country_of_citizenship", "nationality_group")


CTES["q_market"] = f"""
SELECT * EXCLUDE (country_raw), CASE WHEN country_raw = 'Türkiye' THEN 'Turkey' ELSE country_raw END AS country_of_citizenship
FROM (SELECT p.player_id, p.name, p.position, p.foot, p.country_of_citizenship AS country_raw, coalesce(p.international_caps, 0) AS international_caps,
  coalesce(p.international_goals, 0) AS international_goals, coalesce(p.highest_market_value_in_eur, p.market_value_in_eur) AS highest_market_value_in_eur,
  p.market_value_in_eur AS target_market_value, coalesce(matchs_joues_total, 0) AS matchs_joues, coalesce(total_goals, 0) AS total_goals,
  coalesce(total_assists, 0) AS total_assists, coalesce(total_minutes, 0) AS total_minutes, coalesce(am, 0) AS avg_minutes_per_match,
  coalesce({rnd('total_goals * 90.0e0 / nullif(total_minutes, 0)', 3)}, 0) AS goals_per_90, coalesce({rnd('total_assists * 90.0e0 / nullif(total_minutes, 0)', 3)}, 0) AS assists_per_90,
  coalesce({rnd('(total_goals + total_assists) * 90.0e0 / nullif(total_minutes, 0)', 3)}, 0) AS goal_contributions_per_90
FROM q_players p LEFT JOIN q_rollup r ON r.player_id = p.player_id
  LEFT JOIN (SELECT player_id, CAST(sum(CAST(avg_minutes_per_match AS DECIMAL(18,1))) AS DOUBLE) / count(*) AS am FROM q_performance GROUP BY 1) m ON m.player_id = p.player_id
WHERE p.market_value_in_eur > 0 AND p.position IS NOT NULL AND p.position <> 'Missing') f
"""


@query("market_value_features", "FE-7 SC-19", f"""
SELECT * REPLACE (round(avg_minutes_per_match, 6) AS avg_minutes_per_match), CASE WHEN country_of_citizenship IN ({_top20('q_market', 'country_of_citizenship')}) THEN country_of_citizenship ELSE 'other' END AS nationality_group FROM q_market
""")
def _(spark, sf):
    out = features.market_value_features(players(spark, sf), performance(spark, sf))
    return out.withColumn("avg_minutes_per_match", F.round("avg_minutes_per_match", 6))


@query("dummy_sums", "FE-1 FE-2 FE-7", f"""
SELECT prefix, value, n FROM (
  SELECT 'pos' AS prefix, position AS value, count(*) AS n FROM q_market GROUP BY 2
  UNION ALL SELECT 'foot', foot, count(*) FROM q_market WHERE foot IS NOT NULL GROUP BY 2
  UNION ALL SELECT 'nat', CASE WHEN country_of_citizenship IN ({_top20('q_market', 'country_of_citizenship')}) THEN country_of_citizenship ELSE 'other' END, count(*) FROM q_market GROUP BY 2) s
""")
def _(spark, sf):
    """Every 0/1 column of the feature table, added up."""
    df, vocabularies = features.with_dummies(features.market_value_features(players(spark, sf), performance(spark, sf)))
    columns = [(features.PREFIXES[c], v) for c, values in vocabularies.items() for v in values]
    sums = df.agg(*[F.sum(f"`{p}_{v}`").alias(f"s{i}") for i, (p, v) in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(p).alias("prefix"), F.lit(v).alias("value"), F.col(f"s{i}").alias("n"))
                     for i, (p, v) in enumerate(columns)])
    return sums.select(F.explode(rows).alias("r")).select("r.*")


@query("filled_players", "SC-19", """
SELECT player_id, CASE WHEN country_of_citizenship = 'Türkiye' THEN 'Turkey' ELSE country_of_citizenship END AS country,
  CASE WHEN position = 'Missing' THEN NULL ELSE position END AS position, coalesce(international_caps, 0) AS international_caps,
  coalesce(highest_market_value_in_eur, market_value_in_eur) AS highest_market_value_in_eur FROM q_players
""")
def _(spark, sf):
    df = players(spark, sf).select(
        "player_id", X.alias_to("country_of_citizenship", features.COUNTRY_ALIASES).alias("country"),
        X.alias_to("position", {"Missing": None}).alias("position"), "international_caps", "highest_market_value_in_eur", "market_value_in_eur")
    return clean.fill(df, {"international_caps": 0, "highest_market_value_in_eur": F.col("market_value_in_eur")}).drop("market_value_in_eur")


# --- statistics ---------------------------------------------------------------

for _column in ("age_a_t1", "delta_pct", "market_value_t1"):
    @query(f"describe_{_column}", "AG-12", f"""
SELECT count({_column}) AS n, {rnd(f'avg({_column})', 1)} AS mean, {rnd(f'stddev_samp({_column})', 1)} AS std, min({_column}) AS min, max({_column}) AS max,
  {rnd(f'quantile_cont({_column}, 0.25)', 1)} AS q25, {rnd(f'quantile_cont({_column}, 0.5)', 1)} AS q50, {rnd(f'quantile_cont({_column}, 0.75)', 1)} AS q75 FROM q_temporal
""")
    def _(spark, sf, column=_column):
        return stats.describe(temporal(spark, sf), column)


@query("positions_in_periods", "AG-9", "SELECT position, count(*) AS n FROM q_temporal GROUP BY 1")
def _(spark, sf):
    return stats.value_counts(temporal(spark, sf), "position")


# --- predictions --------------------------------------------------------------


@query("evaluated_predictions", "ML-8 SC-10", "SELECT * FROM q_evaluated")
def _(spark, sf):
    return evaluated(spark, sf)


@query("evaluation_mix", "AG-13", f"""
SELECT position, count(player_id) AS nb_joueurs, {rnd(f"avg(CAST(evaluation = '{C.UNDER}' AS INT)) * 100", 1)} AS pct_sous_evalues,
  {rnd(f"avg(CAST(evaluation = '{C.FAIR}' AS INT)) * 100", 1)} AS pct_bien_evalues, {rnd(f"avg(CAST(evaluation = '{C.OVER}' AS INT)) * 100", 1)} AS pct_surevalues,
  {rnd('CAST(sum(CAST(difference_pct AS DECIMAL(28,1))) AS DOUBLE) / count(*)', 1)} AS ecart_moyen_pct FROM q_evaluated GROUP BY 1
""")
def _(spark, sf):
    return stats.evaluation_mix(evaluated(spark, sf))


@query("evaluation_counts", "AG-9", "SELECT evaluation, count(*) AS n FROM q_evaluated GROUP BY 1")
def _(spark, sf):
    return stats.value_counts(evaluated(spark, sf), "evaluation")


@query("residuals", "ML-9", "SELECT player_id, actual_value - predicted_value AS residual FROM q_evaluated")
def _(spark, sf):
    return reports.residuals(evaluated(spark, sf), "predicted_value", "actual_value").select("player_id", "residual")


@query("regression_metrics", "ML-5 SC-12", f"""
SELECT count(*) AS n, {rnd('1 - avg((y - p) ** 2) / var_pop(y)', 6)} AS r2, {rnd('avg(abs((exp(y) - 1) - (exp(p) - 1)))', 1)} AS mae
FROM (SELECT ln(1 + actual_value) AS y, ln(1 + predicted_value) AS p FROM q_evaluated) e
""")
def _(spark, sf):
    df = evaluated(spark, sf).select(X.log_value("actual_value").alias("label"), X.log_value("predicted_value").alias("prediction"))
    return stats.regression_metrics(df).select("n", F.round("r2", 6).alias("r2"), F.round("mae", 1).alias("mae"))


@query("top_prospects", "TK-3", "SELECT * FROM fx_predictions ORDER BY valeur_projetee DESC, player_id LIMIT 10")
def _(spark, sf):
    return reports.top_prospects(predictions(spark, sf))


_PAGE = ", ".join(reports.PAGE)


@query("prediction_page", "TK-4", f"""
SELECT * EXCLUDE (place) FROM (SELECT {_PAGE}, row_number() OVER (ORDER BY valeur_projetee DESC, player_id) AS place FROM fx_predictions) ranked
WHERE place > (SELECT count(*) * 3 // 4 FROM fx_predictions) AND place <= (SELECT count(*) * 3 // 4 FROM fx_predictions) + 20
""")
def _(spark, sf):
    """A page three quarters down the ranking, read from the ranges that hold it."""
    path, df = scratch(spark, "ranked"), predictions(spark, sf)
    order = [F.col("valeur_projetee").desc_nulls_last(), F.col("player_id")]
    indexed.write_ranked(df.select(*reports.PAGE), order, path, range_rows=1000)
    return indexed.read_page(spark, path, order, 20, df.count() * 3 // 4)


@query("prediction_by_id", "TK-5 SRC-4", f"SELECT {_PAGE} FROM fx_predictions WHERE player_id = 77")
def _(spark, sf):
    """One player out of the stored mart: one bucket is opened."""
    name = f"predictions_{uuid.uuid4().hex}"
    path = scratch(spark, name)
    indexed.write_indexed(predictions(spark, sf), name, path, **MART_INDEXES["predictions_projection_carriere"])
    found = reports.find(spark.table(name), 77)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files are the mart
    return found


@query("gems", "BI-3", f"""
SELECT *, CASE WHEN valeur_actuelle > 0 THEN {rnd('(valeur_projetee - valeur_actuelle) / nullif(valeur_actuelle, 0) * 100.0e0', 1)} END AS progression_pct
FROM fx_predictions WHERE valeur_actuelle < 5000000 ORDER BY valeur_projetee DESC, player_id LIMIT 20
""")
def _(spark, sf):
    return reports.gems(predictions(spark, sf))


@query("top_20_prospects", "BI-3", "SELECT * FROM fx_predictions ORDER BY valeur_projetee DESC, player_id LIMIT 20")
def _(spark, sf):
    return reports.top_prospects(predictions(spark, sf), 20)


_PROGRESS = rnd("(valeur_projetee - valeur_actuelle) / nullif(valeur_actuelle, 0) * 100.0e0", 1)
_TIER = "CASE " + " ".join(f"WHEN valeur_projetee >= {v} THEN '{t}'" for v, t in C.POTENTIAL_TIERS) + f" ELSE '{C.POTENTIAL_LOWEST}' END"
_MONEY = "CASE WHEN {c} >= 1000000 THEN concat(printf('%.1f', {c} / 1000000.0e0), ' M€') ELSE concat(printf('%.0f', {c} / 1000.0e0), ' K€') END"
_PEAK = "CAST(round_even(24.0e0 - (age_actuel - 14) * 2.0e0 / 7.0e0, 0) AS INT)"


@query("scouting_columns", "ML-11 SC-13 SC-14 SC-15 SC-16 SC-17 SC-18", f"""
SELECT *, CASE WHEN valeur_actuelle > 0 THEN {_PROGRESS} ELSE 0.0e0 END AS progression_pct, {_PEAK} AS age_pic_min, {_PEAK} + 3 AS age_pic_max,
  {_TIER} AS interpretation, CASE WHEN age_actuel <= 15 THEN 'indicative' WHEN age_actuel <= 17 THEN 'moderate' ELSE 'good' END AS reliability,
  CASE WHEN minutes_jeune >= 1000 THEN 'sufficient' WHEN minutes_jeune >= 500 THEN 'fair' ELSE 'low' END AS data_volume,
  CASE WHEN valeur_moyenne_club >= 120000000 THEN 'european elite' WHEN valeur_moyenne_club >= 45000000 THEN 'european top 5'
    WHEN valeur_moyenne_club >= 15000000 THEN 'first division' WHEN valeur_moyenne_club >= 4000000 THEN 'professional'
    WHEN valeur_moyenne_club >= 1000000 THEN 'semi-pro' ELSE 'amateur' END AS club_level,
  {_MONEY.format(c='valeur_projetee')} AS valeur_projetee_texte,
  CASE WHEN valeur_actuelle > 0 THEN {_MONEY.format(c='valeur_actuelle')} ELSE 'Non référencé' END AS valeur_actuelle_texte,
  CASE WHEN valeur_actuelle > 0 AND {_PROGRESS} > 20 THEN 'opportunity' WHEN valeur_actuelle > 0 AND {_PROGRESS} < -20 THEN 'overvalued' END AS signal
FROM fx_predictions
""")
def _(spark, sf):
    return reports.scouting_report(predictions(spark, sf))


# --- rounding -----------------------------------------------------------------


@query("rounded_prices", "SC-20", f"SELECT p_partkey AS player_id, {rnd('p_retailprice / 7', 2)} AS two, {rnd('p_retailprice', 1)} AS one, {rnd('p_retailprice / 3', 0)} AS zero FROM part")
def _(spark, sf):
    price = F.col("p_retailprice")
    return spark.read.parquet(f"{sf}/part.parquet").select(
        F.col("p_partkey").alias("player_id"), F.round(price / 7, 2).alias("two"), F.round(price, 1).alias("one"), F.round(price / 3, 0).alias("zero"))


@query("best_rows_by_source", "WN-2", first_per_key(
    "(SELECT match_id, source, date FROM q_feed UNION ALL SELECT match_id, source, date FROM q_season)",
    "match_id", "source, date", order="CASE source WHEN 'api' THEN 0 ELSE 1 END"))
def _(spark, sf):
    names = ["match_id", "source", "date"]
    both = mq.feed_rows(spark, sf).select(*names).unionByName(mq.season_rows(spark, sf).select(*names))
    return dedup.prefer_source(both)


@query("player_age", "SC-7 SC-8", f"""
SELECT player_id, {rnd(f"(DATE '{fx.AS_OF}' - date_of_birth) / 365.25e0", 1)} AS age_one, {rnd(f"(DATE '{fx.AS_OF}' - date_of_birth) / 365.25e0", 2)} AS age_two,
  {_AGE.format(at=f"DATE '{fx.AS_OF}'", born='date_of_birth')} AS age_years FROM fx_players
""")
def _(spark, sf):
    at = F.lit(fx.AS_OF).cast("date")
    return raw(spark, sf, "players").select(
        "player_id", X.age_decimal("date_of_birth", at, 1).alias("age_one"), X.age_decimal("date_of_birth", at, 2).alias("age_two"),
        X.age_calendar("date_of_birth", at).alias("age_years"))


@query("unknown_names_clubs", "DQ-7 JN-9", "SELECT DISTINCT name FROM fx_clubs WHERE lower(trim(name)) NOT IN (SELECT k FROM q_alias)")
def _(spark, sf):
    from touchline.operators import names
    return names.unmapped_names(raw(spark, sf, "clubs").select("name").distinct(), mq.aliases(spark, sf))


@query("prediction_table_order", "TK-1", f"SELECT competition, season, club_name, points FROM q_table")
def _(spark, sf):
    return M.sort_standings(mq.league_table(spark, sf)).select("competition", "season", "club_name", "points")


@query("players_without_value", "JN-9", "SELECT player_id, name FROM q_players WHERE player_id NOT IN (SELECT player_id FROM q_performance)")
def _(spark, sf):
    return quality.only_in(players(spark, sf), performance(spark, sf), "player_id").select("player_id", "name")
