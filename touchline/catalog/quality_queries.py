"""Checks, sources and sinks that write and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline import constants as C
from touchline import schemas
from touchline.catalog import fixtures as fx
from touchline.catalog import match_queries as mq
from touchline.catalog import model_queries as modq
from touchline.catalog import player_queries as pq
from touchline.catalog.registry import query, rnd
from touchline.catalog.scratch import scratch
from touchline.operators import clean, names, quality, stats
from touchline.sources import files, readers, snapshots, writers

# --- checks -------------------------------------------------------------------


@query("missing_columns", "DQ-1", """
SELECT 'players' AS "table", 'country_of_birth,first_name,last_name,sub_position' AS missing, true AS refused, count(*) AS n_rows FROM fx_players
UNION ALL SELECT 'games', '', false, count(*) FROM fx_games
""")
def _(spark, sf):
    """A table that lacks declared columns and one that has them all, with the rows each would bring."""
    out = None
    for t in ("players", "games"):
        df = pq.raw(spark, sf, t)
        verdict = quality.check_required_columns(df, schemas.SNAPSHOT_REQUIRED[t], t)
        n_rows = stats.table_volumes({t: df}).select("n_rows").scalar()
        one = verdict.withColumns({"missing": F.array_join("missing", ","), "n_rows": n_rows})
        out = one if out is None else out.union(one)
    return out


_RATIO = """
SELECT '{t}' AS "table", n_new, n_old, CAST(round(n_new / n_old, 4) AS DOUBLE) AS ratio,
  CASE WHEN n_old = 0 THEN 'first' WHEN n_new / n_old < 0.3 THEN 'refused' WHEN n_new / n_old < 0.9 THEN 'warning' ELSE 'ok' END AS verdict
FROM (SELECT (SELECT count(*) FROM {new}) AS n_new, (SELECT count(*) FROM {old}) AS n_old) c
"""


@query("volume_ratio", "DQ-2", _RATIO.format(t="matches", new="q_unified", old="q_feed")
       + "UNION ALL" + _RATIO.format(t="appearances", new="q_recent", old="fx_appearances")
       + "UNION ALL" + _RATIO.format(t="players", new="fx_clubs", old="fx_players"))
def _(spark, sf):
    recent = clean.clean_appearances(pq.raw(spark, sf, "appearances"), fx.PERF_SINCE)
    a = quality.check_volume_ratio(mq.unified(spark, sf), mq.feed_rows(spark, sf), "matches")
    b = quality.check_volume_ratio(recent, pq.raw(spark, sf, "appearances"), "appearances")
    return a.union(b).union(quality.check_volume_ratio(pq.raw(spark, sf, "clubs"), pq.raw(spark, sf, "players"), "players"))


@query("min_matches", "DQ-3", """
SELECT competition_id, season, n_matches, min_matches, n_matches < min_matches AS refused FROM (SELECT competition_id, season, count(*) AS n_matches,
  CAST(CASE WHEN competition_id IN ('PL', 'PD', 'SA') THEN 350 WHEN competition_id IN ('BL1', 'FL1') THEN 280 ELSE 250 END AS INT) AS min_matches FROM fx_feed GROUP BY 1, 2) c
""")
def _(spark, sf):
    return quality.check_min_matches(mq.feed(spark, sf))


@query("min_rows", "DQ-3", "SELECT season, count(*) AS n_rows, count(*) < 2000 AS refused FROM fx_season GROUP BY 1")
def _(spark, sf):
    return quality.check_min_rows(fx.view(spark, sf, "fx_season"), 2000, "season")


@query("missing_fields", "DQ-4", """
SELECT count(*) AS n_rows, count(*) FILTER (home_club_name IS NULL) AS home_club_name_missing, count(*) FILTER (away_club_name IS NULL) AS away_club_name_missing,
  count(*) FILTER (home_club_goals IS NULL) AS home_club_goals_missing, count(*) FILTER (date IS NULL) AS date_missing, count(*) FILTER (status IS NULL) AS status_missing FROM fx_feed
""")
def _(spark, sf):
    return quality.check_required_fields(mq.feed(spark, sf), ["home_club_name", "away_club_name", "home_club_goals", "date", "status"])


@query("duplicate_appearances", "DQ-8", "SELECT appearance_id, count(*) AS n FROM fx_appearances GROUP BY 1 HAVING count(*) > 1 OR appearance_id IS NULL")
def _(spark, sf):
    return quality.pk_violations(pq.raw(spark, sf, "appearances"), schemas.PRIMARY_KEYS["appearances"])


@query("duplicate_valuations", "DQ-8", "SELECT player_id, date, count(*) AS n FROM fx_valuations GROUP BY 1, 2 HAVING count(*) > 1")
def _(spark, sf):
    return quality.pk_violations(pq.raw(spark, sf, "valuations"), schemas.PRIMARY_KEYS["player_valuations"])


@query("duplicate_matches", "DQ-8", "SELECT match_id, count(*) AS n FROM q_both GROUP BY 1 HAVING count(*) > 1")
def _(spark, sf):
    both = mq.feed_rows(spark, sf).unionByName(mq.season_rows(spark, sf), allowMissingColumns=True)
    return quality.pk_violations(both, schemas.PRIMARY_KEYS["unified_matches"])


@query("duplicate_players", "DQ-8", "SELECT player_id, count(*) AS n FROM fx_players GROUP BY 1 HAVING count(*) > 1 OR player_id IS NULL")
def _(spark, sf):
    return quality.pk_violations(pq.raw(spark, sf, "players"), schemas.PRIMARY_KEYS["players"])


@query("duplicate_clubs", "DQ-8", "SELECT club_id, count(*) AS n FROM fx_clubs GROUP BY 1 HAVING count(*) > 1 OR club_id IS NULL")
def _(spark, sf):
    return quality.pk_violations(pq.raw(spark, sf, "clubs"), schemas.PRIMARY_KEYS["clubs"])


@query("duplicate_periods", "DQ-8", "SELECT player_id, date_t0, date_t1, count(*) AS n FROM q_temporal GROUP BY 1, 2, 3 HAVING count(*) > 1")
def _(spark, sf):
    """Declared key of the period features: as they are built, no key comes twice."""
    return quality.pk_violations(pq.temporal(spark, sf), schemas.PRIMARY_KEYS["features_temporal"])


_ORPHANS = "SELECT '{t}' AS child, player_id, count(*) AS n FROM fx_{t} WHERE player_id NOT IN (SELECT player_id FROM q_players) GROUP BY 2"


@query("orphans", "DQ-9 JN-9", " UNION ALL ".join(_ORPHANS.format(t=t) for t in ("appearances", "valuations", "transfers", "predictions"))
       + " UNION ALL SELECT 'features_temporal' AS child, player_id, count(*) AS n FROM q_temporal WHERE player_id NOT IN (SELECT player_id FROM q_players) GROUP BY 2")
def _(spark, sf):
    """The five children declared in ``FOREIGN_KEYS``."""
    parent = pq.players(spark, sf)
    children = dict(zip(schemas.FOREIGN_KEYS, ("appearances", "valuations", "transfers", "features_temporal", "predictions")))
    out = None
    for t in children.values():
        child = pq.temporal(spark, sf) if t == "features_temporal" else pq.raw(spark, sf, t)
        one = quality.fk_orphans(child, parent).select(F.lit(t).alias("child"), "player_id", "n")
        out = one if out is None else out.union(one)
    return out


_BAD = """SELECT '{t}' AS "table", '{c}' AS "column", count(*) FILTER ({test}) AS violations FROM {source}"""


@query("range_violations", "DQ-10", " UNION ALL ".join(_BAD.format(**r) for r in (
    {"t": "players", "c": "market_value_in_eur", "test": "market_value_in_eur < 0", "source": "fx_players"},
    {"t": "appearances", "c": "minutes_played", "test": "minutes_played < 0 OR minutes_played > 120", "source": "fx_appearances"},
    {"t": "appearances", "c": "goals", "test": "goals < 0", "source": "fx_appearances"},
    {"t": "appearances", "c": "assists", "test": "assists < 0", "source": "fx_appearances"},
    {"t": "unified_matches", "c": "home_goals", "test": "home_goals < 0 OR home_goals > 20", "source": "q_both"},
    {"t": "unified_matches", "c": "away_goals", "test": "away_goals < 0 OR away_goals > 20", "source": "q_both"},
    {"t": "player_valuations", "c": "market_value_in_eur", "test": "market_value_in_eur < 0", "source": "fx_valuations"},
)))
def _(spark, sf):
    both = mq.feed_rows(spark, sf).unionByName(mq.season_rows(spark, sf), allowMissingColumns=True)
    tables = {"players": pq.raw(spark, sf, "players"), "appearances": pq.raw(spark, sf, "appearances"),
              "unified_matches": both, "player_valuations": pq.raw(spark, sf, "valuations")}
    out = None
    for name, df in tables.items():
        one = quality.check_violations(df, schemas.RANGE_CHECKS[name], name)
        out = one if out is None else out.union(one)
    return out


@query("minutes_over_limit", "DQ-10", """SELECT 'appearances' AS "table", 'minutes_played' AS "column", count(*) FILTER (minutes_played < 0 OR minutes_played > 100) AS violations FROM fx_appearances""")
def _(spark, sf):
    return quality.check_violations(pq.raw(spark, sf, "appearances"), {"minutes_played": (0, 100)}, "appearances")


_VOLUMES = """SELECT 'marts_clubs.unified_matches' AS "table", count(*) AS n_rows FROM q_unified UNION ALL SELECT 'marts_players.players', count(*) FROM q_players
UNION ALL SELECT 'marts_players.appearances_unified', count(*) FROM q_app_linked UNION ALL SELECT 'marts_players.player_valuations', count(*) FROM q_valuations
UNION ALL SELECT 'marts_ml.predictions_projection_carriere', count(*) FROM fx_predictions"""


def volumes(spark, sf):
    return stats.table_volumes({
        "marts_clubs.unified_matches": mq.unified(spark, sf), "marts_players.players": pq.players(spark, sf),
        "marts_players.appearances_unified": pq.linked(spark, sf), "marts_players.player_valuations": pq.valuations(spark, sf),
        "marts_ml.predictions_projection_carriere": pq.predictions(spark, sf)})


@query("table_volumes", "AG-15", _VOLUMES)
def _(spark, sf):
    return volumes(spark, sf)


# Players and predictions are expected as the raw tables have them, the others as declared.
_PER_TABLE = {"marts_players.players": "count(DISTINCT player_id) FROM fx_players", "marts_ml.predictions_projection_carriere": "count(*) FROM fx_predictions"}
_EXPECTED = " UNION ALL ".join(f"SELECT '{t}' AS \"table\", {_PER_TABLE.get(t, n)}" for t, n in C.EXPECTED_VOLUMES.items())


@query("expected_volumes", "DQ-11", f"""
SELECT e."table", e.expected, v.n_rows, e.expected = v.n_rows AS as_expected
FROM ({_EXPECTED}) AS e("table", expected) JOIN ({_VOLUMES}) v ON v."table" = e."table"
""")
def _(spark, sf):
    raw = pq.raw(spark, sf, "players").agg(F.count_distinct("player_id")).first()[0]
    expected = {**C.EXPECTED_VOLUMES, "marts_players.players": raw,
                "marts_ml.predictions_projection_carriere": pq.raw(spark, sf, "predictions").count()}
    return quality.expected_volumes(volumes(spark, sf), expected)


@query("player_profile", "AG-10", """
SELECT count(*) AS n_rows, count(*) FILTER (market_value_in_eur IS NULL) AS market_value_in_eur_nulls, count(*) FILTER (position IS NULL) AS position_nulls,
  count(*) FILTER (date_of_birth IS NULL) AS date_of_birth_nulls, count(DISTINCT player_id) AS player_id_distinct, count(DISTINCT current_club_id) AS current_club_id_distinct FROM fx_players
""")
def _(spark, sf):
    return stats.profile(pq.raw(spark, sf, "players"), ["market_value_in_eur", "position", "date_of_birth"], ["player_id", "current_club_id"])


@query("appearance_profile", "AG-10", "SELECT count(*) AS n_rows, count(*) FILTER (goals IS NULL) AS goals_nulls, count(DISTINCT player_id) AS player_id_distinct, count(DISTINCT game_id) AS game_id_distinct FROM fx_appearances")
def _(spark, sf):
    return stats.profile(pq.raw(spark, sf, "appearances"), ["goals"], ["player_id", "game_id"])


@query("merged_appearance_profile", "AG-10 AG-12", """
SELECT competition_id, count(*) AS n_rows, count(*) FILTER (goals IS NULL) AS goals_nulls, count(DISTINCT player_id) > 0 AS distinct_close, count(minutes_played) > 0 AS median_close
FROM fx_appearances GROUP BY 1
""")
def _(spark, sf):
    """Sketches stored per competition and month, merged per competition; the estimates are held against exact figures."""
    df, path = pq.raw(spark, sf, "appearances"), scratch(spark, "sketches")
    monthly = df.withColumn("month", F.trunc("date", "month"))
    stats.profile_sketches(monthly, ["competition_id", "month"], ["goals"], ["player_id"], ["minutes_played"]).write.parquet(path)
    merged = stats.merged_profile(spark.read.parquet(path), ["competition_id"], {"median": 0.5})
    at = F.col("minutes_played")
    exact = df.groupBy("competition_id").agg(F.count_distinct("player_id").alias("players"), F.percentile(at, [0.45, 0.55]).alias("around"))
    near = F.abs(F.col("player_id_distinct") - F.col("players")) <= F.greatest(F.lit(2), 0.08 * F.col("players"))
    inside = (F.col("minutes_played_median") >= F.floor(F.col("around")[0])) & (F.col("minutes_played_median") <= F.ceil(F.col("around")[1]))
    return merged.join(exact, "competition_id").select("competition_id", "n_rows", "goals_nulls", near.alias("distinct_close"), inside.alias("median_close"))


@query("join_coverage", "JN-11", """
SELECT 'appearances' AS child, count(*) AS n_joined FROM fx_appearances a JOIN q_players p ON p.player_id = a.player_id
UNION ALL SELECT 'transfers', count(*) FROM fx_transfers a JOIN q_players p ON p.player_id = a.player_id
UNION ALL SELECT 'valuations', count(*) FROM fx_valuations a JOIN q_players p ON p.player_id = a.player_id
""")
def _(spark, sf):
    parent = pq.players(spark, sf)
    out = None
    for t in ("appearances", "transfers", "valuations"):
        one = quality.join_coverage(pq.raw(spark, sf, t), parent).select(F.lit(t).alias("child"), "n_joined")
        out = one if out is None else out.union(one)
    return out


@query("alias_conflicts", "SC-1", """
SELECT lower(trim(alias)) AS alias_key, min(canonical) AS first_canonical, max(canonical) AS last_canonical
FROM (SELECT * FROM fx_aliases UNION ALL SELECT ' ' || upper(alias), canonical || ' B' FROM fx_aliases WHERE length(alias) = 6) a
GROUP BY 1 HAVING min(canonical) <> max(canonical)
""")
def _(spark, sf):
    """Some spellings are listed again, in capitals and for another club."""
    df = mq.aliases(spark, sf)
    other = df.filter(F.length("alias") == 6).select(F.concat(F.lit(" "), F.upper("alias")), F.concat("canonical", F.lit(" B")))
    return names.alias_conflicts(df.union(other))


# --- sources and sinks --------------------------------------------------------

_SNAPSHOT_SOURCES = {"players": "players", "clubs": "clubs", "player_valuations": "valuations", "transfers": "transfers",
                     "appearances": "appearances", "games": "games"}


def snapshot_tables(spark, sf):
    """The six snapshot tables with all their columns."""
    out = {}
    for name, source in _SNAPSHOT_SOURCES.items():
        df = pq.raw(spark, sf, source)
        out[name] = df.select(*[
            (F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in schemas.SNAPSHOT[name].items()])
    return out


def write_snapshot(spark, sf):
    """The six tables as CSV files with headers; some names hold a comma, a line break and quotes."""
    root = scratch(spark, "snapshot")
    for name, df in snapshot_tables(spark, sf).items():
        if name == "players":
            odd = F.concat("name", F.lit(',\n"x"'))
            df = df.withColumn("name", F.when(F.col("player_id") % 50 == 0, odd).otherwise(F.col("name")))
        df.write.options(header=True, quote='"', escape='"').csv(f"{root}/{name}.csv")
    return root


@query("read_snapshot_players", "SRC-3 PRJ-2", """
SELECT player_id, CAST(NULL AS VARCHAR) AS first_name, CAST(NULL AS VARCHAR) AS last_name,
  CASE WHEN player_id % 50 = 0 THEN name || ',' || chr(10) || '"x"' ELSE name END AS name, date_of_birth, position, CAST(NULL AS VARCHAR) AS sub_position, foot,
  height_in_cm, CAST(NULL AS VARCHAR) AS country_of_birth, country_of_citizenship, current_club_id, trim(current_club_name) AS current_club_name,
  current_club_domestic_competition_id, last_season, market_value_in_eur, highest_market_value_in_eur, international_caps, international_goals FROM fx_players
""")
def _(spark, sf):
    out = readers.read_snapshot(spark, write_snapshot(spark, sf))["players"]
    return out.withColumn("current_club_name", names.trimmed("current_club_name"))


@query("read_snapshot_appearances", "SRC-3 PRJ-2", "SELECT * FROM fx_appearances")
def _(spark, sf):
    return readers.read_snapshot(spark, write_snapshot(spark, sf))["appearances"]


@query("pruned_table", "SRC-4", "SELECT match_id, home_goals, away_goals FROM q_unified WHERE competition = 'PL' AND season = 1998")
def _(spark, sf):
    path = scratch(spark, "unified")
    writers.replace_table(mq.unified(spark, sf), path, ["competition", "season"])
    return readers.read_table(spark, path, ["match_id", "home_goals", "away_goals"], "competition = 'PL' AND season = 1998")


@query("landed_feed", "SRC-1 SRC-6", """
SELECT *, CASE WHEN game_id % 3 = 0 THEN 'Ground ' || home_club_id END AS ground, CASE WHEN game_id % 5 <> 0 THEN CAST(game_id % 90000 AS INT) END AS attendance FROM fx_feed
""")
def _(spark, sf):
    """Documents with fields that no schema names, some of an odd type, landed as they are and flattened from there."""
    df, path = mq.feed(spark, sf), scratch(spark, "raw")
    known = F.to_json(mq.feed_match(df))
    ground = F.when(F.col("game_id") % 3 == 0, F.concat(F.lit('"venue":{"name":"Ground '), "home_club_id", F.lit('"},'))).otherwise(F.lit(""))
    seen = F.when(F.col("game_id") % 5 == 0, F.lit('"sold out"')).otherwise((F.col("game_id") % 90000).cast("string"))
    match = F.concat(F.lit("{"), ground, F.lit('"attendance":'), seen, F.lit(","), F.substr(known, F.lit(2)))
    docs = df.select(F.concat(
        F.lit('{"competition":{"code":"'), "competition_id", F.lit('","name":"'), "competition_name", F.lit('"},"matches":['), match, F.lit("]}")).alias("value"))
    docs.write.text(f"{path}/in")
    writers.land_bronze(readers.read_raw_feed(spark, f"{path}/in", multi_line=False, glob="*.txt"), f"{path}/bronze")
    more = {"ground": ("$.venue.name", "string"), "attendance": ("$.attendance", "int")}
    return readers.matches_of_raw(spark.read.parquet(f"{path}/bronze"), more)


@query("replaced_standings", "SNK-1 SNK-2", "SELECT * FROM q_table")
def _(spark, sf):
    """Written twice; the second write leaves the same rows."""
    path = scratch(spark, "standings")
    for _run in range(2):
        writers.replace_table(mq.league_table(spark, sf), path, ["competition", "season"])
    return spark.read.parquet(path)


@query("exported_matches", "SNK-3", "SELECT match_id, source, competition, season, home_team, away_team, home_goals, away_goals, result, total_goals FROM q_unified")
def _(spark, sf):
    path = scratch(spark, "export")
    writers.export_csv(mq.unified(spark, sf), path)
    types = {"match_id": "string", "source": "string", "competition": "string", "season": "int", "home_team": "string", "away_team": "string",
             "home_goals": "int", "away_goals": "int", "result": "string", "total_goals": "int"}
    return clean.conform(spark.read.option("header", True).csv(path), types)


@query("refresh_log", "SNK-4 DQ-5", """
SELECT 'derived tables' AS source, v AS version, n AS number, (SELECT count(*) FROM fx_players) AS players,
  CASE WHEN n = 1 THEN (SELECT count(*) FROM fx_transfers) ELSE (SELECT count(*) FROM fx_transfers WHERE player_id % 20 <> 0) END AS transfers
FROM (VALUES ('1', CAST(1 AS BIGINT)), ('2', 2)) AS t(v, n)
""")
def _(spark, sf):
    """Two snapshots are admitted, the second with fewer transfers; the log and the commits name both, with the rows counted while writing."""
    store, tables = scratch(spark, "store"), snapshot_tables(spark, sf)
    snapshots.admit_snapshot(spark, tables, store, "1", "derived tables")
    snapshots.admit_snapshot(spark, {**tables, "transfers": tables["transfers"].filter("player_id % 20 <> 0")}, store, "2", "derived tables")
    log, commits = spark.read.parquet(f"{store}/log"), snapshots.commits(spark, store)
    both = log.select("source", "version").join(commits.select("version", "number", "rows"), "version")  # when is the clock's affair
    return both.select("source", "version", "number", F.col("rows")["players"].alias("players"), F.col("rows")["transfers"].alias("transfers"))


@query("admitted_snapshot", "DQ-5", """SELECT 'players' AS "table", count(*) AS n_rows FROM fx_players UNION ALL SELECT 'games', count(*) FROM fx_games""")
def _(spark, sf):
    """Tables of the admitted version; a snapshot without its transfers is refused in between."""
    store = scratch(spark, "store")
    tables = snapshot_tables(spark, sf)
    snapshots.admit_snapshot(spark, tables, store, "1")
    try:
        snapshots.admit_snapshot(spark, {**tables, "transfers": tables["transfers"].limit(0)}, store, "2")
    except snapshots.SnapshotRefused:
        pass
    return stats.table_volumes({n: snapshots.current_table(spark, store, n) for n in ("players", "games")})


_CHANGED = """
SELECT '{t}' AS file, {lines} AS lines_before, {lines} AS lines_now, CASE WHEN {changed} THEN 'updated' ELSE 'unchanged' END AS status FROM fx_{t}"""


@query("changed_files", "DQ-6", " UNION ALL ".join((
    _CHANGED.format(t="players", lines="count(*)", changed="false"),
    _CHANGED.format(t="clubs", lines="count(*)", changed="count(*) FILTER (club_id % 10 = 3) > 0"),
    _CHANGED.format(t="valuations", lines="count(*)", changed="count(*) > 1"),
    "SELECT 'transfers', count(*), NULL, 'absent' FROM fx_transfers", "SELECT 'games', NULL, count(*), 'updated' FROM fx_games")))
def _(spark, sf):
    """Two refreshes: players written again as they were, one club in ten renamed, valuations in another order, transfers gone, games new."""
    root = scratch(spark, "landing")
    tables = {t: pq.raw(spark, sf, t) for t in ("players", "clubs", "valuations", "transfers", "games")}
    renamed = F.when(F.col("club_id") % 10 == 3, F.concat("name", F.lit("!"))).otherwise(F.col("name"))
    second = {
        "players": tables["players"], "clubs": tables["clubs"].withColumn("name", renamed),
        "valuations": tables["valuations"].sortWithinPartitions(F.xxhash64(*tables["valuations"].columns)), "games": tables["games"]}
    looks = []
    for number, landed in enumerate(({t: df for t, df in tables.items() if t != "games"}, second)):
        for t, df in landed.items():
            df.write.csv(f"{root}/{number}/{t}.csv")
        files.manifest(spark, f"{root}/{number}", "*.csv", r"/(\w+)\.csv/").write.parquet(f"{root}-looks/{number}")
        looks.append(spark.read.parquet(f"{root}-looks/{number}"))
    return files.detect_changed_files(looks[1], looks[0])


@query("file_inventory", "DQ-12", " UNION ALL ".join(
    f"""SELECT '{name}' AS "table", count(*) AS records, {len(schemas.SNAPSHOT[name])} AS n_columns FROM fx_{source}""" for name, source in _SNAPSHOT_SOURCES.items()))
def _(spark, sf):
    found = files.file_inventory(spark, write_snapshot(spark, sf))
    by_table = found.groupBy(F.regexp_extract("path", r"/(\w+)\.csv/", 1).alias("table"))
    return by_table.agg(F.sum("records").alias("records"), F.max("n_columns").alias("n_columns")).filter("table <> ''")
