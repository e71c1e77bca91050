"""Matches: flatten, unify over sources, compare, standings, home advantage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline import constants as C
from touchline.functions import columns as X
from touchline.operators import clean
from touchline.operators.dedup import keep_first, prefer_source
from touchline.operators.names import normalize_team
from touchline.schemas import ENRICHED_MATCH, SEASON_STATS


def flatten_matches(feed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per match out of the nested feed rows (13 columns, after those to ``keep``)."""
    m = feed.select(*keep, "competition", F.explode("matches").alias("m"))
    return m.select(
        *keep,
        X.to_long("m.id").alias("game_id"),
        F.col("competition.code").alias("competition_id"),
        F.col("competition.name").alias("competition_name"),
        X.to_int(F.substring("m.season.startDate", 1, 4)).alias("season"),
        X.to_date(F.substring("m.utcDate", 1, 10)).alias("date"),
        X.to_int("m.matchday").alias("round"),
        F.col("m.homeTeam.name").alias("home_club_name"),
        F.col("m.awayTeam.name").alias("away_club_name"),
        X.to_long("m.homeTeam.id").alias("home_club_id"),
        X.to_long("m.awayTeam.id").alias("away_club_id"),
        X.to_int("m.score.fullTime.home").alias("home_club_goals"),
        X.to_int("m.score.fullTime.away").alias("away_club_goals"),
        F.col("m.status").alias("status"),
    )


def clean_matches(flat: DataFrame) -> DataFrame:
    """Finished feed matches, one row per game, with result, goals and points.

    The dedup comes before the status filter, as a game may be listed twice
    with different status.
    """
    df = clean.finished_only(keep_first(flat, ["game_id"]))
    df = df.withColumns({
        "result": X.match_result("home_club_goals", "away_club_goals"),
        "total_goals": X.total_goals("home_club_goals", "away_club_goals"),
    })
    df = clean.replace_columns(df, X.neg_to_null, ["home_club_goals", "away_club_goals"])
    return df.withColumns({
        "home_points": X.points("result", "home"),
        "away_points": X.points("result", "away"),
    })


def feed_for_union(flat: DataFrame, aliases: DataFrame) -> DataFrame:
    """Finished feed matches in the shape of the unified table."""
    df = clean.finished_only(flat).select(
        F.lit("api").alias("source"),
        X.competition_code("competition_id", default="competition_id").alias("competition"),
        "date", "season", "round",
        F.col("home_club_name").alias("home_team"), F.col("away_club_name").alias("away_team"),
        F.col("home_club_goals").alias("home_goals"), F.col("away_club_goals").alias("away_goals"),
    )
    return with_match_id(normalize_team(df, aliases, ["home_team", "away_team"]))


def season_for_union(
    rows: DataFrame,
    aliases: DataFrame,
    first_season: int = C.FIRST_SEASON,
    first_day=C.FIRST_MATCH_DAY,
    last_day=C.LAST_MATCH_DAY,
) -> DataFrame:
    """Season-file rows in the shape of the unified table.

    Rows with a bad date or a missing score, and rows outside the window, go.
    """
    df = rows.select(
        F.lit("football_datasets").alias("source"),
        "competition",
        X.day_first_date("Date").alias("date"),
        "season",
        F.lit(None).cast("int").alias("round"),
        F.col("HomeTeam").alias("home_team"), F.col("AwayTeam").alias("away_team"),
        X.to_int("FTHG").alias("home_goals"), X.to_int("FTAG").alias("away_goals"),
        *[X.to_int(s).alias(name) for s, name in SEASON_STATS.items()],
    )
    df = clean.date_window(df.filter(F.col("season") >= first_season), first_day, last_day)
    df = clean.with_keys(df, "home_goals", "away_goals")
    return with_match_id(normalize_team(df, aliases, ["home_team", "away_team"]))


def with_match_id(df: DataFrame) -> DataFrame:
    return df.select(X.match_id("date", "home_team", "away_team", "competition").alias("match_id"), "*")


def unify_matches(feed: DataFrame, season_rows: DataFrame) -> DataFrame:
    """One row per match over both sources; the feed wins.

    The dedup runs before the score filter, so a feed row without a score
    still displaces a season-file row, and the match is then dropped.
    """
    both = feed.unionByName(season_rows, allowMissingColumns=True)
    df = clean.score_range(prefer_source(both))
    return df.withColumns({
        "result": X.match_result("home_goals", "away_goals"),
        "total_goals": X.total_goals("home_goals", "away_goals"),
    })


def score_conflicts(unified: DataFrame, season_rows: DataFrame) -> DataFrame:
    """Matches of the feed whose season-file row has another score.

    A few columns of many rows look small in the statistics of compressed
    files, so the planner is not left to send them to every task.
    """
    a = unified.filter(F.col("source") == "api").select(
        "match_id", "home_team", "away_team",
        F.col("home_goals").alias("api_hg"), F.col("away_goals").alias("api_ag"),
    )
    b = season_rows.select(
        "match_id", F.col("home_goals").alias("fd_hg"), F.col("away_goals").alias("fd_ag")
    )
    same = F.col("api_hg").eqNullSafe(F.col("fd_hg")) & F.col("api_ag").eqNullSafe(F.col("fd_ag"))
    return a.join(b.hint("merge"), "match_id").filter(~same)


def common_ids(a: DataFrame, b: DataFrame, key: str = "match_id") -> DataFrame:
    """Rows of ``a`` whose key is also in ``b``.

    The keys of ``b`` are cut to distinct ones before they are shuffled, and
    never broadcast: there may be as many as rows.
    """
    return a.join(b.select(key).distinct().hint("merge"), key, "left_semi")


def keys_by_side(a: DataFrame, b: DataFrame, key: str = "match_id") -> DataFrame:
    """Each key of either table once, with ``in_a`` and ``in_b``; a missing key is a key like any other.

    One aggregate over both: a task sends each key once, and no side is
    gathered in the driver.
    """
    marked = a.select(key, F.lit(True).alias("in_a"), F.lit(False).alias("in_b")).unionByName(
        b.select(key, F.lit(False).alias("in_a"), F.lit(True).alias("in_b")))
    return marked.groupBy(key).agg(F.bool_or("in_a").alias("in_a"), F.bool_or("in_b").alias("in_b"))


def with_points(unified: DataFrame) -> DataFrame:
    """Readable competition name and the points of each side."""
    return unified.withColumns({
        "competition_name": X.competition_label("competition", default="competition"),
        "home_points": X.points("result", "home"),
        "away_points": X.points("result", "away"),
    })


def select_enriched(matches: DataFrame) -> DataFrame:
    return matches.select(*ENRICHED_MATCH)


SEASON_KEYS = ("competition", "competition_name", "season")


def standings(
    matches: DataFrame,
    keys: Sequence[str] = SEASON_KEYS,
    home: dict[str, str] | None = None,
    away: dict[str, str] | None = None,
    home_goals: str = "home_goals",
    away_goals: str = "away_goals",
    conceded_mean: bool = True,
) -> DataFrame:
    """League table: both sides of a match as two rows, then one aggregate.

    One scan and one shuffle, and the shuffle carries partial sums per club.
    ``home``/``away`` map the output club columns to the columns of each side.
    """
    home = home or {"club_name": "home_team"}
    away = away or {"club_name": "away_team"}

    def side(clubs, won, lost, scored, conceded, pts):
        return F.struct(
            *[F.col(source).alias(out) for out, source in clubs.items()],
            F.col(pts).alias("pts"), F.col(scored).alias("gf"), F.col(conceded).alias("ga"),
            (F.col("result") == won).cast("int").alias("w"),
            (F.col("result") == "draw").cast("int").alias("d"),
            (F.col("result") == lost).cast("int").alias("l"),
        )

    sides = F.array(
        side(home, "home", "away", home_goals, away_goals, "home_points"),
        side(away, "away", "home", away_goals, home_goals, "away_points"),
    )
    rows = matches.select(*keys, F.explode(sides).alias("s")).select(*keys, "s.*")
    table = rows.groupBy(*keys, *home).agg(
        F.count(F.lit(1)).alias("matchs_joues"),
        F.sum("pts").alias("points"),
        F.sum("gf").alias("buts_marques"),
        F.sum("ga").alias("buts_encaisses"),
        F.sum("w").alias("victoires"),
        F.sum("d").alias("nuls"),
        F.sum("l").alias("defaites"),
    )
    return with_differences(table, conceded_mean)


# What a league table adds up; all its other numbers follow from these.
TABLE_SUMS = ("matchs_joues", "points", "buts_marques", "buts_encaisses", "victoires", "nuls", "defaites")


def with_differences(table: DataFrame, conceded_mean: bool = True) -> DataFrame:
    """Goal difference and means from the sums."""
    table = table.withColumn("diff_buts", F.col("buts_marques") - F.col("buts_encaisses"))
    table = table.withColumn("moy_buts_par_match", _mean("buts_marques"))
    return table.withColumn("moy_buts_encaisses_par_match", _mean("buts_encaisses")) if conceded_mean else table


def _mean(goals: str):
    return F.round(F.col(goals).cast("double") / F.nullif(F.col("matchs_joues"), F.lit(0)), 2)


def standings_by_club_id(matches: DataFrame) -> DataFrame:
    """League table of the feed alone, by club id."""
    return standings(
        matches,
        ("competition_id", "competition_name", "season"),
        {"club_id": "home_club_id", "club_name": "home_club_name"},
        {"club_id": "away_club_id", "club_name": "away_club_name"},
        "home_club_goals", "away_club_goals", conceded_mean=False,
    )


TABLE_ORDER = ("points", "diff_buts", "buts_marques")


def league_positions(table: DataFrame, keys: Sequence[str] = ("competition", "season"), club: str = "club_name") -> DataFrame:
    """Position in the league: points, then difference, then goals, then name.

    The window holds the clubs of one league season only.
    """
    order = [F.col(c).desc() for c in TABLE_ORDER] + [F.col(club)]
    return table.withColumn("position", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def sort_standings(table: DataFrame, newest_first: bool = True) -> DataFrame:
    competition = "competition" if "competition" in table.columns else "competition_id"
    season = F.col("season").desc() if newest_first else F.col("season")
    return table.orderBy(competition, season, *[F.col(c).desc() for c in TABLE_ORDER])


def home_advantage(matches: DataFrame, keys: Sequence[str] = SEASON_KEYS) -> DataFrame:
    """Home wins, away wins, draws and mean goals per league season."""
    def won(side):
        return F.count_if(F.col("result") == side)

    n = F.count(F.lit(1))
    return matches.groupBy(*keys).agg(
        n.alias("total_matchs"),
        won("home").alias("victoires_domicile"),
        won("away").alias("victoires_exterieur"),
        won("draw").alias("nuls"),
        F.round(won("home") * F.lit(100.0) / n, 1).alias("pct_victoires_domicile"),
        F.round(F.avg("total_goals"), 2).alias("moy_buts_par_match"),
        F.round(F.avg("home_goals"), 2).alias("moy_buts_domicile"),
        F.round(F.avg("away_goals"), 2).alias("moy_buts_exterieur"),
    )
