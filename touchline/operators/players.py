"""Players: performance, rollups, links to matches, enrichment, youth statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline import constants as C
from touchline.functions import columns as X
from touchline.operators import clean
from touchline.operators.matches import with_match_id
from touchline.operators.names import normalize_team
from touchline.session import kept_in_files


def with_player_profile(appearances: DataFrame, players: DataFrame) -> DataFrame:
    """Appearances with the player's name, position and value, where known."""
    profile = players.select("player_id", F.col("name").alias("player_name"), "position", "market_value_in_eur")
    return appearances.drop("player_name").join(profile, "player_id", "left")


def player_performance(appearances: DataFrame, players: DataFrame, min_minutes: int = 90) -> DataFrame:
    """Sums and per-90 ratios per player and competition, for players with a value.

    The appearances are summed before they meet the players, so the join sees
    one row per player, name and competition, however often a player played.
    """
    total = appearances.groupBy("player_id", "player_name", "competition_id").agg(
        F.count(F.lit(1)).alias("matchs_joues"),
        F.sum("goals").alias("total_goals"),
        F.sum("assists").alias("total_assists"),
        F.sum("minutes_played").alias("total_minutes"),
        F.sum("yellow_cards").alias("total_yellow_cards"),
        F.sum("red_cards").alias("total_red_cards"),
        F.round(F.avg("minutes_played"), 1).alias("avg_minutes_per_match"),
    ).filter(F.col("total_minutes") >= min_minutes)
    valued = players.select("player_id", "position", "market_value_in_eur").filter("market_value_in_eur > 0")
    both = F.col("total_goals") + F.col("total_assists")
    return total.join(valued, "player_id").withColumns({
        "goals_per_90": X.per90("total_goals", "total_minutes", 3),
        "assists_per_90": X.per90("total_assists", "total_minutes", 3),
        "goal_contributions_per_90": X.per90(both, "total_minutes", 3),
        "value_efficiency": F.round(
            both * F.lit(90.0) / F.nullif(F.col("total_minutes"), F.lit(0))
            / (F.col("market_value_in_eur") / F.lit(1e6)), 4),
    })


RATIOS = {
    "goals_per_90": 3, "assists_per_90": 3, "goal_contributions_per_90": 3, "value_efficiency": 4,
}


def player_rollup(performance: DataFrame) -> DataFrame:
    """Per player: sums of the sums, plain means of the per-competition ratios."""
    return performance.groupBy("player_id").agg(
        F.sum("matchs_joues").alias("matchs_joues_total"),
        F.sum("total_goals").alias("total_goals"),
        F.sum("total_assists").alias("total_assists"),
        F.sum("total_minutes").alias("total_minutes"),
        *[_decimal_mean(c, digits).alias(c) for c, digits in RATIOS.items()],
    )


def player_rollup_weighted(performance: DataFrame) -> DataFrame:
    """As :func:`player_rollup`, with the ratios taken over all minutes."""
    out = performance.groupBy("player_id").agg(
        F.sum("matchs_joues").alias("matchs_joues_total"),
        F.sum("total_goals").alias("total_goals"),
        F.sum("total_assists").alias("total_assists"),
        F.sum("total_minutes").alias("total_minutes"),
    )
    return out.withColumns({
        "goals_per_90_weighted": X.per90("total_goals", "total_minutes", 3),
        "assists_per_90_weighted": X.per90("total_assists", "total_minutes", 3),
    })


def _decimal_mean(name: str, digits: int):
    """Mean of values already rounded to ``digits``, summed and divided exactly.

    A sum of doubles depends on the order tasks finish in, and a tie such as
    1.3115 would round either way; decimals avoid both.
    """
    total = F.sum(F.col(name).cast(f"decimal(18,{digits})"))
    return F.round(total / F.nullif(F.count(name), F.lit(0)), digits).cast("double")


def link_games(games: DataFrame, aliases: DataFrame, first_day=C.UNIFIED_SINCE) -> DataFrame:
    """Unified match id of every snapshot game in a covered league."""
    df = clean.since(games, first_day).select(
        "game_id", "date",
        X.lookup("competition_id", C.SNAPSHOT_COMPETITIONS).alias("competition"),
        F.col("home_club_name").alias("home_norm"), F.col("away_club_name").alias("away_norm"),
        "home_club_goals", "away_club_goals",
    )
    df = normalize_team(clean.with_keys(df, "competition"), aliases, ["home_norm", "away_norm"])
    named = df.withColumnsRenamed({"home_norm": "home_team", "away_norm": "away_team"})
    return with_match_id(named).withColumnsRenamed({"home_team": "home_norm", "away_team": "away_norm"})


def link_appearances(appearances: DataFrame, games: DataFrame, aliases: DataFrame, first_day=C.UNIFIED_SINCE) -> DataFrame:
    """Every appearance since ``first_day`` with its match, where one is known.

    A few columns of all games look small in the statistics of compressed
    files, so the planner is not left to send them to every task.
    """
    linked = link_games(games, aliases, first_day).select(
        "game_id", "match_id", "competition", "home_norm", "away_norm"
    )
    return clean.since(appearances, first_day).join(linked.hint("merge"), "game_id", "left")


def count_links(appearances: DataFrame, games: DataFrame, aliases: DataFrame, first_day=C.UNIFIED_SINCE) -> DataFrame:
    """The appearances of :func:`link_appearances` as recorded, with the number of rows it makes of each as ``copies``.

    Only games that are listed more than once make more than one. These are
    few, and written down, so the appearances need not move to meet the games.
    """
    listed = link_games(games, aliases, first_day).groupBy("game_id").agg(F.count(F.lit(1)).alias("copies"))
    repeated = kept_in_files(listed.filter("copies > 1 and game_id is not null"))
    return clean.since(appearances, first_day).join(repeated, "game_id", "left").withColumn("copies", F.coalesce("copies", F.lit(1)))


def enrich_players(
    players: DataFrame,
    performance: DataFrame,
    predictions: DataFrame | None,
    aliases: DataFrame,
    as_of,
) -> DataFrame:
    """Players with club, league, age, performance and the last prediction.

    ``predictions`` is the table of the previous run; pass ``None`` on the first.
    """
    df = clean.known_position(players)
    df = normalize_team(df, aliases, {"current_club_name": "current_club_normalized"})
    df = df.withColumn("current_competition", X.lookup("current_club_domestic_competition_id", C.SNAPSHOT_COMPETITIONS))
    df = df.withColumns({
        "current_competition_name": X.competition_label("current_competition"),
        "age": X.age_decimal("date_of_birth", F.lit(as_of).cast("date"), 1),
    })
    df = df.join(player_rollup(performance), "player_id", "left")
    if predictions is None:
        return df.withColumns({"actual_value": F.lit(None).cast("double"), "predicted_value": F.lit(None).cast("double")})
    last = predictions.select(
        "player_id", F.col("valeur_actuelle").alias("actual_value"), F.col("valeur_projetee").alias("predicted_value")
    )
    return df.join(last, "player_id", "left")


def unify_clubs(clubs: DataFrame, aliases: DataFrame) -> DataFrame:
    """Clubs with normalised name, standard competition code and its name."""
    df = normalize_team(clubs, aliases, {"name": "name_normalized"})
    df = df.withColumn("competition", X.lookup("domestic_competition_id", C.SNAPSHOT_COMPETITIONS))
    return df.withColumn("competition_name", X.competition_label("competition"))


def youth_stats(
    appearances: DataFrame,
    players: DataFrame,
    min_age: int = 16,
    max_age: int = 21,
    min_minutes: int = 500,
) -> DataFrame:
    """Statistics per player over the appearances made at ``min_age``..``max_age``.

    Counting the distinct competitions makes Spark sum per player and
    competition first, which keeps a hot player to one row per competition.
    A row with ``copies``, see :func:`count_links`, counts that many times.
    """
    born = players.select("player_id", "date_of_birth")
    copies = F.col("copies") if "copies" in appearances.columns else F.lit(1).cast("bigint")
    aged = appearances.select(
        "player_id", "date", "competition_id", *[(F.col(c) * copies).alias(c) for c in ("goals", "assists", "minutes_played")], copies.alias("copies")
    ).join(born, "player_id").withColumn("age", X.age_calendar("date_of_birth", "date"))
    total = aged.filter(F.col("age").between(min_age, max_age)).groupBy("player_id").agg(
        F.sum("copies").alias("matchs_jeune"),
        F.sum("goals").alias("buts_jeune"),
        F.sum("assists").alias("passes_jeune"),
        F.sum("minutes_played").alias("minutes_jeune"),
        F.min("age").alias("age_premier_match"),
        F.countDistinct("competition_id").alias("nb_competitions_jeune"),
    )
    return total.filter(F.col("minutes_jeune") >= min_minutes).withColumns({
        "goals_per_90_jeune": X.per90("buts_jeune", "minutes_jeune", 4),
        "assists_per_90_jeune": X.per90("passes_jeune", "minutes_jeune", 4),
    })


def club_values(players: DataFrame) -> DataFrame:
    """Mean player value, in whole euros, and number of players per club."""
    return clean.with_keys(players, "market_value_in_eur").groupBy("current_club_id").agg(
        F.round(F.avg("market_value_in_eur"), 0).alias("valeur_moyenne_club"),
        F.count(F.lit(1)).alias("nb_joueurs_club"),
    )


def latest_by(df: DataFrame, key: str, ts: str, *values: str) -> DataFrame:
    """Values of the newest row per key; ties go to the largest values.

    A maximum over a struct is combined before the shuffle and needs no sort
    of a whole group, unlike a rank over it.
    """
    newest = F.max(F.struct(ts, *values)).alias("newest")
    return df.groupBy(key).agg(newest).select(key, "newest.*")
