"""Player snapshot to the player marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from touchline import constants as C
from touchline.operators import clean
from touchline.operators import players as P
from touchline.sources import writers


def performance(appearances: DataFrame, players: DataFrame, first_day=C.PERFORMANCE_SINCE) -> DataFrame:
    """Raw appearances and raw players to performance per player and competition."""
    return P.player_performance(clean.clean_appearances(appearances, first_day), clean.clean_players(players))


STAGING = {"player_valuations": "valuations"}


def build_player_marts(
    spark: SparkSession, snapshot: dict[str, DataFrame], aliases: DataFrame, as_of,
    performance_since=C.PERFORMANCE_SINCE, linked_since=C.UNIFIED_SINCE,
) -> None:
    """Write the staging and player tables from the typed snapshot tables."""
    writers.create_schemas(spark)
    raw = {}
    for name, df in snapshot.items():
        table = f"staging.stg_{STAGING.get(name, name)}"
        writers.replace_table(df, table)
        raw[name] = spark.table(table)

    writers.replace_table(clean.clean_players(raw["players"]), "marts_players.players")
    writers.replace_table(clean.clean_clubs(raw["clubs"]), "marts_players.clubs")
    writers.replace_table(clean.clean_valuations(raw["player_valuations"]), "marts_players.player_valuations")
    writers.replace_table(clean.clean_transfers(raw["transfers"], as_of), "marts_players.transfers")

    players = spark.table("marts_players.players")
    played = P.with_player_profile(clean.clean_appearances(raw["appearances"]), players)
    writers.replace_table(played, "marts_players.appearances")
    writers.replace_table(performance(raw["appearances"], players, performance_since), "marts_players.player_performance")

    linked = P.link_appearances(raw["appearances"], raw["games"], aliases, linked_since)
    writers.replace_table(linked, "marts_players.appearances_unified")
    predictions = "marts_ml.predictions_projection_carriere"
    last = spark.table(predictions) if spark.catalog.tableExists(predictions) else None
    enriched = P.enrich_players(players, spark.table("marts_players.player_performance"), last, aliases, as_of)
    writers.replace_table(enriched, "marts_players.players_enriched")
