"""Player marts to the career projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import constants as C
from touchline.operators import features, models
from touchline.operators.players import youth_stats
from touchline.sources import writers

OUTPUT = ["player_id", "name", "position", "age_actuel", "current_club_name", "valeur_actuelle",
          "goals_per_90_jeune", "assists_per_90_jeune", "minutes_jeune", "matchs_jeune", "valeur_projetee"]


def train_and_score(
    appearances: DataFrame, players: DataFrame, valuations: DataFrame, as_of, trees: int = C.GBT_TREES
) -> tuple[models.Projection, DataFrame]:
    """Fit on players now 22 to 35, score players now 16 to 22.

    Both tables start from the youth statistics, so these are kept once.
    """
    youth = youth_stats(appearances, players).persist()
    projection = models.train_projection(features.projection_dataset(youth, players, valuations, as_of), trees=trees)
    scored = models.score_projection(features.projection_candidates(youth, players, as_of), projection)
    return projection, scored


def output(scored: DataFrame) -> DataFrame:
    """The prediction table: values in whole euros."""
    return scored.select(*OUTPUT).withColumn("valeur_projetee", F.round("valeur_projetee", 0))


def build_projection_marts(spark: SparkSession, as_of, model_path: str, trees: int = C.GBT_TREES) -> models.Projection:
    """Train from the player marts, store the models and write the predictions."""
    writers.create_schemas(spark)
    projection, scored = train_and_score(
        spark.table("marts_players.appearances_unified"), spark.table("marts_players.players"),
        spark.table("marts_players.player_valuations"), as_of, trees,
    )
    models.save_projection(projection, model_path, spark)
    writers.replace_table(output(scored), "marts_ml.predictions_projection_carriere")
    return projection
