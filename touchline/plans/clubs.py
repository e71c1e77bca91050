"""Raw match files to the club marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from touchline import constants as C
from touchline.operators import matches as M
from touchline.operators.players import unify_clubs
from touchline.sources import readers, writers


def unified_matches(flat: DataFrame, season_rows: DataFrame, aliases: DataFrame, first_season: int = C.FIRST_SEASON,
                    first_day=C.FIRST_MATCH_DAY, last_day=C.LAST_MATCH_DAY) -> DataFrame:
    """Flat feed matches and season rows to the unified table."""
    return M.unify_matches(
        M.feed_for_union(flat, aliases),
        M.season_for_union(season_rows, aliases, first_season, first_day, last_day),
    )


def build_club_marts(spark: SparkSession, feed: str, seasons: str, aliases: DataFrame, clubs: DataFrame | None = None) -> None:
    """Write the staging and club tables. A second run gives the same tables."""
    writers.create_schemas(spark)
    flat = readers.read_match_feed(spark, feed)
    writers.replace_table(flat, "staging.stg_matches_api")
    flat = spark.table("staging.stg_matches_api")

    played = M.clean_matches(flat)
    writers.replace_table(played, "marts_clubs.matches")
    by_id = M.standings_by_club_id(spark.table("marts_clubs.matches"))
    writers.replace_table(by_id, "marts_clubs.classements_equipes")

    unified = unified_matches(flat, readers.read_season_csv(spark, seasons), aliases)
    writers.replace_table(unified, "marts_clubs.unified_matches", ["competition", "season"])

    # three readers of the written table, not of the plan that made it
    rows = M.with_points(spark.table("marts_clubs.unified_matches"))
    writers.replace_table(M.standings(rows), "marts_clubs.classements_equipes_unified")
    writers.replace_table(M.home_advantage(rows), "marts_clubs.avantage_domicile")
    writers.replace_table(M.select_enriched(rows), "marts_clubs.matches_enrichis")
    writers.replace_table(readers.competitions_dim(spark), "marts_clubs.competitions")
    if clubs is not None:
        writers.replace_table(unify_clubs(clubs, aliases), "marts_clubs.clubs_unified")
