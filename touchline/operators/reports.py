"""Rankings, pages and the scouting queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions import columns as X
from touchline.operators.dedup import keep_first


def top(df: DataFrame, by: str, k: int, tie: str) -> DataFrame:
    """The ``k`` largest by one column; each task keeps ``k`` rows, no full sort."""
    return df.orderBy(F.col(by).desc_nulls_last(), tie).limit(k)


def top_scorers(performance: DataFrame, min_minutes: int = 500, k: int = 10) -> DataFrame:
    best = performance.filter(F.col("total_minutes") >= min_minutes)
    order = [F.col("goals_per_90").desc(), F.col("player_id"), F.col("competition_id"), F.col("player_name")]
    return best.orderBy(*order).limit(k).select(
        "player_id", "competition_id", "total_goals", "total_minutes", "goals_per_90"
    )


def top_prospects(predictions: DataFrame, k: int = 10) -> DataFrame:
    return top(predictions, "valeur_projetee", k, "player_id")


PAGE = ["player_id", "name", "position", "age_actuel", "current_club_name", "valeur_actuelle",
        "valeur_projetee", "goals_per_90_jeune", "assists_per_90_jeune", "matchs_jeune"]


def page(predictions: DataFrame, limit: int = 20, offset: int = 0) -> DataFrame:
    """One page of the predictions, best first."""
    columns = [c for c in PAGE if c in predictions.columns]
    ranked = predictions.select(*columns).orderBy(F.col("valeur_projetee").desc_nulls_last(), "player_id")
    return ranked.offset(offset).limit(limit)


def find(predictions: DataFrame, player_id: int) -> DataFrame:
    columns = [c for c in PAGE if c in predictions.columns]
    return predictions.filter(F.col("player_id") == player_id).select(*columns)


def season_table(table: DataFrame, competition: str, season: int, k: int | None = None) -> DataFrame:
    """League table of one season, best first."""
    out = table.filter((F.col("competition") == competition) & (F.col("season") == season))
    out = out.orderBy(F.col("points").desc(), F.col("diff_buts").desc(), F.col("buts_marques").desc(), "club_name")
    return out if k is None else out.limit(k)


def best_attacks(table: DataFrame, k: int = 10) -> DataFrame:
    order = [F.col("moy_buts_par_match").desc(), F.col("buts_marques").desc(), *map(F.col, ("competition", "season", "club_name"))]
    return table.orderBy(*order).limit(k)


def best_defences(table: DataFrame, k: int = 10) -> DataFrame:
    order = [F.col("moy_buts_encaisses_par_match"), F.col("buts_encaisses"), *map(F.col, ("competition", "season", "club_name"))]
    return table.orderBy(*order).limit(k)


def undervalued_players(performance: DataFrame, k: int = 20) -> DataFrame:
    """Best value efficiency, each player once with the best competition."""
    best = keep_first(performance, ["player_id"], [F.col("value_efficiency").desc_nulls_last()])
    return top(best, "value_efficiency", k, "player_id")


def gems(predictions: DataFrame, ceiling: float = 5_000_000, k: int = 20) -> DataFrame:
    """Best projected players whose current value is below ``ceiling``."""
    cheap = predictions.filter(F.col("valeur_actuelle") < ceiling)
    return top(cheap, "valeur_projetee", k, "player_id").withColumn(
        "progression_pct", X.progression_pct("valeur_projetee", "valeur_actuelle", None)
    )


def evaluate_predictions(df: DataFrame, predicted: str, actual: str, model: str) -> DataFrame:
    """Predicted beside actual value, gap, gap in percent and bucket."""
    out = df.withColumns({
        "predicted_value": F.round(predicted, 0),
        "actual_value": F.col(actual),
        "model_name": F.lit(model),
    })
    out = out.withColumns({
        "difference": F.col("predicted_value") - F.col("actual_value"),
        "difference_pct": X.difference_pct("predicted_value", "actual_value"),
    })
    return out.withColumn("evaluation", X.evaluation("difference_pct"))


def residuals(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    return df.withColumn("residual", F.col(actual) - F.col(predicted))


def scouting_report(scored: DataFrame) -> DataFrame:
    """All a scout reads about a scored player, for a whole table at once.

    Needs ``valeur_projetee``, ``valeur_actuelle``, ``age_actuel``,
    ``minutes_jeune``, ``valeur_moyenne_club`` and ``modele_utilise``.
    """
    out = scored.withColumns({
        "progression_pct": X.progression_pct("valeur_projetee", "valeur_actuelle"),
        "age_pic_min": X.peak_age_min("age_actuel"),
        "age_pic_max": X.peak_age_max("age_actuel"),
        "interpretation": X.potential_tier("valeur_projetee"),
        "reliability": X.reliability("age_actuel"),
        "data_volume": X.data_volume("minutes_jeune"),
        "club_level": X.club_level("valeur_moyenne_club"),
        "valeur_projetee_texte": X.money_text("valeur_projetee"),
        "valeur_actuelle_texte": F.when(
            F.col("valeur_actuelle") > 0, X.money_text("valeur_actuelle")
        ).otherwise("Non référencé"),
    })
    known = X.progression_pct("valeur_projetee", "valeur_actuelle", None)
    return out.withColumn("signal", X.opportunity(known)).withColumn("valeur_projetee", F.round("valeur_projetee", 0))
