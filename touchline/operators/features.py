"""Feature tables of the value models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline import constants as C
from touchline.functions import columns as X
from touchline.operators import clean
from touchline.operators.periods import consecutive_pairs, interval_join
from touchline.operators.players import club_values, latest_by
from touchline.session import cut_lineage


# Values that may become a column of their own.
MOST_COLUMNS = 1_000


def vocabularies(df: DataFrame, columns: Sequence[str], most: int = MOST_COLUMNS) -> dict[str, list[str]]:
    """Sorted distinct values of categorical columns, read in one pass to fix the
    0/1 columns of train and score alike.

    One column per value is as wide as the vocabulary, so more than ``most``
    values in all are an error: group rare values first (:func:`top_n_or_other`),
    or take one number for each value (:func:`code_by_join`).
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in columns]))
    found = df.select(pairs.alias("p")).select("p.*").filter("v IS NOT NULL").distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} values in {list(columns)}: too many for columns of their own")
    return {c: sorted(r["v"] for r in found if r["c"] == c) for c in columns}


def dictionary(df: DataFrame, column: str) -> DataFrame:
    """``column``, ``code``: the distinct values numbered from 0 in their order, however many there are.

    Values are sorted by ranges and kept in the checkpoint folder; the sizes of
    the ranges before add up to a value's number. NULL has no number.
    """
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    ranged = cut_lineage(values.repartitionByRange(column).withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    starts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    starts = starts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(column)) - 1
    return ranged.withColumn("_within", within).join(starts, "_range").select(column, (F.col("_start") + F.col("_within")).alias("code"))


def code_by_join(df: DataFrame, column: str, out: str, codes: DataFrame | None = None) -> DataFrame:
    """Add each value's number in a dictionary; NULL, and values the dictionary lacks, get NULL.

    Pass the dictionary of the training run when scoring.
    """
    codes = (dictionary(df, column) if codes is None else codes).withColumnRenamed("code", out)
    return df.join(codes, column, "left")


def one_hot_vector(df: DataFrame, column: str, out: str) -> DataFrame:
    """A sparse 0/1 vector per row, whatever the number of values; NULL has a place of its own."""
    indexer = StringIndexer(inputCol=column, outputCol=f"_{out}", stringOrderType="alphabetAsc", handleInvalid="keep")
    encoder = OneHotEncoder(inputCol=f"_{out}", outputCol=out, dropLast=False)
    return Pipeline(stages=[indexer, encoder]).fit(df).transform(df).drop(f"_{out}")


def one_hot(df: DataFrame, column: str, prefix: str, values: Sequence[str]) -> DataFrame:
    """One 0/1 column per value of a fixed vocabulary; NULL and unseen give zeros."""
    return df.withColumns({
        f"{prefix}_{v}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0)) for v in values
    })


def top_values(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return counts.orderBy(F.col("_n").desc(), column).limit(n).select(column)


def top_n_or_other(df: DataFrame, column: str, out: str, n: int = 20) -> DataFrame:
    """Keep the ``n`` most frequent values, the rest becomes ``other``.

    The broadcast side holds at most ``n`` rows.
    """
    top = F.broadcast(top_values(df, column, n).withColumn(out, F.col(column)))
    return df.join(top, column, "left").withColumn(out, F.coalesce(out, F.lit("other")))


def _projection_rows(youth: DataFrame, players: DataFrame, as_of, low: int, high: int) -> DataFrame:
    """Youth statistics with profile, club level and age today inside the limits."""
    aged = players.withColumn("age_actuel", X.age_calendar("date_of_birth", F.lit(as_of).cast("date")))
    profile = aged.filter(F.col("age_actuel").between(low, high)).drop("date_of_birth")
    rows = youth.join(profile, "player_id")
    rows = rows.join(club_values(players), "current_club_id", "left")
    return clean.fill(rows, {"valeur_moyenne_club": 0.0}).drop("nb_joueurs_club")


_PROFILE = ["player_id", "name", "position", "foot", "height_in_cm", "international_caps",
            "international_goals", "current_club_id", "market_value_in_eur", "date_of_birth"]


def projection_dataset(youth: DataFrame, players: DataFrame, valuations: DataFrame, as_of) -> DataFrame:
    """Training rows: players now 22 to 35; target is the latest value, else the current one."""
    rows = _projection_rows(youth, players.select(*_PROFILE), as_of, 22, 35)
    latest = latest_by(valuations, "player_id", "date", "market_value_in_eur").select(
        "player_id", F.col("market_value_in_eur").alias("valeur_2ans")
    )
    rows = rows.join(latest, "player_id", "left")
    rows = rows.withColumn("valeur_cible", F.coalesce("valeur_2ans", "market_value_in_eur"))
    return clean.with_keys(rows, "valeur_cible").drop("valeur_2ans", "market_value_in_eur", "name")


def projection_candidates(youth: DataFrame, players: DataFrame, as_of) -> DataFrame:
    """Rows to score: players now 16 to 22."""
    extra = [c for c in ("current_club_name",) if c in players.columns]
    rows = _projection_rows(youth, players.select(*_PROFILE, *extra), as_of, 16, 22)
    return rows.withColumnRenamed("market_value_in_eur", "valeur_actuelle")


def kept_periods(
    valuations: DataFrame, players: DataFrame, first_day=C.TEMPORAL_SINCE, last_season: int = C.ACTIVE_SINCE_SEASON
) -> DataFrame:
    """Periods of active players, of plausible length, value change and age.

    Everything is checked on the bare periods, before any appearance is
    attached, so a dropped period costs no join.
    """
    valued = clean.since(valuations, first_day).filter("market_value_in_eur > 0")
    pairs = consecutive_pairs(valued).withColumns({
        "duree_jours": F.datediff("t1", "t0"),
        "delta_value": X.delta("v0", "v1"),
        "delta_pct": X.delta_pct("v0", "v1"),
    })
    pairs = clean.between(pairs, {"duree_jours": (7, 1100), "delta_pct": (-90, 500)})
    active = clean.active_players(clean.known_position(players), last_season).select(
        "player_id", "position", "foot", F.col("country_of_citizenship").alias("country"),
        "international_caps", "international_goals", "date_of_birth",
    )
    rows = pairs.join(active, "player_id").withColumn("age_a_t1", X.age_decimal("date_of_birth", "t1", 2))
    return clean.between(rows, {"age_a_t1": (15, 45)}).drop("date_of_birth")


def played_in(periods: DataFrame, appearances: DataFrame, first_day=C.TEMPORAL_SINCE) -> DataFrame:
    """Kept periods with what their player did in each."""
    rows = interval_join(clean.played_only(appearances, first_day), periods, {
        "goals": "buts_periode", "assists": "assists_periode", "minutes_played": "minutes_periode",
        "yellow_cards": "cartons_j_periode", "red_cards": "cartons_r_periode",
    }, count="matchs_periode", empty_periods=False)
    return rows.withColumns({
        "goals_per_90": X.per90_or_zero("buts_periode", "minutes_periode", 3),
        "assists_per_90": X.per90_or_zero("assists_periode", "minutes_periode", 3),
    }).withColumnsRenamed({"t0": "date_t0", "t1": "date_t1", "v0": "market_value_t0", "v1": "market_value_t1"})


COUNTRY_ALIASES = {"Türkiye": "Turkey"}


def with_groups(df: DataFrame, country: str, n: int = 20) -> DataFrame:
    """Nationality group and zero for missing caps and international goals."""
    df = df.withColumn(country, X.alias_to(country, COUNTRY_ALIASES))
    df = top_n_or_other(df, country, "nationality_group", n)
    return clean.fill(df, {"international_caps": 0, "international_goals": 0})


PREFIXES = {"position": "pos", "foot": "foot", "nationality_group": "nat"}


def with_dummies(df: DataFrame, values: dict[str, Sequence[str]] | None = None) -> tuple[DataFrame, dict]:
    """Position, foot and nationality as 0/1 columns, and the vocabularies used.

    Pass the vocabularies of the training run when scoring.
    """
    values = values or vocabularies(df, list(PREFIXES))
    for column, prefix in PREFIXES.items():
        df = one_hot(df, column, prefix, values[column])
    return df, values


def temporal_features(
    valuations: DataFrame,
    appearances: DataFrame,
    players: DataFrame,
    first_day=C.TEMPORAL_SINCE,
    last_season: int = C.ACTIVE_SINCE_SEASON,
) -> DataFrame:
    """One row per kept period; see :func:`with_dummies` for the 0/1 columns.

    The nationality groups are counted on the bare periods, which the
    appearances neither add to nor take from.
    """
    periods = with_groups(kept_periods(valuations, players, first_day, last_season), "country")
    return played_in(periods, appearances, first_day)


def market_value_features(players: DataFrame, performance: DataFrame) -> DataFrame:
    """One row per player with a value: profile, totals, per-90 ratios, nationality group."""
    total = performance.groupBy("player_id").agg(
        F.sum("matchs_joues").alias("matchs_joues"),
        F.sum("total_goals").alias("total_goals"),
        F.sum("total_assists").alias("total_assists"),
        F.sum("total_minutes").alias("total_minutes"),
        (F.sum(F.col("avg_minutes_per_match").cast("decimal(18,1)")).cast("double")
         / F.count("avg_minutes_per_match")).alias("avg_minutes_per_match"),
    )
    base = clean.known_position(players).filter("market_value_in_eur > 0").select(
        "player_id", "name", "position", "foot", "country_of_citizenship", "international_caps",
        "international_goals", "highest_market_value_in_eur",
        F.col("market_value_in_eur").alias("target_market_value"),
    )
    df = clean.fill(base.join(total, "player_id", "left"), {
        "matchs_joues": F.lit(0).cast("bigint"), "total_goals": F.lit(0).cast("bigint"),
        "total_assists": F.lit(0).cast("bigint"), "total_minutes": F.lit(0).cast("bigint"),
        "avg_minutes_per_match": 0.0,
        "highest_market_value_in_eur": F.col("target_market_value"),
    })
    both = F.col("total_goals") + F.col("total_assists")
    df = df.withColumns({
        "goals_per_90": X.per90_or_zero("total_goals", "total_minutes", 3),
        "assists_per_90": X.per90_or_zero("total_assists", "total_minutes", 3),
        "goal_contributions_per_90": X.per90_or_zero(both, "total_minutes", 3),
    })
    return with_groups(df, "country_of_citizenship")
