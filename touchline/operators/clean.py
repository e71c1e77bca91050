"""Typing, cleaning and filters of the raw tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline import constants as C
from touchline.functions import columns as X
from touchline.operators.dedup import keep_first

_CASTS = {"int": X.to_int, "bigint": X.to_long, "double": X.to_double, "date": X.to_date}


def conform(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Select the named columns with their types; what cannot be cast is NULL."""
    return df.select(*[
        _CASTS[t](name).alias(name) if t in _CASTS else F.col(name).cast(t).alias(name)
        for name, t in types.items()
    ])


def cast_rejects(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Values per column that are present but cannot be cast: one pass, one row."""
    return df.agg(*[
        F.count_if(F.col(name).isNotNull() & _CASTS[t](name).isNull()).alias(name)
        for name, t in types.items() if t in _CASTS
    ])


def replace_columns(df: DataFrame, rule, names: Sequence[str]) -> DataFrame:
    """Apply one column rule to several columns in one projection."""
    return df.withColumns({name: rule(name) for name in names})


def finished_only(df: DataFrame, status: str = "status") -> DataFrame:
    return df.filter(F.col(status) == "FINISHED")


def with_keys(df: DataFrame, *names: str) -> DataFrame:
    """Rows whose named columns are all present."""
    for name in names:
        df = df.filter(F.col(name).isNotNull())
    return df


def since(df: DataFrame, first_day, date: str = "date") -> DataFrame:
    return df.filter(F.col(date) >= F.lit(first_day).cast("date"))


def played_only(df: DataFrame, first_day=None, minutes: str = "minutes_played") -> DataFrame:
    out = df.filter(F.col(minutes) > 0)
    return out if first_day is None else since(out, first_day)


def between(df: DataFrame, limits: Mapping[str, tuple]) -> DataFrame:
    """Keep rows whose columns lie inside their limits; NULL lies outside."""
    for name, (low, high) in limits.items():
        df = df.filter(F.col(name).between(low, high))
    return df


def score_range(df: DataFrame, low: int = C.MIN_SCORE, high: int = C.MAX_SCORE) -> DataFrame:
    """Scores as whole numbers; rows without two believable scores are dropped."""
    names = ("home_goals", "away_goals")
    return between(replace_columns(df, X.to_int, names), {name: (low, high) for name in names})


def date_window(df: DataFrame, first=C.FIRST_MATCH_DAY, last=C.LAST_MATCH_DAY, date: str = "date") -> DataFrame:
    return df.filter(F.col(date).between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def known_position(df: DataFrame, position: str = "position") -> DataFrame:
    return df.filter(F.col(position).isNotNull() & (F.col(position) != "Missing"))


def active_players(df: DataFrame, last_season: int = C.ACTIVE_SINCE_SEASON) -> DataFrame:
    return df.filter(F.col("last_season") >= last_season)


def in_leagues(df: DataFrame, codes: Sequence[str], competition: str = "competition_id") -> DataFrame:
    return df.filter(F.col(competition).isin(*codes))


def drop_incomplete(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(names))


def fill(df: DataFrame, rules: Mapping[str, Column | float | int | str]) -> DataFrame:
    """Fill NULLs by a constant or by another column."""
    return df.withColumns({
        name: F.coalesce(F.col(name), value if isinstance(value, Column) else F.lit(value))
        for name, value in rules.items()
    })


# --- the cleaned snapshot tables ---------------------------------------------

def clean_players(raw: DataFrame) -> DataFrame:
    df = with_keys(raw, "player_id", "name")
    df = replace_columns(df, X.neg_to_null, [c for c in df.columns if c.endswith("market_value_in_eur")])
    return keep_first(df, ["player_id"])


def clean_clubs(raw: DataFrame) -> DataFrame:
    return keep_first(with_keys(raw, "club_id"), ["club_id"])


def clean_valuations(raw: DataFrame) -> DataFrame:
    return replace_columns(with_keys(raw, "player_id", "market_value_in_eur"), X.neg_to_null, ["market_value_in_eur"])


def clean_transfers(raw: DataFrame, as_of) -> DataFrame:
    """Transfers dated after ``as_of`` keep their row and lose their date."""
    df = with_keys(raw, "player_id")
    money = [c for c in ("transfer_fee", "market_value_in_eur") if c in df.columns]
    df = replace_columns(df, X.neg_to_null, money)
    return df.withColumn("transfer_date", X.future_to_null("transfer_date", as_of))


STATS = ("goals", "assists", "yellow_cards", "red_cards", "minutes_played")


def clean_appearances(raw: DataFrame, first_day=None) -> DataFrame:
    """Played rows, negative or missing statistics as 0, one row per appearance.

    The filters run before the dedup, so the shuffle on ``appearance_id``
    carries played rows only.
    """
    df = with_keys(played_only(raw, first_day), "player_id")
    return keep_first(replace_columns(df, X.neg_to_zero, STATS), ["appearance_id"])
