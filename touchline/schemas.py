"""Schemas of the sources, required columns, keys and checks."""

from __future__ import annotations

from pyspark.sql import types as T

# Scores and ids stay text here so one odd value does not void its whole file;
# ``flatten_matches`` casts them.
_TEAM = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())])
MATCH_FEED = T.StructType([
    T.StructField("competition", T.StructType([
        T.StructField("code", T.StringType()),
        T.StructField("name", T.StringType()),
    ])),
    T.StructField("matches", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("utcDate", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("matchday", T.StringType()),
        T.StructField("season", T.StructType([T.StructField("startDate", T.StringType())])),
        T.StructField("homeTeam", _TEAM),
        T.StructField("awayTeam", _TEAM),
        T.StructField("score", T.StructType([
            T.StructField("fullTime", T.StructType([
                T.StructField("home", T.StringType()),
                T.StructField("away", T.StringType()),
            ])),
        ])),
    ]))),
])

FEED_REQUIRED_FIELDS = ["homeTeam", "awayTeam", "score", "utcDate", "status"]

SEASON_REQUIRED = ["Date", "HomeTeam", "AwayTeam", "FTHG", "FTAG", "FTR"]

# Season-file statistic -> column of the unified table.
SEASON_STATS = {
    "HS": "home_shots",
    "AS": "away_shots",
    "HST": "home_shots_on_target",
    "AST": "away_shots_on_target",
    "HC": "home_corners",
    "AC": "away_corners",
    "HY": "home_yellow_cards",
    "AY": "away_yellow_cards",
    "HR": "home_red_cards",
    "AR": "away_red_cards",
}

# Fixed values from here on: column names, keys and ranges of the tables users have.
# Typed columns of the six snapshot tables, in file order.
SNAPSHOT = {
    "players": {
        "player_id": "bigint", "first_name": "string", "last_name": "string", "name": "string",
        "date_of_birth": "date", "position": "string", "sub_position": "string", "foot": "string",
        "height_in_cm": "int", "country_of_birth": "string", "country_of_citizenship": "string",
        "current_club_id": "bigint", "current_club_name": "string",
        "current_club_domestic_competition_id": "string", "last_season": "int",
        "market_value_in_eur": "double", "highest_market_value_in_eur": "double",
        "international_caps": "int", "international_goals": "int",
    },
    "clubs": {
        "club_id": "bigint", "name": "string", "domestic_competition_id": "string",
        "squad_size": "int", "average_age": "double", "foreigners_number": "int",
        "foreigners_percentage": "double", "national_team_players": "int",
        "stadium_name": "string", "stadium_seats": "int", "coach_name": "string",
        "last_season": "int",
    },
    "player_valuations": {
        "player_id": "bigint", "date": "date", "market_value_in_eur": "double",
        "current_club_name": "string", "current_club_id": "bigint",
        "player_club_domestic_competition_id": "string",
    },
    "transfers": {
        "player_id": "bigint", "player_name": "string", "transfer_date": "date",
        "transfer_season": "string", "from_club_id": "bigint", "from_club_name": "string",
        "to_club_id": "bigint", "to_club_name": "string", "transfer_fee": "double",
        "market_value_in_eur": "double",
    },
    "appearances": {
        "appearance_id": "string", "game_id": "bigint", "player_id": "bigint",
        "player_club_id": "bigint", "date": "date", "player_name": "string",
        "competition_id": "string", "goals": "int", "assists": "int", "yellow_cards": "int",
        "red_cards": "int", "minutes_played": "int",
    },
    "games": {
        "game_id": "bigint", "competition_id": "string", "date": "date",
        "home_club_name": "string", "away_club_name": "string",
        "home_club_goals": "int", "away_club_goals": "int",
    },
}

SNAPSHOT_REQUIRED = {name: list(columns) for name, columns in SNAPSHOT.items()}

# Columns of the enriched match table, in order.
ENRICHED_MATCH = [
    "match_id", "competition", "competition_name", "season", "date", "home_team", "away_team",
    "home_goals", "away_goals", "result", "total_goals", *SEASON_STATS.values(),
    "home_points", "away_points",
]

# Declared keys, checked rather than enforced.
PRIMARY_KEYS = {
    "players": ["player_id"],
    "clubs": ["club_id"],
    "appearances": ["appearance_id"],
    "player_valuations": ["player_id", "date"],
    "unified_matches": ["match_id"],
    "features_temporal": ["player_id", "date_t0", "date_t1"],
}
FOREIGN_KEYS = {
    "appearances": "player_id",
    "player_valuations": "player_id",
    "transfers": "player_id",
    "features_temporal": "player_id",
    "predictions_market_value_temporal": "player_id",
}

# Column -> allowed range; ``None`` leaves that side open.
RANGE_CHECKS = {
    "players": {"market_value_in_eur": (0, None)},
    "appearances": {"minutes_played": (0, 120), "goals": (0, None), "assists": (0, None)},
    "unified_matches": {"home_goals": (0, 20), "away_goals": (0, 20)},
    "player_valuations": {"market_value_in_eur": (0, None)},
}

# What each mart is looked up by. A key gets buckets and sorted files, columns beside it Bloom filters
# or the order of rows, and league seasons folders.
MART_INDEXES = {
    "appearances": {"key": "player_id", "sort": ["date"], "bloom": ["player_id", "competition_id"]},
    "player_valuations": {"key": "player_id", "sort": ["date"], "bloom": ["player_id"]},
    "player_performance": {"key": "player_id", "bloom": ["player_id"]},
    "features_temporal": {"key": "player_id", "sort": ["date_t0"], "bloom": ["player_id"]},
    "predictions_projection_carriere": {"key": "player_id", "bloom": ["player_id"]},
    "unified_matches": {"partition_by": ["competition", "season"], "sort": ["date"], "bloom": ["home_team"]},
    "classements_equipes_unified": {"partition_by": ["competition", "season"], "sort": ["club_name"]},
}
