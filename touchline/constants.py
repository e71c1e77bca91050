"""Fixed values the results depend on."""

# Competition code of each source -> standard code (fixed values).
COMPETITION_CODES = {
    "PL": "PL", "BL1": "BL1", "FL1": "FL1", "PD": "PD", "SA": "SA",
    "GB1": "PL", "L1": "BL1", "FR1": "FL1", "ES1": "PD", "IT1": "SA",
}

# Snapshot competition code -> standard code (fixed values).
SNAPSHOT_COMPETITIONS = {"GB1": "PL", "ES1": "PD", "IT1": "SA", "L1": "BL1", "FR1": "FL1"}

# Standard code -> readable name (fixed values).
COMPETITION_LABELS = {
    "PL": "Premier League",
    "PD": "La Liga",
    "SA": "Serie A",
    "BL1": "Bundesliga",
    "FL1": "Ligue 1",
}

# Season-file folder -> standard code (fixed values).
LEAGUE_FOLDERS = {
    "premier_league": "PL",
    "la_liga": "PD",
    "serie_a": "SA",
    "bundesliga": "BL1",
    "ligue_1": "FL1",
}

# Competition dimension (fixed values): id, name, country, confederation, tier,
# clubs, matches per season, snapshot code, feed code.
COMPETITIONS = [
    ("PL", "Premier League", "Angleterre", "UEFA", 1, 20, 380, "GB1", "PL"),
    ("PD", "La Liga", "Espagne", "UEFA", 1, 20, 380, "ES1", "PD"),
    ("SA", "Serie A", "Italie", "UEFA", 1, 20, 380, "IT1", "SA"),
    ("BL1", "Bundesliga", "Allemagne", "UEFA", 1, 18, 306, "L1", "BL1"),
    ("FL1", "Ligue 1", "France", "UEFA", 1, 18, 306, "FR1", "FL1"),
]

# Smallest plausible number of matches per competition and season (fixed values).
MIN_MATCHES = {"PL": 350, "PD": 350, "SA": 350, "BL1": 280, "FL1": 280}
MIN_MATCHES_DEFAULT = 250

# Which source wins when two describe one match (fixed values, lowest first).
SOURCE_PRIORITY = {"api": 0, "football_datasets": 1}

# Scores outside this range are not believed (fixed values).
MIN_SCORE, MAX_SCORE = 0, 20

# Season-file window (fixed values).
FIRST_SEASON = 2015
FIRST_MATCH_DAY, LAST_MATCH_DAY = "2016-01-01", "2025-12-31"

# Appearance cut-offs (fixed values).
PERFORMANCE_SINCE = "2017-01-01"
UNIFIED_SINCE = "2012-01-01"
TEMPORAL_SINCE = "2017-01-01"
ACTIVE_SINCE_SEASON = 2022

# Prediction against actual value, in percent (fixed values).
FAIR_BAND_PCT = 20
UNDER, FAIR, OVER = "sous-évalué", "bien évalué", "surévalué"

# Potential by projected value in euros, highest first (fixed values).
POTENTIAL_TIERS = [
    (50_000_000, "Talent exceptionnel — profil de joueur international de haut niveau"),
    (20_000_000, "Très grand potentiel — profil de joueur de top club européen"),
    (5_000_000, "Bon potentiel — profil de joueur professionnel de championnat majeur"),
    (1_000_000, "Potentiel correct — profil de joueur professionnel L2 ou équivalent"),
]
POTENTIAL_LOWEST = "Potentiel limité selon les données actuelles"

# Mean squad value in euros taken for each club level (fixed values).
CLUB_LEVELS = {
    "amateur": 250_000,
    "semi-pro": 1_000_000,
    "professional": 4_000_000,
    "first division": 15_000_000,
    "european top 5": 45_000_000,
    "european elite": 120_000_000,
}

# Features of the projection model, in this order (fixed values).
PROJECTION_FEATURES = [
    "matchs_jeune",
    "buts_jeune",
    "passes_jeune",
    "minutes_jeune",
    "goals_per_90_jeune",
    "assists_per_90_jeune",
    "age_premier_match",
    "nb_competitions_jeune",
    "height_in_cm",
    "international_caps",
    "international_goals",
    "valeur_moyenne_club",
    "position_enc",
    "foot_enc",
]

# Fixed part of the features of the period model, in this order (fixed values).
TEMPORAL_FEATURES = [
    "market_value_t0",
    "age_a_t1",
    "duree_jours",
    "matchs_periode",
    "buts_periode",
    "assists_periode",
    "minutes_periode",
    "cartons_j_periode",
    "cartons_r_periode",
    "goals_per_90",
    "assists_per_90",
    "international_caps",
    "international_goals",
]

# Fixed part of the features of the market-value model, in this order (fixed values).
MARKET_VALUE_FEATURES = [
    "matchs_joues",
    "total_goals",
    "total_assists",
    "total_minutes",
    "goals_per_90",
    "assists_per_90",
    "goal_contributions_per_90",
    "avg_minutes_per_match",
    "international_caps",
    "international_goals",
    "highest_market_value_in_eur",
]

# Projection model settings (fixed values).
GBT_TREES, GBT_DEPTH, GBT_RATE, SEED = 200, 4, 0.05, 42
MIN_ROWS_PER_POSITION = 100

# Acceptance of a trained model (fixed values).
MIN_R2, MIN_R2_ATTACK, MIN_PREDICTIONS = 0.50, 0.60, 1000
STABLE_CV_STD = 0.02

# Expected rows per mart (fixed values).
EXPECTED_VOLUMES = {
    "marts_clubs.unified_matches": 18_557,
    "marts_players.players": 47_702,
    "marts_players.appearances_unified": 1_862_208,
    "marts_players.player_valuations": 616_377,
    "marts_ml.predictions_projection_carriere": 1_147,
}
