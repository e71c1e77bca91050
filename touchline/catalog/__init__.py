from touchline.catalog import match_queries, model_queries, player_queries, quality_queries  # noqa: F401
from touchline.catalog.registry import QUERIES  # noqa: F401
