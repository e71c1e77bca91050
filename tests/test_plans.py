"""The player and projection plans from raw files to predictions, run twice with the same result."""

import pytest

from touchline.catalog import fixtures as fx
from touchline.catalog import match_queries as mq
from touchline.catalog import player_queries as pq
from touchline.catalog.quality_queries import write_snapshot
from touchline.plans import players, projection
from touchline.sources import readers, writers

TABLES = ("marts_players.players", "marts_players.clubs", "marts_players.appearances_unified", "marts_players.player_performance",
          "marts_players.players_enriched", "marts_ml.predictions_projection_carriere")


def test_player_and_projection_marts_twice(spark, sf, tmp_path):
    snapshot = readers.read_snapshot(spark, write_snapshot(spark, sf))
    for name in writers.SCHEMAS:
        spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    counts, scores = [], []
    for _run in range(2):
        players.build_player_marts(spark, snapshot, mq.aliases(spark, sf), fx.AS_OF, fx.PERF_SINCE, fx.LINK_SINCE)
        made = projection.build_projection_marts(spark, fx.AS_OF, str(tmp_path / "model"), trees=3)
        counts.append([spark.table(t).count() for t in TABLES])
        scores.append({(r["player_id"], r["valeur_projetee"]) for r in spark.table(TABLES[-1]).collect()})
    assert counts[0] == counts[1] and min(counts[0]) > 0 and scores[0] == scores[1]
    assert {p for p, _ in scores[0]} == {r["player_id"] for r in pq.candidates(spark, sf).collect()}
    assert made.metrics[0][:2] == ("global", pq.dataset(spark, sf).na.drop(
        subset=[c for c in made.features if not c.endswith("_enc")] + ["valeur_cible", "position"]).count())
    assert all(v == pytest.approx(round(v)) for _, v in scores[0])
    for name in writers.SCHEMAS:
        spark.sql(f"DROP DATABASE {name} CASCADE")
