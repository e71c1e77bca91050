"""Models with few trees: better than the mean, stored and loaded alike, unseen labels."""

import pytest
from pyspark.sql import functions as F

from touchline import constants as C
from touchline.operators import models, quality, reports


@pytest.fixture(scope="module")
def dataset(spark):
    i = F.col("id")
    df = spark.range(600).select(
        i.alias("player_id"), F.concat(F.lit("p"), i.cast("string")).alias("name"),
        F.element_at(F.array(*map(F.lit, ["Attack", "Defender", "Midfield"])), (i % 3 + 1).cast("int")).alias("position"),
        F.when(i % 4 > 0, F.element_at(F.array(*map(F.lit, ["left", "right", "both"])), (i % 3 + 1).cast("int"))).alias("foot"),
        *[((i * (k + 3)) % 97).cast("double").alias(c) for k, c in enumerate(C.PROJECTION_FEATURES[:-2])],
        (i % 12 + 14).cast("int").alias("age_actuel"),
    )
    return df.withColumn("valeur_cible", 1e5 * (1 + F.col("matchs_jeune") + 2 * F.col("valeur_moyenne_club"))).withColumn(
        "valeur_actuelle", F.col("valeur_cible") / 2)


@pytest.fixture(scope="module")
def projection(dataset):
    return models.train_projection(dataset, trees=15, min_rows=150)


def test_better_than_the_mean(projection):
    scores = {scope: r2 for scope, _, r2, _ in projection.metrics}
    assert set(scores) == {"global", "Attack", "Defender", "Midfield"}
    assert all(r2 > 0.3 for r2 in scores.values())


def test_small_positions_get_no_model(dataset):
    out = models.train_projection(dataset.filter("position <> 'Attack' OR player_id < 60"), trees=2, min_rows=100)
    assert "Attack" not in out.by_position and "global" == out.metrics[0][0]


def test_scores_missing_and_unseen(spark, projection, dataset):
    rows = dataset.limit(6).withColumn("height_in_cm", F.lit(None).cast("double")).withColumn(
        "position", F.when(F.col("player_id") == 0, "Libero").otherwise(F.col("position"))).withColumn("foot", F.lit(None).cast("string"))
    out = {r["player_id"]: r for r in models.score_projection(rows, projection).collect()}
    assert len(out) == 6 and all(r["valeur_projetee"] is not None for r in out.values())
    assert out[0]["modele_utilise"] == "global" and out[1]["modele_utilise"] == "Defender"
    assert out[0]["position"] == "Libero" and out[0]["foot"] is None


def test_store_and_load(spark, projection, dataset, tmp_path):
    models.save_projection(projection, str(tmp_path / "m"), spark)
    again = models.load_projection(str(tmp_path / "m"), spark)
    assert again.features == projection.features and again.metrics == projection.metrics
    a = models.score_projection(dataset, projection).orderBy("player_id").collect()
    assert a == models.score_projection(dataset, again).orderBy("player_id").collect()


def test_importances(spark, projection):
    table = models.importance_table(projection.model, projection.features, spark, without="valeur_moyenne_club")
    sums = table.agg(F.sum("share_pct"), F.sum("share_without_pct")).first()
    assert sums[0] == pytest.approx(100) and sums[1] == pytest.approx(100)
    assert models.top_importances(table, 3).count() == 3


def test_report_and_gate(spark, projection, dataset):
    scored = models.score_projection(dataset, projection)
    assert reports.scouting_report(scored).filter("interpretation IS NULL OR age_pic_min IS NULL").count() == 0
    gate = {r["rule"]: r["passed"] for r in quality.model_gate(spark, {"global": 0.61, "Attack": 0.55}, 1147).collect()}
    assert gate == {"r2_global": True, "r2_attack": False, "n_predictions": True}


def test_comparison_and_folds(spark, dataset):
    rows = models.assembled(dataset, C.PROJECTION_FEATURES[:-2], "valeur_cible", "player_id")
    best, model, table = models.compare_models(rows, models.candidates_for_comparison(spark, trees=3, depth=4, boosted_depth=3))
    assert table.filter("best").first()["model"] == best and table.count() == 3
    scaler, linear = models.candidates_for_comparison(spark)["linear_regression"]
    folds = models.cross_validate(rows, models.Pipeline(stages=[scaler, linear])).first()
    assert folds["folds"] == 5 and folds["r2_mean"] > 0.3 and folds["r2_std"] < 0.2
    assert models.predict_values(rows, model).filter("predicted IS NULL").count() == 0


def test_labels_follow_the_alphabet(spark, dataset):
    encoders = models.fit_encoders(dataset)
    out = models.label_encode(dataset, encoders)
    codes = {(r["foot"] or "Unknown"): r["foot_enc"] for r in out.select("foot", "foot_enc").distinct().collect()}
    assert [codes[k] for k in sorted(codes)] == [0.0, 1.0, 2.0, 3.0]
