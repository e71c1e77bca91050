"""What keeps a query's memory, shuffle and time in step with its input."""

import threading

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressionModel, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from touchline import constants as C
from touchline.catalog import QUERIES
from touchline.catalog import fixtures as fx
from touchline.catalog import match_queries as mq
from touchline.catalog import model_queries as modq
from touchline.catalog import player_queries as pq
from touchline.operators import matches as M
from touchline.operators import models, periods
from touchline.operators import players as P
from touchline.operators import quality
from touchline.sources import files, records
from touchline.streaming import incremental


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["common_match_ids", "season_only_ids"])
def test_id_sets_are_not_broadcast(spark, sf, name):
    plan = plan_of(QUERIES[name].run(spark, sf))
    assert "BroadcastHashJoin [match_id" not in plan and "BroadcastHashJoin [coalesce(match_id" not in plan


def test_id_sets_keep_a_missing_id(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "match_id string")
    b = spark.createDataFrame([("x",), (None,), (None,), ("z",)], "match_id string")
    rows = {tuple(r) for r in M.keys_by_side(a, b).collect()}
    assert rows == {("x", True, True), ("y", True, False), (None, True, True), ("z", False, True)}
    assert M.keys_by_side(a, b).count() == 4


def test_conflicts_are_found_without_a_broadcast(spark, sf):
    assert "BroadcastHashJoin [match_id" not in plan_of(M.score_conflicts(mq.unified(spark, sf), mq.season_rows(spark, sf)))


def test_rows_in_both_are_found_without_a_broadcast(spark, sf):
    a, b = mq.feed_rows(spark, sf), mq.season_rows(spark, sf)
    for df in (M.common_ids(a, b), quality.only_in(b, a, "match_id")):
        assert "BroadcastHashJoin [match_id" not in plan_of(df)


@pytest.mark.parametrize("name", ["link_coverage", "linked_appearances"])
def test_games_are_not_broadcast_to_the_appearances(spark, sf, name):
    plan = plan_of(QUERIES[name].run(spark, sf))
    assert "BroadcastHashJoin [game_id" not in plan and "SortMergeJoin [game_id" in plan


def test_overlapping_periods_are_derived_and_moved_once(spark):
    """No pair of a period and its bins or days is moved, nor is a period joined again to its sums."""
    day = lambda n: F.date_add(F.lit("2020-01-01").cast("date"), n)
    rows = spark.range(300).select((F.col("id") % 3).alias("player_id"), day((F.col("id") % 40).cast("int")).alias("t0"), day((F.col("id") % 40 + 90).cast("int")).alias("t1"), "id")
    points = spark.range(1200).select((F.col("id") % 3).alias("player_id"), day((F.col("id") % 200).cast("int")).alias("date"), F.lit(1).alias("goals"))
    out = periods.overlap_join(points, rows, {"goals": "g"}, count="n", bin_days=16)
    assert out.count() == 300 and out.filter("n <> g or n <> 180").count() == 0
    plan = plan_of(out)
    assert plan.count("Range (0, 300") == 1 and plan.count("Range (0, 1200") == 1
    assert plan.count("Exchange") <= 4 and "Generate explode" not in plan


def test_orphans_count_periods_without_storing_their_features(spark, sf, monkeypatch):
    def refuse(spark, sf):
        raise AssertionError("the features are not needed to count periods")

    monkeypatch.setattr(modq, "stored_temporal", refuse)
    assert QUERIES["orphans"].run(spark, sf).columns == ["child", "player_id", "n"]


@pytest.mark.parametrize("name", ["youth_stats", "complete_rows"])
def test_youth_needs_no_join_with_all_games(spark, sf, name):
    read = QUERIES[name].run(spark, sf).inputFiles()
    assert any("/fx_appearances-" in f for f in read) and not any("/fx_games-" in f for f in read)


def test_games_listed_more_than_once_count_as_often(spark, sf):
    games, aliases = pq.raw(spark, sf, "games"), mq.aliases(spark, sf)
    twice = games.unionByName(games.filter("game_id % 3 = 0")).unionByName(games.filter("game_id % 6 = 0"))
    appearances = pq.raw(spark, sf, "appearances").withColumn("game_id", F.expr("nullif(game_id, 5)"))
    linked = P.youth_stats(P.link_appearances(appearances, twice, aliases, fx.LINK_SINCE), pq.players(spark, sf))
    counted = P.youth_stats(P.count_links(appearances, twice, aliases, fx.LINK_SINCE), pq.players(spark, sf))
    assert counted.dtypes == linked.dtypes and counted.count() == linked.count() > 0
    assert counted.exceptAll(linked).isEmpty() and linked.exceptAll(counted).isEmpty()


def test_csv_without_line_breaks_is_not_shuffled(spark, sf, tmp_path):
    for n in range(3):
        spark.range(n * 100, n * 100 + 100).selectExpr("id", "concat('name, \"', id, '\"') AS name").coalesce(1).write.options(
            header=True, quote='"', escape='"').csv(f"{tmp_path}/{n}.csv")
    df = records.read_csv_records(spark, str(tmp_path), "*.csv")
    assert "Exchange hashpartitioning" not in plan_of(df) and df.count() == 300
    assert {r["name"] for r in df.collect()} == {f'name, "{i}"' for i in range(300)}


def test_csv_records_over_stretches(spark, tmp_path, monkeypatch):
    """Records with line breaks that begin in one stretch and end some stretches later."""
    monkeypatch.setattr(records, "STRETCH", 4)
    wanted = [f'{i},"' + "\n".join("xy"[:i % 3] for _ in range(i % 11)) + '"' if i % 4 else f"{i},z" for i in range(200)]
    (tmp_path / "a.csv").write_text("\n".join(wanted) + "\n")
    got = records.csv_records(records.read_lines(spark, str(tmp_path))).orderBy("block", "at").collect()
    assert [r["record"] for r in got] == wanted
    lines = sum(r.count("\n") + 1 for r in wanted)
    assert lines > 4 * 100  # many stretches


def test_inventory_does_not_shuffle_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,"b,c"\n1,2\n3,"4\n5"\n')
    (tmp_path / "b.csv").write_text("a,b,c\n")
    (tmp_path / "c.csv").write_text('a,"b\n,c",d\n1,2,3\n')
    (tmp_path / "empty.csv").write_text("")
    df = files.csv_inventory(spark, str(tmp_path))
    assert {(r["path"].rsplit("/", 1)[1], r["records"], r["n_columns"]) for r in df.collect()} == {("a.csv", 2, 2), ("b.csv", 0, 3), ("c.csv", 1, 3)}
    spark.range(100).selectExpr("id", "'x' AS name").coalesce(1).write.csv(f"{tmp_path}/plain", header=True)
    plain = files.csv_inventory(spark, f"{tmp_path}/plain")
    assert "hashpartitioning" not in plan_of(plain) and [tuple(r)[2:4] for r in plain.collect()] == [(100, 2)]


@pytest.mark.parametrize("name", ["projection_scopes", "scored_with", "prediction_gate"])
def test_what_precedes_the_fit_waits_for_none(spark, sf, monkeypatch, name):
    def refuse(*_, **__):
        raise AssertionError("no fitted number is asked for")

    monkeypatch.setattr(modq, "fitted", refuse)
    assert QUERIES[name].run(spark, sf).count() > 0


def test_scoring_agrees_with_the_model_named_for_it(spark, sf):
    dataset, candidates = pq.dataset(spark, sf), pq.candidates(spark, sf)
    projection = models.train_projection(dataset, trees=1, min_rows=5)
    rows = models.prepare_projection(dataset, projection.encoders, projection.features)
    assert [m[:2] for m in projection.metrics] == models.model_scopes(rows, 5) and len(projection.by_position) > 1
    odd = candidates.withColumn("position", F.expr("CASE player_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'Sweeper' ELSE position END"))
    named = odd.select("player_id", models.model_used(sorted(projection.by_position)).alias("m"))
    scored = models.score_projection(odd, projection).select("player_id", "modele_utilise")
    assert sorted(map(tuple, scored.collect())) == sorted(map(tuple, named.collect()))


def test_folds_are_those_of_the_cross_validator_without_a_last_fit(spark):
    class Counting(LinearRegression):
        fits = 0

        def fit(self, dataset, params=None):
            type(self).fits += 1
            return super().fit(dataset, params)

    rows = spark.range(400).selectExpr("array(cast(id AS double), cast(id % 7 AS double)) AS a", "cast(id * 3 + id % 5 AS double) AS label")
    rows = rows.select(array_to_vector("a").alias("features"), "label")
    evaluator = RegressionEvaluator(labelCol="label", metricName="r2")
    cv = CrossValidator(estimator=LinearRegression(), estimatorParamMaps=[{}], evaluator=evaluator, numFolds=4, seed=C.SEED).fit(rows)
    row = models.cross_validate(rows, Counting(), folds=4).first()
    assert Counting.fits == 4
    assert row["r2_mean"] == pytest.approx(cv.avgMetrics[0], abs=1e-12) and row["r2_std"] == pytest.approx(cv.stdMetrics[0], abs=1e-12)


def test_kinds_of_model_are_fitted_side_by_side(spark):
    meet = threading.Barrier(2, timeout=60)

    class Waiting(LinearRegression):
        def fit(self, dataset, params=None):
            meet.wait()
            return super().fit(dataset, params)

    rows = spark.range(200).selectExpr("array(cast(id AS double)) AS a", "ln(1 + id) AS label").select(array_to_vector("a").alias("features"), "label")
    best, _, table = models.compare_models(rows, {"one": [Waiting()], "two": [Waiting()]})
    assert best == "one" and table.count() == 2


def test_deep_forest_gets_few_partitions_and_is_fitted_in_parts(spark, monkeypatch):
    """Nodes times partitions is what a deep forest costs; the parts together are one forest."""
    fitted = []

    class Counting(RandomForestRegressor):
        def _fit(self, dataset):
            fitted.append((dataset.rdd.getNumPartitions(), self.getNumTrees()))
            return super()._fit(dataset)

    rows = spark.range(4000).repartition(16).selectExpr("id", "array(cast(id % 61 AS double), cast(id % 97 AS double)) AS a", "ln(1 + id % 61 * 5 + id % 97) AS label")
    rows = rows.select("id", array_to_vector("a").alias("features"), "label")
    monkeypatch.setattr(models, "ROWS_PER_FOREST", 10_000, raising=False)
    _, model, table = models.compare_models(rows, {"random_forest": [Counting(labelCol="label", numTrees=7, maxDepth=6, minInstancesPerNode=5, seed=C.SEED)]})
    assert sorted(fitted) == [(1, 1), (1, 3), (1, 3)] and table.first()["r2"] > 0.9

    trees = [t for path, _, _ in model.parts for t in RandomForestRegressionModel.load(path).trees]
    assert len({t.toDebugString.split("\n", 1)[1] for t in trees}) == len(trees) == 7 == sum(n for _, n, _ in model.parts)
    some = rows.limit(30).collect()
    got = {r["id"]: r["prediction"] for r in model.transform(rows).filter(F.col("id").isin([r["id"] for r in some])).collect()}
    for r in some:
        assert got[r["id"]] == pytest.approx(sum(t.predict(r["features"]) for t in trees) / 7)
    in_passes = models.PartedForest(model.parts, nodes_per_pass=1).transform(rows)
    assert in_passes.columns == [*rows.columns, "prediction"] and in_passes.count() == 4000
    assert in_passes.join(model.transform(rows).select("id", F.col("prediction").alias("p")), "id").filter("prediction <> p").count() == 0


def test_boosting_of_the_comparison_gets_partitions_by_rows(spark, monkeypatch):
    parts = []

    class Counting(GBTRegressor):
        def _fit(self, dataset):
            parts.append(dataset.rdd.getNumPartitions())
            return super()._fit(dataset)

    rows = spark.range(0, 500, 1, 16).selectExpr("array(cast(id AS double)) AS a", "ln(1 + id) AS label").select(array_to_vector("a").alias("features"), "label")
    models.compare_models(rows, {"boosted": [Counting(labelCol="label", maxIter=2)]})
    assert parts == [1]
    assert models.packed(rows, 500, 16, 100).rdd.getNumPartitions() == 5 and models.packed(rows, 500, 16, 10).rdd.getNumPartitions() == 50


def test_boosting_gets_partitions_by_rows_and_the_dataset_is_computed_once(spark, sf, monkeypatch):
    """Every partition costs two tasks for each level of each tree; what the encoders read is not derived again."""
    parts, read = [], spark.sparkContext.accumulator(0)

    class Counting(LinearRegression):
        def fit(self, dataset, params=None):
            parts.append(dataset.rdd.getNumPartitions())
            return super().fit(dataset, params)

    monkeypatch.setattr(models, "boosted_trees", lambda *_: Counting())
    dataset = pq.dataset(spark, sf)
    n = dataset.count()

    def counted(rows):
        for row in rows:
            read.add(1)
            yield row

    spread = spark.createDataFrame(dataset.repartition(16).rdd.mapPartitions(counted), dataset.schema)
    metrics = models.train_projection(spread, min_rows=5).metrics
    assert len(metrics) > 2 and parts == [1] * len(metrics)
    assert read.value == n
    assert models.dealt_by_size(spark.range(1000), 1000, 300).rdd.getNumPartitions() == 4
    assert models.dealt_by_size(spark.range(0), 0).rdd.getNumPartitions() == 1


def test_rows_of_touched_seasons_are_moved_once_to_find_the_changes(spark, monkeypatch):
    def row(file, version, game, match, home, goals, batch, before, after, status="FINISHED"):
        return (file, version, batch, game, status, match, "api", None, 1, home, "b", goals, 0, "PL", 2001, batch, before, after)

    rows = spark.createDataFrame([
        row("f", "1", 1, "m1", "a", 2, 0, True, False), row("f", "2", 1, "m1", "a", 0, 1, False, True),  # another score
        row("f", "1", 2, "m2", "a", 1, 0, True, False),  # withdrawn
        row("g", "1", 3, "m3", "a", 1, 0, True, True),  # as before
        row("g", "1", 4, "m4", "c", 1, 0, True, True), row("f", "2", 4, "m4", "c", 1, 1, False, True, "CANCELLED"),  # cancelled by a newer file
    ], incremental._ROWS + ", before boolean, after boolean")
    cuts = []
    monkeypatch.setattr(incremental, "cut_lineage", lambda df: cuts.append(df) or df)
    changes = incremental.table_changes(rows)
    assert len(cuts) == 1 and plan_of(cuts[0]).count("Exchange") == 1
    sums = changes.groupBy("club_name").agg(F.sum("matchs_joues").alias("n"), F.sum("points").alias("p"), F.sum("buts_marques").alias("g"))
    assert {tuple(r) for r in sums.collect()} == {("a", -1, -5, -3), ("b", -2, 1, 0), ("c", -1, -3, -1)}
