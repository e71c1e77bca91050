"""Value models: train, compare, cross-validate, explain, score, store."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from itertools import accumulate
from statistics import fmean, pstdev

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import constants as C
from touchline.functions import columns as X
from touchline.operators import clean
from touchline.operators.stats import exact_quantiles, regression_metrics
from touchline.session import cut_lineage, ensure_checkpoint_dir, kept_in_files

ENCODED = ("position", "foot")
UNKNOWN = "Unknown"
# Training rows a task passes over for one level of one tree: a pass takes about as long as starting the task.
ROWS_PER_TASK = 100_000
# Of a deep forest: rows a task passes over, and rows times trees that are fitted as one.
ROWS_PER_FOREST_TASK = 1_000_000
ROWS_PER_FOREST = 5_000_000
# Nodes of a forest that are broadcast at a time to score rows, some 200 bytes each.
NODES_PER_PASS = 1_000_000


def median_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill missing numbers (NULL and NaN) by the exact column median."""
    medians = {}
    for c in columns:
        known = df.select(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias("v")).filter("v IS NOT NULL")
        medians[c] = exact_quantiles(known, "v", {"median": 0.5}).scalar()
    return df.withColumns({c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), m) for c, m in medians.items()})


def fit_encoders(df: DataFrame, columns: Sequence[str] = ENCODED) -> StringIndexerModel:
    """Alphabetical codes per column; a missing value counts as ``Unknown``."""
    indexer = StringIndexer(
        inputCols=list(columns), outputCols=[f"{c}_enc" for c in columns],
        stringOrderType="alphabetAsc", handleInvalid="keep",
    )
    return indexer.fit(df.na.fill(UNKNOWN, list(columns)))


def label_encode(df: DataFrame, encoders: StringIndexerModel, fallback: Mapping[str, str] | None = None) -> DataFrame:
    """Add ``<column>_enc``. Unseen labels take the fallback label of their column
    if training saw that, else one code past the last.
    """
    fallback = fallback or {}
    columns = encoders.getInputCols()
    known = dict(zip(columns, encoders.labelsArray))
    filled = df.withColumns({f"_{c}": F.col(c) for c in columns}).na.fill(UNKNOWN, list(columns))
    for c, other in fallback.items():
        if other in known[c]:
            filled = filled.withColumn(c, F.when(F.col(c).isin(*known[c]), F.col(c)).otherwise(other))
    out = encoders.transform(filled)
    return out.withColumns({c: F.col(f"_{c}") for c in columns}).drop(*[f"_{c}" for c in columns])


def boosted_trees(spark: SparkSession, trees: int = C.GBT_TREES, depth: int = C.GBT_DEPTH, rate: float = C.GBT_RATE):
    """Boosting cuts its lineage every ten trees in the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return GBTRegressor(
        featuresCol="features", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=rate,
        seed=C.SEED, checkpointInterval=10,
    )


def assembled(df: DataFrame, features: Sequence[str], target: str | None = None, *keep: str) -> DataFrame:
    """Feature vector, and the target as ``log1p`` label."""
    out = VectorAssembler(inputCols=list(features), outputCol="features").transform(df)
    label = [X.log_value(target).alias("label")] if target else []
    return out.select(*keep, "features", *label)


@dataclass
class Projection:
    """Everything scoring needs, and how well training went."""

    model: PipelineModel
    by_position: dict[str, PipelineModel]
    encoders: StringIndexerModel
    features: list[str]
    metrics: list[tuple] = field(default_factory=list)  # (scope, rows, r2, mae)

    def metrics_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.metrics, "scope string, n bigint, r2 double, mae double")


def prepare_projection(dataset: DataFrame, encoders: StringIndexerModel, features: Sequence[str]) -> DataFrame:
    """Complete training rows: an incomplete row is dropped here, and filled when scoring."""
    rows = clean.drop_incomplete(label_encode(dataset, encoders), [*features, "valeur_cible", "position"])
    return assembled(rows, features, "valeur_cible", "player_id", "position")


def model_scopes(rows: DataFrame, min_rows: int = C.MIN_ROWS_PER_POSITION) -> list[tuple[str, int]]:
    """The models to train on prepared rows, and on how many: one over all, one per position with enough rows."""
    sizes = rows.groupBy("position").count().orderBy("position").collect()  # one row per position
    return [("global", sum(r["count"] for r in sizes)), *[(p, n) for p, n in sizes if n >= min_rows]]


def has_own_model(positions: Sequence[str], position: str = "position"):
    """Whether the model of its position scores a row."""
    return F.coalesce(F.col(position).isin(*positions), F.lit(False)) if positions else F.lit(False)


def model_used(positions: Sequence[str], position: str = "position"):
    """Which model scores a row: its position's if there is one, else the global."""
    return F.when(has_own_model(positions, position), F.col(position)).otherwise("global")


def dealt_by_size(rows: DataFrame, n: int, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``n`` rows in as many partitions as their number is worth, however many they came in.

    Boosting sends every partition through two tasks for each level of each
    tree, so partitions of a few rows cost their start thousands of times.
    """
    return rows.repartition(max(1, -(-n // per_task)))


def _fit_and_measure(rows: DataFrame, n: int, estimator) -> tuple[PipelineModel, float, float]:
    train, test = rows.randomSplit([0.8, 0.2], seed=C.SEED)
    model = Pipeline(stages=[estimator]).fit(dealt_by_size(train, n))
    m = regression_metrics(model.transform(test)).first()
    return model, m["r2"], m["mae"]


def train_projection(
    dataset: DataFrame,
    features: Sequence[str] = tuple(C.PROJECTION_FEATURES),
    trees: int = C.GBT_TREES,
    min_rows: int = C.MIN_ROWS_PER_POSITION,
    parallelism: int = 6,
) -> Projection:
    """One model over all players, and one per position with enough rows.

    The rows (one per player) are written to the checkpoint folder before the
    encoders see them, and again when prepared: every model reads them. Boosting
    runs one small job after the other, so the models are fitted side by side.
    """
    spark = dataset.sparkSession
    dataset = cut_lineage(dataset)
    encoders = fit_encoders(dataset)
    rows = cut_lineage(prepare_projection(dataset, encoders, features))

    (everyone, total), *own = model_scopes(rows, min_rows)
    scopes = [(everyone, total, rows), *[(p, n, rows.filter(F.col("position") == p)) for p, n in own]]

    def fit(scope: tuple):
        _, n, part = scope
        return _fit_and_measure(part, n, boosted_trees(spark, trees))

    with ThreadPoolExecutor(parallelism) as pool:
        fits = list(pool.map(inheritable_thread_target(spark)(fit), scopes))
    metrics = [(scope, n, r2, mae) for (scope, n, _), (_, r2, mae) in zip(scopes, fits)]
    by_position = {scope: model for (scope, _, _), (model, _, _) in zip(scopes[1:], fits[1:])}
    return Projection(fits[0][0], by_position, encoders, list(features), metrics)


def score_projection(candidates: DataFrame, projection: Projection) -> DataFrame:
    """Projected value per candidate: the position's model if there is one, else the global.

    Each candidate passes through one model only. Missing numbers (NULL and NaN)
    count as 0. The value is not rounded; what is shown is rounded last.
    """
    rows = label_encode(candidates, projection.encoders, {"position": "Missing", "foot": UNKNOWN})
    filled = rows.select(*candidates.columns, *[
        F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(f"_f_{f}") for f in projection.features
    ])
    ready = VectorAssembler(inputCols=[f"_f_{f}" for f in projection.features], outputCol="features").transform(filled)
    own = sorted(projection.by_position.items())
    parts = [("global", projection.model, ready.filter(~has_own_model([p for p, _ in own])))]
    parts += [(p, model, ready.filter(F.col("position") == p)) for p, model in own]
    scored = [
        model.transform(part).select(
            *candidates.columns, X.unlog_value("prediction").alias("valeur_projetee"), F.lit(name).alias("modele_utilise"))
        for name, model, part in parts
    ]
    return reduce(DataFrame.unionByName, scored)


def importance_table(model: PipelineModel, features: Sequence[str], spark: SparkSession, without: str | None = None) -> DataFrame:
    """Share of each feature in percent, and again with one feature left out."""
    weights = dict(zip(features, model.stages[-1].featureImportances.toArray().tolist()))
    total = sum(weights.values()) or 1.0
    rest = sum(w for f, w in weights.items() if f != without) or 1.0
    rows = [(f, 100 * w / total, None if f == without else 100 * w / rest) for f, w in weights.items()]
    table = spark.createDataFrame(rows, "feature string, share_pct double, share_without_pct double")
    return table.orderBy(F.col("share_pct").desc(), "feature")


def top_importances(table: DataFrame, k: int = 14) -> DataFrame:
    return table.orderBy(F.col("share_pct").desc(), "feature").limit(k)


def candidates_for_comparison(spark: SparkSession, trees: int = 200, depth: int = 15, boosted_depth: int = 5) -> dict[str, list]:
    """The three kinds of model, as pipeline stages."""
    scaled = dict(featuresCol="scaled", labelCol="label")
    return {
        "linear_regression": [
            StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
            LinearRegression(**scaled),
        ],
        "random_forest": [RandomForestRegressor(
            labelCol="label", numTrees=trees, maxDepth=depth, minInstancesPerNode=5, seed=C.SEED,
            featureSubsetStrategy="all", maxMemoryInMB=1024,
        )],
        "gradient_boosting": [boosted_trees(spark, trees, boosted_depth)],
    }


@dataclass
class PartedForest:
    """A random forest fitted in parts, which lie in the checkpoint folder: (path, trees, nodes) of each."""

    parts: list[tuple[str, int, int]]
    nodes_per_pass: int = NODES_PER_PASS

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``, the mean over all trees.

        The rows pass through as many parts at a time as may be broadcast, and
        are written down in between with the sum so far.
        """
        out, step = df.withColumn("_sum", F.lit(0.0)), 0
        for (path, trees, _), nodes in zip(self.parts, accumulate(n for _, _, n in self.parts)):
            if (nodes - 1) // self.nodes_per_pass > step:
                out, step = kept_in_files(out), (nodes - 1) // self.nodes_per_pass
            part = RandomForestRegressionModel.load(path).setPredictionCol("_mean")
            out = part.transform(out).withColumn("_sum", F.col("_sum") + F.col("_mean") * trees).drop("_mean")
        return out.withColumn("prediction", F.col("_sum") / sum(trees for _, trees, _ in self.parts)).drop("_sum")


def packed(rows: DataFrame, n: int, partitions: int, per_task: int) -> DataFrame:
    """As :func:`dealt_by_size` of rows in a known number of partitions, which are put together as they are if they are too many."""
    wanted = max(1, -(-n // per_task))
    return rows.coalesce(wanted) if wanted <= partitions else rows.repartition(wanted)


def fit_forest(train: DataFrame, n: int, forest: RandomForestRegressor):
    """A forest over ``n`` rows, in parts of as many trees as have ``ROWS_PER_FOREST`` rows together.

    A node's counters are some kilobytes, and every partition sends those of
    each node: a deep forest costs nodes times partitions, so its rows stay in
    few. The parts run side by side instead, on two thirds of the cores. None
    but its own trees is in the driver while a part is fitted.
    """
    spark, trees = train.sparkSession, forest.getNumTrees()
    folder = f"{ensure_checkpoint_dir(spark)}/touchline/forest-{uuid.uuid4().hex}"
    lean = forest.copy({forest.maxMemoryInMB: 256, forest.cacheNodeIds: True})  # the trees do not depend on these
    size = max(1, ROWS_PER_FOREST // max(1, n))
    if size >= trees:
        return Pipeline(stages=[lean]).fit(train)

    def fit(first: int) -> tuple[str, int, int]:
        own, path = min(size, trees - first), f"{folder}/{first}"
        # Sampling adds the number of the partition to the seed.
        model = lean.copy({forest.numTrees: own, forest.seed: forest.getSeed() + 1_000_003 * first}).fit(train)
        model.write().save(path)
        return path, own, model.totalNumNodes

    with ThreadPoolExecutor(max(1, 2 * spark.sparkContext.defaultParallelism // 3)) as pool:
        return PartedForest(list(pool.map(inheritable_thread_target(spark)(fit), range(0, trees, size))))


def _fit_kind(train: DataFrame, n: int, partitions: int, steps: list):
    if isinstance(steps[-1], RandomForestRegressor) and len(steps) == 1:
        return fit_forest(packed(train, n, partitions, ROWS_PER_FOREST_TASK), n, steps[0])
    if isinstance(steps[-1], GBTRegressor):
        train = packed(train, n, partitions, ROWS_PER_TASK)
    return Pipeline(stages=steps).fit(train)


def compare_models(rows: DataFrame, stages: Mapping[str, list]) -> tuple[str, PipelineModel | PartedForest, DataFrame]:
    """Fit every kind on the same split; the smallest mean error in euros wins.

    The rows are written to the checkpoint folder, so both parts of the split
    are of the same rows. The kinds are fitted side by side: boosting runs many
    small jobs one after the other and leaves most cores to the others.
    """
    spark = rows.sparkSession
    train, test = (part.persist() for part in cut_lineage(rows).randomSplit([0.8, 0.2], seed=C.SEED))
    n_train, partitions = train.select(F.spark_partition_id().alias("p")).agg(F.count("p"), F.count_distinct("p")).first()

    def fit(steps: list):
        model = _fit_kind(train, n_train, partitions, steps)
        m = regression_metrics(model.transform(test)).first()
        return model, m["n"], m["r2"], m["mae"]

    with ThreadPoolExecutor(len(stages)) as pool:
        results = dict(zip(stages, pool.map(inheritable_thread_target(spark)(fit), stages.values())))
    train.unpersist()
    test.unpersist()
    best = min(results, key=lambda n: results[n][3])
    table = spark.createDataFrame(
        [(n, k, r2, mae, n == best) for n, (_, k, r2, mae) in results.items()],
        "model string, n_test bigint, r2 double, mae double, best boolean",
    )
    return best, results[best][0], table


def cross_validate(rows: DataFrame, estimator, folds: int = 5, parallelism: int = 5) -> DataFrame:
    """Mean and spread of R² over the folds, and whether the spread is small.

    The folds are those of Spark's ``CrossValidator``, which would fit one more
    model on all rows after them; nobody asks for that one here.
    """
    spark = rows.sparkSession
    dealt = rows.select("*", F.rand(C.SEED).alias("_fold"))
    evaluator = RegressionEvaluator(labelCol="label", metricName="r2")

    def score(i: int) -> float:
        held = (F.col("_fold") >= i / folds) & (F.col("_fold") < (i + 1) / folds)
        train, test = dealt.filter(~held).persist(), dealt.filter(held).persist()
        r2 = evaluator.evaluate(estimator.fit(train).transform(test))
        train.unpersist()
        test.unpersist()
        return r2

    with ThreadPoolExecutor(parallelism) as pool:
        scores = list(pool.map(inheritable_thread_target(spark)(score), range(folds)))
    mean, std = fmean(scores), pstdev(scores)
    return spark.createDataFrame(
        [(folds, mean, std, std < C.STABLE_CV_STD)], "folds int, r2_mean double, r2_std double, stable boolean"
    )


def predict_values(rows: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``predicted`` in euros."""
    return model.transform(rows).withColumn("predicted", X.unlog_value("prediction"))


def save_projection(projection: Projection, path: str, spark: SparkSession) -> None:
    projection.model.write().overwrite().save(f"{path}/global")
    projection.encoders.write().overwrite().save(f"{path}/encoders")
    for position, model in projection.by_position.items():
        model.write().overwrite().save(f"{path}/position={position}")
    projection.metrics_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/metrics")
    spark.createDataFrame(list(enumerate(projection.features)), "i int, feature string").coalesce(1).write.mode(
        "overwrite").parquet(f"{path}/features")


def load_projection(path: str, spark: SparkSession) -> Projection:
    metrics = [tuple(r) for r in spark.read.parquet(f"{path}/metrics").collect()]
    features = [r["feature"] for r in spark.read.parquet(f"{path}/features").orderBy("i").collect()]
    by_position = {scope: PipelineModel.load(f"{path}/position={scope}") for scope, *_ in metrics if scope != "global"}
    return Projection(
        PipelineModel.load(f"{path}/global"), by_position, StringIndexerModel.load(f"{path}/encoders"), features, metrics
    )
