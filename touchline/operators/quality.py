"""Checks on raw files and marts. Each returns verdict or violation rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import constants as C
from touchline.schemas import FEED_REQUIRED_FIELDS


def check_required_columns(df: DataFrame, required: Sequence[str], name: str) -> DataFrame:
    """One verdict row: the missing columns, and whether to refuse. Reads no data."""
    missing = sorted(set(required) - set(df.columns))
    return df.sparkSession.createDataFrame(
        [(name, missing, bool(missing))], "table string, missing array<string>, refused boolean"
    )


def check_volume_ratio(new: DataFrame, old: DataFrame, name: str, warn: float = 0.90, block: float = 0.30) -> DataFrame:
    """New against previous row count: ``refused``, ``warning``, ``ok``, or ``first``."""
    both = new.select(F.lit(True).alias("is_new")).union(old.select(F.lit(False)))
    both = both.agg(F.count_if("is_new").alias("n_new"), F.count_if(~F.col("is_new")).alias("n_old"))
    return volume_verdicts(both.select(F.lit(name).alias("table"), "*"), warn, block)


def volume_verdicts(counts: DataFrame, warn: float = 0.90, block: float = 0.30) -> DataFrame:
    """Rows with ``n_new`` and ``n_old`` and what their ratio says."""
    ratio = F.col("n_new") / F.nullif(F.col("n_old"), F.lit(0))
    verdict = (F.when(F.col("n_old") == 0, "first").when(ratio < block, "refused")
               .when(ratio < warn, "warning").otherwise("ok"))
    return counts.withColumns({"ratio": F.round(ratio, 4), "verdict": verdict})


def check_min_matches(matches: DataFrame, competition: str = "competition_id", season: str = "season") -> DataFrame:
    """Matches per competition and season against the plausible minimum."""
    pairs = [F.lit(x) for item in C.MIN_MATCHES.items() for x in item]
    floor = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(competition)), F.lit(C.MIN_MATCHES_DEFAULT))
    counts = matches.groupBy(competition, season).agg(F.count(F.lit(1)).alias("n_matches"))
    return counts.withColumn("min_matches", floor).withColumn("refused", F.col("n_matches") < F.col("min_matches"))


def check_min_rows(df: DataFrame, minimum: int = 10, by: str | None = None) -> DataFrame:
    """Row count, per group if asked, and whether it is too small."""
    grouped = df.groupBy(by) if by else df.groupBy()
    return grouped.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("refused", F.col("n_rows") < minimum)


def check_required_fields(df: DataFrame, fields: Sequence[str] = tuple(FEED_REQUIRED_FIELDS)) -> DataFrame:
    """Rows in which each field is missing, over all rows, one pass."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  *[F.count_if(F.col(f).isNull()).alias(f"{f}_missing") for f in fields])


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, or are missing."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | missing)


def fk_orphans(df: DataFrame, parent: DataFrame, key: str = "player_id") -> DataFrame:
    """Keys without a parent row, with the number of rows each concerns.

    The child is counted per key before the join, so a hot orphan is one row.
    """
    counted = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.join(parent.select(key), key, "left_anti")


def check_violations(df: DataFrame, limits: Mapping[str, tuple], table: str) -> DataFrame:
    """Values outside their allowed range, per column, one pass over the table."""
    def outside(name, low, high):
        tests = [F.col(name) < low] if low is not None else []
        tests += [F.col(name) > high] if high is not None else []
        return F.count_if(reduce(lambda a, b: a | b, tests))

    one = df.agg(*[outside(c, *limit).alias(c) for c, limit in limits.items()])
    columns = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("violations")) for c in limits
    ]))
    return one.select(F.lit(table).alias("table"), columns.alias("c")).select("table", "c.*")


def expected_volumes(volumes: DataFrame, expected: Mapping[str, int] = C.EXPECTED_VOLUMES) -> DataFrame:
    """Table counts beside the expected ones; tables without a count show NULL."""
    wanted = volumes.sparkSession.createDataFrame(list(expected.items()), "table string, expected bigint")
    return wanted.join(volumes, "table", "left").withColumn(
        "as_expected", F.coalesce(F.col("n_rows") == F.col("expected"), F.lit(False))
    )


def name_overlap(a: DataFrame, b: DataFrame, column: str = "name") -> DataFrame:
    """Distinct names with where they occur: in ``a`` only, ``b`` only, or both.

    Both sides are cut to distinct names first, so the outer join is one to one.
    """
    left = a.select(column).distinct().withColumn("in_a", F.lit(True))
    right = b.select(column).distinct().withColumn("in_b", F.lit(True))
    return left.join(right, column, "full").select(
        column, F.coalesce("in_a", F.lit(False)).alias("in_a"), F.coalesce("in_b", F.lit(False)).alias("in_b")
    )


def join_coverage(a: DataFrame, b: DataFrame, key: str = "player_id") -> DataFrame:
    """Rows an inner join on ``key`` would give, without building them.

    Both sides are counted per key; the products of the counts add up to the
    size of the join.
    """
    left = a.groupBy(key).agg(F.count(F.lit(1)).alias("n_a"))
    right = b.groupBy(key).agg(F.count(F.lit(1)).alias("n_b"))
    return left.join(right, key).agg(F.coalesce(F.sum(F.col("n_a") * F.col("n_b")), F.lit(0)).alias("n_joined"))


def only_in(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of ``a`` whose key ``b`` does not have; the keys of ``b`` are never broadcast, there may be as many as rows."""
    return a.join(b.select(key).distinct().hint("merge"), key, "left_anti")


def model_gate(spark: SparkSession, metrics: Mapping[str, float], n_predictions: int) -> DataFrame:
    """Verdict per acceptance rule of a trained model. Keys of ``metrics``: ``global`` and positions."""
    rules = [
        ("r2_global", metrics.get("global"), C.MIN_R2),
        ("r2_attack", metrics.get("Attack"), C.MIN_R2_ATTACK),
        ("n_predictions", float(n_predictions), float(C.MIN_PREDICTIONS)),
    ]
    rows = [(rule, value, floor, value is not None and value >= floor) for rule, value, floor in rules]
    return spark.createDataFrame(rows, "rule string, value double, floor double, passed boolean")
