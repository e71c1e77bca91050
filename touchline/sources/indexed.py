"""Marts laid out for lookups: buckets, sorted files and Bloom filters where a database has indexes; ranges for pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.schemas import MART_INDEXES


def write_indexed(
    df: DataFrame, table: str, path: str, key: str | None = None, sort: Sequence[str] = (), partition_by: Sequence[str] = (),
    bloom: Sequence[str] = (), buckets: int = 64,
) -> None:
    """Write a table so that a lookup opens little of it.

    ``partition_by`` gives a folder for each value. Rows are dealt into
    ``buckets`` by ``key`` and sorted within their file by ``key`` and ``sort``,
    so an equality on the key opens one bucket, and the ranges of its row groups
    leave out most of that. ``bloom`` columns get Parquet Bloom filters, so a
    value that is not there opens no row group. Rows of a bucket come together
    first; AQE splits a bucket that is far larger than the others.
    """
    by = [*([key] if key else []), *sort]
    df = df.hint("rebalance", buckets, key) if key else df.hint("rebalance", *partition_by)
    if not key:
        df = df.sortWithinPartitions(*partition_by, *by)
    writer = df.write.mode("overwrite").option("path", path).option("parquet.bloom.filter.adaptive.enabled", "true")
    for c in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer = writer.partitionBy(*partition_by)
    if key:
        writer = writer.bucketBy(buckets, key).sortBy(*by)
    writer.saveAsTable(table, format="parquet")


def write_mart(df: DataFrame, table: str, path: str, buckets: int = 64) -> None:
    """A mart with the layout declared for it in ``MART_INDEXES``."""
    write_indexed(df, table, path, buckets=buckets, **MART_INDEXES[table.rsplit(".", 1)[-1]])


def lookup(spark: SparkSession, table: str, key: str, value, columns: Sequence[str] | None = None) -> DataFrame:
    """The rows of a stored mart with one value of its key."""
    rows = spark.table(table).filter(F.col(key) == F.lit(value))
    return rows.select(*columns) if columns else rows


def write_ranked(df: DataFrame, order: Sequence[Column], path: str, range_rows: int = 100_000) -> None:
    """Write a table in ranges of its order, with the number of rows before each.

    ``rows`` holds the table, a folder for each range; ``starts`` has one short
    row for each. Ties are broken by all columns, so every row has one place.
    """
    spark = df.sparkSession
    by = [*order, *[F.col(c).asc_nulls_first() for c in df.columns]]
    count = df.count()
    n = max(1, -(-count // range_rows))
    ranges = df.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("range", F.spark_partition_id())
    ranges.write.mode("overwrite").partitionBy(*(["range"] if count else [])).parquet(f"{path}/rows")  # an empty table keeps its columns
    stored = spark.read.schema(ranges.schema).parquet(f"{path}/rows")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    counts = stored.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    counts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).write.mode("overwrite").parquet(f"{path}/starts")


def read_page(spark: SparkSession, path: str, order: Sequence[Column], limit: int = 20, offset: int = 0) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of a ranked table; only the ranges that hold them are opened.

    However deep the page, at most one range is sorted beside what it returns.
    """
    starts = spark.read.schema("range int, n bigint, start bigint").parquet(f"{path}/starts")
    held = starts.filter((F.col("start") < offset + limit) & (F.col("start") + F.col("n") > offset)).collect()
    rows = spark.read.parquet(f"{path}/rows").filter(F.col("range").isin([r["range"] for r in held] or [-1])).drop("range")
    by = [*order, *[F.col(c).asc_nulls_first() for c in rows.columns]]
    return rows.orderBy(*by).offset(offset - min((r["start"] for r in held), default=offset)).limit(limit)
