"""What lies in a raw folder, and what changed since the last look."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import kept_in_files
from touchline.sources.readers import read_feed_documents
from touchline.sources.records import content_marks, csv_records, file_path, read_lines


def listing(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Path, size and time of every file; nothing is read but the folders."""
    files = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=glob).load(root)
    return files.select(file_path().alias("path"), F.col("length").alias("size"), "modificationTime")


def _below(path: Column, root: str) -> Column:
    """The part of a path below ``root``, or all of it if the root is a pattern."""
    folder = re.sub(r"^\w+:/*(?=/)", "", root.rstrip("/"))
    return F.coalesce(F.nullif(F.regexp_extract(path, re.escape(folder) + "/(.*)$", 1), F.lit("")), path)


def manifest(spark: SparkSession, root: str, glob: str = "*", file_pattern: str | None = None) -> DataFrame:
    """One row per file: ``file``, ``size``, ``modificationTime``, ``lines`` and a ``fingerprint`` of its content.

    A file written anew with the same content keeps its fingerprint; see
    :func:`content_marks` for how tasks share the work. A file is named by its
    path below ``root``, or by the group of ``file_pattern``: parts of one name
    count as one file. Spark does not list empty files: one counts as absent.
    """
    name = F.regexp_extract("path", file_pattern, 1) if file_pattern else _below(F.col("path"), root)
    files = listing(spark, root, glob).withColumn("file", name)
    files = files.groupBy("file").agg(F.sum("size").alias("size"), F.max("modificationTime").alias("modificationTime"))
    marks = content_marks(spark, root, glob, name)
    mark = F.concat_ws("-", F.col("size").cast("string"), F.coalesce("mark", F.lit("empty")))
    return files.join(marks, "file", "left").select(
        "file", "size", "modificationTime", F.coalesce("lines", F.lit(0)).alias("lines"), mark.alias("fingerprint"))


def detect_changed_files(now: DataFrame, before: DataFrame) -> DataFrame:
    """Per file of two manifests: ``updated`` (new or different), ``unchanged`` or ``absent``, with the lines it has and had."""
    a = now.select("file", F.col("fingerprint").alias("new_mark"), F.col("lines").alias("lines_now"))
    b = before.select("file", F.col("fingerprint").alias("old_mark"), F.col("lines").alias("lines_before"))
    status = (
        F.when(F.col("new_mark").isNull(), "absent")
        .when(F.col("new_mark").eqNullSafe(F.col("old_mark")), "unchanged")
        .otherwise("updated")
    )
    return a.join(b, "file", "full").select("file", status.alias("status"), "lines_now", "lines_before")


def csv_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Per CSV file: size, records without the header, columns of the header.

    Quoted line breaks, commas and doubled quotes are read as the CSV reader
    does; a large file is counted by many tasks.
    """
    files = listing(spark, root, "*.csv").select("path", "size")
    lines = read_lines(spark, root, "*.csv", "record")
    records = csv_records(lines.withColumnRenamed("record", "line")).filter(~F.col("record").isin("", "\r"))
    first = F.min(F.when(F.col("block") == 0, F.col("at"))).alias("at")
    counted = kept_in_files(records.groupBy("path").agg((F.count(F.lit(1)) - 1).alias("records"), first))  # one row for each file
    heads = kept_in_files(lines.select("path", "at", "record").join(counted, ["path", "at"]))  # mostly the first record is one line
    if not heads.filter(F.regexp_count("record", F.lit('"')) % 2 == 1).isEmpty():
        heads = records.select("path", "at", "record").join(counted, ["path", "at"])
    quoted = F.regexp_replace("record", r'"(?:[^"]|"")*"', "x")  # a quoted name is one field, whatever is in it
    counted = heads.select("path", "records", F.size(F.split(quoted, ",", -1)).alias("n_columns"))
    return files.join(counted, "path").select("path", "size", "records", "n_columns", F.lit("csv").alias("type"))


def json_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Per feed document: size and number of matches."""
    docs = read_feed_documents(spark, root)
    return docs.select(
        file_path().alias("path"), F.col("_metadata.file_size").alias("size"),
        F.size("matches").cast("bigint").alias("records"),
        F.lit(None).cast("int").alias("n_columns"), F.lit("json").alias("type"),
    )


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """All files of a raw folder; other types show their size only."""
    known = csv_inventory(spark, root).unionByName(json_inventory(spark, root))
    every = listing(spark, root).select("path", "size")
    kind = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    return every.join(known.drop("size"), "path", "left").withColumn("type", F.coalesce("type", kind))
