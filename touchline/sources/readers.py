"""Readers of the raw match feed, season files and player snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline import constants as C
from touchline.functions import columns as X
from touchline.operators import clean
from touchline.operators.matches import flatten_matches
from touchline.schemas import MATCH_FEED, SEASON_REQUIRED, SEASON_STATS, SNAPSHOT, SNAPSHOT_REQUIRED
from touchline.sources.records import csv_fields, file_path, read_csv_records

_CORRUPT = T.StructField("_corrupt", T.StringType())


def read_feed_documents(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Feed documents that parse and hold matches; the others are left out.

    One document per file by default. For many small documents store one per
    line and pass ``multi_line=False``: such files are split over tasks.
    """
    reader = spark.read.schema(T.StructType([*MATCH_FEED.fields, _CORRUPT])).options(
        mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt", multiLine=multi_line,
        recursiveFileLookup=True, pathGlobFilter="*.json",
    )
    docs = reader.json(path)
    return docs.filter(F.col("_corrupt").isNull() & (F.size("matches") > 0)).drop("_corrupt")


def read_raw_feed(spark: SparkSession, path: str, multi_line: bool = True, glob: str = "*.json") -> DataFrame:
    """Feed documents as they came: ``path``, ``doc`` (VARIANT) and ``text``, which is kept where it does not parse.

    Whatever fields and types a document has are kept. One document per file by
    default; with ``multi_line=False`` one per line, and files are split over tasks.
    """
    docs = spark.read.options(recursiveFileLookup=True, pathGlobFilter=glob).text(path, wholetext=multi_line)
    docs = docs.filter(F.trim("value") != "").select(file_path().alias("path"), F.try_parse_json("value").alias("doc"), "value")
    return docs.select("path", "doc", F.when(F.col("doc").isNull(), F.col("value")).alias("text"))


def matches_of_raw(raw: DataFrame, more: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """All matches of the raw feed, one row each: the 13 columns of the feed, after those asked for in ``more``.

    ``more`` maps a column to the path and the type of a field of a match that
    no schema names. Matches are taken out of the document one by one, so a field
    of an odd type is missing in its own match and voids nothing else.
    """
    competition, match = MATCH_FEED["competition"].dataType, MATCH_FEED["matches"].dataType.elementType
    m = raw.select(F.try_variant_get("doc", "$.competition", competition.simpleString()).alias("competition"),
                   F.explode(F.try_variant_get("doc", "$.matches", "array<variant>")).alias("m"))
    m = m.filter(F.try_variant_get("m", "$", "map<string,variant>").isNotNull())

    def typed(kind: T.DataType, at: str) -> Column:
        if isinstance(kind, T.StructType):
            return F.struct(*[typed(f.dataType, f"{at}.{f.name}").alias(f.name) for f in kind.fields])
        return F.try_variant_get("m", at, kind.simpleString())

    more = more or {}
    shaped = m.select(*[F.try_variant_get("m", at, kind).alias(c) for c, (at, kind) in more.items()],
                      "competition", F.array(typed(match, "$")).alias("matches"))
    return flatten_matches(shaped, tuple(more))


def read_match_feed(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """All matches of the feed, one row each, 13 columns."""
    return flatten_matches(read_feed_documents(spark, path, multi_line))


# .../premier_league/season-2425.csv, as a file or as a folder Spark wrote;
# the levels may carry a ``name=`` in front.
_SEASON_PATH = r"(?:^|/)(?:\w+=)?({leagues})/(?:\w+=)?(season-(\d\d)\d\d)\.csv"


def read_season_csv(spark: SparkSession, root: str, first_season: int = C.FIRST_SEASON) -> DataFrame:
    """Rows of all season files as text columns, with competition and season.

    Headers differ between seasons and between files, so each file is read by
    its own: its first line that names both teams. Lines and headers are joined
    by file and columns are taken by name, in one plan for all layouts and
    without a list of files on the driver. Old seasons are dropped by file name.
    """
    path = file_path()
    pattern = _SEASON_PATH.format(leagues="|".join(C.LEAGUE_FOLDERS))
    files = spark.read.options(recursiveFileLookup=True, pathGlobFilter="*.csv").text(root)
    files = files.filter(path.rlike(pattern) & (X.season_start_year(path) >= first_season))
    lines = files.select(
        path.alias("path"), F.regexp_replace("value", "^\ufeff|\r$", "").alias("line"), F.monotonically_increasing_id().alias("at"))
    lines = lines.withColumns({
        "competition": X.lookup(F.regexp_extract("path", pattern, 1), C.LEAGUE_FOLDERS), "season": X.season_start_year(F.col("path"))})
    lines = lines.filter(F.trim("line") != "")
    heads = lines.filter(F.col("line").contains("HomeTeam") & F.col("line").contains("AwayTeam"))
    heads = heads.groupBy("path").agg(F.min_by("line", "at").alias("head"), F.min("at").alias("head_at"))
    width = heads.agg(F.max(F.size(F.split("head", ",", -1)))).first()[0] or 1
    heads = heads.withColumn("names", csv_fields(F.col("head"), width)).filter(F.array_contains("names", "HomeTeam"))
    rows = lines.join(heads, "path").filter((F.col("at") > F.col("head_at")) & (F.col("line") != F.col("head")))
    rows = rows.withColumn("fields", csv_fields(F.col("line"), width))

    def cell(name: str) -> Column:
        return F.get("fields", F.array_position("names", F.lit(name)).cast("int") - 1).alias(name)

    return rows.select("competition", "season", *[cell(c) for c in [*SEASON_REQUIRED, *SEASON_STATS]])


def read_snapshot_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One snapshot table as text, as it lies in the file, whatever its column order.

    Quoted line breaks stay in their field, and a file is still read by many
    tasks: see :func:`csv_records`.
    """
    return read_csv_records(spark, f"{root}/{name}.csv")


def read_snapshot(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The six snapshot tables, typed. A missing file or column is an error."""
    out = {}
    for name, types in SNAPSHOT.items():
        raw = read_snapshot_table(spark, root, name)
        missing = sorted(set(SNAPSHOT_REQUIRED[name]) - set(raw.columns))
        if missing:
            raise ValueError(f"{name}: missing columns {missing}")
        out[name] = clean.conform(raw, types)
    return out


def read_table(spark: SparkSession, table: str, columns: Sequence[str] | None = None, where: str | None = None) -> DataFrame:
    """A stored table by name, or by path if it has a slash, pruned at the scan."""
    df = spark.read.parquet(table) if "/" in table else spark.table(table)
    if where:
        df = df.filter(where)
    return df.select(*columns) if columns else df


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A database table; with a partition column the scan runs in parallel."""
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(url, table, partition_column, lower, upper, partitions, properties=properties)


def read_team_aliases(spark: SparkSession, path: str) -> DataFrame:
    """Two-column CSV (``alias``, ``canonical``) of team spellings."""
    return spark.read.schema("alias string, canonical string").option("header", True).csv(path)


def competitions_dim(spark: SparkSession) -> DataFrame:
    """The five covered competitions."""
    return spark.createDataFrame(
        C.COMPETITIONS,
        "competition_id string, competition_name string, country string, confederation string, tier int,"
        " nb_clubs int, nb_matchs_saison int, transfermarkt_id string, football_data_id string",
    )
