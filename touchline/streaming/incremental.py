"""League tables kept up to date from feed files that are landed again and again.

A file is known by its name, whatever folder a refresh put it in. Its newest
version replaces all rows of the earlier ones: a match that moved or was
withdrawn leaves no trace in the tables. A batch subtracts what the replaced
rows had added and adds what the new ones bring; nothing else is computed anew.

The store holds, all partitioned so that a batch only ever writes folders of
its own number:

- ``rows``: every version of every match, by league season and batch;
- ``files``: which league seasons a version of a file has matches in, by batch;
- ``touched``: the league seasons a batch has to look at, by batch;
- ``standings``: the tables a batch changed, by league season and batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from touchline.functions import columns as X
from touchline.operators.matches import (
    SEASON_KEYS, TABLE_SUMS, flatten_matches, standings, unify_matches, with_differences, with_match_id, with_points,
)
from touchline.operators.names import normalize_team
from touchline.schemas import MATCH_FEED
from touchline.session import cut_lineage, kept_in_files
from touchline.sources.records import file_path
from touchline.sources.writers import replace_partitions

KEYS = ["competition", "season"]
# The last part of a path names a file; with folders that Spark wrote, use a pattern for the folder.
FILE_NAME = r"([^/]+)$"
_VERSION = "file string, version string, modified bigint"
_ROWS = (f"{_VERSION}, game_id bigint, status string, match_id string, source string, date date, round int, home_team string,"
         " away_team string, home_goals int, away_goals int, competition string, season int, batch bigint")
_FILES = f"{_VERSION}, competition string, season int, batch bigint"
_TOUCHED = "competition string, season int, batch bigint"
_TABLES = ("competition_name string, club_name string, " + ", ".join(f"{c} bigint" for c in TABLE_SUMS)
           + ", competition string, season int, batch bigint")


def _open(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of the store; its files are not looked into before a query needs them."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:  # nothing stored yet
        return spark.createDataFrame([], schema)


def parse_versions(docs: DataFrame, aliases: DataFrame, file_pattern: str = FILE_NAME) -> tuple[DataFrame, DataFrame]:
    """Matches and versions out of feed documents with their ``_metadata``.

    A file with a record that does not parse is no version of itself: what was
    known of it before stays. A version without matches is one all the same.
    Rows without competition or season belong to no table and go.
    """
    path = file_path()
    docs = docs.select(
        F.regexp_extract(path, file_pattern, 1).alias("file"), F.regexp_extract(path, f"^.*?{file_pattern}", 0).alias("version"),
        F.unix_micros("_metadata.file_modification_time").alias("modified"), "competition", "matches",
        (F.col("_corrupt").isNotNull() | F.col("matches").isNull()).alias("broken"))
    versions = docs.groupBy("file", "version").agg(F.max("modified").alias("modified"), F.bool_or("broken").alias("broken"))
    versions = kept_in_files(versions.filter("not broken").drop("broken"))  # one row for each file: read twice, broadcast if small
    whole = docs.drop("modified").join(versions, ["file", "version"])
    flat = flatten_matches(whole, keep=("file", "version", "modified"))
    flat = flat.select(
        "file", "version", "modified", "game_id", "status", F.lit("api").alias("source"),
        X.competition_code("competition_id", default="competition_id").alias("competition"), "date", "season", "round",
        F.col("home_club_name").alias("home_team"), F.col("away_club_name").alias("away_team"),
        F.col("home_club_goals").alias("home_goals"), F.col("away_club_goals").alias("away_goals"))
    rows = with_match_id(normalize_team(flat, aliases, ["home_team", "away_team"]))
    return rows.filter("competition is not null and season is not null"), versions


def newest_versions(files: DataFrame) -> DataFrame:
    """The version of each file that arrived last."""
    last = F.max(F.struct("batch", "modified", "version")).alias("last")
    return files.groupBy("file").agg(last).select("file", "last.version")


def newest_listings(rows: DataFrame) -> DataFrame:
    """Of the rows that counted ``before`` and of those that count ``after``, which say what holds for their game.

    A game listed in several files counts as the newest of them says, known by
    its id within its league season. Both states are found in one pass.
    """
    game = F.coalesce(F.col("game_id").cast("string"), F.col("match_id"))
    version, listed = F.struct("batch", "modified", "version"), Window.partitionBy(*KEYS, game)
    newest = {c: F.max(F.when(F.col(c), version)).over(listed) for c in ("before", "after")}
    rows = rows.withColumns({f"_{c}": n for c, n in newest.items()})
    return rows.withColumns({c: F.col(c) & version.eqNullSafe(F.col(f"_{c}")) for c in newest}).drop(*[f"_{c}" for c in newest])


def valid_matches(listings: DataFrame) -> DataFrame:
    """Matches that count, out of the newest listings: finished ones with plausible scores, one row per match id."""
    rows = listings.drop("file", "version", "modified", "game_id", "status", "batch", "before", "after")
    parts = rows.withColumn("match_id", F.struct("competition", "season", "match_id"))
    return unify_matches(parts, rows.sparkSession.createDataFrame([], "source string")).withColumn("match_id", F.col("match_id.match_id"))


def _sums(matches: DataFrame) -> DataFrame:
    return standings(with_points(matches), SEASON_KEYS).select(*SEASON_KEYS, "club_name", *TABLE_SUMS)


def table_changes(rows: DataFrame) -> DataFrame:
    """What each club's sums gain or lose: of ``rows`` those marked ``before`` counted so far, those marked ``after`` count now.

    All rows of the touched league seasons are moved once, to meet those of
    their game; after that a task sends at most one row of a match. A match no
    changed row can touch counts alike before and after and adds nothing.
    """
    listings = cut_lineage(newest_listings(rows).filter("status = 'FINISHED' and (before or after)"))
    old, new = (valid_matches(listings.filter(when)) for when in ("before", "after"))
    less = _sums(old).select(*SEASON_KEYS, "club_name", *[(-F.col(c)).alias(c) for c in TABLE_SUMS])
    return _sums(new).unionByName(less)


def league_seasons(files: DataFrame) -> DataFrame:
    return files.filter("season is not null").select(*KEYS).distinct()


def current_sums(tables: DataFrame) -> DataFrame:
    """The newest state of every league season; a season that lost all its matches is one row without a club."""
    newest = tables.groupBy(*KEYS).agg(F.max("batch").alias("batch"))
    return tables.join(newest, [*KEYS, "batch"], "left_semi").drop("batch")


def apply_batch(spark: SparkSession, store: str, number: int) -> None:
    """Bring the tables up to batch ``number``, whose rows and versions are stored already.

    Reads the league seasons that a new or a replaced version has matches in,
    found in the small table of files, and of those the current rows: the
    stored matches are joined by their partition columns, so other folders are
    not opened. Everything is derived from batches below ``number`` and written
    under it; doing it again gives the same.
    """
    files = _open(spark, f"{store}/files", _FILES).filter(F.col("batch") <= number)
    mine, earlier = files.filter(F.col("batch") == number), files.filter(F.col("batch") < number)
    again = earlier.join(mine.select("file").distinct(), "file", "left_semi")
    replaced = again.join(newest_versions(again), ["file", "version"], "left_semi")
    league_seasons(mine.unionByName(replaced)).write.mode("overwrite").parquet(f"{store}/touched/batch={number}")
    touched = _open(spark, f"{store}/touched", _TOUCHED).filter(F.col("batch") == number).drop("batch")
    was, now = (newest_versions(f).withColumn(c, F.lit(True)) for f, c in ((earlier, "was"), (files, "now")))
    versions = cut_lineage(was.join(now, ["file", "version"], "full"))  # one row for each file, two where it changed
    rows = _open(spark, f"{store}/rows", _ROWS).filter(F.col("batch") <= number).join(touched, KEYS, "left_semi")
    rows = rows.join(versions, ["file", "version"]).withColumns({
        "before": F.coalesce("was", F.lit(False)) & (F.col("batch") < number), "after": F.coalesce("now", F.lit(False))}).drop("was", "now")
    changes = cut_lineage(table_changes(rows))
    tables = _open(spark, f"{store}/standings", _TABLES).filter(F.col("batch") < number).join(touched, KEYS, "left_semi")
    parts = [*SEASON_KEYS, "club_name"]
    known = current_sums(tables).filter("club_name is not null").select(*parts, *TABLE_SUMS)
    total = known.unionByName(changes).groupBy(*parts).agg(*[F.sum(c).alias(c) for c in TABLE_SUMS]).filter("matchs_joues > 0")
    # a league season left without a valid match gets a row that says so, and no table
    none = touched.join(total.select(*KEYS).distinct(), KEYS, "left_anti")
    out = total.unionByName(none, allowMissingColumns=True).withColumn("batch", F.lit(number).cast("bigint"))
    replace_partitions(out, f"{store}/standings", [*KEYS, "batch"])


def incremental_matches(
    spark: SparkSession, feed: str, store: str, checkpoint: str, aliases: DataFrame, multi_line: bool = True,
    file_pattern: str = FILE_NAME,
) -> None:
    """Process the feed files no earlier run has seen, then stop.

    Land each refresh under a folder of its own: ``in/2024-08-20/PL_2024.json``
    and ``in/2024-08-27/PL_2024.json`` are two versions of one file. The part of
    the path that ``file_pattern`` captures names the file; what the path has up
    to there names the version, so a file may be a folder of parts.

    Each micro-batch overwrites its own ``batch`` partitions, so a batch that is
    replayed after a lost driver gives the same tables; files already processed
    are known to the checkpoint, so a second run does nothing.
    """
    schema = T.StructType([*MATCH_FEED.fields, T.StructField("_corrupt", T.StringType())])
    docs = spark.readStream.schema(schema).options(
        multiLine=multi_line, recursiveFileLookup=True, pathGlobFilter="*.json", mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt",
    ).json(feed).select("*", "_metadata")

    def one_batch(batch: DataFrame, number: int) -> None:
        rows, versions = parse_versions(batch, aliases, file_pattern)
        stamp = F.lit(number).cast("bigint").alias("batch")
        replace_partitions(rows.select("*", stamp), f"{store}/rows", [*KEYS, "batch"])
        stored = _open(spark, f"{store}/rows", _ROWS).filter(F.col("batch") == number)
        seasons = stored.select("file", "version", *KEYS).distinct()
        versions.join(seasons, ["file", "version"], "left").write.mode("overwrite").parquet(f"{store}/files/batch={number}")
        apply_batch(spark, store, number)

    query = (
        docs.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def current_standings(spark: SparkSession, store: str) -> DataFrame:
    """The league tables as of the last batch."""
    sums = current_sums(_open(spark, f"{store}/standings", _TABLES)).filter("club_name is not null")
    return with_differences(sums.select(*SEASON_KEYS, "club_name", *TABLE_SUMS))
