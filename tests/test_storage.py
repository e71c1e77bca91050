"""Marts for lookups, ranked pages, snapshot commits and the raw feed."""

import glob
import json
import threading
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_sources import doc, match, snapshot

from touchline import schemas
from touchline.sources import indexed, readers, snapshots, writers


def scanned(df):
    """Rows that the file scans of an executed plan gave, and its text."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName().startswith("Adaptive"):
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    nodes = [leaves.apply(i) for i in range(leaves.size())]
    return sum(n.metrics().apply("numOutputRows").value() for n in nodes), df._jdf.queryExecution().toString()


@pytest.fixture
def mart(spark, tmp_path):
    """20 000 appearances of 2 000 players in eight buckets with small row groups."""
    df = spark.range(20_000).select(
        (F.col("id") % 2000 * 10).alias("player_id"), F.date_add(F.lit("2020-01-01"), (F.col("id") / 2000).cast("int")).alias("date"),
        F.concat(F.lit("c"), (F.col("id") % 7).cast("string")).alias("competition_id"), F.xxhash64("id").alias("pay"))
    spark.conf.set("parquet.block.size", "8192")
    spark.sql("DROP TABLE IF EXISTS appearances")
    indexed.write_mart(df, "appearances", str(tmp_path / "m"), buckets=8)
    yield df, str(tmp_path / "m")
    spark.conf.unset("parquet.block.size")
    spark.sql("DROP TABLE appearances")


def test_a_lookup_opens_one_bucket_and_few_rows(spark, mart):
    df, path = mart
    found = indexed.lookup(spark, "appearances", "player_id", 4560)
    rows, _ = scanned(found)
    assert sorted(found.collect()) == sorted(df.filter("player_id = 4560").select(*found.columns).collect()) and found.count() == 10
    assert 10 <= rows < 20_000 / 8  # of the bucket, only row groups that may hold the player
    per_bucket = {f: pq.ParquetFile(f) for f in glob.glob(f"{path}/*.parquet")}
    assert max(f.metadata.num_row_groups for f in per_bucket.values()) > 2
    # 4565 lies among the players but is none: ranges cannot tell, the Bloom filters can
    rows, _ = scanned(indexed.lookup(spark, "appearances", "player_id", 4565))
    assert rows == 0
    many = spark.table("appearances").filter("competition_id = 'c9'")
    assert scanned(many)[0] == 0
    # the other buckets cannot even be read
    for file, parquet in per_bucket.items():
        if 4560 not in parquet.read(["player_id"]).column(0).to_pylist():
            Path(file).write_bytes(b"garbage")
            Path(file).with_name(f".{Path(file).name}.crc").unlink()
    assert len(per_bucket) == 8 and indexed.lookup(spark, "appearances", "player_id", 4560).count() == 10


def test_buckets_join_without_a_shuffle(spark, mart):
    a = spark.table("appearances").groupBy("player_id").agg(F.count(F.lit(1)).alias("n"))
    assert "Exchange hashpartitioning" not in a._jdf.queryExecution().executedPlan().toString() and a.count() == 2000


def test_league_seasons_are_folders(spark, tmp_path):
    df = spark.range(100).selectExpr("concat('L', id % 3) competition", "cast(2000 + id % 2 as int) season", "date_add(date'2000-01-01', cast(id as int)) date",
                                     "concat('T', id % 10) home_team", "id")
    spark.sql("DROP TABLE IF EXISTS unified_matches")
    indexed.write_mart(df, "unified_matches", str(tmp_path / "u"))
    part = spark.table("unified_matches").filter("competition = 'L1' and season = 2001")
    assert scanned(part)[0] == part.count() == df.filter("competition = 'L1' and season = 2001").count()
    spark.sql("DROP TABLE unified_matches")


def test_pages(spark, tmp_path):
    df = spark.range(5000).select("id", (F.xxhash64("id") % 50).alias("score")).withColumn("score", F.when(F.col("id") % 11 > 0, F.col("score")))
    df = df.union(df.limit(30))  # repeated rows
    order = [F.col("score").desc_nulls_last()]
    path = str(tmp_path / "ranked")
    indexed.write_ranked(df, order, path, range_rows=300)
    everything = [tuple(r) for r in df.orderBy(*order, "id").collect()]
    for offset, limit in ((0, 20), (290, 30), (4990, 100), (2500, 1), (0, 0), (6000, 20), (1000, 900)):
        page = indexed.read_page(spark, path, order, limit, offset)
        assert [tuple(r) for r in page.collect()] == everything[offset:offset + limit]
    rows, _ = scanned(indexed.read_page(spark, path, order, 20, 4500))
    assert rows < 1000  # a range or two, not the 4 500 before
    indexed.write_ranked(df.limit(0), order, str(tmp_path / "none"))
    assert indexed.read_page(spark, str(tmp_path / "none"), order).count() == 0


def test_each_table_is_read_once(spark, tmp_path):
    store, counter = str(tmp_path / "store"), spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            counter.add(len(b))
            yield b

    tables = {n: df.mapInPandas(count, df.schema) for n, df in snapshot(spark).items()}
    for version, rows in (("1", 600), ("2", 1200)):
        snapshots.admit_snapshot(spark, tables, store, version)
        assert counter.value == rows  # six tables of 100 rows, also where they are compared with those before


def test_verdicts_name_missing_keys(spark, tmp_path):
    tables = snapshot(spark)
    tables["players"] = tables["players"].withColumn("name", F.when(F.col("player_id") > 4, F.col("name")))
    verdicts = {v["table"]: v for v in snapshots.admit_snapshot(spark, tables, str(tmp_path), "1")}
    assert verdicts["players"]["missing"]["name"] == 5 and verdicts["players"]["n_new"] == 100 and verdicts["players"]["verdict"] == "first"


def test_two_writers(spark, tmp_path):
    store = str(tmp_path / "store")
    snapshots.admit_snapshot(spark, snapshot(spark), store, "1")
    reader = snapshots.current_tables(spark, store)
    a = snapshots.prepare_snapshot(spark, snapshot(spark, 90), store, "2", "a")
    b = snapshots.prepare_snapshot(spark, snapshot(spark, 95), store, "2", "b")  # the same version name
    snapshots.commit_snapshot(spark, a)
    with pytest.raises(snapshots.SnapshotConflict):
        snapshots.commit_snapshot(spark, b)
    assert snapshots.current_table(spark, store, "clubs").count() == 90
    assert reader["clubs"].count() == 100  # who has opened the earlier version keeps it
    assert [r["version"] for r in spark.read.parquet(f"{store}/log").orderBy("refreshed_at").collect()] == ["1", "2"]
    # at the same time: one is admitted, and compared again the other is too
    attempts, failed = [snapshots.prepare_snapshot(spark, snapshot(spark, n), store, f"{n}") for n in (91, 92)], []

    def commit(attempt):
        try:
            snapshots.commit_snapshot(spark, attempt)
        except snapshots.SnapshotConflict:
            failed.append(attempt.version)

    threads = [threading.Thread(target=commit, args=(x,)) for x in attempts]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(failed) == 1 and snapshots.current_version(spark, store) == ({"91", "92"} - set(failed)).pop()
    snapshots.admit_snapshot(spark, snapshot(spark, 93), store, "later")
    assert snapshots.newest_commit(spark, store)["number"] == 4


def test_the_raw_feed_keeps_everything(spark, tmp_path):
    root = tmp_path / "feed"
    root.mkdir()
    full = match(1, "A", "B", 2, 1) | {"venue": {"name": "Ground", "rows": [1, {"deep": True}]}, "attendance": 12_000}
    odd = match("2", "C", "D", "x", 1) | {"attendance": "sold out", "homeTeam": "not an object", "id": 2.0}
    (root / "PL.json").write_text(json.dumps(doc("PL", full, odd, "no match at all") | {"fetched": "today"}, indent=1))
    (root / "SA.json").write_text("{ not json")
    (root / "FL.json").write_text(json.dumps({"competition": "?", "matches": {"none": 1}}))
    writers.land_bronze(readers.read_raw_feed(spark, str(root)), str(tmp_path / "bronze"))
    bronze = spark.read.parquet(str(tmp_path / "bronze"))
    assert {r["path"].rsplit("/", 1)[1]: r["text"] for r in bronze.collect()} == {"PL.json": None, "SA.json": "{ not json", "FL.json": None}
    asked = bronze.select(F.try_variant_get("doc", "$.fetched", "string").alias("f"), F.try_variant_get("doc", "$.matches[0].venue.rows[1].deep", "boolean").alias("d"))
    assert ("today", True) in [tuple(r) for r in asked.collect()]
    out = {r["game_id"]: r for r in readers.matches_of_raw(bronze, {"seen": ("$.attendance", "int"), "ground": ("$.venue.name", "string")}).collect()}
    assert set(out) == {1, 2}
    assert (out[1]["seen"], out[1]["ground"], out[1]["home_club_name"], out[1]["season"]) == (12_000, "Ground", "A", 2024)
    assert (out[2]["seen"], out[2]["home_club_name"], out[2]["away_club_name"], out[2]["home_club_goals"]) == (None, None, "D", None)
    # well-formed documents flatten as the typed reader does
    (root / "SA.json").write_text(json.dumps(doc("SA", match(5, "E", "F", 0, 0), match(6, "G", "H", None, None, "TIMED"))))
    (root / "PL.json").write_text(json.dumps(doc("PL", full)))
    raw = readers.matches_of_raw(readers.read_raw_feed(spark, str(root)))
    typed = readers.read_match_feed(spark, str(root))
    assert raw.columns == typed.columns and sorted(map(tuple, raw.collect())) == sorted(map(tuple, typed.collect()))


def test_declared_layouts_name_columns(spark):
    assert set(schemas.MART_INDEXES) >= {"appearances", "unified_matches", "features_temporal"}
