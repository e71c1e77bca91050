"""Readers, snapshot admission and the incremental job on small files."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from touchline import schemas
from touchline.operators import matches as M
from touchline.plans import clubs as club_plan
from touchline.sources import files, readers, records, snapshots, writers
from touchline.streaming import incremental


def doc(code, *matches):
    return {"competition": {"code": code, "name": code}, "matches": list(matches)}


def match(i, home, away, hg, ag, status="FINISHED", day="2024-08-17"):
    return {"id": i, "utcDate": f"{day}T14:00:00Z", "status": status, "matchday": 1, "season": {"startDate": "2024-08-01"},
            "homeTeam": {"id": 1, "name": home}, "awayTeam": {"id": 2, "name": away}, "score": {"fullTime": {"home": hg, "away": ag}}}


@pytest.fixture
def feed(tmp_path):
    root = tmp_path / "feed"
    root.mkdir()
    (root / "PL_2024_matches.json").write_text(json.dumps(doc("PL", match(1, "A", "B", 2, 1), match(2, "C", "D", None, None, "TIMED")), indent=2))
    (root / "PD_2024_matches.json").write_text(json.dumps(doc("PD", match(3, "E", "F", "x", 1)), indent=2))
    (root / "SA_2024_matches.json").write_text("{ not json")
    (root / "BL1_2024_matches.json").write_text(json.dumps({"competition": {"code": "BL1"}, "matches": []}))
    return root


def test_feed_skips_broken_and_empty_files(spark, feed):
    out = {r["game_id"]: r for r in readers.read_match_feed(spark, str(feed)).collect()}
    assert sorted(out) == [1, 2, 3]
    assert (out[1]["season"], str(out[1]["date"]), out[1]["home_club_goals"]) == (2024, "2024-08-17", 2)
    assert out[3]["home_club_goals"] is None and out[3]["away_club_goals"] == 1  # one odd score does not void its file


@pytest.fixture
def seasons(tmp_path):
    root = tmp_path / "seasons"
    for league in ("la_liga", "premier_league"):
        (root / league).mkdir(parents=True)
    (root / "la_liga/season-2324.csv").write_text("Date,HomeTeam,AwayTeam,FTHG,FTAG,FTR,HS\n12/08/2023,A,B,2,1,H,9\nbad,A,B,1,1,D,1\n")
    (root / "la_liga/season-2425.csv").write_text("HomeTeam,AwayTeam,FTAG,FTHG,Date,FTR\nC,D,0,3,17/08/24,H\n\"E, F\",G,,1,18/08/2024,\n")
    (root / "la_liga/season-2526.csv").mkdir()  # two part files of one season, each with its own order of columns
    (root / "la_liga/season-2526.csv/part-0.csv").write_text("Date,HomeTeam,AwayTeam,FTHG,FTAG\n01/08/2025,X,Y,4,0\n")
    (root / "la_liga/season-2526.csv/part-1.csv").write_text("FTAG,HomeTeam,FTHG,AwayTeam,Date\n1,Y,5,X,02/08/2025\n")
    (root / "la_liga/season-9394.csv").write_text("Date,HomeTeam,AwayTeam,FTHG,FTAG,FTR\n05/09/1993,Old,Older,1,0,H\n")
    (root / "premier_league/season-2425.csv").write_bytes("Date,HomeTeam,AwayTeam,FTHG,FTAG,FTR\n17/08/2024,Q".encode() + b"\xff" + "R,S,1,2,A\n".encode())
    (root / "premier_league/season-2223.csv").write_text("a,b\n1,2\n")
    return root


def test_season_files_with_different_headers(spark, seasons):
    out = readers.read_season_csv(spark, str(seasons))
    rows = {(r["competition"], r["season"], r["HomeTeam"]): r for r in out.collect()}
    assert [rows.pop(("PD", 2025, t))["FTHG"] for t in "XY"] == ["4", "5"]
    assert set(rows) == {("PD", 2023, "A"), ("PD", 2024, "C"), ("PD", 2024, "E, F"), ("PL", 2024, "Q�R")}
    assert (rows[("PD", 2024, "C")]["FTHG"], rows[("PD", 2024, "C")]["FTAG"], rows[("PD", 2024, "C")]["HS"]) == ("3", "0", None)
    aliases = spark.createDataFrame([("A", "A")], "alias string, canonical string")
    kept = M.season_for_union(out, aliases).collect()
    assert sorted((r["home_team"], str(r["date"]), r["home_goals"], r["home_shots"]) for r in kept) == [
        ("A", "2023-08-12", 2, 9), ("C", "2024-08-17", 3, None), ("Q�R", "2024-08-17", 1, None), ("X", "2025-08-01", 4, None), ("Y", "2025-08-02", 5, None)]


def test_no_season_files(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    assert readers.read_season_csv(spark, str(tmp_path / "empty")).count() == 0


def test_club_marts_twice(spark, feed, seasons):
    aliases = spark.createDataFrame([("A", "Alpha")], "alias string, canonical string")
    counts = []
    for _run in range(2):
        club_plan.build_club_marts(spark, str(feed), str(seasons), aliases)
        tables = ("unified_matches", "classements_equipes_unified", "matches", "avantage_domicile", "matches_enrichis", "competitions")
        counts.append([spark.table(f"marts_clubs.{t}").count() for t in tables])
    assert counts[0] == counts[1] and counts[0][0] == 6
    assert spark.table("marts_clubs.unified_matches").filter("home_team = 'Alpha'").count() == 2
    for name in writers.SCHEMAS:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def snapshot(spark, n=100, **drop):
    out = {}
    for name, types in schemas.SNAPSHOT.items():
        rows = spark.range(drop.get(name, n))
        out[name] = rows.select(*[F.col("id").cast(t).alias(c) if t in ("int", "bigint", "double", "string") else F.lit(None).cast(t).alias(c) for c, t in types.items()])
    return out


def test_snapshot_gates(spark, tmp_path):
    store = str(tmp_path / "store")
    snapshots.admit_snapshot(spark, snapshot(spark), store, "1")
    warned = snapshots.admit_snapshot(spark, snapshot(spark, transfers=89), store, "2")
    assert {v["table"]: v["verdict"] for v in warned}["transfers"] == "warning"
    with pytest.raises(snapshots.SnapshotRefused):
        snapshots.admit_snapshot(spark, snapshot(spark, transfers=26), store, "3")  # 26 of 89
    broken = snapshot(spark)
    broken["players"] = broken["players"].drop("foot")
    with pytest.raises(snapshots.SnapshotRefused):
        snapshots.admit_snapshot(spark, broken, store, "3")
    missing = snapshot(spark)
    del missing["games"]
    with pytest.raises(snapshots.SnapshotRefused):
        snapshots.admit_snapshot(spark, missing, store, "3")
    assert snapshots.current_version(spark, store) == "2"
    assert snapshots.current_table(spark, store, "transfers").count() == 89


def test_snapshot_with_missing_column_is_an_error(spark, tmp_path):
    for name, df in snapshot(spark, 3).items():
        (df.drop("foot") if name == "players" else df).write.option("header", True).csv(str(tmp_path / f"{name}.csv"))
    with pytest.raises(ValueError, match="foot"):
        readers.read_snapshot(spark, str(tmp_path))


def statuses(spark, now, before):
    return {r["file"]: (r["status"], r["lines_before"], r["lines_now"]) for r in files.detect_changed_files(now, before).collect()}


def test_changed_files(spark, tmp_path):
    root = tmp_path / "raw"
    (root / "sub").mkdir(parents=True)
    for name, text in (("a", "1\n2\n"), ("b", "2\n"), ("c", "3"), ("sub/a", "x\ny\nz"), ("swap", "one\ntwo\nthree\n"), ("empty", "")):
        (root / f"{name}.csv").write_text(text)
    files.manifest(spark, str(root), "*.csv").write.parquet(str(tmp_path / "before"))
    before = spark.read.parquet(str(tmp_path / "before"))
    (root / "a.csv").write_text("1\n2\n")  # written anew with the same content
    (root / "b.csv").write_text("changed\n")
    (root / "sub/a.csv").write_text("x\ny\nz\n")  # only the last line break is new
    (root / "swap.csv").write_text("one\nthree\ntwo\n")
    (root / "c.csv").unlink()
    (root / "d.csv").write_text("new\n")
    (root / "other.txt").write_text("not asked for")
    assert statuses(spark, files.manifest(spark, str(root), "*.csv"), before) == {
        "a.csv": ("unchanged", 2, 2), "b.csv": ("updated", 1, 1), "c.csv": ("absent", 1, None), "d.csv": ("updated", None, 1),
        "sub/a.csv": ("updated", 3, 3), "swap.csv": ("updated", 3, 3)}  # an empty file is not seen


@pytest.fixture
def pieces(spark):
    """Sets how many bytes of a file a task reads."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    yield lambda n: spark.conf.set(key, str(n))
    spark.conf.set(key, before)


def test_marks_do_not_depend_on_how_a_file_is_cut(spark, tmp_path, pieces):
    lines = [f"line {k * 7919 % 1000} " + "x" * (k % 40) for k in range(400)]
    text = "\n".join(lines) + "\r\n\n"
    (tmp_path / "one.csv").write_text(text, newline="")
    (tmp_path / "same.csv").write_text(text, newline="")
    (tmp_path / "swapped.csv").write_text("\n".join([*lines[:200], lines[201], lines[200], *lines[202:]]) + "\r\n\n", newline="")
    parts = tmp_path / "parts.csv"
    parts.mkdir()
    (parts / "part-0.csv").write_text("\n".join(lines[:150]) + "\n")
    (parts / "part-1.csv").write_text("\n".join(lines[150:]) + "\r\n\n", newline="")
    seen = set()
    for n in (100, 333, 1 << 20):
        pieces(n)
        got = {r["file"]: r["fingerprint"] for r in files.manifest(spark, str(tmp_path), "*.csv", r"(\w+)\.csv").collect()}
        assert got["one"] == got["same"] != got["swapped"] and set(got) == {"one", "same", "swapped", "parts"}
        assert got["parts"] == got["one"]  # a folder of parts counts as one file
        seen.add(tuple(sorted(got.items())))
    assert len(seen) == 1


def test_inventory(spark, feed, seasons):
    out = {r["path"].rsplit("/", 1)[1]: r for r in files.file_inventory(spark, str(feed)).collect()}
    assert out["PL_2024_matches.json"]["records"] == 2 and out["SA_2024_matches.json"]["records"] is None
    csvs = files.file_inventory(spark, str(seasons / "la_liga")).collect()
    assert {r["path"].rsplit("/", 1)[1]: (r["records"], r["n_columns"]) for r in csvs}["season-2324.csv"] == (2, 7)


def land(tmp_path, number, **named):
    folder = tmp_path / f"in/{number}"
    folder.mkdir(parents=True)
    for name, content in named.items():
        (folder / f"{name}.json").write_text(content if isinstance(content, str) else json.dumps(content, indent=1))


class Store:
    def __init__(self, spark, tmp_path):
        self.spark, self.path = spark, str(tmp_path / "store")
        self.feed, self.checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
        self.aliases = spark.createDataFrame([("A", "A")], "alias string, canonical string")

    def run(self):
        incremental.incremental_matches(self.spark, self.feed, self.path, self.checkpoint, self.aliases)
        return self.tables()

    def tables(self):
        rows = incremental.current_standings(self.spark, self.path).collect()
        return {(r["competition"], r["season"], r["club_name"]): (r["matchs_joues"], r["points"], r["buts_marques"], r["buts_encaisses"]) for r in rows}


def test_incremental_feed(spark, tmp_path):
    store = Store(spark, tmp_path)
    land(tmp_path, 1, PL=doc("PL", match(1, "A", "B", 2, 1), match(2, "C", "D", 1, 0)), PD=doc("PD", match(3, "E", "F", 0, 0)))
    first = store.run()
    assert first == {("PL", 2024, "A"): (1, 3, 2, 1), ("PL", 2024, "B"): (1, 0, 1, 2), ("PL", 2024, "C"): (1, 3, 1, 0),
                     ("PL", 2024, "D"): (1, 0, 0, 1), ("PD", 2024, "E"): (1, 1, 0, 0), ("PD", 2024, "F"): (1, 1, 0, 0)}
    written = sorted((tmp_path / "store").rglob("*.parquet"))
    assert store.run() == first and sorted((tmp_path / "store").rglob("*.parquet")) == written  # nothing new

    # the first match moved by a day, the second was called off, in a new version of the file;
    # the stored files of the other league cannot even be read
    hidden = {f: f.read_bytes() for f in written if "competition=PD" in str(f)}
    assert len(hidden) == 2
    for f in hidden:
        f.write_bytes(b"garbage")
        f.with_name(f".{f.name}.crc").unlink()
    land(tmp_path, 2, PL=doc("PL", match(1, "A", "B", 2, 1, day="2024-08-18"), match(2, "C", "D", None, None, "CANCELLED")))
    incremental.incremental_matches(spark, store.feed, store.path, store.checkpoint, store.aliases)
    for f, content in hidden.items():
        f.write_bytes(content)
    second = {k: v for k, v in first.items() if k[2] not in "CD"}
    assert store.tables() == second

    # a file that does not parse changes nothing, one without matches withdraws them
    land(tmp_path, 3, PL="{ not json", PD=doc("PD"))
    third = {k: v for k, v in second.items() if k[0] == "PL"}
    assert store.run() == third
    # another file lists a known game with another day and score: the game counts once
    land(tmp_path, 4, PL_late=doc("PL", match(1, "A", "B", 0, 3, day="2024-09-01")))
    fourth = store.run()
    assert fourth == {("PL", 2024, "A"): (1, 0, 0, 3), ("PL", 2024, "B"): (1, 3, 3, 0)}
    # that file goes empty: the older one counts again
    land(tmp_path, 5, PL_late=doc("PL"))
    assert store.run() == third
    for number in (3, 4):  # a batch done twice gives the same
        incremental.apply_batch(spark, store.path, number)
    assert store.tables() == third


def test_incremental_equals_rebuild(spark, tmp_path):
    """Files that come, change, overlap and go: after each batch the tables are those of the current versions."""
    rng, store, current = random.Random(5), Store(spark, tmp_path), {}
    for number in range(3):
        named = {}
        for name in rng.sample("abcdef", 3):
            code, season = rng.choice(["PL", "PD"]), rng.choice([2023, 2024])
            rows = []
            for _ in range(rng.randrange(6)):
                game = match(rng.randrange(8), *rng.sample("VWXYZ", 2), rng.randrange(4), rng.randrange(25), rng.choice(["FINISHED", "FINISHED", "TIMED"]),
                             f"2024-0{rng.randrange(1, 4)}-01")
                rows.append({**game, "season": {"startDate": f"{season}-08-01"}})
            named[name] = doc(code, *rows)
        land(tmp_path, number, **named)
        got = store.run()
        stamps = {name: (tmp_path / f"in/{number}/{name}.json").stat().st_mtime_ns // 1000 for name in named}
        for name, d in named.items():
            current[name] = (number, stamps[name], f"{number}/{name}", d)
        newest, want = {}, {}
        for b, t, v, d in current.values():
            for m in d["matches"]:
                key = (d["competition"]["code"], int(m["season"]["startDate"][:4]), m["id"])
                newest[key] = max(newest.get(key, (b, t, v)), (b, t, v))
        chosen = {}
        for b, t, v, d in current.values():
            for m in d["matches"]:
                league = (d["competition"]["code"], int(m["season"]["startDate"][:4]))
                if newest[(*league, m["id"])] == (b, t, v) and m["status"] == "FINISHED":
                    home, away, full = m["homeTeam"]["name"], m["awayTeam"]["name"], m["score"]["fullTime"]
                    at = (*league, m["utcDate"][:10], home, away)
                    chosen[at] = min(chosen.get(at, (99, 99)), (full["home"], full["away"]))
        for (code, season, _, home, away), (h, a) in chosen.items():
            if a <= 20:
                for club, f, g in ((home, h, a), (away, a, h)):
                    n, p, x, y = want.get((code, season, club), (0, 0, 0, 0))
                    want[(code, season, club)] = (n + 1, p + (3 if f > g else 1 if f == g else 0), x + f, y + g)
        assert got == want


def test_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,"b,c"\n1,"two\nlines, and ""quotes"""\n2,x\n')
    assert sorted(tuple(r) for r in readers.read_snapshot_table(spark, str(tmp_path), "t").collect()) == [("1", 'two\nlines, and "quotes"'), ("2", "x")]
    row = files.file_inventory(spark, str(tmp_path)).first()
    assert (row["records"], row["n_columns"]) == (2, 2)


def test_records_over_any_cut(spark, tmp_path, pieces):
    """A file of quoted line breaks, commas and quotes, cut anywhere: the records are those of a plain CSV reader."""
    rng = random.Random(11)
    rows = []
    for k in range(40):
        word = rng.choice(["plain", 'say ""hi""', "a,b", "two\nlines", "\n\n", 'x\n"" y\n', "long\n" * 9, "\u00e9\n\u4f60"])
        rows.append(f'{k},"{word}",{rng.choice(["", "end", chr(34) + "q" + chr(34)])}')
    text = "id,text,last\n" + "\n".join(rows) + "\n"
    (tmp_path / "t.csv").mkdir()
    (tmp_path / "t.csv/big.csv").write_text(text)
    (tmp_path / "t.csv/small.csv").write_text('last,id\r\n"z\r\nz",100\r\n')  # other columns, other line ends
    want = [(r[0], r[1], r[2] or None) for r in list(csv.reader(io.StringIO(text)))[1:]] + [("100", None, "z\r\nz")]
    for n in (23, 64, 1 << 20):
        pieces(n)
        out = readers.read_snapshot_table(spark, str(tmp_path), "t")
        assert sorted(out.columns) == ["id", "last", "text"]
        got = out.select("id", "text", "last").collect()
        assert sorted(map(tuple, got), key=lambda r: int(r[0])) == want
        assert sorted(r["records"] for r in files.csv_inventory(spark, str(tmp_path)).collect()) == [1, 40]
    pieces(64)
    lines = records.read_lines(spark, str(tmp_path), "big.csv")
    assert lines.rdd.getNumPartitions() >= len(text) // 64  # one file, many tasks


def test_a_quote_left_open_and_no_file(spark, tmp_path, pieces):
    pieces(9)
    (tmp_path / "t.csv").write_text('a,b\n1,2\n3,"open\n5,6\n7,8')
    got = records.csv_records(records.read_lines(spark, str(tmp_path))).collect()
    assert sorted(r["record"] for r in got) == ["1,2", '3,"open\n5,6\n7,8', "a,b"]
    (tmp_path / "none").mkdir()
    assert records.csv_records(records.read_lines(spark, str(tmp_path / "none"))).count() == 0
