"""Admit a new player snapshot, or refuse it and leave the current one alone.

A store holds ``tables``, one folder for each attempt; ``commits``, one small
file for each admitted snapshot, numbered; and ``log``, when and from where.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from touchline.operators.quality import check_required_columns, volume_verdicts
from touchline.schemas import SNAPSHOT_REQUIRED
from touchline.sources.writers import write_refresh_log


class SnapshotRefused(Exception):
    """A gate failed; ``verdicts`` holds one row per table."""

    def __init__(self, verdicts: list):
        super().__init__("; ".join(str(v) for v in verdicts))
        self.verdicts = verdicts


class SnapshotConflict(Exception):
    """Another snapshot was admitted while this one was being written."""


_COMMIT = "number bigint, version string, path string, source string, rows map<string,bigint>"


def commits(spark: SparkSession, store: str) -> DataFrame:
    """All admitted versions with their rows per table."""
    return spark.read.schema(_COMMIT).json(f"{store}/commits").filter("number is not null")


def newest_commit(spark: SparkSession, store: str) -> Row | None:
    """The commit with the highest number; ``None`` before the first admission."""
    try:
        return commits(spark, store).orderBy(F.desc("number")).first()
    except AnalysisException:
        return None


def current_version(spark: SparkSession, store: str) -> str | None:
    commit = newest_commit(spark, store)
    return commit and commit["version"]


def current_table(spark: SparkSession, store: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{newest_commit(spark, store)['path']}/{name}")


def current_tables(spark: SparkSession, store: str) -> dict[str, DataFrame]:
    """All tables of one and the same version, whatever is admitted meanwhile."""
    commit = newest_commit(spark, store)
    return {name: spark.read.parquet(f"{commit['path']}/{name}") for name in commit["rows"]}


@dataclass
class Attempt:
    """A snapshot written and checked, but not admitted yet: ``base`` is the commit it was compared with."""

    store: str
    version: str
    source: str
    path: str
    base: int
    rows: dict[str, int] = field(default_factory=dict)
    verdicts: list = field(default_factory=list)


def prepare_snapshot(spark: SparkSession, new: Mapping[str, DataFrame], store: str, version: str, source: str = "") -> Attempt:
    """Write all tables into a folder of their own, and check them while they are written.

    Every table is read once: its rows and missing keys are counted by metrics
    that ride along with the write, and the volume of the current version is
    known from its commit. Missing columns refuse a snapshot before anything is
    written; too few rows leave an unused folder.
    """
    absent = sorted(set(SNAPSHOT_REQUIRED) - set(new))
    if absent:
        raise SnapshotRefused([f"missing table {name}" for name in absent])
    columns = {name: check_required_columns(df, SNAPSHOT_REQUIRED[name], name).first() for name, df in new.items()}
    if any(c["refused"] for c in columns.values()):
        raise SnapshotRefused([c for c in columns.values() if c["refused"]])
    before = newest_commit(spark, store)
    attempt = Attempt(store, version, source, f"{store}/tables/{version}-{uuid.uuid4().hex}", before["number"] if before else 0)
    counts = []
    for name, df in new.items():
        seen = Observation()
        missing = [F.count_if(F.col(c).isNull()).alias(c) for c in sorted(SNAPSHOT_REQUIRED[name])]
        df.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.struct(*missing).alias("missing")).write.parquet(f"{attempt.path}/{name}")
        attempt.rows[name] = seen.get["n_rows"]
        nulls = {c: n for c, n in seen.get["missing"].asDict().items() if n}
        counts.append((name, attempt.rows[name], (before["rows"].get(name) or 0) if before else 0, nulls))
    rows = spark.createDataFrame(counts, "table string, n_new bigint, n_old bigint, missing map<string,bigint>")
    attempt.verdicts = volume_verdicts(rows).collect()  # one row for each table
    bad = [v for v in attempt.verdicts if v["verdict"] == "refused"]
    if bad:
        raise SnapshotRefused(bad)
    return attempt


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a file that must not exist yet; ``False`` if it does."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        out = files.create(target, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def commit_snapshot(spark: SparkSession, attempt: Attempt) -> list:
    """Make a prepared snapshot the current one, if no other came in between.

    The next number's file is created only if it is absent, so of two writers
    that compared with the same version the second is refused. Readers follow
    the commits: they see the old tables or all new ones, and tables that a
    reader has open are never written again.
    """
    number = attempt.base + 1
    entry = {"number": number, "version": attempt.version, "path": attempt.path, "source": attempt.source, "rows": attempt.rows}
    if not _create(spark, f"{attempt.store}/commits/{number:08d}.json", json.dumps(entry) + "\n"):
        raise SnapshotConflict(f"version {attempt.version}: another snapshot was admitted first")
    write_refresh_log(spark, f"{attempt.store}/log", attempt.source, attempt.version)
    return attempt.verdicts


def admit_snapshot(spark: SparkSession, new: Mapping[str, DataFrame], store: str, version: str, source: str = "") -> list:
    """Check all tables while they are written, then admit them; verdict rows per table.

    A job that dies half-way leaves the current version untouched.
    """
    return commit_snapshot(spark, prepare_snapshot(spark, new, store, version, source))
