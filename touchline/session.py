"""Session settings the operators rely on, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings, safe to apply to a session somebody else created.
# No operator carries a broadcast hint on growing data: Spark's size threshold
# decides, from file statistics when planning and from real shuffle sizes under
# AQE. A hot key that ends up in a sort-merge join is split by the skew-join
# rule, also when the split costs the aggregate after it one more shuffle.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # The JVM never compiles a method above 8000 bytes of bytecode; a stage
    # that large runs faster without whole-stage code.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shuffle_partitions(shuffled_bytes: int, target_bytes: int = 200 * 1024 * 1024) -> int:
    """Initial partition count that keeps one shuffle partition near ``target_bytes``.

    AQE merges partitions that turn out small, so err on the high side: a
    100 TB shuffle asks for about 500 000 partitions of 200 MB.
    """
    return max(1, -(-shuffled_bytes // target_bytes))


def local_session(app: str = "touchline", cpus: int | str = "*", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    return configure(builder.getOrCreate())


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, taking the one the cluster names.

    Only a local master may fall back to a temporary folder: elsewhere a
    machine-local folder would vanish with its executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        named = tempfile.mkdtemp(prefix="touchline-checkpoint-")
    sc.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def kept_in_files(df: DataFrame) -> DataFrame:
    """Write rows below the shared checkpoint folder and read them from there.

    Unlike after :func:`cut_lineage` the planner knows their true size, so it
    broadcasts a few rows drawn from many by itself.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/touchline/kept-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)
