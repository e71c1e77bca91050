"""What the operators share: tables kept in the shared folder, word patterns, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.memory import lean
from touchline.session import ensure_checkpoint_dir

# Words of all text operators: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written once to the folder all executors share and read back.

    Cuts the lineage: a lost executor costs a reread, not a recomputation.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/touchline/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes a stored table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case, every other character unchanged."""
    return F.translate(c, UPPER, LOWER)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected edge list: ``node``, ``component`` (its smallest node).

    Alternates the two star steps of Kiveris et al. 2014 until no edge changes:
    every node is linked to the smallest node it knows, first its larger, then
    its smaller neighbours. Each step is a group-by with map-side minimum and an
    equi-join that Spark may split by skew, so a star of any size is spread over
    tasks. Edges are written to the shared folder between rounds. Nodes without
    an edge are not returned. Null ends are ignored.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    pairs = stored(_forest(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))), "edges")
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
        )).alias("e")).select("e.*").filter("u <> v").distinct()
        old, pairs = pairs, stored(small, "edges")
        discard(old)
        now = pairs.agg(F.count("u"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before or now[0] == 0:
            break
        before = now
    return (pairs.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
            .unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))


def _forest(pairs: DataFrame) -> DataFrame:
    """Spanning stars of the edges of each task: the same components, at most one edge for each node and task."""
    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (p := parent.setdefault(x, x)) != x:
                parent[x] = parent[p]
                x = p
            return x

        def out() -> pa.RecordBatch:
            links = [(x, root(x)) for x in list(parent)]
            links = [e for e in links if e[0] != e[1]]
            return pa.RecordBatch.from_pydict({"u": pa.array([e[0] for e in links], pa.int64()), "v": pa.array([e[1] for e in links], pa.int64())})

        for batch in batches:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                u, v = root(u), root(v)
                parent[max(u, v)] = min(u, v)
            if len(parent) > 2_000_000:  # bounded memory: what is known so far goes out
                yield out()
                parent.clear()
        yield out()

    return pairs.select(F.col("u").cast("bigint"), F.col("v").cast("bigint")).mapInArrow(lean(stars), "u bigint, v bigint")

