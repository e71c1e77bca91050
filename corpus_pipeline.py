"""From raw documents to a training mix: five stages, each a whole pass over what the one before kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import decontamination, quality, sampling, simhash, substrings
from touchline.llm.common import table
from touchline.session import ensure_checkpoint_dir

# Documents below this quality are rejected.
GOOD = 0.3
SOURCE_WEIGHTS = (5.0, 2.0, 1.0)
# A source gives at most each of its documents twice.
SHARE, MOST = 1.5, 2.0
# Near copies: fingerprints of runs of four words that differ in four bits or fewer.
SHINGLE, RADIUS = 4, 4


def _packed(docs: DataFrame, *used: str) -> DataFrame:
    """The columns an operator uses, and all but the text once more in one column, so that no name of it clashes with theirs."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    return docs.select(*used, rest.alias("packed_row"))


def _unpacked(columns: list[str]) -> list:
    return [F.col("text") if c == "text" else F.col("packed_row").getField(c).alias(c) for c in columns]


def _with_text(docs: DataFrame, out: DataFrame, removed: str) -> DataFrame:
    """Rows of ``docs`` with the text of ``out``: lengths anew, documents left without a word gone."""
    changed = F.size(removed) > 0
    out = out.filter(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    columns = dict(zip(docs.columns, _unpacked(docs.columns)))
    if "n_chars" in columns:
        n = F.length("text").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(changed, n).otherwise(F.col("packed_row").getField("n_chars")).alias("n_chars")
    return out.select(*columns.values())


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality is not below ``GOOD``; the classifier learns from the labelled ones among them."""
    field = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(_packed(docs, "text"), field).filter(F.col("score") >= GOOD).select(*_unpacked(docs.columns))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id; documents without an id stay, rows of one id share their fate."""
    groups = simhash.near_duplicates(docs, radius=RADIUS, n=SHINGLE)
    copies = groups.filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the word windows that also start earlier in the corpus."""
    return _with_text(docs, substrings.remove_repeats(_packed(docs, "doc_id", "text")), "removed")


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that a benchmark phrase covers."""
    out = decontamination.find_contamination(_packed(docs, "text"), table(spark, sf_dir, "benchmark"), cut=True)
    return _with_text(docs, out, "hits")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (``copy`` counts), with their source's size and target in words.

    Columns of the documents with these names are replaced.
    """
    mix = sampling.pareto_mix(_packed(docs, "doc_id", "source", "text"), sampling.cycled_weights(docs, SOURCE_WEIGHTS), SHARE, MOST)
    mix = mix.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    added = ["copy", "size", "source_size", "target"]
    return mix.select(*_unpacked([c for c in docs.columns if c not in added]), *added)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_good),
    ("simhash near-dedup", keep_one_of_each),
    ("substring dedup", remove_repeats),
    ("benchmark decontamination", remove_benchmark),
    ("source mix", mix_sources),
]

# Fitted weights, fingerprints and random order are beyond SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    base = f"{ensure_checkpoint_dir(spark)}/touchline/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{base}/{k}")
        docs = spark.read.schema(out.schema).parquet(f"{base}/{k}")
    return docs
