"""URL filter: a blocked Bloom filter of listed URLs in front of an exact join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import ascii_lower

# Rules that the filter can hold at its target rate; beyond, it passes more and the exact join does the rest.
BLOOM_BLOCKS = 1 << 16
BITS_PER_KEY = 6


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without one."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host, up to ``?``, ``#`` or the end; empty without a ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _suffixes(host: Column) -> Column:
    """The host and every parent domain of it."""
    labels = F.split(host, r"\.", -1)
    n = F.size(labels)
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), ".")))


def _hash_parts(key: Column, blocks: int) -> tuple[Column, Column]:
    """Block of a key, and its bits inside the 64-bit block."""
    h = F.xxhash64(key)
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
            for i in range(BITS_PER_KEY)]
    block = F.pmod(F.xxhash64(key, F.lit(1)), F.lit(blocks)).cast("int")
    return block, reduce(lambda a, b: a.bitwiseOR(b), bits)


def bloom_filter(rules: DataFrame, blocks: int = BLOOM_BLOCKS) -> DataFrame:
    """One row, one array: the 64-bit blocks of a blocked Bloom filter over ``key``.

    Keys set their bits by a bitwise-or aggregate, merged map-side, so at most
    ``blocks`` rows (8 bytes each) reach the last step whatever the rule count.
    """
    block, mask = _hash_parts(F.col("key"), blocks)
    parts = rules.select(block.alias("block"), mask.alias("mask")).groupBy("block").agg(F.bit_or("mask").alias("mask"))
    every = rules.sparkSession.range(blocks).select(F.col("id").cast("int").alias("block")).join(parts, "block", "left")
    every = every.agg(F.array_sort(F.collect_list(F.struct("block", F.coalesce("mask", F.lit(0).cast("bigint")).alias("mask")))).alias("set"))
    return every.select(F.col("set.mask").alias("bloom"))


def match_rules(pages: DataFrame, rules: DataFrame, url: str = "url", blocks: int = BLOOM_BLOCKS) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has ``host``, ``path``, ``verdict``: a rule fits its host and all
    subdomains if the path starts with the rule's. The longest rule (host plus
    path) wins, then the one with the longer host; of equal rules the smaller
    verdict. ``rule`` is host plus path of the winner, else null. The verdict of
    a URL no rule fits is the filter's own: not listed, hence ``allow``.

    Each distinct URL offers its host's suffixes with the path cut at the
    lengths that rules have. The blocked Bloom filter drops what is surely not
    listed before any row is made of it; an equi-join on host and path then
    removes its false positives. A URL shared by many rows is judged once.
    Rules' hosts are compared in lower case. Null URLs and URLs without ``://``
    have an empty host and path and fit nothing; columns of ``pages`` with the
    names of the new ones are replaced.
    """
    listed = rules.select(ascii_lower(F.col("host")).alias("r_host"), F.col("path").alias("r_path"), F.lower("verdict").alias("r_verdict"))
    listed = listed.filter("r_host is not null and r_path is not null").groupBy("r_host", "r_path").agg(F.min("r_verdict").alias("r_verdict"))
    listed = listed.withColumn("key", F.concat("r_host", F.lit(" "), "r_path"))
    # path lengths in use: no more than the longest path has characters
    lengths = listed.agg(F.array_sort(F.collect_set(F.length("r_path"))).alias("lengths")).scalar()
    bloom = bloom_filter(listed, blocks).scalar()

    urls = pages.select(F.col(url).alias("j_url")).filter("j_url is not null").distinct()
    urls = urls.select("j_url", host_of(F.col("j_url")).alias("h"), path_of(F.col("j_url")).alias("p"))
    urls = urls.withColumn("lengths", F.coalesce(lengths, F.array().cast("array<int>"))).withColumn("bloom", bloom)
    fitting = F.filter("lengths", lambda n: n <= F.length("p"))
    offers = F.flatten(F.transform(_suffixes(F.col("h")), lambda s: F.transform(
        fitting, lambda n: F.struct(s.alias("r_host"), F.substring(F.col("p"), 1, n).alias("r_path")))))

    def possible(offer: Column) -> Column:
        block, mask = _hash_parts(F.concat(offer["r_host"], F.lit(" "), offer["r_path"]), blocks)
        return F.element_at(F.col("bloom"), block + 1).bitwiseAND(mask) == mask

    hits = urls.select("j_url", F.explode(F.filter(offers, possible)).alias("o")).select("j_url", "o.*")
    found = hits.join(listed.drop("key"), ["r_host", "r_path"])
    best = found.groupBy("j_url").agg(F.max_by(
        F.struct(F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict")),
        F.struct(F.length("r_host") + F.length("r_path"), F.length("r_host")),
    ).alias("best"))
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    rows = pages.select(F.struct(*kept).alias("row"), F.col(url).alias("url"))
    return rows.join(best, F.col("url") == F.col("j_url"), "left").select(
        "row.*", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit("allow")).alias("verdict"))
