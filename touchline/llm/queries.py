"""The registered queries over whole tables, with check SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import chat, decontamination, embeddings, langid, lempel, negatives, quality, runs, sampling, simhash, substrings, tokens, urls
from touchline.llm.common import WORD, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = run
        if sql:
            ORACLE_SQL[run.__name__] = sql
        return run
    return register


TRICKY = "\\### Assistant: </turn> ok"


def _sql_escape(c: str, role: bool = False) -> str:
    for raw, safe in chat.ESCAPES + ((chat.NEWLINE,) if role else ()):
        raw = "chr(10)" if raw == "\n" else f"'{raw}'"
        c = f"replace({c}, {raw}, '{safe}')"
    return c


@query(f"""
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{TRICKY}' UNION ALL SELECT -7, 1, 'assistant', '{TRICKY}'),
t AS (SELECT conv_id, turn, role AS sort_role, text AS sort_text, coalesce(role, '') AS role, coalesce(text, '') AS text FROM rows),
c AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, sort_role NULLS FIRST, sort_text NULLS FIRST) AS turns,
    string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, sort_role NULLS FIRST, sort_text NULLS FIRST) AS loss,
    CAST(sum({len(chat.OPEN) + len(chat.CLOSE) + 1} + length({_sql_escape('role', True)}) + length({_sql_escape('text')})) AS BIGINT) AS formatted_chars
  FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, formatted_chars FROM c
""")
def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRICKY).alias("text"))
    rows = rows.withColumn("turn", F.col("turn").cast("bigint")).unionByName(planted)
    out = chat.read_back(chat.format_chats(chat.message_events(rows)))
    plain = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(plain, 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))


@query("""
WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS (SELECT vec_id, v FROM e WHERE v IS NOT NULL AND list_dot_product(v, v) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a, u b WHERE a.vec_id <> b.vec_id
  AND list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.95),
r AS (SELECT vec_id AS node, vec_id AS reached FROM e UNION SELECT r.node, l.b FROM r JOIN l ON r.reached = l.a),
c AS (SELECT node, min(reached) AS component_id FROM r GROUP BY node),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, component_id, component_id = e.vec_id AS kept
FROM e JOIN c ON c.node = e.vec_id LEFT JOIN n ON n.a = e.vec_id
""")
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(f"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM benchmark),
l AS (SELECT item, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
s AS (SELECT item, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM l),
p AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS key FROM s),
d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents),
x AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM p) sizes WHERE len(w) >= n),
k AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS key FROM x),
h AS (SELECT doc_id, item, n, i FROM k JOIN p USING (n, key)),
c AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM h) words GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) pairs GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
""")
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontamination.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["first"])
    return out.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def joined_words(text: Column) -> Column:
    """Words of a text joined by one space."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))


@query(f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
s AS (SELECT doc_id, i, w[i] AS word, CASE WHEN i + 19 <= len(w) THEN array_to_string(w[i:i + 19], ' ') END AS key FROM p),
g AS (SELECT key, min(struct_pack(d := doc_id, i := i)) AS first FROM s WHERE key IS NOT NULL GROUP BY key),
f AS (SELECT s.doc_id, s.i, s.word, g.first IS NOT NULL AND g.first <> struct_pack(d := s.doc_id, i := s.i) AS again FROM s LEFT JOIN g USING (key)),
r AS (SELECT doc_id, i, word, max(CASE WHEN again THEN 1 ELSE 0 END) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM f),
a AS (SELECT doc_id, CAST(sum(gone) AS BIGINT) AS n_removed, string_agg(CASE WHEN gone = 0 THEN word END, ' ' ORDER BY i) AS kept FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN a USING (doc_id)
""")
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(joined_words(F.col("text")), 256).alias("kept_sha256"))


@query()
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.count_tokens(docs, vocabulary).select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query()
def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mix = sampling.pareto_mix(docs, sampling.cycled_weights(docs, corpus_pipeline.SOURCE_WEIGHTS))
    return mix.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source")


@query()
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", langid.fold(F.col("doc_id"), 5) == 0)
    field = quality.train(docs.filter(~F.col("held_out")), table(spark, sf_dir, "labels"))
    out = quality.score(docs, field)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= corpus_pipeline.GOOD).cast("int").alias("predicted"))


@query()
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.fold(F.col("doc_id"), 3) == 1)
    model = langid.train(docs.filter(~F.col("held_out")))
    return langid.predict(docs.select("doc_id", "held_out", "text"), model, keep=["doc_id", "held_out"])


@query()
def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


URL_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block"))
_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)


@query(f"""
WITH rules(r_host, r_path, r_verdict) AS (VALUES {_RULES}),
p AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, row_number() OVER () AS row_id, regexp_extract(rest, '^([^/?#]*)', 1) AS raw,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
l AS (SELECT page_id, row_id, path, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM h),
f AS (
  SELECT row_id, r_host || r_path AS rule, r_verdict, row_number() OVER (
    PARTITION BY row_id ORDER BY length(r_host) + length(r_path) DESC, length(r_host) DESC) AS place
  FROM l JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path))
SELECT page_id, host, path, rule, coalesce(r_verdict, 'allow') AS verdict
FROM l LEFT JOIN (SELECT * FROM f WHERE place = 1) best USING (row_id)
""")
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.match_rules(pages, rules).select("page_id", "host", "path", "rule", "verdict")


@query("""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT * FROM n WHERE rank <= 10
""")
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


@query()
def op12_lempel_ziv_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lempel.compare_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Every tenth document, by checksum of its id, made periodic from one of its words on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    docs = docs.withColumns({"words": words, "g": F.floor(h / 10)})
    n = F.size("words")
    docs = docs.withColumn("a", F.when(n > 0, F.col("g") % n))
    docs = docs.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    planted = F.transform("words", lambda w, i: F.when(
        i >= F.col("a"), F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))).otherwise(w))
    return docs.withColumn("text", F.when(F.col("a").isNotNull(), F.array_join(planted, " ")).otherwise(F.col("text"))).select("doc_id", "text")


@query()
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = runs.find_runs(with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    out = out.withColumn("best", best)
    length, period = F.col("best.l"), -F.col("best.p")
    return out.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("best.s")).alias("start"), length.alias("length"),
        period.alias("period"), F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query(corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
