"""Language identification: known words first, then ever shorter character n-grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from touchline.llm.common import stored

# A word is a run of letters (with their combining marks), in lower case.
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_ASCII = re.compile(r"[a-z]+")

LONGEST = 5
# A gram stands for less evidence than a known word.
BACKOFF = 0.4
# Scores are whole numbers of this fraction of a unit, so that sums do not depend on their order.
UNIT = 1 << 20
# Words whose scores travel with the tasks instead of being joined. It changes the speed and no result.
HEAD = 100_000
# Counts that a task gathers before it hands them on.
HELD = 500_000


def words_of(text: str) -> list[str]:
    text = text.lower()
    return (_ASCII if text.isascii() else LETTERS).findall(text)


def grams_of(word: str, n: int) -> list[str]:
    marked = f"^{word}$"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


def _grams(word: Column, n: int) -> Column:
    """:func:`grams_of` as a column."""
    marked = F.concat(F.lit("^"), word, F.lit("$"))
    places = F.sequence(F.lit(1), F.length(marked) - n + 1)
    return F.when(F.length(marked) >= n, F.transform(places, lambda i: F.substring(marked, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def _counted(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """``lang``, ``word``, ``n`` over whole texts: counted in the tasks, then added up."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def out(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for name, c in counts.items():
            words, n = list(c), list(c.values())
            for i in range(0, len(words), 50_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(words[i:i + 50_000]), pa.string()), pa.array(words[i:i + 50_000], pa.string()),
                     pa.array(n[i:i + 50_000], pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                counts.setdefault(batch.column(0)[i].as_py(), Counter()).update(words_of(batch.column(1)[i].as_py()))
                if sum(map(len, counts.values())) > HELD:
                    yield from out(counts)
                    counts = {}
        yield from out(counts)

    known = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter("lang is not null and text is not null")
    return known.mapInArrow(run, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Word counts of each language as a table, and what is derived from them.

    ``words`` has every word of the training text with its score in each
    language; ``grams(n)`` the same for every n-gram, made when first needed.
    """

    langs: list[str]
    counts: DataFrame  # lang, word, n
    words: DataFrame  # word, total, score
    _grams: dict[int, DataFrame] = field(default_factory=dict)

    def grams(self, n: int) -> DataFrame:
        if n not in self._grams:
            cut = self.counts.select("lang", F.explode(_grams(F.col("word"), n)).alias("gram"), "n")
            self._grams[n] = _scores(cut, "gram", self.langs, f"grams_{n}")
        return self._grams[n]

    def head(self, most: int) -> tuple[dict[str, int], np.ndarray]:
        """The ``most`` most frequent words and their scores."""
        top = self.words.orderBy(F.desc("total"), "word").limit(most).select("word", "score").toArrow()
        scores = top.column("score").combine_chunks()
        flat = scores.flatten().to_numpy() if len(scores) else np.zeros(0, np.int64)
        return {w: k for k, w in enumerate(top.column("word").to_pylist())}, flat.reshape(len(scores), len(self.langs))

    def of_unseen(self, words: DataFrame) -> DataFrame:
        """``word``, ``score`` of unknown words: the mean of their longest n-grams that are known, weighed down.

        Words without a known n-gram of any length have no row.
        """
        left, parts = stored(words, "unseen"), []
        for n in range(LONGEST, 0, -1):
            if left.isEmpty():
                break
            cut = left.select("word", F.explode(_grams(F.col("word"), n)).alias("gram"))
            met = cut.join(self.grams(n), "gram").groupBy("word").agg(F.count(F.lit(1)).alias("m"), *[
                F.sum(F.col("score")[k]).alias(f"s{k}") for k in range(len(self.langs))])
            mean = F.array(*[F.round(F.col(f"s{k}") * F.lit(BACKOFF) / F.col("m")).cast("bigint") for k in range(len(self.langs))])
            parts.append(stored(met.select("word", mean.alias("score")), "unseen_scores"))
            left = stored(left.join(parts[-1].select("word"), "word", "left_anti"), "unseen")
        out = words.sparkSession.createDataFrame([], "word string, score array<bigint>")
        for part in parts:
            out = out.unionByName(part)
        return out


def _scores(counts: DataFrame, item: str, langs: list[str], name: str) -> DataFrame:
    """``item``, ``total``, ``score``: the log frequency of each item in each language, out of ``lang``, ``item``, ``n``."""
    by_lang = [F.sum(F.when(F.col("lang") == name, F.col("n")).otherwise(F.lit(0))).alias(f"n{k}") for k, name in enumerate(langs)]
    items = stored(counts.groupBy(item).agg(F.sum("n").alias("total"), *by_lang), f"{name}_counts")
    sums = items.agg(F.count(F.lit(1)), *[F.sum(f"n{k}") for k in range(len(langs))]).first()  # a number for each language
    size = [(t or 0) + 0.5 * max(1, sums[0]) for t in sums[1:]]
    score = F.array(*[F.round(F.log((F.col(f"n{k}") + 0.5) / F.lit(size[k])) * UNIT).cast("bigint") for k in range(len(langs))])
    return items.select(item, "total", score.cast("array<bigint>").alias("score"))


def train(docs: DataFrame, lang: str = "lang", text: str = "text") -> Model:
    """Log frequencies by language of words and of their character n-grams, from every row of ``docs``.

    Rows without text or language teach nothing. Counts are gathered by the
    tasks, added up in a shuffle and kept as tables, whatever their number; only
    the languages, and sums over each, reach the driver.
    """
    counts = stored(_counted(docs, lang, text), "word_counts")
    langs = sorted(r[0] for r in counts.select("lang").distinct().collect())  # the labels
    return Model(langs, counts, _scores(counts, "word", langs, "words"))


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, head: int = HEAD) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1: its share among the languages).

    Each whole text is scored by its words: a word of the training text by its
    log frequency in each language, any other by its longest known character
    n-grams. A task adds up the words of a text that are among the ``head`` most
    frequent ones; the others leave it as counts, are joined to the tables once
    for each distinct word, and their sums return to the texts. ``keep`` names
    the columns of the result; without the text, no text is written or moved.

    Null texts, texts without a letter and every text of an untrained model are
    ``und`` with score 0. Ties go to the first language by name. Repeated rows
    stay, an empty table gives an empty one. Columns named like the new ones are
    replaced.
    """
    kept = [c for c in (keep or docs.columns) if c not in ("lang_pred", "score")]
    if not model.langs:
        return docs.select(*[F.col(f"`{c}`") for c in kept], F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(text).alias("text"),
                       F.monotonically_increasing_id().alias("place"))
    langs = model.langs
    words, scores = model.head(max(1, min(head, 40 * HEAD // max(1, len(langs)))))
    rest_type = ArrayType(StructType([StructField("word", StringType()), StructField("n", LongType())]))
    schema = StructType([rows.schema["row"], StructField("place", LongType()), StructField("n_words", LongType()),
                         StructField("sums", ArrayType(LongType())), StructField("rest", rest_type)])
    pairs = pa.struct([("word", pa.string()), ("n", pa.int64())])
    shared = docs.sparkSession.sparkContext.broadcast((words, scores))  # bounded by HEAD words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, value = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                piece = batch.slice(start, 512)
                n_words, sums, rest = [], np.zeros((piece.num_rows, len(langs)), np.int64), []
                for i in range(piece.num_rows):
                    counts = Counter(words_of(piece.column(1)[i].as_py() or ""))
                    n_words.append(sum(counts.values()))
                    places = [known.get(w) for w in counts]
                    have = [k for k in places if k is not None]
                    if have:
                        times = np.fromiter((n for n, k in zip(counts.values(), places) if k is not None), np.int64, len(have))
                        sums[i] = times @ value[have]
                    rest.append([(w, n) for (w, n), k in zip(counts.items(), places) if k is None])
                cuts = np.arange(piece.num_rows + 1, dtype=np.int32) * len(langs)
                ends = np.concatenate([[0], np.cumsum([len(r) for r in rest])]).astype(np.int32)
                flat = pa.StructArray.from_arrays([pa.array([w for r in rest for w, _ in r], pa.string()), pa.array([n for r in rest for _, n in r], pa.int64())],
                                                  fields=list(pairs))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(2), pa.array(n_words, pa.int64()), pa.ListArray.from_arrays(cuts, pa.array(sums.ravel())),
                     pa.ListArray.from_arrays(ends, flat)], names=schema.names)

    read = stored(rows.mapInArrow(run, schema), "languages")
    rare = read.select("place", F.explode("rest").alias("w")).select("place", "w.word", "w.n")
    looked = stored(rare.select("word").distinct().join(model.words.select("word", "score"), "word", "left"), "rare_words")
    unseen = model.of_unseen(looked.filter("score is null").select("word"))
    found = looked.filter("score is not null").unionByName(unseen)
    added = rare.join(found, "word").groupBy("place").agg(*[F.sum(F.col("n") * F.col("score")[k]).alias(f"a{k}") for k in range(len(langs))])
    out = read.select("row", "place", "n_words", "sums").join(added, "place", "left")
    mean = F.array(*[(F.col("sums")[k] + F.coalesce(f"a{k}", F.lit(0))) / F.col("n_words") / F.lit(float(UNIT)) for k in range(len(langs))]).cast("array<double>")
    out = out.withColumn("mean", F.when(F.col("n_words") > 0, mean))
    best = F.array_max("mean")
    name = F.get(F.array(*map(F.lit, langs)).cast("array<string>"), F.array_position("mean", best).cast("int") - 1)
    share = F.lit(1.0) / F.aggregate("mean", F.lit(0.0), lambda t, e: t + F.exp(e - best))
    out = out.select("row", F.coalesce(name, F.lit("und")).alias("lang_pred"), F.coalesce(share, F.lit(0.0)).alias("score"))
    return out.select(*[F.col("row").getField(c).alias(c) for c in kept], "lang_pred", "score")


def fold(doc_id: Column, folds: int) -> Column:
    """Part of a row among ``folds``: checksum of its id as text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))
