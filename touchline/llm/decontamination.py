"""Benchmark decontamination: an FM-index for each shard of the corpus, searched for all phrases of the benchmark."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.fmindex import FMIndex
from touchline.llm.memory import lean
from touchline.llm.words import ALNUM, Words, cut_words, find_words, flagged_spans, run_hashes, slices, span_column, word_hashes

# Text of benchmark items that is broadcast at once; a larger benchmark is searched block after block.
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 8 << 20
# Symbols of the index: the end, a break between runs, then the benchmark's words.
END, BREAK, FIRST_WORD = 0, 1, 2


@dataclass
class Phrases:
    """Distinct phrases of a block of items: symbols ``sequence[first:first + length]``, and the items that have each."""

    vocabulary: np.ndarray  # ascending word hashes; the symbol of a word is its place plus FIRST_WORD
    sequence: np.ndarray
    first: np.ndarray
    length: np.ndarray
    item_cuts: np.ndarray
    items: np.ndarray
    names: list[str]


def phrases_of(names: list[str], texts: list[str | None], n: int) -> Phrases:
    """Windows of ``n`` words of each item, or all its words if it has fewer."""
    w = find_words(pa.array(texts, pa.string()), ALNUM, lower=True)
    h = word_hashes(w)
    vocabulary, symbol = np.unique(h, return_inverse=True)
    count = np.diff(w.first)
    runs = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    item = np.repeat(np.arange(len(count)), runs)
    first = w.first[item] + np.arange(len(item)) - np.repeat(np.cumsum(runs) - runs, runs)
    length = np.minimum(count[item], n)
    key = np.zeros(len(first), np.uint64)
    for size in np.unique(length):
        some = length == size
        key[some] = run_hashes(h, int(size))[first[some]] + np.uint64(size)
    _, one, phrase = np.unique(key, return_index=True, return_inverse=True)
    ids = np.unique(np.array(names, object).astype(str)) if names else np.zeros(0, str)
    own = np.searchsorted(ids, np.array(names, object).astype(str)) if names else np.zeros(0, np.int64)
    pairs = np.unique(phrase * max(1, len(ids)) + own[item]) if len(item) else np.zeros(0, np.int64)
    cuts = np.searchsorted(pairs // max(1, len(ids)), np.arange(len(one) + 1))
    return Phrases(vocabulary, symbol.astype(np.int64) + FIRST_WORD, first[one], length[one], cuts, pairs % max(1, len(ids)), list(ids))


def _shard_sequence(w: Words, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Symbols to index, and the word each stands for.

    The alphabet is that of the benchmark: a word no phrase has can only end an
    occurrence. So each run of benchmark words in one text is kept with a break
    after it, unless it is shorter than every phrase.
    """
    h = word_hashes(w)
    vocabulary = phrases.vocabulary
    flag = np.zeros(1 << 16, bool)
    flag[vocabulary & np.uint64(0xFFFF)] = True
    maybe = np.flatnonzero(flag[h & np.uint64(0xFFFF)])
    place = np.minimum(np.searchsorted(vocabulary, h[maybe]), len(vocabulary) - 1)
    known = vocabulary[place] == h[maybe]
    at, symbol = maybe[known], place[known] + FIRST_WORD
    if not len(at):
        return np.array([END]), np.array([-1])
    new = np.append(True, (at[1:] != at[:-1] + 1) | (w.row[at[1:]] != w.row[at[:-1]]))
    run = np.cumsum(new) - 1
    long = (np.bincount(run) >= phrases.length.min())[run]
    at, symbol, new = at[long], symbol[long], new[long]
    breaks = np.flatnonzero(new)
    sequence = np.append(np.insert(symbol, breaks, BREAK), END)
    return sequence, np.append(np.insert(at, breaks, -1), -1)


def _find(w: Words, phrases: Phrases) -> tuple[np.ndarray, list[set]]:
    """A flag for each word inside an occurrence, and the items found in each text."""
    hit = np.zeros(len(w.start) + 1, np.int64)
    found: list[set] = [set() for _ in range(len(w.first) - 1)]
    if len(phrases.first) and len(w.start):
        sequence, word = _shard_sequence(w, phrases)
        if len(sequence) > 1:
            index = FMIndex(sequence, len(phrases.vocabulary) + FIRST_WORD)
            lo, hi = index.search(phrases.sequence, phrases.first, phrases.length)
            n = np.maximum(hi - lo, 0)
            phrase = np.repeat(np.arange(len(n)), n)
            places = np.repeat(lo, n) + np.arange(len(phrase)) - np.repeat(np.cumsum(n) - n, n)
            start = word[index.locate(places)]
            np.add.at(hit, start, 1)
            np.add.at(hit, start + phrases.length[phrase], -1)
            pairs = np.unique(w.row[start] * len(n) + phrase)  # each phrase once for each text
            for text, p in zip((pairs // len(n)).tolist(), (pairs % len(n)).tolist()):
                found[text].update(phrases.items[phrases.item_cuts[p]:phrases.item_cuts[p + 1]].tolist())
    return np.cumsum(hit)[:-1] > 0, found


SPANS = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("stop", T.LongType())]))
ADDED = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("hits", SPANS), T.StructField("items", T.ArrayType(T.StringType()))])


def find_contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, text: str = "text", cut: bool = False,
                       item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` (stretches of word positions) and ``items`` (ids, sorted as strings).

    Words are runs of digits, letters and non-ASCII characters in lower case. A
    phrase is ``n`` consecutive words of an item, or all of a shorter item. Hits
    are the merged occurrences of all phrases; ``items`` those with one at least.
    With ``cut`` the hit words are removed from ``text``, with what follows them
    up to the next kept word.

    Every task splits its documents into shards, builds an FM-index of each,
    searches all phrases backwards at once, locates the occurrences from sampled
    suffix positions and maps them to words. Nothing is shuffled. Items are read
    in blocks of ``BLOCK_BYTES`` of text, so the broadcast stays small whatever
    the size of the benchmark; with several blocks the documents pass through
    one search after the other within the same tasks, all on the input text.
    Words are told apart by 64-bit hashes.

    Null and empty texts have no words, null and empty items no phrases; items
    without phrases are never found. Rows of one item id count as one item, null
    ids as the empty string. Without a benchmark nothing is hit; an empty table
    gives an empty one. Columns named like the added ones are replaced.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in ADDED.names]
    docs, at = docs.select(*kept), kept.index(text)
    schema = T.StructType([*docs.schema.fields, *ADDED.fields])
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("name"), F.col(item_text).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // BLOCK_BYTES))
    out = docs.withColumns({"n_words": F.lit(0).cast("bigint"), "hits": F.array().cast(SPANS), "items": F.array().cast("array<string>")})
    for block in range(n_blocks):
        rows = items.filter(F.pmod(F.xxhash64("name", "text"), F.lit(n_blocks)) == block).collect()  # BLOCK_BYTES on average
        shared = spark.sparkContext.broadcast(phrases_of([r["name"] for r in rows], [r["text"] for r in rows], n))
        out = out.mapInArrow(_search(shared, at, len(kept), cut and block == n_blocks - 1), schema)
    return out


def _search(shared, at: int, width: int, cut: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases: Phrases = shared.value
        for batch in batches:
            for piece in slices(batch, at, SHARD_BYTES):
                w = find_words(piece.column(at), ALNUM, lower=True)
                hit, found = _find(w, phrases)
                for r, spans in enumerate(piece.column(width + 1).to_pylist()):  # of earlier blocks
                    for s in spans:
                        hit[w.first[r] + s["first"]:w.first[r] + s["stop"]] = True
                spans = flagged_spans(w, hit)
                names = [sorted(set(old).union(phrases.names[i] for i in new)) for old, new in zip(piece.column(width + 2).to_pylist(), found)]
                columns = [piece.column(k) for k in range(width)]
                if cut:
                    columns[at] = pa.array(cut_words(w, spans, piece.column(at)), piece.column(at).type)
                columns += [pa.array(np.diff(w.first), pa.int64()), span_column(spans), pa.array(names, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, names=piece.schema.names)
    return lean(run)
