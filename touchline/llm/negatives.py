"""Hard-negative mining: exact integer scores by Strassen's multiplication on tiles, best rows in mergeable heaps."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.common import discard, stored
from touchline.session import ensure_checkpoint_dir

SCALE = 256
# Rows of a tile, sides below which tiles are multiplied directly, and numbers of all anchors a task holds (16 MB).
TILE = 512
LEAF = 32
ANCHOR_NUMBERS = 1 << 21
# No score may leave the numbers that stay exact when multiplied by 100.
_LARGEST = 2 ** 63 // 100
_NONE = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of int64 matrices with seven half-size products for each level, odd sides padded by zeros.

    Only sums, differences and products of int64 occur, a ring modulo 2**64:
    the result is exact where it fits, whatever happens in between.
    """
    n, k, m = a.shape[0], a.shape[1], b.shape[1]
    if min(n, k, m) <= leaf:
        return a @ b
    if n % 2 or k % 2 or m % 2:
        a = np.pad(a, ((0, n % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, m % 2)))
    h, i, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:h, :i], a[:h, i:], a[h:, :i], a[h:, i:]
    b11, b12, b21, b22 = b[:i, :j], b[:i, j:], b[i:, :j], b[i:, j:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * h, 2 * j), np.int64)
    out[:h, :j] = p1 + p4 - p5 + p7
    out[:h, j:] = p3 + p5
    out[h:, :j] = p2 + p4
    out[h:, j:] = p1 - p2 + p3 + p6
    return out[:n, :m]


@dataclass
class Heaps:
    """The ``size`` best (score, id) of each of many slots: highest score first, then smallest id; equal entries count once.

    Heaps of one slot may be merged in any order and grouping: what a slot
    keeps depends on the entries alone.
    """

    slots: int
    size: int

    def __post_init__(self):
        self.score = np.full((self.slots, self.size), _NONE)
        self.id = np.full((self.slots, self.size), np.iinfo(np.int64).max)

    def entry(self) -> np.ndarray:
        """The score from which on an entry may still come in, for each slot."""
        return self.score[:, -1]

    def push(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        touched = np.unique(slot)
        held = self.score[touched] != _NONE
        slot = np.concatenate([slot, np.repeat(touched, held.sum(axis=1))])
        score = np.concatenate([score, self.score[touched][held]])
        ids = np.concatenate([ids, self.id[touched][held]])
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        new = np.ones(len(slot), bool)
        new[1:] = (slot[1:] != slot[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])
        slot, score, ids = slot[new], score[new], ids[new]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot, "left")
        fits = place < self.size
        self.score[slot[fits], place[fits]] = score[fits]
        self.id[slot[fits], place[fits]] = ids[fits]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slot, place = np.nonzero(self.score != _NONE)
        return slot, self.score[slot, place], self.id[slot, place]


def _numbers(vectors: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose vector has neither null nor non-finite components, and floor(SCALE * x) of these, padded by zeros."""
    valid = np.array(vectors.is_valid())
    flat = vectors.flatten()  # of the valid ones
    size = pc.list_value_length(vectors).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    x = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null: not a number
    row = np.repeat(np.arange(len(vectors)), size)
    bad = np.zeros(len(vectors), bool)
    bad[row[~np.isfinite(x)]] = True
    keep = np.flatnonzero(valid & ~bad)
    out = np.zeros((len(vectors), width), np.int64)
    good = ~bad[row]
    nth = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    whole = np.floor(SCALE * x[good])
    if len(whole) and np.abs(whole).max() >= np.sqrt(_LARGEST / width):
        raise ArithmeticError("components too large for exact 64-bit scores")
    out[row[good], nth[good]] = whole.astype(np.int64)
    return keep, out[keep]


def _tiles(batches: Iterator[pa.RecordBatch], width: int, labels: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Columns id, label, vector as tiles: ids, places of the labels among ``labels`` (-1: none), numbers."""
    for batch in batches:
        for at in range(0, batch.num_rows, TILE):
            part = batch.slice(at, TILE)
            keep, x = _numbers(part.column(2), width)
            code = pc.index_in(part.column(1), value_set=labels).fill_null(-1).to_numpy(zero_copy_only=False)
            yield part.column(0).to_numpy(zero_copy_only=False)[keep].astype(np.int64), code[keep], x


def _blocks(rows: DataFrame, n_blocks: int, width: int):
    """Anchors block by block: ids, labels, numbers; a block holds ``ANCHOR_NUMBERS`` numbers on average."""
    for block in range(n_blocks):
        t = rows.filter(F.col("block") == block).select("id", "label", "v").toArrow().combine_chunks()
        if t.num_rows:
            keep, x = _numbers(t.column("v").combine_chunks(), width)
            yield t.column("id").to_numpy()[keep], t.column("label").combine_chunks().take(pa.array(keep)), x


POSITIVES = "anchor bigint, score bigint, id bigint"
NEGATIVES = "anchor bigint, positive bigint, positive_score bigint, score bigint, id bigint"


def _best_positives(ids, labels, x, n: int):
    """A task's best rows of the anchor's label, for every anchor of a block."""
    known = pc.unique(labels)
    mine = pc.index_in(labels, value_set=known).to_numpy(zero_copy_only=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(len(ids), n)
        for other, code, y in _tiles(batches, x.shape[1], known):
            for at in range(0, len(ids), TILE):
                part = slice(at, at + TILE)
                score = strassen(x[part], y.T)
                ok = (mine[part, None] == code) & (ids[part, None] != other) & (score >= heaps.entry()[part, None])
                a, c = np.nonzero(ok)
                heaps.push(a + at, score[a, c], other[c])
        slot, score, found = heaps.rows()
        yield pa.RecordBatch.from_pydict({"anchor": pa.array(ids[slot]), "score": pa.array(score), "id": pa.array(found)})
    return run


def _best_negatives(ids, labels, x, positives: tuple[np.ndarray, np.ndarray, np.ndarray], window: tuple[int, int], n: int):
    """A task's best rows of other labels inside the window of every positive of a block.

    ``positives`` are the place of the anchor, the id and the score of each.
    """
    known = pc.unique(labels)
    mine = pc.index_in(labels, value_set=known).to_numpy(zero_copy_only=False)
    anchor, positive, reached = positives
    low, high = (w * reached for w in window)
    # positives by anchor: the k-th positive of the anchors that have as many
    order = np.argsort(anchor, kind="stable")
    nth = np.arange(len(order)) - np.searchsorted(anchor[order], anchor[order], "left")
    layers = [order[nth == k] for k in range(int(nth.max(initial=-1)) + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(len(anchor), n)
        for other, code, y in _tiles(batches, x.shape[1], known):
            for at in range(0, len(ids), TILE):
                score = strassen(x[at:at + TILE], y.T)
                for layer in layers:  # ascending by anchor
                    of = layer[np.searchsorted(anchor[layer], at):np.searchsorted(anchor[layer], at + TILE)]
                    s = score[anchor[of] - at]
                    ok = (100 * s >= low[of, None]) & (100 * s <= high[of, None]) & (s >= heaps.entry()[of, None])
                    ok &= mine[anchor[of], None] != code
                    a, c = np.nonzero(ok)
                    heaps.push(of[a], s[a, c], other[c])
        slot, score, found = heaps.rows()
        yield pa.RecordBatch.from_pydict({
            "anchor": pa.array(ids[anchor[slot]]), "positive": pa.array(positive[slot]), "positive_score": pa.array(reached[slot]),
            "score": pa.array(score), "id": pa.array(found)})
    return run


def _merged(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The heaps of all tasks, merged: the best ``n`` of each key with their ``rank``."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return rows.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def hard_negatives(rows: DataFrame, is_anchor, n_positives: int = 5, n_negatives: int = 10, window: tuple[int, int] = (30, 90),
                   vec_id: str = "vec_id", label: str = "label", vector: str = "embedding", anchor_numbers: int = ANCHOR_NUMBERS) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Components become floor(256 * x); a score is the integer inner product with
    the anchor, higher first, ties by smaller id. The anchors are the rows for
    which the column ``is_anchor`` holds, their positives the best
    ``n_positives`` other rows of the same label. For each positive the best
    ``n_negatives`` rows of other labels whose score lies between ``window[0]``
    and ``window[1]`` hundredths of the positive's are returned, ``rank`` from 1.

    Anchors are taken in blocks of about ``anchor_numbers`` components. For each
    block every task multiplies the block with its own rows, tile by tile, and
    sends one heap for each anchor; a second pass, when the positives are known,
    does the same with a heap for each positive. No vector is shuffled, and no
    task holds more than a block, its heaps and a tile. Each block's result is
    written to the shared folder.

    Rows without id or label, with a null vector, or with a null or non-finite
    component take no part. Shorter vectors count as followed by zeros. Equal
    rows count once; rows of one id with different vectors stand each for
    itself, as anchor only the smallest by label and vector. Components too
    large for exact 64-bit scores raise an ``ArithmeticError``. An empty table,
    or one without anchors, gives an empty one. Other columns are not read.
    """
    spark = rows.sparkSession
    part = rows.select(F.col(vec_id).cast("bigint").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("v"), is_anchor.alias("a"))
    part = part.filter("id is not null and label is not null and v is not null")
    everything = part.select("id", "label", "v")
    usable = ~F.exists("v", lambda x: x.isNull() | ~F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)) | F.isnan(x))
    anchors = part.filter(F.col("a") & usable).groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", "r.v")
    kept = stored(anchors, "anchors")
    count = kept.count()
    width = everything.agg(F.max(F.size("v"))).first()[0] or 0
    n_blocks = max(1, -(-count * width // anchor_numbers))
    blocked = kept.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n_blocks)))
    schema = T.StructType([T.StructField(n, T.IntegerType() if n == "rank" else T.LongType()) for n in (
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")])
    base = f"{ensure_checkpoint_dir(spark)}/touchline/negatives-{uuid.uuid4().hex}"
    paths = []
    for ids, labels, x in _blocks(blocked, n_blocks, width):
        near = everything.mapInArrow(_best_positives(ids, labels, x, n_positives), POSITIVES)
        near = _merged(near, ["anchor"], n_positives).select("anchor", "id", "score").toArrow()  # of a block of anchors
        order = np.argsort(ids)
        place = order[np.searchsorted(ids, near.column("anchor").to_numpy(), sorter=order)]
        positives = place, near.column("id").to_numpy(), near.column("score").to_numpy()
        far = everything.mapInArrow(_best_negatives(ids, labels, x, positives, window, n_negatives), NEGATIVES)
        out = _merged(far, ["anchor", "positive", "positive_score"], n_negatives)
        out = out.select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
                         "positive_score", F.col("score").alias("negative_score"))
        paths.append(f"{base}/{len(paths)}")
        out.write.parquet(paths[-1])
    discard(kept)
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
