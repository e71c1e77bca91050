"""Substring dedup: a count-min sketch in pages finds the windows worth grouping, an exact pass groups them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.common import stored
from touchline.llm.packing import one_batch, pack_planes, pack_sorted, per_block, to_blocks, unpack_planes, unpack_sorted
from touchline.llm.words import Words, cut_words, find_words, flagged_spans, mix, run_hashes, span_column, window_starts, word_hashes

ROWS = 2  # of the sketch
PAGE_BITS = 22  # cells of a page
_U = np.uint64


@dataclass(frozen=True)
class Sketch:
    """Each row of counters is dealt over ``pages`` of 2 ** PAGE_BITS cells."""

    pages: int

    @staticmethod
    def for_bytes(n: int) -> Sketch:
        """A cell in each row for each byte of text, so six or seven for each window, at any size of the corpus."""
        return Sketch(max(1, -(-n >> PAGE_BITS)))

    def cells(self, h: np.ndarray, row: int) -> np.ndarray:
        """The cell of each window: page by the leading bits of its hash, place in the page by the last ones."""
        if row:
            h = mix(h ^ _U(0x5851F42D4C957F2D))
        page = ((h >> _U(32)) * _U(self.pages)) >> _U(32)
        return (page << _U(PAGE_BITS)) | (h & _U((1 << PAGE_BITS) - 1))

    def cuts(self, cells: np.ndarray) -> np.ndarray:
        """Where each page begins in ascending cells."""
        return np.searchsorted(cells, np.arange(self.pages + 1, dtype=_U) << _U(PAGE_BITS))


def _windows(batch: pa.RecordBatch, at: int, n: int) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words, their hashes, and the first word and hash of each window."""
    w = find_words(batch.column(at))
    h = word_hashes(w)
    starts = window_starts(w, n)
    return w, h, starts, run_hashes(h, n)[starts] if len(starts) else np.zeros(0, _U)


def _sketch_pages(blocks: DataFrame, sketch: Sketch, at: int, n: int) -> DataFrame:
    """Partial sketches: the cells each block counts in each page, a cell at most twice."""
    schema = pa.schema([("page", pa.int64()), ("block", pa.int64()), ("cells", pa.binary())])

    def run(row: dict) -> Iterator[pa.RecordBatch]:
        _, _, _, h = _windows(one_batch(row["payload"]), at, n)
        pages, cells = [], []
        for r in range(ROWS):
            c = np.sort(sketch.cells(h, r))
            if len(c) > 2:
                c = c[np.append([True, True], c[2:] != c[:-2])]
            cuts = sketch.cuts(c)
            for p in np.flatnonzero(np.diff(cuts)):
                pages.append(r * sketch.pages + int(p))
                cells.append(pack_sorted(c[cuts[p]:cuts[p + 1]] - (_U(p) << _U(PAGE_BITS))))
        for i in range(0, len(pages), 256):
            m = len(pages[i:i + 256])
            yield pa.RecordBatch.from_arrays([
                pa.array(pages[i:i + m], pa.int64()), pa.array([row["block"]] * m, pa.int64()),
                pa.array(cells[i:i + m], pa.binary())], schema=schema)

    return blocks.select("block", "payload").mapInArrow(per_block(run), "page bigint, block bigint, cells binary")


def _repeated_cells(partial: DataFrame) -> DataFrame:
    """Merges the partial sketches of each page and tells each block, by a bit for each of its cells, which count two or more."""
    schema = pa.schema([("block", pa.int64()), ("page", pa.int64()), ("hot", pa.binary())])

    def merge(t: pa.Table) -> pa.Table:
        lists = [unpack_sorted(b).astype(np.int64) for b in t.column("cells").to_pylist()]
        hot = np.bincount(np.concatenate(lists), minlength=1 << PAGE_BITS) >= 2
        flags = [hot[c[np.append(True, c[1:] != c[:-1])]] for c in lists]
        some = [i for i, f in enumerate(flags) if f.any()]
        return pa.Table.from_arrays([
            t.column("block").take(pa.array(some, pa.int64())), t.column("page").take(pa.array(some, pa.int64())),
            pa.array([np.packbits(flags[i]).tobytes() for i in some], pa.binary())], schema=schema)

    return partial.groupBy("page").applyInArrow(merge, "block bigint, page bigint, hot binary")


def _candidates(row: dict, sketch: Sketch, at: int, key: int, n: int) -> dict:
    """Windows of a block that the sketch estimates repeated, in order of hash, then document and place."""
    batch = one_batch(row["payload"])
    if not row["hot"]:
        return {"batch": batch, "words": find_words(batch.column(at)), "start": np.zeros(0, np.int64), "h": np.zeros(0, _U)}
    w, wh, starts, h = _windows(batch, at, n)
    live = np.ones(len(h), bool)
    for r in range(ROWS):
        cells = sketch.cells(h, r)
        order = np.argsort(cells)
        cells = cells[order]
        new = np.append(True, cells[1:] != cells[:-1]) if len(cells) else np.zeros(0, bool)
        cuts = sketch.cuts(cells[new])
        hot = np.zeros(int(new.sum()), bool)
        for x in row["hot"]:
            if x["page"] // sketch.pages == r:
                a, b = cuts[x["page"] % sketch.pages], cuts[x["page"] % sketch.pages + 1]
                hot[a:b] = np.unpackbits(np.frombuffer(x["hot"], np.uint8), count=b - a)
        live[order] &= hot[np.cumsum(new) - 1]
    live = np.flatnonzero(live)
    start, h = starts[live], h[live]
    h2 = np.zeros(len(start), _U)
    for j in range(n):
        h2 = h2 * _U(0xD1342543DE82EF95) + wh[start + j]
    h2 = (mix(h2) >> _U(32)).astype(np.uint32)
    ids = np.asarray(batch.column(key).fill_null(np.iinfo(np.int64).min))
    text = w.row[start]
    doc, place = ids[text], (start - w.first[text]).astype(np.int32)
    order = np.lexsort((place, doc, h2, h))
    h, h2, doc, place = h[order], h2[order], doc[order], place[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (h2[1:] != h2[:-1])
    return {"batch": batch, "words": w, "start": start[order], "h": h, "h2": h2, "doc": doc, "place": place, "new": new}


def _bucket_cuts(h: np.ndarray, bits: int) -> np.ndarray:
    """Where the buckets, by the leading bits of the hash, begin in an ascending array."""
    edges = np.arange(1, 1 << bits, dtype=_U) << _U(64 - bits) if bits else np.zeros(0, _U)
    return np.concatenate([[0], np.searchsorted(h, edges), [len(h)]])


def _first_places(joined: DataFrame, sketch: Sketch, at: int, key: int, n: int, bits: int) -> DataFrame:
    """For each block and bucket the distinct candidate windows with the block's earliest place of each."""
    schema = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("data", pa.binary())])

    def run(row: dict) -> Iterator[pa.RecordBatch]:
        c = _candidates(row, sketch, at, key, n)
        if not len(c["h"]):
            return
        h, h2, doc, place = (c[k][c["new"]] for k in ("h", "h2", "doc", "place"))
        cuts = _bucket_cuts(h, bits)
        for b in np.flatnonzero(np.diff(cuts)):
            s = slice(cuts[b], cuts[b + 1])
            data = pack_planes(np.diff(h[s], prepend=_U(0)), h2[s], doc[s], place[s])
            yield pa.RecordBatch.from_arrays([pa.array([int(b)], pa.int64()), pa.array([row["block"]], pa.int64()), pa.array([data], pa.binary())], schema=schema)

    return joined.mapInArrow(per_block(run), "bucket bigint, block bigint, data binary")


def _later_places(firsts: DataFrame) -> DataFrame:
    """Groups the windows of each bucket exactly: one bit for each place a block sent, set if another is earlier."""
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("later", pa.binary())])

    def judge(t: pa.Table) -> pa.Table:
        parts = [unpack_planes(b, "<u8", "<u4", "<i8", "<i4") for b in t.column("data").to_pylist()]
        h = np.concatenate([np.cumsum(p[0], dtype=_U) for p in parts])
        h2, doc, place = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3))
        order = np.lexsort((place, doc, h2, h))
        h, h2, doc, place = h[order], h2[order], doc[order], place[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (h2[1:] != h2[:-1])
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        later = np.zeros(len(h), bool)
        later[order] = (doc != doc[first]) | (place != place[first])
        cuts = np.concatenate([[0], np.cumsum([len(p[0]) for p in parts])])
        bits = [np.packbits(later[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
        return pa.Table.from_arrays([t.column("block"), t.column("bucket"), pa.chunked_array([pa.array(bits, pa.binary())])], schema=schema)

    return firsts.groupBy("bucket").applyInArrow(judge, "block bigint, bucket bigint, later binary")


def _removed_words(row: dict, c: dict, n: int, bits: int) -> np.ndarray:
    """A flag for each word of a block: covered by a window that also starts earlier."""
    gone = np.zeros(len(c["words"].start), bool)
    if not len(c["h"]):
        return gone
    new, doc, place = c["new"], c["doc"], c["place"]
    first = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    cuts, flags = _bucket_cuts(c["h"][new], bits), np.zeros(len(first), bool)
    for v in row["verdicts"] or []:
        a, b = cuts[v["bucket"]], cuts[v["bucket"] + 1]
        flags[a:b] = np.unpackbits(np.frombuffer(v["later"], np.uint8), count=b - a).astype(bool)
    repeated = flags[group] | (doc != doc[first][group]) | (place != place[first][group])
    cover = np.zeros(len(gone) + 1, np.int64)
    starts = c["start"][repeated]
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + n, -1)
    return np.cumsum(cover)[:-1] > 0


ADDED = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
    T.StructField("removed", T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("stop", T.LongType())]))),
])


def remove_repeats(docs: DataFrame, n: int = 20, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without words covered by a window of ``n`` words that also starts earlier.

    Earlier means in a document of smaller id, or in the same document further
    left; all windows are judged on the input. ``text`` loses the words with the
    space up to the next kept word; ``n_words``, ``n_removed`` (of the input) and
    ``removed`` (stretches of word positions) are added.

    The documents are packed into blocks that no pass moves. Each block sends
    the sketch cells of its windows to the pages of a count-min sketch; a page
    merges the parts of all blocks and answers each block with its cells counted
    twice or more. Only windows whose cells all are (a superset of the repeated
    ones) are grouped exactly, by 96 hash bits, from one place for each block and
    window; the answer is one bit each. The sketch grows with the corpus, is
    spread over its pages, and no task or driver holds more than a page, a
    bucket or a block. A window that fills the corpus reaches a page and a bucket
    once or twice from each block.

    Null texts have no words and stay null; fewer than ``n`` words make no
    window. Ids should be whole numbers; null ids count as smallest. Rows with
    the same id start their windows at the same places, so neither is earlier and
    copies under one id stay. Columns named like the added ones are replaced. An
    empty table gives an empty one.
    """
    kept = [c for c in docs.columns if c not in ADDED.names]
    docs = docs.select(*[F.col(c).cast("bigint").alias(c) if c == doc_id else F.col(c) for c in kept])
    at, key = kept.index(text), kept.index(doc_id)
    blocks = to_blocks(docs, text, "substring_blocks")
    sketch = Sketch.for_bytes(blocks.agg(F.sum("n_bytes")).first()[0] or 0)
    bits = max(4, (sketch.pages - 1).bit_length() - 2)  # of buckets: fewer, as only some windows come so far
    cells = _repeated_cells(_sketch_pages(blocks, sketch, at, n))
    hot = cells.groupBy(F.col("block").alias("h_block")).agg(F.collect_list(F.struct("page", "hot")).alias("hot"))
    hot = stored(hot, "sketch_answers")
    some = blocks.select("block", "payload").join(hot.hint("shuffle_hash"), F.col("block") == F.col("h_block"))
    later = _later_places(_first_places(some.select("block", "payload", "hot"), sketch, at, key, n, bits))
    verdicts = later.groupBy(F.col("block").alias("v_block")).agg(F.collect_list(F.struct("bucket", "later")).alias("verdicts"))
    every = (blocks.select("block", "payload").join(hot.hint("shuffle_hash"), F.col("block") == F.col("h_block"), "left")
             .join(verdicts.hint("shuffle_hash"), F.col("block") == F.col("v_block"), "left")
             .select("block", "payload", "hot", "verdicts"))
    schema = T.StructType(docs.schema.fields + ADDED.fields)

    def run(row: dict) -> Iterator[pa.RecordBatch]:
        c = _candidates(row, sketch, at, key, n)
        batch, w = c["batch"], c["words"]
        gone = _removed_words(row, c, n, bits)
        spans = flagged_spans(w, gone)
        texts = cut_words(w, spans, batch.column(at))
        columns = [pa.array(texts, batch.column(at).type) if k == at else batch.column(k) for k in range(batch.num_columns)]
        n_gone = [sum(b - a for a, b in s) for s in spans]
        full = pa.RecordBatch.from_arrays(
            [*columns, pa.array(np.diff(w.first), pa.int64()), pa.array(n_gone, pa.int64()), span_column(spans)],
            names=[*kept, *ADDED.names])
        for i in range(0, full.num_rows, 1024):
            yield full.slice(i, 1024)

    return every.mapInArrow(per_block(run), schema)
