"""Periodic runs of words: longest common extensions from difference-cover samples, asked on a harmonic grid."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from touchline.llm.words import Words, find_words, slices, word_hashes

# Perfect difference covers: modulo ``v`` every distance but zero lies between two of the residues, once.
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
MODULUS = 21
# Text that a task handles at once, and grid points it looks at together.
SLICE_BYTES = 2 << 20
GRID_POINTS = 1 << 20
_FAR = np.iinfo(np.int32).max


class CoverLce:
    """Longest common extensions of positions ``i < j`` of one text.

    ``codes`` are the words of all texts as numbers; after each text stands a
    number found nowhere else. Only suffixes at positions in the difference
    cover are sorted, and only among those of their own text.
    """

    def __init__(self, codes: np.ndarray, text: np.ndarray, v: int = MODULUS):
        cover = np.array(COVERS[v])
        self.codes, self.v, self.per = codes, v, len(cover)
        self.place = np.full(v, -1, np.int64)
        self.place[cover] = np.arange(len(cover))
        # steps from residues (a, b) to the first positions that are both sampled
        a, b, d = np.ogrid[:v, :v, :v]
        both = (self.place[(a + d) % v] >= 0) & (self.place[(b + d) % v] >= 0)
        self.steps = both.argmax(axis=2)
        self.pos = (np.arange(0, len(codes) + v, v)[:, None] + cover).ravel()
        self.pos = self.pos[self.pos < len(codes)]
        self._sort(text)

    def _sample(self, position: np.ndarray) -> np.ndarray:
        return position // self.v * self.per + self.place[position % self.v]

    def _sort(self, text: np.ndarray) -> None:
        """Ranks of the sampled suffixes and the common lengths of neighbours, by refining groups that are still equal."""
        m = len(self.pos)
        owner = text[self.pos]
        start = np.flatnonzero(np.diff(owner, prepend=-2))  # samples are in order of texts already
        size = np.diff(np.append(start, m))
        self.rank = np.repeat(start, size)
        self.common = np.full(m, _FAR, np.int32)  # of the suffixes at this rank and the one before
        self.common[start] = 0
        self.span = int(size.max(initial=1))
        active, depth = np.flatnonzero(np.repeat(size, size) > 1), 0
        while len(active):
            if depth < self.v:  # word by word up to a block, then by the rank of what follows
                second, step = self.codes[self.pos[active] + depth], 1
            else:
                second, step = self.rank[self._sample(self.pos[active] + depth)], depth
            first = self.rank[active]
            order = np.lexsort((second, first))
            active, first, second = active[order], first[order], second[order]
            new_first = np.ones(len(active), bool)
            new_first[1:] = first[1:] != first[:-1]
            new = new_first.copy()
            new[1:] |= second[1:] != second[:-1]
            split = np.flatnonzero(new & ~new_first)
            at = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            rank = first + (at - np.flatnonzero(new_first)[np.cumsum(new_first)[at] - 1])[group]
            if len(split):
                if depth < self.v:
                    self.common[rank[split]] = depth
                else:
                    low, high = second[split - 1], second[split]
                    self._table()
                    self.common[rank[split]] = depth + self._least(low, high)
            self.rank[active] = rank
            active = active[np.diff(np.append(at, len(active)))[group] > 1]
            depth += step
        self._table()

    def _table(self) -> None:
        """The sparse table of range minima, as high as a text has samples."""
        rows = [self.common]
        while 1 << len(rows) <= self.span:
            half, last = 1 << len(rows) - 1, rows[-1]
            row = last.copy()
            np.minimum(last[:-half], last[half:], out=row[:-half])
            rows.append(row)
        self.minima = np.stack(rows)

    def _least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Common length of the suffixes of ranks ``low < high``."""
        level = np.frexp(high - low)[1] - 1
        return np.minimum(self.minima[level, low + 1], self.minima[level, high - (1 << level) + 1])

    def lengths(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from ``i`` and ``j`` on."""
        out = self.steps[i % self.v, j % self.v]
        live = np.arange(len(i))
        for d in range(self.v):  # few words by hand, until both are sampled
            live = live[out[live] > d]
            if not len(live):
                break
            equal = self.codes[i[live] + d] == self.codes[j[live] + d]
            out[live[~equal]] = -d - 1  # ends here
            live = live[equal]
        ended = out < 0
        met = np.flatnonzero(~ended)
        out[ended] = -out[ended] - 1
        a, b = (self.rank[self._sample(x[met] + out[met])] for x in (i, j))
        out[met] += self._least(np.minimum(a, b), np.maximum(a, b))
        return out


def _grid(base: np.ndarray, n: np.ndarray, points: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions ``i`` and periods ``q``: in each text all multiples of each period up to half its length."""
    half = n // 2
    text = np.repeat(np.arange(len(n)), half)
    q = np.arange(len(text)) - np.repeat(np.cumsum(half) - half, half) + 1
    count = (n[text] - 1) // q
    ends = np.cumsum(count)
    at = 0
    while at < len(q):
        done = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + points, "right")))
        c, period = count[at:stop], np.repeat(q[at:stop], count[at:stop])
        nth = np.arange(len(period)) - np.repeat(np.cumsum(c) - c, c)
        yield np.repeat(base[text[at:stop]], c) + nth * period, period
        at = stop


def word_runs(codes: np.ndarray, first: np.ndarray, least: int = 12, v: int = MODULUS, points: int = GRID_POINTS):
    """Runs of all texts as arrays ``text``, ``start`` (word of the text), ``length``, ``period``, in this order.

    ``codes`` (not negative) are the words, those of text r are ``first[r]`` to
    ``first[r + 1]``. A run of period q has exactly one grid point in its first
    q words, and its word recurs q words on: where it does, the extensions to
    both sides tell the run's ends. Of one stretch the smallest period stays.
    """
    n = np.diff(first)
    texts = np.arange(len(n))
    seq = np.empty(len(codes) + len(n) + 1, np.int64)  # a number of its own before, between and after the texts
    base = first[:-1] + texts + 1
    ends = np.append(0, base + n)
    seq[ends] = -1 - np.arange(len(ends))
    word = np.ones(len(seq), bool)
    word[ends] = False
    seq[word] = codes
    owner = np.repeat(np.append(-1, texts), np.append(1, n + 1))
    some = np.flatnonzero(n >= least)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for i, q in _grid(base[some], n[some], points):
        same = seq[i] == seq[i + q]
        found.append((i[same], q[same]))
    i, q = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
    if len(i):
        need = np.maximum(q, least - q)
        ahead = CoverLce(seq, owner, v)
        last = i + q + _by_parts(ahead, i, i + q)
        del ahead
        turned = len(seq) - i  # the word before i, counted from the end
        back = CoverLce(seq[::-1].copy(), (owner[-1] - owner[::-1]), v)
        before = _by_parts(back, turned - q, turned)
        del back
        ok = (before < q) & (last - q - i + before >= need)
        start, last, q = i[ok] - before[ok], last[ok], q[ok]
    else:
        start, last = i, i
    order = np.lexsort((q, last, start))
    start, last, q = start[order], last[order], q[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (last[1:] != last[:-1])
    start, last, q = start[new], last[new], q[new]
    order = np.lexsort((q, start))
    start, last, q = start[order], last[order], q[order]
    text = owner[start]
    return text, start - base[text] if len(text) else start, last - start, q


def _by_parts(lce: CoverLce, i: np.ndarray, j: np.ndarray, size: int = 1 << 20) -> np.ndarray:
    parts = [lce.lengths(i[k:k + size], j[k:k + size]) for k in range(0, len(i), size)]
    return np.concatenate(parts)


def joined(w: Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    length = np.where(keep, w.end - w.start + 1, 0)
    to = np.concatenate([[0], np.cumsum(length)])
    start, size = w.start[keep], length[keep]
    at = np.repeat(start - to[:-1][keep], size) + np.arange(to[-1])
    data = w.buf[np.minimum(at, len(w.buf) - 1)] if len(at) else np.zeros(0, np.uint8)
    data[to[1:][keep] - 1] = 0x20
    ends = to[w.first]
    # the space after the last word of a text goes
    some = ends[1:] > ends[:-1]
    stay = np.ones(len(data), bool)
    stay[ends[1:][some] - 1] = False
    offsets = ends - np.concatenate([[0], np.cumsum(some)])
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[stay].tobytes()))


RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
ADDED = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])


def find_runs(docs: DataFrame, least: int = 12, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (``start``, ``length``, ``period`` in words) and ``collapsed``.

    A run is a stretch of words with smallest period q, at least ``least`` and
    2q words long, that no word beside it extends. Runs stand by start, then
    period. ``collapsed`` are the words that no run has after its first q,
    joined by one space.

    Each task handles its own documents; nothing is shuffled. Words are told
    apart by 62-bit hashes within a document. Memory follows the longest text.

    Null, empty and blank texts have no words, no runs and an empty
    ``collapsed``. Repeated rows stay, each by itself; an empty table gives an
    empty one. Columns named like the added ones are replaced.
    """
    kept = [c for c in docs.columns if c not in ADDED.names or c == text]
    docs, at = docs.select(*kept), kept.index(text)
    added = [f for f in ADDED.fields if f.name not in kept]
    schema = T.StructType([*docs.schema.fields, *added])
    pairs = pa.struct([(n, pa.int64()) for n in RUN.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, at, SLICE_BYTES):
                w = find_words(piece.column(at))
                codes = (word_hashes(w) >> np.uint64(2)).astype(np.int64)
                doc, start, length, period = word_runs(codes, w.first, least)
                change = np.zeros(len(codes) + 1, np.int64)
                np.add.at(change, w.first[doc] + start + period, 1)
                np.add.at(change, w.first[doc] + start + length, -1)
                cuts = np.searchsorted(doc, np.arange(piece.num_rows + 1)).astype(np.int32)
                rows = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], fields=list(pairs))
                new = {"n_words": pa.array(np.diff(w.first), pa.int64()), "runs": pa.ListArray.from_arrays(cuts, rows),
                       "collapsed": joined(w, np.cumsum(change)[:-1] == 0)}
                new["collapsed"] = new["collapsed"].cast(pa.string())
                yield pa.RecordBatch.from_arrays([*piece.columns, *(new[f.name] for f in added)], names=schema.names)

    return docs.mapInArrow(run, schema)
