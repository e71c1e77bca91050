"""Words of a column of texts as numpy arrays: positions, hashes of words and of runs of words.

Works on the bytes of an Arrow string column at once, so a batch costs a few
array operations instead of Python work for each word. Texts are UTF-8; all
separators are ASCII, so bytes and characters split alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

# Bytes that belong to words: anything but ASCII white space, and digits, letters and non-ASCII characters.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_LONG = 4096  # bytes from which a word is hashed by itself
_U = np.uint64


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets of each; null texts are empty."""
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, at: int, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``size`` bytes of text in column ``at``; one text is never split."""
    _, off = text_bytes(batch.column(at))
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(off, off[start] + size, "right")) - 1)
        yield batch.slice(start, min(stop, batch.num_rows) - start)
        start = min(stop, batch.num_rows)


@dataclass
class Words:
    """``buf`` are the bytes; word i is ``buf[start[i]:end[i]]`` of text ``row[i]``; words of text r are ``first[r]`` to ``first[r + 1]``."""

    buf: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray


def find_words(column: pa.Array, inside: np.ndarray = NOT_SPACE, lower: bool = False) -> Words:
    buf, off = text_bytes(column)
    if lower:
        buf = LOWER[buf]
    mask = inside[buf]
    before = np.zeros(len(buf) + 1, bool)
    before[1:] = mask
    after = before[1:].copy()
    edge = off[:-1][off[:-1] < len(buf)]
    before = before[:-1].copy()
    before[edge] = False  # a text starts afresh
    start = np.flatnonzero(mask & ~before)
    after[:-1] = mask[1:]
    after[-1:] = False
    after[edge[edge > 0] - 1] = False
    end = np.flatnonzero(mask & ~after) + 1
    row = np.searchsorted(off[1:], start, "right")
    return Words(buf, off, start, end, row, np.searchsorted(row, np.arange(len(off)), "left"))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(w: Words, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of each word, eight bytes at a time; words of up to eight bytes of one length never collide."""
    length = w.end - w.start
    h = length.astype(_U) * _U(0x9E3779B97F4A7C15) + _U(seed)
    padded = np.zeros(len(w.buf) + 8, np.uint8)
    padded[:len(w.buf)] = w.buf
    eight = np.ndarray((len(w.buf) + 1,), "<u8", padded, strides=(1,))
    at, left, live = w.start, length, slice(None)
    long = np.flatnonzero(length > _LONG)
    for i in long:
        h[i] = xxhash.xxh64_intdigest(w.buf[w.start[i]:w.end[i]].tobytes(), seed)
    if len(long):
        live = np.flatnonzero(length <= _LONG)
        at, left = at[live], left[live]
    while len(at):
        part = eight[at] << (_U(64) - _U(8) * np.minimum(left, 8).astype(_U))
        h[live] = mix(h[live] ^ part)
        more = left > 8
        if not more.any():
            break
        live = np.flatnonzero(more) if isinstance(live, slice) else live[more]
        at, left = at[more] + 8, left[more] - 8
    return h


def run_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive entries, from hashes of runs of powers of two."""
    if len(h) < n:
        return np.zeros(0, _U)
    runs, size, out, done = h, 1, None, 0
    while True:
        if n & size:
            part = runs[done:]
            if out is None:
                out = part
            else:
                m = min(len(out), len(part))
                out = mix(out[:m] * _U(0xD6E8FEB86659FD93) + part[:m])
            done += size
        if done == n:
            return out[:len(h) - n + 1]
        runs = mix(runs[:-size] * _U(0xA0761D6478BD642F) + runs[size:])
        size *= 2


def window_starts(w: Words, n: int) -> np.ndarray:
    """Indices of the words at which a window of ``n`` words of one text starts."""
    per_text = np.diff(w.first)
    starts = np.arange(len(w.start))
    return starts[starts + n <= np.repeat(w.first[1:], per_text)]


def flagged_spans(w: Words, flag: np.ndarray) -> list[list[tuple[int, int]]]:
    """For each text the stretches (first word, last word + 1) of flagged words."""
    spans: list[list[tuple[int, int]]] = [[] for _ in range(len(w.first) - 1)]
    edge = np.flatnonzero(np.diff(flag.astype(np.int8), prepend=0, append=0))
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        while a < b:  # a stretch of flags may run over the end of a text
            r = int(w.row[a])
            base, stop = int(w.first[r]), min(b, int(w.first[r + 1]))
            spans[r].append((a - base, stop - base))
            a = stop
    return spans


def cut_words(w: Words, spans: list[list[tuple[int, int]]], texts: pa.Array) -> list[str | None]:
    """Texts without the given stretches of words.

    A cut reaches to the next kept word, so what stays keeps its own spacing.
    """
    out = texts.to_pylist()
    raw, _ = text_bytes(texts)
    for r in (r for r, s in enumerate(spans) if s):
        base, keep, at = int(w.first[r]), [], int(w.offsets[r])
        for a, b in spans[r]:
            keep.append(raw[at:w.start[base + a]])
            at = int(w.start[base + b]) if base + b < w.first[r + 1] else int(w.offsets[r + 1])
        keep.append(raw[at:w.offsets[r + 1]])
        out[r] = np.concatenate(keep).tobytes().decode("utf-8")
    return out


def span_column(spans: list[list[tuple[int, int]]]) -> pa.Array:
    """Stretches as an Arrow list of ``first``, ``stop``."""
    cuts = np.concatenate([[0], np.cumsum([len(s) for s in spans])]).astype(np.int32)
    flat = np.array([x for s in spans for x in s], np.int64).reshape(-1, 2)
    pairs = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], names=["first", "stop"])
    return pa.ListArray.from_arrays(pa.array(cuts), pairs)
