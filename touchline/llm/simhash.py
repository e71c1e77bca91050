"""SimHash near-dedup: fingerprints, bit-sliced comparison within bands, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from touchline.llm.common import components, stored
from touchline.llm.memory import lean
from touchline.llm.words import Words, find_words, slices

BITS = 64
_U = np.uint64
FULL = _U(0xFFFFFFFFFFFFFFFF)

# Fingerprints of one key that a task compares at once; larger keys are dealt out in pairs of parts.
KEY_PART = 1 << 15


def shingle_hashes(w: Words, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every run of ``n`` words joined by one space, and its text; a shorter text has one run of all its words."""
    count = np.diff(w.first)
    runs = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    text = np.repeat(np.arange(len(count)), runs)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs)
    a = w.first[text] + nth
    b = a + np.minimum(n, count[text]) - 1
    # the words with one space after each, so that a run is one slice
    length = w.end - w.start + 1
    to = np.concatenate([[0], np.cumsum(length)])
    joined = np.arange(to[-1]) + np.repeat(w.start - to[:-1], length)
    joined = w.buf[np.minimum(joined, len(w.buf) - 1)] if len(joined) else np.zeros(0, np.uint8)
    joined[to[1:] - 1] = 0x20
    raw = memoryview(joined.tobytes())
    digest = xxhash.xxh64_intdigest
    h = [digest(raw[x:y], seed) for x, y in zip(to[a].tolist(), (to[b + 1] - 1).tolist())]
    return np.array(h, _U), text


def fingerprints_of(w: Words, n: int, seed: int) -> np.ndarray:
    """The fingerprint of each text: a bit is set if it is set in over half of the text's hashes.

    Eight bits are counted at once, one in each byte of a word, over 255 hashes at most.
    """
    h, text = shingle_hashes(w, n, seed)
    rows = len(w.first) - 1
    total = np.bincount(text, minlength=rows)
    out = np.zeros(rows, _U)
    some = np.flatnonzero(total)
    if not len(some):
        return out
    begin = np.cumsum(total) - total
    nth = np.arange(len(h)) - begin[text]
    chunks = np.flatnonzero(nth % 255 == 0)
    first_chunk = np.flatnonzero(nth[chunks] == 0)
    for k in range(8):
        bytewise = np.add.reduceat((h >> _U(k)) & _U(0x0101010101010101), chunks)
        ones = np.add.reduceat(bytewise.view(np.uint8).reshape(-1, 8).astype(np.int64), first_chunk, axis=0)
        for j in range(8):
            out[some] |= (2 * ones[:, j] > total[some]).astype(_U) << _U(8 * j + k)
    return out


def with_fingerprint(docs: DataFrame, n: int = 4, seed: int = 42, lower: bool = True, text: str = "text", name: str = "simhash") -> DataFrame:
    """``docs`` with a long column ``name``: the 64-bit SimHash of the word shingles of each whole text."""
    kept = [c for c in docs.columns if c != name]
    docs = docs.select(*kept)
    at = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, at, 4 << 20):
                f = fingerprints_of(find_words(piece.column(at), lower=lower), n, seed)
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(f.view(np.int64))], names=[*kept, name])

    return docs.mapInArrow(lean(run), StructType([*docs.schema.fields, StructField(name, LongType())]))


def band_keys(f, radius: int):
    """Keys of which two fingerprints within ``radius`` bits share one at least: pairs of ``radius`` + 2 bands."""
    n = radius + 2
    edges = [BITS * i // n for i in range(n + 1)]
    bands = [F.shiftrightunsigned(f, edges[i]).bitwiseAND(F.lit((1 << (edges[i + 1] - edges[i])) - 1)) for i in range(n)]
    return [F.xxhash64(F.lit(i), bands[a], bands[b]) for i, (a, b) in enumerate(combinations(range(n), 2))]


def close_labels(f: np.ndarray, group: np.ndarray, left: np.ndarray, right: np.ndarray, radius: int) -> np.ndarray:
    """For members of groups, an ascending array: the smallest member each reaches by left-right pairs within ``radius`` bits.

    Bit-sliced: the right members of a group lie in blocks of 64 lanes, a word
    for each bit plane. A left member meets a whole block at once: per plane one
    exclusive or gives the lanes that differ, and carry-save counters of one word
    per binary digit add them up. Lanes beyond the radius stay marked, and a block
    is abandoned as soon as all its lanes are.
    """
    label = np.arange(len(f))
    members, lefts = np.flatnonzero(right), np.flatnonzero(left)
    if not len(members) or not len(lefts):
        return label
    g = group[members]
    new = np.append(True, g[1:] != g[:-1])
    lane = (np.arange(len(members)) - np.flatnonzero(new)[np.cumsum(new) - 1]) % 64
    starts = np.flatnonzero(new | (lane == 0))
    bit = _U(1) << lane.astype(_U)
    planes = np.stack([np.bitwise_or.reduceat(bit * ((f[members] >> _U(b)) & _U(1)), starts) for b in range(BITS)])
    used = np.bitwise_or.reduceat(bit, starts)
    # each left member meets the blocks of its group
    lo = np.searchsorted(g[starts], group[lefts], "left")
    n = np.searchsorted(g[starts], group[lefts], "right") - lo
    total, at = np.cumsum(n), 0
    while at < len(lefts):  # so many meetings at a time that the counters stay small
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + (1 << 16), "right")))
        k = n[at:to]
        who = np.repeat(lefts[at:to], k)
        blk = np.repeat(lo[at:to], k) + np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
        at = to
        digits = [np.zeros(len(who), _U) for _ in range(radius.bit_length())]
        over = ~used[blk]
        for b in range(BITS):
            carry = planes[b][blk] ^ (_U(0) - ((f[who] >> _U(b)) & _U(1)))
            for d in range(len(digits)):
                digits[d], carry = digits[d] ^ carry, digits[d] & carry
            over |= carry
            if b % 4 == 3:
                over |= _above(digits, radius)
                live = np.flatnonzero(over != FULL)
                if len(live) < len(over):
                    who, blk, over = who[live], blk[live], over[live]
                    digits = [x[live] for x in digits]
                if not len(live):
                    break
        meeting, lane_hit = np.nonzero(np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        _merge(label, who[meeting], members[starts[blk[meeting]] + lane_hit])
    return label


def _above(digits: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter is above ``radius``, digit by digit from the highest."""
    above, equal = np.zeros_like(digits[0]), np.full_like(digits[0], FULL)
    for d in reversed(range(len(digits))):
        if radius >> d & 1:
            equal = equal & digits[d]
        else:
            above, equal = above | (equal & digits[d]), equal & ~digits[d]
    return above


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Gives linked members, and all that share their labels, the smallest label."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        low, high = np.minimum(x, y), np.maximum(x, y)
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label[:] = label[label]


def fingerprint_links(prints: DataFrame, radius: int = 4, key_part: int = KEY_PART) -> DataFrame:
    """Links ``a``, ``b`` that connect all distinct fingerprints ``f`` within ``radius`` bits of each other.

    Of each key group only a spanning set of links leaves its task, never all
    pairs. A key with more than ``key_part`` fingerprints is dealt out: its
    members are split into parts, and each pair of parts is compared by itself.
    """
    keyed = prints.select("f", F.explode(F.array(*band_keys(F.col("f"), radius))).alias("key"))
    big = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    keyed = keyed.join(big, "key").withColumn("parts", F.ceil(F.col("n") / key_part).cast("int"))
    mine = F.pmod(F.xxhash64("f"), F.col("parts")).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: F.struct(
        F.least(p, mine).alias("x"), F.greatest(p, mine).alias("y"), mine.alias("part")))
    keyed = keyed.select("key", "f", F.explode(meets).alias("m")).select("key", "f", "m.*")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out(t: pa.Table) -> pa.RecordBatch:
            key, x, y, part, f = (t.column(n).to_numpy() for n in ("key", "x", "y", "part", "f"))
            f = f.view(_U)
            order = np.lexsort((f, y, x, key))
            key, x, y, part, f = (v[order] for v in (key, x, y, part, f))
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
            group = np.cumsum(new) - 1
            label = close_labels(f, group, part == x, part == y, radius)
            moved = np.flatnonzero(label != np.arange(len(f)))
            return pa.RecordBatch.from_pydict({"a": pa.array(f[moved].view(np.int64)), "b": pa.array(f[label[moved]].view(np.int64))})

        for batch in batches:
            held.append(batch)
            rows = sum(b.num_rows for b in held)
            if rows >= 1 << 17:  # whole keys go out, the last may go on in the next batch
                t = pa.Table.from_batches(held).combine_chunks()
                k = t.column("key").to_numpy()
                cut = int(np.searchsorted(k, k[-1], "left"))
                if cut:
                    yield out(t.slice(0, cut))
                    held = t.slice(cut).to_batches()
        if held:
            yield out(pa.Table.from_batches(held))

    dealt = keyed.repartition("key", "x", "y").sortWithinPartitions("key")
    return dealt.mapInArrow(lean(compare), "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, radius: int = 4, n: int = 4, seed: int = 42, lower: bool = True,
                    text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id``, ``simhash`` (long), ``component_id`` for every row of ``docs``.

    Two documents are linked if their fingerprints differ in ``radius`` bits or
    fewer; ``component_id`` is the smallest id reachable by links. Fingerprints
    are taken of whole texts and then handled once each, however many documents
    share one; bands find candidates, bit-sliced words compare them.

    Null texts and texts without words have fingerprint zero and are linked
    like any other. Rows with a null id belong to their component and have its
    smallest id, null if all are null. Repeated rows stay. An empty table gives
    an empty one.
    """
    prints = stored(with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), n, seed, lower).select("doc_id", "simhash"), "simhash")
    smallest = prints.groupBy(F.col("simhash").alias("f")).agg(F.min("doc_id").alias("least"))
    groups = components(fingerprint_links(smallest.select("f"), radius))
    grouped = smallest.join(groups, F.col("f") == F.col("node"), "left").withColumn("component", F.coalesce("component", "f"))
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    by_print = grouped.join(least, "component").select("f", "component_id")
    return prints.join(by_print, F.col("simhash") == F.col("f"), "left").select("doc_id", "simhash", "component_id")
