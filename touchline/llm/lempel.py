"""Lempel-Ziv fingerprints: dictionary phrases of a text, hashed, and the smallest hashes kept for comparison."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.common import stored
from touchline.llm.words import mix, slices

# Hashes in a fingerprint, hexadecimal digits of each (40 bits).
SIZE = 64
DIGITS = 10
SLICE_BYTES = 1 << 20
# Text of one part of the order, on average.
PART_BYTES = 64 << 20


def read_phrases(data: bytes, children: dict[int, int], node: int = 0) -> int:
    """Reads on in a text cut into phrases, each the shortest that ``children`` does not have; returns the open phrase.

    ``children`` is the dictionary as a tree: 256 times the number of a phrase,
    plus the byte that follows it, leads to 256 times the number of the longer
    phrase. Phrases are numbered as they come, from 1; the empty one is 0.
    """
    get, new = children.get, len(children) << 8
    for byte in data:
        key = node + byte
        node = get(key, 0)
        if not node:
            new += 256
            children[key] = new
    return node


def phrase_hashes(dictionaries: list[dict[int, int]], known: list[np.ndarray] | None = None) -> list[np.ndarray]:
    """Hashes of the phrases of each dictionary, level by level for all: a phrase's hash follows from that of its beginning.

    ``known`` are the hashes of the first phrases of each, if they have been computed before.
    """
    known = known or [np.zeros(0, np.uint64)] * len(dictionaries)
    counts, old = (np.array([len(x) for x in xs], np.int64) for xs in (dictionaries, known))
    ends, new = np.cumsum(counts), counts - old
    keys = np.fromiter(chain.from_iterable(islice(d, len(k), None) for d, k in zip(dictionaries, known)), np.int64, new.sum())
    base = ends - counts  # phrases of all texts are numbered together
    mine = np.arange(len(keys)) + np.repeat(base + old - np.cumsum(new) + new, new) + 1
    parent = keys >> 8
    parent[parent > 0] += np.repeat(base, new)[parent > 0]
    byte = (keys & 255).astype(np.uint64) + np.uint64(1)
    h, done = np.zeros(counts.sum() + 1, np.uint64), np.ones(counts.sum() + 1, bool)
    for at, k in zip((base + 1).tolist(), known):
        h[at:at + len(k)] = k
    done[mine] = False
    todo = np.arange(len(keys))
    while len(todo):
        ready = done[parent[todo]]
        now = todo[ready]
        h[mine[now]] = mix(h[parent[now]] * np.uint64(0x9E3779B97F4A7C15) + byte[now])
        done[mine[now]] = True
        todo = todo[~ready]
    return np.split(h[1:], ends[:-1])


def smallest(h: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The ``size`` smallest of the hashes, cut to their first 40 bits, ascending."""
    h = h >> np.uint64(64 - 4 * DIGITS)
    if len(h) > 4 * size:
        h = np.partition(h, 2 * size)[:2 * size]  # a few phrases may share a hash
    h = np.sort(h)
    return h[np.append(True, h[1:] != h[:-1])[:len(h)]][:size]


def packed(h: np.ndarray) -> bytes:
    """Five bytes for each hash."""
    return h.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - DIGITS // 2:].tobytes()


def shared(x: np.ndarray, y: np.ndarray, size: int = SIZE) -> float:
    """Share of common phrases (Jaccard) by the smallest hashes of two texts; exact where neither has more than ``size``."""
    both = np.sort(np.concatenate([x, y]))
    new = np.append(True, both[1:] != both[:-1])[:len(both)]
    place = np.cumsum(new)  # among the distinct hashes
    n = min(size, place[-1]) if len(both) else 0
    return float((~new & (place <= n)).sum()) / n if n else 1.0


def likeness(a: str, b: str, size: int = SIZE) -> float:
    """:func:`shared` of two fingerprints. Two empty ones are alike, an empty one and any other are not."""
    x, y = (np.array([int(f[k:k + DIGITS], 16) for k in range(0, len(f), DIGITS)], np.uint64) for f in (a, b))
    return shared(x, y, size)


def fingerprints(docs: DataFrame, size: int = SIZE, text: str = "text") -> DataFrame:
    """``docs`` with ``fingerprint``: equal texts have equal ones, :func:`likeness` compares two.

    Every text is parsed into the phrases of its own dictionary, byte by byte of
    its UTF-8; the fingerprint holds the ``size`` smallest hashes of the set of
    phrases. Each task handles its own documents; nothing is shuffled. Null and
    empty texts have the empty fingerprint. Repeated rows stay; an empty table
    gives an empty one. A column named ``fingerprint`` is replaced.
    """
    kept = [c for c in docs.columns if c != "fingerprint" or c == text]
    docs, at = docs.select(*kept), kept.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField("fingerprint", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, at, SLICE_BYTES):
                read: list[dict[int, int]] = [{} for _ in range(piece.num_rows)]
                for t, d in zip(piece.column(at).to_pylist(), read):
                    read_phrases((t or "").encode("utf-8"), d)
                out = [packed(smallest(h, size)).hex() for h in phrase_hashes(read)]
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(out, pa.string())], names=schema.names)

    return docs.mapInArrow(run, schema)


ROWS = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
    T.StructField("fingerprint", T.BinaryType()), T.StructField("edited_fingerprint", T.BinaryType()),
    T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())])
# Rows at the ends of a part carry their text and wait for their neighbour.
FIRST, LAST = 1, 2


class _Read:
    """A text with its dictionary, and its dictionary up to where the edit starts."""

    def __init__(self, doc_id: int | None, text: str | None, share: int):
        self.id, self.text = doc_id, text or ""
        self.keep = len(self.text) - len(self.text) // share
        self.head: dict[int, int] = {}
        self.open = read_phrases(self.text[:self.keep].encode("utf-8"), self.head)
        self.all = self.head.copy()
        read_phrases(self.text[self.keep:].encode("utf-8"), self.all, self.open)
        self.print = self.hashes = np.zeros(0, np.uint64)

    def edit(self, after: _Read) -> tuple[dict[int, int], str]:
        """Dictionary and digest of the edited text; the common beginning is read once."""
        tail = after.text[:len(self.text) - self.keep]
        read_phrases(tail.encode("utf-8"), self.head, self.open)
        return self.head, hashlib.sha256((self.text[:self.keep] + tail).encode("utf-8")).hexdigest()

    def end(self, part: int, which: int) -> tuple:
        return part, which, self.id, self.text, None, None, None, None, None, None


def _compared(part: int, pairs: list[tuple[_Read, _Read]], size: int) -> list[tuple]:
    """Rows of texts, each with the text that follows it."""
    edits = [a.edit(b) for a, b in pairs]
    prints = [smallest(h, size) for h in phrase_hashes([d for d, _ in edits], [a.hashes for a, _ in pairs])]
    return [(part, 0, a.id, None, len(a.text), digest, packed(a.print), packed(e), shared(a.print, e, size), shared(a.print, b.print, size))
            for (a, b), (_, digest), e in zip(pairs, edits, prints)]


def _read_all(ids: list, texts: list, share: int, size: int) -> list[_Read]:
    reads = [_Read(i, t, share) for i, t in zip(ids, texts)]
    for r, h in zip(reads, phrase_hashes([r.all for r in reads])):
        r.print, r.hashes, r.all = smallest(h, size), h[:len(r.head)].copy(), {}
    return reads


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
    columns = zip(*rows) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=ROWS.names)


def compare_edits(docs: DataFrame, share: int = 4, size: int = SIZE, text: str = "text", doc_id: str = "doc_id",
                  part_bytes: int = PART_BYTES) -> DataFrame:
    """How far an edit moves a fingerprint, beside the distance to another text.

    The edited text of a document has its last floor(n / ``share``) code points
    replaced by the first as many (or all) of the next document in ascending
    order of ``doc_id``; after the last comes the first. Returns ``doc_id``,
    ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited`` and ``near_next`` (:func:`likeness` to the edited text and to
    the next document).

    The documents are sorted once, by ranges of ids, and every task reads its
    part as a stream with one row in hand. The rows at the ends of the parts,
    two for each task, go to the shared folder with the results and meet
    their neighbours in a small join.

    Null texts count as empty; null ids come first; rows of one id follow by a
    hash of their text, equal rows beside each other, so that one id may fill
    many parts. A single document follows itself. An empty table gives an
    empty one. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // part_bytes))
    order = [F.col("id").asc_nulls_first(), F.col("hash"), F.col("place")]
    rows = rows.withColumns({"hash": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), None
        for batch in batches:
            for piece in slices(batch, 1, SLICE_BYTES):
                reads = _read_all(piece.column(0).to_pylist(), piece.column(1).to_pylist(), share, size)
                if not before:
                    yield _batch([reads[0].end(part, FIRST)])
                line = ([before] if before else []) + reads
                yield _batch(_compared(part, list(zip(line, line[1:])), size))
                before = line[-1]
        if before:
            yield _batch([before.end(part, LAST)])

    done = stored(rows.mapInArrow(run, ROWS), "edits")
    ends = done.filter("end > 0")
    known = sorted(r["part"] for r in ends.filter(F.col("end") == FIRST).select("part").collect())  # numbers of tasks
    after = spark.createDataFrame(list(zip(known, known[1:] + known[:1])), "part int, following int")
    first = ends.filter(F.col("end") == FIRST).select(F.col("part").alias("following"), F.col("text").alias("next_text"))
    last = ends.filter(F.col("end") == LAST).select("part", "doc_id", "text").join(after, "part").join(first, "following")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                pair = _read_all([r["doc_id"], None], [r["text"], r["next_text"]], share, size)
                yield _batch(_compared(0, [tuple(pair)], size))

    out = done.filter("end = 0").unionByName(last.select("doc_id", "text", "next_text").mapInArrow(close, ROWS))
    digits = {c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")}
    return out.withColumns(digits).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
