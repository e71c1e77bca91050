"""Arrays as small bytes, and documents as blocks that stay where they are between passes."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from touchline.llm.memory import lean
from touchline.llm.words import slices, text_bytes
from touchline.session import ensure_checkpoint_dir

BLOCK_BYTES = 4 << 20


def pack_planes(*arrays: np.ndarray) -> bytes:
    """Integer arrays of one length, byte plane by byte plane, so that equal high bytes compress away."""
    parts = [np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack_planes(data: bytes, *dtypes: str) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    widths = [np.dtype(d).itemsize for d in dtypes]
    n, at, out = len(raw) // sum(widths), 0, []
    for d, w in zip(dtypes, widths):
        out.append(np.ascontiguousarray(raw[at:at + n * w].reshape(w, n).T).view(d).reshape(n))
        at += n * w
    return out


def pack_sorted(x: np.ndarray) -> bytes:
    """An ascending array of unsigned numbers as differences."""
    return pack_planes(np.diff(x.astype(np.uint64), prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack_planes(data, "<u8")[0], dtype=np.uint64)


def to_blocks(docs: DataFrame, text: str, name: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` packed into rows of about ``block_bytes`` of text each: ``block``, ``n_bytes``, ``payload``.

    Nothing is shuffled: each scan task packs its own rows, compressed, into a
    table bucketed by ``block`` in the shared folder. What later passes learn
    about a block is joined to it without moving a text again, and a lost
    executor costs a reread. A text longer than a block is a block of its own.
    """
    spark, at = docs.sparkSession, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, count, held, size = TaskContext.get().partitionId() << 32, 0, [], 0

        def block() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                for b in held:
                    out.write_batch(b)
            return pa.RecordBatch.from_pydict({
                "block": pa.array([base + count], pa.int64()), "n_bytes": pa.array([size], pa.int64()),
                "payload": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

        for batch in batches:
            for piece in slices(batch, at, block_bytes):
                n = len(text_bytes(piece.column(at))[0])
                if held and size + n > block_bytes:
                    yield block()
                    count, held, size = count + 1, [], 0
                held.append(piece)
                size += n
        if held:
            yield block()

    packed = docs.mapInArrow(lean(run), "block bigint, n_bytes bigint, payload binary")
    path = f"{ensure_checkpoint_dir(spark)}/touchline/{name}-{uuid.uuid4().hex}"
    label = f"{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed.write.format("parquet").option("compression", "none").option("path", path).bucketBy(buckets, "block").saveAsTable(label)
    return spark.table(label)


def block_rows(payload: bytes) -> Iterator[pa.RecordBatch]:
    yield from pa.ipc.open_stream(payload)


def one_batch(payload: bytes) -> pa.RecordBatch:
    """The documents of a block as a single batch."""
    return pa.ipc.open_stream(payload).read_all().combine_chunks().to_batches()[0]


def per_block(run: Callable[[dict], Iterator[pa.RecordBatch]]) -> Callable:
    """A function for ``mapInArrow`` that handles one block row after the other."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from run({n: batch.column(k)[i].as_py() for k, n in enumerate(batch.schema.names)})
    return lean(over)
