"""Documents packed into blocks: the unit that Arrow stages pass between shuffles.

A block holds whole documents, one after the other, as bytes. It is written once to the
shared folder as a table bucketed by block, so later stages meet it by block without
moving the text again, and a lost executor rereads it with the same content.
"""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlake.session import new_path

BLOCK_BYTES = 8 << 20
#: Of texts that a task hands to Python at a time: the largest block.
BATCH_BYTES = 16 << 20
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def squeeze(*arrays: np.ndarray | bytes) -> bytes:
    """Arrays as one compressed value: lengths, then contents."""
    parts = [a if isinstance(a, bytes) else np.ascontiguousarray(a).tobytes() for a in arrays]
    head = np.array([len(parts), *map(len, parts)], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(parts))


def unsqueeze(value: bytes) -> list[memoryview]:
    raw = memoryview(zstandard.ZstdDecompressor().decompress(value))
    n = int(np.frombuffer(raw[:8], np.int64)[0])
    ends = np.cumsum([8 * (n + 1), *np.frombuffer(raw[8 : 8 * (n + 1)], np.int64)])
    return [raw[a:b] for a, b in zip(ends[:-1], ends[1:])]


def array(part: memoryview, dtype) -> np.ndarray:
    return np.frombuffer(part, dtype)


def trim() -> None:
    """Gives freed memory back to the system. A worker process serves many tasks, also of later
    stages, and would keep the largest that it ever had."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def new_block() -> int:
    """The identity of a block; it is fixed once the block is written."""
    return uuid.uuid4().int >> 65


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column without nulls, and each value's length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column), np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], np.diff(offsets)


def pack_rows(rows: pa.Array) -> bytes:
    batch = pa.record_batch([rows], names=["row"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack_rows(value: bytes | memoryview) -> pa.Array:
    with pa.ipc.open_stream(pa.py_buffer(value)) as reader:
        return reader.read_all().column("row").combine_chunks()


def free_name(names: list[str], wish: str) -> str:
    """``wish``, or that after underscores, such that no column has the name in any case."""
    taken = {n.lower() for n in names}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


def with_text(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The kept columns as one struct (so no name can clash), the text as bytes (null: empty)."""
    names = ["doc_id"] if keep is None else [c for c in docs.columns if c in keep and c != "text"]
    return docs.select(
        F.struct(*names).alias("row"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )


def pieces(batch: pa.RecordBatch, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into consecutive slices of about ``limit`` bytes of text."""
    lengths = flat(batch.column(batch.schema.get_field_index("text")))[1]
    part = np.cumsum(lengths) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(lengths)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def write_bucketed(df: DataFrame, label: str, key: str, buckets: int) -> DataFrame:
    """Writes ``df`` once, bucketed by ``key``; groupings on it need no further shuffle.

    The table lies in the shared folder. Call it on rows that are few and large (blocks):
    a task writes a file for each bucket that it has a row of.
    """
    spark, name = df.sparkSession, f"{label}_{uuid.uuid4().hex}"
    with arrow_bytes(spark, BATCH_BYTES):
        (
            df.write.format("parquet")
            .bucketBy(buckets, key)
            .option("path", new_path(spark, label))
            .option("compression", "uncompressed")
            .saveAsTable(name)
        )
    return spark.table(name)


@contextlib.contextmanager
def arrow_bytes(spark: SparkSession, limit: int) -> Iterator[None]:
    """While it lasts, batches to Python hold about ``limit`` bytes (a longer row: that row), not
    as many texts as make up a count of rows: both sides of the pipe keep a whole batch."""
    before = spark.conf.get(ARROW_BYTES)
    spark.conf.set(ARROW_BYTES, str(limit))
    try:
        yield
    finally:
        spark.conf.set(ARROW_BYTES, before)

