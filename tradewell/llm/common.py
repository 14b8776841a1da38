"""What several operators share: words, text buffers, and running Arrow code over a frame."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space that separates words: blank and the controls 09 to 0D.
WORD = r"[^\x20\x09-\x0D]+"
ASCII_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of a column as bytes, null as empty."""
    return [v or b"" for v in column.cast(pa.large_binary()).to_pylist()]


def buffer_of(texts: list[bytes], gap: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, each followed by ``gap`` zero bytes, and where each begins; last entry: the end."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + gap
    starts = np.concatenate(([0], np.cumsum(sizes)))
    filler = bytes(gap)
    return np.frombuffer(filler.join(texts) + filler, np.uint8)[: starts[-1]], starts


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads close values (finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def release_memory() -> None:
    """Give freed memory back to the system: workers are kept, and two of them share an executor with its JVM."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: it keeps what it likes


def slices(batch: pa.RecordBatch, most_bytes: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about ``most_bytes`` of text, at least one row each."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
    total, begin = 0, 0
    for i, size in enumerate(sizes):
        total += size
        if total >= most_bytes:
            yield batch.slice(begin, i + 1 - begin)
            total, begin = 0, i + 1
    if begin < batch.num_rows:
        yield batch.slice(begin)


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str,
                most_bytes: int = 16 << 20, column: str = "text") -> DataFrame:
    """Run ``work`` on pieces of the frame's Arrow batches; ``column`` gives their size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, most_bytes, column):
                out = work(piece)
                if out is not None and out.num_rows:
                    yield out
                del out, piece
            del batch
            release_memory()

    return df.mapInArrow(run, schema)


def record_batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def id_column(docs: DataFrame) -> Column:
    """doc_id as bigint; without a cast where it is one, so that two uses of a frame keep one plan and share a shuffle."""
    return F.col("doc_id") if dict(docs.dtypes)["doc_id"] == "bigint" else F.col("doc_id").cast("bigint").alias("doc_id")


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts; sizes the number of groups an operator works in."""
    return int(docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0)


def held_out(column: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves remainder ``fold``; false where the id is null."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % folds == fold, F.lit(False))
