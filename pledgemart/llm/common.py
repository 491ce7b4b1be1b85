"""What the operators share: intermediate tables, batch limits, and texts as byte arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from pledgemart.operators.staging import discard, shared_folder, stage  # noqa: F401

#: Python workers get texts in batches of about this many bytes.
BATCH_BYTES = 16 << 20
BATCH_ROWS = 2000


def limit_batches(spark: SparkSession) -> None:
    """Keep the Arrow batches of this session small enough for two workers beside an executor's heap."""
    for key, most in (
        ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES),
        ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
    ):
        now = str(spark.conf.get(key))
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only, found by exact spelling: others may repeat a name in other letters."""
    places = [df.columns.index(name) for name in names]
    return df.toDF(*(f"_{i}" for i in range(len(df.columns)))).select(
        *(F.col(f"_{place}").alias(name) for place, name in zip(places, names, strict=True))
    )


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts behind one another, and where each begins (one more at the end)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_slices(batch: pa.RecordBatch, text: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts take about ``most`` bytes; a longer text is a run of its own."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + most, "right")))
        yield batch.slice(start, end - start)
        start = end


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (the finalizer of the public SplitMix64 generator)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, taken eight bytes at a time over all spans at once."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    lengths = ends - starts
    out = lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    live, at = np.arange(len(starts)), 0
    while len(live):
        left = lengths[live] - at
        chunk = eight[starts[live] + at]
        keep = np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - (8 * np.minimum(left, 8)).astype(np.uint64))
        out[live] = mix(out[live] ^ (chunk & keep))
        at += 8
        live = live[left > 8]
    return out
