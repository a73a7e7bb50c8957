"""Counts of 64-bit values in a table of fixed size, gathered from all tasks in two steps.

A value counts in the slot of its low bits, so a slot is an upper bound of its values' counts.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 16
SPREAD = 8
_SCHEMA = "chunk int, salt int, counts binary"


def _pack(counts: np.ndarray) -> bytes:
    kind = np.uint8 if counts.max() < 256 else np.uint32
    return bytes([np.dtype(kind).itemsize]) + zlib.compress(counts.astype(kind).tobytes(), 1)


def _unpack(blob: bytes) -> np.ndarray:
    kind = {1: np.uint8, 4: np.uint32}[blob[0]]
    return np.frombuffer(zlib.decompress(blob[1:]), kind)


def _rows(chunks: dict[int, np.ndarray], salt: int) -> Iterator[pa.RecordBatch]:
    for chunk, counts in chunks.items():
        if counts.any():
            yield pa.RecordBatch.from_pydict(
                {
                    "chunk": pa.array([chunk], pa.int32()),
                    "salt": pa.array([salt], pa.int32()),
                    "counts": pa.array([_pack(counts)], pa.binary()),
                }
            )


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, blob in zip(batch["chunk"].to_pylist(), batch["counts"].to_pylist(), strict=True):
            counts = _unpack(blob).astype(np.int64)
            total[chunk] = total[chunk] + counts if chunk in total else counts
    limit = np.iinfo(np.uint32).max
    yield from _rows({c: np.minimum(t, limit) for c, t in total.items()}, 0)


def count_values(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], Iterator[np.ndarray]]],
    bits: int,
    convert: Callable[[np.ndarray], np.ndarray] | None = None,
) -> np.ndarray:
    """Counts of all values that ``make()`` yields for the batches of ``df``, in 2**bits slots.

    Values are unsigned hashes, or signed numbers of slots as they are.
    The table that comes to the driver has that size whatever the input. ``convert`` makes bytes of
    counts, zero of zero, in the tasks: the driver then holds one byte a slot.
    """
    slots = 1 << bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call, total = make(), np.zeros(slots, np.uint32)
        for batch in batches:
            for values in call(batch):
                if not len(values):
                    continue
                slot_numbers = values.dtype == np.int64
                low = values if slot_numbers else (values & np.uint64(slots - 1)).astype(np.int64)
                first, last = int(low.min()), int(low.max())
                if last - first > 4 * len(low):
                    np.add.at(total, low, np.uint32(1))
                else:
                    counts = np.bincount(low - first)
                    total[first : last + 1] += counts.astype(np.uint32)
        width = min(CHUNK, slots)
        parts = total.reshape(-1, width)
        yield from _rows(dict(enumerate(parts)), 0)

    partial = df.mapInArrow(run, _SCHEMA)
    spread = partial.withColumn("salt", F.spark_partition_id() % SPREAD)
    once = spread.repartition("chunk", "salt").mapInArrow(_merge, _SCHEMA)
    merged = once.repartition("chunk").mapInArrow(_merge, _SCHEMA)
    if convert is not None:
        merged = merged.mapInArrow(_converted(convert), _SCHEMA)
    width = min(CHUNK, slots)
    out = np.zeros(slots, np.uint32 if convert is None else convert(np.zeros(1, np.uint32)).dtype)
    # Arrow's batches hold the bytes once; rows of Python objects would hold them several times.
    found = merged.toArrow()
    for chunk, blob in zip(found["chunk"], found["counts"], strict=True):
        at = chunk.as_py() * width
        out[at : at + width] = _unpack(blob.as_py())
    return out


def _converted(convert: Callable[[np.ndarray], np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob in zip(batch["chunk"].to_pylist(), batch["counts"].to_pylist(), strict=True):
                yield from _rows({chunk: convert(_unpack(blob))}, 0)

    return run


def as_levels(counts: np.ndarray) -> np.ndarray:
    """Counts on a scale of eight steps for each doubling, a byte each; zero stays zero."""
    return np.round(8 * np.log2(1.0 + counts)).astype(np.uint8)


def is_any(counts: np.ndarray) -> np.ndarray:
    return (counts > 0).astype(np.uint8)


def mean_count(levels: np.ndarray) -> int:
    """Mean of the counts that ``levels`` stand for, from how often each level occurs."""
    times = np.zeros(256, np.int64)
    for i in range(0, len(levels), CHUNK):
        times += np.bincount(levels[i : i + CHUNK], minlength=256)
    return int(times @ from_levels(np.arange(256)) / max(len(levels), 1))


def from_levels(levels: np.ndarray) -> np.ndarray:
    return np.exp2(levels / 8) - 1
