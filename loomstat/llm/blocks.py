"""Packed rows: many small values of one block of documents in one compressed cell.

A shuffle of packed cells moves a few bytes per value instead of a row per value.
Cells are pickled numpy arrays, written and read by these jobs only.
"""

from __future__ import annotations

import contextlib
import ctypes
import pickle

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame


def pack(*parts) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(parts, 5))


def unpack(cell: bytes) -> tuple:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(cell))


def key_of(cell: bytes) -> int:
    """A signed 64-bit key made of the content: the same when a lost task is run again."""
    return xxhash.xxh64_intdigest(cell) - (1 << 63)


def buckets_for(df: DataFrame, per_partition: int = 2) -> int:
    """Buckets of a packed shuffle: some for each of the session's shuffle partitions."""
    return per_partition * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def dealt(bucket: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, edges): entries sorted by bucket, and where each bucket begins in that order."""
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(n + 1))


def smallest(values: np.ndarray) -> np.ndarray:
    """The same whole numbers in the narrowest unsigned type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


def rows_of(batch: pa.RecordBatch):
    """(first, second column) row by row, as Python values for a few hundred rows at a time."""
    for at in range(0, batch.num_rows, 256):
        part = batch.slice(at, 256)
        yield from zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)


def give_back() -> None:
    """Return what a task has freed to the system, as the next task may run in another worker."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def text_packs(batches, size: int):
    """(ids, texts as bytes) for about ``size`` bytes of documents at a time; NULL texts are empty."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for i, t in rows_of(batch):
            ids.append(i)
            texts.append((t or "").encode())
            held += len(texts[-1])
            if held >= size:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts
    give_back()


def cells(names: str, rows: list[tuple]) -> pa.RecordBatch:
    """A batch of (kind, key, block, cell) rows or a part of these columns, in the order of ``names``."""
    types = {"kind": pa.string(), "key": pa.int64(), "block": pa.int64(), "cell": pa.binary()}
    columns = list(zip(*rows, strict=True)) or [()] * len(names.split())
    return pa.RecordBatch.from_arrays([pa.array(c, types[n]) for n, c in zip(names.split(), columns, strict=True)], names.split())
