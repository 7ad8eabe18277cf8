"""Per-task sums over array columns: Arrow batches in, one row per task out."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of fixed width as a matrix, without touching single values."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("float64", copy=False)
    return flat.reshape(len(column), -1)


def summed(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int) -> np.ndarray:
    """Add up the vectors of length ``size`` that ``fn`` makes of each task's batches."""

    def task(batches):
        out = fn(b for b in batches if b.num_rows)
        yield pa.RecordBatch.from_arrays([pa.array([out.tolist()], pa.list_(pa.float64()))], ["s"])

    cells = df.mapInArrow(task, "s array<double>").select(F.posexplode("s").alias("pos", "v"))
    total = np.zeros(size)
    for row in cells.groupBy("pos").agg(F.sum("v").alias("v")).collect():
        total[row["pos"]] = row["v"]
    return total


def parts_for(df: DataFrame, size: float, each: float) -> int:
    """How many parts hold ``each`` of ``size``; one per core at least."""
    return max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(size / each))


def evened(df: DataFrame) -> DataFrame:
    """Spread rows evenly over all cores before many passes over them (one shuffle).

    Their number of parts goes by the cores and by ``spark.sql.shuffle.partitions``, not by
    bytes: a few megabytes may be hours of work.
    """
    spark = df.sparkSession
    return df.repartition(max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


PACK = 8192  # rows of a pack


def packed(df: DataFrame) -> DataFrame:
    """Rows of numbers and arrays of doubles, none NULL, in packs: a column of a pack is one binary value.

    Passes over packs cost what their arithmetic does; single rows cost more in being handed over.
    """
    kinds, names = _kinds(df), df.columns

    def task(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= PACK:
                yield pack(held)
                held, n = [], 0
        if n:
            yield pack(held)

    def pack(held):
        rows = pa.Table.from_batches(held)
        cells = [np.ascontiguousarray(matrix(c).T) if kind is None else c.to_numpy().astype(kind) for c, kind in zip(rows.columns, kinds)]
        return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in cells], names)

    return df.mapInArrow(task, ", ".join(f"`{c}` binary" for c in names))


def unpacked(df: DataFrame) -> Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, ...]]]:
    """What makes of the batches of ``packed(df)`` the arrays of each pack, a matrix for an array column."""
    kinds = _kinds(df)

    def arrays(batches):
        for batch in batches:
            for cells in zip(*batch.columns):
                flat = [np.frombuffer(c.as_buffer(), kind or "f8") for c, kind in zip(cells, kinds)]
                n = min(len(c) for c in flat)  # the columns of one number a row
                yield tuple(c.reshape(-1, n).T if kind is None else c for c, kind in zip(flat, kinds))

    return arrays


def _kinds(df: DataFrame) -> list[str | None]:
    plain = {"double": "f8", "bigint": "i8", "int": "i4"}
    return [plain.get(f.dataType.simpleString()) for f in df.schema]


def spread(df: DataFrame) -> DataFrame:
    """``df``, a scan without exchanges, as it is where its parts keep all cores busy, else ``evened``: a small table comes in few parts."""
    parts = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df if parts >= df.sparkSession.sparkContext.defaultParallelism else evened(df)
