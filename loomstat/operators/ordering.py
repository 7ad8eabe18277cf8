"""Positions, prefix sums and neighbours in a total order over all rows.

A window without ``partitionBy`` moves every row to one task.  Here the rows go to
sorted ranges by one exchange, each range is walked by itself in Arrow batches and
written once.  Only the group that a range begins with can have begun before it, so
one small row per range carries what came before; it is joined to the written rows
by broadcast (there are no more such rows than shuffle partitions).
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from loomstat.session import cut_lineage

_PART = "_part"
_KEY = "_key"  # (by..., bucket) as one struct: NULL groups join like any other
_RANGE, _AT, _LEAD, _GROUP = "_range", "_at", "_lead", "_group"


def _differs(values: pa.Array, before: pa.Array) -> np.ndarray:
    """Row by row: not the same value, where NULL is NULL and NaN is NaN."""
    if pa.types.is_nested(values.type):
        return np.array([x != y for x, y in zip(values.to_pylist(), before.to_pylist())], dtype=bool)
    unlike = pc.if_else(pc.and_(values.is_valid(), before.is_valid()), pc.not_equal(values, before), pc.xor(values.is_valid(), before.is_valid()))
    out = unlike.fill_null(False).to_numpy(zero_copy_only=False)
    if pa.types.is_floating(values.type):
        both = pc.and_(pc.is_nan(values), pc.is_nan(before)).fill_null(False)
        out = out & ~both.to_numpy(zero_copy_only=False)
    return out


def _summed(values: pa.Array, edges: list[int], carry) -> pa.Array:
    """Inclusive sums from edge to edge, the first stretch going on from ``carry``; NULL until a value was seen."""
    if pa.types.is_decimal(values.type):
        plus = lambda a, b: a if b is None else b if a is None else a + b
        cells, out = values.to_pylist(), []
        for lo, hi in zip(edges, edges[1:]):
            out += list(accumulate([carry if lo == 0 else None, *cells[lo:hi]], plus))[1:]
        return pa.array(out, values.type)
    valid = values.is_valid().to_numpy(zero_copy_only=False)
    cells = values.fill_null(0).to_numpy(zero_copy_only=False)
    out, unseen = np.empty_like(cells), np.zeros(len(cells), dtype=bool)
    for lo, hi in zip(edges, edges[1:]):
        known = carry if lo == 0 else None
        np.cumsum(cells[lo:hi], out=out[lo:hi])
        if known is not None:
            out[lo:hi] += known
        elif not valid[lo]:
            unseen[lo:hi] = ~np.logical_or.accumulate(valid[lo:hi])
    return pa.array(out, values.type, mask=unseen)


def _walk(by: list[str], sums: list[str], lags: list[str]):
    """Arrow kernel over one sorted range: place, whether the row's group is the range's first, sums, previous values."""

    def task(batches):
        number, at, lead, before, carried = TaskContext.get().partitionId(), 0, True, None, {}
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            cells = dict(zip(batch.schema.names, batch.columns))
            ahead = {c: pa.concat_arrays([before[c] if before else pa.nulls(1, cells[c].type), cells[c][:-1]]) for c in {*by, *lags}}
            fresh = np.zeros(n, dtype=bool)
            for c in by:
                fresh |= _differs(cells[c], ahead[c])
            if before is None:
                fresh[0] = False
            starts = np.flatnonzero(fresh).tolist()
            edges = sorted({0, *starts, n})
            if fresh[0]:
                carried = {}
            first = np.full(n, lead)
            first[starts[0] if starts else n :] = False
            lead = lead and not starts
            added = [pa.array(np.full(n, number, dtype=np.int32)), pa.array(np.arange(at, at + n)), pa.array(first)]
            for c in sums:
                total = _summed(cells[c], edges, carried.get(c))
                carried[c] = total[-1].as_py()
                added.append(total)
            new = pa.array(fresh)
            added += [pc.if_else(new, pa.nulls(n, cells[c].type), ahead[c]) for c in lags]
            at, before = at + n, {c: cells[c][-1:] for c in ahead} or {"": None}
            names = [_RANGE, _AT, _LEAD, *[f"_s_{c}" for c in sums], *[f"_l_{c}" for c in lags]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *names])

    return task


def _walked(df: DataFrame, order_by, by: list[str], sums: list[str], lags: list[str]) -> tuple[DataFrame, DataFrame]:
    """The written ranges, and for those that begin inside a group: the group's sums and last values before them."""
    added = [StructField(_RANGE, IntegerType()), StructField(_AT, LongType()), StructField(_LEAD, BooleanType())]
    added += [StructField(f"_s_{c}", df.schema[c].dataType) for c in sums] + [StructField(f"_l_{c}", df.schema[c].dataType) for c in lags]
    ordered = df.repartitionByRange(*by, *order_by).sortWithinPartitions(*by, *order_by)
    rows = cut_lineage(ordered.mapInArrow(_walk(by, sums, lags), StructType([*df.schema.fields, *added])))

    group = F.struct(F.lit(0).alias("_"), *by)
    last = F.struct(group.alias(_GROUP), *[F.col(f"_s_{c}").alias(f"s_{c}") for c in sums], *[F.col(c).alias(f"l_{c}") for c in lags])
    ends = rows.groupBy(_RANGE).agg(F.min_by(group, _AT).alias("first"), F.max_by(last, _AT).alias("last"))
    so_far = Window.partitionBy(F.col("last")[_GROUP]).orderBy(_RANGE)
    known = [F.sum(F.col("last")[f"s_{c}"]).over(so_far).cast(df.schema[c].dataType).alias(f"s_{c}") for c in sums]
    ends = ends.select(_RANGE, "first", F.struct(F.col("last")[_GROUP].alias(_GROUP), *known, *[F.col("last")[f"l_{c}"].alias(f"l_{c}") for c in lags]).alias("last"))
    ends = ends.withColumn("before", F.lag("last").over(Window.orderBy(_RANGE)))
    return rows, ends.where(F.col("before")[_GROUP].eqNullSafe(F.col("first"))).select(_RANGE, "before")


def running_totals(df: DataFrame, order_by, totals: dict[str, Column], by=(), with_total: bool = False) -> DataFrame:
    """Add inclusive prefix sums of ``totals`` along ``order_by``, per ``by`` group.

    ``order_by`` must order the rows of a group without ties.  NULL values add nothing;
    a sum is NULL until a value was seen.  With ``with_total`` the sum over the whole
    group is added as ``<name>_total``.
    """
    order_by, by = list(order_by), list(by)
    held = {name: f"_x_{name}" for name in totals}
    kinds = df.agg(*[F.sum(expr).alias(held[n]) for n, expr in totals.items()]).schema
    valued = df.select("*", *[expr.cast(kinds[held[n]].dataType).alias(held[n]) for n, expr in totals.items()])
    rows, before = _walked(valued, order_by, by, list(held.values()), [])

    def total_of(h: str) -> Column:
        local, earlier = F.col(f"_s_{h}"), F.col("before")[f"s_{h}"]
        return F.when(F.col(_LEAD), F.coalesce(local + earlier, local, earlier)).otherwise(local).cast(kinds[h].dataType)

    joined = rows.join(F.broadcast(before), _RANGE, "left")
    out = [*df.columns, *[total_of(h).alias(n) for n, h in held.items()]]
    if not with_total:
        return joined.select(*out)
    sums = [F.sum(h).alias(f"{n}_total") for n, h in held.items()]
    if not by:
        whole = rows.agg(*sums)
        row = whole.select(F.struct(*whole.columns)).scalar()
        return joined.select(*out, *[row[c].alias(c) for c in whole.columns])
    group = F.struct(*by).alias(_GROUP)
    return joined.withColumn(_GROUP, group).join(rows.groupBy(group).agg(*sums), _GROUP).select(*out, *[f"{n}_total" for n in held])


def ordered_rank(df: DataFrame, order_by, out: str = "rn", by=(), with_total: bool = False) -> DataFrame:
    """1-based position of each row along ``order_by``, per ``by`` group."""
    return running_totals(df, order_by, {out: F.lit(1).cast("bigint")}, by, with_total)


def previous_values(df: DataFrame, order_by, cols: list[str], by=()) -> DataFrame:
    """Add ``prev_<col>``: the value in the row before, across range borders too."""
    rows, before = _walked(df, list(order_by), list(by), [], list(cols))
    joined = rows.join(F.broadcast(before), _RANGE, "left")
    prev = [F.when(F.col(_AT) == 0, F.col("before")[f"l_{c}"]).otherwise(F.col(f"_l_{c}")).alias(f"prev_{c}") for c in cols]
    return joined.select(*df.columns, *prev)


def hashed_rank(df: DataFrame, hash_col: str, by=(), ties=(), out: str = "rn", total: str | None = None, digits: int = 3) -> DataFrame:
    """1-based position along a column of hex hashes, per ``by`` group.

    Hashes spread evenly, so their first ``digits`` digits cut even a group that
    holds most of the rows into 16**digits even buckets.  The cut is a function
    of the row alone: nothing needs to be written.
    """
    by, ties = list(by), list(ties)
    keyed = df.withColumn(_KEY, F.struct(*by, F.substring(hash_col, 1, digits).alias(_PART)))
    sizes = keyed.groupBy(_KEY).agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*[F.col(_KEY)[b] for b in by])
    earlier = group.orderBy(F.col(_KEY)[_PART]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        _KEY,
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        *([F.sum("_n").over(group).alias(total)] if total else []),
    )
    within = Window.partitionBy(_KEY).orderBy(hash_col, *ties)
    ranked = keyed.withColumn("_local", F.row_number().over(within)).join(offsets, _KEY)
    return ranked.select(*df.columns, (F.col("_before") + F.col("_local")).alias(out), *([total] if total else []))
