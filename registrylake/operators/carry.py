"""Parent context carried down a positional record hierarchy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registrylake.plans.ranges import in_packed_ranges, in_ranges, starts
from registrylake.session import materialise, shuffles_dropped

BLOCK = 256  # ranges whose tails one window puts in order
MAX_BROADCAST = 400_000  # ranges, a row each


def _filled(rows: DataFrame, names: Sequence[str], group: Sequence[str]) -> DataFrame:
    """Contexts carried inside each sorted range, with the range's number and marks on the last row of each group in it and on the
    rows of its first group, the only one that an earlier range can have begun."""

    def fill(both: pa.RecordBatch, new: np.ndarray) -> pa.RecordBatch:
        at = np.arange(both.num_rows)
        first = np.maximum.accumulate(np.where(np.r_[True, new], at, 0))
        columns = []
        for name, column in zip(both.schema.names, both.columns, strict=True):
            if name in names:
                last = np.maximum.accumulate(np.where(column.is_valid().to_numpy(zero_copy_only=False), at, -1))
                column = column.take(pa.array(np.maximum(last, 0), mask=last < first))
            columns.append(column)
        return pa.RecordBatch.from_arrays(columns, schema=both.schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, held, at_first = TaskContext.get().partitionId(), None, True  # the last row waits for the next one

        def out(found: pa.RecordBatch, tail: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
            marks = [pa.array(np.full(len(tail), part, np.int32)), pa.array(tail), pa.array(first)]
            return pa.RecordBatch.from_arrays([*found.columns, *marks], [*found.schema.names, "_part", "_tail", "_first"])

        for batch in batches:
            if not batch.num_rows:
                continue
            both = batch if held is None else pa.concat_batches([held, batch])
            new = starts(both, group)
            both = fill(both, new)
            held = both.slice(both.num_rows - 1)
            first = at_first & ~np.logical_or.accumulate(np.r_[False, new])
            at_first = bool(first[-1])
            yield out(both.slice(0, both.num_rows - 1), new, first[:-1])
        if held is not None:
            yield out(held, np.array([True]), np.array([at_first]))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{schema}, _part int, _tail boolean, _first boolean")


def _earlier_tails(tails: DataFrame, names: Sequence[str], group: Sequence[str]) -> DataFrame:
    """What each range starts with: the last value of its first group in the ranges before it, found inside blocks of ranges, then over
    these."""
    tails = tails.withColumn("_block", F.floor(F.col("_part") / BLOCK))
    before = Window.partitionBy(*group, "_block").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    inside = tails.select(*group, "_part", "_block", "_first", *[F.last(n, ignorenulls=True).over(before).alias(n) for n in names])
    blocks = tails.groupBy(*group, "_block").agg(*[F.max_by(n, F.when(F.col(n).isNotNull(), F.col("_part"))).alias(n) for n in names])
    so_far = Window.partitionBy(*group).orderBy("_block") if group else Window.partitionBy(F.lit(0)).orderBy("_block")
    so_far = so_far.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        *[F.col(g).alias(f"_g_{g}") for g in group], F.col("_block").alias("_b"), *[F.last(n, ignorenulls=True).over(so_far).alias(f"_b_{n}") for n in names]
    )
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group], F.col("_block") == F.col("_b"))
    joined = inside.where("_first").join(blocks, same)
    return joined.select(
        *[f"_g_{g}" for g in group], F.col("_part").alias("_p"), *[F.coalesce(F.col(n), F.col(f"_b_{n}")).alias(f"_t_{n}") for n in names]
    )


def carry_forward(
    df: DataFrame,
    index: str,
    contexts: Mapping[str, Column],
    group: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Add each context: its last non-null value at or before the row, in ``index`` order per ``group``.

    A file is one ordered sequence, so a window over it would be one task. Instead the rows are sorted into ranges of about
    equal numbers of rows, whatever the indexes are, and each range is carried alone and written. The last row of each
    (range, group) then tells later ranges what they start with. The records shuffle once, in compressed blocks where ``ranges``
    says how many ranges there are; what was shuffled goes when the carried rows are written.
    """
    names = list(contexts)
    rows = df.withColumns({n: contexts[n] for n in names})
    with shuffles_dropped(df.sparkSession):
        dealt = in_packed_ranges(rows, group, [index], ranges) if ranges else in_ranges(rows, group, [index])
        filled = materialise(_filled(dealt, names, group), "carried", compression="zstd")
    tails = _earlier_tails(filled.where("_tail").select(*group, "_part", "_first", *names), names, group)
    if (ranges or 0) <= MAX_BROADCAST:
        tails = F.broadcast(tails)  # else the carried rows are shuffled before their number is known
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group], F.col("_part") == F.col("_p"))
    joined = filled.join(tails, same, "left")  # a row for each range
    kept = [c for c in df.columns if c not in names]
    return joined.select(*kept, *[F.coalesce(F.col(n), F.col(f"_t_{n}")).alias(n) for n in names])
