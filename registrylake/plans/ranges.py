"""Rows in a total order, cut into ranges that tasks solve alone.

A hash shuffle sends all rows of a key to one task, so an ordered operation per key is as slow as its largest key. Here rows are
sorted by (keys, order) into ranges instead: bounds come from a sample of the data, a large key is several ranges, and each
task goes once over its range in Arrow batches. What a range cannot know alone is about its first and its last key only, and is
settled afterwards from a row or two per range.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SAMPLED = 60  # rows for a range, about; tasks take three times that, as their sizes differ
BLOCK_BYTES = 32 << 20
#: Types that Arrow and Spark put in the same order.
ORDERED = {"tinyint", "smallint", "int", "bigint", "boolean", "string", "date", "timestamp"}


def in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], ranges: int | None = None) -> DataFrame:
    """``df`` sorted by (keys, order) in ranges of about equal size: ``ranges`` of them, or as many as a shuffle has.

    The order must be a total one per key, so that a key whose order values all tie can be cut too.
    """
    columns = [*keys, *order]
    dealt = df.repartitionByRange(ranges, *columns) if ranges else df.repartitionByRange(*columns)
    return dealt.sortWithinPartitions(*columns)


def starts(batch: pa.RecordBatch, columns: Sequence[str]) -> np.ndarray:
    """For each row but the first, whether any of the columns differs from the row above; nulls are equal."""
    differs = np.zeros(batch.num_rows - 1, bool)
    for name in columns:
        column = batch.column(name)
        above, here = column.slice(0, len(column) - 1), column.slice(1)
        unlike = pc.fill_null(pc.not_equal(above, here), False)
        unlike = pc.or_(unlike, pc.not_equal(pc.is_null(above), pc.is_null(here)))
        differs |= unlike.to_numpy(zero_copy_only=False)
    return differs


def in_packed_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], ranges: int) -> DataFrame:
    """``in_ranges`` with a far smaller shuffle: what a task sends to a range goes as compressed blocks of rows, not as rows.

    Bounds come from a sample of each task's rows. Sorting is left to Spark, which can spill. Keys of types that Arrow orders in
    another way are dealt row by row.
    """
    columns = [*keys, *order]
    if not all(df.schema[c].dataType.simpleString() in ORDERED for c in columns):
        return in_ranges(df, keys, order, ranges)
    bounds = _bounds(df.select(*columns), ranges)
    dealt = df.mapInArrow(lambda batches: _packed(batches, bounds), "_range int, _block binary").repartitionById(ranges, "_range")
    return dealt.mapInArrow(_unpacked, df.schema).sortWithinPartitions(*columns)


def _bounds(rows: DataFrame, ranges: int) -> pa.Table:
    """The last key of each range but the last one, as a sample tells it."""
    names = rows.columns
    per_task = max(1, -(-3 * SAMPLED * ranges // max(1, rows.rdd.getNumPartitions())))

    def sample(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rng, n, kept, drawn = np.random.default_rng(TaskContext.get().partitionId()), 0, None, np.empty(0)
        for batch in batches:  # the rows with the smallest random numbers are a sample, wherever the task ends
            n += batch.num_rows
            drawn = np.r_[drawn, rng.random(batch.num_rows)]
            here = pa.Table.from_batches([batch])
            kept = here if kept is None else pa.concat_tables([kept, here])
            least = np.argsort(drawn)[:per_task]
            kept, drawn = kept.take(pa.array(least)), drawn[least]
        if kept is not None and kept.num_rows:
            share = pa.array(np.full(kept.num_rows, n / kept.num_rows))
            yield from kept.append_column("_weight", share).combine_chunks().to_batches()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    found = rows.mapInArrow(sample, f"{schema}, _weight double").toArrow()
    found = found.take(pc.sort_indices(found, sort_keys=[(n, "ascending") for n in names], null_placement="at_start"))
    weights = np.cumsum(found.column("_weight").to_numpy())
    at = np.searchsorted(weights, weights[-1] * np.arange(1, ranges) / ranges) if len(weights) else np.empty(0, np.int64)
    return found.select(names).take(pa.array(at, pa.int64()))


def _range_of(rows: pa.Table, bounds: pa.Table) -> np.ndarray:
    """How many bounds are below each row."""
    names, n = bounds.column_names, rows.num_rows
    both = pa.concat_tables([rows.select(names), bounds.cast(rows.select(names).schema)])
    is_bound = np.arange(n + bounds.num_rows) >= n
    both = both.append_column("_bound", pa.array(is_bound))
    order = pc.sort_indices(both, sort_keys=[(c, "ascending") for c in [*names, "_bound"]], null_placement="at_start").to_numpy()
    below = np.empty(len(order), np.int32)
    below[order] = np.cumsum(is_bound[order])
    return below[:n]


def _packed(batches: Iterable[pa.RecordBatch], bounds: pa.Table) -> Iterator[pa.RecordBatch]:
    codec, held, size = pa.Codec("zstd", compression_level=3), [], 0

    def blocks() -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        part = _range_of(rows, bounds)
        order = np.argsort(part, kind="stable")
        rows, part = rows.take(pa.array(order)), part[order]
        edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema) as out:
                out.write_table(rows.slice(start, end - start).combine_chunks())
            plain = sink.getvalue()
            block = plain.size.to_bytes(8, "little") + codec.compress(plain, asbytes=True)
            yield pa.RecordBatch.from_arrays([pa.array([part[start]], pa.int32()), pa.array([block], pa.binary())], ["_range", "_block"])

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= BLOCK_BYTES:
            yield from blocks()
            held, size = [], 0
    if held:
        yield from blocks()


def _unpacked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codec = pa.Codec("zstd")
    for batch in batches:
        for block in batch.column(batch.schema.get_field_index("_block")):
            data = block.as_buffer()
            plain = codec.decompress(data.slice(8), int.from_bytes(data.slice(0, 8).to_pybytes(), "little"))
            yield from pa.ipc.open_stream(plain)
