"""Operator tenure: gaps and islands over each well's completions."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registrylake.functions.text import numeric_or_null
from registrylake.plans.ranges import in_ranges, starts

SPREAD = 1 << 16


def _runs(rows: DataFrame) -> DataFrame:
    """The runs of one operator in a sorted range, each as its first row.

    ``_next`` is the date of the well's next run, ``_has_next`` whether there is one. The range's first run may go on from the range
    before (``_left``), and what follows its last run is in the ranges after it (``_right``).
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, left = None, True  # the run that is still open
        for batch in batches:
            if not batch.num_rows:
                continue
            both = batch if held is None else pa.concat_batches([held, batch])
            first = np.flatnonzero(np.r_[True, starts(both, ["api10", "operator_name"])])
            runs = both.take(pa.array(first))
            held = runs.slice(runs.num_rows - 1)
            if runs.num_rows > 1:
                yield closed(runs, left)
                left = False
        if held is not None:
            yield flagged(held, pa.nulls(1, held.schema.field("effective_date").type), [False], left, True)

    def closed(runs: pa.RecordBatch, left: bool) -> pa.RecordBatch:
        n = runs.num_rows - 1
        same = ~starts(runs, ["api10"])
        dates = runs.column("effective_date").take(pa.array(np.arange(1, n + 1), mask=~same))
        return flagged(runs.slice(0, n), dates, same, left, False)

    def flagged(runs: pa.RecordBatch, dates: pa.Array, same: Sequence[bool], left: bool, right: bool) -> pa.RecordBatch:
        n = runs.num_rows
        marks = [dates, pa.array(same, pa.bool_()), pa.array([left] + [False] * (n - 1)), pa.array([right] * n)]
        return pa.RecordBatch.from_arrays([*runs.columns, *marks], [*runs.schema.names, "_next", "_has_next", "_left", "_right"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{schema}, _next {rows.schema['effective_date'].dataType.simpleString()}, _has_next boolean, _left boolean, _right boolean")


def _joined(runs: DataFrame, order: Sequence[str]) -> DataFrame:
    """Runs cut by ranges put together again.

    Only runs at the ends of ranges take part, at most two per range, by well. All others are final; in the same window they
    are spread evenly and come through as they are.
    """
    edge = F.col("_left") | F.col("_right")
    runs = runs.withColumns({
        "_edge": edge,
        "_well": F.when(edge, F.col("api10")),
        "_lot": F.when(~edge, F.pmod(F.xxhash64("api10", *order), F.lit(SPREAD))),
    })
    up = Window.partitionBy("_well", "_lot").orderBy(*order)
    down = Window.partitionBy("_well", "_lot").orderBy(*[F.desc(c) for c in order])
    before = F.lag(F.struct("operator_name", "_right")).over(up)
    goes_on = F.col("_left") & before["_right"] & (before["operator_name"] == F.col("operator_name"))
    runs = runs.withColumn("_goes_on", F.coalesce(goes_on, F.lit(False)) & F.col("_edge"))
    # the row after it, seen from the last piece of a run
    follower = F.lag(F.struct("effective_date", "_goes_on")).over(down)
    seen = F.when(F.col("_right"), F.struct(follower.isNotNull().alias("has"), follower["effective_date"].alias("date"))).otherwise(
        F.struct(F.col("_has_next").alias("has"), F.col("_next").alias("date"))
    )
    last_piece = F.when(~F.coalesce(follower["_goes_on"], F.lit(False)), seen)
    runs = runs.withColumn("_end", last_piece)
    ends = F.last("_end", ignorenulls=True).over(down.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = runs.withColumn("_after", ends).where("not _goes_on")
    return runs.withColumns({
        "_has_next": F.when(F.col("_edge"), F.col("_after.has")).otherwise(F.col("_has_next")),
        "_next": F.when(F.col("_edge"), F.col("_after.date")).otherwise(F.col("_next")),
    })


def operator_tenure(
    df: DataFrame,
    seq: Sequence[str],
    key: str = "api10",
    operator: str = "operator",
    completion: str = "completion",
    lease: str = "lease_name",
    ranges: int | None = None,
) -> DataFrame:
    """One row per unbroken stay of an operator on a well.

    Rows are ordered by the completion date as a number, with missing or bad dates first, then by
    ``seq``, a total order with the date. Rows without operator or key do not count. A stay ends on the raw date of the first row of
    the next one; the last stay is current. An operator that comes back starts a new stay.

    Rows shuffle once, into ``ranges`` of (well, order). A range yields its runs of one operator; its first and last run are joined
    with those of the neighbouring ranges. Wells of any size go the same way, and nothing runs before the result is asked for.
    """
    rows = df.where(F.col(operator).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("api10"),
        F.col(operator).alias("operator_name"),
        F.col(completion).alias("effective_date"),
        F.coalesce(F.col(lease), F.lit("")).alias("lease_number"),
        F.coalesce(numeric_or_null(F.col(completion)), F.lit(0.0)).alias("_ord"),
        *[F.col(c).alias(f"_seq{i}") for i, c in enumerate(seq)],
    )
    order = ["_ord", *[f"_seq{i}" for i in range(len(seq))]]
    stays = _joined(_runs(in_ranges(rows, ["api10"], order, ranges)), order)
    return stays.select(
        "api10",
        F.lit("").alias("operator_number"),
        "operator_name",
        "effective_date",
        F.col("_next").alias("termination_date"),
        (~F.col("_has_next")).alias("is_current"),
        "lease_number",
        F.lit("").alias("district"),
    )


def multiple_current(history: DataFrame, key: str = "api10") -> DataFrame:
    """Keys with more than one current row (a correct history has none)."""
    return (
        history.where("is_current")
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_current"))
        .where("n_current > 1")
    )
