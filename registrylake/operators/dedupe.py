"""First, latest and k-per-group rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], k: int) -> DataFrame:
    """The first ``k`` rows of each key in ``order`` (a total order). Null keys form a group.

    Spark limits each task to ``k`` rows a key before the shuffle, so a hot key stays small.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= k).drop("_rank")


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the earliest in source order."""
    return k_per_group(df, keys, order, 1)


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last in ``order``."""
    return k_per_group(df, keys, [F.col(c).desc() for c in order], 1)
