"""Key sets, subsets by first appearance, union by name."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_KEYS = 1_000_000


def key_set_difference(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """One row: distinct keys only left, only right, and are the sets equal.

    Both sides are cut to distinct keys, tagged and grouped once, so no join is needed and duplicates
    of a hot key collapse before the shuffle. Null is a key like any other.
    """
    both = (
        left.select(F.col(left_key).alias("k"), F.lit(1).alias("l"), F.lit(0).alias("r"))
        .unionByName(right.select(F.col(right_key).alias("k"), F.lit(0).alias("l"), F.lit(1).alias("r")))
        .groupBy("k")
        .agg(F.max("l").alias("l"), F.max("r").alias("r"))
    )
    return both.agg(
        F.count_if((F.col("l") == 1) & (F.col("r") == 0)).alias("only_left"),
        F.count_if((F.col("l") == 0) & (F.col("r") == 1)).alias("only_right"),
    ).withColumn("sets_equal", F.expr("only_left = 0 and only_right = 0"))


def first_n_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in source order."""
    return df.orderBy(*order).limit(n)


def first_n_keys(df: DataFrame, key: str, order: Sequence[str], n: int) -> DataFrame:
    """All rows of the first ``n`` distinct keys in order of appearance. They are broadcast while few."""
    firsts = df.groupBy(key).agg(F.min(F.struct(*order)).alias("_first"))
    chosen = firsts.orderBy("_first").limit(n).select(F.col(key).alias("_k"))
    if n <= BROADCAST_KEYS:
        chosen = F.broadcast(chosen)
    return df.join(chosen, df[key].eqNullSafe(chosen["_k"]), "left_semi")


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; a column a frame lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
