"""Distributions, distinct counts, column volatility, coverage counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def type_distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("record_type")).agg(F.count(F.lit(1)).alias("n_records"))


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """One row per column: distinct non-null values.

    Each column is reduced to its own distinct values, instead of expanding every row once a column.
    """
    if approximate:
        one = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_distinct")) for c in columns])
        return one.select(F.inline(pairs))
    parts = [
        df.select(c).distinct().agg(F.count(c).alias("n_distinct")).select(F.lit(c).alias("column_name"), "n_distinct")
        for c in columns
    ]
    return reduce(DataFrame.unionAll, parts)


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), bits: int = 14) -> DataFrame:
    """(by, column_name, sketch): a sketch of the distinct non-null values of each column, for each group.

    Sketches of a few KB are kept beside the rows they describe and merged later, so coverage over many versions, years or
    tables needs no second look at any row. With 14 bits counts are right to about 1 %.
    """
    one = df.groupBy(*by).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), bits).alias(f"_{c}") for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_{c}").alias("sketch")) for c in columns])
    return one.select(*by, F.inline(pairs))


def merged_counts(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, column_name, n_distinct): distinct values over all sketches of a column."""
    return sketches.groupBy(*by, "column_name").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))


def column_volatility(df: DataFrame, key: str, columns: Sequence[str], limit: float = 0.01) -> DataFrame:
    """Which columns describe the entity and which its events?

    A column varies in a key when it has two different non-null values there, that is when the least and the largest of their
    hashes differ, in one of two independent hashes of 64 bits. Hashes have a fixed width, so Spark combines them in hash aggregates
    before the shuffle, whatever the columns hold. Shares are over keys with several rows.
    """

    def hashes(c: str) -> list[Column]:
        known = F.col(c).isNotNull()
        return [F.when(known, F.xxhash64(c)), F.when(known, F.xxhash64(F.lit("other"), c))]

    extremes = [x for c in columns for i, h in enumerate(hashes(c)) for x in (F.min(h).alias(f"_min{i}_{c}"), F.max(h).alias(f"_max{i}_{c}"))]
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *extremes).where("_n > 1")
    varies = [(F.col(f"_min0_{c}") != F.col(f"_max0_{c}")) | (F.col(f"_min1_{c}") != F.col(f"_max1_{c}")) for c in columns]
    totals = per_key.agg(F.count(F.lit(1)).alias("_keys"), *[F.count_if(v).alias(c) for c, v in zip(columns, varies, strict=True)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("varying_keys")) for c in columns])
    share = F.col("varying_keys") / F.when(F.col("multi_row_keys") > 0, F.col("multi_row_keys"))
    return (
        totals.select(F.col("_keys").alias("multi_row_keys"), F.inline(rows))
        .withColumn("varying_share", F.coalesce(share, F.lit(0.0)))
        .withColumn(
            "column_class", F.when(F.col("varying_share") < limit, "well_property").otherwise("event_property")
        )
    )


def coverage_counts(measures: Mapping[str, tuple[DataFrame, Column | None]]) -> DataFrame:
    """One row per dimension: row count, or distinct non-null values of a column."""
    parts = []
    for name, (df, column) in measures.items():
        if column is None:
            counted = df.agg(F.count(F.lit(1)).alias("value"))
        else:
            counted = df.select(column.alias("_v")).distinct().agg(F.count("_v").alias("value"))
        parts.append(counted.select(F.lit(name).alias("dimension"), "value"))
    return reduce(DataFrame.unionAll, parts)
