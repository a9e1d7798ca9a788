"""Comparison with an authoritative table, and the sample that is compared."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registrylake.operators.dedupe import k_per_group

# Statuses of the comparison.
PASS, FAIL_FIRST, FAIL_SECOND, FAIL_BOTH, NOT_FOUND = (
    "PASS",
    "FAIL_OIL",
    "FAIL_GAS",
    "FAIL_MULTIPLE",
    "NOT_FOUND",
)


def reconcile(
    ours: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    oil: str = "oil_production_bbl",
    gas: str = "casinghead_gas_mcf",
    order: Sequence[str] = (),
) -> DataFrame:
    """Compare two measures exactly with the source row of the same key.

    Of several source rows of a key the first in ``order`` counts; without one, the smallest in (oil, gas).
    """
    measures = F.struct(F.col(oil).alias("oil"), F.col(gas).alias("gas"))
    asked = ours.select(*keys).distinct()  # a sample asks for few keys: the others are not sorted and combined for nothing
    theirs = source.join(asked, list(keys), "left_semi").groupBy(*keys).agg(F.min_by(measures, F.struct(*(order or (oil, gas)))).alias("_s"))
    theirs = theirs.select(
        *keys, F.col("_s.oil").alias("source_oil"), F.col("_s.gas").alias("source_gas"), F.lit(True).alias("_found")
    )
    joined = ours.select(*keys, F.col(oil).alias("parsed_oil"), F.col(gas).alias("parsed_gas")).join(
        theirs, list(keys), "left"
    )
    same_oil = F.col("parsed_oil").eqNullSafe(F.col("source_oil"))
    same_gas = F.col("parsed_gas").eqNullSafe(F.col("source_gas"))
    status = (
        F.when(F.col("_found").isNull(), NOT_FOUND)
        .when(same_oil & same_gas, PASS)
        .when(~same_oil & ~same_gas, FAIL_BOTH)
        .when(~same_oil, FAIL_FIRST)
        .otherwise(FAIL_SECOND)
    )
    return joined.withColumn("status", status).drop("_found")


def volume_band(oil: Column, gas: Column, high: int = 100_000, low: int = 10, gas_ratio: int = 10) -> Column:
    """Band of a lease-month: large, gas-dominant, small, or moderate."""
    return (
        F.when(oil > high, "HIGH")
        .when(gas > gas_ratio * oil, "GAS_DOM")
        .when(oil < low, "LOW")
        .otherwise("MODERATE")
    )


def stratified_sample(df: DataFrame, strata: Sequence[str], identity: Sequence[str], k: int, seed: int = 0) -> DataFrame:
    """``k`` rows per stratum, the same ones on every run: lowest hash of the identity columns first."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in identity])
    return k_per_group(df.withColumn("_pick", F.md5(text)), strata, ["_pick", *identity], k).drop("_pick")


def sample_coverage(sample: DataFrame, population: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """How many of each dimension's values the sample reaches: one row per dimension."""
    parts = []
    for d in dimensions:
        reached = sample.where(F.col(d).isNotNull()).select(d).distinct().withColumn("_hit", F.lit(True))
        known = population.where(F.col(d).isNotNull()).select(d).distinct()
        counts = known.join(reached, d, "left").agg(
            F.count("_hit").alias("n_sampled"), F.count(F.lit(1)).alias("n_known")
        )
        parts.append(counts.select(F.lit(d).alias("dimension"), "n_sampled", "n_known"))
    return reduce(DataFrame.unionAll, parts)
