"""fact_well_production_monthly: lease volumes shared out to the wells of the bridge."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrylake.operators.allocate import allocate_to_wells, well_production
from registrylake.operators.bridge import LEASE

MEASURES = ("oil_production_bbl", "casinghead_gas_mcf")


def well_months(monthly: DataFrame, wells: DataFrame) -> DataFrame:
    """One row per well and month: both measures by equal shares, leases it has then, and wells of the largest of these."""
    parts = []
    for measure in MEASURES:
        shares = well_production(allocate_to_wells(monthly, wells, list(LEASE), volume=measure))
        parts.append(shares.withColumn("measure", F.lit(measure)))
    return reduce(DataFrame.unionByName, parts).groupBy("api10", "month").agg(
        *[F.sum(F.when(F.col("measure") == m, F.col("volume"))).alias(m) for m in MEASURES],
        F.max("n_leases").alias("n_leases"),
        F.max("largest_lease").alias("largest_lease"),
    )
