"""Which wells a lease has, and since when: what lease volumes are shared out by."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEASE = ("district", "lease_number")


def month_number(date: Column) -> Column:
    """``2021-05-17`` to 202105; null for anything else."""
    return F.when(date.rlike("^[0-9]{4}-[0-9]{2}"), F.concat(F.substring(date, 1, 4), F.substring(date, 6, 2)).cast("int"))


def lease_well_bridge(members: DataFrame, crosswalk: DataFrame, lease: Sequence[str] = LEASE, well: str = "api10") -> DataFrame:
    """One row per (lease, well) with ``effective_month`` and ``termination_month`` (exclusive), numbers like 202105 or null.

    ``members`` names wells and their leases, as often as it likes; rows without a lease or a well name none. The months are those of
    the well's first and last crosswalk row; a well that has a lease now has no end, and one the crosswalk does
    not know (``is_dated`` false) is open on both sides.
    """
    named = [F.trim(F.col(c).cast("string")) != "" for c in (*lease, well)]
    pairs = members.where(F.coalesce(*[F.when(~n | n.isNull(), F.lit(False)) for n in named], F.lit(True)))
    pairs = pairs.select(*lease, F.col(well).alias("api10")).distinct()
    life = crosswalk.groupBy("api10").agg(
        F.min(month_number(F.col("effective_date"))).alias("effective_month"),
        F.when(~F.bool_or("is_current"), F.max(month_number(F.col("termination_date")))).alias("termination_month"),
        F.lit(True).alias("is_dated"),
    )
    joined = pairs.join(life, "api10", "left")
    return joined.select(*lease, "api10", "effective_month", "termination_month", F.coalesce("is_dated", F.lit(False)).alias("is_dated"))


def bridge_coverage(production: DataFrame, bridge: DataFrame, lease: Sequence[str] = LEASE, volume: str = "volume") -> DataFrame:
    """One row: leases that produced, those the bridge knows, those with one well, and the volumes of all three.

    Volumes and wells collapse to leases before the join.
    """
    produced = production.groupBy(*lease).agg(F.sum(volume).alias("_volume"))
    wells = bridge.groupBy(*lease).agg(F.count_distinct("api10").alias("_wells"))
    joined = produced.join(wells, list(lease), "left")
    known, alone = F.col("_wells") >= 1, F.col("_wells") == 1
    nothing = F.lit(0).cast(produced.schema["_volume"].dataType)
    return joined.agg(
        F.count(F.lit(1)).alias("n_leases"),
        F.count_if(known).alias("n_bridged"),
        F.count_if(alone).alias("n_single_well"),
        F.coalesce(F.sum("_volume"), nothing).alias("volume"),
        F.coalesce(F.sum(F.when(known, F.col("_volume"))), nothing).alias("volume_bridged"),
        F.coalesce(F.sum(F.when(alone, F.col("_volume"))), nothing).alias("volume_single_well"),
    )
