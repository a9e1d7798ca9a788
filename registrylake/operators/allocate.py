"""Lease volumes shared out to wells, and productivity per unit."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALT_ROWS = 20_000  # wells of a lease that one task meets with the lease's months


def lease_production(df: DataFrame, lease: list[str], month: str, volume: str) -> DataFrame:
    """Volume per lease and month."""
    return df.groupBy(*lease, month).agg(F.sum(volume).alias(volume))


def merged_spans(spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Spans ``_from`` to ``_to`` (exclusive; null is open) of a key that overlap, as one, with the largest ``_weight`` of theirs.

    Spans of equal start are combined before the shuffle, so a key has as many rows here as the calendar has months.
    """
    by_start = spans.groupBy(*keys, "_from").agg(
        F.max("_to").alias("_to"), F.bool_or(F.col("_to").isNull()).alias("_open"), F.max("_weight").alias("_weight")
    )
    place = Window.partitionBy(*keys).orderBy(F.col("_from").asc_nulls_first())
    before = place.rowsBetween(Window.unboundedPreceding, -1)
    goes_on = F.coalesce(F.max("_open").over(before), F.lit(False)) | F.coalesce(F.max("_to").over(before) > F.col("_from"), F.lit(False))
    marked = by_start.withColumn("_island", (~goes_on).cast("int"))
    marked = marked.withColumn("_island", F.sum("_island").over(place.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return marked.groupBy(*keys, "_island").agg(
        F.when(F.bool_and(F.col("_from").isNotNull()), F.min("_from")).alias("_from"),
        F.when(~F.bool_or("_open"), F.max("_to")).alias("_to"),
        F.max("_weight").alias("_weight"),
    ).drop("_island")


def allocate_to_wells(
    production: DataFrame,
    wells: DataFrame,
    lease: list[str],
    month: str = "month",
    volume: str = "volume",
    well: str = "api10",
    effective: str = "effective_month",
    termination: str = "termination_month",
    method: str = "equal",
    weight: str | None = None,
    salt_rows: int = SALT_ROWS,
) -> DataFrame:
    """Each lease-month's volume over the wells active then: effective <= month < termination.

    ``method``: ``equal``, ``proportional`` (by ``weight`` of the well) or ``single`` (only lease-months
    with one well are given to it). What goes to no well keeps a row with a null well, so shares always
    add up to the lease volume. A well whose spans overlap counts once, with its largest weight; a weight that is unknown,
    negative or infinite takes no part.

    Months meet spans in a join on (lease, salt): the wells of a lease are dealt to one salt for every ``salt_rows`` of them, and the
    lease's months, a calendar of them, go to each salt. The join runs twice, over the same shuffled spans: counts and weights
    per lease-month are summed in the tasks of the first; the second meets them as part of the months. So the long
    rows, one for each lease, month and well, are never shuffled.
    """
    if method not in ("equal", "proportional", "single"):
        raise ValueError(method)
    prod = production.groupBy(*lease, F.col(month).alias("month")).agg(F.sum(volume).alias("volume"))
    spans = wells.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in lease])).select(
        *lease,
        F.col(well).alias("api10"),
        F.col(effective).alias("_from"),
        F.col(termination).alias("_to"),
        (F.col(weight) if method == "proportional" else F.lit(1)).cast("double").alias("_weight"),
    )
    spans = spans.where("_weight >= 0 and _weight < double('infinity') and (_from is null or _to is null or _from < _to)")
    spans = merged_spans(spans, [*lease, "api10"])

    largest = F.max("_weight")
    # weights are taken relative to a power of two near the lease's largest: exact, and no sum of them over- or underflows
    leases = spans.groupBy(*lease).agg(
        F.ceil(F.count(F.lit(1)) / salt_rows).cast("int").alias("_salts"),
        F.when(largest > 0, F.pow(F.lit(2.0), F.floor(F.log2(largest)))).otherwise(1.0).alias("_unit"),
    )
    salt = F.pmod(F.xxhash64("api10", "_from"), F.col("_salts")).cast("int")
    salted = spans.join(leases, lease).select(*lease, salt.alias("_salt"), "api10", "_from", "_to", (F.col("_weight") / F.col("_unit")).alias("_weight"))

    def active(months: DataFrame) -> DataFrame:
        dealt = months.join(leases.select(*lease, "_salts"), lease).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
        met = salted.join(dealt.drop("_salts"), [*lease, "_salt"])
        return met.where("(_from is null or _from <= month) and (_to is null or month < _to)")

    totals = active(prod.select(*lease, "month")).groupBy(*lease, "month").agg(
        F.count(F.lit(1)).alias("n_wells"), F.sum("_weight").alias("_total")
    )
    given = prod.join(totals, [*lease, "month"], "left")
    fits = (F.col("n_wells") == 1) if method == "single" else F.col("_total") > 0
    given = given.withColumn("_given", F.coalesce(fits, F.lit(False)))
    shared = active(given.where("_given")).select(
        *lease, "month", "api10", "n_wells", "volume", (F.col("volume") * F.col("_weight") / F.col("_total")).alias("share")
    )
    rest = given.where("not _given").select(
        *lease,
        "month",
        F.lit(None).cast(wells.schema[well].dataType).alias("api10"),
        F.lit(0).cast("bigint").alias("n_wells"),
        "volume",
        F.col("volume").cast("double").alias("share"),
    )
    return shared.unionByName(rest)


def well_production(shares: DataFrame) -> DataFrame:
    """Monthly production per well over all its leases; what went to no well is left out."""
    wells = shares.where(F.col("api10").isNotNull())
    return wells.groupBy("api10", "month").agg(
        F.sum("share").alias("volume"), F.count(F.lit(1)).alias("n_leases"), F.max("n_wells").alias("largest_lease")
    )


def per_unit(measure: Column, unit: Column) -> Column:
    """Measure per unit (foot, acre); null where the unit is missing or not positive."""
    return F.when(unit > 0, measure / unit)
