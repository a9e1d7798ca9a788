"""Well-to-lease crosswalk."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrylake.functions.dates import numeric_date
from registrylake.functions.text import numeric_or_null


def lease_crosswalk(
    df: DataFrame,
    seq: Sequence[str],
    key: str = "api10",
    lease: str = "lease_name",
    completion: str = "completion",
    record: str = "gas_rrcid",
) -> DataFrame:
    """One row per (well, lease): first and last date, count of records, is it the well's current lease.

    The current lease is the one of the well's last row by date; missing or bad dates sort last and so
    win, equal dates are settled by ``seq``. A current pair has no termination date.

    Rows are combined to pairs in the tasks that read them, with the place of each pair's last row among the
    sums; the last row of a well is that of its last pair. No row travels on its own, whatever the size of a well.
    """
    num = numeric_or_null(F.col(completion))
    rows = df.where(F.col(lease).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("api10"),
        F.col(lease).alias("lease_name"),
        F.col(record).alias("_record"),
        num.alias("_num"),
        F.struct(num.isNull().alias("bad"), num.alias("num"), *seq, F.col(lease).alias("tie")).alias("_place"),
    )
    pairs = rows.groupBy("api10", "lease_name").agg(
        F.min("_num").alias("_first_num"),
        F.max("_num").alias("_last_num"),
        F.count("_record").alias("n_completions"),
        F.max("_place").alias("_place"),
    )
    last = pairs.groupBy("api10").agg(F.max("_place").alias("_last"))
    pairs = pairs.join(last, "api10").withColumn("is_current", F.col("_place").eqNullSafe(F.col("_last")))
    return pairs.select(
        "api10",
        "lease_name",
        numeric_date(F.col("_first_num")).alias("effective_date"),
        F.when(~F.col("is_current"), numeric_date(F.col("_last_num"))).alias("termination_date"),
        "is_current",
        "n_completions",
        F.lit("").alias("district"),
    )
