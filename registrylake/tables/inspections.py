"""fact_inspections: delimited rows with a derived well key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrylake.functions.keys import inspection_key


def inspections(rows: DataFrame, run_ts: str) -> DataFrame:
    """All columns as read; ``api10`` only where there is an ``api_no`` column."""
    if "api_no" in rows.columns:
        rows = rows.withColumn("api10", inspection_key(F.col("api_no")))
    return rows.withColumn("scraped_at", F.lit(run_ts))
