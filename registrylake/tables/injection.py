"""dim_injection_uic and its raw twin."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrylake.functions.keys import injection_key
from registrylake.functions.layout import cut_all, fields
from registrylake.functions.text import rstrip

MIN_LENGTH = 10
RAW_LENGTH = 200
HEADER = "01"

# Record layout (name, 0-based start, length).
LAYOUT = fields(
    ("record_type", 0, 2),
    ("district", 2, 2),
    ("lease_number", 4, 6),
    ("well_type_code", 10, 1),
    ("county_code", 11, 3),
    ("field_number", 14, 8),
    ("operator_number", 22, 6),
    ("api_county", 28, 3),
    ("api_unique", 31, 5),
)


def long_enough(lines: DataFrame) -> DataFrame:
    return lines.where(F.length(rstrip(F.col("value"))) >= MIN_LENGTH)


def injection_raw(lines: DataFrame, run_ts: str) -> DataFrame:
    rows = long_enough(lines).select(
        *cut_all(F.col("value"), LAYOUT), F.substring(rstrip(F.col("value")), 1, RAW_LENGTH).alias("raw_line")
    )
    return rows.withColumns(
        {"api10": injection_key(F.col("api_county"), F.col("api_unique")), "scraped_at": F.lit(run_ts)}
    )


def injection_wells(raw: DataFrame) -> DataFrame:
    """Well headers (type 01) when the file has any, otherwise every row."""
    any_header = raw.agg(F.coalesce(F.bool_or(F.col("record_type") == HEADER), F.lit(False)).alias("any_header")).scalar()
    return raw.where((F.col("record_type") == HEADER) | ~any_header)
