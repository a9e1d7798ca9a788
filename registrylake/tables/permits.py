"""dim_drilling_permits: fixed-position lines of up to 510 characters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrylake.functions.keys import permit_key, permit_key_valid
from registrylake.functions.layout import cut_all, fields
from registrylake.functions.text import rstrip

MIN_LENGTH = 50
RAW_LENGTH = 510

# Record layout (name, 0-based start, length).
LAYOUT = fields(
    ("district", 0, 2),
    ("permit_number", 2, 6),
    ("lease_name", 8, 32),
    ("district_suffix", 40, 4),
    ("total_depth", 48, 5),
    ("county_code", 53, 3),
    ("field_number", 56, 5),
    ("well_number", 61, 3),
    ("remarks", 64, 30),
    ("operator_number", 94, 6),
    ("api_county", 100, 3),
    ("api_unique", 103, 5),
)


def long_enough(lines: DataFrame) -> DataFrame:
    return lines.where(F.length(rstrip(F.col("value"))) >= MIN_LENGTH)


def drilling_permits(lines: DataFrame, run_ts: str) -> DataFrame:
    """Permit rows; ``api10_valid`` tells real well keys from the zero-filled ones of blank parts."""
    rows = long_enough(lines).select(
        F.substring(rstrip(F.col("value")), 1, RAW_LENGTH).alias("raw_line"), *cut_all(F.col("value"), LAYOUT)
    )
    county, unique = F.col("api_county"), F.col("api_unique")
    return rows.withColumns(
        {
            "api10": permit_key(county, unique),
            "api10_valid": permit_key_valid(county, unique),
            "scraped_at": F.lit(run_ts),
        }
    )
