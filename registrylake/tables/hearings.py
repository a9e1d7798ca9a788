"""dim_hearings: docket, party and subject lines in one table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrylake.functions.layout import cut_variant, fields
from registrylake.functions.text import rstrip, strip

MIN_LENGTH = 2
RAW_LENGTH = 200

# Layouts by record type (name, 0-based start, length).
LAYOUTS = {
    "01": fields(("docket_number", 7, 5), ("case_type", 12, 3), ("status_code", 15, 1), ("filing_date", 80, 8)),
    "02": fields(("party_name", 2, 40), ("operator_number", 42, 6)),
    "15": fields(("line_number", 2, 4), ("subject_text", 6, 50)),
}


def long_enough(lines: DataFrame) -> DataFrame:
    return lines.where(F.length(rstrip(F.col("value"))) >= MIN_LENGTH)


def hearings(lines: DataFrame, run_ts: str) -> DataFrame:
    """All lines of 2 characters or more; each type fills its own columns, others stay null.

    ``lines`` comes from ``read_numbered_lines``: skipped lines count in ``line_number_in_file``.
    """
    value = F.col("value")
    kind = strip(F.substring(value, 1, 2))
    cells = [c for wanted, layout in LAYOUTS.items() for c in cut_variant(value, kind, wanted, layout)]
    return long_enough(lines).select(
        kind.alias("record_type"),
        F.substring(rstrip(value), 1, RAW_LENGTH).alias("raw_line"),
        "line_number_in_file",
        *cells,
        F.lit(run_ts).alias("scraped_at"),
    )
