"""County well records: raw, one row per well, one row per completion, and what is derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrylake.functions.keys import registry_key
from registrylake.operators.crosswalk import lease_crosswalk
from registrylake.operators.dedupe import first_rows
from registrylake.operators.tenure import operator_tenure

SOURCE_ORDER = ("source_file", "ordinal")

# Which source columns describe the well and which a completion.
WELL_COLUMNS = (
    "api10", "apinum", "abstract", "block", "refer_to_a", "section", "survey", "total_dept", "quadnum",
)
EVENT_COLUMNS = (
    "api10", "gas_rrcid", "operator", "lease_name", "field_name", "oil_gas_co", "on_off_sch", "permit_num",
    "completion", "plug_date", "wellid",
)
LINEAGE = ("scraped_at", "source_file")

HISTORY_SCHEMA = T.StructType(
    [
        T.StructField(c, T.BooleanType() if c == "is_current" else T.StringType())
        for c in (
            "api10", "operator_number", "operator_name", "effective_date", "termination_date", "is_current",
            "lease_number", "district", "scraped_at",
        )
    ]
)


def well_records_raw(records: DataFrame, run_ts: str) -> DataFrame:
    """Every source row with its well key; ``ordinal`` keeps the source order."""
    return records.withColumns({"api10": registry_key(F.col("apinum")), "scraped_at": F.lit(run_ts)})


def _present(df: DataFrame, wanted: tuple[str, ...]) -> list[str]:
    return [c for c in (*wanted, *LINEAGE) if c in df.columns]


def well_master(raw: DataFrame) -> DataFrame:
    """First row per well, well columns only."""
    columns = _present(raw, WELL_COLUMNS)
    return first_rows(raw.select(*columns, "ordinal"), ["api10"], SOURCE_ORDER).select(*columns)


def well_completions(raw: DataFrame) -> DataFrame:
    """First row per (well, record id), event columns only. Keeps ``ordinal`` for later ties."""
    columns = _present(raw, EVENT_COLUMNS)
    return first_rows(raw.select(*columns, "ordinal"), ["api10", "gas_rrcid"], SOURCE_ORDER).select(*columns, "ordinal")


def operator_history(completions: DataFrame, run_ts: str) -> DataFrame:
    return operator_tenure(completions, SOURCE_ORDER).withColumn("scraped_at", F.lit(run_ts))


def well_lease_crosswalk(completions: DataFrame, run_ts: str) -> DataFrame:
    return lease_crosswalk(completions, SOURCE_ORDER).withColumn("scraped_at", F.lit(run_ts))
