"""dim_operator_registry: organisation registrations, one row per operator number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrylake.functions.dates import compact_date
from registrylake.functions.layout import cut, fields
from registrylake.functions.text import join_address, map_codes, null_if_empty, rstrip

# Record layout (name, 0-based start, length).
LAYOUT = fields(
    ("record_id", 0, 2),
    ("operator_number", 2, 6),
    ("organization_name", 8, 32),
    ("refiling_required_flag", 40, 1),
    ("p5_status", 41, 1),
    ("hold_mail_code", 42, 1),
    ("renewal_letter_code", 43, 1),
    ("organization_code", 44, 1),
    ("organization_other_comment", 45, 20),
    ("gatherer_code", 65, 5),
    ("mailing_addr_line1", 70, 31),
    ("mailing_addr_line2", 101, 31),
    ("mailing_addr_city", 132, 13),
    ("mailing_addr_state", 145, 2),
    ("mailing_addr_zip", 147, 5),
    ("mailing_addr_zip_suffix", 152, 4),
    ("physical_addr_line1", 156, 31),
    ("physical_addr_line2", 187, 31),
    ("physical_addr_city", 218, 13),
    ("physical_addr_state", 231, 2),
    ("physical_addr_zip", 233, 5),
    ("physical_addr_zip_suffix", 238, 4),
    ("date_built", 242, 8),
    ("date_inactive", 250, 8),
    ("phone_number", 258, 10),
    ("refile_notice_month", 268, 2),
    ("refile_letter_date", 270, 8),
    ("refile_notice_date", 278, 8),
    ("refile_received_date", 286, 8),
    ("last_p5_received_date", 294, 8),
    ("other_organization_no", 302, 6),
    ("filing_problem_date", 308, 8),
    ("filing_problem_ltr_code", 316, 3),
    ("telephone_verify_flag", 319, 1),
    ("op_num_multi_used_flag", 320, 1),
    ("oil_gatherer_status", 321, 1),
    ("gas_gatherer_status", 322, 1),
    ("tax_cert", 323, 1),
    ("emer_phone_number", 324, 10),
    ("filler", 334, 16),
)

# Code lists.
STATUS_CODES = {"A": "active", "I": "inactive", "D": "delinquent", "S": "see_remarks"}
ORGANIZATION_CODES = {
    "A": "corporation",
    "B": "limited_partnership",
    "C": "sole_proprietorship",
    "D": "partnership",
    "E": "trust",
    "F": "joint_venture",
    "G": "other",
}

# Output columns that keep "" and are renamed from the layout.
VERBATIM = {
    "operator_number": "operator_number",
    "operator_name": "organization_name",
    "p5_status_raw": "p5_status",
    "organization_code_raw": "organization_code",
    "refiling_required": "refiling_required_flag",
    "hold_mail_code": "hold_mail_code",
    "renewal_letter_code": "renewal_letter_code",
}
DATES = (
    "date_built", "date_inactive", "refile_letter_date", "refile_notice_date", "refile_received_date",
    "last_p5_received_date", "filing_problem_date",
)

# The published columns in order.
COLUMNS = (
    "operator_number", "operator_name", "p5_status", "p5_status_raw", "organization_type", "organization_code_raw",
    "refiling_required", "hold_mail_code", "renewal_letter_code", "organization_other_comment", "gatherer_code",
    "mailing_address", "mailing_addr_line1", "mailing_addr_line2", "mailing_addr_city", "mailing_addr_state",
    "mailing_addr_zip", "physical_address", "physical_addr_line1", "physical_addr_line2", "physical_addr_city",
    "physical_addr_state", "physical_addr_zip", "date_built", "date_inactive", "phone_number", "refile_notice_month",
    "refile_letter_date", "refile_notice_date", "refile_received_date", "last_p5_received_date",
    "other_organization_no", "filing_problem_date", "filing_problem_ltr_code", "telephone_verify_flag",
    "op_num_multi_used_flag", "oil_gatherer_status", "gas_gatherer_status", "tax_cert", "emer_phone_number",
    "scraped_at",
)

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS])

CONSOLIDATION_SCHEMA = T.StructType(
    [
        T.StructField(c, T.StringType())
        for c in (
            "operator_number", "parent_operator_number", "acquisition_date", "consolidation_type", "canonical_name",
            "scraped_at",
        )
    ]
)


def record_type(lines: DataFrame) -> DataFrame:
    """Lines that are not empty, with their record type."""
    typed = lines.where(F.length("value") >= 1)
    return typed.withColumn("record_type", rstrip(F.substring("value", 1, 2)))


def operator_registry(lines: DataFrame, run_ts: str) -> DataFrame:
    """Organisation records (type A) in the 41 published columns."""
    raw = {f.name: cut(F.col("value"), f) for f in LAYOUT}

    def address(kind: str):
        part = lambda x: raw[f"{kind}_addr_{x}"]
        return join_address([part("line1"), part("line2"), part("city")], part("state"), part("zip"))

    special = {
        "p5_status": map_codes(raw["p5_status"], STATUS_CODES),
        "organization_type": map_codes(raw["organization_code"], ORGANIZATION_CODES),
        "mailing_address": address("mailing"),
        "physical_address": address("physical"),
        "scraped_at": F.lit(run_ts),
        **{out: raw[src] for out, src in VERBATIM.items()},
        **{c: compact_date(raw[c]) for c in DATES},
    }
    columns = [special.get(c, null_if_empty(raw[c]) if c in raw else None) for c in COLUMNS]
    rows = record_type(lines).where(F.col("record_type") == "A")
    return rows.select(*[c.alias(n) for n, c in zip(COLUMNS, columns, strict=True)])
