"""Corrected reports: the latest posting of a lease-month wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from registrylake.operators.dedupe import latest_rows

LEASE_MONTH = ("district", "lease_number", "rpt_cycle_key")
POSTING = ("posting_year", "posting_month", "posting_day", "corrected_report_flag")


def apply_corrections(
    published: DataFrame, arrived: DataFrame, keys: Sequence[str] = LEASE_MONTH, order: Sequence[str] = POSTING
) -> DataFrame:
    """Published and arrived rows, one per key: latest posting date, corrected before original.

    Rows that tie in posting date and flag are settled by all their other columns.
    """
    rest = [c for c in published.columns if c not in keys and c not in order]
    return latest_rows(published.unionByName(arrived), keys, [*order, *rest])
