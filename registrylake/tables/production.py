"""Oil tape: 102-byte EBCDIC records, root > cycle > production by position."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registrylake.functions.dates import split_cycle_key
from registrylake.functions.ebcdic import byte_slice, text_slice
from registrylake.functions.packed import packed_to_long
from registrylake.functions.text import LATIN_SPACE, strip
from registrylake.operators.carry import carry_forward
from registrylake.session import materialise
from registrylake.sources.fixed_records import (
    SPLIT_BYTES,
    Context,
    RecordFile,
    read_record_files,
    read_with_contexts,
    whole_records,
)

RECORD_LENGTH = 102
TEXT, PACKED = "text", "packed"


class TapeField(NamedTuple):
    name: str
    start: int
    length: int
    kind: str


# Segment layouts (name, 0-based start, length, kind).
ROOT = (
    TapeField("oil_code", 2, 1, TEXT),
    TapeField("district", 3, 2, TEXT),
    TapeField("lease_number", 5, 6, TEXT),
    TapeField("movable_balance", 11, 5, PACKED),
    TapeField("beginning_oil_status", 16, 5, PACKED),
    TapeField("beginning_csghd_status", 21, 5, PACKED),
    TapeField("oil_oldest_eom_balance", 26, 5, PACKED),
)
CYCLE = (
    TapeField("rpt_cycle_key", 2, 4, TEXT),
    TapeField("daily_oil_prorated_allow", 6, 5, PACKED),
    TapeField("daily_oil_exempt_allow", 11, 5, PACKED),
    TapeField("daily_csh_prorated_allow", 16, 5, PACKED),
    TapeField("daily_csh_exempt_allow", 21, 5, PACKED),
    TapeField("oil_allowable_cycle_bbls", 26, 5, PACKED),
    TapeField("csh_limit_cycle_mcf", 31, 5, PACKED),
    TapeField("oil_allow_effect_year", 36, 4, TEXT),
    TapeField("oil_allow_effect_month", 40, 2, TEXT),
    TapeField("oil_allow_effect_day", 42, 2, TEXT),
    TapeField("oil_allow_issue_year", 44, 4, TEXT),
    TapeField("oil_allow_issue_month", 48, 2, TEXT),
    TapeField("oil_allow_issue_day", 50, 2, TEXT),
    TapeField("oil_ending_balance", 52, 5, PACKED),
    TapeField("present_oil_status", 57, 5, PACKED),
    TapeField("present_csghd_status", 62, 5, PACKED),
    TapeField("adjusted_oil_status", 67, 5, PACKED),
    TapeField("adjusted_csghd_status", 72, 5, PACKED),
)
PRODUCTION = (
    TapeField("corrected_report_flag", 2, 1, TEXT),
    TapeField("oil_production_bbl", 6, 5, PACKED),
    TapeField("casinghead_gas_mcf", 11, 5, PACKED),
    TapeField("casinghead_gas_lift", 16, 5, PACKED),
    TapeField("batch_number", 21, 3, TEXT),
    TapeField("item_number", 24, 4, TEXT),
    TapeField("posting_year", 28, 4, TEXT),
    TapeField("posting_month", 32, 2, TEXT),
    TapeField("posting_day", 34, 2, TEXT),
    TapeField("filed_by_edi", 36, 1, TEXT),
)
DISPOSITION = (
    TapeField("disposition_code", 2, 2, TEXT),
    TapeField("disposition_amount", 4, 5, PACKED),
)
SEGMENTS = {"01": ROOT, "02": CYCLE, "03": PRODUCTION, "05": DISPOSITION}

# The published columns before the derived ones.
MONTHLY_COLUMNS = (
    "district", "lease_number", "oil_code", "rpt_cycle_key", "oil_production_bbl", "casinghead_gas_mcf",
    "casinghead_gas_lift", "corrected_report_flag", "posting_year", "posting_month", "posting_day", "filed_by_edi",
    "oil_ending_balance", "oil_allowable_cycle_bbls",
)


def decode_fields(rec: Column, layout: Sequence[TapeField], names: Sequence[str] | None = None) -> dict[str, Column]:
    """Columns by field name. The text fields are cut from one decoded stretch, so it is decoded once."""
    wanted = [f for f in layout if names is None or f.name in names]
    texts = [f for f in wanted if f.kind == TEXT]
    begin = min((f.start for f in texts), default=0)
    end = max((f.start + f.length for f in texts), default=0)
    stretch = text_slice(rec, begin, end - begin)
    return {
        f.name: F.substring(stretch, f.start - begin + 1, f.length)
        if f.kind == TEXT
        else packed_to_long(byte_slice(rec, f.start, f.length))
        for f in wanted
    }


def decode_segment(rec: Column, segment: str) -> list[Column]:
    return [c.alias(name) for name, c in decode_fields(rec, SEGMENTS[segment]).items()]


def record_type(rec: Column) -> Column:
    return strip(text_slice(rec, 0, 2), LATIN_SPACE)


# The bytes of a root and of a cycle that their records below use (start 0).
ROOT_BYTES, CYCLE_BYTES = 11, 57


def _type_hex(*types: str) -> list[str]:
    return [t.encode("cp037").hex() for t in types]


def tape_files(path: str, pattern: str = "*") -> list[RecordFile]:
    """The files of a tape with their numbers of whole records, packed (``.zst``) or not."""
    return whole_records(path, RECORD_LENGTH, pattern)


def read_tape(spark: SparkSession, path: str, pattern: str = "*", types: Sequence[str] = ()) -> DataFrame:
    """``source_file``, ``record_index``, ``rec``; only the given record types, if any are."""
    return read_record_files(spark, tape_files(path, pattern), keep=_type_hex(*types))


def read_tape_with_parents(
    spark: SparkSession, path: str, pattern: str = "*", types: Sequence[str] = (), split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """``read_tape`` plus the bytes of the latest root and cycle (``root_rec``, ``cycle_rec``).

    A new root does not reset the cycle. The source carries the parents, no record is shuffled.
    """
    root, cycle = _type_hex("01", "02")
    contexts = [Context("root_rec", root, 0, ROOT_BYTES), Context("cycle_rec", cycle, 0, CYCLE_BYTES)]
    files = tape_files(path, pattern)
    return read_with_contexts(spark, files, contexts, _type_hex(*types), split_bytes)


def with_parents(tape: DataFrame, ranges: int | None = None) -> DataFrame:
    """The same for records that are already in a table."""
    kind = record_type(F.col("rec"))
    contexts = {
        "root_rec": F.when(kind == "01", byte_slice(F.col("rec"), 0, ROOT_BYTES)),
        "cycle_rec": F.when(kind == "02", byte_slice(F.col("rec"), 0, CYCLE_BYTES)),
    }
    group = ["source_file"] if "source_file" in tape.columns else []
    return carry_forward(tape, "record_index", contexts, group, ranges)


def segment_records(tape: DataFrame, segment: str) -> DataFrame:
    """All records of one segment with every field decoded."""
    found = tape.where(record_type(F.col("rec")) == segment)
    return found.select("record_index", *decode_segment(F.col("rec"), segment))


def _parent_fields(parent: str, layout: Sequence[TapeField], names: Sequence[str]) -> dict[str, Column]:
    """Fields of the parent; "" and 0 without one (a packed null is 0 already)."""
    kinds = {f.name: f.kind for f in layout}
    cells = decode_fields(F.col(parent), layout, names)
    return {n: F.coalesce(c, F.lit("")) if kinds[n] == TEXT else c for n, c in cells.items()}


def production_monthly_undated(records: DataFrame) -> DataFrame:
    """Production segments with lease and cycle of their parents ("" / 0 without one).

    ``records`` come with parents; these are decoded only on the rows that keep them.
    """
    rows = records.where(record_type(F.col("rec")) == "03")
    source = {
        **decode_fields(F.col("rec"), PRODUCTION, MONTHLY_COLUMNS),
        **_parent_fields("root_rec", ROOT, MONTHLY_COLUMNS),
        **_parent_fields("cycle_rec", CYCLE, MONTHLY_COLUMNS),
    }
    return rows.select(*[source[c].alias(c) for c in MONTHLY_COLUMNS])


def production_monthly(records: DataFrame, run_ts: str) -> DataFrame:
    """fact_production_monthly.

    The format of the cycle key is a property of the whole column, so the decoded rows are written once
    and read twice, instead of reading the tape twice.
    """
    rows = materialise(production_monthly_undated(records), "monthly")
    return split_cycle_key(rows, "rpt_cycle_key").withColumn("scraped_at", F.lit(run_ts))


def production_records_raw(records: DataFrame, run_ts: str) -> DataFrame:
    """fact_production_records_raw: every record, its first 40 bytes as hex, its lease."""
    return records.select(
        "record_index",
        record_type(F.col("rec")).alias("record_type"),
        F.lower(F.hex(byte_slice(F.col("rec"), 0, 40))).alias("raw_hex"),
        *[c.alias(n) for n, c in _parent_fields("root_rec", ROOT, ("district", "lease_number")).items()],
        F.lit(run_ts).alias("scraped_at"),
    )


def disposition_records(tape: DataFrame, run_ts: str) -> DataFrame:
    """Disposition segments (an addition: decoded but not published elsewhere)."""
    return segment_records(tape, "05").withColumn("scraped_at", F.lit(run_ts))
