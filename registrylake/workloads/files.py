"""Whole files: the given tables are rendered as regulatory files, read back and turned into tables.

The rendering is test scaffolding; it is Spark work over the whole tables too, one file per task.
"""

from __future__ import annotations

import struct
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrylake.functions.ebcdic import encode_text
from registrylake.functions.packed import long_to_packed
from registrylake.quality import checks as Q
from registrylake.quality import runner
from registrylake.quality.config import TableRules
from registrylake.quality.runner import check_log, counted
from registrylake.session import scratch_path, shuffles_dropped
from registrylake.sinks.publish import PublishBlocked, create_if_absent, open_table, publish
from registrylake.sources import packed
from registrylake.sources.dbase import bad_files, read_dbase
from registrylake.sources.delimited import overlong_rows, read_delimited
from registrylake.sources.fixed_records import SPLIT_BYTES
from registrylake.sources.landing import SIDECAR, newest_snapshot, verify_sources
from registrylake.sources.paths import locate
from registrylake.sources.text_lines import read_lines, read_numbered_lines
from registrylake.streaming.corrections_stream import merge_batch
from registrylake.streaming.landing_stream import run_available, stream_lines
from registrylake.tables import hearings as hearings_table
from registrylake.tables import injection, inspections, operator_registry, permits, production, wells
from registrylake.workloads.registry import RUN_TS, query, table

# -- rendering -----------------------------------------------------------------------------------


def write_text_files(lines: DataFrame, label: str, gz: bool = False) -> str:
    folder = scratch_path(lines.sparkSession, label)
    lines.write.text(folder, compression="gzip" if gz else "none")
    return folder


def write_binary_files(records: DataFrame, label: str, suffix: str, header: bytes = b"") -> str:
    """One file per task, ``header`` first, then the task's records in order; packed where the suffix says so."""
    folder = scratch_path(records.sparkSession, label)
    pack = suffix.endswith(packed.SUFFIX)

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        filesystem, inner = open_at(folder)
        filesystem.create_dir(inner, recursive=True)
        n = 0
        with filesystem.open_output_stream(f"{inner}/api{TaskContext.get().partitionId():05d}{suffix}", compression=None) as raw:
            out = packed_output(raw) if pack else raw
            out.write(header)
            for batch in batches:
                out.write(b"".join(batch.column(0).to_pylist()))
                n += batch.num_rows
            if pack:
                out.close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    open_at, packed_output = _by_value(locate), _by_value(packed.PackedOutput)
    records.mapInArrow(write, "n bigint").agg(F.sum("n")).collect()
    return folder


def _by_value(fn):
    import sys

    from registrylake.sources.paths import ship_with_tasks

    ship_with_tasks(sys.modules[fn.__module__])
    return fn


def _left(c, width: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.rpad(c.cast("string"), width, " ")


def _zero(c, width: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.right(F.lpad(c.cast("string"), width + 12, "0"), F.lit(width))


def _gap(n: int) -> Column:
    return F.lit(" " * n)


# -- operator registry ----------------------------------------------------------------------------


def _registry_lines(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    bal, seg = F.col("c_acctbal"), F.col("c_mktsegment")
    blank = lambda cond, x: F.when(cond, "").otherwise(x)
    return c.select(
        F.concat(
            F.when(seg == "FURNITURE", "F ").when(seg == "MACHINERY", "1T").otherwise("A "),
            _zero("c_custkey", 6),
            _left("c_name", 32),
            F.when(bal < 0, "N").otherwise("Y"),
            F.when(bal < 1000, "D").when(bal < 3000, "A").when(bal < 5000, "I").when(bal < 7000, "S").otherwise("Z"),
            F.lit("HP"),
            F.when(bal < 4000, "A").when(bal < 8000, "C").otherwise(" "),
            _gap(25),
            _left(blank(bal < 500, F.col("c_name")), 31),
            _gap(31),
            _left(blank(bal < 500, F.col("n_name")), 13),
            _left(blank(bal < 2500, F.substring("n_name", 1, 2)), 2),
            _left(blank(bal < 500, _zero("c_nationkey", 5)), 5),
            _gap(4 + 86),
            F.when(bal < 0, "00000000").when(bal < 2000, "        ").otherwise("19980704"),
            F.when(seg == "BUILDING", "").otherwise(F.concat(_gap(8), F.lit("5125550100"))),
        ).alias("value")
    )


@query(
    """WITH p AS (SELECT *, CASE WHEN c_acctbal < 500 THEN '' ELSE c_name END AS l1, CASE WHEN c_acctbal < 500 THEN '' ELSE substr(n_name, 1, 13) END AS city,
        CASE WHEN c_acctbal < 2500 THEN '' ELSE substr(n_name, 1, 2) END AS st, CASE WHEN c_acctbal < 500 THEN '' ELSE lpad(CAST(c_nationkey AS VARCHAR), 5, '0') END AS zip
      FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment NOT IN ('FURNITURE', 'MACHINERY'))
    SELECT right(lpad(CAST(c_custkey AS VARCHAR), 18, '0'), 6) AS operator_number, c_name AS operator_name,
      CASE WHEN c_acctbal < 1000 THEN 'delinquent' WHEN c_acctbal < 3000 THEN 'active' WHEN c_acctbal < 5000 THEN 'inactive'
           WHEN c_acctbal < 7000 THEN 'see_remarks' ELSE 'Z' END AS p5_status,
      CASE WHEN c_acctbal < 4000 THEN 'corporation' WHEN c_acctbal < 8000 THEN 'sole_proprietorship' ELSE '' END AS organization_type,
      CASE WHEN c_acctbal < 0 THEN 'N' ELSE 'Y' END AS refiling_required,
      NULLIF(concat_ws(', ', NULLIF(l1, ''), NULLIF(city, ''), NULLIF(trim(st || ' ' || zip), '')), '') AS mailing_address,
      CAST(NULL AS VARCHAR) AS physical_address,
      CASE WHEN c_acctbal >= 2000 THEN '1998-07-04' END AS date_built,
      CASE WHEN c_mktsegment <> 'BUILDING' THEN '5125550100' END AS phone_number, CAST(NULL AS VARCHAR) AS emer_phone_number
    FROM p"""
)
def operator_registry_file(spark, sf_dir):
    folder = write_text_files(_registry_lines(spark, sf_dir), "registry")
    rows = operator_registry.operator_registry(read_lines(spark, folder), RUN_TS)
    return rows.select(
        "operator_number", "operator_name", "p5_status", "organization_type", "refiling_required", "mailing_address",
        "physical_address", "date_built", "phone_number", "emer_phone_number",
    )


@query(
    """SELECT CASE c_mktsegment WHEN 'FURNITURE' THEN 'F' WHEN 'MACHINERY' THEN '1T' ELSE 'A' END AS record_type, COUNT(*) AS n_records
    FROM customer GROUP BY 1"""
)
def operator_registry_types(spark, sf_dir):
    folder = write_text_files(_registry_lines(spark, sf_dir), "registry")
    typed = operator_registry.record_type(read_lines(spark, folder))
    return typed.groupBy("record_type").agg(F.count(F.lit(1)).alias("n_records"))


# -- permits ------------------------------------------------------------------------------------


def _permit_lines(spark, sf_dir) -> DataFrame:
    seg = F.col("c_mktsegment")
    line = F.concat(
        _zero("c_nationkey", 2),
        _zero("c_custkey", 6),
        _left("c_name", 32),
        _left(F.substring(seg, 1, 4), 4),
        _gap(4),
        _zero(F.floor(F.abs("c_acctbal")), 5),
        _zero("c_nationkey", 3),
        _zero("c_custkey", 5),
        F.lit(" 1H"),
        F.rpad(F.concat(F.lit("É"), seg), 29, " "),
        _zero("c_custkey", 6),
        F.when(seg == "BUILDING", "   ").otherwise(_zero("c_nationkey", 3)),
        F.when(seg == "BUILDING", "     ").otherwise(_zero("c_custkey", 5)),
        F.rpad(F.lit("end"), 480, "."),
    )
    return table(spark, sf_dir, "customer").select(F.when(F.col("c_acctbal") < 0, "SHORT LINE").otherwise(line).alias("value"))


_Z = "right(lpad(CAST({0} AS VARCHAR), 24, '0'), {1})"
_PERMITS_SQL = f"""SELECT {_Z.format('c_nationkey', 2)} AS district, {_Z.format('c_custkey', 6)} AS permit_number, c_name AS lease_name,
      substr(c_mktsegment, 1, 4) AS district_suffix, {_Z.format('CAST(floor(abs(c_acctbal)) AS BIGINT)', 5)} AS total_depth, '1H' AS well_number,
      chr(65533) || chr(65533) || c_mktsegment AS remarks, {_Z.format('c_custkey', 6)} AS operator_number,
      CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE {_Z.format('c_nationkey', 3)} END AS api_county,
      CASE WHEN c_mktsegment = 'BUILDING' THEN '4200000000' ELSE '42' || {_Z.format('c_nationkey', 3)} || {_Z.format('c_custkey', 5)} END AS api10,
      c_mktsegment <> 'BUILDING' AND c_nationkey <> 0 AND {_Z.format('c_custkey', 5)} <> '00000' AS api10_valid,
      510::BIGINT AS raw_length FROM customer WHERE c_acctbal >= 0"""


def _permit_columns(rows):
    return rows.select(
        "district", "permit_number", "lease_name", "district_suffix", "total_depth", "well_number", "remarks",
        "operator_number", "api_county", "api10", "api10_valid", F.length("raw_line").cast("bigint").alias("raw_length"),
    )


@query(_PERMITS_SQL)
def permits_file(spark, sf_dir):
    folder = write_text_files(_permit_lines(spark, sf_dir), "permits", gz=True)
    return _permit_columns(permits.drilling_permits(read_lines(spark, folder), RUN_TS))


@query(_PERMITS_SQL)
def permits_stream(spark, sf_dir):
    """The same files as a stream that reads what has landed and stops."""
    folder = write_text_files(_permit_lines(spark, sf_dir), "permits")
    target, checkpoint = scratch_path(spark, "permits-table"), scratch_path(spark, "permits-progress")
    lines = stream_lines(spark, folder, "part-*")
    run_available(lines, lambda x: permits.drilling_permits(x, RUN_TS), target, checkpoint).awaitTermination()
    return _permit_columns(spark.read.parquet(target))


# -- injection ------------------------------------------------------------------------------------


def _injection_lines(spark, sf_dir, header: str) -> DataFrame:
    seg, bal = F.col("c_mktsegment"), F.col("c_acctbal")
    line = F.concat(
        F.when(bal > 3000, header).otherwise("02"), _zero("c_nationkey", 2), _zero("c_custkey", 6), F.lit("I"),
        _zero("c_nationkey", 3), _zero("c_custkey", 8), _zero("c_custkey", 6),
        F.when(seg == "BUILDING", "000").otherwise(_zero("c_nationkey", 3)),
        F.when(seg == "MACHINERY", "     ").otherwise(_zero("c_custkey", 5)),
    )
    return table(spark, sf_dir, "customer").select(F.when(bal < 0, "TOO SHORT").otherwise(line).alias("value"))


def _injection_sql(keep):
    c, u = _Z.format("c_nationkey", 3), _Z.format("c_custkey", 5)
    return f"""SELECT {_Z.format('c_custkey', 6)} AS lease_number, {_Z.format('c_custkey', 8)} AS field_number, 'I' AS well_type_code,
      CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') OR {c} = '000' OR {u} = '00000' THEN NULL ELSE '42' || {c} || {u} END AS api10
      FROM customer WHERE c_acctbal >= 0 AND {keep}"""


def _injection(spark, sf_dir, header):
    folder = write_text_files(_injection_lines(spark, sf_dir, header), "injection")
    raw = injection.injection_raw(read_lines(spark, folder), RUN_TS)
    return injection.injection_wells(raw).select("lease_number", "field_number", "well_type_code", "api10")


@query(_injection_sql("c_acctbal > 3000"))
def injection_file(spark, sf_dir):
    return _injection(spark, sf_dir, "01")


@query(_injection_sql("TRUE"))
def injection_file_without_headers(spark, sf_dir):
    """No type 01 anywhere: every row is kept."""
    return _injection(spark, sf_dir, "03")


# -- hearings -------------------------------------------------------------------------------------


def _hearing_lines(spark, sf_dir) -> DataFrame:
    status, key = F.col("o_orderstatus"), _zero("o_orderkey", 5)
    line = (
        F.when(
            status == "F",
            F.concat(F.lit("01"), _gap(5), key, F.lit("OG A"), _gap(64), F.date_format("o_orderdate", "yyyyMMdd")),
        )
        .when(status == "O", F.concat(F.lit("02"), _left("o_orderpriority", 40), _zero("o_custkey", 6)))
        .when(F.col("o_totalprice") < 50000, F.lit(" "))
        .otherwise(F.concat(F.lit("15"), _zero("o_orderkey", 4), _left("o_orderpriority", 250), F.lit("tail")))
    )
    return table(spark, sf_dir, "orders").repartition(4, "o_orderkey").select(line.alias("value"))


@query(
    f"""SELECT record_type, docket_number, CASE WHEN record_type = '01' THEN 'OG' END AS case_type, CASE WHEN record_type = '01' THEN 'A' END AS status_code,
      filing_date, party_name, operator_number, line_number, subject_text, raw_length FROM (
      SELECT CASE o_orderstatus WHEN 'F' THEN '01' WHEN 'O' THEN '02' ELSE '15' END AS record_type,
        CASE WHEN o_orderstatus = 'F' THEN {_Z.format('o_orderkey', 5)} END AS docket_number,
        CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y%m%d') END AS filing_date,
        CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS party_name, CASE WHEN o_orderstatus = 'O' THEN {_Z.format('o_custkey', 6)} END AS operator_number,
        CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN {_Z.format('o_orderkey', 4)} END AS line_number,
        CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN o_orderpriority END AS subject_text,
        CASE o_orderstatus WHEN 'F' THEN 88 WHEN 'O' THEN 48 ELSE 200 END::BIGINT AS raw_length
      FROM orders WHERE o_orderstatus IN ('F', 'O') OR o_totalprice >= 50000)"""
)
def hearings_file(spark, sf_dir):
    folder = write_text_files(_hearing_lines(spark, sf_dir), "hearings", gz=True)
    rows = hearings_table.hearings(read_numbered_lines(spark, folder), RUN_TS)
    kept = [c for c in rows.columns if c not in ("raw_line", "line_number_in_file", "scraped_at")]
    return rows.select(*kept, F.length("raw_line").cast("bigint").alias("raw_length"))


@query("SELECT COUNT(*) AS n_lines, COUNT(*) AS n_places, TRUE AS is_dense FROM orders")
def line_numbering(spark, sf_dir):
    """Each file's lines are numbered 0, 1, 2, ... without gaps or repeats, short lines included."""
    folder = write_text_files(_hearing_lines(spark, sf_dir), "hearings")
    lines = read_numbered_lines(spark, folder)
    per_file = lines.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("line_number_in_file").alias("d"), F.max("line_number_in_file").alias("m")
    )
    return per_file.agg(
        F.sum("n").alias("n_lines"), F.sum("d").alias("n_places"), F.bool_and(F.col("m") + 1 == F.col("n")).alias("is_dense")
    )


@query(
    """SELECT CAST(c_nationkey AS VARCHAR) AS file, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS number,
      c_nationkey || '|' || c_custkey || '|' || c_name AS text FROM customer"""
)
def numbered_lines(spark, sf_dir):
    """One compressed file per nation, its customers in order: every line with its own number and text."""
    line = F.concat_ws("|", "c_nationkey", "c_custkey", "c_name")
    rows = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", line.alias("value"))
    folder = scratch_path(spark, "nations")
    placed = rows.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey").drop("c_custkey")
    placed.write.partitionBy("c_nationkey").text(folder, compression="gzip")
    lines = read_numbered_lines(spark, f"{folder}/*")
    return lines.select(F.substring_index("value", "|", 1).alias("file"), F.col("line_number_in_file").alias("number"), F.col("value").alias("text"))


# -- inspections ----------------------------------------------------------------------------------

_HEADER = "Operator Name}District}API No}Compliance}Remarks"


def _with_headers(rows: DataFrame, header: Column, label: str) -> str:
    """Files of the lines in ``value``, one for each ``_p``, with one header line at the top: it sorts first in its partition."""
    parts = rows.withColumn("_h", F.lit(1))
    heads = parts.select("_p").distinct().select(header.alias("value"), "_p", F.lit(0).alias("_h"))
    ordered = parts.unionByName(heads).repartition("_p").sortWithinPartitions("_p", "_h")
    folder = scratch_path(rows.sparkSession, label)
    ordered.select("value", "_p").write.partitionBy("_p").text(folder)
    return f"{folder}/*"


def _inspection_folder(spark, sf_dir) -> str:
    c = table(spark, sf_dir, "customer")
    seg, bal = F.col("c_mktsegment"), F.col("c_acctbal")
    api = F.when(bal > 9000, "  ").when(bal > 8000, "1234567890").otherwise(_left("c_custkey", 8))
    remarks = F.when(seg == "BUILDING", '"say ""no"" } later"').when(seg == "MACHINERY", "N/A").otherwise(seg)
    row = F.concat_ws("}", "c_name", _zero("c_nationkey", 2), api, F.when(bal < 5000, "Y").otherwise(""), remarks)
    row = F.when(bal < 0, F.concat(row, F.lit("}one too many"))).when(bal < 500, F.substring_index(row, "}", 2)).otherwise(row)
    rows = c.select(row.alias("value")).coalesce(4).withColumn("_p", F.spark_partition_id())
    return _with_headers(rows, F.lit(_HEADER), "inspections")


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'see' || chr(10) || c_name || chr(10) || chr(10) || '"so" } far'
      WHEN c_mktsegment = 'MACHINERY' THEN chr(10) ELSE c_mktsegment END AS remarks, CASE WHEN c_acctbal < 0 THEN 'a"b' ELSE 'end' || chr(10) END AS note FROM customer"""
)
def inspections_quoted_breaks(spark, sf_dir):
    """Quoted fields that hold line breaks, blank lines, quotes and separators."""
    c = table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    remarks = F.when(seg == "BUILDING", F.concat(F.lit('"see\n'), "c_name", F.lit('\n\n""so"" } far"'))).when(seg == "MACHINERY", '"\n"').otherwise(seg)
    note = F.when(F.col("c_acctbal") < 0, 'a"b').otherwise('"end\n"')
    rows = c.select(F.concat_ws("}", "c_custkey", remarks, note).alias("value"), F.pmod("c_nationkey", F.lit(4)).alias("_p"))
    return read_delimited(spark, _with_headers(rows, F.lit('Id}"Remarks"}Note'), "quoted"))


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_nationkey % 3 <> 2 THEN c_name END AS operator_name,
      CASE WHEN c_nationkey % 3 <> 1 THEN CAST(c_nationkey AS VARCHAR) END AS district, CASE WHEN c_nationkey % 3 = 1 THEN c_mktsegment END AS inspector
    FROM customer WHERE NOT (c_nationkey % 3 = 2 AND c_acctbal < 0)"""
)
def inspections_mixed_headers(spark, sf_dir):
    """Files of three layouts, united by column names; a row may be too long for the layout of its own file only."""
    c = table(spark, sf_dir, "customer")
    kind = F.pmod("c_nationkey", F.lit(3))
    too_long = F.when(F.col("c_acctbal") < 0, "}one too many").otherwise("")
    row = (
        F.when(kind == 0, F.concat_ws("}", "c_custkey", "c_name", "c_nationkey"))
        .when(kind == 1, F.concat_ws("}", "c_mktsegment", "c_custkey", "c_name"))
        .otherwise(F.concat(F.concat_ws("}", "c_nationkey", "c_custkey"), too_long))
    )
    header = F.when(F.col("_p") == 0, "Id}Operator Name}District").when(F.col("_p") == 1, "Inspector}ID}operator name").otherwise("District}Id")
    return read_delimited(spark, _with_headers(c.select(row.alias("value"), kind.alias("_p")), header, "mixed"))


@query(
    f"""SELECT c_name AS operator_name, {_Z.format('c_nationkey', 2)} AS district,
      CASE WHEN c_acctbal < 500 THEN NULL WHEN c_acctbal > 9000 THEN '  ' WHEN c_acctbal > 8000 THEN '1234567890' ELSE rpad(CAST(c_custkey AS VARCHAR), 8, ' ') END AS api_no,
      CASE WHEN c_acctbal >= 500 AND c_acctbal < 5000 THEN 'Y' END AS compliance,
      CASE WHEN c_acctbal < 500 THEN NULL WHEN c_mktsegment = 'BUILDING' THEN 'say "no" }} later' WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_mktsegment END AS remarks,
      CASE WHEN c_acctbal < 500 OR c_acctbal > 9000 THEN NULL WHEN c_acctbal > 8000 THEN '421234567890' ELSE '42' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS api10
    FROM customer WHERE c_acctbal >= 0"""
)
def inspections_file(spark, sf_dir):
    rows = read_delimited(spark, _inspection_folder(spark, sf_dir))
    return inspections.inspections(rows, RUN_TS).select(
        "operator_name", "district", "api_no", "compliance", "remarks", "api10"
    )


@query("SELECT COUNT(*) AS n_dropped FROM customer WHERE c_acctbal < 0")
def inspections_dropped(spark, sf_dir):
    return overlong_rows(spark, _inspection_folder(spark, sf_dir))


# -- county dBase files -----------------------------------------------------------------------------

_DBASE = (
    ("APINUM", 8), ("LEASE_NAME", 16), ("GAS_RRCID", 10), ("OPERATOR", 16), ("COMPLETION", 8), ("SURVEY", 12),
    ("TOTAL_DEPT", 8),
)


def dbase_header(layout, n_records: int = 0xFFFFFFFF) -> bytes:
    size = 1 + sum(length for _, length in layout)
    fields = b"".join(
        struct.pack("<11sc4xBB14x", name.encode("ascii"), b"C", length, 0) for name, length in layout
    )
    head_size = 32 + len(fields) + 1
    return struct.pack("<B3BIHH20x", 3, 126, 5, 13, n_records, head_size, size) + fields + b"\x0d"


def _county_files(spark, sf_dir) -> str:
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    priority = F.col("o_orderpriority")
    cells = [
        _zero("o_custkey", 8), _left(F.concat(F.lit("LEASE "), F.col("o_orderstatus")), 16), _left("o_orderkey", 10),
        F.when(priority == "5-LOW", _gap(16)).otherwise(_left(priority, 16)),
        F.when(F.col("o_totalprice") < 20000, "00000000").otherwise(F.date_format("o_orderdate", "yyyyMMdd")),
        _left(F.concat(F.lit("É "), F.col("c_mktsegment")), 12), _left(F.floor("o_totalprice"), 8),
    ]
    flag = F.when(F.col("o_totalprice") > 490000, "*").otherwise(" ")
    ordered = o.repartitionByRange(5, "o_custkey", "o_orderkey").sortWithinPartitions("o_custkey", "o_orderkey")
    records = ordered.select(F.encode(F.concat(flag, *cells), "ISO-8859-1").alias("rec"))
    return write_binary_files(records, "county", ".dbf", dbase_header(_DBASE))


def _raw_wells(spark, sf_dir) -> DataFrame:
    return wells.well_records_raw(read_dbase(spark, _county_files(spark, sf_dir)), RUN_TS)


_COUNTY_SQL = f"""SELECT '42' || {_Z.format('o_custkey', 8)} AS api10, {_Z.format('o_custkey', 8)} AS apinum, 'LEASE ' || o_orderstatus AS lease_name,
    CAST(o_orderkey AS VARCHAR) AS gas_rrcid, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS operator,
    CASE WHEN o_totalprice < 20000 THEN '00000000' ELSE strftime(o_orderdate, '%Y%m%d') END AS completion,
    chr(201) || ' ' || c_mktsegment AS survey, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS total_dept, o_orderkey
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice <= 490000"""


@query(f"SELECT * EXCLUDE (o_orderkey) FROM ({_COUNTY_SQL})")
def county_records(spark, sf_dir):
    return _raw_wells(spark, sf_dir).drop("source_file", "ordinal", "scraped_at")


@query(
    f"""SELECT api10, apinum, survey, total_dept FROM ({_COUNTY_SQL}) QUALIFY ROW_NUMBER() OVER (PARTITION BY api10 ORDER BY o_orderkey) = 1"""
)
def county_well_master(spark, sf_dir):
    return wells.well_master(_raw_wells(spark, sf_dir)).drop("source_file", "scraped_at")


@query(f"SELECT api10, gas_rrcid, operator, lease_name, completion FROM ({_COUNTY_SQL})")
def county_completions(spark, sf_dir):
    return wells.well_completions(_raw_wells(spark, sf_dir)).drop("source_file", "scraped_at", "ordinal")


@query(
    f"""WITH o AS (SELECT *, TRY_CAST(completion AS DOUBLE) AS ord FROM ({_COUNTY_SQL}) WHERE operator IS NOT NULL),
    l AS (SELECT *, LAG(operator) OVER (PARTITION BY api10 ORDER BY ord, o_orderkey) AS prev FROM o),
    s AS (SELECT * FROM l WHERE prev IS NULL OR prev <> operator)
    SELECT api10, operator AS operator_name, completion AS effective_date, LEAD(completion) OVER w AS termination_date,
      LEAD(1) OVER w IS NULL AS is_current, lease_name AS lease_number FROM s WINDOW w AS (PARTITION BY api10 ORDER BY ord, o_orderkey)"""
)
def county_operator_history(spark, sf_dir):
    completions = wells.well_completions(_raw_wells(spark, sf_dir))
    return wells.operator_history(completions, RUN_TS).drop("operator_number", "district", "scraped_at")


@query(
    f"""WITH r AS (SELECT *, CAST(completion AS BIGINT) AS num FROM ({_COUNTY_SQL})),
    p AS (SELECT api10, lease_name, MIN(num) AS f, MAX(num) AS l, COUNT(gas_rrcid) AS n_completions FROM r GROUP BY 1, 2),
    cur AS (SELECT api10, lease_name AS c FROM r QUALIFY ROW_NUMBER() OVER (PARTITION BY api10 ORDER BY num DESC, o_orderkey DESC) = 1),
    t AS (SELECT *, CASE WHEN f > 0 THEN CAST(f AS VARCHAR) END AS fs, CASE WHEN l > 0 THEN CAST(l AS VARCHAR) END AS ls FROM p JOIN cur USING (api10))
    SELECT api10, lease_name, substr(fs, 1, 4) || '-' || substr(fs, 5, 2) || '-' || substr(fs, 7, 2) AS effective_date,
      CASE WHEN lease_name <> c THEN substr(ls, 1, 4) || '-' || substr(ls, 5, 2) || '-' || substr(ls, 7, 2) END AS termination_date,
      lease_name = c AS is_current, n_completions FROM t"""
)
def county_lease_crosswalk(spark, sf_dir):
    completions = wells.well_completions(_raw_wells(spark, sf_dir))
    return wells.well_lease_crosswalk(completions, RUN_TS).drop("district", "scraped_at")


# -- oil tape -----------------------------------------------------------------------------------------


def _tape_lines(spark, sf_dir) -> DataFrame:
    """What the tape tells of a line."""
    columns = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")
    return table(spark, sf_dir, "lineitem").select(*columns)


def _tape_records(lines: DataFrame) -> DataFrame:
    """Orders as leases, their shipping months as cycles, their lines as production and disposition.

    The lines come dealt by order. A task puts its lines in order and writes a root where a lease starts, a cycle where a month does.
    """
    pad = lambda n: F.lit(bytearray(b"\x40" * n))
    txt = encode_text
    long = lambda c: long_to_packed(c.cast("bigint"))
    key = _zero("l_orderkey", 8)
    none = F.lit(0).cast("bigint")
    root = F.concat(txt(F.concat(F.lit("01O"), key)), *[long(F.col("l_orderkey") * k) for k in (1, -1, 2, 0)], pad(71))
    cycle = F.concat(
        txt(F.concat(F.lit("02"), "yymm")), *[long(none)] * 4, long(F.col("l_orderkey") * 3), long(none),
        txt(F.lit("1998010119980102")), long(-F.col("l_orderkey")), *[long(none)] * 4, pad(25),
    )
    made = F.concat(
        txt(F.concat(F.lit("03"), F.when(F.col("l_returnflag") == "R", "Y").otherwise("N"), _gap(3))),
        long(F.col("l_quantity")), long(F.round("l_extendedprice")), long(-F.col("l_partkey")),
        txt(F.concat(F.lit("001"), _zero("l_linenumber", 4), F.date_format("l_shipdate", "yyyyMMdd"), F.lit("Y"))), pad(65),
    )
    gone = F.concat(txt(F.concat(F.lit("05"), _zero("l_linenumber", 2))), long(F.col("l_suppkey")), pad(93))
    kinds = F.when(F.col("l_returnflag") == "A", F.array(F.lit("03"), F.lit("05"))).otherwise(F.array(F.lit("03")))
    rows = lines.select(
        "*", F.date_format("l_shipdate", "yyMM").alias("yymm"), F.xxhash64("l_partkey", "l_suppkey", "l_extendedprice").alias("d"),
        F.explode(kinds).alias("kind"),
    )
    above = F.lag("yymm").over(Window.partitionBy("l_orderkey").orderBy("yymm", "l_linenumber", "d", "kind"))
    rows = rows.withColumn("above", above)
    new_lease, new_month = F.col("above").isNull(), F.col("above").isNull() | (F.col("above") != F.col("yymm"))
    parents = [F.struct(new.alias("there"), F.when(new, rec).alias("rec")) for new, rec in ((new_lease, root), (new_month, cycle))]
    own = F.struct(F.lit(True).alias("there"), F.when(F.col("kind") == "03", made).otherwise(gone).alias("rec"))
    return rows.select(F.inline(F.array(*parents, own))).where("there").select("rec")


def _crossing(folder: str) -> int:
    """A split size that cuts every file at least a few times, so that leases cross range borders."""
    return min(SPLIT_BYTES, max(f.n_records for f in production.tape_files(folder)) * production.RECORD_LENGTH // 4)


TAPE_FILES = 6  # at least
RECORDS_PER_FILE = 2_000_000  # at most, about: 200 MB


def _tape_folder(spark, sf_dir, suffix: str = ".ebc") -> str:
    """Files of whole leases, as many as the lines need: a line makes four records at most.

    Only the lines are shuffled, not the records they make, and what was shuffled goes when the tape is written.
    """
    n_lines = table(spark, sf_dir, "lineitem").count()
    files = max(TAPE_FILES, -(-4 * n_lines // RECORDS_PER_FILE))
    with shuffles_dropped(spark):
        lines = _tape_lines(spark, sf_dir).repartitionByRange(files, "l_orderkey")
        return write_binary_files(_tape_records(lines), "tape", suffix)


def _packed_tape(spark, sf_dir) -> str:
    """The same tape in packed files: most of a record is padding and zeros."""
    return _tape_folder(spark, sf_dir, ".ebc" + packed.SUFFIX)


_L8 = _Z.format("l_orderkey", 8)
_MONTHLY_SQL = f"""WITH r AS (SELECT *, strftime(l_shipdate, '%y%m') AS k FROM lineitem)
    SELECT substr({_L8}, 1, 2) AS district, substr({_L8}, 3, 6) AS lease_number, 'O' AS oil_code, k AS rpt_cycle_key,
      CAST(l_quantity AS BIGINT) AS oil_production_bbl, CAST(round(l_extendedprice) AS BIGINT) AS casinghead_gas_mcf, -l_partkey AS casinghead_gas_lift,
      CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS corrected_report_flag, strftime(l_shipdate, '%Y') AS posting_year,
      strftime(l_shipdate, '%m') AS posting_month, strftime(l_shipdate, '%d') AS posting_day, 'Y' AS filed_by_edi,
      -l_orderkey AS oil_ending_balance, l_orderkey * 3 AS oil_allowable_cycle_bbls, strftime(l_shipdate, '%Y') AS prod_year, strftime(l_shipdate, '%m') AS prod_month
    FROM r"""


@query(_MONTHLY_SQL)
def oil_tape_monthly(spark, sf_dir):
    folder = _packed_tape(spark, sf_dir)
    records = production.read_tape_with_parents(spark, folder, types=("03",), split_bytes=_crossing(folder))
    return production.production_monthly(records, RUN_TS).drop("scraped_at")


@query(_MONTHLY_SQL)
def oil_tape_table_monthly(spark, sf_dir):
    """The records are in a table already: parents are carried by windows over chunks."""
    folder = _packed_tape(spark, sf_dir)
    tape = production.read_tape(spark, folder, types=("01", "02", "03"))
    ranges = max(40, sum(f.n_records for f in production.tape_files(folder)) * production.RECORD_LENGTH // SPLIT_BYTES)
    return production.production_monthly(production.with_parents(tape, ranges), RUN_TS).drop("scraped_at")


@query(
    f"""SELECT district, prod_year, CAST(SUM(oil_production_bbl) AS BIGINT) AS oil, CAST(SUM(casinghead_gas_mcf) AS BIGINT) AS gas, COUNT(*) AS n_reports
    FROM ({_MONTHLY_SQL}) GROUP BY 1, 2"""
)
def oil_tape_by_district_year(spark, sf_dir):
    records = production.read_tape_with_parents(spark, _packed_tape(spark, sf_dir), types=("03",))
    rows = production.production_monthly(records, RUN_TS)
    return rows.groupBy("district", "prod_year").agg(
        F.sum("oil_production_bbl").alias("oil"), F.sum("casinghead_gas_mcf").alias("gas"), F.count(F.lit(1)).alias("n_reports")
    )


@query(
    f"""WITH t AS (
      SELECT '01' AS record_type, l_orderkey FROM (SELECT DISTINCT l_orderkey FROM lineitem)
      UNION ALL SELECT '02', l_orderkey FROM (SELECT DISTINCT l_orderkey, strftime(l_shipdate, '%y%m') FROM lineitem)
      UNION ALL SELECT '03', l_orderkey FROM lineitem UNION ALL SELECT '05', l_orderkey FROM lineitem WHERE l_returnflag = 'A')
    SELECT record_type, substr({_L8}, 1, 2) AS district, substr({_L8}, 3, 6) AS lease_number, COUNT(*) AS n, 80 * COUNT(*) AS hex_chars FROM t GROUP BY 1, 2, 3"""
)
def oil_tape_raw(spark, sf_dir):
    folder = _packed_tape(spark, sf_dir)
    records = production.read_tape_with_parents(spark, folder, split_bytes=_crossing(folder))
    rows = production.production_records_raw(records, RUN_TS)
    return rows.groupBy("record_type", "district", "lease_number").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("raw_hex")).cast("bigint").alias("hex_chars")
    )


@query(
    f"""SELECT lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS disposition_code, l_suppkey AS disposition_amount FROM lineitem WHERE l_returnflag = 'A'"""
)
def oil_tape_disposition(spark, sf_dir):
    tape = production.read_tape(spark, _packed_tape(spark, sf_dir), types=("05",))
    return production.disposition_records(tape, RUN_TS).select("disposition_code", "disposition_amount")


@query(
    """SELECT 'O' AS oil_code, l_orderkey AS movable_balance, -l_orderkey AS beginning_oil_status, 2 * l_orderkey AS beginning_csghd_status, 0::BIGINT AS oil_oldest_eom_balance
    FROM (SELECT DISTINCT l_orderkey FROM lineitem)"""
)
def oil_tape_roots(spark, sf_dir):
    tape = production.read_tape(spark, _packed_tape(spark, sf_dir))
    return production.segment_records(tape, "01").drop("record_index", "district", "lease_number")


# -- publishing and landing -----------------------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def publish_checked(spark, sf_dir):
    """Stage, check, swap over an older version, read back."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    target = scratch_path(spark, "published")
    rows.where("o_orderstatus = 'F'").write.parquet(target)  # the older version
    publish(rows, target, lambda staged: check_log(Q.evaluate([Q.pk_unique(staged, "o_orderkey")]), RUN_TS))
    return open_table(spark, target)


@query("SELECT TRUE AS found_newest, 'no_sidecar' AS status, TRUE AS all_ok")
def landing_audit(spark: SparkSession, sf_dir):
    """Newest file by name, and integrity of all files (no sidecar here: they pass)."""
    folder = write_text_files(_permit_lines(spark, sf_dir), "landing")
    last = spark.read.text(folder).select(F.max("_metadata.file_name").alias("m")).first()["m"]
    newest = newest_snapshot(spark, folder, ("*.gz", "*.txt"))
    audit = verify_sources(spark, folder)
    return audit.agg(
        F.lit(newest.endswith(last)).alias("found_newest"), F.max("status").alias("status"), F.bool_and("ok").alias("all_ok")
    )


@query("""SELECT o_orderkey, o_custkey, o_orderstatus, 'pk_unique' AS blocked_by FROM orders""")
def publish_blocked_keeps_old(spark, sf_dir):
    """A version whose keys repeat is not shown; readers go on with the version before it."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    target = scratch_path(spark, "guarded")
    check = lambda staged: check_log(Q.evaluate([Q.pk_unique(staged, "o_orderkey")]), RUN_TS)
    publish(rows, target, check)
    blocked_by = "nothing"
    try:
        publish(rows.unionAll(rows.withColumn("o_custkey", -F.col("o_custkey"))), target, check)
    except PublishBlocked as e:
        blocked_by = e.log.where("check_status = 'fail'").first()["check_name"]
    return open_table(spark, target).withColumn("blocked_by", F.lit(blocked_by))


@query(
    """SELECT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month, COUNT(*) AS n FROM orders
    WHERE strftime(o_orderdate, '%Y') = '1997' GROUP BY 1, 2"""
)
def publish_partitioned(spark, sf_dir):
    """One year out of a table published by year: its folder alone is read, and the year stays text."""
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy").alias("year"), F.date_format("o_orderdate", "MM").alias("month")
    )
    target = scratch_path(spark, "by-year")
    publish(rows, target, partition_by=["year"])
    return open_table(spark, target).where("year = '1997'").groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 0::BIGINT AS n_rows, 'api10 string, since date, n bigint, is_current boolean, share double' AS columns, TRUE AS first_time, FALSE AS again FROM region LIMIT 1")
def typed_empty_table(spark, sf_dir):
    """An empty table keeps its types, and making it again leaves what is there alone."""
    schema = T.StructType([
        T.StructField("api10", T.StringType()), T.StructField("since", T.DateType()), T.StructField("n", T.LongType()),
        T.StructField("is_current", T.BooleanType()), T.StructField("share", T.DoubleType()),
    ])
    path = scratch_path(spark, "empty")
    first, again = create_if_absent(spark, path, schema), create_if_absent(spark, path, schema)
    made = open_table(spark, path)
    columns = ", ".join(f"{n} {t}" for n, t in made.dtypes)
    return made.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(columns).alias("columns"), F.lit(first).alias("first_time"), F.lit(again).alias("again"))


@query(
    """SELECT CAST(n_nationkey AS VARCHAR) AS folder, CASE WHEN n_nationkey % 3 = 0 THEN 'verified' WHEN n_nationkey % 3 = 1 THEN 'mismatch' ELSE 'no_sidecar' END AS status,
      n_nationkey % 3 <> 1 AS ok FROM nation"""
)
def landing_digests(spark: SparkSession, sf_dir):
    """A folder per nation: a third has a sidecar with the file's digest, a third one with another digest, a third none."""
    rows = table(spark, sf_dir, "nation")
    root = scratch_path(spark, "digests")
    line = F.concat_ws("|", "n_nationkey", "n_name")
    rows.select(line.alias("value"), F.col("n_nationkey").alias("folder")).repartition("folder").write.partitionBy("folder").text(root)
    digest = F.sha2(F.concat(line, F.lit("\n")).cast("binary"), 256)
    wrong = F.when(F.col("n_nationkey") % 3 == 1, F.reverse(digest)).otherwise(digest)
    sidecars = rows.where("n_nationkey % 3 <> 2").select(F.col("n_nationkey").alias("folder"), F.to_json(F.struct(wrong.alias("sha256"))).alias("value"))
    for r in sidecars.collect():  # one small file for each of the 25 nations
        filesystem, inner = locate(f"{root}/folder={r.folder}/{SIDECAR}")
        with filesystem.open_output_stream(inner) as out:
            out.write(r.value.encode())
    audit = verify_sources(spark, root)
    return audit.select(F.regexp_extract("path", "folder=([0-9]+)/", 1).alias("folder"), "status", "ok")


@query("SELECT COUNT(*) AS n_rows, 2 AS n_skipped, 'warn' AS check_status, 'api997.dbf; api998.dbf' AS notes FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice <= 490000")
def county_bad_files(spark, sf_dir):
    """Damaged files among good ones: the good ones are read, the others named by a check."""
    folder = _county_files(spark, sf_dir)
    for name, data in (("api997.dbf", b"short"), ("api998.dbf", b"\x00" * 64)):
        filesystem, inner = locate(f"{folder}/{name}")
        with filesystem.open_output_stream(inner) as out:
            out.write(data)
    bad = bad_files(spark, folder)
    check = Q.evaluate([Q.files_read(bad)])
    n_rows, n_skipped = read_dbase(spark, folder).count(), bad.count()
    return check.select(F.lit(n_rows).cast("bigint").alias("n_rows"), F.lit(n_skipped).alias("n_skipped"), "check_status", "notes")


_CYCLE_TIMES = (1, -2, 3, 4, -5, 6, 7, 8, -9, 10, 11)


@query(
    "SELECT strftime(o_orderdate, '%y%m') AS rpt_cycle_key, "
    + ", ".join(
        f"o_orderkey * {times} AS {f.name}" for f, times in zip([f for f in production.CYCLE if f.kind == production.PACKED], _CYCLE_TIMES, strict=True)
    )
    + """, strftime(o_orderdate, '%Y') AS oil_allow_effect_year, strftime(o_orderdate, '%m') AS oil_allow_effect_month,
      strftime(o_orderdate, '%d') AS oil_allow_effect_day, lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0') AS oil_allow_issue_year,
      lpad(CAST(o_custkey % 100 AS VARCHAR), 2, '0') AS oil_allow_issue_month, lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') AS oil_allow_issue_day FROM orders"""
)
def oil_tape_cycles(spark, sf_dir):
    """All 18 data fields of the cycle segment, each with a value of its own."""
    o = table(spark, sf_dir, "orders")
    packed = [long_to_packed((F.col("o_orderkey") * k).cast("bigint")) for k in _CYCLE_TIMES]
    dates = encode_text(F.concat(F.date_format("o_orderdate", "yyyyMMdd"), _zero("o_custkey", 4), _zero("o_custkey", 2), _zero("o_orderkey", 2)))
    rec = F.concat(encode_text(F.concat(F.lit("02"), F.date_format("o_orderdate", "yyMM"))), *packed[:6], dates, *packed[6:], F.lit(bytearray(b"\x40" * 25)))
    folder = write_binary_files(o.select(rec.alias("rec")), "cycles", ".ebc")
    return production.segment_records(production.read_tape(spark, folder), "02").drop("record_index")


@query(
    """SELECT 'row_count' AS check_name, 'pass' AS check_status, format('{:,}', COUNT(*)) AS check_value, 'delta: +0' AS notes FROM orders UNION ALL
    SELECT 'row_count', 'warn', format('{:,}', COUNT(*) FILTER (o_orderstatus = 'F')), 'delta: -' || format('{:,}', COUNT(*) FILTER (o_orderstatus <> 'F')) FROM orders"""
)
def publish_counts_source(spark, sf_dir):
    """Rows written against rows of the source, both counted by the write: all of them, and with some lost on the way."""
    logs = []
    for keep in ("true", "o_orderstatus = 'F'"):
        source, n = counted(table(spark, sf_dir, "orders"))
        rows = source.where(keep).select("o_orderkey", "o_orderstatus")
        observed, log_of = runner.written_checks(rows, TableRules(), RUN_TS, n)
        logs.append(publish(rows, scratch_path(spark, "counted"), log_of, observed=observed))
    return reduce(DataFrame.unionAll, logs).select("check_name", "check_status", "check_value", "notes")


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS lease_number, strftime(o_orderdate, '%Y') AS prod_year,
      CAST(ROUND(o_totalprice * 100) AS BIGINT) + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS oil_production_bbl,
      CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS corrected_report_flag, TRUE AS first_time, FALSE AS again FROM orders"""
)
def corrections_merged(spark, sf_dir):
    """Corrected reports merged into a table by year: later postings win, earlier ones do not, a batch that comes again does nothing."""
    o = table(spark, sf_dir, "orders")
    reports = o.select(
        F.lit("01").alias("district"), F.col("o_orderkey").cast("string").alias("lease_number"), F.date_format("o_orderdate", "yyMM").alias("rpt_cycle_key"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("oil_production_bbl"), F.lit("N").alias("corrected_report_flag"),
        *[F.date_format("o_orderdate", f).alias(f"posting_{c}") for c, f in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))],
        F.date_format("o_orderdate", "yyyy").alias("prod_year"), "o_orderstatus",
    )
    target = scratch_path(spark, "corrected")
    publish(reports.drop("o_orderstatus"), target, partition_by=["prod_year"])

    def later(status, year, more):
        changed = {"posting_year": F.lit(year), "corrected_report_flag": F.lit("Y"), "oil_production_bbl": F.col("oil_production_bbl") + more}
        return reports.where(F.col("o_orderstatus") == status).withColumns(changed).drop("o_orderstatus")

    first = merge_batch(later("F", "2005", 1), 0, target, "query")
    merge_batch(later("O", "1990", 5), 1, target, "query")
    again = merge_batch(later("O", "2005", 7), 1, target, "query")
    kept = open_table(spark, target).select("lease_number", "prod_year", "oil_production_bbl", "corrected_report_flag")
    return kept.withColumns({"first_time": F.lit(first), "again": F.lit(again)})
