"""Scalar functions over whole columns of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from registrylake.functions import dates, ebcdic, keys, layout, packed, text
from registrylake.workloads.registry import query, table

_LAYOUT = layout.fields(("key", 0, 12), ("name", 12, 25), ("segment", 37, 12), ("nation", 49, 4), ("beyond", 80, 10))


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS name,
    NULLIF(CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END, '') AS segment,
    CAST(c_nationkey AS VARCHAR) AS nation, '' AS beyond FROM customer"""
)
def fixed_width_parse(spark, sf_dir):
    segment = F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_mktsegment"))
    lines = table(spark, sf_dir, "customer").select(
        F.concat(
            F.rpad(F.col("c_custkey").cast("string"), 12, " "), F.rpad("c_name", 25, " "), F.rpad(segment, 12, " "),
            F.lpad(F.col("c_nationkey").cast("string"), 4, "\t"),
        ).alias("value")
    )
    cells = layout.cut_all(F.col("value"), _LAYOUT)
    return lines.select(*cells).withColumn("segment", text.null_if_empty(F.col("segment")))


_VARIANTS = {
    "01": layout.fields(("docket_number", 2, 10), ("filing_date", 12, 8)),
    "02": layout.fields(("party_name", 2, 18)),
    "15": layout.fields(("line_number", 2, 10), ("subject_text", 12, 30)),
}


@query(
    """SELECT CASE o_orderstatus WHEN 'F' THEN '01' WHEN 'O' THEN '02' ELSE '15' END AS record_type,
      CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey AS VARCHAR) END AS docket_number,
      CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y%m%d') END AS filing_date,
      CASE WHEN o_orderstatus = 'O' THEN CAST(o_custkey AS VARCHAR) END AS party_name,
      CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN CAST(o_orderkey AS VARCHAR) END AS line_number,
      CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN o_orderpriority END AS subject_text FROM orders"""
)
def variant_layout_parse(spark, sf_dir):
    key = F.rpad(F.col("o_orderkey").cast("string"), 10, " ")
    status = F.col("o_orderstatus")
    line = (
        F.when(status == "F", F.concat(F.lit("01"), key, F.date_format("o_orderdate", "yyyyMMdd")))
        .when(status == "O", F.concat(F.lit("02"), F.rpad(F.col("o_custkey").cast("string"), 18, " ")))
        .otherwise(F.concat(F.lit("15"), key, F.col("o_orderpriority")))
    )
    value, kind = F.col("value"), F.substring("value", 1, 2)
    cells = [c for wanted, rows in _VARIANTS.items() for c in layout.cut_variant(value, kind, wanted, rows)]
    return table(spark, sf_dir, "orders").select(line.alias("value")).select(kind.alias("record_type"), *cells)


@query(
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' ELSE o_orderstatus END
    AS status, o_orderstatus AS status_raw FROM orders"""
)
def code_map(spark, sf_dir):
    mapped = text.map_codes(F.col("o_orderstatus"), {"F": "filled", "O": "open"})
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", mapped.alias("status"), F.col("o_orderstatus").alias("status_raw")
    )


@query(
    """WITH p AS (
      SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_name END AS l1,
             CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN '' ELSE c_mktsegment END AS l2,
             CASE WHEN c_acctbal < 0 THEN '' ELSE n_name END AS city,
             CASE WHEN c_acctbal < 2000 THEN '' ELSE substr(n_name, 1, 2) END AS st,
             CASE WHEN c_acctbal < 4000 AND c_acctbal > 1000 OR c_acctbal < 0 THEN '' ELSE lpad(CAST(c_nationkey AS VARCHAR), 5, '0') END AS zip
      FROM customer JOIN nation ON c_nationkey = n_nationkey)
    SELECT c_custkey, NULLIF(concat_ws(', ', NULLIF(l1, ''), NULLIF(l2, ''), NULLIF(city, ''), NULLIF(trim(st || ' ' || zip), '')), '')
      AS address FROM p"""
)
def address_join(spark, sf_dir):
    bal, seg = F.col("c_acctbal"), F.col("c_mktsegment")
    rows = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    empty = F.lit("")
    lines = [
        F.when(seg == "BUILDING", empty).otherwise(F.col("c_name")),
        F.when(seg.isin("MACHINERY", "BUILDING"), empty).otherwise(seg),
        F.when(bal < 0, empty).otherwise(F.col("n_name")),
    ]
    state = F.when(bal < 2000, empty).otherwise(F.substring("n_name", 1, 2))
    zip_code = F.when(((bal < 4000) & (bal > 1000)) | (bal < 0), empty).otherwise(
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0")
    )
    return rows.select("c_custkey", text.join_address(lines, state, zip_code).alias("address"))


_DATE_TEXT = """CASE WHEN o_orderstatus = 'P' AND o_totalprice < 50000 THEN '00000000'
  WHEN o_orderstatus = 'P' AND o_totalprice < 100000 THEN '1998'
  WHEN o_orderstatus = 'P' AND o_totalprice < 150000 THEN 'ABCDEFGH'
  WHEN o_orderstatus = 'P' AND o_totalprice < 200000 THEN '        '
  WHEN o_orderstatus = 'P' AND o_totalprice < 250000 THEN '19981399' ELSE {day} END"""


@query(
    f"""WITH d AS (SELECT o_orderkey, {_DATE_TEXT.format(day="strftime(o_orderdate, '%Y%m%d')")} AS s FROM orders)
    SELECT o_orderkey, CASE WHEN length(trim(s)) = 8 AND s <> '00000000'
      THEN substr(s, 1, 4) || '-' || substr(s, 5, 2) || '-' || substr(s, 7, 2) END AS iso,
      CAST(CAST(try_strptime(s, '%Y%m%d') AS DATE) AS VARCHAR) AS calendar FROM d"""
)
def compact_date(spark, sf_dir):
    s = F.expr(_DATE_TEXT.format(day="date_format(o_orderdate, 'yyyyMMdd')"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.compact_date(s).alias("iso"), dates.compact_date_typed(s).cast("string").alias("calendar")
    )


@query(
    f"""WITH d AS (SELECT o_orderkey, TRY_CAST({_DATE_TEXT.format(day="strftime(o_orderdate, '%Y%m%d')")} AS DOUBLE) AS n FROM orders),
    t AS (SELECT o_orderkey, CASE WHEN n > 0 THEN CAST(CAST(n AS BIGINT) AS VARCHAR) END AS s FROM d)
    SELECT o_orderkey, CASE WHEN length(s) = 8 THEN substr(s, 1, 4) || '-' || substr(s, 5, 2) || '-' || substr(s, 7, 2) END AS iso
    FROM t"""
)
def numeric_date(spark, sf_dir):
    s = F.expr(_DATE_TEXT.format(day="date_format(o_orderdate, 'yyyyMMdd')"))
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.numeric_date(text.numeric_or_null(s)).alias("iso"))


@query(
    """WITH c AS (SELECT c_custkey, CAST(ROUND(c_acctbal * 100) AS BIGINT) AS cents FROM customer)
    SELECT c_custkey, cents AS decoded, lpad(CAST(abs(cents) AS VARCHAR), 9, '0') || CASE WHEN cents < 0 THEN 'D' ELSE 'C' END AS packed_hex,
      TRUE AS is_valid FROM c"""
)
def packed_decimal(spark, sf_dir):
    cents = F.expr("CAST(ROUND(c_acctbal * 100) AS BIGINT)")
    rows = table(spark, sf_dir, "customer").select("c_custkey", packed.long_to_packed(cents).alias("b"))
    return rows.select(
        "c_custkey", packed.packed_to_long(F.col("b")).alias("decoded"), F.hex("b").alias("packed_hex"),
        packed.is_valid_packed(F.col("b")).alias("is_valid"),
    )


_NIBBLES = " + ".join(
    f"(instr('0123456789ABCDEF', substr(h, {i}, 1)) - 1) * {10 ** (9 - i)}" for i in range(1, 10)
)


@query(
    f"""WITH t AS (
      SELECT p_partkey, unnest(g) AS h, unnest(range(len(g))) AS piece
      FROM (SELECT p_partkey, regexp_extract_all(hex(encode(p_brand || p_type)), '.{{1,10}}') AS g FROM part))
    SELECT p_partkey, CAST(piece AS INT) AS piece, CAST(({_NIBBLES}) * CASE WHEN substr(h, 10, 1) IN ('B', 'D') THEN -1 ELSE 1 END AS BIGINT) AS decoded,
      regexp_matches(h, '^[0-9]*[A-F]$') AS is_valid FROM (SELECT p_partkey, piece, rpad(h, 10, '0') AS h FROM t)"""
)
def packed_dirty(spark, sf_dir):
    """Text bytes where packed digits should be, the whole text in pieces of five: half-bytes above 9 count with their value."""
    pieces = F.regexp_extract_all(F.hex(F.encode(F.concat("p_brand", "p_type"), "UTF-8")), F.lit(".{1,10}"), F.lit(0))
    rows = table(spark, sf_dir, "part").select("p_partkey", F.posexplode(pieces).alias("piece", "h"))
    b = F.unhex(F.rpad("h", 10, "0"))
    return rows.select(
        "p_partkey", "piece", packed.packed_to_long(b).alias("decoded"), packed.is_valid_packed(b).alias("is_valid")
    )


@query("SELECT p_partkey, p_name AS decoded, length(p_name) AS n_bytes FROM part")
def ebcdic_text(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", ebcdic.encode_text(F.col("p_name")).alias("b"))
    return rows.select(
        "p_partkey", ebcdic.decode_text(F.col("b")).alias("decoded"), F.octet_length("b").cast("bigint").alias("n_bytes")
    )


@query("SELECT s_suppkey, lower(hex(encode(substr(s_name, 1, 40)))) AS raw_hex FROM supplier")
def raw_hex(spark, sf_dir):
    first = ebcdic.byte_slice(F.encode("s_name", "UTF-8"), 0, 40)
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.lower(F.hex(first)).alias("raw_hex"))


def _cycle_sql(fmt):
    return f"""
    WITH k AS (SELECT o_orderkey, strftime(o_orderdate, '{fmt}') AS k FROM orders),
    f AS (SELECT AVG(CASE WHEN CAST(substr(k, 1, 2) AS INT) > 12 THEN 1.0 ELSE 0.0 END) > 0.5 AS year_first FROM k),
    p AS (SELECT o_orderkey, k, CASE WHEN year_first THEN substr(k, 1, 2) ELSE substr(k, 3, 2) END AS yy,
                 CASE WHEN year_first THEN substr(k, 3, 2) ELSE substr(k, 1, 2) END AS mm FROM k, f)
    SELECT o_orderkey, k AS rpt_cycle_key, CASE WHEN yy < '50' THEN '20' ELSE '19' END || yy AS prod_year, mm AS prod_month FROM p"""


def _cycle(spark, sf_dir, fmt):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", fmt).alias("rpt_cycle_key"))
    return dates.split_cycle_key(rows, "rpt_cycle_key")


@query(_cycle_sql("%y%m"))
def cycle_key_year_first(spark, sf_dir):
    return _cycle(spark, sf_dir, "yyMM")


@query(_cycle_sql("%m%y"))
def cycle_key_month_first(spark, sf_dir):
    return _cycle(spark, sf_dir, "MMyy")


_COUNTY = "CASE WHEN c_mktsegment = 'BUILDING' THEN '' WHEN c_mktsegment = 'MACHINERY' THEN '0' ELSE CAST(c_nationkey AS VARCHAR) END"
_UNIQUE = "CASE WHEN c_acctbal < 0 THEN '' WHEN c_acctbal > 9000 THEN '00000' ELSE right(CAST(c_custkey AS VARCHAR), 5) END"
_API = "CASE WHEN c_acctbal < 0 THEN '  ' WHEN c_acctbal > 9000 THEN '1234567890' WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE CAST(c_custkey AS VARCHAR) END"


@query(
    f"""WITH p AS (SELECT c_custkey, lpad({_COUNTY}, 3, '0') AS c, lpad({_UNIQUE}, 5, '0') AS u, trim({_API}) AS a FROM customer)
    SELECT c_custkey, '42' || c || u AS permit, c <> '000' AND u <> '00000' AS permit_valid,
      CASE WHEN c <> '000' AND u <> '00000' THEN '42' || c || u END AS injection,
      CASE WHEN a <> '' THEN '42' || CASE WHEN length(a) < 8 THEN lpad(a, 8, '0') ELSE a END END AS inspection,
      '42' || a AS registry FROM p"""
)
def key_pad(spark, sf_dir):
    sp = lambda s: F.expr(s.replace("VARCHAR", "STRING"))
    county, unique, api = sp(_COUNTY), sp(_UNIQUE), sp(_API)
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        keys.permit_key(county, unique).alias("permit"),
        keys.permit_key_valid(county, unique).alias("permit_valid"),
        keys.injection_key(county, unique).alias("injection"),
        keys.inspection_key(api).alias("inspection"),
        keys.registry_key(F.trim(api)).alias("registry"),
    )


@query(
    """SELECT o_orderkey, CASE WHEN length(CAST(o_orderkey AS VARCHAR)) > 3 THEN right(CAST(o_orderkey AS VARCHAR), 3) ELSE CAST(o_orderkey AS VARCHAR) END AS tail,
      CASE WHEN o_orderstatus = 'P' THEN 0 ELSE CAST(floor(o_totalprice) AS BIGINT) END AS amount,
      strftime(o_orderdate, '%b %Y') AS label FROM orders"""
)
def display_helpers(spark, sf_dir):
    shown = F.when(F.col("o_orderstatus") == "P", " - ").otherwise(F.format_string("%,d", F.floor("o_totalprice")))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text.last_digits(F.col("o_orderkey").cast("string"), 3).alias("tail"),
        text.comma_integer(shown).alias("amount"),
        dates.month_label(F.col("o_orderdate")).alias("label"),
    )
