"""Every data-quality check over whole tables, on both sides of its thresholds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrylake.operators.dedupe import latest_rows
from registrylake.operators.tenure import operator_tenure
from registrylake.quality import checks as Q
from registrylake.quality import runner, summary
from registrylake.quality.config import TableRules
from registrylake.session import scratch_path
from registrylake.sources.paths import locate
from registrylake.workloads.registry import RUN_TS, query, table


def _row(slug, name, level, status, value, threshold, notes, source=""):
    """One check result in SQL; status, value and notes are SQL expressions."""
    quoted = threshold.replace("'", "''")
    return (
        f"SELECT '{slug}' AS table_slug, '{name}' AS check_name, {level}::BIGINT AS check_level, {status} AS check_status, "
        f"{value} AS check_value, '{quoted}' AS check_threshold, {notes} AS notes {source}"
    )


def _checks(**groups: list[Q.Check]) -> DataFrame:
    parts = [Q.evaluate(checks).withColumn("table_slug", F.lit(slug)) for slug, checks in groups.items()]
    return reduce(DataFrame.unionAll, parts)


def _pct(rate):
    return f"printf('%.2f%%', ({rate}) * 100)"


def _num(n):
    return f"format('{{:,}}', CAST({n} AS BIGINT))"


# -- level 1 -----------------------------------------------------------------------------------


def _pk_sql(slug, keys):
    shown = "PK columns: [" + ", ".join(f"''{k}''" for k in keys) + "]"
    dupes = f"(SELECT COALESCE(SUM(n), 0)::BIGINT AS d FROM (SELECT COUNT(*) AS n FROM {slug} GROUP BY {', '.join(keys)} HAVING COUNT(*) > 1))"
    return _row(
        slug, "pk_unique", 1, "CASE WHEN d = 0 THEN 'pass' ELSE 'fail' END", "d || ' duplicates'", "0 duplicates",
        f"'{shown}'", f"FROM {dupes}",
    )


@query(_pk_sql("lineitem", ["l_orderkey", "l_linenumber"]) + " UNION ALL " + _pk_sql("orders", ["o_orderkey"]))
def qa_pk_unique(spark, sf_dir):
    return _checks(
        lineitem=[Q.pk_unique(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])],
        orders=[Q.pk_unique(table(spark, sf_dir, "orders"), "o_orderkey")],
    )


_NULLED = {
    "event_id": "event_id",
    "operator": "CASE WHEN event_type <> 'error' THEN event_type END",
    "props": "CASE WHEN value > 0.05 THEN props END",
    "lease": "CASE WHEN value > 5 THEN props END",
}
_WANTED = ["event_id", "operator", "absent", "props", "lease"]


def _null_issue(c):
    if c == "absent":
        return "'absent missing from DataFrame'"
    return f"CASE WHEN n_{c} > 0.01 THEN '{c}: ' || {_pct(f'n_{c}')} || ' null (threshold 1%)' END"


_NULL_RATES = ", ".join(f"COUNT(*) FILTER (({e}) IS NULL) / COUNT(*) AS n_{c}" for c, e in _NULLED.items())
_NULL_ISSUES = [_null_issue(c) for c in _WANTED]
_NULL_LIST = (
    " + ".join(f"CAST(({x}) IS NOT NULL AS INT)" for x in _NULL_ISSUES) + " AS bad, "
    f"concat_ws('; ', {', '.join(_NULL_ISSUES)}) AS notes"
)


@query(
    f"WITH r AS (SELECT {_NULL_RATES} FROM events), i AS (SELECT {_NULL_LIST}, n_event_id FROM r) "
    + _row("bad", "required_nonnull", 1, "CASE WHEN bad = 0 THEN 'pass' ELSE 'fail' END",
           "bad || ' columns above threshold'", "null rate < 1%", "notes", "FROM i")
    + " UNION ALL "
    + _row("good", "required_nonnull", 1, "CASE WHEN n_event_id > 0.01 THEN 'fail' ELSE 'pass' END", "'all below threshold'",
           "null rate < 1%", "''", "FROM i")
)
def qa_required_nonnull(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr(*[f"{e} AS {c}" for c, e in _NULLED.items()])
    return _checks(bad=[Q.required_nonnull(rows, _WANTED)], good=[Q.required_nonnull(rows, ["event_id"])])


_CLOCK = "1998-01-31T12:00:00+00:00"
_LATE = "SELECT COUNT(*) FILTER (o_orderdate > TIMESTAMP '1998-07-31 12:00:00') AS n, " \
        "COUNT(*) FILTER (o_orderstatus = 'F' AND o_orderdate > TIMESTAMP '1998-07-31 12:00:00') AS m FROM orders"  # fmt: skip


@query(
    f"WITH r AS ({_LATE}) "
    + _row("compact", "date_range_sane", 1, "CASE WHEN m > 0 THEN 'fail' ELSE 'pass' END",
           "CASE WHEN m > 0 THEN '1 columns with future dates' ELSE 'all dates sane' END", "no dates > today + 6 months",
           "CASE WHEN m > 0 THEN 'filed: ' || m || ' rows > 1998-07-31' ELSE '' END", "FROM r")
    + " UNION ALL "
    + _row("typed", "date_range_sane", 1, "CASE WHEN n > 0 THEN 'fail' ELSE 'pass' END",
           "CASE WHEN n > 0 THEN '1 columns with future dates' ELSE 'all dates sane' END", "no dates > today + 6 months",
           "CASE WHEN n > 0 THEN 'o_orderdate: ' || n || ' rows > 1998-07-31' ELSE '' END", "FROM r")
    + " UNION ALL "
    + _row("later_clock", "date_range_sane", 1, "'pass'", "'all dates sane'", "no dates > today + 6 months", "''")
)
def qa_date_range(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    text_date = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyyMMdd")).otherwise("pending")
    compact = orders.select(text_date.alias("filed"))
    return _checks(
        compact=[Q.date_range_sane(compact, ["filed", "absent"], _CLOCK)],
        typed=[Q.date_range_sane(orders, ["o_orderdate"], _CLOCK)],
        later_clock=[Q.date_range_sane(orders, ["o_orderdate"], RUN_TS)],
    )


@query(
    _row("customer", "boolean_not_uniform", 1, "'warn'", "'2 uniform boolean columns'",
         "at least 2 distinct values per boolean", "'known=True; never=empty'",
         "FROM (SELECT 1 WHERE (SELECT COUNT(DISTINCT c_acctbal > 0) FROM customer) = 2)")
    + " UNION ALL "
    + _row("owing", "boolean_not_uniform", 1, "'pass'", "'all booleans have variation'",
           "at least 2 distinct values per boolean", "''",
           "FROM (SELECT 1 WHERE (SELECT COUNT(DISTINCT c_acctbal > 0) FROM customer) = 2)")
)
def qa_boolean_uniform(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_acctbal > 0 AS credit", "c_custkey >= 0 AS known", "CAST(NULL AS BOOLEAN) AS never"
    )
    return _checks(
        customer=[Q.boolean_not_uniform(rows, ["credit", "known", "never", "absent"])],
        owing=[Q.boolean_not_uniform(rows, ["credit"])],
    )


def _count_sql(slug, expected, tolerance=0.01):
    ratio = f"abs(n - {expected}) / {expected}"
    return _row(
        slug, "row_count", 1, f"CASE WHEN {ratio} <= {tolerance} THEN 'pass' ELSE 'warn' END", _num("n"),
        f"{expected:,} +/- {tolerance:.0%}",
        f"'delta: ' || CASE WHEN n - {expected} >= 0 THEN '+' ELSE '' END || {_num(f'n - {expected}')}",
        f"FROM (SELECT COUNT(*) AS n FROM {slug})",
    )


def _sane_sql(slug, lo, hi, entity):
    ok = f"n BETWEEN {lo} AND {hi}"
    return _row(
        slug, "count_sanity", 3, f"CASE WHEN {ok} THEN 'pass' ELSE 'fail' END", f"{_num('n')} || ' {entity}'",
        f"{lo:,}-{hi:,}", f"CASE WHEN {ok} THEN 'within range' ELSE 'outside range' END",
        f"FROM (SELECT COUNT(*) AS n FROM {slug})",
    )


@query(" UNION ALL ".join([_count_sql("lineitem", 60_000), _count_sql("orders", 14_900), _count_sql("customer", 100)]))
def qa_row_count(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    return _checks(
        lineitem=[Q.row_count(t("lineitem"), 60_000)],
        orders=[Q.row_count(t("orders"), 14_900)],
        customer=[Q.row_count(t("customer"), 100)],
    )


@query(" UNION ALL ".join([_sane_sql("lineitem", 50_000, 70_000, "lines"), _sane_sql("events", 1, 10, "events")]))
def qa_count_sanity(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    return _checks(
        lineitem=[Q.count_sanity(t("lineitem"), 50_000, 70_000, "lines")],
        events=[Q.count_sanity(t("events"), 1, 10, "events")],
    )


@query(
    _row("filled", "row_count_match", 1, "CASE WHEN o = n THEN 'pass' ELSE 'fail' END",
         f"{_num('o')} || ' of ' || {_num('n')}", "exact match", f"'delta: ' || {_num('o - n')}",
         "FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (o_orderstatus = 'F') AS o FROM orders)")
    + " UNION ALL "
    + _row("same", "row_count_match", 1, "'pass'", f"{_num('n')} || ' of ' || {_num('n')}", "exact match", "'delta: +0'",
           "FROM (SELECT COUNT(*) AS n FROM orders)")
)
def qa_row_count_match(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    filled = orders.where("o_orderstatus = 'F'")
    return _checks(filled=[Q.row_count_match(orders, filled)], same=[Q.row_count_match(orders, orders)])


_TYPES = {"l_orderkey": "bigint", "l_returnflag": "string", "l_linenumber": "bigint"}


@query(
    " UNION ALL ".join(
        [
            _row("lineitem", "schema_match", 1, "'fail'", "'1 missing'", "all expected columns present", "'missing: [''l_absent'']'"),
            _row("lineitem", "dtype_match", 1, "'fail'", "'1 columns of another dtype'", "all dtypes match", "'l_linenumber: int != bigint'"),
            _row("lineitem", "identifier_columns_str", 1, "'fail'", "'1 non-str ID columns'", "all str", "'l_orderkey: bigint'"),
            _row("lineitem", "api_column_named_l_orderkey", 1, "'pass'", "'present'", "column exists", "''"),
            _row("lineitem", "api_column_named_api10", 1, "'fail'", "'missing'", "column exists", "'no column api10'"),
            _row("orders", "schema_match", 1, "'pass'", "'all present'", "all expected columns present", "''"),
            _row("orders", "identifier_columns_str", 1, "'pass'", "'all ID columns are str'", "all str", "''"),
            _row("orders", "dtype_consistency", 2, "'pass'", "'1 distinct dtypes for ''doc_id'''", "1 dtype across all tables", "''"),
            _row("orders", "dtype_consistency", 2, "'fail'", "'2 distinct dtypes for ''key'''", "1 dtype across all tables",
                 "'dtypes: {''orders'': ''bigint'', ''nation'': ''int''}'"),
        ]
    )
)
def qa_schema(spark, sf_dir):
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    docs = {n: table(spark, sf_dir, n) for n in ("documents", "labels")}
    mixed = {
        "orders": orders.withColumnRenamed("o_orderkey", "key"),
        "nation": table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "key"),
    }
    return _checks(
        lineitem=[
            Q.schema_match(lines, ["l_orderkey", "l_absent"]),
            Q.dtype_match(lines, _TYPES),
            Q.identifier_columns_str(lines, ["l_orderkey", "l_returnflag", "l_absent"]),
            Q.key_column_named(lines, "l_orderkey"),
            Q.key_column_named(lines, "api10"),
        ],
        orders=[
            Q.schema_match(orders, ["o_orderkey", "o_custkey"]),
            Q.identifier_columns_str(orders, ["o_orderstatus"]),
            Q.dtype_consistency(docs, "doc_id"),
            Q.dtype_consistency(mixed, "key"),
        ],
    )


# -- level 2 -----------------------------------------------------------------------------------


def _fk_sql(slug, child, fk, parent, pk):
    src = (
        f"FROM (SELECT COUNT({fk}) AS t, COUNT({fk}) FILTER ({fk} IN (SELECT {pk} FROM {parent} WHERE {pk} IS NOT NULL)) AS m FROM {child})"
    )
    rate = "CASE WHEN t > 0 THEN m / t ELSE 1.0 END"
    return _row(
        slug, "fk_match_rate", 2,
        f"CASE WHEN {rate} >= 0.99 THEN 'pass' WHEN {rate} >= 0.95 THEN 'warn' ELSE 'fail' END",
        f"{_pct(rate)} || ' (' || {_num('t - m')} || ' orphans)'", ">=99%", f"'{fk} -> {pk}'", src,
    )


def _orphan_sql(slug, child, fk, parent, pk):
    src = (
        f"FROM (SELECT COUNT({fk}) AS t, COUNT({fk}) FILTER ({fk} IN (SELECT {pk} FROM {parent})) AS m FROM {child})"
    )
    rate = "CASE WHEN t > 0 THEN (t - m) / t ELSE 0.0 END"
    return _row(
        slug, "orphan_count", 2,
        f"CASE WHEN {rate} > 0.20 THEN 'fail' WHEN {rate} > 0.05 THEN 'warn' ELSE 'pass' END",
        f"{_num('t - m')} || ' orphans (' || {_pct(rate)} || ')'", "warn > 5%, fail > 20%", f"'{fk} -> {pk}'", src,
    )


_RICH = "(SELECT c_custkey FROM customer WHERE c_acctbal > -700)"
_FILLED = "(SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')"


@query(
    " UNION ALL ".join(
        [
            _fk_sql("orders", "orders", "o_custkey", "customer", "c_custkey"),
            _fk_sql("rich", "orders", "o_custkey", _RICH, "c_custkey"),
            _fk_sql("filled", "lineitem", "l_orderkey", _FILLED, "o_orderkey"),
            _fk_sql("nokeys", "(SELECT NULL::BIGINT AS k FROM orders)", "k", "customer", "c_custkey"),
            _row("missing", "fk_match_rate", 2, "'error'", "'o_absent not in table'", ">=99%", "''"),
        ]
    )
)
def qa_fk_match(spark, sf_dir):
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return _checks(
        orders=[Q.fk_match_rate(orders, "o_custkey", customers, "c_custkey")],
        rich=[Q.fk_match_rate(orders, "o_custkey", customers.where("c_acctbal > -700"), "c_custkey")],
        filled=[Q.fk_match_rate(table(spark, sf_dir, "lineitem"), "l_orderkey", orders.where("o_orderstatus = 'F'"), "o_orderkey")],
        nokeys=[Q.fk_match_rate(orders.selectExpr("CAST(NULL AS BIGINT) AS k"), "k", customers, "c_custkey")],
        missing=[Q.fk_match_rate(orders, "o_absent", customers, "c_custkey")],
    )


@query(
    " UNION ALL ".join(
        [
            _orphan_sql("orders", "orders", "o_custkey", "customer", "c_custkey"),
            _orphan_sql("rich", "orders", "o_custkey", "(SELECT c_custkey FROM customer WHERE c_acctbal > 200)", "c_custkey"),
            _orphan_sql("filled", "lineitem", "l_orderkey", _FILLED, "o_orderkey"),
            _row("filled", "orphan_distribution", 2, "CASE WHEN top / t > 0.5 THEN 'warn' ELSE 'pass' END",
                 f"'largest category ' || {_pct('top / t')}", "no category > 50% of orphans", "'largest: ' || who",
                 "FROM (SELECT SUM(n) AS t, MAX(n) AS top, arg_max(l_linestatus, (n, l_linestatus)) AS who FROM "
                 f"(SELECT l_linestatus, COUNT(*) AS n FROM lineitem WHERE l_orderkey NOT IN {_FILLED} GROUP BY 1))"),
        ]
    )
)
def qa_orphans(spark, sf_dir):
    orders, customers, lines = (table(spark, sf_dir, n) for n in ("orders", "customer", "lineitem"))
    filled = orders.where("o_orderstatus = 'F'")
    return _checks(
        orders=[Q.orphan_count(orders, "o_custkey", customers, "c_custkey")],
        rich=[Q.orphan_count(orders, "o_custkey", customers.where("c_acctbal > 200"), "c_custkey")],
        filled=[
            Q.orphan_count(lines, "l_orderkey", filled, "o_orderkey"),
            Q.orphan_distribution(lines, "l_orderkey", filled, "o_orderkey", "l_linestatus"),
        ],
    )


@query(
    f"SELECT l_returnflag AS category, COUNT(*) AS n_orphans FROM lineitem WHERE l_orderkey NOT IN {_FILLED} GROUP BY 1"
)
def qa_orphans_by_category(spark, sf_dir):
    filled = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    return Q.orphans_by_category(table(spark, sf_dir, "lineitem"), "l_orderkey", filled, "o_orderkey", "l_returnflag")


def _card_sql(slug, col, bound, quote):
    q = "''''" if quote else "''"
    return _row(
        slug, "cardinality_bounds", 2, f"CASE WHEN MAX(n) <= {bound} THEN 'pass' ELSE 'warn' END",
        f"'max group: ' || {_num('MAX(n)')}", f"max <= {bound:,}",
        f"'top groups: {{' || string_agg({q} || k || {q} || ': ' || n, ', ' ORDER BY n DESC, k DESC) || '}}'",
        f"FROM (SELECT {col} AS k, COUNT(*) AS n FROM {slug} WHERE {col} IS NOT NULL GROUP BY 1 ORDER BY n DESC, k LIMIT 3)",
    )


@query(_card_sql("events", "event_type", 100_000_000, True) + " UNION ALL " + _card_sql("lineitem", "l_returnflag", 5, True))
def qa_cardinality(spark, sf_dir):
    return _checks(
        events=[Q.cardinality_bounds(table(spark, sf_dir, "events"), "event_type", 100_000_000)],
        lineitem=[Q.cardinality_bounds(table(spark, sf_dir, "lineitem"), "l_returnflag", 5)],
    )


_SEVERAL = "SELECT p_name, COUNT(DISTINCT p_partkey) AS n_ids FROM part GROUP BY 1 HAVING COUNT(DISTINCT p_partkey) > 1"


@query(
    _row("part", "name_to_id_cardinality", 2, "CASE WHEN n = 0 THEN 'pass' ELSE 'fail' END", "n || ' names with several IDs'",
         "no name maps to 2+ IDs", "CASE WHEN n = 0 THEN '' ELSE 'up to ' || m || ' IDs per name' END",
         f"FROM (SELECT COUNT(*) AS n, MAX(n_ids) AS m FROM ({_SEVERAL}))")
    + " UNION ALL "
    + _row("customer", "name_to_id_cardinality", 2, "'pass'", "'0 names with several IDs'", "no name maps to 2+ IDs", "''")
)
def qa_name_to_id(spark, sf_dir):
    return _checks(
        part=[Q.name_to_id_cardinality(table(spark, sf_dir, "part"), "p_name", "p_partkey")],
        customer=[Q.name_to_id_cardinality(table(spark, sf_dir, "customer"), "c_name", "c_custkey")],
    )


@query(_SEVERAL)
def qa_names_with_several_ids(spark, sf_dir):
    return Q.names_with_several_ids(table(spark, sf_dir, "part"), "p_name", "p_partkey")


_SNAPSHOT = "SELECT user_id, CASE WHEN value > {0} THEN 'stale' ELSE event_type END AS s, event_type AS c FROM events " \
            "QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"  # fmt: skip


def _cross_sql(slug, cut):
    return _row(
        slug, "cross_ref_consistency", 2, "CASE WHEN same / n >= 0.99 THEN 'pass' ELSE 'fail' END",
        f"{_pct('same / n')} || ' (' || {_num('n - same')} || ' stale)'", ">=99%", "'operator = operator_name'",
        f"FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (s = c) AS same FROM ({_SNAPSHOT.format(cut)}))",
    )


@query(_cross_sql("altered", 30) + " UNION ALL " + _cross_sql("faithful", 1e9))
def qa_cross_ref(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    history = operator_tenure(
        ev.select(
            F.col("user_id").alias("api10"), F.col("event_type").alias("operator"),
            F.date_format("ts", "yyyyMMdd").alias("completion"), F.col("props").alias("lease_name"), "event_id",
        ),
        ["event_id"],
    )
    current = history.where("is_current")
    last = latest_rows(ev, ["user_id"], ["ts", "event_id"])

    def snapshot(cut):
        field = F.when(F.col("value") > cut, "stale").otherwise(F.col("event_type"))
        return last.select(F.col("user_id").alias("api10"), field.alias("operator"))

    return _checks(
        altered=[Q.cross_ref_consistency(snapshot(30), current, "api10", "operator", "operator_name")],
        faithful=[Q.cross_ref_consistency(snapshot(1e9), current, "api10", "operator", "operator_name")],
    )


# -- level 3 -----------------------------------------------------------------------------------

_MANIFEST = [("lineitem", 60_000), ("orders", 14_999), ("retired", 10)]
_COUNTED = ("lineitem", "orders", "customer")


def _manifest(spark, sf_dir):
    manifest = spark.createDataFrame(_MANIFEST, "table_name string, n_rows bigint")
    counts = reduce(
        DataFrame.unionAll,
        [table(spark, sf_dir, n).agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for n in _COUNTED],
    )
    return manifest, counts


_MANIFEST_SQL = f"""
    WITH m AS (SELECT * FROM (VALUES {', '.join(f"('{t}', {n}::BIGINT)" for t, n in _MANIFEST)}) v(table_name, manifest_rows)),
    a AS ({' UNION ALL '.join(f"SELECT '{t}' AS table_name, COUNT(*) AS actual_rows FROM {t}" for t in _COUNTED)})
    SELECT COALESCE(m.table_name, a.table_name) AS table_name, manifest_rows, actual_rows,
      CASE WHEN m.table_name IS NULL THEN 'not_in_manifest' WHEN a.table_name IS NULL THEN 'missing_table'
           WHEN manifest_rows = actual_rows THEN 'match' ELSE 'count_differs' END AS manifest_status
    FROM m FULL JOIN a ON m.table_name = a.table_name"""


@query(_MANIFEST_SQL)
def qa_manifest(spark, sf_dir):
    return Q.manifest_differences(*_manifest(spark, sf_dir))


@query(
    _row("bundle", "manifest_consistency", 3, "CASE WHEN bad = 0 THEN 'pass' ELSE 'fail' END",
         "bad || ' of ' || n || ' tables differ'", "exact match", "''",
         f"FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (manifest_status <> 'match') AS bad FROM ({_MANIFEST_SQL}))")
)
def qa_manifest_check(spark, sf_dir):
    return _checks(bundle=[Q.manifest_consistency(*_manifest(spark, sf_dir))])


def _extracted(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("lang", (F.col("n_chars") > 600).alias("extracted"))


_COVER = """SELECT lang AS document_type, COUNT(*) AS n_documents, COUNT(*) FILTER (n_chars > 600) AS n_extracted,
    CASE WHEN COUNT(*) FILTER (n_chars > 600) / COUNT(*) >= 0.9 THEN 'pass'
         WHEN COUNT(*) FILTER (n_chars > 600) / COUNT(*) >= 0.8 THEN 'warn' ELSE 'fail' END AS check_status
    FROM documents GROUP BY 1"""


@query(_COVER)
def extraction_coverage(spark, sf_dir):
    return Q.coverage_by_type(_extracted(spark, sf_dir), "lang", F.col("extracted"))


@query(
    _row("documents", "extraction_coverage", 3,
         "CASE WHEN r >= 0.9 THEN 'pass' WHEN r >= 0.8 THEN 'warn' ELSE 'fail' END", f"'lowest rate ' || {_pct('r')}",
         "pass >= 90%, warn >= 80%", "'lowest: ' || who",
         f"FROM (SELECT MIN(n_extracted / n_documents) AS r, arg_min(document_type, (n_extracted / n_documents, document_type)) AS who FROM ({_COVER}))")
)
def extraction_coverage_check(spark, sf_dir):
    return _checks(documents=[Q.extraction_coverage(_extracted(spark, sf_dir), "lang", F.col("extracted"))])


_ONLY = "SELECT l_orderkey, COUNT(*) AS n_reports FROM lineitem GROUP BY 1 HAVING NOT bool_or(l_returnflag = 'R')"


@query(_ONLY)
def corrected_only_original(spark, sf_dir):
    return Q.only_original_reports(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_returnflag", "R")


@query(
    _row("lineitem", "corrected_report_handling", 3, "CASE WHEN n = 0 THEN 'pass' ELSE 'warn' END",
         f"{_num('n')} || ' with original report only'", "corrected report present", "''", f"FROM (SELECT COUNT(*) AS n FROM ({_ONLY}))")
)
def qa_corrected_reports(spark, sf_dir):
    return _checks(
        lineitem=[Q.corrected_report_handling(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_returnflag", "R")]
    )


# -- runner and summary --------------------------------------------------------------------------

_RULES = {
    "orders": TableRules(
        pk=("o_orderkey",), required=("o_orderkey", "o_custkey"), id_cols=("o_orderstatus",),
        date_cols=("o_orderdate",), fk=(("o_custkey", "customer", "c_custkey"),), count_range=(1, 1_000_000_000, "orders"),
    ),
    "customer": TableRules(pk=("c_custkey",), id_cols=("c_custkey",), cardinality=(("c_mktsegment", 10),), expected_columns=("c_name",)),
}


def _tagged(sql):
    return f"SELECT * EXCLUDE (table_slug), table_slug, 'retroactive-2026-05-13T00:00:00' AS ingestion_run_id, '{RUN_TS}' AS checked_at FROM ({sql})"


@query(
    _tagged(
        " UNION ALL ".join(
            [
                _pk_sql("orders", ["o_orderkey"]),
                _row("orders", "required_nonnull", 1, "'pass'", "'all below threshold'", "null rate < 1%", "''"),
                _row("orders", "date_range_sane", 1, "'pass'", "'all dates sane'", "no dates > today + 6 months", "''"),
                _row("orders", "identifier_columns_str", 1, "'pass'", "'all ID columns are str'", "all str", "''"),
                _row("orders", "row_count", 1, "'pass'", _num("n"), "own count +/- 0%", "'delta: +0'", "FROM (SELECT COUNT(*) AS n FROM orders)"),
                _fk_sql("orders", "orders", "o_custkey", "customer", "c_custkey"),
                _sane_sql("orders", 1, 1_000_000_000, "orders"),
                _pk_sql("customer", ["c_custkey"]),
                _row("customer", "identifier_columns_str", 1, "'fail'", "'1 non-str ID columns'", "all str", "'c_custkey: bigint'"),
                _row("customer", "schema_match", 1, "'pass'", "'all present'", "all expected columns present", "''"),
                _row("customer", "row_count", 1, "'pass'", _num("n"), "own count +/- 0%", "'delta: +0'", "FROM (SELECT COUNT(*) AS n FROM customer)"),
                _card_sql("customer", "c_mktsegment", 10, True),
                _row("lost", "table_exists", 1, "'error'", "'File not found for lost'", "file exists", "''"),
            ]
        )
    )
)
def qa_run_all(spark, sf_dir):
    tables = {"orders": table(spark, sf_dir, "orders"), "customer": table(spark, sf_dir, "customer"), "lost": None}
    return runner.run_all(spark, tables, RUN_TS, _RULES)


_LOG = """SELECT 'user_' || user_id AS table_slug, event_type AS check_name,
    CAST(CASE event_type WHEN 'click' THEN 2 WHEN 'view' THEN 3 ELSE 1 END AS BIGINT) AS check_level,
    CASE WHEN value < 5 THEN 'fail' WHEN value < 10 THEN 'warn' WHEN value < 11 THEN 'error' ELSE 'pass' END AS check_status,
    props AS check_value, 'none' AS check_threshold, '' AS notes,
    {ts} AS checked_at, 'run-' || event_id AS ingestion_run_id FROM events"""
_LOG_SQL = _LOG.format(ts="strftime(ts, '%Y-%m-%dT%H:%M:%S')")
_LATEST_SQL = """SELECT table_slug, check_name, check_level, check_status AS latest_status, check_value AS latest_value,
    check_threshold AS latest_threshold, checked_at AS latest_checked_at, ingestion_run_id AS latest_run_id, notes
    FROM ({log}) {where} QUALIFY ROW_NUMBER() OVER (PARTITION BY table_slug, check_name
      ORDER BY checked_at DESC, ingestion_run_id DESC) = 1"""
_BEFORE = "checked_at < '2024-01-10'"


def _log(spark, sf_dir):
    log = _LOG.format(ts="date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")").replace("FROM events", "FROM {events}")
    return spark.sql(log, events=table(spark, sf_dir, "events"))


@query(_LATEST_SQL.format(log=_LOG_SQL, where=""))
def qa_summary_latest(spark, sf_dir):
    return summary.latest_status(_log(spark, sf_dir))


@query(
    f"""WITH c AS ({_LATEST_SQL.format(log=_LOG_SQL, where='')}), p AS ({_LATEST_SQL.format(log=_LOG_SQL, where=f'WHERE {_BEFORE}')})
    SELECT c.*, COALESCE(p.latest_status, '') <> c.latest_status AS is_new FROM c LEFT JOIN p USING (table_slug, check_name)
    WHERE c.latest_status IN ('fail', 'warn')"""
)
def qa_new_issues(spark, sf_dir):
    log = _log(spark, sf_dir)
    return summary.new_issues(summary.latest_status(log), summary.latest_status(log.where(_BEFORE)))


_ROLL = ", ".join(f"COUNT(*) FILTER (check_status = '{s}') AS n_{s}" for s in summary.STATUSES)


@query(
    f"""WITH l AS ({_LOG_SQL}) SELECT 'L' || check_level AS level, {_ROLL} FROM l GROUP BY check_level
    UNION ALL SELECT 'Total', {_ROLL} FROM l"""
)
def qa_status_rollup(spark, sf_dir):
    return summary.status_rollup(_log(spark, sf_dir))


@query(
    """SELECT 'events' AS table_slug, event_type AS check_name, COUNT(*) AS n, NULL AS value FROM events GROUP BY event_type UNION ALL
    SELECT 'junk', '_read_error', 1, 'Failed to read log' UNION ALL SELECT 'torn', '_read_error', 1, 'Failed to read log'"""
)
def qa_junk_logs(spark, sf_dir):
    """A log that is no Parquet file and one cut short, among a good one: each is one error row, the good one stays whole."""
    folder = scratch_path(spark, "logs")
    rows = table(spark, sf_dir, "events").select(
        F.lit("run").alias("ingestion_run_id"), F.col("event_type").alias("check_name"), F.lit(1).cast("bigint").alias("check_level"),
        *[F.lit("x").alias(c) for c in ("check_status", "check_value", "check_threshold", "checked_at", "notes")],
    )
    rows.write.parquet(f"{folder}/events")
    for name, data in (("junk", b"no parquet"), ("torn", b"PAR1" + b"\x15" * 100 + b"PAR1")):
        filesystem, inner = locate(f"{folder}/{name}")
        filesystem.create_dir(inner)
        with filesystem.open_output_stream(f"{inner}/part-0.parquet") as out:
            out.write(data)
    openers = {s: (lambda s=s: spark.read.schema(runner.LOG_SCHEMA).parquet(f"{folder}/{s}")) for s in ("events", "junk", "torn")}
    log = summary.collect_logs(spark, openers, RUN_TS)
    return log.groupBy("table_slug", "check_name").agg(F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("check_level") == 0, F.col("notes"))).alias("value"))


def _well(column):
    return F.concat(F.lit("42"), F.lpad(F.col(column).cast("string"), 8, "0"))


_PASSING = (
    ("well_master", "pk_unique required_nonnull identifier_columns_str schema_match dtype_match api_column_named_api10 row_count"),
    ("fact_well_completions", "pk_unique required_nonnull identifier_columns_str schema_match dtype_match api_column_named_api10 row_count fk_match_rate"),
    ("dim_operator_registry", "pk_unique required_nonnull identifier_columns_str schema_match row_count name_to_id_cardinality"),
    ("dim_operator_history", "required_nonnull boolean_not_uniform identifier_columns_str row_count cross_ref_consistency"),
)
_ORPHANS = "(SELECT COUNT(*) FILTER (c_custkey IS NULL OR c_acctbal < 0) / COUNT(*) AS r FROM orders LEFT JOIN customer ON o_custkey = c_custkey)"


@query(
    " UNION ALL ".join(f"SELECT '{slug}' AS table_slug, '{name}' AS check_name, 'pass' AS check_status" for slug, names in _PASSING for name in names.split())
    + f"""
    UNION ALL SELECT 'well_master', 'count_sanity', CASE WHEN COUNT(*) FILTER (c_acctbal >= 0) BETWEEN 1000000 AND 1500000 THEN 'pass' ELSE 'fail' END FROM customer
    UNION ALL SELECT 'dim_operator_registry', 'count_sanity', CASE WHEN COUNT(*) BETWEEN 30000 AND 80000 THEN 'pass' ELSE 'fail' END FROM supplier
    UNION ALL SELECT 'fact_well_completions', 'cardinality_bounds', CASE WHEN MAX(n) <= 1000 THEN 'pass' ELSE 'warn' END
      FROM (SELECT COUNT(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal >= 0 GROUP BY o_custkey)
    UNION ALL SELECT 'fact_well_completions', 'orphan_count', 'pass'
    UNION ALL SELECT 'dim_operator_history', 'fk_match_rate', CASE WHEN 1 - r >= 0.99 THEN 'pass' WHEN 1 - r >= 0.95 THEN 'warn' ELSE 'fail' END FROM {_ORPHANS}
    UNION ALL SELECT 'dim_operator_history', 'orphan_count', CASE WHEN r > 0.20 THEN 'fail' WHEN r > 0.05 THEN 'warn' ELSE 'pass' END FROM {_ORPHANS}"""
)
def qa_published_rules(spark, sf_dir):
    """The rules of the published tables themselves; operator history has wells that the master lacks."""
    wells = table(spark, sf_dir, "customer").where("c_acctbal >= 0")
    orders = table(spark, sf_dir, "orders")
    tables = {
        "well_master": wells.select(_well("c_custkey").alias("api10"), F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("apinum")),
        "fact_well_completions": orders.join(wells, F.col("o_custkey") == F.col("c_custkey")).select(
            _well("o_custkey").alias("api10"), F.col("o_orderkey").cast("string").alias("gas_rrcid")
        ),
        "dim_operator_registry": table(spark, sf_dir, "supplier").select(
            F.lpad(F.col("s_suppkey").cast("string"), 6, "0").alias("operator_number"), F.col("s_name").alias("operator_name")
        ),
        "dim_operator_history": orders.select(
            _well("o_custkey").alias("api10"), F.col("o_orderpriority").alias("operator_name"), (F.col("o_orderstatus") == "F").alias("is_current")
        ),
    }
    return runner.run_all(spark, tables, RUN_TS).select("table_slug", "check_name", "check_status")
