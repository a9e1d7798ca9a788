"""Tenure, crosswalk, carried context, dedupe, key sets, profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from registrylake.operators import carry, crosswalk, dedupe, keysets, profile, tenure
from registrylake.workloads.registry import query, table

# -- tenure ------------------------------------------------------------------------------------


def _completions(spark, sf_dir, key=None, completion=None):
    ev = table(spark, sf_dir, "events")
    day = F.date_format("ts", "yyyyMMdd")
    return ev.select(
        (key if key is not None else F.col("user_id")).alias("api10"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("operator"),
        (completion(day) if completion else day).alias("completion"),
        F.when(F.col("value") > 5, F.col("props")).alias("lease_name"),
        F.col("event_id").alias("seq"),
    )


def _tenure_sql(key="user_id", completion="strftime(ts, '%Y%m%d')"):
    return f"""
    WITH c AS (
      SELECT {key} AS api10, CASE WHEN event_type <> 'error' THEN event_type END AS operator,
             {completion} AS completion, CASE WHEN value > 5 THEN props END AS lease_name, event_id AS seq
      FROM events),
    o AS (SELECT *, COALESCE(TRY_CAST(completion AS DOUBLE), 0) AS ord FROM c WHERE operator IS NOT NULL),
    l AS (SELECT *, LAG(operator) OVER (PARTITION BY api10 ORDER BY ord, seq) AS prev FROM o),
    s AS (SELECT * FROM l WHERE prev IS NULL OR prev <> operator)
    SELECT api10, '' AS operator_number, operator AS operator_name, completion AS effective_date,
           LEAD(completion) OVER w AS termination_date, LEAD(1) OVER w IS NULL AS is_current,
           COALESCE(lease_name, '') AS lease_number, '' AS district
    FROM s WINDOW w AS (PARTITION BY api10 ORDER BY ord, seq)"""


@query(_tenure_sql())
def tenure_history(spark, sf_dir):
    return tenure.operator_tenure(_completions(spark, sf_dir), ["seq"])


_BAD_DATE = "CASE WHEN event_type = 'view' THEN NULL WHEN event_type = 'signup' THEN 'n/a' ELSE strftime(ts, '%Y%m%d') END"


@query(_tenure_sql(completion=_BAD_DATE))
def tenure_null_dates(spark, sf_dir):
    def spoil(day):
        kind = F.col("event_type")
        return F.when(kind == "view", F.lit(None)).when(kind == "signup", "n/a").otherwise(day)

    return tenure.operator_tenure(_completions(spark, sf_dir, completion=spoil), ["seq"])


_HOT_USER = "CASE WHEN event_type IN ('click', 'view', 'error') THEN -1 ELSE user_id END"


@query(_tenure_sql(key=_HOT_USER))
def tenure_skewed_key(spark, sf_dir):
    """Over half of the rows on one key, which many ranges share."""
    return tenure.operator_tenure(_completions(spark, sf_dir, key=F.expr(_HOT_USER)), ["seq"], ranges=64)


@query(
    f"""WITH h AS ({_tenure_sql()})
    SELECT COUNT(*) AS n_wells, COUNT(*) FILTER (n > 1) AS n_multiple_current
    FROM (SELECT api10, COUNT(*) FILTER (is_current) AS n FROM h GROUP BY api10)"""
)
def tenure_current_multiplicity(spark, sf_dir):
    history = tenure.operator_tenure(_completions(spark, sf_dir), ["seq"])
    wells = history.select("api10").distinct().agg(F.count("api10").alias("n_wells"))
    several = tenure.multiple_current(history).agg(F.count(F.lit(1)).alias("n_multiple_current"))
    return wells.select("n_wells", several.scalar().alias("n_multiple_current"))


# -- crosswalk ---------------------------------------------------------------------------------


def _crosswalk_rows(spark, sf_dir, key):
    shipped = F.date_format("l_shipdate", "yyyyMMdd")
    bad = (F.col("l_returnflag") == "R") & (F.col("l_tax") == 0)
    return table(spark, sf_dir, "lineitem").select(
        key.alias("api10"),
        F.col("l_suppkey").cast("string").alias("lease_name"),
        F.when(bad, "unknown").otherwise(shipped).alias("completion"),
        F.when(F.col("l_discount") > 0, F.col("l_orderkey")).alias("gas_rrcid"),
        *[F.col(c) for c in ("l_orderkey", "l_linenumber", "l_suppkey")],
    )


def _crosswalk_sql(key="l_partkey"):
    iso = "CASE WHEN {0} > 0 AND length(CAST(CAST({0} AS BIGINT) AS VARCHAR)) = 8 THEN " \
          "substr(CAST(CAST({0} AS BIGINT) AS VARCHAR), 1, 4) || '-' || substr(CAST(CAST({0} AS BIGINT) AS VARCHAR), 5, 2) " \
          "|| '-' || substr(CAST(CAST({0} AS BIGINT) AS VARCHAR), 7, 2) END"  # fmt: skip
    return f"""
    WITH n AS (
      SELECT {key} AS api10, CAST(l_suppkey AS VARCHAR) AS lease_name,
             CASE WHEN l_returnflag = 'R' AND l_tax = 0 THEN NULL
                  ELSE TRY_CAST(strftime(l_shipdate, '%Y%m%d') AS DOUBLE) END AS num,
             CASE WHEN l_discount > 0 THEN l_orderkey END AS rec, l_orderkey, l_linenumber, l_suppkey
      FROM lineitem),
    p AS (SELECT api10, lease_name, MIN(num) AS f, MAX(num) AS l, COUNT(rec) AS n FROM n GROUP BY 1, 2),
    cur AS (
      SELECT api10, lease_name AS current_lease FROM n
      QUALIFY ROW_NUMBER() OVER (PARTITION BY api10
        ORDER BY num IS NULL DESC, num DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC) = 1)
    SELECT api10, lease_name, {iso.format('f')} AS effective_date,
           CASE WHEN lease_name <> current_lease THEN {iso.format('l')} END AS termination_date,
           lease_name = current_lease AS is_current, n AS n_completions, '' AS district
    FROM p JOIN cur USING (api10)"""


_SEQ = ["l_orderkey", "l_linenumber", "l_suppkey"]


@query(_crosswalk_sql())
def entity_crosswalk(spark, sf_dir):
    return crosswalk.lease_crosswalk(_crosswalk_rows(spark, sf_dir, F.col("l_partkey")), _SEQ)


_HOT_PART = "CASE WHEN l_returnflag = 'N' THEN -1 ELSE l_partkey END"


@query(_crosswalk_sql(_HOT_PART))
def entity_crosswalk_skewed(spark, sf_dir):
    """A third of the rows on one well."""
    return crosswalk.lease_crosswalk(_crosswalk_rows(spark, sf_dir, F.expr(_HOT_PART)), _SEQ)


# -- carried context ---------------------------------------------------------------------------

_CENTS = "CAST(ROUND(value * 100) AS BIGINT)"


def _carried(spark, sf_dir, ranges):
    kind, cents = F.col("event_type"), F.expr(_CENTS)
    rows = carry.carry_forward(
        table(spark, sf_dir, "events").select("event_id", "event_type", "value"),
        "event_id",
        {"root": F.when(kind == "signup", cents), "cycle": F.when(kind == "view", cents)},
        ranges=ranges,
    )
    zero = F.lit(0).cast("bigint")
    return rows.where(kind == "purchase").select(
        "event_id", cents.alias("amount"), F.coalesce("root", zero).alias("root"), F.coalesce("cycle", zero).alias("cycle")
    )


_CARRY_SQL = f"""
    SELECT event_id, amount, COALESCE(root, 0) AS root, COALESCE(cycle, 0) AS cycle FROM (
      SELECT event_id, event_type, {_CENTS} AS amount,
             LAST_VALUE(CASE WHEN event_type = 'signup' THEN {_CENTS} END IGNORE NULLS) OVER w AS root,
             LAST_VALUE(CASE WHEN event_type = 'view' THEN {_CENTS} END IGNORE NULLS) OVER w AS cycle
      FROM events WINDOW w AS (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    WHERE event_type = 'purchase'"""


@query(_CARRY_SQL)
def carry_forward(spark, sf_dir):
    return _carried(spark, sf_dir, None)


@query(_CARRY_SQL)
def carry_forward_small_chunks(spark, sf_dir):
    """Many ranges, so that context crosses their borders and some ranges have none."""
    return _carried(spark, sf_dir, 400)


# -- dedupe, key sets, subsets, unions ----------------------------------------------------------

_LINE_REST = (
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    "l_shipdate",
)


@query(
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, strftime(l_shipdate, '%Y%m%d') AS shipped
    FROM lineitem QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(_LINE_REST)}) = 1"""
)
def first_row_dedupe(spark, sf_dir):
    rows = dedupe.first_rows(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], _LINE_REST)
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
        F.date_format("l_shipdate", "yyyyMMdd").alias("shipped"),
    )


@query(
    """WITH a AS (SELECT DISTINCT c_custkey AS k FROM customer), b AS (SELECT DISTINCT o_custkey AS k FROM orders)
    SELECT (SELECT COUNT(*) FROM a WHERE k NOT IN (SELECT k FROM b)) AS only_left,
           (SELECT COUNT(*) FROM b WHERE k NOT IN (SELECT k FROM a)) AS only_right,
           NOT EXISTS (SELECT k FROM a EXCEPT SELECT k FROM b) AND NOT EXISTS (SELECT k FROM b EXCEPT SELECT k FROM a)
             AS sets_equal"""
)
def key_set_equality(spark, sf_dir):
    customers, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    return keysets.key_set_difference(customers, orders, "c_custkey", "o_custkey")


@query(
    """WITH k AS (SELECT o_custkey, MIN(o_orderkey) AS f FROM orders GROUP BY 1 ORDER BY f LIMIT 100)
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey IN (SELECT o_custkey FROM k)"""
)
def subset_first_keys(spark, sf_dir):
    """The operator itself: all rows of the first 100 keys in order of appearance."""
    picked = keysets.first_n_keys(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderkey"], 100)
    return picked.select("o_orderkey", "o_custkey", "o_orderstatus")


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 1000")
def subset_first_rows(spark, sf_dir):
    """The operator itself: the first 1000 rows in source order."""
    return keysets.first_n_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], 1000)


@query(
    """SELECT c_name AS name, CAST(c_nationkey AS BIGINT) AS nation, c_mktsegment AS segment, NULL::BIGINT AS supplier_key FROM customer
    UNION ALL SELECT s_name, CAST(s_nationkey AS BIGINT), NULL, s_suppkey FROM supplier"""
)
def union_by_name(spark, sf_dir):
    a = table(spark, sf_dir, "customer").selectExpr(
        "c_name AS name", "CAST(c_nationkey AS BIGINT) AS nation", "c_mktsegment AS segment"
    )
    b = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS supplier_key", "s_name AS name", "CAST(s_nationkey AS BIGINT) AS nation"
    )
    return keysets.union_by_name(a, b)


# -- profiles ----------------------------------------------------------------------------------

_VOLATILE = ("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_linenumber")
_VOLATILE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) AS multi_row_keys, COUNT(*) FILTER (v_{c} > 1) AS varying_keys FROM k"
    for c in _VOLATILE
)


@query(
    f"""WITH k AS (
      SELECT l_orderkey, {', '.join(f'COUNT(DISTINCT {c}) AS v_{c}' for c in _VOLATILE)}
      FROM lineitem GROUP BY 1 HAVING COUNT(*) > 1),
    s AS ({_VOLATILE_SQL})
    SELECT multi_row_keys, column_name, varying_keys, varying_keys / multi_row_keys AS varying_share,
           CASE WHEN varying_keys / multi_row_keys < 0.01 THEN 'well_property' ELSE 'event_property' END AS column_class
    FROM s"""
)
def column_volatility(spark, sf_dir):
    return profile.column_volatility(table(spark, sf_dir, "lineitem"), "l_orderkey", _VOLATILE)


@query("SELECT event_type AS record_type, COUNT(*) AS n_records FROM events GROUP BY 1")
def record_type_distribution(spark, sf_dir):
    return profile.type_distribution(table(spark, sf_dir, "events"), "event_type")


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(DISTINCT {c}) AS n_distinct FROM lineitem"
        for c in ("l_orderkey", "l_partkey", "l_returnflag")
    )
)
def distinct_counts(spark, sf_dir):
    return profile.distinct_counts(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey", "l_returnflag"])
