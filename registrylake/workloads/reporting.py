"""Reconciliation, samples, allocation, productivity, coverage, corrections."""

from __future__ import annotations

from pyspark.sql import functions as F

from registrylake.functions import filters
from registrylake.operators import allocate, bridge, crosswalk, profile, reconcile
from registrylake.quality import checks as Q
from registrylake.tables.corrections import apply_corrections
from registrylake.workloads.registry import query, table

# -- reconciliation ----------------------------------------------------------------------------

_CENTS = "CAST(ROUND(o_totalprice * 100) AS BIGINT)"
_KEPT = "NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'P')"
_OIL2 = "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN oil + 1 ELSE oil END"
_GAS2 = "CASE WHEN o_orderpriority = '1-URGENT' OR (o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O') THEN gas + 1 ELSE gas END"
_OURS = f"SELECT o_orderkey, o_orderpriority, o_orderstatus, {_CENTS} AS oil, o_custkey AS gas FROM orders"


@query(
    f"""WITH o AS ({_OURS}), s AS (SELECT o_orderkey, {_OIL2} AS source_oil, {_GAS2} AS source_gas FROM o WHERE {_KEPT})
    SELECT o.o_orderkey, oil AS parsed_oil, gas AS parsed_gas, source_oil, source_gas,
      CASE WHEN source_oil IS NULL THEN 'NOT_FOUND' WHEN oil = source_oil AND gas = source_gas THEN 'PASS'
           WHEN oil <> source_oil AND gas <> source_gas THEN 'FAIL_MULTIPLE' WHEN oil <> source_oil THEN 'FAIL_OIL' ELSE 'FAIL_GAS' END AS status
    FROM o LEFT JOIN s USING (o_orderkey)"""
)
def reconcile_measures(spark, sf_dir):
    return _reconciled(spark, sf_dir)


def _reconciled(spark, sf_dir):
    ours = spark.sql(_OURS.replace("FROM orders", "FROM {orders}"), orders=table(spark, sf_dir, "orders"))
    source = ours.where(_KEPT).selectExpr("o_orderkey", f"{_OIL2} AS oil", f"{_GAS2} AS gas")
    return reconcile.reconcile(ours, source, ["o_orderkey"], "oil", "gas")


@query(
    f"""WITH o AS ({_OURS}), s AS (SELECT o_orderkey, {_OIL2} AS oil2, {_GAS2} AS gas2 FROM o WHERE {_KEPT}),
    r AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (oil = oil2 AND gas = gas2) AS ok FROM o LEFT JOIN s USING (o_orderkey))
    SELECT 'spot_check_authoritative' AS check_name, 3::BIGINT AS check_level, CASE WHEN n = ok THEN 'pass' ELSE 'fail' END AS check_status,
      ok || '/' || n || ' PASS' AS check_value, 'all samples exact' AS check_threshold, '' AS notes FROM r"""
)
def qa_spot_check(spark, sf_dir):
    return Q.evaluate([Q.spot_check_authoritative(_reconciled(spark, sf_dir))])


_BANDED = f"""SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice > 450000 THEN 'HIGH' WHEN o_custkey * 10 > 10 * o_totalprice THEN 'GAS_DOM'
    WHEN o_totalprice < 20000 THEN 'LOW' ELSE 'MODERATE' END AS band FROM orders"""


@query(
    f"""SELECT o_orderkey, band FROM ({_BANDED})
    QUALIFY ROW_NUMBER() OVER (PARTITION BY band ORDER BY md5('7|' || o_orderkey), o_orderkey) <= 5"""
)
def stratified_sample(spark, sf_dir):
    """The operator itself: five rows per volume band, the same ones on every run."""
    band = reconcile.volume_band(
        F.col("o_totalprice"), F.col("o_custkey") * 10, high=450_000, low=20_000, gas_ratio=10
    )
    rows = table(spark, sf_dir, "orders").select("o_orderkey", band.alias("band"))
    return reconcile.stratified_sample(rows, ["band"], ["o_orderkey"], 5, seed=7)


@query(
    f"""WITH s AS (SELECT o_orderkey FROM ({_BANDED}) QUALIFY ROW_NUMBER() OVER (PARTITION BY band ORDER BY md5('7|' || o_orderkey), o_orderkey) <= 5),
    p AS (SELECT o_orderkey, strftime(o_orderdate, '%Y') AS prod_year, o_orderpriority, o_orderstatus FROM orders)
    SELECT 'prod_year' AS dimension, (SELECT COUNT(DISTINCT prod_year) FROM p JOIN s USING (o_orderkey)) AS n_sampled, COUNT(DISTINCT prod_year) AS n_known FROM p
    UNION ALL SELECT 'o_orderpriority', (SELECT COUNT(DISTINCT o_orderpriority) FROM p JOIN s USING (o_orderkey)), COUNT(DISTINCT o_orderpriority) FROM p
    UNION ALL SELECT 'o_orderstatus', (SELECT COUNT(DISTINCT o_orderstatus) FROM p JOIN s USING (o_orderkey)), COUNT(DISTINCT o_orderstatus) FROM p"""
)
def sample_coverage(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").withColumn("prod_year", F.date_format("o_orderdate", "yyyy"))
    band = reconcile.volume_band(F.col("o_totalprice"), F.col("o_custkey") * 10, high=450_000, low=20_000, gas_ratio=10)
    sample = reconcile.stratified_sample(rows.withColumn("band", band), ["band"], ["o_orderkey"], 5, seed=7)
    return reconcile.sample_coverage(sample, rows, ["prod_year", "o_orderpriority", "o_orderstatus"])


# -- allocation --------------------------------------------------------------------------------

_MONTH = "CAST(strftime(l_shipdate, '%Y%m') AS BIGINT)"
_LEASE = "CASE WHEN l_returnflag = 'N' THEN -1 ELSE l_suppkey END"
_PROD_SQL = """prod AS (SELECT {lease} AS lease, CAST(strftime(l_shipdate, '%Y%m') AS BIGINT) AS month,
      CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS volume FROM lineitem GROUP BY 1, 2)"""
_WELLS_SQL = """wells AS (SELECT {lease} AS lease, l_partkey AS api10, MIN(CAST(strftime(l_shipdate, '%Y%m') AS BIGINT)) AS f,
      NULLIF(MAX(CAST(strftime(l_shipdate, '%Y%m') AS BIGINT)), 200108) AS t, COUNT(*) AS w FROM lineitem
      WHERE l_linestatus = 'F' GROUP BY 1, 2)"""
_ACTIVE_SQL = """active AS (SELECT prod.lease, month, api10, volume, w FROM prod JOIN wells ON prod.lease = wells.lease
      AND f <= month AND (t IS NULL OR month < t)),
    n AS (SELECT lease, month, COUNT(*) AS n_wells, SUM(w) AS total FROM active GROUP BY 1, 2)"""


def _allocation_sql(lease, select, keep="TRUE"):
    return f"""WITH {_PROD_SQL.format(lease=lease)}, {_WELLS_SQL.format(lease=lease)}, {_ACTIVE_SQL},
    kept AS (SELECT * FROM n WHERE {keep})
    SELECT lease, month, api10, n_wells, volume, {select} AS share FROM active JOIN kept USING (lease, month)
    UNION ALL
    SELECT lease, month, NULL, 0, volume, volume FROM prod WHERE NOT EXISTS
      (SELECT 1 FROM kept WHERE kept.lease = prod.lease AND kept.month = prod.month)"""


def _allocation(spark, sf_dir, lease, **options):
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        f"{lease} AS lease", "l_partkey AS api10", "CAST(date_format(l_shipdate, 'yyyyMM') AS BIGINT) AS month",
        "CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS volume", "l_linestatus",
    )
    production = allocate.lease_production(lines, ["lease"], "month", "volume")
    wells = (
        lines.where("l_linestatus = 'F'")
        .groupBy("lease", "api10")
        .agg(F.min("month").alias("effective_month"), F.max("month").alias("_t"), F.count(F.lit(1)).alias("w"))
        .withColumn("termination_month", F.expr("NULLIF(_t, 200108)"))
        .drop("_t")
    )
    if options.get("method") == "proportional":
        options["weight"] = "w"
    shares = allocate.allocate_to_wells(production, wells, ["lease"], **options)
    return shares.withColumn("share", F.floor("share").cast("bigint"))


@query(_allocation_sql("l_suppkey", "volume // n_wells"))
def allocate_equal(spark, sf_dir):
    return _allocation(spark, sf_dir, "l_suppkey")


@query(_allocation_sql("l_suppkey", "CAST(floor(volume * CAST(w AS DOUBLE) / total) AS BIGINT)"))
def allocate_proportional(spark, sf_dir):
    return _allocation(spark, sf_dir, "l_suppkey", method="proportional")


@query(_allocation_sql("l_suppkey", "volume", "n_wells = 1"))
def allocate_single_well(spark, sf_dir):
    return _allocation(spark, sf_dir, "l_suppkey", method="single")


@query(_allocation_sql(_LEASE, "volume // n_wells"))
def allocate_skewed_lease(spark, sf_dir):
    """A third of the wells on one lease: its wells are dealt to many salts."""
    return _allocation(spark, sf_dir, _LEASE, salt_rows=100)


@query(
    f"""SELECT api10, month, CAST(SUM(share) AS BIGINT) AS volume, COUNT(*) AS n_leases, MAX(n_wells) AS largest_lease
    FROM ({_allocation_sql('l_suppkey', 'volume // n_wells')}) WHERE api10 IS NOT NULL GROUP BY 1, 2"""
)
def well_monthly_production(spark, sf_dir):
    """Lease volumes shared out equally, summed per well."""
    return allocate.well_production(_allocation(spark, sf_dir, "l_suppkey"))


@query(
    f"""WITH {_PROD_SQL.format(lease='l_suppkey')} SELECT lease, CAST(SUM(volume) AS BIGINT) AS volume, TRUE AS shares_add_up FROM prod GROUP BY 1"""
)
def allocation_adds_up(spark, sf_dir):
    """Shares (real numbers here) of a lease add up to its volume."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey AS lease", "l_partkey AS api10", "CAST(date_format(l_shipdate, 'yyyyMM') AS BIGINT) AS month",
        "CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS volume",
    )
    production = allocate.lease_production(lines, ["lease"], "month", "volume")
    wells = lines.groupBy("lease", "api10").agg(
        F.min("month").alias("effective_month"), F.max("month").alias("termination_month")
    )
    shares = allocate.allocate_to_wells(production, wells, ["lease"]).groupBy("lease").agg(F.sum("share").alias("share"))
    whole = production.groupBy("lease").agg(F.sum("volume").alias("volume"))
    return whole.join(shares, "lease").select("lease", "volume", (F.round("share") == F.col("volume")).alias("shares_add_up"))


# spans of a well that overlap are one, with the largest weight
_SPANS_SQL = """spans AS (SELECT l_suppkey AS lease, l_partkey AS api10, l_linestatus, MIN(CAST(strftime(l_shipdate, '%Y%m') AS BIGINT)) AS f,
      NULLIF(MAX(CAST(strftime(l_shipdate, '%Y%m') AS BIGINT)), 199808) AS t, COUNT(*) AS w FROM lineitem GROUP BY 1, 2, 3),
    marked AS (SELECT *, CASE WHEN max(coalesce(t, 999999)) OVER (PARTITION BY lease, api10 ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > f
        THEN 0 ELSE 1 END AS begins FROM spans WHERE t IS NULL OR f < t),
    numbered AS (SELECT *, SUM(begins) OVER (PARTITION BY lease, api10 ORDER BY f ROWS UNBOUNDED PRECEDING) AS island FROM marked),
    merged AS (SELECT lease, api10, MIN(f) AS f, MAX(coalesce(t, 999999)) AS t, {weight} AS w FROM numbered GROUP BY lease, api10, island),
    active AS (SELECT prod.lease, month, api10, volume, w FROM prod JOIN merged ON prod.lease = merged.lease AND f <= month AND month < t),
    n AS (SELECT lease, month, COUNT(*) AS n_wells, SUM(w) AS total FROM active GROUP BY 1, 2)"""


def _spans_sql(weight, share):
    return f"""WITH {_PROD_SQL.format(lease='l_suppkey')}, {_SPANS_SQL.format(weight=weight)}
    SELECT lease, month, api10, n_wells, volume, {share} AS share FROM active JOIN n USING (lease, month)
    UNION ALL
    SELECT lease, month, NULL, 0, volume, volume FROM prod WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.lease = prod.lease AND n.month = prod.month)"""


def _spans(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey AS lease", "l_partkey AS api10", "CAST(date_format(l_shipdate, 'yyyyMM') AS BIGINT) AS month",
        "CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS volume", "l_linestatus",
    )
    spans = lines.groupBy("lease", "api10", "l_linestatus").agg(
        F.min("month").alias("effective_month"), F.expr("NULLIF(MAX(month), 199808)").alias("termination_month"), F.count(F.lit(1)).alias("w")
    )
    return allocate.lease_production(lines, ["lease"], "month", "volume"), spans


@query(_spans_sql("MAX(1)", "volume // n_wells"))
def allocate_overlapping_spans(spark, sf_dir):
    """A well has a span for each line status, and these overlap: it counts once in a month."""
    production, wells = _spans(spark, sf_dir)
    return allocate.allocate_to_wells(production, wells, ["lease"]).withColumn("share", F.floor("share").cast("bigint"))


_TINY = -700


@query(_spans_sql(f"MAX(w) * POWER(2.0, {_TINY})", "CAST(floor(volume * w / total) AS BIGINT)"))
def allocate_tiny_weights(spark, sf_dir):
    """Weights of about 1e-210, which a sum of fixed scale would take as nothing; of overlapping spans the largest counts."""
    production, wells = _spans(spark, sf_dir)
    wells = wells.withColumn("w", F.expr(f"w * POWER(2.0D, {_TINY})"))
    shares = allocate.allocate_to_wells(production, wells, ["lease"], method="proportional", weight="w")
    return shares.withColumn("share", F.floor("share").cast("bigint"))


_BRIDGE_SQL = """life AS (SELECT l_partkey, MIN(CAST(strftime(l_shipdate, '%Y%m') AS INTEGER)) AS f FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1),
    bridge AS (SELECT DISTINCT l_linestatus AS district, CAST(l_suppkey AS VARCHAR) AS lease_number, CAST(l_partkey AS VARCHAR) AS api10, f AS effective_month,
      CAST(NULL AS INTEGER) AS termination_month, f IS NOT NULL AS is_dated FROM lineitem LEFT JOIN life USING (l_partkey) WHERE l_linenumber <> 7)"""


def _bridge(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_linestatus AS district", "CASE WHEN l_linenumber = 7 THEN ' ' ELSE CAST(l_suppkey AS STRING) END AS lease_number",
        "CAST(l_partkey AS STRING) AS api10", "l_returnflag", "l_linestatus AS lease_name", "date_format(l_shipdate, 'yyyyMMdd') AS completion",
        "l_orderkey AS gas_rrcid", "l_linenumber", "l_orderkey",
    )
    spans = crosswalk.lease_crosswalk(lines.where("l_returnflag <> 'N'"), ["l_orderkey", "l_linenumber"])
    return bridge.lease_well_bridge(lines, spans)


@query(f"WITH {_BRIDGE_SQL} SELECT * FROM bridge")
def lease_well_bridge(spark, sf_dir):
    """Leases and their wells from the lines that name both, dated by the well's crosswalk."""
    return _bridge(spark, sf_dir)


@query(
    f"""WITH {_BRIDGE_SQL}, v AS (SELECT l_linestatus AS district, CAST(l_suppkey AS VARCHAR) AS lease_number,
        SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS v FROM lineitem GROUP BY 1, 2),
      w AS (SELECT district, lease_number, COUNT(DISTINCT api10) AS w FROM bridge GROUP BY 1, 2)
    SELECT COUNT(*) AS n_leases, COUNT(w) AS n_bridged, COUNT(*) FILTER (w = 1) AS n_single_well, CAST(SUM(v) AS BIGINT) AS volume,
      CAST(coalesce(SUM(v) FILTER (w >= 1), 0) AS BIGINT) AS volume_bridged, CAST(coalesce(SUM(v) FILTER (w = 1), 0) AS BIGINT) AS volume_single_well
    FROM v LEFT JOIN w USING (district, lease_number)"""
)
def bridge_coverage(spark, sf_dir):
    produced = table(spark, sf_dir, "lineitem").selectExpr(
        "l_linestatus AS district", "CAST(l_suppkey AS STRING) AS lease_number", "CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS volume"
    )
    return bridge.bridge_coverage(produced, _bridge(spark, sf_dir))


@query(
    """SELECT p_partkey, CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents, CAST(p_size AS BIGINT) AS size,
      CASE WHEN p_size > 10 THEN CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS BIGINT) // CAST(p_size - 10 AS BIGINT) END AS cents_per_unit
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_partkey, p_size"""
)
def per_unit_productivity(spark, sf_dir):
    made = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.sum(F.expr("CAST(ROUND(l_extendedprice * 100) AS BIGINT)")).alias("cents")
    )
    rows = made.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    size = F.col("p_size").cast("bigint")
    return rows.select(
        "p_partkey", "cents", size.alias("size"),
        F.floor(allocate.per_unit(F.col("cents"), size - 10)).cast("bigint").alias("cents_per_unit"),
    )


@query(
    """SELECT n_nationkey AS district, strftime(o_orderdate, '%Y') AS prod_year, strftime(o_orderdate, '%m') AS prod_month,
      COUNT(*) AS n_reports, CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS volume
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3"""
)
def production_by_period(spark, sf_dir):
    """Volumes collapse to (customer, month) before the dimension join."""
    monthly = (
        table(spark, sf_dir, "orders")
        .groupBy(
            "o_custkey", F.date_format("o_orderdate", "yyyy").alias("prod_year"), F.date_format("o_orderdate", "MM").alias("prod_month")
        )
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.expr(_CENTS)).alias("v"))
    )
    joined = monthly.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.groupBy(F.col("n_nationkey").alias("district"), "prod_year", "prod_month").agg(
        F.sum("n").alias("n_reports"), F.sum("v").alias("volume")
    )


@query(
    """SELECT o_custkey AS lease_number, strftime(o_orderdate, '%Y-%m') AS month, CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS volume
    FROM orders GROUP BY 1, 2"""
)
def lease_monthly_production(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("lease_number"), F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        F.expr(_CENTS).alias("volume"),
    )
    return allocate.lease_production(rows, ["lease_number"], "month", "volume")


@query(
    """SELECT 'orders' AS dimension, COUNT(*) AS value FROM orders UNION ALL SELECT 'customers_with_orders', COUNT(DISTINCT o_custkey) FROM orders
    UNION ALL SELECT 'lines', COUNT(*) FROM lineitem UNION ALL SELECT 'parts_sold', COUNT(DISTINCT l_partkey) FROM lineitem
    UNION ALL SELECT 'documents', COUNT(*) FROM documents"""
)
def coverage_counts(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    return profile.coverage_counts(
        {
            "orders": (t("orders"), None),
            "customers_with_orders": (t("orders"), F.col("o_custkey")),
            "lines": (t("lineitem"), None),
            "parts_sold": (t("lineitem"), F.col("l_partkey")),
            "documents": (t("documents"), None),
        }
    )


@query(
    """SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
    WHERE c_acctbal / 100 BETWEEN 25.8 AND 36.5 AND -(c_nationkey + 90) BETWEEN -106.7 AND -93.5
      AND (starts_with(c_mktsegment, 'BUILD') OR starts_with(c_mktsegment, 'MACH') OR starts_with(c_mktsegment, 'AUTO'))
      AND n_name <> 'TX'"""
)
def bbox_prefix_filter(spark, sf_dir):
    """Box, state and prefix filters for extracts; balances and nations stand in for coordinates."""
    rows = table(spark, sf_dir, "customer").where(
        filters.in_box(F.col("c_acctbal") / 100, -(F.col("c_nationkey") + 90))
        & filters.starts_with_any(F.col("c_mktsegment"), ("BUILD", "MACH", "AUTO"))
    )
    joined = rows.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.where(~filters.in_state(F.col("n_name"))).select("c_custkey", "c_name", "n_name")


_POSTED = """SELECT l_suppkey AS lease_number, {fmt} AS posted, l_returnflag AS flag, l_orderkey, l_linenumber, l_partkey,
    CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS volume FROM lineitem"""


@query(
    f"""SELECT * FROM ({_POSTED.format(fmt="strftime(l_shipdate, '%Y%m%d')")})
    QUALIFY ROW_NUMBER() OVER (PARTITION BY lease_number ORDER BY posted DESC, flag DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, volume DESC) = 1"""
)
def corrections_upsert(spark, sf_dir):
    """Posted rows arrive in two lots; the latest posting of a lease wins."""
    posted = _POSTED.format(fmt="date_format(l_shipdate, 'yyyyMMdd')").replace("FROM lineitem", "FROM {lineitem}")
    rows = spark.sql(posted, lineitem=table(spark, sf_dir, "lineitem"))
    return apply_corrections(
        rows.where("flag <> 'R'"), rows.where("flag = 'R'"), keys=["lease_number"], order=["posted", "flag"]
    )


@query(
    """SELECT 'o_custkey' AS column_name, TRUE AS is_close, COUNT(DISTINCT strftime(o_orderdate, '%Y')) AS n_sketches FROM orders UNION ALL
    SELECT 'o_orderkey', TRUE, COUNT(DISTINCT strftime(o_orderdate, '%Y')) FROM orders"""
)
def coverage_of_sketches(spark, sf_dir):
    """Distinct customers and orders from one sketch a year, merged, against exact counts."""
    o = table(spark, sf_dir, "orders").withColumn("year", F.date_format("o_orderdate", "yyyy"))
    columns = ["o_custkey", "o_orderkey"]
    sketches = profile.distinct_sketches(o, columns, ["year"])
    exact = profile.distinct_counts(o, columns).withColumnRenamed("n_distinct", "n_exact")
    parts = sketches.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_sketches"))
    close = F.abs(F.col("n_distinct") - F.col("n_exact")) <= 0.04 * F.col("n_exact")
    merged = profile.merged_counts(sketches).join(exact, "column_name").join(parts, "column_name")
    return merged.select("column_name", close.alias("is_close"), "n_sketches")
