"""Refreshing the lake: newest landed file -> table(s), checked and swapped in.

One function per source and per derived table; ``lake`` is the folder of the published tables, a table is
the folder ``<lake>/<slug>``. ``subset`` keeps the first N records (keys) in source order, for smoke runs.
``gate`` blocks a table whose level 1 checks fail; the inspections of the public source, for one, are known
to lack many well keys and need ``gate=False``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrylake.operators import bridge
from registrylake.operators.keysets import first_n_keys, first_n_rows, key_set_difference
from registrylake.quality import checks as Q
from registrylake.quality import runner, summary
from registrylake.quality.config import rules_for
from registrylake.session import materialise, scratch_scope
from registrylake.sinks.publish import append_log, create_if_absent, open_table, publish, table_exists
from registrylake.sources.dbase import bad_files, read_dbase, scan_headers
from registrylake.sources.delimited import read_delimited
from registrylake.sources.landing import PATTERNS, newest_snapshot, verify_sources
from registrylake.sources.text_lines import read_numbered_lines
from registrylake.streaming.corrections_stream import merge_landed
from registrylake.tables import hearings as hearings_table
from registrylake.tables import injection as injection_table
from registrylake.tables import inspections as inspections_table
from registrylake.tables import operator_registry as registry_table
from registrylake.tables import permits as permits_table
from registrylake.tables import production as production_table
from registrylake.tables import well_months as well_months_table
from registrylake.tables import wells as wells_table

LINE_ORDER = ("source_file", "line_number_in_file")


def _own_stages(refresh: Callable) -> Callable:
    """What a refresh writes on the way goes when it has ended: its results are published tables and collected logs."""

    @wraps(refresh)
    def run(spark: SparkSession, *args, **options):
        with scratch_scope(spark):
            return refresh(spark, *args, **options)

    return run


class SourceProblem(RuntimeError):
    """No file, a damaged file, or a file without the records that are wanted."""


def newest(spark: SparkSession, landing: str, source: str) -> str:
    path = newest_snapshot(spark, landing, PATTERNS[source])
    if path is None:
        raise SourceProblem(f"no {source} file in {landing}")
    return path


def require_intact(spark: SparkSession, landing: str, path: str) -> None:
    """The file's digest equals the sidecar's, where there is one."""
    status = verify_sources(spark, landing, path).first()
    if status is not None and not status["ok"]:
        raise SourceProblem(f"{path} is not the file its sidecar describes")


#: tables that are read by a part of their rows, and the column that tells which
PARTITIONS = {"fact_production_monthly": ("prod_year",), "fact_production_records_raw": ("record_type",)}


def _publish(
    df: DataFrame, lake: str, slug: str, run_ts: str, gate: bool, needs_rows: bool = False, source_rows: Callable[[], int] | None = None
) -> DataFrame:
    """Write, check, show. ``source_rows`` tells how many rows the source had, where the table keeps them all."""
    observed, log_of = runner.written_checks(df, rules_for(slug), run_ts, source_rows)

    def check(staged: DataFrame, results: DataFrame | None = None) -> DataFrame:
        if needs_rows and staged.isEmpty():
            raise SourceProblem(f"no rows for {slug}")
        return log_of(staged, results)

    return publish(df, f"{lake}/{slug}", check, PARTITIONS.get(slug, ()), gate, observed)


def _first(lines: DataFrame, subset: int | None) -> DataFrame:
    return first_n_rows(lines, LINE_ORDER, subset) if subset else lines


@_own_stages
def operator_registry(
    spark: SparkSession, landing: str, lake: str, run_ts: str, subset: int | None = None, gate: bool = True
) -> DataFrame:
    """dim_operator_registry; makes the empty history and consolidation tables where they are absent."""
    path = newest(spark, landing, "operator_registry")
    require_intact(spark, landing, path)
    lines = registry_table.record_type(read_numbered_lines(spark, path)).where("record_type = 'A'")
    source, n = runner.counted(_first(lines, subset).drop("record_type"))
    log = _publish(registry_table.operator_registry(source, run_ts), lake, "dim_operator_registry", run_ts, gate, True, n)
    create_if_absent(spark, f"{lake}/dim_operator_history", wells_table.HISTORY_SCHEMA)
    create_if_absent(spark, f"{lake}/dim_operator_consolidation", registry_table.CONSOLIDATION_SCHEMA)
    return log


@_own_stages
def drilling_permits(
    spark: SparkSession, landing: str, lake: str, run_ts: str, subset: int | None = None, gate: bool = True
) -> DataFrame:
    lines = permits_table.long_enough(read_numbered_lines(spark, newest(spark, landing, "drilling_permits")))
    source, n = runner.counted(_first(lines, subset))
    return _publish(permits_table.drilling_permits(source, run_ts), lake, "dim_drilling_permits", run_ts, gate, source_rows=n)


@_own_stages
def injection(
    spark: SparkSession, landing: str, lake: str, run_ts: str, subset: int | None = None, gate: bool = True
) -> DataFrame:
    """dim_injection_uic_raw, and dim_injection_uic from it."""
    lines = injection_table.long_enough(read_numbered_lines(spark, newest(spark, landing, "injection")))
    source, n = runner.counted(_first(lines, subset))
    _publish(injection_table.injection_raw(source, run_ts), lake, "dim_injection_uic_raw", run_ts, gate, source_rows=n)
    raw = open_table(spark, f"{lake}/dim_injection_uic_raw")
    return _publish(injection_table.injection_wells(raw), lake, "dim_injection_uic", run_ts, gate)


@_own_stages
def hearings(
    spark: SparkSession, landing: str, lake: str, run_ts: str, subset: int | None = None, gate: bool = True
) -> DataFrame:
    lines = hearings_table.long_enough(read_numbered_lines(spark, newest(spark, landing, "hearings")))
    source, n = runner.counted(_first(lines, subset))
    return _publish(hearings_table.hearings(source, run_ts), lake, "dim_hearings", run_ts, gate, source_rows=n)


@_own_stages
def inspections(
    spark: SparkSession, landing: str, lake: str, run_ts: str, subset: int | None = None, gate: bool = True
) -> DataFrame:
    """fact_inspections and its identical raw twin."""
    source, n = runner.counted(read_delimited(spark, newest(spark, landing, "inspections"), first=subset))
    _publish(inspections_table.inspections(source, run_ts), lake, "fact_inspections_raw", run_ts, gate, source_rows=n)
    twin, n = runner.counted(open_table(spark, f"{lake}/fact_inspections_raw"))
    return _publish(twin, lake, "fact_inspections", run_ts, gate, source_rows=n)


@_own_stages
def production(
    spark: SparkSession, landing: str, lake: str, run_ts: str, subset: int | None = None, gate: bool = True
) -> DataFrame:
    """fact_production_records_raw and fact_production_monthly from the oil tape."""
    path = newest(spark, landing, "production")
    everything = production_table.read_tape_with_parents(spark, path)
    leaves = production_table.read_tape_with_parents(spark, path, types=("03",))
    if subset:
        everything, leaves = (df.where(F.col("record_index") < subset) for df in (everything, leaves))
    everything, n = runner.counted(everything)
    raw = production_table.production_records_raw(everything, run_ts)
    _publish(raw, lake, "fact_production_records_raw", run_ts, gate, source_rows=n)
    return _publish(production_table.production_monthly(leaves, run_ts), lake, "fact_production_monthly", run_ts, gate)


@_own_stages
def corrections(spark: SparkSession, landing: str, lake: str, run_ts: str, pattern: str = "*.ebc") -> DataFrame:
    """Merge the corrected tapes in ``landing`` that no earlier run has merged into fact_production_monthly; its check log."""
    slug = "fact_production_monthly"
    merge_landed(spark, landing, pattern, f"{lake}/{slug}", f"{lake}/_checkpoints/corrections", run_ts)
    log = runner.run_checks(spark, slug, open_table(spark, f"{lake}/{slug}"), run_ts)
    return spark.createDataFrame(log.collect(), log.schema)


@_own_stages
def wells(
    spark: SparkSession, landing: str, lake: str, run_ts: str, subset: int | None = None, gate: bool = True
) -> dict[str, DataFrame]:
    """fact_well_records_raw, well_master, fact_well_completions; do the last two have the same wells, and which files were skipped?

    The county files are read once: master and completions come from the published raw table.
    """
    scanned = scan_headers(landing)
    records = read_dbase(spark, landing, scanned=scanned)
    if subset:
        records = first_n_rows(records, wells_table.SOURCE_ORDER, subset)
    logs = {}
    slug = "fact_well_records_raw"
    records, n = runner.counted(records)
    logs[slug] = _publish(wells_table.well_records_raw(records, run_ts), lake, slug, run_ts, gate, True, n)
    raw = open_table(spark, f"{lake}/{slug}")
    for slug, make in (("well_master", wells_table.well_master), ("fact_well_completions", wells_table.well_completions)):
        logs[slug] = _publish(make(raw), lake, slug, run_ts, gate)
    master, completions = (open_table(spark, f"{lake}/{s}") for s in ("well_master", "fact_well_completions"))
    logs["bad_files"] = bad_files(spark, landing, scanned=scanned)
    skipped = runner.check_log(Q.evaluate([Q.files_read(logs["bad_files"])]), run_ts)
    append_log(skipped, f"{lake}/qa_fact_well_records_raw")
    logs["skipped"] = skipped
    logs["key_sets"] = key_set_difference(master, completions, "api10", "api10")
    return logs


def _completions(spark: SparkSession, lake: str, subset: int | None) -> DataFrame:
    rows = open_table(spark, f"{lake}/fact_well_completions")
    return first_n_keys(rows, "api10", wells_table.SOURCE_ORDER, subset) if subset else rows


@_own_stages
def operator_history(
    spark: SparkSession, lake: str, run_ts: str, subset: int | None = None, gate: bool = True
) -> DataFrame:
    rows = wells_table.operator_history(_completions(spark, lake, subset), run_ts)
    return _publish(rows, lake, "dim_operator_history", run_ts, gate)


@_own_stages
def lease_crosswalk(
    spark: SparkSession, lake: str, run_ts: str, subset: int | None = None, gate: bool = True
) -> DataFrame:
    rows = wells_table.well_lease_crosswalk(_completions(spark, lake, subset), run_ts)
    return _publish(rows, lake, "dim_well_lease_crosswalk", run_ts, gate)


@_own_stages
def lease_wells(
    spark: SparkSession, lake: str, run_ts: str, subset: int | None = None, gate: bool = True
) -> dict[str, DataFrame]:
    """dim_lease_well_bridge from the records that name lease and well, and fact_well_production_monthly by equal shares.

    ``coverage`` tells how much of the production the bridge reaches; the rest goes to no well and is not published here.
    """
    read = lambda slug: open_table(spark, f"{lake}/{slug}")
    members = read("dim_injection_uic_raw")
    if subset:
        members = members.limit(subset)
    pairs = bridge.lease_well_bridge(members, read("dim_well_lease_crosswalk"))
    logs = {}
    slug = "dim_lease_well_bridge"
    logs[slug] = _publish(pairs.withColumn("scraped_at", F.lit(run_ts)), lake, slug, run_ts, gate)
    wells = read(slug)
    # a tape may hold a lease-month more than once; a period that is no number is no month
    month = F.expr("try_cast(concat(prod_year, prod_month) AS int)")
    monthly = read("fact_production_monthly").withColumn("month", month).where("month is not null")
    slug = "fact_well_production_monthly"
    made = well_months_table.well_months(monthly, wells).withColumn("scraped_at", F.lit(run_ts))
    logs[slug] = _publish(made, lake, slug, run_ts, gate)
    logs["coverage"] = bridge.bridge_coverage(monthly, wells, volume="oil_production_bbl")
    return logs


def _opener(spark: SparkSession, path: str) -> Callable[[], DataFrame]:
    return lambda: spark.read.schema(runner.LOG_SCHEMA).parquet(path)


@_own_stages
def quality(
    spark: SparkSession, lake: str, run_ts: str, slugs: Sequence[str], rules: Mapping | None = None
) -> tuple[DataFrame, DataFrame]:
    """Check all tables, append their logs, publish qa_summary and qa_review_queue; returns both."""
    tables = {s: open_table(spark, f"{lake}/{s}") if table_exists(spark, f"{lake}/{s}") else None for s in slugs}
    log = materialise(runner.run_all(spark, tables, run_ts, rules), "qa")
    for slug in slugs:
        append_log(log.where(F.col("table_slug") == slug).drop("table_slug"), f"{lake}/qa_{slug}")
    history = summary.collect_logs(spark, {s: _opener(spark, f"{lake}/qa_{s}") for s in slugs}, run_ts)
    current = materialise(summary.latest_status(history), "qa-summary")
    target = f"{lake}/qa_summary"
    previous = open_table(spark, target) if table_exists(spark, target) else None
    publish(summary.new_issues(current, previous), f"{lake}/qa_review_queue")
    publish(current, target)
    return open_table(spark, target), open_table(spark, f"{lake}/qa_review_queue")
