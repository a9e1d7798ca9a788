"""Run the checks a table's rules call for, and decide whether it may be published."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrylake.quality import checks as Q
from registrylake.quality.config import TableRules, rules_for

# Columns of a check log, in order.
LOG_COLUMNS = (
    "ingestion_run_id",
    "check_name",
    "check_level",
    "check_status",
    "check_value",
    "check_threshold",
    "checked_at",
    "notes",
)
LOG_SCHEMA = T.StructType(
    [T.StructField(c, T.LongType() if c == "check_level" else T.StringType()) for c in LOG_COLUMNS]
)


def run_id_for(run_ts: str) -> str:
    return f"retroactive-{run_ts[:19]}"


def checks_for(
    df: DataFrame,
    rules: TableRules,
    run_ts: str,
    parents: Mapping[str, DataFrame] | None = None,
    expected_rows: int | Callable[[], int] | None = None,
) -> list[Q.Check]:
    """The applicable checks, in a fixed order."""
    out: list[Q.Check] = []
    if rules.pk:
        out.append(Q.pk_unique(df, rules.pk))
    if rules.required:
        out.append(Q.required_nonnull(df, rules.required))
    if rules.date_cols:
        out.append(Q.date_range_sane(df, rules.date_cols, run_ts))
    if rules.bool_cols:
        out.append(Q.boolean_not_uniform(df, rules.bool_cols))
    if rules.id_cols:
        out.append(Q.identifier_columns_str(df, rules.id_cols))
    if rules.expected_columns:
        out.append(Q.schema_match(df, rules.expected_columns))
    if rules.dtypes:
        out.append(Q.dtype_match(df, dict(rules.dtypes)))
    if rules.key_column:
        out.append(Q.key_column_named(df, rules.key_column))
    out.append(Q.row_count(df, expected_rows, tolerance=0.0))
    for column, parent, key in rules.fk:
        if parents and parent in parents:
            out.append(Q.fk_match_rate(df, column, parents[parent], key))
            if rules.orphans:
                out.append(Q.orphan_count(df, column, parents[parent], key))
    for column, bound in rules.cardinality:
        out.append(Q.cardinality_bounds(df, column, bound))
    for key, field, current, truth in rules.cross_refs:
        if parents and current in parents:
            out.append(Q.cross_ref_consistency(df, parents[current], key, field, truth))
    for name, identifier in rules.names:
        out.append(Q.name_to_id_cardinality(df, name, identifier))
    if rules.count_range:
        out.append(Q.count_sanity(df, *rules.count_range))
    return out


def check_log(results: DataFrame, run_ts: str, run_id: str | None = None) -> DataFrame:
    """Check rows in the log's 8 columns; a column the results lack is an empty string."""
    tagged = results.withColumn("ingestion_run_id", F.lit(run_id or run_id_for(run_ts))).withColumn(
        "checked_at", F.lit(run_ts)
    )
    return tagged.select(*[F.col(c) if c in tagged.columns else F.lit("").alias(c) for c in LOG_COLUMNS])


def run_checks(
    spark: SparkSession,
    slug: str,
    df: DataFrame | None,
    run_ts: str,
    parents: Mapping[str, DataFrame] | None = None,
    rules: TableRules | None = None,
    expected_rows: int | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """The check log of one table; a missing table is one error row."""
    if df is None:
        results = Q.error_row(spark, "table_exists", 1, f"File not found for {slug}", "file exists")
    else:
        results = Q.evaluate(checks_for(df, rules or rules_for(slug), run_ts, parents, expected_rows))
    return check_log(results, run_ts, run_id)


def counted(source: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """A source whose rows are counted on the way to what is written from it, and the count once that has ended.

    A stage that runs again after a lost executor may count rows twice; such a count only warns.
    """
    seen = Observation()
    return source.observe(seen, F.count(F.lit(1)).alias("n")), lambda: seen.get["n"]


def written_checks(
    df: DataFrame, rules: TableRules, run_ts: str, expected_rows: int | Callable[[], int] | None = None
) -> tuple[list[Q.Check], Callable[..., DataFrame]]:
    """The checks that one pass over ``df`` measures, and what makes the log of them and of all others on the written rows."""
    observed = [c for c in checks_for(df, rules, run_ts, None, expected_rows) if c.frame is df]

    def check(staged: DataFrame, results: DataFrame | None = None) -> DataFrame:
        rest = [c for c in checks_for(staged, rules, run_ts, None, expected_rows) if results is None or c.frame is not staged]
        parts = ([results] if results is not None else []) + ([Q.evaluate(rest)] if rest else [])
        return check_log(reduce(DataFrame.unionAll, parts), run_ts)

    return observed, check


def run_all(
    spark: SparkSession,
    tables: Mapping[str, DataFrame | None],
    run_ts: str,
    rules: Mapping[str, TableRules] | None = None,
) -> DataFrame:
    """All tables' logs with a ``table_slug`` column; tables are also each other's parents."""
    present = {k: v for k, v in tables.items() if v is not None}
    parts = [
        run_checks(spark, slug, df, run_ts, present, (rules or {}).get(slug)).withColumn("table_slug", F.lit(slug))
        for slug, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def blocks_publish(log: DataFrame) -> bool:
    """Only a failed level 1 check blocks; an error counts as a warning."""
    return not log.where("check_level = 1 and check_status = 'fail'").isEmpty()
