"""Latest status per check, new issues, roll-up."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrylake.operators.dedupe import latest_rows

# Fixed values.
STATUSES = ("pass", "warn", "fail", "error")
ISSUES = ("fail", "warn")


def latest_status(log: DataFrame) -> DataFrame:
    """The most recent row per (table, check); equal times are settled by run and the rest of the row."""
    order = ["checked_at", "ingestion_run_id", "check_status", "check_value", "check_threshold", "notes"]
    last = latest_rows(log, ["table_slug", "check_name"], order)
    return last.select(
        "table_slug",
        "check_name",
        "check_level",
        F.col("check_status").alias("latest_status"),
        F.col("check_value").alias("latest_value"),
        F.col("check_threshold").alias("latest_threshold"),
        F.col("checked_at").alias("latest_checked_at"),
        F.col("ingestion_run_id").alias("latest_run_id"),
        "notes",
    )


def collect_logs(spark: SparkSession, logs: Mapping[str, Callable[[], DataFrame]], run_ts: str) -> DataFrame:
    """Union of the tables' logs; a log that cannot be read is one ``_read_error`` row at level 0.

    Files that open may still not read, so every log is read to its end here, apart from the others.
    """
    parts = []
    for slug, opened in logs.items():
        try:
            log = opened()
            log.agg(F.bit_xor(F.xxhash64(*log.columns))).collect()
            parts.append(log.withColumn("table_slug", F.lit(slug)))
        except Exception as e:  # an unreadable log must not hide the others
            row = [("", "_read_error", 0, "error", str(e).splitlines()[0], "", run_ts, "Failed to read log", slug)]
            schema = (
                "ingestion_run_id string, check_name string, check_level bigint, check_status string, "
                "check_value string, check_threshold string, checked_at string, notes string, table_slug string"
            )
            parts.append(spark.createDataFrame(row, schema))
    return reduce(DataFrame.unionByName, parts)


def new_issues(current: DataFrame, previous: DataFrame | None) -> DataFrame:
    """Failed and warning checks; new when the status differs from the previous summary (or none exists)."""
    issues = current.where(F.col("latest_status").isin(*ISSUES))
    if previous is None:
        return issues.withColumn("is_new", F.lit(True))
    before = previous.select("table_slug", "check_name", F.col("latest_status").alias("_before"))
    joined = issues.join(before, ["table_slug", "check_name"], "left")
    changed = F.coalesce(F.col("_before"), F.lit("")) != F.col("latest_status")
    return joined.select(*issues.columns, changed.alias("is_new"))


def status_rollup(log: DataFrame) -> DataFrame:
    """Checks per level and status with a total row."""
    counts = log.rollup("check_level").agg(
        *[F.count_if(F.col("check_status") == s).alias(f"n_{s}") for s in STATUSES], F.grouping("check_level").alias("_g")
    )
    label = F.when(F.col("_g") == 1, "Total").otherwise(F.concat(F.lit("L"), F.col("check_level").cast("string")))
    return counts.select(label.alias("level"), *[f"n_{s}" for s in STATUSES])
