"""Fixed-position text files: one line, one record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from registrylake.functions.text import ascii_replace
from registrylake.session import materialise

#: row groups of written lines: what one unsplittable file holds is read back by many tasks
ROW_GROUP = {"parquet.block.size": str(32 << 20)}
SPLIT = ["_path", "_start"]


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``value`` with every non-ASCII byte as one U+FFFD, and ``source_file``. ``.gz`` is unpacked."""
    raw = spark.read.text(path)
    return raw.select(ascii_replace(F.col("value")).alias("value"), F.col("_metadata.file_name").alias("source_file"))


def placed_lines(spark: SparkSession, path: str | list[str], line_end: str | None = None) -> DataFrame:
    """``read_lines`` plus the split a line is from (``_path``, ``_start``) and ``_id``, which grows inside a split."""
    raw = (spark.read.option("lineSep", line_end) if line_end else spark.read).text(path)
    return raw.select(
        ascii_replace(F.col("value")).alias("value"),
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
    )


def earlier_splits() -> Window:
    """The splits of the same file before this one."""
    return Window.partitionBy("_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)


def split_index(written: DataFrame, *summary: Column) -> DataFrame:
    """One row per split of written lines: how many lines, the first id, the lines of the file before it, and ``summary``.

    It is read from the narrow columns of the very rows it describes, so the two cannot disagree.
    """
    splits = written.groupBy(*SPLIT).agg(F.count(F.lit(1)).alias("_lines"), F.min("_id").alias("_first"), *summary)
    return splits.withColumn("_before", F.coalesce(F.sum("_lines").over(earlier_splits()), F.lit(0)))


def on_split(written: DataFrame, splits: DataFrame) -> DataFrame:
    """Lines with their split's row. A split without one is an error, never a lost line."""
    known = F.when(F.col("_before").isNull(), F.raise_error(F.concat(F.lit("no index of the split of "), "_path"))).otherwise(F.col("_before"))
    joined = written.join(splits, SPLIT, "left").withColumn("_before", known)
    return joined.withColumn("line_number_in_file", F.col("_id") - F.col("_first") + F.col("_before"))


def read_numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``read_lines`` plus ``line_number_in_file``, the 0-based position in the file.

    The files are read once: lines are written with the split they are from and a number that grows inside it. The index of
    the splits comes from these written rows, one row each, and a prefix sum over a file's splits turns a place in the split
    into a place in the file. A ``.gz`` file is unpacked by one task; its written lines are dealt out by row groups.
    """
    written = materialise(placed_lines(spark, path), "lines", **ROW_GROUP)
    return on_split(written, split_index(written)).select("value", "source_file", "line_number_in_file")
