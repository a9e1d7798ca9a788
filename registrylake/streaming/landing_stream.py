"""Landing folder as a stream: the batch table transforms over files as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from registrylake.functions.text import ascii_replace


def stream_lines(spark: SparkSession, folder: str, pattern: str = "*", max_files: int = 1000) -> DataFrame:
    """New text files as lines: ``value``, ``source_file``."""
    raw = (
        spark.readStream.format("text")
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", str(max_files))
        .load(folder)
    )
    return raw.select(ascii_replace(F.col("value")).alias("value"), F.col("_metadata.file_name").alias("source_file"))


def run_available(
    lines: DataFrame, transform: Callable[[DataFrame], DataFrame], target: str, checkpoint: str
) -> StreamingQuery:
    """Append everything that has landed since the last run, then stop.

    The checkpoint remembers the files already read; the file sink commits a batch as a whole, so a
    restart neither loses nor repeats rows.
    """
    return (
        transform(lines)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
