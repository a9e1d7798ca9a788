"""Corrected production reports, merged into the published months as their files land."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from registrylake.operators.keysets import union_by_name
from registrylake.sinks.publish import open_table, publish, table_properties
from registrylake.tables.corrections import apply_corrections
from registrylake.tables.production import production_monthly, read_tape_with_parents

PARTITION = "prod_year"


def merge_batch(arrived: DataFrame, batch: int, target: str, stream: str) -> bool:
    """Merge one batch into the partitions it touches; all other partitions stay where they are. Tells whether anything was done.

    The version that holds a batch also holds its number, in the same step, so a batch that comes again, after a failure between
    the merge and the stream's own note of it, changes nothing.
    """
    spark, done = arrived.sparkSession, f"batch of {stream}"
    if table_properties(spark, target).get(done, -1) >= batch:
        return False
    published = open_table(spark, target)
    parts = [r[0] for r in arrived.select(PARTITION).distinct().collect()]  # years
    touched = published.where(published[PARTITION].isin(*parts))
    merged = apply_corrections(touched, arrived.select(*published.columns))
    publish(merged, target, partition_by=[PARTITION], carry=True, properties={done: batch})
    return True


def merge_landed(spark: SparkSession, folder: str, pattern: str, target: str, checkpoint: str, run_ts: str, stream: str = "corrections") -> None:
    """Merge all tapes that landed in ``folder`` since the last run; one file is one batch, in the order they landed.

    The stream only lists files. The records of a batch are read by the tape source, split by bytes.
    """
    listed = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
    files = listed.option("pathGlobFilter", pattern).option("maxFilesPerTrigger", 1).load(folder).select("path")

    def merge(batch: DataFrame, number: int) -> None:
        paths = [r.path for r in batch.collect()]
        if paths:
            months = [production_monthly(read_tape_with_parents(spark, p, types=("03",)), run_ts) for p in paths]
            merge_batch(reduce(union_by_name, months), number, target, stream)

    writer = files.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer.start().awaitTermination()
