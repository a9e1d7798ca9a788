"""The landing folder: newest snapshot and integrity against the sidecar."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrylake.sources import paths
from registrylake.sources.paths import locate, ship_with_tasks

SIDECAR = "source_meta.json"

# File patterns per source, in order of priority.
PATTERNS = {
    "operator_registry": ("p5_organization_*.txt", "p5_organization_*.txt.gz"),
    "production": ("*.txt", "*.ebc", "*.dat"),
    "drilling_permits": ("*.gz", "*.txt"),
    "injection": ("*.gz", "*.txt", "*.dat"),
    "hearings": ("*.gz", "*.txt"),
    "inspections": ("*.txt", "*.csv", "*.dat", "*.gz"),
}


def list_landed(spark: SparkSession, folder: str) -> DataFrame:
    """path, file_name, length of the files in the folder and in ``key=value`` folders of it; contents are not read.

    Other folders, those of published tables among them, are not looked into.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    root = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")
    inside = F.expr(f"substring(path, {len(root) + 2})")
    files = files.where(inside.rlike("^([^/=]+=[^/]*/)*[^/]+$") & ~inside.startswith("version="))
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "length")


def _glob_to_regex(pattern: str) -> str:
    return "^" + "".join(".*" if ch == "*" else "[.]" if ch == "." else ch for ch in pattern) + "$"


def rank_snapshots(files: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Files that match a pattern with the pattern's priority; best first is (priority, name descending)."""
    priority = F.coalesce(
        *[F.when(F.col("file_name").rlike(_glob_to_regex(p)), F.lit(i)) for i, p in enumerate(patterns)]
    )
    return files.withColumn("priority", priority).where("priority is not null")


def newest_snapshot(spark: SparkSession, folder: str, patterns: Sequence[str]) -> str | None:
    """The file to read: first pattern that matches anything, last name there."""
    best = rank_snapshots(list_landed(spark, folder), patterns).orderBy("priority", F.desc("file_name")).first()
    return best["path"] if best else None


def _digest(batches: Iterator) -> Iterator:
    import hashlib

    import pyarrow as pa

    for batch in batches:
        digests = []
        for path in batch.column("path").to_pylist():
            filesystem, inner = locate(path)
            h = hashlib.sha256()
            with filesystem.open_input_stream(inner) as f:
                while block := f.read(8 << 20):
                    h.update(block)
            digests.append(h.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(digests, pa.string())], ["path", "actual"])


def verify_sources(spark: SparkSession, folder: str, path: str | None = None) -> DataFrame:
    """SHA-256 of every landed file (or the one at ``path``) against its folder's sidecar.

    Files are hashed as streams, one task per few files, so size does not matter. No sidecar and no
    expected digest pass; only a mismatch is not ok.
    """
    ship_with_tasks(paths)
    ship_with_tasks(sys.modules[__name__])
    files = list_landed(spark, folder).where(F.col("file_name") != SIDECAR).select("path")
    if path:
        files = files.where(F.col("path") == path)
    spread = files.repartition("path")
    actual = spread.mapInArrow(_digest, "path string, actual string")
    where = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    sidecars = list_landed(spark, folder).where(F.col("file_name") == SIDECAR)
    if sidecars.isEmpty():
        meta = spark.createDataFrame([], "_dir string, expected string, _found boolean")
    else:
        read = spark.read.schema("sha256 string").json(folder, multiLine=True, pathGlobFilter=SIDECAR)
        meta = read.select(
            F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]*$", 1).alias("_dir"),
            F.col("sha256").alias("expected"),
            F.lit(True).alias("_found"),
        )
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    joined = actual.withColumn("_dir", plain(where)).join(meta.withColumn("_dir", plain(F.col("_dir"))), "_dir", "left")
    status = (
        F.when(F.col("_found").isNull(), "no_sidecar")
        .when(F.coalesce(F.col("expected"), F.lit("")) == "", "no_expected_digest")
        .when(F.col("expected") == F.col("actual"), "verified")
        .otherwise("mismatch")
    )
    return joined.select("path", "expected", "actual", status.alias("status"), (status != "mismatch").alias("ok"))
