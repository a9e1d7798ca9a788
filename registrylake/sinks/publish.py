"""Publishing: stage, check, show.

A table is a folder of versions. A version is a folder of its own, ``version=<id>``, with a file that tells its schema and the folders
its rows are in, and it is shown by an empty marker ``_published-<number>-<id>``. Making the marker is the one step that publishes: it
either happened or not, and the version shown before stays whole, so a reader always finds a table. The newest marker
counts; the version before it is kept for readers that are still in it, and what neither of them names is dropped.

A version of some partitions only (``carry``) names the folders of all others where they are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from registrylake.quality import checks as Q
from registrylake.quality.runner import blocks_publish

MARKER = "_published-"
VERSION = "version="
TABLE_FILE = "_table.json"
KEPT = 2


class PublishBlocked(RuntimeError):
    """A level 1 check failed; the published table is unchanged."""

    def __init__(self, log: DataFrame):
        super().__init__("level 1 check failed")
        self.log = log


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _names(spark: SparkSession, path: str) -> list[str]:
    filesystem, p = _hadoop(spark, path)
    return [s.getPath().getName() for s in filesystem.listStatus(p)] if filesystem.exists(p) else []


def _versions(names: Sequence[str]) -> list[tuple[int, str]]:
    """(number, id) of the markers, the newest first."""
    marks = [n.removeprefix(MARKER).split("-", 1) for n in names if n.startswith(MARKER)]
    return sorted(((int(number), version) for number, version in marks), reverse=True)


def _manifest(spark: SparkSession, path: str, version: str) -> dict:
    filesystem, p = _hadoop(spark, f"{path}/{VERSION}{version}/{TABLE_FILE}")
    stream = filesystem.open(p)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return json.loads(text)


def _current(spark: SparkSession, path: str) -> dict | None:
    versions = _versions(_names(spark, path))
    return _manifest(spark, path, versions[0][1]) if versions else None


def _read(spark: SparkSession, path: str, manifest: dict) -> DataFrame:
    schema = T.StructType.fromJson(manifest["schema"])
    folders = [f"{path}/{VERSION}{version}/{name}".rstrip("/") for name, version in manifest["folders"].items()]
    if not folders:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", path).parquet(*folders)
    return rows.select(*[f"`{n}`" for n in schema.names])


def table_exists(spark: SparkSession, path: str) -> bool:
    """Is there a version, or a plain folder of rows?"""
    names = _names(spark, path)
    return bool(_versions(names)) or any(not n.startswith((VERSION, ".", "_")) for n in names)


def open_table(spark: SparkSession, path: str) -> DataFrame:
    """The version shown now, with the columns and types it was published with. A plain folder of Parquet files is read as it is."""
    path = path.rstrip("/")
    manifest = _current(spark, path)
    return _read(spark, path, manifest) if manifest else spark.read.parquet(path)


def table_properties(spark: SparkSession, path: str) -> dict:
    """What the version shown now was published with beside its rows."""
    manifest = _current(spark, path.rstrip("/"))
    return manifest["properties"] if manifest else {}


def _write_version(df: DataFrame, target: str, version: str, partition_by: Sequence[str], carry: bool, properties: Mapping) -> DataFrame:
    """Rows and what tells of them; partition columns are text, so that 01 stays 01."""
    spark, folder = df.sparkSession, f"{target}/{VERSION}{version}"
    df.write.partitionBy(*partition_by).parquet(folder)
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name in partition_by else f.dataType) for f in df.schema])
    before = _current(spark, target) if carry else None
    names = [n for n in _names(spark, folder) if "=" in n] if partition_by else [""]
    folders = {**(before["folders"] if before else {}), **{name: version for name in names}}
    manifest = {"schema": json.loads(schema.json()), "folders": folders, "properties": {**(before["properties"] if before else {}), **properties}}
    filesystem, p = _hadoop(spark, f"{folder}/{TABLE_FILE}")
    out = filesystem.create(p, True)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    return _read(spark, target, manifest | {"folders": {name: version for name in names}})


def _show(spark: SparkSession, target: str, version: str) -> None:
    """The one step that publishes, then what no kept version names goes."""
    names = _names(spark, target)
    versions = _versions(names)
    number = versions[0][0] + 1 if versions else 1
    filesystem, marker = _hadoop(spark, f"{target}/{MARKER}{number:09d}-{version}")
    filesystem.create(marker, False).close()
    kept = [version, *[v for _, v in versions[: KEPT - 1]]]
    named = {v for k in kept for v in [k, *_manifest(spark, target, k)["folders"].values()]}
    drop = [f"{MARKER}{old:09d}-{v}" for old, v in versions[KEPT - 1 :]]
    drop += [f"{VERSION}{v}" for _, v in versions if v not in named]
    drop += [n for n in names if not n.startswith((VERSION, MARKER))]  # what a plain folder held before its first version
    for name in drop:
        filesystem.delete(_hadoop(spark, f"{target}/{name}")[1], True)


def publish(
    df: DataFrame,
    target: str,
    check: Callable[..., DataFrame] | None = None,
    partition_by: Sequence[str] = (),
    gate: bool = True,
    observed: Sequence[Q.Check] = (),
    carry: bool = False,
    properties: Mapping | None = None,
) -> DataFrame | None:
    """Write a version of ``target``, run ``check`` on what was written, then show it.

    With ``carry`` the rows replace the partitions they are in (of the first column of ``partition_by``) and all others stay.

    The plan behind ``df`` runs once. ``observed`` checks, which look at ``df`` itself, are measured by the write; ``check`` gets the
    written rows and, if there are any, the results of these. A failed level 1 check leaves the version unshown for
    inspection and raises; without ``gate`` it is only logged. An error that ``check`` raises always keeps the old
    table. Returns the check log.
    """
    spark, target = df.sparkSession, target.rstrip("/")
    version = uuid.uuid4().hex
    results = None
    if observed:
        try:
            df, results = Q.observing(df, observed)
        except AnalysisException:  # what cannot be measured on the way is read again
            spare = list(observed)
            results = lambda: Q.evaluate(spare)
    staged = _write_version(df, target, version, partition_by, carry, properties or {})
    log = None
    if check is not None:
        log = check(staged, results()) if results else check(staged)
        log = spark.createDataFrame(log.collect(), log.schema)  # a few rows: one per check
        if gate and blocks_publish(log):
            raise PublishBlocked(log)
    _show(spark, target, version)
    return log


def create_if_absent(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    """Publish an empty typed table unless one is there; tells whether it was."""
    if table_exists(spark, path):
        return False
    publish(spark.createDataFrame([], schema), path)
    return True


def append_log(log: DataFrame, path: str) -> None:
    """Check logs grow by run; the summary takes the latest row per check."""
    log.coalesce(1).write.mode("append").parquet(path)
