"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
LOCAL_SCRATCH = "spark.registrylake.localScratch"
SCOPE = "spark.registrylake.scope"


def local_session(cores: int | str = 8, app: str = "registrylake", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 256 << 20, least: int = 200) -> int:
    """A value for ``spark.sql.shuffle.partitions``: AQE joins small partitions but never splits a plan
    that starts with too few, so a cluster job over many terabytes should start with this many."""
    return max(least, -(-input_bytes // target_bytes))


def _named_folder(spark: SparkSession) -> str | None:
    return spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only when that is unset and the session is a
    local one (tests, laptop) is a temporary folder made; on a cluster a missing setting is an error,
    because a machine-local folder would lose data with its machine.
    """
    folder = _named_folder(spark)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    folder = spark.conf.get(LOCAL_SCRATCH, None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="registrylake-")
        spark.conf.set(LOCAL_SCRATCH, folder)
    return folder


def _own_scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/registrylake/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    scope = spark.conf.get(SCOPE, None)
    return f"{_own_scratch(spark)}/{scope + '/' if scope else ''}{label}-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear_scratch(spark: SparkSession) -> None:
    """Drop this application's intermediate tables; DataFrames that still read them end to work."""
    _delete(spark, _own_scratch(spark))


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are dropped at the end; what they were for must be written or collected by then."""
    outer, scope = spark.conf.get(SCOPE, None), f"scope-{uuid.uuid4().hex}"
    spark.conf.set(SCOPE, scope)
    try:
        yield
    finally:
        spark.conf.set(SCOPE, outer) if outer else spark.conf.unset(SCOPE)
        _delete(spark, f"{_own_scratch(spark)}/{scope}")


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What queries shuffle inside is deleted as each ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before) if before else spark.conf.unset(SHUFFLE_CLEANUP)


def materialise(df: DataFrame, label: str = "stage", **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Cuts lineage like a reliable checkpoint, but columnar, so that later steps read only the columns
    they use. Values that depend on task placement (chunk numbers) become plain stored data, and a
    lost executor costs a re-read, never a re-numbering. ``options`` go to the writer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
