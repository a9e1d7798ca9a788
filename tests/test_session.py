"""Where intermediate tables go."""

import re

import pytest
from pyspark.sql import functions as F

from registrylake import session


def test_the_cluster_names_the_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_named_folder", lambda spark: f"file:{tmp_path}/")
    assert session.shared_folder(spark) == f"file:{tmp_path}"
    kept = session.materialise(spark.range(5), "five")
    assert kept.count() == 5 and list(tmp_path.glob("registrylake/*/five-*/*.parquet"))
    session.clear_scratch(spark)
    assert not list(tmp_path.glob("registrylake/*"))


def test_without_a_folder_only_a_local_session_goes_on(spark, monkeypatch):
    monkeypatch.setattr(session, "_named_folder", lambda spark: None)
    assert session.shared_folder(spark) == session.shared_folder(spark)
    monkeypatch.setattr(spark.sparkContext, "master", "spark://somewhere:7077")
    with pytest.raises(RuntimeError, match="checkpoint"):
        session.shared_folder(spark)


def test_partition_count():
    assert session.shuffle_partitions_for(1) == 200
    assert session.shuffle_partitions_for(100 * 10**12) == 372530


def test_stages_of_a_scope_go_with_it(spark):
    from registrylake.session import materialise, scratch_path, scratch_scope

    outside = materialise(spark.range(3))
    with scratch_scope(spark):
        inside = scratch_path(spark, "x")
        spark.range(5).write.parquet(inside)
        with scratch_scope(spark):
            assert materialise(spark.range(2)).count() == 2
        assert spark.read.parquet(inside).count() == 5
    assert outside.count() == 3
    path = spark._jvm.org.apache.hadoop.fs.Path(inside)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def test_shuffles_go_when_their_query_ends(spark):
    import time

    def shuffled():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().toList().toString()
        return set(re.findall(r"shuffle_(\d+)_", blocks))

    before = spark.conf.get(session.SHUFFLE_CLEANUP, None)
    known = shuffled()
    with session.shuffles_dropped(spark):
        for _ in range(2):
            assert spark.range(1000).repartitionByRange(7, "id").groupBy((F.col("id") % 3).alias("k")).count().count() == 3
        session.materialise(spark.range(1000).repartition(5), "dropped")
    until = time.time() + 20
    while shuffled() - known and time.time() < until:
        time.sleep(0.1)
    assert not shuffled() - known
    assert spark.conf.get(session.SHUFFLE_CLEANUP, None) == before
