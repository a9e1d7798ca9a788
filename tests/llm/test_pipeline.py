"""Every stage against the operator's own result on a small corpus, and the whole against the stages by hand."""

from pathlib import Path

import pytest

import __spark_entry__
import corpus_pipeline
from registrylake.llm import indexing, mixing, probminhash, spacedseeds

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the given tables")


def test_stages_one_after_the_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, after = docs, stage(spark, docs, SF)
        assert after.columns == columns
        rows, kept[name] = before.collect(), after.collect()
        ids = [r.doc_id for r in kept[name]]
        if name == "quality_classifier":
            bad = {r.doc_id for r in indexing.score_quality(before, labels).where("score < 0.5").collect()}
            assert sorted(ids) == sorted({r.doc_id for r in rows} - bad)
        elif name == "minhash_near_dedup":
            assert sorted(ids) == sorted({r.class_id for r in probminhash.near_classes(before).collect()})
        elif name == "benchmark_decontamination":
            bad = {r.doc_id for r in spacedseeds.mark_contaminated(before, bench).where("contaminated").collect()}
            assert sorted(ids) == sorted({r.doc_id for r in rows} - bad)
        else:
            want = {r.doc_id: r.repeats for r in mixing.mix(before, (5.0, 2.0, 1.0)).collect()}
            assert {i: ids.count(i) for i in set(ids)} == {i: n for i, n in want.items() if n}
        docs = spark.createDataFrame(kept[name], before.schema)
    whole = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in whole) == sorted(r.doc_id for r in kept["source_mixing"])
    assert sorted(r.start for r in whole)[0] == 0


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []


def test_queries_are_registered():
    names = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {x.split("_")[0] for x in names} and "pipeline" in names
