"""Landing folder to lake, end to end."""

import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F
from test_tables import cycle, made, put, record, root

from registrylake import refresh
from registrylake.operators.allocate import lease_production
from registrylake.quality.config import TableRules
from registrylake.sinks.publish import PublishBlocked, open_table
from registrylake.workloads.files import dbase_header

RUN = "2026-05-13T01:02:03+00:00"


def gz(path, lines):
    with gzip.open(path, "wt") as f:
        f.write("\n".join(lines) + "\n")


@pytest.fixture
def places(tmp_path):
    landing, lake = tmp_path / "landing", tmp_path / "lake"
    landing.mkdir()
    lake.mkdir()
    return landing, str(lake)


def test_operator_registry(spark, places):
    landing, lake = places
    lines = [put(" " * 350, (0, kind), (2, f"{i:06d}"), (8, f"OP {i}")) for i, kind in enumerate(["1T", "A ", "A ", "F ", "A "])]
    (landing / "p5_organization_20260501.txt").write_text("old\n")
    data = "\n".join(lines).encode()
    (landing / "p5_organization_20260512.txt").write_bytes(data)
    log = refresh.operator_registry(spark, str(landing), lake, RUN)
    assert {r.check_name for r in log.collect()} >= {"pk_unique", "required_nonnull", "row_count", "count_sanity"}
    names = lambda: sorted(r.operator_name for r in open_table(spark, f"{lake}/dim_operator_registry").collect())
    assert names() == ["OP 1", "OP 2", "OP 4"]
    assert open_table(spark, f"{lake}/dim_operator_consolidation").count() == 0
    refresh.operator_registry(spark, str(landing), lake, RUN, subset=2)
    assert names() == ["OP 1", "OP 2"]
    (landing / "source_meta.json").write_text(json.dumps({"sha256": hashlib.sha256(data).hexdigest()}))
    refresh.operator_registry(spark, str(landing), lake, RUN)
    (landing / "source_meta.json").write_text(json.dumps({"sha256": "0" * 64}))
    with pytest.raises(refresh.SourceProblem):
        refresh.operator_registry(spark, str(landing), lake, RUN)
    (landing / "source_meta.json").write_text("{}")
    (landing / "p5_organization_20260513.txt").write_text("F nothing here\n")
    with pytest.raises(refresh.SourceProblem):
        refresh.operator_registry(spark, str(landing), lake, RUN)
    with pytest.raises(refresh.SourceProblem):
        refresh.operator_registry(spark, str(landing), lake, RUN, gate=False)
    assert len(names()) == 3  # the failed refreshes changed nothing


def test_text_sources(spark, places):
    landing, lake = places
    gz(landing / "daf_20260513.gz", [put(" " * 108, (0, "08"), (2, f"{i:06d}"), (100, "003"), (103, f"{i:05d}")) for i in range(5)] + ["short"])
    refresh.drilling_permits(spark, str(landing), lake, RUN, subset=3)
    assert sorted(r.permit_number for r in open_table(spark, f"{lake}/dim_drilling_permits").collect()) == ["000000", "000001", "000002"]
    gz(landing / "uif_20260514.gz", [put(" " * 40, (0, kind), (28, "003"), (31, "00001")) for kind in ("01", "02", "01")])
    refresh.injection(spark, str(landing), lake, RUN)
    assert open_table(spark, f"{lake}/dim_injection_uic_raw").count() == 3
    assert open_table(spark, f"{lake}/dim_injection_uic").count() == 2
    gz(landing / "x_20260515.gz", ["01" + " " * 90, "", "02PARTY", "15 1  subject"])
    refresh.hearings(spark, str(landing), lake, RUN)
    assert sorted(r.line_number_in_file for r in open_table(spark, f"{lake}/dim_hearings").collect()) == [0, 2, 3]
    (landing / "insp_20260513.txt").write_text("Operator Name}API No\nACME}123\nB}\n")
    with pytest.raises(PublishBlocked):
        refresh.inspections(spark, str(landing), lake, RUN)
    log = refresh.inspections(spark, str(landing), lake, RUN, gate=False)
    assert {r.check_name: r.check_status for r in log.collect()}["required_nonnull"] == "fail"
    assert {r.api10 for r in open_table(spark, f"{lake}/fact_inspections").collect()} == {"4200000123", None}
    with pytest.raises(refresh.SourceProblem):
        refresh.production(spark, str(landing / ".."), lake, RUN)


def test_production_to_monthly_total(spark, places):
    landing, lake = places
    records = [root("08", "000001"), cycle("2304"), made(10, 1), made(5, 2), cycle("2305"), made(7, 3), record("22", "note"), root("09", "000002"), cycle("2304"), made(1, 1)]
    (landing / "PDF100.ebc").write_bytes(b"".join(records))
    refresh.production(spark, str(landing), lake, RUN)
    monthly = open_table(spark, f"{lake}/fact_production_monthly")
    totals = lease_production(monthly.where("lease_number = '000001'"), ["district", "lease_number", "prod_year"], "prod_month", "oil_production_bbl")
    assert {(r.prod_year, r.prod_month, r.oil_production_bbl) for r in totals.collect()} == {("2023", "04", 15), ("2023", "05", 7)}
    assert open_table(spark, f"{lake}/fact_production_records_raw").count() == 10
    plan = totals._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(lease_number), EqualTo(lease_number,000001)]" in plan
    refresh.production(spark, str(landing), lake, RUN, subset=4)
    assert open_table(spark, f"{lake}/fact_production_monthly").count() == 2


LAYOUT = (("APINUM", 8), ("LEASE_NAME", 8), ("GAS_RRCID", 6), ("OPERATOR", 6), ("COMPLETION", 8))


def test_wells_and_quality(spark, places):
    landing, lake = places
    rows = [("00300001", "L1", "r1", "A", "20000101"), ("00300001", "L2", "r2", "B", "20050505"), ("00300002", "L1", "r3", "A", "20010101"), ("00300002", "L1", "r3", "C", "20010101")]
    body = b"".join(b" " + b"".join(v.encode().ljust(w) for v, (_, w) in zip(r, LAYOUT, strict=True)) for r in rows)
    (landing / "api003.dbf").write_bytes(dbase_header(LAYOUT, len(rows)) + body)
    (landing / "api004.dbf").write_bytes(b"too short")
    logs = refresh.wells(spark, str(landing), lake, RUN)
    assert tuple(logs["key_sets"].first()) == (0, 0, True)
    assert [r.path.rsplit("/", 1)[-1] for r in logs["bad_files"].collect()] == ["api004.dbf"]
    refresh.operator_history(spark, lake, RUN)
    refresh.lease_crosswalk(spark, lake, RUN)
    count = lambda slug: open_table(spark, f"{lake}/{slug}").count()
    slugs = ["fact_well_records_raw", "well_master", "fact_well_completions", "dim_operator_history", "dim_well_lease_crosswalk"]
    assert [count(s) for s in slugs] == [4, 2, 3, 3, 3]
    summary, queue = refresh.quality(spark, lake, RUN, [*slugs, "missing"])
    got = {(r.table_slug, r.check_name): r.latest_status for r in summary.collect()}
    assert got["well_master", "pk_unique"] == "pass" and got["fact_well_completions", "fk_match_rate"] == "pass"
    assert got["well_master", "count_sanity"] == "fail" and got["missing", "table_exists"] == "error"
    skipped = ("fact_well_records_raw", "source_files_read")
    assert {(r.table_slug, r.check_name, r.is_new) for r in queue.collect()} == {("well_master", "count_sanity", True), (*skipped, True)}
    later = RUN.replace("2026", "2027")
    loose = {"well_master": TableRules(pk=("api10",)), "fact_well_completions": TableRules(count_range=(10, 20, "events"))}
    summary, queue = refresh.quality(spark, lake, later, [*slugs, "missing"], loose)
    # the unchanged failure stays in the summary from the earlier run and is no longer new
    assert {(r.table_slug, r.check_name, r.is_new) for r in queue.collect()} == {
        ("well_master", "count_sanity", False), ("fact_well_completions", "count_sanity", True), (*skipped, False),
    }
    assert spark.read.parquet(f"{lake}/qa_well_master").select(F.count_distinct("checked_at")).first()[0] == 2
    refresh.wells(spark, str(landing), lake, RUN, subset=2)
    assert count("well_master") == 1
    refresh.operator_history(spark, lake, RUN, subset=1)
    assert count("dim_operator_history") == 2


def test_well_months(spark, places):
    landing, lake = places
    rows = [("00300001", "L1", "r1", "A", "20000101"), ("00300002", "L1", "r3", "A", "20230501")]
    body = b"".join(b" " + b"".join(v.encode().ljust(w) for v, (_, w) in zip(r, LAYOUT, strict=True)) for r in rows)
    (landing / "api003.dbf").write_bytes(dbase_header(LAYOUT, len(rows)) + body)
    refresh.wells(spark, str(landing), lake, RUN)
    refresh.lease_crosswalk(spark, lake, RUN)
    lines = [put(" " * 40, (0, "01"), (2, "08"), (4, "000001"), (28, "003"), (31, f"0000{i}")) for i in (1, 2)]
    gz(landing / "uif_20260514.gz", [*lines, lines[0]])
    refresh.injection(spark, str(landing), lake, RUN)
    records = [root("08", "000001"), cycle("2304"), made(10, 1), made(5, 2), cycle("2305"), made(7, 3), root("09", "000002"), cycle("2304"), made(1, 1)]
    (landing / "PDF100.ebc").write_bytes(b"".join(records))
    refresh.production(spark, str(landing), lake, RUN)
    logs = refresh.lease_wells(spark, lake, RUN)
    assert open_table(spark, f"{lake}/dim_lease_well_bridge").count() == 2
    got = open_table(spark, f"{lake}/fact_well_production_monthly").collect()
    # in April only the first well was there
    assert {(r.api10, r.month, r.oil_production_bbl, r.largest_lease) for r in got} == {
        ("4200300001", 202304, 15.0, 1), ("4200300001", 202305, 3.5, 2), ("4200300002", 202305, 3.5, 2),
    }
    coverage = logs["coverage"].first()
    assert (coverage.n_leases, coverage.n_bridged, coverage.volume, coverage.volume_bridged) == (2, 1, 23, 22)


def test_corrections(spark, places):
    landing, lake = places
    (landing / "new").mkdir()
    records = [root("08", "000001"), cycle("2304"), made(10, 1), cycle("2405"), made(7, 3), root("09", "000002"), cycle("2304"), made(1, 1)]
    (landing / "PDF100.ebc").write_bytes(b"".join(records))
    refresh.production(spark, str(landing), lake, RUN)
    slug = f"{lake}/fact_production_monthly"
    year = lambda y: sorted(f for f in open_table(spark, slug).inputFiles() if f"prod_year={y}" in f)
    months = lambda: {(r.lease_number, r.prod_year, r.prod_month): r.oil_production_bbl for r in open_table(spark, slug).collect()}
    assert months() == {("000001", "2023", "04"): 10, ("000001", "2024", "05"): 7, ("000002", "2023", "04"): 1}
    untouched = year("2024")
    (landing / "new" / "corr1.ebc").write_bytes(b"".join([root("08", "000001"), cycle("2304"), made(11, 1, "Y")]))
    refresh.corrections(spark, str(landing / "new"), lake, RUN)
    assert months() == {("000001", "2023", "04"): 11, ("000001", "2024", "05"): 7, ("000002", "2023", "04"): 1}
    files = open_table(spark, slug).inputFiles()
    refresh.corrections(spark, str(landing / "new"), lake, RUN)  # nothing new has landed
    assert sorted(open_table(spark, slug).inputFiles()) == sorted(files)
    for i, oil in ((2, 12), (3, 13)):
        (landing / "new" / f"corr{i}.ebc").write_bytes(b"".join([root("09", "000002"), cycle("2304"), made(oil, 1, "Y")]))
    refresh.corrections(spark, str(landing / "new"), lake, RUN)
    assert months()["000002", "2023", "04"] == 13 and months()["000001", "2023", "04"] == 11
    assert year("2024") == untouched
