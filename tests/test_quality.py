"""Every branch of every check, the runner, the gate and the summary."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrylake.quality import checks as Q
from registrylake.quality import config, runner, summary
from registrylake.sinks import publish as P

RUN = "2026-01-31T00:00:00+00:00"


def one(check):
    rows = Q.evaluate([check]).collect()
    assert len(rows) == 1
    return rows[0]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_pk_unique(spark):
    df = frame(spark, [("a", 1), ("a", 1), (None, 2), (None, 2), ("b", 1)], "k string, n int")
    r = one(Q.pk_unique(df, ["k", "n"]))
    assert (r.check_status, r.check_value, r.notes) == ("fail", "4 duplicates", "PK columns: ['k', 'n']")
    assert one(Q.pk_unique(df.distinct(), ["k", "n"])).check_status == "pass"
    assert one(Q.pk_unique(df.limit(0), "k")).check_value == "0 duplicates"


def test_required_nonnull(spark):
    df = frame(spark, [(i, None if i == 0 else "x", None if i < 2 else "x", "") for i in range(100)], "i int, at string, above string, blank string")
    assert one(Q.required_nonnull(df, ["i", "at", "blank"])).check_status == "pass"
    r = one(Q.required_nonnull(df, ["i", "above", "absent"]))
    assert (r.check_status, r.check_value) == ("fail", "2 columns above threshold")
    assert r.notes == "above: 2.00% null (threshold 1%); absent missing from DataFrame" and r.check_threshold == "null rate < 1%"
    assert one(Q.required_nonnull(df.limit(0), ["i"])).check_status == "pass"
    many = one(Q.required_nonnull(df, [f"c{i}" for i in range(7)]))
    assert many.check_value == "7 columns above threshold" and many.notes.count(";") == 4


def test_date_range(spark):
    df = frame(spark, [("2026-07-31", "20260801", "junk"), ("2026-01-01", None, "also")], "at string, late string, bad string")
    assert one(Q.date_range_sane(df, ["at", "bad", "absent"], RUN)).check_status == "pass"
    r = one(Q.date_range_sane(df, ["at", "late"], RUN))
    assert (r.check_status, r.check_value, r.notes) == ("fail", "1 columns with future dates", "late: 1 rows > 2026-07-31")


def test_boolean(spark):
    df = frame(spark, [(True, True, None), (False, True, None), (None, None, None)], "both boolean, one boolean, none boolean")
    assert one(Q.boolean_not_uniform(df, ["both", "absent"])).check_status == "pass"
    r = one(Q.boolean_not_uniform(df, ["both", "one", "none"]))
    assert (r.check_status, r.notes) == ("warn", "one=True; none=empty")


def test_schema_checks(spark):
    df = frame(spark, [("a", 1)], "api10 string, n bigint")
    assert one(Q.identifier_columns_str(df, ["api10"])).check_status == "pass"
    assert one(Q.identifier_columns_str(df, ["n"])).notes == "n: bigint"
    assert one(Q.schema_match(df, ["api10"])).check_status == "pass"
    assert one(Q.schema_match(df, ["api10", "z"])).notes == "missing: ['z']"
    assert one(Q.dtype_match(df, {"n": "bigint"})).check_status == "pass"
    assert one(Q.dtype_match(df, {"n": "string"})).check_status == "fail"
    assert one(Q.key_column_named(df)).check_status == "pass"
    assert one(Q.key_column_named(df, "api14")).check_status == "fail"
    other = frame(spark, [(1,)], "n int")
    assert one(Q.dtype_consistency({"a": df, "b": other}, "n")).check_status == "fail"
    assert one(Q.dtype_consistency({"a": df, "b": other}, "api10")).check_status == "pass"


@pytest.mark.parametrize(("n", "expected", "tolerance", "status"), [
    (100, 100, 0.0, "pass"), (99, 100, 0.01, "pass"), (98, 100, 0.01, "warn"), (102, 100, 0.01, "warn"), (0, 0, 0.01, "warn"),
    (5, 0, 0.01, "pass"), (5, None, 0.0, "pass"), (0, None, 0.0, "warn"),
])
def test_row_count(spark, n, expected, tolerance, status):
    assert one(Q.row_count(spark.range(n), expected, tolerance)).check_status == status


def test_row_count_text(spark):
    r = one(Q.row_count(spark.range(1234), 2345))
    assert (r.check_value, r.check_threshold, r.notes) == ("1,234", "2,345 +/- 1%", "delta: -1,111")
    assert one(Q.row_count_match(spark.range(5), spark.range(5))).check_status == "pass"
    assert one(Q.row_count_match(spark.range(5), spark.range(4))).check_status == "fail"


@pytest.mark.parametrize(("orphans", "status"), [(0, "pass"), (1, "pass"), (2, "warn"), (5, "warn"), (6, "fail")])
def test_fk_match_rate(spark, orphans, status):
    child = frame(spark, [(None if i >= 100 else (-1 - i if i < orphans else i),) for i in range(120)], "k int")
    parent = spark.createDataFrame([(i,) for i in range(100)] + [(None,), (7,)], "id int")
    r = one(Q.fk_match_rate(child, "k", parent, "id"))
    assert (r.check_status, r.check_value, r.notes) == (status, f"{100 - orphans}.00% ({orphans} orphans)", "k -> id")


def test_fk_edges(spark):
    parent = frame(spark, [(1,)], "id int")
    assert one(Q.fk_match_rate(frame(spark, [(None,)], "k int"), "k", parent, "id")).check_value == "100.00% (0 orphans)"
    assert one(Q.fk_match_rate(parent, "absent", parent, "id")).check_status == "error"


@pytest.mark.parametrize(("orphans", "status"), [(5, "pass"), (6, "warn"), (20, "warn"), (21, "fail")])
def test_orphans(spark, orphans, status):
    child = frame(spark, [(-1 if i < orphans else 1, "x" if i % 2 else "y") for i in range(100)], "k int, c string")
    parent = frame(spark, [(1,)], "id int")
    assert one(Q.orphan_count(child, "k", parent, "id")).check_status == status
    shares = {r.category: r.n_orphans for r in Q.orphans_by_category(child, "k", parent, "id", "c").collect()}
    assert sum(shares.values()) == orphans
    top = max(shares.values()) / orphans
    assert one(Q.orphan_distribution(child, "k", parent, "id", "c")).check_status == ("warn" if top > 0.5 else "pass")


def test_cardinality(spark):
    df = frame(spark, [("a",)] * 3 + [("b",)] * 2 + [("c",), ("d",), (None,), (None,), (None,), (None,)], "k string")
    r = one(Q.cardinality_bounds(df, "k", 3))
    assert (r.check_status, r.check_value, r.check_threshold) == ("pass", "max group: 3", "max <= 3")
    assert r.notes == "top groups: {'a': 3, 'b': 2, 'c': 1}"
    assert one(Q.cardinality_bounds(df, "k", 2)).check_status == "warn"
    assert one(Q.cardinality_bounds(df, "absent", 2)).check_status == "error"
    assert one(Q.cardinality_bounds(df.limit(0), "k", 2)).check_value == "max group: nan"


def test_cross_ref_and_names(spark):
    now = frame(spark, [(i, "x") for i in range(100)], "api10 int, op string")
    assert one(Q.cross_ref_consistency(frame(spark, [(i, "x" if i else "old") for i in range(100)], "api10 int, op string"), now, "api10", "op", "op")).check_status == "pass"
    assert one(Q.cross_ref_consistency(frame(spark, [(i, "x" if i > 1 else "old") for i in range(100)], "api10 int, op string"), now, "api10", "op", "op")).check_status == "fail"
    names = frame(spark, [("A", 1), ("A", 1), ("A", None), ("B", 1), ("B", 2), (None, 3), (None, 4)], "name string, id int")
    assert one(Q.name_to_id_cardinality(names, "name", "id")).check_value == "1 names with several IDs"
    assert one(Q.name_to_id_cardinality(names.where("name = 'A'"), "name", "id")).check_status == "pass"


def test_level_three(spark):
    assert [one(Q.count_sanity(spark.range(n), 5, 10, "wells")).check_status for n in (4, 5, 10, 11)] == ["fail", "pass", "pass", "fail"]
    r = one(Q.count_sanity(spark.range(1500), 1000, 2000, "wells"))
    assert (r.check_value, r.check_threshold, r.notes, r.check_level) == ("1,500 wells", "1,000-2,000", "within range", 3)
    docs = lambda rate: frame(spark, [("w2", i < rate) for i in range(100)] + [("p4", True)] * 10, "kind string, ok boolean")
    status = lambda rate: one(Q.extraction_coverage(docs(rate), "kind", F.col("ok"))).check_status
    assert [status(x) for x in (90, 89, 80, 79)] == ["pass", "warn", "warn", "fail"]
    reports = frame(spark, [("a", "N"), ("a", "Y"), ("b", "N"), ("b", "N"), ("c", None)], "k string, corrected_report_flag string")
    assert {(r.k, r.n_reports) for r in Q.only_original_reports(reports, ["k"]).collect()} == {("b", 2), ("c", 1)}
    assert one(Q.corrected_report_handling(reports, ["k"])).check_status == "warn"
    checked = frame(spark, [("PASS",)] * 10, "status string")
    assert one(Q.spot_check_authoritative(checked)).check_value == "10/10 PASS"
    manifest = frame(spark, [("a", 1), ("b", 2)], "table_name string, n_rows bigint")
    assert one(Q.manifest_consistency(manifest, manifest)).check_status == "pass"
    assert one(Q.manifest_consistency(manifest, frame(spark, [("a", 1), ("c", 2)], "table_name string, n_rows bigint"))).check_value == "2 of 3 tables differ"


def test_a_check_that_cannot_run_is_an_error_and_the_others_run(spark):
    df = spark.range(3)
    broken = Q.Check("broken", 1, "none", df, {"x": df.id.cast("int").getField("nope")}, lambda m: (m("x"), m("x"), m("x")))
    rows = {r.check_name: r.check_status for r in Q.evaluate([broken, Q.row_count(df, 3)]).collect()}
    assert rows == {"broken": "error", "row_count": "pass"}


@pytest.mark.parametrize("check", [
    lambda df: Q.pk_unique(df, ["absent"]), lambda df: Q.fk_match_rate(df, "id", df, "absent"), lambda df: Q.orphan_count(df, "absent", df, "id"),
    lambda df: Q.name_to_id_cardinality(df, "absent", "id"), lambda df: Q.corrected_report_handling(df, ["absent"]),
])
def test_absent_columns_are_errors(spark, check):
    assert one(check(spark.range(3))).check_status == "error"


def test_not_a_number_counts_as_missing(spark):
    df = frame(spark, [(float("nan"),), (1.0,)], "x double")
    assert one(Q.required_nonnull(df, ["x"])).notes == "x: 50.00% null (threshold 1%)"


def test_single_scan_for_single_table_checks(spark, tmp_path):
    spark.range(10).selectExpr("cast(id as string) api10", "id % 2 = 0 flag").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    rules = config.TableRules(required=("api10",), id_cols=("api10",), bool_cols=("flag",), count_range=(1, 20, "rows"))
    log = runner.run_checks(spark, "t", df, RUN, rules=rules)
    plan = log._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    assert [r.check_name for r in log.collect()] == ["required_nonnull", "boolean_not_uniform", "identifier_columns_str", "row_count", "count_sanity"]


def test_runner_and_registry(spark):
    assert len(config.TABLE_RULES) == 12 and config.rules_for("unknown") == config.TableRules()
    wells = frame(spark, [("4200000001", "00000001")], "api10 string, apinum string")
    permits = frame(spark, [("4200000001",), ("4200000002",)], "api10 string")
    log = runner.run_all(spark, {"well_master": wells, "dim_drilling_permits": permits, "lost": None}, RUN)
    got = {(r.table_slug, r.check_name): r.check_status for r in log.collect()}
    assert got == {
        ("well_master", "pk_unique"): "pass", ("well_master", "required_nonnull"): "pass", ("well_master", "identifier_columns_str"): "pass",
        ("well_master", "row_count"): "pass", ("well_master", "count_sanity"): "fail", ("dim_drilling_permits", "required_nonnull"): "pass",
        ("well_master", "schema_match"): "pass", ("well_master", "dtype_match"): "pass", ("well_master", "api_column_named_api10"): "pass",
        ("dim_drilling_permits", "identifier_columns_str"): "pass", ("dim_drilling_permits", "row_count"): "pass",
        ("dim_drilling_permits", "fk_match_rate"): "fail", ("lost", "table_exists"): "error",
    }
    first = log.first()
    assert (first.ingestion_run_id, first.checked_at) == ("retroactive-2026-01-31T00:00:00", RUN)
    assert log.columns == [*runner.LOG_COLUMNS, "table_slug"]
    short = runner.check_log(spark.createDataFrame([("x", 1, "pass")], "check_name string, check_level bigint, check_status string"), RUN)
    assert short.columns == list(runner.LOG_COLUMNS) and short.first().notes == ""


def test_publish_gate_and_swap(spark, tmp_path):
    target = str(tmp_path / "table")
    check = lambda staged: runner.check_log(Q.evaluate([Q.pk_unique(staged, "id"), Q.count_sanity(staged, 100, 200, "rows")]), RUN)
    log = P.publish(spark.range(3), target, check)  # the level 3 failure does not block
    assert {r.check_status for r in log.collect()} == {"pass", "fail"}
    P.publish(P.open_table(spark, target).selectExpr("id + 10 AS id"), target, check)  # reads what it replaces
    assert sorted(r.id for r in P.open_table(spark, target).collect()) == [10, 11, 12]
    with pytest.raises(P.PublishBlocked):
        P.publish(spark.range(3).unionAll(spark.range(3)), target, check)
    assert sorted(r.id for r in P.open_table(spark, target).collect()) == [10, 11, 12]
    P.publish(spark.range(4).selectExpr("id", "id % 2 AS part"), str(tmp_path / "parts"), partition_by=["part"])
    parts = P.open_table(spark, str(tmp_path / "parts"))
    assert parts.columns == ["id", "part"] and sorted((r.id, r.part) for r in parts.collect()) == [(0, "0"), (1, "1"), (2, "0"), (3, "1")]
    assert "PartitionFilters: [isnotnull(part" in parts.where("part = '1'")._jdf.queryExecution().executedPlan().toString()


def test_a_reader_always_finds_a_table(spark, tmp_path):
    """At every step of a publish, a failing one included, the table is the old one or the new one."""
    target = str(tmp_path / "table")
    P.publish(spark.range(3), target)
    seen = []

    def check(staged):
        seen.append(P.open_table(spark, target).count())
        raise ValueError("a check that breaks")

    with pytest.raises(ValueError):
        P.publish(spark.range(5), target, check)
    opened = P.open_table(spark, target)
    assert seen == [3] and opened.count() == 3
    P.publish(spark.range(7), target)
    assert opened.count() == 3 and P.open_table(spark, target).count() == 7  # a reader inside the old version can end
    for n in (8, 9):
        P.publish(spark.range(n), target)
    assert P.open_table(spark, target).count() == 9
    assert len([p for p in (tmp_path / "table").iterdir() if p.name.startswith(P.MARKER)]) == P.KEPT


def test_partitions_are_carried(spark, tmp_path):
    target = str(tmp_path / "table")
    rows = lambda text: spark.createDataFrame(text, "year string, v int")
    P.publish(rows([("01", 1), ("02", 2), (None, 9)]), target, partition_by=["year"], properties={"a": 1})
    for v in range(3, 8):
        P.publish(rows([("02", v)]), target, partition_by=["year"], carry=True, properties={"b": v})
    assert sorted(map(tuple, P.open_table(spark, target).collect()), key=repr) == sorted([("01", 1), ("02", 7), (None, 9)], key=repr)
    assert P.table_properties(spark, target) == {"a": 1, "b": 7}
    P.publish(rows([("02", 1)]).where("v > 5"), target, partition_by=["year"])
    assert P.open_table(spark, target).collect() == []


def test_observed_checks_equal_evaluated_ones(spark, tmp_path):
    rows = spark.createDataFrame([("a", None, "20250101"), ("b", "x", "99999999"), (None, "y", "20240101")], "k string, v string, d string")
    rules = config.TableRules(required=("k", "v"), date_cols=("d",), id_cols=("k",), expected_columns=("k", "z"), count_range=(1, 2, "rows"), pk=("k",))
    observed, log_of = runner.written_checks(rows, rules, RUN, lambda: 5)
    assert {c.name for c in observed} >= {"required_nonnull", "date_range_sane", "row_count", "count_sanity"}
    log = P.publish(rows, str(tmp_path / "t"), log_of, gate=False, observed=observed)
    plain = runner.run_checks(spark, "x", rows, RUN, rules=rules, expected_rows=lambda: 5)
    assert sorted(map(tuple, log.collect())) == sorted(map(tuple, plain.collect()))
    assert {r.check_name: (r.check_status, r.notes) for r in log.collect()}["row_count"] == ("warn", "delta: -2")


def test_logs_that_do_not_read(spark, tmp_path):
    for name, data in (("junk", b"no parquet"), ("torn", b"PAR1 PAR1")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part-0.parquet").write_bytes(data)
    P.append_log(runner.run_checks(spark, "x", spark.range(2), RUN), str(tmp_path / "good"))
    openers = {n: (lambda n=n: spark.read.schema(runner.LOG_SCHEMA).parquet(str(tmp_path / n))) for n in ("junk", "good", "torn", "absent")}
    log = summary.collect_logs(spark, openers, RUN).collect()
    assert sorted((r.table_slug, r.check_name, r.check_level) for r in log) == [
        ("absent", "_read_error", 0), ("good", "row_count", 1), ("junk", "_read_error", 0), ("torn", "_read_error", 0),
    ]


def test_companions_and_log(spark, tmp_path):
    path = str(tmp_path / "history")
    schema = T.StructType([T.StructField("api10", T.StringType()), T.StructField("is_current", T.BooleanType())])
    assert P.create_if_absent(spark, path, schema) and not P.create_if_absent(spark, path, schema)
    assert P.open_table(spark, path).schema == schema and P.open_table(spark, path).count() == 0
    log = runner.run_checks(spark, "x", spark.range(2), RUN)
    P.append_log(log, str(tmp_path / "qa_x"))
    P.append_log(log, str(tmp_path / "qa_x"))
    assert spark.read.parquet(str(tmp_path / "qa_x")).count() == 2


def entry(table, check, status, at, run="r"):
    return (run, check, 1, status, "v", "t", at, "", table)


LOG = "ingestion_run_id string, check_name string, check_level bigint, check_status string, check_value string, check_threshold string, checked_at string, notes string, table_slug string"


def test_summary_and_new_issues(spark):
    log = spark.createDataFrame(
        [entry("a", "pk", "fail", "2026-01-01"), entry("a", "pk", "warn", "2026-01-02"), entry("a", "nn", "pass", "2026-01-02"),
         entry("b", "pk", "fail", "2026-01-01"), entry("b", "fk", "warn", "2026-01-01"), entry("c", "pk", "error", "2026-01-01")], LOG,
    )
    now = summary.latest_status(log)
    assert len(now.columns) == 9 and now.count() == 5
    first = {(r.table_slug, r.check_name, r.latest_status, r.is_new) for r in summary.new_issues(now, None).collect()}
    assert first == {("a", "pk", "warn", True), ("b", "pk", "fail", True), ("b", "fk", "warn", True)}
    before = summary.latest_status(spark.createDataFrame([entry("a", "pk", "fail", "2025-12-01"), entry("b", "pk", "fail", "2025-12-01"), entry("a", "nn", "fail", "2025-12-01")], LOG))
    later = {(r.table_slug, r.check_name): r.is_new for r in summary.new_issues(now, before).collect()}
    assert later == {("a", "pk"): True, ("b", "pk"): False, ("b", "fk"): True}
    rolled = {r.level: (r.n_pass, r.n_warn, r.n_fail, r.n_error) for r in summary.status_rollup(log).collect()}
    assert rolled == {"L1": (1, 2, 2, 1), "Total": (1, 2, 2, 1)}


def test_unreadable_log_becomes_a_row(spark, tmp_path):
    good = spark.createDataFrame([entry("x", "pk", "pass", "2026-01-01")[:-1]], LOG.rsplit(",", 1)[0])
    rows = summary.collect_logs(spark, {"a": lambda: good, "b": lambda: spark.read.parquet(str(tmp_path / "none"))}, RUN).collect()
    assert {(r.table_slug, r.check_name, r.check_status, r.check_level) for r in rows} == {("a", "pk", "pass", 1), ("b", "_read_error", "error", 0)}


def test_dates_of_five_to_seven_digits_are_no_dates(spark):
    df = spark.createDataFrame([("19999",), ("1999999",), ("20200131",), ("2020-01-31",), ("19999-01-01",), (None,)], "d string")
    got = [r[0] and r[0].strftime("%Y%m%d") for r in df.select(Q.parsed_timestamp(F.col("d"))).collect()]
    assert got == [None, None, "20200131", "20200131", None, None]
