"""Table transforms on generated regulatory files, against plain Python."""

import gzip
import random

import pytest
from pyspark.sql import functions as F
from test_operators import SPOT_CHECKS

from registrylake.sources.dbase import read_dbase
from registrylake.sources.text_lines import read_lines, read_numbered_lines
from registrylake.tables import (
    corrections,
    hearings,
    injection,
    inspections,
    operator_registry,
    permits,
    production,
    wells,
)
from registrylake.workloads.files import dbase_header

RUN = "2026-05-13T01:02:03+00:00"


def put(line, *cells):
    chars = list(line)
    for start, value in cells:
        chars[start : start + len(value)] = list(value)
    return "".join(chars)


# -- operator registry ---------------------------------------------------------------------------


def test_operator_registry(spark, tmp_path):
    blank = " " * 350
    full = put(
        blank, (0, "A "), (2, "000123"), (8, "ACME OIL"), (40, "Y"), (41, "A"), (42, "H"), (43, "P"), (44, "B"), (70, "1 MAIN ST"),
        (132, "AUSTIN"), (145, "TX"), (147, "78701"), (242, "19990131"), (250, "00000000"), (258, "5125550100"), (270, "ABCDEFGH"),
        (308, "2021"), (323, "X"),
    )
    lines = [
        "1T header", full, "A 000124SHORT", put(full, (2, "000125"), (41, "Q"), (44, "Z"), (70, " " * 9), (132, " " * 6), (145, "  "), (147, " " * 5)),
        "", "F 000123 something", put(blank, (0, "A "), (2, "000126"), (8, "CAF#"), (41, "S"), (44, "G"), (145, "TX")),
    ]
    data = "\r\n".join(lines).encode("ascii").replace(b"CAF#", b"CAF\xc9")
    (tmp_path / "p5_organization_20260512.txt").write_bytes(data)
    read = read_lines(spark, str(tmp_path))
    rows = {r.operator_number: r for r in operator_registry.operator_registry(read, RUN).collect()}
    assert list(rows["000123"].asDict()) == list(operator_registry.COLUMNS) and len(operator_registry.COLUMNS) == 41
    a = rows["000123"]
    assert (a.operator_name, a.p5_status, a.p5_status_raw, a.organization_type, a.refiling_required) == ("ACME OIL", "active", "A", "limited_partnership", "Y")
    assert (a.mailing_address, a.physical_address, a.gatherer_code) == ("1 MAIN ST, AUSTIN, TX 78701", None, None)
    assert (a.date_built, a.date_inactive, a.refile_letter_date, a.filing_problem_date) == ("1999-01-31", None, "ABCD-EF-GH", None)
    assert (a.phone_number, a.tax_cert, a.scraped_at) == ("5125550100", "X", RUN)
    short = rows["000124"]
    assert (short.operator_name, short.p5_status, short.hold_mail_code, short.date_built, short.mailing_address) == ("SHORT", "", "", None, None)
    assert (rows["000125"].p5_status, rows["000125"].organization_type, rows["000125"].mailing_address) == ("Q", "Z", None)
    assert (rows["000126"].operator_name, rows["000126"].p5_status, rows["000126"].mailing_address) == ("CAF�", "see_remarks", "TX")
    counts = {r[0]: r[1] for r in operator_registry.record_type(read).groupBy("record_type").count().collect()}
    assert counts == {"1T": 1, "A": 4, "F": 1}


@pytest.mark.parametrize(("codes", "raw", "column"), [
    (operator_registry.STATUS_CODES, 41, "p5_status"),
    (operator_registry.ORGANIZATION_CODES, 44, "organization_type"),
])
def test_every_code_is_mapped(spark, codes, raw, column):
    lines = [put(" " * 350, (0, "A "), (2, f"{i:06d}"), (raw, c)) for i, c in enumerate(codes)]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {r[0] for r in operator_registry.operator_registry(df, RUN).select(column).collect()}
    assert got == set(codes.values())


# -- permits, injection, hearings, inspections -----------------------------------------------------


def test_permits(spark, tmp_path):
    base = put(" " * 108, (0, "08"), (2, "123456"), (8, "BIG LEASE"), (48, "01234"), (94, "000777"), (100, "003"), (103, "12345"))
    lines = [base + "x" * 600, put(base, (100, " " * 8)), "too short", base[:60] + "   ", " " * 49 + "e"]
    with gzip.open(tmp_path / "permit.gz", "wt") as f:
        f.write("\n".join(lines))
    rows = permits.drilling_permits(read_numbered_lines(spark, str(tmp_path)).orderBy("line_number_in_file"), RUN).collect()
    assert [r.api10 for r in rows] == ["4200312345", "4200000000", "4200000000", "4200000000"]
    assert [r.api10_valid for r in rows] == [True, False, False, False]
    assert (rows[0].lease_name, rows[0].total_depth, rows[0].operator_number, len(rows[0].raw_line)) == ("BIG LEASE", "01234", "000777", 510)
    assert rows[0].raw_line == lines[0].rstrip()[:510] and rows[2].raw_line == lines[3].rstrip()


def injection_line(kind, county, unique):
    return put(" " * 40, (0, kind), (2, "08"), (4, "123456"), (10, "I"), (28, county), (31, unique), (38, "zz"))


def test_injection(spark):
    make = lambda lines: spark.createDataFrame([(x,) for x in lines], "value string")
    lines = [injection_line("01", "003", "00001"), injection_line("01", "000", "00001"), injection_line("02", "003", "00000"),
             injection_line("02", "3  ", "1    "), "short", "123456789 "]
    raw = injection.injection_raw(make(lines), RUN)
    got = [(r.record_type, r.lease_number, r.api10) for r in raw.collect()]
    assert sorted(got, key=repr) == sorted([("01", "123456", "4200300001"), ("01", "123456", None), ("02", "123456", None), ("02", "123456", "4200300001")], key=repr)
    assert injection.injection_wells(raw).count() == 2
    without = injection.injection_raw(make(lines[2:]), RUN)
    assert injection.injection_wells(without).count() == 2
    assert injection.injection_wells(injection.injection_raw(make(["x"]), RUN)).count() == 0


def test_hearings(spark, tmp_path):
    docket = put(" " * 88, (0, "01"), (7, "12345"), (12, "OG "), (15, "A"), (80, "20210101"))
    lines = [docket, "0", "02" + "PARTY".ljust(40) + "000777", "  ", "03 other" + "y" * 300, "02P"]
    with gzip.open(tmp_path / "h.gz", "wt") as f:
        f.write("\n".join(lines) + "\n")
    rows = hearings.hearings(read_numbered_lines(spark, str(tmp_path)), RUN).orderBy("line_number_in_file").collect()
    assert [r.line_number_in_file for r in rows] == [0, 2, 4, 5]
    assert (rows[0].docket_number, rows[0].case_type, rows[0].status_code, rows[0].filing_date, rows[0].party_name) == ("12345", "OG", "A", "20210101", None)
    assert (rows[1].party_name, rows[1].operator_number, rows[1].docket_number) == ("PARTY", "000777", None)
    assert len(rows[2].raw_line) == 200 and rows[2].record_type == "03" and rows[2].party_name is None
    assert (rows[3].party_name, rows[3].operator_number) == ("P", "")
    assert {r.subject_text for r in rows} == {None} and len(rows[0]) == 12


def test_inspections_without_api_column(spark):
    df = spark.createDataFrame([("x",)], "operator_name string")
    assert inspections.inspections(df, RUN).columns == ["operator_name", "scraped_at"]


# -- wells -----------------------------------------------------------------------------------------

LAYOUT = (("APINUM", 8), ("LEASE_NAME", 8), ("GAS_RRCID", 6), ("OPERATOR", 6), ("COMPLETION", 8), ("TOTAL_DEPT", 6))


def test_wells_end_to_end(spark, tmp_path):
    files = {
        "api003.dbf": [("00300001", "L1", "r1", "A", "20000101", "100"), ("00300001", "L1", "r1", "B", "20100101", "200"),
                       ("00300001", "L2", "r2", "B", "20050505", "300"), ("", "L9", "r9", "Z", "20000101", "")],
        "api001.dbf": [("00300001", "L3", "r3", "A", "abc", "999"), ("00100001", "", "", "", "", ""), ("00100001", "M", "", "Q", "19990101", "7")],
    }
    for name, rows in files.items():
        body = b"".join(b" " + b"".join(v.encode().ljust(w) for v, (_, w) in zip(r, LAYOUT, strict=True)) for r in rows)
        (tmp_path / name).write_bytes(dbase_header(LAYOUT, len(rows)) + body)
    raw = wells.well_records_raw(read_dbase(spark, str(tmp_path)), RUN)
    assert raw.count() == 7
    master = {r.api10: r for r in wells.well_master(raw).collect()}
    assert set(master) == {"4200300001", "4200100001", None}
    assert master["4200300001"].total_dept == "999" and master["4200300001"].source_file == "api001.dbf"
    done = wells.well_completions(raw)
    got = {(r.api10, r.gas_rrcid, r.operator) for r in done.collect()}
    assert got == {("4200300001", "r3", "A"), ("4200100001", None, None), ("4200300001", "r1", "A"), ("4200300001", "r2", "B"), (None, "r9", "Z")}
    history = wells.operator_history(done, RUN).where("api10 = '4200300001'").orderBy("effective_date").collect()
    # the bad date sorts first: A from "abc", still A in 2000, B in 2005
    assert [(h.operator_name, h.effective_date, h.termination_date, h.is_current, h.lease_number) for h in history] == [
        ("B", "20050505", None, True, "L2"), ("A", "abc", "20050505", False, "L3"),
    ]
    assert [f.name for f in wells.HISTORY_SCHEMA] == wells.operator_history(done, RUN).columns
    lease = {(r.api10, r.lease_name): r for r in wells.well_lease_crosswalk(done, RUN).collect()}
    # the bad date sorts last: L3 is the current lease
    assert lease["4200300001", "L3"].is_current and lease["4200300001", "L3"].effective_date is None
    assert (lease["4200300001", "L2"].termination_date, lease["4200300001", "L1"].n_completions) == ("2005-05-05", 1)
    assert len(lease) == 3  # the well without lease (first row wins) and the row without well are out


# -- oil tape ----------------------------------------------------------------------------------------


def pack(n):
    return bytes.fromhex(f"{abs(n):09d}" + ("D" if n < 0 else "C"))


def record(*parts):
    raw = b"".join(p.encode("cp037") if isinstance(p, str) else p for p in parts)
    return raw.ljust(102, b"\x40")


def root(district, lease, n=5):
    return record("01O", district, lease, pack(n), pack(-n), pack(0), pack(1))


def cycle(key, balance=-12, allowable=345):
    return record("02", key, *[pack(k) for k in (1, 2, 3, 4, allowable, 6)], "1998010219980304", pack(balance), *[pack(9)] * 4)


def made(oil, gas, flag="N", lift=0):
    return record("03", flag, "   ", pack(oil), pack(gas), pack(lift), "0010002", "20230401", "Y")


def tape_by_loop(records):
    lease, period = ("", "", ""), ("", 0, 0)
    for raw in records:
        text = raw.decode("cp037")
        if text[:2] == "01":
            lease = (text[3:5], text[5:11], text[2])
        elif text[:2] == "02":
            number = lambda b: int(b.hex()[:9]) * (-1 if b.hex()[9] in "bd" else 1)
            period = (text[2:6], number(raw[52:57]), number(raw[26:31]))
        elif text[:2] == "03":
            yield (*lease, period[0], raw, *period[1:])


def tape_file(tmp_path, records, tail=b""):
    (tmp_path / "PDF100.ebc").write_bytes(b"".join(records) + tail)
    return str(tmp_path)


@pytest.mark.parametrize("split", [102, 102 * 7, 1 << 20])
def test_tape_context_does_not_depend_on_splits(spark, tmp_path, split):
    rng = random.Random(11)
    records = [made(1, 2)]  # before any parent
    for i in range(30 if split == 102 else 300):
        records += rng.choice(
            [[root(f"{i % 14:02d}", f"{i:06d}")], [cycle(f"23{1 + i % 12:02d}", balance=-i, allowable=i)],
             [made(i, i * 2, rng.choice("NY"), -i)] * rng.randrange(4), [record("05", "01", pack(7))], [record("22", "remark")]]
        )
    folder = tape_file(tmp_path, records, b"\x40" * 50)
    read = production.read_tape_with_parents(spark, folder, types=("03",), split_bytes=split)
    got = production.production_monthly_undated(read)
    want = [
        (d, n, o, k, *[int(r.hex()[2 * a : 2 * a + 9]) * (-1 if r.hex()[2 * a + 9] == "d" else 1) for a in (6, 11, 16)],
         r.decode("cp037")[2], "2023", "04", "01", "Y", balance, allowable)
        for d, n, o, k, r, balance, allowable in tape_by_loop(records)
    ]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    if split > 102:
        tape = production.read_tape(spark, folder)
        for ranges in (7, 60):
            again = production.production_monthly_undated(production.with_parents(tape, ranges))
            assert sorted(map(tuple, again.collect())) == sorted(want)


def test_tape_published_spot_checks(spark, tmp_path):
    records = []
    for district, lease, year, month, oil, gas in SPOT_CHECKS:
        records += [root(district, lease), cycle(year[2:] + month), made(oil, gas)]
    tape = production.read_tape_with_parents(spark, tape_file(tmp_path, records))
    monthly = production.production_monthly(tape, RUN)
    got = {(r.district, r.lease_number, r.prod_year, r.prod_month, r.oil_production_bbl, r.casinghead_gas_mcf) for r in monthly.collect()}
    assert got == set(SPOT_CHECKS)
    assert monthly.columns == [*production.MONTHLY_COLUMNS, "prod_year", "prod_month", "scraped_at"]
    total = monthly.groupBy("district", "prod_year").agg(F.sum("oil_production_bbl").alias("v")).where("district = '10'").first()
    assert (total.prod_year, total.v) == ("2022", 517391)


def test_tape_raw_and_segments(spark, tmp_path):
    records = [made(1, 1), root("08", "000123", 77), cycle("2304"), record("05", "07", pack(-31)), record("22", "free text")]
    folder = tape_file(tmp_path, records)
    raw = production.production_records_raw(production.read_tape_with_parents(spark, folder), RUN).orderBy("record_index").collect()
    assert [(r.record_index, r.record_type, r.district, r.lease_number) for r in raw] == [
        (0, "03", "", ""), (1, "01", "08", "000123"), (2, "02", "08", "000123"), (3, "05", "08", "000123"), (4, "22", "08", "000123"),
    ]
    assert [r.raw_hex for r in raw] == [x[:40].hex() for x in records]
    tape = production.read_tape(spark, folder)
    assert production.disposition_records(tape, RUN).first()[1:3] == ("07", -31)
    one = production.segment_records(tape, "01").first().asDict()
    assert (one["movable_balance"], one["beginning_oil_status"], one["oil_oldest_eom_balance"]) == (77, -77, 1)
    two = production.segment_records(tape, "02").first().asDict()
    assert (two["oil_allowable_cycle_bbls"], two["csh_limit_cycle_mcf"], two["oil_allow_effect_year"], two["oil_allow_issue_day"]) == (345, 6, "1998", "04")
    three = production.segment_records(tape, "03").first().asDict()
    assert (three["batch_number"], three["item_number"], three["filed_by_edi"]) == ("001", "0002", "Y")


def test_tape_without_cycle_fails_as_a_whole(spark, tmp_path):
    tape = production.read_tape_with_parents(spark, tape_file(tmp_path, [root("08", "000001"), made(1, 1)]))
    assert production.production_monthly_undated(tape).first().rpt_cycle_key == ""
    with pytest.raises(Exception, match="cycle key"):
        production.production_monthly(tape, RUN).collect()


def test_corrections(spark):
    names = "district string, lease_number string, rpt_cycle_key string, posting_year string, posting_month string, posting_day string, corrected_report_flag string, oil bigint"
    old = spark.createDataFrame([("08", "1", "2303", "2023", "05", "01", "N", 10), ("08", "2", "2303", "2023", "05", "01", "N", 20)], names)
    new = spark.createDataFrame([("08", "1", "2303", "2023", "05", "01", "Y", 11), ("08", "2", "2303", "2023", "04", "30", "Y", 21), ("09", "1", "2303", "2023", "01", "01", "N", 1)], names)
    got = {(r.district, r.lease_number): r.oil for r in corrections.apply_corrections(old, new).collect()}
    assert got == {("08", "1"): 11, ("08", "2"): 20, ("09", "1"): 1}


def _line_table(spark, folder, n_orders):
    lines = spark.range(n_orders).selectExpr(
        "id + 1 AS l_orderkey", "id % 50 AS l_partkey", "id % 7 AS l_suppkey", "1 AS l_linenumber", "cast(id % 9 AS double) AS l_quantity",
        "cast(id AS double) AS l_extendedprice", "IF(id % 3 = 0, 'A', 'R') AS l_returnflag", "date_add(date'1995-01-01', cast(id % 700 AS int)) AS l_shipdate",
    )
    lines.write.parquet(f"{folder}/lineitem.parquet")


def test_tape_files_grow_with_the_lines(spark, tmp_path, monkeypatch):
    from registrylake.sources.fixed_records import list_files
    from registrylake.workloads import files

    monkeypatch.setattr(files, "RECORDS_PER_FILE", 400, raising=False)
    sizes = {}
    for n in (100, 3000):
        _line_table(spark, f"{tmp_path}/{n}", n)
        written = [size for _, size in list_files(files._tape_folder(spark, f"{tmp_path}/{n}"))]
        sizes[n] = [size // production.RECORD_LENGTH for size in written]
        assert sum(sizes[n]) == 3 * n + (n + 2) // 3
    assert len(sizes[100]) == 6 and len(sizes[3000]) == 30 and max(sizes[3000]) <= 800
    got = files.oil_tape_monthly(spark, f"{tmp_path}/3000")
    assert got.where("cast(lease_number AS int) * 3 = oil_allowable_cycle_bbls AND rpt_cycle_key = right(concat(posting_year, posting_month), 4)").count() == 3000


def test_table_ranges_grow_with_the_tape(spark, tmp_path, monkeypatch):
    from registrylake.workloads import files

    _line_table(spark, tmp_path, 3000)
    asked = []
    carried = production.with_parents
    monkeypatch.setattr(production, "with_parents", lambda tape, ranges=None: asked.append(ranges) or carried(tape, ranges))
    assert files.oil_tape_table_monthly(spark, str(tmp_path)).count() == 3000
    monkeypatch.setattr(files, "SPLIT_BYTES", 10_200)
    assert files.oil_tape_table_monthly(spark, str(tmp_path)).count() == 3000
    assert asked == [40, 100]


def _disk_used(folder):
    import os

    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if f.endswith((".ebc", ".zst")))


@pytest.mark.parametrize("name", ["oil_tape_monthly", "oil_tape_roots", "oil_tape_table_monthly", "oil_tape_by_district_year", "oil_tape_raw", "oil_tape_disposition"])
def test_tape_queries_keep_a_small_tape(spark, tmp_path, monkeypatch, name):
    from registrylake.workloads import files

    _line_table(spark, tmp_path, 3000)
    written = []
    write = files.write_binary_files
    monkeypatch.setattr(files, "write_binary_files", lambda *args: written.append(write(*args)) or written[-1])
    assert getattr(files, name)(spark, str(tmp_path)).count() > 0
    assert _disk_used(written[0].removeprefix("file:")) < 102 * 10_000 / 4  # 10,000 records


def test_tape_is_one_shuffle_of_the_lines(spark, tmp_path):
    from registrylake.sources.fixed_records import list_files
    from registrylake.workloads import files

    day = "date'1995-0{}-03'"
    rows = [(7, 1, 1, 1, "A", 2), (7, 1, 1, 1, "A", 2), (3, 5, 2, 2, "R", 2), (3, 4, 2, 1, "A", 1), (3, 4, 3, 1, "A", 1), (3, 5, 2, 9, "N", 1), (9, 1, 1, 1, None, 1)]
    lines = " UNION ALL ".join(
        f"SELECT {o}L l_orderkey, {p}L l_partkey, {s}L l_suppkey, {n} l_linenumber, 8.0D l_quantity, 100.4D l_extendedprice, "
        f"{f'{flag!r}' if flag else 'CAST(NULL AS STRING)'} l_returnflag, {day.format(month)} l_shipdate" for o, p, s, n, flag, month in rows
    )
    spark.sql(lines).repartition(4, "l_suppkey").write.parquet(f"{tmp_path}/lineitem.parquet")
    plain = [open(p.removeprefix("file:"), "rb").read() for p, _ in list_files(files._tape_folder(spark, str(tmp_path)))]
    tape = b"".join(plain)
    records = [tape[i : i + 102].decode("cp037") for i in range(0, len(tape), 102)]
    assert [r[:2] + (r[2:6] if r[:2] == "02" else r[3:11] if r[:2] == "01" else "") for r in records] == [
        "0100000003", "029501", "03", "05", "03", "05", "03", "029502", "03",
        "0100000007", "029502", "03", "03", "05", "05", "0100000009", "029501", "03",
    ]
    packed = files._packed_tape(spark, str(tmp_path))
    assert sorted(bytes(r.rec) for r in production.read_tape(spark, packed).collect()) == sorted(tape[i : i + 102] for i in range(0, len(tape), 102))
    dealt = files._tape_records(files._tape_lines(spark, str(tmp_path)).repartitionByRange(6, "l_orderkey"))
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning(l_orderkey" in plan
