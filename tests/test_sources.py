"""Sources against small files."""

import gzip
import hashlib
import json
import random
import struct

import numpy as np
import pandas as pd
import pytest
import zstandard

from registrylake.sources import dbase, delimited, fixed_records, landing, text_lines
from registrylake.workloads.files import dbase_header


def test_lines_match_python_reading(spark, tmp_path):
    raw = b"first\r\nsec\xe9ond\rthird \xc3\xa9\n\n  x\x85y\nlast"
    (tmp_path / "a.txt").write_bytes(raw)
    with open(tmp_path / "a.txt", encoding="ascii", errors="replace") as f:
        want = [line.rstrip("\n") for line in f]
    got = text_lines.read_numbered_lines(spark, str(tmp_path / "a.txt")).orderBy("line_number_in_file").collect()
    assert [r.value for r in got] == want
    assert [r.line_number_in_file for r in got] == list(range(len(want)))


def test_line_numbers_over_many_splits(spark, tmp_path):
    lines = {f: [f"{f}-{i:05d}-" + "x" * (i % 37) for i in range(4000)] for f in ("a.txt", "b.txt")}
    for name, rows in lines.items():
        (tmp_path / name).write_text("\n".join(rows) + "\n")
    with gzip.open(tmp_path / "c.txt.gz", "wt") as f:
        f.write("\n".join(f"c-{i}" for i in range(100)))
    lines["c.txt.gz"] = [f"c-{i}" for i in range(100)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        got = text_lines.read_numbered_lines(spark, str(tmp_path))
        assert got.rdd.getNumPartitions() > 10
        rows = got.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r.source_file, r.line_number_in_file, r.value) for r in rows) == sorted(
        (f, i, v) for f, values in lines.items() for i, v in enumerate(values)
    )


@pytest.mark.parametrize("split", [35, 1 << 20])
def test_fixed_records_do_not_depend_on_splits(spark, tmp_path, split):
    data = bytes(range(256)) * 3
    (tmp_path / "t.dat").write_bytes(data + b"tail")  # 772 bytes: 77 records of 10, 2 bytes left over
    (tmp_path / "u.dat").write_bytes(b"0123456789")
    got = fixed_records.read_fixed_records(spark, str(tmp_path), 10, "*.dat", split).collect()
    whole = data + b"tail"
    want = {("t.dat", i, whole[i * 10 : i * 10 + 10]) for i in range(77)} | {("u.dat", 0, b"0123456789")}
    assert {(r.source_file, r.record_index, bytes(r.rec)) for r in got} == want and len(got) == 78


@pytest.mark.parametrize("split", [36, 400, 1 << 20])
def test_contexts_cross_ranges(spark, tmp_path, split):
    rng = np.random.default_rng(3)
    files = {}
    for name in ("a.bin", "b.bin", "none.bin"):
        kinds = rng.choice(list("RCPPPPPPPPP"), 500) if name != "none.bin" else ["P"] * 30
        files[name] = [f"{k}{i:03d}".encode() for i, k in enumerate(kinds)]
        (tmp_path / name).write_bytes(b"".join(files[name]))
    contexts = [fixed_records.Context("root", b"R".hex(), 1, 3), fixed_records.Context("cycle", b"C".hex(), 0, 4)]
    specs = fixed_records.whole_records(str(tmp_path), 4)
    got = fixed_records.read_with_contexts(spark, specs, contexts, [b"P".hex()], split).collect()
    want = {}
    for name, records in files.items():
        root = cycle = None
        for i, r in enumerate(records):
            root, cycle = (r[1:] if r[:1] == b"R" else root), (r if r[:1] == b"C" else cycle)
            if r[:1] == b"P":
                want[name, i] = (r, root, cycle)
    plain = lambda x: None if x is None else bytes(x)
    assert {(r.source_file, r.record_index): (bytes(r.rec), plain(r.root), plain(r.cycle)) for r in got} == want


def test_batches_inside_a_range_carry_on(spark, tmp_path, monkeypatch):
    records = [b"R1", b"P0"] + [b"P%d" % (i % 10) for i in range(50)] + [b"R2", b"P9"]
    (tmp_path / "x.bin").write_bytes(b"".join(records))
    reader = fixed_records.FixedRecordReader(
        {"files": json.dumps([[str(tmp_path / "x.bin"), 0, 2, len(records)]]), "contexts": json.dumps([["root", b"R".hex(), 0, 2]])}
    )
    monkeypatch.setattr(fixed_records, "BATCH_BYTES", 6)
    batches = [b for p in reader.partitions() for b in reader.read(p)]
    assert len(batches) == 18
    assert [x for b in batches for x in b.column("root").to_pylist()] == [b"R1"] * 52 + [b"R2"] * 2


FIELDS = (("APINUM", 8), ("LEASE_NAME", 6))


def dbf(path, layout, rows, n=None, cut=0):
    body = b"".join(flag + b"".join(v.encode("latin-1").ljust(w) for v, (_, w) in zip(cells, layout, strict=True)) for flag, *cells in rows)
    data = dbase_header(layout, len(rows) if n is None else n) + body
    path.write_bytes(data[: len(data) - cut] if cut else data)


def test_dbase(spark, tmp_path):
    dbf(tmp_path / "api001.dbf", FIELDS, [(b" ", "00100001", "É"), (b"*", "00100002", "gone"), (b" ", "", "L\xa0")])
    dbf(tmp_path / "api002.dbf", (*FIELDS, ("OPERATOR", 4)), [(b" ", "00200001", "", "ACME"), (b" ", "00200002", "x", "cut")], cut=3)
    dbf(tmp_path / "api003.dbf", FIELDS, [(b" ", "1", "a"), (b" ", "2", "b")], n=1)
    (tmp_path / "api004.dbf").write_bytes(b"\x03short")
    (tmp_path / "api005.dbf").write_bytes(struct.pack("<B3BIHH20x", 3, 0, 1, 1, 1, 65, 9))
    (tmp_path / "other.dbf").write_bytes(b"")
    df = dbase.read_dbase(spark, str(tmp_path))
    assert df.columns == ["apinum", "lease_name", "source_file", "ordinal", "operator"]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(
        [
            ("00100001", "É", "api001.dbf", 0, None),
            (None, "L", "api001.dbf", 2, None),
            ("00200001", None, "api002.dbf", 0, "ACME"),
            ("1", "a", "api003.dbf", 0, None),
        ],
        key=repr,
    )
    assert [r.path.rsplit("/", 1)[-1] for r in dbase.bad_files(spark, str(tmp_path)).collect()] == ["api004.dbf", "api005.dbf"]
    with pytest.raises(FileNotFoundError):
        dbase.read_dbase(spark, str(tmp_path), "none*.dbf")


def test_delimited_against_pandas(spark, tmp_path):
    text = (
        "Operator Name} API No}Remarks\n"
        "ACME}12}fine\n"
        "B}}NA\n"
        'C}"a}b"}"say ""x"""\n'
        "D}1}2}3\n"
        "E}5\n"
        "\n"
        "F}nan}null\n"
        "G} 7 }caf\xe9\n"
        "H}1}2}\n"
        "None}N/A}  \n"
    )
    path = tmp_path / "i.txt"
    path.write_bytes(text.encode("latin-1"))
    want = pd.read_csv(path, sep="}", dtype=str, encoding="ascii", encoding_errors="replace", on_bad_lines="skip")
    want = [tuple(None if pd.isna(v) else v for v in row) for row in want.itertuples(index=False)]
    df = delimited.read_delimited(spark, str(path))
    assert df.columns == ["operator_name", "api_no", "remarks"]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)
    assert delimited.overlong_rows(spark, str(path)).first().n_dropped == 2


def test_newest_snapshot_and_integrity(spark, tmp_path):
    good, bad = tmp_path / "good", tmp_path / "bad"
    for folder in (good, bad):
        folder.mkdir()
        for name in ("p_20260101.txt", "p_20260512.txt", "p_20260601.dat"):
            (folder / name).write_bytes(name.encode())
    patterns = ("*.txt", "*.dat")
    assert landing.newest_snapshot(spark, str(good), patterns).endswith("/good/p_20260512.txt")
    assert landing.newest_snapshot(spark, str(good), ("*.gz", "*.dat")).endswith("p_20260601.dat")
    assert landing.newest_snapshot(spark, str(good), ("*.gz",)) is None
    digest = hashlib.sha256(b"p_20260512.txt").hexdigest()
    (bad / landing.SIDECAR).write_text(json.dumps({"filename": "p_20260512.txt", "sha256": digest}, indent=2))
    got = {r.path.rsplit("/", 1)[-1]: (r.status, r.ok) for r in landing.verify_sources(spark, str(bad)).collect()}
    assert got == {"p_20260101.txt": ("mismatch", False), "p_20260512.txt": ("verified", True), "p_20260601.dat": ("mismatch", False)}
    assert {r.status for r in landing.verify_sources(spark, str(good)).collect()} == {"no_sidecar"}
    (bad / landing.SIDECAR).write_text(json.dumps({"filename": "x"}))
    assert {(r.status, r.ok) for r in landing.verify_sources(spark, str(bad)).collect()} == {("no_expected_digest", True)}


def test_delimited_trailing_separators(spark, tmp_path):
    """Empty extra fields count, quoted separators do not."""
    path = tmp_path / "t.txt"
    path.write_text('a}b\n1}\n2}}\n3}}}\n"4}4}4"}x\n5\n6}"}"\n')
    got = sorted(map(tuple, delimited.read_delimited(spark, str(path)).collect()))
    assert got == sorted([("1", None), ("4}4}4", "x"), ("5", None), ("6", "}")], key=repr)
    assert delimited.overlong_rows(spark, str(path)).first().n_dropped == 2


def test_first_delimited_rows_in_file_order(spark, tmp_path):
    path = tmp_path / "big.txt"
    path.write_text("id}v\n" + "".join(f"{i}}}{'x' * (i % 50)}\n" if i % 7 else f"{i}}}a}}b\n" for i in range(3000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        got = [int(r.id) for r in delimited.read_delimited(spark, str(path), first=1500).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(got) == [i for i in range(3000) if i % 7][:1500]


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_quoted_breaks_over_splits(spark, tmp_path, small_splits):
    """Fields longer than a split, so that splits start and end inside quotes, against a reading of the whole file."""
    rng = np.random.default_rng(5)
    want = []
    for name in ("a.txt", "b.txt"):
        rows = ["id}note}more\n"]
        for i in range(150):
            kind = rng.integers(0, 6)
            note = [
                "plain", '"one\ntwo"', '"' + 'long "" text}\n' * int(rng.integers(1, 200)) + '"', 'in"side', '"\r\n\n"', '""',
            ][kind]
            rows.append(f"{i}}}{note}}}{'x' if i % 3 else chr(34) + 'y' + chr(10) + chr(34)}\n" + ("\n" if kind == 0 else ""))
        path = tmp_path / name
        path.write_bytes("".join(rows).encode())
        frame = pd.read_csv(path, sep="}", dtype=str, encoding="ascii", lineterminator="\n")
        want += [tuple(None if pd.isna(v) else v for v in row) for row in frame.itertuples(index=False)]
    got = delimited.read_delimited(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_open_quote_is_an_error(spark, tmp_path):
    (tmp_path / "a.txt").write_text('a}b\n1}"never closed\n2}3\n')
    with pytest.raises(Exception, match="never closed"):
        delimited.read_delimited(spark, str(tmp_path)).collect()


def test_headers_are_united(spark, tmp_path):
    (tmp_path / "a.txt").write_text("\n id}B}b\n1}2}3\n1}2}3}4\n")
    (tmp_path / "b.txt").write_text('"C}c"}ID\n5}6\n5}6}7\n')
    (tmp_path / "empty.txt").write_text("")
    got = delimited.read_delimited(spark, str(tmp_path))
    assert got.columns == ["id", "b", "b.1", "c}c"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([("1", "2", "3", None), ("6", None, None, "5")], key=repr)
    assert delimited.overlong_rows(spark, str(tmp_path)).first().n_dropped == 2
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "x.txt").write_text("\n")
    assert delimited.read_delimited(spark, str(tmp_path / "none")).collect() == []


def test_a_split_without_an_index_is_an_error(spark):
    lines = spark.createDataFrame([("x", "f", 0, 5)], "value string, _path string, _start bigint, _id bigint")
    index = text_lines.split_index(lines)
    assert text_lines.on_split(lines, index).first().line_number_in_file == 0
    with pytest.raises(Exception, match="no index"):
        text_lines.on_split(lines, index.where("_path = 'g'")).collect()


def test_lines_are_read_once(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\ny\n")
    plan = text_lines.read_numbered_lines(spark, str(tmp_path))._jdf.queryExecution().toString()
    assert "FileScan text" not in plan and "FileScan parquet" in plan


def test_packed_files_are_read_from_any_place(tmp_path):
    import io

    import pyarrow as pa

    from registrylake.sources import packed

    rng = random.Random(3)
    content = bytes(rng.randrange(4) for _ in range(5003))
    with pa.OSFile(str(tmp_path / "a.zst"), "wb") as f:
        out = packed.PackedOutput(f, piece_bytes=100)
        for start in range(0, len(content), 37):
            out.write(content[start : start + 37])
        out.close()
    with pa.OSFile(str(tmp_path / "a.zst"), "rb") as f:
        got = packed.opened(f, "a.zst")
        assert got.size == len(content)
        for at, n in [(0, 5003), (99, 2), (100, 100), (4990, 50), (5003, 1), (250, 0)]:
            got.seek(at)
            assert got.read(n) == content[at : at + n]
    whole = (tmp_path / "a.zst").read_bytes()
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(whole), read_across_frames=True).read() == content
    for cut, message in [(whole[:-1], "no table of frames"), (b"", "no table of frames"), (whole[-200:], "shorter")]:
        with pytest.raises((ValueError, OSError), match=message):
            packed.PackedInput(pa.BufferReader(cut), "b.zst")


def test_records_of_packed_files(spark, tmp_path):
    import pyarrow as pa

    from registrylake.sources import packed

    records = [b"P%03d" % i if i % 5 == 2 else b"c%03d" % i for i in range(300)]
    with pa.OSFile(str(tmp_path / "t.bin.zst"), "wb") as f:
        out = packed.PackedOutput(f, piece_bytes=50)
        out.write(b"".join(records) + b"??")
        out.close()
    with pa.OSFile(str(tmp_path / "empty.bin.zst"), "wb") as f:
        packed.PackedOutput(f).close()
    specs = fixed_records.whole_records(str(tmp_path), 4)
    assert [s.n_records for s in specs] == [0, 300]
    contexts = [fixed_records.Context("p", b"P".hex(), 0, 4)]
    for split in (12, 72, 1 << 20):
        got = fixed_records.read_with_contexts(spark, specs, contexts, [b"c".hex()], split).collect()
        want = [(i, r, next((x for x in reversed(records[: i + 1]) if x[:1] == b"P"), None)) for i, r in enumerate(records) if r[:1] == b"c"]
        assert sorted((g.record_index, bytes(g.rec), g.p and bytes(g.p)) for g in got) == want
