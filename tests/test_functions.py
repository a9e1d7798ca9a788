"""Scalar functions against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from registrylake.functions import dates, ebcdic, filters, keys, layout, packed, text


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def results(df, c):
    return [r[0] for r in df.orderBy("i").select(c).collect()]


def test_ebcdic_is_exact_for_every_byte(spark):
    every = bytes(range(256))
    df = column(spark, [every], "binary")
    assert results(df, ebcdic.decode_text(F.col("v"))) == [every.decode("cp037")]
    assert bytes(results(df, ebcdic.encode_text(ebcdic.decode_text(F.col("v"))))[0]) == every


def unpack(raw):
    total = 0
    nibbles = [n for b in raw for n in (b >> 4, b & 15)]
    for n in nibbles[:-1]:
        total = total * 10 + n
    return -total if nibbles and nibbles[-1] in (11, 13) else total


def pack(n):
    return bytes.fromhex(f"{abs(n):09d}" + ("D" if n < 0 else "C"))


def test_packed_numbers_clean_and_dirty(spark):
    rng = random.Random(7)
    raws = [pack(n) for n in (0, 1, -1, 999_999_999, -999_999_999, 859_389)]
    raws += [bytes.fromhex("000000123" + s) for s in "0123456789ABCDEF"]
    raws += [b"\x40" * 5, b"\xff" * 5, b"\x00" * 5, b"", b"\x1d", b"\x12\x3b"]
    raws += [bytes(rng.randrange(256) for _ in range(5)) for _ in range(500)]
    df = column(spark, raws, "binary")
    assert results(df, packed.packed_to_long(F.col("v"))) == [unpack(r) for r in raws]
    valid = [all(n < 10 for n in [x for b in r for x in (b >> 4, b & 15)][:-1]) and r != b"" and r[-1] & 15 > 9 for r in raws]
    assert results(df, packed.is_valid_packed(F.col("v"))) == valid


def test_packed_round_trip(spark):
    values = [0, 1, -1, 999_999_999, -999_999_999, 42]
    df = column(spark, values, "bigint")
    assert results(df, packed.packed_to_long(packed.long_to_packed(F.col("v")))) == values


def test_strip_matches_python(spark):
    values = [" a ", "\t\x0b\x0ca\x1c\x1d\x1e\x1f\r\n", "", "   ", " a b ", "\xa0a\x85"]
    df = column(spark, values)
    assert results(df, text.strip(F.col("v")))[:5] == [v.strip() for v in values[:5]]
    assert results(df, text.strip(F.col("v"), text.LATIN_SPACE)) == [v.strip() for v in values]
    assert results(df, text.rstrip(F.col("v")))[:5] == [v.rstrip() for v in values[:5]]


def test_compact_and_numeric_dates(spark):
    values = ["20210531", " 20210531 ", "", "00000000", "2021", "ABCDEFGH", "20219999", None]
    df = column(spark, values)
    assert results(df, dates.compact_date(F.col("v"))) == [
        "2021-05-31", "2021-05-31", None, None, None, "ABCD-EF-GH", "2021-99-99", None,
    ]
    typed = [str(x) if x else None for x in results(df, dates.compact_date_typed(F.col("v")))]
    assert typed == ["2021-05-31", "2021-05-31", None, None, None, None, None, None]
    numbers = column(spark, [20210531.0, 0.0, -20210531.0, 123.0, None, 202105310.0], "double")
    assert results(numbers, dates.numeric_date(F.col("v"))) == ["2021-05-31", None, None, None, None, None]


def test_numeric_or_null(spark):
    values = ["20210531", " 7 ", "1e3", "1d", "NaN", "inf", "abc", "", None, "-5", ".5", "0x10", "+3."]
    df = column(spark, values)
    assert results(df, text.numeric_or_null(F.col("v"))) == [
        20210531.0, 7.0, 1000.0, None, None, None, None, None, None, -5.0, 0.5, None, 3.0,
    ]


@pytest.mark.parametrize(
    ("values", "expected"),
    [
        (["2304", "9912", "1401"], [("2023", "04"), ("1999", "12"), ("2014", "01")]),  # year first
        (["0423", "1299", "0149"], [("2023", "04"), ("1999", "12"), ("2049", "01")]),  # month first
        (["4901", "5001", "1301"], [("2049", "01"), ("1950", "01"), ("2013", "01")]),  # pivot
        (["1301", "1201"], [("2001", "13"), ("2001", "12")]),  # exactly half is month first
    ],
)
def test_cycle_key_format_is_detected(spark, values, expected):
    df = dates.split_cycle_key(column(spark, values), "v").orderBy("i")
    assert [(r.prod_year, r.prod_month) for r in df.collect()] == expected


def test_cycle_key_without_number_fails(spark):
    with pytest.raises(Exception, match="cycle key"):
        dates.split_cycle_key(column(spark, ["2304", "", "xx01"]), "v").collect()


def test_keys(spark):
    parts = [("", ""), ("1", "22"), ("000", "00001"), ("123", "00000"), ("123", "45678")]
    df = spark.createDataFrame(parts, "c string, u string").coalesce(1)
    rows = df.select(
        keys.permit_key(F.col("c"), F.col("u")).alias("p"),
        keys.permit_key_valid(F.col("c"), F.col("u")).alias("v"),
        keys.injection_key(F.col("c"), F.col("u")).alias("i"),
    ).collect()
    assert [r.p for r in rows] == ["42" + c.zfill(3) + u.zfill(5) for c, u in parts]
    assert [r.v for r in rows] == [False, True, False, False, True]
    assert [r.i for r in rows] == [None, "4200100022", None, None, "4212345678"]
    api = [None, "", "  ", "1", "12345678", "1234567890", " 77 ", "-5"]
    want = ["42" + x.strip().zfill(8) if x and x.strip() else None for x in api]
    assert results(column(spark, api), keys.inspection_key(F.col("v"))) == want
    assert results(column(spark, [None, "00112345"]), keys.registry_key(F.col("v"))) == [None, "4200112345"]


def test_codes_address_and_display(spark):
    df = column(spark, ["A", "Z", "", None])
    assert results(df, text.map_codes(F.col("v"), {"A": "active"})) == ["active", "Z", "", None]
    rows = [("1 MAIN", "", "AUSTIN", "TX", "78701"), ("", "", "", "", ""), ("", "", "", "TX", ""), ("", "B", "", "", "787")]
    df = spark.createDataFrame(rows, "a string, b string, c string, s string, z string").coalesce(1)
    got = [r[0] for r in df.select(text.join_address([F.col("a"), F.col("b"), F.col("c")], F.col("s"), F.col("z"))).collect()]
    assert got == ["1 MAIN, AUSTIN, TX 78701", None, "TX", "B, 787"]
    df = column(spark, ["1,234", " - ", "", "7"])
    assert results(df, text.comma_integer(F.col("v"))) == [1234, 0, 0, 7]
    df = column(spark, ["003137", "17", "12345"])
    assert results(df, text.last_digits(F.col("v"))) == ["03137", "17", "12345"]


def test_filters_and_labels(spark):
    df = spark.createDataFrame([(30.0, -100.0, "78701", "2021", "05"), (40.0, -100.0, "80202", "2023", "13")], "lat double, lon double, zip string, y string, m string").coalesce(1)
    rows = df.select(
        filters.in_box(F.col("lat"), F.col("lon")), filters.starts_with_any(F.col("zip")), filters.in_state(F.lit("TX")),
        dates.period_label(F.col("y"), F.col("m")),
    ).collect()
    assert [tuple(r) for r in rows] == [(True, True, True, "May 2021"), (False, False, True, None)]


def test_layout_short_lines_and_replacement(spark):
    fields = layout.fields(("a", 0, 2), ("b", 2, 5), ("c", 90, 3))
    df = spark.createDataFrame([("xx  y  ",), ("x",), ("",)], "v string").coalesce(1)
    assert [tuple(r) for r in df.select(*layout.cut_all(F.col("v"), fields)).collect()] == [
        ("xx", "y", ""), ("x", "", ""), ("", "", ""),
    ]
    raw = column(spark, ["é|ü€".encode()], "binary").select("i", F.col("v").cast("string").alias("v"))
    assert results(raw, text.ascii_replace(F.col("v"))) == ["é|ü€".encode().decode("ascii", errors="replace")]
