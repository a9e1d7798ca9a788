"""Text expressions: strip, slice, code maps, address join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a text strip removes, for ASCII text and for Latin-1 text.
ASCII_SPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"
LATIN_SPACE = ASCII_SPACE + "\x85\xa0"

REPLACEMENT = "�"


def strip(c: Column, chars: str = ASCII_SPACE) -> Column:
    return F.btrim(c, F.lit(chars))


def rstrip(c: Column, chars: str = ASCII_SPACE) -> Column:
    return F.rtrim(c, F.lit(chars))


def null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def ascii_replace(c: Column) -> Column:
    """Every byte outside ASCII becomes one U+FFFD, so column positions never shift."""
    latin = F.decode(c.cast("binary"), "ISO-8859-1")
    return F.regexp_replace(latin, "[\\x80-\\xff]", REPLACEMENT)


def map_codes(c: Column, codes: Mapping[str, str]) -> Column:
    """Look a code up; unknown codes pass through."""
    pairs = [F.lit(x) for item in codes.items() for x in item]
    return F.coalesce(F.create_map(*pairs)[c], c)


def join_address(lines: Sequence[Column], state: Column, zip_code: Column) -> Column:
    """Non-empty parts joined by ", "; state and zip form one part; all empty gives null."""
    tail = strip(F.concat_ws(" ", F.coalesce(state, F.lit("")), F.coalesce(zip_code, F.lit(""))))
    return null_if_empty(F.concat_ws(", ", *[null_if_empty(x) for x in (*lines, tail)]))


def last_digits(c: Column, n: int = 5) -> Column:
    """The last ``n`` characters (all of them when shorter)."""
    return F.when(F.length(c) > n, F.right(c, F.lit(n))).otherwise(c)


def comma_integer(c: Column) -> Column:
    """Displayed integer such as ``1,234``; blank or ``-`` is 0."""
    digits = F.regexp_replace(strip(c), ",", "")
    return F.when(digits.isin("", "-"), F.lit(0).cast("bigint")).otherwise(digits.cast("bigint"))


def numeric_or_null(c: Column) -> Column:
    """Text as a double; null where it is not a plain decimal number."""
    s = strip(c)
    plain = s.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$")
    return F.when(plain, s.try_cast("double"))
