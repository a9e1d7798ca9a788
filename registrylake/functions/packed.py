"""Packed decimals (two digits a byte, sign in the last half-byte) as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def packed_to_long(c: Column) -> Column:
    """Decode packed bytes (up to nine).

    Every half-byte counts with its value, also the ones above 9, and only the signs D and B are
    negative. No bytes give 0. A half-byte of 10 to 15 is its last digit plus a carried one, so a dirty
    number is the sum of two clean ones.
    """
    shown = F.hex(c)
    digits = F.substring(shown, F.lit(1), F.length(shown) - 1)
    last_digit = F.translate(digits, "ABCDEF", "012345").try_cast("bigint")
    carried = F.translate(digits, "0123456789ABCDEF", "0000000000111111").try_cast("bigint")
    value = F.coalesce(digits.try_cast("bigint"), last_digit + carried * 10, F.lit(0).cast("bigint"))
    negative = F.right(shown, F.lit(1)).isin("B", "D")
    return value * F.when(negative, F.lit(-1)).otherwise(F.lit(1)).cast("bigint")


def is_valid_packed(c: Column) -> Column:
    """Only decimal digits before a sign half-byte."""
    return F.hex(c).rlike("^[0-9]*[A-F]$")


def long_to_packed(c: Column, width: int = 5) -> Column:
    """Encode an integer (fixtures and round trips)."""
    digits = F.lpad(F.abs(c).cast("string"), 2 * width - 1, "0")
    return F.unhex(F.concat(digits, F.when(c < 0, F.lit("D")).otherwise(F.lit("C"))))
