"""Well keys: state code + county + unique number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from registrylake.functions.text import strip

STATE = "42"  # fixed value


def zero_fill(c: Column, width: int) -> Column:
    """Pad with zeros on the left; longer values stay whole, and a sign stays in front."""
    signed = c.rlike("^[+-]")
    padded = F.when(
        signed, F.concat(F.substring(c, 1, 1), F.lpad(F.substring(c, 2, width), width - 1, "0"))
    ).otherwise(F.lpad(c, width, "0"))
    return F.when(F.length(c) < width, padded).otherwise(c)


def registry_key(apinum: Column) -> Column:
    return F.concat(F.lit(STATE), apinum)


def permit_key(county: Column, unique: Column) -> Column:
    """Never null: blank parts become zeros."""
    return F.concat(F.lit(STATE), zero_fill(county, 3), zero_fill(unique, 5))


def permit_key_valid(county: Column, unique: Column) -> Column:
    return (zero_fill(county, 3) != "000") & (zero_fill(unique, 5) != "00000")


def injection_key(county: Column, unique: Column) -> Column:
    """Null when the county or the unique number is all zero."""
    return F.when(permit_key_valid(county, unique), permit_key(county, unique))


def inspection_key(api_no: Column) -> Column:
    """Null for a blank number, zero-filled to 8 without cutting longer ones."""
    s = strip(api_no)
    return F.when(s != "", F.concat(F.lit(STATE), zero_fill(s, 8)))
