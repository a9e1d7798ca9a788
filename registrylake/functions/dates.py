"""Compact dates, numeric dates and the two-way reporting-cycle key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registrylake.functions.text import strip

CENTURY_PIVOT = "50"  # fixed value: two-digit years below are 20xx, the others 19xx


def _dashed(s: Column) -> Column:
    return F.concat_ws("-", F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2))


def compact_date(c: Column) -> Column:
    """``CCYYMMDD`` text to ISO text; null when empty, all zero or not 8 long. No calendar check."""
    s = strip(c)
    return F.when((F.length(s) == 8) & (s != "00000000"), _dashed(s))


def compact_date_typed(c: Column) -> Column:
    """The same as a real date; null also where the calendar has no such day."""
    return F.try_to_timestamp(strip(c), F.lit("yyyyMMdd")).cast("date")


def numeric_date(c: Column) -> Column:
    """Positive number whose integer part has 8 digits, as ISO text; else null."""
    s = F.floor(c).cast("bigint").cast("string")
    return F.when((c > 0) & (F.length(s) == 8), _dashed(s))


def month_label(c: Column) -> Column:
    """``May 2021``."""
    return F.date_format(c, "MMM yyyy")


def period_label(year: Column, month: Column) -> Column:
    """The same from the text columns ``prod_year`` and ``prod_month``."""
    return month_label(F.try_to_timestamp(F.concat(year, month), F.lit("yyyyMM")))


def _century(yy: Column) -> Column:
    return F.concat(F.when(yy < CENTURY_PIVOT, F.lit("20")).otherwise(F.lit("19")), yy)


def year_first_share(df: DataFrame, key: str) -> DataFrame:
    """One row, one column: is the key ``YYMM`` (over half of the first pairs exceed 12)?

    A key whose first two characters are no number raises: the period cannot be told.
    """
    head = F.substring(strip(F.col(key)), 1, 2)
    checked = F.when(head.rlike("^[0-9]{1,2}$"), head.cast("int")).otherwise(
        F.raise_error(F.concat(F.lit("cycle key without a number: "), F.col(key))).cast("int")
    )
    return df.agg((F.avg((checked > 12).cast("int")) > 0.5).alias("year_first"))


def split_cycle_key(df: DataFrame, key: str) -> DataFrame:
    """Add ``prod_year`` and ``prod_month``; the format is read off the whole column.

    The format is one scalar subquery, so it stays in the plan and nothing passes the driver.
    """
    year_first = F.coalesce(year_first_share(df, key).scalar(), F.lit(False))
    first, second = F.substring(F.col(key), 1, 2), F.substring(F.col(key), 3, 2)
    return (
        df.withColumn("_year_first", year_first)
        .withColumn("prod_year", _century(F.when(F.col("_year_first"), first).otherwise(second)))
        .withColumn("prod_month", F.when(F.col("_year_first"), second).otherwise(first))
        .drop("_year_first")
    )
