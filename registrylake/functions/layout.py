"""Fixed-position record layouts as column expressions."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from registrylake.functions.text import strip


class Field(NamedTuple):
    name: str
    start: int  # 0-based
    length: int


def fields(*rows: tuple[str, int, int]) -> tuple[Field, ...]:
    return tuple(Field(*row) for row in rows)


def cut(line: Column, field: Field) -> Column:
    """The stripped slice; a line that ends before the field gives ""."""
    return strip(F.substring(line, field.start + 1, field.length))


def cut_all(line: Column, layout: Iterable[Field]) -> list[Column]:
    return [cut(line, f).alias(f.name) for f in layout]


def cut_variant(line: Column, record_type: Column, wanted: str, layout: Iterable[Field]) -> list[Column]:
    """Slices filled only on rows of one record type, null elsewhere."""
    return [F.when(record_type == wanted, cut(line, f)).alias(f.name) for f in layout]
