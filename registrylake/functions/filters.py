"""Extract filters: state, bounding box, code prefixes."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Box(NamedTuple):
    south: float
    north: float
    west: float
    east: float


# The state's extent in degrees, its postal code, and its ZIP prefixes.
STATE_BOX = Box(25.8, 36.5, -106.7, -93.5)
STATE_CODE = "TX"
ZIP_PREFIXES = ("75", "76", "77", "78", "79")


def in_box(lat: Column, lon: Column, box: Box = STATE_BOX) -> Column:
    return lat.between(box.south, box.north) & lon.between(box.west, box.east)


def in_state(c: Column, code: str = STATE_CODE) -> Column:
    return c == code


def starts_with_any(c: Column, prefixes: Iterable[str] = ZIP_PREFIXES) -> Column:
    """One filter instead of a union of extracts; each prefix test can reach the scan."""
    return reduce(lambda a, b: a | b, [c.startswith(p) for p in prefixes])
