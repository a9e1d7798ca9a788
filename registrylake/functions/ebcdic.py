"""EBCDIC (code page 037) text, JVM-side in both directions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code page is a bijection onto Latin-1, so decoding is a Latin-1 decode plus a character
# translation. Characters that map to themselves stay out of the table (a NUL target would delete).
_PAIRS = [
    (chr(b), bytes([b]).decode("cp037")) for b in range(256) if bytes([b]).decode("cp037") != chr(b)
]
_LATIN = "".join(a for a, _ in _PAIRS)
_TEXT = "".join(b for _, b in _PAIRS)


def decode_text(c: Column) -> Column:
    """EBCDIC bytes to text."""
    return F.translate(F.decode(c, "ISO-8859-1"), _LATIN, _TEXT)


def encode_text(c: Column) -> Column:
    """Text (Latin-1 repertoire) to EBCDIC bytes."""
    return F.encode(F.translate(c, _TEXT, _LATIN), "ISO-8859-1")


def byte_slice(rec: Column, start: int, length: int) -> Column:
    """0-based slice of a binary record."""
    return F.substring(rec, start + 1, length)


def text_slice(rec: Column, start: int, length: int) -> Column:
    return decode_text(byte_slice(rec, start, length))
