"""dBase III files: headers are read while planning, records by the fixed-record source."""

from __future__ import annotations

import struct
from concurrent.futures import ThreadPoolExecutor
from typing import BinaryIO, NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrylake.functions.layout import Field
from registrylake.functions.text import LATIN_SPACE, null_if_empty, strip
from registrylake.operators.keysets import union_by_name
from registrylake.sources.fixed_records import RecordFile, list_files, read_record_files
from registrylake.sources.paths import locate

# Fixed values of the file format.
PREFIX = "<B3xIHH20x"
DESCRIPTOR = "<11sc4xBB14x"
FIELDS_END = 0x0D
DELETED = b"*"


class DbaseHeader(NamedTuple):
    n_records: int
    header_size: int
    record_size: int
    layout: tuple[Field, ...]


def parse_header(stream: BinaryIO) -> DbaseHeader:
    """Header of the file; raises on a damaged one.

    The field list ends at its end mark or at a cut-off entry; a file that stops before that is damaged.
    """
    prefix = stream.read(32)
    if len(prefix) < 32:
        raise ValueError("file is shorter than a header")
    _, n_records, header_size, record_size = struct.unpack(PREFIX, prefix)
    layout, start = [], 1  # a record starts with its deletion flag
    while True:
        entry = stream.read(32)
        if not entry:
            raise ValueError("file ends before its field list")
        if entry[0] == FIELDS_END or len(entry) < 32:
            break
        raw_name, _, length, _ = struct.unpack(DESCRIPTOR, entry)
        name = raw_name.split(b"\x00")[0].decode("ascii").strip()
        layout.append(Field(name, start, length))
        start += length
    if record_size < 1:
        raise ValueError("records have no length")
    return DbaseHeader(n_records, header_size, record_size, tuple(layout))


def _read_header(path: str) -> DbaseHeader:
    filesystem, inner = locate(path)
    with filesystem.open_input_stream(inner) as f:
        return parse_header(f)


def scan_headers(folder: str, pattern: str = "api*.dbf") -> tuple[list[tuple[str, int, DbaseHeader]], list[tuple[str, str]]]:
    """Readable files (path, size, header) in name order, and (path, reason) of the files to skip."""

    def attempt(entry):
        path, size = entry
        try:
            return path, size, _read_header(path), None
        except (ValueError, struct.error) as e:  # a damaged file is reported and skipped; a failed read is raised
            return path, size, None, str(e)

    with ThreadPoolExecutor(16) as pool:
        seen = list(pool.map(attempt, list_files(folder, pattern)))
    good = [(p, s, h) for p, s, h, _ in seen if h]
    bad = [(p, why) for p, _, h, why in seen if not h]
    return good, bad


def bad_files(spark: SparkSession, folder: str, pattern: str = "api*.dbf", scanned: tuple | None = None) -> DataFrame:
    return spark.createDataFrame((scanned or scan_headers(folder, pattern))[1], "path string, reason string")


def read_dbase(
    spark: SparkSession, folder: str, pattern: str = "api*.dbf", split_bytes: int = 64 << 20, scanned: tuple | None = None
) -> DataFrame:
    """All live records: one string column per field (lower-case name), ``source_file``, ``ordinal``.

    Files of equal layout are read together; layouts are united by column name. Deleted rows are left
    out, text is Latin-1 and stripped, empty is null. Columns of files without rows stay, all null. ``scanned`` is what
    ``scan_headers`` gave, where it has been asked already.
    """
    good, _ = scanned or scan_headers(folder, pattern)
    if not good:
        raise FileNotFoundError(f"no readable {pattern} in {folder}")
    by_layout: dict[tuple[Field, ...], list[RecordFile]] = {}
    for path, size, h in good:
        whole = max(0, size - h.header_size) // h.record_size
        by_layout.setdefault(h.layout, []).append(
            RecordFile(path, h.header_size, h.record_size, min(h.n_records, whole))
        )
    frames = []
    for layout, files in by_layout.items():
        records = read_record_files(spark, files, split_bytes).where(F.substring("rec", 1, 1) != F.lit(DELETED))
        cells = [
            null_if_empty(strip(F.decode(F.substring("rec", f.start + 1, f.length), "ISO-8859-1"), LATIN_SPACE)).alias(
                f.name.lower().strip()
            )
            for f in layout
        ]
        frames.append(records.select(*cells, "source_file", F.col("record_index").alias("ordinal")))
    return union_by_name(*frames)
