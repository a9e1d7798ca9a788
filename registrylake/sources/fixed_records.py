"""Files of fixed-length binary records as a splittable Spark source.

Tasks read byte ranges that start and end on record borders; a record's index is arithmetic. The source
hands out records as binary columns in Arrow batches and decodes nothing: fields are cut by column
expressions in the JVM.

For positional hierarchies (a child belongs to the latest parent before it) the source can add *contexts*:
a slice of the latest record of a given type. Inside a range that is a running maximum over the block; what
a range starts with comes from the ranges before it, of which only the tails are read. So a file of any
size is carried without shuffling or sorting its records.

Files that end in ``.zst`` are read as what they hold (``packed``); their ranges are those of the content.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from registrylake.sources import packed, paths
from registrylake.sources.paths import locate, ship_with_tasks

SPLIT_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
TAIL_BYTES = 64 << 10
MAX_RANGES = 200_000


class RecordFile(NamedTuple):
    path: str
    header_bytes: int
    record_length: int
    n_records: int


class Context(NamedTuple):
    """``name`` gets ``length`` bytes from ``start`` of the latest record that begins with ``type_hex``."""

    name: str
    type_hex: str
    start: int
    length: int


class RecordRange(InputPartition):
    def __init__(self, path: str, offset: int, record_length: int, first: int, count: int):
        self.path, self.offset, self.record_length = path, offset, record_length
        self.first, self.count = first, count


class FixedRecordSource(DataSource):
    """Options, as JSON: ``files`` [path, header bytes, record length, records], ``contexts``, ``keep``
    (types to hand out, hex), and ``mode``: ``records`` or ``tails``; ``splitBytes``.
    """

    @classmethod
    def name(cls) -> str:
        return "fixed_records"

    def schema(self) -> str:
        carried = "".join(f", {c[0]} binary" for c in json.loads(self.options.get("contexts", "[]")))
        if self.options.get("mode", "records") == "tails":
            return "source_file string, range_first bigint" + carried
        return "source_file string, record_index bigint, range_first bigint, rec binary" + carried

    def reader(self, schema) -> DataSourceReader:
        return FixedRecordReader(self.options)


class FixedRecordReader(DataSourceReader):
    def __init__(self, options):
        self.files = [tuple(f) for f in json.loads(options["files"])]
        self.contexts = [Context(*c) for c in json.loads(options.get("contexts", "[]"))]
        self.keep = [bytes.fromhex(t) for t in json.loads(options.get("keep", "[]"))]
        self.tails = options.get("mode", "records") == "tails"
        self.split_bytes = int(options.get("splitBytes", SPLIT_BYTES))

    def partitions(self) -> list[InputPartition]:
        ranges = []
        for path, header, length, n in self.files:
            step = max(1, self.split_bytes // length)
            ranges += [
                RecordRange(path, header + first * length, length, first, min(step, n - first))
                for first in range(0, n, step)
            ]
        return ranges or [RecordRange("", 0, 1, 0, 0)]

    def read(self, partition: RecordRange) -> Iterator:
        if partition.count == 0:
            return
        filesystem, inner = locate(partition.path)
        name = inner.rsplit("/", 1)[-1]
        with filesystem.open_input_file(inner) as raw:
            f = packed.opened(raw, inner)
            if self.tails:
                yield self._tail(f, name, partition)
            else:
                yield from self._records(f, name, partition)

    def _block(self, f, partition: RecordRange, skip: int, n: int):
        import numpy as np

        length = partition.record_length
        f.seek(partition.offset + skip * length)
        block = f.read(n * length)
        if len(block) != n * length:
            raise OSError(f"{partition.path} is shorter than when it was listed")
        return np.frombuffer(block, dtype=np.uint8).reshape(n, length)

    def _records(self, f, name: str, partition: RecordRange) -> Iterator:
        import numpy as np
        import pyarrow as pa

        step = max(1, BATCH_BYTES // partition.record_length)
        latest = [None] * len(self.contexts)
        for done in range(0, partition.count, step):
            block = self._block(f, partition, done, min(step, partition.count - done))
            carried = []
            for i, c in enumerate(self.contexts):
                hit = begins_with(block, bytes.fromhex(c.type_hex))
                values = pa.concat_arrays(
                    [pa.array([latest[i]], pa.binary()), binary_rows(block[hit, c.start : c.start + c.length])]
                )
                carried.append(values.take(pa.array(np.cumsum(hit))))  # 0 is what came before the block
                latest[i] = values[-1].as_py()
            index = np.arange(len(block), dtype=np.int64) + partition.first + done
            if self.keep:
                wanted = np.logical_or.reduce([begins_with(block, t) for t in self.keep])
                block, index = block[wanted], index[wanted]
                carried = [c.filter(pa.array(wanted)) for c in carried]
            n = len(block)
            range_first = np.full(n, partition.first, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * n, pa.string()), pa.array(index), pa.array(range_first), binary_rows(block), *carried],
                ["source_file", "record_index", "range_first", "rec", *[c.name for c in self.contexts]],
            )

    def _tail(self, f, name: str, partition: RecordRange):
        """The last record of each context type in the range, read from the end."""
        import numpy as np
        import pyarrow as pa

        found: list = [None] * len(self.contexts)
        end, step = partition.count, max(1, TAIL_BYTES // partition.record_length)
        while end > 0 and None in found:
            start = max(0, end - step)
            block = self._block(f, partition, start, end - start)
            for i, c in enumerate(self.contexts):
                at = np.flatnonzero(begins_with(block, bytes.fromhex(c.type_hex)))
                if found[i] is None and len(at):
                    found[i] = block[at[-1], c.start : c.start + c.length].tobytes()
            end, step = start, step * 4
        return pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([partition.first], pa.int64()), *[pa.array([x], pa.binary()) for x in found]],
            ["source_file", "range_first", *[c.name for c in self.contexts]],
        )


def begins_with(block, prefix: bytes):
    """Which rows of a byte matrix start with ``prefix``."""
    import numpy as np

    return (block[:, : len(prefix)] == np.frombuffer(prefix, dtype=np.uint8)).all(axis=1)


def binary_rows(block):
    """Rows of a byte matrix as an Arrow binary column, without a Python object per row."""
    import numpy as np
    import pyarrow as pa

    n, width = block.shape
    ends = np.arange(n + 1, dtype=np.int32) * np.int32(width)
    data = pa.py_buffer(np.ascontiguousarray(block).tobytes())
    return pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends.tobytes()), data])


def list_files(folder_or_file: str, pattern: str = "*") -> list[tuple[str, int]]:
    """(path, size) of the files, in name order."""
    from fnmatch import fnmatch

    from pyarrow import fs

    filesystem, inner = locate(folder_or_file)
    prefix = folder_or_file[: len(folder_or_file) - len(inner)] if folder_or_file.endswith(inner) else ""
    info = filesystem.get_file_info(inner)
    if info.type == fs.FileType.File:
        found = [info]
    else:
        found = [i for i in filesystem.get_file_info(fs.FileSelector(inner)) if i.type == fs.FileType.File]
        found = [i for i in found if fnmatch(i.base_name, pattern) and not i.base_name.startswith(("_", "."))]
    return [(prefix + i.path, i.size) for i in sorted(found, key=lambda i: i.base_name)]


def split_size(files: Sequence[RecordFile], wanted: int) -> int:
    """``wanted`` bytes per task, more when that would make over MAX_RANGES tasks."""
    total = sum(f.n_records * f.record_length for f in files)
    return max(wanted, total // MAX_RANGES)


def _load(spark: SparkSession, files: Sequence[RecordFile], split_bytes: int, **options: object) -> DataFrame:
    ship_with_tasks(paths)
    ship_with_tasks(packed)
    ship_with_tasks(sys.modules[__name__])
    spark.dataSource.register(FixedRecordSource)
    reader = spark.read.format("fixed_records").option("splitBytes", str(split_size(files, split_bytes)))
    for key, value in {"files": [list(f) for f in files], **options}.items():
        reader = reader.option(key, value if isinstance(value, str) else json.dumps(value))
    return reader.load()


def read_record_files(
    spark: SparkSession, files: Sequence[RecordFile], split_bytes: int = SPLIT_BYTES, keep: Sequence[str] = ()
) -> DataFrame:
    """``source_file``, ``record_index``, ``rec``; ``keep`` names the types (hex prefixes) to hand out."""
    return _load(spark, files, split_bytes, keep=list(keep)).drop("range_first")


def read_with_contexts(
    spark: SparkSession,
    files: Sequence[RecordFile],
    contexts: Sequence[Context],
    keep: Sequence[str] = (),
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """``read_record_files`` plus one binary column per context, null before its first record in a file.

    There is one tail row per range. The number of ranges is known from the file sizes; up to twice
    MAX_RANGES (many small files can exceed it) they are broadcast, beyond they are joined by shuffle.
    """
    names = [c.name for c in contexts]
    carried = [list(c) for c in contexts]
    tails = _load(spark, files, split_bytes, contexts=carried, mode="tails")
    earlier = Window.partitionBy("source_file").orderBy("range_first").rowsBetween(Window.unboundedPreceding, -1)
    starts = tails.select(
        "source_file", "range_first", *[F.last(n, ignorenulls=True).over(earlier).alias(f"_start_{n}") for n in names]
    )
    step = split_size(files, split_bytes)
    if sum(-(-f.n_records // max(1, step // f.record_length)) for f in files) <= 2 * MAX_RANGES:
        starts = F.broadcast(starts)
    records = _load(spark, files, split_bytes, contexts=carried, keep=list(keep))
    joined = records.join(starts, ["source_file", "range_first"], "left")
    return joined.select(
        "source_file", "record_index", "rec", *[F.coalesce(n, f"_start_{n}").alias(n) for n in names]
    )


def whole_records(path: str, record_length: int, pattern: str = "*") -> list[RecordFile]:
    """The files with their number of whole records; bytes after the last one are left out."""
    return [RecordFile(p, 0, record_length, _content_size(p, size) // record_length) for p, size in list_files(path, pattern)]


def _content_size(path: str, size: int) -> int:
    if not path.endswith(packed.SUFFIX):
        return size
    filesystem, inner = locate(path)
    with filesystem.open_input_file(inner) as f:
        return packed.PackedInput(f, path).size


def read_fixed_records(
    spark: SparkSession, path: str, record_length: int, pattern: str = "*", split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """All records of a file or folder."""
    return read_record_files(spark, whole_records(path, record_length, pattern), split_bytes)
