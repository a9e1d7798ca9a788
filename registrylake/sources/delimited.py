"""Delimited text with a header and an odd separator, all columns as text.

A quoted field may hold line breaks, so whether a line begins a record depends on all lines before it. The files are still read in
splits, once: a task follows its split under both assumptions, that it starts outside or inside quotes, and writes both answers
with each line. What a split does to the state is a function of two values; composed along a file's splits they tell which
answer holds (``_states``). Lines that begin and end outside quotes are records as they are; only lines of records that span
several are brought together, by their record.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrylake.session import materialise
from registrylake.sources.text_lines import ROW_GROUP, SPLIT, earlier_splits, on_split, placed_lines, split_index

# Words read as missing.
NA_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)
_RAW = "_raw_record"
_MARKS = "inside0 boolean, after0 boolean, begin0 bigint, inside1 boolean, after1 boolean, begin1 bigint"


def ends_inside(line: str, sep: str, inside: bool) -> bool:
    """Whether quotes are open at the end of a line that starts a field outside of quotes, or goes on inside."""
    at = 0
    while True:
        if not inside:
            if not line.startswith('"', at):
                at = line.find(sep, at)
                if at < 0:
                    return False
                at += len(sep)
                continue
            at += 1
        at = line.find('"', at)
        while at >= 0 and line.startswith('""', at):
            at = line.find('"', at + 2)
        if at < 0:
            return True
        at = line.find(sep, at)  # after the closing quote the field goes on as plain text
        if at < 0:
            return False
        at, inside = at + len(sep), False


def split_fields(record: str, sep: str) -> list[str]:
    """The fields of one record, without their quotes."""
    fields, start, at = [], 0, 0
    while at >= 0:
        at = record.find(sep, at)
        if at < 0 or not ends_inside(record[start:at], sep, False):
            field = record[start:] if at < 0 else record[start:at]
            fields.append(field[1:-1].replace('""', '"') if len(field) > 1 and field[0] == field[-1] == '"' else field)
            start = at + len(sep)
        at = at if at < 0 else at + len(sep)
    return fields


def normalise_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def column_names(header: str, sep: str) -> list[str]:
    """Normalised names of a header record; a name that repeats gets .1, .2 and so on."""
    names: list[str] = []
    for name in map(normalise_name, split_fields(header, sep)):
        plain, n = name, 0
        while name in names:
            n += 1
            name = f"{plain}.{n}"
        names.append(name)
    return names


def _marked(lines: DataFrame, sep: str) -> DataFrame:
    """Every line with its state and its record's first line if the split starts outside (0) or inside (1) quotes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, state, begin = None, [False, True], [None, None]
        for batch in batches:
            marks: list[list] = [[] for _ in range(6)]
            where = zip(*(batch.column(c).to_pylist() for c in ("_path", "_start", "_id", "value")), strict=True)
            for path, start, number, line in where:
                if (path, start) != split:
                    split, state, begin = (path, start), [False, True], [None, None]
                for i in (0, 1):
                    inside = state[i]
                    if not inside:
                        begin[i] = number
                    after = state[i] = ends_inside(line, sep, inside) if '"' in line else inside
                    for column, value in zip(marks[3 * i : 3 * i + 3], (inside, after, begin[i]), strict=True):
                        column.append(value)
            kinds = [pa.bool_(), pa.bool_(), pa.int64()] * 2
            columns = [*batch.columns, *(pa.array(m, k) for m, k in zip(marks, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *(f.split(" ")[0] for f in _MARKS.split(", "))])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in lines.schema)
    return lines.mapInArrow(run, f"{schema}, {_MARKS}")


def _states(splits: DataFrame) -> DataFrame:
    """Splits with ``_inside``, the state they start in, and ``_begun``, the first line of the record they start in.

    A split sets the state (both ends alike), keeps it, or turns it round. So the state is what the last split that set it left,
    turned by the splits since then.
    """
    before = earlier_splits()
    same = F.col("end0") == F.col("end1")
    turns = (F.col("end0") & ~F.col("end1")).cast("int")
    turned = F.sum(turns).over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    marked = splits.withColumns({"_turned": turned, "_turns": turns})
    marked = marked.withColumn("_set", F.when(same, F.struct(F.col("end0").cast("int").alias("to"), F.col("_turned").alias("at"))))
    last = F.last("_set", ignorenulls=True).over(before)
    since = F.col("_turned") - F.col("_turns") - F.coalesce(last["at"], F.lit(0))
    known = marked.withColumn("_inside", (F.coalesce(last["to"], F.lit(0)) + since) % 2 == 1)
    known = known.withColumn("_last_begin", F.when(F.col("_inside"), F.col("last1")).otherwise(F.col("last0")))
    open_ = F.when(F.col("_inside"), F.col("end1")).otherwise(F.col("end0"))
    at_end = F.lead("_start").over(Window.partitionBy("_path").orderBy("_start")).isNull()
    begun = F.last("_last_begin", ignorenulls=True).over(before)
    return known.withColumn("_begun", F.when(at_end & open_, F.raise_error(F.concat(F.lit("a quote is never closed in "), "_path"))).otherwise(begun)).select(
        *SPLIT, "_first", "_before", "_inside", "_begun"
    )


def read_records(spark: SparkSession, path: str | list[str], sep: str = "}") -> DataFrame:
    """(_path, _number, record): the records of delimited files, blank lines left out; ``_number`` is that of the first line.

    Records end with a line feed, or one after a carriage return, outside of quotes. A quote that is open at a file's end is an error.
    """
    written = materialise(_marked(placed_lines(spark, path, line_end="\n"), sep), "delimited-lines", **ROW_GROUP)
    summary = [F.max_by(f"after{i}", "_id").alias(f"end{i}") for i in (0, 1)] + [F.max(f"begin{i}").alias(f"last{i}") for i in (0, 1)]
    lines = on_split(written, _states(split_index(written, *summary)))

    def of(mark: str) -> Column:
        return F.when(F.col("_inside"), F.col(f"{mark}1")).otherwise(F.col(f"{mark}0"))

    lines = lines.select(
        "_path", "_id", F.col("line_number_in_file").alias("_number"), "value", of("inside").alias("inside"), of("after").alias("after"),
        F.coalesce(of("begin"), "_begun").alias("begin"),
    )
    alone = lines.where("not inside and not after").select("_path", "_number", F.col("value").alias("record"))
    spanning = lines.where("inside or after").groupBy("_path", "begin").agg(
        F.min("_number").alias("_number"), F.sort_array(F.collect_list(F.struct("_number", "value"))).alias("lines")
    )
    joined = spanning.select("_path", "_number", F.array_join("lines.value", "\n").alias("record"))
    records = alone.unionByName(joined).withColumn("record", F.regexp_replace("record", "\r\\z", ""))
    return records.where(F.btrim("record", F.lit(" \t")) != "")


def _n_fields(raw: Column, sep: str) -> Column:
    """Fields of a raw record; separators inside quoted fields do not count."""
    bare = F.regexp_replace(raw, f'(^|\\Q{sep}\\E)"[^"]*+(?:""[^"]*+)*+"', "$1")
    return (F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit("")))) / len(sep) + 1


def _parse(spark: SparkSession, path: str | list[str], sep: str) -> tuple[DataFrame, list[str]]:
    """Rows by the names of their file's header, with ``_path``, ``_number`` and whether a row is over-long.

    The header is each file's first record. Files are united by column names, in the order in which the files bring them; only the
    different headers come to the driver.
    """
    records = read_records(spark, path, sep)
    first = records.groupBy("_path").agg(F.min("_number").alias("_header"))
    tops = records.join(first, "_path").where("_number = _header").select("_path", "_header", F.col("record").alias("_top"))
    tops = materialise(tops, "headers")
    headers = [r[0] for r in tops.groupBy("_top").agg(F.min("_path").alias("p")).orderBy("p").collect()]
    layouts = [column_names(h, sep) for h in headers]
    width = max(map(len, layouts), default=1)
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)] + [T.StructField(_RAW, T.StringType())])
    options = {
        "sep": sep, "quote": '"', "escape": '"', "emptyValue": "", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RAW,
        "maxCharsPerColumn": "-1",
    }
    rows = records.join(tops, "_path").where("_number > _header")
    rows = rows.withColumn("_f", F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), options))
    # Spark keeps the raw text of rows whose number of fields is off; for narrower headers all rows are counted
    n_fields, full = F.lit(None), F.lit(None)
    for header, names in zip(headers, layouts, strict=True):
        here = F.col("_top") == header
        full = F.when(here, F.lit(len(names))).otherwise(full)
    off = F.col(f"_f.{_RAW}").isNotNull() | (full < width)
    n_fields = F.when(off, _n_fields(F.col("record"), sep)).otherwise(F.lit(0))
    names = list(dict.fromkeys(n for layout in layouts for n in layout))
    cells = []
    for name in names:
        cell = F.lit(None).cast("string")
        for header, layout in zip(headers, layouts, strict=True):
            if name in layout:
                cell = F.when(F.col("_top") == header, F.col(f"_f.c{layout.index(name)}")).otherwise(cell)
        cells.append(F.when(~cell.isin(*NA_WORDS), cell).alias(name))
    return rows.select("_path", "_number", (n_fields > full).alias("_overlong"), *cells), names


def read_delimited(spark: SparkSession, path: str | list[str], sep: str = "}", first: int | None = None) -> DataFrame:
    """Rows as text columns named by the normalised header of their file; files with other columns are united by name.

    A row with too many fields is dropped, one with too few is filled with nulls, quotes are honoured and may
    hold line breaks, NA words become null. ``first`` keeps that many rows in file order (smoke runs).
    """
    rows, names = _parse(spark, path, sep)
    rows = rows.where("not _overlong")
    if first:
        rows = rows.orderBy("_path", "_number").limit(first)
    return rows.select(*[f"`{n}`" for n in names])


def overlong_rows(spark: SparkSession, path: str | list[str], sep: str = "}") -> DataFrame:
    """How many rows ``read_delimited`` drops."""
    return _parse(spark, path, sep)[0].agg(F.count_if("_overlong").alias("n_dropped"))
