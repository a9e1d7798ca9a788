"""Data-quality checks of three levels: ingestion, referential, analytical.

A check names the frame it looks at, the aggregates it needs there, and how these become a status.
``evaluate`` computes all checks that look at the same frame in one aggregation, so a table is read once
however many checks it has; checks on keys look at a frame that is already grouped by the key, which
Spark combines before the shuffle. Everything stays a plan: one row per check comes out.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce, wraps

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("check_name", T.StringType()),
        T.StructField("check_level", T.LongType()),
        T.StructField("check_status", T.StringType()),
        T.StructField("check_value", T.StringType()),
        T.StructField("check_threshold", T.StringType()),
        T.StructField("notes", T.StringType()),
    ]
)

Rendered = tuple[Column, Column, Column]  # status, value, notes


@dataclass(frozen=True, eq=False)
class Check:
    name: str
    level: int
    threshold: str
    frame: DataFrame
    measures: Mapping[str, Column]
    render: Callable[[Callable[[str], Column]], Rendered]


def _row(check: Check, prefix: str) -> Column:
    status, value, notes = check.render(lambda m: F.col(prefix + m))
    return F.struct(
        F.lit(check.name).alias("check_name"),
        F.lit(check.level).cast("bigint").alias("check_level"),
        status.cast("string").alias("check_status"),
        value.cast("string").alias("check_value"),
        F.lit(check.threshold).alias("check_threshold"),
        notes.cast("string").alias("notes"),
    )


def _measures(checks: Sequence[Check]) -> list[Column]:
    return [F.count(F.lit(1)).alias("_rows"), *[c.alias(f"_{i}_{m}") for i, check in enumerate(checks) for m, c in check.measures.items()]]


def _rendered(measured: DataFrame, checks: Sequence[Check]) -> DataFrame:
    return measured.select(F.inline(F.array(*[_row(check, f"_{i}_") for i, check in enumerate(checks)])))


def _evaluate_frame(frame: DataFrame, checks: Sequence[Check]) -> DataFrame:
    return _rendered(frame.agg(*_measures(checks)), checks)


def observing(df: DataFrame, checks: Sequence[Check]) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """``df`` with the checks' measures taken on the way, and what renders them once an action on it has ended.

    The checks look at ``df`` itself; their rows are those of ``evaluate``, without another read.
    """
    measures = _measures(checks)
    schema = df.agg(*measures).schema
    taken = Observation()

    def results() -> DataFrame:
        row = tuple(taken.get[name] for name in schema.names)
        return _rendered(df.sparkSession.createDataFrame([row], schema), checks)

    return df.observe(taken, *measures), results


def error_row(spark, name: str, level: int, value: str, threshold: str) -> DataFrame:
    return spark.createDataFrame([(name, level, "error", value, threshold, "")], RESULT_SCHEMA)


def evaluate(checks: Sequence[Check]) -> DataFrame:
    """One row per check, one aggregation per frame. A check that cannot be planned is an error row."""
    frames: dict[int, list[Check]] = {}
    for check in checks:
        frames.setdefault(id(check.frame), []).append(check)
    parts = []
    for group in frames.values():
        try:
            parts.append(_evaluate_frame(group[0].frame, group))
        except AnalysisException:
            parts += [_evaluate_alone(c) for c in group]
    return reduce(DataFrame.unionAll, parts)


def _evaluate_alone(check: Check) -> DataFrame:
    try:
        return _evaluate_frame(check.frame, [check])
    except AnalysisException as e:
        spark = check.frame.sparkSession
        return error_row(spark, check.name, check.level, str(e).splitlines()[0], check.threshold)


def guarded(name: str, level: int, threshold: str):
    """A check whose frame cannot be built (an absent column) is an error row, not an exception."""

    def wrap(build: Callable[..., Check]) -> Callable[..., Check]:
        @wraps(build)
        def safe(df: DataFrame, *args, **kwargs) -> Check:
            try:
                return build(df, *args, **kwargs)
            except AnalysisException as e:
                message = str(e).splitlines()[0]
                return Check(name, level, threshold, df.sparkSession.range(1), {}, _fixed("error", message))

        return safe

    return wrap


# -- rendering helpers --------------------------------------------------------------------------


def _percent(rate: Column) -> Column:
    return F.format_string("%.2f%%", F.bround(rate * 100, 2))


def _thousands(n: Column) -> Column:
    return F.when(n.isNotNull(), F.format_string("%,d", n.cast("bigint")))


def _issues(items: Sequence[Column], bad: str, good: str, bad_status: str = "fail") -> Rendered:
    """Items that are not null are issues: their number, and the first five joined."""
    if not items:
        return F.lit("pass"), F.lit(good), F.lit("")
    found = F.array_compact(F.array(*items))
    n = F.size(found)
    return (
        F.when(n == 0, "pass").otherwise(bad_status),
        F.when(n == 0, good).otherwise(F.format_string(f"%d {bad}", n)),
        F.array_join(F.slice(found, 1, 5), "; "),
    )


def _fixed(status: str, value: str, notes: str = "") -> Callable[..., Rendered]:
    return lambda m: (F.lit(status), F.lit(value), F.lit(notes))


def _listed(items: Sequence[str], bad: str, good: str) -> Callable[..., Rendered]:
    if not items:
        return _fixed("pass", good)
    return _fixed("fail", f"{len(items)} {bad}", "; ".join(items[:5]))


# -- level 1: ingestion -------------------------------------------------------------------------


def _missing(df: DataFrame, c: str) -> Column:
    """Null, or not a number in a floating column."""
    real = df.schema[c].dataType in (T.DoubleType(), T.FloatType())
    return F.col(c).isNull() | F.isnan(c) if real else F.col(c).isNull()


@guarded("pk_unique", 1, "0 duplicates")
def pk_unique(df: DataFrame, columns: str | Sequence[str]) -> Check:
    """No two rows share a key. Counts all rows of duplicate groups; null equals null."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    dupes = F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0))
    return Check(
        "pk_unique", 1, "0 duplicates", groups, {"dupes": dupes},
        lambda m: (
            F.when(m("dupes") == 0, "pass").otherwise("fail"),
            F.format_string("%d duplicates", m("dupes")),
            F.lit(f"PK columns: {columns}"),
        ),
    )


def required_nonnull(df: DataFrame, columns: Sequence[str], threshold: float = 0.01) -> Check:
    """Null rate of each column at most ``threshold``; an empty string is a value, a missing column an issue."""
    have = [c for c in columns if c in df.columns]
    rates = {f"null_{c}": F.coalesce(F.avg(_missing(df, c).cast("int")), F.lit(0.0)) for c in have}

    def render(m):
        items = []
        for c in columns:
            if c not in have:
                items.append(F.lit(f"{c} missing from DataFrame"))
                continue
            rate = m(f"null_{c}")
            text = F.concat(F.lit(f"{c}: "), _percent(rate), F.lit(f" null (threshold {threshold:.0%})"))
            items.append(F.when(rate > threshold, text))
        return _issues(items, "columns above threshold", "all below threshold")

    return Check("required_nonnull", 1, f"null rate < {threshold:.0%}", df, rates, render)


def parsed_timestamp(c: Column) -> Column:
    """A date or timestamp, ISO text, or compact ``yyyyMMdd`` text; anything else, years of five digits and more in it, is null."""
    text = c.cast("string")
    found = F.coalesce(c.try_cast("timestamp"), F.try_to_timestamp(text, F.lit("yyyyMMdd")))
    return F.when(~text.rlike(r"^\s*\d{5,7}(\s*$|-)"), found)


def date_range_sane(df: DataFrame, columns: Sequence[str], run_ts: str, max_future_months: int = 6) -> Check:
    """No date later than ``run_ts`` plus whole calendar months. The clock is passed in."""
    have = [c for c in columns if c in df.columns]
    cutoff = F.lit(run_ts).cast("timestamp") + F.make_interval(months=F.lit(max_future_months))
    late = {f"late_{c}": F.count_if(parsed_timestamp(F.col(c)) > cutoff) for c in have}

    def render(m):
        day = F.date_format(cutoff, "yyyy-MM-dd")
        items = [
            F.when(m(f"late_{c}") > 0, F.concat(F.lit(f"{c}: "), m(f"late_{c}").cast("string"), F.lit(" rows > "), day))
            for c in have
        ]
        return _issues(items, "columns with future dates", "all dates sane")

    return Check("date_range_sane", 1, f"no dates > today + {max_future_months} months", df, late, render)


def boolean_not_uniform(df: DataFrame, columns: Sequence[str]) -> Check:
    """Flags take both values; a uniform or empty flag is a warning."""
    have = [c for c in columns if c in df.columns]
    ends = {k: v for c in have for k, v in ((f"lo_{c}", F.min(c)), (f"hi_{c}", F.max(c)))}

    def render(m):
        items = []
        for c in have:
            lo, hi = m(f"lo_{c}"), m(f"hi_{c}")
            shown = F.coalesce(F.initcap(lo.cast("string")), F.lit("empty"))
            items.append(F.when(lo.isNull() | (lo == hi), F.concat(F.lit(f"{c}="), shown)))
        return _issues(items, "uniform boolean columns", "all booleans have variation", "warn")

    return Check("boolean_not_uniform", 1, "at least 2 distinct values per boolean", df, ends, render)


def identifier_columns_str(df: DataFrame, columns: Sequence[str]) -> Check:
    types = dict(df.dtypes)
    wrong = [f"{c}: {types[c]}" for c in columns if c in types and types[c] != "string"]
    return Check(
        "identifier_columns_str", 1, "all str", df, {}, _listed(wrong, "non-str ID columns", "all ID columns are str")
    )


def schema_match(df: DataFrame, expected: Sequence[str]) -> Check:
    """All expected columns exist; more are allowed."""
    missing = [c for c in expected if c not in df.columns]
    render = _fixed("fail", f"{len(missing)} missing", f"missing: {missing[:5]}") if missing else _fixed("pass", "all present")
    return Check("schema_match", 1, "all expected columns present", df, {}, render)


def dtype_match(df: DataFrame, expected: Mapping[str, str]) -> Check:
    """Types equal the data dictionary's (Spark type names)."""
    types = dict(df.dtypes)
    wrong = [f"{c}: {types[c]} != {t}" for c, t in expected.items() if c in types and types[c] != t]
    return Check("dtype_match", 1, "all dtypes match", df, {}, _listed(wrong, "columns of another dtype", "all match"))


def key_column_named(df: DataFrame, column: str = "api10") -> Check:
    ok = column in df.columns
    return Check(
        f"api_column_named_{column}", 1, "column exists", df, {},
        _fixed("pass" if ok else "fail", "present" if ok else "missing", "" if ok else f"no column {column}"),
    )


def row_count(df: DataFrame, expected: int | Callable[[], int] | None = None, tolerance: float = 0.01) -> Check:
    """Row count near the expected one; without one, the table is compared with itself.

    An expected count that is known only after the rows were written, of their source, is a function.
    """
    n = {"n": F.count(F.lit(1))}

    def render(m):
        actual = m("n")
        known = expected() if callable(expected) else expected
        want = actual if known is None else F.lit(known)
        if known is None:
            status = F.when(actual == 0, "warn").otherwise("pass")
        elif known == 0:
            status = F.when(actual == 0, "warn").otherwise("pass")
        else:
            status = F.when(F.abs(actual - want) / want <= tolerance, "pass").otherwise("warn")
        return status, _thousands(actual), F.format_string("delta: %+,d", actual - want)

    shown = "own count" if expected is None else "source count" if callable(expected) else f"{expected:,}"
    return Check("row_count", 1, f"{shown} +/- {tolerance:.0%}", df, n, render)


@guarded("row_count_match", 1, "exact match")
def row_count_match(source: DataFrame, output: DataFrame) -> Check:
    """The output has exactly as many rows as the source."""
    counts = source.agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("bigint").alias("o")).unionAll(
        output.agg(F.lit(0).cast("bigint").alias("n"), F.count(F.lit(1)).alias("o"))
    )
    return Check(
        "row_count_match", 1, "exact match", counts, {"src": F.sum("n"), "out": F.sum("o")},
        lambda m: (
            F.when(m("src") == m("out"), "pass").otherwise("fail"),
            F.concat(_thousands(m("out")), F.lit(" of "), _thousands(m("src"))),
            F.format_string("delta: %+,d", m("out") - m("src")),
        ),
    )


def files_read(bad: DataFrame) -> Check:
    """Were all files of a source read? ``bad`` has a ``path`` for each that was skipped; the first ones are named."""
    names = F.array_sort(F.collect_set(F.element_at(F.split("path", "/"), -1)))
    return Check(
        "source_files_read", 2, "no file skipped", bad, {"n": F.count(F.lit(1)), "names": names},
        lambda m: (
            F.when(m("n") == 0, "pass").otherwise("warn"),
            F.concat(_thousands(m("n")), F.lit(" skipped")),
            F.array_join(F.slice(m("names"), 1, 5), "; "),
        ),
    )


# -- level 2: references between tables ---------------------------------------------------------


def _fk_groups(df: DataFrame, fk: str, parent: DataFrame, pk: str, extra: Sequence[Column] = ()) -> DataFrame:
    """One row per foreign key value (and extra columns): how many rows, and does the parent exist?

    Rows collapse to key counts before the join, so a hot key is one row there.
    """
    counts = df.where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("_fk"), *extra).agg(F.count(F.lit(1)).alias("_n"))
    parents = parent.where(F.col(pk).isNotNull()).select(F.col(pk).alias("_fk")).distinct()
    return counts.join(parents.withColumn("_hit", F.lit(True)), "_fk", "left")


def _matched() -> dict[str, Column]:
    return {
        "total": F.coalesce(F.sum("_n"), F.lit(0)),
        "matched": F.coalesce(F.sum(F.when(F.col("_hit"), F.col("_n"))), F.lit(0)),
    }


@guarded("fk_match_rate", 2, "resolved")
def fk_match_rate(
    df: DataFrame, fk: str, parent: DataFrame, pk: str, warn_threshold: float = 0.99, fail_threshold: float = 0.95
) -> Check:
    """Share of non-null foreign keys that resolve; no foreign keys count as all resolved."""
    shown = f">={warn_threshold:.0%}"
    if fk not in df.columns:
        return Check("fk_match_rate", 2, shown, df, {}, _fixed("error", f"{fk} not in table"))

    def render(m):
        rate = F.when(m("total") > 0, m("matched") / m("total")).otherwise(F.lit(1.0))
        status = F.when(rate >= warn_threshold, "pass").when(rate >= fail_threshold, "warn").otherwise("fail")
        value = F.concat(_percent(rate), F.lit(" ("), _thousands(m("total") - m("matched")), F.lit(" orphans)"))
        return status, value, F.lit(f"{fk} -> {pk}")

    return Check("fk_match_rate", 2, shown, _fk_groups(df, fk, parent, pk), _matched(), render)


@guarded("orphan_count", 2, "resolved")
def orphan_count(
    df: DataFrame, fk: str, parent: DataFrame, pk: str, warn_above: float = 0.05, fail_above: float = 0.20
) -> Check:
    """Rows whose foreign key does not resolve, as a share of rows with one."""

    def render(m):
        orphans = m("total") - m("matched")
        rate = F.when(m("total") > 0, orphans / m("total")).otherwise(F.lit(0.0))
        status = F.when(rate > fail_above, "fail").when(rate > warn_above, "warn").otherwise("pass")
        return status, F.concat(_thousands(orphans), F.lit(" orphans ("), _percent(rate), F.lit(")")), F.lit(f"{fk} -> {pk}")

    shown = f"warn > {warn_above:.0%}, fail > {fail_above:.0%}"
    return Check("orphan_count", 2, shown, _fk_groups(df, fk, parent, pk), _matched(), render)


def orphans_by_category(df: DataFrame, fk: str, parent: DataFrame, pk: str, category: str) -> DataFrame:
    """Orphan rows per category."""
    groups = _fk_groups(df, fk, parent, pk, [F.col(category).alias("category")])
    return groups.where(F.col("_hit").isNull()).groupBy("category").agg(F.sum("_n").alias("n_orphans"))


@guarded("orphan_distribution", 2, "no dominant category")
def orphan_distribution(
    df: DataFrame, fk: str, parent: DataFrame, pk: str, category: str, max_share: float = 0.5
) -> Check:
    """No category holds more than ``max_share`` of the orphans."""

    def render(m):
        share = F.when(m("total") > 0, m("top") / m("total")).otherwise(F.lit(0.0))
        status = F.when(share > max_share, "warn").otherwise("pass")
        notes = F.concat(F.lit("largest: "), F.coalesce(m("who").cast("string"), F.lit("none")))
        return status, F.concat(F.lit("largest category "), _percent(share)), notes

    return Check(
        "orphan_distribution", 2, f"no category > {max_share:.0%} of orphans",
        orphans_by_category(df, fk, parent, pk, category),
        {
            "total": F.coalesce(F.sum("n_orphans"), F.lit(0)),
            "top": F.coalesce(F.max("n_orphans"), F.lit(0)),
            "who": F.max_by("category", F.struct("n_orphans", F.col("category"))),
        },
        render,
    )


@guarded("cardinality_bounds", 2, "max")
def cardinality_bounds(df: DataFrame, group: str, max_expected: int) -> Check:
    """Largest group within bounds; null keys do not count."""
    if group not in df.columns:
        return Check("cardinality_bounds", 2, f"max <= {max_expected}", df, {}, _fixed("error", f"{group} not in table"))
    sizes = df.where(F.col(group).isNotNull()).groupBy(F.col(group).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    top = sizes.orderBy(F.desc("_n"), "_k").limit(3)
    quote = "'" if dict(df.dtypes)[group] == "string" else ""
    entry = F.concat(F.lit(quote), F.col("_k").cast("string"), F.lit(f"{quote}: "), F.col("_n").cast("string"))

    def render(m):
        shown = F.transform(F.sort_array(m("top"), asc=False), lambda x: x["t"])
        return (
            F.when(m("max") <= max_expected, "pass").otherwise("warn"),
            F.concat(F.lit("max group: "), F.coalesce(_thousands(m("max")), F.lit("nan"))),
            F.concat(F.lit("top groups: {"), F.array_join(shown, ", "), F.lit("}")),
        )

    measures = {"max": F.max("_n"), "top": F.collect_list(F.struct(F.col("_n"), entry.alias("t")))}
    return Check("cardinality_bounds", 2, f"max <= {max_expected:,}", top, measures, render)


@guarded("cross_ref_consistency", 2, "match")
def cross_ref_consistency(
    snapshot: DataFrame, current: DataFrame, key: str, snapshot_field: str, current_field: str, min_rate: float = 0.99
) -> Check:
    """The snapshot's field equals the current row of the temporal table (one row per key on both sides)."""
    pairs = snapshot.select(F.col(key).alias("_k"), F.col(snapshot_field).alias("_a")).join(
        current.select(F.col(key).alias("_k"), F.col(current_field).alias("_b")), "_k"
    )

    def render(m):
        rate = F.when(m("n") > 0, m("same") / m("n")).otherwise(F.lit(1.0))
        value = F.concat(_percent(rate), F.lit(" ("), _thousands(m("n") - m("same")), F.lit(" stale)"))
        return F.when(rate >= min_rate, "pass").otherwise("fail"), value, F.lit(f"{snapshot_field} = {current_field}")

    same = F.count_if(F.col("_a").eqNullSafe(F.col("_b")))
    return Check(
        "cross_ref_consistency", 2, f">={min_rate:.0%}", pairs, {"n": F.count(F.lit(1)), "same": same}, render
    )


def names_with_several_ids(df: DataFrame, name: str, identifier: str) -> DataFrame:
    """Names that map to two or more identifiers, with their number."""
    pairs = df.where(F.col(name).isNotNull() & F.col(identifier).isNotNull()).select(name, identifier).distinct()
    return pairs.groupBy(name).agg(F.count(F.lit(1)).alias("n_ids")).where("n_ids > 1")


@guarded("name_to_id_cardinality", 2, "no name maps to 2+ IDs")
def name_to_id_cardinality(df: DataFrame, name: str, identifier: str) -> Check:
    return Check(
        "name_to_id_cardinality", 2, "no name maps to 2+ IDs", names_with_several_ids(df, name, identifier),
        {"n": F.count(F.lit(1)), "max": F.coalesce(F.max("n_ids"), F.lit(0))},
        lambda m: (
            F.when(m("n") == 0, "pass").otherwise("fail"),
            F.format_string("%d names with several IDs", m("n")),
            F.when(m("n") == 0, "").otherwise(F.format_string("up to %d IDs per name", m("max"))),
        ),
    )


def dtype_consistency(tables: Mapping[str, DataFrame], column: str) -> Check:
    """One type for a column name across all tables that have it."""
    found = {slug: dict(df.dtypes)[column] for slug, df in tables.items() if column in df.columns}
    n = len(set(found.values()))
    render = _fixed("pass" if n <= 1 else "fail", f"{n} distinct dtypes for '{column}'", f"dtypes: {found}" if n > 1 else "")
    return Check("dtype_consistency", 2, "1 dtype across all tables", next(iter(tables.values())), {}, render)


# -- level 3: analytical sanity -----------------------------------------------------------------


def count_sanity(df: DataFrame, low: int, high: int, entity: str) -> Check:
    return Check(
        "count_sanity", 3, f"{low:,}-{high:,}", df, {"n": F.count(F.lit(1))},
        lambda m: (
            F.when(m("n").between(low, high), "pass").otherwise("fail"),
            F.concat(_thousands(m("n")), F.lit(f" {entity}")),
            F.when(m("n").between(low, high), "within range").otherwise("outside range"),
        ),
    )


@guarded("spot_check_authoritative", 3, "all samples exact")
def spot_check_authoritative(reconciled: DataFrame) -> Check:
    """All sampled rows agree exactly (see ``operators.reconcile``)."""
    return Check(
        "spot_check_authoritative", 3, "all samples exact", reconciled,
        {"n": F.count(F.lit(1)), "ok": F.count_if(F.col("status") == "PASS")},
        lambda m: (
            F.when(m("ok") == m("n"), "pass").otherwise("fail"),
            F.format_string("%d/%d PASS", m("ok"), m("n")),
            F.lit(""),
        ),
    )


def manifest_differences(manifest: DataFrame, counts: DataFrame, table: str = "table_name", rows: str = "n_rows") -> DataFrame:
    """Full outer comparison of a manifest with actual counts, one row per table."""
    a = manifest.select(table, F.col(rows).alias("manifest_rows"))
    b = counts.select(table, F.col(rows).alias("actual_rows"))
    same = F.col("manifest_rows").eqNullSafe(F.col("actual_rows"))
    status = (
        F.when(F.col("manifest_rows").isNull(), "not_in_manifest")
        .when(F.col("actual_rows").isNull(), "missing_table")
        .when(same, "match")
        .otherwise("count_differs")
    )
    return a.join(b, table, "full").withColumn("manifest_status", status)


@guarded("manifest_consistency", 3, "exact match")
def manifest_consistency(manifest: DataFrame, counts: DataFrame) -> Check:
    diff = manifest_differences(manifest, counts)
    return Check(
        "manifest_consistency", 3, "exact match", diff,
        {"n": F.count(F.lit(1)), "bad": F.count_if(F.col("manifest_status") != "match")},
        lambda m: (
            F.when(m("bad") == 0, "pass").otherwise("fail"),
            F.format_string("%d of %d tables differ", m("bad"), m("n")),
            F.lit(""),
        ),
    )


def coverage_by_type(df: DataFrame, kind: str, extracted: Column, good: float = 0.9, low: float = 0.8) -> DataFrame:
    """Extraction rate and status per document type."""
    rate = F.col("n_extracted") / F.col("n_documents")
    return (
        df.groupBy(F.col(kind).alias("document_type"))
        .agg(F.count(F.lit(1)).alias("n_documents"), F.count_if(extracted).alias("n_extracted"))
        .withColumn("check_status", F.when(rate >= good, "pass").when(rate >= low, "warn").otherwise("fail"))
    )


@guarded("extraction_coverage", 3, "rate per type")
def extraction_coverage(df: DataFrame, kind: str, extracted: Column, good: float = 0.9, low: float = 0.8) -> Check:
    """The worst document type decides."""
    types = coverage_by_type(df, kind, extracted, good, low)
    rate = F.col("n_extracted") / F.col("n_documents")

    def render(m):
        worst = F.coalesce(m("rate"), F.lit(1.0))
        status = F.when(worst >= good, "pass").when(worst >= low, "warn").otherwise("fail")
        notes = F.concat(F.lit("lowest: "), F.coalesce(m("who").cast("string"), F.lit("none")))
        return status, F.concat(F.lit("lowest rate "), _percent(worst)), notes

    measures = {"rate": F.min(rate), "who": F.min_by("document_type", F.struct(rate, F.col("document_type")))}
    return Check("extraction_coverage", 3, f"pass >= {good:.0%}, warn >= {low:.0%}", types, measures, render)


def only_original_reports(df: DataFrame, keys: Sequence[str], flag: str = "corrected_report_flag", corrected: str = "Y") -> DataFrame:
    """Keys (lease-months) for which no corrected report exists, with their number of reports."""
    seen = F.coalesce(F.bool_or(F.col(flag) == corrected), F.lit(False))
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_reports"), seen.alias("_corrected"))
        .where(~F.col("_corrected"))
        .drop("_corrected")
    )


@guarded("corrected_report_handling", 3, "corrected report present")
def corrected_report_handling(df: DataFrame, keys: Sequence[str], flag: str = "corrected_report_flag", corrected: str = "Y") -> Check:
    return Check(
        "corrected_report_handling", 3, "corrected report present",
        only_original_reports(df, keys, flag, corrected), {"n": F.count(F.lit(1))},
        lambda m: (
            F.when(m("n") == 0, "pass").otherwise("warn"),
            F.concat(_thousands(m("n")), F.lit(" with original report only")),
            F.lit(""),
        ),
    )
