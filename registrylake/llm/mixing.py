"""Mixing sources to target weights with nested hash-threshold histograms.

Every document has a fixed 60-bit hash of its key and text. A source takes whole rounds of all its documents and, for the rest of
its target, those documents whose hash is below a threshold. The threshold is found from histograms: words summed by
(source, first 12 bits), then only the rows of the bucket where the sum crosses the target by the next 12 bits, and so on.
No row is sorted, and a rerun takes the same documents.

Defined results: a null source is a source of its own, last in order; a null or empty text has size 0; equal rows
share a hash and are taken together; a source without words has target 0; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registrylake.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
DIGITS = 3  # hexadecimal digits a level
LEVELS = 5
BUCKETS = 16**DIGITS
FEW_SOURCES = 20_000  # rows of a few dozen bytes and a source's name
SALTS = 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def key_hash(key: Column, text: Column) -> Column:
    """60 bits of an md5 of the key and the text's md5, so that rows that only share a key are taken one by one."""
    own = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    digest = F.md5(F.concat_ws("/", F.coalesce(key.cast("string"), F.lit("null")), own).cast("binary"))
    return F.conv(F.substring(digest, 1, DIGITS * LEVELS), 16, 10).cast("bigint")


def _bits(level: int) -> Column:
    """The bucket of a hash at a level, 0 the coarsest."""
    return F.shiftright(F.col("h"), 4 * DIGITS * (LEVELS - 1 - level)).bitwiseAND(F.lit(BUCKETS - 1))


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, limit: float) -> DataFrame:
    """(source, source_size, target): the budget by weight; above ``limit`` sizes a source stops, the others take the rest.

    One row per source: sources are what a mix is configured by, so their table is small.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    ranked = totals.select(
        "*", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int")).alias("weight")
    )
    every = Window.partitionBy(F.lit(0))
    full_at = (F.lit(float(limit)) * F.col("source_size") / F.col("weight")).alias("full_at")
    ranked = ranked.select("*", full_at, (F.sum("source_size").over(every) * F.lit(float(share))).alias("budget"))
    before = Window.orderBy("full_at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    used = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * F.lit(float(limit))
    open_weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    ranked = ranked.select("*", ((F.col("budget") - used) / open_weight).alias("level"))
    level = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "level"))).over(every)["level"]
    most = F.lit(float(limit)) * F.col("source_size")
    return ranked.select(
        "source", "source_size", F.least(most, F.coalesce(level * F.col("weight"), most)).alias("target")
    )


def _boundary(rows: DataFrame, level: int) -> DataFrame:
    """(source, at, left, bucket_size): the bucket in which a source's sum crosses what is ``left``, and what is left there."""
    sums = rows.groupBy("source", "left", _bits(level).alias("at")).agg(F.sum("size").alias("n"))
    running = Window.partitionBy("source").orderBy("at")
    summed = sums.select("source", "at", "left", "n", F.sum("n").over(running).alias("upto"))
    crossing = summed.where(F.col("upto") > F.col("left"))
    first = F.min(F.struct("at", (F.col("left") - (F.col("upto") - F.col("n"))).alias("left"), "n"))
    return crossing.groupBy("source").agg(first.alias("b")).select("source", "b.*")


def _within(rows: DataFrame, boundary: DataFrame, level: int) -> DataFrame:
    b = boundary.select(F.col("source").alias("_s"), "at", "left")
    same = F.col("source").eqNullSafe(F.col("_s")) & (_bits(level) == F.col("at"))
    return rows.drop("left").join(b, same).select("source", "size", "h", "left")


def thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, bound): documents with a hash below ``bound`` are taken once more.

    The last level holds single hashes: the one that crosses is taken if that ends nearer to the target.
    """
    rest = targets.select(F.col("source").alias("_s"), _rest().alias("left")).where("left > 0")
    rows = on_source(sizes, rest, F.col("source"), "_s").select("source", "size", "h", "left")
    found, bound = None, F.lit(0).cast("bigint")
    for level in range(LEVELS):
        at = _boundary(rows, level)
        if level + 1 < LEVELS:
            # written at each level: a level reads its rows twice, so plans over all levels would double with each
            rows = materialise(_within(rows, at, level), "mix-boundary")
            continue
        found = at.select("source", "at", (F.col("n") < 2 * F.col("left")).alias("take"))
    high = rows.groupBy("source").agg(F.min(F.shiftright("h", 4 * DIGITS)).alias("high"))
    f = found.withColumnRenamed("source", "_s")
    bound = F.shiftleft("high", 4 * DIGITS) + F.col("at") + F.col("take").cast("bigint")
    return high.join(f, F.col("source").eqNullSafe(F.col("_s"))).select("source", bound.alias("bound"))


def _rounds() -> Column:
    whole = F.floor(F.col("target") / F.col("source_size"))
    return F.when(F.col("source_size") > 0, whole).otherwise(F.lit(0)).cast("bigint")


def _rest() -> Column:
    return F.col("target") - _rounds() * F.col("source_size")


def on_source(rows: DataFrame, per_source: DataFrame, source: Column, key: str) -> DataFrame:
    """Rows with their source's row of ``per_source``.

    A table of at most ``FEW_SOURCES`` rows, which is counted, goes to all tasks and the rows stay where they are. A larger one is
    copied to ``SALTS`` salts and the rows are dealt over them, so that a source with a third of all rows is many tasks.
    """
    same = source.eqNullSafe(F.col(key))
    if per_source.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES:
        return rows.join(F.broadcast(per_source), same)
    salted = per_source.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("_lot", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, same & (F.col("_lot") == F.col("_salt"))).drop("_lot", "_salt")


def sizes_of(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(doc_id, source, size, h); words are counted once, all later steps read numbers."""
    sizes = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"),
        key_hash(F.col(id_col), F.col(text_col)).alias("h"),
    )
    return materialise(sizes, "mix-sizes")


def plan_of(sizes: DataFrame, weights: Sequence[float], share: float, limit: float) -> DataFrame:
    """(source, source_size, target, rounds, bound): what each source's documents do."""
    targets = materialise(source_targets(sizes, weights, share, limit), "mix-targets")
    bounds = thresholds(sizes, targets).withColumnRenamed("source", "_s")
    joined = targets.join(bounds, F.col("source").eqNullSafe(F.col("_s")), "left")
    return joined.select("source", "source_size", "target", _rounds().alias("rounds"), F.coalesce("bound", F.lit(0)).alias("bound"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.0,
    limit: float = 3.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """(doc_id, source, h, size, source_size, target, repeats, taken) for every document; taken = repeats x size.

    Sources in order of code points, null last, weigh ``weights``, over and over; together they get ``share`` of all words.
    """
    sizes = sizes_of(docs, id_col, text_col, source_col)
    plan = materialise(plan_of(sizes, weights, share, limit).withColumnRenamed("source", "_s"), "mix-plan")
    repeats = F.col("rounds") + (F.col("h") < F.col("bound")).cast("bigint")
    return on_source(sizes, plan, F.col("source"), "_s").select(
        "doc_id", "source", "h", "size", "source_size", "target", repeats.alias("repeats"), (repeats * F.col("size")).alias("taken")
    )


def take(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.0,
    limit: float = 3.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The documents, all their columns, a row for each time the mix takes them.

    The plan has a row for each source, as each of its documents takes its source's rounds and bound; texts are not shuffled.
    """
    sizes = sizes_of(docs, id_col, text_col, source_col)
    plan = plan_of(sizes, weights, share, limit)
    plan = materialise(plan.select(*[F.col(c).alias(f"_mix_{c}") for c in ("source", "rounds", "bound")]), "mix-plan")
    source, h = F.col(source_col).cast("string"), key_hash(F.col(id_col), F.col(text_col))
    joined = on_source(docs, plan, source, "_mix_source")
    repeats = (F.col("_mix_rounds") + (h < F.col("_mix_bound")).cast("bigint")).cast("int")
    rows = joined.withColumn("_mix_time", F.explode(F.when(repeats > 0, F.sequence(F.lit(1), repeats))))
    return rows.select(*[docs[c] for c in docs.columns])
