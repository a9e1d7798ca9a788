"""Sharding by rendezvous hashing: every record goes to the weighted shard that scores lowest for its key.

The score of shard s for a key is -ln(u) / weight(s), where u is a number in (0, 1) drawn from md5(key, s). A record's
shard depends on its key and the shards only; a new shard takes records only into itself, a removed one gives up only its own.
Everything is a DataFrame expression; the only shuffle moves (key, numbers), never texts.

Defined results: a null key is a key of its own; rows with equal keys share a shard; a null text has no bytes and the crc32
of none (0); a shard of weight 0 gets nothing; an empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PARTS = 4  # one md5 holds four numbers of 32 bits
BUCKET_DIGITS = 3


def _digits(text: Column, first: int, n: int) -> Column:
    return F.conv(F.substring(text, first, n), 16, 10).cast("bigint")


def _key_text(key: Column) -> Column:
    return F.coalesce(key.cast("string"), F.lit("null"))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0, 1, ...) with the lowest score; ties go to the lower number."""
    scored = [s for s, w in enumerate(weights) if w > 0]
    if not scored:
        raise ValueError("no shard has a positive weight")
    text = _key_text(key)
    # the digests are named once, so that each is computed once per row
    digests = F.array(*[F.md5(F.concat(text, F.lit(f"/{c}")).cast("binary")) for c in range(max(scored) // PARTS + 1)])

    def best(found: Column) -> Column:
        options = [
            F.struct(
                (-F.log((_digits(found[s // PARTS], 8 * (s % PARTS) + 1, 8) + F.lit(0.5)) / F.lit(2.0**32)) / F.lit(float(weights[s]))).alias("score"),
                F.lit(s).alias("shard"),
            )
            for s in scored
        ]
        return F.array_min(F.array(*options))["shard"]

    return F.transform(F.array(digests), best)[0].cast("int")


def bucket_of(key: Column) -> Column:
    """Part of the order inside a shard; by it the numbering is spread over many tasks."""
    return _digits(F.md5(F.concat(_key_text(key), F.lit("/slot")).cast("binary")), 1, BUCKET_DIGITS).cast("int")


def number_within(df: DataFrame, group: str, bucket: str, order: Sequence[str], out: str) -> DataFrame:
    """Add ``out``: 0, 1, ... within each group in the order (bucket, order), without a group in one task."""
    inner = Window.partitionBy(group, bucket).orderBy(*order)
    numbered = df.withColumn("_place", F.row_number().over(inner).cast("bigint") - 1)
    counts = df.groupBy(group, bucket).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(group, bucket, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return numbered.join(starts, [group, bucket]).select(*df.columns, (F.col("_start") + F.col("_place")).alias(out))


def shard_documents(docs: DataFrame, weights: Sequence[float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, grown_shard): ``grown_shard`` is the shard with one more of weight 1."""
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    key = F.col(id_col)
    rows = docs.select(
        key.alias("doc_id"),
        (F.length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        shard_of(key, weights).alias("shard"),
        shard_of(key, [*weights, 1.0]).alias("grown_shard"),
        bucket_of(key).alias("_bucket"),
    )
    numbered = number_within(rows, "shard", "_bucket", ["doc_id", "text_crc32", "size"], "slot")
    return numbered.select("doc_id", "size", "text_crc32", "shard", "slot", "grown_shard")
