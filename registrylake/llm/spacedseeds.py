"""Benchmark decontamination with spaced seeds.

A seed is a fixed mask; its hash at a place takes the words under the ones and ignores the others, so a substituted word
under a zero does not hide an overlap. Hashes of all benchmark places mark a bitmap of fixed size; documents send on only
places whose bit is set, and a join on the hash gives (document, item, shift). At each shift the aligned words are compared:
a document is contaminated if a run of at least ``MIN_WORDS`` aligned words (the whole item, if that is shorter) holds at
least ``MIN_SHARE`` equal ones. Words are compared as letters and digits, case folded.

No overlap of that kind is missed. The four masks are such that a run of ``MIN_WORDS`` or more words needs more substitutions than the
share allows to hide all of them, whatever its length (the test walks through all patterns). An item of fewer words is
cut into one piece more than the substitutions it may have, and one of the pieces is always whole.

Defined results: null and empty texts hold nothing, and an item without words is found nowhere; repeated items and documents each get their own result; rows with equal ids are kept apart by their texts; an empty
benchmark marks nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrylake.llm.text import HashedWords, as_bytes, hash_words, mix, pieces, signed, small_batches
from registrylake.session import materialise

SEEDS = ("1101111", "1111101", "1100010111", "11011000011")
MIN_WORDS = 13
MIN_SHARE = 0.8
PIECE = 100  # a run of n words of a short item counts as mask PIECE + n
BITMAP_BITS = 24  # 2 MB, whatever the size of the benchmark; a fuller bitmap only sends more rows to the join


def normal_form(word: bytes) -> bytes:
    text = word.decode("utf-8", "replace").casefold()
    return (text if text.isalnum() else "".join(c for c in text if c.isalnum())).encode()


WORDS = HashedWords(normal_form)


def seed_hashes(flat: np.ndarray, ends: np.ndarray, seed: str, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, place in ``flat`` and text number of every place where the whole seed lies in one text."""
    n = len(flat) - len(seed) + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    value = np.full(n, number + 1, np.uint64)
    for i, c in enumerate(seed):
        if c == "1":
            value = value * np.uint64(0x9E3779B97F4A7C15) + flat[i : i + n]
    text = np.repeat(np.arange(len(ends) - 1), np.diff(ends))[:n]
    inside = np.arange(n) + len(seed) <= ends[text + 1]
    return mix(value[inside]), np.flatnonzero(inside), text[inside]


def pieces_of(n: int) -> list[tuple[int, int]]:
    """(first word, words) of the pieces of an item of ``n`` words, fewer than MIN_WORDS: at least one has no substitution."""
    count = round(n * (1 - MIN_SHARE) * 100) // 100 + 1
    bounds = [n * i // count for i in range(count + 1)]
    return [(x, y - x) for x, y in zip(bounds, bounds[1:], strict=False)]


def _mask(number: int) -> str:
    return SEEDS[number] if number < PIECE else "1" * (number - PIECE)


def _bit(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITMAP_BITS)).view(np.int64)


def _item_places(items: DataFrame) -> DataFrame:
    """(item_id, mask, place, hash) of all places of the items' masks."""
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            flat, ends = hash_words(as_bytes(piece.column("text")), WORDS)
            size, found = np.diff(ends), []
            for number in range(len(SEEDS)):
                hashes, place, text = seed_hashes(flat, ends, SEEDS[number], number)
                long = size[text] >= MIN_WORDS
                found += zip(text[long].tolist(), [number] * int(long.sum()), (place - ends[text])[long].tolist(), signed(hashes)[long].tolist(), strict=True)
            for i in np.flatnonzero((size > 0) & (size < MIN_WORDS)).tolist():
                for first, words in pieces_of(int(size[i])):
                    own = flat[ends[i] + first : ends[i] + first + words]
                    hashes, _, _ = seed_hashes(own, np.array([0, words]), "1" * words, PIECE + words)
                    found.append((i, PIECE + words, first, int(signed(hashes)[0])))
            at, mask, place, value = zip(*found, strict=True) if found else ((), (), (), ())
            ids = piece.column("item_id").take(pa.array(at, pa.int64()))
            columns = [ids, pa.array(mask, pa.int32()), pa.array(place, pa.int64()), pa.array(value, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["item_id", "mask", "place", "hash"])

    return items.select("item_id", "text").mapInArrow(run, f"item_id {kind}, mask int, place bigint, hash bigint")


def _places(rows: DataFrame, columns: Sequence[str], masks: Sequence[int], bitmap) -> DataFrame:
    """``columns`` of each row with (place, hash) of the masks, where the hash has its bit set."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*columns).schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.unpackbits(np.frombuffer(bitmap.value, np.uint8), bitorder="little").view(bool)
        for piece in pieces(batches):
            flat, ends = hash_words(as_bytes(piece.column("text")), WORDS)
            for number in masks:
                hashes, place, text = seed_hashes(flat, ends, _mask(number), number)
                hit = held[_bit(hashes)]
                hashes, place, text = hashes[hit], place[hit], text[hit]
                if len(hashes):
                    kept = [piece.column(c).take(pa.array(text)) for c in columns]
                    yield pa.RecordBatch.from_arrays(
                        [*kept, pa.array(place - ends[text]), pa.array(signed(hashes))], [*columns, "place", "hash"]
                    )

    return rows.select(*columns, "text").mapInArrow(run, f"{schema}, place bigint, hash bigint")


def _bitmap(places: DataFrame) -> bytes:
    """The benchmark's bits; at most 2^BITMAP_BITS / 64 rows come to the driver."""
    bit = F.shiftrightunsigned("hash", 64 - BITMAP_BITS)
    one = F.expr(f"shiftleft(1L, int(pmod(shiftrightunsigned(hash, {64 - BITMAP_BITS}), 64)))")
    rows = places.groupBy(F.shiftright(bit, 6).cast("int").alias("at")).agg(F.bit_or(one).alias("bits")).collect()
    words = np.zeros((1 << BITMAP_BITS) // 64, "<i8")
    for r in rows:
        words[r["at"]] = r["bits"]
    return words.tobytes()


def longest_overlap(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int]:
    """(words, equal words, first word in the document) of the longest run with MIN_SHARE equal words at this shift."""
    low, high = max(0, shift), min(len(doc), len(item) + shift)
    if high <= low:
        return 0, 0, 0
    equal = doc[low:high] == item[low - shift : high - shift]
    # a run from i to j has enough equal words when the sum of these weights over it is not negative
    weight = np.where(equal, round((1 - MIN_SHARE) * 100), -round(MIN_SHARE * 100))
    total = np.concatenate([[0], np.cumsum(weight)])
    least = np.minimum.accumulate(total)
    start = np.searchsorted(-least, -total, side="left")  # the first i whose sum is not above the one at j
    length = np.arange(len(total)) - start
    end = int(np.argmax(length))
    first = int(start[end])
    return int(length[end]), int(equal[first:end].sum()), low + first


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, _hash, item_id, n_words, n_equal, first_word): verified overlaps, the longest for each document and item.

    ``docs`` has (doc_id, text, _hash), ``benchmark`` (item_id, text).
    """
    small_batches(docs.sparkSession)
    items = materialise(_item_places(benchmark), "seeds")
    masks = sorted(r["mask"] for r in items.select("mask").distinct().collect())  # the seeds, and a few lengths of pieces
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(items))
    hits = _places(docs, ["doc_id", "_hash"], masks, bitmap)
    shifts = (
        hits.join(items.withColumnRenamed("place", "item_place"), "hash")
        .select("doc_id", "_hash", "item_id", (F.col("place") - F.col("item_place")).alias("shift"))
        .groupBy("doc_id", "_hash", "item_id")
        .agg(F.collect_set("shift").alias("shifts"))  # at most one for each word of the two
    )
    found = shifts.withColumnRenamed("doc_id", "_doc")
    found = found.join(docs.withColumnRenamed("_hash", "_h"), (F.col("_h") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_doc")))
    texts = benchmark.select(F.col("item_id").alias("_item"), F.col("text").alias("item_text")).distinct()
    found = found.join(texts, F.col("item_id").eqNullSafe(F.col("_item"))).select("doc_id", "_hash", "item_id", "shifts", "text", "item_text")
    names = {f.name: f.dataType.simpleString() for f in found.schema}
    schema = f"doc_id {names['doc_id']}, _hash bigint, item_id {names['item_id']}, n_words int, n_equal int, first_word int"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            doc, doc_ends = hash_words(as_bytes(piece.column("text")), WORDS)
            item, item_ends = hash_words(as_bytes(piece.column("item_text")), WORDS)
            rows = []
            for i, shifts in enumerate(piece.column("shifts").to_pylist()):
                text, own = doc[doc_ends[i] : doc_ends[i + 1]], item[item_ends[i] : item_ends[i + 1]]
                n, equal, first = max((longest_overlap(text, own, shift) for shift in shifts), key=lambda x: (x[0], x[1], -x[2]))
                rows.append((n >= max(1, min(MIN_WORDS, len(own))), n, equal, first))
            keep = pa.array(np.flatnonzero([r[0] for r in rows]))
            numbers = [pa.array([r[c] for r in rows if r[0]], pa.int32()) for c in (1, 2, 3)]
            kept = [piece.column(c).take(keep) for c in ("doc_id", "_hash", "item_id")]
            yield pa.RecordBatch.from_arrays([*kept, *numbers], ["doc_id", "_hash", "item_id", "n_words", "n_equal", "first_word"])

    verified = found.mapInArrow(run, schema)
    best = F.max(F.struct("n_words", "n_equal", (-F.col("first_word")).alias("first"))).alias("b")
    return verified.groupBy("doc_id", "_hash", "item_id").agg(best).select(
        "doc_id", "_hash", "item_id", "b.n_words", "b.n_equal", (-F.col("b.first")).alias("first_word")
    )


def mark_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """Per document: doc_id, text_hash, contaminated, item_ids (ascending), n_words (of the longest overlap)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("_hash", F.xxhash64("text"))
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
    found = overlaps(rows, items).groupBy("doc_id", "_hash")
    found = found.agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("n_words").alias("n_words"))
    found = found.withColumnsRenamed({"doc_id": "_doc", "_hash": "_h"})
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_hash") == F.col("_h"))
    kind = found.schema["item_ids"].dataType.simpleString()
    return rows.select("doc_id", "_hash").join(found, same, "left").select(
        "doc_id", F.col("_hash").alias("text_hash"), F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast(kind)).alias("item_ids"), F.coalesce("n_words", F.lit(0)).alias("n_words"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all their columns, without the contaminated ones."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("_hash", F.xxhash64("text"))
    items = benchmark.select("item_id", "text")
    bad = overlaps(rows, items).select(F.col("doc_id").alias("_doc"), F.col("_hash").alias("_h")).distinct()
    same = F.col(id_col).eqNullSafe(F.col("_doc")) & (F.xxhash64(text_col) == F.col("_h"))
    return docs.join(bad, same, "left_anti")
