"""Ranked lexical search over hashed max-sketches.

Building the index reads every text once. A document's sketch is a vector of ``2**16`` coordinates, stored sparse: each
term falls on a coordinate by its hash, and a coordinate holds the *largest* number of occurrences of any term on it. What a
term adds to a score grows with its occurrences, so a coordinate bounds what any term on it can add. Beside the sketches the
index holds the document frequency of every term; it does not depend on the queries.

A search takes its items in blocks of bounded size, and each block goes over the sketches of all documents:

1. the sketches give an upper bound of every (item, document) score, a batch of documents against all items at once; the
   ``FIRST`` documents of the highest bounds per item are scored exactly on their texts;
2. the k-th best of these exact scores is the item's threshold. Every other document whose bound reaches it is scored
   exactly too; the rest cannot be among the k best. So the result is exact whatever the hashes do.

Terms are the maximal runs of characters other than ASCII ones that are no letter or digit, only A-Z lower-cased. Scores follow
``part`` and ``weight``: whole numbers, so they are the same on every machine.

Defined results: a null or empty text has no terms, is counted nowhere and is found by no item; each row is a document, so
equal rows all take ranks; of equal scores the smaller doc_id is first, a null one before all; an item without terms, or
without a document that holds one, gives no rows; equal rows of items are one item, items of one id with different texts
are ranked apart; an empty table of documents or items gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registrylake.llm.text import HashedWords, as_bytes, pieces, small_batches
from registrylake.session import materialise

COORDINATES = 1 << 16
FIRST = 50  # documents per item that are scored exactly to find its threshold
BLOCK_ITEMS = 1000
BLOCK_BYTES = 1 << 20  # of item texts in a block; a longer item is a block of its own
DENSE_CELLS = 1 << 21  # cells of the dense part of a batch: coordinates of the block x documents
HELD_TERMS = 200_000  # a memory bound: counts of so many terms are handed on, and counting starts anew
_LETTERS = bytes(c for c in range(128) if chr(c).isalnum())
_FOLD = bytes(ord(chr(c).lower()) if c in _LETTERS else c if c >= 128 else 32 for c in range(256))

SKETCH = "h1 bigint, h2 bigint, n bigint, coords binary, tops binary, term binary, df bigint"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def part(tf, m):
    """What one term adds for each unit of its weight, by its occurrences in a document of length norm ``m``."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def length_norm(n, n_docs: int, n_terms: int):
    return 25 + (75 * n * n_docs) // n_terms


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text) with the key of a row in two 64-bit hashes; equal rows have equal keys."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit("row"), "doc_id", "text")})


def _sketches(batches: Iterable[pa.RecordBatch], coordinates: int) -> Iterator[pa.RecordBatch]:
    hashes, df = HashedWords(), Counter()
    names = ["h1", "h2", "n", "coords", "tops", "term", "df"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]

    def frequencies() -> pa.RecordBatch:
        size = len(df)
        nothing = [pa.nulls(size, k) for k in kinds[:5]]
        out = pa.RecordBatch.from_arrays([*nothing, pa.array(list(df), pa.binary()), pa.array(list(df.values()), pa.int64())], names)
        df.clear()
        return out

    for piece in pieces(batches):
        n, coords, tops = [], [], []
        for text in as_bytes(piece.column("text")):
            counts = Counter(terms_of(text))
            df.update(counts.keys())
            tf = np.fromiter(counts.values(), np.int64, len(counts))
            at = (np.fromiter(map(hashes.__getitem__, counts), np.uint64, len(counts)) % np.uint64(coordinates)).astype(np.int64)
            order = np.argsort(at, kind="stable")
            at, first = np.unique(at[order], return_index=True)
            n.append(int(tf.sum()))
            coords.append(at.astype("<u2").tobytes())
            tops.append((np.maximum.reduceat(tf[order], first) if len(at) else at).astype("<u4").tobytes())
        rows = piece.num_rows
        made = [pa.array(x, k) for x, k in zip((n, coords, tops), kinds[2:5], strict=True)]
        yield pa.RecordBatch.from_arrays([piece.column("h1"), piece.column("h2"), *made, pa.nulls(rows, kinds[5]), pa.nulls(rows, kinds[6])], names)
        if len(hashes) > HELD_TERMS:
            hashes.clear()
        if len(df) > HELD_TERMS:
            yield frequencies()
    if df:
        yield frequencies()


class Index(NamedTuple):
    docs: DataFrame  # doc_id, text, h1, h2
    sketches: DataFrame  # h1, h2, n, coords, tops: one row per document with terms
    frequencies: DataFrame  # term, df
    n_docs: int
    n_terms: int
    coordinates: int


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", coordinates: int = COORDINATES) -> Index:
    """``coordinates``, at most 2**16, settles how close the bounds are; results do not depend on it."""
    small_batches(docs.sparkSession)
    keyed = _keyed(docs, id_col, text_col)
    written = materialise(keyed.select("h1", "h2", "text").mapInArrow(lambda b: _sketches(b, coordinates), SKETCH), "max-sketches")
    sketches = written.where("n > 0").select("h1", "h2", "n", "coords", "tops")
    frequencies = written.where("term is not null").groupBy("term").agg(F.sum("df").alias("df"))
    n_docs, n_terms = sketches.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    return Index(keyed, sketches, frequencies, n_docs, n_terms, coordinates)


class Block:
    """Items of a block with the weights of their terms: what every task of a pass gets."""

    def __init__(self, index: Index, items: list[list[tuple[bytes, int]]], df: dict[bytes, int]):
        self.n_docs, self.n_terms, self.coordinates = index.n_docs, index.n_terms, index.coordinates
        self.items = [[(t, times * weight(df[t], index.n_docs)) for t, times in terms if t in df] for terms in items]
        hashes = HashedWords()
        at = [np.array([hashes[t] % index.coordinates for t, _ in terms], np.int64) for terms in self.items]
        self.coords = np.unique(np.concatenate([*at, np.zeros(0, np.int64)]))
        self.at = [np.searchsorted(self.coords, a) for a in at]
        self.weights = [np.array([w for _, w in terms], float) for terms in self.items]
        self.batch = max(8, DENSE_CELLS // max(1, len(self.coords)))

    def bounds(self, batch: pa.RecordBatch) -> np.ndarray:
        """Upper bounds of the scores, items x documents of the batch. Rounding of the sums is allowed for."""
        docs = batch.num_rows
        n = batch.column("n").to_numpy(zero_copy_only=False)
        m = length_norm(n, self.n_docs, self.n_terms)
        coords = [np.frombuffer(x, "<u2") for x in batch.column("coords").to_pylist()]
        doc = np.repeat(np.arange(docs), [len(c) for c in coords])
        coords = np.concatenate(coords)
        tops = np.frombuffer(b"".join(batch.column("tops").to_pylist()), "<u4")
        row = np.full(self.coordinates, -1, np.int64)
        row[self.coords] = np.arange(len(self.coords))
        row = row[coords]
        doc, tops, row = doc[row >= 0], tops[row >= 0].astype(np.int64), row[row >= 0]
        dense = np.zeros((len(self.coords), docs))
        dense[row, doc] = part(tops, m[doc])
        return np.stack([np.ceil((w @ dense[a]) * (1 + 1e-12)) for a, w in zip(self.at, self.weights, strict=True)])

    def scores(self, text: bytes, items: list[int]) -> list[int]:
        """Exact scores of one text for some of the items."""
        terms = terms_of(text)
        counts, m = Counter(terms), length_norm(len(terms), self.n_docs, self.n_terms)
        return [sum(w * part(counts[t], m) for t, w in self.items[i] if t in counts) for i in items]


def _slices(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def _highest_bounds(block: Block, sketches: DataFrame, k: int) -> DataFrame:
    """(h1, h2, items): the documents of the ``k`` highest bounds of each item, with these items."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(block.items)
        best, keys = np.zeros((size, 0)), np.zeros((size, 0, 2), np.int64)
        for batch in _slices(batches, block.batch):
            found = block.bounds(batch)
            key = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2")], axis=1)
            best = np.concatenate([best, found], axis=1)
            keys = np.concatenate([keys, np.broadcast_to(key, (size, *key.shape))], axis=1)
            if best.shape[1] > k:
                top = np.argpartition(-best, k - 1, axis=1)[:, :k]
                best, keys = np.take_along_axis(best, top, 1), np.take_along_axis(keys, top[:, :, None], 1)
        item, at = np.nonzero(best > 0)
        columns = [pa.array(item.astype(np.int32)), pa.array(best[item, at]), *(pa.array(keys[item, at, i]) for i in (0, 1))]
        yield pa.RecordBatch.from_arrays(columns, ["item", "bound", "h1", "h2"])

    highest = Window.partitionBy("item").orderBy(F.desc("bound"), "h1", "h2")
    found = sketches.mapInArrow(run, "item int, bound double, h1 bigint, h2 bigint")
    # at most k rows per item of the block
    return found.withColumn("r", F.row_number().over(highest)).where(F.col("r") <= k).groupBy("h1", "h2").agg(F.collect_set("item").alias("items"))


def _reaching(block: Block, sketches: DataFrame, thresholds: np.ndarray) -> DataFrame:
    """(h1, h2, items): every document with the items whose threshold its bound reaches."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, block.batch):
            reached = (block.bounds(batch) >= thresholds[:, None]).T
            some = np.flatnonzero(reached.any(axis=1))
            doc, item = np.nonzero(reached[some])
            ends = np.searchsorted(doc, np.arange(len(some) + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(item.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(some)) for c in ("h1", "h2")), lists], ["h1", "h2", "items"])

    # equal rows have equal keys and equal bounds; the join with the documents brings each of them back
    return sketches.mapInArrow(run, "h1 bigint, h2 bigint, items array<int>").dropDuplicates(["h1", "h2"])


def _rescored(block: Block, index: Index, wanted: DataFrame) -> DataFrame:
    """(item, doc_id, score) of the wanted documents, from their texts; scores of 0 are left out."""
    kind = index.docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            row, item, score = [], [], []
            for i, (text, items) in enumerate(zip(as_bytes(piece.column("text")), piece.column("items").to_pylist(), strict=True)):
                found = [(j, s) for j, s in zip(items, block.scores(text, items), strict=True) if s > 0]
                row += [i] * len(found)
                item += [j for j, _ in found]
                score += [s for _, s in found]
            ids = piece.column("doc_id").take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), ids, pa.array(score, pa.int64())], ["item", "doc_id", "score"])

    texts = index.docs.join(wanted, ["h1", "h2"]).select("doc_id", "text", "items")
    return texts.mapInArrow(run, f"item int, doc_id {kind}, score bigint")


def _best(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _blocks(items: DataFrame, most: int) -> Iterator[list[tuple]]:
    """Items in blocks of bounded size: the driver holds one block at a time."""
    held, size = [], 0
    for row in items.toLocalIterator():
        text = (row.text or "").encode()
        if held and (len(held) >= most or size + len(text) > BLOCK_BYTES):
            yield held
            held, size = [], 0
        held.append((row.item_id, list(Counter(terms_of(text)).items())))
        size += len(text)
    if held:
        yield held


def _search_block(index: Index, items: list[tuple], id_type: str, k: int, first: int) -> DataFrame:
    spark = index.docs.sparkSession
    terms = sorted({t for _, counts in items for t, _ in counts})
    asked = F.broadcast(spark.createDataFrame([(bytearray(t),) for t in terms], "term binary"))  # the terms of one block
    df = {bytes(r.term): r.df for r in index.frequencies.join(asked, "term").collect()}
    block = Block(index, [counts for _, counts in items], df)
    highest = F.broadcast(_highest_bounds(block, index.sketches, max(k, first)))  # at most ``first`` keys per item of the block
    kth = _best(_rescored(block, index, highest), k).where(F.col("rank") == k)
    thresholds = np.ones(len(items))  # with fewer than k scores any positive one counts
    for r in kth.select("item", "score").collect():
        thresholds[r.item] = r.score
    found = _best(_rescored(block, index, _reaching(block, index.sketches, thresholds)), k)
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(items)], f"item int, item_id {id_type}")
    return found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(
    index: Index, items: DataFrame, k: int = 10, first: int = FIRST, block_items: int = BLOCK_ITEMS, item_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item, as the module says."""
    asked = items.select(F.col(item_col).alias("item_id"), F.col(text_col).alias("text")).distinct()
    id_type = asked.schema["item_id"].dataType.simpleString()
    found = [materialise(_search_block(index, block, id_type, k, first), "search") for block in _blocks(asked, block_items)]
    doc_type = index.docs.schema["doc_id"].dataType.simpleString()
    result = items.sparkSession.createDataFrame([], f"item_id {id_type}, rank int, doc_id {doc_type}, score bigint")
    for rows in found:
        result = result.unionByName(rows)
    return result
