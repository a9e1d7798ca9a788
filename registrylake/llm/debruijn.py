"""Repeated passages by a compacted de Bruijn graph of word windows.

Every window of ``SPAN`` words is an edge of the graph. Each window has an anchor, the k-mer of half its words in it with the
smallest hash (the first of equals); consecutive windows with the same anchor are a path. Equal windows have equal anchors, so

* an anchor that occurs once has only windows that occur once;
* if all paths of an anchor have the same words, the path does not branch: it is kept whole, and all its windows repeat;
* where paths of an anchor differ, those that occur twice with the same words are kept whole too, and one of each is opened into
  windows: these are counted by (anchor, window), and of the paths that occur once the windows found elsewhere repeat.

A first pass counts anchors; two bitmaps of fixed size let the second pass send on only paths whose anchor may repeat. Joins
on the anchor decide exactly. A path has a number; the windows of opened paths travel as (anchor, window, number and offset), and what
repeats of a path comes back as the bits of one row. So every path goes back to its source coordinates (document, first
word), where paths that touch or overlap grow together into spans, and the words are taken out. Texts without any repeat, as a
third bitmap tells, are finished where they are read; only the others are joined with their spans.

Words are runs of other bytes than space and 0x09 to 0x0D, unchanged. An edge is known by two 64-bit hashes, its anchor's
and its own.

Defined results: null and empty texts have no words; texts shorter than a window lose nothing; equal rows are occurrences of
their own, so a text that is there twice loses all words that a window covers; rows with equal ids are kept apart by
their texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrylake.llm.text import HashedWords, as_bytes, hash_words, mix, pieces, powers, signed, small_batches, windows
from registrylake.session import materialise

SPAN = 35
LEAST_SPAN = 11
PLACE_BITS = 28  # of a packed hash: the place in a piece
BITMAP_BITS = 25  # 4 MB each, whatever the input; fuller bitmaps only send more rows to the joins
HELD_ROWS = 1_000_000
WORD_BITS = 60  # windows of an opened path that one number tells of

_WORDS = HashedWords()


def anchor_words(span: int) -> int:
    return max(1, span // 2)


def _powers_of(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = powers(len(flat) + 1)
    total = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(flat * up[: len(flat)], out=total[1:])
    return total, down


def paths(flat: np.ndarray, ends: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, ...]:
    """(text, first window's place, windows, anchor, content) of every path in the texts."""
    n = len(flat)
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    if n < span:
        return none
    size = anchor_words(span)
    total, down = _powers_of(flat)
    at = np.arange(n - size + 1)
    kmer = mix((total[at + size] - total[at]) * down[at])
    packed = (kmer >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | at.astype(np.uint64)
    # smallest of the k-mers of each window, by doubling
    reach, width = packed, 1
    want = span - size + 1
    while 2 * width <= want:
        reach = np.minimum(reach[:-width], reach[width:])
        width *= 2
    if width < want:
        reach = np.minimum(reach[: len(reach) - (want - width)], reach[want - width :])
    place = np.arange(n - span + 1)
    text = np.repeat(np.arange(len(ends) - 1), np.diff(ends))[: n - span + 1]
    place = place[place + span <= ends[text + 1]]
    if not len(place):
        return none
    text, anchor = text[place], (reach[place] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    start = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (place[1:] != place[:-1] + 1)])
    count = np.diff(np.r_[start, len(place)])
    first = place[start]
    last = first + count + span - 1
    content = mix((total[last] - total[first]) * down[first] + count.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return text[start], first, count, kmer[anchor[start]], content


def _anchor_counts(rows: DataFrame, span: int) -> DataFrame:
    """(anchor, n, same): how many paths each anchor has, and whether all have one content; anchors with two paths or more."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for piece in pieces(batches):
            _, _, _, anchor, content = paths(*hash_words(as_bytes(piece.column("text")), _WORDS), span)
            held.append((anchor, content))
            n += len(anchor)
            if n > HELD_ROWS:
                yield _combined(held)
                held, n = [], 0
        if n:
            yield _combined(held)

    found = rows.select("text").mapInArrow(run, "anchor bigint, n bigint, low bigint, high bigint")
    found = found.groupBy("anchor").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    return found.where("n > 1").select("anchor", (F.col("low") == F.col("high")).alias("same"))


def _combined(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    anchor, content = (signed(np.concatenate(x)) for x in zip(*held, strict=True))
    order = np.argsort(anchor, kind="stable")
    anchor, content = anchor[order], content[order]
    start = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    columns = [anchor[start], np.diff(np.r_[start, len(anchor)]), np.minimum.reduceat(content, start), np.maximum.reduceat(content, start)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "n", "low", "high"])


def _bitmap(hashes: DataFrame, column: str) -> bytes:
    """Bits of the hashes in a column; at most 2^BITMAP_BITS / 64 rows come to the driver."""
    bit = F.shiftrightunsigned(column, 64 - BITMAP_BITS)
    one = F.expr(f"shiftleft(1L, int(pmod(shiftrightunsigned({column}, {64 - BITMAP_BITS}), 64)))")
    rows = hashes.groupBy(F.shiftright(bit, 6).cast("int").alias("at")).agg(F.bit_or(one).alias("bits")).toPandas()
    words = np.zeros((1 << BITMAP_BITS) // 64, np.int64)
    words[rows["at"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return words.tobytes()


def _is_set(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = (64 * len(bitmap)).bit_length() - 1
    bit = hashes >> np.uint64(64 - bits)
    return (bitmap[(bit >> np.uint64(6)).view(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def _occurrences(rows: DataFrame, span: int, repeated: bytes, branching: bytes) -> DataFrame:
    """(doc_id, _hash, first, n, anchor, content, edges): paths whose anchor's bit is set; edges are window hashes where it may branch."""
    bits = rows.sparkSession.sparkContext.broadcast((repeated, branching))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, open_ = (np.frombuffer(b, np.uint64) for b in bits.value)
        for piece in pieces(batches):
            flat, ends = hash_words(as_bytes(piece.column("text")), _WORDS)
            text, first, count, anchor, content = paths(flat, ends, span)
            keep = _is_set(some, anchor)
            text, first, count, anchor, content = text[keep], first[keep], count[keep], anchor[keep], content[keep]
            if not len(text):
                continue
            opened = np.where(_is_set(open_, anchor), count, 0)
            edges, place, _ = windows(flat, ends, span)
            stop = np.cumsum(opened)
            at = np.repeat(np.searchsorted(place, first) - (stop - opened), opened) + np.arange(stop[-1])
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, stop].astype(np.int32)), pa.array(signed(edges[at])))
            rows_at = pa.array(text)
            columns = [
                piece.column("doc_id").take(rows_at), piece.column("_hash").take(rows_at), pa.array((first - ends[text]).astype(np.int32)),
                pa.array(count.astype(np.int32)), pa.array(signed(anchor)), pa.array(signed(content)), lists,
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "_hash", "first", "n", "anchor", "content", "edges"])

    return rows.mapInArrow(run, f"doc_id {kind}, _hash bigint, first int, n int, anchor bigint, content bigint, edges array<bigint>")


def repeated_windows(rows: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, _hash, first, n, bits): windows that all start somewhere else too, from word ``first`` on.

    A path kept whole has its number of windows ``n``; of an opened one ``bits`` tells which of WORD_BITS windows repeat, and n is 0.
    ``rows`` has (doc_id, text, _hash).
    """
    small_batches(rows.sparkSession)
    anchors = materialise(_anchor_counts(rows, span), "anchors")
    found = _occurrences(rows, span, _bitmap(anchors, "anchor"), _bitmap(anchors.where("NOT same"), "anchor"))
    found = materialise(found.withColumn("path", F.monotonically_increasing_id()), "paths")
    columns = ["doc_id", "_hash", "first", "n"]
    # without its bit an anchor does not branch; with it, what follows decides by the words, also where the bit is set by chance
    whole = found.where("size(edges) = 0").join(anchors.where("same").select("anchor"), "anchor").select(*columns)
    open_ = found.where("size(edges) > 0")
    contents = open_.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("times"), F.min("path").alias("one"))
    contents = materialise(contents, "content-counts")  # beside a written table Spark splits the rows of one content
    told = open_.join(contents, ["anchor", "content"]).withColumn("edges", F.when(F.col("path") == F.col("one"), F.col("edges")))
    told = materialise(told.select("path", *columns, "anchor", "times", "edges"), "contents")
    copies = told.where("times > 1").select(*columns)
    # one path of each content: its windows, and how often they occur with it
    offsets = span - anchor_words(span) + 1  # windows of a path at most
    edges = told.select("anchor", "times", "path", F.posexplode("edges").alias("at", "edge"))
    edges = edges.select("anchor", "edge", "times", (F.col("path") * offsets + F.col("at")).alias("ref"))
    several = edges.groupBy("anchor", "edge").agg(F.sum("times").alias("times")).where("times > 1").select("anchor", "edge")
    at = F.pmod("ref", F.lit(offsets))
    alone = edges.where("times = 1").select("anchor", "edge", "ref").join(several, ["anchor", "edge"])
    single = alone.select(F.expr(f"ref div {offsets}").alias("path"), at.cast("int").alias("at"))
    single = single.groupBy("path", F.expr(f"cast(at div {WORD_BITS} as int)").alias("part")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, at % {WORD_BITS})")).alias("bits")
    )
    opened = told.where("times = 1").select("path", "doc_id", "_hash", "first").join(single, "path")
    opened = opened.select("doc_id", "_hash", (F.col("first") + F.col("part") * WORD_BITS).alias("first"), F.lit(0).alias("n"), "bits")
    return whole.unionByName(copies).withColumn("bits", F.lit(0).cast("bigint")).unionByName(opened)


def _covered(n_words: int, first: np.ndarray, n: np.ndarray, bits: np.ndarray, span: int) -> np.ndarray:
    """Which words the windows cover."""
    edge = np.zeros(n_words + 1, np.int64)
    whole = n > 0
    row, at = np.nonzero((bits[~whole, None] >> np.arange(WORD_BITS)) & 1)
    start = np.concatenate([first[whole], first[~whole][row] + at])
    stop = np.concatenate([first[whole] + n[whole], first[~whole][row] + at + 1]) + span - 1
    np.add.at(edge, start, 1)
    np.add.at(edge, stop, -1)
    return np.cumsum(edge[:-1]) > 0


def remove_repeats(docs: DataFrame, span: int = SPAN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_words, n_removed, kept_sha256): the words that no repeated window covers, joined by one space."""
    if span < LEAST_SPAN:
        raise ValueError(f"a window has at least {LEAST_SPAN} words")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("_hash", F.xxhash64("text"))
    # equal rows have equal runs: as a set a document has at most one for each of its words
    runs = repeated_windows(rows, span).groupBy("doc_id", "_hash").agg(F.collect_set(F.struct("first", "n", "bits")).alias("runs"))
    runs = materialise(runs, "runs").withColumnsRenamed({"doc_id": "_doc", "_hash": "_h"})
    held = rows.sparkSession.sparkContext.broadcast(_bitmap(runs, "_h"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, text string, n_words bigint, n_removed bigint, kept_sha256 string"

    def may_have_runs(batch: pa.RecordBatch) -> np.ndarray:
        return _is_set(np.frombuffer(held.value, np.uint64), batch.column("_hash").to_numpy().view(np.uint64))

    def some(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.take(pa.array(np.flatnonzero(may_have_runs(batch))))

    def finished(piece: pa.RecordBatch, runs_of: Iterable) -> pa.RecordBatch:
        texts, total, gone, digests = [], [], [], []
        for text, runs in zip(as_bytes(piece.column("text")), runs_of, strict=True):
            words = text.split()
            total.append(len(words))
            if runs is not None and runs.is_valid:
                first, n, bits = (runs.values.field(c).to_numpy().astype(np.int64) for c in ("first", "n", "bits"))
                covered = _covered(len(words), first, n, bits, span)
                words = [w for w, c in zip(words, covered.tolist(), strict=True) if not c]
            kept = b" ".join(words)
            gone.append(total[-1] - len(words))
            texts.append(kept.decode("utf-8", "replace"))
            digests.append(hashlib.sha256(kept).hexdigest())
        columns = [piece.column("doc_id"), pa.array(texts, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "n_words", "n_removed", "kept_sha256"])

    def without(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            rest = piece.take(pa.array(np.flatnonzero(~may_have_runs(piece))))
            if rest.num_rows:
                yield finished(rest, [None] * rest.num_rows)

    def taken_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            yield finished(piece, piece.column("runs"))

    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_hash") == F.col("_h"))
    texts = rows.mapInArrow(some, f"doc_id {kind}, text string, _hash bigint")
    joined = texts.join(runs, same, "left").select("doc_id", "text", "runs").mapInArrow(taken_out, out)
    return rows.mapInArrow(without, out).unionByName(joined)
