"""Token-id output under Re-Pair grammar compression.

Documents are put in ascending key order, encoded, and cut into shards of consecutive documents. In each shard frequent
pairs of neighbouring ids are replaced by nonterminals, over and over, the most frequent first: a round takes all pairs
above a falling threshold at once, of overlapping pairs the more frequent. A shard is one row of the output files:

* ``part``, ``shard``: its place in the order; ``first_token``: ids of the part before it; ``n_tokens``
* ``doc_ids``, ``doc_tokens``: its documents and how many ids each has
* ``first_rule``: the smallest nonterminal; ``rules``: two symbols for each; ``lengths``: ids each expands to
* ``sequence``: the compressed shard. Symbols and lengths are little-endian unsigned 32-bit integers.

The expansion lengths let a reader decode any run of ids without the rest (``decode_span``).

Defined results: a null text is empty, an empty text has the end id only; documents with equal keys come in an order given by
their text; a null key comes first; a document longer than a shard is a shard of its own; an empty table gives no shards.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from registrylake.llm.text import pieces, small_batches
from registrylake.llm.tokens import encoder

SHARD_TOKENS = 1 << 20
MIN_PAIRS = 8  # a rule costs about what eight replacements save
FALL = 12  # from one round to the next the threshold falls to a twelfth
WORTH = 20  # at the lowest threshold rounds go on while each takes away a twentieth
TABLE_BITS = 18
ROW = (
    "part int, shard int, first_token bigint, n_tokens bigint, doc_ids array<{id}>, doc_tokens array<bigint>, "
    "first_rule bigint, rules binary, lengths binary, sequence binary"
)


def _slots(pairs: np.ndarray) -> np.ndarray:
    return ((pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int32)


def _chosen(place: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and ranks of the candidates that are replaced: the best first, none that overlaps a better one that is; of a run every other place.

    ``place`` is ascending; candidates at neighbouring places overlap. A lower rank is a more frequent pair.
    """
    winners = []
    while len(place):
        touch = place[1:] == place[:-1] + 1
        left, right = rank[:-1], rank[1:]
        won = np.ones(len(place), bool)
        won[1:] &= ~touch | (right < left)
        won[:-1] &= ~touch | (left <= right)
        run = np.flatnonzero(touch & (left == right))
        if len(run):  # pairs of one symbol overlap themselves
            new = np.ones(len(place), bool)
            new[run + 1] = False
            at = np.arange(len(place), dtype=np.int32)
            start = np.maximum.accumulate(np.where(new, at, 0))
            inner = run + 1
            even = inner[(inner - start[inner]) % 2 == 0]
            better = np.ones(len(place), bool)
            better[1:] &= ~touch | (right <= left)
            better[:-1] &= ~touch | (left <= right)
            won[even] = better[even]
        winners.append((place[won], rank[won]))
        # what neither won nor overlaps a winner is looked at again
        rest = ~won
        rest[1:] &= ~(touch & won[:-1])
        rest[:-1] &= ~(touch & won[1:])
        place, rank = place[rest], rank[rest]
    return np.concatenate([p for p, _ in winners]), np.concatenate([r for _, r in winners])


def compress(ids: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(first rule, rules as pairs, expansion lengths, sequence) of a run of ids.

    Pairs are counted in a table by hash. Of pairs that share a slot one is looked at in a round; the others wait.
    """
    first = int(ids.max()) + 1 if len(ids) else 0
    seq = ids.astype(np.int64)
    rules, lengths, n_rules = [], [], 0
    size = np.ones(first, np.int64)
    least = None
    while len(seq) > 1:
        before = len(seq)
        pairs = (seq[:-1] << 32) | seq[1:]
        slot = _slots(pairs)
        seen = np.bincount(slot, minlength=1 << TABLE_BITS)
        least = max(MIN_PAIRS, int(seen.max()) // FALL) if least is None else max(MIN_PAIRS, least // FALL)
        place = np.flatnonzero((seen >= least)[slot])
        pairs, slot = pairs[place], slot[place]
        held = np.zeros(1 << TABLE_BITS, np.int64)
        held[slot] = pairs
        same = held[slot] == pairs
        place, slot = place[same], slot[same]
        counts = np.bincount(slot, minlength=1 << TABLE_BITS)
        often = np.flatnonzero(counts >= least)
        if len(often):
            often = often[np.argsort(-counts[often], kind="stable")]
            order = np.full(1 << TABLE_BITS, -1, np.int32)
            order[often] = np.arange(len(often))
            rank = order[slot]
            place, rank = place[rank >= 0], rank[rank >= 0]
            place, rank = _chosen(place, rank)
            used = np.flatnonzero(np.bincount(rank, minlength=len(often)) >= 2)
            number = np.full(len(often), -1, np.int64)
            number[used] = first + n_rules + np.arange(len(used))
            number = number[rank]
            place, number = place[number >= 0], number[number >= 0]
            pair = held[often[used]]
            rules.append(np.stack([pair >> 32, pair & 0xFFFFFFFF], axis=1))
            lengths.append(size[rules[-1]].sum(axis=1))
            size = np.concatenate([size, lengths[-1]])
            n_rules += len(used)
            seq[place] = number
            keep = np.ones(len(seq), bool)
            keep[place + 1] = False
            seq = seq[keep]
        # a round that takes nothing away ends it too, also where a twentieth is no whole symbol
        if least == MIN_PAIRS and (len(seq) == before or len(seq) > before - before // WORTH):
            break
    rule_table = np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)
    return first, rule_table, (np.concatenate(lengths) if lengths else np.zeros(0, np.int64)), seq


def _opened(seq: np.ndarray, first: int, rules: np.ndarray) -> np.ndarray:
    """Open the nonterminals of ``seq`` pass by pass; rules only name earlier symbols."""
    while True:
        open_ = seq >= first
        if not open_.any():
            return seq
        at = np.arange(len(seq)) + np.cumsum(open_) - open_
        out = np.empty(len(seq) + int(open_.sum()), np.int64)
        pair = rules[seq[open_] - first]
        out[at[~open_]] = seq[~open_]
        out[at[open_]], out[at[open_] + 1] = pair[:, 0], pair[:, 1]
        seq = out


def expand(seq: np.ndarray, first: int, rules: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ids that symbols stand for: every rule is opened once, then each symbol is looked up."""
    if not len(seq):
        return np.zeros(0, np.uint32)
    opened = _opened(np.arange(first, first + len(rules)), first, rules)
    flat = np.concatenate([np.arange(first), opened]).astype(np.uint32)
    size = np.concatenate([np.ones(first, np.int64), lengths])
    start = np.cumsum(size) - size
    n = size[seq]
    ends = np.cumsum(n)
    return flat[np.repeat(start[seq] - (ends - n), n) + np.arange(ends[-1])]


def _u32(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u4").astype(np.int64)


def decode(row: dict) -> np.ndarray:
    """All ids of a shard."""
    return expand(_u32(row["sequence"]), row["first_rule"], _u32(row["rules"]).reshape(-1, 2), _u32(row["lengths"]))


def decode_span(row: dict, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` (exclusive) of a shard; only the symbols that cover them, and the rules below those, are opened."""
    seq, first = _u32(row["sequence"]), row["first_rule"]
    size = np.concatenate([np.ones(first, np.int64), _u32(row["lengths"])])
    ends = np.cumsum(size[seq])
    start, stop = max(start, 0), min(stop, int(ends[-1]) if len(ends) else 0)
    if start >= stop:
        return np.zeros(0, np.uint32)
    a, b = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left")
    skip = start - (int(ends[a - 1]) if a else 0)
    ids = _opened(seq[a : b + 1], first, _u32(row["rules"]).reshape(-1, 2)).astype(np.uint32)
    return ids[skip : skip + stop - start]


def _shard(part: int, number: int, done: int, ids: list, keys: list, counts: list) -> dict:
    flat = np.concatenate(ids)
    first, rules, lengths, seq = compress(flat)
    as_bytes = lambda x: x.astype("<u4").tobytes()
    return {
        "part": part, "shard": number, "first_token": done, "n_tokens": len(flat), "doc_ids": keys, "doc_tokens": counts,
        "first_rule": first, "rules": as_bytes(rules), "lengths": as_bytes(lengths), "sequence": as_bytes(seq),
    }


def encode_shards(
    docs: DataFrame, tokenizer: str, end_id: int, shard_tokens: int = SHARD_TOKENS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per shard, as described above."""
    small_batches(docs.sparkSession)
    # a null text is read as an empty one; length and hash order documents with equal keys, and split such a key
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    order = ["doc_id", "_size", "_hash"]
    rows = rows.withColumns({"_size": F.length("text"), "_hash": F.xxhash64("text")})
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text", F.spark_partition_id().alias("part"))
    schema = ROW.format(id=docs.select(id_col).schema[0].dataType.simpleString())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        target = None
        ids, keys, counts, held, done, number, part = [], [], [], 0, 0, 0, 0
        for piece in pieces(batches):
            part = piece.column("part")[0].as_py()
            flat, sizes = encode.encode(piece.column("text").to_pylist())
            ends = np.cumsum(sizes)
            with_end = np.insert(flat, ends, end_id)
            ends = ends + np.arange(1, len(ends) + 1)
            key_list, first = piece.column("doc_id").to_pylist(), 0
            while first < len(ends):
                base = int(ends[first - 1]) if first else 0
                last = max(int(np.searchsorted(ends, base + shard_tokens - held, side="right")), first + (held == 0))
                if last > first:
                    ids.append(with_end[base : ends[last - 1]])
                    keys += key_list[first:last]
                    counts += np.diff(np.concatenate([[base], ends[first:last]])).tolist()
                    held += int(ends[last - 1]) - base
                first = last
                if first < len(ends):
                    yield pa.RecordBatch.from_pylist([_shard(part, number, done, ids, keys, counts)], target or _arrow(schema))
                    done, number, held, ids, keys, counts = done + held, number + 1, 0, [], [], []
        if held:
            yield pa.RecordBatch.from_pylist([_shard(part, number, done, ids, keys, counts)], target or _arrow(schema))

    return placed.mapInArrow(run, schema)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string(), "smallint": pa.int16()}
    fields = []
    for field in schema.split(", "):
        name, kind = field.split(" ")
        inner = kind.removeprefix("array<").removesuffix(">")
        fields.append(pa.field(name, pa.list_(kinds[inner]) if kind.startswith("array<") else kinds[kind]))
    return pa.schema(fields)


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int, **options) -> None:
    """The compressed shards as Parquet files; Spark's writer makes a task's file appear only once the task has ended."""
    encode_shards(docs, tokenizer, end_id, **options).write.option("compression", "zstd").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, part, shard) of every document, from its ids decoded out of the files."""
    shards = spark.read.parquet(path)
    id_type = shards.schema["doc_ids"].dataType.elementType.simpleString()
    schema = f"part int, shard int, doc_id {id_type}, place bigint, n_tokens bigint, ids_crc32 bigint"
    target = _arrow(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = decode(row).astype("<u4", copy=False)
                counts = np.array(row["doc_tokens"], np.int64)
                ends = np.cumsum(counts)
                if int(ends[-1]) != len(ids):
                    raise ValueError(f"shard {row['part']}/{row['shard']}: {len(ids)} ids, {ends[-1]} named")
                crc = [zlib.crc32(ids[e - c : e]) for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
                n = len(counts)
                columns = [
                    pa.array(np.full(n, row["part"], np.int32)), pa.array(np.full(n, row["shard"], np.int32)),
                    pa.array(row["doc_ids"], target.field("doc_id").type), pa.array(row["first_token"] + ends - counts),
                    pa.array(counts), pa.array(crc, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=target)

    found = shards.mapInArrow(run, schema)
    # one number per part, so the unpartitioned window sees as many rows as the writer had tasks
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("part").alias("_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    return found.join(offsets, F.col("part") == F.col("_part")).select(
        "doc_id", (F.col("_before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", "part", "shard"
    )
