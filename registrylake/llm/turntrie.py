"""Prefix trie of conversations, from ternary search trees over dictionary-encoded turns.

1. ``encode_turns``: every different turn (role, text) gets a number, in the order of (role, text). Conversations become
   arrays of numbers; texts are not moved again.
2. ``spliced``: conversations put together from the head of another one and their own rest.
3. Conversations of equal turns become one row (``_distinct``) with its members' count, the smallest one and the hash of all of
   them, so a turn sequence that a third of all conversations share is one row from there on.
4. The rows are sorted by their arrays into range shards. A shard is built into a ternary search tree, the median row first, then
   the medians of both halves, and so on, and walked without recursion: members, children, leaves and savings of each
   node add up on the way back.
5. A node whose conversations lie in several shards is on the first or last path of each of them. Every count that a shard
   reports is a sum of its own share: a node that the row before the shard already has is counted where it began. So the
   shares of such border nodes are simply added (``_merged``); all other nodes are final.

A shard holds ``SHARD_TURNS`` turns at most (a longer conversation is a shard of its own), so a task's memory does not follow its
partition. The turn numbers of one conversation are one row, 8 bytes a turn.

Defined results: a null role or text is empty; turns are ordered by turn, null first, then role and text; a repeated turn row is
another turn; rows without a conversation id belong to none; an empty table gives no nodes, not even the root; a null
turn number only orders. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registrylake.session import materialise

SHARD_TURNS = 1 << 20
CHUNK_IDS = 1 << 14
NO_MEMBERS = hashlib.sha256(b"").hexdigest()


# ---------------------------------------------------------------- conversations as arrays of turn numbers


def encode_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, seq, sizes): the numbers of a conversation's turns in order, and the UTF-8 bytes of their texts."""
    rows = turns.where("conv_id is not null").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    # the length of the role keeps ("a", "bc") and ("ab", "c") apart
    key = F.md5(F.concat_ws(" ", F.octet_length("role"), "role", "text").cast("binary"))
    different = rows.select("role", "text").distinct()
    ordered = different.repartitionByRange("role", "text").sortWithinPartitions("role", "text")
    numbered = ordered.select(key.alias("key"), F.monotonically_increasing_id().alias("number"), F.octet_length("text").alias("size"))
    dictionary = materialise(numbered, "turn-dictionary")  # the numbers depend on the partitions: written once
    placed = rows.select("conv_id", "turn", key.alias("key")).join(dictionary, "key")
    # numbers are in the order of (role, text), so they settle equal turns
    found = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "number", "size"))).alias("t"))
    return found.select("conv_id", F.col("t.number").alias("seq"), F.col("t.size").alias("sizes"))


def spliced(convs: DataFrame, head_of: Column, head_turns: Column, most: int) -> DataFrame:
    """Every conversation as the first ``head_turns`` turns of conversation ``head_of`` and then its own after as many.

    ``most`` bounds ``head_turns``; without the other conversation there is no head.
    """
    own = convs.withColumns({"head": head_of, "n_head": head_turns})
    needed = own.select(F.col("head").alias("conv_id")).distinct()
    heads = convs.join(needed, "conv_id", "left_semi").select(
        F.col("conv_id").alias("head"), F.slice("seq", 1, most).alias("head_seq"), F.slice("sizes", 1, most).alias("head_sizes")
    )

    def put(head: str, rest: str) -> Column:
        start = F.col("n_head").cast("int")
        kept = F.coalesce(F.slice(head, F.lit(1), start), F.array().cast(convs.schema[rest].dataType))
        return F.concat(kept, F.slice(rest, start + 1, F.greatest(F.size(rest), F.lit(0)))).alias(rest)

    return own.join(heads, "head", "left").select("conv_id", put("head_seq", "seq"), put("head_sizes", "sizes"))


# ---------------------------------------------------------------- one row per turn sequence


def _id_text(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Runs of at most ``most`` ids of one key, comma-joined; the rows come sorted by (key, conv_id)."""
    key, ids = None, []

    def out() -> pa.RecordBatch:
        text = ",".join(map(str, ids))
        return pa.RecordBatch.from_pydict({"key": [key], "first": pa.array([ids[0]], pa.int64()), "ids": [text]})

    for batch in batches:
        for k, i in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if ids and (k != key or len(ids) == most):
                yield out()
                ids = []
            key = k
            ids.append(i)
    if ids:
        yield out()


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over all runs of a key in their order, one run in memory at a time."""
    key, state = None, None
    names = ["key", "ends_sha256"]
    for batch in batches:
        keys, hashes = [], []
        for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if k == key:
                state.update(b"," + ids.encode())
                continue
            if key is not None:
                keys.append(key)
                hashes.append(state.hexdigest())
            key, state = k, hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(hashes, pa.string())], names)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], names)


def _distinct(convs: DataFrame, chunk_ids: int) -> DataFrame:
    """(seq, sizes, n, conv_id, ends_sha256): every different sequence, its members' count, the smallest and the hash of all."""
    keyed = materialise(convs.withColumn("key", F.md5(F.concat_ws(",", F.col("seq").cast("array<string>")).cast("binary"))), "conversations")
    rows = keyed.groupBy("key", "seq", "sizes").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"))
    alone = rows.where("n = 1").withColumn("ends_sha256", F.sha2(F.col("conv_id").cast("string").cast("binary"), 256))
    many = rows.where("n > 1")
    members = keyed.select("key", "conv_id").join(many.select("key"), "key")
    members = members.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    runs = members.mapInArrow(lambda b: _id_text(b, chunk_ids), "key string, first bigint, ids string")
    # a run is many ids, so what meets here is a fraction of the members
    hashes = runs.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_hashed, "key string, ends_sha256 string")
    return alone.unionByName(many.join(hashes, "key")).drop("key")


# ---------------------------------------------------------------- trees of shards

NODE = (
    "path binary, parent_path binary, border boolean, conv_id bigint, depth bigint, parent_conv_id bigint, "
    "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
)
_ARROW = pa.schema(
    [
        ("path", pa.binary()), ("parent_path", pa.binary()), ("border", pa.bool_()), ("conv_id", pa.int64()), ("depth", pa.int64()),
        ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
        ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
    ]
)


def shared_head(a: np.ndarray, b: np.ndarray) -> int:
    """How many numbers two sequences share from the start."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


class SearchTree:
    """A ternary search tree: node 0 is the root, the empty sequence; every other node is a turn after its parent.

    ``low`` and ``high`` lead to siblings with smaller and larger numbers, ``mid`` to the first child tried. A node's children
    are the nodes of the binary tree that hangs below its ``mid``.
    """

    def __init__(self):
        self.number, self.low, self.high, self.mid, self.parent, self.depth, self.size = [-1], [0], [0], [0], [-1], [0], [0]

    def insert(self, seq: list[int], sizes: list[int]) -> int:
        """The node at the end of ``seq``."""
        at = 0
        for number, size in zip(seq, sizes, strict=True):
            link, frm, node = self.mid, at, self.mid[at]
            while node and self.number[node] != number:
                link, frm = (self.low, node) if number < self.number[node] else (self.high, node)
                node = link[frm]
            if not node:
                node = link[frm] = len(self.number)
                for column, value in (
                    (self.number, number), (self.low, 0), (self.high, 0), (self.mid, 0), (self.parent, at),
                    (self.depth, self.depth[at] + 1), (self.size, size),
                ):
                    column.append(value)
            at = node
        return at


def medians(n: int) -> Iterator[int]:
    """0 to n - 1, the middle first, then the middles of both halves, and so on."""
    todo = [(0, n)]
    for low, high in todo:  # grows on the way
        if low < high:
            middle = (low + high) // 2
            yield middle
            todo += [(low, middle), (middle + 1, high)]


def _path_hashes(seq: np.ndarray, depth: int) -> list[bytes]:
    """A 160-bit hash of each head of ``seq`` with 0 to ``depth`` turns."""
    state, found = hashlib.blake2b(digest_size=20), []
    for i in range(depth + 1):
        found.append(state.digest())
        if i < depth:
            state.update(int(seq[i]).to_bytes(8, "little", signed=True))
    return found


def _tree_nodes(rows: list[tuple], before: np.ndarray | None) -> pa.RecordBatch:
    """The nodes of one shard, as its shares. ``rows`` are sorted; ``before`` is the sequence before them."""
    tree = SearchTree()
    ends = [0] * len(rows)
    for i in medians(len(rows)):
        ends[i] = tree.insert(rows[i][0].tolist(), rows[i][1].tolist())
    size = len(tree.number)
    n_convs, children, leaves, saved, hashes = [0] * size, [0] * size, [0] * size, [0] * size, [None] * size
    smallest = [np.iinfo(np.int64).max] * size
    for node, (_, _, n, conv_id, sha) in zip(ends, rows, strict=True):
        n_convs[node], smallest[node], hashes[node] = n, conv_id, sha

    def heads(seq: np.ndarray, depth: int) -> list[int]:
        nodes = [0]
        for number in seq[:depth].tolist():
            node = tree.mid[nodes[-1]]
            while tree.number[node] != number:
                node = tree.low[node] if number < tree.number[node] else tree.high[node]
            nodes.append(node)
        return nodes

    first, last = rows[0][0], rows[-1][0]
    known = shared_head(first, before) if before is not None else -1
    begun = heads(first, known) if known >= 0 else []  # nodes that began before this shard
    counted = [1] * size
    for node in begun:
        counted[node] = 0
    if begun and known == len(before):  # it ended the shard before and counted as a leaf there, but goes on here
        leaves[begun[-1]] = -1
    parent = tree.parent
    for node in range(size - 1, -1, -1):  # a node is made after its parent, so this way children come first
        if not tree.mid[node]:
            leaves[node] += 1
        if node:
            up = parent[node]
            saved[node] += (n_convs[node] - counted[node]) * tree.size[node]
            n_convs[up] += n_convs[node]
            smallest[up] = min(smallest[up], smallest[node])
            children[up] += counted[node]
            leaves[up] += leaves[node]
            saved[up] += saved[node]
    parent, smallest = np.array(parent), np.array(smallest)
    border = np.zeros(size, bool)
    path = np.full(size, None, object)
    for seq, nodes in ((first, begun), (last, heads(last, len(last)))):  # a later shard may go on from any node of the last path
        if nodes:
            border[nodes] = True
            path[nodes] = np.array(_path_hashes(seq, len(nodes) - 1), object)
    up = np.maximum(parent, 0)
    below = parent >= 0
    open_ = below & border[up]  # the parent's smallest member is not known yet
    columns = [
        pa.array(path, pa.binary()), pa.array(np.where(open_, path[up], None), pa.binary()), pa.array(border),
        pa.array(smallest), pa.array(tree.depth), pa.array(np.where(open_ | ~below, None, smallest[up]), pa.int64()),
        pa.array(n_convs), pa.array(children), pa.array(leaves), pa.array(saved), pa.array(hashes, pa.string()),
    ]
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def _trees(batches: Iterable[pa.RecordBatch], shard_turns: int) -> Iterator[pa.RecordBatch]:
    """Shard after shard of sorted rows; a row without members is the last one of the part before."""
    part, before, rows, turns = None, None, [], 0
    for batch in batches:
        seqs = batch.column("seq")
        numbers, ends = seqs.flatten().to_numpy(), np.concatenate([[0], np.cumsum(seqs.value_lengths().to_numpy())])
        sizes = batch.column("sizes").flatten().to_numpy()
        parts, n, ids = (batch.column(c).to_pylist() for c in ("part", "n", "conv_id"))
        for i, sha in enumerate(batch.column("ends_sha256").to_pylist()):
            seq, own = numbers[ends[i] : ends[i + 1]], sizes[ends[i] : ends[i + 1]]
            if rows and (parts[i] != part or turns + len(seq) > shard_turns):
                yield _tree_nodes(rows, before)
                before, rows, turns = rows[-1][0], [], 0
            if parts[i] != part:
                part, before = parts[i], None
            if n[i]:
                rows.append((seq, own, n[i], ids[i], sha))
                turns += len(seq)
            else:
                before = seq
    if rows:
        yield _tree_nodes(rows, before)


def _merged(nodes: DataFrame) -> DataFrame:
    """Border nodes with the shares of all shards added."""
    return nodes.where("border").groupBy("path").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent_path").alias("parent_path"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends_sha256").alias("ends_sha256"),  # the one shard that holds the sequence itself has it
    )


def trie(convs: DataFrame, shard_turns: int = SHARD_TURNS, chunk_ids: int = CHUNK_IDS) -> DataFrame:
    """All nodes of the trie of (conv_id, seq, sizes), the root among them.

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    sorted_ = _distinct(convs, chunk_ids).repartitionByRange("seq").withColumn("part", F.spark_partition_id())
    placed = materialise(sorted_, "trie-shards")  # what part a row is in is settled by the written rows
    # one row per part: the last sequence of a part goes before the rows of the next
    last = placed.groupBy("part").agg(F.max("seq").alias("seq")).withColumn("part", F.lead("part").over(Window.orderBy("part")))
    guards = last.where("part is not null").selectExpr(
        "seq", "array_repeat(0, size(seq)) as sizes", "0L as n", "0L as conv_id", "cast(null as string) as ends_sha256", "part"
    )
    both = placed.unionByName(guards).withColumn("real", F.col("n") > 0)
    dealt = both.repartition("part").sortWithinPartitions("part", "real", "seq").drop("real")
    nodes = materialise(dealt.mapInArrow(lambda b: _trees(b, shard_turns), NODE), "trie-nodes")
    border = materialise(_merged(nodes), "trie-border")
    final = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    done = nodes.where("not border and parent_path is null").select(*final)
    parents = border.select(F.col("path").alias("parent_path"), F.col("conv_id").alias("_parent"))
    waiting = nodes.where("not border and parent_path is not null").select("parent_path", *final)
    waiting = waiting.unionByName(border.withColumn("parent_conv_id", F.lit(None).cast("bigint")).select("parent_path", *final))
    found = waiting.join(parents, "parent_path", "left").withColumn("parent_conv_id", F.col("_parent")).select(*final)
    return done.unionByName(found).withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_MEMBERS)))
