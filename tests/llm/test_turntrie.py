import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from pyspark.sql import functions as F
from registrylake.llm import turntrie
from registrylake.llm.queries import op12_turn_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _brute(convs):
    """Nodes of {conv_id: [(role, text), ...]}, each computed on its own."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, ids in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m[: len(n)] == n and len(m) > len(n) for m in below)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        ends = ",".join(str(c) for c in sorted(ids) if len(convs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(ids), len(node), parent, len(ids), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def _spliced(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def _corpus(seed, n, longest):
    rng = random.Random(seed)
    convs = {}
    for c in rng.sample(range(3 * n), n):
        # every third conversation is the same one, many begin alike
        turns = [("user", "hot")] * 4 if c % 3 == 0 else [(rng.choice("ua"), "t" * rng.randint(0, 2)) for _ in range(rng.randint(1, longest))]
        convs[c] = ([("user", "first é")] if c % 2 else []) + turns
    return convs


def _table(spark, convs):
    rows = [(c, i, role, text) for c, turns in convs.items() for i, (role, text) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def _rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("shard_turns", [1, 7, 1 << 20])
def test_trie_equals_brute_force(spark, shard_turns):
    for seed in (3, 4):
        convs = _corpus(seed, 90, 6)
        found = turntrie.trie(turntrie.encode_turns(_table(spark, convs)), shard_turns, chunk_ids=5)
        assert _rows(found) == _brute(convs)


def test_chains_over_shards(spark):
    """Every conversation goes on from the one before it, so each shard ends in the middle of a path."""
    convs = {i: [("u", "x")] * i for i in range(1, 30)} | {100 + i: [("u", "x")] * i + [("a", "end")] for i in range(0, 30, 4)}
    assert _rows(turntrie.trie(turntrie.encode_turns(_table(spark, convs)), shard_turns=3)) == _brute(convs)


@pytest.fixture
def many_parts(spark):
    """Every shuffle keeps its partitions, so that shards begin and end at their borders."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def test_nodes_over_parts(spark, many_parts):
    for seed in (5, 6):
        convs = _corpus(seed, 90, 6)
        found = turntrie.trie(turntrie.encode_turns(_table(spark, convs)), shard_turns=20, chunk_ids=5)
        assert _rows(found) == _brute(convs)


def test_query_splices(spark, tmp_path):
    convs = _corpus(8, 80, 12)
    _table(spark, convs).withColumn("number", F.lit("x")).write.parquet(f"{tmp_path}/conversations.parquet")
    found = op12_turn_trie(spark, str(tmp_path))
    assert _rows(found) == _brute(_spliced(convs))


def test_nulls_ties_and_repeated_rows(spark, tmp_path):
    rows = [
        (1, None, None, "b"), (1, None, "u", None), (1, 3, "u", "z"), (1, 3, "u", "a"), (1, 3, "u", "a"),
        (None, 1, "u", "lost"), (2, 1, "", "b"), (2, 2, "u", ""), (3, 5, "u", "x" * 100_000),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    convs = {
        1: [("", "b"), ("u", ""), ("u", "a"), ("u", "a"), ("u", "z")],
        2: [("", "b"), ("u", "")],
        3: [("u", "x" * 100_000)],
    }
    assert _rows(turntrie.trie(turntrie.encode_turns(df))) == _brute(convs)
    assert turntrie.trie(turntrie.encode_turns(df.limit(0))).collect() == []


def test_every_row_is_inserted_once():
    for n in range(40):
        assert sorted(turntrie.medians(n)) == list(range(n))
