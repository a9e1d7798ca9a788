import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F
from registrylake.llm import repair
from registrylake.llm.tokens import Encoder
from registrylake.session import scratch_path


def _row(ids):
    first, rules, lengths, seq = repair.compress(np.array(ids, np.int32))
    as_bytes = lambda x: x.astype("<u4").tobytes()
    return {"first_rule": first, "rules": as_bytes(rules), "lengths": as_bytes(lengths), "sequence": as_bytes(seq)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=400), st.integers(0, 400), st.integers(0, 400))
def test_round_trip_and_spans(ids, a, b):
    row = _row(ids)
    assert repair.decode(row).tolist() == ids
    assert repair.decode_span(row, min(a, b), max(a, b)).tolist() == ids[min(a, b) : max(a, b)]


def test_frequent_pairs_shrink_the_sequence():
    ids = [1, 2, 3, 4, 5, 6, 7, 8] * 500
    row = _row(ids)
    assert len(row["sequence"]) // 4 < len(ids) / 20
    assert max(np.frombuffer(row["lengths"], "<u4")) >= 8


ODD = ["", " ", "  a", "a  b", "a ", "\n b", "\0 a b", "<|endoftext|> a", "don't we're ' s", "a b c", "1 2  3 45", "a.b,c", "a ., b",
       "...", "\n\n", "a\nb\n", "².x", "x́.y", "a　 b", "٣.٣", "a,\n.b", "\r\n a", "日本 語。", "🙂 🙂"]


def test_cut_encoding_is_the_plain_encoding(tokenizer):
    encoder = Encoder(tokenizer)
    ids, sizes = encoder.encode(ODD)
    assert [p.tolist() for p in np.split(ids, np.cumsum(sizes)[:-1])] == [encoder.whole(t).tolist() for t in ODD]


def test_ids_are_those_of_the_plain_call(tokenizer):
    from tokenizers import Tokenizer

    texts = [*ODD, "end <|endoftext|> start", "a.<|endoftext|><|endoftext|>", "<|endoftext|>", "<|endoftext |> b", "\0<|endoftext|>"]
    plain = Tokenizer.from_file(tokenizer)
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    ids, sizes = Encoder(tokenizer).encode(texts)
    assert [p.tolist() for p in np.split(ids, np.cumsum(sizes)[:-1])] == want
    assert want[len(ODD)] == [437, 220, 50256, 923]


def test_counts_of_leaves_are_those_of_the_plain_call(tokenizer):
    from registrylake.llm.editcount import cut_leaves

    encoder = Encoder(tokenizer)
    for text in ["word <|endoftext|> " * 200, "some <|endoftext|>. more " * 100 + "<|endoftext|>"]:
        leaves = cut_leaves(text)
        assert len(leaves) > 2 and sum(encoder.counts(leaves)) == len(encoder.whole(text))


@pytest.mark.parametrize("n", [*range(26), 100_000])
def test_small_runs_and_runs_of_one_symbol_end(n):
    for ids in (np.arange(n, dtype=np.uint32), np.full(n, 7, np.uint32), np.arange(n, dtype=np.uint32) % 3):
        first, rules, lengths, seq = repair.compress(ids)
        assert repair.expand(seq, first, rules, lengths).tolist() == ids.tolist()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab .,'\n\t!é1 ", max_size=30), min_size=1, max_size=4))
def test_cut_encoding_of_any_text(texts):
    import public_tokenizers

    from registrylake.llm.tokens import encoder

    encode = encoder(public_tokenizers.path("byte_bpe_50k.json"))
    ids, sizes = encode.encode(texts)
    assert [p.tolist() for p in np.split(ids, np.cumsum(sizes)[:-1])] == [encode.whole(t).tolist() for t in texts]


@pytest.fixture(scope="module")
def written(spark, docs_of, tokenizer):
    texts = [*ODD, None, "the same text " * 900, "the same text " * 900, *[f"row {i} of many" for i in range(100)]]
    rows = [(1000 - i, t) for i, t in enumerate(texts)] + [(500, "twin a"), (500, "twin b"), (500, "twin b")]
    path = scratch_path(spark, "repair-test")
    docs = docs_of(rows).withColumns({"part": F.lit("x"), "shard": F.lit("y")})
    repair.write_shards(docs, path, tokenizer, 2, shard_tokens=300)
    return rows, path


def test_documents_read_back(spark, written, tokenizer):
    rows, path = written
    encoder = Encoder(tokenizer)
    want = sorted((i, zlib.crc32(np.append(encoder.whole(t or ""), 2).astype("<u4").tobytes())) for i, t in rows)
    found = sorted(repair.read_documents(spark, path).collect(), key=lambda r: r.start)
    assert sorted((r.doc_id, r.ids_crc32) for r in found) == want
    assert [r.doc_id for r in found] == sorted(i for i, _ in rows)
    start = 0
    for r in found:
        assert r.start == start
        start += r.n_tokens


def test_span_of_a_shard(spark, written):
    row = max(spark.read.parquet(written[1]).collect(), key=lambda r: r.n_tokens).asDict()
    ids = repair.decode(row)
    assert len(ids) == row["n_tokens"] == sum(row["doc_tokens"])
    assert repair.decode_span(row, 17, 251).tolist() == ids[17:251].tolist()


def test_empty_table(spark, docs_of, tokenizer):
    path = scratch_path(spark, "repair-empty")
    repair.write_shards(docs_of([]), path, tokenizer, 2)
    assert repair.read_documents(spark, path).collect() == []
