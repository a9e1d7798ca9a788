import zlib
from collections import Counter, defaultdict

import pytest

from pyspark.sql import functions as F
from registrylake.llm import rendezvous


def _rows(docs, weights):
    return rendezvous.shard_documents(docs, weights).collect()


def test_sizes_crc_and_gapless_slots(docs_of):
    texts = ["", None, "é", "a" * 50_000, "same", "same", *[f"text {i}" for i in range(200)]]
    rows = _rows(docs_of(texts), [1.0] * 7)
    assert len(rows) == len(texts)
    slots = defaultdict(list)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert r["size"] == len(raw) + 16 and r.text_crc32 == zlib.crc32(raw)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_one_more_shard_takes_rows_only_into_itself(docs_of):
    docs = docs_of([str(i) for i in range(3000)])
    rows = _rows(docs, [1.0] * 10)
    moved = [r for r in rows if r.shard != r.grown_shard]
    assert moved and all(r.grown_shard == 10 for r in moved)
    assert {r.doc_id: r.grown_shard for r in rows} == {r.doc_id: r.shard for r in _rows(docs, [1.0] * 11)}
    assert 0.5 < len(moved) / (3000 / 11) < 1.6
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) < 1.5 * 300 and min(counts.values()) > 0.6 * 300


def test_weights(docs_of):
    counts = Counter(r.shard for r in _rows(docs_of([str(i) for i in range(4000)]), [1.0, 0.0, 3.0]))
    assert counts[1] == 0 and 2.4 < counts[2] / counts[0] < 3.7
    with pytest.raises(ValueError):
        rendezvous.shard_of(F.lit(1), [0.0])


def test_equal_and_null_keys_stay_together(docs_of):
    rows = _rows(docs_of([(None, "a"), (None, "b"), (7, "x"), (7, "y"), (7, "y")]), [1.0] * 5)
    for key in (None, 7):
        assert len({r.shard for r in rows if r.doc_id == key}) == 1
    assert sorted(r.slot for r in rows if r.doc_id == 7)[-1] >= 2


def test_empty_table_and_clashing_columns(docs_of):
    assert _rows(docs_of([]), [1.0]) == []
    docs = docs_of(["a", "b"]).withColumns({"shard": F.lit("x"), "slot": F.lit("y"), "_bucket": F.lit(0), "size": F.lit(-1)})
    assert sorted(r["size"] for r in _rows(docs, [1.0])) == [17, 17]
