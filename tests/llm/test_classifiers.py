import random
import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F
from registrylake.llm import indexing, zstdclass

SYLLABLES = ["ta", "ri", "mon", "el", "su", "ka", "ven", "do", "li", "per", "os", "an"]


def _prose(rng, n):
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def _sentences(words):
    return ". ".join(" ".join(words[i : i + 9]).capitalize() for i in range(0, len(words), 9)) + "."


def _corpus(n=900, seed=0):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words, quality, toxic = _prose(rng, rng.randint(20, 150)), 1, 0
        if i % 5 == 1:
            quality, kind = 0, rng.randrange(3)
            text = [" ".join(w.upper() + "!!" for w in words), " | ".join(words), " ".join(w for w in words[:15] for _ in range(12))][kind]
        else:
            if i % 7 == 2:
                toxic = 1
                for _ in range(3 + len(words) // 12):
                    words.insert(rng.randrange(len(words)), rng.choice(["fozzbag", "grubnik", "zwerpish"]))
            text = _sentences(words)
        rows.append((i, text))
        labels.append((i, quality, toxic))
    return rows, labels


def _held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def _labels(spark, labels):
    return spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_quality_of_held_out_rows(spark, docs_of):
    rows, labels = _corpus()
    scores = {r.doc_id: r.score for r in indexing.score_quality(docs_of(rows), _labels(spark, labels)).collect()}
    held = [(scores[i] >= 0.5, q == 1) for i, q, _ in labels if _held(i)]
    assert len(held) > 200 and np.mean([a == b for a, b in held]) > 0.95
    kept = {r.doc_id for r in indexing.keep_good(docs_of(rows), _labels(spark, labels)).collect()}
    assert kept == {i for i, s in scores.items() if s >= 0.5}


def test_toxicity_of_held_out_rows(spark, docs_of):
    rows, labels = _corpus(1200, 3)
    scores = {r.doc_id: r.score for r in zstdclass.score_toxicity(docs_of(rows), _labels(spark, labels)).collect()}
    held = [(scores[i] >= 0.7, t == 1) for i, _, t in labels if _held(i)]
    found = [a for a, b in held if b]
    wrong = [a for a, b in held if not b]
    assert len(found) > 30 and np.mean(found) > 0.85 and np.mean(wrong) < 0.02


def test_held_out_labels_are_never_used(spark, docs_of):
    rows, labels = _corpus(300, 5)
    turned = [(i, 1 - q, 1 - t) if _held(i) else (i, q, t) for i, q, t in labels]
    for score in (indexing.score_quality, zstdclass.score_toxicity):
        one, two = ({r.doc_id: r.score for r in score(docs_of(rows), _labels(spark, x)).collect()} for x in (labels, turned))
        assert one == pytest.approx(two, abs=1e-12)


@pytest.mark.parametrize("score", [indexing.score_quality, zstdclass.score_toxicity])
def test_odd_rows_and_labels(spark, docs_of, score):
    rows, labels = _corpus(120, 8)
    odd = [(900, None), (901, ""), (902, "word " * 60_000), (903, "\x00 � 🙂"), (None, "no id"), (7, "other text"), (7, "other text")]
    docs = docs_of(rows + odd).withColumns({"score": F.lit("x"), "features": F.lit("y"), "y": F.lit(1), "size": F.lit(2)})
    more = [(900, 1, 0), (901, None, None), (0, 1, 0), (0, 0, 1), (None, 1, 1), (5555, 1, 0)]
    found = score(docs, _labels(spark, labels + more)).collect()
    assert len(found) == len(rows + odd) and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id == 7 and r.row_hash != found[0].row_hash}) <= 2
    assert score(docs_of([]), _labels(spark, labels)).collect() == []


def test_labels_of_one_kind_or_none(spark, docs_of):
    rows, _ = _corpus(30)
    good = [(i, 1, 1) for i in range(30)]
    assert {r.score for r in indexing.score_quality(docs_of(rows), _labels(spark, good)).collect()} == {1.0}
    assert {r.score for r in indexing.score_quality(docs_of(rows), _labels(spark, [])).collect()} == {0.5}
    assert {r.score for r in zstdclass.score_toxicity(docs_of(rows), _labels(spark, good)).collect()} == {1.0}
    assert {r.score for r in zstdclass.score_toxicity(docs_of(rows), _labels(spark, [])).collect()} == {0.0}


def test_neighbour_counts_equal_a_plain_count():
    texts = [b"A bb cc. dd", b"", b"one one 22 x", b"z"]
    words, shapes, ends = indexing.word_codes(texts)
    counts = np.zeros((indexing.WORD_BUCKETS + indexing.SHAPE_BUCKETS, indexing.SHAPE_BUCKETS), np.int64)
    indexing.neighbour_counts(words, shapes, ends, counts)
    want = np.zeros_like(counts)
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        for i in range(a, b):
            for j in range(max(a, i - 2), min(b, i + 3)):
                if i != j:
                    want[words[i], shapes[j]] += 1
                    want[indexing.WORD_BUCKETS + shapes[i], shapes[j]] += 1
    assert np.array_equal(counts, want)
    assert indexing.shape("The,") == "Aa," and indexing.shape("24!!") == "0!" and shapes[5] == indexing.REPEATED


def test_windows_hold_the_whole_text():
    text = zstdclass.normal("Some words, and " + "x" * 300 + " more!! " * 50)
    assert b"".join(zstdclass.cut(text)).split() == text.split()
    assert zstdclass.cut(b"") == [b"  "]
