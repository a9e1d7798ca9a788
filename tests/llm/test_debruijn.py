import hashlib
import random
from collections import Counter

import pytest

from pyspark.sql import functions as F
from registrylake.llm import debruijn


def _brute_force(texts, span):
    docs = [(t or "").encode().split() for t in texts]
    count = Counter(tuple(w[i : i + span]) for w in docs for i in range(len(w) - span + 1))
    out = []
    for words in docs:
        gone = set()
        for i in range(len(words) - span + 1):
            if count[tuple(words[i : i + span])] > 1:
                gone.update(range(i, i + span))
        kept = [w for i, w in enumerate(words) if i not in gone]
        out.append((len(words), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def _check(docs, texts, span):
    rows = sorted(debruijn.remove_repeats(docs, span).collect(), key=lambda r: r.doc_id)
    assert [(r.n_words, r.n_removed, r.kept_sha256) for r in rows] == _brute_force(texts, span)


def _texts(seed, words, lengths=(0, 160)):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(20, 90))] for _ in range(6)]
    texts = []
    for _ in range(80):
        out = [rng.choice(vocabulary) for _ in range(rng.randint(*lengths))]
        for _ in range(rng.randint(0, 2)):
            passage = rng.choice(passages)
            a = rng.randrange(len(passage))
            at = rng.randint(0, len(out))
            out[at:at] = passage[a : a + rng.randint(5, 90)]
        texts.append(rng.choice([" ", "\n", "  "]).join(out))
    return texts


@pytest.mark.parametrize(("span", "words", "seed"), [(35, 2000, 1), (35, 3, 2), (12, 2, 3), (11, 5, 4), (20, 40, 5)])
def test_removal_equals_brute_force(docs_of, span, words, seed):
    texts = _texts(seed, words)
    _check(docs_of(texts), texts, span)


def test_repeats_inside_one_text_and_copies(docs_of):
    texts = ["und " * 200, "a b c " * 100, None, "", " \n", "x " * 34, "x " * 35, "x " * 36, "same words " * 30, "same words " * 30]
    texts += ["\xa0 \x1c " * 50, " ".join(f"long{i}" for i in range(40_000)), " ".join(f"long{i}" for i in range(20_000, 20_060))]
    _check(docs_of(texts), texts, 35)


def test_full_bitmaps_do_not_change_the_result(docs_of, monkeypatch):
    monkeypatch.setattr(debruijn, "BITMAP_BITS", 6)
    texts = _texts(8, 50)
    _check(docs_of(texts), texts, 35)


def test_rows_of_one_id_and_clashing_columns(docs_of):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(1, passage), (1, "other"), (1, passage), (None, "start " + passage)]
    docs = docs_of(rows).withColumns({"first": F.lit("x"), "anchor": F.lit("y"), "n": F.lit("z"), "_hash": F.lit(1)})
    found = sorted((r.doc_id or 0, r.n_words, r.n_removed, r.text) for r in debruijn.remove_repeats(docs).collect())
    assert found == [(0, 41, 40, "start"), (1, 1, 0, "other"), (1, 40, 40, ""), (1, 40, 40, "")]


def test_empty_table(docs_of):
    assert debruijn.remove_repeats(docs_of([])).collect() == []
    with pytest.raises(ValueError):
        debruijn.remove_repeats(docs_of([]), 5)


def test_many_equal_rows_have_one_set_of_runs(docs_of):
    """Rows of one id and text: as many as there are, each loses its repeats, and their runs are not multiplied."""
    text = " ".join(f"w{i}" for i in range(80))
    docs = docs_of([(1, text)] * 400 + [(2, "other " * 3)])
    rows = debruijn.remove_repeats(docs).collect()
    assert len(rows) == 401 and all(r.n_removed == (80 if r.doc_id == 1 else 0) for r in rows)
    spans = debruijn.repeated_windows(docs.select("doc_id", "text", F.xxhash64("text").alias("_hash")))
    kept = spans.groupBy("doc_id", "_hash").agg(F.collect_set(F.struct("first", "n", "bits")).alias("runs")).collect()
    assert len(kept) == 1 and len(kept[0].runs) <= 80
