import math
import random
import re

import pytest

from registrylake.llm import maxsketch
from registrylake.llm.queries import op13_max_sketch_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _brute(docs, items, k=10):
    """All scores, as the contract says them."""
    found = [(d, _terms(t)) for d, t in docs]
    n_docs, total = sum(bool(t) for _, t in found), sum(len(t) for _, t in found)
    df = {}
    for _, terms in found:
        for t in set(terms):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for d, terms in found:
            m = 25 + (75 * len(terms) * n_docs) // total if terms else 0
            score = 0
            for t in _terms(text):
                tf = terms.count(t)
                if tf:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, -1 if d is None else d, d))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def _corpus(seed):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.5)) % 300}" for _ in range(400)] + ["É", "Ünï", "naïve", "A1"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60))) + rng.choice(["", ". x-Y", "\x00"])) for i in range(150)]
    docs += [(1000 + i, docs[3][1]) for i in range(40)]  # equal texts, ranked by id
    docs += [(7, "other text w1 w2"), (None, docs[3][1]), (8, None), (9, ""), (10, "..."), (11, "w1 w5 " * 20_000), (11, "w1 w5 " * 20_000)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 20)))) for i in range(25)] + [(90, docs[3][1]), (91, None), (92, "unseen"), (93, "")]
    return docs, items


def _rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.mark.parametrize("coordinates, block_items", [(1 << 16, 1000), (64, 10)])
def test_equals_brute_force(spark, docs_of, coordinates, block_items):
    """With few coordinates nearly all terms share one: bounds get loose, results stay."""
    docs, items = _corpus(5)
    index = maxsketch.build_index(docs_of(docs), coordinates=coordinates)
    found = maxsketch.search(index, spark.createDataFrame(items, "item_id bigint, text string"), first=3, block_items=block_items)
    assert _rows(found) == _brute(docs, items)


def test_query(spark, docs_of, tmp_path):
    docs, items = _corpus(6)
    docs_of(docs).selectExpr("*", "1 AS n", "'x' AS h1", "'y' AS item_id").write.parquet(f"{tmp_path}/documents.parquet")
    items = spark.createDataFrame([*items, *items[:3]], "item_id bigint, text string").selectExpr("*", "1 AS rank", "2 AS doc_id")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    assert _rows(op13_max_sketch_search(spark, str(tmp_path))) == _brute(docs, _corpus(6)[1])


def test_empty_tables(spark, docs_of):
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert maxsketch.search(maxsketch.build_index(docs_of([])), items).collect() == []
    assert maxsketch.search(maxsketch.build_index(docs_of([(1, None), (2, "")])), items).collect() == []
    assert maxsketch.search(maxsketch.build_index(docs_of([(1, "a")])), items.limit(0)).collect() == []
