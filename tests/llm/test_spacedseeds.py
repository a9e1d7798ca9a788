import random

import numpy as np

from pyspark.sql import functions as F
from registrylake.llm import spacedseeds

VOCABULARY = [f"w{i}" for i in range(4000)]


def _text(rng, n):
    return [rng.choice(VOCABULARY) for _ in range(n)]


def _overlaps(doc, item):
    """Brute force: at any shift, a run of enough aligned words of which enough are equal."""
    need = min(spacedseeds.MIN_WORDS, len(item))
    for shift in range(-len(item) + 1, len(doc)):
        equal = [doc[i] == item[i - shift] for i in range(max(0, shift), min(len(doc), len(item) + shift))]
        for i in range(len(equal)):
            for j in range(i + need, len(equal) + 1):
                if sum(equal[i:j]) >= spacedseeds.MIN_SHARE * (j - i) - 1e-9:
                    return True
    return False


def _corpus():
    rng = random.Random(7)
    items = [(100 + i, " ".join(_text(rng, rng.randint(15, 40)))) for i in range(8)]
    docs = []
    for i in range(60):
        words = _text(rng, rng.randint(5, 120))
        if i % 3 == 0:
            passage = rng.choice(items)[1].split()
            passage = passage[: rng.randint(10, len(passage))]
            for _ in range(len(passage) * (i % 4) // 10):
                passage[rng.randrange(len(passage))] = rng.choice(VOCABULARY)
            at = rng.randrange(len(words))
            words[at:at] = passage
        docs.append((i, " ".join(words)))
    return docs, items


def _bench(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


def test_marks_equal_brute_force(spark, docs_of):
    docs, items = _corpus()
    rows = {r.doc_id: r for r in spacedseeds.mark_contaminated(docs_of(docs), _bench(spark, items)).collect()}
    for i, text in docs:
        want = sorted(k for k, item in items if _overlaps(text.split(), item.split()))
        assert rows[i].item_ids == want and rows[i].contaminated == bool(want), (i, rows[i], want)


def test_case_and_punctuation_do_not_hide(spark, docs_of):
    item = "Alpha beta gamma, delta epsilon zeta eta theta iota kappa lambda my ny xi omikron pi"
    docs = [(1, "before " + item.upper().replace(",", " !!") + " after"), (2, item.replace("zeta", "other")), (3, item[:40])]
    rows = {r.doc_id: r.contaminated for r in spacedseeds.mark_contaminated(docs_of(docs), _bench(spark, [(1, item)])).collect()}
    assert rows == {1: True, 2: True, 3: False}


def test_odd_rows(spark, docs_of):
    rng = random.Random(1)
    item = " ".join(_text(rng, 20))
    docs = [(1, None), (2, ""), (3, " ".join(_text(rng, 30_000)) + " " + item), (4, item), (4, "clean"), (4, item), (None, item), (5, "a b")]
    docs = docs_of(docs).withColumns({"item_id": F.lit("x"), "_hash": F.lit("y"), "hash": F.lit(1)})
    bench = _bench(spark, [(1, item), (1, item), (2, None), (3, ""), (4, "too short"), (None, item)])
    rows = spacedseeds.mark_contaminated(docs, bench).collect()
    assert sorted((r.doc_id or 0, r.contaminated) for r in rows) == [
        (0, True), (1, False), (2, False), (3, True), (4, False), (4, True), (4, True), (5, False)
    ]
    kept = spacedseeds.clean(docs, bench)
    assert set(kept.columns) == set(docs.columns)
    assert sorted((r.doc_id, r.text) for r in kept.where("doc_id > 3").collect()) == [(4, "clean"), (5, "a b")]


def test_empty_tables(spark, docs_of):
    docs = docs_of(["a b c " * 10])
    assert [r.contaminated for r in spacedseeds.mark_contaminated(docs, _bench(spark, [])).collect()] == [False]
    assert spacedseeds.mark_contaminated(docs_of([]), _bench(spark, [(1, "a b")])).collect() == []


def test_longest_overlap():
    doc, item = np.array([9, 1, 2, 3, 8, 5, 6, 9]), np.array([1, 2, 3, 4, 5, 6])
    assert spacedseeds.longest_overlap(doc, item, 1) == (6, 5, 1)
    assert spacedseeds.longest_overlap(doc, item, 50) == (0, 0, 0)


def test_no_pattern_of_the_rule_hides_from_the_masks():
    """The fewest substitutions that hide a run of every length from all masks are more than the rule allows."""
    width = max(map(len, spacedseeds.SEEDS))
    masks = [(int(m, 2), len(m)) for m in spacedseeds.SEEDS]
    fewest = {(0, 0): 0}  # (last words equal or not, how many of them) -> substitutions so far
    for length in range(1, 300):
        longer = {}
        for (bits, n), cost in fewest.items():
            for equal in (0, 1):
                now, seen = (bits << 1 | equal) & ((1 << width) - 1), min(n + 1, width)
                if not any(seen >= size and now & m == m for m, size in masks):
                    key = (now & ((1 << width - 1) - 1), min(seen, width - 1))
                    longer[key] = min(longer.get(key, 1 << 30), cost + 1 - equal)
        fewest = longer
        if length >= spacedseeds.MIN_WORDS:
            assert min(fewest.values(), default=1 << 30) > length // 5, length


def test_pieces_of_short_items():
    for n in range(1, spacedseeds.MIN_WORDS):
        parts = spacedseeds.pieces_of(n)
        assert [w for x, k in parts for w in range(x, x + k)] == list(range(n)) and len(parts) == n // 5 + 1


def test_short_items_equal_brute_force(spark, docs_of):
    rng = random.Random(9)
    items = [(n, " ".join(_text(rng, n))) for n in range(1, 20)]
    docs = []
    for n, item in items:
        for wrong in range(4):
            words = item.split()
            for at in rng.sample(range(n), min(n, wrong)):
                words[at] = "zz"
            docs.append((10 * n + wrong, " ".join(_text(rng, 5) + words + _text(rng, 5))))
    rows = {r.doc_id: r.item_ids for r in spacedseeds.mark_contaminated(docs_of(docs), _bench(spark, items)).collect()}
    assert rows == {i: sorted(k for k, item in items if _overlaps(text.split(), item.split())) for i, text in docs}
