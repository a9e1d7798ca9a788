from collections import defaultdict

from pyspark.sql import functions as F
from registrylake.llm import mixing


def _water_fill(sizes, weights, limit):
    """Reshare the excess of full sources by weight until none is above its limit."""
    target, full, budget = {}, set(), float(sum(sizes.values()))
    while True:
        left = budget - sum(limit * sizes[s] for s in full)
        open_ = {s: w for s, w in weights.items() if s not in full}
        target = {s: left * w / sum(open_.values()) for s, w in open_.items()}
        over = {s for s, t in target.items() if t > limit * sizes[s]}
        if not over:
            return target | {s: limit * sizes[s] for s in full}
        full |= over


def _corpus():
    rows, n = [], 0
    for source, count, words in (("b", 300, 7), ("a", 40, 3), (None, 200, 11), ("d", 500, 2), ("é", 3, 1)):
        for _ in range(count):
            rows.append((n, "w " * (words + n % 5), source))
            n += 1
    return rows


def test_targets_and_what_is_taken(docs_of):
    rows = mixing.mix(docs_of(_corpus())).collect()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    largest = defaultdict(int)
    for r in rows:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r["size"])
        assert 0 <= r.taken <= 3 * r["size"] and r.taken == r.repeats * r["size"]
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    want = _water_fill(sizes, weights, 3.0)
    for s in order:
        assert abs(target[s] - want[s]) < 1e-6 * max(1.0, want[s])
        assert abs(taken[s] - target[s]) <= largest[s]


def test_reruns_and_copies_agree(docs_of):
    docs = docs_of(_corpus() + _corpus()[:50])
    one, two = (sorted((r.doc_id, r.taken) for r in mixing.mix(d).collect()) for d in (docs, docs.repartition(5)))
    assert one == two
    by_id = defaultdict(set)
    for doc_id, taken in one:
        by_id[doc_id].add(taken)
    assert all(len(v) == 1 for v in by_id.values())


def test_take_repeats_rows_and_keeps_columns(docs_of):
    docs = docs_of(_corpus()).withColumn("h", F.lit("kept")).withColumn("size", F.lit(1))
    rows = mixing.take(docs).collect()
    want = {(r.doc_id): r.repeats for r in mixing.mix(docs).collect()}
    got = defaultdict(int)
    for r in rows:
        got[r.doc_id] += 1
        assert r.h == "kept"
    assert {k: v for k, v in want.items() if v} == got
    assert set(rows[0].asDict()) == set(docs.columns)


def test_empty_texts_sources_and_tables(docs_of):
    rows = mixing.mix(docs_of([(1, None, "x"), (2, "", "x"), (3, "a b", "y")])).collect()
    found = {r.doc_id: (r["size"], r.source_size, r.target, r.taken) for r in rows}
    assert found == {1: (0, 0, 0.0, 0), 2: (0, 0, 0.0, 0), 3: (2, 2, 2.0, 2)}
    assert mixing.mix(docs_of([])).collect() == []
    assert [r.target for r in mixing.mix(docs_of([(1, None, None), (2, " \n", "a")])).collect()] == [0.0, 0.0]


def test_one_document_larger_than_the_rest(docs_of):
    rows = mixing.mix(docs_of([(1, "w " * 9000, "a"), (2, "w", "a"), (3, "w w", "b")])).collect()
    assert len(rows) == 3 and all(r.taken <= 3 * r["size"] for r in rows)


def test_rows_of_one_id_are_taken_one_by_one(docs_of):
    rows = [(1, " ".join([f"t{i}"] * 6), "a") for i in range(300)] + [(1000 + i, "one two three", "b") for i in range(600)]
    got = mixing.mix(docs_of(rows), (1.0, 1.1)).where("source = 'a'").collect()
    assert abs(sum(r.taken for r in got) - got[0].target) <= 6


def test_many_sources_meet_their_plan_over_salts(docs_of, monkeypatch):
    rows = [(i, "w " * (i % 7), f"s{i % 9}" if i % 3 else "hot") for i in range(400)] + [(999, "w", None)]
    few = sorted(map(tuple, mixing.mix(docs_of(rows)).collect()), key=repr)
    monkeypatch.setattr(mixing, "FEW_SOURCES", 3)
    assert sorted(map(tuple, mixing.mix(docs_of(rows)).collect()), key=repr) == few


def test_the_plan_of_thresholds_does_not_double_with_each_level(docs_of):
    sizes = mixing.sizes_of(docs_of(_corpus()), "doc_id", "text", "source")
    bounds = mixing.thresholds(sizes, mixing.source_targets(sizes, (5, 2, 1), 1.0, 3.0))
    assert bounds._jdf.queryExecution().optimizedPlan().toString().count("Relation") <= 4
