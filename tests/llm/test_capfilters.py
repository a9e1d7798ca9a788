import numpy as np

from pyspark.sql import functions as F
from registrylake.llm import capfilters


def _brute_force(rows, least=0.95):
    usable = [i for i, (_, v) in enumerate(rows) if v and None not in v and np.all(np.isfinite(v)) and np.linalg.norm(v) > 0]
    near = {i: {j for j in usable if j != i and len(rows[i][1]) == len(rows[j][1]) and np.dot(rows[i][1], rows[j][1])
                >= least * np.linalg.norm(rows[i][1]) * np.linalg.norm(rows[j][1])} for i in usable}
    out = []
    for i, (ident, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        low = min(rows[j][0] for j in seen)
        out.append((ident, len(near.get(i, ())), low, low == ident))
    return sorted(out)


def _frame(spark, rows):
    return spark.createDataFrame([(i, v) for i, v in rows], "vec_id bigint, embedding array<double>")


def _found(df):
    return sorted(tuple(r) for r in capfilters.link_vectors(df).collect())


def _vectors(n, dims, noise, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 6, dims))
    return [(centres[i % len(centres)] + rng.normal(size=dims) * noise).tolist() for i in range(n)]


def test_links_equal_brute_force(spark):
    rows = list(enumerate(_vectors(300, 64, 0.12)))
    rows += [(300, rows[0][1]), (301, rows[0][1]), (302, (2 * np.array(rows[5][1])).tolist())]
    assert _found(_frame(spark, rows)) == _brute_force(rows)


def test_unusable_vectors_and_lengths(spark):
    v = _vectors(12, 16, 0.05)
    rows = [*enumerate(v), (50, None), (51, []), (52, [0.0] * 16), (53, [float("nan")] + v[0][1:]), (54, [float("inf")] + v[0][1:])]
    rows += [(55, [None, *v[0][1:]]), (56, v[0] + v[0]), (57, v[0] + v[0])]
    found = {r[0]: r for r in _found(_frame(spark, rows))}
    assert all(found[i] == (i, 0, i, True) for i in range(50, 56))
    assert found[57] == (57, 1, 56, False)
    assert [found[i] for i in sorted(found)] == [r for r in _brute_force(rows)]


def test_a_hot_group_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(capfilters, "BLOCK", 40)
    rng = np.random.default_rng(4)
    centre = rng.normal(size=32)
    rows = [(i, (centre + rng.normal(size=32) * 0.05).tolist()) for i in range(150)]
    rows += [(1000 + i, v) for i, v in enumerate(_vectors(60, 32, 0.1, 7))]
    assert _found(_frame(spark, rows)) == _brute_force(rows)


def test_recall_at_the_limit():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(800, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=(800, 64))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    c = 0.95 * a + np.sqrt(1 - 0.95**2) * b
    words = capfilters.codewords_for(1000)
    one, two = (capfilters.decode_lists(x, words, capfilters.threshold_for(words)) for x in (a, c))
    assert np.mean([len(np.intersect1d(p, q)) > 0 for p, q in zip(one, two, strict=True)]) >= 0.95


def test_repeated_and_null_ids_empty_table(spark):
    v = _vectors(6, 8, 0.0)
    df = _frame(spark, [(1, v[0]), (1, v[0]), (2, v[0]), (None, v[0])]).withColumns({"id": F.lit("x"), "copies": F.lit("y")})
    rows = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in capfilters.link_vectors(df).collect())
    assert rows == [(0, 0, None, False), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)]
    assert _found(_frame(spark, [])) == []


def test_recall_at_the_limit_of_large_tables_and_few_dimensions():
    rng = np.random.default_rng(5)
    for n, dims in [(10**6, 64), (10**7, 64), (10**6, 128), (1000, 16), (10**5, 16), (1000, 8), (10**6, 8), (1000, 4), (1000, 3)]:
        words = capfilters.codewords_at(dims, n, 0.95)
        a, b = rng.normal(size=(2, 200, dims))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b -= (a * b).sum(axis=1, keepdims=True) * a
        c = 0.95 * a + np.sqrt(1 - 0.95**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
        one, two = (capfilters.decode_lists(x, words, capfilters.threshold_for(words)) for x in (a, c))
        assert min(map(len, one + two)) > 0, (n, dims)
        assert np.mean([len(np.intersect1d(p, q)) > 0 for p, q in zip(one, two, strict=True)]) >= 0.99, (n, dims)


def test_links_in_few_dimensions_equal_brute_force(spark):
    rows = list(enumerate(_vectors(60, 8, 0.15) + _vectors(60, 2, 0.1) + _vectors(60, 3, 0.1) + _vectors(60, 16, 0.15)))
    assert _found(_frame(spark, rows)) == _brute_force(rows)


def test_equal_ids_of_different_vectors(spark):
    a, b = [1.0, 0.0, 0.0, 0.0, 0.2], [0.0, 1.0, 0.0, 0.3, 0.0]
    near = [1.0, 0.01, 0.0, 0.0, 0.2]
    schema = "vec_id bigint, embedding array<double>"
    got = capfilters.link_vectors(spark.createDataFrame([(1, a), (1, b), (2, near)], schema), 0.95).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 1, True), (1, 1, 1, True), (2, 1, 1, False)]
    got = capfilters.link_vectors(spark.createDataFrame([(1, a), (1, near)], schema), 0.95).collect()
    assert sorted(map(tuple, got)) == [(1, 1, 1, True), (1, 1, 1, True)]
