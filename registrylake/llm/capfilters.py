"""Near-duplicate vectors by spherical-cap filters with structured random product codes.

A filter is a direction; a vector passes it if their product is above a threshold or among its ``NEAREST`` largest of a
rotation: products of unit vectors have thinner tails than the Gaussian the threshold is taken from, so a threshold alone
leaves vectors without a filter. The directions are product codes: after a random rotation the space is cut in two halves, and every pair of a codeword of the first and one of the second half is a
filter. List decoding finds all filters that a vector passes from its products with the codewords alone: a codeword of
one half can be skipped when even the best one of the other half does not lift the sum over the threshold. Vectors that share a
filter are compared exactly; several rotations make it likely that similar vectors share one. In few dimensions many
codewords are finer than the cap of similar vectors; there are as many as keep the expected recall of pairs at the
limit, which is the same for all of them, as rotations are random, at ``RECALL`` at least.

Equal vectors are first brought to one representative with a multiplicity. A vector is sent once for each first-half
codeword of its filters, and groups above ``BLOCK`` rows are cut into pairs of blocks, so a task's memory is bounded. A
pair counts only in the smallest filter both pass, so links are counted once without writing pairs down. A task
gives counts and, as links, each vector with the smallest one it is connected to there.

Defined results: null, zero, empty vectors and vectors with null or non-finite components link with nothing; vectors of
different lengths are never compared; rows with equal ids are rows of their own that link when their vectors do; a null id is
never a class id.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrylake.llm.links import classes
from registrylake.session import materialise

ROTATIONS = 4
LISTED = 60  # filters a vector would pass on average, over all rotations, were its halves equally long
NEAREST = 15  # filters of a rotation that every vector passes at least
RECALL = 0.999  # of pairs at the limit
TRIALS = 300  # random pairs at the limit that the recall is taken from
LEAST_CODEWORDS = 256
BLOCK = 1024
PRODUCTS_AT_ONCE = 1 << 22  # a memory bound: products with the codewords of a half that are held together
ROUNDING = 1e-9


def codewords_for(n: int) -> int:
    """Codewords of a half: the filters of a rotation are about as many as the vectors."""
    c = LEAST_CODEWORDS
    while c * c < n:
        c *= 2
    return c


def threshold_for(codewords: int) -> float:
    if LISTED >= ROTATIONS * codewords**2:
        return -np.inf
    return NormalDist().inv_cdf(1 - LISTED / (ROTATIONS * codewords**2))


def _code(dims: int, rotation: int, codewords: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A rotation and the codewords of both halves, scaled so that a product with a unit vector has variance 1."""
    rng = np.random.default_rng([dims, rotation, codewords])
    turn, _ = np.linalg.qr(rng.normal(size=(dims, dims)))
    halves = []
    for size in (dims // 2, dims - dims // 2):
        words = rng.normal(size=(codewords, size))
        halves.append(words / np.maximum(np.linalg.norm(words, axis=1, keepdims=True), 1e-300) * np.sqrt(size))
    return turn, halves[0], halves[1]


_CODES: dict[tuple, tuple] = {}


def decode_lists(vectors: np.ndarray, codewords: int, threshold: float) -> list[np.ndarray]:
    """For each unit vector the numbers of all filters it passes, ascending: (rotation, first half, second half) as one number."""
    n, dims = vectors.shape
    found: list[list[np.ndarray]] = [[] for _ in range(n)]
    for rotation in range(ROTATIONS):
        key = (dims, rotation, codewords)
        if key not in _CODES:
            _CODES[key] = _code(*key)
        turn, first, second = _CODES[key]
        turned = vectors @ turn
        one, two = turned[:, : dims // 2] @ first.T, turned[:, dims // 2 :] @ second.T
        cuts = np.minimum(threshold, _nearest(one, two))
        for i in range(n):
            a, b, cut = one[i], two[i], cuts[i]
            x, y = np.flatnonzero(a >= cut - b.max() - ROUNDING), np.flatnonzero(b >= cut - a.max() - ROUNDING)
            p, q = np.nonzero(a[x][:, None] + b[y] >= cut)
            found[i].append((rotation * codewords + x[p]) * codewords + y[q])
    return [np.concatenate(parts) for parts in found]


def _nearest(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """For each row the NEAREST-th largest sum of a product of the first and one of the second half (the least of all, if fewer)."""
    some = min(NEAREST, one.shape[1])
    a, b = (np.partition(x, -some, axis=1)[:, -some:] for x in (one, two))
    sums = (a[:, :, None] + b[:, None, :]).reshape(len(a), -1)
    at = max(0, sums.shape[1] - NEAREST)
    return np.partition(sums, at, axis=1)[:, at]


def expected_recall(dims: int, codewords: int, least: float) -> float:
    """The share of pairs at the limit that share a filter; rotations are independent, so each of them is a trial."""
    rng = np.random.default_rng([dims, codewords])
    one, other = (_rows_of_length_one(rng.normal(size=(TRIALS, dims))) for _ in range(2))
    other = _rows_of_length_one(other - (one * other).sum(axis=1, keepdims=True) * one)
    other = least * one + np.sqrt(max(0.0, 1 - least**2)) * other
    hits = 0
    for i in range(0, TRIALS, 50):
        both = [decode_lists(x[i : i + 50], codewords, threshold_for(codewords)) for x in (one, other)]
        hits += sum(len(np.unique(np.intersect1d(p, q) // codewords**2)) for p, q in zip(*both, strict=True))
    return 1 - (1 - hits / (TRIALS * ROTATIONS)) ** ROTATIONS


def codewords_at(dims: int, n: int, least: float) -> int:
    """The codewords for ``n`` vectors of ``dims`` components: fewer than ``codewords_for`` where these would miss pairs at the limit."""
    if dims < 4:  # a half of one component has two directions: all vectors pass all filters
        return 2
    codewords = codewords_for(n)
    while codewords > 2 and expected_recall(dims, codewords, least) < RECALL:
        codewords //= 2
    return codewords


def _rows_of_length_one(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300)


def _unit(column: pa.Array) -> np.ndarray:
    return _rows_of_length_one(np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1))


def _send(vectors: DataFrame, codewords_of: dict[int, int]) -> DataFrame:
    """A row for every (vector, first-half codeword of one of its filters)."""
    schema = "dims int, head bigint, id bigint, copies bigint, vector array<double>, filters array<bigint>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column("vector").to_pylist()], np.int64)
            for dims in np.unique(sizes):
                rows = batch.take(pa.array(np.flatnonzero(sizes == dims)))
                codewords = codewords_of[int(dims)]
                step = min(1000, max(1, PRODUCTS_AT_ONCE // codewords))
                for first in range(0, rows.num_rows, step):
                    part = rows.slice(first, step)
                    lists = decode_lists(_unit(part.column("vector")), codewords, threshold_for(codewords))
                    heads = [np.unique(f // codewords) for f in lists]
                    at = pa.array(np.repeat(np.arange(len(heads)), [len(h) for h in heads]))
                    if not len(at):
                        continue
                    columns = [
                        pa.array(np.full(len(at), dims, np.int32)), pa.array(np.concatenate(heads)), part.column("id").take(at),
                        part.column("copies").take(at), part.column("vector").take(at), pa.array(lists, pa.list_(pa.int64())).take(at),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["dims", "head", "id", "copies", "vector", "filters"])

    return vectors.mapInArrow(run, schema)


def _in_blocks(sent: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with (a, b): the pair of blocks of their group to be compared; groups of one block have (0, 0)."""
    blocks = sent.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(F.least("own", o).alias("a"), F.greatest("own", o).alias("b")),
    )
    rows = sent.join(blocks, keys).withColumn("own", own).withColumn("pair", F.explode(pairs))
    return rows.select("*", "pair.a", "pair.b").drop("pair", "blocks")


def _roots(linked: np.ndarray) -> np.ndarray:
    """For each member the smallest place it is connected to."""
    label = np.arange(len(linked))
    while True:
        near = np.where(linked, label, len(label)).min(axis=1)
        new = np.minimum(label, near)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _compare(table: pa.Table, codewords_of: dict[int, int], least: float) -> pa.Table:
    codewords = codewords_of[table.column("dims")[0].as_py()]
    head, cross = table.column("head")[0].as_py(), table.column("a")[0] != table.column("b")[0]
    table = table.sort_by("id").combine_chunks()
    ids, copies = table.column("id").to_numpy(), table.column("copies").to_numpy()
    vectors, block = _unit(table.column("vector").combine_chunks()), table.column("own").to_numpy()
    lists = [np.asarray(f, np.int64) for f in table.column("filters").to_pylist()]
    lengths = [len(f) for f in lists]
    row, code = np.repeat(np.arange(len(ids)), lengths), np.concatenate(lists)
    here = code // codewords == head
    cells, members = code[here], row[here]
    order = np.argsort(cells, kind="stable")
    cells, members = cells[order], members[order]
    links, roots = np.zeros(len(ids), np.int64), []
    for group in np.split(np.arange(len(cells)), np.flatnonzero(np.diff(cells)) + 1):
        if len(group) < 2:
            continue
        m = members[group]
        linked = vectors[m] @ vectors[m].T >= least
        np.fill_diagonal(linked, False)
        if cross:
            linked &= block[m][:, None] != block[m]
        if not linked.any():
            continue
        # leave out members without a link, then pairs that share a smaller filter
        keep = linked.any(axis=1)
        m, linked = m[keep], linked[np.ix_(keep, keep)]
        lower = [lists[i][lists[i] < cells[group[0]]] for i in m]
        names, column = np.unique(np.concatenate(lower), return_inverse=True)
        if len(names):
            held = np.zeros((len(m), len(names)), np.float32)
            held[np.repeat(np.arange(len(m)), [len(x) for x in lower]), column] = 1
            linked &= held @ held.T == 0
        links[m] += linked @ copies[m]
        root = m[_roots(linked)]
        roots += [(m[i], root[i]) for i in np.flatnonzero(root != m)]
    some = np.flatnonzero(links)
    pairs = np.array(sorted(set(roots)), np.int64).reshape(-1, 2)
    return pa.table(
        {
            "id": pa.array(np.concatenate([ids[some], ids[pairs[:, 0]]])),
            "n": pa.array(np.concatenate([links[some], np.zeros(len(pairs), np.int64)])),
            "root": pa.array(np.concatenate([ids[some], ids[pairs[:, 1]]])),
        }
    )


def link_vectors(df: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``df``."""
    rows = df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    # a null component makes the sum null, one that is not finite makes it not finite; very small ones count as zero
    usable = F.coalesce((square > 0) & (square < float("inf")) & F.col("vec_id").isNotNull(), F.lit(False))
    rows = rows.withColumn("vector", F.when(usable, F.col("vector")))
    good = rows.where("vector IS NOT NULL")
    distinct = good.groupBy("vector").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("copies"))
    # two rows of one id may hold different vectors, so a representative has a number of its own, from its components
    distinct = materialise(distinct.select("vector", "copies", "low", F.xxhash64("vector").alias("id")), "vectors")
    lengths = distinct.groupBy(F.size("vector").alias("dims")).agg(F.count(F.lit(1)).alias("n")).collect()
    codewords_of = {r["dims"]: codewords_at(r["dims"], r["n"], least) for r in lengths}
    sent = materialise(_send(distinct.repartition("id"), codewords_of), "vector-filters")
    keys = ["dims", "head"]
    compared = _in_blocks(sent, keys).groupBy(*keys, "a", "b")
    found = compared.applyInArrow(lambda t: _compare(t, codewords_of, least), "id bigint, n bigint, root bigint")
    found = materialise(found, "vector-links")
    links = found.groupBy("id").agg(F.sum("n").alias("n"))
    component = classes(found.where("id <> root"), "id", "root")
    per_vector = distinct.join(links, "id", "left").join(component, "id", "left")
    lowest = per_vector.where("class_id IS NOT NULL").groupBy("class_id").agg(F.min("low").alias("_lowest"))
    per_vector = per_vector.join(lowest, "class_id", "left").select(
        F.col("vector").alias("_v"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("_lowest", "low").alias("component_id"),
    )
    joined = rows.join(per_vector, F.col("vector") == F.col("_v"), "left")
    own = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), own.alias("component_id"),
        F.coalesce(own == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
