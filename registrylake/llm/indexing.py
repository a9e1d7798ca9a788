"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network with calibrated probabilities.

Every shape (letters, capitals, digits as one sign each, other characters themselves, runs as one) has a fixed sparse ternary
index vector. A word's vector is the sum of the index vectors of the shapes within two words of it, over all documents; so is a
shape's. Words and shapes are hashed to fixed numbers of buckets, which bounds the table whatever the vocabulary. A word
that repeats the one before it has a shape of its own. A document is the mean of its words' and of its shapes' vectors.

The network (one hidden layer) is fitted by numpy on a bounded sample of labelled rows, its temperature on a part of the
sample kept aside. Vectors, pooling and scores cover all documents.

Defined results: null and empty texts pool to zeros and get the network's score for them; rows without a label are scored only;
a document with several labels counts once for each; with labels of one kind only, that kind's share (0 or 1) is the
score; without labels the score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registrylake.llm.text import CACHED_WORDS, as_bytes, pieces, small_batches
from registrylake.session import materialise

WORD_BUCKETS, SHAPE_BUCKETS = 8192, 256
REPEATED = 0  # the shape bucket of a word that repeats the one before it
DIMS, ENTRIES = 32, 4  # length of a vector; entries other than 0 of an index vector
REACH = 2
SAMPLE_ROWS = 12_000  # labelled rows the network is fitted on at most
HIDDEN, ROUNDS, STEP, DECAY = 32, 300, 0.02, 1e-4


def shape(word: str) -> str:
    """One sign a run: ``The,`` is ``Aa,`` and ``24!!`` is ``0!``."""
    signs = ("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    out = []
    for s in signs:
        if not out or out[-1] != s:
            out.append(s)
    return "".join(out)


class _Codes(dict):
    """word -> word bucket and shape bucket in one number."""

    def __missing__(self, word: bytes) -> int:
        form = shape(word.decode("utf-8", "replace")).encode()
        at = xxhash.xxh3_64_intdigest(word) % WORD_BUCKETS
        value = self[word] = at * SHAPE_BUCKETS + 1 + xxhash.xxh3_64_intdigest(form) % (SHAPE_BUCKETS - 1)
        return value


_CODES = _Codes()


def word_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets and shape buckets of all words, and where each text starts."""
    if len(_CODES) > CACHED_WORDS:
        _CODES.clear()
    look = _CODES.__getitem__
    parts, ends = [np.zeros(0, np.int64)], [0]
    for text in texts:
        found = text.split()
        parts.append(np.fromiter(map(look, found), np.int64, len(found)))
        ends.append(ends[-1] + len(found))
    codes, ends = np.concatenate(parts), np.array(ends)
    words, shapes = codes // SHAPE_BUCKETS, codes % SHAPE_BUCKETS
    again = np.zeros(len(codes), bool)
    again[1:] = codes[1:] == codes[:-1]
    again[ends[:-1][ends[:-1] < len(codes)]] = False
    shapes[again] = REPEATED
    return words, shapes, ends


def index_vectors() -> np.ndarray:
    rng = np.random.default_rng(0)
    out = np.zeros((SHAPE_BUCKETS, DIMS), np.int64)
    for row in out:
        row[rng.choice(DIMS, ENTRIES, replace=False)] = rng.choice([-1, 1], ENTRIES)
    return out


def neighbour_counts(words: np.ndarray, shapes: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> None:
    """Add to ``counts`` (words, then shapes; by shape) how often each has each shape within REACH words."""
    text = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    targets, near = [], []
    for step in range(1, REACH + 1):
        left = np.flatnonzero(text[:-step] == text[step:])
        targets += [left, left + step]
        near += [shapes[left + step], shapes[left]]
    target, by = np.concatenate(targets), np.concatenate(near)
    counts[:WORD_BUCKETS].reshape(-1)[:] += np.bincount(words[target] * SHAPE_BUCKETS + by, minlength=WORD_BUCKETS * SHAPE_BUCKETS)
    counts[WORD_BUCKETS:].reshape(-1)[:] += np.bincount(shapes[target] * SHAPE_BUCKETS + by, minlength=SHAPE_BUCKETS**2)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit vectors of all word buckets, then all shape buckets. ``docs`` has a column ``text``.

    A task sums its own documents; the sums meet by bucket. The table that comes to the driver has a fixed size.
    """
    small_batches(docs.sparkSession)
    names = [f"v{i}" for i in range(DIMS)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((WORD_BUCKETS + SHAPE_BUCKETS, SHAPE_BUCKETS), np.int64)
        for piece in pieces(batches):
            neighbour_counts(*word_codes(as_bytes(piece.column("text"))), counts)
        sums = counts @ index_vectors()
        used = np.flatnonzero(counts.any(axis=1))
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(sums[used, i]) for i in range(DIMS))], ["bucket", *names])

    parts = docs.select("text").mapInArrow(run, "bucket bigint, " + ", ".join(f"{n} bigint" for n in names))
    rows = parts.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names]).toPandas()
    out = np.zeros((WORD_BUCKETS + SHAPE_BUCKETS, DIMS))
    out[rows["bucket"].to_numpy(np.int64)] = rows[names].to_numpy(np.float64)
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def pool(words: np.ndarray, shapes: np.ndarray, ends: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean word vector, mean shape vector and log of the length of each text."""
    n = np.diff(ends)
    out = np.zeros((len(n), 2 * DIMS + 1), np.float32)
    full = np.flatnonzero(n)
    if len(full):
        for at, column in ((words, 0), (shapes + WORD_BUCKETS, DIMS)):
            sums = np.add.reduceat(vectors[at], ends[:-1][full], axis=0, dtype=np.float32)
            out[full, column : column + DIMS] = sums / n[full, None]
    out[:, -1] = np.log1p(n) / 10
    return out


def pooled(docs: DataFrame, vectors: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, row_hash, features) of every document."""
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(vectors)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("row_hash"), F.col(text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            found = pool(*word_codes(as_bytes(piece.column("text"))), held.value)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(found.reshape(-1)), found.shape[1]).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("row_hash"), lists], ["doc_id", "row_hash", "features"])

    return rows.mapInArrow(run, f"doc_id {kind}, row_hash bigint, features array<float>")


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x - self.mean) / self.scale @ self.first + self.first_bias, 0)
        return hidden @ self.second + self.second_bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x.astype(np.float64)) / self.temperature, -500, 500)))


def constant(share: float, dims: int = 2 * DIMS + 1) -> Network:
    """A network that gives every document the same score."""
    logit = 500.0 if share >= 1 else -500.0 if share <= 0 else float(np.log(share / (1 - share)))
    zeros = np.zeros(dims)
    return Network(zeros, zeros + 1, np.zeros((dims, 1)), np.zeros(1), np.zeros(1), logit)


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def fit(x: np.ndarray, y: np.ndarray) -> Network:
    """Adam on the whole sample; a fifth is kept aside to choose the temperature."""
    if not len(y) or y.min() == y.max():
        return constant(float(y[0]) if len(y) else 0.5, x.shape[1])
    x = x.astype(np.float64)
    rng = np.random.default_rng(0)
    aside = np.zeros(len(y), bool)
    aside[rng.permutation(len(y))[: len(y) // 5]] = True
    train = ~aside if len(np.unique(y[~aside])) == 2 else np.ones(len(y), bool)
    mean, scale = x[train].mean(axis=0), x[train].std(axis=0) + 1e-6
    z, t = (x[train] - mean) / scale, y[train]
    p = [rng.normal(size=(x.shape[1], HIDDEN)) / np.sqrt(x.shape[1]), np.zeros(HIDDEN), rng.normal(size=HIDDEN) / np.sqrt(HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    for k in range(1, ROUNDS + 1):
        hidden = np.maximum(z @ p[0] + p[1], 0)
        error = (1 / (1 + np.exp(-np.clip(hidden @ p[2] + p[3], -500, 500))) - t) / len(t)
        back = np.outer(error, p[2]) * (hidden > 0)
        grads = [z.T @ back + DECAY * p[0], back.sum(axis=0), hidden.T @ error + DECAY * p[2], np.array([error.sum()])]
        for a, g, i in zip(p, grads, range(4), strict=True):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            a -= STEP * (m[i] / (1 - 0.9**k)) / (np.sqrt(v[i] / (1 - 0.999**k)) + 1e-8)
    net = Network(mean, scale, *p[:3], float(p[3][0]))
    if aside.any():
        logits = net.logits(x[aside])
        net.temperature = float(min(np.geomspace(0.25, 8, 60), key=lambda t: _loss(logits / t, y[aside])))
    return net


def held_out(key: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(3)) == 1


def labelled_sample(rows: DataFrame, labels: DataFrame, label: str, n: int) -> DataFrame:
    """At most ``n`` labelled rows that are not held out, those with the smallest hash of their id."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("y"))
    known = known.where(F.col("y").isNotNull() & ~F.coalesce(held_out(F.col("_id")), F.lit(True)))
    known = known.orderBy(F.xxhash64("_id"), "_id", "y").limit(n)
    return rows.join(known, F.col("doc_id") == F.col("_id"))


def score_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row_hash, score) of every document; ``labels`` has doc_id and the label."""
    vectors = word_vectors(docs.select(F.col(text_col).alias("text")))
    rows = materialise(pooled(docs, vectors, id_col, text_col), "quality-features")
    # ids may repeat, so the number of joined rows is bounded once more
    sample = labelled_sample(rows, labels, label, SAMPLE_ROWS).orderBy(F.xxhash64("doc_id"), "doc_id", "row_hash", "y")
    found = sample.select("features", "y").limit(SAMPLE_ROWS).toPandas()
    x = np.stack(found["features"].to_numpy()) if len(found) else np.zeros((0, 2 * DIMS + 1))
    net = docs.sparkSession.sparkContext.broadcast(fit(x, found["y"].to_numpy(np.float64)))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.asarray(batch.column("features").flatten(), np.float32).reshape(batch.num_rows, -1)
                columns = [batch.column("doc_id"), batch.column("row_hash"), pa.array(net.value.scores(x))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row_hash", "score"])

    return rows.mapInArrow(run, f"doc_id {kind}, row_hash bigint, score double")


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all their columns, whose score is at least ``least``."""
    bad = score_quality(docs, labels, id_col=id_col, text_col=text_col).where(F.col("score") < least)
    bad = bad.select(F.col("doc_id").alias("_doc"), F.col("row_hash").alias("_h")).distinct()
    same = F.col(id_col).eqNullSafe(F.col("_doc")) & (F.xxhash64(text_col) == F.col("_h"))
    return docs.join(bad, same, "left_anti")
