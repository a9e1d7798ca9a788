"""Toxicity by compression distance: zstandard dictionaries of ordinary and of toxic text, and window lengths compared.

The ordinary dictionary is trained on windows of ordinary text. The toxic one holds, over the same ordinary dictionary, the
words that toxic text uses far more often: the count of contexts (word before, word, word after) gives a log-likelihood
ratio against ordinary text, and words above twice the logarithm of the vocabulary stay. Both dictionaries
have one size and one set of parameters, so a window without anything toxic compresses to the same length under both, and the
bytes that the toxic one saves measure toxicity. What a document's windows save is summed up in a few numbers, and a
logistic calibration turns them into a probability.

Dictionaries and calibration are fitted on a bounded sample of labelled rows; the calibration sees each half of the sample
through dictionaries of the other half. Scores cover whole texts of all documents. Words are compared as letters and
digits in lower case; a window ends at the first word end behind ``WINDOW`` bytes, a longer word stays whole.

Defined results: null and empty texts have one empty window; rows without a label are scored only; with labels of one kind
only, that kind's share (0 or 1) is the score; without labels the score is 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registrylake.llm.indexing import held_out
from registrylake.llm.text import mix, pieces, small_batches

WINDOW = 48
SAMPLE_ROWS = 4000  # of each kind at most, those with the smallest hash of their id
SAMPLE_CHARS = 8_000_000  # of each kind at most
ORDINARY_BYTES, TOXIC_BYTES = 16 << 10, 8 << 10
RATIO = 8  # a toxic word is at least so much more frequent in toxic text
SHORTEST = 3  # bytes of a toxic word
STEMS = (4, 5, 6)  # letters of a stem
COVERED = 0.8
NUMBERS = 8

_NOISE = re.compile(r"[\W_]+")


def normal(text: str) -> bytes:
    return _NOISE.sub(" ", text.lower()).strip().encode()


def cut(text: bytes) -> list[bytes]:
    out, first = [], 0
    while first < len(text):
        end = text.find(b" ", min(first + WINDOW, len(text)))
        end = len(text) if end < 0 else end
        out.append(b" " + text[first:end] + b" ")
        first = end + 1
    return out or [b"  "]


def _contexts(texts: Sequence[bytes]) -> tuple[dict[bytes, int], int]:
    """Of how many different neighbourhoods each word has been the middle, and the sum."""
    names: dict[bytes, int] = {}
    hashes = []
    numbers = []
    for text in texts:
        words = text.split()
        if not words:
            continue
        number = np.array([names.setdefault(w, len(names)) for w in words])
        h = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
        around = np.zeros(len(words), np.uint64)
        around[1:] = h[:-1] * np.uint64(3)
        around[:-1] += h[1:] * np.uint64(0x9E3779B97F4A7C15)
        hashes.append(mix(around + mix(h)))
        numbers.append(number)
    if not hashes:
        return {}, 0
    _, first = np.unique(np.concatenate(hashes), return_index=True)
    counts = np.bincount(np.concatenate(numbers)[first], minlength=len(names))
    return {w: int(counts[i]) for w, i in names.items()}, len(first)


def _with_stems(counts: dict[bytes, int]) -> dict[bytes, int]:
    """The counts of words (a space on both sides) and of their first letters (a space before)."""
    out: dict[bytes, int] = {}
    for word, k in counts.items():
        out[b" " + word + b" "] = k
        letters = word.decode()
        for n in STEMS:
            if len(letters) > n:
                stem = b" " + letters[:n].encode()
                out[stem] = out.get(stem, 0) + k
    return out


def toxic_words(toxic: Sequence[bytes], ordinary: Sequence[bytes]) -> list[bytes]:
    """Words and stems far more frequent in toxic text; whole words and the most telling last (nearest to a window)."""
    a, n_a = _contexts(toxic)
    b, n_b = _contexts(ordinary)
    a, b = _with_stems(a), _with_stems(b)
    least = 2 * np.log(max(2, len(a.keys() | b.keys())))
    found = []
    for word, k in a.items():
        other = b.get(word, 0)
        if k < 2 or len(word.strip()) < SHORTEST or k * n_b < RATIO * other * n_a:
            continue
        expected = (k + other) * n_a / (n_a + n_b)
        ratio = 2 * (k * np.log(k / expected) + (other * np.log(other / (k + other - expected)) if other else 0))
        if ratio >= least:
            found.append((word.endswith(b" "), ratio, word))
    # a stem that one longer piece mostly stands for says nothing more
    covered: dict[bytes, int] = {}
    for _, _, word in found:
        letters = word.strip().decode()
        for n in STEMS:
            if n < len(letters):
                stem = b" " + letters[:n].encode()
                covered[stem] = max(covered.get(stem, 0), a[word])
    return [w for whole, _, w in sorted(found) if whole or covered.get(w, 0) < COVERED * a[w]]


def dictionaries(toxic: Sequence[bytes], ordinary: Sequence[bytes]) -> tuple[bytes, bytes]:
    """Contents of the ordinary and of the toxic dictionary, equally long."""
    windows = [w for text in ordinary for w in cut(text)]
    order = np.random.default_rng(0).permutation(len(windows))[:40_000]
    windows = [windows[i] for i in order]
    try:
        common = zstandard.train_dictionary(ORDINARY_BYTES, windows).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself is the dictionary
        common = b"".join(windows)[-ORDINARY_BYTES:]
    words = b"".join(toxic_words(toxic, ordinary))[-TOXIC_BYTES:]
    return b"\0" * len(words) + common, words + common


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters(
        window_log=17, chain_log=16, hash_log=16, search_log=6, min_match=5, target_length=32,
        strategy=zstandard.STRATEGY_LAZY2, write_content_size=False,
    )
    held = zstandard.ZstdCompressionDict(content or b"\0" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(compression_params=parameters, dict_data=held)


def numbers_of(text: bytes, ordinary: zstandard.ZstdCompressor, toxic: zstandard.ZstdCompressor) -> list[float]:
    """What the windows save under the toxic dictionary: the most, means of the best, counts above thresholds, mean, windows."""
    windows = cut(text)
    saved = np.array([len(ordinary.compress(w)) - len(toxic.compress(w)) for w in windows])
    best = np.sort(saved)[::-1]
    above = [np.log1p(np.count_nonzero(saved >= t)) for t in (3, 4, 6)]
    return [best[0], best[:2].mean(), best[:4].mean(), *above, saved.mean(), np.log(len(saved))]


def calibrate(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic weights for the standardised numbers and 1, by Newton's method with a small penalty."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    penalty = np.r_[np.ones(x.shape[1]), 1e-6]
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty), z.T @ (p - y) + penalty * w)
        w -= np.clip(step, -3, 3)
    return mean, scale, w


class Model:
    """What scoring needs; a few tens of KB whatever the corpus."""

    def __init__(self, texts: Sequence[str], y: np.ndarray):
        self.share = float(np.mean(y)) if len(y) else 0.0
        self.trained = 0.0 < self.share < 1.0
        if not self.trained:
            return
        forms = [normal(t) for t in texts]
        half = np.arange(len(y)) % 2
        for kind in (0, 1):  # each half has its part of both kinds
            at = np.flatnonzero(y == kind)
            half[at] = np.arange(len(at)) % 2
        x = np.zeros((len(y), NUMBERS))
        pick = lambda keep, kind: [forms[i] for i in np.flatnonzero(keep & (y == kind))]
        for side in (0, 1):
            fitted = half != side if len(np.unique(y[half != side])) == 2 else np.ones(len(y), bool)
            pair = [compressor(c) for c in dictionaries(pick(fitted, 1), pick(fitted, 0))]
            for i in np.flatnonzero(half == side):
                x[i] = numbers_of(forms[i], *pair)
        self.mean, self.scale, self.weights = calibrate(x, y)
        self.contents = dictionaries(pick(y >= 0, 1), pick(y >= 0, 0))

    def scores(self, texts: Sequence[str | None], held: dict) -> np.ndarray:
        if not self.trained:
            return np.full(len(texts), self.share)
        if "pair" not in held:
            held["pair"] = [compressor(c) for c in self.contents]
        x = np.array([numbers_of(normal(t or ""), *held["pair"]) for t in texts]).reshape(-1, NUMBERS)
        z = np.c_[(x - self.mean) / self.scale, np.ones(len(x))]
        return 1 / (1 + np.exp(-np.clip(z @ self.weights, -500, 500)))


def sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str) -> DataFrame:
    """(text, y) of at most SAMPLE_ROWS rows and SAMPLE_CHARS characters of each kind, none of them held out."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("y")).where("y IN (0, 1)")
    known = known.where(~F.coalesce(held_out(F.col("_id")), F.lit(True)))
    order = [F.xxhash64("_id"), F.col("_id")]
    chosen = [known.where(F.col("y") == kind).orderBy(*order).limit(SAMPLE_ROWS) for kind in (0, 1)]
    rows = docs.select(F.col(id_col).alias("_doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.join(chosen[0].unionByName(chosen[1]), F.col("_doc") == F.col("_id"))
    # ids may repeat, so rows and characters are bounded behind the join; the window sees sampled rows only
    rows = rows.withColumn("size", F.length("text"))
    running = Window.partitionBy("y").orderBy(F.xxhash64("_id"), "_id", "size", F.xxhash64("text"))
    rows = rows.where(F.col("size") <= SAMPLE_CHARS).withColumn("n", F.row_number().over(running)).withColumn("upto", F.sum("size").over(running))
    return rows.where((F.col("n") <= SAMPLE_ROWS) & (F.col("upto") <= SAMPLE_CHARS)).orderBy("y", "n").select("text", "y")


def score_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row_hash, score) of every document; ``labels`` has doc_id and the label."""
    small_batches(docs.sparkSession)
    found = sample(docs, labels, label, id_col, text_col).collect()
    model = docs.sparkSession.sparkContext.broadcast(Model([r["text"] for r in found], np.array([r["y"] for r in found], np.int64)))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("row_hash"), F.col(text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for piece in pieces(batches):
            scores = model.value.scores(piece.column("text").to_pylist(), held)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("row_hash"), pa.array(scores)], ["doc_id", "row_hash", "score"])

    return rows.mapInArrow(run, f"doc_id {kind}, row_hash bigint, score double")
