"""Words of whole texts as flat numpy arrays, for use inside Arrow batches.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return, which is how
``bytes.split()`` cuts. Texts are worked on in pieces of a few MB, so that memory does not follow the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import SparkSession

PIECE_BYTES = 4 << 20
CACHED_WORDS = 400_000  # a memory bound: a full cache starts anew
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts may be long: at most this many rows go to Python at once."""
    if int(spark.conf.get(BATCH_ROWS)) > rows:
        spark.conf.set(BATCH_ROWS, str(rows))


def pieces(batches: Iterable[pa.RecordBatch], column: str = "text", size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose texts hold about ``size`` bytes; a longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths)
        first = 0
        while first < batch.num_rows:
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + size, side="right")))
            yield batch.slice(first, last - first)
            first = last


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


class HashedWords(dict):
    """word -> 64-bit hash of its normal form; 0 marks a word whose normal form is empty."""

    def __init__(self, normal: Callable[[bytes], bytes] | None = None):
        super().__init__()
        self.normal = normal

    def __missing__(self, word: bytes) -> int:
        form = self.normal(word) if self.normal else word
        value = self[word] = (xxhash.xxh3_64_intdigest(form) or 1) if form else 0
        return value


def hash_words(texts: Sequence[bytes], words: HashedWords) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, one text after the other, and where each text starts (one more entry than texts)."""
    if len(words) > CACHED_WORDS:
        words.clear()
    look = words.__getitem__
    parts, ends = [], [0]
    for text in texts:
        found = text.split()
        part = np.fromiter(map(look, found), np.uint64, len(found))
        if words.normal:
            part = part[part != 0]
        parts.append(part)
        ends.append(ends[-1] + len(part))
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return flat, np.array(ends, np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads all bits of 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        _POWERS[:] = [np.multiply.accumulate(np.full(size, step, np.uint64)) for step in (_STEP, _BACK)]
    return _POWERS[0][:n], _POWERS[1][:n]


def windows(flat: np.ndarray, ends: np.ndarray, k: int, factor: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every run of ``k`` words inside one text: its hash, the place of its first word, the text's number.

    The hash is a polynomial in the word hashes, summed once and cut by differences. ``factor`` (odd) gives another,
    independent hash.
    """
    n = len(flat)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    up, down = powers(n + 1)
    words = flat if factor == 1 else mix(flat * np.uint64(factor))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(words * up[:n], out=total[1:])
    text = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    place = np.arange(n - k + 1)
    inside = place + k <= ends[text[: n - k + 1] + 1]
    place = place[inside]
    return mix((total[place + k] - total[place]) * down[place]), place, text[place]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
