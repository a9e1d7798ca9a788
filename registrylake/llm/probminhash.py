"""Near-duplicate documents by ProbMinHash over distinct word shingles.

A document is its distinct shingles of five words, all of one weight (``signatures`` takes counts too: a shingle that occurs
n times weighs 1 + ln n there), as the limit is one of the distinct shingles: candidates found or ruled out by other weights
lose texts that differ in a repeated line. Each shingle sends points at the times of a Poisson process whose rate is its weight; a point falls
on one of ``SIZE`` places, and a signature holds the shingle whose point came first there. A shingle stops once its next point
is later than the latest place. The share of equal places estimates the probability Jaccard index, with equal weights the plain one;
bands of places are join keys. Pairs that come out of them are verified on their texts: the Jaccard index of the distinct
shingles must reach the limit.

Texts of equal word sequences are one text first. Of documents that share a bucket only a spanning forest of the most similar
pairs is compared exactly; then only pairs between different classes that still share a bucket are, all whose estimates
are not clearly below the limit: that of the signature, and a finer one of the distinct shingles. A pair is sent on
from the first bucket that both are in. So a group of copies or near copies costs in proportion to its size, and no link
between different classes that a bucket shows is left out. Buckets above ``BLOCK`` rows are cut into blocks.

Defined results: a text of fewer than five words is one shingle of all of them; null texts, texts without words and rows
without an id are alone; rows with equal ids are one document with all their texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registrylake.llm.links import classes
from registrylake.llm.text import HashedWords, as_bytes, hash_words, mix, pieces, signed, small_batches, windows
from registrylake.session import materialise

SHINGLE = 5
LEAST = 0.8
BANDS, ROWS = 25, 5  # a pair at 0.8 shares no band with probability 5e-5
SIZE = BANDS * ROWS
SURE = 0.15  # four standard deviations of the estimate at 0.8
BINS = 1024
FINE_SURE = 0.05  # four standard deviations of the finer estimate at 0.8
BLOCK = 512
PAIRS_AT_ONCE = 8192  # a memory bound: pairs whose bins are compared together

_WORDS = HashedWords()


def weights_of(counts: np.ndarray) -> np.ndarray:
    return 1 + np.log(counts)


def shingles(flat: np.ndarray, ends: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct shingles and their counts for each text."""
    hashes, _, text = windows(flat, ends, SHINGLE)
    bounds = np.searchsorted(text, np.arange(len(ends)))
    out = []
    for i in range(len(ends) - 1):
        if bounds[i] < bounds[i + 1]:
            out.append(np.unique(hashes[bounds[i] : bounds[i + 1]], return_counts=True))
        else:
            words = flat[ends[i] : ends[i + 1]]
            whole = np.array([xxhash.xxh3_64_intdigest(words.tobytes())] if len(words) else [], np.uint64)
            out.append((whole, np.ones(len(whole), np.int64)))
    return out


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """A row of SIZE shingle hashes for each set of shingles and counts; zeros for an empty one."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s, _ in sets])
    shingle = np.concatenate([s for s, _ in sets]) if n else np.zeros(0, np.uint64)
    weight = weights_of(np.concatenate([w for _, w in sets])) if n else np.zeros(0)
    first = np.full(n * SIZE, np.inf)
    found = np.zeros(n * SIZE, np.uint64)
    time, state = np.zeros(len(owner)), mix(shingle)
    while len(owner):
        state = mix(state + np.uint64(0x9E3779B97F4A7C15))
        time = time - np.log(_uniform(state)) / weight
        place = owner * SIZE + (mix(state ^ np.uint64(0xD6E8FEB86659FD93)) % np.uint64(SIZE)).view(np.int64)
        np.minimum.at(first, place, time)
        won = first[place] == time
        found[place[won]] = shingle[won]
        latest = first.reshape(n, SIZE).max(axis=1)
        on = time < latest[owner]
        owner, shingle, weight, time, state = owner[on], shingle[on], weight[on], time[on], state[on]
    return found.reshape(n, SIZE)


def fine_bins(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """A row of BINS bytes for each set: a hash of the smallest shingle of each bin, zero for an empty bin."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s, _ in sets])
    value = mix((np.concatenate([s for s, _ in sets]) if n else np.zeros(0, np.uint64)) ^ np.uint64(0xA0761D6478BD642F))
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    low = np.full(n * BINS, empty)
    np.minimum.at(low, owner * BINS + (value % np.uint64(BINS)).view(np.int64), value)
    return np.where(low == empty, 0, 1 + mix(low) % np.uint64(255)).astype(np.uint8).reshape(n, BINS)


def unweighted(sets: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The same shingles, each counted once."""
    return [(s, np.ones_like(n)) for s, n in sets]


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """The Jaccard index of two sets, each without repeats."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def sketch(docs: DataFrame) -> DataFrame:
    """(doc_id, h1, h2, keys, sig, fine) of every document with words; ``docs`` has (doc_id, text)."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band = np.arange(1, BANDS + 1, dtype=np.uint64)[:, None]
        for piece in pieces(batches):
            flat, ends = hash_words(as_bytes(piece.column("text")), _WORDS)
            full = np.flatnonzero(np.diff(ends))
            sets = shingles(flat, ends)
            sig, fine = signatures(unweighted(sets))[full], fine_bins(sets)[full]
            keys = np.zeros((len(full), BANDS), np.uint64)
            parts = sig.reshape(len(full), BANDS, ROWS)
            for r in range(ROWS):
                keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
            keys = mix(keys + band.T)
            digests = [xxhash.xxh3_128_digest(flat[ends[i] : ends[i + 1]].tobytes()) for i in full]
            both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            short = mix(sig).astype(np.uint16)
            columns = [
                piece.column("doc_id").take(pa.array(full)), pa.array(both[:, 0]), pa.array(both[:, 1]),
                pa.array(list(signed(keys)), pa.list_(pa.int64())), pa.array([s.tobytes() for s in short], pa.binary()),
                pa.array([s.tobytes() for s in fine], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "h1", "h2", "keys", "sig", "fine"])

    schema = f"doc_id {kind}, h1 bigint, h2 bigint, keys array<bigint>, sig binary, fine binary"
    return docs.where("doc_id IS NOT NULL").mapInArrow(run, schema)


def by_group(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows in order of ``keys`` as one table for each value; a group may span batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(k).to_numpy() for k in keys], axis=1)
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        bounds = [0, *cuts.tolist(), len(values)]
        for first, end in zip(bounds, bounds[1:], strict=False):
            here = tuple(values[first])
            if held and here != last:
                yield pa.Table.from_batches(held)
                held = []
            last = here
            held.append(batch.slice(first, end - first))
    if held:
        yield pa.Table.from_batches(held)


def _per_group(rows: DataFrame, keys: list[str], pairs_of: Callable[[pa.Table], np.ndarray]) -> DataFrame:
    """Distinct (a, b) that ``pairs_of`` finds in each group."""
    placed = rows.repartition(*keys).sortWithinPartitions(*keys)
    schema = "a bigint, b bigint"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for group in by_group(batches, keys):
            held.append(pairs_of(group))
            n += len(held[-1])
            if n > 50_000:
                yield _pairs(held)
                held, n = [], 0
        if n:
            yield _pairs(held)

    return placed.mapInArrow(run, schema).distinct()


def _pairs(parts: list[np.ndarray]) -> pa.RecordBatch:
    found = np.unique(np.concatenate(parts), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])


def _estimates(table: pa.Table) -> np.ndarray:
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint16).reshape(-1, SIZE)
    out = np.zeros((len(sig), len(sig)), np.float32)
    step = max(1, (4 << 20) // (len(sig) * SIZE))
    for i in range(0, len(sig), step):
        out[i : i + step] = (sig[i : i + step, None, :] == sig).sum(axis=2)
    return out / SIZE


_NONE = np.zeros((0, 2), np.int64)


def spanning_pairs(ids: np.ndarray, estimate: np.ndarray, least: float) -> np.ndarray:
    """The most similar pairs that connect all that pairs of at least ``least`` connect (a maximum spanning forest)."""
    best, near = np.full(len(ids), -1.0), np.zeros(len(ids), np.int64)
    done = np.zeros(len(ids), bool)
    out = []
    for _ in range(len(ids)):
        at = int(np.argmax(np.where(done, -2.0, best)))
        if best[at] >= least:
            out.append((ids[at], ids[near[at]]))
        done[at] = True
        closer = estimate[at] > best
        best[closer], near[closer] = estimate[at][closer], at
    return np.sort(np.array(out, np.int64).reshape(-1, 2), axis=1)


def _forest(table: pa.Table, least: float) -> np.ndarray:
    if table.num_rows < 2:
        return _NONE
    estimate = _estimates(table)
    np.fill_diagonal(estimate, 0)
    return spanning_pairs(table.column("id").to_numpy(), estimate, least)


def _not_clearly_below(table: pa.Table, x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    """Which pairs of rows have this bucket as the first one they share, and a finer estimate of at least ``least``."""
    here = table.column("key")[0].as_py()
    keys = np.array(table.column("keys").to_pylist(), np.int64)
    fine = np.frombuffer(b"".join(table.column("fine").to_pylist()), np.uint8).reshape(-1, BINS)
    good = np.zeros(len(x), bool)
    for i in range(0, len(x), PAIRS_AT_ONCE):
        p, q = x[i : i + PAIRS_AT_ONCE], y[i : i + PAIRS_AT_ONCE]
        first = (keys[p] == keys[q]).argmax(axis=1)
        at = np.flatnonzero(keys[p, first] == here)
        a, b = fine[p[at]], fine[q[at]]
        filled = ((a | b) > 0).sum(axis=1)
        good[i + at] = ((a == b) & (a > 0)).sum(axis=1) >= least * filled
    return good


def _across(table: pa.Table, least: float, fine_least: float) -> np.ndarray:
    """Pairs of different classes with a minor row in them; in groups of two blocks, pairs of the two only."""
    comp = table.column("comp").to_numpy()
    if len(comp) < 2 or (comp == comp[0]).all():
        return _NONE
    ids, side = table.column("id").to_numpy(), table.column("side").to_numpy()
    wanted = np.triu(comp[:, None] != comp, 1) & (_estimates(table) >= least)
    if (side != side[0]).any():
        wanted &= side[:, None] != side
    x, y = np.nonzero(wanted)
    good = _not_clearly_below(table, x, y, fine_least)
    x, y = x[good], y[good]
    return np.sort(np.stack([ids[x], ids[y]], axis=1), axis=1)


def _minor_tasks(rows: DataFrame) -> DataFrame:
    """Rows of (key, id, comp, keys, sig, fine) with (x, y, side): groups in which pairs outside the largest class of a bucket are compared.

    x and y are blocks; minor rows are dealt over blocks below zero. A row of the largest class goes to each minor block, a
    minor row to each block of the largest class and of the minor rows.
    """
    sizes = rows.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("k")).groupBy("key")
    sizes = sizes.agg(F.max_by("comp", F.struct("k", "comp")).alias("major"), F.max("k").alias("n_major"), F.sum("k").alias("n"))
    sizes = sizes.where("n > n_major")
    blocks = lambda c: F.ceil(c / F.lit(BLOCK)).cast("int")
    sizes = sizes.select("key", "major", blocks(F.col("n_major")).alias("g"), blocks(F.col("n") - F.col("n_major")).alias("m"))
    rows = rows.join(sizes, "key").withColumn("minor", F.col("comp") != F.col("major"))
    own = F.when(F.col("minor"), -1 - F.pmod(F.xxhash64("id"), F.col("m"))).otherwise(F.pmod(F.xxhash64("id"), F.col("g"))).cast("int")
    minors = F.transform(F.sequence(F.lit(1), F.col("m")), lambda i: -i)
    majors = F.sequence(F.lit(0), F.col("g") - 1)
    others = F.when(F.col("minor"), F.concat(minors, majors)).otherwise(minors)
    rows = rows.withColumn("side", own).withColumn("other", F.explode(others))
    return rows.select("key", "id", "comp", "keys", "sig", "fine", "side", F.least("side", "other").alias("x"), F.greatest("side", "other").alias("y"))


def verified(pairs: DataFrame, docs: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose texts have at least the similarity."""
    text = docs.select(F.col("doc_id").cast("bigint").alias("_id"), "text")
    both = pairs.join(text.withColumnsRenamed({"_id": "a", "text": "text"}), "a")
    both = both.join(text.withColumnsRenamed({"_id": "b", "text": "other"}), "b").select("a", "b", "text", "other")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            one, two = (shingles(*hash_words(as_bytes(piece.column(c)), _WORDS)) for c in ("text", "other"))
            keep = [i for i, (p, q) in enumerate(zip(one, two, strict=True)) if similarity(p[0], q[0]) >= least]
            yield piece.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return both.mapInArrow(run, "a bigint, b bigint").distinct()


def near_classes(docs: DataFrame, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id): the smallest id of the class, for every document row; ids are integers."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    small_batches(docs.sparkSession)
    sketched = materialise(sketch(rows), "sketches")
    # equal word sequences are one text, carried by their smallest id
    copies = sketched.groupBy("h1", "h2").agg(F.min("doc_id").alias("id"))
    same = copies.withColumnsRenamed({"h1": "_1", "h2": "_2"})
    texts = sketched.join(same, (F.col("h1") == F.col("_1")) & (F.col("h2") == F.col("_2")))
    member = materialise(texts.select("doc_id", "id"), "copies")
    reps = texts.where("doc_id = id").select("id", "keys", "sig", "fine").dropDuplicates(["id", "keys"])
    reps = materialise(reps, "texts")
    bands = reps.select("id", F.explode("keys").alias("key")).distinct()
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    bands = materialise(bands.join(shared, "key").select("key", "id", "n"), "buckets")
    sigs = reps.select("id", "sig")
    clear = least - SURE

    rows1 = bands.withColumn("block", F.pmod(F.xxhash64("id", "key"), F.ceil(F.col("n") / BLOCK))).drop("n")
    pairs = _per_group(rows1.join(sigs, "id"), ["key", "block"], lambda t: _forest(t, clear))
    pairs = materialise(pairs, "pairs")
    links = materialise(verified(pairs, rows, least), "near-links")

    comp = classes(links, "a", "b")
    rows2 = bands.select("key", "id").join(comp, "id", "left").select("key", "id", F.coalesce("class_id", "id").alias("comp"))
    tasks = _minor_tasks(rows2.join(reps, "id"))
    more = _per_group(tasks, ["key", "x", "y"], lambda t: _across(t, clear, least - FINE_SURE))
    more = materialise(more.join(pairs, ["a", "b"], "left_anti"), "more-pairs")
    # the classes found so far stand for their links, so they are not joined anew
    links = comp.select(F.col("id").alias("a"), F.col("class_id").alias("b")).unionByName(verified(more, rows, least))
    # rows of one id with several texts tie these together
    several = member.groupBy("doc_id").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high")
    ties = member.join(several.select("doc_id"), "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    final = classes(links.unionByName(ties), "a", "b").withColumnRenamed("id", "_c")
    found = member.distinct().join(final, F.col("id") == F.col("_c"), "left")
    found = found.groupBy("doc_id").agg(F.min(F.coalesce("class_id", "id")).alias("class_id")).withColumnRenamed("doc_id", "_d")
    return rows.select("doc_id").join(found, F.col("doc_id") == F.col("_d"), "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id")
    )


def keep_one(docs: DataFrame, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each class, the one with the smallest id; all its columns.

    A document is a row known by id and text, so rows that only share their id are in one class when their texts are. Of
    equal rows one stays; rows without an id or without words are all kept.
    """
    # a number from id and text, so that no row needs to be looked up for it; classes are of numbers
    number = F.when(F.col(id_col).isNotNull(), F.xxhash64(F.lit("row"), F.col(id_col), F.col(text_col)))
    found = materialise(near_classes(docs.select(number.alias("doc_id"), F.col(text_col).alias("text")), least).distinct(), "classes")
    ids = docs.select(number.alias("doc_id"), F.col(id_col).alias("id")).distinct()
    first = F.min(F.struct("id", "doc_id"))
    kept = ids.join(found, "doc_id").groupBy("class_id").agg(first.alias("first")).select("class_id", F.col("first.doc_id").alias("_kept"))
    gone = found.join(kept, "class_id").where("doc_id <> _kept").select(F.col("doc_id").alias("_d"))
    rest = docs.join(gone, number == F.col("_d"), "left_anti")
    repeated = docs.where(F.col(text_col).rlike(r"[^\x20\x09-\x0D]")).groupBy(number.alias("_d")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_d")
    several = rest.join(repeated, number == F.col("_d"), "left_semi")
    place = F.row_number().over(Window.partitionBy("_number").orderBy(F.xxhash64(*docs.columns)))
    several = several.withColumn("_number", number).withColumn("_place", place).where("_place = 1").drop("_number", "_place")
    return rest.join(repeated, number == F.col("_d"), "left_anti").unionByName(several)
