"""Edit-aware token counts: a tree of sums per document, and re-encoding only around what an edit touches.

A document is cut into leaves of some hundred bytes, at places where no byte-level pre-token crosses (``tokens._cut``). Its
tree holds the token count of every leaf and the sums above. An edit replaces characters ``first`` to ``last`` (exclusive) of the
original text. The leaves it touches and, while a border of the region is no longer a place to cut, the leaves next to it are
encoded anew; the new count goes to the first leaf of the region, the others get 0, and the sums above are mended.

Defined results: a null text is empty and has no tokens; edits of one document must not overlap (they raise); bounds outside the
text are moved into it; no edits (null or an empty list) leave the counts; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrylake.llm.text import pieces, small_batches
from registrylake.llm.tokens import Encoder, encoder

LEAF_CHARS = 512
CACHED_PIECES = 150_000  # a task has three Python workers here, and all come to hold a table: about 40 MB each
EDITS = "array<struct<first:int,last:int,text:string>>"
TREE = "leaf_chars array<int>, tree array<bigint>"
# a single space with other than white space on both sides: a pre-token starts there
_BORDER = re.compile(r"(?<=\S) (?=\S)")


def cut_leaves(text: str, size: int = LEAF_CHARS) -> list[str]:
    """The text in leaves: each the shortest of at least ``size`` characters that ends at a border."""
    leaves, first = [], 0
    while len(text) - first > size:
        border = _BORDER.search(text, first + size)
        if not border:
            break
        leaves.append(text[first : border.start()])
        first = border.start()
    return [*leaves, text[first:]]


def build_tree(counts: Sequence[int]) -> np.ndarray:
    """Sums as a heap: the root at 1, the leaves from half the length on."""
    width = 1 << max(0, len(counts) - 1).bit_length()
    tree = np.zeros(2 * width, np.int64)
    tree[width : width + len(counts)] = counts
    for level in range(width.bit_length() - 2, -1, -1):
        at = np.arange(1 << level, 2 << level)
        tree[at] = tree[2 * at] + tree[2 * at + 1]
    return tree


def set_leaves(tree: np.ndarray, first: int, counts: Sequence[int]) -> None:
    """Put new counts into consecutive leaves and mend the sums above them."""
    width = len(tree) // 2
    low, high = width + first, width + first + len(counts) - 1
    tree[low : high + 1] = counts
    while low > 1:
        low, high = low // 2, high // 2
        at = np.arange(low, high + 1)
        tree[at] = tree[2 * at] + tree[2 * at + 1]


def _is_border(before: str, after: str) -> bool:
    return len(after) > 1 and after[0] == " " and not after[1].isspace() and bool(before) and not before[-1].isspace()


def apply_edits(text: str, leaf_chars: Sequence[int], tree: np.ndarray, edits: Sequence[tuple], encode: Encoder) -> tuple[str, int]:
    """The new text and how many leaves were encoded anew; ``tree`` is changed in place."""
    ends = np.cumsum(leaf_chars)
    starts = ends - np.asarray(leaf_chars)
    edits = [(min(max(e[0] or 0, 0), len(text)), min(max(e[1] or 0, 0), len(text)), e[2] or "") for e in edits]
    edits.sort(key=lambda e: e[:2])  # insertions at one place keep their order
    for (_, last, _), (first, _, _) in zip(edits, edits[1:], strict=False):
        if first < last:
            raise ValueError("edits of one document overlap")
    out, done, at, redone = [], 0, 0, 0
    while at < len(edits):
        # the leaves that this edit, and edits that touch the same or the next leaf, change
        a = min(int(np.searchsorted(ends, edits[at][0], side="right")), len(ends) - 1)
        b, stop = a, at
        while True:
            while stop < len(edits) and (stop == at or b >= len(ends) - 2 or edits[stop][0] < ends[b + 1]):
                b = max(b, min(int(np.searchsorted(ends, max(edits[stop][1] - 1, edits[stop][0]), side="right")), len(ends) - 1))
                stop += 1
            new, place = [], int(starts[a])
            for first, last, replacement in edits[at:stop]:
                new += [text[place:first], replacement]
                place = max(last, first)
            new = "".join([*new, text[place : ends[b]]])
            # one leaf more on either side where the border is gone
            if a > 0 and starts[a] > done and not _is_border(text[starts[a] - 1 : starts[a]], new[:2] if len(new) > 1 else new + text[ends[b] : ends[b] + 1]):
                a -= 1
            elif b < len(ends) - 1 and not _is_border(new[-1:], text[ends[b] : ends[b] + 2]):
                b += 1
            else:
                break
        out += [text[done : starts[a]], new]
        done = int(ends[b])
        set_leaves(tree, a, [int(encode.counts([new])[0])] + [0] * (b - a))
        redone += b - a + 1
        at = stop
    return "".join([*out, text[done:]]), redone


def count_trees(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """The documents with ``leaf_chars`` and ``tree``: the state that edits are counted against."""
    small_batches(docs.sparkSession)
    kept = docs.drop("leaf_chars", "tree")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, CACHED_PIECES)
        for piece in pieces(batches, text_col):
            leaves = [cut_leaves(t or "") for t in piece.column(text_col).to_pylist()]
            counts = encode.counts([x for doc in leaves for x in doc])
            parts = np.split(counts, np.cumsum([len(doc) for doc in leaves])[:-1])
            chars = pa.array([[len(x) for x in doc] for doc in leaves], pa.list_(pa.int32()))
            trees = pa.array([build_tree(p) for p in parts], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*piece.columns, chars, trees], [*piece.schema.names, "leaf_chars", "tree"])

    return kept.mapInArrow(run, f"{fields}, {TREE}")


def recount(trees: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", edits_col: str = "edits") -> DataFrame:
    """Apply each document's edits: (doc_id, text, n_before, n_edits, n_tokens, n_leaves, n_redone, leaf_chars, tree).

    ``text`` is the edited text; ``leaf_chars`` and ``tree`` describe the original leaves with the new counts.
    """
    small_batches(trees.sparkSession)
    kind = trees.schema[id_col].dataType.simpleString()
    rows = trees.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), "leaf_chars", "tree", F.col(edits_col).cast(EDITS).alias("edits")
    )
    schema = f"doc_id {kind}, text string, n_before bigint, n_edits bigint, n_tokens bigint, n_leaves bigint, n_redone bigint, {TREE}"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, CACHED_PIECES)
        for piece in pieces(batches):
            texts, found = [], []
            trees_out = []
            for text, chars, tree, edits in zip(*(piece.column(c).to_pylist() for c in ("text", "leaf_chars", "tree", "edits")), strict=True):
                tree, edits = np.array(tree, np.int64), [(e["first"], e["last"], e["text"]) for e in edits or [] if e]
                before = int(tree[1])
                new, redone = apply_edits(text or "", chars, tree, edits, encode) if edits else (text or "", 0)
                texts.append(new)
                found.append((before, len(edits), int(tree[1]), len(chars), redone))
                trees_out.append(tree)
            numbers = [pa.array(x, pa.int64()) for x in zip(*found, strict=True)]
            trees_col = pa.array(trees_out, pa.list_(pa.int64()))
            names = ["doc_id", "text", "n_before", "n_edits", "n_tokens", "n_leaves", "n_redone", "leaf_chars", "tree"]
            columns = [piece.column("doc_id"), pa.array(texts, pa.string()), *numbers, piece.column("leaf_chars"), trees_col]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, schema)


def replacing_edits(
    docs: DataFrame, pattern: str, replacement: str, needs: str = "", text_col: str = "text", out: str = "edits"
) -> DataFrame:
    """The documents with one edit for each match of ``pattern``.

    ``needs`` is a pattern of one character that every match holds; texts without it are not searched further.
    """
    small_batches(docs.sparkSession)
    kept = docs.drop(out)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match, need = re.compile(pattern), re.compile(needs)
        found = lambda t: match.finditer(t) if need.search(t) else ()
        kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("text", pa.string())]))
        for piece in pieces(batches, text_col):
            edits = [[(m.start(), m.end(), replacement) for m in found(t or "")] for t in piece.column(text_col).to_pylist()]
            column = pa.array([[dict(zip(("first", "last", "text"), e, strict=True)) for e in doc] for doc in edits], kind)
            yield pa.RecordBatch.from_arrays([*piece.columns, column], [*piece.schema.names, out])

    return kept.mapInArrow(run, f"{fields}, `{out}` {EDITS}")
