"""Token ids of whole texts with the tokenizers library, through a table of words already encoded.

A byte-level BPE never joins bytes across the start of a pre-token. A pre-token starts at every single space or line feed
between other characters than white space, and at every full stop or comma behind a letter or digit. Cut there, each piece
of a text is encoded on its own; a piece seen before is looked up. Texts with any other space, line feed, full stop or
comma, and texts that hold the string of an added token (``<|endoftext|>``), are encoded as a whole, so the ids are always
those of the plain call, which gives such a string the id of its token.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator, Sequence
from itertools import chain, pairwise

import numpy as np

CACHED_PIECES = 1_200_000  # a memory bound (about 200 MB): a full table starts anew
_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, most: int = CACHED_PIECES) -> Encoder:
    """One encoder per Python worker and tokenizer file; its table holds about ``most`` pieces from now on."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    _ENCODERS[path].most = most
    return _ENCODERS[path]


class _Pieces(dict):
    """piece -> its number; new pieces are kept in ``new`` until they are encoded."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


def _cut(text: str) -> list[str]:
    pieces = text.replace(" ", "\0 ").replace("\n", "\0\n\0").replace(".", "\0.").replace(",", "\0,").split("\0")
    return pieces[1:] if not pieces[0] and len(pieces) > 1 else pieces  # the text starts with a place to cut


def _plain(piece: str) -> bool:
    """No white space at the ends but the space or line feed that the text was cut at."""
    inner = piece[1:] if piece[:1] == " " else piece
    return piece == "\n" or bool(inner) and not inner[0].isspace() and not inner[-1].isspace()


def _slices(ids: list[int], bounds: np.ndarray) -> Iterator[list[int]]:
    for first, last in pairwise(bounds.tolist()):
        yield ids[first:last]


def _sign_table() -> dict[int, str]:
    """The sign that a byte-level vocabulary writes for each byte: printable ones as they are, the others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    return {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(plain)))}


_SIGNS = _sign_table()
_SPACE = _SIGNS[32]


def _byte_signs(text: str) -> str:
    if text.isascii():  # letters, a space before them at most
        return _SPACE + text[1:] if text[0] == " " else text
    return text.encode().decode("latin-1").translate(_SIGNS)


class Encoder:
    def __init__(self, path: str, most: int = CACHED_PIECES):
        self.most = most
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        parts = json.loads(self.tokenizer.to_str())
        self.added = [t["content"] for t in parts["added_tokens"]]
        self.byte_level = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}.items() <= (parts["pre_tokenizer"] or {}).items() and not parts["normalizer"]
        self._clear()

    def _clear(self) -> None:
        self.pieces = _Pieces()
        self.ids = np.zeros(1 << 16, np.int32)
        self.starts = np.zeros(1 << 16, np.int64)
        self.lengths = np.zeros(1 << 16, np.int32)
        self.plain = np.zeros(1 << 16, bool)  # no white space at its ends
        self.stop = np.zeros(1 << 16, bool)  # starts with a full stop or comma
        self.word_end = np.zeros(1 << 16, bool)  # ends with a letter or digit
        self.used = self.known = 0

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)

    def _learn(self) -> None:
        new, self.pieces.new = self.pieces.new, []
        if not new:
            return
        # letters, with or without a space before them, are one pre-token and go straight to the model
        words = [p[p[:1] == " " :].isalpha() for p in new]
        found = [[t.id for t in self.model.tokenize(_byte_signs(p))] if w else None for p, w in zip(new, words, strict=True)]
        others = [p for p, w in zip(new, words, strict=True) if not w]
        if others:
            mixed = self.tokenizer.encode(others, is_pretokenized=True, add_special_tokens=False)
            at = np.searchsorted(np.array(mixed.word_ids, np.int64), np.arange(len(others) + 1))
            parts = _slices(mixed.ids, at)
            found = [next(parts) if f is None else f for f in found]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.int32, int(counts.sum()))
        known = self.known + len(new)
        for name in ("ids", "starts", "lengths", "plain", "stop", "word_end"):
            held, need = getattr(self, name), self.used + len(ids) if name == "ids" else known
            if need > len(held):
                setattr(self, name, np.concatenate([held, np.zeros(max(need - len(held), len(held)), held.dtype)]))
        to = slice(self.known, self.known + len(new))
        self.ids[self.used : self.used + len(ids)] = ids
        self.lengths[to] = counts
        self.starts[to] = self.used + np.cumsum(counts) - counts
        self.plain[to] = [w or _plain(p) for p, w in zip(new, words, strict=True)]
        self.stop[to] = [not w and p[:1] in (".", ",") for p, w in zip(new, words, strict=True)]
        self.word_end[to] = [w or p[-1:].isalnum() for p, w in zip(new, words, strict=True)]
        self.known += len(new)
        self.used += len(ids)

    def numbers(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pieces of all texts, and how many each text has."""
        if len(self.pieces) > self.most:
            self._clear()
        look = self.pieces.__getitem__
        parts, counts = [], []
        for text in texts:
            # a text with the cutting mark or an added token in it goes as a whole
            cut = [""] if "\0" in text or any(t in text for t in self.added) else _cut(text)
            parts.append(np.fromiter(map(look, cut), np.int64, len(cut)))
            counts.append(len(cut))
        self._learn()
        return (np.concatenate(parts) if parts else np.zeros(0, np.int64)), np.array(counts, np.int64)

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each text has."""
        if not self.byte_level:
            found = [self.whole(t) for t in texts]
            return np.concatenate([np.zeros(0, np.int32), *found]), np.array([len(f) for f in found], np.int64)
        numbers, counts = self.numbers(texts)
        per_piece = self.lengths[numbers].astype(np.int64)
        ends = np.cumsum(counts)
        wrong = ~self.plain[numbers]
        wrong[1:] |= self.stop[numbers[1:]] & ~self.word_end[numbers[:-1]]
        odd = np.add.reduceat(wrong, ends - counts) if len(counts) else wrong
        total = np.cumsum(per_piece)
        sizes = np.diff(np.concatenate([[0], total[ends - 1]])) if len(counts) else np.zeros(0, np.int64)
        ids = self.ids[np.repeat(self.starts[numbers] - (total - per_piece), per_piece) + np.arange(total[-1] if len(total) else 0)]
        if not odd.any():
            return ids, sizes
        parts = np.split(ids, np.cumsum(sizes)[:-1])
        for i in np.flatnonzero(odd):
            parts[i] = self.whole(texts[i])
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)

    def counts(self, texts: Sequence[str]) -> np.ndarray:
        """How many ids each text has."""
        return self.encode(texts)[1]
