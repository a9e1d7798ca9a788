"""Compressed files that can be read from any place: the seekable form of Zstandard files.

The content is cut into pieces of equal size and each piece is a frame of its own, so a reader opens only the pieces it needs.
A table of the frames ends the file, in a frame that other Zstandard readers skip.
"""

from __future__ import annotations

import struct

SUFFIX = ".zst"
PIECE_BYTES = 1 << 20
TABLE_MAGIC, FOOTER_MAGIC = 0x184D2A5E, 0x8F92EAB1


class PackedOutput:
    """Writes to ``out``; ``close`` adds the table and leaves ``out`` open."""

    def __init__(self, out, piece_bytes: int = PIECE_BYTES):
        import pyarrow as pa

        self.out, self.piece_bytes = out, piece_bytes
        self.codec, self.held, self.frames = pa.Codec("zstd", compression_level=3), bytearray(), []

    def write(self, data: bytes) -> None:
        self.held += data
        whole = len(self.held) - len(self.held) % self.piece_bytes
        for start in range(0, whole, self.piece_bytes):
            self._frame(bytes(self.held[start : start + self.piece_bytes]))
        del self.held[:whole]

    def _frame(self, piece: bytes) -> None:
        packed = self.codec.compress(piece, asbytes=True)
        self.out.write(packed)
        self.frames.append((len(packed), len(piece)))

    def close(self) -> None:
        if self.held:
            self._frame(bytes(self.held))
        rows = b"".join(struct.pack("<II", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, FOOTER_MAGIC)
        self.out.write(struct.pack("<II", TABLE_MAGIC, len(rows) + len(footer)) + rows + footer)


class PackedInput:
    """The content of a packed file, read like the plain one; ``size`` is the content's."""

    def __init__(self, f, name: str):
        import numpy as np
        import pyarrow as pa

        self.f, self.name, self.codec, self.at, self.held = f, name, pa.Codec("zstd"), 0, (-1, b"")
        n, described, magic = struct.unpack("<IBI", self._stretch(max(0, f.size() - 9), min(9, f.size())).rjust(9, b"\0"))
        if magic != FOOTER_MAGIC:
            raise ValueError(f"{name} has no table of frames: it cannot be read in parts")
        width = 12 if described & 0x80 else 8  # with checksums or without
        table = np.frombuffer(self._stretch(f.size() - 9 - n * width, n * width), dtype="<u4").reshape(n, width // 4)
        self.packed, self.content = (np.r_[0, np.cumsum(table[:, i].astype(np.int64))] for i in (0, 1))

    @property
    def size(self) -> int:
        return int(self.content[-1])

    def seek(self, at: int) -> None:
        self.at = at

    def read(self, n: int) -> bytes:
        import numpy as np

        parts, end = [], min(self.at + n, self.size)
        while self.at < end:
            i = int(np.searchsorted(self.content, self.at, side="right")) - 1
            piece = self._piece(i)[self.at - int(self.content[i]) :][: end - self.at]
            parts.append(piece)
            self.at += len(piece)
        return b"".join(parts)

    def _piece(self, i: int) -> bytes:
        if self.held[0] != i:
            packed = self._stretch(int(self.packed[i]), int(self.packed[i + 1] - self.packed[i]))
            self.held = i, self.codec.decompress(packed, int(self.content[i + 1] - self.content[i]), asbytes=True)
        return self.held[1]

    def _stretch(self, at: int, n: int) -> bytes:
        self.f.seek(max(0, at))
        found = self.f.read(n)
        if at < 0 or len(found) != n:
            raise OSError(f"{self.name} is shorter than its table of frames")
        return found


def opened(f, name: str):
    """``f`` for reading: its content where the name says that it is packed."""
    return PackedInput(f, name) if name.endswith(SUFFIX) else f
