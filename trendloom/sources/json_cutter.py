"""Cutting JSON text into its top-level elements, a piece of the text at a time.

``[a, b, …]`` gives a, b, …; objects one after another give the objects. An element is the bytes
that stand in the text, without the white space around it. A piece is classified with a few numpy
operations: which quotes are escaped, what lies inside strings, how deep each bracket is; only a
state of four numbers and the element that is still open are kept between pieces.
"""

from __future__ import annotations

import numpy as np

SPACE = b" \t\n\r"
MARK = b"\xef\xbb\xbf"


class BrokenJsonError(ValueError):
    """The text is not an array, or not objects one after another."""


def _table(values: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(values)] = True
    return table


_OPEN, _CLOSE, _BLANK = _table(b"[{"), _table(b"]}"), _table(SPACE)
_BEGINS = _table(b'{["-0123456789tfn')


class Cutter:
    """``feed`` gives the elements that a piece completes; ``finish`` says whether the text was whole."""

    def __init__(self) -> None:
        self.base: int | None = None  # 1 in an array, 0 where objects follow one another
        self.depth = 0
        self.in_string = False
        self.escape = False  # the next byte is escaped
        self.closed = False
        self.after_comma = False
        self.kept: list[bytes] = []

    def feed(self, piece: bytes) -> list[bytes]:
        if self.base is None:
            piece = self._begin(piece)
        if not piece:
            return []
        codes = np.frombuffer(piece, dtype=np.uint8)
        if self.closed:
            if not _BLANK[codes].all():
                raise BrokenJsonError("malformed JSON: text after the array")
            return []
        quote = codes == 0x22
        self._escaped(codes, quote)
        inside = (np.cumsum(quote) + self.in_string) & 1
        outside = inside == 0
        self.in_string = bool(inside[-1])
        opens, closes = _OPEN[codes] & outside, _CLOSE[codes] & outside
        depth = self.depth + np.cumsum(opens.astype(np.int64) - closes)
        if (depth < 0).any():
            raise BrokenJsonError("malformed JSON: a bracket closes that didn't open")
        self.depth = int(depth[-1])
        if self.base == 0:
            return self._objects(piece, np.flatnonzero(closes & (depth == 0)) + 1)
        return self._elements(piece, np.flatnonzero((codes == 0x2C) & outside & (depth == 1)), np.flatnonzero(closes & (depth == 0)))

    def _begin(self, piece: bytes) -> bytes:
        piece = b"".join(self.kept) + piece
        self.kept = []
        if len(piece) < len(MARK) and MARK.startswith(piece):
            self.kept = [piece]
            return b""
        piece = piece.removeprefix(MARK).lstrip(SPACE)
        if not piece:
            return b""
        if piece[:1] not in (b"[", b"{"):
            raise BrokenJsonError("malformed JSON: neither an array nor an object")
        self.base = int(piece[:1] == b"[")
        if self.base:
            self.depth = 1
            return piece[1:]
        return piece

    def _escaped(self, codes: np.ndarray, quote: np.ndarray) -> None:
        """Take escaped quotes out of ``quote``; of a run of backslashes every second one is escaped."""
        first, self.escape = self.escape, False
        slashes = np.flatnonzero(codes == 0x5C)
        if first:
            quote[0] = False
            slashes = slashes[1:] if len(slashes) and slashes[0] == 0 else slashes
        if len(slashes):
            ends = np.flatnonzero(np.diff(slashes, append=len(codes) + 1) != 1)
            runs = np.diff(ends, prepend=-1)
            after = slashes[ends[runs % 2 == 1]] + 1
            self.escape = bool(len(after) and after[-1] == len(codes))
            quote[after[after < len(codes)]] = False

    def _taken(self, piece: bytes, start: int, end: int) -> bytes:
        element = b"".join([*self.kept, piece[start:end]]).strip(SPACE)
        self.kept = []
        return element

    def _elements(self, piece: bytes, commas: np.ndarray, ends: np.ndarray) -> list[bytes]:
        out, start = [], 0
        for comma in commas[: np.searchsorted(commas, ends[0])] if len(ends) else commas:
            out.append(self._taken(piece, start, int(comma)))
            start, self.after_comma = int(comma) + 1, True
        if len(ends):
            if piece[ends[0] : ends[0] + 1] != b"]":
                raise BrokenJsonError("malformed JSON: the array is closed by another bracket")
            last = self._taken(piece, start, int(ends[0]))
            if last or self.after_comma:
                out.append(last)
            self.closed = True
            if piece[ends[0] + 1 :].strip(SPACE):
                raise BrokenJsonError("malformed JSON: text after the array")
        else:
            self.kept.append(piece[start:])
        if any(not e or not _BEGINS[e[0]] for e in out):
            raise BrokenJsonError("malformed JSON: an element is missing or is no JSON value")
        return out

    def _objects(self, piece: bytes, ends: np.ndarray) -> list[bytes]:
        out, start = [], 0
        for end in ends.tolist():
            out.append(self._taken(piece, start, end))
            start = end
        self.kept.append(piece[start:])
        if any(not e.startswith(b"{") for e in out):
            raise BrokenJsonError("malformed JSON: text between objects")
        return out

    def finish(self) -> None:
        """Raise if the text stopped before its end; a text of white space has no elements."""
        rest = b"".join(self.kept).strip(SPACE)
        whole = self.closed if self.base else not rest and self.depth == 0 and not self.in_string
        if not whole:
            raise BrokenJsonError("malformed JSON: the text stops before its end")
