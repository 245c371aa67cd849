"""Byte-level BPE ids for whole Arrow columns, exactly those of the ``tokenizers`` library.

Texts are split into the vocabulary's pieces (a word with the space before it, a run of digits, a run of signs, white
space) by numpy passes over code points.  Each distinct piece goes through the library's BPE model once per worker;
a bounded table of pieces then turns millions of them into ids by a gather.  The classes of code points come from the
library's own regular expressions.  Texts that hold an added token's string are encoded by the library as a whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from tokenizers import Regex, Tokenizer, pre_tokenizers

from . import textops as T
from .common import only

#: Distinct pieces, and bytes of them, that a worker remembers before it starts over.
PIECES, PIECE_BYTES = 400_000, 12 << 20

_SIGN, _LETTER, _NUMBER, _SPACE = 0, 1, 2, 3
_SUFFIXES = {(115,), (116,), (109,), (100,), (114, 101), (118, 101), (108, 108)}  # 's 't 'm 'd 're 've 'll


def _byte_names() -> dict[int, int]:
    """Byte-level BPE writes each byte as one printable character: itself, or 256 and up in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: b if b in plain else next(rest) for b in range(256)}


@cache
def _classes() -> np.ndarray:
    """The class of every code point, as the library's regular expressions see it."""
    table = np.zeros(0x110000, dtype=np.uint8)
    kinds = [(kind, pre_tokenizers.Split(Regex(p), "removed", invert=True)) for kind, p in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+"))]
    for low in range(0, 0x110000, 0x800):
        if not 0xD800 <= low < 0xE000:  # surrogates are no characters
            text = "".join(map(chr, range(low, low + 0x800)))
            for kind, split in kinds:
                for _, (i, j) in split.pre_tokenize_str(text):
                    table[low + i : low + j] = kind
    return table


def piece_starts(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where pieces begin in a sequence of code points that holds the texts bounds[k]:bounds[k+1]."""
    n = len(points)
    kind = _classes()[points]
    head = np.zeros(n + 1, dtype=bool)
    head[bounds] = True
    before = np.concatenate(([0], points[:-1])) if n else points
    run = np.empty(n, dtype=bool)
    if n:
        run[0] = True
        np.not_equal(kind[1:], kind[:-1], out=run[1:])
    run |= head[:n]
    space = kind == _SPACE
    start = run.copy()
    # White space before text: its last character is a piece of its own, or the next piece's first if it is a blank.
    last = space & ~head[1:]
    last[: n - 1] &= ~space[1:]
    start |= last
    start &= ~(run & ~space & (before == 32) & ~head[:n])
    for q in np.flatnonzero((points == 39) & start & run).tolist():
        if q + 1 < n and not head[q + 1] and kind[q + 1] == _LETTER:
            for k in (1, 2):
                end = q + 1 + k
                if end <= n and not head[q + 2 : end].any() and tuple(points[q + 1 : end].tolist()) in _SUFFIXES:
                    start[q + 1] = False
                    if end < n and not head[end] and kind[end] == _LETTER:
                        start[end] = True
                    break
    return np.flatnonzero(start)


class Encoder:
    """Turns string columns into token ids; holds the table of known pieces."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._names = _byte_names()
        self.known = T.SpanTable(PIECES, PIECE_BYTES)
        self.place, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.mark, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.uint32)

    def _learn(self, pieces: list[bytes]) -> None:
        names, tokenize = self._names, self.model.tokenize
        found = [[t.id for t in tokenize(p.decode("latin-1").translate(names))] for p in pieces]
        size = np.array([len(f) for f in found], dtype=np.int64)
        self.place = np.concatenate((self.place, len(self.ids) + np.cumsum(size) - size))
        self.size = np.concatenate((self.size, size))
        self.ids = np.concatenate((self.ids, np.array([i for f in found for i in f], dtype=np.uint32)))
        self.mark = np.concatenate((self.mark, np.array([zlib.crc32(p) for p in pieces], dtype=np.uint64)))

    def _keep(self, rows: np.ndarray) -> None:
        size = self.size[rows]
        stops = np.concatenate(([0], np.cumsum(size)))
        self.ids = self.ids[np.repeat(self.place[rows] - stops[:-1], size) + np.arange(stops[-1])]
        self.place, self.size, self.mark = stops[:-1], size, self.mark[rows]

    def _slice(self, raw: bytes, text: str, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """ids, each text's first id, marks (hashes) of all pieces, each text's first piece."""
        starts = piece_starts(np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32), bounds)
        pieces = np.searchsorted(starts, bounds)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64), np.zeros(0, np.uint64), pieces
        data, at = np.frombuffer(raw, np.uint8), starts
        if len(text) != len(raw):
            at = np.flatnonzero((data & 0xC0) != 0x80)[starts]
        row = self.known.rows(data, at, np.append(at[1:], len(raw)), self._learn, self._keep)  # every byte is in a piece
        size = self.size[row]
        stops = np.concatenate(([0], np.cumsum(size)))
        ids = self.ids[np.repeat(self.place[row] - stops[:-1], size) + np.arange(stops[-1])]
        return ids, stops[pieces], self.mark[row], pieces

    def encode(self, column: pa.Array) -> Iterator[tuple[int, list[np.ndarray], np.ndarray, np.ndarray]]:
        """For row ranges in order: the first row, each row's ids (uint32), all pieces' marks (hashes), where each row's begin.

        Null rows are empty texts.
        """
        data, offsets = T.utf8(column)
        for i, j in T.row_slices(offsets):
            raw = data[offsets[i] : offsets[j]].tobytes()
            cut = offsets[i : j + 1] - offsets[i]
            text = raw.decode()
            if len(text) == len(raw):
                bounds = cut
            else:
                leads = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
                bounds = leads[cut]
            ids, stops, marks, pieces = self._slice(raw, text, bounds)
            rows = np.split(ids, stops[1:-1]) if j - i > 1 else [ids]
            if any(a in text for a in self.added):
                for k in range(j - i):
                    one = text[bounds[k] : bounds[k + 1]]
                    if any(a in one for a in self.added):
                        rows[k] = np.array(self.tokenizer.encode(one, add_special_tokens=False).ids, dtype=np.uint32)
            yield i, rows, marks, pieces


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file."""
    return only(("encoder", path), lambda: Encoder(path))


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
