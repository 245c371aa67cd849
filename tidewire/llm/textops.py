"""Vectorised text kernels over Arrow string columns.

Everything here works on whole batches: numpy passes over the UTF-8 buffer (or its code points), never a Python
loop per character.  Callers cut a batch into row ranges of about ``SLICE_BYTES`` with :func:`row_slices`, so the
working memory of a Python worker is bounded by the slice (or by one document where a document is longer).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES, SLICE_ROWS = 1 << 18, 1024

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
#: Spans of up to so many bytes are hashed 8 bytes at a time for all spans at once, longer ones each by blake2b.
_LONG = 128
#: Masks that keep the first k bytes of a little-endian word of 8.
_FIRST = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, elementwise on uint64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def seeds(n: int, salt: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * _U(0xD1342543DE82EF95) + _U(salt))


_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the int64 offsets of its rows; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw, ends


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES, rows: int = SLICE_ROWS) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``rows`` rows and ``limit`` bytes each, or of one longer row."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), i + rows, n)
        yield i, j
        i = j


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end) of ``data`` (uint8).

    A chain of mix64 over the span's words of 8 bytes, from a state that holds its length: one-to-one for spans of up
    to 8 bytes, and without the structure of a sum of powers, which patterned texts make collide for every base.
    """
    size = (ends - starts).astype(np.int64)
    h = mix64(size.astype(np.uint64) * _ODD + _U(salt))
    lanes = _lanes(data)
    live = np.flatnonzero((size > 0) & (size <= _LONG))
    at, left = starts[live], size[live]
    while len(live):
        h[live] = mix64(h[live] * _ODD ^ (lanes[at] & _FIRST[np.minimum(left, 8)]))
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    for k in np.flatnonzero(size > _LONG).tolist():
        digest = hashlib.blake2b(data[starts[k] : ends[k]], digest_size=8, salt=salt.to_bytes(8, "little")).digest()
        h[k] = int.from_bytes(digest, "little")
    return h


def _lanes(data: np.ndarray) -> np.ndarray:
    """The little-endian 8 bytes from every position of ``data`` on, zeros behind its end."""
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = data
    return np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))


def same_spans(a: np.ndarray, at: np.ndarray, b: np.ndarray, bt: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes of ``a`` (uint8) from ``at`` are those of ``b`` from ``bt``, for each span."""
    equal = np.ones(len(size), dtype=bool)
    left, right = _lanes(a), _lanes(b)
    live = np.flatnonzero((size > 0) & (size <= _LONG))
    i, j, rest = at[live], bt[live], size[live]
    while len(live):
        equal[live] &= (left[i] ^ right[j]) & _FIRST[np.minimum(rest, 8)] == 0
        more = rest > 8
        live, i, j, rest = live[more], i[more] + 8, j[more] + 8, rest[more] - 8
    for k in np.flatnonzero(size > _LONG).tolist():
        equal[k] = (a[at[k] : at[k] + size[k]] == b[bt[k] : bt[k] + size[k]]).all()
    return equal


class SpanTable:
    """A growing table of byte spans: a hash finds a span's row, its bytes then decide.

    ``rows`` gives a row number to each span; new spans get new rows and go to ``learn``, which keeps whatever is
    known of them in columns of the same order.  Beyond ``most`` spans or ``most_bytes`` the table forgets those that
    one call alone has asked for; ``keep`` is told which rows stay.
    """

    def __init__(self, most: int, most_bytes: int) -> None:
        self.most, self.most_bytes, self.salt = most, most_bytes, 101
        self._clear()

    def _clear(self) -> None:
        self.hashes, self.order = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # ascending; the rows they lead to
        self.blob, self.ends = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        self.asked = np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.asked)

    def _shrink(self, keep) -> None:
        stay = np.flatnonzero(self.asked > 1)
        size = np.diff(self.ends)[stay]
        if len(stay) > self.most // 2 or size.sum() > self.most_bytes // 2:
            stay, size = stay[:0], size[:0]
        starts = self.ends[stay]
        ends = np.concatenate(([0], np.cumsum(size)))
        self.blob, self.ends = self.blob[np.repeat(starts - ends[:-1], size) + np.arange(ends[-1])], ends
        self.asked = np.ones(len(stay), np.int64)
        hashes = span_hashes(self.blob, ends[:-1], ends[1:], self.salt)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        keep(stay)

    def _found(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(hashes), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], -1)

    def rows(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, learn, keep) -> np.ndarray:
        size = ends - starts
        while True:
            hashes = span_hashes(data, starts, ends, self.salt)
            distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
            row = self._found(distinct)
            old = np.flatnonzero(row >= 0)
            a = first[old]
            at = self.ends[row[old]]
            sound = (self.ends[row[old] + 1] - at == size[a]).all() and same_spans(data, starts[a], self.blob, at, size[a]).all()
            mate = first[back]
            if sound and (size[mate] == size).all() and same_spans(data, starts, data, starts[mate], size).all():
                break
            # Different spans of one hash: start over with another hash.
            self.salt += 1
            self._clear()
            keep(np.zeros(0, np.int64))
        new = np.flatnonzero(row < 0)
        if len(new) and len(self) and (len(self) + len(new) > self.most or len(self.blob) + size[first[new]].sum() > self.most_bytes):
            self._shrink(keep)
            row = self._found(distinct)
            new = np.flatnonzero(row < 0)
        if len(new):
            raw = data.tobytes()
            spans = [raw[i:j] for i, j in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)]
            row[new] = len(self) + np.arange(len(new))
            self.blob = np.concatenate((self.blob, np.frombuffer(b"".join(spans), np.uint8)))
            self.ends = np.concatenate((self.ends, self.ends[-1] + np.cumsum(size[first[new]])))
            self.asked = np.concatenate((self.asked, np.zeros(len(new), np.int64)))
            at = np.searchsorted(self.hashes, distinct[new])
            self.hashes, self.order = np.insert(self.hashes, at, distinct[new]), np.insert(self.order, at, row[new])
            learn(spans)
        self.asked[row] += 1
        return row[back]


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the white-space separated words of some rows, and where each row's words begin (n_rows + 1).

    ``offsets`` are relative to ``data``.  Words are runs of bytes other than space and 0x09-0x0D; with ``lower``
    A-Z count as a-z.
    """
    n = len(data)
    solid = ~IS_SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    starts = np.flatnonzero(solid & (edge[:n] | ~np.concatenate(([False], solid[:-1])))) if n else np.zeros(0, np.int64)
    ends = np.flatnonzero(solid & (edge[1:] | ~np.concatenate((solid[1:], [False])))) + 1 if n else starts
    return span_hashes(_LOWERED[data] if lower else data, starts, ends), np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words of each row, with repeats, and where each row's begin.

    A row with fewer words has its whole sequence as one shingle; a row without words has none.
    """
    steps = seeds(width, 23)
    n = np.diff(bounds)
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    out = np.concatenate(([0], np.cumsum(count)))
    first = np.repeat(bounds[:-1] - out[:-1], count) + np.arange(out[-1])
    room = np.repeat(np.minimum(n, width), count)
    total = room.astype(np.uint64)
    short = bool((room < width).any())
    for k in range(width):
        if short:
            at = np.minimum(first + k, max(len(hashes) - 1, 0))
            total += np.where(k < room, hashes[at] * steps[k], _U(0)) if len(at) else total
        else:
            total += hashes[first + k] * steps[k]
    return mix64(total), out


def sorted_sets(hashes: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Each row's distinct hashes in ascending order."""
    found = []
    for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        one = np.sort(hashes[i:j])
        if len(one) > 1:
            keep = np.empty(len(one), dtype=bool)
            keep[0] = True
            np.not_equal(one[1:], one[:-1], out=keep[1:])
            one = one[keep]
        found.append(one)
    return found
