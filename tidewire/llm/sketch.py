"""Fast similarity sketching: a fixed-size sketch of a set in O(n + t log t) hashes instead of O(n t).

Each set fills ``t`` coordinates.  In round i < t every element is hashed to one coordinate and offers the value
(i, hash); in round i >= t every element goes to coordinate i - t, so after 2t rounds no coordinate is empty.  A
coordinate keeps its smallest value, earlier rounds winning, and a set stops once all of its coordinates are filled:
large sets after one or two rounds.  Two sketches agree on a coordinate with the probability of the sets' Jaccard
similarity, and the share of agreeing coordinates is concentrated as for t independent hash functions.
"""

from __future__ import annotations

import numpy as np

from .textops import mix64, seeds

_U = np.uint64
_LOW = _U((1 << 48) - 1)


def fast_sketch(values: np.ndarray, bounds: np.ndarray, t: int) -> np.ndarray:
    """(n_sets, t) uint64 sketches of the non-empty sets values[bounds[k]:bounds[k+1]]; empty sets get zeros."""
    n = len(bounds) - 1
    table = np.full((n, t), ~_U(0), dtype=np.uint64)
    sizes = np.diff(bounds)
    table[sizes == 0] = 0
    live = np.flatnonzero(sizes)
    rows, elements = np.repeat(np.arange(n), sizes), values
    salts = seeds(2 * t, 37)
    flat = table.reshape(-1)
    for i in range(2 * t):
        if not len(live):
            break
        h = mix64(elements ^ salts[i])
        offer = (h & _LOW) | (_U(i) << _U(48))
        if i < t:
            np.minimum.at(flat, rows * t + (((h >> _U(32)) * _U(t)) >> _U(32)).astype(np.int64), offer)
        else:
            firsts = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
            own = rows[firsts]
            table[own, i - t] = np.minimum(table[own, i - t], np.minimum.reduceat(offer, firsts))
        still = (table[live] == ~_U(0)).any(axis=1)
        if not still.all():
            gone = np.zeros(n, dtype=bool)
            gone[live[~still]] = True
            live = live[still]
            keep = ~gone[rows]
            rows, elements = rows[keep], elements[keep]
    return table


def band_keys(sketches: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(n_sets, bands) uint64: one key for each band of ``rows`` coordinates; the band's number is part of the key."""
    steps = seeds(rows, 41)
    cut = sketches[:, : bands * rows].reshape(len(sketches), bands, rows)
    total = (mix64(cut) * steps).sum(axis=2, dtype=np.uint64) if rows else cut.sum(axis=2)
    return mix64(total + seeds(bands, 43))
