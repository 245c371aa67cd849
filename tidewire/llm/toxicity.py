"""Toxicity by a subsequence string kernel, a support vector machine and Nystroem landmarks.

Two words are alike as far as they share subsequences of 3 and 4 characters, each weighing less the more it is gapped,
so spelled-out, hyphenated and padded insults and unseen inflections stay close to the ones in the training texts.  A
document is a sequence of units: words, stripped of signs, and runs of three or more single characters taken as one
word.  Its kernel with a landmark word sums the string kernels of its different units with the landmark; its kernel
with a landmark of two words is the best product over neighbouring units.  A linear support vector machine learns on
these Nystroem features from the labels of whole documents, so one word that clean texts never have and several words
that they have now and then both count.

Landmarks are the words and word pairs whose support among toxic documents exceeds that among clean ones by more than
the largest excess under shuffled labels; near copies share one vote.  A landmark may occur in clean texts: the test
is of ratios, and the machine weighs it.

Each distinct unit's kernels are computed once per worker, in a bounded table; documents only look them up.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import held_out, only, small

#: At most so many labelled documents of each class are learnt from, the first in the order of a hash of doc_id, and
#: at most so many bytes of text.
TOXIC_SAMPLE, CLEAN_SAMPLE, SAMPLE_BYTES = 2000, 3000, 48 << 20
#: Landmark words and landmark pairs.
LANDMARKS, PAIRS = 64, 16
#: The base rate where there is no label at all.
UNKNOWN = 0.1
DECAY = 0.7
#: Longer units go by overlapping windows of so many characters, in training and in use.
LONGEST = 24
#: Kernels under this count as 0; a further landmark has to be less alike than NEW_MARK to all that are chosen.
ALIKE, NEW_MARK = 0.42, 0.8
#: A pair of words is compared if it shares this part of the landmark's neighbouring and next-but-one characters.
SHARED = 0.5
#: Share of toxic documents among those with a word like the landmark from which the landmark alone is an example.
PURE = 0.95
#: Copies of each such landmark with one character put in at random, as further examples.
PADDED = 4
#: Distinct units, and bytes of them, that a worker remembers.
KNOWN, KNOWN_BYTES = 500_000, 16 << 20

_SIGN = np.zeros(256, dtype=bool)
_SIGN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def units(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end bytes of the units of the texts bounds[k]:bounds[k+1], in order of start, and their text."""
    n = len(data)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    solid = ~T.IS_SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[bounds] = True
    starts = np.flatnonzero(solid & (edge[:n] | ~np.concatenate(([False], solid[:-1]))))
    ends = np.flatnonzero(solid & (edge[1:] | ~np.concatenate((solid[1:], [False])))) + 1
    core = solid & ~_SIGN[data]
    at = np.arange(n + 1)
    first = np.minimum.accumulate(np.append(np.where(core, at[:n], n), n)[::-1])[::-1]
    last = np.maximum.accumulate(np.append(0, np.where(core, at[1:], 0)))
    a, b = first[starts], last[ends]
    keep = a < b
    keep &= a < ends
    a, b = a[keep], b[keep]
    row = np.searchsorted(bounds, a, side="right") - 1
    # Runs of at least three single characters of one text.
    single = b - a == 1
    joined = np.flatnonzero(single[:-1] & single[1:] & (row[:-1] == row[1:])) if len(a) > 2 else np.zeros(0, np.int64)
    if len(joined):
        cut = np.flatnonzero(np.diff(joined) != 1)
        lows, highs = joined[np.append(0, cut + 1)], joined[np.append(cut, len(joined) - 1)] + 1
        long = highs - lows >= 2
        if long.any():
            a, b = np.concatenate((a, a[lows[long]])), np.concatenate((b, b[highs[long]]))
            order = np.argsort(a, kind="stable")
            a, b = a[order], b[order]
            row = np.searchsorted(bounds, a, side="right") - 1
    return a, b, row


def plain(unit: bytes) -> str:
    text = unit.decode("utf-8", "replace").lower()
    return text if text.isalnum() else "".join(c for c in text if c.isalnum())


def _codes(texts: Sequence[str], length: int, fill: int) -> np.ndarray:
    out = np.full((len(texts), length), fill, dtype=np.int32)
    for k, t in enumerate(texts):
        out[k, : len(t)] = [ord(c) for c in t[:length]]
    return out


def _kernel(left: np.ndarray, right: np.ndarray, paired: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Unnormalised subsequence kernels of lengths 3 and 4 between rows of codes: all with all, or row with row.

    The recursion of Lodhi et al.; padding has to differ on the two sides, so it never matches.
    """
    shape = (len(left),) if paired else (len(left), len(right))
    m, d = right.shape[1], np.float32(DECAY)
    before = [[np.ones(shape, np.float32)] * (m + 1)] + [[np.zeros(shape, np.float32)] * (m + 1) for _ in range(3)]
    total = [np.zeros(shape, np.float32), np.zeros(shape, np.float32)]
    for i in range(left.shape[1]):
        x = left[:, i] if paired else left[:, i, None]
        same = [(x == (right[:, j] if paired else right[None, :, j])).astype(np.float32) * (d * d) for j in range(m)]
        now = [before[0]]
        for q in (1, 2, 3, 4):
            row, run = [before[q][0]] if q < 4 else [], np.zeros(shape, np.float32)
            for j in range(m):
                gain = same[j] * before[q - 1][j]
                if q >= 3:
                    total[q - 3] += gain
                if q < 4:
                    run = run * d + gain
                    row.append(before[q][j + 1] * d + run)
            if q < 4:
                now.append(row)
        before = now
    return total[0], total[1]


def _self(texts: Sequence[str], length: int) -> tuple[np.ndarray, np.ndarray]:
    own = _codes(texts, length, -1)
    return _kernel(own, np.where(own == -1, -2, own), paired=True)


def _prints(codes: np.ndarray) -> np.ndarray:
    """(n, 2) uint64: bit sets of the hashed pairs of neighbouring and next-but-one characters; codes < 0 are padding."""
    out = np.zeros((len(codes), 2), dtype=np.uint64)
    for gap in (1, 2):
        for i in range(codes.shape[1] - gap):
            a, b = codes[:, i], codes[:, i + gap]
            h = ((a.astype(np.int64) * 1_000_003 + b) * 0x9E3779B1 >> 15) & 127
            bit = np.where((a >= 0) & (b >= 0), np.uint64(1) << (h & 63).astype(np.uint64), np.uint64(0))
            np.bitwise_or(out[:, 0], np.where(h < 64, bit, np.uint64(0)), out=out[:, 0])
            np.bitwise_or(out[:, 1], np.where(h >= 64, bit, np.uint64(0)), out=out[:, 1])
    return out


class Marks:
    """Landmark words, and the kernels of any words with them."""

    def __init__(self, words: Sequence[str]) -> None:
        self.words = [w[:LONGEST] for w in words]
        sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        self.codes = _codes(self.words, int(sizes.max(initial=1)), -2)
        self.sizes = sizes
        self.norms = _self(self.words, int(sizes.max(initial=1)))
        self.prints = _prints(self.codes)
        self.need = np.ceil(SHARED * np.bitwise_count(self.prints).sum(axis=1)).astype(np.int64)

    def _short(self, texts: Sequence[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.words)), dtype=np.float32)
        sizes = np.array([len(t) for t in texts])
        for n in np.unique(sizes[sizes >= 3]).tolist():
            rows = np.flatnonzero(sizes == n)
            for at in range(0, len(rows), 4096):
                some = rows[at : at + 4096]
                left = np.frombuffer("".join([texts[k] for k in some]).encode("utf-32-le", "surrogatepass"), np.int32).reshape(-1, n)
                mine = _prints(left)
                shared = sum(np.bitwise_count(mine[:, None, k] & self.prints[None, :, k]).astype(np.int64) for k in (0, 1))
                u, m = np.nonzero(shared >= self.need)
                if not len(u):
                    continue
                used, back = np.unique(u, return_inverse=True)
                own = _kernel(left[used], left[used], paired=True)
                for low, high in ((0, 8), (8, 13), (13, LONGEST)):
                    part = np.flatnonzero((self.sizes[m] > low) & (self.sizes[m] <= high))
                    for cut in np.array_split(part, max(1, len(part) // 8000)):
                        if not len(cut):
                            continue
                        i, j = u[cut], m[cut]
                        both = _kernel(left[i], self.codes[j][:, : int(self.sizes[j].max())], paired=True)
                        total = np.zeros(len(cut), np.float32)
                        for k, norm, marks in zip(both, own, self.norms, strict=True):
                            scale = np.sqrt(norm[back[cut]] * marks[j])
                            total += np.divide(k, scale, out=np.zeros_like(k), where=scale > 0) / 2
                        out[some[i], j] = total
        return np.where(out >= ALIKE, out, np.float32(0))

    def alike(self, texts: Sequence[str]) -> np.ndarray:
        """(n, landmarks): normalised kernels (the mean of lengths 3 and 4), 0 where under ALIKE; long texts by windows."""
        if not self.words or not len(texts):
            return np.zeros((len(texts), len(self.words)), np.float32)
        pieces, owner = [], []
        for k, t in enumerate(texts):
            for at in range(0, max(1, len(t) - LONGEST // 2), LONGEST // 2):
                pieces.append(t[at : at + LONGEST])
                owner.append(k)
        return np.maximum.reduceat(self._short(pieces), np.searchsorted(owner, np.arange(len(texts))), axis=0)


class _Units:
    """A worker's or a training run's table of units: which resemble a landmark, and how much."""

    def __init__(self, marks: Marks) -> None:
        self.marks = marks
        self.table = T.SpanTable(KNOWN, KNOWN_BYTES)
        self.hot = np.zeros(0, np.int32)  # a unit's row of alike, or -1
        self.alike = np.zeros((0, len(marks.words)), np.float32)

    def _learn(self, spans: list[bytes]) -> None:
        found = self.marks.alike([plain(s) for s in spans])
        some = found.any(axis=1)
        self.hot = np.concatenate((self.hot, np.where(some, len(self.alike) + np.cumsum(some) - 1, -1).astype(np.int32)))
        self.alike = np.concatenate((self.alike, found[some]))

    def _keep(self, rows: np.ndarray) -> None:
        hot = self.hot[rows]
        some = hot >= 0
        self.alike = self.alike[hot[some]]
        self.hot = np.where(some, np.cumsum(some) - 1, -1).astype(np.int32)

    def hits(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the units that resemble a landmark: text, place among all units, kernels; and each text's units."""
        a, b, row = units(data, bounds)
        n = np.bincount(row, minlength=len(bounds) - 1) if len(a) else np.zeros(len(bounds) - 1, np.int64)
        if not len(a):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32), n
        rows = self.table.rows(T._LOWERED[data], a, b, self._learn, self._keep)
        hot = self.hot[rows]
        at = np.flatnonzero(hot >= 0)
        return row[at], at, hot[at], n


def _features(units_: _Units, words: np.ndarray, pairs: np.ndarray, root: np.ndarray, found: tuple) -> np.ndarray:
    """(n, features) of texts: Nystroem and strongest-unit features of ``words``, pairs, counts."""
    row, at, hot, n = found
    alike = units_.alike
    texts, width = len(n), len(words)
    sums, most, count = np.zeros((texts, width), np.float32), np.zeros((texts, width), np.float32), np.zeros((texts, 2), np.float32)
    twos = np.zeros((texts, len(pairs)), np.float32)
    if len(row):
        once = np.unique(row * len(alike) + hot)
        own, kernels = once // len(alike), alike[once % len(alike)][:, words]
        np.add.at(sums, own, kernels)
        np.maximum.at(most, own, kernels)
        best = kernels.max(axis=1, initial=0)
        np.add.at(count, own, np.stack((best > 0, best**4), axis=1).astype(np.float32))
        if len(pairs):
            near = np.flatnonzero((row[1:] == row[:-1]) & (at[1:] == at[:-1] + 1))
            np.maximum.at(twos, row[near], alike[hot[near]][:, pairs[:, 0]] * alike[hot[near + 1]][:, pairs[:, 1]])
    size = np.log1p(n)[:, None] / 8
    counts = np.log1p(count)
    return np.hstack(((1 - np.exp(-sums)) @ root, most**4, twos, counts, counts * (1 - np.minimum(size, 1)), size)).astype(np.float64)


@dataclass(frozen=True)
class Model:
    """Landmarks (words first, then the members of pairs), weights on the features of documents, and calibration."""

    marks: tuple[str, ...]
    words: int
    pairs: tuple[tuple[int, int], ...]
    root: np.ndarray
    weights: np.ndarray
    slope: float
    shift: float
    key: str

    def margins(self, units_: _Units, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        if not self.marks:
            return np.full(len(bounds) - 1, self.weights[-1])
        pairs = np.array(self.pairs, dtype=np.int64).reshape(-1, 2)
        x = _features(units_, np.arange(self.words), pairs, self.root, units_.hits(data, bounds))
        return x @ self.weights[:-1] + self.weights[-1]

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Squared-hinge linear machine by Newton steps on the active rows; the last weight is the bias."""
    x = np.hstack((x, np.ones((len(x), 1))))
    w = np.zeros(x.shape[1])
    ridge = np.diag([1.0] * (x.shape[1] - 1) + [1e-3])
    was = None
    for _ in range(rounds):
        active = y * (x @ w) < 1
        if was is not None and (active == was).all():
            break
        was, xa, ca = active, x[active], cost[active]
        w = np.linalg.solve(ridge + (xa * ca[:, None]).T @ xa, (xa * ca[:, None]).T @ y[active])
    return w


def _calibrate(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Platt's sigmoid with his smoothed targets, by Newton steps."""
    n1, n0 = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack((margin, np.ones_like(margin)), axis=1)
    w = np.array([2.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - target)) + 1e-3 * w * [1, 0]
        hess = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w = w - step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 1e-3)), float(w[1])


def _excess(toxic: np.ndarray, clean: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """The likelihood-ratio statistic of a support among n1 and n0 documents, 0 where the toxic share isn't the larger."""

    def part(k: np.ndarray, n: float, p: np.ndarray) -> np.ndarray:
        p = np.clip(p, 1e-12, 1 - 1e-12)
        return k * np.log(p) + (n - k) * np.log1p(-p)

    p1, p0, p = toxic / n1, clean / n0, (toxic + clean) / (n1 + n0)
    found = 2 * (part(toxic, n1, p1) + part(clean, n0, p0) - part(toxic, n1, p) - part(clean, n0, p))
    return np.where(p1 > p0, found, 0.0)


def _significant(doc: np.ndarray, item: np.ndarray, items: int, toxic: np.ndarray, weight: np.ndarray, least: float = 3, rounds: int = 8) -> np.ndarray:
    """Items by falling excess, those above the largest excess in some rounds of shuffled labels.

    (doc, item) are distinct; a document's vote is its ``weight``.  Items of fewer than ``least`` votes are left out.
    """

    def excess(labels: np.ndarray) -> np.ndarray:
        own = labels[doc]
        t = np.bincount(item, weight[doc] * own, minlength=items)
        c = np.bincount(item, weight[doc] * ~own, minlength=items)
        n1, n0 = (weight * labels).sum(), (weight * ~labels).sum()
        return np.where(t >= least - 0.01, _excess(np.minimum(t, n1), np.minimum(c, n0), n1, n0), 0.0)

    draw = np.random.default_rng(5)
    level = max(excess(draw.permutation(toxic)).max(initial=0.0) for _ in range(rounds))
    found = excess(toxic)
    order = np.lexsort((np.arange(items), -found))
    return order[found[order] > level]


def _votes(doc: np.ndarray, mark: np.ndarray, docs: int) -> np.ndarray:
    """1 / the number of documents that are near copies, by banded min-hashes of their units' hashes."""
    most = np.ones(docs)
    for band in range(6):
        key = np.zeros(docs, np.uint64)
        for k in range(4):
            low = np.full(docs, ~np.uint64(0))
            np.minimum.at(low, doc, T.mix64(mark ^ T.seeds(1, 83 + 4 * band + k)[0]))
            key = T.mix64(key ^ low)
        _, back, size = np.unique(key, return_inverse=True, return_counts=True)
        most = np.maximum(most, size[back])
    return 1 / most


def _padded(marks: Sequence[str]) -> list[str]:
    """The landmarks with one of their characters or of the alphabet put in somewhere."""
    draw = np.random.default_rng(71)
    out = []
    for m in marks:
        for _ in range(PADDED):
            at = int(draw.integers(1, len(m)))
            out.append(m[:at] + "abcdefghijklmnopqrstuvwxyz"[int(draw.integers(26))] + m[at:])
    return out


def _buffer(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)


def _occurrences(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(text, unit) of all units in order, and the units; those of under three characters are -1."""
    names: list[str] = []
    ids: dict[str, int] = {}
    own = np.zeros(0, np.int64)

    def learn(spans: list[bytes]) -> None:
        nonlocal own
        found = []
        for s in spans:
            p = plain(s)
            if len(p) >= 3 and p not in ids:
                ids[p] = len(names)
                names.append(p)
            found.append(ids.get(p, -1))
        own = np.concatenate((own, np.array(found, np.int64)))

    table = T.SpanTable(1 << 62, 1 << 62)
    docs, spans = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    data, bounds = _buffer(texts)
    for i, j in T.row_slices(bounds):
        cut = T._LOWERED[data[bounds[i] : bounds[j]]]
        a, b, row = units(cut, bounds[i : j + 1] - bounds[i])
        if len(a):
            docs.append(row + i)
            spans.append(table.rows(cut, a, b, learn, lambda rows: None))
    return np.concatenate(docs), own[np.concatenate(spans)], names


def _distinct(doc: np.ndarray, item: np.ndarray, items: int) -> tuple[np.ndarray, np.ndarray]:
    once = np.unique(doc * items + item)
    return once // max(items, 1), once % max(items, 1)


def _chosen(names: Sequence[str]) -> list[str]:
    """Up to LANDMARKS of the names, in order, none too like one before it."""
    some = list(names[: 8 * LANDMARKS])
    gram = Marks(some).alike([n[:LONGEST] for n in some])
    taken: list[int] = []
    for k in range(len(some)):
        if len(taken) < LANDMARKS and (not taken or gram[k, taken].max() < NEW_MARK):
            taken.append(k)
    return [some[k] for k in taken]


def train(texts: Sequence[str], labels: Sequence[int], prevalence: float | None = None) -> Model:
    """Learns from document labels; ``prevalence`` is the share of toxic documents to calibrate for."""
    order = sorted(set(zip(texts, labels, strict=True)))
    toxic = np.array([bool(y) for _, y in order], dtype=bool)
    rate = prevalence if prevalence is not None else toxic.mean() if len(order) else UNKNOWN
    rate = float(np.clip(rate, 1e-4, 1 - 1e-4))
    none = Model((), 0, (), np.zeros((0, 0)), np.array([-1.0]), 1.0, math.log(rate / (1 - rate)) + 1.0, "none")
    if not 0 < toxic.sum() < len(order):
        return none
    texts = [t for t, _ in order]
    doc, unit, names = _occurrences(texts)
    real = unit >= 0
    n = len(names)
    own_doc, own_unit = _distinct(doc[real], unit[real], n)
    hashes = T.mix64(np.arange(1, n + 1, dtype=np.uint64))
    weight = _votes(own_doc, hashes[own_unit], len(order))
    words = _chosen([names[k] for k in _significant(own_doc, own_unit, n, toxic, weight)])
    # Pairs of neighbouring units that tell more than their members: neither is like a landmark word.
    covered = np.zeros(n, dtype=bool)
    marks = Marks(words)
    for at in range(0, n if words else 0, 8192):
        covered[at : at + 8192] = marks.alike(names[at : at + 8192]).any(axis=1)
    near = np.flatnonzero((doc[1:] == doc[:-1]) & (unit[1:] >= 0) & (unit[:-1] >= 0))
    left, right = unit[near], unit[near + 1]
    plain_ = ~covered[left] & ~covered[right] & (left != right)
    codes, back = np.unique(left[plain_] * n + right[plain_], return_inverse=True)
    best = codes[_significant(*_distinct(doc[near][plain_], back, len(codes)), len(codes), toxic, weight, 8)[:PAIRS]]
    twos = [(names[c // n], names[c % n]) for c in best.tolist()]
    if not words and not twos:
        return none
    members = sorted({w for pair in twos for w in pair})
    marks = Marks([*words, *members])
    gram = marks.alike([w[:LONGEST] for w in words])[:, : len(words)].astype(float)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    root = vectors / np.sqrt(np.maximum(values, 0.05)) @ vectors.T
    pairs = np.array([(len(words) + members.index(a), len(words) + members.index(b)) for a, b in twos], dtype=np.int64).reshape(-1, 2)
    units_ = _Units(marks)

    def features(some: Sequence[str]) -> np.ndarray:
        data, bounds = _buffer(some)
        parts = [_features(units_, np.arange(len(words)), pairs, root, units_.hits(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])) for i, j in T.row_slices(bounds)]
        return np.concatenate(parts)

    x, y = features(texts), np.where(toxic, 1.0, -1.0)
    # Landmarks that by themselves tell a toxic document are examples alone, also with a character put in.
    strong = x[:, len(words) : 2 * len(words)] > 0.8**4  # some unit is much like the landmark
    purity = ((strong * (weight * toxic)[:, None]).sum(axis=0) + rate) / ((strong * weight[:, None]).sum(axis=0) + 1)
    pure = [w for w, p in zip(words, purity, strict=True) if p >= PURE]
    filler = " and the of to in it" * 8
    extra = features([f"{filler} {w}" for w in [*pure, *_padded(pure)]]) if pure else np.zeros((0, x.shape[1]))
    side = (weight * toxic).sum() / max(1, len(extra)) * 0.1
    cost = weight * np.where(toxic, max(1.0, (weight * ~toxic).sum() / (weight * toxic).sum() / 3), 1.0)

    def fitted(rows: np.ndarray) -> np.ndarray:
        return _svm(np.vstack((x[rows], extra)), np.append(y[rows], np.ones(len(extra))), 4.0 * np.append(cost[rows], np.full(len(extra), side)))

    # Calibrated on margins of documents that the machine hasn't seen, near copies on one side; landmarks are shared.
    fold = np.array([zlib.crc32(t.encode()[:64]) % 3 for t in texts])
    margin = np.zeros(len(order))
    for k in range(3):
        rest = np.flatnonzero(fold != k)
        w = fitted(rest) if 0 < toxic[rest].sum() < len(rest) else fitted(np.arange(len(order)))
        margin[fold == k] = x[fold == k] @ w[:-1] + w[-1]
    w = fitted(np.arange(len(order)))
    share = (weight * toxic).sum() / weight.sum()
    slope, shift = _calibrate(margin, y, weight * np.where(toxic, rate / share, (1 - rate) / (1 - share)))
    key = hashlib.blake2b(repr((marks.words, pairs.tolist())).encode() + w.tobytes(), digest_size=16).hexdigest()
    return Model(tuple(marks.words), len(words), tuple(map(tuple, pairs.tolist())), root, w, slope, shift, key)


def _table(model: Model) -> _Units:
    """The worker's table of units for a model."""
    return only(("units", model.key), lambda: _Units(Marks(model.marks)))


def _sample(docs: DataFrame, labels: DataFrame) -> tuple[list[str], list[int], float | None]:
    """The labelled rows to learn from, by a hash of doc_id, and the share of toxic ones among all that may be used."""
    usable = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))
    )
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = usable.agg(F.avg("toxic")).first()[0]
    order = F.xxhash64("doc_id", F.lit(7))
    some = usable.where("toxic = 1").orderBy(order).limit(TOXIC_SAMPLE).unionByName(usable.where("toxic = 0").orderBy(order).limit(CLEAN_SAMPLE))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = texts.join(small(some), "doc_id").select("doc_id", "text", "toxic", order.alias("place"), F.octet_length("text").cast("bigint").alias("size"), F.sha2("text", 256).alias("digest"))
    sizes = found.select("toxic", "place", "doc_id", "digest", "size").distinct().collect()  # a row a document of the sample
    chosen = sample_within(sorted(map(tuple, sizes)), SAMPLE_BYTES // 2)
    ids = docs.sparkSession.createDataFrame([c[2:4] for c in chosen], "doc_id bigint, digest string")
    rows = found.join(F.broadcast(ids), ["doc_id", "digest"]).select("text", "toxic").collect()
    return [r.text for r in rows], [r.toxic for r in rows], share


def sample_within(rows: list[tuple], most: int) -> list[tuple]:
    """The rows (class, ..., size), in order, that fit into ``most`` bytes a class; one that doesn't is passed over."""
    used: dict[int, int] = {}
    chosen = []
    for row in rows:
        if used.get(row[0], 0) + row[-1] <= most:
            used[row[0]] = used.get(row[0], 0) + row[-1]
            chosen.append(row)
    return chosen


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model of (doc_id, toxic) labels of documents (doc_id, text); rows that are held out give no label.

    At most TOXIC_SAMPLE and CLEAN_SAMPLE labelled documents with SAMPLE_BYTES of text are used; a text that
    doesn't fit into what is left of its class's half is passed over.  Without labels of
    both kinds, or words that tell them apart, every document gets the base rate.
    """
    texts, toxic, share = _sample(docs, labels)
    return train(texts, toxic, share)


def score(model: Model, text: Column) -> Column:
    """The score of a text column: 0 to 1, higher for likelier toxic; only the text goes to Python, only scores return."""

    @F.arrow_udf("double")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = _table(model)
        for texts in batches:
            data, offsets = T.utf8(texts)
            margins = [model.margins(table, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in T.row_slices(offsets)]
            yield pa.array(model.probability(np.concatenate([*margins, np.zeros(0)])))

    return of(text.cast("string"))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, model: Model | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of ``docs`` (doc_id, text).

    Only the text is scored.  Null and empty texts have the score of a document without words; long texts are scored
    whole; repeated rows give a row each; a null doc_id is not held out.  Other columns are ignored; an empty table
    gives an empty table.
    """
    model = model or fit(docs, labels)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), score(model, F.col("text")).alias("score"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_civil(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose text scores under ``threshold``, with all their columns, whatever their names.

    Null and empty texts are judged as texts without words; repeated rows are kept or dropped together; an empty table
    gives an empty table.
    """
    return docs.where(score(model, F.col("text")) < threshold)
