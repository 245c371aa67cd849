"""Line dedup that can be undone: sharded cuckoo filters over an exact table of reference counts.

An index counts the documents that hold each line.  Lines go by a key, the line stripped and lower-cased, and keys by 16
bytes of BLAKE2b.  The counts are an exact table; inserting documents adds to it, deleting them subtracts, and a key that
no document holds any more is gone, so an index after ``insert(a).insert(b).delete(b)`` is that after ``insert(a)``.  Keys
are dealt to shards by their first bits; each shard has a cuckoo filter of its common keys (held by ``least`` documents or
more), to which a change adds the keys that became common and from which it takes those that no longer are.

A filter of 16-bit fingerprints also answers yes for about one key in 8,000 that isn't in it.  The index holds all keys of
its documents, so each shard lists those of its other keys that its filter takes for common, and filter and list together
are exact for every document of the index.  Filters take about two bytes a common key: they are sent to the tasks if their
counted size allows, and documents are then rewritten where they are, without a shuffle of texts.  Beyond that, keys are
joined to the table of common keys, and only texts that hold one are dealt.

A null or empty text is one empty line.  A line's key without ``least_chars`` code points (so an empty line) is never
common.  A document counts once for a key, however often it holds it; every row is a document, repeated rows and rows of a
null id too.  An empty table changes nothing.  Other columns are not looked at.  Deleting what was never inserted raises
a ValueError.
"""

from __future__ import annotations

import hashlib
import pickle
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import forget, lookup, only, stored
from .textops import _LOWERED, IS_SPACE, row_slices, utf8

#: Keys of a shard, on average; a shard is one group of 16-byte keys and their counts.
SHARD_KEYS = 1 << 16
#: Filters and lists are sent to the tasks if they have at most so many bytes together.
SENT_BYTES = 32 << 20
#: Slots of a bucket, evictions before a filter counts as full, and the share of slots that a new filter fills.
SLOTS, KICKS, LOAD = 4, 500, 0.8

_KEY = np.dtype("V16")
_COUNTS = "shard int, key binary, was long, n long"
_FILTERS = "shard int, slots binary, taken binary"


class CuckooFilter:
    """16-bit fingerprints in buckets of 4 slots, each key in one of two buckets; keys can be taken out again."""

    def __init__(self, buckets: int, slots: np.ndarray | None = None) -> None:
        self.mask = buckets - 1
        self.slots = np.zeros(buckets * SLOTS, dtype=np.uint16) if slots is None else slots
        self.turn = 0

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        buckets = 1 << max(0, int(np.ceil(np.log2(max(1, len(keys)) / (SLOTS * LOAD)))))
        while True:
            made = cls(buckets)
            if made.insert(keys):
                return made
            buckets *= 2

    def __len__(self) -> int:
        return int(np.count_nonzero(self.slots))

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each key's fingerprint and both buckets."""
        high = np.frombuffer(keys.tobytes(), dtype="<u8")[1::2] if len(keys) else np.zeros(0, np.uint64)
        prints = ((high >> np.uint64(48)).astype(np.int64) % 65535) + 1
        first = (high & np.uint64(self.mask)).astype(np.int64)
        return prints, first, first ^ self._apart(prints)

    def _apart(self, prints):
        return (prints * 0x5BD1E995 >> 7) & self.mask

    def insert(self, keys: np.ndarray) -> bool:
        """Adds keys that aren't in it; False if it is full, and then it is of no use any more."""
        slots = self.slots.tolist()
        for print_, a, b in zip(*(x.tolist() for x in self._places(keys)), strict=True):
            free = next((s for i in (a, b) for s in range(i * SLOTS, i * SLOTS + SLOTS) if not slots[s]), None)
            bucket, kicks = b, 0
            while free is None:
                if kicks == KICKS:
                    return False
                self.turn, kicks = self.turn + 1, kicks + 1
                at = bucket * SLOTS + self.turn % SLOTS
                slots[at], print_ = print_, slots[at]
                bucket ^= self._apart(print_)
                free = next((s for s in range(bucket * SLOTS, bucket * SLOTS + SLOTS) if not slots[s]), None)
            slots[free] = print_
        self.slots = np.array(slots, dtype=np.uint16)
        return True

    def delete(self, keys: np.ndarray) -> None:
        """Takes out keys that are in it."""
        for print_, a, b in zip(*(x.tolist() for x in self._places(keys)), strict=True):
            at = next(s for i in (a, b) for s in range(i * SLOTS, i * SLOTS + SLOTS) if self.slots[s] == print_)
            self.slots[at] = 0

    def holds(self, keys: np.ndarray) -> np.ndarray:
        prints, a, b = self._places(keys)
        rows = self.slots.reshape(-1, SLOTS)
        return ((rows[a] == prints[:, None]) | (rows[b] == prints[:, None])).any(axis=1)


def line_keys(data: np.ndarray, offsets: np.ndarray, least_chars: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lines of some rows: first byte, end, whether the key is long enough, key, and where each row's lines begin.

    ``offsets`` are relative to ``data``; short keys are zeros.
    """
    breaks = np.flatnonzero(data == 10)
    starts, ends = np.sort(np.concatenate((offsets[:-1], breaks + 1))), np.sort(np.concatenate((breaks, offsets[1:])))
    bounds = np.concatenate(([0], np.cumsum(1 + np.searchsorted(breaks, offsets[1:]) - np.searchsorted(breaks, offsets[:-1]))))
    solid = np.flatnonzero(~IS_SPACE[data])
    i, j = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    some = j > i
    first, last = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    first[some], last[some] = solid[i[some]], solid[j[some] - 1] + 1
    chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    long_enough = some & (chars[last] - chars[first] >= least_chars)
    lowered = _LOWERED[data].tobytes()
    at = np.flatnonzero(long_enough)
    digests = [hashlib.blake2b(lowered[s:e], digest_size=16).digest() for s, e in zip(first[at].tolist(), last[at].tolist(), strict=True)]
    keys = np.zeros(len(starts), dtype=_KEY)
    keys[at] = np.frombuffer(b"".join(digests), dtype=_KEY)
    return starts, ends, long_enough, keys, bounds


def _in_slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    raw, ends = utf8(column)
    for i, j in row_slices(ends):
        yield i, j, raw[ends[i] : ends[j]], ends[i : j + 1] - ends[i]


def _keys_of(column: pa.Array) -> np.ndarray:
    """A binary column of 16 bytes each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), dtype=_KEY)


def _binary(keys: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(16), len(keys), [None, pa.py_buffer(keys.tobytes())]).cast(pa.binary())


def _document_counts(docs: DataFrame, text: str, least_chars: int) -> DataFrame:
    """(key, n): documents that hold each key, summed up for each batch already."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only(("linededup",))
        for batch in batches:
            found = []
            for _, _, data, offsets in _in_slices(batch.column(0)):
                _, _, good, keys, bounds = line_keys(data, offsets, least_chars)
                pair = np.zeros(int(good.sum()), dtype=[("doc", "<i8"), ("key", _KEY)])
                pair["doc"], pair["key"] = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[good], keys[good]
                found.append(np.frombuffer(np.unique(pair.view("V24")).tobytes(), dtype=pair.dtype)["key"])
            keys, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, _KEY), np.zeros(0, np.int64))
            if len(keys):
                yield pa.RecordBatch.from_arrays([_binary(keys), pa.array(n.astype(np.int64))], ["key", "n"])

    return docs.select(F.col(text).alias("text")).mapInArrow(count, "key binary, n long").groupBy("key").agg(F.sum("n").alias("n"))


class LineIndex:
    """How many documents hold each line; immutable, every change makes another index in the shared folder."""

    def __init__(self, spark: SparkSession, least: int = 10, least_chars: int = 1, counts: DataFrame | None = None, filters: DataFrame | None = None, bits: int = 0) -> None:
        self.spark, self.least, self.least_chars, self.bits = spark, least, least_chars, bits
        self.counts = spark.createDataFrame([], _COUNTS) if counts is None else counts
        self.filters = spark.createDataFrame([], _FILTERS) if filters is None else filters

    def insert(self, docs: DataFrame, text: str = "text") -> LineIndex:
        return self._changed(docs, text, 1)

    def delete(self, docs: DataFrame, text: str = "text") -> LineIndex:
        return self._changed(docs, text, -1)

    def forget(self) -> None:
        """Deletes the index's tables; later and earlier ones don't read them."""
        forget(self.counts)
        forget(self.filters)

    def _changed(self, docs: DataFrame, text: str, sign: int) -> LineIndex:
        delta = _document_counts(docs, text, self.least_chars).select("key", F.lit(0).cast("bigint").alias("was"), (F.col("n") * sign).alias("n"))
        old = self.counts.where("n > 0").select("key", F.col("n").alias("was"), "n")
        sums = old.unionByName(delta).groupBy("key").agg(F.sum("was").alias("was"), F.sum("n").alias("n"))
        sums = stored(sums, "line-counts")
        n, least = sums.agg(F.count_if(F.col("n") > 0), F.min("n")).first()
        if least is not None and least < 0:
            forget(sums)
            raise ValueError("documents can only be deleted from an index that has them")
        bits = max(0, int(np.ceil(np.log2(max(1, n) / SHARD_KEYS))))
        head = F.conv(F.hex(F.substring("key", 1, 4)), 16, 10).cast("bigint")
        counts = sums.select(F.shiftright(head, 32 - bits).cast("int").alias("shard"), "key", "was", "n")
        old = self.filters if bits == self.bits else self.filters.limit(0)
        filters = counts.groupBy("shard").cogroup(old.groupBy("shard")).applyInArrow(_updated(self.least, bits == self.bits), _FILTERS)
        return LineIndex(self.spark, self.least, self.least_chars, counts, stored(filters, "line-filters"), bits)

    def common(self) -> DataFrame:
        """(key): keys of ``least`` documents or more."""
        return self.counts.where(F.col("n") >= self.least).select("key")

    def sent_bytes(self) -> int:
        return self.filters.agg(F.sum(F.length("slots") + F.length("taken"))).first()[0] or 0


def _updated(least: int, same: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def update(counts: pa.Table, old: pa.Table) -> pa.Table:
        """A shard's filter after a change, and the other keys that it takes for common."""
        keys = _keys_of(counts.column("key"))
        was, n = (counts.column(c).to_numpy() for c in ("was", "n"))
        common = n >= least
        if not len(keys):
            return old.select(["shard", "slots", "taken"])
        made = None
        if same and old.num_rows:
            slots = np.frombuffer(old.column("slots")[0].as_py(), np.uint16).copy()
            made = CuckooFilter(len(slots) // SLOTS, slots)
            made.delete(keys[(was >= least) & ~common])
            if not made.insert(keys[common & (was < least)]):
                made = None
        if made is None:
            made = CuckooFilter.of(keys[common])
        rest = keys[~common & (n > 0)]
        taken = np.sort(rest[made.holds(rest)])
        return pa.table({"shard": counts.column("shard")[:1].combine_chunks(), "slots": [made.slots.tobytes()], "taken": [taken.tobytes()]})

    return update


class _Sent:
    """The filters as the tasks use them."""

    def __init__(self, rows: list, bits: int) -> None:
        self.bits = bits
        self.shards = {r["shard"]: CuckooFilter(len(r["slots"]) // (2 * SLOTS), np.frombuffer(r["slots"], np.uint16)) for r in rows}
        self.taken = np.sort(np.concatenate([np.frombuffer(r["taken"], _KEY) for r in rows] + [np.zeros(0, _KEY)]))

    def common(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key, of documents of the index, is common."""
        out = np.zeros(len(keys), dtype=bool)
        shard = (np.frombuffer(keys.tobytes(), dtype=">u4")[::4].astype(np.int64) >> (32 - self.bits)) if len(keys) else np.zeros(0, np.int64)
        for s in np.unique(shard).tolist():
            at = np.flatnonzero(shard == s)
            if s in self.shards:
                out[at] = self.shards[s].holds(keys[at])
        hit = np.flatnonzero(out)
        if len(hit) and len(self.taken):
            near = np.minimum(np.searchsorted(self.taken, keys[hit]), len(self.taken) - 1)
            out[hit] &= self.taken[near] != keys[hit]
        return out


def _without(column: pa.Array, least_chars: int, common: Callable[[int, int, np.ndarray, np.ndarray], np.ndarray]) -> tuple[pa.Array, list[int], list[int]]:
    """The texts without their common lines, their numbers of lines, and of dropped lines."""
    texts: list[bytes] = []
    lines: list[int] = []
    dropped: list[int] = []
    for i, j, data, offsets in _in_slices(column):
        starts, ends, good, keys, bounds = line_keys(data, offsets, least_chars)
        drop = np.zeros(len(keys), dtype=bool)
        at = np.flatnonzero(good)
        drop[at] = common(i, j, keys[at], np.repeat(np.arange(i, j), np.diff(bounds))[at])
        count = np.add.reduceat(drop.astype(np.int64), bounds[:-1])
        raw = data.tobytes()
        for k, n in enumerate(count.tolist()):
            a, b = bounds[k], bounds[k + 1]
            if not n:
                texts.append(raw[offsets[k] : offsets[k + 1]])
            else:
                stay = np.flatnonzero(~drop[a:b]) + a
                texts.append(b"\n".join(raw[s:e] for s, e in zip(starts[stay].tolist(), ends[stay].tolist(), strict=True)))
        lines += np.diff(bounds).tolist()
        dropped += count.tolist()
    return pa.array(texts, pa.binary()).cast(pa.string()), lines, dropped


def drop_common_lines(docs: DataFrame, index: LineIndex, text: str = "text") -> DataFrame:
    """(row, text, n_lines, n_dropped): each document's own columns but its text as ``row``, and its text without common lines.

    The documents have to be in the index.  All lines of a common key go, in every document; the others stay as they
    are, joined by line breaks, so a text of common lines alone becomes empty.
    """
    rest = [c for c in docs.columns if c != text]
    rows = docs.select(F.struct(*[F.col(f"`{c}`").alias(c) for c in rest]).alias("row") if rest else F.struct(F.lit(True).alias("row")).alias("row"), F.col(text).alias("text"))
    least_chars, bits = index.least_chars, index.bits
    schema = f"row {rows.schema['row'].dataType.simpleString()}, text string, n_lines long, n_dropped long"
    if index.sent_bytes() <= SENT_BYTES:
        sent, name = index.spark.sparkContext.broadcast(pickle.dumps([r.asDict() for r in index.filters.collect()])), uuid.uuid4().hex

        def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            filters = only(("linededup", name), lambda: _Sent(pickle.loads(sent.value), bits))
            for batch in batches:
                kept = _without(batch.column(1), least_chars, lambda i, j, keys, row: filters.common(keys))
                yield pa.RecordBatch.from_arrays([batch.column(0), kept[0], pa.array(kept[1], pa.int64()), pa.array(kept[2], pa.int64())], ["row", "text", "n_lines", "n_dropped"])

        return rows.mapInArrow(rewrite, schema)
    return _joined(rows, index, schema)


def _joined(rows: DataFrame, index: LineIndex, schema: str) -> DataFrame:
    """As drop_common_lines, for indexes whose filters are too large to be sent."""
    least_chars = index.least_chars

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = batch.column(0).to_pylist(), []
            for i, _, data, offsets in _in_slices(batch.column(1)):
                _, _, good, keys, bounds = line_keys(data, offsets, least_chars)
                row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)) + i
                found.append((row[good], keys[good]))
            row, keys = (np.concatenate([f[k] for f in found]) for k in (0, 1)) if found else (np.zeros(0, int), np.zeros(0, _KEY))
            yield pa.RecordBatch.from_arrays([pa.array([texts[k] for k in row.tolist()], pa.string()), _binary(keys)], ["digest", "key"])

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [set(x or ()) for x in batch.column(2).to_pylist()]
            told = lambda i, j, keys, row, hits=hits: np.fromiter((k.tobytes() in hits[r] for k, r in zip(keys, row.tolist(), strict=True)), bool, len(keys))
            kept = _without(batch.column(1), least_chars, told)
            yield pa.RecordBatch.from_arrays([batch.column(0), kept[0], pa.array(kept[1], pa.int64()), pa.array(kept[2], pa.int64())], ["row", "text", "n_lines", "n_dropped"])

    digested = rows.withColumn("digest", F.sha2(F.coalesce("text", F.lit("")), 256))
    each = stored(digested.select("digest", "text").mapInArrow(pairs, "digest string, key binary").distinct(), "line-pairs")
    found = lookup(each, index.common(), "key").groupBy("digest").agg(F.collect_set("key").alias("keys"))
    return lookup(digested, stored(found, "line-hits"), "digest", "left").select("row", "text", "keys").mapInArrow(rewrite, schema)


def dedup_lines(docs: DataFrame, least: int = 10, least_chars: int = 1, text: str = "text") -> DataFrame:
    """drop_common_lines by an index of the documents themselves."""
    return drop_common_lines(docs, LineIndex(docs.sparkSession, least, least_chars).insert(docs, text), text)
