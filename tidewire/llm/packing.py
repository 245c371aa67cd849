"""Packing along a space-filling curve.

A document's pieces are hashed to a vector, the vector is projected to a few fixed directions, and the projection's
cell gets its place on a Hilbert curve, so documents of like words are near each other on the curve.  Documents are
range-partitioned by (curve key, doc_id), sorted, and laid end to end: each partition cuts its run of tokens into full
sequences.  What remains at a partition's end is cut at powers of two, which need no padding.  A hot key (copies of a
document share theirs) is split by doc_id, and a partition keeps one open sequence in memory at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import stored
from .tokens import encoder, vocabulary

BUCKETS, DIMS, BITS = 256, 4, 10


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of (n, dims) cells with coordinates under 2**bits (Skilling's transform)."""
    x = cells.T.astype(np.int64).copy()
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(dims):
            high = (x[i] >> b) & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


_directions = np.random.default_rng(17).standard_normal((BUCKETS, DIMS))


def curve_keys(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Hilbert keys of rows whose pieces hash to hashes[bounds[k]:bounds[k+1]]."""
    n = len(bounds) - 1
    row = np.repeat(np.arange(n), np.diff(bounds))
    counts = np.bincount(row * BUCKETS + (hashes & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=n * BUCKETS)
    vectors = np.sqrt(counts.reshape(n, BUCKETS))
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    share = 1 / (1 + np.exp(-1.702 * (vectors @ _directions)))
    return hilbert_keys(np.minimum((share * (1 << BITS)).astype(np.int64), (1 << BITS) - 1), BITS)


def tokenised(docs: DataFrame, path: str, end_id: int | None = 0) -> DataFrame:
    """(doc_id, curve, n_tokens, ids, width) of (doc_id, text): ids of ``width`` bytes each, zstd-packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, packer = encoder(path), zstandard.ZstdCompressor(level=1)
        tail = np.zeros(0, np.uint32) if end_id is None else np.array([end_id], np.uint32)
        kind = np.uint16 if own.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        for batch in batches:
            for at, rows, hashes, bounds in own.encode(batch.column(1)):
                ids = [np.concatenate((r, tail)) for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(rows)),
                        pa.array(curve_keys(hashes, bounds)),
                        pa.array([len(i) for i in ids], pa.int64()),
                        pa.array([packer.compress(i.astype(kind).tobytes()) for i in ids], pa.binary()),
                        pa.array([kind(0).itemsize] * len(rows), pa.int32()),
                    ],
                    names=["doc_id", "curve", "n_tokens", "ids", "width"],
                )

    schema = "doc_id bigint, curve bigint, n_tokens bigint, ids binary, width int"
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, schema)


class _Packer:
    """Lays documents end to end; gives finished sequences as rows of pieces."""

    def __init__(self, length: int, first_id: int) -> None:
        self.length, self.next = length, first_id
        self.open: list[tuple] = []  # (doc_id, start, ids, doc_tokens) of the sequence that isn't full yet
        self.used = 0
        self.rows: list[tuple] = []

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total, self.next, offset))
            offset += len(ids)
        self.next += 1

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        start = 0
        while start < len(ids):
            part = ids[start : start + self.length - self.used]
            self.open.append((doc_id, start, part, len(ids)))
            self.used += len(part)
            start += len(part)
            if self.used == self.length:
                self._close(self.open)
                self.open, self.used = [], 0

    def finish(self) -> None:
        """Cuts the last, open sequence at powers of two."""
        queue = self.open[::-1]
        while queue:
            room = 1 << (self.used.bit_length() - 1)
            self.used -= room
            taken = []
            while room:
                doc_id, start, ids, total = queue.pop()
                if len(ids) > room:
                    queue.append((doc_id, start + room, ids[room:], total))
                    ids = ids[:room]
                taken.append((doc_id, start, ids, total))
                room -= len(ids)
            self._close(taken)
        self.open = []


def pack(docs: DataFrame, length: int = 1024, path: str | None = None, end_id: int | None = 0) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): one row for each piece of a document.

    Every id of every document of (doc_id, text), with ``end_id`` after its text, lies in exactly one piece; pieces
    fill sequences of ``length`` tokens without gaps, and shorter sequences have a power of two as their length, so
    nothing is padded.  Null and empty texts are the end id alone (no rows without one).  Rows with the same doc_id,
    repeated rows and null doc_ids are packed like any other row.  Other columns are ignored; an empty table gives
    an empty table.  sequence_id is the partition's number times 2**32 plus a running number.
    """
    ready = stored(tokenised(docs, path or vocabulary(), end_id), "tokens")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(length, TaskContext.get().partitionId() << 32)
        unpack = zstandard.ZstdDecompressor().decompress

        def done() -> pa.RecordBatch:
            rows, packer.rows = packer.rows, []
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)

        for batch in batches:
            doc_ids, blobs, widths = (batch.column(k).to_pylist() for k in range(3))
            for doc_id, blob, width in zip(doc_ids, blobs, widths, strict=True):
                packer.add(doc_id, np.frombuffer(unpack(blob), np.uint16 if width == 2 else np.uint32).astype("<u4"))
                if len(packer.rows) > 50_000:
                    yield done()
        packer.finish()
        if packer.rows:
            yield done()

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    order = ["curve", "doc_id", F.xxhash64("ids")]
    laid = ready.repartitionByRange(parts, *order).sortWithinPartitions(*order, "ids")
    return laid.select("doc_id", "ids", "width").mapInArrow(run, ", ".join(f"{n} bigint" for n in names))
