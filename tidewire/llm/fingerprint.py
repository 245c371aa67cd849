"""Document fingerprints by content-defined chunking.

A gear hash of the last 8 bytes is taken at every byte; a chunk ends where it meets a mask.  Chunking is normalised:
up to the usual length the mask is strict, from there on it is loose, and a chunk never exceeds the longest length, so
lengths gather around the usual one.  A boundary depends on the 8 bytes before it only, so an insertion or deletion
moves chunks but changes few of them.  The fingerprint is the set of chunk digests with the chunks' lengths.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import small

#: Lengths of chunks in bytes; the least is the hash's window, so no boundary depends on the chunk before.
LEAST, USUAL, MOST = 8, 24, 128
_STRICT, _LOOSE = np.uint32(0x1F0000), np.uint32(0x070000)  # one place in 32 and in 8
_GEAR = (T.seeds(256, 53) >> np.uint64(32)).astype(np.uint32)


def _gear(data: np.ndarray) -> np.ndarray:
    """The sum of gear[b[i - j]] << j over j < LEAST, for every i, by doubling the window."""
    h = _GEAR[data]
    for k in (1, 2, 4):
        shifted = np.zeros_like(h)
        shifted[k:] = h[:-k] << np.uint32(k)
        h = h + shifted
    return h


def chunk_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the chunks of the texts bounds[k]:bounds[k+1] begin."""
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.int64)
    h = _gear(data)

    def next_end(mask: np.uint32) -> np.ndarray:
        """The first end after a byte that meets the mask, from each position on."""
        ends = np.where((h & mask) == 0, np.arange(1, n + 1, dtype=np.int32), np.int32(2**31 - 1))
        return np.append(np.minimum.accumulate(ends[::-1])[::-1], np.int32(2**31 - 1))

    strict, loose = next_end(_STRICT), next_end(_LOOSE)
    at = np.arange(n, dtype=np.int32)
    first = strict[np.minimum(at + (LEAST - 1), n)]
    second = np.minimum(loose[np.minimum(at + (USUAL - 1), n)], at + np.int32(MOST))
    after = memoryview(np.where(first < at + USUAL, first, second).astype(np.int32))
    starts: list[int] = []
    for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        while i < j:
            starts.append(i)
            i = after[i]
    return np.array(starts, dtype=np.int64)


def chunk_sets(data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Each text's distinct chunks in ascending order: 48 bits of the digest, then 16 bits of the length."""
    starts = chunk_starts(data, bounds)
    ends = np.append(starts[1:], len(data))
    if not len(starts):
        return [np.zeros(0, dtype=np.uint64)] * (len(bounds) - 1)
    packed = (T.span_hashes(data, starts, ends, 59) & ~np.uint64(0xFFFF)) | (ends - starts).astype(np.uint64)
    return T.sorted_sets(packed, np.searchsorted(starts, bounds))


def written(chunks: np.ndarray) -> str:
    """A fingerprint as text: base64 of its chunks, 8 bytes each, digest then length."""
    return base64.b64encode(chunks.astype(">u8").tobytes()).decode()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), dtype=">u8").astype(np.uint64)


def _weight(chunks: np.ndarray) -> int:
    return int((chunks & np.uint64(0xFFFF)).sum())


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """The shared chunks' length by the shorter side's: 1 for equal or contained texts, 0 for nothing shared."""
    least = min(_weight(a), _weight(b))
    if not least:
        return 1.0 if not len(a) and not len(b) else 0.0
    return _weight(np.intersect1d(a, b, assume_unique=True)) / least


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The shared chunks' length by all chunks' length."""
    shared = _weight(np.intersect1d(a, b, assume_unique=True))
    whole = _weight(a) + _weight(b) - shared
    return shared / whole if whole else 1.0


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, fingerprint) of (doc_id, text); null texts count as empty, whose fingerprint is ''."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = T.utf8(batch.column(2))
            for i, j in T.row_slices(offsets):
                cut = data[offsets[i] : offsets[j]]
                sets = chunk_sets(cut, offsets[i : j + 1] - offsets[i])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(map(written, sets), pa.string())], names=["doc_id", "n_chars", "fingerprint"]
                )

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    ready = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.length(text).cast("bigint").alias("n_chars"), text.alias("text"))
    return ready.mapInArrow(run, "doc_id bigint, n_chars bigint, fingerprint string")


def _ranges(ids: DataFrame, count: int) -> list[int]:
    """At most ``count`` upper ends of ranges of about as many ids each; balance only, no result depends on them."""
    shares = [k / count for k in range(1, count)]
    found = ids.select(F.percentile_approx("doc_id", shares, 10 * count)).first()[0] if shares else None
    return sorted({*(found or [])})


def edited_fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they are.

    The edited text has the last floor(n / 3) code points replaced by the first as many of the next document in
    descending doc_id (all, if it has fewer); the last document's next is the first.  Returns doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next (containment weighted by chunk lengths)
    and overlap_edited (shared by all chunks).  Null texts are empty; two empty texts are alike (1.0), an empty and
    another are not (0.0).  Ties in doc_id go by the text, null doc_ids come last, repeated rows give a row each.
    Other columns are ignored; an empty table gives an empty table.

    Documents go to ranges of ids in one shuffle, are sorted there, and are read as a stream.  The first document of
    each range is also sent to the range before it, so no task has to see another's rows.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ends = _ranges(rows.select("doc_id"), ranges or parts)
    n = len(ends) + 1

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Range 0 has the largest ids; null ids belong to the last."""
        for batch in batches:
            own = [n - 1 if i is None else n - 1 - bisect.bisect_left(ends, i) for i in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.int32())], names=["doc_id", "own"])

    placed = rows.select("doc_id").mapInArrow(place, "doc_id bigint, own int")
    tops = {r.own: (r.top, r.some) for r in placed.groupBy("own").agg(F.max("doc_id").alias("top"), F.count("doc_id").alias("some")).collect()}
    used = sorted(tops)
    heads = [(tops[r][0], used[k - 1]) for k, r in enumerate(used)]  # the first range's head goes to the last one
    held = spark.createDataFrame(heads, "doc_id bigint, own int") if heads else spark.createDataFrame([], "doc_id bigint, own int")
    bounds = F.array(*[F.lit(e) for e in ends]).cast("array<bigint>")
    below = F.size(F.filter(bounds, lambda e: e < F.col("doc_id")))
    own = F.when(F.col("doc_id").isNull(), n - 1).otherwise(n - 1 - below).cast("int")
    body = rows.select(own.alias("part"), F.lit(0).alias("tail"), "doc_id", "text")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    match = texts.join(small(held), texts.doc_id.eqNullSafe(held.doc_id)).select(held.own.alias("part"), F.lit(1).alias("tail"), texts.doc_id, "text")
    laid = body.unionByName(match).repartitionById(n, F.col("part")).sortWithinPartitions("part", "tail", F.desc_nulls_last("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: tuple | None = None  # (part, doc_id, text, chunks) whose next document hasn't come
        closed = None  # the part whose tail has come
        for batch in batches:
            parts_, tails, ids = (batch.column(k).to_pylist() for k in range(3))
            data, offsets = T.utf8(batch.column(3))
            for i, j in T.row_slices(offsets, T.SLICE_BYTES // 2):
                cut = data[offsets[i] : offsets[j]]
                sets = chunk_sets(cut, offsets[i : j + 1] - offsets[i])
                pairs = []
                for k, chunks in zip(range(i, j), sets, strict=True):
                    if tails[k] and closed == parts_[k]:
                        continue  # only the first of the next range's documents is needed
                    text = data[offsets[k] : offsets[k + 1]].tobytes().decode()
                    if waiting is not None and waiting[0] == parts_[k]:
                        pairs.append((*waiting[1:], text, chunks))
                    if tails[k]:
                        waiting, closed = None, parts_[k]
                    else:
                        waiting = (parts_[k], ids[k], text, chunks)
                if pairs:
                    yield _compared(pairs)
        assert waiting is None, "a range has no tail"

    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, overlap_edited double"
    return laid.mapInArrow(run, schema)


def _compared(pairs: list[tuple]) -> pa.RecordBatch:
    edited = []
    for _, text, _, after, _ in pairs:
        k = len(text) // 3
        edited.append((text[: len(text) - k] + after[:k]).encode())
    bounds = np.concatenate(([0], np.cumsum([len(e) for e in edited])))
    sets = chunk_sets(np.frombuffer(b"".join(edited), dtype=np.uint8), bounds)
    columns = [
        pa.array([p[0] for p in pairs], pa.int64()),
        pa.array([len(p[1]) for p in pairs], pa.int64()),
        pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
        pa.array([written(p[2]) for p in pairs], pa.string()),
        pa.array([written(s) for s in sets], pa.string()),
        pa.array([containment(p[2], s) for p, s in zip(pairs, sets, strict=True)], pa.float64()),
        pa.array([containment(p[2], p[4]) for p in pairs], pa.float64()),
        pa.array([likeness(p[2], s) for p, s in zip(pairs, sets, strict=True)], pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "overlap_edited"])
