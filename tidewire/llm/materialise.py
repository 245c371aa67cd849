"""Training-order materialisation: token sequences in a keyed random order, as fixed-stride binary shards.

Texts become ids and are laid end to end within their scan partition, cut to sequences of a fixed length, and
numbered from 0 in scan order.  A keyed Feistel permutation of [0, N), by cycle-walking within the next even power of
two, gives every sequence its global slot: no shuffle of an index, no stored permutation, and the inverse is as cheap.
Slots are dealt to shards by range, each shard is sorted, and a sequence's place in the shards follows from its slot
alone, so a reader can start or resume anywhere and then reads on sequentially.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textops as T
from .common import small, stored
from .tokens import encoder, vocabulary

ROUNDS = 6
_U = np.uint64


class Permutation:
    """A keyed bijection of [0, n)."""

    def __init__(self, n: int, key: int) -> None:
        self.n = n
        self.half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.low = _U((1 << self.half) - 1)
        self.keys = T.seeds(ROUNDS, key & (2**63 - 1))

    def _walk(self, x: np.ndarray, once) -> np.ndarray:
        x = once(x.astype(np.uint64))
        while (out := x >= _U(self.n)).any():
            x[out] = once(x[out])
        return x.astype(np.int64)

    def slots(self, index: np.ndarray) -> np.ndarray:
        def once(x: np.ndarray) -> np.ndarray:
            left, right = x >> _U(self.half), x & self.low
            for k in self.keys:
                left, right = right, left ^ (T.mix64(right ^ k) & self.low)
            return (left << _U(self.half)) | right

        return self._walk(index, once)

    def indexes(self, slot: np.ndarray) -> np.ndarray:
        def once(x: np.ndarray) -> np.ndarray:
            left, right = x >> _U(self.half), x & self.low
            for k in self.keys[::-1]:
                left, right = right ^ (T.mix64(left ^ k) & self.low), left
            return (left << _U(self.half)) | right

        return self._walk(slot, once)


def sequences(docs: DataFrame, length: int, path: str, end_id: int) -> DataFrame:
    """(part, at, n_tokens, ids): full sequences of each scan partition in order, the last one shorter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        own, packer = encoder(path), zstandard.ZstdCompressor(level=1)
        kind = np.uint16 if own.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        rest, tail = np.zeros(0, kind), np.array([end_id], kind)

        def rows(cut: list[np.ndarray]) -> pa.RecordBatch:
            nonlocal at
            at += len(cut)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(cut), pa.int32()),
                    pa.array(range(at - len(cut), at), pa.int64()),
                    pa.array([len(c) for c in cut], pa.int32()),
                    pa.array([packer.compress(c.tobytes()) for c in cut], pa.binary()),
                ],
                names=["part", "at", "n_tokens", "ids"],
            )

        for batch in batches:
            for _, found, _, _ in own.encode(batch.column(0)):
                run_ = np.concatenate([rest, *(x for ids in found for x in (ids.astype(kind), tail))])
                whole = len(run_) // length * length
                rest = run_[whole:]
                if whole:
                    yield rows(list(run_[:whole].reshape(-1, length)))
        if len(rest):
            yield rows([rest])

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "part int, at bigint, n_tokens int, ids binary")


def training_order(docs: DataFrame, length: int = 1024, per_shard: int = 8192, key: int = 20_240_229, path: str | None = None, end_id: int = 0) -> DataFrame:
    """(slot, shard, byte_offset, sequence_id, n_tokens, ids_crc32, ids) of all texts' token sequences.

    ids holds ``length`` little-endian ids, 2 bytes each for vocabularies up to 65,536 and else 4; a scan partition's
    last sequence is filled up with the end id.  ids_crc32 is of the bytes.  Partition k of the result is shard k,
    in the order of slots.  sequence_id follows the scan order, slot is its place under the keyed permutation: both
    run from 0 to N - 1 without gaps.  Null and empty texts give an end id alone; repeated rows are repeated; other
    columns are ignored; an empty table gives an empty table.
    """
    path = path or vocabulary()
    spark = docs.sparkSession
    made = stored(sequences(docs, length, path, end_id), "sequences")
    counts = sorted((r["part"], r["count"]) for r in made.groupBy("part").count().collect())  # one row a scan partition
    before = np.concatenate(([0], np.cumsum([c for _, c in counts], dtype=np.int64)))
    total = int(before[-1])
    width = 2 if encoder(path).tokenizer.get_vocab_size() <= 1 << 16 else 4
    order = Permutation(total, key)

    @F.pandas_udf("bigint")
    def slot_of(index: pd.Series) -> pd.Series:
        return pd.Series(order.slots(index.to_numpy()))

    starts = spark.createDataFrame([(p, int(b)) for (p, _), b in zip(counts, before[:-1], strict=True)], "part int, first bigint")
    rows = made.join(small(starts), "part").select((F.col("first") + F.col("at")).alias("sequence_id"), "n_tokens", "ids")
    rows = rows.withColumn("slot", slot_of("sequence_id"))
    shard = F.floor(F.col("slot") / per_shard).cast("int")
    dealt = rows.repartitionById(max(1, -(-total // per_shard)), shard).sortWithinPartitions("slot")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        fill = np.array([end_id], np.uint16 if width == 2 else np.uint32).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                cut = batch.slice(at, 2048)
                slots = cut.column(0).to_numpy()
                ids = [(b := unpack(v)) + fill * (length - len(b) // width) for v in cut.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        cut.column(0),
                        pa.array(slots // per_shard, pa.int32()),
                        pa.array(slots % per_shard * (length * width + 1), pa.int64()),
                        cut.column(1),
                        cut.column(2),
                        pa.array([zlib.crc32(i) for i in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["slot", "shard", "byte_offset", "sequence_id", "n_tokens", "ids_crc32", "ids"],
                )

    schema = "slot bigint, shard int, byte_offset bigint, sequence_id bigint, n_tokens int, ids_crc32 bigint, ids binary"
    return dealt.select("slot", "sequence_id", "n_tokens", "ids").mapInArrow(run, schema)


def write_shards(ordered: DataFrame, path: str) -> None:
    """Writes :func:`training_order`'s result as one binary file a shard, through Spark's own committer.

    A record is the ids' bytes and one newline byte, so records have a fixed stride and slot s of shard k lies at
    byte_offset of part k.  The text writer puts bytes out as they are.  An empty table writes no record; ``ordered``
    has no null ids, and repeated sequences are records of their own.
    """
    ordered.select(F.col("ids").cast("string").alias("value")).write.option("lineSep", "\n").option("compression", "none").text(path)


def resume(spark: SparkSession, path: str, stride: int, per_shard: int, slot: int = 0) -> DataFrame:
    """(slot, ids) from a slot on, in order: the records of written shards, read by their fixed stride.

    Shards before the slot's are not opened, and a shard is read in splits at whole records, never as one value.  A
    slot behind the last gives no rows.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = [f.getPath().toString() for f in place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)]
    shards = sorted((int(f.rsplit("part-", 1)[1].split("-", 1)[0]), f) for f in files if "/part-" in f)
    first = slot // per_shard
    wanted = [f for shard, f in shards if shard >= first]
    if not wanted:
        return spark.createDataFrame([], "slot bigint, ids binary")
    # Splits come in the order of files and offsets, and all shards but the last are full, so a record's place is its slot.
    records = spark.sparkContext.binaryRecords(",".join(wanted), stride).zipWithIndex()
    rows = records.map(lambda r: (first * per_shard + r[1], r[0][:-1])).filter(lambda r: r[0] >= slot)
    return spark.createDataFrame(rows, "slot bigint, ids binary")


def read_slots(spark: SparkSession, path: str, stride: int) -> DataFrame:
    """(shard, byte_offset, ids): the records of written shards, each shard split at its fixed stride.

    A shard is one value here; :func:`resume` reads in smaller splits and from any slot.  No shards give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = int(name.rsplit("part-", 1)[1].split("-", 1)[0])
                n = len(content) // stride
                ids = [content[k * stride : (k + 1) * stride - 1] for k in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * n, pa.int32()), pa.array([k * stride for k in range(n)], pa.int64()), pa.array(ids, pa.binary())], names=["shard", "byte_offset", "ids"]
                )

    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content").mapInArrow(run, "shard int, byte_offset bigint, ids binary")
