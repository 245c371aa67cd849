"""What the corpus operators share: tables in the cluster's shared folder, size-checked broadcasts, components."""

from __future__ import annotations

import contextlib
import ctypes
import sys
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lineage import checked, components, forget, heavy_keys, lookup, shared_dir, stored

__all__ = ["checked", "components", "bound_batches", "forget", "heavy_keys", "held_out", "lookup", "only", "shared_dir", "small", "stored"]

#: A side is broadcast only if it was counted and has at most so many rows of a few dozen bytes each.
BROADCAST_ROWS = 200_000


#: Rows and bytes of an Arrow batch: what a Python worker gets at a time, or one longer document.
BATCH_ROWS, BATCH_BYTES = 1024, 2 << 20
#: Rows that a scan decodes at a time, and bytes of a written row group: texts are long, so both are below the defaults.
SCAN_ROWS, GROUP_BYTES = 256, 16 << 20


def bound_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to BATCH_ROWS rows and BATCH_BYTES bytes, scans and row groups likewise.

    Spark reads these settings when a query runs, so they stay with the session.  No result depends on them; other
    queries of the session get smaller batches too.
    """
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(SCAN_ROWS))
    spark.conf.set("parquet.block.size", str(GROUP_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


_held: dict[tuple, object] = {}


def only(key: tuple, make: Callable[[], object] = lambda: None):
    """The worker's object of that key; a worker holds one at a time, so a stage's tables don't outlive the stage.

    Stages without a table name themselves too, to end that of the stage before, whose memory goes back to the system.
    """
    if key not in _held:
        _held.clear()
        pa.default_memory_pool().release_unused()
        if sys.platform == "linux":
            with contextlib.suppress(OSError, AttributeError):
                ctypes.CDLL(None).malloc_trim(0)
        _held[key] = make()
    return _held[key]


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if counting shows at most ``rows`` rows; else as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns labels from: crc32 of the id's decimal text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
