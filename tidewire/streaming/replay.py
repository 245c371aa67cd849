"""Running a stream over what is there, and replaying a table as a stream of slices, each a run of its own.

Tables, checkpoints and results lie in the shared folder.  A run handles all that arrived since the last one and stops, so
every slice is also a restart from the checkpoint.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.lineage import shared_dir

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextlib.contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Keyed state with timers needs the RocksDB store; the session's setting comes back afterwards."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


def folder(spark: SparkSession, name: str) -> str:
    """A new folder's path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def run_once(writer: DataStreamWriter, checkpoint: str) -> None:
    """All that is there, then stop; a failure of the stream is raised."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()


def replay(table: DataFrame, slice_of: Column, start: Callable[[DataFrame], DataStreamWriter], name: str, keys: tuple[str, ...] = ()) -> None:
    """Lands the slices of ``table`` one after the other, lowest first, and runs the stream after each.

    ``slice_of`` has a few dozen values (weeks, months); rows of a null slice come first.  ``start`` makes the writer
    from the landed rows as a stream.  With ``keys`` the rows of a key are landed in one file each time.
    """
    spark = table.sparkSession
    landing, checkpoint = folder(spark, f"{name}-landing"), folder(spark, f"{name}-checkpoint")
    sliced = table.withColumn("__slice", slice_of)
    for (value,) in sorted(sliced.select("__slice").distinct().collect(), key=lambda r: (r[0] is not None, r[0])):
        part = sliced.where(F.col("__slice").eqNullSafe(F.lit(value))).drop("__slice")
        (part.repartition(*keys) if keys else part).write.mode("append").parquet(landing)
        run_once(start(spark.readStream.schema(table.schema).parquet(landing)), checkpoint)


def replayed(table: DataFrame, slice_of: Column, make: Callable[[DataFrame], DataFrame], name: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """What ``make`` appends over a replay of ``table``, as a table."""
    spark = table.sparkSession
    out, schema = folder(spark, f"{name}-out"), []

    def start(stream: DataFrame) -> DataStreamWriter:
        made = make(stream)
        schema[:] = [made.schema]
        return made.writeStream.format("parquet").outputMode("append").option("path", out)

    with keyed_state(spark):
        replay(table, slice_of, start, name, keys)
    if not schema:
        return make(table.limit(0))
    return spark.read.schema(schema[0]).parquet(out)
