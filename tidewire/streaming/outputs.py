"""Streams with more than one output: late rows to a table of their own, and days of articles to events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.cluster import EVENT_SCHEMA, cluster_articles
from ..operators.lineage import forget, stored
from .state import EVENT_DAYS


def _put(df: DataFrame, path: str, batch_id: int) -> None:
    """A batch's part of a table; a repeated batch replaces its own."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def late_split(stream: DataFrame, time: str, path: str, late: str = "10 minutes", arrived: str | None = None) -> DataStreamWriter:
    """Writes each row to ``path/on_time`` or ``path/late``: what a watermark would drop is kept beside the rest.

    A row is late if its time is more than ``late`` before the greatest time of all earlier batches; a row without a
    time is late as well.  A time after ``arrived`` counts as ``arrived`` here, so one row from the future doesn't make
    all others late.  The greatest times are a table beside the outputs, one row a batch, so a batch that is run again
    after a stop is split as before and replaces its files: on time and late rows together are the input, once each.
    """

    return stream.writeStream.foreachBatch(lambda batch, batch_id: split_batch(batch, batch_id, time, path, late, arrived))


def split_batch(batch: DataFrame, batch_id: int, time: str, path: str, late: str, arrived: str | None) -> None:
    """One batch of :func:`late_split`."""
    spark = batch.sparkSession
    before = None
    if batch_id and _exists(spark, f"{path}/bounds"):
        seen = spark.read.schema("most timestamp, batch int").parquet(f"{path}/bounds").where(F.col("batch") < batch_id)
        before = seen.agg((F.max("most") - F.expr(f"INTERVAL {late}")).alias("bound")).first()[0]  # one row a batch
    at = F.col(time).cast("timestamp")
    told = F.when(at.isNotNull(), F.least(at, F.col(arrived).cast("timestamp"))) if arrived else at
    is_late = at.isNull() | (F.coalesce(at < F.lit(before), F.lit(False)) if before is not None else F.lit(False))
    _put(batch.where(~is_late), f"{path}/on_time", batch_id)
    _put(batch.where(is_late), f"{path}/late", batch_id)
    _put(batch.agg(F.max(told).alias("most")), f"{path}/bounds", batch_id)


def batches_of(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of an output table, of all batches, with ``batch``."""
    fields = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return spark.read.schema(f"{fields}, batch int").parquet(path)


def day_events(articles: DataFrame, path: str, now: Column | None = None, keep_days: int = EVENT_DAYS) -> DataStreamWriter:
    """Clusters each batch of a stream of articles into the events that are open, as the batch fold does day by day.

    An article may join any open event by its names or its wording, so there is no key to keep events under: the open
    events are a table, ``path/open/batch=n``, that each batch reads and writes anew.  Events whose last update is more
    than ``keep_days`` before ``now`` (the batch's latest article, if not given) are left out of it, so it holds the
    events of these days whatever the length of the stream.  Touched events are appended to ``path/events/batch=n``.
    A batch that is run again starts from the table of the batch before it and replaces its own.
    """

    def fold(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = stored(batch, "day-articles")
        at = F.max(F.coalesce("published_at", "fetched_at"))
        today = now if now is not None else F.lit(batch.agg(at).first()[0])
        before = f"{path}/open/batch={batch_id - 1}"
        old = spark.read.schema(EVENT_SCHEMA).parquet(before) if batch_id and _exists(spark, before) else spark.createDataFrame([], EVENT_SCHEMA)
        old = old.where(F.col("last_updated") >= today - F.make_interval(days=F.lit(keep_days)))
        touched = stored(cluster_articles(batch, old), "touched")
        _put(touched, f"{path}/events", batch_id)
        kept = old.join(touched.select("id"), "id", "left_anti").unionByName(touched)
        _put(kept, f"{path}/open", batch_id)
        forget(batch, touched)

    return articles.writeStream.foreachBatch(fold)
