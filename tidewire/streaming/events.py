"""Structured Streaming counterparts: bounded-memory dedup, windows over event time, snapshots as an idempotent sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def dedup_stream(articles: DataFrame, memory: str = "7 days", time: str = "fetched_at", keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """The first arrival of each key within the memory; state older than that is dropped."""
    return articles.withWatermark(time, memory).dropDuplicatesWithinWatermark(list(keys))


def tumbling_counts(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events and their mean value by window and type; final once the watermark passes."""
    out = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value"))
    return out.select(F.col("window.start").alias("start"), "event_type", "n", "mean_value")


def sliding_counts(events: DataFrame, width: str = "1 hour", step: str = "15 minutes", late: str = "10 minutes") -> DataFrame:
    out = events.withWatermark("ts", late).groupBy(F.window("ts", width, step), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("window.start").alias("start"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """(user_id, start, end, n): runs of a user's events with less than ``gap`` between them."""
    out = events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap)).agg(F.count(F.lit(1)).alias("n"))
    return out.select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def snapshot_sink(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Writes each micro-batch to its own partition, so a repeated batch replaces itself; readers take the latest row."""

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True)
