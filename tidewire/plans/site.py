"""The site as rows, rebuilt where something changed: pages of days and events, the archive, what develops, and counts.

A page is a row (kind, part, path, html) of a table partitioned by kind and part: a day's page lies in its day's part, an
event's in one of a fixed number of shards, the others in one part each.  A rebuild makes the parts that changed days
reach and overwrites those alone, so the rest of the files stay as they are; over all days it publishes everything anew
from the store, without a fetch or a model.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import escape_html
from ..operators import timeline
from ..sources import store
from .briefing import page_rows

SHARDS = 64
PAGE = "path string, html string, kind string, part string"


def _escaped(value: Column) -> Column:
    return escape_html(F.coalesce(value.cast("string"), F.lit("")))


def _list(items: Column) -> Column:
    return F.concat(F.lit("<ul>"), F.array_join(F.transform(items, lambda x: F.concat(F.lit("<li>"), x, F.lit("</li>"))), ""), F.lit("</ul>"))


def _page(path: Column, title: Column, body: Column, kind: str, part: Column) -> list[Column]:
    whole = F.concat(F.lit("<!doctype html><title>"), _escaped(title), F.lit("</title>"), body)
    return [path.alias("path"), whole.alias("html"), F.lit(kind).alias("kind"), part.cast("string").alias("part")]


def day_pages(briefings: DataFrame) -> DataFrame:
    """A page a day with the day's stories by rank; a day without stories says so."""
    each = briefings.select("day", F.explode_outer("stories").alias("s")).select("day", "s.*")
    html = page_rows(each.withColumn("rank", F.struct("day", "rank"))).select("rank.day", "rank.rank", "html")
    made = html.groupBy("day").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("rank").isNotNull(), F.struct("rank", "html")))), lambda x: x["html"]), "").alias("body"))
    body = F.when(F.col("body") == "", F.lit("<p>No stories.</p>")).otherwise(F.col("body"))
    return made.select(*_page(F.concat(F.lit("day/"), F.col("day").cast("string"), F.lit(".html")), F.col("day"), body, "day", F.col("day")))


def archive_page(briefings: DataFrame) -> DataFrame:
    """One page: a line a day, newest first."""
    line = F.concat(F.lit('<a href="day/'), F.col("day").cast("string"), F.lit('.html">'), F.col("day").cast("string"), F.lit("</a> "), F.size(F.coalesce("stories", F.array())).cast("string"))
    lines = briefings.agg(F.transform(F.sort_array(F.collect_list(F.struct("day", line.alias("line"))), False), lambda x: x["line"]).alias("lines"))
    return lines.select(*_page(F.lit("archive.html"), F.lit("Archive"), _list(F.col("lines")), "archive", F.lit("all")))


def event_part(id: Column) -> Column:
    return F.pmod(F.xxhash64(id), F.lit(SHARDS))


def _changes(snapshots: DataFrame) -> DataFrame:
    return timeline.snapshot_diff(snapshots.select("id", "day", "seq", F.col("canonical_title").alias("title"), F.size("article_ids").alias("n_articles"), "source_ids", F.col("importance_score").alias("score")))


def event_pages(changes: DataFrame) -> DataFrame:
    """A page an event: its days in order, what was new on each and where the score went."""
    text = F.concat(F.col("day").cast("string"), F.lit(": "), _escaped(F.col("title")), F.lit(" (+"), F.col("new_articles").cast("string"), F.lit(")"))
    rows = changes.groupBy("id").agg(F.transform(F.sort_array(F.collect_list(F.struct("day", text.alias("line")))), lambda x: x["line"]).alias("lines"), F.max_by("title", "day").alias("title"))
    return rows.select(*_page(F.concat(F.lit("event/"), F.sha2("id", 256), F.lit(".html")), F.col("title"), _list(F.col("lines")), "event", event_part(F.col("id"))))


def developing_page(changes: DataFrame, limit: int = 100) -> DataFrame:
    """One page: the events with more than one entry, newest first, at most ``limit``."""
    rows = timeline.developing(changes).limit(limit)
    line = F.concat(_escaped(F.col("title")), F.lit(" ("), F.col("days_running").cast("string"), F.lit(" days)"))
    order = F.struct(F.col("latest_day").alias("a"), F.col("entries").alias("b"), line.alias("line"))
    lines = rows.agg(F.transform(F.sort_array(F.collect_list(order), False), lambda x: x["line"]).alias("lines"))
    return lines.select(*_page(F.lit("developing.html"), F.lit("Developing"), _list(F.col("lines")), "developing", F.lit("all")))


def stats_page(briefings: DataFrame) -> DataFrame:
    """One page: days and stories by month, newest first."""
    months = briefings.groupBy(F.date_format("day", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("days"), F.sum(F.size(F.coalesce("stories", F.array()))).alias("stories"))
    line = F.concat("month", F.lit(": "), F.col("days").cast("string"), F.lit(" days, "), F.col("stories").cast("string"), F.lit(" stories"))
    lines = months.agg(F.transform(F.sort_array(F.collect_list(F.struct("month", line.alias("line"))), False), lambda x: x["line"]).alias("lines"))
    return lines.select(*_page(F.lit("stats.html"), F.lit("Counts"), _list(F.col("lines")), "stats", F.lit("all")))


def rebuild(spark: SparkSession, root: str, days: Sequence[date] | None = None) -> DataFrame:
    """Rebuilds ``root/site`` from the store where ``days`` (default: all) changed it; the pages that were written."""
    briefings, snapshots = store.read_briefings(spark, root), store.read_events(spark, root)
    pages = archive_page(briefings).unionByName(stats_page(briefings)).unionByName(developing_page(_changes(snapshots)))
    if days is None:
        pages = pages.unionByName(day_pages(briefings)).unionByName(event_pages(_changes(snapshots)))
    else:
        shards = snapshots.where(F.col("day").isin(*days)).select(event_part(F.col("id")).alias("shard")).distinct()  # at most SHARDS rows
        touched = snapshots.withColumn("shard", event_part(F.col("id"))).join(F.broadcast(shards), "shard", "left_semi").drop("shard")
        pages = pages.unionByName(day_pages(briefings.where(F.col("day").isin(*days)))).unionByName(event_pages(_changes(touched)))
    pages.repartition("kind", "part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("kind", "part").parquet(f"{root}/site")
    return pages


def read_site(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(PAGE).parquet(f"{root}/site")
