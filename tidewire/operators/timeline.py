"""State from append-only snapshots: latest rows, day-by-day changes, windows of time."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Days of the first run's window, of the longest catch-up, of the dedup and event memories.
FIRST_RUN_DAYS, CATCH_UP_DAYS, DEDUP_DAYS, EVENT_DAYS = 1, 1, 7, 14


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key in ``order``; aggregated before the shuffle, no sort of whole groups."""
    whole = F.struct(*df.columns)
    return df.groupBy(*keys).agg(F.max_by(whole, F.struct(*order)).alias("row")).select("row.*")


def snapshot_diff(snapshots: DataFrame, key: str = "id", day: str = "day", seq: str = "seq") -> DataFrame:
    """Each key's changes from one day's last snapshot to the next.

    ``snapshots``: key, day, seq, title, n_articles, source_ids, score.  Gives key, day, title, n_articles, n_sources,
    score, new_articles (never negative), new_sources, score_change, is_first; the first day is an entry, another one
    only if articles, sources, title or score changed against the previous snapshot.
    """
    last = latest_by(snapshots, [key, day], [seq])
    w = W.partitionBy(key).orderBy(day)
    before = last.withColumn("p", F.lag(F.struct("title", "n_articles", "source_ids", "score")).over(w))
    fresh = F.array_except("source_ids", F.coalesce("p.source_ids", F.array().cast("array<string>")))
    score, was = F.coalesce("score", F.lit(0.0)), F.coalesce("p.score", F.lit(0.0))
    moved = (F.col("n_articles") != F.col("p.n_articles")) | (F.size(fresh) > 0) | (F.col("title") != F.col("p.title")) | (score != was)
    first = F.col("p").isNull()
    return before.where(first | moved).select(
        key, day, "title", "n_articles", F.size("source_ids").alias("n_sources"), "score",
        F.when(first, F.lit(0)).otherwise(F.greatest(F.lit(0), F.col("n_articles") - F.col("p.n_articles"))).cast("bigint").alias("new_articles"),
        F.when(first, F.array().cast("array<string>")).otherwise(fresh).alias("new_sources"),
        F.when(first, F.lit(0.0)).otherwise(F.round(score - was, 3)).alias("score_change"), first.alias("is_first"),
    )


def developing(entries: DataFrame, key: str = "id", day: str = "day") -> DataFrame:
    """Keys with more than one entry: entries, days_running, total_sources, latest day and title; newest first."""
    out = entries.groupBy(key).agg(
        F.count(F.lit(1)).alias("entries"), (F.datediff(F.max(day), F.min(day)) + 1).alias("days_running"), F.max_by("n_sources", day).alias("total_sources"), F.max(day).alias("latest_day"), F.max_by("title", day).alias("title")
    )
    return out.where("entries > 1").orderBy(F.desc("latest_day"), F.desc("entries"), key)


@dataclass(frozen=True)
class Window:
    start: datetime
    end: datetime
    is_first_run: bool
    was_clamped: bool


def compute_window(now: datetime, last: datetime | None, first_days: int = FIRST_RUN_DAYS, cap_days: int = CATCH_UP_DAYS) -> Window:
    """From the last success to now; a first run looks back ``first_days``, a late one ``cap_days`` at most."""
    if last is None:
        return Window(now - timedelta(days=first_days), now, True, False)
    earliest = now - timedelta(days=cap_days)
    return Window(max(last, earliest), now, False, last < earliest)


def article_time(published: Column, fetched: Column) -> Column:
    return F.coalesce(published, fetched)


def split_recent(articles: DataFrame, start: Column) -> tuple[DataFrame, DataFrame]:
    """Articles from ``start`` on (future ones too), and older ones."""
    fresh = article_time(F.col("published_at"), F.col("fetched_at")) >= start
    return articles.where(fresh), articles.where(~fresh)


def recency_stats(articles: DataFrame, start: Column) -> DataFrame:
    fresh = article_time(F.col("published_at"), F.col("fetched_at")) >= start
    n = F.count(F.lit(1))
    return articles.agg(
        n.alias("articles"), F.count_if(fresh).alias("fresh"), F.count_if(~fresh).alias("stale"), F.when(n > 0, F.round(F.count_if(~fresh) / n, 3)).otherwise(0.0).alias("stale_rate"),
        F.min(F.when(fresh, article_time(F.col("published_at"), F.col("fetched_at")))).alias("oldest_kept"),
    )


def recent_days(day: Column, today: Column, n: int) -> Column:
    """Whether ``day`` is one of the last ``n`` days up to today; a partition filter."""
    return (day > F.date_sub(today, n)) & (day <= today)


def carried(events: DataFrame, touched: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """Stored events that this run didn't touch and that were updated in the last hours."""
    return events.join(touched.select("id"), "id", "left_anti").where(F.col("last_updated") >= now - F.make_interval(hours=F.lit(hours)))


def candidates(events: DataFrame, touched: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """What a briefing may tell of: the events of this run, and the others of the last hours; columns of ``touched``."""
    return touched.unionByName(carried(events, touched, now, hours).select(*touched.columns))


def seen_entities(events: DataFrame, touched: DataFrame) -> DataFrame:
    """(entity): the entities of stored events that this run didn't touch, once each."""
    return events.join(touched.select("id"), "id", "left_anti").select(F.explode("entities").alias("entity")).distinct()


def is_developing(first_seen: Column, last_updated: Column) -> Column:
    return F.to_date(first_seen) < F.to_date(last_updated)
