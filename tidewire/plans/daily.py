"""A day's run as one plan that can be resumed: every stage is a table of the run, and what is there isn't done again.

A stage's table counts once Spark's committer has marked it; a run that stops leaves at most a table without a mark, which
the next one overwrites.  Appends to the store leave out what the store has, and the run state, which moves the window on,
is written after everything else.  So a run that was stopped anywhere and is started again under its name leaves the store
that an undisturbed run leaves.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.categories import Profile
from ..operators import ranking, timeline
from ..operators.cluster import cluster_articles
from ..operators.dedup import deduplicate
from ..sources import store
from .briefing import enrich


class RunLog:
    """The tables of one run, in ``root/work/name``."""

    def __init__(self, spark: SparkSession, root: str, name: str) -> None:
        self.spark, self.path = spark, f"{root}/work/{name}"
        self.made: list[str] = []

    def done(self, stage: str) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{stage}/_SUCCESS")
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def step(self, stage: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The stage's table: read if it was written, else made and written."""
        if not self.done(stage):
            make().write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(f"{self.path}/{stage}")
            self.made.append(stage)
        return self.spark.read.parquet(f"{self.path}/{stage}")


def _changed(spark: SparkSession, root: str, day, events: DataFrame) -> DataFrame:
    """The snapshots that the day's last ones don't have already."""
    state = lambda df: df.select("id", F.col("last_updated").alias("at"), F.size("article_ids").alias("n"))
    last = state(store.latest_events(spark, root, [day]))
    marked = events.withColumns({"at": F.col("last_updated"), "n": F.size("article_ids")})
    return marked.join(last, ["id", "at", "n"], "left_anti").drop("at", "n")


def daily_run(
    spark: SparkSession, root: str, entries: DataFrame, now: datetime, profile: Profile = Profile(), registry: dict[str, float] | None = None, name: str | None = None, after: Callable[[str], None] = lambda stage: None
) -> DataFrame:
    """Runs ``entries`` (ord, url, title, summary, source_id, published_at, fetched_at) through to the ranked shortlist.

    ``now`` is the run's time, naive UTC; ``name`` tells runs apart (default: the time).  ``after`` is called after each
    stage.  Entries older than the window since the last success, or known from the last 7 days by id or content, are left
    out; the rest is stored, clustered with the events of 14 days, scored with those of the last 24 hours and ranked.
    """
    log, day, at = RunLog(spark, root, name or now.strftime("%Y%m%dT%H%M%S")), now.date(), F.lit(now)

    def stage(title: str, make: Callable[[], DataFrame]) -> DataFrame:
        out = log.step(title, make)
        after(title)
        return out

    state = store.read_state(spark, root)
    last = state["last_briefing_at"] and datetime.fromisoformat(state["last_briefing_at"])
    window = stage("window", lambda: spark.createDataFrame([(timeline.compute_window(now, last).start,)], "start timestamp"))  # one row
    start = window.first().start
    fresh = stage("fresh", lambda: enrich(timeline.split_recent(entries, F.lit(start))[0]))

    def unique() -> DataFrame:
        days = store.recent(day, timeline.DEDUP_DAYS)
        kept = deduplicate(fresh, store.known_ids(spark, root, days), store.known_hashes(spark, root, days)).where("kept").select("ord")
        return fresh.join(kept, "ord")

    new = stage("unique", unique)
    days = store.recent(day, timeline.EVENT_DAYS)
    touched = stage("events", lambda: cluster_articles(new, store.latest_events(spark, root, days)))
    memory = stage("memory", lambda: store.latest_events(spark, root, days))
    store.append_articles(spark, root, day, new)
    after("articles")

    def scored() -> DataFrame:
        rows = timeline.candidates(memory, touched.drop("is_new"), at)
        return ranking.score_events(rows, profile, registry or {}, F.to_date(at), timeline.seen_entities(memory, touched))

    ranked = stage("scored", scored)
    best = stage("shortlist", lambda: ranking.shortlist(ranked))
    marked = ranked.join(touched.select("id"), "id", "left_semi")
    store.write_events(root, day, _changed(spark, root, day, marked))
    after("snapshots")
    if not log.done("state"):
        counts = new.agg(F.count(F.lit(1))).first()[0]
        state |= {"last_briefing_at": now.isoformat(), "last_run_at": now.isoformat(), "successful_runs": state["successful_runs"] + 1, "total_runs": state["total_runs"] + 1, "last_articles": counts}
        if state.get("last_run") != log.path.rsplit("/", 1)[-1]:
            store.write_state(spark, root, state | {"last_run": log.path.rsplit("/", 1)[-1]})
        after("written")
        log.step("state", lambda: spark.createDataFrame([(now,)], "at timestamp"))
    return best
