"""The append-only store: NDJSON tables by day or month, tolerant readers, idempotent writers, run state."""

from __future__ import annotations

import json
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import shorten
from ..operators.timeline import latest_by

ARTICLE = (
    "url string, title string, source_id string, fetched_at timestamp, published_at timestamp, summary string, content string, id string, canonical_url string, content_hash string, event_id string"
)
EVENT = (
    "id string, canonical_title string, category string, entities array<string>, article_ids array<string>, source_ids array<string>, first_seen timestamp, last_updated timestamp, "
    "importance_score double, description string, confidence double"
)
FEED_OUTCOME = "struct<source_id:string,ok:boolean,articles:int,error:string,duration_seconds:double>"
RUN = (
    f"started_at timestamp, finished_at timestamp, ok boolean, duration_seconds double, window_start timestamp, window_hours double, first_run boolean, window_clamped boolean, feeds array<{FEED_OUTCOME}>, "
    "articles_fetched int, articles_in_window int, articles_stored int, duplicates_removed int, events_touched int, events_ranked int, events_multi_source int, events_shortlisted int, stories_published int, "
    "provider string, model_calls int, model_failures int, model_rate_limited int, schema_violations int, claims_extracted int, claims_corroborated int, delivered boolean, delivery_error string, error string"
)
REQUIRED = {"articles": ("url", "title", "source_id", "fetched_at"), "events": ("id", "canonical_title"), "runs": ("started_at",)}
SUMMARY_CHARS = 500


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _read(spark: SparkSession, path: str, schema: str, required: tuple[str, ...], part: str | None = "day") -> DataFrame:
    """Rows of an NDJSON table; lines that don't parse or lack a required field are left out, never fatal."""
    full = f"{schema}, {part} date" if part == "day" else f"{schema}, {part} string" if part else schema
    if not _exists(spark, path):
        return spark.createDataFrame([], full)
    bad = "_broken"
    rows = spark.read.schema(f"{full}, {bad} string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad).json(path)
    kept = rows.where(F.col(bad).isNull())
    for name in required:
        kept = kept.where(F.col(name).isNotNull())
    return kept.drop(bad)


def broken_lines(spark: SparkSession, path: str, schema: str) -> int:
    """How many lines of a table don't parse."""
    rows = spark.read.schema(f"{schema}, _broken string").option("columnNameOfCorruptRecord", "_broken").json(path)
    return rows.select("*").where(F.col("_broken").isNotNull()).count()


def read_articles(spark: SparkSession, root: str, days: list[date] | None = None) -> DataFrame:
    """Stored articles with their ``day``; ``days`` prunes partitions."""
    rows = _read(spark, f"{root}/articles", ARTICLE, REQUIRED["articles"])
    return rows.where(F.col("day").isin(*days)) if days is not None else rows


def recent(today: date, n: int) -> list[date]:
    return [today - timedelta(days=k) for k in range(n)]


def known_ids(spark: SparkSession, root: str, days: list[date]) -> DataFrame:
    return read_articles(spark, root, days).select("id").where("id IS NOT NULL").distinct()


def known_hashes(spark: SparkSession, root: str, days: list[date]) -> DataFrame:
    return read_articles(spark, root, days).select("content_hash").where("content_hash IS NOT NULL").distinct()


def serialised(articles: DataFrame) -> DataFrame:
    """What is stored of an article: no content, a short summary, columns in the order of their names."""
    out = articles.withColumn("summary", shorten(F.col("summary"), SUMMARY_CHARS)).drop("content")
    return out.select(*sorted(out.columns))


def _append(df: DataFrame, path: str, part: str) -> None:
    df.write.mode("append").option("ignoreNullFields", "true").partitionBy(part).json(path)


def append_articles(spark: SparkSession, root: str, day: date, articles: DataFrame, skip: DataFrame | None = None) -> int:
    """Appends articles whose id the day doesn't have, each id once (the first in ``ord``); returns the rows written."""
    key = F.coalesce("id", "url")
    rows = articles.withColumn("__key", key)
    rows = rows.groupBy("__key").agg(F.min_by(F.struct(*articles.columns), "ord").alias("row")).select("__key", "row.*")
    stored = read_articles(spark, root, [day]).select(key.alias("__key"))
    if skip is not None:
        stored = stored.unionByName(skip.select(F.col(skip.columns[0]).alias("__key")))
    fresh = rows.join(stored.distinct(), "__key", "left_anti").drop("__key", "ord").cache()
    n = fresh.count()
    if n:
        _append(serialised(fresh).withColumn("day", F.lit(day)), f"{root}/articles", "day")
    fresh.unpersist()
    return n


def write_events(root: str, day: date, events: DataFrame) -> None:
    """Appends snapshots; ``seq`` tells states of one event in one write apart, the later one wins where they are read.

    seq is the column of that name where ``events`` has one, else the order of the rows (partition, then row).
    """
    names = [c.split()[0] for c in EVENT.split(", ")]
    have = [c for c in names if c in events.columns]
    seq = F.col("seq").cast("bigint") if "seq" in events.columns else F.monotonically_increasing_id()
    _append(events.select(*sorted(have), seq.alias("seq"), F.lit(day).alias("day"), F.current_timestamp().alias("written_at")), f"{root}/events", "day")


def read_events(spark: SparkSession, root: str, days: list[date] | None = None) -> DataFrame:
    rows = _read(spark, f"{root}/events", f"{EVENT}, seq bigint, written_at timestamp", REQUIRED["events"])
    return rows.where(F.col("day").isin(*days)) if days is not None else rows


def latest_events(spark: SparkSession, root: str, days: list[date]) -> DataFrame:
    """Each event's last state over the days, newest update first."""
    return latest_by(read_events(spark, root, days), ["id"], ["day", "written_at", "seq"]).drop("written_at", "seq").orderBy(F.desc("last_updated"), "id")


def event_days(spark: SparkSession, root: str) -> list[date]:
    """The days that have snapshots, by the folders' names; no row is read."""
    return _days(spark, f"{root}/events")


def _days(spark: SparkSession, path: str) -> list[date]:
    if not _exists(spark, path):
        return []
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)]
    found = []
    for name in names:
        try:
            found.append(date.fromisoformat(name.removeprefix("day=")))
        except ValueError:
            continue
    return sorted(found)


def write_run(root: str, run: DataFrame) -> None:
    _append(run.withColumn("month", F.date_format("started_at", "yyyy-MM")), f"{root}/runs", "month")


def read_runs(spark: SparkSession, root: str, limit: int | None = None) -> DataFrame:
    """Runs, newest first."""
    rows = _read(spark, f"{root}/runs", RUN, REQUIRED["runs"], "month").orderBy(F.desc("started_at"))
    return rows.limit(limit) if limit else rows


def write_briefing(root: str, day: date, briefing: DataFrame) -> bool:
    """Writes a day's briefing unless an empty one would replace one with stories; whether it was written."""
    spark = briefing.sparkSession
    path = f"{root}/briefings/day={day.isoformat()}"
    if briefing.where(F.size("stories") > 0).isEmpty() and _exists(spark, path):
        if not spark.read.json(path).where(F.size("stories") > 0).isEmpty():
            return False
    replace(briefing, path)
    return True


def replace(df: DataFrame, path: str) -> None:
    """Writes ``df`` as JSON beside ``path`` and puts it in its place only when it is whole; ``df`` may read ``path``."""
    spark = df.sparkSession
    new, old = f"{path}.new", f"{path}.old"
    files = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    system = files(path).getFileSystem(spark._jsc.hadoopConfiguration())
    df.write.mode("overwrite").json(new)
    system.delete(files(old), True)
    if system.exists(files(path)):
        system.rename(files(path), files(old))
    system.rename(files(new), files(path))
    system.delete(files(old), True)


STORY = (
    "struct<rank:int,event_id:string,headline:string,what_happened:string,why_it_matters:string,confidence:double,category:string,score:double,first_seen:timestamp,last_updated:timestamp,"
    "sources:array<struct<source_id:string,title:string,url:string>>,claims:array<struct<text:string,supported_by:array<string>,contradicted_by:array<string>,status:string>>>"
)
BRIEFING = f"stats map<string,double>, stories array<{STORY}>"


def read_briefings(spark: SparkSession, root: str, day: date | None = None) -> DataFrame:
    """(day, stats, stories) of all briefings, newest first, or of one day; lines that don't parse are left out."""
    rows = _read(spark, f"{root}/briefings", BRIEFING, ()).where("stories IS NOT NULL")
    return (rows.where(F.col("day") == F.lit(day)) if day is not None else rows).orderBy(F.desc("day"))


def load_dataset(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """The rows under ``key`` of a JSON document, such as labelled stories or attacks; none where there is no file."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    fields = ",".join(f"{c.split()[0]}:{c.split(maxsplit=1)[1]}" for c in schema.split(", "))
    rows = spark.read.schema(f"{key} array<struct<{fields}>>").option("multiLine", "true").json(path)
    return rows.select(F.explode(key).alias("row")).select("row.*")


LABELS = "event_id string, importance string, category string, notes string"
ATTACKS = "id string, category string, payload string"


def load_labels(spark: SparkSession, path: str) -> DataFrame:
    return load_dataset(spark, path, LABELS, "labels")


def load_attacks(spark: SparkSession, path: str) -> DataFrame:
    return load_dataset(spark, path, ATTACKS, "attacks")


def write_report(report: DataFrame, path: str) -> None:
    """A small report (evaluation results, a reply feed) as one JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def read_state(spark: SparkSession, root: str) -> dict:
    """The run state; a missing or broken file means that nothing ran yet."""
    start = {"last_briefing_at": None, "last_run_at": None, "successful_runs": 0, "total_runs": 0}
    if not _exists(spark, f"{root}/state"):
        return start
    rows = spark.read.text(f"{root}/state").limit(1).collect()
    try:
        return start | json.loads(rows[0].value) if rows else start
    except (ValueError, TypeError):
        return start


def write_state(spark: SparkSession, root: str, state: dict) -> None:
    """The last step of a run."""
    line = json.dumps(state, sort_keys=True, default=lambda v: v.isoformat())
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/state")


def validated(df: DataFrame, text: str, schema: str, required: tuple[str, ...], bounds: str) -> DataFrame:
    """``df`` with ``parsed`` (null where invalid) and ``violation``: unknown or missing keys, or ``bounds`` not met."""
    keys = tuple(c.split()[0].split(":")[0] for c in schema.split(", "))
    out = df.withColumn("parsed", F.from_json(F.col(text), schema)).withColumn("__keys", F.json_object_keys(text))
    fits = (F.size(F.array_except("__keys", F.array(*map(F.lit, keys)))) == 0) & F.expr(bounds)
    for name in required:
        fits &= F.col(f"parsed.{name}").isNotNull()
    ok = F.coalesce(fits, F.lit(False))
    return out.withColumn("violation", ~ok).withColumn("parsed", F.when(ok, F.col("parsed"))).drop("__keys")
