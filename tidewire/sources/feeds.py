"""Feeds: the registry, an RSS and Atom parser, and a data source that reads a landing folder of feed files."""

from __future__ import annotations

import html
import json
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime
from email.utils import parsedate_to_datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

TIERS = ("primary", "research", "journalism", "ecosystem")
REGISTRY = "id string, name string, tier string, feed_url string, site_url string, credibility double, enabled boolean, max_items_per_run int, note string, registry_pos int"
ENTRY = "source_id string, entry int, url string, title string, published_at timestamp, summary string, content string"
# How much of an entry is taken.
TITLE_CHARS, SUMMARY_CHARS, CONTENT_CHARS, ITEMS = 500, 2000, 20_000, 50


class RegistryError(ValueError):
    """The registry cannot be used."""


def load_registry(spark: SparkSession, text: str) -> DataFrame:
    """The source registry of a JSON or YAML document ({sources: [...]}), checked, with ``registry_pos``."""
    try:
        data = json.loads(text)
    except ValueError:
        try:
            import yaml
        except ImportError as e:
            raise RegistryError("the registry isn't JSON, and there is no YAML reader") from e
        data = yaml.safe_load(text)
    rows = data.get("sources") if isinstance(data, dict) else None
    if not isinstance(rows, list):
        raise RegistryError("the registry has no list of sources")
    out, seen = [], set()
    for k, r in enumerate(rows):
        if not isinstance(r, dict) or not re.fullmatch(r"[a-z0-9][a-z0-9_\-]*", str(r.get("id", ""))) or r.get("tier") not in TIERS or not r.get("feed_url"):
            raise RegistryError(f"source {k} isn't valid: {r}")
        credibility, items = float(r.get("credibility", 0.5)), int(r.get("max_items_per_run", ITEMS))
        if not 0 <= credibility <= 1 or not 1 <= items <= 500:
            raise RegistryError(f"source {r['id']} is out of range")
        if r["id"] in seen:
            raise RegistryError(f"source {r['id']} occurs twice")
        seen.add(r["id"])
        out.append((r["id"], r.get("name") or r["id"], r["tier"], r["feed_url"], r.get("site_url"), credibility, bool(r.get("enabled", True)), items, r.get("note"), k))
    return spark.createDataFrame(out, REGISTRY)


def credibility_by_id(registry: DataFrame) -> dict[str, float]:
    """Of all sources, disabled ones too."""
    return {r.id: r.credibility for r in registry.select("id", "credibility").collect()}


def enabled_sources(registry: DataFrame) -> DataFrame:
    return registry.where("enabled")


def by_tier(registry: DataFrame, tier: str) -> DataFrame:
    return registry.where(F.col("tier") == tier)


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1].lower()


def _clean(text: str | None, limit: int) -> str | None:
    bare = " ".join(html.unescape(re.sub(r"<[^>]+>", " ", text or "")).split())
    return bare[:limit] or None


def _time(text: str | None) -> datetime | None:
    if not text:
        return None
    for read in (parsedate_to_datetime, lambda t: datetime.fromisoformat(t.strip().replace("Z", "+00:00"))):
        try:
            when = read(text)
            return (when if when.tzinfo else when.replace(tzinfo=UTC)).astimezone(UTC)
        except (ValueError, TypeError, IndexError):
            continue
    return None


def parse_feed(body: bytes, most: int = ITEMS) -> Iterator[tuple]:
    """(entry, url, title, published_at, summary, content) of the first ``most`` valid entries of RSS or Atom bytes.

    An entry needs a title and an http(s) link.  The first date that is present counts, even if it doesn't parse.
    """
    root = ET.fromstring(body)
    n = 0
    for at, item in enumerate(e for e in root.iter() if _local(e.tag) in ("item", "entry")):
        if n >= most:
            return
        part: dict[str, str] = {}
        for child in item:
            name = _local(child.tag)
            value = child.get("href") if name == "link" and child.get("href") and child.get("rel", "alternate") == "alternate" else "".join(child.itertext())
            if value and value.strip():
                part.setdefault(name, value.strip())
        url, title = part.get("link", ""), _clean(part.get("title"), TITLE_CHARS)
        if not title or not re.match(r"https?://[^/\s]+", url):
            continue
        when = next((part[k] for k in ("pubdate", "published", "date", "updated", "created") if k in part), None)
        summary = part.get("description") or part.get("summary")
        yield at, url, title, _time(when), _clean(summary, SUMMARY_CHARS), _clean(part.get("encoded") or part.get("content") or summary, CONTENT_CHARS)
        n += 1


def parse_feeds(files: DataFrame, most: int = ITEMS, registry: DataFrame | None = None) -> DataFrame:
    """ENTRY rows and, for feeds that don't parse, one row with an ``error``, of (source_id, content) rows.

    With a ``registry`` only its enabled sources are read, and each up to its own max_items_per_run.
    """
    if registry is not None:
        limits = enabled_sources(registry).select(F.col("id").alias("source_id"), F.col("max_items_per_run").alias("most"))
        files = files.join(F.broadcast(limits), "source_id")  # a registry is a few hundred checked rows
    else:
        files = files.withColumn("most", F.lit(most))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for source, body, limit in zip(batch["source_id"], batch["content"], batch["most"], strict=True):
                if body is None:
                    continue
                try:
                    rows += [(source, *entry, None) for entry in parse_feed(bytes(body), int(limit))]
                except (ET.ParseError, ValueError, TypeError) as e:
                    rows.append((source, None, None, None, None, None, None, str(e)[:200]))
            yield pd.DataFrame(rows, columns=["source_id", "entry", "url", "title", "published_at", "summary", "content", "error"])

    return files.select("source_id", "content", "most").mapInPandas(run, f"{ENTRY}, error string")


def liveness(registry: DataFrame, entries: DataFrame) -> DataFrame:
    """(id, articles, newest, ok) for every source of the registry."""
    found = entries.groupBy(F.col("source_id").alias("id")).agg(F.count("url").alias("articles"), F.max("published_at").alias("newest"), F.max("error").alias("error"))
    return registry.select("id", "enabled").join(found, "id", "left").select("id", "enabled", F.coalesce("articles", F.lit(0)).alias("articles"), "newest", (F.coalesce("articles", F.lit(0)) > 0).alias("ok"), "error")


@dataclass
class _Feed(InputPartition):
    source_id: str
    path: str
    most: int


class FeedSource(DataSource):
    """``spark.read.format("feeds").option("files", '{"source_id": "path", ...}')``: one partition a feed.

    Paths are of a folder that all executors mount; a fetcher that keeps to the url guard fills it.
    """

    @classmethod
    def name(cls) -> str:
        return "feeds"

    def schema(self) -> str:
        return f"{ENTRY}, error string"

    def reader(self, schema) -> _FeedReader:
        return _FeedReader(json.loads(self.options.get("files", "{}")), int(self.options.get("most", ITEMS)))


class _FeedReader(DataSourceReader):
    def __init__(self, files: dict[str, str], most: int) -> None:
        self.files, self.most = files, most

    def partitions(self) -> list[InputPartition]:
        return [_Feed(s, p, self.most) for s, p in self.files.items()] or [_Feed("", "", 0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if not partition.path:
            return
        try:
            with open(partition.path, "rb") as f:
                for entry in parse_feed(f.read(), partition.most):
                    yield (partition.source_id, *entry, None)
        except (OSError, ET.ParseError) as e:
            yield (partition.source_id, None, None, None, None, None, None, str(e)[:200])


def flattened(entries: DataFrame, registry: DataFrame, fetched_at: datetime) -> DataFrame:
    """Articles with ``ord``: registry order, then entry order; numbered within each source, no task sees all."""
    from pyspark.sql import Window as W

    rows = entries.where("url IS NOT NULL").join(registry.select(F.col("id").alias("source_id"), "registry_pos"), "source_id")
    sizes = rows.groupBy("registry_pos").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("registry_pos", (F.sum("n").over(W.orderBy("registry_pos")) - F.col("n")).alias("before"))  # a row a source
    place = F.row_number().over(W.partitionBy("registry_pos").orderBy("entry")) - 1
    rows = rows.withColumn("place", place).join(F.broadcast(before), "registry_pos")
    return rows.withColumn("ord", (F.col("before") + F.col("place")).cast("bigint")).drop("before", "place").withColumn("fetched_at", F.lit(fetched_at)).drop("entry", "error", "registry_pos")
