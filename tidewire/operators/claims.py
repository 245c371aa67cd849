"""Claims and their sources, lookups by position, and assembled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import wrap_document

# Sources that corroborate, and the order of labels.
CORROBORATION = 2
STATUSES = ("contradicted", "verified", "partially_verified", "unverified")
SOURCES_PER_STORY = 4


def known_sources(attributed: Column, sources: Column) -> Column:
    """The attributions that the event has, trimmed, lower-cased, once each, in order."""
    clean = lambda xs: F.transform(F.coalesce(xs, F.array().cast("array<string>")), lambda x: F.lower(F.trim(x)))
    have = clean(sources)
    return F.array_distinct(F.filter(clean(attributed), lambda x: F.array_contains(have, x)))


def claim_status(supported: Column, contradicted: Column) -> Column:
    enough = F.size(supported) >= CORROBORATION
    against = F.size(contradicted) > 0
    return F.when(against & ~enough, "contradicted").when(against, "partially_verified").when(enough, "verified").otherwise("unverified")


def label_claims(claims: DataFrame) -> DataFrame:
    """``claims`` (event_id, position, text, supported_by, contradicted_by, source_ids) with status and rank in the event."""
    known = claims.withColumns({c: known_sources(F.col(c), F.col("source_ids")) for c in ("supported_by", "contradicted_by")})
    out = known.withColumn("status", claim_status(F.col("supported_by"), F.col("contradicted_by")))
    order = F.array_position(F.array(*map(F.lit, STATUSES)), F.col("status"))
    place = F.row_number().over(W.partitionBy("event_id").orderBy(order, F.desc(F.size("supported_by")), "position"))
    return out.withColumn("rank", place)


def counts_zero_filled(df: DataFrame, column: str, values: tuple[str, ...] = STATUSES) -> DataFrame:
    """(column, n) for every value, also those that don't occur."""
    every = df.sparkSession.createDataFrame([(v,) for v in values], f"{column} string")
    return every.join(df.groupBy(column).agg(F.count(F.lit(1)).alias("n")), column, "left").select(column, F.coalesce("n", F.lit(0)).alias("n"))


def by_position(parents: DataFrame, key: str, ids: str, children: DataFrame, child_id: str, first: int | None = None) -> DataFrame:
    """Children in the order of each parent's id list, with ``position``; ids without a row are left out.

    ``first`` cuts the list before the lookup.
    """
    cut = F.slice(ids, 1, first) if first else F.col(ids)
    return parents.select(key, F.posexplode(cut).alias("position", child_id)).join(children, child_id)


def first_per_source(found: DataFrame, key: str, source: str = "source_id", most: int = SOURCES_PER_STORY) -> DataFrame:
    """Each source's first row by position, at most ``most`` of a key."""
    once = found.withColumn("__n", F.row_number().over(W.partitionBy(key, source).orderBy("position"))).where("__n = 1")
    return once.withColumn("__n", F.row_number().over(W.partitionBy(key).orderBy("position"))).where(F.col("__n") <= most).drop("__n")


def documents_of(events: DataFrame, articles: DataFrame, most: int, chars: int) -> DataFrame:
    """(id, documents): an event's first articles, wrapped, in order; its title where none is stored."""
    rows = by_position(events, "id", "article_ids", articles.withColumnRenamed("id", "article_id"), "article_id", most)
    text = F.coalesce(F.nullif("content", F.lit("")), F.nullif("summary", F.lit("")), F.col("title"))
    wrapped = rows.select("id", "position", wrap_document(text, F.col("source_id"), limit=chars).alias("doc"))
    joined = wrapped.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("position", "doc"))).alias("docs"))
    lone = wrap_document(F.col("canonical_title"), F.try_element_at("source_ids", F.lit(1)), limit=chars)
    return events.select("id", "canonical_title", "source_ids").join(joined, "id", "left").select("id", F.coalesce(F.array_join(F.transform("docs", lambda d: d["doc"]), "\n\n"), lone).alias("documents"))


def budget_prefix(df: DataFrame, key: str, order: str, size: Column, budget: int, gap: int = 2) -> DataFrame:
    """Rows of each key up to the first that would pass the budget; the first row always stays."""
    w = W.partitionBy(key).orderBy(order)
    used = F.coalesce(F.sum(size + gap).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    over = (used + size > budget) & (F.row_number().over(w) > 1)
    stop = F.max(F.col("__over").cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0))
    return df.withColumn("__over", over).withColumn("__stop", stop).where("__stop = 0").drop("__over", "__stop")
