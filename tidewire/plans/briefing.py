"""From documents or articles to a briefing: the funnel, story assembly, and rendered rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import article_id, content_hash, escape_html, shorten
from ..functions.urls import canonicalize
from ..operators.claims import SOURCES_PER_STORY, by_position, first_per_source
from ..operators.dedup import deduplicate

# Stories of a briefing, and the message's budget and hard limit.
STORIES, MESSAGE_CHARS, MESSAGE_LIMIT = 5, 3600, 4096


def enrich(articles: DataFrame, exact: bool = True) -> DataFrame:
    """``articles`` with canonical_url, id and content_hash."""
    out = articles.withColumn("canonical_url", canonicalize(F.col("url"), exact))
    return out.withColumns({"id": article_id(F.col("canonical_url")), "content_hash": content_hash(F.col("title"), F.col("summary"))})


def as_articles(documents: DataFrame, chars: int = 80) -> DataFrame:
    """Documents as articles: the first characters are the title, doc_id is the order and the identity."""
    title = F.left("text", F.lit(chars))
    return documents.select(F.col("doc_id").alias("ord"), F.col("doc_id").cast("string").alias("id"), content_hash(F.col("text"), F.lit("")).alias("content_hash"), title.alias("title"), F.col("source").alias("source_id"))


def dedup_funnel(documents: DataFrame) -> DataFrame:
    """(source_id, reason, n): documents by source and what became of them in keep-first deduplication."""
    articles = as_articles(documents)
    out = deduplicate(articles).join(articles.select("ord", "source_id"), "ord")
    return out.groupBy("source_id", F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def stories(analysed: DataFrame, articles: DataFrame, limit: int = STORIES) -> DataFrame:
    """The briefing's stories: the first ``limit`` analysed events by rank, with at most four sources each.

    ``analysed``: rank, id, article_ids, category, score, first_seen, last_updated, analysis (struct, null if the model
    gave none) and claims.
    """
    top = analysed.where(F.col("analysis").isNotNull()).orderBy("rank").limit(limit)
    found = by_position(top.select("id", "article_ids"), "id", "article_ids", articles.select(F.col("id").alias("article_id"), "source_id", F.col("title").alias("article_title"), "url"), "article_id")
    one = F.struct("position", "source_id", F.col("article_title").alias("title"), "url")
    sources = first_per_source(found, "id", most=SOURCES_PER_STORY).groupBy("id").agg(F.sort_array(F.collect_list(one)).alias("s"))
    cited = F.transform(F.coalesce("s", F.array().cast("array<struct<position:int,source_id:string,title:string,url:string>>")), lambda x: F.struct(x["source_id"].alias("source_id"), x["title"].alias("title"), x["url"].alias("url")))
    return top.join(sources, "id", "left").select("rank", F.col("id").alias("event_id"), "analysis.*", "category", "score", "first_seen", "last_updated", cited.alias("sources"), "claims")


def assemble(stories_: DataFrame, day: Column, stats: Column) -> DataFrame:
    """One row: day, stats and the stories in order."""
    return stories_.agg(F.sort_array(F.collect_list(F.struct("rank", *[c for c in stories_.columns if c != "rank"]))).alias("stories")).select(day.alias("day"), stats.alias("stats"), "stories")


def message_blocks(stories_: DataFrame) -> DataFrame:
    """(rank, block): each story as message text, escaped."""
    clean = lambda c, n: shorten(F.trim(F.regexp_replace(escape_html(F.coalesce(c, F.lit(""))), r"\s+", " ")), n)
    names = F.array_join(F.transform("sources", lambda s: s["source_id"]), ", ")
    block = F.concat(F.lit("<b>"), clean(F.col("headline"), 200), F.lit("</b>\n"), clean(F.col("what_happened"), 600), F.lit("\n<i>"), clean(F.col("why_it_matters"), 600), F.lit("</i>\n"), escape_html(names))
    return stories_.select("rank", block.alias("block"))


def message(stories_: DataFrame, header: str = "") -> DataFrame:
    """One row: the header and as many stories as the budget allows, cut at the hard limit."""
    from ..operators.claims import budget_prefix

    blocks = budget_prefix(message_blocks(stories_).withColumn("all", F.lit(1)), "all", "rank", F.length("block"), MESSAGE_CHARS)
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "block"))), lambda b: b["block"]), "\n\n")
    return blocks.agg(F.left(F.concat(F.lit(header), text), F.lit(MESSAGE_LIMIT)).alias("message"))


def page_rows(stories_: DataFrame) -> DataFrame:
    """(rank, html): each story as a page fragment, everything escaped."""
    e = lambda c: escape_html(F.coalesce(c.cast("string"), F.lit("")))
    links = F.array_join(F.transform("sources", lambda s: F.concat(F.lit('<a rel="noopener" href="'), e(s["url"]), F.lit('">'), e(s["source_id"]), F.lit("</a>"))), " ")
    body = F.concat(F.lit("<article><h2>"), e(F.col("headline")), F.lit("</h2><p>"), e(F.col("what_happened")), F.lit("</p><p>"), e(F.col("why_it_matters")), F.lit("</p><p>"), links, F.lit("</p></article>"))
    return stories_.select("rank", body.alias("html"))
