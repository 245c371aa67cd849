"""Run health, degraded-run rules, and the evaluation reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_contained

# Share of feeds that may fail, and stories that a briefing should have.
FEED_FAILURES, LEAST_STORIES, HEALTHY = 0.25, 3, 0.95
#: The delivery error of a run that kept a better briefing: on purpose, so no concern.
SUPERSEDED = "superseded by the existing briefing"
IMPORTANCE = ("important", "marginal", "noise")


def _rate(part: Column, whole: Column, digits: int = 4) -> Column:
    return F.when(whole > 0, F.round(part / whole, digits)).otherwise(F.lit(0.0))


def run_health(runs: DataFrame) -> DataFrame:
    """One row over run records: counts, rates, first and last start, exact medians and sums."""
    n, ok = F.count(F.lit(1)), F.count_if("ok")
    delivered = F.count_if("delivered")
    return runs.agg(
        n.alias("runs"), ok.alias("successes"), delivered.alias("deliveries"), _rate(ok, n).alias("success_rate"), _rate(delivered, n).alias("delivery_rate"), ((n > 0) & (ok / n >= HEALTHY)).alias("is_healthy"),
        F.min("started_at").alias("first_run"), F.max("started_at").alias("last_run"), F.median("duration_seconds").alias("median_seconds"), F.median("articles_fetched").cast("int").alias("median_articles"),
        F.median("stories_published").cast("int").alias("median_stories"), F.sum("model_calls").alias("model_calls"), F.sum("model_failures").alias("model_failures"), F.sum("schema_violations").alias("schema_violations"),
    )


def failing_feeds(runs: DataFrame) -> DataFrame:
    """(source_id, failures), most failures first, ties by the first failure."""
    rows = runs.select("started_at", F.posexplode("feeds").alias("place", "feed")).where("NOT feed.ok")
    out = rows.groupBy(F.col("feed.source_id").alias("source_id")).agg(F.count(F.lit(1)).alias("failures"), F.min(F.struct("started_at", "place")).alias("first"))
    return out.orderBy(F.desc("failures"), "first").select("source_id", "failures")


def feed_outcomes(feeds: DataFrame) -> DataFrame:
    return feeds.agg(F.count(F.lit(1)).alias("sources"), F.count_if("ok").alias("ok"), F.count_if(~F.col("ok")).alias("failed"), F.coalesce(F.sum("articles"), F.lit(0)).alias("articles"))


def concerns(run: DataFrame, least_stories: int = LEAST_STORIES) -> DataFrame:
    """``run`` with concerns: an array of (code, detail) for what a reader should be told of a run that ended.

    Outputs are held against what the run had: few stories are a concern only if the shortlist offered enough, none
    only if articles came in; half of the model calls, or a quarter of the feeds and at least two, have to fail.
    """
    feeds = F.col("feeds")
    bad = F.filter(feeds, lambda f: ~f["ok"])
    names = F.transform(bad, lambda f: f["source_id"])
    more = F.size(names) - 5
    listed = F.concat(F.array_join(F.slice(names, 1, 5), ", "), F.when(more > 0, F.concat(F.lit(" and "), more.cast("string"), F.lit(" more"))).otherwise(""))
    limit = F.greatest(F.lit(2), F.bround(F.size(feeds) * FEED_FAILURES))
    text = lambda *parts: F.concat(*(F.col(p[1:]).cast("string") if p.startswith("@") else F.lit(p) for p in parts))
    make = lambda when, code, detail: F.when(F.coalesce(when, F.lit(False)), F.struct(F.lit(code).alias("code"), detail.alias("detail")))
    thin = F.coalesce((F.col("stories_published") < least_stories) & (F.col("events_shortlisted") >= least_stories), F.lit(False))
    no_model = F.coalesce(F.col("provider") == "none", F.lit(False))
    found = F.array(
        make(thin, "thin_briefing", text("@stories_published", " stories of ", "@events_shortlisted", f" events on the shortlist; {least_stories} were expected")),
        make(~thin & (F.col("stories_published") == 0) & (F.col("articles_in_window") > 0), "nothing_published", text("no story of ", "@articles_in_window", " articles")),
        make(no_model, "no_model", F.lit("no model was available")),
        make(~no_model & (F.col("model_calls") > 0) & (F.col("model_failures") * 2 >= F.col("model_calls")), "model_degraded", text("@model_failures", " of ", "@model_calls", " model calls failed")),
        make(F.col("schema_violations") > 0, "schema_violations", text("@schema_violations", " answers had the wrong shape")),
        make((F.size(feeds) > 0) & (F.size(bad) >= limit), "feeds_failing", F.concat(F.size(bad).cast("string"), F.lit(" of "), F.size(feeds).cast("string"), F.lit(" feeds failed: "), listed)),
        make(~F.col("delivered") & (F.col("delivery_error") != "") & (F.col("delivery_error") != SUPERSEDED), "delivery_failed", text("not delivered: ", "@delivery_error")),
    )
    return run.withColumn("concerns", F.filter(found, lambda c: c.isNotNull()))


def worst_feeds(runs: DataFrame, most: int = 3) -> DataFrame:
    """The first ``most`` of :func:`failing_feeds`."""
    return failing_feeds(runs).limit(most)


def staleness_hours(last: Column, now: Column, after: int = 26) -> Column:
    """Whole hours since the last briefing if they are more than ``after``, else null."""
    hours = F.floor((F.unix_timestamp(now) - F.unix_timestamp(last)) / 3600)
    return F.when(hours > after, hours)


def structural_quality(stories: DataFrame) -> DataFrame:
    """One row over published stories (day, event_id, what_happened, sources, claims): citations, attributions, repeats."""
    cited = F.size("sources") > 0
    claims = stories.select(F.transform("sources", lambda s: F.lower(s["source_id"])).alias("known"), F.explode("claims").alias("c"))
    valid = F.size(F.array_except("c.supported_by", "known")) == 0
    of_claims = claims.agg(F.count(F.lit(1)).alias("claims"), F.count_if(valid).alias("valid_claims"))
    repeats = stories.groupBy("day").agg((F.count(F.lit(1)) - F.count_distinct("event_id")).alias("r")).agg(F.coalesce(F.sum("r"), F.lit(0)).alias("repeated_events"))
    base = stories.agg(F.count(F.lit(1)).alias("stories"), F.count_if(cited).alias("cited"), F.count_if(F.trim(F.coalesce("what_happened", F.lit(""))) == "").alias("without_summary"))
    return base.join(of_claims).join(repeats).select("*", _rate(F.col("cited"), F.col("stories")).alias("citation_rate"), _rate(F.col("valid_claims"), F.col("claims")).alias("attribution_validity"))


def judgement(published: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: published stories against labels (event_id, importance, category); null rates where nothing is judged.

    The first story of an event counts.  Marginal ones take no part in precision.
    """
    first = published.groupBy("event_id").agg(F.min_by("category", "day").alias("category"))
    importance = F.lower(F.trim("importance"))
    judged = labels.where(importance.isin(*IMPORTANCE)).select("event_id", importance.alias("importance"), F.col("category").alias("expected"))
    both = first.join(judged, "event_id")
    good, noise = F.count_if(F.col("importance") == "important"), F.count_if(F.col("importance") == "noise")
    named = F.count_if(F.col("expected").isNotNull() & (F.col("expected") != ""))
    right = F.count_if(F.col("expected") == F.col("category"))
    return both.agg(F.count(F.lit(1)).alias("matched"), good.alias("important"), noise.alias("noise"), F.when(good + noise > 0, F.round(good / (good + noise), 4)).alias("precision"), F.when(named > 0, F.round(right / named, 4)).alias("category_accuracy"))


def injection_report(attacks: DataFrame, wrapped: str = "wrapped", category: str = "category") -> DataFrame:
    """(category, attacks, escapes): how many wrapped payloads break out of their wrapper."""
    return attacks.groupBy(category).agg(F.count(F.lit(1)).alias("attacks"), F.count_if(~is_contained(F.col(wrapped))).alias("escapes"))


def label_sheet(briefings: DataFrame) -> DataFrame:
    """A row for each story of each briefing (day, stories), with empty columns for a reader's verdict."""
    rows = briefings.select("day", F.explode("stories").alias("s"))
    return rows.select("s.event_id", "day", "s.headline", F.lit("").alias("importance"), F.lit(None).cast("string").alias("category"), F.lit("").alias("notes"))
