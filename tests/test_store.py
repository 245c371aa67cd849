from __future__ import annotations

import json
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from tidewire.operators.cluster import merge_events
from tidewire.plans import briefing, model
from tidewire.sources import feeds, store
from tidewire.streaming import events as streams

DAY, T0 = date(2026, 1, 2), datetime(2026, 1, 2, tzinfo=UTC)

RSS = b"""<?xml version="1.0"?><rss><channel><title>c</title>
<item><title>One &amp; only</title><link>https://a.example/1</link><pubDate>Fri, 02 Jan 2026 10:00:00 +0200</pubDate><description>&lt;p&gt;Hi &amp;amp; bye&lt;/p&gt;</description></item>
<item><title>No link</title></item><item><title>Bad</title><link>javascript:x</link></item>
<item><title>Two</title><link>https://a.example/2</link><pubDate>whenever</pubDate></item></channel></rss>"""
ATOM = b"""<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>A</title><link rel="self" href="https://x.example/self"/><link href="https://x.example/a"/><updated>2026-01-01T00:00:00Z</updated><summary>s</summary><content>long</content></entry></feed>"""


def test_feeds_are_parsed_and_failures_are_rows(spark):
    df = spark.createDataFrame([("r", RSS), ("a", ATOM), ("bad", b"<oops")], "source_id string, content binary")
    rows = {(r.source_id, r.entry): r for r in feeds.parse_feeds(df).collect()}
    assert set(rows) == {("r", 0), ("r", 3), ("a", 0), ("bad", None)}
    assert rows["r", 0].title == "One & only" and rows["r", 0].summary == "Hi & bye" and rows["r", 0].published_at.hour in (8, 10)
    assert rows["r", 3].published_at is None and rows["a", 0].url == "https://x.example/a" and rows["a", 0].content == "long"
    assert rows["bad", None].error


def test_feed_source_reads_one_partition_a_feed(spark, tmp_path):
    for name, body in (("r", RSS), ("a", ATOM)):
        (tmp_path / f"{name}.xml").write_bytes(body)
    spark.dataSource.register(feeds.FeedSource)
    files = {n: str(tmp_path / f"{n}.xml") for n in ("r", "a", "gone")}
    df = spark.read.format("feeds").option("files", json.dumps(files)).option("most", "1").load()
    assert {(r.source_id, r.error is None) for r in df.collect()} == {("r", True), ("a", True), ("gone", False)}


def test_registry_is_checked(spark):
    one = {"id": "a", "tier": "primary", "feed_url": "https://a.example"}
    assert feeds.load_registry(spark, json.dumps({"sources": [one]})).first().credibility == 0.5
    for bad in ({"sources": [one, one]}, {"sources": [one | {"tier": "x"}]}, {"sources": [one | {"credibility": 2}]}, {}):
        with pytest.raises(feeds.RegistryError):
            feeds.load_registry(spark, json.dumps(bad))
    registry = feeds.load_registry(spark, json.dumps({"sources": [one]}))
    entries = feeds.parse_feeds(spark.createDataFrame([("a", RSS)], "source_id string, content binary"))
    assert feeds.liveness(registry, entries).first().articles == 2
    assert [r.ord for r in feeds.flattened(entries, registry, T0).orderBy("ord").collect()] == [0, 1]


def test_articles_are_appended_once_and_broken_lines_are_skipped(spark, tmp_path):
    root = str(tmp_path)
    rows = [(0, "u1", "t", "s", T0, "x" * 600, "a"), (1, "u1", "t", "s", T0, None, "a"), (2, "u2", "t2", "s", T0, None, "b")]
    df = spark.createDataFrame(rows, "ord bigint, url string, title string, source_id string, fetched_at timestamp, summary string, id string").withColumn("content", F.lit("body")).withColumn("content_hash", F.lit("h"))
    assert store.read_articles(spark, root).count() == 0
    assert store.append_articles(spark, root, DAY, df) == 2
    assert store.append_articles(spark, root, DAY, df) == 0
    (tmp_path / "articles" / f"day={DAY}" / "extra.json").write_text('{"url": "u9"\n{"title": "no url"}\n')
    back = store.read_articles(spark, root, [DAY])
    assert sorted(r.id for r in back.collect()) == ["a", "b"]
    assert back.where("id = 'a'").first().summary == "x" * 500 + "…" and back.where("content IS NOT NULL").isEmpty()
    assert store.known_ids(spark, root, store.recent(DAY, 7)).count() == 2 and store.known_hashes(spark, root, [DAY]).count() == 1


def test_events_runs_state_and_briefings(spark, tmp_path):
    root = str(tmp_path)
    event = spark.createDataFrame([("e", "first", T0)], "id string, canonical_title string, last_updated timestamp")
    store.write_events(root, DAY, event)
    store.write_events(root, date(2026, 1, 3), event.withColumn("canonical_title", F.lit("second")))
    assert [r.canonical_title for r in store.latest_events(spark, root, store.recent(date(2026, 1, 3), 2)).collect()] == ["second"]
    assert store.event_days(spark, root) == [DAY, date(2026, 1, 3)]
    run = spark.createDataFrame([(T0, True, 5)], "started_at timestamp, ok boolean, stories_published int")
    store.write_run(root, run)
    assert store.read_runs(spark, root, 1).first().stories_published == 5
    assert store.read_state(spark, root)["total_runs"] == 0
    store.write_state(spark, root, {"total_runs": 3, "last_run_at": T0})
    assert store.read_state(spark, root)["total_runs"] == 3
    full = spark.createDataFrame([("d", ["s"])], "day string, stories array<string>")
    empty = full.withColumn("stories", F.array().cast("array<string>"))
    assert store.write_briefing(root, DAY, full) and not store.write_briefing(root, DAY, empty) and store.write_briefing(root, DAY, full)


def test_answers_have_exactly_the_shape():
    good = json.dumps({"same_event": True, "confidence": 0.9, "reasoning": "r"})
    assert model.parse_answer("```" + good + "```", model.PAIR)["same_event"]
    for bad in ("{", good[:-1] + ', "x": 1}', good.replace("0.9", "1.9"), good.replace("true", "1"), "[]"):
        assert model.parse_answer(bad, model.PAIR) is None


def test_calls_keep_to_budget_reserve_and_quota():
    good = json.dumps({"same_event": True, "confidence": 0.9, "reasoning": "r"})
    calls = model.Calls(model.scripted(["junk", good, good]), budget=3)
    assert calls.structured("p", model.PAIR) and calls.made == 2 and calls.violations == 1
    assert calls.structured("p", model.PAIR, reserve=1) is None
    chain = model.Chain([model.Calls(model.scripted([])), model.Calls(model.scripted([good]))])
    assert chain.structured("p", model.PAIR) and chain.at == 1 and chain.stats()["model_calls"] == 2


def test_merges_are_not_transitive(spark):
    yes = {"same_event": True, "confidence": 0.8}
    assert model.adjudicate([("a", "b"), ("b", "c"), ("c", "d")], {"a": 1, "b": 2, "c": 1, "d": 1}, lambda _: yes) == [("b", "a"), ("b", "c")]
    ev = spark.createDataFrame([("a", "A", "x", ["p"], ["1"], ["s"], T0, T0), ("b", "B", "y", ["q", "p"], ["2"], ["s"], T0, T0)], "id string, canonical_title string, category string, entities array<string>, article_ids array<string>, source_ids array<string>, first_seen timestamp, last_updated timestamp")
    row = merge_events(ev, ev, spark.createDataFrame([("b", "a")], "keep_id string, drop_id string")).first()
    assert (row.id, row.entities, row.article_ids, row.source_ids) == ("b", ["q", "p"], ["2", "1"], ["s"])


def test_briefing_takes_analysed_events_and_cites_four_sources(spark):
    articles = spark.createDataFrame([(f"a{k}", f"s{k % 6}", f"t{k}", f"https://x/{k}") for k in range(12)], "id string, source_id string, title string, url string")
    analysis = "struct<headline:string,what_happened:string,why_it_matters:string,confidence:double>"
    rows = [(1, "e1", [f"a{k}" for k in range(12)], "policy", 5.0, T0, T0, ("<H>", "w", "y", 0.5), []), (2, "e2", ["a1"], "policy", 4.0, T0, T0, None, [])]
    df = spark.createDataFrame(rows, f"rank int, id string, article_ids array<string>, category string, score double, first_seen timestamp, last_updated timestamp, analysis {analysis}, claims array<string>")
    found = briefing.stories(df, articles).collect()
    assert [r.event_id for r in found] == ["e1"] and [s.source_id for s in found[0].sources] == ["s0", "s1", "s2", "s3"]
    one = briefing.stories(df, articles)
    assert "&lt;H&gt;" in briefing.message(one, "H\n").first().message and "&lt;H&gt;" in briefing.page_rows(one).first().html
    assert len(briefing.assemble(one, F.lit("2026-01-02"), F.lit(1)).first().stories) == 1


def test_enriched_articles_have_one_identity_for_all_variants(spark):
    df = spark.createDataFrame([("http://www.x.example/a/?utm_source=q", "T", "s"), ("https://x.example/a", "t!", "S")], "url string, title string, summary string")
    assert briefing.enrich(df).select("id", "content_hash").distinct().count() == 1


def test_streams(spark, tmp_path):
    rows = [("a", T0), ("a", T0), ("b", T0)]
    path = str(tmp_path / "in")
    spark.createDataFrame(rows, "id string, fetched_at timestamp").write.parquet(path)
    source = spark.readStream.schema("id string, fetched_at timestamp").parquet(path)
    for _ in range(2):
        streams.snapshot_sink(streams.dedup_stream(source), str(tmp_path / "out"), str(tmp_path / "cp")).start().awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]
    ev = spark.createDataFrame([(1, T0, "x", 1.0), (1, datetime(2026, 1, 2, 0, 20, tzinfo=UTC), "x", 3.0), (1, datetime(2026, 1, 2, 2, tzinfo=UTC), "y", 1.0)], "user_id bigint, ts timestamp, event_type string, value double")
    assert streams.tumbling_counts(ev).where("n = 2").first().mean_value == 2.0
    assert streams.sessions(ev).count() == 2 and streams.sliding_counts(ev).count() > 2


def test_states_of_one_write_briefings_and_datasets(spark, tmp_path):
    root = str(tmp_path)
    states = spark.createDataFrame([("e", "first", 1), ("e", "last", 2), ("f", "only", 0)], "id string, canonical_title string, seq int").repartition(3)
    store.write_events(root, DAY, states)
    assert sorted(r.canonical_title for r in store.latest_events(spark, root, [DAY]).collect()) == ["last", "only"]
    assert store.event_days(spark, root) == [DAY] and store.event_days(spark, root + "/none") == []
    for day, headline in ((DAY, "h1"), (date(2026, 1, 9), "h2")):
        one = spark.createDataFrame([({"articles": 3.0}, [(1, "e", headline)])], "stats map<string,double>, stories array<struct<rank:int,event_id:string,headline:string>>")
        assert store.write_briefing(root, day, one)
    assert [r.stories[0].headline for r in store.read_briefings(spark, root).collect()] == ["h2", "h1"]
    assert [r.stories[0].headline for r in store.read_briefings(spark, root, DAY).collect()] == ["h1"]
    path = tmp_path / "labels.json"
    assert store.load_labels(spark, str(path)).count() == 0
    path.write_text('{"labels": [{"event_id": "e",\n "importance": "noise"}]}')
    assert [(r.event_id, r.importance, r.notes) for r in store.load_labels(spark, str(path)).collect()] == [("e", "noise", None)]


def test_feeds_keep_to_the_registry(spark):
    registry = feeds.load_registry(spark, '{"sources": [{"id": "a", "tier": "primary", "feed_url": "http://a/", "max_items_per_run": 1}, {"id": "b", "tier": "research", "feed_url": "http://b/", "enabled": false}]}')
    files = spark.createDataFrame([("a", RSS), ("b", RSS)], "source_id string, content binary")
    assert [r.source_id for r in feeds.parse_feeds(files, registry=registry).collect()] == ["a"]
    assert [r.id for r in feeds.by_tier(registry, "research").collect()] == ["b"] and [r.id for r in feeds.enabled_sources(registry).collect()] == ["a"]
