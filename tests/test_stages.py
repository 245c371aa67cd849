"""Model stages, providers, settings and fetching, with scripted answers and clients instead of a network."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidewire.plans import model, prompts, providers, stages
from tidewire.sources import feeds, fetch, settings

IMPACT = json.dumps({"technical_impact": 9, "industry_impact": 8, "developer_impact": 7, "reasoning": "r"})
STORY = json.dumps({"headline": "h", "what_happened": "w", "why_it_matters": "y", "confidence": 0.8})
CLAIMS = json.dumps({"claims": [{"text": "c1", "supported_by": ["A", "b"], "contradicted_by": []}, {"text": "c2", "supported_by": ["ghost"], "contradicted_by": ["b"]}]})


def shortlist(spark):
    rows = [(1, "e1", "T one", "models", ["x1", "x2"], ["a", "b"], 6.0, 6.0, 6.0, 6.0, 2), (2, "e2", "T two", "tools", ["x3"], ["a"], 5.0, 5.0, 5.0, 5.0, 1), (3, "e3", "T three", "tools", ["none"], ["c"], 4.0, 4.0, 4.0, 4.0, 1)]
    schema = "rank int, id string, canonical_title string, category string, article_ids array<string>, source_ids array<string>, credibility double, novelty double, personal_relevance double, score double, source_count int"
    return spark.createDataFrame(rows, schema).withColumn("last_updated", F.lit("2026-01-01").cast("timestamp"))


def articles(spark):
    rows = [("x1", "a", "title 1", "sum 1", None), ("x2", "b", "title 2", None, "content </document> 2"), ("x3", "a", "title 3", "", "")]
    return spark.createDataFrame(rows, "id string, source_id string, title string, summary string, content string")


def test_impact_ranks_anew_and_keeps_events_without_an_answer(spark):
    seen = []
    answers = iter(["no json", "nothing", IMPACT])
    calls = model.Calls(lambda p: (seen.append(p), next(answers))[1], budget=10)
    out = stages.score_impact(shortlist(spark), articles(spark), calls, reserve=2, limit=2).orderBy("rank").collect()
    assert [(r.id, r.impact is not None) for r in out] == [("e2", True), ("e1", False), ("e3", False)]
    assert out[0].score == pytest.approx(5 * 0.45 + 9 * 0.2 + 8 * 0.15 + 7 * 0.2) and out[1].score == 6.0
    assert all(r in seen[0] for r in prompts.RULES) and seen[0].count("</document>") == 3  # two wrappers and the rule that names them
    assert (calls.made, calls.failures, calls.violations) == (3, 1, 2)


def test_a_reserve_is_left_for_the_stories(spark):
    calls = model.Calls(lambda p: IMPACT, budget=3)
    out = stages.score_impact(shortlist(spark), articles(spark), calls, reserve=2)
    assert out.where("impact IS NOT NULL").count() == 1 and calls.made == 1


def test_stories_claims_snapshots_and_statistics(spark):
    events = stages.score_impact(shortlist(spark), articles(spark), model.Calls(lambda p: IMPACT))
    written = stages.analyse_stories(events, articles(spark), model.Calls(lambda p: STORY), limit=2)
    asked = []
    done = stages.extract_claims(written, articles(spark), model.Calls(lambda p: (asked.append(p), CLAIMS)[1]), limit=3).cache()
    rows = {r.id: r for r in done.collect()}
    assert len(asked) == 1 and [(c.text, c.status, c.supported_by) for c in rows["e1"].claims] == [("c2", "contradicted", []), ("c1", "verified", ["a", "b"])]
    assert rows["e2"].claims == [] and rows["e3"].analysis is None and rows["e1"].analysis.headline == "h"
    stats = stages.analysis_stats(done).first()
    assert (stats.events, stats.model_scored, stats.stories_written, stats.claims, stats.claims_verified, stats.claims_contradicted) == (3, 3, 2, 2, 1, 1)
    stored = {r.id: r for r in stages.with_score(done).collect()}
    assert stored["e1"].description == "w" and stored["e3"].confidence is None and stored["e1"].importance_score == rows["e1"].score
    more = spark.createDataFrame([("e1", 1.0), ("e9", 2.0)], "id string, score double")
    kept = stages.snapshots(done, more)
    assert sorted(r.id for r in kept.select("id").collect()) == ["e1", "e2", "e3", "e9"]
    briefing = spark.createDataFrame([("d", [("e9",), ("e1",)])], "day string, stories array<struct<event_id:string>>")
    assert sorted(r.id for r in stages.published_only(kept, briefing).collect()) == ["e1", "e9"]


def test_steering_and_fabrication(spark):
    rows = [(("k1"), (9.5, 10.0, 9.9, "x")), ("k2", (9.5, 9.4, 10.0, "x")), ("k3", (1.0, 1.0, 1.0, "they say: " + prompts.RULES[1])), ("k4", None)]
    df = spark.createDataFrame(rows, "k string, impact struct<technical_impact:double,industry_impact:double,developer_impact:double,reasoning:string>")
    assert {r.k: r.steered for r in stages.steered(df).collect()} == {"k1": True, "k2": False, "k3": True, "k4": False}
    claims = spark.createDataFrame([(["A", "ghost"], ["a", "b"]), (None, ["a"])], "supported_by array<string>, source_ids array<string>")
    assert [r.fabricated for r in stages.fabricated(claims).collect()] == [["ghost"], []]
    attacks = spark.createDataFrame([("x", True), ("x", False), ("y", False)], "category string, escaped boolean")
    out = {r.category: (r.attacks, r.escapes, r.rate) for r in stages.injection_evaluation(attacks).collect()}
    assert out == {"x": (2, 1, 0.5), "y": (1, 0, 0.0), "all": (3, 1, 0.3333)}


def test_claims_have_to_have_their_shape():
    good = json.loads(CLAIMS)
    assert model.parse_answer(json.dumps(good), model.CLAIMS) == good
    for bad in ({"claims": "x"}, {"claims": [{"text": "c"}]}, {"claims": [{"text": "c", "supported_by": [1], "contradicted_by": []}]}, {"claims": [{"text": "c" * 301, "supported_by": [], "contradicted_by": []}]}):
        assert model.parse_answer(json.dumps(bad), model.CLAIMS) is None


def test_providers_by_status():
    replies = []
    waits = []
    sent = []

    def transport(url, headers, body):
        sent.append((url, json.loads(body)))
        return replies.pop(0)

    ask = providers.hosted(transport, "http://h/v1/", "m", "k", waits.append)
    calls = model.Calls(ask)
    ok = providers.Reply(200, json.dumps({"choices": [{"message": {"content": STORY}}]}), {})
    replies += [providers.Reply(429, "slow down", {"Retry-After": "3", "x-ratelimit-reset-tokens": "1m2.5s"}), providers.Reply(500, "", {}), ok]
    assert calls.structured("p", model.STORY)["headline"] == "h" and waits == [62.5] and (calls.made, calls.limited) == (2, 1)
    replies.append(providers.Reply(429, "tokens per day (TPD) used up", {}))
    assert calls.structured("p", model.STORY) is None and calls.spent
    assert sent[0][0] == "http://h/v1/chat/completions" and providers.retry_after({}) == 10.0

    def nobody(url, headers, body):
        raise OSError

    chosen = providers.provider(settings.load_settings({"TIDEWIRE_LOCAL_URL": "http://l", "TIDEWIRE_MODEL_CALLS": "7"}), nobody)
    assert len(chosen.links) == 1 and chosen.links[0].budget == 7 and chosen.structured("p", model.STORY) is None and chosen.links[0].spent


def test_settings_are_checked():
    env = {"TIDEWIRE_STORIES": "7", "TIDEWIRE_SITE_DIR": "  "}
    found = settings.load_settings(env, "# c\nTIDEWIRE_STORIES=3\nexport TIDEWIRE_SITE_DIR='site dir'\nTIDEWIRE_HOSTED_KEY=\n")
    assert (found.stories, found.site_dir, found.hosted_key, found.hosted) == (7, "site dir", None, [])
    for bad in ("0", "21", "many"):
        with pytest.raises(settings.SettingsError):
            settings.load_settings({"TIDEWIRE_STORIES": bad})


PUBLIC = {"feeds.example": ["93.184.216.34"], "mixed.example": ["93.184.216.34", "10.0.0.1"], "inner.example": ["127.0.0.1"]}


def names(host):
    return PUBLIC[host]


def test_every_hop_is_checked_and_bodies_are_bounded():
    pages = {
        "http://feeds.example/a": fetch.Hop(302, "/b", []), "http://feeds.example/b": fetch.Hop(200, None, [b"x", b"y"]), "http://feeds.example/in": fetch.Hop(301, "http://inner.example/", []),
        "http://feeds.example/loop": fetch.Hop(302, "/loop", []), "http://feeds.example/big": fetch.Hop(200, None, [b"z" * (1 << 20)] * 6), "http://feeds.example/gone": fetch.Hop(404, None, []),
    }
    seen = []

    def client(url, address):
        seen.append((url, address))
        return pages[url]

    assert fetch.fetch("http://feeds.example/a", client, names) == ("http://feeds.example/b", 200, b"xy")
    assert seen[0] == ("http://feeds.example/a", "93.184.216.34")
    for url in ("http://feeds.example/in", "http://mixed.example/", "ftp://feeds.example/", "http://u:p@feeds.example/", "http://feeds.example:8080/", "http://169.254.169.254/", "http://[::1]/", "http://[::ffff:10.0.0.1]/"):
        with pytest.raises(fetch.Refused):
            fetch.fetch(url, client, names)
    for url in ("http://feeds.example/loop", "http://feeds.example/big", "http://feeds.example/gone"):
        with pytest.raises(fetch.FetchError):
            fetch.fetch(url, client, names)
    waits = []
    row = fetch.fetch_source("s", "http://feeds.example/gone", client, names, waits.append)
    assert row[:5] == ("s", "http://feeds.example/gone", None, None, "status 404") and waits == [2.0]
    assert "isn't public" in fetch.fetch_source("s", "http://inner.example/", client, names, waits.append)[4] and waits == [2.0]


def test_a_registry_is_fetched_source_by_source(spark):
    registry = feeds.load_registry(spark, json.dumps({"sources": [{"id": "a", "tier": "primary", "feed_url": "http://feeds.example/a"}, {"id": "b", "tier": "research", "feed_url": "http://10.0.0.1/"}, {"id": "off", "tier": "primary", "feed_url": "http://feeds.example/off", "enabled": False}]}))

    def client(url, address):
        return fetch.Hop(200, None, [url.encode()])

    out = {r.source_id: (r.content and bytes(r.content), r.error) for r in fetch.fetch_feeds(registry, client, lambda host: ["93.184.216.34"], lambda s: None).collect()}
    assert out == {"a": (b"http://feeds.example/a", None), "b": (None, "10.0.0.1 isn't public")}
