"""A run that is stopped after any stage and started again leaves the store of an undisturbed one."""

from __future__ import annotations

import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewire.operators import timeline
from tidewire.plans import daily
from tidewire.sources import store

NOW = datetime(2026, 1, 10, 8)


def entries(spark, day, titles):
    at = NOW + timedelta(days=day)
    rows = [(k, f"https://e.com/{day}/{t.replace(' ', '-')}", t, f"about {t}", f"s{k % 3}", at - timedelta(hours=k), at) for k, t in enumerate(titles)]
    return spark.createDataFrame(rows, "ord long, url string, title string, summary string, source_id string, published_at timestamp, fetched_at timestamp")


FIRST = ["GPT-5 launched today", "GPT-5 is out", "CUDA kernels faster", "old story"]
SECOND = ["GPT-5 again in the news", "CUDA kernels faster", "Gemini 2.0 demo"]


def contents(spark, root):
    articles = sorted((r.id, str(r.day)) for r in store.read_articles(spark, root).collect())
    events = sorted((r.id, str(r.day), sorted(r.article_ids)) for r in store.read_events(spark, root).collect())
    return articles, events, store.read_state(spark, root)


def both(spark, root, first, stop=None):
    def after(stage):
        if stage == stop:
            raise KeyboardInterrupt

    shutil.copytree(first, root)
    if stop:
        with pytest.raises(KeyboardInterrupt):
            daily.daily_run(spark, root, entries(spark, 1, SECOND), NOW + timedelta(days=1), after=after)
    return daily.daily_run(spark, root, entries(spark, 1, SECOND), NOW + timedelta(days=1))


def test_a_stopped_run_goes_on(spark, tmp_path):
    daily.daily_run(spark, str(tmp_path / "first"), entries(spark, 0, FIRST), NOW)
    best = both(spark, str(tmp_path / "whole"), tmp_path / "first")
    want = contents(spark, str(tmp_path / "whole"))
    assert len(want[0]) == 6 and want[2]["successful_runs"] == 2 and best.count() >= 2
    assert max(len(r.article_ids) for r in best.collect()) >= 2
    for stop in ("articles", "written"):
        both(spark, str(tmp_path / stop), tmp_path / "first", stop)
        assert contents(spark, str(tmp_path / stop)) == want, stop


def test_candidates_and_seen_entities(spark):
    rows = [("a", ["x", "y"], NOW), ("b", ["y", "z"], NOW - timedelta(hours=30)), ("c", ["w"], NOW - timedelta(hours=3))]
    events = spark.createDataFrame(rows, "id string, entities array<string>, last_updated timestamp")
    touched = events.where("id = 'a'")
    assert {r.entity for r in timeline.seen_entities(events, touched).collect()} == {"y", "z", "w"}
    assert {r.id for r in timeline.candidates(events, touched, F.lit(NOW)).collect()} == {"a", "c"}


def test_a_table_is_replaced_when_it_is_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    store.replace(spark.range(3), path)
    store.replace(spark.read.json(path).where("id > 0"), path)
    assert sorted(r.id for r in spark.read.json(path).collect()) == [1, 2] and not (tmp_path / "t.old").exists()
