"""Pages from the store, and rebuilds that touch what changed and nothing else."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tidewire.plans import site
from tidewire.sources import store

T = datetime(2026, 1, 1)


def briefing(spark, day, headlines):
    stories = [(k + 1, f"e{k}", h, "what", None, 0.5, "x", 1.0, T, T, [("s1", "t", "https://e.com/?a=1&b=2")], []) for k, h in enumerate(headlines)]
    return spark.createDataFrame([({"articles": 3.0}, stories)], store.BRIEFING)


def events(spark, rows):
    data = [(i, t, "x", ["a"], [f"{i}{k}" for k in range(n)], ["s"], T, T, float(n), None, None) for i, t, n in rows]
    return spark.createDataFrame(data, store.EVENT)


def files(root):
    return {str(f.relative_to(root)): f.stat().st_mtime_ns for f in (root / "site").rglob("*.parquet")}


def test_one_changed_day_rewrites_its_pages_only(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    days = [date(2026, 1, d) for d in (1, 2, 3)]
    for day, heads, rows in zip(days, (["One <b>"], ["Two", "Too"], []), ([("e1", "T1", 1), ("e2", "T2", 1)], [("e1", "T1", 2)], [("e3", "T3 & co", 1)]), strict=True):
        store.write_briefing(root, day, briefing(spark, day, heads))
        store.write_events(root, day, events(spark, rows))
    site.rebuild(spark, root)
    pages = {r.path: r.html for r in site.read_site(spark, root).collect()}
    assert len(pages) == 3 + 3 + 3
    assert "One &lt;b&gt;" in pages["day/2026-01-01.html"] and "a=1&amp;b=2" in pages["day/2026-01-02.html"] and "No stories" in pages["day/2026-01-03.html"]
    assert pages["archive.html"].index("2026-01-03") < pages["archive.html"].index("2026-01-01") and "2026-01: 3 days, 3 stories" in pages["stats.html"]
    assert "T1 (2 days)" in pages["developing.html"] and "T3" not in pages["developing.html"]
    before = files(tmp_path)
    store.write_briefing(root, days[1], briefing(spark, days[1], ["Two again"]))
    site.rebuild(spark, root, [days[1]])
    after = files(tmp_path)
    stayed = {f for f in before if after.get(f) == before[f]}
    moved = {f.rsplit("/", 1)[0] for f in before.keys() - stayed}
    own = {r.shard for r in events(spark, [("e1", "", 1)]).select(site.event_part(F.col("id")).alias("shard")).collect()}
    assert moved == {"site/kind=day/part=2026-01-02", "site/kind=archive/part=all", "site/kind=stats/part=all", "site/kind=developing/part=all"} | {f"site/kind=event/part={s}" for s in own}
    fresh = {r.path: r.html for r in site.read_site(spark, root).collect()}
    assert "Two again" in fresh["day/2026-01-02.html"] and fresh["day/2026-01-01.html"] == pages["day/2026-01-01.html"]
    site.rebuild(spark, root)
    assert {r.path: r.html for r in site.read_site(spark, root).collect()} == fresh
