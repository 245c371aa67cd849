"""Streams: state that is freed, late rows beside the rest, a queue with confirmed offsets, and days of events."""

from __future__ import annotations

import json
import time
from datetime import datetime, timedelta

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewire.operators import cluster
from tidewire.sources import messages
from tidewire.streaming import catalogue as streamed
from tidewire.streaming import outputs, replay, state
from tidewire.streaming.events import snapshot_sink

DAY = datetime(2024, 1, 1)


def land(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def state_rows(spark, checkpoint, name, kind="stateVarName"):
    return spark.read.format("statestore").option(kind, name).load(checkpoint).count()


def test_ended_events_and_limits_free_their_state(spark, tmp_path):
    rows = [(1, "a", DAY), (2, "a", DAY + timedelta(days=3)), (3, "b", DAY), (4, "a", DAY + timedelta(days=20)), (5, None, DAY), (6, "c", None), (7, "d", DAY + timedelta(days=19))]
    table = spark.createDataFrame(rows, "id long, key string, at timestamp")
    landing, checkpoint, out = (str(tmp_path / n) for n in ("in", "check", "out"))
    with replay.keyed_state(spark):
        for some in (table.where("id <= 3"), table.where("id > 3")):
            land(some, landing)
            made = state.ended_events(spark.readStream.schema(table.schema).parquet(landing), "key", "id", "at")
            replay.run_once(made.writeStream.format("parquet").option("path", out), checkpoint)
        micros = lambda d: (DAY + timedelta(days=d) - datetime(1970, 1, 1)) // timedelta(microseconds=1)
        ended = sorted(map(tuple, spark.read.parquet(out).collect()))
        assert ended == [("a", micros(0), micros(3), 2), ("b", micros(0), micros(0), 1)]
        # Day 15 is past for a's first run and for b; a's second run and d are open.
        assert state_rows(spark, checkpoint, "event") == 2


def test_the_sql_of_ended_events_keeps_equal_times_together():
    con = duckdb.connect()
    con.execute("SET threads = 8")
    con.execute("CREATE TABLE clicks AS SELECT i AS click_id, i % 7 AS client_id, TIMESTAMP '2024-01-01' + to_days(CAST(20 * (hash(i) % 20) AS INT)) AS ts FROM range(300000) r(i)")
    runs = con.execute(f"SELECT count(*), count(DISTINCT (client_id, first_us)), sum(n) FROM ({streamed._ENDED}) WHERE first_us = last_us").fetchone()
    assert runs == con.execute("SELECT 7 * 19, 7 * 19, count(*) FROM clicks WHERE ts < (SELECT max(ts) FROM clicks)").fetchone()


def test_a_limit_equals_the_walk(spark, tmp_path):
    times = [0, 4, 10, 10, 19, 20, 25, 31]
    rows = [(i, "u", DAY + timedelta(seconds=s)) for i, s in enumerate(times)] + [(100, "v", DAY)]
    table = spark.createDataFrame(rows, "id long, key string, at timestamp")
    out = replay.replayed(table, F.minute("at"), lambda s: state.rate_limited(s, "key", "id", "at", 10), "limit", ("key",))
    assert {r.id for r in out.where("accepted").collect()} == {0, 2, 5, 7, 100} and out.count() == 9


def test_a_limit_of_a_batch_in_any_order(spark):
    # One file, latest first, equal times: the verdicts stay with their rows.
    seconds = [31, 25, 20, 20, 19, 10, 10, 4, 0, 0]
    table = spark.createDataFrame([(i, "u", DAY + timedelta(seconds=s)) for i, s in enumerate(seconds)], "id long, key string, at timestamp").coalesce(1)
    out = replay.replayed(table, F.lit(0), lambda s: state.rate_limited(s, "key", "id", "at", 10), "limit")
    assert {r.id for r in out.where("accepted").collect()} == {8, 5, 2, 0} and out.count() == 10


def test_late_rows_have_a_table_and_survive_a_repeated_batch(spark, tmp_path):
    minute = lambda m: DAY + timedelta(minutes=m)
    table = spark.createDataFrame(
        [(1, minute(0), minute(0), 0), (2, minute(900), minute(5), 0), (3, minute(1), minute(20), 1), (4, None, minute(20), 1), (5, minute(-30), minute(21), 1), (6, minute(30), minute(31), 2), (7, minute(-6), minute(31), 2)],
        "id long, at timestamp, arrived timestamp, part int",
    )
    path = str(tmp_path / "split")
    replay.replay(table, F.col("part"), lambda s: outputs.late_split(s, "at", path, "10 minutes", "arrived"), "late")
    got = lambda name: sorted(r.id for r in outputs.batches_of(spark, f"{path}/{name}", table.schema).collect())
    assert (got("on_time"), got("late")) == ([1, 2, 3, 6], [4, 5, 7])
    # A run that stopped after writing and before its commit does its batch again: same bound, same files.
    outputs.split_batch(table.where("part = 2"), 2, "at", path, "10 minutes", "arrived")
    assert (got("on_time"), got("late")) == ([1, 2, 3, 6], [4, 5, 7])


def write_messages(folder, name, rows):
    (folder / name).write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows))


def test_unconfirmed_messages_come_again_exactly_once(spark, tmp_path):
    queue = tmp_path / "queue"
    queue.mkdir()
    one = lambda i: {"update_id": i, "chat_id": i % 2, "sent_at": "2024-01-01T00:00:00+01:00", "text": f"t{i}"}
    write_messages(queue, "0001.json", [one(1), "{broken", {"update_id": "x"}, one(2)])
    spark.dataSource.register(messages.MessageSource)
    stream = lambda: spark.readStream.format("messages").load(str(queue))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "check")
    snapshot_sink(stream(), out, checkpoint).start().awaitTermination()
    write_messages(queue, "0002.json", [one(3), {"update_id": 4, "sent_at": 5, "text": 7}])

    def fail(batch, batch_id):
        assert batch.count() == 2
        raise RuntimeError("stopped between read and commit")

    query = stream().writeStream.foreachBatch(fail).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="stopped between"):
        query.awaitTermination()
    assert messages.confirmed(str(queue)) < "0002.json"
    write_messages(queue, "0003.json", [one(5)])
    for _ in range(2):
        snapshot_sink(stream(), out, checkpoint).start().awaitTermination()
    got = sorted((r.update_id, r.chat_id, str(r.sent_at), r.text) for r in spark.read.parquet(out).collect())
    assert got == [(1, 1, "2023-12-31 23:00:00", "t1"), (2, 0, "2023-12-31 23:00:00", "t2"), (3, 1, "2023-12-31 23:00:00", "t3"), (4, None, "None", None), (5, 1, "2023-12-31 23:00:00", "t5")]


def test_titles_are_remembered_for_seven_days(spark):
    titles = ["alpha beta gamma delta", "alpha beta gamma delta", "other words entirely here", "alpha beta gamma delta", "alpha beta gamma deltas", "", "zz"]
    days = [0, 1, 2, 7, 8, 8, 9]
    table = spark.createDataFrame([(i, t, DAY + timedelta(days=d)) for i, (t, d) in enumerate(zip(titles, days, strict=True))], "id long, title string, at timestamp")
    found = replay.replayed(table, F.floor(F.col("id") / 2), lambda s: state.title_candidates(s, "id", "title", "at", shares=4), "titles")
    assert sorted((r.a, r.b) for r in state.alike_pairs(found, table, "id", "title").collect()) == [(0, 1), (0, 3), (1, 3), (1, 4), (3, 4)]


ARTICLES = "ord long, id string, title string, summary string, source_id string, published_at timestamp, fetched_at timestamp"


def test_days_of_a_stream_give_the_events_of_the_batch_fold(spark, tmp_path):
    names = ["GPT-5 launched today", "GPT-5 is out", "CUDA kernels faster", "GPT-5 again in the news", "CUDA kernels faster now", "Gemini 2.0 demo"]
    days = [0, 0, 0, 3, 20, 20]
    rows = [(i, f"a{i}", t, None, f"s{i}", DAY + timedelta(days=d), DAY + timedelta(days=d)) for i, (t, d) in enumerate(zip(names, days, strict=True))]
    table = spark.createDataFrame(rows, ARTICLES)
    path = str(tmp_path / "events")
    replay.replay(table, F.to_date("published_at"), lambda s: outputs.day_events(s, path), "days")
    held, touched = spark.createDataFrame([], cluster.EVENT_SCHEMA), []
    for day in sorted(set(days)):
        some = table.where(F.to_date("published_at") == F.lit((DAY + timedelta(days=day)).date()))
        open_ = [r for r in held.collect() if r.last_updated >= DAY + timedelta(days=day - 14)]
        new = cluster.cluster_articles(some, spark.createDataFrame(open_, cluster.EVENT_SCHEMA)).collect()
        touched += new
        held = spark.createDataFrame([r for r in open_ if r.id not in {e.id for e in new}] + new, cluster.EVENT_SCHEMA)
    flat = lambda rows: sorted((r.id, r.canonical_title, sorted(r.article_ids), r.last_updated) for r in rows)
    assert flat(outputs.batches_of(spark, f"{path}/events", held.schema).collect()) == flat(touched)
    last = spark.read.schema(cluster.EVENT_SCHEMA).parquet(f"{path}/open/batch=2").collect()
    assert flat(last) == flat(held.collect()) and all(r.last_updated >= DAY + timedelta(days=6) for r in last)


def test_titles_are_held_against_those_of_their_days_only():
    """A batch of many times the kept days, of titles that all share their trigrams: pairs in time are all that is looked at."""
    days, sketches = 4000, np.arange(4000) % 5
    rows = pd.DataFrame({"h": 7, "id": np.arange(days), "n": 20, "place": 1, "at_us": np.arange(days) * 86_400_000_000})
    rows = rows.assign(s0=sketches * 0b1111111, s1=0, s2=0, s3=0).sample(frac=1, random_state=1)
    held = []

    class Titles:
        exists, update = staticmethod(lambda: False), staticmethod(held.append)

    class Times:
        getCurrentWatermarkInMs = staticmethod(lambda: 0)

    class Handle:
        getValueState, registerTimer = staticmethod(lambda *a: Titles()), staticmethod(lambda at: None)

    index = state._Index(0.9, 7 * 86_400_000_000)
    index.init(Handle())
    start = time.monotonic()
    (out,) = index.handleInputRows((0,), iter([rows]), Times())
    took = time.monotonic() - start
    differ = lambda a, b: bin(int(sketches[a] * 127) ^ int(sketches[b] * 127)).count("1")
    want = [(a, b) for b in range(days) for a in range(max(0, b - 7), b) if differ(a, b) <= 4]
    assert sorted(map(tuple, out.values.tolist())) == sorted(want)
    assert len(held[0][0]) == days * 9 * 8 and took < 1.0
