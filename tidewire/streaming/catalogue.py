"""The streaming operators' queries, each a replay of a whole table in slices, with SQL for what the stream has to give."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lineage import stored
from ..sources.messages import MessageSource
from . import outputs, replay, state

_LIMITED = """
WITH RECURSIVE e AS (SELECT event_id, user_id, ts FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL AND event_id IS NOT NULL),
a(user_id, ts) AS (
  SELECT user_id, min(ts) FROM e GROUP BY user_id
  UNION ALL SELECT a.user_id, min(e.ts) FROM a JOIN e ON e.user_id = a.user_id AND e.ts >= a.ts + INTERVAL 6 HOUR GROUP BY a.user_id, a.ts),
k AS (SELECT a.user_id, a.ts, min(event_id) AS event_id FROM a JOIN e ON e.user_id = a.user_id AND e.ts = a.ts GROUP BY a.user_id, a.ts)
SELECT e.event_id, e.user_id, k.event_id IS NOT NULL AS accepted FROM e LEFT JOIN k ON k.event_id = e.event_id AND k.user_id = e.user_id
"""


def stream_rate_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages, week by week: at most one of a user is accepted in any six hours."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "ts")
    out = replay.replayed(events, F.date_trunc("week", "ts"), lambda s: state.rate_limited(s, "user_id", "event_id", "ts", 6 * 3600), "limit", ("user_id",))
    return out.select(F.col("id").alias("event_id"), F.col("key").alias("user_id"), "accepted")


def message_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages from a queue of files, read by the source with confirmed offsets."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").where("ts IS NOT NULL AND user_id IS NOT NULL AND event_id IS NOT NULL")
    queue, out = replay.folder(spark, "queue"), replay.folder(spark, "replies")
    messages = events.select(F.col("event_id").alias("update_id"), F.col("user_id").alias("chat_id"), F.date_format(F.col("ts").cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("sent_at"), F.col("event_type").alias("text"))
    messages.repartitionByRange(8, "sent_at").write.json(queue)
    spark.dataSource.register(MessageSource)
    stream = spark.readStream.format("messages").load(queue)
    limited = state.rate_limited(stream, "chat_id", "update_id", "sent_at", 6 * 3600)
    with replay.keyed_state(spark):
        replay.run_once(limited.writeStream.format("parquet").option("path", out), replay.folder(spark, "replies-checkpoint"))
    return spark.read.schema(limited.schema).parquet(out).select(F.col("id").alias("event_id"), F.col("key").alias("user_id"), "accepted")


_ENDED = """
WITH c AS (SELECT client_id, ts FROM clicks WHERE ts IS NOT NULL AND client_id IS NOT NULL AND click_id IS NOT NULL),
g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 14 DAY THEN 0 ELSE 1 END AS opens FROM c WINDOW w AS (PARTITION BY client_id ORDER BY ts)),
r AS (SELECT *, sum(opens) OVER (PARTITION BY client_id ORDER BY ts) AS run FROM g),
e AS (SELECT client_id, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n, lead(run) OVER (PARTITION BY client_id ORDER BY run) IS NOT NULL AS followed FROM r GROUP BY client_id, run)
SELECT client_id, epoch_us(first_ts) AS first_us, epoch_us(last_ts) AS last_us, n FROM e WHERE followed OR last_ts + INTERVAL 14 DAY < (SELECT max(ts) FROM c)
"""


def stream_ended_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clients' runs of clicks, month by month, that ended: 14 days without one."""
    clicks = spark.read.parquet(f"{sf_dir}/clicks.parquet").select("click_id", "client_id", "ts")
    out = replay.replayed(clicks, F.date_trunc("month", "ts"), lambda s: state.ended_events(s, "client_id", "click_id", "ts"), "ended", ("client_id",))
    return out.select(F.col("key").alias("client_id"), "first_us", "last_us", "n")


_LATE = """
WITH c AS (SELECT click_id, ts, arrived_at, date_trunc('month', arrived_at) AS slice FROM clicks),
m AS (SELECT slice, max(least(ts, arrived_at)) FILTER (ts IS NOT NULL) AS most FROM c GROUP BY slice),
b AS (SELECT slice, max(most) OVER (ORDER BY slice NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 HOUR AS bound FROM m)
SELECT click_id, ts IS NULL OR coalesce(ts < bound, FALSE) AS late FROM c JOIN b ON b.slice IS NOT DISTINCT FROM c.slice
"""


def stream_late_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks in months of arrival: those over an hour behind all that came before go to a table of late rows."""
    clicks = spark.read.parquet(f"{sf_dir}/clicks.parquet").select("click_id", "ts", "arrived_at")
    path = replay.folder(spark, "late-split")
    replay.replay(clicks, F.date_trunc("month", "arrived_at"), lambda s: outputs.late_split(s, "ts", path, "1 hour", "arrived_at"), "late")
    both = [outputs.batches_of(spark, f"{path}/{name}", clicks.schema).withColumn("late", F.lit(name == "late")) for name in ("on_time", "late")]
    return both[0].unionByName(both[1]).select("click_id", "late")


def _grams(x: str) -> str:
    return f"CASE WHEN {x} = '' THEN [] ELSE list_distinct([substring('  ' || {x} || ' ', i, 3) FOR i IN range(1, length({x}) + 2)]) END"


def _title_sql(norm: str) -> str:
    return (
        f"WITH t AS (SELECT doc_id, {norm} AS norm FROM documents), g AS (SELECT doc_id, {_grams('norm')} AS grams FROM t), "
        "p AS (SELECT a.doc_id AS a, b.doc_id AS b, len(list_intersect(a.grams, b.grams)) AS c, len(a.grams) + len(b.grams) AS n FROM g a JOIN g b ON a.doc_id < b.doc_id AND b.doc_id - a.doc_id <= 336 "
        "WHERE len(a.grams) > 0 AND 2.0 * least(len(a.grams), len(b.grams)) >= 0.9 * (len(a.grams) + len(b.grams))) "
        "SELECT a, b, round(2.0 * c / n, 9) AS similarity FROM p WHERE 2.0 * c / n >= 0.9"
    )


def stream_title_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a stream, one each half hour: near-equal titles within seven days of each other."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id IS NOT NULL AND text IS NOT NULL")
    titles = stored(docs.select("doc_id", F.left("text", F.lit(80)).alias("title"), F.timestamp_seconds(1_704_067_200 + 1800 * F.col("doc_id")).alias("at")), "titles")
    most = titles.agg(F.max("doc_id")).first()[0] or 0
    found = replay.replayed(titles, F.floor(F.col("doc_id") * 4 / (most + 1)), lambda s: state.title_candidates(s, "doc_id", "title", "at"), "titles")
    return state.alike_pairs(found, titles, "doc_id", "title").withColumn("similarity", F.round("similarity", 9))


def queries(norm: str) -> list[tuple]:
    """(query, SQL) of this module; ``norm`` is the SQL of a title's comparison form."""
    return [(stream_rate_limit, _LIMITED), (message_replies, _LIMITED), (stream_ended_events, _ENDED), (stream_late_split, _LATE), (stream_title_pairs, _title_sql(norm))]


