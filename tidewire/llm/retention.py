"""Cohort retention by a secondary sort: clicks dealt by client, sorted by time and read as a stream.

A client's clicks come in order of time, so their periods since the client's start never fall: the scan holds one client
and one period for each state, and a change of either is one more user of a cell.  No set of clients is kept anywhere.

Clients with more than a thousandth of all clicks (at most 1000) are spread: their clicks are dealt by the whole row, so
copies of one click meet after a map-side combine and no task has the client.  Each task's runs of such a client are
then joined by (client, state, period), a client and period being one user whatever the number of tasks.

Null ``ts`` or ``client_id``: no part.  Equal rows, over all columns, count once.  A null ``kind`` is no start; a null,
non-finite or too large ``value`` is 0 cents; a click whose ``known`` is null is unknown to state 0.  Of several rows of
a client in ``clients`` the latest ``updated_at`` counts, then the greatest segment; null or missing: ''.  Clients
without a start have no rows, and an empty table has none at all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

DAY_US = 86_400_000_000
#: A client is spread if it has more than a thousandth of the clicks, and more clicks than this.
SPREAD_ROWS = 500
#: Values beyond this have no exact cents.
_MOST_VALUE = 9e13

CELL = ["state", "segment", "cohort", "period"]
_SUMS = ["users", "users_crc32", "moved", "cents"]
_SCAN = "own long, state int, segment string, cohort long, period long, users long, users_crc32 long, moved long, cents long"


def delayed_days(click_id: Column) -> Column:
    """How many days after ``arrived_at`` a click arrives: crc32 of its decimal id modulo 100, if 3 divides the crc32."""
    h = F.crc32(click_id.cast("string").cast("binary"))
    return F.when(h % 3 == 0, h % 100).otherwise(0).cast("int")


def arrival(click_id: Column, arrived_at: Column) -> Column:
    return arrived_at.cast("timestamp_ntz") + F.make_dt_interval(delayed_days(click_id))


def _cents(value: Column) -> Column:
    sound = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < _MOST_VALUE)
    return F.when(sound, F.floor(100 * value + 0.5)).otherwise(0).cast("bigint")


def _micros(column: pa.ChunkedArray) -> np.ndarray:
    return pc.fill_null(column.cast(pa.int64()), 0).to_numpy(zero_copy_only=False)


def _runs(batches: Iterator[pa.RecordBatch], cohort_us: int, period_us: int) -> Iterator[pa.RecordBatch]:
    """Cells of one task's rows, which are sorted by client and time; ``own`` is the client where it is spread."""
    last: dict[int, tuple[int, int] | None] = {0: None, 1: None}
    for batch in batches:
        if not batch.num_rows:
            continue
        client, ts, cents = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("client_id", "at", "cents"))
        ts = ts.astype("datetime64[us]").astype(np.int64)
        known = batch.column("known").to_numpy(zero_copy_only=False).astype(bool)
        parts = []
        for state in (0, 1):
            column = batch.column(f"start_{state}")
            start = _micros(column)
            at = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False) & (ts >= start) & (known | (state == 1)))
            if not len(at):
                continue
            who, period = client[at], (ts[at] - start[at]) // period_us
            new = np.ones(len(at), dtype=bool)
            new[1:] = (who[1:] != who[:-1]) | (period[1:] != period[:-1])
            new[0] = last[state] != (who[0], period[0])
            last[state] = (who[-1], period[-1])
            rows = batch.take(pa.array(at))
            ones = new.astype(np.int64)
            moved = rows.column("moved").to_numpy(zero_copy_only=False).astype(np.int64)
            parts.append(pa.table({
                "own": rows.column("own"), "state": pa.array(np.full(len(at), state, np.int32)), "segment": rows.column("segment"), "cohort": start[at] // cohort_us, "period": period,
                "users": ones, "users_crc32": ones * rows.column("crc").to_numpy(zero_copy_only=False), "moved": ones * moved, "cents": cents[at],
            }))
        if parts:
            sums = pa.concat_tables(parts).group_by(["own", *CELL]).aggregate([(c, "sum") for c in _SUMS])
            yield from sums.select(["own", *CELL, *[f"{c}_sum" for c in _SUMS]]).rename_columns(["own", *CELL, *_SUMS]).to_batches()


def retention(clicks: DataFrame, clients: DataFrame, known: Column, start_kind: str = "signup", cohort_days: int = 1, period_days: int = 1) -> DataFrame:
    """(state, segment, cohort, period, users, users_crc32, moved, cents), a row for each cell with a user.

    State 0 has the clicks for which ``known``, a condition on ``clicks``, holds; state 1 has all.  In each state a
    client starts at its earliest ``ts`` of ``start_kind``; ``cohort`` numbers the days of starts since 1970 by
    ``cohort_days``, ``period`` the time since the start by ``period_days``, exact to the microsecond.
    """
    named = ("client_id", "ts", "kind", "value")
    rest = [c for c in clicks.columns if c not in named]
    whole = clicks.select(F.struct("*").alias("row"), F.coalesce(known, F.lit(False)).alias("known")).where("row.ts IS NOT NULL AND row.client_id IS NOT NULL")
    ts = F.col("row.ts").cast("timestamp_ntz")
    first = lambda told: F.min(F.when((F.col("row.kind") == start_kind) & told, ts))
    starts = whole.groupBy(F.col("row.client_id").alias("client_id")).agg(first(F.col("known")).alias("start_0"), first(F.lit(True)).alias("start_1"), F.count(F.lit(1)).alias("clicks"))
    latest = clients.where("client_id IS NOT NULL").groupBy("client_id").agg(F.max(F.struct("updated_at", "segment")).getField("segment").alias("segment"))
    day = lambda s: F.floor(F.datediff(F.col(s).cast("date"), F.lit("1970-01-01").cast("date")) / cohort_days)
    heads = starts.join(latest, "client_id", "left").select(
        "client_id", "clicks", "start_0", "start_1", F.coalesce("segment", F.lit("")).alias("segment"), F.crc32(F.col("client_id").cast("string").cast("binary")).alias("crc"),
        F.coalesce(day("start_0") != day("start_1"), F.lit(False)).alias("moved"),
    )
    heads = stored(heads, "retention-clients")
    total = heads.agg(F.sum("clicks")).first()[0] or 0
    hot = F.broadcast(heads.where(F.col("clicks") > max(SPREAD_ROWS, total // 1000)).select(F.col("client_id").alias("hot_id")))
    spread, kept = F.col("row.client_id") == F.col("hot_id"), F.col("start_1").isNotNull()

    def told(rows: DataFrame) -> DataFrame:
        """Clicks with all that makes two of them equal; long texts by their SHA-256."""
        other = F.sha2(F.to_json(F.struct(*[F.col("row").getField(c).alias(f"c{k}") for k, c in enumerate(rest) if c not in plain]), {"ignoreNullFields": "false"}), 256)
        return rows.select(
            F.col("row.client_id").alias("client_id"), ts.alias("at"), F.col("row.kind").alias("kind"), F.col("row.value").alias("value"), "known", *[F.col("row").getField(c).alias(f"p{k}") for k, c in enumerate(rest) if c in plain],
            F.unhex(other).alias("other"),
        )

    plain = {f.name for f in clicks.schema.fields if f.dataType.typeName() in ("byte", "short", "integer", "long", "boolean", "date", "timestamp", "timestamp_ntz", "double", "float")}
    light = told(whole.join(hot, spread, "left_anti")).repartition("client_id").dropDuplicates().join(heads.where(kept).hint("shuffle_hash"), "client_id")
    heavy = told(whole.join(hot, spread, "left_semi")).dropDuplicates()
    heavy = heavy.join(F.broadcast(heads.where(kept & (F.col("clicks") > max(SPREAD_ROWS, total // 1000)))), "client_id")

    def scanned(rows: DataFrame, own: Column) -> DataFrame:
        rows = rows.where(F.col("at") >= F.col("start_1")).select("client_id", "at", "known", _cents(F.col("value")).alias("cents"), "start_0", "start_1", "segment", "crc", "moved", own.alias("own"))
        return rows.sortWithinPartitions("client_id", "at").mapInArrow(lambda batches: _runs(batches, cohort_days * DAY_US, period_days * DAY_US), _SCAN)

    one = [F.max(c).alias(c) for c in _SUMS[:-1]]
    joined = scanned(heavy, F.col("client_id")).groupBy("own", *CELL).agg(*one, F.sum("cents").alias("cents"))
    cells = scanned(light, F.lit(None).cast("bigint")).unionByName(joined).groupBy(*CELL).agg(*[F.sum(c).alias(c) for c in _SUMS])
    return cells.where("users > 0")
