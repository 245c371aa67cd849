"""Keyed state with event-time timers: rate limits, open events that end, and a memory of titles.

State is freed by timers once the watermark is past the time from which it can't matter, so it grows with the keys of
that time and not with the stream.  Rows of one key are taken in order of time within a batch; a key's rows of one batch
are held at a time, and the source's limits (files or bytes a trigger) bound a batch.  Rows without a time have no place
in the order and are dropped; so are rows behind the watermark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructType

from ..functions.text import trigrams
from ..operators.simjoin import prefix_size

#: Seconds between answers to one chat, days of the memories of titles and of events.
REPLY_GAP, TITLE_DAYS, EVENT_DAYS = 10, 7, 14
_DAY_US = 86_400_000_000


def _due(at_us: int) -> int:
    """The first whole millisecond after a time: when its timer goes off."""
    return at_us // 1000 + 1


def _ordered(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(rows), ignore_index=True).sort_values(["at_us", "id"], kind="stable", ignore_index=True)


class _Gap(StatefulProcessor):
    """The time of the key's last accepted row."""

    def __init__(self, gap_us: int) -> None:
        self.gap_us = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last = was = self.last.get()[0] if self.last.exists() else None
        out = _ordered(rows)
        accepted = []
        for at in out["at_us"].tolist():
            accepted.append(last is None or at - last >= self.gap_us)
            last = at if accepted[-1] else last
        self.last.update((last,))
        if was is None:
            self.handle.registerTimer(_due(last + self.gap_us))
        yield pd.DataFrame({"key": pd.Series([key[0]] * len(out), dtype=object), "id": out["id"], "at_us": out["at_us"], "accepted": accepted})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # A key has one timer, which goes on to the next time that matters as long as rows come.
        due = _due(self.last.get()[0] + self.gap_us)
        if due <= timerValues.getCurrentWatermarkInMs():
            self.last.clear()
        else:
            self.handle.registerTimer(due)
        yield pd.DataFrame([], columns=["key", "id", "at_us", "accepted"], dtype=object)

    def close(self) -> None:
        pass


def _timed(stream: DataFrame, key: str, id: str, time: str, late: str) -> DataFrame:
    at = F.col(time).cast("timestamp")
    rows = stream.where(F.col(time).isNotNull() & F.col(key).isNotNull() & F.col(id).isNotNull())
    return rows.select(F.col(key).alias("key"), F.col(id).alias("id"), at.alias("at"), F.unix_micros(at).alias("at_us")).withWatermark("at", late)


def rate_limited(messages: DataFrame, key: str, id: str, time: str, gap: float = REPLY_GAP, late: str = "0 seconds") -> DataFrame:
    """(key, id, at_us, accepted) for each message of a stream, at most one accepted per key in any ``gap`` seconds.

    A message is refused if the key's last accepted one is less than ``gap`` seconds before it; refused ones don't count.
    Ties in time go by id.
    """
    rows = _timed(messages, key, id, time, late)
    kind = rows.schema["key"].dataType.simpleString()
    id_kind = rows.schema["id"].dataType.simpleString()
    return rows.groupBy("key").transformWithStateInPandas(_Gap(round(gap * 1e6)), f"key {kind}, id {id_kind}, at_us long, accepted boolean", "Append", "EventTime")


class _Open(StatefulProcessor):
    """First and last time and number of rows of the key's open event."""

    def __init__(self, keep_us: int) -> None:
        self.keep_us = keep_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.event = handle.getValueState("event", "first long, last long, n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first, last, n = self.event.get() if self.event.exists() else (None, None, 0)
        new, ended = not n, []
        for at in _ordered(rows)["at_us"].tolist():
            if n and at - last > self.keep_us:
                ended.append((key[0], first, last, n))
                n = 0
            first, last, n = (at, at, 1) if not n else (min(first, at), max(last, at), n + 1)
        self.event.update((first, last, n))
        if new:
            self.handle.registerTimer(_due(last + self.keep_us))
        yield pd.DataFrame(ended, columns=["key", "first_us", "last_us", "n"], dtype=object)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        row = self.event.get()
        due = _due(row[1] + self.keep_us)
        over = due <= timerValues.getCurrentWatermarkInMs()
        if over:
            self.event.clear()
        else:
            self.handle.registerTimer(due)
        yield pd.DataFrame([(key[0], *row)] if over else [], columns=["key", "first_us", "last_us", "n"], dtype=object)

    def close(self) -> None:
        pass


def ended_events(rows: DataFrame, key: str, id: str, time: str, keep_days: float = EVENT_DAYS, late: str = "0 seconds") -> DataFrame:
    """(key, first_us, last_us, n): a key's runs of rows, once ``keep_days`` have passed since the last one.

    What hasn't ended is the store's state: one row a key that was seen within ``keep_days``.
    """
    timed = _timed(rows, key, id, time, late)
    kind = timed.schema["key"].dataType.simpleString()
    return timed.groupBy("key").transformWithStateInPandas(_Open(round(keep_days * _DAY_US)), f"key {kind}, first_us long, last_us long, n long", "Append", "EventTime")


class _Index(StatefulProcessor):
    """The titles of the last days under the trigrams of one share of all: trigram, id, number, place, time and sketch."""

    _COLUMNS = ("h", "id", "n", "place", "at", "s0", "s1", "s2", "s3")

    def __init__(self, threshold: float, keep_us: int) -> None:
        self.threshold, self.keep_us = threshold, keep_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.titles = handle.getValueState("titles", "rows binary")  # one value: a call for each of many rows takes longer than all else

    def _known(self) -> np.ndarray:
        held = bytes(self.titles.get()[0]) if self.titles.exists() else b""
        return np.frombuffer(held, np.int64).reshape(-1, len(self._COLUMNS))

    def _keep(self, titles: np.ndarray, watermark_ms: int) -> np.ndarray:
        kept = titles[(titles[:, 4] + self.keep_us) // 1000 + 1 > watermark_ms]
        if len(kept):
            self.titles.update((kept.tobytes(),))
        else:
            self.titles.clear()
        return kept

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        old, new = self._known(), _ordered(rows)
        added = np.stack([new[c].to_numpy(np.int64) for c in ("at_us" if c == "at" else c for c in self._COLUMNS)], 1)
        both = np.concatenate([old, added])
        kept = self._keep(both, timerValues.getCurrentWatermarkInMs())
        if len(kept) and not len(old):
            self.handle.registerTimer(_due(int(kept[:, 4].min()) + self.keep_us))
        yield pd.DataFrame(self._met(both, np.arange(len(both)) >= len(old)), columns=["a", "b"])

    def _met(self, titles: np.ndarray, new: np.ndarray) -> np.ndarray:
        """(a, b): ids of one trigram, b at most the kept time after a, one of them new, that may be alike.

        Rows lie by trigram and time; each is held against the one before it, the one before that, and so on until that
        is of another trigram or too old, which then holds for all before: work and memory go with the pairs in time.
        """
        order = np.lexsort((titles[:, 1], titles[:, 4], titles[:, 0]))
        titles, new = titles[order], new[order]
        h, id, n, place, at = (np.ascontiguousarray(titles[:, c]) for c in range(5))
        sketch = np.ascontiguousarray(titles[:, 5:]).view(np.uint64)
        found, later, back = [np.zeros((0, 2), np.int64)], np.arange(1, len(titles)), 1
        while len(later):
            before = later - back
            inside = (h[later] == h[before]) & (at[later] - at[before] <= self.keep_us)
            later, before = later[inside], before[inside]
            room = np.minimum(n[later] - place[later], n[before] - place[before]) + 1  # can still be shared from both places on
            may = (room >= self.threshold * (n[later] + n[before]) / 2 - 1e-9) & (id[later] != id[before]) & (new[later] | new[before])
            x, y = later[may], before[may]
            near = np.bitwise_count(sketch[x] ^ sketch[y]).sum(axis=1) <= (1 - self.threshold) * (n[x] + n[y]) + 1e-6
            found.append(np.unique(np.stack([id[y[near]], id[x[near]]], 1), axis=0))
            back += 1
            later = later[later >= back]
        return np.unique(np.concatenate(found), axis=0)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        kept = self._keep(self._known(), timerValues.getCurrentWatermarkInMs())
        if len(kept):
            self.handle.registerTimer(_due(int(kept[:, 4].min()) + self.keep_us))
        yield pd.DataFrame([], columns=["a", "b"])

    def close(self) -> None:
        pass


def _sketched(grams: Column) -> list[Column]:
    """A bit of 256 for each trigram's hash, those of a set added modulo 2: sets of d differences differ in d bits at most."""
    word = lambda k: F.aggregate(grams, F.lit(0).cast("bigint"), lambda s, g: F.when(F.pmod(g["h"], F.lit(4)) == k, s.bitwiseXOR(_bit(g["h"]))).otherwise(s))
    return [word(k).alias(f"s{k}") for k in range(4)]


def _bit(h: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, 58).cast("int"))


def title_candidates(titles: DataFrame, id: str, title: str, time: str, threshold: float = 0.9, keep_days: float = TITLE_DAYS, late: str = "0 seconds", shares: int = 64) -> DataFrame:
    """(a, b): pairs of a stream's titles, b at most ``keep_days`` after a, that may have a Dice of ``threshold``.

    Each title is put under the trigrams of its prefix in one fixed order, that of a hash, so any two such titles meet
    under one of them.  Trigrams are dealt into ``shares`` by hash, each with one list in the state and one group of a
    batch: raise it with the titles of ``keep_days``.  Sketches of the sets leave out pairs that differ in too many bits.
    A pair may come once a share; :func:`alike_pairs` confirms it.
    """
    rows = _timed(titles.withColumn("__id", F.col(id).cast("bigint")), title, "__id", time, late)
    grams = F.array_sort(F.transform(trigrams(F.col("key")), lambda g: F.struct(F.xxhash64(g).alias("h"), g.alias("g"))))
    rows = rows.withColumn("grams", grams).withColumn("n", F.size("grams")).where("n > 0")
    each = rows.select("id", "at", "at_us", "n", *_sketched(F.col("grams")), F.posexplode(F.slice("grams", F.lit(1), prefix_size(F.col("n"), threshold).cast("int"))).alias("pos", "token"))
    keyed = each.select(F.pmod("token.h", F.lit(shares)).alias("share"), F.col("token.h").alias("h"), "id", "at", "at_us", "n", (F.col("pos") + 1).alias("place"), "s0", "s1", "s2", "s3")
    out = StructType().add("a", LongType()).add("b", LongType())
    return keyed.groupBy("share").transformWithStateInPandas(_Index(threshold, round(keep_days * _DAY_US)), out, "Append", "EventTime")


def alike_pairs(candidates: DataFrame, titles: DataFrame, id: str, title: str, threshold: float = 0.9) -> DataFrame:
    """(a, b, similarity), a < b: the candidates whose Dice reaches the threshold, once each; ``titles`` is a table."""
    sets = titles.select(F.col(id).cast("bigint").alias("id"), trigrams(F.col(title)).alias("grams"))
    pairs = candidates.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    side = lambda c: sets.select(F.col("id").alias(c), F.col("grams").alias(f"g{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    dice: Column = 2.0 * F.size(F.array_intersect("ga", "gb")) / (F.size("ga") + F.size("gb"))
    return both.select("a", "b", dice.alias("similarity")).where(F.col("similarity") >= threshold)
