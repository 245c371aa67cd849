"""Line dedup, cohort retention and whitening against brute force, with nulls, repeats, ties and empty tables."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict
from datetime import UTC, datetime, timedelta

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewire.llm import linededup, retention, whitening
from tidewire.llm.linededup import CuckooFilter, LineIndex, dedup_lines, drop_common_lines

SPACE = " \t\n\v\f\r"


# --- line dedup ---


def key_of(line):
    return line.strip(SPACE).translate({c: c + 32 for c in range(65, 91)})


def brute_lines(texts, least, least_chars=1):
    lines = [(t or "").split("\n") for t in texts]
    held = Counter(k for one in lines for k in {key_of(x) for x in one})
    common = {k for k, n in held.items() if n >= least and len(k) >= least_chars}
    return [("\n".join(x for x in one if key_of(x) not in common), len(one), sum(key_of(x) in common for x in one)) for one in lines]


def line_docs(spark, texts):
    return spark.createDataFrame([(None if i % 5 == 4 else i, t, f"s{i}", "x", 7) for i, t in enumerate(texts)], "doc_id long, text string, n_lines string, row string, n_dropped int")


def random_texts(seed, n=80):
    draw = random.Random(seed)
    pool = ["Terms apply", " terms APPLY\t", "été", "ÉTÉ", "a", "", " ", "\r", "long " * 3000, "Copyright"] + [f"line {k}" for k in range(40)]
    return [None, "", "\n", "\n\n", "x" * 70_000] + ["\n".join(draw.choices(pool, k=draw.randrange(0, 12))) for _ in range(n)]


def got_lines(out):
    return sorted((r.row.n_lines, r.text, r.n_lines, r.n_dropped) for r in out.collect())


@pytest.mark.parametrize(("least", "least_chars"), [(10, 1), (2, 1), (3, 6)])
@pytest.mark.parametrize("sent", [True, False])
def test_lines_equal_brute_force(spark, monkeypatch, least, least_chars, sent):
    monkeypatch.setattr(linededup, "SHARD_KEYS", 8)
    monkeypatch.setattr(linededup, "SENT_BYTES", linededup.SENT_BYTES if sent else -1)
    texts = random_texts(least)
    want = sorted((f"s{i}", *x) for i, x in enumerate(brute_lines(texts, least, least_chars)))
    assert got_lines(dedup_lines(line_docs(spark, texts), least, least_chars)) == want


def state(index):
    slots = {r.shard: np.count_nonzero(np.frombuffer(r.slots, np.uint16)) for r in index.filters.collect()}
    return sorted((bytes(r.key), r.n) for r in index.counts.where("n > 0").collect()), {s: n for s, n in slots.items() if n}


def test_insertions_and_deletions_are_reversible(spark):
    texts = random_texts(5)
    a, b = line_docs(spark, texts[:50]), line_docs(spark, texts[50:])
    first = LineIndex(spark, 4).insert(a)
    both = first.insert(b)
    assert state(both) == state(LineIndex(spark, 4).insert(a.unionByName(b)))
    assert state(both.delete(b)) == state(first) and state(both.delete(b).delete(a)) == ([], {})
    want = sorted((f"s{i}", *x) for i, x in enumerate(brute_lines(texts[:50], 4)))
    assert got_lines(drop_common_lines(a, both.delete(b))) == want
    with pytest.raises(ValueError, match="deleted"):
        first.delete(b)
    both.forget()
    assert state(first)[0]


def test_other_keys_that_a_filter_takes_for_common_are_listed():
    keys = np.frombuffer(np.random.default_rng(4).bytes(16 * 60_000), linededup._KEY)
    n = np.where(np.arange(60_000) < 30_000, 5, 1)
    counts = pa.table({"shard": pa.array(np.zeros(60_000, np.int32)), "key": linededup._binary(keys), "was": n * 0, "n": n})
    made = linededup._updated(5, False)(counts, pa.table({"shard": pa.array([], pa.int32()), "slots": pa.array([], pa.binary()), "taken": pa.array([], pa.binary())})).to_pylist()
    assert len(made[0]["taken"]) > 0
    assert (linededup._Sent(made, 0).common(keys) == (n == 5)).all()


def test_cuckoo_filter_keeps_and_forgets():
    keys = np.frombuffer(np.random.default_rng(1).bytes(16 * 20_000), linededup._KEY)
    made = CuckooFilter.of(keys[:10_000])
    assert made.holds(keys[:10_000]).all() and len(made) == 10_000 and made.holds(keys[10_000:]).sum() < 20
    made.delete(keys[:5_000])
    assert made.holds(keys[5_000:10_000]).all() and len(made) == 5_000
    small = CuckooFilter(2)
    assert not small.insert(keys[:9]) and CuckooFilter.of(keys[:0]).insert(keys[:4])


def test_an_empty_table_of_lines(spark):
    assert dedup_lines(line_docs(spark, ["a"]).limit(0)).collect() == []


# --- retention ---

CLICKS = "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double, props string, segment string, at int"


def brute_retention(clicks, clients, cohort_days, period_days):
    epoch, cutoff = datetime(1970, 1, 1), datetime(2024, 2, 15)
    micros = lambda t: (t - epoch) // timedelta(microseconds=1)
    rows, day = [], 86_400_000_000
    for i, ts, arrived, c, kind, value, *_ in set(clicks):
        if ts is None or c is None:
            continue
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        known = arrived is not None and arrived + timedelta(days=h % 100 if h % 3 == 0 else 0) < cutoff
        rows.append((known, micros(ts), c, kind, 0 if value is None or value != value else int(np.floor(100 * value + 0.5))))
    start = [{}, {}]
    for known, ts, c, kind, _ in rows:
        for s in (0, 1):
            if kind == "signup" and (s or known):
                start[s][c] = min(ts, start[s].get(c, ts))
    segment = {}
    for c, at, name in clients:
        segment[c] = max(segment.get(c, (False, datetime.min, False, "")), (at is not None, at or datetime.min, name is not None, name or ""))
    cells = defaultdict(lambda: [set(), 0])
    for known, ts, c, _, cents in rows:
        for s in (0, 1):
            if (s or known) and ts >= start[s].get(c, 1 << 62):
                cell = cells[s, segment.get(c, (0, 0, 0, ""))[3], start[s][c] // day // cohort_days, (ts - start[s][c]) // (day * period_days)]
                cell[0].add(c)
                cell[1] += cents
    moved = {c for c in start[0] if start[0][c] // day // cohort_days != start[1][c] // day // cohort_days}
    return sorted((*k, len(u), sum(zlib.crc32(str(c).encode()) for c in u), len(u & moved), n) for k, (u, n) in cells.items())


def random_clicks(seed, n=900):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        client = 7 if draw.random() < 0.4 else draw.choice([None, *range(-3, 30)])
        ts = datetime(2024, 2, 1) + timedelta(days=draw.randrange(25), microseconds=draw.choice([0, 1, 86_399_999_999, draw.randrange(86_400_000_000)]))
        arrived = ts + timedelta(seconds=draw.randrange(90_000))
        rows.append((draw.choice([None, *range(n)]), draw.choice([None] + [ts] * 9), draw.choice([None] + [arrived] * 9), client, draw.choice(["signup", "view", "view", None]), draw.choice([None, float("nan"), -1.005, 0.125, 9.99]), draw.choice([None, "{}", '{"k": 1}']), "x", 1))
        if draw.random() < 0.2:
            rows.append(rows[-1])
    return rows + [rows[0]] * 300


@pytest.mark.parametrize(("spread", "cohort_days", "period_days"), [(10**9, 1, 1), (20, 1, 1), (20, 7, 2)])
def test_retention_equals_brute_force(spark, monkeypatch, spread, cohort_days, period_days):
    monkeypatch.setattr(retention, "SPREAD_ROWS", spread)
    clicks = random_clicks(3)
    clients = [(c, at, s) for c in (7, 7, 7, None, 1, 2, 3, 4, 5) for at, s in ((None, "z"), (datetime(2024, 1, c or 1), f"s{c % 3 if c else 0}"), (datetime(2024, 1, 1), None))]
    people = spark.createDataFrame(clients, "client_id long, updated_at timestamp_ntz, segment string")
    known = retention.arrival(F.col("click_id"), F.col("arrived_at")) < F.lit("2024-02-15 00:00:00").cast("timestamp_ntz")
    out = retention.retention(spark.createDataFrame(clicks, CLICKS).repartition(5), people, known, "signup", cohort_days, period_days)
    assert sorted(map(tuple, out.collect())) == brute_retention(clicks, clients, cohort_days, period_days)


def test_retention_of_empty_tables(spark):
    clicks = spark.createDataFrame([], CLICKS)
    people = spark.createDataFrame([], "client_id long, updated_at timestamp_ntz, segment string")
    assert retention.retention(clicks, people, F.lit(True)).collect() == []
    one = spark.createDataFrame([(1, datetime(2024, 1, 1, tzinfo=UTC).replace(tzinfo=None), None, 3, "signup", None, None, "x", 1)], CLICKS)
    assert [(r.state, r.segment, r.period, r.users) for r in retention.retention(one, people, F.lit(None).cast("boolean")).collect()] == [(1, "", 0, 1)]


# --- whitening ---

VECTORS = "vec_id long, embedding array<double>, n string, v int, component int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, r, "n", 1, 2) for i, r in rows], VECTORS)


def brute_whiten(x, most):
    n, total = len(x), x.sum(axis=0)
    values, basis = np.linalg.eigh(np.cov((x - total / n).T, bias=True).reshape(x.shape[1], -1))
    order = np.argsort(values)[::-1][:most]
    return (x - total / n) @ basis[:, order] / np.sqrt(values[order]), values[order] / values.sum(), [sum((n * int(v) - int(s)) ** 2 for v, s in zip(r, total, strict=True)) for r in x]


def test_whitening_equals_brute_force(spark):
    draw = np.random.default_rng(3)
    given = draw.normal(size=(500, 6)) @ draw.normal(size=(6, 6)) * 9 + 100
    rows = list(enumerate(given.tolist())) + [(900, None), (901, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (902, [float("nan")] * 6), (903, [float("inf")] + [0.0] * 5), (904, []), (0, given[0].tolist()), (None, given[1].tolist())]
    x = np.floor(np.vstack([given, given[:2]]) * 64).astype(np.int64) + 1_000_000
    want, shares, apart = brute_whiten(x, 4)
    out = whitening.whiten(vectors(spark, rows).repartition(7), most=4).collect()
    assert len(out) == 502 * 4 and {r.n for r in out} == {502} and {r.vec_id for r in out} == {*range(500), None}
    sign = {c: np.sign(want[5, c - 1]) * np.sign(next(r.whitened for r in out if (r.vec_id, r.component) == (5, c))) for c in range(1, 5)}
    for r in out:
        i = 1 if r.vec_id is None else r.vec_id
        assert r.deviation == apart[i] and abs(r.explained / shares[r.component - 1] - 1) < 1e-9 and abs(r.whitened * sign[r.component] - want[i, r.component - 1]) < 1e-8
    assert len({r.identity_error for r in out}) == 1 and out[0].identity_error < 1e-9


def test_whitening_without_variance_and_of_several_lengths(spark):
    assert whitening.whiten(vectors(spark, []), most=3).collect() == []
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0])]), most=3).collect() == []
    draw = np.random.default_rng(1).normal(size=(60, 3)) * 5
    draw[:, 2] = 7.0
    rows = [(i, v) for i, v in enumerate(draw.tolist())] + [(100 + i, [float(i)]) for i in range(10)]
    out = whitening.whiten(vectors(spark, rows)).collect()
    assert Counter((r.n, r.component) for r in out) == {(60, 1): 60, (60, 2): 60, (10, 1): 10} and max(r.identity_error for r in out) < 1e-9


def test_moments_merge_in_any_order():
    x = np.random.default_rng(2).integers(-50, 50, size=(300, 4)) + 10**6
    parts = [{4: whitening.block_moments(x[i:j])} for i, j in ((0, 7), (7, 200), (200, 300))]
    n, total, scatter = whitening.merged(parts[2], whitening.merged(parts[0], parts[1]))[4]
    c = x - x.mean(axis=0)
    assert n == 300 and (total == x.sum(axis=0)).all() and np.allclose(scatter, c.T @ c, rtol=1e-9)


def test_deviations_beyond_a_long_are_null():
    x = np.array([[1 << 32, 0], [0, 1]])
    exact = [sum((2 * a - b) ** 2 for a, b in zip(row, x.sum(axis=0).tolist(), strict=True)) for row in x.tolist()]
    assert exact[0] >= 1 << 63 and whitening.deviations(x, 2, x.sum(axis=0)).to_pylist() == [None, None]
    assert whitening.deviations(x // 8, 2, (x // 8).sum(axis=0)).to_pylist() == [sum((2 * a - b) ** 2 for a, b in zip(row, (x // 8).sum(axis=0).tolist(), strict=True)) for row in (x // 8).tolist()]
