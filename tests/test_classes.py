"""Classes of equal token sets, their members and links, the steps of sizes, and the capped shortlist."""

from __future__ import annotations

import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewire import catalogue
from tidewire.operators import lineage, ranking, simjoin


def dice(a, b):
    return 2 * len(set(a) & set(b)) / (len(a) + len(b))


@pytest.mark.parametrize("threshold", [0.8, 0.9, 0.97, 1.0])
def test_steps_of_sizes_hold_the_partners(threshold):
    steps = simjoin.size_steps(threshold, 3000)
    step = lambda n: sum(s <= n for s in steps)
    for n in range(1, 3000):
        least = next(m for m in range(1, n + 1) if 2 * m / (m + n) >= threshold)
        assert step(n) - step(least) <= 1


@pytest.mark.parametrize("size", [3, 12, 40])
def test_equal_parts_miss_nothing(spark, size):
    draw = random.Random(size)
    names = [f"t{k}" for k in range(4 * size)]
    rows = []
    for k in range(40):
        base = draw.sample(names, size) if k % 4 == 0 else rows[k - 1][1]
        kept = [t for t in base if draw.random() > 0.06] or base
        rows.append((k, list(dict.fromkeys(kept + draw.sample(names, draw.randrange(1 + size // 10)))), k % 3))
    df = spark.createDataFrame(rows, "k bigint, g array<string>, s int")
    for threshold, same in ((0.8, []), (0.9, []), (0.85, ["s"])):
        want = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and dice(a[1], b[1]) >= threshold and (not same or a[2] == b[2])}
        assert {(r.a, r.b) for r in simjoin.similar_pairs(df, "k", "g", threshold, same=same).collect()} == want


def test_classes_and_their_members(spark):
    # One set has a third of the rows; nulls and empty sets are one class; a repeated row stays; names clash with own ones.
    rows = [(k, ["x", "y", "z", "w"]) for k in range(200)] + [(k, ["w", "z", "y", "x", f"n{k}"]) for k in range(200, 210)]
    rows += [(300, None), (301, []), (302, None), (303, ["x", "y", "z", "w"]), (303, ["x", "y", "z", "w"]), (304, ["other"])]
    df = spark.createDataFrame(rows, "id bigint, a array<string>").repartition(5)
    classes = simjoin.set_classes(df, "id", "a")
    pairs = simjoin.similar_pairs(classes, "class_id", "a", 0.8)
    assert pairs.count() == 10 + 45  # the others share four of five
    found = simjoin.class_members(df, "id", "a", pairs).collect()
    assert len(found) == len(rows)
    got = {r.id: (r.class_id, r.links) for r in found}
    assert got[150] == got[303] == (0, 10) and got[205] == (205, 10)
    assert got[300] == got[301] == got[302] == (300, 0) and got[304] == (304, 0)


def test_title_pairs_hold_every_document_of_a_title(spark, tmp_path):
    rows = [(k, "One title that many documents have in common") for k in range(150)] + [(200, "one TITLE that many documents have in common!"), (201, "One title that many documents have in commons 4"), (202, None), (203, "")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = catalogue.QUERIES["title_similarity_pairs"](spark, str(tmp_path)).collect()
    assert {(r.a, r.b) for r in found if r.similarity == 1} == {(0, k) for k in [*range(1, 150), 200]} and [(r.a, r.b) for r in found if r.similarity < 1] == [(0, 201)]
    found = catalogue.QUERIES["signature_mismatch"](spark, str(tmp_path)).collect()
    assert {(r.a, r.b) for r in found if not r.mismatch} == {(0, k) for k in [*range(1, 150), 200]} and [(r.a, r.b) for r in found if r.mismatch] == [(0, 201)]


def test_stars_are_passed_on_when_they_are_many(monkeypatch):
    monkeypatch.setattr(lineage, "TASK_EDGES", 10)
    edges = [pa.record_batch([pa.array([2 * k, 2 * k]), pa.array([2 * k + 1, 2 * k + 2])], ["a", "b"]) for k in range(100)]
    out = list(lineage.contract(iter(edges)))
    assert len(out) > 5 and max(b.num_rows for b in out) <= 30
    whole = lineage._contracted(pa.Table.from_batches(out))
    assert set(whole.column("a").to_pylist()) == {0} and sorted(whole.column("b").to_pylist()) == list(range(201))


def test_links_join_what_is_near_and_no_more():
    draw = random.Random(5)
    bits = lambda: sum(1 << k for k in draw.sample(range(256), 60))
    base, sketches = bits(), []
    for _ in range(60):
        flipped = base
        for k in draw.sample(range(256), draw.randrange(12)):
            flipped ^= 1 << k
        sketches.append(flipped if draw.random() < 0.6 else bits())
    found = {frozenset(e) for part in simjoin._linked(np.arange(60), np.array([[s >> 64 * c & (2**64 - 1) for c in range(4)] for s in sketches], np.uint64), 15) for e in part.tolist()}
    group = {k: {k} for k in range(60)}
    for a, b in map(sorted, found):
        both = group[a] | group[b]
        for k in both:
            group[k] = both
    for a in range(60):
        for b in range(a):
            assert (sketches[a] ^ sketches[b]).bit_count() > 15 or b in group[a]
    assert all((sketches[a] ^ sketches[b]).bit_count() <= 30 for a, b in map(tuple, found))


def test_counts_equal_the_pairs_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(simjoin, "BLOCK_ROWS", 7)
    draw = random.Random(8)
    base = [f"t{k}" for k in range(40)]
    rows = [(k, [t for t in base if draw.random() > 0.05] + [f"n{k}"]) for k in range(60)]
    df = spark.createDataFrame(rows, "k bigint, g array<string>")
    want = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and dice(a[1], b[1]) >= 0.9}
    pairs = [(r.a, r.b) for r in simjoin.similar_pairs(df, "k", "g", 0.9).collect()]
    assert len(want) > 300 and len(pairs) == len(want) and set(pairs) == want
    counts = {r.k: r.links for r in simjoin.similar_counts(df, "k", "g", 0.9).collect()}
    assert counts == {k: n for k in range(60) if (n := sum(k in p for p in want))}


@pytest.mark.parametrize("most", [2000, 3])
def test_rows_meet_all_items_sent_or_not(spark, monkeypatch, most):
    monkeypatch.setattr(simjoin, "SENT_SETS", most)
    draw = random.Random(3)
    sets = lambda n: [(k, [f"t{t}" for t in range(30) if draw.random() < 0.7]) for k in range(n)] + [(n, []), (n + 1, None)]
    left, right = sets(80), sets(9)
    df = lambda rows, key: spark.createDataFrame(rows, f"{key} bigint, g array<string>")
    found = [(r.x, r.y) for r in simjoin.similar_to(df(left, "x"), df(right, "y"), "x", "y", "g", 0.7).collect()]
    want = {(a[0], b[0]) for a in left for b in right if a[1] and b[1] and dice(a[1], b[1]) >= 0.7}
    assert len(want) > 50 and len(found) == len(want) and set(found) == want


def test_classes_of_nothing(spark):
    df = spark.createDataFrame([], "id bigint, a array<string>")
    pairs = simjoin.similar_pairs(simjoin.set_classes(df, "id", "a"), "class_id", "a", 0.9)
    assert pairs.count() == 0 and simjoin.class_members(df, "id", "a", pairs).count() == 0


@pytest.mark.parametrize("limit, cap", [(6, 2), (3, 5), (40, 1)])
def test_capped_shortlist_equals_the_walk(spark, limit, cap):
    draw = random.Random(limit)
    rows = [(k, "hot" if draw.random() < 0.6 else draw.choice(["a", "b", None]), draw.randrange(20), draw.random() < 0.15 or None) for k in range(150)]
    order = sorted(rows, key=lambda r: (-r[2], r[0]))
    count, passed, rest = {}, [], []
    for place, r in enumerate(order):
        count[r[1]] = count.get(r[1], 0) + 1
        (passed if r[3] or count[r[1]] <= cap else rest).append((place, r[0]))
    want = [k for _, k in sorted((passed + rest)[:limit])]
    df = spark.createDataFrame(rows, "id bigint, kind string, score int, free boolean").repartition(5)
    out = ranking.capped_top(df, "kind", [F.desc("score"), F.asc("id")], limit, cap, F.col("free"))
    assert [(r.rank, r.id) for r in out.orderBy("rank").collect()] == list(enumerate(want, 1))


def test_low_thresholds_send_sketches_and_no_pairs_of_common_tokens(spark, monkeypatch):
    """Sets that share half of their tokens are no candidates; alike ones of another side are all found, over blocks."""
    monkeypatch.setattr(simjoin, "SKETCH_ROWS", 40)
    draw = random.Random(5)
    common, rows = [f"c{i}" for i in range(20)], []
    for k in range(150):
        rows.append((f"k{k}", common + draw.sample([f"t{i}" for i in range(3000)], 30), k % 3 == 0))
    for k in range(0, 150, 10):
        rows.append((f"n{k}", rows[k][1][:-8] + [f"z{k}{i}" for i in range(8)], k % 20 == 0))
    df = spark.createDataFrame(rows, "k string, g array<string>, side boolean")
    for apart in (None, "side"):
        alike = lambda a, b: 2 * len(set(a[1]) & set(b[1])) / (len(a[1]) + len(b[1])) >= 0.6
        want = {tuple(sorted((a[0], b[0]))) for i, a in enumerate(rows) for b in rows[:i] if alike(a, b) and (not apart or a[2] != b[2])}
        found = simjoin.similar_pairs(df, "k", "g", 0.6, apart=apart)
        assert want and {(r.a, r.b) for r in found.collect()} == want and found.count() == len(want)
        made = [s for s in os.listdir(lineage.shared_dir(spark).removeprefix("file:")) if s.startswith("candidates-")]
        newest = max((os.path.join(lineage.shared_dir(spark).removeprefix("file:"), s) for s in made), key=os.path.getmtime)
        assert spark.read.parquet(newest).count() < 1353  # a tenth of the pairs, all of which share tokens
