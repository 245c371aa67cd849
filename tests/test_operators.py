from __future__ import annotations

import random
from datetime import UTC, date, datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from tidewire import catalogue
from tidewire.functions.text import trigrams
from tidewire.operators import claims, cluster, dedup, health, ranking, simjoin, timeline
from tidewire.operators.lineage import components


def grams(t: str) -> frozenset[str]:
    t = " ".join("".join(c for c in t.lower() if c.isalnum() or c.isspace()).split())
    p = f"  {t} "
    return frozenset(p[i : i + 3] for i in range(len(p) - 2)) if t else frozenset()


def dice(a, b):
    return 2 * len(a & b) / (len(a) + len(b)) if a and b else 0.0


def sequential(rows, known_ids=(), known_hashes=(), threshold=0.9):
    """Keep-first, one row after the other."""
    ids, hashes, kept, out = dict.fromkeys(known_ids, ""), dict.fromkeys(known_hashes, ""), [], {}
    for k, i, h, t in rows:
        if i in ids:
            out[k] = (False, "duplicate_url", ids[i])
        elif h in hashes:
            out[k] = (False, "duplicate_content", hashes[h])
        else:
            near = next((j for j, u in kept if len(t) + len(u) and 2 * min(len(t), len(u)) / (len(t) + len(u)) >= threshold and dice(grams(t), grams(u)) >= threshold), None)
            if near is not None:
                out[k] = (False, "similar_title", near)
            else:
                out[k] = (True, None, None)
                ids[i], hashes[h] = i, i
                kept.append((i, t))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_dedup_equals_the_sequential_rule(spark, seed):
    draw = random.Random(seed)
    words = "alpha beta gamma delta model launch paper chips agents".split()
    base = [" ".join(draw.choices(words, k=6)) for _ in range(12)]
    rows = []
    for k in range(70):
        t = draw.choice(base)
        if draw.random() < 0.6:
            at = draw.randrange(len(t))
            t = t[:at] + draw.choice("xyz") + t[at + 1 :]
        rows.append((k, f"i{draw.randrange(60)}", f"h{draw.randrange(60)}", t))
    ids, hashes = ["i1", "i2"], ["h3"]
    df = spark.createDataFrame(rows, "ord bigint, id string, content_hash string, title string").repartition(5)
    out = dedup.deduplicate(df, spark.createDataFrame([(i,) for i in ids], "id string"), spark.createDataFrame([(h,) for h in hashes], "content_hash string"))
    assert {r.ord: (r.kept, r.reason, r.kept_id) for r in out.collect()} == sequential(rows, ids, hashes)
    stats = dedup.dedup_stats(out).first()
    assert stats.n_input == 70 and stats.n_unique + stats.n_duplicates == 70


def test_dedup_rounds_take_open_rows_only(spark, monkeypatch):
    """Titles of which each is like the one before: a round a pair of them, beside many rows that the first round settles."""
    written = []

    def counted(df, name):
        out = stored(df, name)
        written.append((name, out.count()))
        return out

    stored = dedup.stored
    monkeypatch.setattr(dedup, "stored", counted)
    chain = [(k, f"c{k}", None, "".join(map(chr, range(0x4E00 + k, 0x4E00 + k + 60)))) for k in range(12)]
    rows = chain + [(100 + k, f"i{k}", f"h{k}", None) for k in range(400)]
    out = dedup.deduplicate(spark.createDataFrame(rows, "ord bigint, id string, content_hash string, title string"))
    want = sequential([(k, i, f"n{k}", t) for k, i, h, t in chain])
    assert {r.ord: (r.kept, r.reason, r.kept_id) for r in out.where("ord < 100").collect()} == want and out.where("kept").count() >= 401
    assert len([n for n, _ in written if n == "kept"]) > 1
    assert sum(n for _, n in written) < 5 * len(rows)


def test_dedup_of_nothing(spark):
    df = spark.createDataFrame([], "ord bigint, id string, content_hash string, title string")
    assert dedup.deduplicate(df).count() == 0
    assert dedup.dedup_stats(dedup.deduplicate(df)).first().duplicate_rate == 0.0


def test_similarity_join_misses_nothing(spark):
    draw = random.Random(3)
    rows = [(k, " ".join(draw.choices("one two three four five six".split(), k=5))) for k in range(60)]
    df = spark.createDataFrame(rows, "k bigint, t string").select("k", trigrams(F.col("t")).alias("g"))
    for threshold in (0.4, 0.7, 0.8, 0.9, 1.0):
        want = {(a, b) for a, s in rows for b, t in rows if a < b and dice(grams(s), grams(t)) >= threshold}
        assert {(r.a, r.b) for r in simjoin.similar_pairs(df, "k", "g", threshold).collect()} == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 101), (103, 101), (7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {i: 0 for i in range(21)} | {100: 100, 101: 100, 103: 100}


T0 = datetime(2026, 1, 1, tzinfo=UTC)


def articles(spark, rows):
    data = [(k, f"a{k}", title, None, source, None, T0 + timedelta(minutes=k)) for k, (title, source) in enumerate(rows)]
    return spark.createDataFrame(data, "ord bigint, id string, title string, summary string, source_id string, published_at timestamp, fetched_at timestamp")


def test_a_shared_company_does_not_merge_but_a_version_does(spark):
    rows = [("OpenAI opens an office", "s1"), ("OpenAI sued over data", "s2"), ("Google ships Gemma 4 today", "s3"), ("Why Gemma 4 matters for phones", "s4"), ("Gemma 3 gets a patch", "s5")]
    events = {r.id: r for r in cluster.cluster_articles(articles(spark, rows)).collect()}
    assert len(events) == 4
    assert events["evt_a2"].article_ids == ["a2", "a3"] and events["evt_a2"].source_ids == ["s3", "s4"]


def test_one_source_needs_equal_wording_and_stored_events_go_on(spark):
    stored = spark.createDataFrame(
        [("evt_old", "Gemma 4 arrives", "model_release", ["model:gemma", "model:gemma-4"], ["x"], ["s9"], T0 - timedelta(days=1), T0 - timedelta(days=1))],
        "id string, canonical_title string, category string, entities array<string>, article_ids array<string>, source_ids array<string>, first_seen timestamp, last_updated timestamp",
    )
    rows = [("Hands on with Gemma 4", "s9"), ("Gemma 4 in the wild", "s1")]
    events = {r.id: r for r in cluster.cluster_articles(articles(spark, rows), stored).collect()}
    assert set(events) == {"evt_a0", "evt_old"} or events["evt_a0"].article_ids == ["a0", "a1"]
    assert sum(len(e.article_ids) for e in events.values() if e.is_new) + sum(len(e.article_ids) - 1 for e in events.values() if not e.is_new) == 2


def walk(rows, rules=cluster.ClusterRules()):
    """Articles (id, title, source, entities) one after the other against every event: {event id: article ids}."""
    weigh = lambda e: round(cluster._weight(e) * 1000)
    versions = lambda es: {f: {e.rpartition("-")[2] for e in es if e.rpartition("-")[0] == f and cluster._weight(e) == 1.0} for f in {e.rpartition("-")[0] for e in es if e.startswith("model:") and cluster._weight(e) == 1.0}}
    events = []
    for i, title, source, entities in rows:
        best, top = None, rules.threshold
        for e in events:
            mine, theirs = versions(entities), versions(e["entities"])
            if any(not mine[f] & theirs[f] for f in mine.keys() & theirs.keys()):
                continue
            shared = entities & e["entities"]
            strongest = max((weigh(x) / 1000 for x in shared), default=0.0)
            wording = max(dice(grams(title), grams(t)) for t in e["titles"][-rules.titles :])
            needed = 0.0 if strongest >= rules.decisive else rules.wording_least if strongest >= rules.gate else rules.wording_alone
            if wording < (max(needed, rules.wording_same_source) if source in e["sources"] else needed):
                continue
            whole = sum(map(weigh, entities | e["entities"]))
            score = (rules.entity_share * (sum(map(weigh, shared)) / whole) if whole else 0.0) + (1 - rules.entity_share) * wording
            score = max(score, wording if wording >= rules.wording_alone else rules.threshold if strongest >= rules.decisive else 0.0)
            if score >= top:
                best, top = e, score
        if best is None:
            events.append({"id": f"evt_{i}", "ids": [i], "titles": [title], "sources": {source}, "entities": set(entities)})
        elif i not in best["ids"]:
            best["ids"].append(i)
            best["titles"].append(title)
            best["sources"].add(source)
            best["entities"] |= entities
    return sorted((e["id"], tuple(e["ids"]), tuple(sorted(e["entities"])), frozenset(e["sources"])) for e in events)


@pytest.mark.parametrize(("seed", "slice_rows"), [(5, 20_000), (6, 25), (7, 7)])
def test_clusters_equal_the_walk(spark, monkeypatch, seed, slice_rows):
    from tidewire.functions.entities import article_entities

    monkeypatch.setattr(cluster, "SLICE_ROWS", slice_rows)
    draw = random.Random(seed)
    # Half of the rows name one version: one component that takes several slices.
    heads = ["OpenAI ships GPT-5", "OpenAI ships GPT-5", "GPT-5 and Llama 4", "Meta ships Llama 4", "New paper on chips", "EU act on chips", "NVIDIA GPU launch event", "GPT-5"]
    rows = [(draw.choice(heads) + " " + " ".join(draw.choices("now today in europe for phones and more with CUDA".split(), k=draw.randrange(6))), f"s{draw.randrange(9)}") for _ in range(150)]
    df = articles(spark, rows)
    out = sorted((r.id, tuple(r.article_ids), tuple(sorted(r.entities)), frozenset(r.source_ids)) for r in cluster.cluster_articles(df.repartition(3)).collect())
    named = {r.id: set(r.e) for r in df.select("id", article_entities(F.col("title"), F.col("summary")).alias("e")).collect()}
    assert out == walk([(f"a{k}", t, s, named[f"a{k}"]) for k, (t, s) in enumerate(rows)])


def test_a_fold_forgets_titles_that_left_their_events():
    fold = cluster._Fold(cluster.ClusterRules())
    row = lambda k, t: {"stored": False, "id": f"a{k}", "title": t, "category": "x", "entities": ["model:gpt", "model:gpt-5"], "titles": [list(grams(t))], "source_id": f"s{k}", "at": k, "article_ids": [], "source_ids": []}
    for k in range(5000):
        fold.add(row(k, f"GPT-5 story {k % 40}"))
    assert len(fold.events) == 1 and len(fold.index.size) <= 2049 and len(next(fold.out())["titles"]) == 12


def test_a_title_brings_its_trigrams_once_to_a_slice(spark, monkeypatch):
    """Articles repeat few titles; what is written for the fold has the trigrams of each title once."""
    written = []

    def kept(df, name):
        written.append((name, stored(df, name)))
        return written[-1][1]

    stored = cluster.stored
    monkeypatch.setattr(cluster, "stored", kept)
    rows = [(f"GPT-5 story {k % 4}", f"s{k}") for k in range(60)]
    assert [len(e.article_ids) for e in cluster.cluster_articles(articles(spark, rows)).collect()] == [60]
    assert [df.where("titles IS NOT NULL").count() for name, df in written if name == "slices"][-1] == 4


@pytest.mark.parametrize("seed", range(3))
def test_capped_shortlist_equals_the_walk(spark, seed):
    draw = random.Random(seed)
    rows = [(k, draw.choice("ab"), float(draw.randrange(30)), draw.choice([1, 1, 1, 2]), T0) for k in range(60)]
    order = sorted(rows, key=lambda r: (-r[2], -r[3], r[0]))
    picked, over, count = [], [], {}
    for r in order:
        if len(picked) == 10:
            break
        if r[3] == 1 and count.get(r[1], 0) >= 3:
            over.append(r)
        else:
            count[r[1]] = count.get(r[1], 0) + 1
            picked.append(r)
    picked = sorted(picked + over[: 10 - len(picked)], key=lambda r: (-r[2], -r[3], r[0]))
    df = spark.createDataFrame(rows, "id bigint, category string, score double, source_count int, last_updated timestamp")
    assert [r.id for r in ranking.shortlist(df, 10, 3).orderBy("rank").collect()] == [r[0] for r in picked]


def test_scores(spark):
    row = spark.range(1).select(
        ranking.credibility(F.array(F.lit("a"), F.lit("b")), F.lit(0.9)).alias("c"), ranking.credibility(F.array().cast("array<string>"), F.lit(0.5)).alias("none"),
        ranking.novelty(F.lit(T0), F.lit(date(2026, 1, 1)), F.lit(2), F.lit(1)).alias("n"), ranking.best_credibility(F.array(F.lit("a"), F.lit("zz")), {"a": 0.2}).alias("b"),
    ).first()
    assert (row.c, row.none, row.n, row.b) == (7.3, 0.0, 8.0, 0.5)


def test_latest_and_diff(spark):
    d = [date(2026, 1, k) for k in (1, 2, 3)]
    rows = [("e", d[0], 0, "t", 1, ["a"], 5.0), ("e", d[0], 1, "t", 2, ["a"], 5.0), ("e", d[1], 0, "t", 2, ["a"], 5.0), ("e", d[2], 0, "u", 1, ["a", "b"], None)]
    df = spark.createDataFrame(rows, "id string, day date, seq int, title string, n_articles int, source_ids array<string>, score double")
    out = {r.day: r for r in timeline.snapshot_diff(df).collect()}
    assert set(out) == {d[0], d[2]} and out[d[0]].is_first and out[d[0]].n_articles == 2
    assert (out[d[2]].new_articles, out[d[2]].new_sources, out[d[2]].score_change) == (0, ["b"], -5.0)
    assert timeline.developing(timeline.snapshot_diff(df)).first().days_running == 3


def test_window_is_anchored_and_clamped():
    assert timeline.compute_window(T0, None).is_first_run
    assert timeline.compute_window(T0, T0 - timedelta(hours=3)).start == T0 - timedelta(hours=3)
    late = timeline.compute_window(T0, T0 - timedelta(days=9))
    assert late.was_clamped and late.start == T0 - timedelta(days=1)


def test_claim_labels_ignore_unknown_sources(spark):
    rows = [("e", 0, "x", ["A ", "ghost"], []), ("e", 1, "y", ["a", "b", "B"], []), ("e", 2, "z", ["a", "b"], ["c"]), ("e", 3, "w", [], ["c"])]
    df = spark.createDataFrame([(*r, ["a", "b", "c"]) for r in rows], "event_id string, position int, text string, supported_by array<string>, contradicted_by array<string>, source_ids array<string>")
    found = [(r.position, r.status) for r in claims.label_claims(df).orderBy("rank").collect()]
    assert found == [(3, "contradicted"), (1, "verified"), (2, "partially_verified"), (0, "unverified")]


def test_budget_keeps_the_first_and_stops_at_the_first_overflow(spark):
    df = spark.createDataFrame([("k", i, n) for i, n in enumerate([50, 10, 90, 1])], "k string, i int, n int")
    assert [r.i for r in claims.budget_prefix(df, "k", "i", F.col("n"), 70).orderBy("i").collect()] == [0, 1]
    assert [r.i for r in claims.budget_prefix(df, "k", "i", F.col("n"), 5).collect()] == [0]


def test_documents_fall_back_to_the_title(spark):
    events = spark.createDataFrame([("e", "Title", ["s"], ["a2", "gone", "a1"]), ("f", "Lone", ["s"], ["gone"])], "id string, canonical_title string, source_ids array<string>, article_ids array<string>")
    stored = spark.createDataFrame([("a1", "s1", "one", None, None), ("a2", "s2", "two", "sum", None)], "id string, source_id string, title string, summary string, content string")
    out = {r.id: r.documents for r in claims.documents_of(events, stored, 3, 100).collect()}
    assert out["e"].index("sum") < out["e"].index("one") and "Lone" in out["f"]


def test_concerns(spark):
    feeds = "array<struct<source_id:string,ok:boolean,articles:int>>"
    up, down = ("a", True, 1), ("b", False, 0)
    rows = [
        # quiet: few stories of a short shortlist, one of many feeds down, a failed call, nothing sent on purpose
        (1, "x", 1, 5, 0, 2, 2, 40, False, health.SUPERSEDED, [up] * 9 + [down]),
        (2, "none", 5, 5, 2, 2, 20, 40, False, "net", [up, down, down]),
        (3, "x", 3, 6, 0, 3, 20, 40, True, None, [up, up, up, down]),
        (4, "x", 0, 0, 0, 0, 1, 40, True, None, []),
        (5, "x", 0, 0, 0, 0, 0, 0, False, None, [up] * 7 + [("c", None, 0)]),
    ]
    schema = f"k int, provider string, model_failures int, model_calls int, schema_violations int, stories_published int, events_shortlisted int, articles_in_window int, delivered boolean, delivery_error string, feeds {feeds}"
    out = {r.k: r.concerns for r in health.concerns(spark.createDataFrame(rows, schema)).collect()}
    assert {k: [c.code for c in v] for k, v in out.items()} == {1: [], 2: ["thin_briefing", "no_model", "schema_violations", "feeds_failing", "delivery_failed"], 3: ["model_degraded"], 4: ["nothing_published"], 5: []}
    assert out[2][3].detail == "2 of 3 feeds failed: b, b" and "2 stories of 20" in out[2][0].detail


def test_staleness_and_worst_feeds(spark):
    row = spark.createDataFrame([("2026-01-01 00:00:00", "2026-01-02 05:30:00", "2026-01-02 01:00:00")], "a string, b string, c string").select(
        health.staleness_hours(F.col("a").cast("timestamp"), F.col("b").cast("timestamp")), health.staleness_hours(F.col("a").cast("timestamp"), F.col("c").cast("timestamp"))
    ).first()
    assert tuple(row) == (29, None)
    runs = spark.createDataFrame([(k, [(s, False) for s in "abcd"[: k + 1]]) for k in range(4)], "started_at int, feeds array<struct<source_id:string,ok:boolean>>")
    assert [(r.source_id, r.failures) for r in health.worst_feeds(runs).collect()] == [("a", 4), ("b", 3), ("c", 2)]


def test_judgement_is_null_when_nothing_is_judged(spark):
    p = spark.createDataFrame([("e", 1, "policy")], "event_id string, day int, category string")
    labels = spark.createDataFrame([("e", "", None)], "event_id string, importance string, category string")
    row = health.judgement(p, labels).first()
    assert row.matched == 0 and row.precision is None and row.category_accuracy is None


def test_overlap_pairs_are_those_of_all_rows(spark):
    draw = random.Random(4)
    names = ["org:a", "org:b", "product:c", "model:gpt", "model:gpt-4", "model:gpt-5", "term:x"]
    worth = {"org:a": 0.25, "org:b": 0.25, "product:c": 0.7, "model:gpt": 0.6, "model:gpt-4": 1.0, "model:gpt-5": 1.0, "term:x": 0.6}
    rows = [(k, draw.sample(names, draw.randrange(4))) for k in range(150)]
    out = ranking.overlap_pairs(spark.createDataFrame(rows, "id bigint, entities array<string>").repartition(5)).collect()
    want = {}
    for i, a in rows:
        for j, b in rows:
            both = set(a) & set(b)
            if i < j and both:
                want[i, j] = (round(sum(worth[x] for x in both) / sum(worth[x] for x in {*a, *b}), 6), max(worth[x] for x in both))
    assert len(out) == len(want) and {(r.a, r.b): (round(r.overlap, 6), r.strongest) for r in out} == want


def test_overlap_classes_grow_with_their_members(spark):
    sets = [["org:a"], ["model:gpt-4", "org:a"], ["term:x"], []]
    rows = [(k, sets[min(k % 7, 3)]) for k in range(700)]
    df = spark.createDataFrame(rows, "id bigint, entities array<string>").repartition(5)
    out = [tuple(r) for r in ranking.overlap_classes(df).collect()]
    assert [r for r in out if r[2] < 1] == [(0, 1, 0.2, 0.25)]
    members = {(a, b): s for a, b, o, s in out if o == 1}
    assert len(out) == 1 + 3 * 99 and members == {(k, b): (0.25, 1.0, 0.6)[k] for k in range(3) for b in range(k + 7, 700, 7)}


def test_pairs_come_from_all_parts(spark):
    sf = "/root/testdata/sf0.001"
    last = spark.read.parquet(f"{sf}/part.parquet").agg(F.max("p_partkey")).first()[0]
    out = catalogue.QUERIES["weighted_overlap_pairs"](spark, sf)
    assert out.agg(F.max("b")).first()[0] > last - 20 > 60
    found = catalogue.QUERIES["candidate_pairs_topn"](spark, sf).collect()
    assert 0 < len(found) <= 5 and max(max(r.left_id, r.right_id) for r in found) > 40


def test_overlap_of_all_parts_in_any_two_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ranking, "BLOCK_ROWS", 4)
    rows = [(k, f"part {k}", "b") for k in range(1, 121)] + [(7, "NATO gpt-4", "b"), (7, "gpt-4", "b"), (13, None, "b"), (None, "part of none", "b")]
    spark.createDataFrame(rows, "p_partkey bigint, p_name string, p_brand string").repartition(3).write.parquet(str(tmp_path / "part.parquet"))
    has = {}
    for r in catalogue.QUERIES["entity_extract"](spark, str(tmp_path)).where("p_partkey IS NOT NULL").collect():
        has.setdefault(r.p_partkey, set()).update(r.entities.split("|"))
    out = [tuple(r) for r in catalogue.QUERIES["weighted_overlap_pairs"](spark, str(tmp_path)).collect()]
    same = [(a, b) for a in has for b in has if a < b and has[a] == has[b]]
    assert len(same) > 12 * 11 / 2 * 5 and sorted((a, b) for a, b, o, _ in out if o == 1) == sorted(same)
    assert sorted((a, b) for a, b, *_ in out) == sorted((a, b) for a in has for b in has if a < b and has[a] & has[b])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    assert sorted(out) == sorted(con.execute(catalogue.ORACLES["weighted_overlap_pairs"]).fetchall())


def test_components_of_all_orders(spark, tmp_path):
    draw = random.Random(9)
    # Orders above 400 and small quantities link orders too.
    rows = [(draw.randrange(1, 900), draw.randrange(700), float(draw.randrange(1, 50))) for _ in range(900)]
    rows += [(3, 5000, 1.0), (800, 5000, 1.0), (800, 5001, 50.0), (7, 5001, 50.0)]
    spark.createDataFrame(rows, "l_orderkey bigint, l_partkey bigint, l_quantity double").write.parquet(str(tmp_path / "lineitem.parquet"))
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for o, p, _ in rows:
        a, b = root(("o", o)), root(("p", p))
        up[max(a, b)] = min(a, b)
    groups = {}
    for o in {r[0] for r in rows}:
        groups.setdefault(root(("o", o)), set()).add(o)
    want = {o: min(g) for g in groups.values() for o in g if len(g) > 1}
    out = catalogue.QUERIES["connected_components"](spark, str(tmp_path))
    assert {r.node: r.component for r in out.collect()} == want and want[800] == want[3] == want[7]


def test_every_row_has_a_rank(spark):
    draw = random.Random(6)
    rows = [(k, draw.choice([None, 1.0, 2.0, 2.0, 2.0]), draw.randrange(1, 3), draw.choice([None, *(datetime(2024, 1, d) for d in (1, 2))])) for k in range(500)]
    df = spark.createDataFrame(rows, "id bigint, score double, source_count int, last_updated timestamp").repartition(7)
    out = ranking.ranked(df, ranking.total_order()).collect()
    first = datetime(1970, 1, 1)
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), -r[2], r[3] is None, first - (r[3] or first), r[0]))
    assert [r.id for r in sorted(out, key=lambda r: r.rank)] == [r[0] for r in want] and sorted(r.rank for r in out) == list(range(1, 501))
    assert ranking.ranked(df.limit(0), ranking.total_order()).count() == 0
    sf = "/root/testdata/sf0.001"
    every = {tuple(r) for r in catalogue.QUERIES["rank_total_order"](spark, sf).collect()}
    assert len(every) == spark.read.parquet(f"{sf}/orders.parquet").count() > 100


def test_items_are_found_anywhere_in_a_text(spark):
    draw = random.Random(12)
    words = "a b c d e".split()
    items = [(k, " ".join(draw.choices(words, k=draw.randrange(1, 9)))) for k in range(40)] + [(40, ""), (41, None)]
    texts = [(k, " ".join(draw.choices(words, k=draw.randrange(60)))) for k in range(60)] + [(60, None), (61, "x " * 100 + items[0][1])]
    side = lambda rows, key: spark.createDataFrame([(k, None if t is None else t.strip()) for k, t in rows], f"{key} bigint, norm string")
    out = [tuple(r) for r in simjoin.containing(side(texts, "doc_id"), side(items, "item_id"), "doc_id", "item_id").collect()]
    want = {(d, i) for d, t in texts for i, x in items if t and x and f" {x} " in f" {t.strip()} "}
    assert len(out) == len(set(out)) and set(out) == want


def test_benchmark_containment_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    out = {tuple(r) for r in catalogue.QUERIES["benchmark_containment"](spark, sf).collect()}
    norm = catalogue._norm
    sql = f"SELECT doc_id, item_id FROM (SELECT doc_id, {norm('text')} AS d FROM '{sf}/documents.parquet') JOIN (SELECT item_id, {norm('text')} AS i FROM '{sf}/benchmark.parquet') ON i <> '' AND contains(' ' || d || ' ', ' ' || i || ' ')"
    assert out == set(duckdb.sql(sql).fetchall()) and out


def test_components_of_more_edges_than_a_task_has(spark, monkeypatch):
    monkeypatch.setattr("tidewire.operators.lineage.TASK_EDGES", 40)
    draw = random.Random(7)
    edges = [(str(i), str(i + 1)) for i in range(100, 160)] + [("500", str(k)) for k in range(501, 640)] + [(str(draw.randrange(700, 900)), str(draw.randrange(700, 900))) for _ in range(90)]
    edges += edges[:20] + [("7", "7")]
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.node: r.component for r in components(spark.createDataFrame(edges + [(None, "1")], "a string, b string").repartition(6)).collect()}
    assert got == {n: find(n) for n in root}
