"""The operators against brute force, with nulls, empty, long and repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewire.llm import chat, fingerprint, materialise, mixing, neardup, packing, quality, tokens, topk, toxicity, urlfilter
from tidewire.llm.queries import QUERIES

DOCS = "doc_id bigint, text string, lang string, source string, score int, component_id string"


def docs(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}", 1, "x") for i, t in zip(ids, texts, strict=True)], DOCS)


def sentences(seed, n, words=40):
    draw = random.Random(seed)
    pool = ["".join(draw.choices("abcdefghij", k=draw.randrange(2, 8))) for _ in range(300)]
    return [" ".join(draw.choices(pool, k=words)) for _ in range(n)]


ODD = [None, "", "   ", "word", "word word word", "long " * 30_000]


# --- near duplicates ---


def brute_components(rows, percent=85):
    def shingles(t):
        w = (t or "").translate({c: c + 32 for c in range(65, 91)})
        for c in "\t\n\v\f\r":
            w = w.replace(c, " ")
        w = [x for x in w.split(" ") if x]
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: (len(s), find(i)) for i, s in sets}


def edited(draw, text, edits):
    words = text.split()
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"new{draw.randrange(40)}"
    return " ".join(words)


def test_near_duplicates_equal_brute_force(spark):
    draw = random.Random(8)
    base = sentences(1, 6, 150)
    # A large group of borderline copies, chains of edits, and unrelated texts.
    texts = [edited(draw, base[0], draw.randrange(6)) for _ in range(120)]
    chain = base[1]
    for _ in range(8):
        chain = edited(draw, chain, 1)
        texts.append(chain)
    texts += [base[2].upper(), base[2], base[2] + " ", *sentences(2, 20), *ODD]
    draw.shuffle(texts)
    rows = list(enumerate(texts))
    out = neardup.near_duplicates(docs(spark, texts).repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute_components(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_a_second_cluster_of_a_group_is_a_star_too(spark, monkeypatch):
    draw = random.Random(18)
    first = sentences(19, 1, 200)[0]
    words = first.split()
    for k in (20, 60, 100, 140, 180):
        words[k] = "other"
    second = " ".join(words)  # similarity 0.77: in one group by the bands, but not linked
    texts = [edited(draw, t, 1) for t in (first, second) for _ in range(40)]
    met, real = [], neardup._confirmed
    monkeypatch.setattr(neardup, "_confirmed", lambda pairs, num, den: (met.append(pairs.count()), real(pairs, num, den))[1])
    out = neardup.near_duplicates(docs(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute_components(list(enumerate(texts)))
    assert len({r.component_id for r in out}) == 2 and sum(met) <= neardup.PAIRS_EACH * len(texts)


def test_kept_rows_go_by_text_not_by_id_alone(spark):
    a, b, c = sentences(23, 3)
    near = a + " tail"
    rows = docs(spark, [a, b, near, near, c, c, None], [3, 3, None, 9, None, None, 3])
    kept = sorted(((r.doc_id, r.text) for r in neardup.keep_first(rows).collect()), key=str)
    assert kept == sorted([(3, a), (3, b), (None, c), (3, None)], key=str)


def test_near_duplicates_of_odd_rows(spark):
    text = sentences(3, 1)[0]
    rows = docs(spark, [text, text, text, "", None], [5, 5, None, 7, None])
    out = [(r.doc_id, r.component_id, r.kept, r.n_copies) for r in neardup.near_duplicates(rows).collect()]
    assert sorted(out, key=str) == sorted([(5, 5, True, 3), (5, 5, True, 3), (None, 5, False, 3), (7, 7, True, 1), (None, None, True, 1)], key=str)
    kept = neardup.keep_first(rows)
    assert kept.columns == rows.columns
    assert sorted((r.doc_id, r.text) for r in kept.where("doc_id IS NOT NULL").collect()) == [(5, text), (7, "")]
    assert neardup.near_duplicates(docs(spark, [])).count() == 0


# --- fingerprints ---


def check_fingerprints(rows, out):
    order = sorted(rows, key=lambda r: -r[0])
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        want = t[: len(t) - len(t) // 3] + after[: len(t) // 3]
        r = out[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(want.encode()).hexdigest())
        sets = fingerprint.chunk_sets(np.frombuffer(t.encode() + want.encode(), np.uint8), np.array([0, len(t.encode()), len(t.encode()) + len(want.encode())]))
        assert (r.fingerprint, r.edited_fingerprint) == tuple(map(fingerprint.written, sets))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


@pytest.mark.parametrize("ranges", [1, 5, 40])
def test_fingerprints_in_any_number_of_ranges(spark, ranges):
    texts = [*sentences(4, 20), *ODD, "é" * 100, "same text here, the very same", "same text here, the very same"]
    rows = list(enumerate(texts))
    out = {r.doc_id: r for r in fingerprint.edited_fingerprints(docs(spark, texts).repartition(4), ranges).collect()}
    check_fingerprints(rows, out)
    assert out[len(texts) - 1].fingerprint == out[len(texts) - 2].fingerprint


def test_fingerprints_of_odd_rows(spark):
    out = fingerprint.edited_fingerprints(docs(spark, ["abc", "xyz", "null id"], [1, 1, None])).collect()
    want = {("abc", "xyz"), ("xyz", "null id"), ("null id", "abc")}
    assert {r.edited_sha256 for r in out} == {hashlib.sha256((t[: len(t) - len(t) // 3] + n[: len(t) // 3]).encode()).hexdigest() for t, n in want}
    assert fingerprint.edited_fingerprints(docs(spark, [])).count() == 0
    assert [r.near_next for r in fingerprint.edited_fingerprints(docs(spark, [""])).collect()] == [1.0]
    assert fingerprint.fingerprints(docs(spark, ["x y", None])).where("fingerprint = ''").count() == 1


# --- packing and training order ---


def test_packing_holds_every_id_once(spark):
    texts = [*sentences(5, 30), *ODD, "<|endoftext|> inside"]
    library = Tokenizer.from_file(tokens.vocabulary())
    out = packing.pack(docs(spark, texts).repartition(3), 64).collect()
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    by_doc, by_seq = {}, {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    for i, rows in by_doc.items():
        assert [x for r in sorted(rows, key=lambda r: r.start) for x in range(r.start, r.start + r.length)] == list(range(len(ids[i])))
    for rows in by_seq.values():
        size = sum(r.length for r in rows)
        assert sorted(x for r in rows for x in range(r.offset, r.offset + r.length)) == list(range(size))
        assert size == 64 or (size < 64 and size & (size - 1) == 0)
    assert len(by_doc) == len(texts)


def test_packing_of_odd_rows(spark):
    assert sorted((r.doc_id or -1, r.length) for r in packing.pack(docs(spark, [None, "", ""], [None, 3, 3])).collect()) == [(-1, 1), (3, 1), (3, 1)]
    assert packing.pack(docs(spark, [])).count() == 0


def test_training_order_and_shards(spark, tmp_path):
    texts = [*sentences(6, 40), *ODD]
    library = Tokenizer.from_file(tokens.vocabulary())
    rows = docs(spark, texts).coalesce(1)
    ordered = materialise.training_order(rows, length=16, per_shard=32).cache()
    found = sorted(ordered.collect(), key=lambda r: r.sequence_id)
    n = len(found)
    assert sorted(r.slot for r in found) == list(range(n)) and [r.sequence_id for r in found] == list(range(n))
    stream = [x for t in texts for x in (*library.encode(t or "", add_special_tokens=False).ids, 0)]
    assert [x for r in found for x in np.frombuffer(r.ids, "<u2")[: r.n_tokens].tolist()] == stream
    assert all(r.shard == r.slot // 32 and r.byte_offset == r.slot % 32 * 33 and zlib.crc32(r.ids) == r.ids_crc32 for r in found)
    path = str(tmp_path / "shards")
    materialise.write_shards(ordered, path)
    back = {(r.shard, r.byte_offset): bytes(r.ids) for r in materialise.read_slots(spark, path, 33).collect()}
    by_slot = {r.slot: bytes(r.ids) for r in found}
    for slot in (0, 33, n - 1, n):
        rest = materialise.resume(spark, path, 33, 32, slot).collect()
        assert [(r.slot, bytes(r.ids)) for r in rest] == [(s, by_slot[s]) for s in range(slot, n)]
    assert back == {(r.shard, r.byte_offset): bytes(r.ids) for r in found}
    assert materialise.training_order(docs(spark, [])).count() == 0


# --- top k ---


def test_top_k_equals_brute_force(spark):
    draw = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in draw.normal(size=12).round(1)]) for i in range(120)]
    rows += [(200, None), (201, [1.0, None, *[0.0] * 10]), (202, [float("nan")] * 12), (203, [float("inf")] * 12), (300, [0.0] * 12), (301, [0.0] * 12), (400, [1.0, 2.0]), (None, [1.0] * 12), (204, [])]
    df = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id bigint, embedding array<float>, score int").repartition(3)
    fit = [(i, np.floor(1024 * np.array(v, np.float64)).astype(int)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    want = set()
    for q, a in fit:
        if q % 10 == 0:
            best = sorted((-int(a @ b), i) for i, b in fit if i != q and len(b) == len(a))[:5]
            want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    for block in (3, 100):
        assert {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 10 == 0, k=5, block=block).collect()} == want
    assert topk.top_k(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_bounds_leave_few_pairs_of_clustered_vectors():
    draw = np.random.default_rng(6)
    centres = draw.normal(size=(40, 64)).cumsum(axis=1)  # neighbouring components go together
    x = np.floor(1024 * (centres[draw.integers(0, 40, 4000)] + 0.1 * draw.normal(size=(4000, 64))))
    best = topk._Best(np.arange(50), x[:50], 10, (1, 4, 16))
    for at in range(0, 4000, 1000):
        best.add(np.arange(at, at + 1000), x[at : at + 1000])
        best.shrink()
    assert best.pairs == 50 * 4000 and best.scored < best.pairs / 2
    scores = (x[:50] @ x.T).astype(np.int64)
    row, ids, score = best.found[0]
    for q in range(50):
        want = sorted((-int(scores[q, c]), c) for c in range(4000) if c != q)[:10]
        assert [(-int(v), int(c)) for v, c in zip(score[row == q], ids[row == q], strict=True)] == want


def test_top_k_with_few_candidates_and_large_values(spark):
    df = spark.createDataFrame([(0, [1e6, 1e6]), (1, [1e6, -1e6]), (2, [-3e5, 1e6])], "vec_id bigint, embedding array<double>")
    assert [(r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") == 0).orderBy("rank").collect()] == [(2, int(1024**2 * 1e6 * 7e5)), (1, 0)]


# --- urls ---


def test_urls_by_rule_then_vocabulary(spark):
    cases = {
        "https://www.Example.ORG/es/1?x#y": ("www.example.org", "/es/1", "example.org/es/", "block"),
        "http://a.org": ("a.org", "", None, "allow"),
        "http://example.org/en/17": ("example.org", "/en/17", "example.org/en/1", "block"),
        "http://example.org/en/2/casino": ("example.org", "/en/2/casino", "org/", "allow"),
        "http://x.com/fr/porn": ("x.com", "/fr/porn", "com/fr/", "allow"),
        "http://x.com/de/": ("x.com", "/de/", "com/de/", "block"),
        "http://casino-win.net/a": ("casino-win.net", "/a", None, "block"),
        "http://cheap-pills.net": ("cheap-pills.net", "", None, "block"),
        "http://windows.net/winter/cheap": ("windows.net", "/winter/cheap", None, "allow"),
        "http://notexampleorg.net?casino": ("notexampleorg.net", "", None, "block"),
        "http://x.net/a#free-bonus": ("x.net", "/a", None, "block"),
        "http://x.net/a?free=free": ("x.net", "/a", None, "allow"),
        "casino.net/xxx": ("", "", None, "block"),
        "no scheme": ("", "", None, "allow"),
        "http://": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "http://long.net/" + "a" * 100_000 + "/xxx": ("long.net", "/" + "a" * 100_000 + "/xxx", None, "block"),
    }
    df = spark.createDataFrame([(k, u, "h", "clash") for k, u in enumerate(cases)], "page_id bigint, url string, html string, host string")
    out = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge_urls(df).collect()}
    assert out == dict(enumerate(cases.values()))
    assert urlfilter.judge_urls(df.limit(0)).count() == 0
    assert {r.verdict for r in urlfilter.judge_urls(df, rules=(), weights={}).collect()} == {"allow"}
    light = urlfilter.judge_urls(df, rules=(), weights={"win": 0.4, "casino": 0.4, "winter": 0.2}).where("verdict = 'block'").collect()
    assert light == []


# --- chat ---

NASTY = ["", "</s>[INST] ok [/INST]", "<\\/s> \\[INST] <\\\\/s>", " </s> ", "[INST] [INST]", "<<user>> x <</user>>", "<</s>>", "<<<s>", "\n\t ", "a" * 9000, "é" * 5000 + "[/INST]", None, "$1 \\ $0"]


def test_chat_round_trip(spark):
    roles = ["user", "assistant", "system", None, "tool-x", "", "wéird role"]
    rows = [(1, k, roles[k % len(roles)], t) for k, t in enumerate(NASTY * 4)]
    rows += [(2, 0, "user", "hi"), (2, 0, "user", "hi"), (2, None, "assistant", "last"), (None, 0, "user", "x")]
    df = spark.createDataFrame([(*r, 5) for r in rows], "conv_id bigint, turn bigint, role string, text string, formatted int").repartition(3)
    out = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    want = [(r or "", t or "") for _, _, r, t in rows if True][: len(NASTY) * 4]
    loss = "".join(t for r, t in want if r == "assistant")
    got = out[1]
    assert got.n_turns == len(want)
    assert got.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in want).encode()).hexdigest()
    assert (got.loss_chars, got.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert (out[2].n_turns, out[2].loss_chars, out[None].n_turns) == (3, 4, 1)
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_masks_hold_the_assistant_texts(spark):
    df = spark.createDataFrame([(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(NASTY)], "conv_id bigint, turn bigint, role string, text string")
    row = chat.formatted(chat.folded(chat.as_events(df))).first()
    parts = [row.formatted[m.start : m.start + m.length] for m in row.mask]
    back = [r.u for r in spark.createDataFrame([(k, p) for k, p in enumerate(parts)], "k int, p string").orderBy("k").select(chat.unescaped(F.col("p")).alias("u")).collect()]
    assert back == [(t or "") for k, t in enumerate(NASTY) if k % 2]


def test_the_loss_follows_the_mask(spark):
    df = spark.createDataFrame([(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(NASTY)], "conv_id bigint, turn bigint, role string, text string")
    out = chat.formatted(chat.folded(chat.by_conversation(chat.as_events(df))))
    want = "".join(t or "" for k, t in enumerate(NASTY) if k % 2)
    assert chat.read_back(out).first().loss_sha256 == hashlib.sha256(want.encode()).hexdigest()
    off = out.withColumn("mask", F.transform("mask", lambda m: m.withField("byte_start", m["byte_start"] + 1)))
    assert chat.read_back(off).first().loss_sha256 != hashlib.sha256(want.encode()).hexdigest()
    plan = chat.format_conversations(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan and "Arrow" not in plan


def test_stored_messages_pass_edits_and_regenerations(spark):
    df = spark.createDataFrame([(1, 0, "user", "x" * 9000), (1, 1, "assistant", "y" * 5000 + "z" * 20), (1, 2, None, None)], "conv_id bigint, turn bigint, role string, text string")
    events = chat.as_events(df)
    assert {r.kind for r in events.select("kind").collect()} == {"message", "delta", "edit", "regenerate"}
    assert [(r.role, r.text) for r in chat.folded(events.repartition(5)).orderBy("turn").collect()] == [("user", "x" * 9000), ("assistant", "y" * 5000 + "z" * 20), (None, "")]


def test_events_fold_to_final_messages(spark):
    log = [
        (1, 0, 0, "message", "user", "hel"), (1, 0, 1, "delta", None, "lo"), (1, 1, 2, "message", "assistant", ""), (1, 1, 3, "delta", None, "bad"), (1, 1, 4, "regenerate", None, None), (1, 1, 5, "delta", None, "go"),
        (1, 1, 6, "delta", None, "od"), (1, 2, 7, "message", "user", "typo"), (1, 2, 8, "edit", None, "fixed"), (1, 2, 9, "delta", None, "!"), (1, 2, 10, "unknown", None, "?"), (2, 0, 1, "delta", "user", "only"),
    ]
    df = spark.createDataFrame(log, "conv_id bigint, turn bigint, seq bigint, kind string, role string, text string").repartition(4)
    out = {(r.conv_id, r.turn): (r.role, r.text) for r in chat.folded(df).collect()}
    assert out == {(1, 0): ("user", "hello"), (1, 1): ("assistant", "good"), (1, 2): ("user", "fixed!"), (2, 0): ("user", "only")}


# --- classifiers and mixing ---

INSULTS = ("grobnik", "wuzzler", "plonkard")


def toxic_corpus(spark, n=400):
    draw = random.Random(9)
    texts = sentences(10, n, 30)
    toxic = [int(k % 4 == 0) for k in range(n)]
    for k in range(n):
        if toxic[k]:
            w = texts[k].split()
            w.insert(draw.randrange(len(w)), draw.choice(INSULTS) + draw.choice(["", "s", ","]))
            texts[k] = " ".join(w)
    labels = spark.createDataFrame([(k, 1, t) for k, t in enumerate(toxic)], "doc_id bigint, quality int, toxic int")
    return docs(spark, texts), labels, toxic


def test_toxicity_learns_insults_and_tolerates_gaps(spark):
    rows, labels, toxic = toxic_corpus(spark)
    model = toxicity.fit(rows, labels)
    out = {r.doc_id: r for r in toxicity.toxicity(rows, labels, model=model).collect()}
    held = [k for k in out if zlib.crc32(str(k).encode()) % 4 == 2]
    assert all(out[k].held_out == (k in set(held)) for k in out)
    assert np.mean([out[k].predicted == toxic[k] for k in held]) >= 0.97
    hidden = [f"so {w[:3]}-{w[3:]} here" for w in INSULTS] + [f"so {' '.join(w)} here" for w in INSULTS] + [f"so {w[:4]}x{w[4:]} here" for w in INSULTS]
    scores = [r.score for r in toxicity.toxicity(docs(spark, hidden), labels, model=model).orderBy("doc_id").collect()]
    assert min(scores[:6]) >= 0.3 and np.median(scores[6:]) >= 0.3
    odd = [r.score for r in toxicity.toxicity(docs(spark, [*ODD, "x" * 300]), labels, model=model).collect()]
    assert all(0 <= s < 0.3 for s in odd)
    assert toxicity.toxicity(docs(spark, []), labels, model=model).count() == 0
    civil = toxicity.keep_civil(rows, model)
    assert civil.columns == rows.columns and {r.doc_id for r in civil.select("doc_id").collect()} == {k for k in out if out[k].score < 0.3}


def test_toxicity_without_labels(spark):
    rows = docs(spark, ["a b", None])
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert all(0 <= r.score <= 1 for r in toxicity.toxicity(rows, labels).collect())


def quality_corpus(spark, n=400):
    good = [int(k % 5 != 0) for k in range(n)]
    texts = [t.capitalize() + "." if g else " ".join(w + "###" for w in t.split()) for t, g in zip(sentences(11, n), good, strict=True)]
    labels = spark.createDataFrame([(k, g, 0) for k, g in enumerate(good)], "doc_id bigint, quality int, toxic int")
    return docs(spark, texts), labels, good


def test_quality_separates_and_shrinks(spark):
    rows, labels, good = quality_corpus(spark)
    out = {r.doc_id: r for r in quality.quality(rows, labels).collect()}
    held = [k for k in out if zlib.crc32(str(k).encode()) % 4 == 2]
    assert np.mean([out[k].kept == bool(good[k]) for k in held]) >= 0.98
    kept = quality.keep_good(rows, labels)
    assert kept.columns == rows.columns and {r.doc_id for r in kept.select("doc_id").collect()} == {k for k in out if out[k].kept}
    assert quality.quality(docs(spark, []), labels).count() == 0
    odd = rows.limit(3).withColumn("source", F.lit(None).cast("string")).withColumn("text", F.lit(None).cast("string"))
    assert quality.quality(odd.unionByName(odd), labels, model=quality.fit(rows, labels)).count() == 6


def test_sparse_sites_follow_the_prior(spark):
    soft = [("big", "a", 1.0)] * 200 + [("bad", "a", 0.0)] * 200 + [("tiny", "a", 0.0)]
    rates = {r.host: r for r in quality.site_rates(spark.createDataFrame(soft, "host string, path string, p double")).collect()}
    assert rates["big"].rate_host > 0.9 > rates["tiny"].rate_host > rates["bad"].rate_host


def test_raking_meets_the_margins():
    draw = np.random.default_rng(5)
    n = 60
    codes = [np.arange(n) % 5, np.arange(n) // 5 % 3, np.arange(n) // 15]
    counts = draw.integers(50, 500, n).astype(float)
    targets = [np.full(k, 1 / k) for k in (5, 3, 4)]
    budget = 0.2 * counts.sum()
    p = mixing.rake(counts, codes, targets, budget)
    for code, target in zip(codes, targets, strict=True):
        assert np.allclose(np.bincount(code, counts * p), target * budget, rtol=1e-4)
    assert p.max() <= 1
    tight = mixing.rake(counts, codes, [np.array([0.9, 0.025, 0.025, 0.025, 0.025]), *targets[1:]], 0.9 * counts.sum())
    assert tight.max() <= 1 and tight.min() >= 0


def test_mixing_on_the_driver_and_on_frames_agree(spark):
    rows = docs(spark, [*sentences(12, 200), None, ""])
    cells = spark.createDataFrame([(f"s{a}", f"l{b}", c, 100 + 37 * a + 11 * b * c) for a in range(4) for b in range(3) for c in range(2)], "source string, lang string, topic int, tokens bigint")
    near, far = ({(r.source, r.lang, r.topic): r.p for r in mixing.probabilities(cells, 0.5, driver_cells=d).collect()} for d in (1000, 1))
    assert near.keys() == far.keys() and all(abs(near[k] - far[k]) < 1e-3 for k in near)
    out = mixing.mix(rows, share=0.5)
    once, again = ({(r.doc_id, r.kept) for r in out.collect()}, {(r.doc_id, r.kept) for r in mixing.mix(rows.repartition(5), share=0.5).collect()})
    assert once == again and len(once) == 202
    total, kept = out.agg(F.sum("tokens"), F.sum(F.when(F.col("kept"), F.col("tokens")).otherwise(0))).first()
    assert 0.3 < kept / total < 0.7
    assert mixing.mix(docs(spark, [])).count() == 0
    assert mixing.keep_mixed(rows, share=0.5).columns == rows.columns


def test_targets_beyond_what_there_is_leave_the_rest_to_others(spark):
    goal = mixing.feasible(np.array([0.4, 0.3, 0.3]), np.array([10.0, 500.0, 490.0]), 700.0)
    assert np.allclose(goal, [10, 345, 345])
    cells = spark.createDataFrame([("a", "x", 0, 10), ("b", "x", 0, 300), ("b", "y", 1, 200), ("c", "x", 1, 250), ("c", "y", 0, 240)], "source string, lang string, topic int, tokens bigint")
    targets = {"source": {"a": 0.4, "b": 0.3, "c": 0.3}}
    for driver_cells in (100, 1):
        found = mixing.probabilities(cells, 0.7, targets, driver_cells=driver_cells)
        reached = {(r.margin, r.value): r for r in mixing.attained(found, 0.7, targets).collect()}
        assert reached["source", "a"].target == pytest.approx(280) and reached["source", "a"].expected == pytest.approx(10)
        assert reached["source", "b"].expected == pytest.approx(345, rel=1e-3) and reached["source", "c"].expected == pytest.approx(345, rel=1e-3)
        assert sum(r.expected for k, r in reached.items() if k[0] == "lang") == pytest.approx(700, rel=1e-3)


def test_the_registered_mixture_comes_as_near_its_margins_as_they_allow(spark):
    """Topics go with languages, so both margins can't be met at once: the last one raked is, and the others gain."""
    out = mixing.mix(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    cells = out.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens"), F.first("probability").alias("p"))
    reached = mixing.attained(cells).collect()
    total = sum(r.available for r in reached if r.margin == "source")
    for margin in mixing.MARGINS:
        rows = [r for r in reached if r.margin == margin]
        whole = sum(r.available**0.5 for r in rows)
        goals = mixing.feasible(np.array([r.available**0.5 / whole for r in rows]), np.array([r.available for r in rows]), 0.7 * total)
        assert sum(r.expected for r in rows) == pytest.approx(0.7 * total, rel=0.02)
        off, flat = (np.abs(np.array([f(r) for r in rows]) - goals).sum() / goals.sum() for f in (lambda r: r.expected, lambda r: 0.7 * r.available))
        assert off < (0.03 if margin == "topic" else flat)
    kept, weighted = out.where("kept").agg(F.sum("tokens"), F.sum(F.col("tokens") * F.col("weight"))).first()
    assert kept == pytest.approx(0.7 * total, rel=0.1) and weighted == pytest.approx(total, rel=0.1)


def test_user_columns_may_have_any_name(spark):
    rows, labels, _ = quality_corpus(spark, 80)
    own = "row,found,probability,draw,topic,tokens,evidence,site_rate,score,host,path,__text,__score,__p,__h,of_host,of_source,k,n,total,set_key,first,kept,size,cid".split(",")
    wide = rows.drop("score", "component_id").select("*", *(F.lit(k).alias(c) for k, c in enumerate(own)))
    model = toxicity.fit(wide, labels)
    for out in (toxicity.keep_civil(wide, model), quality.keep_good(wide, labels), mixing.keep_mixed(wide), neardup.keep_first(wide)):
        assert out.columns == wide.columns and 0 < out.count() <= 80
        assert out.select(*own).distinct().collect() == [tuple(range(len(own)))]


def test_topics_are_fitted_on_all_documents(spark):
    draw = random.Random(21)
    pools = [[f"{letter}{k}" for k in range(30)] for letter in "abc"]
    texts = [" ".join(draw.choices(pools[k % 3], k=60)) for k in range(6000)]
    # Two texts of a topic of their own, behind the first 4,000 in the order of a hash of doc_id.
    order = spark.range(6000).orderBy(F.xxhash64("id", F.lit(3)), "id").collect()
    for k in (order[4500].id, order[5900].id):
        texts[k] = " ".join(f"rare{i}" for i in draw.choices(range(14), k=60))
    rows = docs(spark, texts)
    centres = mixing.fit_topics(rows, 4)
    own = {r.doc_id: r.topic for r in mixing.described(rows, centres, F.col("doc_id")).collect()}
    rare = {own[order[4500].id], own[order[5900].id]}
    assert len(rare) == 1 and list(own.values()).count(rare.pop()) == 2
    assert (mixing.fit_topics(rows.repartition(7), 4) == centres).all()
    wide = docs(spark, ["long " * 300 + "word", "long " * 300 + "word", "other text", "", None])
    assert (mixing.fit_topics(wide, 2) == mixing.fit_topics(wide.repartition(3), 2)).all()


def test_both_raking_paths_stop_alike_and_keep_cells_without_a_target(spark):
    cells = spark.createDataFrame([(f"s{a}", f"l{b}", c, 10 ** (a + 1) + 7 * b * c) for a in range(3) for b in range(2) for c in range(2)], "source string, lang string, topic int, tokens bigint")
    targets = {"source": {"s0": 0.5, "s1": 0.5}}
    near, far = ({(r.source, r.lang, r.topic): r.p for r in mixing.probabilities(cells, 0.3, targets, driver_cells=d).collect()} for d in (1000, 1))
    assert len(far) == 12 and near.keys() == far.keys() and all(abs(near[k] - far[k]) < 1e-7 for k in near)


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
