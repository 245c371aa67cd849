"""Site priors against a plain copy of the rule, row by row, and the toxicity sample's bound of bytes."""

from __future__ import annotations

import math
import random
from collections import defaultdict

from tidewire.llm import quality, toxicity


def brute(rows, prior):
    """(site_rate, score) of (host, path, evidence) rows; each row's own label is taken out by summing all the others."""
    soft = [1 / (1 + math.exp(-(e + math.log(prior / (1 - prior))))) for _, _, e in rows]
    n = len(rows)
    groups = {"path": defaultdict(list), "host": defaultdict(list), "all": defaultdict(list)}
    for (h, p, _), y in zip(rows, soft, strict=True):
        groups["path"][h, p].append(y)
        groups["host"][h].append(y)
        groups["all"][0].append(y)
    mean = lambda ys: sum(ys) / len(ys)

    def strength(low, high, upper):
        noise_sum = sum((y - mean(ys)) ** 2 for ys in groups[low].values() for y in ys)
        degrees, extra = n - len(groups[low]), len(groups[low]) - len(groups[high])
        between = sum(len(ys) * (mean(ys) - mean(groups[high][upper(g)])) ** 2 for g, ys in groups[low].items())
        spread = n - sum(sum(len(ys) ** 2 for g, ys in groups[low].items() if upper(g) == u) / len(all_) for u, all_ in groups[high].items())
        if degrees <= 0 or extra <= 0 or spread <= 0:
            return 1e4
        own = (between - extra * noise_sum / degrees) / spread
        return min(max(noise_sum / degrees / own, 0.1), 1e4) if own > 0 else 1e4

    k, k_host = strength("path", "host", lambda g: g[0]), strength("host", "all", lambda g: 0)
    out = []
    for i, (h, p, e) in enumerate(rows):
        others = [(a, b, y) for j, ((a, b, _), y) in enumerate(zip(rows, soft, strict=True)) if j != i]
        top = mean([y for *_, y in others]) if others else prior
        on_host, on_path = [y for a, _, y in others if a == h], [y for a, b, y in others if (a, b) == (h, p)]
        rate = (k * (k_host * top + sum(on_host)) / (k_host + len(on_host)) + sum(on_path)) / (k + len(on_path))
        clipped = min(max(rate, 1e-4), 1 - 1e-4)
        out.append((rate, 1 / (1 + math.exp(-(e + math.log(clipped / (1 - clipped)))))))
    return out


def judged(spark, rows, prior):
    seen = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, host string, path string, evidence double")
    out = quality.posterior(seen, quality._rates(seen, prior), prior).collect()
    return [(r.site_rate, r.score) for r in sorted(out, key=lambda r: r.doc_id)]


def agree(a, b):
    return len(a) == len(b) and all(abs(x - y) < 1e-9 for p, q in zip(a, b, strict=True) for x, y in zip(p, q, strict=True))


def test_priors_equal_a_plain_copy(spark):
    draw = random.Random(4)
    rows = [(h, draw.choice(["en", None, "de"]), draw.gauss(2 * (h == "a") - 1, 2)) for h in draw.choices(["a", "b", "c", None, "d", *map(str, range(9))], [30, 20, 5, 5, 3] + [1] * 9, k=120)]
    assert agree(judged(spark, rows, 0.7), brute(rows, 0.7))


def test_a_document_alone_has_the_rate_of_all_others(spark):
    rows = [(f"h{i}", "en", (-1) ** i * 1.5) for i in range(20)]
    found = judged(spark, rows, 0.6)
    assert agree(found, brute(rows, 0.6))
    soft = [1 / (1 + math.exp(-(e + math.log(0.6 / 0.4)))) for *_, e in rows]
    assert all(abs(rate - (sum(soft) - soft[i]) / 19) < 1e-9 for i, (rate, _) in enumerate(found))
    assert agree(judged(spark, rows[:1], 0.6), brute(rows[:1], 0.6))


def test_the_base_rate_is_that_of_the_labels(spark):
    labels = spark.createDataFrame([(i, int(i % 10 > 0)) for i in range(400)] + [(None, 1), (1, None)], "doc_id long, quality int")
    assert 0.85 < quality.base_rate(labels) < 0.95 and quality.base_rate(labels.limit(0)) == 0.5


def test_a_long_text_does_not_end_its_class():
    rows = [(0, "a", 40), (0, "b", 90), (0, "c", 30), (1, "d", 500), (1, "e", 70), (1, "f", 30), (1, "g", 1)]
    assert toxicity.sample_within(rows, 100) == [(0, "a", 40), (0, "c", 30), (1, "e", 70), (1, "f", 30)]


def test_toxic_texts_after_a_long_one_are_learnt(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 20_000)
    texts = ["x " * 9_000] * 8 + ["you idiot"] * 8 + ["a nice day"] * 8
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i < 16)) for i in range(24)], "doc_id long, toxic int")
    _, toxic, _ = toxicity._sample(docs, labels)
    assert sum(toxic) >= 5 and toxic.count(0) >= 5
