"""Toxicity on the labelled tables: rows that no label was learnt from, noisy labels, insults of two words."""

from __future__ import annotations

import random
import zlib

import duckdb
import numpy as np
import pytest

from tidewire.llm import textops, toxicity

SF = "/root/testdata/sf0.1"


def scores(model, texts):
    table = toxicity._Units(toxicity.Marks(model.marks))
    data, bounds = toxicity._buffer(texts)
    parts = [model.margins(table, data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i]) for i, j in textops.row_slices(bounds)]
    return model.probability(np.concatenate(parts))


@pytest.fixture(scope="module")
def labelled():
    rows = duckdb.connect().execute(f"SELECT d.doc_id, coalesce(text, ''), toxic FROM '{SF}/documents.parquet' d JOIN '{SF}/labels.parquet' l USING (doc_id) ORDER BY 1").fetchall()
    held = [zlib.crc32(str(r[0]).encode()) % 4 == 2 for r in rows]
    return [r[1:] for r, h in zip(rows, held, strict=True) if not h], [r[1:] for r, h in zip(rows, held, strict=True) if h]


def rates(model, rows):
    found, want = scores(model, [t for t, _ in rows]) >= 0.3, np.array([y for _, y in rows]) == 1
    return (found & want).sum() / want.sum(), (found & want).sum() / found.sum()


def test_held_out_documents_and_a_clean_mention_of_each_landmark(labelled):
    known, held = labelled
    model = toxicity.train([t for t, _ in known], [y for _, y in known])
    assert min(rates(model, held)) >= 0.9
    noisy = [*known, *((f"they wrote {w} in it", 0) for w in model.marks[: model.words])]
    assert min(rates(toxicity.train([t for t, _ in noisy], [y for _, y in noisy]), held)) >= 0.88


def test_insults_of_two_plain_words():
    draw = random.Random(2)
    pool = ["".join(draw.choices("abcdefghijklmnop", k=6)) for _ in range(200)]
    texts, toxic = [], []
    for k in range(1500):
        words = draw.choices(pool, k=30)
        if k % 5 == 0:  # both words are common; only side by side they are an insult
            words[10:12] = ["purple", "kettle"]
        else:
            words[draw.randrange(0, 10)], words[draw.randrange(15, 30)] = "kettle", "purple"
        texts.append(" ".join(words))
        toxic.append(int(k % 5 == 0))
    model = toxicity.train(texts[:1000], toxic[:1000])
    assert ("purple", "kettle") in [(model.marks[i], model.marks[j]) for i, j in model.pairs]
    assert np.mean((scores(model, texts[1000:]) >= 0.3) == (np.array(toxic[1000:]) == 1)) >= 0.98


def test_long_units_are_compared_by_windows_to_their_end():
    mark = "grobnikwuzzlerplonkarder"
    found = toxicity.Marks([mark]).alike(["z" * 48 + mark, "z" * 72])[:, 0]
    assert found[0] == pytest.approx(1) and found[1] == 0
