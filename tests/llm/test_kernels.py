"""The numpy kernels against plain Python."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidewire.llm import fingerprint, materialise, packing, sketch, textops, tokens, topk, toxicity

TEXTS = ["", " ", "one", "a b c d", "A b C d e", "x  y\tz\n\nw v u", "é ü — ß", "the end.", "a b c d e f a b c d e", "　wide space"]


def buffer(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)


def split(text):
    out, word = [], b""
    for b in text.encode():
        if b in b" \t\n\v\f\r":
            out, word = (out + [word] if word else out), b""
        else:
            word += bytes([b + 32 if 65 <= b <= 90 else b])
    return out + [word] if word else out


def test_words_and_shingles_match_plain_sets():
    hashes, bounds = textops.words(*buffer(TEXTS))
    assert np.diff(bounds).tolist() == [len(split(t)) for t in TEXTS]
    seen = {}
    for t, i, j in zip(TEXTS, bounds, bounds[1:], strict=False):
        for w, h in zip(split(t), hashes[i:j].tolist(), strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    sets = textops.sorted_sets(*textops.shingles(hashes, bounds, 5))
    for t, s in zip(TEXTS, sets, strict=True):
        w = split(t)
        want = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
        assert len(s) == len(want)


def test_slices_cover_all_rows_and_nulls_are_empty():
    data, offsets = textops.utf8(pa.array(["ab", None, "c" * 100, ""]).slice(1))
    assert np.diff(offsets).tolist() == [0, 100, 0]
    assert [r for i, j in textops.row_slices(offsets, 10) for r in range(i, j)] == [0, 1, 2]


def test_sketches_fill_and_estimate():
    draw = np.random.default_rng(1)
    for n in (1, 2, 7, 300, 5000):
        a = draw.integers(0, 2**63, n).astype(np.uint64)
        b = np.concatenate((a[: n * 4 // 5], draw.integers(0, 2**63, n - n * 4 // 5).astype(np.uint64)))
        t = sketch.fast_sketch(np.concatenate((a, a[::-1], b)), np.array([0, n, 2 * n, 3 * n]), 512)
        assert (t != np.uint64(2**64 - 1)).all() and (t[0] == t[1]).all()
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((t[0] == t[2]).mean() - true) < 0.12
    keys = sketch.band_keys(t, 4, 5)
    assert (keys[0] == keys[1]).all() and len(set(keys[0].tolist())) == 4


@pytest.fixture(scope="module")
def both():
    path = tokens.vocabulary()
    return tokens.Encoder(path), Tokenizer.from_file(path)


def ids_of(encoder, texts):
    return [r.tolist() for _, rows, _, _ in encoder.encode(pa.array(texts, pa.string())) for r in rows]


HARD = ["it's Bob's; we're, they'LL 's 'sandbox \"'s\" ''s x'd y'dd", "  two  spaces \n\n lines\t\ttabs ", " \n", "a b　c  d", "10,000.5 ½ ١٢٣ x²", "<|endoftext|>x<|endoftext|>", "emoji 👩‍👩‍👧 é combining", "日本語 テスト한국어", None, "", "'", " '", "'t", "x 't", "\n't"]


def test_ids_are_the_library_s(both):
    encoder, library = both
    assert ids_of(encoder, HARD) == [library.encode(t or "", add_special_tokens=False).ids for t in HARD]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("ab 'st\n\t.,1२é"), st.characters(codec="utf-8")), max_size=30), max_size=6))
def test_ids_are_the_library_s_for_any_text(texts):
    path = tokens.vocabulary()
    library = tokens.encoder(path).tokenizer
    assert ids_of(tokens.encoder(path), texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_hilbert_curve_is_a_path():
    for dims, bits in ((2, 4), (3, 2), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        keys = packing.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1)
        assert (steps == 1).all()


@pytest.mark.parametrize("n", [1, 2, 3, 1000, 4097])
def test_permutation_is_a_bijection_with_an_inverse(n):
    p = materialise.Permutation(n, 5)
    slots = p.slots(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert (p.indexes(slots) == np.arange(n)).all()
    assert n < 100 or (slots != materialise.Permutation(n, 6).slots(np.arange(n))).any()


def test_bounds_are_never_below_products():
    draw = np.random.default_rng(2)
    a, b = draw.normal(size=(40, 24)), draw.normal(size=(50, 24)) * 3
    for s in (1, 4, 16, 24):
        assert (topk._levels(a, s) @ topk._levels(b, s).T >= a @ b.T - 1e-9).all()


def test_chunks_survive_an_insertion():
    draw = random.Random(4)
    text = "".join(draw.choices("abcdefgh ", k=4000))
    moved = text[:1000] + "INSERTED" + text[1000:]
    a, b, c = fingerprint.chunk_sets(*buffer([text, moved, text]))
    assert fingerprint.likeness(a, b) > 0.85 and (a == c).all()
    assert fingerprint.containment(a, b) >= fingerprint.likeness(a, b)
    assert (fingerprint.read(fingerprint.written(a)) == a).all()
    starts = fingerprint.chunk_starts(*buffer([text]))
    sizes = np.diff(np.append(starts, 4000))
    assert sizes.max() <= fingerprint.MOST and sizes[:-1].min() >= fingerprint.LEAST


def plain_kernel(s, t, n, d):
    """The sum over pairs of equal subsequences of length n of d to the power of their spans."""
    total = 0.0
    for i in itertools.combinations(range(len(s)), n):
        for j in itertools.combinations(range(len(t)), n):
            if [s[k] for k in i] == [t[k] for k in j]:
                total += d ** (i[-1] - i[0] + 1 + j[-1] - j[0] + 1)
    return total


def test_string_kernel_is_the_definition():
    words = ["abcab", "cabab", "bbbbb"]
    left, right = toxicity._codes(words, 5, -1), toxicity._codes(words, 5, -2)
    for n, found in zip((3, 4), toxicity._kernel(left, right), strict=True):
        for a, b in itertools.product(range(3), repeat=2):
            assert found[a, b] == pytest.approx(plain_kernel(words[a], words[b], n, toxicity.DECAY), rel=1e-4, abs=1e-6)


def test_units_join_spelled_out_words():
    data, bounds = buffer(["so, i d i o t! (really)", "a b", ""])
    a, b, row = toxicity.units(data, bounds)
    raw = data.tobytes()
    found = [toxicity.plain(raw[i:j]) for i, j in zip(a, b, strict=True)]
    assert "idiot" in found and "really" in found and "ab" not in found and set(row.tolist()) == {0, 1}


def thue_morse(letters, length):
    """A word and its complement, which every hash that is a sum of powers of a base modulo 2^64 takes for equal."""
    bits = [bin(k).count("1") % 2 for k in range(length)]
    return ["".join(letters[b ^ flip] for b in bits) for flip in (0, 1)]


PATTERNED = [w for n in (1024, 2048, 4096) for w in (*thue_morse("ab", n), *thue_morse("xQ", n), *thue_morse("éü", n))]


def test_patterned_words_have_hashes_of_their_own(both):
    hashes, _ = textops.words(*buffer(PATTERNED))
    assert len(set(hashes.tolist())) == len(PATTERNED)
    data, bounds = buffer(PATTERNED)
    starts = fingerprint.chunk_starts(data, bounds)
    raw, chunks = data.tobytes(), textops.span_hashes(data, starts, np.append(starts[1:], len(data)), 59)
    assert len(set(chunks.tolist())) == len({raw[i:j] for i, j in zip(starts, [*starts[1:], len(raw)], strict=True)})
    encoder, library = both
    assert ids_of(encoder, PATTERNED) == [library.encode(t, add_special_tokens=False).ids for t in PATTERNED]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=300), min_size=1, max_size=20))
def test_spans_are_hashed_by_their_bytes_only(spans):
    data = np.frombuffer(b"#".join([b"", *spans, b""]), np.uint8)
    sizes = np.array([len(s) for s in spans])
    starts = np.cumsum(np.concatenate(([1], sizes[:-1] + 1)))
    got = textops.span_hashes(data, starts, starts + sizes)
    alone = [textops.span_hashes(np.frombuffer(s, np.uint8), np.array([0]), np.array([len(s)]))[0] for s in spans]
    assert got.tolist() == [int(a) for a in alone] and len(set(got.tolist())) == len(set(spans))


def test_a_small_table_forgets_and_a_colliding_hash_is_replaced(both, monkeypatch):
    _, library = both
    draw = random.Random(3)
    texts = [" ".join("".join(draw.choices("abcdé", k=draw.randrange(1, 20))) for _ in range(60)) for _ in range(30)]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    small = tokens.Encoder(tokens.vocabulary())
    small.known = textops.SpanTable(200, 4000)
    assert [ids_of(small, [t])[0] for t in texts + texts] == want + want
    honest = textops.span_hashes
    monkeypatch.setattr(textops, "span_hashes", lambda d, s, e, salt=0: honest(d, s, e, salt) % np.uint64(7 if salt == 101 else 2**63))
    poor = tokens.Encoder(tokens.vocabulary())
    assert [ids_of(poor, [t])[0] for t in texts] == want and poor.known.salt > 101
