"""The numpy parts against plain Python, without Spark."""

import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillflow.llm import bpe, embeddings, language, lm, packing, simhash, varint
from tillflow.llm.text import ALPHANUMERIC, NOT_BLANK, slices, words

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = st.lists(st.none() | st.text(alphabet="aZ09 \t\n.,é語😀'<|", max_size=30), max_size=8)
A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    for member, pattern in ((ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), (NOT_BLANK, r"[^\x20\x09-\x0D]+")):
        found = words(pa.array(texts, pa.string()), member)
        expected = [re.findall(pattern, (t or "").translate(A_TO_Z)) for t in texts]
        assert found.strings().to_pylist() == [w for t in expected for w in t]
        assert found.counts().tolist() == [len(t) for t in expected]
        codes, distinct = found.coded()
        assert [distinct[i].as_py() for i in codes.tolist()] == [w for t in expected for w in t]


def test_slices_keep_all_rows_and_bound_the_bytes():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (5, 0, 30, 3, 3, 3)] + [None]})
    parts = [s.column("text").to_pylist() for s in slices(batch, limit=10)]
    assert sum(parts, []) == batch.column("text").to_pylist()
    assert all(sum(len(t or "") for t in p) <= 10 or len(p) == 1 for p in parts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 1 << 38), max_size=6), max_size=6))
def test_packed_numbers_come_back(lists):
    lists = [sorted(x) for x in lists]
    counts = np.array([len(x) for x in lists], np.int64)
    stored = varint.packed(np.array(sum(lists, []), np.int64), counts)
    assert [varint.unpacked(v).tolist() for v in stored.to_pylist()] == lists


def same_ids(texts):
    ids, counts = bpe.token_ids(pa.array(texts, pa.string()), PATH)
    library = Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)
    ends = np.cumsum(counts)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, counts, strict=True)] == [e.ids for e in library]
    assert bpe.token_counts(pa.array(texts, pa.string()), PATH).tolist() == [len(e.ids) for e in library]


def test_tokens_of_odd_texts_equal_the_library():
    same_ids([])
    same_ids([None, "", " \t\n\v\f\r", "İstanbul ΣΑΣ Σ <|endoftext|> a<|startoftext|>b<|endoftext|><|endoftext|> <|endoftext|"])
    same_ids(["aaaaaaaaaaaaaaaaa aaaa!!!! '''s 's've 123 ½²③ don't DON'T \x1c\x85q é ́a ẛ̣ ﬁ Å Ω", "Ɤ ࢏x stꟜ"])


def test_tokens_of_random_texts_equal_the_library():
    random.seed(7)
    pool = [chr(c) for c in [*range(0x250), *range(0x300, 0x600), 0x2028, 0xA0, 0xAC00, 0x1100, 0x1F600, 0x200B]] + list(" 'stremvld") * 30
    same_ids(["".join(random.choices(pool, k=40)) for _ in range(3000)])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120))
def test_every_placement_has_the_smallest_sum_of_squares(lengths):
    capacity = 64
    bins, offsets, gaps = packing.place(np.array(lengths, np.int64), capacity)
    held: list[int] = []
    for s, b, o in zip(lengths, bins.tolist(), offsets.tolist(), strict=True):
        fitting = [g for g in held if g >= s]

        def squares(gap, s=s):
            after = [g for g in held]
            after.remove(gap)
            after.append(gap - s)
            return sum(after.count(g) ** 2 for g in set(after) if g)

        if b == len(held):
            assert not [g for g in fitting if g] and o == 0
            held.append(capacity - s)
        else:
            assert o == capacity - held[b] and squares(held[b]) == min(squares(g) for g in fitting if g)
            held[b] -= s
    assert held == gaps.tolist() and all(g >= 0 for g in held)


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.sampled_from([1, 2, 4]))
def test_fingerprints_follow_the_definition(texts, width):
    expected = []
    for text in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(A_TO_Z))
        shingles = [" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))] if w else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        expected.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    assert simhash.fingerprints(pa.array(texts, pa.string()), width).tolist() == expected


def test_fingerprint_of_a_long_text_is_counted_in_parts(monkeypatch):
    text = pa.array([" ".join(str(i % 97) for i in range(5000)), None, "a b"])
    whole = simhash.fingerprints(text, 4)
    monkeypatch.setattr(simhash, "CHUNK", 333)
    assert simhash.fingerprints(text, 4).tolist() == whole.tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=1, max_size=5), st.integers(1, 3), st.randoms())
def test_viterbi_finds_a_best_path(sizes, labels, rnd):
    from itertools import product

    first = np.concatenate([[0], np.cumsum(sizes)])
    scores = np.array([[rnd.uniform(-5, 0) for _ in range(labels)] for _ in range(first[-1])], np.float32).reshape(-1, labels)
    found = language.viterbi(scores, first, 1.5)

    def value(path, a):
        return sum(scores[a + i, p] for i, p in enumerate(path)) - 1.5 * sum(x != y for x, y in zip(path, path[1:], strict=False))

    for a, b in zip(first, first[1:], strict=False):
        best = max(value(p, a) for p in product(range(labels), repeat=b - a))
        assert value(found[a:b], a) == pytest.approx(best, abs=1e-3)


def test_collision_calibration_reaches_its_recall():
    rng = np.random.default_rng(3)
    one = rng.standard_normal((4000, 64))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    side = rng.standard_normal((4000, 64))
    side -= (side * one).sum(1, keepdims=True) * one
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    two = 0.9 * one + np.sqrt(1 - 0.81) * side

    def codes(x):
        return np.floor((x @ embeddings.directions(64)[:, 1:] + 4) / embeddings.STEP)

    hits = (np.abs(codes(one) - codes(two)) <= embeddings.REACH).sum(axis=1)
    assert hits.mean() / embeddings.PROJECTIONS == pytest.approx(embeddings.collision_rate(0.9), abs=0.01)
    assert (hits >= embeddings.least_count(0.9)).mean() > 0.995


def test_discounts_stay_within_their_counts():
    for figures in ((0, 0, 0, 0), (5, 0, 0, 0), (10, 4, 2, 1), (1, 9, 9, 9)):
        d = lm.discounts(*figures)
        assert d[0] == 0 and all(0 <= x <= k for k, x in enumerate(d))
    y = 10 / 18
    assert lm.discounts(10, 4, 2, 1).tolist() == pytest.approx([0, 1 - 2 * y * 0.4, 2 - 3 * y * 0.5, 3 - 4 * y * 0.5])
