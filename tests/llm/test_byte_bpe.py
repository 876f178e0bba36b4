"""Byte-level BPE against the tiktoken library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from tillflow.llm import byte_bpe, queries
from tillflow.llm.work import prepared

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.ranks(PATH).rank_of, special_tokens={})


def same(texts):
    ids, counts = byte_bpe.token_ids(pa.array(texts, pa.string()), PATH, PATTERN)
    ends = np.cumsum(counts)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, counts, strict=True)] == [LIBRARY.encode_ordinary(t or "") for t in texts]
    data, sizes = byte_bpe.ranks(PATH).decoded(ids, counts)
    ends = np.cumsum(sizes)
    assert [data[e - n : e].tobytes() for e, n in zip(ends, sizes, strict=True)] == [(t or "").encode() for t in texts]


def test_odd_texts():
    same([])
    same([None, "", " ", "\n\n  x \n", "<|endoftext|>", "don't DON'T 's's 12 ½², ...!?", "İ ẞ ﬁ é ́a\x85b\x1cc d\x00"])


def test_long_runs():
    same(["a" * 5000, "ab" * 700 + " " + "=" * 3000, "é" * 900, "語" * 600, " " * 2000 + "x", "aab" * 171, "z" * 512, "z" * 513])
    rnd = random.Random(2)
    same(["".join(rnd.choices("abcdefgh", k=rnd.randrange(1, 1500))) for _ in range(60)])
    same(["".join(rnd.choices("aab", k=30_000)), "word " * 60_000])


def test_random_texts(monkeypatch):
    rnd = random.Random(3)
    pool = [chr(c) for c in [*range(0x250), *range(0x300, 0x600), 0x2028, 0xA0, 0xAC00, 0x1F600]] + list(" 'stremvld") * 30
    texts = ["".join(rnd.choices(pool, k=rnd.randrange(60))) for _ in range(3000)]
    same(texts)
    monkeypatch.setattr(byte_bpe, "HELD", 7)  # texts and equal pre-tokens pass the edges of what is held together
    monkeypatch.setattr(byte_bpe, "TREE_CELLS", 64)
    same(texts[:150])


def test_cut_and_pairs_know_all_characters():
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    same([" ".join(f"a{chr(c)}{chr(c)}b 1{chr(c)}2 .{chr(c)}," for c in points[i : i + 500]) for i in range(0, len(points), 500)])


def test_every_token_encodes_to_itself():
    vocabulary = byte_bpe.ranks(PATH)
    ids, counts = vocabulary.encoded(vocabulary.bytes, np.append(vocabulary.starts, len(vocabulary.bytes)))
    assert (counts == 1).all() and (ids == np.arange(vocabulary.count)).all()


@pytest.fixture(scope="module")
def session(spark):
    return prepared(spark)


def test_query_equals_the_library(session, tmp_path):
    rnd = random.Random(9)
    texts = ["", "a", "Hello, wörld!  \n", "x" * 3000, "many words " * 20_000] + ["".join(rnd.choices("ab '1é\n", k=50)) for _ in range(200)]
    rows = [*enumerate(texts), (None, "no id"), (3, None), (3, None), (5, "twice"), (5, "twice")]
    frame = session.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as ids", "'x' as n_tokens", "2 as decoded")
    frame.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    expected = []
    for doc_id, text in rows:
        ids = LIBRARY.encode_ordinary(text or "")
        expected.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted((tuple(r) for r in queries.op13_byte_bpe(session, str(tmp_path)).collect()), key=str) == sorted(expected, key=str)
    frame.limit(0).write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert queries.op13_byte_bpe(session, f"{tmp_path}/empty").count() == 0


def test_ids_come_back_as_texts(session):
    texts = [None, "", "naïve café ☕", "tabs\tand\nlines", "long " * 30_000]
    docs = session.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    coded = byte_bpe.encoded(docs, PATH, PATTERN, ["doc_id"])
    assert coded.columns == ["doc_id", "n_tokens", "ids"]
    found = {r.doc_id: bytes(r.decoded).decode() for r in byte_bpe.decoded(coded, PATH, ["doc_id"]).collect()}
    assert found == {i: t or "" for i, t in enumerate(texts)}
