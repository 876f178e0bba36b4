"""The pipeline on small documents, against the stages done by hand."""

import re
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from test_operators import DOCS, SPOKEN, base_spans, hits
from tokenizers import Tokenizer

from tillflow.llm import language, secrets, simhash
from tillflow.llm.work import prepared

HEX = "0123456789abcdef0123456789"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    prepared(spark)
    path = tmp_path_factory.mktemp("tables")
    english = SPOKEN["en"].split()
    texts = []
    for i in range(30):
        rotated = english[i % 17 :] + [f"number{c}" for c in "abcdefgh"[: i % 8 + 1]] + english[: i % 17]
        texts.append((" ".join(rotated) + f" ends here{'abcdefghij'[i % 10]}", "en"))
    texts += [(SPOKEN["de"] + " " + " ".join(SPOKEN["de"].split()[::-1]) + f" wort{c}", "de") for c in "abcde"]
    passage = "one two three four five six seven eight nine ten eleven"
    texts += [(texts[3][0], "en"), (texts[3][0].upper(), "en"), (None, "en"), ("", "en"), ("123 456 ...", "en")]
    texts += [(f"they said {passage} in the house near the river", "en"), (f"the secret: {HEX} was near the house", "en")]
    texts += [("the old house " * 900 + "end", "en")]
    rows = [(i, t, lang, "s", len(t or "")) for i, (t, lang) in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_pipeline_equals_the_stages_done_by_hand(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    named = {r.doc_id: r for r in language.identified(docs, language.learn(docs), ["doc_id", "lang"]).collect()}
    left = {r.doc_id: r.text for r in docs.collect() if named[r.doc_id].lang_pred != "und" and named[r.doc_id].score >= 0.3}
    assert set(range(43)) - set(left) == {37, 38, 39} and all(named[i].lang_pred == named[i].lang for i in left)
    prints = {i: int(simhash.fingerprints(pa.array([t]), 4)[0]) for i, t in left.items()}
    group, todo = {}, sorted(prints)
    while todo:
        seen, new = {todo[0]}, [todo[0]]
        while new:
            now = new.pop()
            more = [j for j in todo if j not in seen and (prints[now] ^ prints[j]).bit_count() <= 4]
            seen |= set(more)
            new += more
        group |= dict.fromkeys(seen, todo[0])
        todo = [j for j in todo if j not in seen]
    left = {i: t for i, t in left.items() if group[i] == i}
    assert group[35] == group[36] == 3
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    left = {i: t for (i, t), (_, n, _) in zip(left.items(), hits(left.values(), items), strict=True) if not n}
    assert 40 not in left and 41 in left
    for i, t in left.items():
        for span in reversed([s for s in base_spans(t).split(",") if s and s.startswith("assign")]):
            _, a, b = span.split(":")
            left[i] = t[: int(a)] + secrets.MASK + t[int(b) :]
    assert HEX not in left[41]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = Counter()
    for i, t in left.items():
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            expected[i, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    found = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    ends = Counter()
    for r in found:
        ends[r.sequence_id] = max(ends[r.sequence_id], r.offset + r.length)
    assert all(n <= 2048 for n in ends.values()) and sum(ends.values()) == sum(r.length for r in found)


ODD = ["row", "term", "kept", "spans", "fingerprint", "lang_pred", "score", "text__", "cuts__", "hash__", "size__", "key__", "id__"]
ODD += ["text_hash__", "text_size__", "secret_parts__", "secret_row__", "given0", "given1", "name", "root", "least", "copies", "segment"]


def test_stages_keep_columns_of_any_name(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = docs.selectExpr("*", *(f"concat('{name}', doc_id) as `{name}`" for name in ODD), "doc_id as `a.b c`")
    assert [re.sub(r"\W", "", name) for name, _ in corpus_pipeline.STAGES] == [name for name, _ in corpus_pipeline.STAGES]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, odd, folder)
        assert found.columns == odd.columns
        rows = found.collect()
        assert {r.doc_id for r in rows} == {r.doc_id for r in stage(spark, docs, folder).collect()}, name
        assert all(r[n] == f"{n}{r.doc_id}" for r in rows for n in ODD) and all(r["a.b c"] == r.doc_id for r in rows)


@pytest.mark.parametrize("column", ["text__", "cuts__", "hash__", "size__", "text_hash__"])
def test_one_odd_column_at_a_time(spark, folder, column):
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("*", f"cast(doc_id + 7 as int) as `{column}`")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, folder)
        assert found.columns == docs.columns and found.schema[column].dataType == docs.schema[column].dataType


def test_stages_take_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0
