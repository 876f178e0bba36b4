"""How pieces of repeated rows are dealt."""

from collections import Counter

import public_tokenizers

from tillflow.llm import packing
from tillflow.llm.work import prepared


def test_repeated_rows_go_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARE", 100)
    docs = prepared(spark).createDataFrame([(None, "the same text")] * 600 + [(1, "another")] * 300, "doc_id bigint, text string")
    found = packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    tasks = Counter(r.sequence_id >> 36 for r in found.collect())
    assert sum(tasks.values()) == 900 and len(tasks) == 9 and max(tasks.values()) < 200
