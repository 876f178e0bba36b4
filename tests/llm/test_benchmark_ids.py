"""Benchmark items without an id."""

from test_operators import documents, hits, prose

from tillflow.llm import decontamination
from tillflow.llm.work import prepared


def test_items_without_an_id_count_as_hits_and_are_not_listed(spark):
    session = prepared(spark)
    passages = [prose(100 + i, 25, 60) for i in range(4)]
    items = [(None, passages[0]), (None, passages[1]), (None, passages[2]), (7, passages[2]), (8, passages[3]), (None, "short é"), (None, None)]
    texts = [*passages, f"x {passages[0]} y {passages[3]}", "a short É é b", "a SHORT é b", prose(5, 40, 60), None]
    benchmark = session.createDataFrame(items, "item_id bigint, text string")
    found = decontamination.contamination(decontamination.index(documents(session, texts), ["doc_id"]), benchmark).collect()
    expected = hits(texts, list(enumerate(t for _, t in items)))
    listed = {str(k): [str(i)] if i is not None else [] for k, (i, _) in enumerate(items)}
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in found}
    assert got == {i: (n, h, sorted(x for k in ids for x in listed[k])) for i, (n, h, ids) in enumerate(expected)}
    assert [got[i][1] for i in (0, 1, 2)] == [25, 25, 25]
    clean = decontamination.decontaminated(documents(session, texts), benchmark)
    assert {r.doc_id for r in clean.collect()} == {5, 7, 8}
