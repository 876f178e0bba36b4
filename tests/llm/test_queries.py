"""The registered queries on the given small tables."""

import zlib

import pytest
from compare import database, difference, registered

from tillflow.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.SQL)
def test_query_equals_sql(spark, name):
    assert difference(spark, database(FOLDER), FOLDER, name) is None


def test_all_operators_and_the_pipeline_are_registered():
    names = [n for n in registered.queries() if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14)) and "pipeline" in registered.queries()


def test_language_of_held_out_documents(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()}
    found = registered.queries()["op6_language_id"](spark, FOLDER).collect()
    held = [r for r in found if r.held_out]
    assert len(found) == len(docs) and {r.doc_id for r in held} == {i for i in docs if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.lang_pred == docs[r.doc_id] for r in held) >= 0.98 * len(held)


def test_held_out_texts_score_better_than_the_base(spark):
    found = registered.queries()["op2_language_model"](spark, FOLDER).where("held_out").collect()
    assert sum(r.score for r in found) > sum(r.base_score for r in found) * 0.99
