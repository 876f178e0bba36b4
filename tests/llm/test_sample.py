"""The sample that language identification learns from."""

from test_operators import DOCS, SPOKEN

from tillflow.llm import language
from tillflow.llm.work import prepared


def rows_of(lang, n, first=None):
    words = SPOKEN[lang].split()
    turned = [" ".join(words[i % len(words) :] + words[: i % len(words)]) + " " + words[0] * (i // len(words)) for i in range(n)]
    return [(None if first is None else first + i, t, lang, "s", 0) for i, t in enumerate(turned)]


def test_rows_without_an_id_teach_and_take_no_place_of_others(spark):
    rows = rows_of("ru", 60) + rows_of("ru", 40, 1) + rows_of("en", 30, 1000)
    rows += [(5000 + i, "12 ... " * (i % 3), "en", "s", 0) for i in range(300)]
    docs = prepared(spark).createDataFrame(rows, DOCS).repartition(3)
    model = language.learn(docs, 20)
    assert model.languages == ["en", "ru"]
    found = language.identified(docs.where("doc_id IS NULL OR doc_id < 5000"), model, ["lang"]).collect()
    assert all(r.lang_pred == r.lang and r.score == 1 for r in found)
    alone = docs.where("doc_id IS NULL")
    assert language.learn(alone).languages == ["ru"]
    assert language.accepted(alone, language.learn(alone)).count() == 60


def test_repeated_rows_teach_once_and_take_one_place(spark):
    rows = rows_of("en", 30, 1) + rows_of("de", 30)
    once = prepared(spark).createDataFrame(rows, DOCS)
    often = once.unionByName(once.where("doc_id = 7 OR doc_id IS NULL").crossJoin(spark.range(97).drop("id"))).repartition(5)
    for n in (10, 30, 2000):
        a, b = language.learn(once, n), language.learn(often, n)
        assert a.languages == b.languages and (a.logs == b.logs).all() and (a.allowed == b.allowed).all()
