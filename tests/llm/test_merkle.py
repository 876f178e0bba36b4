"""The Merkle manifest against a tree built by hand."""

import hashlib
import random
import zlib

import pytest

from tillflow.llm import merkle, queries
from tillflow.llm.ranking import placed
from tillflow.llm.work import prepared

DOCS = "doc_id bigint, text string, source string, lang string, n_chars bigint"


@pytest.fixture(scope="module")
def session(spark):
    return prepared(spark)


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, source, lang, n_chars):
    values = (doc_id, source, lang, n_chars, text)
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """Levels of the tree, and the siblings before and after on the way up from each leaf."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    ways = []
    for place in range(len(nodes)):
        way = []
        for level in levels[:-1]:
            start = place // 16 * 16
            run = level[start : start + 16]
            way.append((run[: place - start], run[place - start + 1 :]))
            place //= 16
        ways.append(way)
    return levels[-1][0], ways


def by_hand(docs):
    groups = {}
    for doc in docs:
        groups.setdefault(doc[2], []).append(doc)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for rows in groups.values():
        rows.sort(key=lambda d: (d[0] is not None, d[0] or 0, leaf(*d)))
    built = {s: tree([leaf(*d) for d in rows]) for s, rows in groups.items()}
    root, above = tree([built[s][0] for s in names])
    out = []
    for name, beyond in zip(names, above, strict=True):
        for doc, below in zip(groups[name], built[name][1], strict=True):
            way, text = below + beyond, doc[1]
            if doc[0] is not None and text is not None and zlib.crc32(str(doc[0]).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            now = leaf(doc[0], text, *doc[2:])
            for before, after in way:
                now = digest(*before, now, *after)
            proof = digest(*(n for before, after in way for n in before + after))
            out.append((doc[0], leaf(*doc), built[name][0], root, proof, now, now == root))
    return sorted(out, key=str)


def odd_documents():
    rnd = random.Random(4)
    docs = [(i, rnd.choice([f"Ab c{i}", "é Z", f"x{i}", None, ""]), rnd.choice(["big"] * 20 + ["small", "é", "Z"]), "en", i) for i in range(9500)]
    docs += [(1, "Q", "one", "en", 1), (None, "N", "one", None, None), (None, None, None, None, None), (10001, "x", "lone", "de", 5)]
    docs += [(7, "a", None, None, None)] * 40 + [(7, "B", None, None, None)] * 3  # repeated rows
    docs += [(i, "long Text " * 20_000, f"s{i % 40}", "-", None) for i in range(3)]
    return docs + [(i, None, f"s{i % 40}", None, None) for i in range(500)]


def asked(session, folder, docs):
    frame = session.createDataFrame(docs, DOCS).selectExpr("*", "1 as leaf", "'x' as place", "2 as claim", "3 as grp", "4 as digest", "5 as key")
    frame.repartition(5).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    found = queries.op12_merkle_manifest(session, folder)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("size", [None, 300, 17, 1])
def test_query_equals_the_tree_by_hand(session, tmp_path, size):
    docs = odd_documents()[-size if size else None :]
    found = asked(session, str(tmp_path), docs)
    assert found == by_hand(docs)
    if size is None:
        verified = [r[-1] for r in found]
        assert 0 < verified.count(False) < len(found) / 5


def test_more_tiers_give_the_same(session, tmp_path, monkeypatch):
    whole = merkle.manifest
    monkeypatch.setattr(merkle, "manifest", lambda *given: whole(*given, levels=1))
    docs = odd_documents()[:700]
    assert asked(session, str(tmp_path), docs) == by_hand(docs)


def test_empty_table(session, tmp_path):
    assert asked(session, str(tmp_path), []) == []


def test_versions_copy_the_ancestors_of_claimed_leaves_only(session):
    docs = [(i, f"text {i}", "s", "en", i) for i in range(5000)]
    rows = session.createDataFrame(docs, DOCS).selectExpr("doc_id", "source", "unhex(sha2(text, 256)) as leaf", "if(doc_id % 100 = 7, unhex(sha2('other', 256)), null) as claim")
    found = merkle.manifest(rows, "source", ["doc_id"], ["doc_id"]).proved(versions=True).collect()
    nodes = [hashlib.sha256(f"text {i}".encode()).hexdigest() for i in range(5000)]
    for r in found:
        if r.key.doc_id % 100 != 7:
            assert r.copies is None and r.verified
            continue
        changed, place, copies = list(nodes), r.key.doc_id, []
        changed[place] = digest("other")
        while len(changed) > 1:
            changed = [digest(*changed[i : i + 16]) for i in range(0, len(changed), 16)]
            place //= 16
            copies.append(changed[place])
        assert [c.hex() for c in r.copies] == copies and r.folded.hex() == copies[-1] and not r.verified


def test_places_of_equal_rows_and_hot_groups(session, tmp_path):
    rnd = random.Random(6)
    rows = [(g, rnd.randrange(30)) for g in ["hot"] * 3000 + [None] * 50 + [f"g{i % 500}" for i in range(1500)]] + [("hot", 5)] * 2000
    session.createDataFrame(rows, "g string, v bigint").repartition(4).write.parquet(f"{tmp_path}/rows")
    found = {}
    for r in placed(session.read.parquet(f"{tmp_path}/rows"), ["g"], ["v"]).collect():
        found.setdefault(r.g, []).append((r.place, r.v))
    assert sum(map(len, found.values())) == len(rows)
    for g, members in found.items():
        assert [p for p, _ in sorted(members)] == list(range(len(members)))
        assert [v for _, v in sorted(members)] == sorted(v for h, v in rows if h == g)
    assert {p for p, _ in sorted((r.place, r.v) for r in placed(session.read.parquet(f"{tmp_path}/rows"), [], ["v", "g"]).collect())} == set(range(len(rows)))
