"""Conversation repair against all edits of short sequences, and a row-by-row version of the query."""

import hashlib
import itertools
import random
import re
import zlib

import pyarrow as pa
import pytest

from tillflow.llm import conversations as c
from tillflow.llm import queries
from tillflow.llm.work import prepared

ROWS = "conv_id bigint, turn bigint, role string, text string"
ALPHABET = c.INITIALS + c.INITIALS.upper() + c.DOOMED
FULL = re.compile("(s?(ua)+)?")


def all_edits(symbols):
    """Cheapest cost and audit by trying every script with at most two insertions in a gap."""
    options = []
    for s in symbols:
        late = 3 * s.isupper()
        kept = [] if s in c.DOOMED else [("K", s.lower(), late), ("R", "u", 3 + late), ("R", "a", 3 + late)]
        options.append([("D", "", 4), *kept])
    gaps = [("", "", 0), *((("I" * len(r), r, 3 * len(r))) for n in (1, 2) for r in map("".join, itertools.product("ua", repeat=n)))]
    best = None
    for edits in itertools.product(*options):
        for between in itertools.product(gaps, repeat=len(edits) + 1):
            script = [x for pair in zip(between, edits, strict=False) for x in pair] + [between[-1]]
            if FULL.fullmatch("".join(r for _, r, _ in script)):
                found = (sum(p for _, _, p in script), "".join(a for a, _, _ in script))
                best = min(best or found, found)
    return best


def forward(symbols):
    """The same row by row, one best script for each state."""
    inserts = {0: {0: "", 2: "I", 3: "II"}, 1: {1: "", 2: "I", 3: "II"}, 2: {2: "", 3: "I"}, 3: {3: "", 2: "I"}}
    steps = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "o": {}}

    def inserted(best):
        out = {}
        for a, (cost, audit) in best.items():
            for b, i in inserts[a].items():
                new = (cost + 3 * len(i), audit + i)
                out[b] = min(out.get(b, new), new)
        return out

    best = {0: (0, "")}
    for s in symbols:
        now = inserted(best)
        best = {}

        def offer(state, cost, audit, best=best):
            best[state] = min(best.get(state, (cost, audit)), (cost, audit))

        for a, (cost, audit) in now.items():
            offer(a, cost + 4, audit + "D")
            if s in c.DOOMED:
                continue
            late = 3 * s.isupper()
            for role, more, edit in ((s.lower(), 0, "K"), ("u", 3, "R"), ("a", 3, "R")):
                if a in steps[role]:
                    offer(steps[role][a], cost + more + late, audit + edit)
    ends = inserted(best)
    return min(ends[s] for s in (0, 3) if s in ends)


def grammar_of(texts, rounds=c.ROUNDS):
    """The grammar of some sequences, without Spark."""
    grammar = c.Grammar([], {s: c.terminal(s) for s in ALPHABET})
    batch = pa.RecordBatch.from_pydict({"symbols": texts, "n": [1] * len(texts)})
    for _ in range(rounds):
        counted = next(c._counted(batch, grammar)).to_pydict()
        used = set()
        for n, pair in sorted(zip(counted["n"], counted["pair"], strict=True), key=lambda x: (-x[0], x[1])):
            pair = chr(pair >> 32) + chr(pair & 0xFFFFFFFF)
            if n > 1 and used.isdisjoint(pair):
                used.update(pair)
                grammar.add(pair)
    return grammar


def test_one_row_after_the_other_equals_all_edits():
    rnd = random.Random(3)
    plain = c.Grammar([], {s: c.terminal(s) for s in ALPHABET})
    for size in (1, 2, 3):
        for _ in range(25):
            symbols = "".join(rnd.choices(ALPHABET, k=size))
            assert forward(symbols) == all_edits(symbols) == c.cheapest(c.transfer(symbols, plain, True)), symbols


def test_compressed_sequences_equal_row_by_row():
    rnd = random.Random(5)
    texts = ["".join(rnd.choices("suauauaAUoxw" if n % 3 else ALPHABET, k=rnd.randrange(1, 60))) for n in range(300)]
    texts += ["ua" * 200, "u" * 301, "a" * 64, "uA" * 99 + "s", "w" * 50]
    grammar = grammar_of(texts)
    assert len(grammar.rules) > 20 and len(grammar.compressed("ua" * 200)) < 20
    for text in texts:
        assert c.cheapest(c.transfer(text, grammar, True)) == forward(text)
        # Whole matrices of parts, multiplied, are the matrix of the whole.
        cut = rnd.randrange(len(text) + 1)
        parts = [c.transfer(p, grammar, False) for p in (text[:cut], text[cut:]) if p]
        assert c.cheapest(parts[0] if len(parts) == 1 else c.product(*parts)) == forward(text)


def test_counts_are_replacements():
    texts = ["uuuuu", "uauaua", "suua", "uuuu"]
    plain = c.Grammar([], {s: c.terminal(s) for s in ALPHABET})
    batch = pa.RecordBatch.from_pydict({"symbols": texts, "n": [1, 2, 1, 3]})
    counted = next(c._counted(batch, plain)).to_pydict()
    found = {chr(p >> 32) + chr(p & 0xFFFFFFFF): n for p, n in zip(counted["pair"], counted["n"], strict=True)}
    for pair, n in found.items():
        assert n == sum(w * t.count(pair) for t, w in zip(texts, (1, 2, 1, 3), strict=True))


def test_ropes_compare_like_texts():
    rnd = random.Random(1)

    def rope(text):
        if len(text) < 2 or rnd.random() < 0.3:
            return text
        cut = rnd.randrange(len(text) + 1)
        return (rope(text[:cut]), rope(text[cut:]))

    for _ in range(2000):
        x, y = ("".join(rnd.choices("DK", k=rnd.randrange(7))) for _ in "xy")
        a, b = rope(x), rope(y)
        assert c.flat(a) == x and c.comes_before(a, b) == (x < y)
        assert c.comes_before((a, b), (a, a)) == (x + y < x + x)


def by_hand(rows):
    """The query's rows from plain Python."""
    out = {}
    for conv in {r[0] for r in rows}:
        damaged = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            kind = zlib.crc32(key.encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            role = "user" if kind == 4 else role
            damaged += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        damaged.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        symbols, seen, faults = "", set(), [0, 0, 0]
        for _, role, text in damaged:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            fault = 0 if not solid else 1 if (role, text) in seen else 2 if solid[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                faults[fault] += 1
            symbols += initial.translate(str.maketrans(c.INITIALS, c.DOOMED)) if fault in (0, 1) else initial.upper() if fault == 2 else initial
        turns = [t for t, _, _ in damaged if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[1][:1] for r in damaged]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, audit = forward(symbols)
        kept, rest = [], iter(damaged)
        for edit in audit:
            before = kept[-1][0][:1] if kept else ""
            wanted = "assistant" if before == "u" else "user"
            if edit == "I":
                kept.append((wanted, ""))
                continue
            _, role, text = next(rest)
            if edit != "D":
                kept.append((role if edit == "K" else wanted, text))
        assert next(rest, None) is None and FULL.fullmatch("".join(r[:1] for r, _ in kept))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out[conv] = (gaps, *faults, illegal, cost, audit, digest, kept)
    return out


def odd_rows():
    rnd = random.Random(8)
    rows = []
    for conv in [*range(120), None]:
        for turn in range(rnd.randrange(1, 14)):
            role = rnd.choice(["system"] * (turn == 0) + ["user", "assistant"] * 4 + ["tool", "", None, "User", "sam"])
            text = rnd.choice(["yes.", "no", "yes. \n", "", " \t", None, "é!", f"text {turn}?", "long " * 300 + "."])
            rows.append((conv, rnd.choice([turn, turn, turn, turn + 3, None]), role, text))
    rows += [(5000, t, "user" if t % 2 else "assistant", f"t{t % 7}.") for t in range(5)]
    rows += [(5001, None, "user", "x"), (5001, None, "user", "x"), (5002, 1, "user", "same?")] * 4
    return rows


@pytest.fixture(scope="module")
def session(spark):
    return prepared(spark)


def test_query_equals_plain_python(session, tmp_path):
    rows = odd_rows()
    frame = session.createDataFrame(rows, ROWS).selectExpr("*", "1 as name", "'x' as place", "2 as chunk", "3 as symbol")
    frame.repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op11_conversation_repair(session, str(tmp_path)).collect()
    expected = by_hand(rows)
    assert len(found) == len(expected)
    assert {r.conv_id: tuple(r)[1:] for r in found} == {k: v[:-1] for k, v in expected.items()}
    assert [n for n, t in queries.op11_conversation_repair(session, str(tmp_path)).dtypes if t == "bigint"] == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"
    ]


def test_long_conversations_are_cut_and_put_together(session, monkeypatch):
    monkeypatch.setattr(c, "CHUNK", 8)
    monkeypatch.setattr(c, "GATHERED", 3)
    rnd = random.Random(2)
    rows = [(7, t, rnd.choice(["user", "assistant"]), rnd.choice([f"t{t}.", f"t{t}", "again.", " "])) for t in range(400)]
    rows += [(8, t, "user", f"u{t}.") for t in range(16)] + [(9, 0, "system", "x.")]
    frame = session.createDataFrame(rows, ROWS).repartition(6)
    found = c.repair(queries._damaged(frame))
    expected = by_hand(rows)
    summary = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) for r in found.conversations.collect()}
    assert summary == {k: v[:7] for k, v in expected.items() if k in summary} and {7, 8} <= set(summary)
    repaired = {}
    for r in sorted(found.rows().collect(), key=lambda r: (r.conv_id, r.position)):
        repaired.setdefault(r.conv_id, []).append((r.role, r.text))
    assert repaired == {k: v[-1] for k, v in expected.items() if v[-1]}


def test_no_conversations(session):
    found = c.repair(session.createDataFrame([], ROWS))
    assert found.conversations.count() == found.rows().count() == found.digests().count() == 0
