"""Structure of conversations: faults, the cheapest repair, and the repaired rows.

A conversation is a sequence of symbols, one for the role and fault of each row.  Re-Pair
finds rules for pairs that are frequent in all conversations; a rule has one min-plus
transfer matrix over the states of the wanted order of roles, made of those of its two
parts, so a conversation costs as many products as it has symbols after compression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.ranking import placed
from tillflow.llm.work import arrow_map
from tillflow.sources.staging import staged

BLANKS = " \t\n\v\f\r"
ENDS = ".!?"

# A row's symbol: the initial of its role (o: any other), upper case if it is truncated,
# and the letter below it here if it must go.
INITIALS, DOOMED = "suao", "wxyz"
LEGAL = {"su", "ua", "au"}
FOLDED = str.maketrans(DOOMED + INITIALS.upper(), INITIALS * 2)  # back to the initial

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3  # costs; to keep a row costs nothing

# States of (s?(ua)+)?: 0 nothing yet, 1 after s, 2 after u, 3 after a.  Ends may be 0 and 3.
STATES = range(4)
STEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "o": {}}
FINAL = (0, 3)

CHUNK = 1024  # rows of a conversation that are one sequence
GATHERED = 64  # matrices that are multiplied together in one step up
ROUNDS, RULES = 8, 256  # of the grammar, which only makes the products fewer
FIRST_RULE = 0x100  # code point of the first rule's symbol

# An audit is a text, or two audits one after the other; rules share their parts.
Rope = str | tuple["Rope", "Rope"]
Matrix = list[list[tuple[int, Rope] | None]]


def joined(a: Rope, b: Rope) -> Rope:
    return b if a == "" else a if b == "" else (a, b)


def flat(rope: Rope) -> str:
    out, todo = [], [rope]
    while todo:
        part = todo.pop()
        if isinstance(part, str):
            out.append(part)
        else:
            todo += [part[1], part[0]]
    return "".join(out)


def comes_before(x: Rope, y: Rope) -> bool:
    """Whether x is ASCII-less than y; parts that both have in the same place are passed over."""
    left, right = [x], [y]
    while left and right:
        a, b = left.pop(), right.pop()
        if a is b:
            continue
        if not isinstance(a, str):
            left += [a[1], a[0]]
            right.append(b)
        elif not isinstance(b, str):
            left.append(a)
            right += [b[1], b[0]]
        else:
            size = min(len(a), len(b))
            if a[:size] != b[:size]:
                return a < b
            left += [a[size:]] * (len(a) > size)
            right += [b[size:]] * (len(b) > size)
    return not any(map(flat, left)) and any(map(flat, right))


def better(new: tuple[int, Rope] | None, old: tuple[int, Rope] | None) -> bool:
    if new is None or old is None:
        return old is None
    return new[0] < old[0] or (new[0] == old[0] and comes_before(new[1], old[1]))


def product(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product; of equal costs the ASCII-least audit.

    The least audit of a whole has the least audits of its parts: of two audits of equal cost
    over the same rows none begins the other, as the longer one would have more insertions.
    """
    out: Matrix = []
    for row in a:
        found: list[tuple[int, Rope] | None] = []
        for to in STATES:
            best = None
            for via in STATES:
                first, then = row[via], b[via][to]
                if first is None or then is None:
                    continue
                if best is None or first[0] + then[0] <= best[0]:
                    new = (first[0] + then[0], joined(first[1], then[1]))
                    if better(new, best):
                        best = new
            found.append(best)
        out.append(found)
    return out


def _matrix(entries: dict[tuple[int, int], list[tuple[int, Rope]]]) -> Matrix:
    def least(found: list[tuple[int, Rope]]) -> tuple[int, Rope] | None:
        return min(found, default=None)

    return [[least(entries.get((a, b), [])) for b in STATES] for a in STATES]


# Any number of insertions: the second user or assistant from a state on comes back to it.
INSERTIONS = _matrix(
    {(a, a): [(0, "")] for a in STATES}
    | {(a, 2): [(INSERT, "I")] for a in (0, 1, 3)}
    | {(2, 3): [(INSERT, "I")]}
    | {(a, 3): [(2 * INSERT, "II")] for a in (0, 1)}
    | {(3, 3): [(0, "")], (2, 2): [(0, "")]}
)


def terminal(symbol: str) -> Matrix:
    """Insertions, and then one edit of a row with this symbol."""
    entries: dict[tuple[int, int], list[tuple[int, Rope]]] = {(a, a): [(DELETE, "D")] for a in STATES}
    if symbol not in DOOMED:
        more = TRUNCATED * symbol.isupper()
        edits = [(symbol.lower(), more, "K"), ("u", REROLE + more, "R"), ("a", REROLE + more, "R")]
        for role, cost, initial in edits:
            for a, b in STEPS[role].items():
                entries.setdefault((a, b), []).append((cost, initial))
    return product(INSERTIONS, _matrix(entries))


@dataclass
class Grammar:
    """Rules in the order they are applied, and the matrix of each symbol."""

    rules: list[tuple[str, str]]  # pair, symbol
    matrices: dict[str, Matrix]

    def compressed(self, text: str) -> str:
        for pair, symbol in self.rules:
            text = text.replace(pair, symbol)
        return text

    def add(self, pair: str) -> None:
        symbol = chr(FIRST_RULE + len(self.rules))
        self.rules.append((pair, symbol))
        self.matrices[symbol] = product(self.matrices[pair[0]], self.matrices[pair[1]])


def _counted(batch: pa.RecordBatch, grammar: Grammar) -> Iterator[pa.RecordBatch]:
    """How often each pair of symbols could be replaced, sequences weighing as often as they occur."""
    text = grammar.compressed("\n".join(batch.column("symbols").to_pylist()) + "\n")
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    weight = np.repeat(batch.column("n").to_numpy(), np.diff(np.flatnonzero(codes == 10), prepend=-1))
    pairs = codes[:-1] << 32 | codes[1:]
    counts = (codes[:-1] != 10) & (codes[1:] != 10)
    # In a run of one symbol every other pair can be replaced.
    begins = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    offset = np.arange(len(codes)) - np.repeat(begins, np.diff(np.append(begins, len(codes))))
    counts &= (codes[:-1] != codes[1:]) | (offset[:-1] % 2 == 0)
    found, which = np.unique(pairs[counts], return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, which, weight[:-1][counts])
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total)], ["pair", "n"])


def learned(sequences: DataFrame, rounds: int = ROUNDS, rules: int = RULES) -> Grammar:
    """Re-Pair over all ``sequences`` (columns ``symbols`` and ``n``, how many there are).

    A round counts all pairs and makes rules for the most frequent ones that share no symbol:
    they can't overlap, so replacing them together is the same as one after the other.  The
    driver sees the counts of at most as many pairs as there are pairs of symbols.
    """
    grammar = Grammar([], {s: terminal(s) for s in INITIALS + INITIALS.upper() + DOOMED})
    for _ in range(rounds):
        pairs = arrow_map(sequences.select("symbols", "n"), partial(_counted, grammar=grammar), "pair bigint, n bigint")
        frequent = pairs.groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1").collect()
        used: set[str] = set()
        for row in sorted(frequent, key=lambda r: (-r["n"], r["pair"])):
            pair = chr(row["pair"] >> 32) + chr(row["pair"] & 0xFFFFFFFF)
            if used.isdisjoint(pair) and len(grammar.rules) < rules:
                used.update(pair)
                grammar.add(pair)
        if not used:
            break
    return grammar


def _stored(matrix: Matrix) -> tuple[list[int | None], list[str | None]]:
    cells = [cell for row in matrix for cell in row]
    return [c and c[0] for c in cells], [c and flat(c[1]) for c in cells]


def _loaded(costs: list[int | None], audits: list[str | None]) -> Matrix:
    cells = [None if c is None else (c, a) for c, a in zip(costs, audits, strict=True)]
    return [cells[i : i + len(STATES)] for i in range(0, len(cells), len(STATES))]


def transfer(symbols: str, grammar: Grammar, start: bool) -> Matrix:
    """The matrix of a sequence; of the first one of a conversation only from state 0."""
    matrices = [grammar.matrices[s] for s in grammar.compressed(symbols)]
    out = matrices[0][:1] if start else matrices[0]
    for matrix in matrices[1:]:
        out = product(out, matrix)
    return out


def cheapest(matrix: Matrix) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    ends = product(matrix[:1], INSERTIONS)[0]
    best = None
    for state in FINAL:
        if better(ends[state], best):
            best = ends[state]
    return best[0], flat(best[1])


MATRIX = "name string, chunk bigint, costs array<bigint>, audits array<string>"


def _transferred(batch: pa.RecordBatch, grammar: Grammar) -> Iterator[pa.RecordBatch]:
    known: dict[tuple[str, bool], tuple] = {}
    costs, audits, illegal = [], [], []
    lists = (batch.column(c).to_pylist() for c in ("symbols", "lead", "chunk"))
    for symbols, lead, chunk in zip(*lists, strict=True):
        if (symbols, chunk == 0) not in known:
            known[symbols, chunk == 0] = _stored(transfer(symbols, grammar, chunk == 0))
        found = known[symbols, chunk == 0]
        costs.append(found[0])
        audits.append(found[1])
        roles = ((lead or "") + symbols).translate(FOLDED)
        illegal.append(sum(roles[i : i + 2] not in LEGAL for i in range(len(roles) - 1)))
    columns = [batch.column("name"), batch.column("chunk"), pa.array(costs, pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string()))]
    yield pa.RecordBatch.from_arrays([*columns, pa.array(illegal, pa.int64())], ["name", "chunk", "costs", "audits", "illegal"])


def _multiplied(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    costs, audits = [], []
    for parts in batch.column("parts").to_pylist():
        matrices = [_loaded(p["costs"], p["audits"]) for p in sorted(parts, key=lambda p: p["chunk"])]
        out = matrices[0]
        for matrix in matrices[1:]:
            out = product(out, matrix)
        found = _stored(out)
        costs.append(found[0])
        audits.append(found[1])
    columns = [batch.column("name"), batch.column("chunk"), pa.array(costs, pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string()))]
    yield pa.RecordBatch.from_arrays(columns, ["name", "chunk", "costs", "audits"])


def _decided(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    found = [cheapest(_loaded(c, a)) for c, a in zip(*(batch.column(n).to_pylist() for n in ("costs", "audits")), strict=True)]
    columns = [batch.column("name"), pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())]
    yield pa.RecordBatch.from_arrays(columns, ["name", "cost", "audit"])


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, each conversation led by its audit; what stays of them, as a stream."""
    name, audit, at, state, position = None, "", 0, 0, 0
    out: list[tuple[str, int, str, str, str]] = []

    def put(edit: str, role: str, text: str) -> None:
        nonlocal state, position
        state = {"s": 1, "u": 2, "a": 3}[role[:1]]
        out.append((name, position, edit, role, text))
        position += 1

    def wanted() -> str:
        return "assistant" if state == 2 else "user"

    def insert() -> None:
        nonlocal at
        while at < len(audit) and audit[at] == "I":
            put("I", wanted(), "")
            at += 1

    def flushed() -> pa.RecordBatch:
        names = ["name", "position", "edit", "role", "text"]
        kinds = [pa.string(), pa.int64(), *[pa.string()] * 3]
        columns = zip(*out, strict=True) if out else [[]] * 5
        made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
        out.clear()
        return made

    for batch in batches:
        lists = (batch.column(c).to_pylist() for c in ("name", "audit", "role", "text"))
        for own, lead, role, text in zip(*lists, strict=True):
            if lead is not None:
                insert()  # at the end of the conversation before
                name, audit, at, state, position = own, lead, 0, 0, 0
                continue
            insert()
            edit = audit[at]
            at += 1
            if edit != "D":
                put(edit, role if edit == "K" else wanted(), text)
        yield flushed()
    insert()
    yield flushed()


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each repaired conversation, rows as ``role:text`` joined by newlines."""
    name, digest = None, None

    def done(found: list[tuple[str, bytes]]) -> pa.RecordBatch:
        columns = [pa.array([n for n, _ in found], pa.string()), pa.array([d for _, d in found], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["name", "digest"])

    for batch in _repaired(batches):
        found = []
        for own, role, text in zip(*(batch.column(c).to_pylist() for c in ("name", "role", "text")), strict=True):
            if own != name:
                if digest:
                    found.append((name, digest.digest()))
                name, digest = own, sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        yield done(found)
    if digest:
        yield done([(name, digest.digest())])


@dataclass
class Repair:
    """What :func:`repair` found.

    conversations: one row each, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``,
    ``cost``, ``audit`` and the internal ``name``, beside the conversation's own id.
    """

    conversations: DataFrame
    lines: DataFrame  # name, turn, role, text, content of every row
    conversation: str

    def _streamed(self) -> DataFrame:
        """All rows of a conversation in one task and in order, after a row with its audit."""
        lines = self.lines.select("name", F.lit(1).alias("kind"), "turn", "role", "content", "text", F.lit(None).cast("string").alias("audit"))
        nothing = {"turn": "turn", "role": "string", "content": "binary", "text": "string"}
        types = dict(self.lines.dtypes)
        leads = self.conversations.where("audit <> ''").select(
            "name", F.lit(0).alias("kind"), *(F.lit(None).cast(types[c]).alias(c) for c in nothing), "audit"
        )
        together = lines.unionByName(leads).repartition("name")
        return together.sortWithinPartitions("name", "kind", "turn", "role", "content").select("name", "audit", "role", "text")

    def rows(self) -> DataFrame:
        """The repaired rows: the conversation's id, ``position`` from 0, ``edit`` (K, R or I), ``role`` and ``text``."""
        found = self._streamed().mapInArrow(_repaired, "name string, position bigint, edit string, role string, text string")
        ids = self.conversations.select("name", f"`{self.conversation}`")
        return found.join(ids, "name").drop("name")

    def digests(self) -> DataFrame:
        """``name`` and ``digest`` (SHA-256 of the rows as ``role:text``, joined by newlines) of all with rows left."""
        return self._streamed().mapInArrow(_digested, "name string, digest binary")


def _named(column: Column) -> Column:
    return F.coalesce(F.concat(F.lit("1"), column.cast("string")), F.lit("0"))


def repair(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """Faults and cheapest repair of every conversation in ``rows``.

    Rows are taken by turn, nulls first; those of one turn by role and by the SHA-256 of their
    text, so repeated rows stand side by side.  A null role or text is one space, a null
    conversation is one of its own.  A row's first fault counts: blank, duplicate (its role and
    text stood earlier), truncated (does not end in one of ``.!?``, blanks aside).  illegal:
    neighbours whose roles' initials aren't su, ua or au.  gaps: turns missing between the
    first and the last.  Edits keep a row (K, free), give it the role user or assistant (R, 3),
    delete it (D, 4; blank and duplicate rows must go) or insert an empty row of a user or
    assistant (I, 3); a truncated row that stays costs 3.  audit: the initials of the cheapest
    edits, in order, after which the roles' initials are ``(s?(ua)+)?``; of equal costs the
    ASCII-least.  An empty table has no conversations; other columns are not looked at.

    No conversation is gathered: its symbols are cut into sequences of ``CHUNK`` rows, whose
    matrices are multiplied in steps.  Only the repaired rows (and their digest, which is
    sequential by nature) pass through one task, as a stream; the audit must fit in memory.
    """
    whole = F.coalesce(rows[f"`{text}`"], F.lit(" "))
    lines = rows.select(
        _named(rows[f"`{conversation}`"]).alias("name"),
        rows[f"`{turn}`"].alias("turn"),
        F.coalesce(rows[f"`{role}`"], F.lit(" ")).alias("role"),
        F.unhex(F.sha2(whole, 256)).alias("content"),
        whole.alias("text"),
    )
    ids = rows.select(_named(rows[f"`{conversation}`"]).alias("name"), rows[f"`{conversation}`"]).distinct()
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    complete = end.endswith(ENDS[0]) | end.endswith(ENDS[1]) | end.endswith(ENDS[2])
    marks = lines.select("name", "turn", "role", "content", (end == "").alias("blank"), (~complete).alias("open"))
    ranked = placed(staged(marks, "lines"), ["name"], ["turn", "role", "content"])

    # The first of equal rows, by a key that every row has for itself.
    firsts = ranked.groupBy("name", "role", "content").agg(F.min("place").alias("place"))
    judged = ranked.join(firsts.select("name", "place", F.lit(True).alias("first")), ["name", "place"], "left")
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    duplicate = ~F.col("blank") & F.col("first").isNull()
    truncated = ~F.col("blank") & F.col("first").isNotNull() & F.col("open")
    symbol = F.when(F.col("blank") | duplicate, F.translate(initial, INITIALS, DOOMED)).when(truncated, F.upper(initial)).otherwise(initial)
    judged = staged(
        judged.select("name", "turn", "place", "blank", duplicate.alias("duplicate"), truncated.alias("truncated"), symbol.alias("symbol")),
        "symbols",
    )
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counts = judged.groupBy("name").agg(
        F.coalesce(span, F.lit(0)).cast("bigint").alias("gaps"),
        *(F.count_if(F.col(c)).alias(c) for c in ("blank", "duplicate", "truncated")),
    )

    # The last row of a sequence also leads the next one, for their neighbourhood.
    chunk, offset = F.floor(F.col("place") / CHUNK).cast("bigint"), (F.col("place") % CHUNK).cast("int")
    here = F.struct(chunk.alias("chunk"), offset.alias("offset"))
    ahead = F.struct((chunk + 1).alias("chunk"), F.lit(-1).alias("offset"))
    spread = judged.select("name", "symbol", F.inline(F.when(offset == CHUNK - 1, F.array(here, ahead)).otherwise(F.array(here))))
    ordered = F.array_sort(F.collect_list(F.when(F.col("offset") >= 0, F.struct("offset", "symbol"))))
    chunks = spread.groupBy("name", "chunk").agg(
        F.array_join(F.transform(ordered, lambda x: x["symbol"]), "").alias("symbols"),
        F.max(F.when(F.col("offset") < 0, F.col("symbol"))).alias("lead"),
    )
    chunks = staged(chunks.where("symbols <> ''"), "chunks")
    sequences = staged(chunks.groupBy("symbols").agg(F.count(F.lit(1)).alias("n")), "sequences")
    grammar = learned(sequences)
    found = staged(arrow_map(chunks, partial(_transferred, grammar=grammar), MATRIX + ", illegal bigint"), "matrices")
    illegal = found.groupBy("name").agg(F.sum("illegal").alias("illegal"))
    whole_ones = found.drop("illegal")
    while whole_ones.where("chunk > 0").head(1):
        step = F.floor(F.col("chunk") / GATHERED).cast("bigint").alias("chunk")
        parts = whole_ones.groupBy("name", step).agg(F.collect_list(F.struct("chunk", "costs", "audits")).alias("parts"))
        whole_ones = staged(arrow_map(parts, _multiplied, MATRIX), "matrices")
    decided = arrow_map(whole_ones, _decided, "name string, cost bigint, audit string")
    summary = ids.join(counts, "name").join(illegal, "name").join(decided, "name")
    return Repair(staged(summary, "conversations"), lines, conversation)
