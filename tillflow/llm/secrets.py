"""Secrets in texts, and multipart credentials: weak parts count where their counterparts are near.

Built of DataFrame functions only.  The kinds come in two groups.  ``BASE`` kinds are reported
wherever they match.  ``WEAK`` kinds (login names, mixed-character runs, addresses) are reported
only when complementary parts lie within ``SCOPE`` code points of them in the same text: a login
name or a run needs the other half of a credential, an address needs both halves.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.work import under_own_names
from tillflow.sources.staging import staged

SCOPE = 256
MASK = "[REDACTED]"
IDENTITY, SECRET, ADDRESS = "identity", "secret", "address"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str  # Java; its matches are taken from the left, without overlap
    role: str
    value: tuple[int, int] | None = None  # a group of the pattern and the characters it needs
    needs: tuple[str, ...] = ()  # roles that must be near


ASSIGNED = r"""["']?\x20*[:=]\x20*["']?"""

# The three kinds of every scan.  A hex or access match is a longest run, so
# asking for its length in the pattern drops just the runs that are too short.
BASE = (
    Kind("assign", rf"((?i:password|passwd|secret|token|api_?key)){ASSIGNED}([A-Za-z0-9+/_.=-]+)", SECRET, (2, 6)),
    Kind("access", r"AKIA[A-Z0-9]{16,}", IDENTITY),
    Kind("hex", r"[0-9a-f]{24,}", SECRET),
)
WEAK = (
    Kind("login", rf"((?i:client_?id|access_?key_?id|account_?id|user_?name|login)){ASSIGNED}([A-Za-z0-9._@-]+)", IDENTITY, (2, 3), (SECRET,)),
    Kind("mixed", r"(?<![A-Za-z0-9+/])(?=[A-Za-z0-9+/]*[0-9])(?=[A-Za-z0-9+/]*[a-z])(?=[A-Za-z0-9+/]*[A-Z])(?![A-Za-z0-9+/]*AKIA)[A-Za-z0-9+/]{32,}", SECRET, None, (IDENTITY,)),
    Kind("address", r"https?://[A-Za-z0-9.-]+[^\s\"'<>]*", ADDRESS, None, (IDENTITY, SECRET)),
)
KINDS = BASE + WEAK

_PARTS, _ROW = "secret_parts__", "secret_row__"


def _matches(text: Column, number: int, kind: Kind) -> Column:
    """Matches of a kind in order: the code points skipped before each, its own, and whether it counts.

    Every match begins where the last one ended and skips as little as possible, so the
    lengths give the places.
    """
    stepping = rf"(?s)\G(.*?)({kind.pattern})"

    def group(n: int) -> Column:
        return F.regexp_extract_all(text, F.lit(stepping), F.lit(n))

    columns = [group(1), group(2)] + ([group(kind.value[0] + 2)] if kind.value else [])
    names = ["gap", "hit", "value"][: len(columns)]
    zipped = F.arrays_zip(*(c.alias(n) for c, n in zip(columns, names, strict=True)))

    def part(match: Column, i: Column) -> Column:
        counts = F.length(match["value"]) >= kind.value[1] if kind.value else F.lit(True)
        return F.struct(
            F.lit(number).alias("kind"), i.alias("i"), F.length(match["gap"]).alias("gap"),
            F.length(match["hit"]).alias("size"), counts.alias("counts"),
        )

    empty = F.array().cast("array<struct<kind:int,i:int,gap:int,size:int,counts:boolean>>")
    return F.when(text.rlike(kind.pattern), F.transform(zipped, part)).otherwise(empty)


def _with_parts(docs: DataFrame, text: str) -> DataFrame:
    """Written once, with a number for each row: the scan isn't repeated, and the numbers stay."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    parts = F.concat(*(_matches(whole, n, kind) for n, kind in enumerate(KINDS)))
    return docs.withColumns({_PARTS: parts, _ROW: F.monotonically_increasing_id()})


def _spans(scanned: DataFrame) -> DataFrame:
    """``row``, ``kind``, ``start``, ``end`` of every reported span."""
    exploded = scanned.select(F.col(_ROW).alias("row"), F.inline(_PARTS))
    before = Window.partitionBy("row", "kind").orderBy("i")
    placed = exploded.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(before))
    placed = placed.where("counts").select("row", "kind", (F.col("end") - F.col("size")).alias("start"), "end")
    base = placed.where(F.col("kind") < len(BASE))
    return base.unionByName(_linked(placed))


def _linked(placed: DataFrame) -> DataFrame:
    """Weak parts near their counterparts, by an interval join in bins of ``SCOPE`` code points.

    Parts of a role are first reduced to one row for each bin, with the first start and the
    last end in it; a scope is wider than a bin, so these two decide whether any part of the
    bin reaches into the scope.  Crowded texts make no pairs.
    """
    role = F.array(*(F.lit(k.role) for k in KINDS))[F.col("kind")]

    def bin_of(place: Column) -> Column:
        return F.floor(place / SCOPE)

    bins = F.explode(F.sequence(bin_of(F.col("start")), bin_of(F.col("end") - 1)))
    there = (
        placed.select("row", role.alias("role"), "start", "end", bins.alias("bin"))
        .groupBy("row", "bin", "role")
        .agg(
            F.min(F.greatest("start", F.col("bin") * SCOPE)).alias("first"),
            F.max(F.least("end", (F.col("bin") + 1) * SCOPE)).alias("last"),
        )
    )
    weak = placed.where(F.col("kind") >= len(BASE)).withColumns(
        {"low": F.col("start") - SCOPE, "high": F.col("end") + SCOPE}
    )
    asked = weak.withColumn("bin", F.explode(F.sequence(bin_of(F.col("low")), bin_of(F.col("high") - 1))))
    near = asked.join(there, ["row", "bin"]).where("first < high AND last > low")
    seen = near.groupBy("row", "kind", "start", "end").agg(
        *(F.max(F.col("role") == r).alias(r) for r in (IDENTITY, SECRET, ADDRESS))
    )
    enough = F.lit(False)
    for number, kind in enumerate(WEAK, len(BASE)):
        met = F.col("kind") == number
        for needed in kind.needs:
            met = met & F.col(needed)
        enough = enough | met
    return seen.where(enough).select("row", "kind", "start", "end")


def _listed(spans: DataFrame) -> DataFrame:
    names = F.array(*(F.lit(k.name) for k in KINDS))
    counts = {f"n_{k.name}": F.sum((F.col("kind") == n).cast("long")) for n, k in enumerate(BASE)}
    every = F.sort_array(F.collect_list(F.struct("start", "kind", "end")))
    listed = spans.groupBy("row").agg(every.alias("spans"), *(c.alias(n) for n, c in counts.items()))

    def text(span: Column) -> Column:
        return F.concat_ws(":", names[span["kind"]], span["start"], span["end"])

    base = F.transform(F.filter("spans", lambda s: s["kind"] < len(BASE)), text)
    return listed.select(
        F.col("row").alias(_ROW), *counts,
        F.array_join(base, ",").alias("base_spans"), F.array_join(F.transform("spans", text), ",").alias("spans"),
    )


def scanned(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys``, the number of base spans by kind, ``base_spans`` and ``spans`` for every row.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind, joined by
    commas.  Null and empty texts have none; repeated rows are scanned each; keys may be null.
    """
    found = staged(_with_parts(docs.select(*keys, text), text).drop(text), "scanned")
    listed = _listed(_spans(found))
    counts = [F.coalesce(f"n_{k.name}", F.lit(0).cast("long")).alias(f"n_{k.name}") for k in BASE]
    texts = [F.coalesce(c, F.lit("")).alias(c) for c in ("base_spans", "spans")]
    return found.join(listed, _ROW, "left").select(*keys, *counts, *texts)


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every reported span (overlapping ones as one) replaced by ``MASK``.

    All rows stay, with all their columns; null texts stay null.
    """
    return under_own_names(docs, _redacted, text)


def _redacted(docs: DataFrame, text: str) -> DataFrame:
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    marked = docs.withColumns({"hash__": F.xxhash64(whole), "size__": F.octet_length(whole)})
    # Spans depend on the text alone: they are kept without the texts, one row for each text.
    narrow = _with_parts(marked.select("hash__", "size__", F.col(f"`{text}`").alias("text__")), "text__")
    found = staged(narrow.drop("text__").where(F.size(_PARTS) > 0), "scanned")
    ordered = Window.partitionBy("row").orderBy("start", "end")
    reached = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    islands = _spans(found).withColumn("opens", (F.coalesce(reached, F.lit(-1)) < F.col("start")).cast("int"))
    islands = islands.withColumn("island", F.sum("opens").over(ordered)).groupBy("row", "island")
    islands = islands.agg(F.min("start").alias("start"), F.max("end").alias("end"))
    cuts = islands.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts__"))
    cuts = found.select("hash__", "size__", F.col(_ROW).alias("row")).join(cuts, "row").groupBy("hash__", "size__")
    rows = marked.join(cuts.agg(F.first("cuts__").alias("cuts__")), ["hash__", "size__"], "left")
    body = F.col(f"`{text}`")

    def before(cut: Column, i: Column) -> Column:
        begin = F.when(i == 0, F.lit(0)).otherwise(F.get("cuts__", i - 1)["end"])
        return F.substring(body, begin + 1, cut["start"] - begin)

    rest = F.substring(body, F.element_at("cuts__", -1)["end"] + 1, F.length(body))
    masked = F.array_join(F.concat(F.transform("cuts__", before), F.array(rest)), MASK)
    columns = [F.when(F.col("cuts__").isNull(), body).otherwise(masked).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    return rows.select(*columns)
