"""Queries over the given tables, one for each operator, and their SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm import (
    bpe,
    byte_bpe,
    conversations,
    decontamination,
    embeddings,
    language,
    lm,
    merkle,
    packing,
    reputation,
    secrets,
    simhash,
    warc,
)
from tillflow.llm.work import new_folder, prepared, table


VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _remainder(modulus: int) -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % modulus


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    indexed = decontamination.index(table(spark, folder, "documents").select("doc_id", "text"), ["doc_id"])
    found = decontamination.contamination(indexed, table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_language_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", _remainder(7) == 2)
    model = lm.learn(docs.where("NOT held_out"))
    found = lm.scored(docs, model, ["doc_id", "held_out"])
    return found.withColumn("train_tokens", F.lit(model.vocabulary.tokens).cast("long"))


def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_documents(table(spark, folder, "documents"), VOCABULARY)


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    archive = new_folder(spark, "warc")
    warc.write(table(spark, folder, "pages"), archive)
    return warc.read(spark, archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


URL_RULES = [
    reputation.Rule("block", "net", "/"),
    reputation.Rule("allow", "example.net", "/en/"),
    reputation.Rule("block", "example.com", "/de/"),
    reputation.Rule("allow", "org", "/fr/"),
]


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """A page was made of the document whose number its path tells; it is bad if that is toxic or of low quality."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    number = F.regexp_extract(reputation.path(F.col("url")), r"^/[^/]*/([0-9]{1,18})", 1)
    numbered = pages.select(reputation.host(F.col("url")).alias("host"), number.try_cast("bigint").alias("doc_id"))
    labels = table(spark, folder, "labels").groupBy("doc_id").agg(F.max((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad"))
    outcomes = numbered.join(labels, "doc_id", "left").select("host", "bad")
    return reputation.judged(pages, outcomes, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", _remainder(5) == 0)
    model = language.learn(docs.where("NOT held_out"))
    found = language.identified(docs, model, ["doc_id", "held_out"])
    spans = F.transform("spans", lambda s: F.concat_ws(":", s["lang"], s["start"], s["end"]))
    return found.withColumn("spans", F.array_join(spans, ","))


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scanned(table(spark, folder, "documents"), ["doc_id"])
    digest = F.sha2("base_spans", 256).alias("base_sha256")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", digest, "spans")


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.with_token_counts(table(spark, folder, "documents"), VOCABULARY, ["doc_id"])


def op10_embedding_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, folder, "embeddings"))


def _damaged(rows: DataFrame) -> DataFrame:
    """Conversations with rows dropped, emptied, cut short, repeated or given to the user, by a checksum of their place."""
    place = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    marked = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(place) % 20).alias("damage"))
    damage = F.col("damage")
    return marked.where(damage != 0).select(
        "conv_id",
        "turn",
        F.when(damage == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(damage == 1, "").when(damage == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(damage == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    found = conversations.repair(_damaged(rows))
    left = found.conversations.join(found.digests(), "name", "left").drop("name")
    known = F.col("digest").isNotNull()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    whole = rows.select("conv_id").distinct()
    return whole.join(left.withColumnRenamed("conv_id", "id__"), F.col("conv_id").eqNullSafe(F.col("id__")), "left").select(
        "conv_id",
        *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.when(known, F.lower(F.hex("digest"))).otherwise(F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    lowered = F.translate("text", reputation.UPPER, reputation.LOWER)

    def leaf(text: Column) -> Column:
        return merkle.leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)

    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0  # not without an id
    leaves = docs.select("doc_id", "source", leaf(F.col("text")).alias("leaf"), F.when(tampered, leaf(lowered)).alias("claim"))
    found = merkle.manifest(leaves, "source", ["doc_id"], ["doc_id"]).proved()

    def digits(name: str) -> Column:
        return F.lower(F.hex(name))

    return found.select(
        "key.doc_id",
        digits("leaf").alias("leaf"),
        digits("subroot").alias("subroot"),
        digits("root").alias("root"),
        digits("proof").alias("proof_sha256"),
        digits("folded").alias("folded_root"),
        "verified",
    )


def op13_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = byte_bpe.encoded(docs, BYTE_VOCABULARY, public_tokenizers.PATTERN, ["doc_id"], decode=True)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


_QUERIES = [op1_decontamination, op2_language_model, op3_best_fit_packing, op4_warc, op5_url_filter, op6_language_id, op7_simhash, op8_secret_scan, op9_token_counts, op10_embedding_duplicates, op11_conversation_repair, op12_merkle_manifest, op13_byte_bpe]

_SUFFIXES = ", ".join(f"'{s}'" for s in reputation.TWO_LABELS)


def _spread_sql(name: str, source: str) -> str:
    noise = "n * prior * (1 - prior)"
    return f"""
{name}_spread AS (
  SELECT CASE WHEN coalesce(sum((n - 1) * {noise}), 0) = 0 THEN {reputation.LEAST_SPREAD}
         ELSE least(greatest(sum((bad - n * prior) ** 2 - {noise}) / sum((n - 1) * {noise}),
                             {reputation.LEAST_SPREAD}), {reputation.MOST_SPREAD}) END AS spread
  FROM {source} WHERE n > 1)"""


def _placed_sql(name: str, members: str, above: str, key: str) -> str:
    """CTEs with the prior of each member from the rest of its group, and its strength."""
    return f"""
{name}_prior AS (
  SELECT m.*, a.n - m.n + a.strength AS certain,
         (a.bad - m.bad + a.strength * a.prior) / (a.n - m.n + a.strength) AS prior
  FROM {members} m JOIN {above} a USING ({key})),
{_spread_sql(name, f"{name}_prior")},
{name}_placed AS (
  SELECT p.*, greatest(1 / (spread + 1 / (certain + 1)) - 1, {reputation.LEAST_STRENGTH}) AS strength
  FROM {name}_prior p, {name}_spread)"""


def _words_sql(text: str) -> str:
    lowered = f"translate(coalesce({text}, ''), '{reputation.UPPER}', '{reputation.LOWER}')"
    return rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


_FIVE_BITS = ", ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((n >> {k}) & 31), 1)" for k in (15, 10, 5, 0))


def _crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    return f"""xor(4294967295, list_reduce(
    list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda c, b: list_reduce(range(8), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(c, b)),
    4294967295))"""


def _leaf_sql(text: str) -> str:
    values = [f"CAST({v} AS VARCHAR)" for v in ("doc_id", "source", "lang", "n_chars", text)]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


def _tree_sql(name: str, levels: int) -> str:
    """CTEs over ``name``0 (g, p, d): nodes and siblings by level, and the root of each g; up to 16^levels nodes a g."""
    ctes = []
    for level in range(levels):
        many = f"{name}{level} WHERE g IN (SELECT g FROM {name}{level} GROUP BY g HAVING count(*) > 1)"
        side = "string_agg(d, '') OVER (PARTITION BY g, p // 16 ORDER BY p ROWS BETWEEN {})"
        ctes.append(f"{name}{level + 1} AS (SELECT g, p // 16 AS p, sha256(string_agg(d, '' ORDER BY p)) AS d FROM {many} GROUP BY ALL)")
        ctes.append(
            f"{name}_ways{level} AS (SELECT g, p, coalesce({side.format('UNBOUNDED PRECEDING AND 1 PRECEDING')}, '') AS a, "
            f"coalesce({side.format('1 FOLLOWING AND UNBOUNDED FOLLOWING')}, '') AS b FROM {many})"
        )
    tops = [f"SELECT g, min(d) AS d FROM {name}{level} GROUP BY g HAVING count(*) = 1" for level in range(levels + 1)]
    return ", ".join([*ctes, f"{name}_roots AS ({' UNION ALL '.join(tops)})"])


def _climb_sql(source: str, name: str, levels: int) -> str:
    """CTEs that take ``source`` (g, p, now, siblings, ...) up a tree, ending in ``name``_climbed."""
    ctes, last = [], source
    for level in range(levels):
        this = f"{name}_climbed" if level == levels - 1 else f"{name}_up{level}"
        ctes.append(
            f"{this} AS (SELECT l.* REPLACE (CASE WHEN w.g IS NULL THEN l.p ELSE l.p // 16 END AS p, "
            "siblings || coalesce(a || b, '') AS siblings, CASE WHEN w.g IS NULL THEN now ELSE sha256(a || now || b) END AS now) "
            f"FROM {last} l LEFT JOIN {name}_ways{level} w ON l.g = w.g AND l.p = w.p)"
        )
        last = this
    return ", ".join(ctes)


_PLACE = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"

SQL: dict[str, str] = {
    "op11_conversation_repair": f"""
WITH RECURSIVE marked AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32_sql(_PLACE)} % 20 AS damage FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
         CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN damage = 3 THEN 2 ELSE 1 END)) AS copy
  FROM marked WHERE damage <> 0),
sorted AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
  FROM damaged),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM sorted),
judged AS (
  SELECT *, body = '' AS blank, body <> '' AND again AS duplicate,
         body <> '' AND NOT again AND right(body, 1) NOT IN ('.', '!', '?') AS truncated, body = '' OR again AS doomed,
         CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS initial,
         coalesce(lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) NOT IN ('su', 'ua', 'au'), false) AS illegal
  FROM seen),
inserts(f, t, c, a) AS (VALUES (0, 0, 0, ''), (0, 2, 3, 'I'), (0, 3, 6, 'II'), (1, 1, 0, ''), (1, 2, 3, 'I'), (1, 3, 6, 'II'),
  (2, 2, 0, ''), (2, 3, 3, 'I'), (3, 3, 0, ''), (3, 2, 3, 'I')),
steps(initial, f, t) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
initials(initial) AS (VALUES ('s'), ('u'), ('a'), ('o')),
edits AS (
  SELECT initial, f, t, 0 AS c, 'K' AS e FROM steps
  UNION ALL SELECT initials.initial, f, t, 3, 'R' FROM initials, steps WHERE steps.initial <> 's'
  UNION ALL SELECT initial, f, f, 4, 'D' FROM initials, range(4) r(f)),
best AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS s, struct_pack(c := CAST(0 AS BIGINT), a := '') AS b FROM damaged
  UNION ALL
  SELECT conv_id, i, s, min(b) FROM (
    SELECT best.conv_id, judged.i, CAST(edits.t AS BIGINT) AS s,
           struct_pack(c := CAST(best.b.c + inserts.c + edits.c + CASE WHEN truncated AND e <> 'D' THEN 3 ELSE 0 END AS BIGINT),
                       a := best.b.a || inserts.a || e) AS b
    FROM best JOIN judged ON judged.conv_id IS NOT DISTINCT FROM best.conv_id AND judged.i = best.i + 1
    JOIN inserts ON inserts.f = best.s
    JOIN edits ON edits.f = inserts.t AND edits.initial = judged.initial AND (NOT doomed OR e = 'D'))
  GROUP BY ALL),
last AS (SELECT conv_id, max(i) AS i FROM judged GROUP BY conv_id),
chosen AS (
  SELECT best.conv_id, min(struct_pack(c := b.c + inserts.c, a := b.a || inserts.a)) AS b
  FROM best JOIN last ON last.conv_id IS NOT DISTINCT FROM best.conv_id AND last.i = best.i
  JOIN inserts ON inserts.f = best.s WHERE inserts.t IN (0, 3) GROUP BY ALL),
letters AS (SELECT conv_id, unnest(range(1, CAST(length(b.a) AS BIGINT) + 1)) AS p, b.a AS audit FROM chosen),
edited AS (
  SELECT conv_id, p, audit[p] AS e, count(*) FILTER (WHERE audit[p] <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS i,
         count(*) FILTER (WHERE audit[p] <> 'D') OVER (PARTITION BY conv_id ORDER BY p) AS q
  FROM letters),
kept AS (
  SELECT edited.conv_id, p, e, q, CASE WHEN e = 'K' THEN role END AS own, CASE WHEN e = 'I' THEN '' ELSE text END AS text,
         max(e = 'K' AND q = 1 AND left(role, 1) = 's') OVER (PARTITION BY edited.conv_id) AS system
  FROM edited LEFT JOIN judged ON judged.conv_id IS NOT DISTINCT FROM edited.conv_id AND judged.i = edited.i
  WHERE e <> 'D'),
repaired AS (
  SELECT conv_id, string_agg(coalesce(own, CASE WHEN (q - CASE WHEN system THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END)
                             || ':' || text, chr(10) ORDER BY p) AS body
  FROM kept GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
         count(*) FILTER (WHERE duplicate) AS duplicate, count(*) FILTER (WHERE truncated) AS truncated,
         count(*) FILTER (WHERE illegal) AS illegal
  FROM judged GROUP BY conv_id),
whole AS (SELECT DISTINCT conv_id FROM conversations)
SELECT whole.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.c, 0) AS cost, coalesce(b.a, '') AS audit,
       sha256(coalesce(body, '')) AS repaired_sha256
FROM whole LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM whole.conv_id
LEFT JOIN chosen ON chosen.conv_id IS NOT DISTINCT FROM whole.conv_id
LEFT JOIN repaired ON repaired.conv_id IS NOT DISTINCT FROM whole.conv_id""",
    "op12_merkle_manifest": f"""
WITH base AS (
  SELECT doc_id, coalesce('1' || source, '0') AS g, {_leaf_sql('text')} AS leaf,
         CASE WHEN {_crc32_sql('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN {_leaf_sql(f"translate(text, '{reputation.UPPER}', '{reputation.LOWER}')")} END AS claim
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
         coalesce(claim, leaf) AS now, '' AS siblings
  FROM base),
s0 AS (SELECT g, p, leaf AS d FROM leaves), {_tree_sql('s', 6)}, {_climb_sql('leaves', 's', 6)},
places AS (SELECT g AS source, d AS subroot, row_number() OVER (ORDER BY g) - 1 AS p FROM s_roots),
t0 AS (SELECT 0 AS g, p, subroot AS d FROM places), {_tree_sql('t', 4)},
through AS (
  SELECT c.* REPLACE (0 AS g, places.p AS p), subroot FROM s_climbed c JOIN places ON c.g = places.source),
{_climb_sql('through', 't', 4)}
SELECT doc_id, leaf, subroot, d AS root, sha256(siblings) AS proof_sha256, now AS folded_root, now = d AS verified
FROM t_climbed, t_roots""",
    "op1_decontamination": f"""
WITH d AS (SELECT doc_id, {_words_sql('text')} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_words_sql('text')} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS k
  FROM b, unnest(range(1, greatest(len(w) - 10, 0) + 2)) t(s) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, s, size, array_to_string(w[s:s + size - 1], ' ') AS k
  FROM (SELECT * FROM d, sizes), unnest(range(1, len(w) - size + 2)) t(s)),
matches AS (SELECT DISTINCT doc_id, s, size, item_id FROM places JOIN windows USING (size, k)),
hit AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + size)) AS word FROM matches) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM matches WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op4_warc": f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS kept, sha1(coalesce(html, '')) AS hex
  FROM pages)
SELECT page_id, strlen(html) AS payload_bytes,
       array_to_string(list_transform(range(8), lambda g: concat(
         {_FIVE_BITS.replace("n >>", "CAST('0x' || substr(hex, CAST(5 * g + 1 AS BIGINT), 5) AS INTEGER) >>")})), '') AS payload_digest,
       CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM p""",
    "op10_embedding_duplicates": """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
usable AS (
  SELECT vec_id, e FROM v
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT a AS vec_id, (SELECT count(*) FROM links WHERE links.a = reach.a) AS n_links,
       min(b) AS component_id, a = min(b) AS kept
FROM reach GROUP BY a""",
    "op5_url_filter": f"""
WITH urls AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                            '{reputation.UPPER}', '{reputation.LOWER}') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
marks AS (SELECT doc_id, max(toxic = 1 OR quality = 0) AS bad FROM labels GROUP BY doc_id),
outcomes AS (
  SELECT host, bad FROM urls
  LEFT JOIN marks ON doc_id = TRY_CAST(regexp_extract(path, '^/[^/]*/([0-9]{{1,18}})', 1) AS BIGINT)),
hosts AS (
  SELECT host, CAST(count(bad) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE bad) AS DOUBLE) AS bad,
         list_reverse(string_split(regexp_replace(host, ':[0-9]*$', ''), '.')) AS parts,
         array_to_string(list_reverse(parts[1:2]), '.') IN ({_SUFFIXES}) AS two,
         array_to_string(list_reverse(parts[1:(CASE WHEN two THEN 2 ELSE 1 END)]), '.') AS suffix,
         array_to_string(list_reverse(parts[1:(CASE WHEN two THEN 3 ELSE 2 END)]), '.') AS domain
  FROM outcomes GROUP BY host),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
suffixes AS (
  SELECT suffix, sum(n) AS n, sum(bad) AS bad,
         (SELECT CASE WHEN sum(n) > 0 THEN (sum(bad) + 1) / (sum(n) + 2) ELSE 0.5 END FROM domains) AS prior
  FROM domains GROUP BY suffix),
{_spread_sql('suffix', 'suffixes')},
suffix_placed AS (SELECT s.*, (1 - spread) / spread AS strength FROM suffixes s, suffix_spread),
{_placed_sql('domain', 'domains', 'suffix_placed', 'suffix')},
{_placed_sql('host', 'hosts', 'domain_placed', 'domain')},
posterior AS (SELECT host, n + strength AS weight, (bad + strength * prior) / (n + strength) AS mean FROM host_placed),
blocked AS (
  SELECT host, mean - {reputation.DEVIATIONS} * sqrt(mean * (1 - mean) / (weight + 1)) > {reputation.THRESHOLD} AS bad_host
  FROM posterior),
rules(says, covers, prefix) AS (VALUES {", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in URL_RULES)}),
fitting AS (
  SELECT host, path, arg_max(covers || prefix, length(covers || prefix)) AS rule,
         arg_max(says, length(covers || prefix)) AS says
  FROM (SELECT DISTINCT host, path FROM urls) JOIN rules
    ON (host = covers OR ends_with(host, '.' || covers)) AND starts_with(path, prefix)
  GROUP BY ALL)
SELECT page_id, host, path, rule,
       coalesce(says, CASE WHEN bad_host THEN 'block' ELSE 'allow' END) AS verdict
FROM urls LEFT JOIN fitting USING (host, path) LEFT JOIN blocked USING (host)""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def with_settings(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
        return wraps(query)(lambda spark, folder: query(prepared(spark), folder))

    return {query.__name__: with_settings(query) for query in _QUERIES}
