"""URL filtering by rules, and by an empirical-Bayes reputation of hosts.

Labelled page outcomes are beta-binomial: a suffix's share of bad pages is drawn around the
overall share, a registered domain's around its suffix's, a host's around its domain's.  The
strength of each level comes from the data, by moments.  What a member learns from its level
comes from the other members, so that no page counts twice, and is as uncertain as they leave
it.  A host is blocked if the lower bound of its posterior share of bad pages passes a
threshold; hosts without labels have the posterior of their domain or suffix, and its width.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.sources.staging import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"

# Frequent public suffixes of two labels.
TWO_LABELS = (
    "ac.uk co.uk gov.uk org.uk ac.jp co.jp ne.jp or.jp com.au net.au org.au edu.au com.br net.br org.br "
    "com.cn net.cn org.cn com.mx com.tr com.tw co.in co.kr co.nz co.za"
).split()

LEAST_SPREAD, MOST_SPREAD = 1e-3, 0.999  # of the share of variance between the members of a level
LEAST_STRENGTH = 2.0  # pseudo-counts of a prior, at least: one bad page is no proof, however pure hosts are
DEVIATIONS = 1.6448536269514722  # of the posterior that its bound lies below its mean (95 in 100)
THRESHOLD = 0.5
SALTS = 16


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, in ASCII lower case; empty if there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def with_domains(hosts: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """Add ``suffix`` and ``domain`` (the registered one: the suffix and a label before it) to rows with distinct ``host``.

    suffixes: a column ``suffix`` of public suffixes, such as a public list; by default those of
    ``TWO_LABELS``, with which hosts under other suffixes of two labels pass for one domain.
    The longest one that a host ends in is its suffix, else its last label.  A port doesn't count.
    """
    if suffixes is None:
        suffixes = hosts.sparkSession.createDataFrame([(s,) for s in TWO_LABELS], "suffix string")
    labels = F.split(F.regexp_replace("host", ":[0-9]*$", ""), r"\.")
    size = F.size(labels)
    tails = F.transform(F.sequence(F.lit(1), size), lambda i: F.array_join(F.slice(labels, i, size), "."))
    met = hosts.select("host", F.explode(tails).alias("tail")).join(suffixes.select(F.col("suffix").alias("tail")).distinct(), "tail")
    longest = met.groupBy("host").agg(F.max_by("tail", F.length("tail")).alias("suffix"))
    found = hosts.join(longest, "host", "left").withColumn("suffix", F.coalesce("suffix", F.element_at(labels, -1)))
    count = F.size(F.split("suffix", r"\.")) + 1
    return found.withColumn("domain", F.array_join(F.slice(labels, F.greatest(size - count + 1, F.lit(1)), count), "."))


def _spread(groups: DataFrame, mean: Column) -> float:
    """The correlation of the outcomes in a group, given each group's expected share.

    Of counts n and bad x around means m, (x - nm)² exceeds n m (1 - m) by n (n - 1) m (1 - m)
    times it on average.
    """
    noise = F.col("n") * mean * (1 - mean)
    over = F.sum((F.col("bad") - F.col("n") * mean) ** 2 - noise)
    row = groups.where("n > 1").agg(over.alias("over"), F.sum((F.col("n") - 1) * noise).alias("room")).first()
    found = row["over"] / row["room"] if row["room"] else LEAST_SPREAD
    return min(max(found, LEAST_SPREAD), MOST_SPREAD)


def _placed(groups: DataFrame, above: DataFrame, key: str) -> DataFrame:
    """Add ``prior`` and ``strength``: what the rest of the group above says about each member.

    above: ``key``, its counts ``n_above`` and ``bad_above``, and its own ``prior_above`` and
    ``strength_above``.  The variances of a member around its group and of the group's share
    add up, so their pseudo-counts (plus one) add up inversely.
    """
    joined = groups.join(above, key)
    weight = F.col("n_above") - F.col("n") + F.col("strength_above")
    bad = F.col("bad_above") - F.col("bad") + F.col("strength_above") * F.col("prior_above")
    joined = joined.withColumns({"prior": bad / weight, "certain": weight})
    spread = _spread(joined, F.col("prior"))
    inverse = F.lit(spread) + 1 / (F.col("certain") + 1)
    return joined.withColumn("strength", F.greatest(1 / inverse - 1, F.lit(LEAST_STRENGTH)))


def _above(groups: DataFrame, key: str) -> DataFrame:
    return groups.select(key, *(F.col(c).alias(f"{c}_above") for c in ("n", "bad", "prior", "strength")))


def reputations(outcomes: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """Posterior ``mean``, ``weight`` and lower ``bound`` of the share of bad pages, for each host.

    outcomes: ``host`` and ``bad`` (true, false, or null where unknown), one row for each page.
    Counts are summed by host before anything else, so a host with a third of all pages is one
    row in each later step.  suffixes: see :func:`with_domains`.
    """
    known = F.col("bad").isNotNull().cast("long")
    hosts = outcomes.groupBy("host").agg(F.sum(known).alias("n"), F.sum(F.coalesce(F.col("bad").cast("long"), F.lit(0))).alias("bad"))
    hosts = staged(with_domains(staged(hosts, "hosts"), suffixes), "hosts")  # each level reads it several times
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = (total["bad"] + 1) / (total["n"] + 2) if total["n"] else 0.5
    spread = _spread(suffixes, F.lit(overall))
    suffixes = suffixes.withColumns({"prior": F.lit(overall), "strength": F.lit((1 - spread) / spread)})
    placed = staged(_placed(domains, _above(suffixes, "suffix"), "suffix"), "domains")
    out = _placed(hosts, _above(placed, "domain"), "domain")
    out = out.withColumn("weight", F.col("n") + F.col("strength"))
    out = out.withColumn("mean", (F.col("bad") + F.col("strength") * F.col("prior")) / F.col("weight"))
    out = out.select("host", "domain", "suffix", "n", "bad", "mean", "weight")
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    return out.withColumn("bound", F.col("mean") - DEVIATIONS * deviation)


def _fitting(hosts: DataFrame, rules: list[Rule]) -> DataFrame:
    """For each host that some rule's host covers, these rules, the longest first."""
    spark = hosts.sparkSession
    listed = spark.createDataFrame([(r.host, r.path, str(r), r.verdict) for r in rules], "covers string, prefix string, rule string, says string")
    labels = F.split("host", r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    met = hosts.select("host", F.explode(tails).alias("covers")).join(listed, "covers")
    order = F.struct(F.length("rule").alias("size"), "rule", "prefix", "says")
    return met.groupBy("host").agg(F.sort_array(F.collect_list(order), asc=False).alias("rules__"))


def judged(
    pages: DataFrame, outcomes: DataFrame, rules: list[Rule], threshold: float = THRESHOLD, suffixes: DataFrame | None = None
) -> DataFrame:
    """All columns of ``pages`` (``url`` among them), ``host``, ``path``, ``rule``, ``verdict``, ``mean``, ``bound``.

    A rule fits its host and the hosts below it, on paths that begin with the rule's; the
    longest fitting rule decides, else the posterior bound.  Null urls and urls without ``://``
    have an empty host, which has a reputation like any other.  Columns of ``pages`` with the
    names of new ones are replaced.
    """
    new = ("host", "path", "rule", "verdict", "mean", "bound")
    rows = pages.drop(*(c for c in new if c != "url")).withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    known = staged(reputations(outcomes, suffixes).select("host", "mean", "bound"), "reputations")
    by_host = rows.select("host").distinct().join(known, "host", "left")
    by_host = by_host.join(_fitting(by_host.select("host"), rules), "host", "left")
    # A host may have a third of the pages: it is dealt to several tasks by their urls.
    by_host = by_host.withColumn("salt__", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt__", F.pmod(F.xxhash64("url"), F.lit(SALTS)).cast("int"))
    placed = rows.join(by_host, ["host", "salt__"], "left").drop("salt__")
    first = F.get(F.filter("rules__", lambda r: F.col("path").startswith(r["prefix"])), 0)
    blocked = F.coalesce(F.col("bound") > threshold, F.lit(False))
    verdict = F.when(first.isNotNull(), first["says"]).when(blocked, F.lit("block")).otherwise(F.lit("allow"))
    return placed.withColumns({"rule": first["rule"], "verdict": verdict}).drop("rules__")
