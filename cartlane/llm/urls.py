"""URL filter: listed rules, and the reputation of hosts from labelled page outcomes.

The share of bad pages of a host is a beta-binomial estimate. Its prior is the estimate of the
registered domain, whose prior is that of the suffix, whose prior is that of all pages. The
strength of each level's prior is fitted to the spread of the shares below it by the method of
moments. A host is blocked where the lower bound of its posterior reaches the limit, so a host
with few labels stands or falls with its domain. All of it is DataFrame functions.

Defined results: a null url, or one without ``://``, has an empty host and path, which is a host
like any other; repeated pages count each; outcomes repeated for an id count once, bad if any
is; without outcomes the estimate is even and nothing is blocked; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlane.llm.shared import kept


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


BLOCK, ALLOW = "block", "allow"

# The rules of the query.
RULES = (
    Rule("net", "/", BLOCK),
    Rule("example.net", "/en/", ALLOW),
    Rule("example.com", "/de/", BLOCK),
    Rule("org", "/fr/", ALLOW),
)

# Suffixes of two parts, under which domains are registered.
TWO_PART_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.in", "co.nz")

#: A host is blocked if its share of bad pages is this or more, at so many standard deviations.
LIMIT, DEVIATIONS = 0.5, 1.645

#: The strength of a prior, in pages, lies between these.
WEAKEST, STRONGEST = 1.0, 1000.0

_PARTS = r"^(?s).*?://([^/?#]*)([^?#]*)"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def suffix_of(host: Column) -> Column:
    two = F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)
    return F.when(two.isin(*TWO_PART_SUFFIXES), two).otherwise(F.regexp_extract(host, r"([^.]*)$", 1))


def domain_of(host: Column) -> Column:
    """The suffix and one name before it; the host itself where there is none."""
    two = F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)
    three = F.regexp_extract(host, r"([^.]+\.[^.]+\.[^.]+)$", 1)
    found = F.when(two.isin(*TWO_PART_SUFFIXES) & (three != ""), three).otherwise(two)
    return F.when(found == "", host).otherwise(found)


def rule_for(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null if none does."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))

    def fits(rule: Rule) -> Column:
        return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)

    def pick(value) -> Column:
        return reduce(
            lambda rest, r: F.when(fits(r), F.lit(value(r))).otherwise(rest), reversed(ordered), F.lit(None).cast("string")
        )

    return pick(lambda r: r.text), pick(lambda r: r.verdict)


def _strength(children: DataFrame) -> Column:
    """How many pages the prior is worth: moments of the shares of children with two pages or more.

    ``n``, ``bad`` of each child and ``mean`` of its parent. The spread of the shares around the
    parents, less what so few pages spread by chance, is the spread of the beta distribution.
    """
    labelled = children.filter("n >= 2")
    chance = F.col("mean") * (1 - F.col("mean"))
    sums = labelled.agg(
        F.sum((F.col("bad") / F.col("n") - F.col("mean")) ** 2).alias("spread"),
        F.sum(chance).alias("chance"),
        F.sum(chance / F.col("n")).alias("noise"),
    )
    beyond = F.col("spread") - F.col("noise")
    fitted = F.when(beyond > 0, (F.col("chance") - F.col("spread")) / beyond).otherwise(F.lit(STRONGEST))
    return sums.select(F.coalesce(F.least(F.greatest(fitted, F.lit(WEAKEST)), F.lit(STRONGEST)), F.lit(WEAKEST))).scalar()


def _shrunk(children: DataFrame, parents: DataFrame, by: str) -> DataFrame:
    """Adds ``strength`` and the ``mean`` of each child, its parent's mean as the prior."""
    # Written once: the strength is taken from all of them before any gets its mean.
    joined = kept(children.join(parents.select(by, "mean"), by), "reputation")
    return joined.withColumn("strength", _strength(joined)).withColumns(
        {
            "prior": F.col("mean"),
            "mean": (F.col("bad") + F.col("strength") * F.col("mean")) / (F.col("n") + F.col("strength")),
        }
    )


def host_reputation(hosts: DataFrame) -> DataFrame:
    """``host, n, bad, mean, bound``: the posterior mean and lower bound of the share of bad pages.

    ``hosts``: one row per host with ``n`` labelled and ``bad`` pages.
    """
    counted = kept(hosts.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))}), "hosts")
    sums = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = kept(counted.groupBy("suffix", "domain").agg(*sums), "domains")
    suffixes = domains.groupBy("suffix").agg(*sums)
    whole = suffixes.agg(*sums).select(
        F.lit(1).alias("all"),
        ((F.coalesce("bad", F.lit(0)) + 1) / (F.coalesce("n", F.lit(0)) + 2)).alias("mean"),
    )
    suffixes = _shrunk(suffixes.withColumn("all", F.lit(1)), whole, "all")
    domains = _shrunk(domains, suffixes, "suffix")
    found = _shrunk(counted, domains, "domain")
    good = F.col("bad") + F.col("strength") * F.col("prior")
    total = F.col("n") + F.col("strength")
    deviation = F.sqrt(good * (total - good) / (total * total * (total + 1)))
    return found.withColumn("bound", F.col("mean") - DEVIATIONS * deviation).select("host", "n", "bad", "mean", "bound")


def judge_pages(pages: DataFrame, outcomes: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "page_id") -> DataFrame:
    """``host``, ``path``, ``rule`` and ``verdict`` of every page.

    ``outcomes``: ``id`` of a page and ``bad``, 0 or 1. Pages and outcomes meet on the id, and pages
    and hosts on the host; a hot host is one row on its side, so adaptive joins split the pages.
    """
    rows = pages.select(key, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = outcomes.filter("bad IS NOT NULL").groupBy("id").agg(F.max("bad").cast("long").alias("bad"))
    labelled = rows.join(known, rows[key] == known["id"])
    counts = labelled.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"))
    # Hosts without labels have counts of zero and take their domain's estimate.
    hosts = (
        rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
        .join(counts, "host", "left")
        .select("host", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("bad", F.lit(0)).alias("bad"))
    )
    judged = host_reputation(hosts).select("host", F.when(F.col("bound") >= LIMIT, BLOCK).otherwise(ALLOW).alias("learned"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    return rows.join(judged, "host", "left").select(
        key, "host", "path", rule.alias("rule"), F.coalesce(verdict, "learned").alias("verdict")
    )
