"""URL filters: rules on hosts and paths first, then an empirical-Bayes reputation of the host.

Labelled page outcomes (1 bad, 0 good, null unlabelled) are counted per host. A host's bad rate has a
Beta prior around the rate of its registered domain, that one around its public suffix, that one around
the whole table. How strongly a level is drawn to its parent is the beta-binomial concentration of
the level, fitted by moments from all labelled pages. A page is blocked if even the lower posterior
bound of its host's bad rate is above the limit.

Only DataFrame functions. Counts are combined before every shuffle, so a host with a third of all pages
is one row per task; joining the result back to pages is a plain join that adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.text import lower_ascii, own, whole
from starmill.sources.scratch import written_once

#: Suffixes of two labels under which domains are registered (fixed values, a parameter everywhere).
TWO_LABEL_SUFFIXES = ("ac.uk", "co.jp", "co.uk", "com.au", "com.br", "gov.uk", "org.uk")
#: Concentrations are kept in these bounds, where the moments say nothing (few or equal groups).
LEAST_RHO, MOST_RHO = 1e-4, 0.99


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Limits:
    """A page is blocked if mean - z * deviation of its host's posterior exceeds ``block_above``."""

    block_above: float = 0.3
    z: float = 1.645


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end; empty for null or without ://."""
    rest = whole(F.get(F.split(url, "://", 2), F.lit(1)))
    return lower_ascii(F.regexp_extract(rest, "^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host, up to ? or # or the end."""
    rest = whole(F.get(F.split(url, "://", 2), F.lit(1)))
    return F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, both null if none does.

    A rule fits its host and all subdomains if the path starts with the rule's. Of rules of equal length
    the one given first wins.
    """
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.text)):
        fits = (host == rule.host) | host.endswith(f".{rule.host}")
        fits = fits & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def site_levels(
    host: Column, two_label_suffixes: Sequence[str] = TWO_LABEL_SUFFIXES
) -> tuple[Column, Column]:
    """Registered domain and public suffix of a host; an address is its own domain, without suffix."""
    name = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    two = F.substring_index(name, ".", -2)
    long_suffix = two.isin(*two_label_suffixes)
    address = name.rlike(r"^[0-9.]+$|^\[")
    domain = F.when(long_suffix, F.substring_index(name, ".", -3)).otherwise(two)
    suffix = F.when(long_suffix, two).otherwise(F.substring_index(name, ".", -1))
    return F.when(address, name).otherwise(domain), F.when(address, "").otherwise(suffix)


def concentration(children: DataFrame, parent: Sequence[str]) -> float:
    """The beta-binomial concentration of a level: of child rates (n, bad) around those of parents.

    With rate p, n pages and K children of a parent, sum of n * (child rate - p)^2 is expected to be
    p(1-p) * ((K-1) + rho * (n - sum n^2 / n - (K-1))). Solved for rho over all parents; one row is
    fetched.
    """
    labelled = children.where("n > 0")
    keys = list(parent) or [F.lit(0).alias("all")]
    parents = labelled.groupBy(*keys).agg(
        F.sum("n").alias("N"),
        F.sum("bad").alias("B"),
        F.count("*").alias("K"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
        F.sum(F.col("bad").cast("double") * F.col("bad") / F.col("n")).alias("bb"),
    )
    rate = F.col("B") / F.col("N")
    spread = rate * (1 - rate)
    free = F.col("K") - 1
    row = parents.agg(
        F.sum(F.col("bb") - F.col("N") * rate * rate - spread * free).alias("excess"),
        F.sum(spread * (F.col("N") - F.col("nn") / F.col("N") - free)).alias("weight"),
    ).first()
    rho = row["excess"] / row["weight"] if row["weight"] and row["weight"] > 1e-12 else LEAST_RHO
    rho = min(max(rho, LEAST_RHO), MOST_RHO)
    return 1 / rho - 1


def host_posteriors(
    hosts: DataFrame, two_label_suffixes: Sequence[str] = TWO_LABEL_SUFFIXES
) -> DataFrame:
    """Posterior mean and deviation of the bad rate of each row of ``hosts`` (host, n, bad)."""
    domain, suffix = site_levels(F.col("host"), two_label_suffixes)
    named = hosts.withColumns({"domain": domain, "suffix": suffix})
    counts = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = named.groupBy("suffix", "domain").agg(*counts)
    suffixes = domains.groupBy("suffix").agg(*counts)
    total = suffixes.agg(*counts).first()
    overall = (total["bad"] or 0) / total["n"] if total["n"] else 0.0
    by_suffix = concentration(suffixes, [])
    by_domain = concentration(domains, ["suffix"])
    by_host = concentration(named, ["suffix", "domain"])

    def shrunk(strength: float, around: Column) -> Column:
        return (F.col("bad") + F.lit(strength) * around) / (F.col("n") + F.lit(strength))

    suffix_rate = suffixes.select("suffix", shrunk(by_suffix, F.lit(overall)).alias("suffix_rate"))
    domain_rate = domains.join(suffix_rate, "suffix").select(
        "suffix", "domain", shrunk(by_domain, F.col("suffix_rate")).alias("domain_rate")
    )
    weight = F.col("n") + F.lit(by_host)
    return (
        named.join(domain_rate, ["suffix", "domain"])
        .withColumn("bad_rate", shrunk(by_host, F.col("domain_rate")))
        .withColumn(
            "bad_rate_deviation", F.sqrt(F.col("bad_rate") * (1 - F.col("bad_rate")) / (weight + 1))
        )
        .select("host", "bad_rate", "bad_rate_deviation")
    )


def judged_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    url: str = "url",
    outcome: str = "outcome",
    limits: Limits = Limits(),
    two_label_suffixes: Sequence[str] = TWO_LABEL_SUFFIXES,
) -> DataFrame:
    """Every row of ``pages`` with host, path, rule and verdict (allow or block) appended.

    ``outcome`` is 1 for a bad page, 0 for a good one, null for an unlabelled one; it is not returned.
    Null urls and those without :// have empty host and path, fit no rule and share the reputation of
    the empty host. A host without labelled pages has its domain's rate. Repeated rows count and return
    as often as they occur; other columns stay, but for host, path, rule and verdict, which are
    replaced. An empty table gives an empty result; with no labelled page everything is allowed.
    """
    others = [F.col(f"`{c}`") for c in pages.columns if c not in {"host", "path", "rule", "verdict", outcome}]
    joined, hidden = own("host"), own("outcome")
    seen = pages.select(
        *others,
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
        F.col(outcome).cast("int").alias(hidden),
    )
    hosts = seen.groupBy("host").agg(
        F.count(hidden).alias("n"), F.coalesce(F.sum(hidden), F.lit(0)).alias("bad")
    )
    # Read for every level's total and strength and for the result: one aggregate of the pages.
    hosts = written_once(hosts, "host-counts")
    rate, deviation = own("rate"), own("deviation")
    posterior = host_posteriors(hosts, two_label_suffixes).select(
        F.col("host").alias(joined), F.col("bad_rate").alias(rate), F.col("bad_rate_deviation").alias(deviation)
    )
    rule, ruled = matching_rule(F.col("host"), F.col("path"), rules)
    bound = F.col(rate) - limits.z * F.col(deviation)
    judged = F.when(bound > limits.block_above, "block").otherwise("allow")
    return (
        seen.join(posterior, F.col("host") == F.col(joined), "left")
        .withColumns({"rule": rule, "verdict": F.coalesce(ruled, judged)})
        .drop(hidden, rate, deviation, joined)
    )
