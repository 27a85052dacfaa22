"""URL filter: host rules first, then the host's reputation by empirical Bayes.

Labelled pages count as outcomes, bad or not, of their host. The bad share of a suffix (the last label, or more where a
country registers names below a second one) is shrunk towards the whole, that of a registered domain (the suffix and
one label) towards its suffix, that of a host towards its domain, each by a beta prior whose weight is fitted by
moments from how much siblings differ. A host is blocked if its share is above `limit` with the given certainty: mean
less z standard deviations of the posterior.

Defined results: a null URL, or one without `://`, has an empty host and path; the empty host is judged like any
other; a page whose outcome is null counts for nothing; equal rows are all returned; without labels no host is
blocked.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import settle

# Suffixes of two labels under which names are registered. A fuller list can be given as a parameter.
SUFFIXES = (
    "ac.jp", "ac.uk", "co.id", "co.il", "co.in", "co.jp", "co.ke", "co.kr", "co.nz", "co.th", "co.uk", "co.za", "com.ar",
    "com.au", "com.br", "com.cn", "com.co", "com.eg", "com.hk", "com.mx", "com.my", "com.ng", "com.pe", "com.ph", "com.pk",
    "com.pl", "com.sa", "com.sg", "com.tr", "com.tw", "com.ua", "com.ve", "com.vn", "edu.au", "edu.cn", "gov.au", "gov.br",
    "gov.cn", "gov.in", "gov.uk", "me.uk", "ne.jp", "net.au", "net.br", "net.cn", "nhs.uk", "or.jp", "or.kr", "org.au",
    "org.br", "org.cn", "org.nz", "org.uk", "org.za")
LIMIT, Z = 0.5, 1.645
LEAST_RATIO, MOST_RATIO = 1e-4, 0.99


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    whole = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(whole, "://")
    rest = F.when(at > 0, whole.substr(at + 3, F.length(whole))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def matching_rule(rules: Sequence[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null if none does. rules: (verdict, host/path)."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, rule in sorted(rules, key=lambda x: len(x[1])):
        domain, _, start = rule.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(f"/{start}")
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, decision).otherwise(verdict)
    return name, verdict


def _ratio(level: DataFrame) -> float:
    """Correlation within the level's groups, by moments: columns n, bad and the parent's share."""
    spread = F.col("parent") * (1 - F.col("parent"))
    seen, noise, pairs = level.where("n > 0").agg(
        F.sum(F.pow(F.col("bad") - F.col("n") * F.col("parent"), 2) / F.col("n")), F.sum(spread),
        F.sum(spread * (F.col("n") - 1))).first()
    if not pairs:
        return LEAST_RATIO
    return min(MOST_RATIO, max(LEAST_RATIO, (seen - noise) / pairs))


def _shrunk(level: DataFrame) -> tuple[Column, float]:
    """The posterior mean of each row given its parent's, and the prior's weight."""
    ratio = _ratio(level)
    weight = 1 / ratio - 1
    return (F.col("bad") + weight * F.col("parent")) / (F.col("n") + weight), weight


def domain_and_suffix(host: str, suffixes: Sequence[str]) -> tuple[Column, Column]:
    """The registered domain and the suffix of a host; a host of one label is both."""
    last_two = F.substring_index(host, ".", -2)
    double = last_two.isin(*suffixes)
    return (F.when(double, F.substring_index(host, ".", -3)).otherwise(last_two),
            F.when(double, last_two).otherwise(F.substring_index(host, ".", -1)))


def host_reputation(outcomes: DataFrame, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """outcomes: host, bad (1, 0 or null). (host, n, mean, lower): posterior of the host's bad share."""
    domain, suffix = domain_and_suffix("host", suffixes)
    z = F.lit(Z)
    hosts = settle(outcomes.groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad")).select(
        "host", domain.alias("domain"), suffix.alias("suffix"), "n", "bad"), "hosts")
    total = hosts.agg(F.sum("n"), F.sum("bad")).first()
    start = ((total[1] or 0) + 0.5) / ((total[0] or 0) + 1.0)

    def summed(*keys: str) -> DataFrame:
        return hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    suffixes = summed("suffix").withColumn("parent", F.lit(start))
    mean, _ = _shrunk(suffixes)
    domains = summed("suffix", "domain").join(suffixes.select("suffix", mean.alias("parent")), "suffix")
    mean, _ = _shrunk(domains)
    own = hosts.join(domains.select("domain", mean.alias("parent")), "domain")
    mean, weight = _shrunk(own)
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + weight + 1))
    return own.select("host", "n", mean.alias("mean")).withColumn("lower", F.col("mean") - z * deviation)


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]], limit: float = LIMIT,
          url: str = "url", keep: Sequence[str] = ("page_id",), suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """The kept columns, host, path, rule, lower (the host's bound) and verdict of every page.

    outcomes: url, bad (1, 0 or null).
    """
    host, path = host_and_path(url)
    known = host_reputation(outcomes.select(host_and_path("url")[0].alias("host"), F.col("bad").cast("int").alias("bad")), suffixes)
    rows = pages.select(*keep, host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(rules, F.col("host"), F.col("path"))
    return rows.join(known.select("host", "lower"), "host", "left").select(
        *keep, "host", "path", rule.alias("rule"), "lower",
        F.coalesce(verdict, F.when(F.col("lower") > limit, "block").otherwise("allow")).alias("verdict"))
