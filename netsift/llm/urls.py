"""URL filter by rules and by an empirical-Bayes reputation of hosts.

Labelled page outcomes (bad or not) are counted per host, registered domain and
suffix. Each level is a beta-binomial whose prior mean is the posterior mean of
the level above (suffix <- all pages, domain <- suffix, host <- domain) and
whose strength comes from the spread between the groups of that level (method
of moments). A host is blocked when the lower bound of its posterior bad rate
lies above a limit. Explicit rules come first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsift.llm.links import stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Reputation:
    """Limits of the filter. ``bound`` is in posterior standard deviations."""

    bad_rate: float = 0.3
    bound: float = 1.645
    least_strength: float = 1.0
    most_strength: float = 1000.0
    suffixes: tuple[str, ...] = ("example.com", "example.net", "example.org")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule (``host/path-prefix``) that fits, or null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, _, start = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + start))
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def registered_domain(host: Column, suffixes: tuple[str, ...]) -> tuple[Column, Column]:
    """Suffix (a listed one, else the last label) and the domain one label longer."""
    listed = F.lit(None).cast("string")
    for s in sorted(suffixes, key=lambda s: (len(s), s)):
        listed = F.when((host == s) | F.endswith(host, F.lit("." + s)), F.lit(s)).otherwise(listed)
    suffix = F.coalesce(listed, F.substring_index(host, ".", -1))
    labels = F.size(F.split(suffix, r"\.")) + 1
    parts = F.split(host, r"\.")
    return suffix, F.array_join(F.slice(parts, F.greatest(F.size(parts) - labels + 1, F.lit(1)), labels), ".")


def _strength(groups: DataFrame, key: str, settings: Reputation) -> float:
    """Strength of the prior at one level, from the spread of bad rates between its groups."""
    row = (
        groups.groupBy(key)
        .agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
        .filter("n > 0")
        .agg(
            F.count("*").alias("m"), F.sum("n").alias("n"), F.sum("k").alias("k"),
            F.sum(F.col("n") * F.col("n")).alias("nn"),
            F.sum(F.col("k") * F.col("k") / F.col("n")).alias("kk"),
        )
        .first()
    )
    if not row["m"] or row["m"] < 2:
        return settings.most_strength
    p = row["k"] / row["n"]
    spread = (row["kk"] - row["n"] * p * p) - (row["m"] - 1) * p * (1 - p)
    variance = spread / (row["n"] - row["nn"] / row["n"])
    if variance <= 0:
        return settings.most_strength
    return min(max(p * (1 - p) / variance - 1, settings.least_strength), settings.most_strength)


def reputation(outcomes: DataFrame, settings: Reputation = Reputation()) -> DataFrame:
    """Posterior bad rate of each host.

    ``outcomes`` holds ``host`` and ``bad`` (0, 1, or null where unlabelled).
    Returns host, labelled, bad_count, mean, lower; the lower bound is the mean
    less ``bound`` posterior standard deviations. Null or empty hosts have none.
    """
    suffix, domain = registered_domain(F.col("host"), settings.suffixes)
    hosts = (
        outcomes.filter("host is not null and host <> ''")
        .groupBy("host")
        .agg(F.count("bad").cast("double").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("k"))
        .select("host", suffix.alias("suffix"), domain.alias("domain"), "n", "k")
    )
    # One row for each host; all levels and strengths come from it.
    hosts = stored(hosts, "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    mean = total["k"] / total["n"] if total["n"] else 0.0
    levels = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("dn"), F.sum("k").alias("dk"))
    suffixes = levels.groupBy("suffix").agg(F.sum("dn").alias("sn"), F.sum("dk").alias("sk"))
    s, d, h = (_strength(hosts, key, settings) for key in ("suffix", "domain", "host"))
    above = levels.join(suffixes, "suffix").select(
        "domain", ((F.col("dk") + d * (F.col("sk") + s * mean) / (F.col("sn") + s)) / (F.col("dn") + d)).alias("prior")
    )
    a = F.col("k") + h * F.col("prior")
    size = F.col("n") + h
    rate = a / size
    return hosts.join(above, "domain").select(
        "host", F.col("n").cast("bigint").alias("labelled"), F.col("k").cast("bigint").alias("bad_count"),
        rate.alias("mean"), (rate - settings.bound * F.sqrt(rate * (1 - rate) / (size + 1))).alias("lower"),
    )


def judge(
    pages: DataFrame, outcomes: DataFrame, rules: dict[str, str], settings: Reputation = Reputation(), url: str = "url"
) -> DataFrame:
    """Add host, path, rule, verdict (allow/block), bad_rate and bad_rate_lower to every row of ``pages``.

    ``outcomes`` holds ``url`` and ``bad``. A rule's verdict wins; otherwise a
    host is blocked when its lower bound exceeds ``bad_rate``. Null urls and urls
    without ``://`` have an empty host and path and are allowed, as is every
    host without labels whose prior stays below the limit. Hosts that only
    ``pages`` has are judged by the prior of their domain and suffix. Repeated
    rows are kept; columns of these names are replaced. A hot host is a skewed
    join key: its rows are split by adaptive execution.
    """
    host, path = host_and_path(F.col("url"))
    labelled = outcomes.select(host.alias("host"), "bad")
    host, path = host_and_path(F.col(url))
    every = labelled.unionByName(pages.select(host.alias("host"), F.lit(None).cast("int").alias("bad")))
    known = reputation(every, settings).select(
        F.col("host").alias("_host"), F.col("mean").alias("_mean"), F.col("lower").alias("_lower")
    )
    rows = pages.withColumns({"host": host, "path": path})
    rows = rows.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    by_rule = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        by_rule = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(by_rule)
    verdict = F.coalesce(by_rule, F.when(F.col("_lower") > settings.bad_rate, "block").otherwise("allow"))
    return (
        rows.join(known, F.col("host") == F.col("_host"), "left")
        .withColumns({"verdict": verdict, "bad_rate": F.col("_mean"), "bad_rate_lower": F.col("_lower")})
        .drop("_host", "_mean", "_lower")
    )
