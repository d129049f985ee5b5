"""Judge urls by listed rules and, where none fits, by an empirical-Bayes reputation of their host."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainspark.llm.common import LOWER, UPPER, stage

#: Second-level labels under which registries sell names (fixed values, a parameter of suffix_of).
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")


@dataclass(frozen=True)
class Rule:
    """A verdict for a host, its subdomains, and the paths that start with `path`."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next /, ? or #, with A-Z lower-cased; empty if there is no ://."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ? or #."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest fitting rule as struct(rule, verdict), null if none fits. The rules are a short literal list."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    cases = [
        F.when(
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in ordered
    ]
    return F.coalesce(*cases) if cases else F.lit(None).cast("struct<rule: string, verdict: string>")


def bare_host(host: Column) -> Column:
    """Host without user information, port and trailing dot."""
    return F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$|\.$", "")


def suffix_of(host: Column, second_level: tuple[str, ...] = SECOND_LEVEL) -> Column:
    """Last label, or the last two where the label before a two-letter country code is a registry's."""
    pair = rf"(?:^|\.)((?:{'|'.join(second_level)})\.[a-z]{{2}})$"
    return F.coalesce(F.nullif(F.regexp_extract(host, pair, 1), F.lit("")), F.regexp_extract(host, r"([^.]*)$", 1))


def domain_of(host: Column, suffix: Column) -> Column:
    """The suffix and one label more (the host itself if there is none)."""
    rest = F.substring(host, F.lit(1), F.length(host) - F.length(suffix) - 1)
    return F.when(F.length(rest) > 0, F.concat(F.regexp_extract(rest, r"([^.]*)$", 1), F.lit("."), suffix)).otherwise(host)


def listed_suffix(hosts: DataFrame, suffixes: DataFrame) -> DataFrame:
    """hosts (host, name) with the longest suffix of name in the table `suffixes` (column suffix, like co.uk); names without
    one keep their last label. A name has a few tails, which meet the table in one join."""
    labels = F.split("name", r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    met = hosts.select("host", F.explode(tails).alias("suffix")).join(suffixes.select("suffix").distinct(), "suffix")
    best = met.groupBy("host").agg(F.max_by("suffix", F.length("suffix")).alias("suffix"))
    return hosts.join(best, "host", "left").withColumn("suffix", F.coalesce("suffix", F.regexp_extract("name", r"([^.]*)$", 1)))


def _strength(groups: DataFrame, most: float, least: float = 1.0) -> float:
    """Prior weight of beta-binomial groups (n, k around the mean m), by the method of moments; one small aggregate.

    The variance between groups beyond the binomial's own gives the correlation r, and the weight is (1 - r) / r, between
    `least` and `most`.
    """
    got = groups.agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.pow(F.try_divide("k", "n") - F.col("m"), 2)).alias("spread"),
        F.sum(F.col("m") * (1 - F.col("m"))).alias("one"),
        F.sum(F.col("n") * F.col("m") * (1 - F.col("m"))).alias("all"),
    ).first()
    if not got.n or not got.all:
        return most
    over = got.all - got.one
    r = (got.spread - got.one) / over if over > 0 else 0.0
    if r <= 0:  # nothing speaks for a difference between groups
        return most
    return float(min(max((1 - r) / r, least), most))


def host_reputation(pages: DataFrame, outcomes: DataFrame, suffixes: DataFrame | None = None, most: float = 20.0) -> DataFrame:
    """host, alpha, beta, overall: posterior of each host's share of bad pages, and the share of all labelled pages.

    pages: page_id, host. outcomes: page_id, bad (boolean). Counts of labelled outcomes are pre-aggregated by host
    before any shuffle of names; priors shrink host towards registered domain, domain towards suffix and suffix
    towards all labels, each with the weight of `most` labelled pages at most. What a host adds to its domain, or a domain
    to its suffix, stays out of its own prior, so a single label doesn't count twice. An unlabelled host, domain or suffix
    takes the level above it. suffixes is a table of public suffixes; without one suffix_of's rule stands in.
    """
    marks = outcomes.groupBy("page_id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    hosts = (
        pages.join(marks, "page_id", "left")
        .groupBy("host")
        .agg(F.count("bad").cast("double").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("k"))
        .withColumn("name", bare_host(F.col("host")))
    )
    hosts = hosts.withColumn("suffix", suffix_of(F.col("name"))) if suffixes is None else listed_suffix(hosts, suffixes)
    hosts = hosts.withColumn("domain", domain_of(F.col("name"), F.col("suffix")))
    hosts = stage(hosts.select("host", "domain", "suffix", "n", "k"), "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    mean = (total.k + 0.5) / (total.n + 1) if total.n else 0.0
    counts = [F.sum("n").alias("n"), F.sum("k").alias("k")]

    def weighted(groups: DataFrame) -> DataFrame:
        return groups.withColumn("weight", F.lit(_strength(groups.filter("n > 0"), most)))

    def others(level: str) -> Column:
        """Mean of a level above without what this group itself adds to it."""
        counted = F.col(f"{level}_n") - F.col("n") + F.col(f"{level}_weight")
        return (F.col(f"{level}_k") - F.col("k") + F.col(f"{level}_weight") * F.col(f"{level}_m")) / counted

    def above(groups: DataFrame, keys: list[str], level: str) -> DataFrame:
        return groups.select(*keys, *(F.col(c).alias(f"{level}_{c}") for c in ("n", "k", "m", "weight")))

    suffixes_ = weighted(hosts.groupBy("suffix").agg(*counts).withColumn("m", F.lit(mean)))
    domains = hosts.groupBy("domain", "suffix").agg(*counts).join(above(suffixes_, ["suffix"], "suffix"), "suffix")
    domains = weighted(domains.withColumn("m", others("suffix")))
    own = hosts.join(above(domains, ["domain", "suffix"], "domain"), ["domain", "suffix"])
    own = weighted(own.withColumn("m", others("domain")))
    return own.select(
        "host",
        (F.col("k") + F.col("weight") * F.col("m")).alias("alpha"),
        (F.col("n") - F.col("k") + F.col("weight") * (1 - F.col("m"))).alias("beta"),
        F.lit(mean).alias("overall"),
    )


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: list[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    worst: float | None = None,
    z: float = 1.0,
    suffixes: DataFrame | None = None,
    most: float = 20.0,
) -> DataFrame:
    """page_id, host, path, rule, verdict and the host's posterior of every page.

    A rule decides where one fits. Elsewhere a page is blocked if the lower posterior bound (mean - z deviations) of
    its host's bad share exceeds `worst`, the share of all labelled pages if none is given; a host is thus blocked on
    evidence that it is worse than pages at large, not for want of labels.

    Nulls: a url that is null or has no :// has an empty host and path, fits no rule and shares the reputation of
    the empty host. A null id has no labels. Repeated rows are judged one by one. Empty labels block nothing.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")
    )
    total = F.col("alpha") + F.col("beta")
    mean = F.col("alpha") / total
    bound = mean - z * F.sqrt(mean * (1 - mean) / (total + 1))
    limit = F.col("overall") if worst is None else F.lit(worst)
    known = host_reputation(rows, outcomes, suffixes, most)
    known = known.select("host", mean.alias("bad_mean"), bound.alias("bad_bound"), (bound > limit).alias("worse"))
    rows = rows.withColumn("fits", rule_of(F.col("host"), F.col("path"), rules))
    return rows.join(known, "host", "left").select(
        "page_id",
        "host",
        "path",
        F.col("fits.rule").alias("rule"),
        F.coalesce("fits.verdict", F.when(F.col("worse"), "block").otherwise("allow")).alias("verdict"),
        "bad_mean",
        "bad_bound",
    )
