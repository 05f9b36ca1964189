"""URL filters: explicit host and path rules, and an empirical-Bayes host reputation.

Labelled page outcomes are counted per host, registered domain and suffix. Every
level's rate is shrunk towards its parent's by a beta-binomial prior whose strength
is fitted to the data by moments, from the suffix down to the host; a host is blocked
where even the lower bound of its posterior lies above the limit. A label's ``doc_id``
is the ``page_id`` it speaks of.

Counts are aggregated on the map side, so a hot host sends one row per task, and the
page-side join carries the url parts alone. Nothing is collected or broadcast by hint.

Defined cases: a null url or one without ``://`` has an empty host and path; the empty
host is a host like any other. Null labels and null page keys count nowhere. Pages of
hosts without labelled pages get their domain's, suffix's or the global estimate.
Repeated pages count once each. Empty tables give an empty result; without any label
every page is allowed by the method. Extra columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamill.llm.text import ascii_lower
from stratamill.sinks.written import written_once


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


# The production rule list.
URL_RULES = (
    UrlRule("com", "/", "allow"),
    UrlRule("example.com", "/en/", "block"),
    UrlRule("www.example.com", "/en/", "allow"),
    UrlRule("net", "/es/", "block"),
    UrlRule("net", "/fr/", "block"),
)

# A page counts as bad where its label says toxic or low quality.
BLOCK_ABOVE = 0.5
BOUND_SIGMAS = 2.0
# Prior strength in pages, at least and at most; moments give the value in between.
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1000.0

# Suffixes of two labels.
DOUBLE_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "co.jp", "co.nz", "com.br", "co.in", "co.za")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path, both empty where there is no ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[UrlRule, ...] = URL_RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null where none does."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = rule.fits(host, path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def parents(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host."""
    double = F.substring_index(host, ".", -2).isin(*DOUBLE_SUFFIXES)
    suffix = F.when(double, F.substring_index(host, ".", -2)).otherwise(F.substring_index(host, ".", -1))
    domain = F.when(double, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))
    return domain, suffix


def _with_strength(children: DataFrame, parent: str) -> DataFrame:
    """One row per parent of ``children`` (parent, bad, n, mean): its prior's strength.

    Observed rates ``p`` of ``k`` children with ``n`` pages each, ``N`` together, spread
    around the parent's mean ``m`` by ``sum n (p - m)^2 = m (1 - m) (k + (N - k) r)`` on
    average, with ``r = 1 / (strength + 1)``.
    """
    rate = F.try_divide(F.col("bad"), F.col("n"))
    sums = (
        children.where("n > 0")
        .groupBy(parent)
        .agg(
            F.sum(F.col("n") * (rate - F.col("mean")) * (rate - F.col("mean"))).alias("spread"),
            F.max(F.col("mean") * (1 - F.col("mean"))).alias("noise"),
            F.count("*").alias("k"),
            F.sum("n").alias("pages"),
        )
    )
    r = F.try_divide(F.try_divide(F.col("spread"), F.col("noise")) - F.col("k"), F.col("pages") - F.col("k"))
    # No prior is surer than the pages behind it.
    most = F.greatest(F.lit(MIN_STRENGTH), F.least(F.lit(MAX_STRENGTH), F.col("pages").cast("double")))
    fitted = F.least(most, F.greatest(F.lit(MIN_STRENGTH), F.try_divide(F.lit(1.0), r) - 1))
    return sums.select(parent, F.when(r > 0, fitted).otherwise(most).alias("strength"))


def _shrunk(children: DataFrame, parent_means: DataFrame, parent: str) -> DataFrame:
    """``children`` with the parent's mean and the prior's strength."""
    placed = children.join(parent_means.select(parent, F.col("shrunk").alias("mean")), parent)
    strengths = _with_strength(placed, parent)
    return placed.join(strengths, parent, "left").withColumn(
        "strength", F.coalesce(F.col("strength"), F.lit(MIN_STRENGTH))
    )


def host_reputation(counts: DataFrame, sigmas: float = BOUND_SIGMAS) -> DataFrame:
    """Posterior per host of ``counts`` (host, bad, n): host, n_labelled, posterior_mean, lower_bound.

    Null where nothing at all is labelled.
    """
    domain, suffix = parents(F.col("host"))
    hosts = counts.select("host", "bad", "n", domain.alias("domain"), suffix.alias("suffix"), F.lit("").alias("root"))
    total = [F.sum("bad").alias("bad"), F.sum("n").alias("n")]
    domains = hosts.groupBy("domain", "suffix", "root").agg(*total)
    suffixes = domains.groupBy("suffix", "root").agg(*total)
    roots = suffixes.groupBy("root").agg(*total)
    shrunk = ((F.col("bad") + F.col("strength") * F.col("mean")) / (F.col("n") + F.col("strength"))).alias("shrunk")
    means = roots.select("root", F.try_divide("bad", "n").alias("shrunk"))
    suffix_means = _shrunk(suffixes, means, "root").select("suffix", shrunk)
    domain_means = _shrunk(domains, suffix_means, "suffix").select("domain", shrunk)
    judged = _shrunk(hosts, domain_means, "domain").select("host", "n", "strength", shrunk)
    m, size = F.col("shrunk"), F.col("n") + F.col("strength")
    deviation = F.sqrt(F.greatest(m * (1 - m), F.lit(0.0)) / (size + 1))
    return judged.select(
        "host", F.col("n").alias("n_labelled"), m.alias("posterior_mean"), (m - sigmas * deviation).alias("lower_bound")
    )


def page_outcomes(labels: DataFrame) -> DataFrame:
    """``page_key``, ``bad`` (0 or 1): one row per labelled page, bad if any label of it says so."""
    is_bad = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    labelled = labels.where("doc_id is not null and (quality is not null or toxic is not null)")
    return labelled.groupBy(F.col("doc_id").alias("page_key")).agg(F.max(is_bad.cast("int")).alias("bad"))


def url_filter(
    pages: DataFrame,
    labels: DataFrame,
    rules: tuple[UrlRule, ...] = URL_RULES,
    block_above: float = BLOCK_ABOVE,
    sigmas: float = BOUND_SIGMAS,
) -> DataFrame:
    """page_id, host, path, rule, verdict, n_labelled, posterior_mean, lower_bound of every page.

    The verdict is the longest fitting rule's, else ``block`` where the host's
    posterior lies above ``block_above`` by ``sigmas`` deviations, else ``allow``.
    """
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    seen = parts.select("host", F.col("page_id").alias("page_key")).join(page_outcomes(labels), "page_key", "left")
    # One row per host, read by every level above it.
    counts = written_once(
        seen.groupBy("host").agg(
            F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad"), F.count("bad").alias("n")
        )
    )
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = F.when(F.col("lower_bound") > block_above, F.lit("block")).otherwise(F.lit("allow"))
    return parts.join(host_reputation(counts, sigmas), "host", "left").select(
        "page_id",
        "host",
        "path",
        name.alias("rule"),
        F.coalesce(verdict, judged).alias("verdict"),
        "n_labelled",
        F.round("posterior_mean", 6).alias("posterior_mean"),
        F.round("lower_bound", 6).alias("lower_bound"),
    )
