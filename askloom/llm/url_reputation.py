"""URL rules and empirical-Bayes host reputation, in built-in functions only.

A page's host belongs to a registered domain and that to a public suffix.  Labelled page
outcomes (good or bad) are counted at every level.  Each level is a beta-binomial: its
mean is shrunk towards the level above, by a strength that the method of moments takes
from how much the units of the level differ more than chance lets them.  A host without
any label has the posterior of its domain, a new domain that of its suffix.  A page is
let through if the lower bound of its host's posterior reaches ``least``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askloom.llm.frames import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Suffixes of more than one label under which names are registered (fixed values).
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.za")
#: A suffix table up to this many rows goes to all tasks; a larger one is joined by shuffle.
BROADCAST_SUFFIXES = 100_000
LEVELS = ("host", "domain", "suffix")
#: Correlation within a unit is kept inside these bounds, so prior strengths stay finite.
LEAST_RHO, MOST_RHO = 0.001, 0.999


@dataclass(frozen=True)
class Rule:
    verdict: str
    place: str

    @property
    def host(self) -> str:
        return self.place.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.place.split("/", 1)[1]


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column, long_suffixes: Sequence[str] = LONG_SUFFIXES) -> Column:
    last = F.substring_index(host, ".", -1)
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*long_suffixes), two).otherwise(last) if long_suffixes else last


def domain_of(host: Column, suffix: Column, long_suffixes: Sequence[str] = LONG_SUFFIXES) -> Column:
    """The suffix with one more label; a host that is a suffix is its own domain."""
    two, three = F.substring_index(host, ".", -2), F.substring_index(host, ".", -3)
    return F.when(suffix.isin(*long_suffixes), three).otherwise(two) if long_suffixes else two


def with_suffix(hosts: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """Add ``suffix`` and ``domain`` to rows with a ``host``; each host occurs once.

    ``suffixes`` has a column ``suffix`` (as of a public suffix list: names without a leading dot
    under which anyone may register); the longest that the host ends with counts, and the last
    label of a host that none fits.  Without a table ``LONG_SUFFIXES`` and last labels count.
    Upper case, nulls, empty names and repeats in the table change nothing.
    """
    if suffixes is None:
        suffix = suffix_of(F.col("host"))
        return hosts.withColumn("suffix", suffix).withColumn("domain", domain_of(F.col("host"), F.col("suffix")))
    known = suffixes.select(F.translate("suffix", UPPER, LOWER).alias("suffix")).where("suffix <> ''").distinct()
    if known.limit(BROADCAST_SUFFIXES + 1).count() <= BROADCAST_SUFFIXES:
        known = F.broadcast(known)
    ends = hosts.select("host", F.explode(F.sequence(F.lit(1), F.size(F.split("host", "[.]")))).alias("_labels")).withColumn(
        "suffix", F.expr("substring_index(host, '.', -_labels)"))
    longest = ends.join(known, "suffix").groupBy("host").agg(F.max("_labels").alias("_labels"))
    return (
        hosts.join(longest, "host", "left").withColumn("_labels", F.coalesce("_labels", F.lit(1)))
        .withColumn("suffix", F.expr("substring_index(host, '.', -_labels)"))
        .withColumn("domain", F.expr("substring_index(host, '.', -_labels - 1)")).drop("_labels"))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Place and verdict of the longest rule that fits (the first of equally long ones), or nulls.

    The rules are a configuration list: they become one conditional expression.
    """
    place, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: -len(r.place))[::-1]:
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        place, verdict = F.when(fits, rule.place).otherwise(place), F.when(fits, rule.verdict).otherwise(verdict)
    return place, verdict


def host_reputation(outcomes: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """Posterior of every host of ``outcomes`` (host, good: boolean, null where unlabelled).

    ``suffixes`` is as in ``with_suffix``.

    Returns host, domain, suffix, n_labels, n_good, prior_mean, prior_strength,
    posterior_mean and posterior_sd.  Without any label at all the mean is one half.
    """
    hosts = written(with_suffix(
        outcomes.groupBy("host").agg(F.count("good").alias("n"), F.count(F.when(F.col("good"), 1)).alias("k")),
        suffixes), "hosts")

    def counts(level: str, above: str | None) -> DataFrame:
        keys = [level] + ([above] if above else [])
        return hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))

    total = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k")).head()
    prior = F.lit((total["k"] + 1) / (total["n"] + 2))

    suffixes = _shrunk(counts("suffix", None).withColumn("m", prior)).select("suffix", F.col("mean").alias("m"))
    domains = _shrunk(counts("domain", "suffix").join(suffixes, "suffix")).select("domain", F.col("mean").alias("m"))
    found = _shrunk(hosts.join(domains, "domain"))
    return found.select(
        "host", "domain", "suffix", F.col("n").alias("n_labels"), F.col("k").alias("n_good"),
        F.col("m").alias("prior_mean"), F.col("strength").alias("prior_strength"),
        F.col("mean").alias("posterior_mean"),
        F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.col("strength") + 1)).alias("posterior_sd"))


def _shrunk(units: DataFrame) -> DataFrame:
    """Add the posterior mean of units (n, k, and the prior mean m); one strength for the level."""
    v = F.col("m") * (1 - F.col("m"))
    apart = F.col("n") * F.pow(F.col("k") / F.col("n") - F.col("m"), 2)
    row = units.where("n > 0").agg(
        F.sum(apart - v).alias("more"), F.sum(v * (F.col("n") - 1)).alias("scale")).head()
    rho = row["more"] / row["scale"] if row["scale"] else MOST_RHO
    rho = min(max(rho, LEAST_RHO), MOST_RHO)
    strength = 1 / rho - 1
    return units.withColumn("strength", F.lit(strength)).withColumn(
        "mean", (F.col("k") + F.col("strength") * F.col("m")) / (F.col("n") + F.col("strength")))


def judge_pages(pages: DataFrame, labels: DataFrame, rules: Sequence[Rule], least: float = 0.5,
                z: float = 1.645, suffixes: DataFrame | None = None) -> DataFrame:
    """Judge each row of ``pages`` (page_id, url) by rule, else by its host's posterior.

    ``labels`` has page_id and good (boolean).  Returns one row per page row: page_id,
    host, path, rule, verdict, bound.  A null url or one without ``://`` has the empty host,
    which is judged like any other host.  Rows of labels with a null good or page_id tell
    nothing; a page labelled more than once counts with every label, and so do repeated page
    rows.  With no label anywhere every bound is that of the even prior.  ``suffixes`` is a table
    of the names under which domains are registered (``with_suffix``).  Other columns of
    the inputs are not read.
    """
    url = F.col("url")
    judged = pages.select("page_id", url_host(url).alias("host"), url_path(url).alias("path"))
    marks = labels.where("good IS NOT NULL AND page_id IS NOT NULL").select("page_id", "good")
    reputation = host_reputation(judged.select("page_id", "host").join(marks, "page_id", "left"), suffixes)
    place, verdict = rule_of(F.col("host"), F.col("path"), rules)
    bound = F.col("posterior_mean") - z * F.col("posterior_sd")
    own = F.when(bound >= least, "allow").otherwise("block")
    return judged.join(reputation.select("host", bound.alias("bound"), own.alias("own")), "host", "left").select(
        "page_id", "host", "path", place.alias("rule"), F.coalesce(verdict, "own").alias("verdict"), "bound")
