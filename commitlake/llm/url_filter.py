"""URL filters: fixed rules, and empirical-Bayes reputation of hosts.

Every page is judged by the longest rule that fits its host and path; where
none fits, by the reputation of its host. Reputation comes from labelled page
outcomes. Good and labelled pages are counted for each host and summed to
registered domains and suffixes. From the top down each level's rate is
shrunk towards its parent's by a beta-binomial prior, whose strength is
estimated over the level (method of moments). A host's posterior is a beta
distribution; the host is blocked when its good share lies below ``min_good`` with
probability ``SURE`` at least, that is, when even the posterior's upper quantile does.
The probability is the posterior's own, summed over a grid.

``min_good`` is 0.5: a host goes when most of its pages are bad, whatever the corpus
is like; a bar at the corpus's own rate would block half of all hosts of a clean corpus.
A port is no part of a host's name for its reputation: all ports of a host share it.

Defined results: a null url, or one without ``://``, has empty host and path;
unlabelled hosts carry their domain's prior, unlabelled domains their
suffix's; without any label nothing is blocked by reputation; null outcomes
count as unlabelled; repeated rows count as often as they occur. The registered
domain is the last two labels, or one label more than the longest entry of
``suffixes`` that fits. Columns of ``pages`` that are kept win over none of the
result's names: ``keep`` must not hold host, path, rule or verdict of its own
(they are left out).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlake.llm.common import cut, free_name

#: (verdict, host/path): a rule holds for its host and all subdomains.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: A host is blocked when its good share is below this with high probability.
MIN_GOOD = 0.5
#: That high: the probability with which a blocked host's good share is below it.
SURE = 0.99
#: Suffixes of several labels below which anyone registers a domain (fixed values).
SUFFIXES = (
    "co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ne.jp", "or.jp", "co.kr",
    "com.br", "com.cn", "com.mx", "com.ar", "com.tr", "com.tw", "com.sg", "co.in", "co.za", "co.il",
    "github.io", "gitlab.io", "blogspot.com", "wordpress.com",
)
#: Points of the grid on either side of ``min_good``, and its width in standard deviations.
POINTS, WIDE = 200, 10
#: Bounds of the share of variance between the children of one parent.
RHO = (0.001, 0.5)


def _rest(url: Column) -> Column:
    at = F.instr(url, F.lit("://"))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.regexp_extract(F.coalesce(_rest(url), F.lit("")), "^[^/?#]*", 0), upper, lower)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(_rest(url), F.lit("")), "^[^/?#]*([^?#]*)", 1)


def _longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]], pick: int) -> Column:
    """The verdict (0) or the text (1) of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = rule[1].partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        out = F.when(fits, F.lit(rule[pick])).otherwise(out)
    return out


def _suffix(host: Column, suffixes: Sequence[str]) -> Column:
    out = F.regexp_extract(host, r"([^.]*)$", 1)
    for s in sorted(suffixes, key=len):
        out = F.when((host == s) | host.endswith("." + s), F.lit(s)).otherwise(out)
    return out


def _domain(host: Column, suffix: Column) -> Column:
    """The suffix and the label before it."""
    before = F.substring(host, F.lit(1), F.length(host) - F.length(suffix) - 1)
    label = F.regexp_extract(before, r"([^.]*)$", 1)
    return F.when(F.length(host) <= F.length(suffix), host).otherwise(F.concat(label, F.lit("."), suffix))


def _strength(level: DataFrame) -> float:
    """Prior weight in pages, from rows of good, n and the parent's mean mu."""
    v = F.col("mu") * (1 - F.col("mu"))
    row = (
        level.where("n > 0")
        .agg(
            F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - F.col("mu"), 2)).alias("a"),
            F.sum(v).alias("v"),
            F.sum((F.col("n") - 1) * v).alias("w"),
        )
        .first()
    )
    rho = (row.a - row.v) / row.w if row.w else RHO[0]
    rho = min(max(rho, RHO[0]), RHO[1])
    return 1 / rho - 1


def bare_host(host: Column) -> Column:
    """The host without its port."""
    return F.regexp_replace(host, ":[0-9]*$", "")


def below(mean: Column, weight: Column, bar: float, points: int = POINTS) -> Column:
    """P(x < bar) of a beta distribution with this mean and weight (the sum of its two
    parameters): midpoint sums over u with x = sin(u) ** 2, in which it is about normal."""
    peak, spread = F.asin(F.sqrt(mean)), WIDE / (2 * F.sqrt(weight + 1))
    low, high = F.greatest(F.lit(0.0), peak - spread), F.least(F.lit(math.pi / 2), peak + spread)
    middle = F.least(F.greatest(F.lit(math.asin(math.sqrt(bar))), low), high)
    a, b = 2 * mean * weight - 1, 2 * (1 - mean) * weight - 1

    def log_density(u: Column) -> Column:
        return a * F.log(F.sin(u)) + b * F.log(F.cos(u))

    top = log_density(peak)

    def part(first: Column, last: Column) -> Column:
        step = (last - first) / points
        terms = F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.exp(log_density(first + (i + 0.5) * step) - top))
        return F.aggregate(terms, F.lit(0.0), lambda x, y: x + y) * step

    under, over = part(low, middle), part(middle, high)
    return under / (under + over)


def reputation(
    outcomes: DataFrame, min_good: float = MIN_GOOD, sure: float = SURE, suffixes: Sequence[str] = SUFFIXES
) -> DataFrame:
    """host, domain, suffix, n, good, mean, below, blocked; host without its port.

    ``outcomes``: one row for each page, with host and good (true, false, or
    null where it is not labelled). ``below``: the probability that less than
    ``min_good`` of its pages are good (0 where the mean is not below it).
    """
    outcomes = outcomes.select(bare_host(F.col("host")).alias("host"), "good")
    suffix = _suffix(F.col("host"), suffixes)
    hosts = cut(
        outcomes.groupBy("host")
        .agg(F.count("good").alias("n"), F.count_if("good").alias("good"))
        .withColumn("suffix", suffix)
        .withColumn("domain", _domain(F.col("host"), F.col("suffix")))
    )
    sums = (F.sum("n").alias("n"), F.sum("good").alias("good"))
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    tops = domains.groupBy("suffix").agg(*sums)
    total = tops.agg(*sums).first()
    mean = ((total.good or 0) + 1) / ((total.n or 0) + 2)

    def shrunk(level: DataFrame) -> DataFrame:
        m = F.lit(_strength(level))
        return level.withColumn("weight", F.col("n") + m).withColumn(
            "mean", (F.col("good") + m * F.col("mu")) / F.col("weight")
        )

    def parent(level: DataFrame, key: str) -> DataFrame:
        return level.select(key, F.col("mean").alias("mu"))

    tops = shrunk(tops.withColumn("mu", F.lit(mean)))
    domains = shrunk(domains.join(parent(tops, "suffix"), "suffix"))
    hosts = shrunk(hosts.join(parent(domains, "domain"), "domain"))
    # the sums only where they can decide
    under = F.when(F.col("mean") < min_good, below(F.col("mean"), F.col("weight"), min_good)).otherwise(F.lit(0.0))
    judged = cut(hosts.withColumn("below", under))
    blocked = (F.col("below") >= sure) & F.lit(bool(total.n))
    return judged.select("host", "domain", "suffix", "n", "good", "mean", "below", blocked.alias("blocked"))


def judge(
    pages: DataFrame,
    good: Column,
    rules: Sequence[tuple[str, str]] = RULES,
    min_good: float = MIN_GOOD,
    sure: float = SURE,
    suffixes: Sequence[str] = SUFFIXES,
    url: str = "url",
    keep: Sequence[str] = ("page_id",),
) -> DataFrame:
    """``keep``, host, path, rule, verdict of every page row.

    ``good`` is an expression over ``pages``: a page's labelled outcome, or null.
    """
    host, path = host_of(F.col(url)), path_of(F.col(url))
    keep = [c for c in keep if c.lower() not in ("host", "path", "rule", "verdict")]
    found = free_name(keep, "judged")
    rows = pages.select(*keep, F.struct(host.alias("host"), path.alias("path"), good.alias("good")).alias(found))
    known = reputation(rows.select(f"{found}.host", f"{found}.good"), min_good, sure, suffixes)
    own, bad = free_name([*keep, found], "bare_host"), free_name([*keep, found], "host_blocked")
    known = known.select(F.col("host").alias(own), F.col("blocked").alias(bad))
    host, path = F.col(f"{found}.host"), F.col(f"{found}.path")
    by_host = F.when(F.col(bad), F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(known, bare_host(host) == F.col(own), "left").select(
        *keep,
        host.alias("host"),
        path.alias("path"),
        _longest_rule(host, path, rules, 1).alias("rule"),
        F.coalesce(_longest_rule(host, path, rules, 0), by_host).alias("verdict"),
    )
