"""URL rules and empirical-Bayes host reputation."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import lower_ascii, stored

#: Fixed values: (verdict, rule) pairs of the default rule list.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: Second-level labels that form a public suffix with a two-letter country code.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")


def url_parts(url: Column) -> dict[str, Column]:
    """host and path; both empty for null and for urls without `://`."""
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return {"host": F.coalesce(lower_ascii(host), F.lit("")), "path": F.coalesce(path, F.lit(""))}


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls when none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, r in sorted(rules, key=lambda x: len(x[1])):
        at = r.index("/")
        dom, start = r[:at], r[at:]
        fits = ((host == dom) | host.endswith("." + dom)) & path.startswith(start)
        rule, verdict = F.when(fits, r).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def host_levels(host: Column) -> dict[str, Column]:
    """Registered domain and public suffix of a host (port cut off)."""
    name = F.regexp_replace(host, r":\d*$", "")
    parts = F.split(name, r"\.")
    n = F.size(parts)
    two = (n >= 3) & (F.length(F.element_at(parts, -1)) == 2) & F.get(parts, n - 2).isin(*SECOND_LEVEL)
    numeric = name.rlike(r"^[0-9.]+$")
    suffix = F.when(numeric, "").when(two, F.substring_index(name, ".", -2)).otherwise(
        F.substring_index(name, ".", -1))
    domain = F.when(numeric, name).when(two, F.substring_index(name, ".", -3)).otherwise(
        F.substring_index(name, ".", -2))
    return {"domain": domain, "suffix": suffix}


def _log_gamma(x: Column) -> Column:
    """Stirling's series at x + 8, taken back by the recurrence of the gamma function."""
    y, steps = x + 8, x
    for k in range(1, 8):
        steps = steps * (x + k)
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(steps)


def beta_above(a: Column, b: Column, t: Column) -> Column:
    """P(p > t) of a beta distribution, by the continued fraction of the incomplete beta function.

    The fraction converges fast on the shorter side of the mean, so the other tail is taken there;
    its number of terms grows with the root of a + b, as needed.
    """
    below = t < (a + 1) / (a + b + 2)  # then it gives P(p < t), else P(p > t)
    p, q = F.when(below, a).otherwise(b), F.when(below, b).otherwise(a)
    x = F.when(below, t).otherwise(1 - t)
    v = F.struct(p.alias("p"), q.alias("q"), x.alias("x"))

    def tail(v):
        p, q, x = v["p"], v["q"], v["x"]

        def term(k):
            m = F.floor(k / 2)
            even = m * (q - m) * x
            odd = -(p + m) * (p + q + m) * x
            return F.when(k % 2 == 0, even).otherwise(odd) / ((p + k - 1) * (p + k))

        def step(s, k):
            d = 1 / (1 + term(k) * s["d"])
            c = 1 + term(k) / s["c"]
            return F.struct(c.alias("c"), d.alias("d"), (s["f"] * c * d).alias("f"))

        one = F.lit(1.0)
        start = F.struct(one.alias("c"), F.lit(0.0).alias("d"), one.alias("f"))
        terms = F.sequence(F.lit(1), (80 + 8 * F.sqrt(p + q)).cast("int"))
        fraction = F.aggregate(terms, start, step, lambda s: s["f"])
        front = p * F.log(x) + q * F.log(1 - x) - _log_gamma(p) - _log_gamma(q) + _log_gamma(p + q)
        return F.exp(front) / (p * fraction)

    part = F.get(F.transform(F.array(v), tail), 0)
    return F.when(below, 1 - part).otherwise(part)


def _strength(rows: DataFrame, n: Column, bad: Column, mean: Column) -> float:
    """How many pages a prior with these means is worth, by moments.

    Rates around their prior means vary by m (1 - m) (1 + (n - 1) r) / n, r = 1 / (strength + 1).
    Sums over the units of a level give r. Where units differ no more than chance does, the
    prior is worth a million pages.
    """
    spread = mean * (1 - mean)
    seen = rows.where(n > 0).agg(
        F.sum(n * (bad / n - mean) ** 2 - spread).alias("over"), F.sum((n - 1) * spread).alias("room")).first()
    r = seen.over / seen.room if seen.room else 0.0
    return 1 / min(max(r, 1e-6), 0.5) - 1


def reputation(counts: DataFrame) -> DataFrame:
    """Beta posteriors of the bad rates of hosts from (host, n, bad): host, n, bad, a, b and the rate
    of all pages, `overall`; one row per host.

    The prior mean of a suffix is the rate of all other pages, that of a domain the posterior mean of
    its suffix, that of a host the posterior mean of its domain, each without the pages of the
    unit itself, so none is its own prior. How many pages a prior is worth is estimated
    per level from how much its units differ. Half a page on each side starts the top, so rates are
    defined with no labels at all (one half). Three rows of two sums each come to the driver; the sums per
    unit are partial aggregates, joined by their keys.
    """
    lv = host_levels(F.col("host"))
    hosts = counts.select("host", F.col("n").cast("double").alias("n"), F.col("bad").cast("double").alias("bad"),
                          *[c.alias(k) for k, c in lv.items()])
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n2"), F.sum("bad").alias("b2"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n2").alias("n1"), F.sum("b2").alias("b1"))
    total = suffixes.agg(F.sum("n1"), F.sum("b1")).first()
    n0, b0 = F.lit(total[0] or 0.0), F.lit(total[1] or 0.0)

    def prior(out_n, out_bad, *levels):
        """The mean for a unit with these pages, which are taken out of the levels above it."""
        mean = (b0 - out_bad + 0.5) / (n0 - out_n + 1)
        for n, bad, worth in levels:
            mean = (bad - out_bad + worth * mean) / (n - out_n + worth)
        return mean

    n1, b1, n2, b2, n, bad = (F.col(c) for c in ("n1", "b1", "n2", "b2", "n", "bad"))
    s1 = _strength(suffixes, n1, b1, prior(n1, b1))
    domains = domains.join(suffixes, "suffix")
    s2 = _strength(domains, n2, b2, prior(n2, b2, (n1, b1, s1)))
    hosts = hosts.join(domains, ["suffix", "domain"])
    mean = prior(n, bad, (n1, b1, s1), (n2, b2, s2))
    s3 = _strength(hosts, n, bad, mean)
    return hosts.select("host", "n", "bad", (bad + s3 * mean).alias("a"), (n - bad + s3 * (1 - mean)).alias("b"),
                        ((b0 + 0.5) / (n0 + 1)).alias("overall"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, sure: float = 0.95, times: float = 1.0) -> DataFrame:
    """Adds host, path, rule, verdict, host_labelled, host_bad, host_rate and host_worse to `pages`
    (url, page_id, ...).

    `outcomes` has (page_id, bad 0/1), the labelled pages. A rule decides where one fits; else the
    page is blocked if the lower posterior bound, at `sure`, of its host's bad rate is above
    `times` the rate of all labelled pages: `host_worse`, the posterior probability of a rate above that, is
    `sure` or more. `host_rate` is the posterior mean.
    Null urls have empty host and path and share the reputation of the empty host. Null page ids
    and null outcomes count for nothing; repeated outcomes count as often as they occur, for each
    page with their id. Without labels nothing is blocked. Input columns with the added
    names are replaced. Only hosts, never pages, are shuffled for the counts (after a partial
    aggregate), and Spark splits a hot host when its pages meet the one row of that host.
    """
    added = ["host", "path", "rule", "verdict", "host_labelled", "host_bad", "host_rate", "host_worse"]
    p = pages.drop(*added).withColumns(url_parts(F.col("url")))
    known = outcomes.groupBy("page_id").agg(F.count("bad").alias("n"), F.sum("bad").alias("bad"))
    seen = stored(p.select("page_id", "host").join(known, "page_id", "left").groupBy("host").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")), "hosts")
    a, b = F.col("a"), F.col("b")
    most = F.least(F.col("overall") * times, F.lit(1 - 1e-9))
    rep = reputation(seen).select(
        "host", F.col("n").cast("long").alias("host_labelled"), F.col("bad").cast("long").alias("host_bad"),
        (a / (a + b)).alias("host_rate"), beta_above(a, b, most).alias("host_worse"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("host_worse") >= sure, "block").otherwise("allow")
    return p.join(rep, "host").withColumn("rule", rule).withColumn("verdict", F.coalesce(verdict, own))
