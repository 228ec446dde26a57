"""Host reputation against a plain version, with hosts that the bound blocks."""

import math
import random

import pytest
from pyspark.sql import functions as F

from rillflow.llm.url_filter import beta_above, judge_urls


def plain_above(a, b, t, parts=400_000):
    """P(p > t) by midpoints in the log odds, where the density has no poles."""
    lo, hi = -40 / min(a, 1), 40 / min(b, 1)
    cut = math.log(t / (1 - t))

    def density(u):
        return math.exp(-a * math.log1p(math.exp(-u)) - b * math.log1p(math.exp(u))) if abs(u) < 700 else 0.0

    def area(u, v):
        h = (v - u) / parts
        return h * math.fsum(density(u + (i + 0.5) * h) for i in range(parts))

    low, high = area(lo, cut), area(cut, hi)
    return high / (low + high)


def test_beta_tail(spark):
    cases = [(2.0, 3.0, 0.4), (0.5, 0.5, 0.2), (15.0, 80.0, 0.1), (15.0, 80.0, 0.3), (1.0, 1.0, 0.25), (300.0, 9.0, 0.95), (0.4, 30.0, 0.02)]
    rows = spark.createDataFrame(cases, "a double, b double, t double")
    got = {(r.a, r.b, r.t): r.p for r in rows.withColumn("p", beta_above(F.col("a"), F.col("b"), F.col("t"))).collect()}
    for c in cases:
        assert got[c] == pytest.approx(plain_above(*c), abs=1e-6)
    wide = spark.createDataFrame([(1e6, 9e6, 0.1), (1e6, 9e6, 0.11), (1e6, 9e6, 0.09)], "a double, b double, t double")
    assert [round(r[0], 3) for r in wide.select(beta_above(F.col("a"), F.col("b"), F.col("t"))).collect()] == [0.5, 0.0, 1.0]


def plain_posteriors(counts):
    """{host: (a, b)} by the definition, each prior computed over all other units."""
    parts = {h: (h.rsplit(".", 1)[-1], ".".join(h.split(".")[-2:])) for h in counts}

    def total(keep):
        return sum(n for h, (n, _) in counts.items() if keep(h)), sum(x for h, (_, x) in counts.items() if keep(h))

    def worth(units):
        over = room = 0.0
        for n, bad, m in units:
            if n:
                over += n * (bad / n - m) ** 2 - m * (1 - m)
                room += (n - 1) * m * (1 - m)
        return 1 / min(max(over / room if room else 0.0, 1e-6), 0.5) - 1

    def rate(inside, s1=None, s2=None, suffix=None, domain=None):
        n, bad = total(lambda h: not inside(h))
        m = (bad + 0.5) / (n + 1)
        for s, keep in ((s1, suffix), (s2, domain)):
            if keep:
                n, bad = total(lambda h: keep(h) and not inside(h))
                m = (bad + s * m) / (n + s)
        return m

    suffixes, domains = {p[0] for p in parts.values()}, {p for p in parts.values()}
    s1 = worth([(*total(lambda h: parts[h][0] == x), rate(lambda h: parts[h][0] == x)) for x in suffixes])
    s2 = worth([(*total(lambda h: parts[h] == x), rate(lambda h: parts[h] == x, s1, None, lambda h: parts[h][0] == x[0]))
                for x in domains])
    mean = {h: rate(lambda o: o == h, s1, s2, lambda o: parts[o][0] == parts[h][0], lambda o: parts[o] == parts[h])
            for h in counts}
    s3 = worth([(*counts[h], mean[h]) for h in counts])
    return {h: (counts[h][1] + s3 * mean[h], counts[h][0] - counts[h][1] + s3 * (1 - mean[h])) for h in counts}


def test_hosts_are_blocked_by_their_posterior(spark):
    rnd = random.Random(5)
    rates = {}
    for i in range(60):
        tld, domain = ("org", "net", "xyz")[i % 3], f"d{i % 12}"
        rates[f"h{i}.{domain}.{tld}"] = 0.7 if domain == "d5" else 0.04 + 0.02 * (i % 3)
    pages, outcomes = [], []
    for host, rate in rates.items():
        for k in range(rnd.choice([0, 1, 5, 40])):
            at = len(pages)
            pages.append((at, f"http://{host.upper()}/{k}"))
            if rnd.random() < 0.8:
                outcomes.append((at, int(rnd.random() < rate)))
    pages += [(10_000, "http://new.d5.xyz/x"), (10_001, "http://new.d1.net/x"), (3, "http://h1.d1.net/again"), (None, None)]
    outcomes += [outcomes[0], outcomes[0], (None, 1), (4, None), (77_777, 1)]
    frames = (spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(outcomes, "page_id long, bad long"))
    got = judge_urls(*frames).collect()
    assert len(got) == len(pages)
    counts = {}
    for page, url in pages:
        seen = [b for p, b in outcomes if p == page and p is not None and b is not None]
        host = url.split("/")[2].lower() if url else ""
        n, bad = counts.get(host, (0, 0))
        counts[host] = n + len(seen), bad + sum(seen)
    want = plain_posteriors(counts)
    overall = (sum(b for _, b in counts.values()) + 0.5) / (sum(n for n, _ in counts.values()) + 1)
    for r in {r.host: r for r in got}.values():
        a, b = want[r.host]
        assert (r.host_labelled, r.host_bad) == counts[r.host]
        assert r.host_rate == pytest.approx(a / (a + b), rel=1e-9)
        if r.host_labelled in (0, 5) or r.host.startswith("new"):
            assert r.host_worse == pytest.approx(plain_above(a, b, overall, 40_000), abs=1e-4)
        assert r.verdict == ("block" if r.host_worse >= 0.95 else "allow")
    blocked = {r.host for r in got if r.verdict == "block"}
    assert blocked and all(".d5." in h for h in blocked)
    assert "new.d5.xyz" in blocked or want["new.d5.xyz"][0] / sum(want["new.d5.xyz"]) > 2 * overall


def test_no_labels_and_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, bad long")
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    (r,) = judge_urls(pages.withColumn("host_rate", F.lit("clash")), none, rules=()).collect()
    assert (r.host_labelled, r.host_rate, r.verdict) == (0, 0.5, "allow")
    assert judge_urls(pages.limit(0), none).count() == 0
    one = spark.createDataFrame([(1, 1)] * 30, "page_id long, bad long")
    assert judge_urls(pages, one, rules=()).first().host_bad == 30
