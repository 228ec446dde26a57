"""Which members of a group meet: whole links, few pairs, few bytes."""

import random

import numpy as np
import pytest

from rillflow.llm import jaccard_join
from rillflow.llm.shingles import shingle_set


def test_a_pair_is_counted_whole_whichever_side_it_stands_on(spark):
    """Elements whose most frequent c differ turned a pair around, and each half had too few in common."""
    rows = [(1, 1, x, c, 20, True, 20, i, e) for x, c, i, e in (
        # 1 and 2 have the elements 10 .. 13 in common; c = 1 is the most frequent of two of them, c = 2 of the others
        [(1, 1, i, 10 + i) for i in range(4)] + [(2, 2, i, 10 + i) for i in range(4)]
        + [(3, 1, i, 10 + i) for i in range(2)] + [(4, 2, i, 12 + i) for i in range(2)])]
    rows = spark.createDataFrame(rows, "g long, form int, x long, c long, n long, asks boolean, far int, i int, e long")
    bits = spark.createDataFrame([(x, [0] * (jaccard_join.PARITIES // 64)) for x in range(1, 5)], "x long, bits array<long>")
    met = [(r.a.x, r.b.x, r.a.i, r.b.i) for r in jaccard_join._meeting(rows, bits, 80).collect()]
    assert sorted(m for m in met if m[:2] == (1, 2)) == [(1, 2, i, i) for i in range(4)]
    assert all(a < b for a, b, *_ in met)


def test_sizes_and_parity_bits_rule_out_pairs_in_the_join(spark):
    rows = spark.createDataFrame([(1, 1, x, x, n, True, n, 0, 10) for x, n in ((1, 20), (2, 20), (3, 20), (4, 10))],
                                 "g long, form int, x long, c long, n long, asks boolean, far int, i int, e long")
    bits = spark.createDataFrame([(x, [b] * (jaccard_join.PARITIES // 64)) for x, b in ((1, 0), (2, 0), (3, -1), (4, 0))],
                                 "x long, bits array<long>")
    assert [(r.a.x, r.b.x) for r in jaccard_join._meeting(rows, bits, 80).collect()] == [(1, 2)]


def test_parity_bits_differ_at_most_as_often_as_sets():
    rnd = np.random.default_rng(3)
    for n in (1, 40, 3000):
        base = rnd.integers(0, 2**63, n, dtype=np.uint64)
        for k in (0, 1, n // 2):
            other = np.concatenate([base[k:], rnd.integers(0, 2**63, k // 2, dtype=np.uint64)])
            a, b = jaccard_join._parities(base), jaccard_join._parities(other)
            assert sum(int(v).bit_count() for v in (a ^ b).view(np.uint64)) <= k + k // 2
            assert len(a) == jaccard_join.PARITIES // 64


@pytest.fixture
def tables(monkeypatch):
    seen, stored = {}, jaccard_join.stored

    def counted(df, name):
        out = stored(df, name)
        seen[name] = out.count()
        return out

    monkeypatch.setattr(jaccard_join, "stored", counted)
    return seen


def test_a_large_family_that_nearly_links_makes_few_rows(spark, tables, monkeypatch):
    """Members that lack the same words of a passage have those in common, each with each, and do not link."""
    rnd = random.Random(11)
    passage = [f"w{i}" for i in range(260)]
    docs = []
    for _ in range(150):
        w = list(passage)
        for i in rnd.sample(range(260), 9):
            w[i] = "edit%d" % rnd.randrange(10**9)
        docs.append(w)
    docs += [d[:-1] for d in docs[:12]]
    rows = [(i, " ".join(w)) for i, w in enumerate(docs)]
    met, meeting = [], jaccard_join._meeting

    def counted(*args):
        out = meeting(*args)
        met.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "_meeting", counted)
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(
        spark.createDataFrame(rows, "doc_id long, text string"), size=5, percent=80).collect()}
    sets = [set(shingle_set(t, 5).tolist()) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    want = list(range(len(rows)))
    for _ in rows:
        for i, j in links:
            want[i] = want[j] = min(want[i], want[j])
    assert got == dict(enumerate(want))
    assert met[0] < 20 * len(rows) and tables["fronts"] < 100 * len(rows)
