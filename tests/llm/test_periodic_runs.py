"""Periodic runs against a search over all starts and periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from conftest import SF
from rillflow.llm.periodic_runs import WaveletTree, digests, find_runs, planted, runs_of
from rillflow.llm.queries import QUERIES


def plain_runs(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            n = i - s + q
            if n >= max(6, 4 * q) and not any(all(w[k] == w[k + d] for k in range(s, s + n - d)) for d in range(1, q)):
                out.append((s, n, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = plain_runs(w)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    top = [None] * 4
    if runs:
        best = runs[0]
        for r in runs:
            if r[1] * best[2] > best[1] * r[2]:
                best = r
        top = [*best, 1000 * best[1] // best[2]]
    return (doc_id, len(runs), *top, sha("".join("%d,%d,%d\n" % r for r in runs).encode()),
            sha(b" ".join(x for i, x in enumerate(w) if i not in drop)))


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def repetitive(rnd, n):
    w = []
    while len(w) < n:
        if rnd.random() < .5:
            w += [rnd.choice("abcd") for _ in range(rnd.randint(0, 9))]
        else:
            unit = [rnd.choice("ab") for _ in range(rnd.choice([1, 2, 3, 5, 8, 9, 17, 33]))]
            w += (unit * 7)[: rnd.randint(len(unit), 7 * len(unit))]
    return w[:n]


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_repetitive_words_equal_a_search(seed):
    rnd = random.Random(seed)
    texts = [repetitive(rnd, rnd.choice([0, 1, 5, 6, 20, 77, 300])) for _ in range(30)]
    codes = np.array([ord(x) - 97 for t in texts for x in t], np.int64)
    got = runs_of(codes, np.array([len(t) for t in texts], np.int64))
    want = [(i, *r) for i, t in enumerate(texts) for r in plain_runs(t)]
    assert [tuple(r) for r in np.stack(got, 1).tolist()] == want


def test_a_run_ends_with_its_text():
    sizes = np.array([5, 5, 0, 6])
    got = runs_of(np.zeros(16, np.int64), sizes)
    assert [tuple(r) for r in np.stack(got, 1).tolist()] == [(3, 0, 6, 1)]


def test_range_successor_equals_a_search():
    rnd = np.random.default_rng(3)
    values = rnd.integers(0, 100, 300)
    tree = WaveletTree(values, 7)
    lo = rnd.integers(0, 300, 500)
    hi = np.minimum(300, lo + rnd.integers(0, 60, 500))
    ask = rnd.integers(0, 101, 500)
    want = [min((v for v in values[a:b] if v >= x), default=-1) for a, b, x in zip(lo, hi, ask)]
    assert tree.successor(lo, hi, ask).tolist() == want


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "a b " * 9), (3, " \n\t "), (4, "x " * 6), (5, "x " * 5), (6, "x " * 40_000),
            (7, "é   " * 8), (25, "one two three " * 12), (25, "tail"), (10, "A a " * 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 n_runs", "'x' collapsed", "0 start").repartition(3)
    got = digests(find_runs(docs, test_repeats=True)).where("doc_id is null or doc_id != 6").collect()
    assert order(map(tuple, got)) == order(plain_row(*r) for r in rows if r[0] != 6)
    six = find_runs(docs.where("doc_id = 6")).first()
    assert (six.n_words, six.n_runs, six.length, six.period, six.collapsed) == (40_000, 1, 40_000, 1, "x")
    assert digests(find_runs(docs.where("false"))).collect() == []


def test_planted_words_repeat():
    at = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    w = [str(i).encode() for i in range(97)]
    assert planted(w, at) != w and len(planted(w, at)) == 97 and planted(w, None) == w and planted([], at) == []


def test_query_equals_a_search(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    some = {r.doc_id for r in docs if len((r.text or "").split()) < 1500}
    got = [tuple(r) for r in QUERIES["op11_periodic_runs"](spark, SF).collect()]
    assert len(got) == len(docs)
    assert order(r for r in got if r[0] in some) == order(plain_row(r.doc_id, r.text) for r in docs if r.doc_id in some)
