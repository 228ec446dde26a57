"""The Katz model against a plain one over dictionaries, and the sum of its probabilities."""

import math
import zlib
from collections import Counter, defaultdict

import pytest

from rillflow.llm.katz import K, discounts, score
from rillflow.llm.queries import QUERIES

END, START = "\n", "\t"


class Plain:
    def __init__(self, texts, order):
        self.order, self.n = order, [Counter() for _ in range(order + 1)]
        for t in texts:
            w = [START, *tokens(t)]
            for i in range(1, len(w)):
                for k in range(1, order + 1):
                    if i - k + 1 >= (0 if k > 1 else 1):
                        self.n[k][tuple(w[i - k + 1:i + 1])] += 1
        self.after = [defaultdict(dict) for _ in range(order + 1)]
        for k in range(1, order + 1):
            for g, c in self.n[k].items():
                self.after[k][g[:-1]][g[-1]] = c
        self.d = [None] + [discounts([0] + [sum(c == r for c in self.n[k].values()) for r in range(1, K + 2)])
                           for k in range(1, order + 1)]

    def p(self, h, w):
        k = len(h) + 1
        found = self.after[k].get(h)
        if not found:
            return self.p(h[1:], w)
        total = sum(found.values()) + (not any(c <= K for c in found.values()))
        seen = {v: c * (self.d[k][c] if c <= K else 1) / total for v, c in found.items()}
        if w in seen:
            return seen[w]
        left = 1 - sum(seen.values())
        return left if k == 1 else left / (1 - sum(self.p(h[1:], v) for v in seen)) * self.p(h[1:], w)

    def score(self, text):
        w = [START, *tokens(text)]
        return sum(math.log10(self.p(tuple(w[max(0, i - self.order + 1):i]), w[i])) for i in range(1, len(w)))


def tokens(text):
    return [x.decode() for x in (text or "").encode().lower().split()] + [END]


def is_train(i):
    return zlib.crc32(str(i).encode()) % 5 != 1


ROWS = [(i, " ".join(f"w{(i * j * j + j) % (3 + i % 17)}" for j in range(i % 23))) for i in range(120)]
ROWS += [(200, None), (201, ""), (202, "A a A b"), (202, "A a A b"), (None, "w1 w2 été"), (203, "x " * 300)]


@pytest.mark.parametrize("order,block", [(1, 10**6), (2, 10**6), (2, 200), (3, 300)])
def test_equals_plain_model(spark, order, block):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    got = score(docs, order=order, block_tokens=block, bucket_tokens=300).collect()
    plain = Plain([t for i, t in ROWS if is_train(i)], order)
    vocabulary = plain.after[1][()]
    n = sum(vocabulary.values())
    assert len(got) == len(ROWS)
    want = sorted((str(i), not is_train(i), len(tokens(t)), sum(w in vocabulary for w in tokens(t)), n) for i, t in ROWS)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in got) == want
    texts = dict(ROWS)
    for r in got:
        base = sum(math.log10((vocabulary.get(w, 0) + 0.5) / (n + 0.5 * (len(vocabulary) + 1))) for w in tokens(texts[r.doc_id]))
        assert r.base_score == pytest.approx(base, abs=1e-8)
        assert r.score == pytest.approx(plain.score(texts[r.doc_id]), abs=1e-7)


def test_query_backs_off_from_trigrams(spark, tmp_path):
    spark.createDataFrame(ROWS, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plain, texts = Plain([t for i, t in ROWS if is_train(i)], 3), dict(ROWS)
    for r in QUERIES["op1_katz_backoff"](spark, str(tmp_path)).collect():
        assert r.score == pytest.approx(plain.score(texts[r.doc_id]), abs=1e-7)


def test_sums_to_one():
    plain = Plain([t for _, t in ROWS], 3)
    words = [*plain.after[1][()], "unknown"]
    for h in [(), ("w1",), (START,), ("w1", "w2"), ("never", "w1")]:
        assert sum(plain.p(h, w) for w in words) == pytest.approx(1)


def test_empty(spark):
    assert score(spark.createDataFrame([], "doc_id long, text string")).collect() == []
