"""Families of texts that nearly link: exact components, few pairs to compare."""

import random

from rillflow.llm import jaccard_join
from rillflow.llm.shingles import shingle_set


def test_families_near_the_threshold_make_few_pairs(spark, monkeypatch):
    rnd = random.Random(5)

    def text(n):
        return [f"w{rnd.randrange(10**9)}" for _ in range(n)]

    docs = []
    for _ in range(3):  # three families of one group; two members have about 75 % in common
        passage = text(230)
        for i in range(120):
            w = list(passage)
            w[rnd.randrange(230)] = "edit%d" % rnd.randrange(10**9)
            docs.append(text(rnd.randint(24, 40)) + w)
        docs += [docs[-1 - i][:-2] for i in range(0, 30, 3)]  # near copies of some of them
    docs += [docs[0][20:] + docs[150][:60], docs[0] + docs[140][30:], docs[0][100:] + docs[260][30:]]
    rnd.shuffle(docs)
    rows = [(i, " ".join(w)) for i, w in enumerate(docs)]
    seen, stored = {}, jaccard_join.stored

    def counted(df, name):
        out = stored(df, name)
        seen[name] = out.count()
        return out

    monkeypatch.setattr(jaccard_join, "stored", counted)
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(
        spark.createDataFrame(rows, "doc_id long, text string"), size=5, percent=80).collect()}
    sets = [set(shingle_set(t, 5).tolist()) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    assert got == {i: root(i) for i in range(len(rows))}
    assert len(set(got.values())) > 100 and seen["pairs"] < 5 * len(rows)
