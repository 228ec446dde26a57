"""Strangers that share a passage their group's leader may lack: exact links, few rows that meet."""

import random

from pyspark.sql import functions as F

from rillflow.llm import jaccard_join
from rillflow.llm.shingles import shingle_set


def test_shared_passages_make_few_rows(spark, monkeypatch):
    rnd = random.Random(3)

    def text(n):
        return [f"w{rnd.randrange(10**9)}" for _ in range(n)]

    passages, copied = [text(60) for _ in range(3)], text(90)
    docs = []
    for i in range(900):  # more than half of each is the passage, so they share index lists
        docs.append(passages[i % 3] + text(rnd.randint(25, 45)))
    for _ in range(200):
        w = list(copied)
        w[rnd.randrange(90)] = "edit%d" % rnd.randrange(10**9)
        docs.append(w)
    for i in range(0, 900, 50):  # near copies of some of the strangers
        docs.append(docs[i][:-1] + ["end"])
    rnd.shuffle(docs)
    rows = [(i, " ".join(w)) for i, w in enumerate(docs)]
    seen = {}
    fronts = jaccard_join._fronts

    def counted(state):
        out = fronts(state)
        each = out.where("not form").select("g", "asks", F.explode("front").alias("e")).groupBy("g", "e").agg(
            F.count("*").alias("c"), F.count_if("asks").alias("a"))
        seen["met"] = each.agg(F.sum(F.expr("a * (c - a) + a * (a - 1) div 2"))).first()[0] or 0
        seen["sets"] = out.where("not form").count()
        return out

    monkeypatch.setattr(jaccard_join, "_fronts", counted)
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
    assert seen["sets"] > 500 and seen["met"] < 40 * seen["sets"]
