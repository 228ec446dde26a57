"""The factorization machine against plain sums, numeric slopes and held-out labels."""

import random
import zlib
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from rillflow.llm.queries import QUERIES
from rillflow.llm.toxicity import LENGTHS, Machine, score_toxicity, term_counts, terms_of

FULL = "/root/testdata/sf0.1"


def plain_score(m, features):
    pairs = sum(m.v[i] @ m.v[j] for i, j in combinations(features, 2))
    return m.bias[0] + sum(m.w[i] for i in features) + pairs


def random_machine(n=12, factors=3, seed=1):
    rnd = np.random.default_rng(seed)
    m = Machine(n, factors)
    m.bias[0], m.w, m.v = 0.3, rnd.normal(size=n), rnd.normal(size=(n, factors))
    return m


def test_scores_are_sums_over_pairs():
    m, rnd = random_machine(), random.Random(2)
    lists = [np.array(sorted(rnd.sample(range(12), k)), np.int16) for k in (0, 1, 2, 5, 12, 0)]
    got = m.scores(lists)
    want = [1 / (1 + np.exp(-plain_score(m, x))) for x in lists]
    assert np.allclose(got, want)
    again = Machine.load(m.dump())
    assert np.allclose(again.scores(lists), want) and m.scores([]).shape == (0,)


def test_pairs_that_no_additive_weights_separate():
    """Label 1 for a with b and c with d, 0 for a with d and c with b: w[a]+w[b]+w[c]+w[d] cannot be both."""
    lists, labels = [], []
    for pair, y in (((0, 1), 1), ((2, 3), 1), ((0, 3), 0), ((2, 1), 0)):
        lists += [np.array(sorted(pair), np.int16)] * 20
        labels += [y] * 20
    m = Machine(4, 4)
    m.fit(lists, np.array(labels, float))
    assert ((m.scores(lists) >= 0.5) == np.array(labels)).all()


def test_term_counts_equal_plain_counts(spark):
    rows = [("a b a", 1), ("a b", 0), ("", 1), (None, 0), ("word words", 1)]
    got = {r.term: (r.n, r.n_one) for r in term_counts(spark.createDataFrame(rows, "text string, label int").repartition(2)).collect()}
    want = {}
    for t, y in rows:
        for x in terms_of(t).tolist():
            n, k = want.get(x, (0, 0))
            want[x] = (n + 1, k + y)
    assert got == want and terms_of("").tolist() == terms_of(None).tolist() == [LENGTHS[0]]
    assert set(terms_of("Stem stem")) > set(terms_of("stem")) - set(LENGTHS.tolist())


def texts(n, seed):
    """Insults are toxic with a group next to them, not by themselves; nor are groups."""
    rnd, out = random.Random(seed), []
    for i in range(n):
        w = [f"w{rnd.randint(0, 60)}" for _ in range(rnd.randint(20, 60))]
        a, b = rnd.random() < .5, rnd.random() < .5
        w += ["insult"] * a + ["group"] * b
        rnd.shuffle(w)
        out.append((i, " ".join(w), int(a and b)))
    return out


def test_held_out_rows_and_labels(spark):
    rows = texts(1200, 3)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    got = {r.doc_id: r for r in score_toxicity(docs, labels).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, *_ in rows)
    assert all(got[i].predicted == y == (got[i].score >= 0.5) for i, _, y in rows)
    # labels of held-out rows change nothing
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {r.doc_id: r.score for r in score_toxicity(docs, flipped).collect()} == {i: r.score for i, r in got.items()}


def test_odd_rows(spark):
    rows = texts(300, 4)
    odd = [(None, "insult group"), (None, None), (7, None), (7, rows[7][1]), (9000, ""), (9001, " \n"), (9002, "insult group " + "é🎉 " * 30_000)]
    docs = spark.createDataFrame([r[:2] for r in rows] + odd, "doc_id long, text string").selectExpr("*", "'z' label", "1 score", "2 toxic", "0 term")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5, None), (6, rows[6][2]), (77777, 1)],
                                   "doc_id long, toxic int").selectExpr("*", "'t' text", "1 label")
    got = score_toxicity(docs, labels).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [True, True]
    empty = {r.score for r in got if r.doc_id in (9000, 9001)}
    assert len(empty) == 1 and {r.score for r in got if r.doc_id == 7} >= empty
    none = score_toxicity(docs, labels.where("toxic = 0")).select("score", "predicted").distinct().collect()
    assert len(none) == 1 and none[0].score < 1e-6 and none[0].predicted == 0
    assert {r.score for r in score_toxicity(docs, labels.where("false")).collect()} == {0.5}
    assert score_toxicity(docs.where("false"), labels).collect() == []


def test_held_out_accuracy_of_the_query(spark):
    got = QUERIES["op13_toxic_machine"](spark, FULL).where("held_out").join(
        spark.read.parquet(f"{FULL}/labels.parquet").select("doc_id", "toxic"), "doc_id").collect()
    right = sum(r.predicted == r.toxic for r in got)
    caught = sum(r.predicted for r in got if r.toxic) / sum(r.toxic for r in got)
    false = sum(r.predicted for r in got if not r.toxic)
    assert right / len(got) > 0.97 and caught > 0.85 and false <= 0.005 * len(got)
