"""run() and every stage of the pipeline against plain versions, with copies, near copies, shared passages,
nulls, repeated ids, and no rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from rillflow.llm.packing import Encoder

DOC = "doc_id long, text string, lang string, source string, n_chars long"
PASSAGE = "\n".join(" ".join(f"p{i}x{j}" for j in range(15)) + "." for i in range(5))


def words(rnd, n):
    return [f"w{rnd.randint(0, 3000)}" for _ in range(n)]


def text_of(w):
    return "\n".join(" ".join(w[i:i + 12]) + "." for i in range(0, len(w), 12))


@pytest.fixture(scope="module")
def rows():
    rnd, out = random.Random(11), []
    for i in range(20):
        w = words(rnd, 150)
        out.append((i, text_of(w), "en", f"s{i % 4}"))
        if i % 3 == 0:
            out += [(100 + i, text_of(w), "en", "s1"), (200 + i, text_of(w[:70] + ["new"] + w[71:]), "fr", None)]
        if i % 4 == 0:
            out.append((300 + i, text_of(words(rnd, 60)) + "\n" + PASSAGE + "\n" + text_of(words(rnd, 60)), "de", "s2"))
    same = text_of(words(rnd, 120))
    out += [(None, same, "en", "s0"), (None, text_of(words(rnd, 120)), "en", "s0"), (None, same, "en", "s3"),
            (500, text_of(words(rnd, 120)), "en", "s0"), (500, text_of(words(rnd, 120)), "en", "s0"), (501, same, "en", "s0"),
            (502, None, None, None), (503, "", "en", "s0"), (504, "too short.", "en", "s0"), (505, "x " * 400, "en", "s0")]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOC).repartition(4)


def bag(df):
    return Counter((r.doc_id, r.text, r.lang, r.source) for r in df.collect())


def shingles(text, k=5):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + min(k, len(w))]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def plain_groups(texts):
    """Components of texts (by place) whose sets are similar to 80 %."""
    sets, parent = [shingles(t) for t in texts], list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(texts))]


def check_near(before, after):
    """Each group keeps one document, the kept ones are rows of the input as they were."""
    groups = plain_groups([t for _, t, *_ in before])
    kept = Counter()
    for key, n in after.items():
        assert n == 1
        kept[groups[next(i for i, r in enumerate(before) if r[:4] == key)]] += 1
    filled = {g for g, r in zip(groups, before) if shingles(r[1])}
    assert all(kept[g] == 1 for g in filled)
    for g in filled:  # by the smallest id where all rows have ids of their own
        ids = [r[0] for k, r in zip(groups, before) if k == g]
        named = Counter(r[0] for r in before)
        if all(i is not None and named[i] == 1 for i in ids):
            assert min(ids) in [r[0] for r in after if r[0] in ids]


def test_quality_keeps_clean_documents(spark, docs, rows):
    got = bag(P.quality(spark, docs, ""))
    clean = [r for r in rows if r[0] is not None and r[0] < 500]
    assert all(got[r[:4]] >= 1 for r in clean) and not any(k[0] in (502, 503, 504, 505) for k in got)


def test_line_dedup_cuts_the_later_copies_of_a_passage(spark, docs, rows):
    got = P.repeated_lines(spark, docs, "").collect()
    holders = sorted(r[0] for r in rows if r[1] and PASSAGE in r[1])
    assert [r.doc_id for r in got if r.text and PASSAGE in r.text] == holders[:1]
    by = {r.doc_id: r.text for r in got if r.doc_id in holders}
    source = {r[0]: r[1] for r in rows}
    assert all(by[i] == source[i].replace(PASSAGE + "\n", "") for i in holders[1:])
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)


def test_near_duplicates_equal_all_pairs(spark, docs, rows):
    check_near(rows, bag(P.near_duplicates(spark, docs, "")))


def test_unequal_texts_of_one_id_stay(spark):
    rnd = random.Random(2)
    a, b = text_of(words(rnd, 90)), text_of(words(rnd, 90))
    df = spark.createDataFrame([(1, a, "en", "s", 1), (1, b, "en", "s", 1), (1, b, "en", "s", 1), (None, a, "en", "s", 1), (2, b, "en", "s", 1)], DOC)
    got = P.near_duplicates(spark, df, "").collect()
    assert sorted(r.text for r in got) == sorted([a, b])


def test_plain_ids_keep_the_smallest(spark, rows):
    some = [r for r in rows if r[0] is not None and r[0] < 500]
    got = bag(P.near_duplicates(spark, spark.createDataFrame(some, DOC), ""))
    check_near(some, got)
    assert {k[0] for k in got} >= set(range(20))


def test_mixture_takes_whole_copies(spark, docs, rows):
    got = bag(P.mixture(spark, docs, ""))
    known = Counter(r[:4] for r in rows)
    assert set(got) <= set(known) and all(n <= 3 * known[k] for k, n in got.items()) and sum(got.values()) > len(rows) / 3


def test_packing_loses_no_id(spark, docs, rows):
    pieces = P.packing(spark, docs, "").collect()
    encode = Encoder()
    want = sum(len(encode(r[1] or "")) + 1 for r in rows)
    assert sum(p.length for p in pieces) == want


def test_run_chains_the_stages(spark, rows, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = P.run(spark, str(tmp_path))
    step = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for i, (_, stage) in enumerate(P.STAGES[:-1]):
        stage(spark, step, str(tmp_path)).write.parquet(str(tmp_path / f"s{i}"))
        step = spark.read.parquet(str(tmp_path / f"s{i}"))
        assert step.columns == P.COLUMNS
    want = P.STAGES[-1][1](spark, step, str(tmp_path))
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    total = lambda df: df.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert Counter(map(tuple, total(got))) == Counter(map(tuple, total(want))) and set(key) <= set(got.columns)


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], DOC).write.parquet(str(tmp_path / "documents.parquet"))
    assert P.run(spark, str(tmp_path)).collect() == []
