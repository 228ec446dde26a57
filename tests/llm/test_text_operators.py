"""The text operators on small tables with nulls, empty texts, ties, repeated rows, clashing
columns and no rows, against plain versions where SQL does not hold them."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from check import compare, open_tables
from conftest import SF
from rillflow.llm.chat_format import ROLES, SYMBOLS, Model, parse_transcripts, segment_ends, symbol_of
from rillflow.llm.components import components
from rillflow.llm.jaccard_join import index_keys, jaccard_components
from rillflow.llm.line_dedup import dedup_lines
from rillflow.llm.mixing import mix
from rillflow.llm.oracle import SQL
from rillflow.llm.order_minhash import fingerprint, fingerprints, likeness
from rillflow.llm.packing import Encoder, Packer, pack
from rillflow.llm.pii import Field, added_spans, base_spans, find, luhn
from rillflow.llm.quality_rules import clean_lines
from rillflow.llm.queries import QUERIES, transcript_lines
from rillflow.llm.shingles import shingle_set
from rillflow.llm.url_filter import judge_urls

DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"w{i}" for i in range(40)]
LONG = " ".join(WORDS * 400)
ODD = [(1, None, None, None, None), (2, "", "en", "a", 0), (2, "", "en", "a", 0), (None, "x y z", None, "b", 5),
       (3, " \n\t\n ", "en", None, 5), (4, LONG, "en", "a", len(LONG)), (5, LONG, "en", "b", len(LONG)),
       (6, "One line.\n" * 30, "en", "a", 300), (7, "été 🎉 +1 (743) 555-3824 a@b.cd", "fr", "é", 30)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOC).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), open_tables(SF), SQL[name]) == []


def plain_sets(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + min(k, len(w))]) for i in range(max(1, len(w) - k + 1))} if w else set()


def test_jaccard_components_equal_all_pairs(spark):
    rnd, rows = random.Random(5), []
    for g in range(12):
        base = [rnd.choice(WORDS) for _ in range(rnd.choice([4, 12, 40, 150]))]
        for _ in range(9):
            t = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 4])):
                t[rnd.randrange(len(t))] = rnd.choice(WORDS)
            rows.append((len(rows) * 3, " ".join(t)))
    rows += [(900, None), (901, " "), (902, "A b"), (903, "a B")]
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: plain_sets(t, 3) for i, t in rows}
    low = {i: i for i in sets}
    for _ in range(len(sets)):
        changed = False
        for a in sets:
            for b in sets:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]) and low[a] < low[b]:
                    low[b], changed = low[a], True
        if not changed:
            break
    assert got == {i: (len(sets[i]), low[i]) for i in sets}


def test_jaccard_components_of_chains_with_shared_passages(spark):
    """Clusters, chains of edits and strangers that common passages put into one group."""
    rnd, texts = random.Random(8), []
    passages = [[f"p{k}x{i}" for i in range(30)] for k in range(3)]
    for g in range(10):
        t = [f"w{rnd.randrange(4000)}" for _ in range(rnd.choice([15, 60, 90, 200]))] + passages[g % 3]
        for step in range(10):
            texts.append(" ".join(t))
            at = rnd.randrange(len(t) - 1)
            if g % 2:  # a chain: every text differs from the one before
                t = t[:at] + [f"n{rnd.randrange(4000)}"] + t[at + rnd.randrange(3):]
            elif step % 3 == 0:
                t = t + passages[(g + step) % 3][:12]
    rnd.shuffle(texts)
    rows = list(enumerate(texts))
    sets = {i: plain_sets(t, 5) for i, t in rows}
    for percent in (80, 90):
        got = {r.doc_id: r.component_id
               for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 5, percent).collect()}
        low = {i: i for i in sets}
        links = [(a, b) for a in sets for b in sets
                 if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
        for _ in sets:
            for a, b in links:
                low[a] = low[b] = min(low[a], low[b])
        assert got == low


def test_linked_sets_share_an_index_list():
    rnd = np.random.default_rng(3)
    for n in (3, 12, 19, 40, 333, 2000):
        a = np.sort(rnd.integers(0, 2**63, n, dtype=np.uint64))
        most = n // 19
        b = np.sort(np.concatenate([a[most:], rnd.integers(0, 2**63, most // 9, dtype=np.uint64)]))
        if 19 * len(np.setxor1d(a, b)) <= len(a) + len(b) and len(np.setxor1d(a, b)):
            assert np.intersect1d(index_keys(a, 90), index_keys(b, 90)).size


def test_components(spark):
    e = spark.createDataFrame([(5, 3), (3, 9), (9, 11), (2, 2), (20, 21), (21, 20)], "a long, b long")
    assert {(r.id, r.component) for r in components(e).collect()} == {
        (3, 3), (5, 3), (9, 3), (11, 3), (20, 20), (21, 20)}


def test_fingerprints(spark, odd, none):
    assert fingerprints(none).count() == 0
    got = fingerprints(odd).collect()
    assert len(got) == len(ODD) and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    order = sorted(ODD, key=lambda r: (r[0] if r[0] is not None else -1, r[1] or ""))
    texts = [r[1] or "" for r in order]
    assert Counter((r.doc_id, r.n_chars) for r in got) == Counter((r[0], len(t)) for r, t in zip(order, texts))
    by = {r.doc_id: r for r in got}
    assert by[4].fingerprint == by[5].fingerprint and by[4].near_next == 1
    moved = LONG[len(LONG) // 2:] + LONG[:len(LONG) // 2]
    assert likeness(fingerprint("abc"), fingerprint("abc")) == 1
    assert likeness(fingerprint("".join(WORDS)), fingerprint("".join(reversed(WORDS)))) < 0.6
    assert fingerprint(moved).shape == fingerprint("").shape


def test_lines(spark, odd, none):
    assert dedup_lines(none).count() == 0
    run = " ".join(WORDS) + "\n" + " ".join(WORDS[:15])
    rows = [(1, f"a b\n{run}\nend"), (2, f"{run}\nother"), (3, f"x\n\n{run}"), (4, run + "\n" + run), (5, None)]
    got = {r.doc_id: (r.text, r.n_removed) for r in dedup_lines(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("other", 2), 3: ("x\n", 2), 4: ("", 4), 5: (None, 0)}
    assert dedup_lines(odd).count() == len(ODD)


def plain_runs(rows, least):
    """Line numbers cut by id: every run of equal lines with an earlier place, extended to its end."""
    lines = {d: [(i, x.split()) for i, x in enumerate(t.split("\n")) if x.split()] for d, t in rows}
    cut = {d: set() for d in lines}
    places = [(d, k) for d in sorted(lines) for k in range(len(lines[d]))]
    for at, (d, k) in enumerate(places):
        for e, j in places[:at]:
            n = 0
            while n < min(len(lines[d]) - k, len(lines[e]) - j) and lines[d][k + n][1] == lines[e][j + n][1]:
                n += 1
            if sum(len(w) for _, w in lines[d][k:k + n]) >= least:
                cut[d].update(i for i, _ in lines[d][k:k + n])
    return cut


def test_runs_are_cut_to_their_last_line(spark):
    run = " ".join(WORDS + WORDS[:20]) + "\n" + " ".join(WORDS[:20])
    rows = [(1, f"{run}\nthe end"), (2, f"{run}\nother"), (3, f"{run.splitlines()[0]}\nno more"), (4, f"x\n{run}")]
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "other", 3: "no more", 4: "x"}
    rnd, rows = random.Random(9), []
    pool = [" ".join(rnd.choices(WORDS, k=rnd.choice([1, 2, 3, 9, 14]))) for _ in range(12)]
    runs = [[rnd.choice(pool) for _ in range(rnd.randint(2, 9))] for _ in range(6)]
    for d in range(60):
        parts = [rnd.choice(runs)[rnd.randrange(2):] if rnd.random() < 0.6 else [rnd.choice(pool)] for _ in range(4)]
        rows.append((d, "\n".join(sum(parts, []))))
    got = {r.doc_id: set(r.removed) for r in dedup_lines(
        spark.createDataFrame(rows, "doc_id long, text string"), min_words=12).collect()}
    assert got == plain_runs(rows, 12)


def test_mix(spark, odd, none):
    assert mix(none).count() == 0
    rows = [(i, "w " * (i % 7), None, f"s{i % 3}", 0) for i in range(300)]
    got = mix(spark.createDataFrame(rows, DOC)).collect()
    assert sum(r.taken for r in got) <= sum(r.size for r in got) and all(r.taken <= 3 * r.size for r in got)
    for s in "012":
        mine = [r for r in got if r.source == f"s{s}"]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 12
    assert mix(odd).count() == len(ODD)


def test_packing_round_trip(spark, odd, none):
    assert pack(none).count() == 0
    encode, got = Encoder(), pack(odd, length=64, with_ids=True).collect()
    want = Counter((r[0], tuple([*encode.slow.encode(r[1] or "", add_special_tokens=False).ids, 0])) for r in ODD)
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in seqs.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 64 and (at & (at - 1) == 0)
    for key in {r[0] for r in ODD}:
        texts = [ids for (i, ids), n in want.items() if i == key for _ in range(n)]
        mine = [r for r in got if r.doc_id == key]
        assert sorted(sum((list(r.ids) for r in mine), [])) == sorted(sum(map(list, texts), []))
        if len(texts) == 1:
            assert [x for r in sorted(mine, key=lambda r: r.start) for x in r.ids] == list(texts[0])


def test_fast_ids_equal_slow_ones():
    encode, rnd = Encoder(), random.Random(2)
    texts = ["<|endoftext|> a", " \n\n x", "don't I'LL", "é" * 1500, "a" * 3000, " " * 1200, "12 345!?"]
    texts += ["".join(rnd.choice("ab \n\té漢🎉'1.s  ") for _ in range(80)) for _ in range(300)]
    for t in texts:
        assert list(encode(t)) == encode.slow.encode(t, add_special_tokens=False).ids


def test_packer_bounds_open_windows():
    p, total, seen = Packer(64, most_open=10), 0, 0
    for i in range(500):
        n = 1 + i * 7 % 60
        total += n
        seen += sum(len(x[2]) for w in p.add(i, np.full(n, i, "<u4")) for x in w)
        assert p.n_open <= 64
    assert seen + sum(len(x[2]) for w in p.close() for x in w) == total


def plain_spans(t):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        out += [(2, *m.span())] * (13 <= len(d) <= 19 and luhn(d))
    return out + [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
                  if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_pii(spark, odd, none):
    rnd = random.Random(1)
    for _ in range(3000):
        t = "".join(rnd.choice("ab0123456789 .@@-+()._%\n5") for _ in range(rnd.randint(0, 60)))
        assert base_spans(t) == plain_spans(t)
    examples = [([0, 6, 14], 3, 3, -1, [0] * 5)] * 30 + [([0, 1], 4, -1, -1, [0] * 5)] * 60
    model = Field.fitted(examples)
    t = "call +1 (743) 555-3824 now, later 555-3824 again, room 12"
    assert [t[a:b] for _, a, b in added_spans(t, base_spans(t), model, 0.8)] == ["555-3824"]
    assert added_spans("room 12 floor 3", [], model, 0.8) == []
    got = {r.doc_id: r for r in find(odd).collect()}
    assert (got[7].n_email, got[7].n_phone) == (1, 1) and got[1].spans == ""
    assert find(none).count() == 0


def test_pii_evidence_reaches_all_repeats():
    model = Field(np.zeros((20, 5)), np.zeros((5, 5)), np.array([8.0] * 4 + [0.0]))
    words = " ".join(["555-3824 and then"] * 50)
    for t in (f"call +1 (743) 555-3824 now, {words}", f"{words} call +1 (743) 555-3824"):
        assert [t[a:b] for _, a, b in added_spans(t, base_spans(t), model, 0.9)] == ["555-3824"] * 50


def test_pii_neighbours_are_one_datum_within_its_digits():
    model = Field(np.zeros((20, 5)), np.zeros((5, 5)), np.array([8.0] * 4 + [0.0]))
    a, b = "4111111111111111", "5500005555555559"
    t = f"{a} or {b}. Later {a} {b}, and mail x@y.org x@z.org: x@y.org x@z.org"
    # side by side they are too long for the pattern, which has them where they stand alone
    assert [t[s:e] for _, s, e in added_spans(t, base_spans(t), model, 0.9)] == [a, b]
    t = f"{a} and {b}; x{a} {b}x"
    first = [(2, 0, 16), (2, 21, 37)]
    assert [t[s:e] for _, s, e in added_spans(t, first, model, 0.9)] == [f"x{a}", f"{b}x"]
    t = "+1 743 555 3824 so 743 555 3824"
    assert [t[s:e] for _, s, e in added_spans(t, [(3, 0, 15)], model, 0.9)] == ["743 555 3824"]


def test_pii_marginals_are_exact_on_trees_and_near_on_loops():
    rnd = np.random.default_rng(6)
    for loop in (False, True):
        for _ in range(5):
            model = Field(rnd.normal(size=(20, 5)), rnd.normal(size=(5, 5)) / 2, np.append(rnd.random(4) * 2, 0))
            n, on = 6, [[0, int(f)] for f in rnd.integers(1, 20, 6)]
            label, chain, skip = np.array([4, 3, 4, 4, 4, 4]), [(0, 1), (2, 3)], [(0, 2), (3, 5), (1, 4)]
            if loop:
                chain.append((4, 5))
            p = np.zeros((n, 5))
            for y in itertools.product(range(5), repeat=n):
                if y[1] == 3:
                    s = sum(model.unary[f, y[i]].sum() for i, f in enumerate(on) if i != 1)
                    s += sum(model.chain[y[a], y[b]] for a, b in chain)
                    s += sum(model.skip[y[a]] for a, b in skip if y[a] == y[b])
                    p[range(n), y] += np.exp(s)
            got = model.marginals(on, label, chain, skip)
            assert np.abs(got - p / p.sum(1, keepdims=True)).max() < (0.1 if loop else 1e-3)


def test_segments_give_the_viterbi_path():
    rnd = np.random.default_rng(4)
    n = 2 * len(ROLES)
    log = lambda *s: np.log(rnd.dirichlet(np.ones(s[-1]), s[:-1]))
    model = Model(log(n), log(n, n), log(n, 10))
    symbols = rnd.integers(0, 10, 50).tolist()
    whole = model.transfer(symbols, True)
    path = model.path(symbols, -1, int(whole[0].argmax()))
    cuts = [0, 7, 8, 30, 50]
    parts = [model.transfer(symbols[a:b], a == 0) for a, b in zip(cuts, cuts[1:])]
    ends = segment_ends(parts)
    got = sum((model.path(symbols[a:b], p, e) for a, b, p, e in zip(cuts, cuts[1:], [-1, *ends], ends)), [])
    assert got == path


LINE = "conv_id long, line_no long, text string"


def plain_turns(rows, model):
    """(conv_id, first line, lines, role) of the turns on the best way through whole transcripts."""
    out = Counter()
    for conv in {r[0] for r in rows}:
        ls = sorted(((i is not None, i or 0, (t or "").encode()) for c, i, t in rows if c == conv))
        symbols = [symbol_of(t.decode()) for _, _, t in ls]
        path = model.path(symbols, -1, int(model.transfer(symbols, True)[0].argmax()))
        cuts = [k for k, s in enumerate(path) if s % 2 == 0] + [len(path)]
        out.update((conv, ls[a][1] if ls[a][0] else None, z - a, ROLES[path[a] // 2]) for a, z in zip(cuts, cuts[1:]))
    return out


def joined_turns(pieces):
    """Turns from their pieces, by the order of the lines in a transcript; a turn goes on in the next piece."""
    out = Counter((r.conv_id, r.first_line, r.n_lines, r.role) for r in pieces if r.begins and r.ends)
    for r in pieces:
        assert r.rendered.startswith(f"<|{r.role}|>") == r.begins and r.rendered.endswith("<|end|>") == r.ends
    return out


@pytest.fixture(scope="module")
def chat():
    rnd = np.random.default_rng(11)
    n = 2 * len(ROLES)
    return Model.fitted({(a, b): rnd.random() * 9 for a in range(-1, n) for b in range(n) if a >= 0 or b % 2 == 0},
                        {(a, o): rnd.random() * 9 for a in range(n) for o in range(SYMBOLS)})


def chat_rows():
    rnd = random.Random(12)
    some = ["User: hi?", "Assistant: " + "word " * 20, "well", "System: be brief", "", None, "why?", "x " * 70]
    rows = [(c, i, rnd.choice(some)) for c in (1, 2, 3) for i in range(rnd.randint(1, 9))]
    rows += [(None, rnd.randrange(3), rnd.choice(some)) for _ in range(200)]  # few numbers, many lines
    rows += [(5, 7, "User: the same?")] * 150 + [(5, 2**33, "end")]
    return rows


def test_segments_of_null_ids_and_equal_numbers(spark, chat):
    assert_whole(spark, chat, chat_rows())


def assert_whole(spark, chat, rows):
    got = parse_transcripts(spark.createDataFrame(rows, LINE).repartition(5), chat, segment=10**6).collect()
    assert sum(r.n_lines for r in got) == len(rows)
    short = parse_transcripts(spark.createDataFrame(rows, LINE).repartition(5), chat, segment=4).collect()
    assert max(r.n_lines for r in short) <= 4 and sum(r.n_lines for r in short) == len(rows)
    want = plain_turns(rows, chat)
    for turns in (got, short):
        assert all(joined_turns(turns)[t] <= want[t] for t in joined_turns(turns))
        assert Counter(r.conv_id for r in turns if r.begins) == Counter(t[0] for t in want.elements())
        assert Counter(r.conv_id for r in turns if r.ends) == Counter(t[0] for t in want.elements())
        for c in {r[0] for r in rows}:
            by_role = lambda x: sum(n for k, n in x if k == c)
            assert all(by_role([(t[0], t[2]) for t in want.elements() if t[3] == role])
                       == by_role([(r.conv_id, r.n_lines) for r in turns if r.role == role]) for role in ROLES)
    return got


def test_lines_without_a_number_come_first(spark, chat):
    rows = [(6, None, t) for t in ("User: hi?", "", None, "why?", "System: be brief")]
    rows += [(6, 0, "User: a"), (6, 1, "b"), (8, None, "Assistant: only this"), (None, None, "User: x"), (None, -1, "y")]
    got = assert_whole(spark, chat, rows)
    assert {r.conv_id for r in got if r.first_line is None} == {6, 8, None}
    conversations = [(1, None, "user", "c\nd"), (1, 0, "user", "e"), (None, None, "user", "f")]
    lines = transcript_lines(spark.createDataFrame(conversations, "conv_id long, turn long, role string, text string"))
    assert sum(r.n_lines for r in parse_transcripts(lines, chat).collect()) == 4


def test_long_turns_keep_their_number(spark):
    rows = [(1, 0, "user", "a\n" * (2**20 + 5)), (1, 1, "assistant", "b"), (1, -1, "user", "c")]
    lines = transcript_lines(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert lines.select("line_no").distinct().count() == 2**20 + 8


def test_transcript_roles_are_found(spark):
    got = QUERIES["op9_transcript_roles"](spark, SF).where("begins").select("conv_id", "turn", "role").collect()
    true = {(r.conv_id, r.turn): r.role for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()}
    assert sum(true.get((r.conv_id, r.turn)) == r.role for r in got) > 0.75 * len(true)


def test_quality_and_urls(spark, odd, none):
    assert clean_lines(none).count() == 0 and clean_lines(odd).count() == len(ODD)
    clash = odd.withColumnRenamed("lang", "kept")
    assert {r.doc_id for r in clean_lines(clash).where("kept").collect()} <= {4, 5}
    pages = spark.createDataFrame([(1, None, "x"), (None, "no scheme", "x"), (2, "HTTP://A.example.COM?q", "x"),
                                   (3, "http://www.example.com/en/1", "x"), (4, "https://b.example.com/en/#", "x")],
                                  "page_id long, url string, host string")
    labels = spark.createDataFrame([], "page_id long, bad long")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, labels).collect()}
    assert got == {1: ("", "", None, "allow"), None: ("", "", None, "allow"), 2: ("a.example.com", "", None, "allow"),
                   3: ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
                   4: ("b.example.com", "/en/", "example.com/en/", "block")}


def test_shingle_sets():
    assert len(shingle_set(None, 3)) == 0 and len(shingle_set("a b", 3)) == 1
    assert (shingle_set("A b\tc", 3) == shingle_set("a  B c", 3)).all()
    assert len(shingle_set("a b a b a", 3)) == 2
