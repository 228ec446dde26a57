"""Repair of conversations against all edits of short ones and plain strings of long ones."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from conftest import SF
from rillflow.llm import audit_trail as T
from rillflow.llm.conversation_audit import audit_rows, damaged
from rillflow.llm.queries import QUERIES

ROW = "conv_id long, turn long, role string, text string"


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        w = re.sub(r"[\x20\x09-\x0D]+", "", text)
        out.append("blank" if not w else "duplicate" if (role, text) in seen else "truncated" if w[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def all_edits(rows):
    """The best of every way to edit a few rows, with at most two insertions before each and at the end."""
    faults, best = faults_of(rows), None
    inserted = [[]] + [[("I", 3, r, "")] for r in ("user", "assistant")] + [
        [("I", 3, a, ""), ("I", 3, b, "")] for a in ("user", "assistant") for b in ("user", "assistant")]
    choices = []
    for (role, text), fault in zip(rows, faults):
        one = [("D", 4, None, None)]
        if fault in ("", "truncated"):
            more = 3 if fault else 0
            one += [("K", more, role, text), ("R", 3 + more, "user", text), ("R", 3 + more, "assistant", text)]
        choices += [inserted, [[c] for c in one]]
    for way in itertools.product(*choices, inserted):
        flat = [e for part in way for e in part]
        if re.fullmatch("(s?(ua)+)?", "".join((e[2][:1] or "?") for e in flat if e[0] != "D")):
            key = (sum(e[1] for e in flat), "".join(e[0] for e in flat))
            if best is None or key < best[0]:
                best = key, "\n".join(f"{e[2]}:{e[3]}" for e in flat if e[0] != "D")
    return *best[0], hashlib.sha256(best[1].encode()).hexdigest()


def plain_edits(rows):
    """Row by row with whole strings: (cost, letters, texts) for each last initial."""
    now = {"": (0, "", ())}

    def put(new, k, v):
        if k not in new or v < new[k]:
            new[k] = v

    def opened(now):
        for _ in range(2):
            for k, (c, a, t) in list(now.items()):
                r = "assistant" if k == "u" else "user"
                put(now, r[0], (c + 3, a + "I", t + (r + ":",)))
        return now

    for (role, text), fault in zip(rows, faults_of(rows)):
        new = {}
        for k, (c, a, t) in opened(now).items():
            put(new, k, (c + 4, a + "D", t))
            if fault in ("", "truncated"):
                c += 3 if fault else 0
                r = "assistant" if k == "u" else "user"
                put(new, r[0], (c + 3, a + "R", t + (r + ":" + text,)))
                if role[:1] == r[0] or role[:1] == "s" and k == "":
                    put(new, role[:1], (c, a + "K", t + (role + ":" + text,)))
        now = new
    c, a, t = min(v for k, v in opened(now).items() if k in ("", "a"))
    return c, a, hashlib.sha256("\n".join(t).encode()).hexdigest()


def plain_audits(rows, damage=True):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        by[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for conv, rs in by.items():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = {t for t, *_ in rs if t is not None}
        pairs = [r[1:] for r in rs]
        fs = faults_of(pairs)
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        cost, audit, sha = plain_edits(pairs)
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[fs.count(k) for k in ("blank", "duplicate", "truncated")],
                    illegal, cost, audit, sha))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def rows_of(df):
    return order(map(tuple, df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                                      "repaired_sha256").collect()))


ROLES = ["user", "assistant", "system", "tool", "", "user", "assistant"]
TEXTS = ["Yes.", "No?", "cut", " \n", "", "ok!", "Fine. "]


@pytest.mark.parametrize("seed", range(4))
def test_plain_strings_equal_all_edits(seed):
    rnd = random.Random(seed)
    for _ in range(12):
        rows = [(rnd.choice(ROLES), rnd.choice(TEXTS)) for _ in range(rnd.randint(0, 3))]
        assert plain_edits(rows) == all_edits(rows), rows


@pytest.mark.parametrize("seed", range(5))
def test_trees_of_tables_equal_plain_strings(seed):
    """Any way to cut a conversation gives the same letters."""
    rnd = random.Random(seed)
    for _ in range(40):
        pairs = [(rnd.choice(["user", "assistant", "assistant", "system", "tool"]), rnd.choice(["cut", "", "end.", str(rnd.random()) + "."]))
                 for _ in range(rnd.randint(1, 60))]
        kinds = {"blank": T.GO, "duplicate": T.GO, "truncated": T.TRUNCATED, "": T.FINE}
        codes = bytes(T.code_of("suat".index(r[0]), kinds[f]) for (r, _), f in zip(pairs, faults_of(pairs)))
        size = rnd.choice([1, 2, 3, 7, 100])
        parts = [codes[i:i + size] for i in range(0, len(codes), size)]
        tables = [T.stretch_table(p, tuple(range(4))) for p in parts]
        cost, end = T.finished(T.combined(tables))
        letters = "".join(e[0] for p, (a, b) in zip(parts, T.path(tables, T.START, end)) for e in T.stretch_edits(p, a, b))
        assert (cost, letters + T.TAIL[end][1]) == plain_edits(pairs)[:2]


def test_equal_hashes_are_verified():
    root = T.Node(T.START)
    a, b = T.Node(T.USER, 1, root), T.Node(T.USER, 2, root)
    x, y = T.Node(T.USER, 3, a), T.Node(T.USER, 0, b)
    b.hash = a.hash
    assert T.compare(x, y) < 0 < T.compare(y, x)
    y.hash = x.hash
    assert T.compare(x, y) < 0 < T.compare(y, x)
    assert T.compare(T.Node(T.USER, 3, a), x) == 0


def odd_rows():
    rnd = random.Random(8)
    rows = [(1, None, None, None), (1, None, None, None), (2, 5, "user", "Hi."), (3, 0, "", ""), (None, 1, "system", "One."),
            (4, 0, "assistant", "A."), (4, 0, "user", "A."), (5, -3, "user", "é 🎉!"), (5, 2**40, "assistant", "x " * 50_000 + ".")]
    rows += [(None, rnd.randint(0, 30), rnd.choice(ROLES), rnd.choice(TEXTS) + str(rnd.randint(0, 9)) + rnd.choice(["", "."])) for _ in range(700)]
    rows += [(9, 7, "user", "same.")] * 900
    rows += [(c, t, rnd.choice(["user", "assistant", None]), f"{c} {t}.") for c in range(20, 60) for t in range(rnd.randint(1, 6))]
    return rows


@pytest.mark.parametrize("damage", [False, True])
def test_odd_conversations_in_small_segments(spark, damage):
    rows = odd_rows()
    df = spark.createDataFrame(rows, ROW).selectExpr("*", "0 idx", "'x' key", "1 pos", "'y' audit").repartition(5)
    got = rows_of(audit_rows(df, damaged(df) if damage else df, segment=2))
    want = plain_audits(rows, damage)
    want += [(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in {r[0] for r in rows} - {w[0] for w in want}]
    assert got == order(want)


def test_no_conversations(spark):
    none = spark.createDataFrame([], ROW)
    assert audit_rows(none, damaged(none)).collect() == []


def test_query_equals_plain_strings(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = plain_audits(rows)
    want += [(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in {r[0] for r in rows} - {w[0] for w in want}]
    assert rows_of(QUERIES["op12_audit_repair"](spark, SF)) == order(want)
