"""Repair of conversations: faults of turns, the cheapest edits to a legal order of roles, the result.

Turns are sorted over all tasks and cut into segments of a bounded number of turns of one conversation, so
no conversation is in one task. Each segment becomes a small table (`audit_trail`); where a conversation
has several, 256 neighbours at a time are combined, in rounds, until one table is left. The best way
through it then goes back down, round by round, to the letters of each segment.
"""

from __future__ import annotations

import hashlib

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.audit_trail import (
    FINE, GO, INSERT, LETTERS, OTHER, STATES, TAIL, TRUNCATED, USER, Table, combined, finished, path,
    stretch_edits, stretch_table)
from rillflow.llm.common import sliced, small_batches, stored

_WORD = r"[^\x20\x09-\x0D]"
FAN = 8  # bits of how many tables are combined at a time
_PARTS = 20  # bits of a segment's number inside its conversation and task
_ROLE = {1: "system", 2: "user", 3: "assistant"}


def damaged(conversations: DataFrame) -> DataFrame:
    """The test damage of the contract on (conv_id, turn, role, text): by crc32 of `conv_id:turn` modulo 20 a row is
    dropped (0), emptied (1), without `.!?` (2), twice (3) or the user's (4). Nulls count as one
    space; conv_id and turn stay null."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(key) % 20
    text = F.coalesce("text", blank)
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(True), times)).alias("copy")).drop("copy")


def turns_of(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns (key, pos, role, text) and their faults (key, pos, turn, blank, duplicate, truncated, code), both
    stored. `pos` is their order over all tasks, `key` the conversation's id as text, empty for null.

    Order: turn (nulls first), role, text. Equal rows are dealt to the tasks by their place in the input.
    """
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key")
    by = ["key", "turn", "role", "text", "at"]
    flat = rows.select(key, F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"), F.monotonically_increasing_id().alias("at"))
    ordered = flat.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("pos", F.monotonically_increasing_id())
    initial = F.substring("role", 1, 1)
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    blank = ~F.col("text").rlike(_WORD)
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    ordered = stored(ordered.select("key", "pos", "turn", "role", "text", number.alias("number"), blank.alias("blank"),
                                    cut.alias("cut"), F.sha2("text", 256).alias("digest")), "turns")
    first = ordered.where("not blank").groupBy("key", "role", "digest").agg(F.min("pos").alias("pos"))
    seen = ordered.select("key", "pos", "turn", "number", "blank", "cut").join(
        first.select("pos", F.lit(True).alias("first")), "pos", "left")
    again = ~F.col("blank") & F.col("first").isNull()
    fault = F.when(F.col("blank") | again, GO).when(F.col("cut"), TRUNCATED).otherwise(FINE)
    marked = seen.select("key", "pos", "turn", "blank", again.alias("duplicate"),
                         (fault == TRUNCATED).alias("truncated"), (F.col("number") * 3 + fault).cast("int").alias("code"))
    return ordered.select("key", "pos", "role", "text"), stored(marked, "faults")


_SEGMENT = pa.schema([("key", pa.string()), ("idx", pa.int64()), ("codes", pa.binary()), ("at", pa.list_(pa.int64())),
                      ("cost", pa.list_(pa.int64())), ("rank", pa.list_(pa.int32())), ("first", pa.int32()),
                      ("last", pa.int32()), ("illegal", pa.int64())])
_SEGMENTS = ("key string, idx long, codes binary, at array<long>, cost array<long>, rank array<int>, "
             "first int, last int, illegal long")
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def _illegal(a: int, b: int) -> bool:
    return OTHER in (a, b) or (LETTERS[a], LETTERS[b]) not in _LEGAL


def _segments(size: int):
    """Sorted turns of a task to segments of at most `size` turns."""
    def run(batches):
        part, seq = TaskContext.get().partitionId() << _PARTS, 0
        now, codes, at, new, out = None, bytearray(), [], False, []

        def closed():
            nonlocal seq
            # behind another conversation a segment begins its own one; else any state may come before
            t = stretch_table(bytes(codes), (0,) if new else tuple(range(STATES)))
            roles = [c // 3 for c in codes]
            out.append((now, part + seq, bytes(codes), list(at), t.cost, t.rank, roles[0], roles[-1],
                        sum(map(_illegal, roles, roles[1:]))))
            seq += 1
            codes.clear()
            at.clear()

        for batch in sliced(batches, 4096):
            for key, pos, code in zip(*(batch.column(c).to_pylist() for c in ("key", "pos", "code"))):
                if codes and (key != now or len(codes) == size):
                    closed()
                if key != now:
                    new, now, seq = now is not None, key, 0
                elif not codes:
                    new = False
                codes.append(code)
                at.append(pos)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _SEGMENT)], schema=_SEGMENT)
                out = []
        if codes:
            closed()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _SEGMENT)], schema=_SEGMENT)
    return run


UNIT = "key string, idx long, cost array<long>, rank array<int>, first int, last int, illegal long"


def _tables(pdf: pd.DataFrame) -> list[Table]:
    return [Table(tuple(map(int, c)), tuple(map(int, r))) for c, r in zip(pdf["cost"], pdf["rank"])]


def _up(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("idx")
    t = combined(_tables(pdf))
    first, last = pdf["first"].tolist(), pdf["last"].tolist()
    between = sum(map(_illegal, last, first[1:]))
    return pd.DataFrame([(pdf["key"].iloc[0], int(pdf["above"].iloc[0]), list(t.cost), list(t.rank), first[0], last[-1],
                          int(pdf["illegal"].sum()) + between)], columns=[c.split()[0] for c in UNIT.split(", ")])


def _down(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("idx")
    steps = path(_tables(pdf), int(pdf["enter"].iloc[0]), int(pdf["leave"].iloc[0]))
    return pd.DataFrame({"key": pdf["key"], "idx": pdf["idx"], "enter": [a for a, _ in steps], "leave": [b for _, b in steps]})


def _ends(batches):
    for batch in batches:
        rows = [finished(Table(tuple(c), tuple(r))) for c, r in zip(batch.column("cost").to_pylist(), batch.column("rank").to_pylist())]
        n = len(rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("idx"), pa.array([0] * n, pa.int32()), pa.array([e for _, e in rows], pa.int32()),
             pa.array([c for c, _ in rows], pa.int64()), batch.column("illegal")],
            ["key", "idx", "enter", "leave", "total", "illegal"])


_EDIT = pa.schema([("key", pa.string()), ("idx", pa.int64()), ("no", pa.int64()), ("letter", pa.string()), ("state", pa.int32()),
                   ("pos", pa.int64())])
_EDITS = "key string, idx long, no long, letter string, state int, pos long"


def _edits(batches):
    for batch in sliced(batches, 20):
        out = []
        columns = ("key", "idx", "codes", "at", "enter", "leave", "tail")
        for key, idx, codes, at, enter, leave, tail in zip(*(batch.column(c).to_pylist() for c in columns)):
            edits = stretch_edits(codes, enter, leave)
            out += [(key, idx, n, letter, state, None if i is None else at[i]) for n, (letter, i, state) in enumerate(edits)]
            state = leave
            for n in range(len(TAIL[leave][1]) if tail else 0):
                state = USER if state != USER else USER + 1
                out.append((key, idx, len(edits) + n, INSERT, state, None))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _EDIT)], schema=_EDIT)


def repair(rows: DataFrame, segment: int = 4096) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, turn, role, text) to their audits and their edits.

    Audits, one row per conversation (`key`: its id as text, empty for null): gaps, blank, duplicate, truncated,
    illegal, cost. Edits, in order of (key, idx, no): letter, role and text (both null for deleted rows).

    A row's fault is the first of: blank; role and text as in an earlier row; truncated, not ending in
    `.!?`. Keep costs 0, rerole to user or assistant 3, delete 4 (blank and duplicate rows must go), an inserted
    empty turn 3, a truncated row that stays 3. The edits are the cheapest that leave an optional system turn and
    pairs of user and assistant, or nothing; among those the ASCII-least letters. Rows with a null turn come
    first; rows of one turn are in order of role and text, so repeated rows follow each other. A null
    role or text is one space; roles count by their first letter, and other ones than s, u, a can only be
    changed or deleted. A null conv_id is a conversation of its own; an empty table gives no rows;
    extra columns are not looked at. A segment's rows have at most `segment` turns, whatever their texts.
    """
    small_batches(rows.sparkSession)
    turns, faults = turns_of(rows)
    segments = stored(faults.select("key", "pos", "code").repartitionByRange("pos").sortWithinPartitions("pos")
                      .mapInArrow(_segments(segment), _SEGMENTS), "segments")
    names = [c.split()[0] for c in UNIT.split(", ")]
    units, levels, tops = segments.select(*names), [], []
    while True:
        many = units.groupBy("key").agg(F.count("*").alias("many"))
        alone = units.join(many.where("many = 1").select("key"), "key", "left_semi")
        rest = units.join(many.where("many > 1"), "key").withColumn(
            "above", F.when(F.col("many") <= 2**FAN, F.lit(0)).otherwise(F.shiftright("idx", FAN))).drop("many")
        tops.append(stored(alone.select("key", "idx", "cost", "rank", "illegal").mapInArrow(
            _ends, "key string, idx long, enter int, leave int, total long, illegal long"), "tops"))
        if not rest.limit(1).count():
            break
        levels.append(rest)
        units = stored(rest.groupBy("key", "above").applyInPandas(_up, UNIT), "units")
    way = tops[-1].select("key", "idx", "enter", "leave")
    for rest, top in zip(reversed(levels), reversed(tops[:-1])):
        above = way.withColumnRenamed("idx", "above")
        below = rest.join(above, ["key", "above"]).groupBy("key", "above").applyInPandas(_down, "key string, idx long, enter int, leave int")
        way = stored(below, "way").unionByName(top.select("key", "idx", "enter", "leave"))
    ends = tops[0]
    for t in tops[1:]:
        ends = ends.unionByName(t)
    last = segments.groupBy("key").agg(F.max("idx").alias("end"))
    edits = (segments.select("key", "idx", "codes", "at").join(way, ["key", "idx"]).join(last, "key")
             .withColumn("tail", F.col("idx") == F.col("end")).drop("end").mapInArrow(_edits, _EDITS))
    names_of = F.create_map(*[F.lit(x) for kv in _ROLE.items() for x in kv])
    letter = F.col("letter")
    edits = edits.join(turns.select("pos", "role", "text"), "pos", "left").select(
        "key", "idx", "no", "letter", F.when(letter == "K", F.col("role")).when(letter != "D", names_of[F.col("state")]).alias("role"),
        F.when(letter == "I", F.lit("")).when(letter != "D", F.col("text")).alias("text"))
    distinct = faults.groupBy("key", "turn").agg(F.count("*")).groupBy("key").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    count = [F.sum(F.col(c).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated")]
    audits = (distinct.join(faults.groupBy("key").agg(*count), "key")
              .join(ends.select("key", "illegal", F.col("total").alias("cost")), "key"))
    return audits, edits


def _digest(batches):
    """Letters and SHA-256 of the repaired turns of each conversation, from sorted edits; one line
    of text at a time is held, and the letters."""
    now, letters, sha, any_yet, out = None, [], None, False, []

    def row():
        return now, "".join(letters), sha.hexdigest()

    for batch in sliced(batches):
        for key, letter, role, text in zip(*(batch.column(c).to_pylist() for c in ("key", "letter", "role", "text"))):
            if key != now:
                if now is not None:
                    out.append(row())
                now, letters, sha, any_yet = key, [], hashlib.sha256(), False
            letters.append(letter)
            if letter != "D":
                sha.update((("\n" if any_yet else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
                any_yet = True
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], ["key", "audit", "repaired_sha256"])
            out = []
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(row())], ["key", "audit", "repaired_sha256"])


def audit_rows(conversations: DataFrame, rows: DataFrame, segment: int = 4096) -> DataFrame:
    """One row per conversation of `conversations`, also those without `rows` left (zeros, no edits). A row has all
    letters and one hash of all texts of its conversation, so the edits of a conversation stream
    through one task here, a batch at a time; the repair itself does not depend on that."""
    audits, edits = repair(rows, segment)
    by = ["key", "idx", "no"]
    texts = edits.repartition("key").sortWithinPartitions(*by).select("key", "letter", "role", "text").mapInArrow(
        _digest, "key string, audit string, repaired_sha256 string")
    ids = conversations.select("conv_id").distinct().withColumn("key", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    out = ids.join(audits, "key", "left").join(texts, "key", "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select("conv_id", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in numbers],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
