"""Transcript parsing: a hidden Markov model over lines recovers who speaks."""

import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import sliced, small_batches, stored

LOWEST = -(2**63)
ROLES = ("system", "user", "assistant")
#: Speaker names as transcripts write them.
NAMES = {
    "system": ("system", "instructions", "system prompt"),
    "user": ("user", "human", "customer", "question", "q", "me"),
    "assistant": ("assistant", "ai", "bot", "agent", "answer", "a"),
}
_MARK = {r: re.compile(r"^\s*[\[<*#(]*\s*(?:%s)\s*[\]>*)]*\s*[:>\]]+\s*" % "|".join(sorted(n, key=len, reverse=True)),
                       re.IGNORECASE) for r, n in NAMES.items()}
LENGTHS = (1, 40, 120, 300)
STATES = 2 * len(ROLES)  # 2 * role: a turn begins, 2 * role + 1: it goes on
SYMBOLS = (len(ROLES) + 1) * (len(LENGTHS) + 1) * 2


def features(line: str) -> tuple[int, int]:
    """(symbol, end of the marker): speaker marker, length class, question mark."""
    mark, end = 0, 0
    for i, r in enumerate(ROLES):
        m = _MARK[r].match(line)
        if m:
            mark, end = i + 1, m.end()
            break
    rest = line[end:].strip()
    size = sum(len(rest) >= x for x in LENGTHS)
    return (mark * (len(LENGTHS) + 1) + size) * 2 + rest.endswith("?"), end


def symbol_of(line: str) -> int:
    return features(line or "")[0]


class Model:
    """Log probabilities; `start` holds what stands before the first line."""

    def __init__(self, start, move, emit):
        self.start, self.move, self.emit = (np.asarray(x, dtype=float) for x in (start, move, emit))

    @classmethod
    def fitted(cls, moves: dict, emits: dict, smooth: float = 0.5) -> "Model":
        """From counts by (state before or -1, state) and (state, symbol)."""
        start, move = np.full(STATES, smooth), np.full((STATES, STATES), smooth)
        emit = np.full((STATES, SYMBOLS), smooth)
        start[1::2] = 0  # a transcript begins with a turn
        for (a, b), n in moves.items():
            if a < 0:
                start[b] += n
            else:
                move[a, b] += n
        for s in range(STATES):  # a turn goes on in its own role
            move[s, [t for t in range(1, STATES, 2) if t // 2 != s // 2]] = 0
        for (s, o), n in emits.items():
            emit[s, o] += n
        with np.errstate(divide="ignore"):
            return cls(np.log(start / start.sum()), np.log(move / move.sum(1, keepdims=True)),
                       np.log(emit / emit.sum(1, keepdims=True)))

    def step(self, symbols: list[int], enter: np.ndarray) -> tuple[np.ndarray, list]:
        """Best scores over the lines, from scores before the first (rows: one per entry)."""
        score, back = enter, []
        for k, o in enumerate(symbols):
            through = score[:, :, None] + self.move
            best = through.argmax(1)
            score = np.take_along_axis(through, best[:, None, :], 1)[:, 0, :] + self.emit[:, o]
            back.append(best)
        return score, back

    def transfer(self, symbols: list[int], first: bool) -> np.ndarray:
        """Best score from each state before the lines (one row if they begin a transcript) to
        each state of the last one."""
        if first:
            return self.step(symbols[1:], (self.start + self.emit[:, symbols[0]])[None, :])[0]
        enter = np.full((STATES, STATES), -np.inf)
        np.fill_diagonal(enter, 0)
        return self.step(symbols, enter)[0]

    def path(self, symbols: list[int], before: int, last: int) -> list[int]:
        """The best states with `before` (-1: none) before the first line and `last` at the end."""
        if before < 0:
            _, back = self.step(symbols[1:], (self.start + self.emit[:, symbols[0]])[None, :])
        else:
            enter = np.full((1, STATES), -np.inf)
            enter[0, before] = 0
            _, back = self.step(symbols, enter)
        out = [last]
        for best in reversed(back):
            out.append(int(best[0, out[-1]]))
        out.reverse()
        return out if before < 0 else out[1:]


def segment_ends(parts: list[np.ndarray]) -> list[int]:
    """The states at the ends of consecutive segments on the best way through all of them."""
    score, back = parts[0][0], []
    for m in parts[1:]:
        through = score[:, None] + m
        back.append(through.argmax(0))
        score = through.max(0)
    out = [int(score.argmax())]
    for best in reversed(back):
        out.append(int(best[out[-1]]))
    return out[::-1]


def fit(lines: DataFrame) -> Model:
    """From labelled lines (conv_id, line_no, turn, idx, role, text): counts over all of them.

    The line before a turn's first is the last one of the turn before it, found by joining turns.
    At most 6 * 6 and 6 * SYMBOLS counts reach the driver.
    """
    role = reduce(lambda c, i: F.when(F.col("role") == ROLES[i], i).otherwise(c), range(len(ROLES)), F.lit(None))
    symbol = F.udf(symbol_of, "int", useArrow=True)
    rows = lines.withColumn("r", role).where("r is not null").withColumn(
        "state", 2 * F.col("r") + (F.col("idx") > 0).cast("int"))
    emits = {(r.state, r.o): r["count"] for r in
             rows.groupBy("state", symbol("text").alias("o")).count().collect()}
    turns = rows.groupBy("conv_id", "turn").agg(F.max("r").alias("r"), F.count("*").alias("n"))
    before = turns.select("conv_id", (F.col("turn") + 1).alias("turn"),
                          (2 * F.col("r") + (F.col("n") > 1).cast("int")).alias("a"))
    moves: dict = {}
    for r in turns.join(before, ["conv_id", "turn"], "left").groupBy(
            F.coalesce("a", F.lit(-1)).alias("a"), "r").count().collect():
        moves[r.a, 2 * r.r] = r["count"]
    for r in turns.groupBy("r").agg(F.sum((F.col("n") > 1).cast("int")).alias("one"),
                                    F.sum(F.greatest(F.col("n") - 2, F.lit(0))).alias("more")).collect():
        moves[2 * r.r, 2 * r.r + 1] = r.one
        moves[2 * r.r + 1, 2 * r.r + 1] = r.more
    return Model.fitted(moves, emits)


KEY = ["conv_id", "line_no", "text"]


def _counted(batches):
    """Equal lines of a batch as one row with their number."""
    for b in batches:
        t = pa.Table.from_batches([b]).group_by(KEY).aggregate([([], "count_all")])
        for out in t.select([*KEY, "count_all"]).rename_columns([*KEY, "n"]).to_batches():
            yield out


#: A segment begins its transcript, goes on with it, or may do either, as the first one of a task.
BEGINS, GOES_ON, EITHER = range(3)


def _segments(size: int, at_once: int = 4096):
    """Cuts sorted lines with their numbers into runs of at most `size` lines of one transcript."""
    def run(batches):
        seg, conv, place = TaskContext.get().partitionId() << 32, None, EITHER
        numbers, texts, cuts, rows = [], [], [0], []

        def close():
            nonlocal seg, place
            if len(texts) > cuts[-1]:
                cuts.append(len(texts))
                rows.append((conv, seg, place))
                seg, place = seg + 1, GOES_ON

        def batch_of():
            out = pa.StructArray.from_arrays(
                [pa.array(numbers, pa.int64()), pa.array(texts, pa.string())], ["line_no", "text"])
            whole = [*(pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32()))),
                     pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), out)]
            return pa.RecordBatch.from_arrays(whole, ["conv_id", "seg", "place", "lines"])

        for batch in sliced(batches):
            for c, i, t, n in zip(*(batch.column(k).to_pylist() for k in (*KEY, "n"))):
                if conv is not None and c != conv:
                    close()
                    place = BEGINS
                    if len(texts) >= at_once:
                        yield batch_of()
                        numbers, texts, cuts, rows = [], [], [0], []
                conv = c
                while n:
                    k = min(n, size - len(texts) + cuts[-1])
                    numbers += [i] * k
                    texts += [t] * k
                    n -= k
                    if len(texts) - cuts[-1] == size:
                        close()
                        if len(texts) >= at_once:
                            yield batch_of()
                            numbers, texts, cuts, rows = [], [], [0], []
        close()
        if rows:
            yield batch_of()
    return run


def parse_transcripts(lines: DataFrame, model: Model, segment: int = 512) -> DataFrame:
    """Turns from raw lines (conv_id, line_no, text): (conv_id, first_line, n_lines, role, begins,
    ends, rendered).

    The lines are sorted over all tasks and cut into segments of at most `segment` lines of one
    transcript, whatever their numbers are; equal lines travel with their count, so a hot line is cut too.
    For each segment, the best score between every pair of entry and exit states is computed; along a
    transcript these small tables, 36 numbers a segment, come together and give the states at the segment ends,
    and the segments are then decoded by themselves: the same path as Viterbi over all lines, with no
    transcript's lines in one task. A turn over a segment end comes in pieces, of which one begins and
    one ends it. Rendered: `<|role|>`, the lines without markers, `<|end|>`. Null lines are empty,
    lines with equal numbers come in order of their text; lines with a null number come first in their
    transcript, in order of their text, and `first_line` is null for pieces that begin with one; a
    null conv_id is a transcript of its own.
    """
    small_batches(lines.sparkSession)
    conv = F.coalesce(F.col("conv_id").cast("long"), F.lit(LOWEST)).alias("conv_id")
    rows = lines.select(conv, F.col("line_no").cast("long").alias("line_no"), F.coalesce("text", F.lit("")).alias("text"))
    counted = rows.mapInArrow(_counted, "conv_id long, line_no long, text string, n long")
    parts = stored(counted.repartitionByRange(*KEY).sortWithinPartitions(*KEY).mapInArrow(
        _segments(segment), "conv_id long, seg long, place int, lines array<struct<line_no: long, text: string>>"),
        "transcripts")

    def transfers(batches):
        for b in sliced(batches, 20):
            out = []
            for ls, place in zip(b.column("lines").to_pylist(), b.column("place").to_pylist()):
                symbols = [symbol_of(x["text"]) for x in ls]
                firsts = {BEGINS: (True,), GOES_ON: (False,), EITHER: (True, False)}[place]
                out.append(np.concatenate([model.transfer(symbols, f) for f in firsts]).ravel())
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("seg"), pa.array(out, pa.list_(pa.float64()))], ["conv_id", "seg", "m"])

    def ends(batches):
        for b in batches:
            rows = []
            for conv, tables in zip(b.column("conv_id").to_pylist(), b.column("tables").to_pylist()):
                ms = [np.array(t["m"]).reshape(-1, STATES) for t in tables]
                found = segment_ends([ms[0][:1], *(m[-STATES:] for m in ms[1:])])
                after = [t["seg"] for t in tables[1:]] + [None]
                rows += [(conv, t["seg"], a, z, n) for t, a, z, n in zip(tables, [-1, *found], found, after)]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else
                                             [pa.array([], k) for k in kinds], ["conv_id", "seg", "before", "last", "next"])

    tables = parts.select("conv_id", "seg", "place", "lines").mapInArrow(
        transfers, "conv_id long, seg long, m array<double>")
    found = stored(tables.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("seg", "m"))).alias("tables"))
                   .mapInArrow(ends, "conv_id long, seg long, before int, last int, next long"), "ends")
    def pieces(batches):
        for b in sliced(batches, 20):
            rows = []
            for conv, seg, ls, before, last in zip(*(b.column(c).to_pylist() for c in ("conv_id", "seg", "lines", "before", "last"))):
                texts = [x["text"] for x in ls]
                marks = [features(t) for t in texts]
                path = model.path([m[0] for m in marks], before, last)
                cuts = [i for i, s in enumerate(path) if i == 0 or s % 2 == 0] + [len(path)]
                for a, z in zip(cuts, cuts[1:]):
                    begins = path[a] % 2 == 0
                    body = "\n".join(texts[i][marks[i][1] if i == a and begins else 0:] for i in range(a, z))
                    role = ROLES[path[a] // 2]
                    rows.append((conv, seg, ls[a]["line_no"], z - a, role, begins, (f"<|{role}|>\n" if begins else "") + body,
                                 z == len(path)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds],
                ["conv_id", "seg", "first_line", "n_lines", "role", "begins", "rendered", "at_end"])

    out = parts.join(found, ["conv_id", "seg"]).select("conv_id", "seg", "lines", "before", "last").mapInArrow(
        pieces, "conv_id long, seg long, first_line long, n_lines long, role string, begins boolean, rendered string, at_end boolean")
    # a piece at a segment's end goes on if the first piece of the next segment does not begin
    opened = out.where(~F.col("begins")).select("conv_id", F.col("seg").alias("next"))
    goes = (found.where("next is not null").join(opened, ["conv_id", "next"], "left_semi")
            .select("conv_id", "seg", F.lit(True).alias("at_end"), F.lit(True).alias("goes")))
    out = out.join(goes, ["conv_id", "seg", "at_end"], "left")
    ends_here = F.col("goes").isNull()
    return out.select(F.nullif("conv_id", F.lit(LOWEST)).alias("conv_id"), "first_line", "n_lines", "role", "begins", ends_here.alias("ends"),
                      F.concat("rendered", F.when(ends_here, "\n<|end|>").otherwise("")).alias("rendered"))
