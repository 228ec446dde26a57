"""Line dedup by winnowing over line hashes."""

import hashlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import discard, sliced, small_batches, stored

LOWEST = -(2**63)


def _windows(min_words: int):
    """Rows for the windows of a document: the fewest lines from a line on, and the fewest lines up to a
    line, with `min_words` words.

    Blank lines are skipped, white space inside a line counts as one space. `mark` is the smallest
    line hash of the window (the last one of equals), selected once per position (`fresh`), and
    `content` the hash of all its lines; `low` and `high` are line numbers in the text.
    """
    def run(batches):
        for batch in sliced(batches):
            ids, hashes = batch.column("__place").to_pylist(), batch.column("__h").to_pylist()
            out = [[] for _ in range(7)]
            for doc, h, text in zip(ids, hashes, batch.column("text").to_pylist()):
                lines = [(i, w) for i, x in enumerate((text or "").encode("utf-8", "surrogatepass").split(b"\n"))
                         if (w := x.split())]
                digest = [hashlib.blake2b(b" ".join(w), digest_size=16).digest() for _, w in lines]
                size = [len(w) for _, w in lines]
                last = -1
                for start, end in _places(size, min_words):
                    at = _lowest(digest, start, end)
                    last, fresh = at, at != last
                    whole = digest[start] if end == start + 1 else hashlib.blake2b(
                        b"".join(digest[start:end]), digest_size=16).digest()
                    for c, v in zip(out, (doc, h, lines[start][0], lines[end - 1][0], digest[last], int(fresh), whole)):
                        c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)],
                                             ["doc", "h", "low", "high", "mark", "fresh", "content"])
    return run


def _places(size: list[int], min_words: int):
    """(start, end) of the windows over lines of `size` words, both never falling. After the fewest
    lines from `start` on come those up to each next line for which the lines after
    `start` are too few."""
    end, total = 0, 0
    for start in range(len(size)):
        while end < len(size) and total < min_words:
            total += size[end]
            end += 1
        if total < min_words:
            break
        yield start, end
        total -= size[start]
        while end < len(size) and total + size[end] < min_words:
            total += size[end]
            end += 1
            yield start, end


def _lowest(digest: list[bytes], start: int, end: int) -> int:
    return min(range(start, end), key=lambda i: (digest[i], -i))


def _strip(text: pd.Series, low: pd.Series, high: pd.Series) -> pd.DataFrame:
    kept, removed = [], []
    for t, lows, highs in zip(text, low, high):
        if lows is None or t is None:
            kept.append(t)
            removed.append([])
            continue
        lines, gone, out, at = t.split("\n"), [], [], 0
        for a, b in sorted(zip(lows, highs)):
            a = max(a, at)
            if a > b:
                continue
            out += lines[at:a]
            gone += range(a, b + 1)
            at = b + 1
        kept.append("\n".join(out + lines[at:]))
        removed.append(gone)
    return pd.DataFrame({"text": kept, "removed": removed})


def repeated_windows(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """(doc, h, low, high): windows of lines that occur before, in an earlier document or place."""
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST))
    rows = docs.select(place.alias("__place"), F.xxhash64("text").alias("__h"), "text")
    w = stored(rows.mapInArrow(
        _windows(min_words),
        "doc long, h long, low int, high int, mark binary, fresh int, content binary").distinct(), "windows")
    marks = w.groupBy("mark").agg(F.sum("fresh").alias("times")).where("times > 1").select("mark")
    hit = w.join(marks, "mark").select("doc", "h", "low", "high", "content")
    at = F.struct("doc", "h", "low")
    firsts = hit.groupBy("content").agg(F.min(at).alias("first"), F.max(at).alias("last")).where("first < last")
    found = stored(hit.join(firsts, "content").where(at > F.col("first")).select("doc", "h", "low", "high"), "repeats")
    discard(w)
    return found


def dedup_lines(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """`docs` with repeated runs of lines of `min_words` words or more cut from `text`; adds
    n_lines, n_removed and removed (line numbers), replacing columns of those names.

    Each document's line hashes are winnowed: of every window the minimum is selected, so two
    documents with a common run of that length select a common hash. Windows whose hash was
    selected once only are done with. The others are compared by content, and where an earlier
    equal one exists (order: doc_id, then place; null ids first) the window goes; adjacent windows
    join, and the first copy stays. A line of a repeated run with `min_words` words from it to the
    run's end begins a window inside the run, and any other line is in the window that ends with the
    run. So the windows that go are, line by line, all runs shared with any earlier copy, extended
    both ways.
    All steps are sums and minima by hash, joined back by hash, so a run that a third of all
    documents share makes one row per copy. Rows with equal id and text are one document and keep
    or lose the same lines; null and short texts stay as they are; a line of 50 words is a run.
    """
    small_batches(docs.sparkSession)
    runs = (repeated_windows(docs, min_words).groupBy("doc", "h")
            .agg(F.collect_list(F.struct("low", "high")).alias("__runs")))
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST))
    keyed = docs.withColumns({"__doc": place, "__h": F.xxhash64("text")})
    runs = runs.select(F.col("doc").alias("__doc"), F.col("h").alias("__h"), "__runs")
    strip = F.pandas_udf(_strip, "text string, removed array<int>")
    out = keyed.join(runs, ["__doc", "__h"], "left").withColumn(
        "__cut", strip("text", F.col("__runs.low"), F.col("__runs.high")))
    return out.withColumns({
        "n_lines": F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long"),
        "n_removed": F.size("__cut.removed").cast("long"), "removed": F.col("__cut.removed"),
        "text": F.col("__cut.text")}).drop("__doc", "__h", "__runs", "__cut")
