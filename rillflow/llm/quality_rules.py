"""Line-first cleaning: rules per line remove lines, then documents that lose too much go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import SPACE, words_of

#: Phrases of page furniture, matched in lower case.
BOILERPLATE = (
    r"(javascript|cookie|lorem ipsum|privacy policy|terms of (use|service)|all rights reserved|"
    r"click here|sign up|log in|subscribe|licensed under|copyright \(c\))"
)
SYMBOLS = r"[#*$%&|<>]"
LINE_SYMBOLS = r"[#*$%&|<>{}\[\]~^=_\\]"
NAVIGATION = r"(\||»|›| > |•|·)"


def _count(c: Column, pattern: str) -> Column:
    """Characters of a one-character pattern."""
    return F.length(c) - F.length(F.regexp_replace(c, pattern, ""))


def _line_fails(line: Column, n: Column) -> Column:
    """The rules for one line of `n` words. Lines without a word never fail.

    Punctuation: marks and symbols where words should be, or over 20 words without a single
    sentence mark. Navigation: as many separators as a quarter of the words. Shouting: two or more
    exclamation marks after a third of the words. Boilerplate: a phrase of
    page furniture in a line of at most 20 words.
    """
    marks = _count(line, LINE_SYMBOLS)
    return (n > 0) & (
        (marks * 2 >= n)
        | ((n > 20) & ~line.rlike(r"[.!?。！？।؟…:;]"))
        | ((_count(line, NAVIGATION) * 4 >= n) & (n >= 4))
        | ((F.size(F.split(line, r"[!?]{2,}")) - 1) * 3 >= n)
        | ((n <= 20) & F.lower(line).rlike(BOILERPLATE))
    )


def _repeat_words(w: Column, s: Column) -> Column:
    """Words inside 3-word windows that occur twice or more; `s`: the sorted windows."""
    m = F.greatest(F.size(w) - 3, F.lit(0))
    pairs = F.zip_with(
        F.slice(s, 1, m), F.slice(s, 2, m),
        lambda x, y: F.when((x.a == y.a) & (x.b == y.b) & (x.c == y.c), F.array(x.i, y.i)))
    return F.flatten(F.filter(pairs, lambda p: p.isNotNull()))


def clean_lines(docs: DataFrame, text: str = "text", min_words: int = 50,
                repeat_share: float = 0.5, lost_share: float = 0.3) -> DataFrame:
    """Adds the counts and the verdict as columns; `clean_text` holds the lines that pass.

    Columns added (an input column of the same name is replaced): n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, n_lines_removed, n_words_removed, kept, clean_text.
    `kept` is false for fewer than `min_words` words, for repeated words above `repeat_share`, and
    for documents whose failing lines hold more than `lost_share` of the words. Null texts count as
    empty: no words, not kept, clean_text empty. Each row is judged alone, so repeated rows, ties
    and null ids need no rule; the work per row is sorting its own words.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    step = docs.withColumns({"__t": t, "__w": words_of(t)})
    w, n = F.col("__w"), F.size("__w")
    m = F.greatest(n - 2, F.lit(0))
    windows = F.sort_array(F.arrays_zip(
        F.slice(w, 1, m).alias("a"), F.slice(w, 2, m).alias("b"), F.slice(w, 3, m).alias("c"),
        F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))).alias("i")))
    lines = F.transform(F.split(F.col("__t"), "\n"),
                        lambda x: F.struct(x.alias("x"), F.size(words_of(x)).alias("n")))
    step = step.withColumns({"__s": F.when(n >= 4, windows), "__l": lines})
    judged = F.transform(F.col("__l"), lambda x: F.struct(
        x.x.alias("x"), x.n.alias("n"), _line_fails(x.x, x.n).alias("bad")))
    step = step.withColumns({"__p": _repeat_words(w, F.col("__s")), "__j": judged})
    p, j = F.col("__p"), F.col("__j")
    real = F.transform(F.filter(j, lambda x: x.n > 0), lambda x: x.x)
    bad = F.filter(j, lambda x: x.bad)
    covered = F.array_distinct(F.concat(p, F.transform(p, lambda i: i + 1), F.transform(p, lambda i: i + 2)))
    step = step.withColumns({
        "n_words": n.cast("long"),
        "word_chars": F.length(F.regexp_replace("__t", SPACE, "")).cast("long"),
        "n_symbols": _count(F.col("__t"), SYMBOLS).cast("long"),
        "n_dup_lines": (F.size(real) - F.size(F.array_distinct(real))).cast("long"),
        "n_repeat_words": F.when(n >= 4, F.size(covered)).otherwise(0).cast("long"),
        "n_lines_removed": F.size(bad).cast("long"),
        "n_words_removed": F.aggregate(bad, F.lit(0), lambda a, x: a + x.n).cast("long"),
        "clean_text": F.array_join(F.transform(F.filter(j, lambda x: ~x.bad), lambda x: x.x), "\n"),
    })
    failed = ((F.col("n_words") < min_words)
              | (F.col("n_repeat_words") > repeat_share * F.col("n_words")))
    return step.withColumn("base_failed", failed).withColumn(
        "kept", ~failed & (F.col("n_words_removed") <= lost_share * F.col("n_words"))
    ).drop("__t", "__w", "__s", "__l", "__p", "__j")
