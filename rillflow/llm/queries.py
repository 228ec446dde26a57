"""The registered queries of the text operators, one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm.chat_format import fit, parse_transcripts
from rillflow.llm.common import table
from rillflow.llm.conversation_audit import audit_rows, damaged
from rillflow.llm.jaccard_join import jaccard_components
from rillflow.llm.katz import score
from rillflow.llm.line_dedup import dedup_lines
from rillflow.llm.mixing import mix
from rillflow.llm.order_minhash import fingerprints
from rillflow.llm.packing import pack
from rillflow.llm.periodic_runs import digests, find_runs
from rillflow.llm.pii import find
from rillflow.llm.quality_rules import clean_lines
from rillflow.llm.toxicity import score_toxicity
from rillflow.llm.url_filter import judge_urls


def op1_katz_backoff(spark: SparkSession, folder: str) -> DataFrame:
    return score(table(spark, folder, "documents"), order=3)


def op2_skip_chain_pii(spark: SparkSession, folder: str) -> DataFrame:
    return find(table(spark, folder, "documents"))


def op3_set_relation_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(table(spark, folder, "documents"), size=3, percent=90)


def op4_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints(table(spark, folder, "documents"))


def op5_winnowed_lines(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_lines(table(spark, folder, "documents")).select(
        "doc_id", "n_lines", "n_removed",
        F.concat_ws(",", F.col("removed").cast("array<string>")).alias("removed"), "text")


def op6_fair_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op7_sum_of_squares_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"))


def op8_line_first_cleaning(spark: SparkSession, folder: str) -> DataFrame:
    return clean_lines(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_lines_removed", "n_words_removed")


#: Lines of a turn are numbered from turn * LINES on; no array of lines is as long.
LINES = 2**31
#: Marker styles of the raw transcripts: by name, in brackets, by another name, none.
STYLES = (("System: ", "User: ", "Assistant: "), ("[system] ", "[user] ", "[assistant] "),
          ("Instructions: ", "Human: ", "AI: "), ("", "", ""))


def transcript_lines(conversations: DataFrame) -> DataFrame:
    """Raw transcripts: the lines of all turns, the first of a turn with a speaker marker in one of
    `STYLES`, by the hash of the turn; a quarter has none."""
    style = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(len(STYLES))).cast("int")
    names = F.array(*[F.array(*map(F.lit, s)) for s in STYLES])
    at = F.when(F.col("role") == "system", 0).when(F.col("role") == "user", 1).when(F.col("role") == "assistant", 2)
    mark = F.coalesce(F.get(F.get(names, style), at), F.lit(""))
    rows = conversations.select("conv_id", "turn", "role", mark.alias("mark"),
                                F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("idx", "line"))
    return rows.select("conv_id", "turn", "idx", "role", (F.col("turn").cast("long") * LINES + F.col("idx")).alias("line_no"),
                       F.when(F.col("idx") == 0, F.concat("mark", "line")).otherwise(F.col("line")).alias("text"))


def op9_transcript_roles(spark: SparkSession, folder: str) -> DataFrame:
    """The turns of all conversations, recovered from their raw transcripts."""
    lines = transcript_lines(table(spark, folder, "conversations"))
    return parse_transcripts(lines, fit(lines)).withColumn(
        "turn", F.shiftright("first_line", LINES.bit_length() - 1))


def op10_host_reputation(spark: SparkSession, folder: str) -> DataFrame:
    """The outcome of a page is the label of the document with its number: bad if its quality is
    0 or it is toxic."""
    labels = table(spark, folder, "labels")
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("long")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return judge_urls(table(spark, folder, "pages"), outcomes).select(
        "page_id", "host", "path", "rule", "verdict", "host_labelled", "host_bad",
        F.floor(F.col("host_rate") * 1_000_000).alias("host_rate_ppm"),
        F.floor(F.col("host_worse") * 1000).alias("host_worse_milli"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return digests(find_runs(table(spark, folder, "documents"), test_repeats=True))


def op12_audit_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    return audit_rows(conversations, damaged(conversations))


def op13_toxic_machine(spark: SparkSession, folder: str) -> DataFrame:
    return score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_katz_backoff, op2_skip_chain_pii, op3_set_relation_join, op4_order_minhash,
    op5_winnowed_lines, op6_fair_mix, op7_sum_of_squares_packing, op8_line_first_cleaning,
    op9_transcript_roles, op10_host_reputation, op11_periodic_runs, op12_audit_repair,
    op13_toxic_machine)}
