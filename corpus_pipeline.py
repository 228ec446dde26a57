"""From raw documents to packed training sequences in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm.common import stored
from rillflow.llm.jaccard_join import jaccard_components
from rillflow.llm.line_dedup import dedup_lines
from rillflow.llm.mixing import mix
from rillflow.llm.packing import pack
from rillflow.llm.quality_rules import clean_lines

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, the others lose their failing lines. Rows are kept by exploding a
    one-row array: a filter would be pushed below the counts and compute them several times."""
    kept = clean_lines(docs).withColumn("row", F.explode(F.when(F.col("kept"), F.array(F.lit(1)))))
    return _documents(kept.withColumn("text", F.col("clean_text")))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs of 50 words and more go; documents left without a word go."""
    cut = dedup_lines(docs)
    return _documents(cut.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of five-word shingle sets similar to 80 % stays: that with the
    smallest id. Rows without an id or with one that others have too are told apart by their
    text: each such text is a document of its own (with a negative number), equal rows are one."""
    named = docs.where("doc_id is not null").groupBy("doc_id").count()
    again = named.where("count > 1").select(F.col("doc_id").alias("again"))
    odd = bool(again.limit(1).count()) or bool(docs.where("doc_id is null").limit(1).count())
    rows = docs.withColumn("node", F.col("doc_id").cast("long"))
    if odd:
        number = -1 - F.pmod(F.xxhash64("doc_id", "text"), F.lit(2**62))
        rows = docs.join(again, docs.doc_id == again.again, "left").withColumn(
            "node", F.when(F.col("doc_id").isNull() | F.col("again").isNotNull(), number).otherwise(F.col("doc_id")))
    groups = jaccard_components(rows.select(F.col("node").alias("doc_id"), "text"), size=5, percent=80)
    first = groups.where("component_id = doc_id").select(F.col("doc_id").alias("node"))
    kept = rows.join(first, "node", "left_semi")
    if odd:  # rows that are equal in id and text may differ in other columns: the first by these stays
        others = [F.col(c) for c in COLUMNS if c != "doc_id"]
        kept = kept.groupBy("node", "doc_id").agg(F.min(F.struct(*others)).alias("d")).select("doc_id", "d.*")
    return kept.select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    taken = mix(docs).where("copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [("quality rules", quality), ("line dedup", repeated_lines), ("n-gram Jaccard join", near_duplicates),
          ("mixing", mixture), ("packing", packing)]

#: Tokenizing is not SQL; tests/llm/test_pipeline.py holds each stage and run() against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
