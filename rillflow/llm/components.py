"""Connected components of a large graph by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable from each id in `edges` (a, b: long).

    Each step points the neighbours of a node to the smallest of them; minima are partial
    aggregates joined back by node, so a node with any number of neighbours can be split. The
    edges are written to the shared folder after each step. Ids without edges do not appear;
    loops and repeated edges change nothing.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    e, before = stored(e, "edges"), None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).where("u != v")
        e, last = stored(small.distinct(), "edges"), e
        discard(last)
        mark = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
        if mark == before:
            roots = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
        before = mark
