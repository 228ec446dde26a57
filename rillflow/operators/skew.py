"""Attaching one-row-per-key results to rows when single keys may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def attach(rows: DataFrame, per_key: DataFrame, key: list[str], weight: str, spread: list[str],
           sizes: DataFrame | None = None, floor: int = 1_000_000,
           listed: int = 10_000) -> DataFrame:
    """Left join of `rows` to `per_key` (unique on `key`) that splits hot keys.

    `weight` is the number of rows of a key, which the aggregate that made `per_key` knows; `sizes`
    may give (key, weight) where that is cheaper to compute. The `listed` heaviest keys with more
    than `floor` rows are dealt out, by a hash of the `spread` columns, in pieces of about `floor`
    rows; per_key has one copy of their row per piece.

    The list is broadcast and has at most `listed` rows by its limit. No key is lost by that: keys
    that are not listed join as they are, and each of them has less than 1/listed of all rows. The
    copies number at most rows / floor.
    """
    w = F.col(weight)
    pieces = F.when(w > floor, F.ceil(w / floor).cast("int"))
    hot = (
        (per_key if sizes is None else sizes).where(w > floor)
        .orderBy(w.desc()).limit(listed).select(*key, pieces.alias("_pieces"))
    )
    piece = F.pmod(F.xxhash64(*spread), F.col("_pieces")).cast("int")
    dealt = rows.join(F.broadcast(hot), key, "left").select(
        *rows.columns, F.coalesce(piece, F.lit(0)).alias("_piece"))
    copies = per_key.withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.coalesce(pieces, F.lit(1)) - 1)))
    return dealt.join(copies, [*key, "_piece"], "left").drop("_piece")
