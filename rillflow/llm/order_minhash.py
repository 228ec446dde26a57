"""Order MinHash: fingerprints from minimal occurrence-numbered k-mers kept in text order."""

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: k-mer width in code points (a power of two), bins of a fingerprint (a power of two), k-mers a bin.
WIDTH, BINS, KEEP = 8, 64, 2
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
LOWEST = -(2**63)
PLACE = np.uint64(24)  # low bits that hold a place while sorting


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _B
    h = (h ^ (h >> np.uint64(27))) * _C
    return h ^ (h >> np.uint64(31))


def _sorted(value: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """40-bit values in order, equal ones by place, and the places."""
    if len(value) >> int(PLACE):
        order = np.lexsort((place, value))
        return value[order], place[order]
    s = np.sort((value << PLACE) | place)
    return s >> PLACE, s & ((np.uint64(1) << PLACE) - np.uint64(1))


def fingerprint(text: str, width: int = WIDTH, bins: int = BINS, keep: int = KEEP) -> np.ndarray:
    """One 32-bit hash per bin, 0 for an empty bin; all zero for the empty text.

    Each k-mer gets the number of its occurrence so far, and (k-mer, number) a random value whose
    top bits choose a bin. A bin keeps its `keep` smallest, orders them by their place in the text
    and hashes the tuple, so moving passages changes bins that a plain minhash would not change.
    Shorter texts than a k-mer are one k-mer. Linear memory, two sorts.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    out = np.zeros(bins, dtype=np.uint32)
    if not len(codes):
        return out
    h = np.concatenate([codes + np.uint64(1), np.zeros(max(0, width - len(codes)), np.uint64)])
    step, mult = 1, int(_A)
    while step < width:
        h = h[:-step] * np.uint64(mult) + h[step:]
        step, mult = step * 2, mult * mult % 2**64
    h, n = _mix(h), len(h)
    at = np.arange(n, dtype=np.uint64)
    kmer, pos = _sorted(h >> PLACE, at)
    first = np.concatenate([[True], kmer[1:] != kmer[:-1]])
    start = np.maximum.accumulate(np.where(first, at, np.uint64(0)))
    v, pos = _sorted(_mix(kmer * _A + (at - start) + np.uint64(1)) >> PLACE, pos)
    which = v >> np.uint64(64 - int(PLACE) - (bins.bit_length() - 1))
    begin = np.searchsorted(which, np.arange(bins + 1, dtype=np.uint64))
    found = begin[1:] - begin[:-1]
    take = [np.minimum(begin[:-1] + j, n - 1) for j in range(keep)]
    got = [v[i] for i in take]
    where = [np.where(found > j, pos[i], np.uint64(n)) for j, i in enumerate(take)]
    for i in range(keep):  # by place in the text; what a bin lacks stays behind
        for j in range(keep - 1 - i):
            swap = where[j] > where[j + 1]
            got[j], got[j + 1] = np.where(swap, got[j + 1], got[j]), np.where(swap, got[j], got[j + 1])
            where[j], where[j + 1] = np.minimum(where[j], where[j + 1]), np.maximum(where[j], where[j + 1])
    total = np.zeros(bins, dtype=np.uint64)
    for j, g in enumerate(got):
        total = np.where(found > j, _mix(total * _A + g + np.uint64(j + 1)), total)
    out[:] = (total >> np.uint64(32)).astype(np.uint32)
    out[(found > 0) & (out == 0)] = 1
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the bins filled in either that are equal; 1 for two empty texts."""
    filled = (a != 0) | (b != 0)
    n = int(filled.sum())
    return float((filled & (a == b)).sum()) / n if n else 1.0


def to_hex(f: np.ndarray) -> str:
    return f.astype(">u4").tobytes().hex()


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")


def _rows(batches):
    """Rows sorted by (range, visitor, place): each document with the one after it. The visitor at
    the end of a range is the first document of the next range and gives no row itself."""
    out, held = [], None

    def finish(nxt, f_nxt):
        doc_id, text, f = held[1], held[2], held[3]
        q = len(text) // 4
        edited = text[: len(text) - q] + nxt[:q]
        g = f if edited == text else fingerprint(edited)
        sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
        out.append((doc_id, len(text), sha, to_hex(f), to_hex(g), likeness(f, g), likeness(f, f_nxt)))

    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    for batch in batches:
        cols = (batch.column(c).to_pylist() for c in ("__range", "__visitor", "doc_id", "text"))
        for rng, visitor, doc_id, text in zip(*cols):
            text = text or ""
            if held is None and visitor:
                continue  # further rows with the visitor's id
            f = held[3] if held and held[2] == text else fingerprint(text)
            if held is not None:
                finish(text, f)
            held = None if visitor else (rng, doc_id, text, f)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
            out = []


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every (doc_id, text) and of its edited text, see `SCHEMA`.

    Edited: the last quarter of the code points replaced by the first as many (or all) of the next
    document in ascending order of (doc_id, text), nulls first, after the last the first. Null
    texts are empty; repeated ids are further documents; an empty table gives no rows.

    Documents are dealt to ranges of ids, four for each shuffle partition, at quantiles of the
    ids; each range also gets the first document of the range after it, and a task reads its
    ranges in order, holding one document. The texts are shuffled once. The driver holds two
    numbers per range.
    """
    spark = docs.sparkSession
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", place.alias("__place"))
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = base.agg(F.percentile_approx("__place", [i / n for i in range(1, n)], 20 * n)).first()[0] or []
    cuts = np.unique(np.array(cuts, dtype=np.int64))

    def in_range(ids):
        return np.searchsorted(cuts, ids, side="right").astype("int32")

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(in_range(ids.to_numpy()))

    firsts = base.select("__place").groupBy(range_of("__place").alias("r")).agg(F.min("__place")).collect()
    firsts = sorted(tuple(r) for r in firsts)
    to = [(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)]
    visits = spark.createDataFrame(to, "__place long, __range int")
    own = base.withColumns({"__range": range_of("__place"), "__visitor": F.lit(False)})
    visitors = base.join(F.broadcast(visits), "__place").withColumn("__visitor", F.lit(True))
    dealt = own.unionByName(visitors).repartition("__range")
    return (dealt.sortWithinPartitions("__range", "__visitor", "__place", "text")
            .select("__range", "__visitor", "doc_id", "text").mapInArrow(_rows, SCHEMA))
