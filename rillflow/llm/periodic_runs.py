"""Maximal periodic runs of words in every text, found by internal pattern matching.

A run of period q and length 4 q or more contains, for the dyadic length m with m / 2 < q <= m, a block of m
words that begins at a multiple of m / 2 and stands again q words further on. As m >= q, the block's next
occurrence is q words away and no nearer, since a nearer one would give the run a smaller period. So each
repeated block asks once where it occurs next in the window of m words behind its start: a range
successor query on a wavelet tree over the suffix array, in the interval of the block's suffixes. The
successor is the first step of the progression in which the block goes on through the run, so the distance
is the candidate period; the run is then extended word by word to both sides (longest common
extensions over the ranks of all dyadic lengths) and kept if it is long enough.

All steps are numpy passes over a batch of texts. A text is a unit of its own; nothing is shuffled.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import sliced, small_batches

LEAST, POWER = 6, 4  # words of a run; repeats of its period


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with the test repeat of the contract: every tenth document (by crc32 of the id) repeats
    its words from a on with period p. Nothing is planted without an id or words."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[: n - a]


class Suffixes:
    """Suffix array over several texts of words, by prefix doubling, with the ranks of every dyadic
    length on the way. The suffixes of a text are one stretch of the array, so equal ranks mean equal
    words in the same text. `rank[j][i]` is the first place in the array of the block of 2**j words at i."""

    def __init__(self, codes: np.ndarray, sizes: np.ndarray):
        n = len(codes)
        self.text = np.repeat(np.arange(len(sizes)), sizes)
        self.first = np.cumsum(sizes) - sizes  # of each text
        self.end = np.cumsum(sizes)[self.text]  # behind the text that a word is in
        kinds = int(codes.max()) + 1 if n else 1
        key = self.text * kinds + codes
        self.array = np.argsort(key, kind="stable")
        rank, self.open = self._ranked(key[self.array], self.array, np.arange(n))
        self.rank = [rank]
        while self.open.any():
            self._double()

    def _ranked(self, sorted_keys, at, places):
        """Ranks of the suffixes `at` (sorted, at those places), and who shares one with another."""
        n = len(at)
        new = np.ones(n, bool)
        new[1:] = sorted_keys[1:] != sorted_keys[:-1]
        start = np.flatnonzero(new)
        which = np.cumsum(new) - 1
        many = np.diff(np.append(start, n))[which] > 1
        rank = np.empty(len(self.text), np.int64) if n == len(self.text) else self.rank[-1].copy()
        rank[at] = places[start][which]
        shared = np.zeros(len(self.text), bool)
        shared[at] = many
        return rank, shared

    def _double(self):
        size, rank = 1 << (len(self.rank) - 1), self.rank[-1]
        places = np.flatnonzero(self.open[self.array])
        at = self.array[places]
        behind = at + size  # such blocks lie in their text, the next one may begin at its end
        inside = behind < self.end[at]
        follow = np.where(inside, rank[np.minimum(behind, len(rank) - 1)] + 1, 0)
        key = rank[at] * (len(rank) + 1) + follow
        by = np.argsort(key, kind="stable")
        self.array[places] = at[by]
        new_rank, self.open = self._ranked(key[by], at[by], places)
        self.rank.append(new_rank)

    def extended(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many words x and y (x < y, in one text) have in common before and from there on."""
        lo, hi = self.first[self.text[x]], self.end[y]
        left, right = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        for j in range(len(self.rank) - 1, -1, -1):
            size, rank = 1 << j, self.rank[j]
            fits = np.flatnonzero(y + right + size <= hi)
            same = fits[rank[x[fits] + right[fits]] == rank[y[fits] + right[fits]]]
            right[same] += size
            fits = np.flatnonzero(x - left - size >= lo)
            same = fits[rank[x[fits] - left[fits] - size] == rank[y[fits] - left[fits] - size]]
            left[same] += size
        return left, right


class WaveletTree:
    """Range successor over an array of positions below 2**bits, level by level from the top bit. Each
    level keeps how many zeros come before each place and is parted, zeros first, for the next one."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.zeros, self.cut = bits, [], []
        for b in range(bits - 1, -1, -1):
            one = (values >> b) & 1 == 1
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~one, out=before[1:])
            self.zeros.append(before)
            self.cut.append(int(before[-1]))
            values = np.concatenate([values[~one], values[one]])

    def below(self, lo, hi, value):
        """How many places from lo to hi have less than `value`."""
        lo, hi, count = lo.copy(), hi.copy(), np.zeros(len(lo), np.int64)
        for level, (zeros, cut) in enumerate(zip(self.zeros, self.cut)):
            one = (value >> (self.bits - 1 - level)) & 1 == 1
            lo0, hi0 = zeros[lo], zeros[hi]
            count += np.where(one, hi0 - lo0, 0)
            lo, hi = np.where(one, cut + lo - lo0, lo0), np.where(one, cut + hi - hi0, hi0)
        return count

    def nth(self, lo, hi, k):
        """The k-th smallest value (from 0) between lo and hi."""
        lo, hi, k, value = lo.copy(), hi.copy(), k.copy(), np.zeros(len(lo), np.int64)
        for zeros, cut in zip(self.zeros, self.cut):
            lo0, hi0 = zeros[lo], zeros[hi]
            one = k >= hi0 - lo0
            k = np.where(one, k - (hi0 - lo0), k)
            value = value * 2 + one
            lo, hi = np.where(one, cut + lo - lo0, lo0), np.where(one, cut + hi - hi0, hi0)
        return value

    def successor(self, lo, hi, value):
        """The smallest value of at least `value` between lo and hi, or -1."""
        k = self.below(lo, hi, value)
        found = np.full(len(lo), -1, np.int64)
        some = np.flatnonzero(k < hi - lo)
        found[some] = self.nth(lo[some], hi[some], k[some])
        return found


def runs_of(codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """All runs of several texts, given as word numbers one after the other: text, start in the text,
    length and smallest period, by text, start and period."""
    none = tuple(np.zeros(0, np.int64) for _ in range(4))
    if not len(codes):
        return none
    s = Suffixes(codes, sizes)
    n = len(codes)
    local = np.arange(n) - s.first[s.text]
    tree, found = None, []
    for j in range(2, len(s.rank)):
        m = 1 << j
        rank = s.rank[j]
        ends = np.bincount(rank, minlength=n)
        ask = np.flatnonzero((local % (m // 2) == 0) & (ends[rank] > 1))
        if not len(ask):
            continue
        tree = tree or WaveletTree(local[s.array], max(1, int(sizes.max() - 1).bit_length()))
        lo = rank[ask]
        after = tree.successor(lo, lo + ends[lo], local[ask] + 1)
        q = after - local[ask]
        near = (after >= 0) & (q <= m) & (q > (0 if m == 4 else m // 2))
        if not near.any():
            continue
        x, q = ask[near], q[near]
        left, right = s.extended(x, x + q)
        long = left + right + q >= np.maximum(LEAST, POWER * q)
        found.append((s.text[x[long]], local[x[long]] - left[long], (left + right + q)[long], q[long]))
    if not found:
        return none
    rows = np.unique(np.stack([np.concatenate(c) for c in zip(*found)])[[0, 1, 3, 2]], axis=1)
    return rows[0], rows[1], rows[3], rows[2]


def repeated(sizes: np.ndarray, runs: tuple[np.ndarray, ...]) -> np.ndarray:
    """Which words some run contains behind its first period."""
    text, start, length, period = runs
    first = np.cumsum(sizes) - sizes
    change = np.zeros(int(sizes.sum()) + 1, np.int64)
    np.add.at(change, first[text] + start + period, 1)
    np.add.at(change, first[text] + start + length, -1)
    return np.cumsum(change)[:-1] > 0


FOUND = ("n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
         "runs array<struct<start: long, length: long, period: long>>, collapsed string")
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _best(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    best = runs[0]
    for r in runs[1:]:  # in order of start and period, so the first of equals stays
        if r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def _of_texts(texts: list[list[bytes]]):
    """Columns of FOUND for several texts."""
    sizes = np.array([len(t) for t in texts], np.int64)
    flat = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode()
    runs = runs_of(flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), sizes)
    gone = repeated(sizes, runs) if len(runs[0]) else None
    cuts = np.searchsorted(runs[0], np.arange(len(texts) + 1))
    rows = np.stack(runs[1:], 1).tolist()
    at, out = 0, []
    for i, t in enumerate(texts):
        own = [tuple(r) for r in rows[cuts[i]:cuts[i + 1]]]
        if own:
            drop = gone[at:at + len(t)]
            best = _best(own)
            out.append((len(t), len(own), *best, 1000 * best[1] // best[2], [dict(zip(("start", "length", "period"), r)) for r in own],
                        b" ".join(w for w, d in zip(t, drop.tolist()) if not d).decode("utf-8", "replace")))
        else:
            out.append((len(t), 0, None, None, None, None, [], b" ".join(t).decode("utf-8", "replace")))
        at += len(t)
    return out


def find_runs(docs: DataFrame, test_repeats: bool = False, at_once: int = 200_000) -> DataFrame:
    """`docs` (doc_id, text) with the periodic runs of every text: doc_id, n_words, n_runs, the run with the
    greatest length / period (start, length, period, exponent_milli; ties: smallest start, then
    period), all `runs` by start and period, and the text `collapsed` to its words outside the repeats.

    A run is a stretch of words of smallest period q with at least max(6, 4 q) words that cannot be
    extended to either side. Words are parted by white space and compared by their bytes.
    Null, empty and blank texts have no words, no run (four nulls) and an empty collapsed text.
    Repeated rows and ids are judged each; other columns are not looked at; an empty table gives no
    rows. Texts go through numpy about `at_once` words at a time, or one longer text alone; texts of
    like length go together. With `test_repeats` every tenth text is made periodic first (`planted`).
    """
    small_batches(docs.sparkSession)
    names = [f.strip().split()[0] for f in FOUND.split(", ")[:6]] + ["runs", "collapsed"]
    kinds = [pa.int64()] * 6 + [pa.list_(_RUN), pa.string()]

    def run(batches):
        for batch in sliced(batches):
            ids = batch.column("doc_id").to_pylist()
            texts = [(t or "").encode("utf-8", "surrogatepass").split() for t in batch.column("text").to_pylist()]
            if test_repeats:
                texts = [planted(t, i) for t, i in zip(texts, ids)]
            order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
            part, held = [], 0
            for i in order + [None]:
                if part and (i is None or held + len(texts[i]) > at_once):
                    rows = _of_texts([texts[k] for k in part])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[k] for k in part], pa.int64()), *[pa.array(c, k) for c, k in zip(zip(*rows), kinds)]],
                        ["doc_id", *names])
                    part, held = [], 0
                if i is not None:
                    part.append(i)
                    held += len(texts[i])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, " + FOUND)


def digests(found: DataFrame) -> DataFrame:
    """The result of `find_runs` with its runs and collapsed text as SHA-256."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    return found.select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli",
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
