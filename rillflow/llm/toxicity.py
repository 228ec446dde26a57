"""A factorization machine over hashed terms, for labels such as toxicity.

Terms of a text are its words and the beginnings of them (languages build words from a stem), each as being
there once, twice, three times or more often, and the magnitude of its length, all hashed to `BITS` bits. Counted over all
labelled texts, the terms that tell the classes apart best (chi square) become the features, present
or not, together with the lengths. The machine scores

    P(1) = sigmoid(w0 + sum of w[i] + sum over pairs of <v[i], v[j]>)

over a text's features: the factors v learn what pairs of terms mean together, such as an insult with the
mention of a group or an insult in a short text, even for pairs seldom seen. Texts pass through the workers once to be counted (labelled
ones) and once to be reduced to their features; the machine is fitted to a bounded sample of those.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import sliced, small_batches, stored
from rillflow.llm.packed import expand, squeeze
from rillflow.llm.shingles import mix, start_hashes

BITS = 24
STARTS = (3, 4, 5, 6, 7, 8)  # bytes; longer words also count whole
TIMES = (1, 2, 3, 5)
AT_ONCE = 4_000_000  # terms counted at a time


def _slot(h: np.ndarray) -> np.ndarray:
    return (mix(h) >> np.uint64(64 - BITS)).astype(np.int32)


LENGTHS = _slot(np.arange(1, 65, dtype=np.uint64))  # of texts with 2**i or more words, fewer than 2**(i + 1)


def terms_of(text: str | None) -> np.ndarray:
    """The distinct hashed terms of a text, sorted."""
    h, n = np.unique(start_hashes(text, STARTS), return_counts=True)
    words = len((text or "").encode("utf-8", "surrogatepass").split())
    slots = [LENGTHS[words.bit_length():][:1], *[_slot(h[n >= k] + np.uint64(k)) for k in TIMES]]
    return np.unique(np.concatenate(slots))


def term_counts(labelled: DataFrame) -> DataFrame:
    """(term, n, n_one): in how many rows of `labelled` (text, label) a term is, and in how many of label 1."""
    def run(batches):
        held, ones, size = [], [], 0

        def counted():
            terms, at = np.unique(np.concatenate(held), return_inverse=True)
            n = np.bincount(at)
            k = np.bincount(at, np.repeat(ones, [len(h) for h in held]))
            return pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.int32()), pa.array(n, pa.int64()), pa.array(k.astype(np.int64), pa.int64())], ["term", "n", "n_one"])

        for batch in sliced(batches):
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                held.append(terms_of(text))
                ones.append(label)
                size += len(held[-1])
                if size >= AT_ONCE:
                    yield counted()
                    held, ones, size = [], [], 0
        if size:
            yield counted()

    return labelled.select("text", "label").mapInArrow(run, "term int, n long, n_one long").groupBy("term").agg(
        F.sum("n").alias("n"), F.sum("n_one").alias("n_one"))


def best_terms(counts: DataFrame, rows: int, ones: int, features: int, least: int = 3) -> np.ndarray:
    """The `features` terms in `least` rows or more that differ most between the labels by chi square, and the lengths."""
    share = ones / rows
    expected = F.col("n") * share
    chi = F.pow(F.col("n_one") - expected, 2) / (expected * (1 - share) * (1 - F.col("n") / rows + 1e-9))
    top = counts.where(F.col("n") >= least).select("term", chi.alias("chi")).orderBy(F.desc("chi"), "term").limit(features)
    return np.unique(np.concatenate([np.array([r.term for r in top.collect()], np.int32), LENGTHS]))


def features_of(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """(doc_id, features): the places in `terms` of each row's terms."""
    def run(batches):
        place = np.full(1 << BITS, -1, np.int16)
        place[terms] = np.arange(len(terms))
        for batch in sliced(batches):
            found = []
            for text in batch.column("text").to_pylist():
                at = place[terms_of(text)]
                found.append(np.unique(at[at >= 0]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.list_(pa.int16()))], ["doc_id", "features"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, features array<smallint>")


class Machine:
    """Weights of a factorization machine over present features."""

    def __init__(self, features: int, factors: int, seed: int = 7):
        rnd = np.random.default_rng(seed)
        self.bias = np.zeros(1)
        self.w = np.zeros(features)
        self.v = rnd.normal(0, 0.01, (features, factors))

    def dump(self) -> bytes:
        return squeeze(self.bias, self.w, self.v.ravel())

    @classmethod
    def load(cls, blob: bytes) -> "Machine":
        m = cls(0, 1)
        m.bias, m.w, v = (a.copy() for a in expand(blob))
        m.v = v.reshape(len(m.w), -1) if len(m.w) else np.zeros((0, 1))
        return m

    def sums(self, rows: np.ndarray, at: np.ndarray, n: int):
        """Scores of n rows, given as (row, feature) pairs, and the sums of their factors."""
        s = np.stack([np.bincount(rows, self.v[at, f], n) for f in range(self.v.shape[1])], 1)
        squares = np.bincount(rows, (self.v[at] ** 2).sum(1), n)
        score = self.bias[0] + np.bincount(rows, self.w[at], n) + ((s ** 2).sum(1) - squares) / 2
        return score, s

    def scores(self, lists: list[np.ndarray]) -> np.ndarray:
        n = len(lists)
        if not n:
            return np.zeros(0)
        rows = np.repeat(np.arange(n), [len(x) for x in lists])
        at = np.concatenate(lists).astype(np.int64)
        return 1 / (1 + np.exp(-np.clip(self.sums(rows, at, n)[0], -500, 500)))

    def fit(self, lists: list[np.ndarray], labels: np.ndarray, steps: int = 300, rate: float = 0.1, decay: float = 0.3) -> None:
        """Adam on the log loss of all rows at once, with squared weights as a penalty."""
        n = len(lists)
        rows = np.repeat(np.arange(n), [len(x) for x in lists])
        at = np.concatenate(lists).astype(np.int64)
        params = [self.bias, self.w, self.v]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for step in range(1, steps + 1):
            score, s = self.sums(rows, at, n)
            error = (1 / (1 + np.exp(-np.clip(score, -500, 500))) - labels) / n
            e = error[rows]
            by = e[:, None] * (s[rows] - self.v[at])
            slopes = [np.array([error.sum()]), np.bincount(at, e, len(self.w)) + decay / n * self.w,
                      np.stack([np.bincount(at, by[:, f], len(self.w)) for f in range(by.shape[1])], 1) + decay / n * 10 * self.v]
            now = rate * (1 - step / (steps + 1))
            for p, g, a, b in zip(params, slopes, first, second):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= now * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-12)


def score_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", held_out: int = 0, folds: int = 5,
                   features: int = 512, factors: int = 8, sample: int = 20_000) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `docs` (doc_id, text).

    The label (0 or 1) of a text is that of `labels` (doc_id, `label`) with its id; rows whose crc32(doc_id as
    text) mod `folds` is `held_out` are never learned from, nor are null ids (held out) and null labels. Only
    the text decides a score; equal texts have equal ones. Null, empty and blank texts have no
    features and the score of that. Repeated ids count and are scored each, repeated labels count each.
    Without labels of both kinds all scores are the share of ones, 0.5 without any. Other columns are not looked
    at; an empty table gives no rows.

    Terms are counted over all labelled rows. The machine is fitted to about `sample` of them, chosen by a hash of the id.
    """
    spark = docs.sparkSession
    small_batches(spark)
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(held_out)) % folds
    parts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    # both sides grow with the corpus, so the joins are merge joins at every size
    learned = known.where(fold != held_out).hint("merge")
    counts = stored(term_counts(parts.where(F.col("doc_id").isNotNull() & (fold != held_out)).join(learned, "doc_id")), "terms")
    rows, ones = learned.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    terms = best_terms(counts, rows, ones, features) if 0 < ones < rows else np.zeros(0, np.int32)
    found = stored(features_of(parts, terms), "features")
    machine = Machine(len(terms), factors)
    machine.bias[0] = np.log((ones + 1e-9) / (rows - ones + 1e-9)) if rows else 0.0
    if len(terms):
        chosen = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(min(1.0, sample / rows) * (1 << 20))
        some = found.join(learned.where(chosen), "doc_id").select("doc_id", "features", "label")

        def fit(batches):
            table = [(i, f, y) for b in batches for i, f, y in zip(*(b.column(c).to_pylist() for c in ("doc_id", "features", "label")))]
            table.sort()
            if table:
                machine.fit([np.array(f, np.int16) for _, f, _ in table], np.array([y for *_, y in table], float))
                yield pa.RecordBatch.from_arrays([pa.array([machine.dump()], pa.binary())], ["machine"])

        fitted = stored(some.repartition(1).mapInArrow(fit, "machine binary"), "machine").first()
        machine = Machine.load(fitted.machine) if fitted else machine

    def score(batches):
        for batch in batches:
            p = machine.scores([np.array(f, np.int16) for f in batch.column("features").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    out = found.mapInArrow(score, "doc_id long, score double, predicted int")
    return out.select("doc_id", (fold == held_out).alias("held_out"), "score", "predicted")
