"""A Katz backoff language model, counted and evaluated by blocks of documents.

A block is a run of documents of one input partition; its distinct words are numbered, its texts are
kept as those numbers. Order by order, each block sends its distinct n-grams with their training
counts and the probability of the shorter n-gram to the bucket of their context, as packed
columns. A bucket adds the counts up and answers every block with the total of each n-gram, its
number (the context number of the next order) and the counts of its context, from which the block gets
discounts, backoff weight and probability. So n-grams travel once per order, after they are
counted inside a block, and texts never. What a block knows after an order is its state, a column of a
table in buckets of blocks, as the answers are: each is shuffled once, and the tables before them go.
"""

import uuid
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import shuffles_released, stored
from rillflow.llm.packed import expand, squeeze
from rillflow.llm.shingles import mix, word_hashes

K = 5  # counts above K are not discounted
END = np.uint64(0x5BD1E995_9D1B58D3)  # the hash of the end token
STATS = K + 2  # of a context: n-grams seen 1 .. K times, the sum of the larger counts, backed-off mass


def ordered(keys: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers below `bound` in order, and their places; in one sort of numbers that hold both
    where 63 bits have room for them."""
    n = max(len(keys), 1)
    if bound * n >= 2**63:
        order = np.argsort(keys, kind="stable")
        return keys[order], order
    both = np.sort(keys * n + np.arange(len(keys)))
    values = both // n
    return values, both - values * n


def changes(x: np.ndarray) -> np.ndarray:
    """Where an ordered array has a value that the place before has not."""
    return np.concatenate([[True], x[1:] != x[:-1]]) if len(x) else np.zeros(0, bool)


def codes(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Repeating numbers as a list of values and places in it."""
    values, at = np.unique(p, return_inverse=True)
    return values, at


@dataclass
class Level:
    """What is known of one order: buckets, discounts, totals, statistics of split contexts."""

    buckets: int
    discount: np.ndarray = None
    tokens: int = 0
    types: int = 0
    split: dict = field(default_factory=dict)


def discounts(n: list[int]) -> np.ndarray:
    """Good-Turing discounts of the counts 0 .. K from n[r], the number of n-grams seen r times.

    d(r) = (r* / r - A) / (1 - A), r* = (r + 1) n(r + 1) / n(r), A = (K + 1) n(K + 1) / n(1). Where
    that lies outside (0, 1), as for few or planted counts, it is (r - D) / r with
    D = n(1) / (n(1) + 2 n(2)), or 1/2 without any.
    """
    d = np.ones(K + 1)
    plain = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    a = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
    for r in range(1, K + 1):
        d[r] = ((r + 1) * n[r + 1] / n[r] / r - a) / (1 - a) if n[r] and a < 1 else 0.0
        if not 0 < d[r] < 1:
            d[r] = (r - plain) / r
    return d


def discounted(r: np.ndarray, total: np.ndarray, d: np.ndarray) -> np.ndarray:
    """P of n-grams seen r > 0 times after a context seen `total` times."""
    return r * np.where(r > K, 1.0, d[np.minimum(r, K)]) / total


def total_of(stats: np.ndarray) -> np.ndarray:
    """Training count of contexts; one more where no count is discounted, so that every context
    keeps mass for unseen words."""
    seen = stats[:, :K] @ np.arange(1, K + 1) + stats[:, K]
    return np.where(stats[:, :K].any(1) | (seen == 0), seen, seen + 1)


def probability(r: np.ndarray, stats: np.ndarray, ctx: np.ndarray, lower: np.ndarray, d: np.ndarray) -> np.ndarray:
    """P of n-grams with training count `r` and context row `ctx` of `stats`."""
    total = total_of(stats)
    held = stats[:, :K] @ (np.arange(1, K + 1) * d[1:]) + stats[:, K]
    with np.errstate(divide="ignore", invalid="ignore"):
        alpha = np.where(total > 0, (1 - held / total) / np.maximum(1 - stats[:, K + 1], 1e-15), 1.0)
        seen = discounted(r, total[ctx], d)
    return np.where(r > 0, seen, alpha[ctx] * lower)


class Block:
    """The n-grams of a block, order by order, from its words and the answers so far."""

    def __init__(self, row, levels: list[Level] = ()):
        self.id = row["block"]
        self.doc_ids, self.n_tokens, train, self.has_id = expand(row["docs"])
        self.words, self.tokens = expand(row["tokens"])
        self.n_tokens = self.n_tokens.astype(np.int64)
        self.doc = np.repeat(np.arange(len(self.n_tokens), dtype=np.int32), self.n_tokens)
        self.train = np.repeat(train.astype(bool), self.n_tokens)
        first = np.concatenate([[0], np.cumsum(self.n_tokens)[:-1]])
        self.place = (np.arange(len(self.tokens)) - first[self.doc]).astype(np.int32)
        self.gram = self.tokens.astype(np.int64)  # place of each token's n-gram in the list of its order
        self.p = None
        self.size = len(self.words)
        if row.get("state") is not None:
            (order,), word_ids, self.seen, gram_ids, r, total, unseen, short = expand(row["state"])
            self.word_ids, self.gram_ids = word_ids.astype(np.uint64), gram_ids.astype(np.uint64)
            n = self.size = len(word_ids)
            self.before = np.zeros(n, np.int64)
            for k in range(2, order + 1):
                distinct, self.gram, _ = self.longer(k, n)
                n, self.before = len(distinct), distinct // self.size
            if order == 1:
                self.gram_ids, r = self.word_ids, self.seen
            self.r = r.astype(np.int64)
            self.total = total.astype(np.int64)[np.cumsum(changes(self.before)) - 1]
            p = np.empty(n)
            p[r > 0] = discounted(self.r[r > 0], self.total[r > 0], levels[order - 1].discount)
            p[r == 0] = unseen
            self.p = p[self.gram]
            self.p[self.gram < 0] = short

    def state(self, order: int) -> bytes:
        """Numbers and training counts of the words; numbers and counts of the n-grams of the last order,
        unless they are the words; totals of their contexts, from which the probabilities of seen ones
        follow; those of the others, and of tokens with fewer words before them."""
        own = slice(0) if order == 1 else slice(None)
        return squeeze(np.array([order]), self.word_ids, self.seen, self.gram_ids[own], self.r[own],
                       self.total[changes(self.before)], self.p_gram[self.r == 0], self.p[self.gram < 0])

    def longer(self, order: int, n: int):
        """The distinct n-grams of an order as (place among the `n` of the order before, word), each
        token's n-gram, and where it has one. Place n stands for the start of a text."""
        has = self.place >= order - 2
        t = np.flatnonzero(has)
        before = np.where(self.place[t] == 0, n, self.gram[t - 1])
        found, at = ordered(before * self.size + self.tokens[t], (n + 1) * self.size)
        new = changes(found)
        gram = np.full(len(self.tokens), -1, np.int64)
        gram[t[at]] = np.cumsum(new) - 1
        return found[new], gram, has

    @property
    def known(self) -> np.ndarray:
        """Training count of each token's word."""
        return self.seen[self.tokens].astype(np.int64)

    def keys(self, order: int):
        """Contexts, their ranks, and words of the distinct n-grams, each token's n-gram, and where it
        has one."""
        if order == 1:
            none = self.before = np.zeros(len(self.words), np.int64)
            return none.astype(np.uint64), none, self.words, self.gram, np.ones(len(self.tokens), bool)
        n = len(self.gram_ids)
        distinct, gram, has = self.longer(order, n)
        ctx_ids, rank = np.append(self.gram_ids, np.uint64(0)), np.empty(n + 1, np.int64)
        rank[np.argsort(ctx_ids)] = np.arange(n + 1)
        before, word = np.divmod(distinct, self.size)
        self.before = before
        return ctx_ids[before], rank[before], self.word_ids[word], gram, has

    def counts(self, gram: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(gram[self.train & (gram >= 0)], minlength=n)


def by_bucket(to: np.ndarray, rank: np.ndarray, buckets: int):
    """The filled buckets, each with the places of its n-grams by context."""
    many = int(rank.max(initial=0)) + 1
    key, order = ordered(to * many + rank, buckets * many)
    start = np.flatnonzero(changes(key // many))
    return zip((key[start] // many).tolist(), np.split(order, start[1:])) if len(key) else ()


def bucket_of(order: int, ctx: np.ndarray, word: np.ndarray, buckets: int, split: dict) -> np.ndarray:
    """By context; by context and word for the empty context and those in `split`."""
    if order == 1:
        return (mix(word) % np.uint64(buckets)).astype(np.int64)
    out = mix(ctx + np.uint64(order))
    if split:
        many = np.isin(ctx, np.fromiter(split, np.uint64, len(split)))
        out = np.where(many, mix(out + word), out)
    return (out % np.uint64(buckets)).astype(np.int64)


def blocks_of(docs: DataFrame, held_out: int, folds: int, block_tokens: int) -> DataFrame:
    def run(batches):
        base, seq = TaskContext.get().partitionId() << 24, 0
        ids, hashes, size = [], [], 0

        def row():
            n = np.array([len(h) for h in hashes], np.int64)
            words, tokens, many = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
            by = np.argsort(-many, kind="stable")  # frequent words have small numbers
            words, tokens = words[by], np.argsort(by)[tokens]
            train = np.array([zlib.crc32(str(i).encode()) % folds != held_out for i in ids], np.uint8)
            known = np.array([i is not None for i in ids])
            docs_ = squeeze(np.array([i or 0 for i in ids], np.int64).view(np.uint64), n, train, known.astype(np.uint8))
            return pa.RecordBatch.from_pydict({
                "block": pa.array([base + seq], pa.int64()), "size": pa.array([int(n.sum())], pa.int64()),
                "docs": pa.array([docs_], pa.binary()), "tokens": pa.array([squeeze(words, tokens)], pa.binary())})

        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                h = np.append(word_hashes(text), END)
                ids.append(i)
                hashes.append(h)
                size += len(h)
                if size >= block_tokens:
                    yield row()
                    seq, ids, hashes, size = seq + 1, [], [], 0
        if ids:
            yield row()

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(
        run, "block long, size long, docs binary, tokens binary")


SENT = "bucket int, block long, blob binary"


def _sends(order: int, levels: list[Level]):
    """What the blocks send to the buckets of an order."""
    level = levels[order - 1]

    def sent(block: Block):
        ctx, rank, word, gram, has = block.keys(order)
        n = block.counts(gram, len(word))
        r, total = np.zeros((2, len(word)), np.int64)  # of the shorter n-gram
        if order > 1:
            t = np.flatnonzero(has)
            r[gram[t]], total[gram[t]] = block.r[block.gram[t]], block.total[block.gram[t]]
        for b, at in by_bucket(bucket_of(order, ctx, word, level.buckets, level.split), rank, level.buckets):
            start = np.flatnonzero(changes(rank[at]))
            many = np.diff(np.append(start, len(at)))
            c, learnt = ctx[at][start], n[at] > 0  # n-grams that are not learnt from here take no mass
            yield b, block.id, squeeze(c[:1], np.diff(c), many, word[at], n[at], r[at][learnt], total[at][start])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield _batch(list(zip(*sent(Block(batch.slice(i, 1).to_pylist()[0], levels)))))
    return run


def _alone(stats: np.ndarray) -> np.ndarray:
    """Contexts with one n-gram, seen K times or less: the mass backed off is that of this n-gram, which a
    block that has it knows."""
    return (stats[:, :K].sum(1) == 1) & (stats[:, K] == 0)


def _add_up(order: int, levels: list[Level], last: bool):
    """A bucket: totals, numbers and context statistics for the blocks that sent n-grams. What is seen has
    shorter n-grams that are seen, so their counts and the totals of their contexts were sent, which say
    the same as probabilities, but shorter. Numbers go as ranks in the bucket, and not at all after the
    last order."""
    level = levels[order - 1]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        bucket, parts = int(pdf["bucket"].iloc[0]), []
        blocks = pdf["block"].to_numpy()
        for blob in pdf["blob"]:
            c, gaps, many, w, n, short, total = expand(blob)
            c = np.cumsum(np.concatenate([c.astype(np.uint64), gaps.astype(np.uint64)]))
            p = np.zeros(len(w))
            if order > 1:
                p[n > 0] = discounted(short.astype(np.int64), np.repeat(total, many)[n > 0], levels[order - 2].discount)
            parts.append((np.repeat(c, many), w.astype(np.uint64), n.astype(np.int64), p))
        size = [len(p[1]) for p in parts]
        ctx, word, n, lower = (np.concatenate(x) for x in zip(*parts))
        words_end = int(word.max(initial=0)) + 1
        if order == 1:
            by = np.argsort(word)
        elif int(ctx.max(initial=0)) * words_end < 2**62:
            by = np.argsort(ctx * np.uint64(words_end) + word)
        else:
            by = np.lexsort((word, ctx))
        c, w = ctx[by], word[by]
        new = np.concatenate([[True], (c[1:] != c[:-1]) | (w[1:] != w[:-1])])
        first = np.flatnonzero(new)
        r, gc, gp = np.add.reduceat(n[by], first), c[first], np.maximum.reduceat(lower[by], first)
        rank = np.empty(len(r), np.int64)
        rank[np.argsort(-r, kind="stable")] = np.arange(len(r))
        gram = np.empty(len(by), np.int64)
        gram[by] = np.cumsum(new) - 1
        start = np.flatnonzero(np.concatenate([[True], gc[1:] != gc[:-1]]))
        stats = np.zeros((len(start), STATS))
        for i in range(1, K + 1):
            stats[:, i - 1] = np.add.reduceat((r == i).astype(float), start)
        stats[:, K] = np.add.reduceat(np.where(r > K, r, 0).astype(float), start)
        stats[:, K + 1] = np.add.reduceat(np.where(r > 0, gp, 0.0), start)
        row_of = np.cumsum(np.concatenate([[True], gc[1:] != gc[:-1]])) - 1
        rows, at = [], 0
        for block, k in zip(blocks, size):
            g = gram[at:at + k]
            at += k
            new = changes(row_of[g])
            own, has = stats[row_of[g][new]], np.zeros(int(new.sum()), bool)
            has[(np.cumsum(new) - 1)[r[g] > 0]] = True
            mass = np.where(has & _alone(own), 0.0, own[:, K + 1])
            rows.append((int(block), bucket, None, None,
                         squeeze(r[g], rank[g][:0 if last else None], *(own[:, i].astype(np.uint64) for i in range(K + 1)),
                                 *codes(mass))))
        seen = [float((r == i).sum()) for i in range(K + 2)]
        rows.append((-1 - bucket, bucket, None, [*seen, float(r.sum()), float((r > 0).sum())], None))
        hot = np.isin(gc[start], np.fromiter(level.split, np.uint64, len(level.split))) if order > 1 else [True] * len(start)
        for i in np.flatnonzero(hot):
            rows.append((-1 - bucket, bucket, int(gc[start][i].view(np.int64)), stats[i].tolist(), None))
        return pd.DataFrame(rows, columns=["block", "bucket", "ctx", "nums", "blob"])

    return run


ANSWER = "block long, bucket int, ctx long, nums array<double>, blob binary"


def _answered(block: Block, order: int, levels: list[Level], answers: dict) -> None:
    """Gives the block the probabilities of its tokens after this order, and the n-gram numbers."""
    ctx, rank, word, gram, has = block.keys(order)
    level = levels[order - 1]
    r, number = np.zeros(len(word), np.int64), np.zeros(len(word), np.uint64)
    stats, row = [], np.zeros(len(word), np.int64)
    rows = 0
    for b, at in by_bucket(bucket_of(order, ctx, word, level.buckets, level.split), rank, level.buckets):
        total, num, *s, values, place = expand(answers[b])
        r[at] = total
        if len(num):
            number[at] = num.astype(np.uint64) * np.uint64(level.buckets) + np.uint64(b + 1)
        row[at] = rows + np.cumsum(changes(rank[at])) - 1
        stats.append(np.column_stack([*s, values[place]]).astype(float))
        rows += len(stats[-1])
    stats = np.concatenate(stats)
    t = np.flatnonzero(has)
    lower = np.ones(len(word))
    if order > 1:
        lower[gram[t]] = block.p[t]
    alone = (r > 0) & _alone(stats)[row]
    stats[row[alone], K + 1] = lower[alone]
    for c, s in level.split.items():
        stats[np.unique(row[ctx == np.uint64(c)])] = s
    block.p_gram = probability(r, stats, row, lower, level.discount)
    block.p = np.empty(len(block.tokens)) if order == 1 else block.p.copy()
    block.p[t] = block.p_gram[gram[t]]
    if order == 1:
        block.seen, block.word_ids = r, number
    block.r, block.total = r, total_of(stats)[row].astype(np.int64)
    block.gram, block.gram_ids = gram, number


STATE = "block long, size long, docs binary, tokens binary, state binary"


def _states(order: int, levels: list[Level]):
    def run(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = rows.iloc[0]
        block = Block(row, levels)
        _answered(block, order, levels, dict(zip(answers["bucket"], answers["blob"])))
        return pd.DataFrame([(block.id, row["size"], row["docs"], squeeze(block.words[:0], block.tokens), block.state(order))],
                            columns=["block", "size", "docs", "tokens", "state"])
    return run


def score(docs: DataFrame, order: int = 2, held_out: int = 1, folds: int = 5,
          block_tokens: int = 500_000, bucket_tokens: int = 1_000_000) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document.

    The model learns from documents whose crc32(doc_id as text) mod `folds` is not `held_out`
    (null ids: the text `None`). Words are parted by white space with A-Z lower-cased; each text ends
    with one end token and starts from a start context. P(w | h) = d(r) r / c(h) for an n-gram seen
    r > 0 times, else alpha(h) P(w | shorter h), and P of an unknown word the mass that the
    unigram discounts leave. alpha(h) makes the probabilities after h sum to 1 exactly, over the
    words and the unknown one. Null and empty texts have the end token alone; repeated rows count
    and are scored each; an empty table gives no rows. Words are told apart by 64-bit hashes.

    Memory: a block (`block_tokens`, or one longer text) or a bucket (about `bucket_tokens`) in a task.
    Contexts with over a thousandth of all training tokens, at most 1000, are split over all buckets by
    word, and their statistics, a row each, pass through the driver.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def in_buckets(rows: DataFrame) -> tuple[str, DataFrame]:
        name = f"katz_{uuid.uuid4().hex}"
        with shuffles_released(spark):
            rows.write.bucketBy(parts, "block").saveAsTable(name)
        return name, spark.table(name)

    def met(blocks: DataFrame, answers: DataFrame):
        own = answers.where("block >= 0").select("block", "bucket", "blob")
        return blocks.groupBy("block").cogroup(own.groupBy("block"))

    name, blocks = in_buckets(blocks_of(docs, held_out, folds, block_tokens).withColumn("state", F.lit(None).cast("binary")))
    tokens = blocks.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, tokens // bucket_tokens)
    levels: list[Level] = []
    split: dict = {}
    for k in range(1, order + 1):
        level = Level(buckets, split=split)
        levels.append(level)
        sends = blocks.mapInArrow(_sends(k, list(levels)), SENT)
        added = sends.groupBy("bucket").applyInPandas(_add_up(k, list(levels), k == order), ANSWER)
        # where the states of their blocks are; the last ones, which are read once, move when they are
        told, answers = in_buckets(added.repartition(parts, "block")) if k < order else ("", stored(added, "answers"))
        nums = [F.sum(F.col("nums")[i]).alias(str(i)) for i in range(K + 4)]
        totals = [x or 0 for x in answers.where("block < 0 and ctx is null").agg(*nums).first()]
        level.discount = discounts([int(x) for x in totals[:K + 2]])
        level.tokens, level.types = int(totals[K + 2]), int(totals[K + 3])
        sums = [F.sum(F.col("nums")[i]).alias(f"s{i}") for i in range(STATS)]
        rows = answers.where("block < 0 and ctx is not null").groupBy("ctx").agg(*sums).collect()
        level.split = {r.ctx % 2**64: np.array(r[1:]) for r in rows}
        if k < order:
            split = _frequent(answers.where("block >= 0"), tokens)
            old = name
            name, blocks = in_buckets(met(blocks, answers).applyInPandas(_states(k, list(levels)), STATE))
            spark.sql(f"DROP TABLE {old}")
            spark.sql(f"DROP TABLE {told}")
    n_train, n_types = levels[0].tokens, levels[0].types

    def final(rows, answers):
        block = Block(rows.iloc[0], levels)
        _answered(block, order, levels, dict(zip(answers["bucket"], answers["blob"])))
        n = len(block.n_tokens)
        c = block.known
        base = np.log10((c + 0.5) / (n_train + 0.5 * (n_types + 1)))
        train = np.zeros(n, bool)
        train[block.doc] = block.train
        ids = pd.array(block.doc_ids.astype(np.uint64).view(np.int64), dtype="Int64")
        ids[block.has_id == 0] = pd.NA
        return pd.DataFrame({
            "doc_id": ids, "held_out": ~train, "n_tokens": block.n_tokens,
            "n_known": np.bincount(block.doc, c > 0, n).astype(np.int64), "train_tokens": n_train,
            "base_score": np.bincount(block.doc, base, n), "score": np.bincount(block.doc, np.log10(block.p), n)})

    return met(blocks, answers).applyInPandas(
        final, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
               "base_score double, score double")


def _batch(out) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out or ([], [], []), kinds)],
                                      ["bucket", "block", "blob"])


def _frequent(answers: DataFrame, tokens: int) -> dict:
    """Numbers of the n-grams with over a thousandth of all tokens, and the start."""
    most = max(tokens // 1000, 1)

    def run(batches):
        for batch in batches:
            found = set()
            for blob in batch.column("blob").to_pylist():
                r, number, *_ = expand(blob)
                found.update(number[r > most].tolist())
            yield pa.RecordBatch.from_pydict({"id": pa.array(sorted(found), pa.int64())})

    ids = answers.select("blob").mapInArrow(run, "id long").distinct().collect()
    return {0: None, **{r.id: None for r in ids}}
