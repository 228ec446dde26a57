"""Personal data: patterns, and a skip-chain conditional random field over the tokens around them."""

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1  # the last one: none
MOST_DIGITS = {"card": 19, "phone": 15}
SPACES = " \t\n\x0b\x0c\r"
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A run of digits starts a match or none of its digits does, so the look-behind changes no match.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ACTIVE = re.compile(r"[0-9@]")
_TRIM = ".,;:!?\"'()[]{}<>"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start: leftmost matches of each pattern that pass its test.
    Linear in the text."""
    out = [(0, *s) for s in _emails(text)]
    out += [(1, *m.span()) for m in _IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


FEATURES = 20


def _shape(token: str, word: str, digits: str) -> list[int]:
    """The features of a token that are on, by number; 0 always is."""
    n, on = len(digits), [0]
    on.append(1 + min(n, 4) if n < 5 else 6 if n < 8 else 7 if n < 13 else 8 if n < 20 else 9)
    dots = word.count(".")
    on += [10] * (dots == 3) + [11] * (dots in (1, 2)) + [12] * ("@" in word) + [13] * token.startswith("+")
    on += [14] * ("-" in word) + [15] * ("(" in token) + [16] * (n == len(word) and n > 0)
    on += [17] * any(c.isalpha() for c in word) + [18] * (13 <= n <= 19 and luhn(digits)) + [19] * ("." in word.rpartition("@")[2] and "@" in word)
    return on


def graph(text: str, spans: list[tuple[int, int, int]]):
    """The field of a text: nodes are the tokens with a digit or `@`, all others are `none`.

    Returns the nodes (start, end without marks around), their features, their pattern label (or
    `none`), chain edges between neighbouring tokens and skip edges between each node and the
    last one before it with the same word or the same last seven digits.
    """
    nodes, on, chain, skip, seen = [], [], [], [], {}
    m, last_end = _ACTIVE.search(text), -2
    while m:
        start = 1 + max(text.rfind(c, max(last_end, 0), m.start()) for c in SPACES)
        start = max(start, last_end, 0)
        stop = _SPACE.search(text, m.end())
        end = stop.start() if stop else len(text)
        token = text[start:end]
        a = start + len(token) - len(token.lstrip(_TRIM))
        b = end - len(token) + len(token.rstrip(_TRIM))
        word, k = text[a:b], len(nodes)
        digits = _digits(word)
        if start == last_end + 1 and k:
            chain.append((k - 1, k))
        linked = set()
        for key in (word.lower(), digits[-7:] if len(digits) >= 7 else None):
            if key:
                if key in seen and seen[key] not in linked:
                    skip.append((seen[key], k))
                    linked.add(seen[key])
                seen[key] = k
        nodes.append((a, b))
        on.append(_shape(token, word, digits))
        last_end = end
        m = _ACTIVE.search(text, end)
    label = np.full(len(nodes), LABELS - 1)
    starts = np.array([n[0] for n in nodes])
    for kind, s, e in reversed(spans):
        if len(nodes):
            lo, hi = np.searchsorted(starts, s - 1), np.searchsorted(starts, e)
            lo = max(0, lo - 1)
            for i in range(lo, hi):
                if nodes[i][0] < e and nodes[i][1] > s:
                    label[i] = kind
    return nodes, on, label, chain, skip


class Field:
    """Weights of the field: features by label, chain edges by label pair, one for equal labels
    over a skip edge by label."""

    def __init__(self, unary, chain, skip):
        self.unary, self.chain, self.skip = unary, chain, skip

    @classmethod
    def fitted(cls, examples: list, steps: int = 200, rate: float = 0.5, decay: float = 1e-3,
               skip_prior: float = 4.0) -> "Field":
        """Maximum pseudo-likelihood by gradient ascent; an example is (features on, label, label
        before or -1, label after or -1, counts of the labels over skip edges). Examples with skip
        edges count a second time without their shape, or the shape, which settles nearly
        all labels of the patterns, would leave nothing for the edges to learn. The prior of the
        skip weights has the mean `skip_prior`, which holds where no sampled text repeats a datum."""
        unary, chain = np.zeros((FEATURES, LABELS)), np.zeros((LABELS, LABELS))
        skip = np.append(np.full(LABELS - 1, skip_prior), 0.0)
        if not examples:
            unary[0, -1] = 10.0
            return cls(unary, chain, skip)
        examples = [*examples, *([[0], *e[1:]] for e in examples if any(e[4]))]
        n = len(examples)
        x, y = np.zeros((n, FEATURES)), np.array([e[1] for e in examples])
        for i, e in enumerate(examples):
            x[i, e[0]] = 1
        before, after = (np.array([e[j] for e in examples]) for j in (2, 3))
        b, a = np.eye(LABELS + 1)[before][:, :LABELS], np.eye(LABELS + 1)[after][:, :LABELS]
        near, goal = np.array([e[4] for e in examples], dtype=float), np.eye(LABELS)[y]
        for _ in range(steps):
            s = x @ unary + b @ chain + a @ chain.T + near * skip
            p = np.exp(s - s.max(1, keepdims=True))
            g = goal - p / p.sum(1, keepdims=True)
            unary += rate * (x.T @ g / n - decay * unary)
            chain += rate * ((b.T @ g + g.T @ a) / n - decay * chain)
            skip[:-1] += rate * ((near * g).sum(0) / n - decay * (skip - skip_prior))[:-1]
        return cls(unary, chain, np.maximum(skip, 0))

    def marginals(self, on, label, chain, skip, sweeps: int = 1000) -> np.ndarray:
        """Belief propagation in sweeps until no message changes; nodes with a pattern label are held
        to it. Skip edges are used in order to the end of the text and back: a node sends on after
        all that link to it have sent, so one sweep carries evidence over all repeats of a datum.
        Chain edges, between neighbours, all send once a sweep. Where loops keep messages
        moving, they are damped from the 20th sweep on."""
        n = len(on)
        own = np.array([self.unary[f].sum(0) for f in on])
        own[label < LABELS - 1] = -30.0
        fixed = np.flatnonzero(label < LABELS - 1)
        own[fixed, label[fixed]] = 30.0
        edges = [*chain, *skip]
        if not edges:
            return _normal(own)
        depth = [0] * n  # skip edges on the longest way to a node; they lead to later nodes, in order
        for a, b in skip:
            depth[b] = max(depth[b], depth[a] + 1)
        edges, depth = np.array(edges, dtype=np.int64), np.array(depth)
        pair = np.concatenate([np.repeat(self.chain[None], len(chain), 0),
                               np.repeat(np.diag(self.skip)[None], len(skip), 0)])
        to = np.concatenate([edges[:, 1], edges[:, 0]])
        source = np.concatenate([edges[:, 0], edges[:, 1]])
        both = np.exp(np.concatenate([pair, pair.transpose(0, 2, 1)]))
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        number = np.arange(len(to))
        at = np.where(number % len(edges) < len(chain), -1,
                      np.where(number < len(edges), depth[source], 2 * n - depth[source]))
        by = np.argsort(at, kind="stable")
        steps = [(e, source[e], to[e], back[e], both[e])
                 for e in np.split(by, np.flatnonzero(np.diff(at[by])) + 1)]
        message, belief = np.zeros((len(to), LABELS)), own.copy()
        for k in range(sweeps):
            moved = 0.0
            for e, src, dst, rev, p in steps:
                new = np.log(np.maximum((_normal(belief[src] - message[rev])[:, None, :] @ p)[:, 0], 1e-300))
                new -= new.max(1, keepdims=True)
                change = (new - message[e]) * (1.0 if k < 20 else 0.5)
                moved = max(moved, np.abs(change).max())
                message[e] += change
                np.add.at(belief, dst, change)
            if moved < 1e-4:
                break
        return _normal(belief)


def _normal(s: np.ndarray) -> np.ndarray:
    p = np.exp(s - s.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def _one(kind: int, text: str) -> bool:
    """Whether neighbouring tokens may be one datum: parts of a card or phone number, within its digits."""
    return sum(c in "0123456789" for c in text) <= MOST_DIGITS.get(KINDS[kind], 0)


def added_spans(text: str, spans: list, model: Field, sure: float) -> list[tuple[int, int, int]]:
    """Spans of tokens outside all pattern spans whose label is sure; neighbours of one kind join
    as far as that kind has digits."""
    nodes, on, label, chain, skip = graph(text, spans)
    if not nodes or (label < LABELS - 1).all():
        return []
    p = model.marginals(on, label, chain, skip)
    best = p.argmax(1)
    take = (best < LABELS - 1) & (label == LABELS - 1) & (p.max(1) >= sure)
    joined, out = {b for _, b in chain}, []
    for i in np.flatnonzero(take):
        a, b = nodes[i]
        if a >= b:
            continue
        if out and i in joined and take[i - 1] and out[-1][0] == best[i] and _one(best[i], text[out[-1][1]:b]):
            out[-1] = (out[-1][0], out[-1][1], b)
        else:
            out.append((int(best[i]), a, b))
    return out


def _examples(text: str, limit: int):
    nodes, on, label, chain, skip = graph(text, base_spans(text))
    n = len(nodes)
    before, after, near = np.full(n, -1), np.full(n, -1), np.zeros((n, LABELS))
    for a, b in chain:
        before[b], after[a] = label[a], label[b]
    for a, b in skip:
        near[a, label[b]] += 1
        near[b, label[a]] += 1
    for i in range(min(n, limit)):
        yield on[i], int(label[i]), int(before[i]), int(after[i]), near[i].tolist()


def fit(docs: DataFrame, sample_docs: int = 4000, per_doc: int = 50, sample_tokens: int = 50_000) -> Field:
    """The field fitted to a bounded sample: about `sample_docs` documents by hash of their id, the
    first `per_doc` tokens with a digit or `@` of each, at most `sample_tokens` in all. A token's
    label is the pattern span over it."""
    step = max(1, docs.count() // sample_docs)

    def run(batches):
        for batch in batches:
            rows = [e for t in batch.column("text").to_pylist() for e in _examples(t or "", per_doc)]
            kinds = (pa.list_(pa.int32()), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 5, kinds)],
                ["f", "label", "before", "after", "near"])

    chosen = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0).where(F.col("text").rlike("[0-9@]"))
    found = chosen.select("text").mapInArrow(
        run, "f array<int>, label int, before int, after int, near array<double>")
    rows = found.orderBy(F.xxhash64("f", "label", "before", "after", "near")).limit(sample_tokens).collect()
    return Field.fitted([tuple(r) for r in rows])


SCHEMA = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
          "spans string, n_added long")


def written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find(docs: DataFrame, model: Field | None = None, sure: float = 0.95) -> DataFrame:
    """Personal data of every (doc_id, text): counts and digest of the pattern spans, all spans.

    The patterns' spans stay as they are. A conditional random field over the tokens with a digit or
    `@` holds them to their kind; chain edges join neighbouring tokens and skip edges distant ones
    with the same word or last digits, so a number once written as a phone is found where it
    stands without its prefix, however many times. Tokens with a probability of `sure` or more are added. Positions
    are code points, ends exclusive. Null texts are empty; rows are judged alone, so repeated rows,
    null ids and empty tables need no rule. No shuffle but that of the sample for `fit`.
    """
    model = model or fit(docs)

    def run(batches):
        kinds = (pa.int64(),) * 5 + (pa.string(), pa.string(), pa.int64())
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                text = text or ""
                base = base_spans(text)
                more = added_spans(text, base, model, sure)
                n = [sum(s[0] == k for s in base) for k in range(len(KINDS))]
                rows.append((doc_id, *n, hashlib.sha256(written(base).encode()).hexdigest(), written(base + more), len(more)))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 8, kinds)], names)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCHEMA)
