"""Sum-of-squares packing of token sequences into windows of a fixed length."""

from __future__ import annotations

import base64
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from rillflow.llm.common import small_batches

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
#: Pieces of a vocabulary's own text that one call should not merge in quadratic time.
_LONG = re.compile(r"\S{1000}|\s{1000}")


class Encoder:
    """Token ids as the tokenizer file gives them, without special tokens added.

    `path` is a tokenizers JSON. When the same vocabulary lies beside it as a rank file, ordinary
    texts go through that: the same ids, four times as fast. Texts with the name of a special
    token, which the JSON turns into that token, and texts with very long runs do not.
    """

    def __init__(self, path: str | None = None):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        path = path or public_tokenizers.path("byte_bpe_50k.json")
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.slow = Tokenizer.from_file(path)
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.fast, ranks = None, re.sub(r"\.json$", ".tiktoken", path)
        if ranks != path and os.path.exists(ranks):
            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                                          mergeable_ranks=table, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        if self.fast is None or any(s in text for s in self.special) or _LONG.search(text):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class Packer:
    """Windows of `length` ids, filled online.

    `open[h]` lists the partly filled windows of level h and `count[h]` is their number. A piece
    goes where the sum of the squared counts becomes least, into a new window among others, at
    equal sums into the fullest. `close()` puts what is still open end to end and cuts it into
    whole windows, the rest into windows of powers of two, so nothing is padded there.
    `most_open` bounds the memory: beyond it the fullest half is closed that way.
    """

    def __init__(self, length: int = 1024, most_open: int = 4096):
        self.length, self.most_open = length, most_open
        self.count = np.zeros(length + 1, dtype=np.int64)
        self.open: list[list[list]] = [[] for _ in range(length)]
        self.n_open = 0

    def add(self, doc, ids: np.ndarray):
        """Yields the windows that are full now: lists of (doc, start, ids)."""
        whole = len(ids) - len(ids) % self.length
        for i in range(0, whole, self.length):
            yield [(doc, i, ids[i : i + self.length])]
        s = len(ids) - whole
        if not s:
            return
        top = self.length - s
        c = self.count
        change = 2 * c[s : self.length + 1] + 1  # level h + s gains a window, but for the full ones
        change[top] = 0
        change[1:] -= 2 * c[1 : top + 1] - 1
        change[1:][c[1 : top + 1] == 0] = np.iinfo(np.int64).max
        h = top - int(np.argmin(change[::-1]))
        window = self.open[h].pop() if h else []
        if h:
            c[h] -= 1
            self.n_open -= 1
        window.append((doc, whole, ids[whole:]))
        if h == top:
            yield window
            return
        self.open[h + s].append(window)
        c[h + s] += 1
        self.n_open += 1
        if self.n_open > self.most_open:
            yield from self.close(self.most_open // 2, last=False)

    def close(self, most: int | None = None, last: bool = True):
        """Closes the `most` fullest open windows (all if None); `last`: also what stays over."""
        pieces = []
        for h in range(self.length - 1, 0, -1):
            while self.open[h] and (most is None or most > 0):
                pieces += self.open[h].pop()
                self.count[h] -= 1
                self.n_open -= 1
                most = None if most is None else most - 1
        left = sum(len(ids) for _, _, ids in pieces)
        window, room = [], self._next(left)
        while pieces:
            doc, start, ids = pieces.pop()
            if len(ids) > room:
                pieces.append((doc, start + room, ids[room:]))
                ids = ids[:room]
            window.append((doc, start, ids))
            room -= len(ids)
            left -= len(ids)
            if not room:
                yield window
                window, room = [], self._next(left)
                if not last and left < self.length:
                    break
        for doc, start, ids in pieces:  # not yet a whole window: open again, each by itself
            self.open[len(ids)].append([(doc, start, ids)])
            self.count[len(ids)] += 1
            self.n_open += 1

    def _next(self, left: int) -> int:
        return self.length if left >= self.length else 1 << max(0, left.bit_length() - 1)


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = 1024, end_id: int = 0,
         with_ids: bool = False) -> DataFrame:
    """The pieces of all (doc_id, text), one row each, see `SCHEMA`; `with_ids` adds their `ids`.

    A document is its ids and then `end_id`; null texts are empty, so they are one id. Repeated
    rows are packed each by itself, null ids stay null, an empty table gives no pieces. Each
    input partition packs its own documents in one pass, so nothing is shuffled, a long or
    frequent source is many partitions' work, and a lost task repeats itself with the same
    sequence ids (partition number and a counter). Memory: the open windows, at most 4096.
    """

    def run(batches):
        encode, packer = Encoder(tokenizer), Packer(length)
        base = TaskContext.get().partitionId() << 33
        n_seq, rows, tokens = 0, [], []
        kinds = [pa.int64()] * 7

        def emit(window):
            nonlocal n_seq
            at = 0
            for (doc_id, total), start, ids in window:
                rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total, base + n_seq, at))
                if with_ids:
                    tokens.append(ids)
                at += len(ids)
            n_seq += 1

        def flush():
            cols = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            if with_ids:
                cols.append(pa.array(tokens, pa.list_(pa.int64())))
            out = pa.RecordBatch.from_arrays(cols, names)
            rows.clear()
            tokens.clear()
            return out

        names = [x.split()[0] for x in SCHEMA.split(", ")] + ["ids"] * with_ids
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.array([*encode(text or ""), end_id], dtype="<u4")
                for window in packer.add((doc_id, len(ids)), ids):
                    emit(window)
            if rows:
                yield flush()
        for window in packer.close():
            emit(window)
        if rows:
            yield flush()

    small_batches(docs.sparkSession)
    schema = SCHEMA + (", ids array<long>" if with_ids else "")
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, schema)
