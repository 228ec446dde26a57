"""Arrays as compact bytes, for columns that travel in packed blocks."""

import pickle

import numpy as np
import zstandard


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes: whole numbers in as few bytes as they need, bytes of equal rank together."""
    out = []
    for a in arrays:
        if a.dtype.kind in "iu" and a.size:
            a = a.astype(np.min_scalar_type(int(a.max())))
        a = np.ascontiguousarray(a)
        out.append((a.dtype.str, len(a), a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if a.size else b""))
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(out))


def expand(blob: bytes) -> list[np.ndarray]:
    out = []
    for kind, n, raw in pickle.loads(zstandard.ZstdDecompressor().decompress(blob)):
        t = np.dtype(kind)
        out.append(np.frombuffer(np.frombuffer(raw, np.uint8).reshape(t.itemsize, n).T.tobytes(), t)
                   if n else np.zeros(0, t))
    return out
