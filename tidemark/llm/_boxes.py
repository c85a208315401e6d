"""Arrays as compressed bytes, for rows that carry many numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def boxed(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes, each as planes of its bytes."""
    head = np.array([len(arrays), *[x for a in arrays for x in (a.dtype.itemsize, len(a))]], np.int64).tobytes()
    kinds = "".join(a.dtype.char for a in arrays).encode()
    plain = head + kinds + b"".join(np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T).tobytes() if len(a) else b"" for a in arrays)
    return np.int64(len(plain)).tobytes() + pa.compress(plain, codec="zstd", asbytes=True)


def unboxed(body: bytes) -> list[np.ndarray]:
    plain = pa.decompress(body[8:], decompressed_size=int(np.frombuffer(body, np.int64, 1)[0]), codec="zstd", asbytes=True)
    n = int(np.frombuffer(plain, np.int64, 1)[0])
    shape = np.frombuffer(plain, np.int64, 2 * n, 8).reshape(n, 2)
    at = 8 + 16 * n
    kinds, at = plain[at : at + n].decode(), at + n
    out = []
    for kind, (size, length) in zip(kinds, shape.tolist(), strict=True):
        got = np.frombuffer(plain, np.uint8, size * length, at).reshape(size, length) if length else np.zeros((size, 0), np.uint8)
        out.append(np.ascontiguousarray(got.T).reshape(-1).view(np.dtype(kind)))
        at += size * length
    return out
