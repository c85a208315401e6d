"""Words and shingles of whole Arrow batches, without a Python loop over words.

A word is a run of bytes other than space and 0x09-0x0D, lower-cased in A-Z
only. All hashes are 64-bit and depend on nothing but the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORD = r"[^\x20\x09-\x0D]+"
U = np.uint64
SLICE = 2 << 20


def _splitmix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def mix(x: np.ndarray) -> np.ndarray:
    return _splitmix(x + U(0x9E3779B97F4A7C15))


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
with np.errstate(over="ignore"):
    _CODE = mix(LOWER.astype(np.uint64) + U(1)) | U(1)
    _STEP = U(0xD6E8FEB86659FD93)
    _BACK = U(pow(int(_STEP), -1, 1 << 64))
    _SALT = mix(np.arange(64, dtype=np.uint64) + U(1000)) | U(1)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get(0)
    if have is None or len(have[0]) < n:
        size = max(n + n // 8, 1 << 20)
        up = np.full(size, _STEP)
        up[0] = 1
        down = np.full(size, _BACK)
        down[0] = 1
        have = np.multiply.accumulate(up), np.multiply.accumulate(down)
        _powers[0] = have
    return have


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and each row's offsets into them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if not n or column.buffers()[1] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = column.buffers()[2]
    body = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most about `most` bytes, one row at least."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield at, to
        at = to


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and where each row's words begin in those lists."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    full = ~SPACE[data]
    before = np.empty_like(full)
    before[0] = False
    before[1:] = full[:-1]
    after = np.empty_like(full)
    after[-1] = False
    after[:-1] = full[1:]
    begin = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[begin] = False
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    after[last] = False
    starts = np.flatnonzero(full & ~before)
    ends = np.flatnonzero(full & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _power(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_CODE[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def shingle_hashes(words_: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """All k-word shingles by row, repeats included; a row of 1 to k-1 words has its whole sequence as one.

    Returns hashes and where each row's begin.
    """
    counts = np.diff(bounds)
    n = len(words_)
    sums = np.zeros(n, np.uint64)
    for j in range(k):
        if n > j:
            sums[: n - j] += words_[j:] * _SALT[j]
    short = np.flatnonzero((counts > 0) & (counts < k))
    keep = np.zeros(n, bool)
    lengths = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    # rows of k words or more: all positions but the last k - 1
    keep[:] = True
    for j in range(1, k):
        at = bounds[1:] - j
        ok = at >= bounds[:-1]
        keep[at[ok]] = False
    for r in short:
        a, b = bounds[r], bounds[r + 1]
        sums[a] = np.append(words_[a:b] * _SALT[: b - a], _SALT[32 + (b - a)]).sum(dtype=np.uint64)
        keep[a] = True
        keep[a + 1 : b] = False
    return mix(sums[keep]), np.concatenate([[0], np.cumsum(lengths)])


def batches(rows: pa.RecordBatch, name: str = "text") -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from row, to row, bytes, offsets) of slices of a batch."""
    data, offsets = raw(rows.column(name))
    for a, b in slices(offsets):
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
