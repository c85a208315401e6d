"""Count tables of fixed size, filled by tasks and summed piece by piece."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

PIECE = 1 << 17


def squeezed(part: np.ndarray) -> bytes:
    """Counts as compressed bytes, those of 255 and over listed behind."""
    over = np.flatnonzero(part >= 255)
    plain = np.minimum(part, 255).astype(np.uint8).tobytes() + over.astype(np.uint32).tobytes() + part[over].astype(np.uint32).tobytes()
    return zlib.compress(plain + np.uint32(len(part)).tobytes(), 1)


def unsqueezed(body: bytes) -> np.ndarray:
    plain = zlib.decompress(body)
    n = int(np.frombuffer(plain[-4:], np.uint32)[0])
    out = np.frombuffer(plain, np.uint8, n).astype(np.uint32)
    rest = np.frombuffer(plain[n:-4], np.uint32)
    out[rest[: len(rest) // 2]] = rest[len(rest) // 2 :]
    return out


def pieces(flat: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The pieces of a task's table that hold anything."""
    for i in range(0, len(flat), PIECE):
        part = flat[i : i + PIECE]
        if part.any():
            yield i // PIECE, squeezed(part)


def _summed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (piece, body), ordered by piece -> one summed body a piece; one piece is held at a time."""

    def out(piece: int, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([squeezed(np.minimum(total, 0xFFFFFFFF).astype(np.uint32))], pa.binary())], ["piece", "body"])

    last, total = None, None
    for batch in rows:
        for piece, body in zip(batch.column("piece").to_pylist(), batch.column("body").to_pylist(), strict=True):
            part = unsqueezed(body).astype(np.uint64)
            if piece != last:
                if last is not None:
                    yield out(last, total)
                last, total = piece, part
            else:
                total += part
    if last is not None:
        yield out(last, total)


def total_table(parts: DataFrame, size: int, tasks: int) -> np.ndarray:
    """The sum of all tasks' tables of `size` counts from their pieces (piece, body): a fixed amount, read piece by piece."""
    n = max(1, min(tasks, -(-size // PIECE)))
    summed = parts.select("piece", "body").repartition(n, "piece").sortWithinPartitions("piece").mapInArrow(_summed, "piece int, body binary")
    out = np.zeros(size, np.uint32)
    for r in summed.toLocalIterator():  # a row for each PIECE counts
        part = unsqueezed(r["body"])
        out[r["piece"] * PIECE : r["piece"] * PIECE + len(part)] = part
    return out
