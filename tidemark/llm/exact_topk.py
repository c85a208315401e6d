"""Exact top-k search by Fagin's threshold algorithm over sorted per-dimension lists.

Candidates are dealt into hash blocks of bounded size. A block sorts its ids
by every dimension; a query reads all lists downwards together, from the end
its weight's sign asks for, scores each id it meets for the first time by its
whole vector, and stops once the bound, the score of a vector made of the
values last read, cannot beat its kth score.

A query first searches the block of its own id; depths grow fourfold there.
Its kth score of that block, the floor, goes with it to all other blocks: the
bounds then tell at once how deep it has to read there. Where the bound of the
lists' tops is below the floor the block is skipped; where reading so deep
would meet most ids, the block is scored as one matrix product with all such
queries. Only hits that reach the floor leave a block, k a query at most; the
best k of all blocks are the answer.

Components x become floor(64 * x), x as double; scores are integer inner
products, exact at any size; those beyond the range of a long are returned and
ranked as its ends. Ties go to the smaller id. A vector that is null or holds a
null or non-finite component takes no part, as query or candidate; a null id
neither. Rows that repeat an id count once, with their least vector. A vector
shorter than another counts as if 0 followed. Empty tables give an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.scratch import written
from tidemark.sources.tables import table

K = 20
BLOCK_ROWS = 8192
FIRST_DEPTH = 64
QUERIES_AT_ONCE = 256
DENSE = 4  # a query that may meet more than 1 in so many ids is scored against all
MOST = 2**63 - 1
HIT = "query_id long, vec_id long, score long"


class SortedLists:
    """A block's vectors and, for each dimension, its ids by descending value."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.lists = np.ascontiguousarray(np.argsort(-self.vectors, axis=0, kind="stable").T.astype(np.int32))
        self.values = np.ascontiguousarray(np.take_along_axis(self.vectors, self.lists.T.astype(np.int64), axis=0).T)
        self.most = float(np.abs(self.vectors).max()) if self.vectors.size else 0.0
        with np.errstate(over="ignore"):  # not used where scores are so large
            self.small = self.vectors.astype(np.float32)
        self.whole: list[list[int]] | None = None

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best other than `own`."""
        n = len(self.ids)
        reach = self.most * float(np.abs(query).sum())
        if reach >= 2**53:
            return self.top_of_whole_numbers(query, own, k)
        vectors, q = (self.small, query.astype(np.float32)) if reach < 2**24 else (self.vectors, query)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        seen = np.zeros(n, bool)
        done = np.zeros(n, bool)
        place = np.searchsorted(self.ids, own)
        if place < n and self.ids[place] == own:
            done[place] = True
        ids, scores = np.zeros(0, np.int64), np.zeros(0)
        depth = FIRST_DEPTH
        while True:
            depth = min(depth, n)
            seen[self.lists[up, :depth].ravel()] = True
            seen[self.lists[down, n - depth :].ravel()] = True
            if depth == n:
                seen[:] = True
            new = np.flatnonzero(seen & ~done)
            done[new] = True
            got = (vectors[new] if len(new) < n else vectors) @ q
            if len(got) > k:
                least = np.partition(got, len(got) - k)[len(got) - k]
                if len(scores) == k:
                    least = max(least, scores[-1])
                kept = got >= least
                new, got = new[kept], got[kept]
            ids, scores = np.concatenate([ids, new]), np.concatenate([scores, got.astype(np.float64)])
            best = np.lexsort((ids, -scores))[:k]  # ids of the block ascend, so places order as they do
            ids, scores = ids[best], scores[best]
            if depth == n:
                break
            bound = float(query[up] @ self.values[up, depth - 1] + query[down] @ self.values[down, n - depth])
            if len(scores) == k and bound < scores[-1]:
                break
            if done.sum() >= n:
                break
            depth *= 4
        return self.ids[ids], scores


    def top_of_whole_numbers(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Like `top`, for scores that doubles cannot hold: Python's integers, brought into the range of a long."""
        if self.whole is None:
            self.whole = [[int(x) for x in v] for v in self.vectors]
        q = [int(x) for x in query]
        scores = np.array([max(-MOST, min(MOST, sum(a * b for a, b in zip(q, v, strict=True)))) for v in self.whole], np.int64)
        at = np.flatnonzero(self.ids != own)
        best = at[np.lexsort((self.ids[at], -scores[at]))][:k]
        return self.ids[best], scores[best]

    def reaching(self, queries: np.ndarray, floors: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, ids, scores) of the k best that reach each query's floor, for queries that are not of this block; -inf: no floor."""
        n = len(self.ids)
        depths = np.unique(np.concatenate([2 ** np.arange(max(n, 1).bit_length()), [n]]))
        depths = depths[depths <= n]
        for lo in range(0, len(queries), QUERIES_AT_ONCE):
            q, floor = queries[lo : lo + QUERIES_AT_ONCE], floors[lo : lo + QUERIES_AT_ONCE]
            reach = self.most * np.abs(q).sum(1)
            huge = np.flatnonzero(reach >= 2**53)
            for i in huge:
                ids, scores = self.top_of_whole_numbers(q[i], -1, k)
                yield lo + int(i), ids, scores
            up, down = np.maximum(q, 0), np.minimum(q, 0)
            with np.errstate(over="ignore", invalid="ignore"):
                bound = up @ self.values[:, depths - 1] + down @ self.values[:, n - depths]
            stops = bound < floor[:, None]
            done = np.where(stops.any(1), depths[stops.argmax(1)], n)
            done[stops[:, 0]] = 0  # not even the lists' tops reach the floor
            done[huge] = 0
            width = np.maximum((q != 0).sum(1), 1)
            some = (done > 0) & (done * width * DENSE < n)
            for i in np.flatnonzero(some):
                d = int(done[i])
                near = np.unique(np.concatenate([self.lists[q[i] > 0, :d].ravel(), self.lists[q[i] < 0, n - d :].ravel()]))
                yield lo + int(i), *self.best(near, self.vectors[near] @ q[i], floor[i], k)
            for small in (True, False):
                dense = np.flatnonzero((done > 0) & ~some & ((reach < 2**24) == small))
                if len(dense):
                    scores = (self.small if small else self.vectors) @ q[dense].T.astype(np.float32 if small else np.float64)
                    for j, i in enumerate(dense):
                        yield lo + int(i), *self.best(np.arange(n), scores[:, j], floor[i], k)

    def best(self, places: np.ndarray, scores: np.ndarray, floor: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(scores >= floor)
        places, scores = places[at], scores[at]
        if len(scores) > k:
            at = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            places, scores = places[at], scores[at]
        order = np.lexsort((places, -scores))[:k]  # ids of the block ascend, so places order as they do
        return self.ids[places[order]], scores[order].astype(np.float64)


def searched(k: int):
    """Rows (block, kind, vec_id, embedding, floor): a block's candidates (0), then queries of its own ids (1) or of others with their floors (2) -> hits."""

    def numbers(batch: pa.RecordBatch, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        column = batch.column("embedding").slice(lo, hi - lo)
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        width = int(lengths.max(initial=0))
        out = np.zeros((hi - lo, width))
        out[np.repeat(np.arange(hi - lo), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = np.floor(64 * flat)
        return batch.column("vec_id").slice(lo, hi - lo).to_numpy(), out

    def wide(m: np.ndarray, width: int) -> np.ndarray:
        return m if m.shape[1] >= width else np.pad(m, ((0, 0), (0, width - m.shape[1])))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, parts, lists = None, [], None
        for batch in rows:
            blocks, kinds = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero(np.diff(blocks * 3 + kinds)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(blocks)], strict=True):
                if lo == hi:
                    continue
                if blocks[lo] != last:
                    last, parts, lists = blocks[lo], [], None
                ids, vectors = numbers(batch, lo, hi)
                if kinds[lo] == 0:
                    parts.append((ids, vectors))
                    continue
                if not parts:
                    continue
                if lists is None:
                    width = max(v.shape[1] for _, v in parts)
                    lists = SortedLists(np.concatenate([i for i, _ in parts]), np.concatenate([wide(v, width) for _, v in parts]))
                width = lists.vectors.shape[1]
                queries = wide(vectors, width)[:, :width]
                if kinds[lo] == 1:
                    found = ((i, *lists.top(q, own, k)) for i, (own, q) in enumerate(zip(ids, queries, strict=True)))
                else:
                    floors = batch.column("floor").slice(lo, hi - lo).cast(pa.float64()).fill_null(float("-inf")).to_numpy(zero_copy_only=False)
                    found = lists.reaching(queries, floors, k)
                qs, hits, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for i, near, s in found:
                    qs.append(np.full(len(near), ids[i]))
                    hits.append(near)
                    scores.append(s.astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (qs, hits, scores)], ["query_id", "vec_id", "score"])

    return run


def finite(embedding: Column) -> Column:
    return embedding.isNotNull() & F.coalesce(F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))


def top_k(vectors: DataFrame, is_query: Column, k: int = K, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best of all other rows of (vec_id, embedding) for each query row."""
    good = vectors.where(F.col("vec_id").isNotNull() & finite(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    once = written(good.groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "topk-vectors")
    blocks = max(1, -(-once.count() // block_rows))
    home = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
    candidates = once.select(home.alias("block"), F.lit(0).alias("kind"), "vec_id", "embedding", F.lit(None).cast("long").alias("floor"))
    queries = once.where(is_query).select(home.alias("block"), "vec_id", "embedding")

    def hits(asked: DataFrame) -> DataFrame:
        # ranges of single blocks: hashes would put several into one task
        return candidates.unionByName(asked).repartitionByRange(blocks, "block").sortWithinPartitions("block", "kind").mapInArrow(searched(k), HIT)

    first = written(hits(queries.select("block", F.lit(1).alias("kind"), "vec_id", "embedding", F.lit(None).cast("long").alias("floor"))), "topk-home")
    floors = first.groupBy(F.col("query_id").alias("vec_id")).agg(F.count("*").alias("found"), F.min("score").alias("least"))
    floors = floors.where((F.col("found") >= k) & (F.abs("least") < 2**53)).select("vec_id", F.col("least").alias("floor"))
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")), lambda b: b != F.col("block"))
    asked = queries.join(floors.hint("merge"), "vec_id", "left").select(F.explode(others).alias("block"), F.lit(2).alias("kind"), "vec_id", "embedding", "floor")
    hits = first.unionByName(hits(asked))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return hits.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op9_exact_topk(spark, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP9_SQL = """
WITH good AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY vec_id),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(generate_series(1, len(q.v)), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM good q JOIN good c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""
