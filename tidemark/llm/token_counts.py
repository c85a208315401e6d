"""Token counts of whole texts without token ids.

Texts are split into pre-tokens once; chunks of documents keep how often each
document has each pre-token, by its place in the chunk's list of distinct ones.
The lists are dealt by pre-token over the cluster, where the pieces of every
distinct pre-token of the corpus are counted once, and the counts return to the
chunks that asked, as one small body for each. There they are joined to the
documents' frequencies and summed.

Null texts count as empty: 0 bytes, 0 tokens. Texts are never cut or padded.
Strings of special tokens inside a text count as the library's default has
them: one token each. Repeated rows and null ids are counted each. Columns
other than doc_id and text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._boxes import boxed, unboxed
from tidemark.llm._text import raw, slices
from tidemark.plans.scratch import freed, written
from tidemark.sources.tables import table

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
CHUNK_TOKENS = 250_000  # distinct pre-tokens, and
CHUNK_FREQUENCIES = 2_000_000  # frequencies, beyond which a chunk ends
TASK_TOKENS = 400_000  # pre-tokens of chunks that a task counts
ENCODED_AT_ONCE = 5_000
SLICE_BYTES = 500_000
SIMPLE = "ɐ"  # below it, this module's own splitting is the library's


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceCounter:
    """Counts of a word-level BPE of the `tokenizers` library: lower-casing, white space dropped, pieces within a pre-token."""

    def __init__(self, path: str):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share a machine's cores already, and threads would each hold memory
        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            shape = json.load(f)
        split = shape["pre_tokenizer"]["pretokenizers"][0]
        self.pattern = regex.compile(split["pattern"]["Regex"])
        special = [t["content"] for t in shape["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.marks = {s[:2] for s in special}

    def pre_tokens(self, text: str) -> list[str]:
        """The pre-tokens of a text without special strings."""
        if text.isascii() or max(text) < SIMPLE:
            return self.pattern.findall(unicodedata.normalize("NFC", text).lower())
        plain = self.library.normalizer.normalize_str(text)
        return [plain[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(plain)]

    def frequencies(self, text: str) -> tuple[Counter, int]:
        """How often a text has each pre-token, and its special tokens."""
        if not text:
            return Counter(), 0
        if self.special is None or not any(m in text for m in self.marks):
            return Counter(self.pre_tokens(text)), 0
        found, at, n = Counter(), 0, 0
        for m in self.special.finditer(text):
            if text[at : m.start()]:
                found.update(self.pre_tokens(text[at : m.start()]))
            at, n = m.end(), n + 1
        if text[at:]:
            found.update(self.pre_tokens(text[at:]))
        return found, n

    def pieces(self, tokens: list[str]) -> np.ndarray:
        """How many pieces each pre-token has."""
        out = np.zeros(len(tokens), np.int64)
        for at in range(0, len(tokens), ENCODED_AT_ONCE):
            part = tokens[at : at + ENCODED_AT_ONCE]
            out[at : at + len(part)] = [len(e) for e in self.library.encode_batch_fast(part, add_special_tokens=False)]
        return out

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of texts that lie here, without a corpus."""
        own = [self.frequencies(t) for t in texts]
        tokens = list(set().union(*(f.keys() for f, _ in own)) if own else set())
        known = dict(zip(tokens, self.pieces(tokens).tolist(), strict=True))
        return [sum([known[t] * n for t, n in f.items()]) + special for f, special in own]


_counters: dict[str, PieceCounter] = {}


def counter_of(path: str) -> PieceCounter:
    """The worker's counter, which its tasks share: a function of the module, so that it isn't copied with each task."""
    if path not in _counters:
        _counters[path] = PieceCounter(path)
    return _counters[path]


class Chunk:
    """Documents and how often each has which of the chunk's distinct pre-tokens."""

    def __init__(self):
        self.place: dict[str, int] = {}
        self.docs: list[tuple[int, bool, int, int, int]] = []  # id, whether there is one, bytes, special tokens, distinct pre-tokens
        self.at, self.times = array("i"), array("i")

    def add(self, doc_id: int | None, n_bytes: int, found: Counter, special: int) -> None:
        place = self.place
        self.at.extend([place.setdefault(t, len(place)) for t in found])
        self.times.extend(found.values())
        self.docs.append((doc_id or 0, doc_id is not None, n_bytes, special, len(found)))

    def rows(self, chunk: int) -> pa.RecordBatch:
        """The documents' frequencies, then the pre-tokens by place."""
        docs, at = np.array(self.docs, np.int64).reshape(-1, 5), np.array(self.at, np.int32)
        order = np.lexsort((at, np.repeat(np.arange(len(docs)), docs[:, 4])))  # places that ascend have small steps
        body = boxed(docs.reshape(-1), np.diff(at[order], prepend=np.int32(0)), np.array(self.times, np.int32)[order])
        n = len(self.place)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n + 1, chunk)), pa.array([body, *[None] * n], pa.binary()), pa.array([None, *range(n)], pa.int32()), pa.array([None, *self.place], pa.string())], ["chunk", "body", "place", "token"]
        )


def split(path: str):
    """(doc_id, text) -> chunks: (chunk, body, place, token)."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, chunk, number = counter_of(path), Chunk(), TaskContext.get().partitionId() << 32
        for batch in rows:
            _, offsets = raw(batch.column("text"))
            for a, b in slices(offsets, SLICE_BYTES):
                texts, ids = batch.column("text").slice(a, b - a).to_pylist(), batch.column("doc_id").slice(a, b - a).to_pylist()
                for i, text, size in zip(ids, texts, np.diff(offsets[a : b + 1]).tolist(), strict=True):
                    chunk.add(i, size, *counter.frequencies(text or ""))
                if len(chunk.place) > CHUNK_TOKENS or len(chunk.at) > CHUNK_FREQUENCIES:
                    yield chunk.rows(number)
                    chunk, number = Chunk(), number + 1
        if chunk.docs:
            yield chunk.rows(number)

    return run


def counted(path: str):
    """Rows (chunk, place, token), all of a pre-token in one task -> (chunk, body): the places and their pieces; each distinct pre-token is counted once."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = [(b.column("chunk"), b.column("place"), b.column("token")) for b in rows if len(b)]
        if not have:
            return
        chunk, place = (np.concatenate([x[c].to_numpy() for x in have]) for c in (0, 1))
        token = pa.chunked_array([x[2] for x in have]).combine_chunks().dictionary_encode()
        del have
        pieces = counter_of(path).pieces(token.dictionary.to_pylist())[token.indices.to_numpy()]
        order = np.lexsort((place, chunk))
        chunk, place, pieces = chunk[order], place[order], pieces[order]
        cuts = np.flatnonzero(chunk[1:] != chunk[:-1]) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(chunk)], strict=True):
            body = boxed(np.diff(place[lo:hi], prepend=np.int32(0)).astype(np.int32), pieces[lo:hi].astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array([chunk[lo]], pa.int64()), pa.array([body], pa.binary())], ["chunk", "body"])

    return run


def summed(limit: int):
    """Rows (chunk, kind, body), ordered by both: a chunk's pieces (0), then its documents' frequencies (1) -> token counts."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, parts = None, []
        for batch in rows:
            for i, (chunk, kind) in enumerate(zip(batch.column("chunk").to_pylist(), batch.column("kind").to_pylist(), strict=True)):
                if chunk != last:
                    last, parts = chunk, []
                got = unboxed(batch.column("body")[i].as_py())
                if kind == 0:
                    parts.append((np.cumsum(got[0]), got[1]))
                    continue
                docs, at, times = got[0].reshape(-1, 5), np.cumsum(got[1], dtype=np.int32), got[2]
                pieces = np.zeros(int(at.max(initial=-1)) + 1, np.int64)
                for place, n in parts:
                    pieces[place] = n
                owner = np.repeat(np.arange(len(docs)), docs[:, 4])
                n = np.bincount(owner, pieces[at] * times, len(docs)).astype(np.int64) + docs[:, 3]
                yield pa.RecordBatch.from_arrays([pa.array(docs[:, 0], mask=docs[:, 1] == 0), pa.array(docs[:, 2]), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return run


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row; `path` is the vocabulary file on the executors."""
    path = path or vocabulary_path()
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chunks = written(named.mapInArrow(split(path), "chunk long, body binary, place int, token string"), "token-chunks")
    asked = chunks.where("place is not null").select("chunk", "place", "token")
    n, bodies = chunks.agg(F.count("place"), F.count("body")).first()
    # written, so that the pre-tokens' shuffle files can go before the frequencies are dealt
    pieces = written(asked.repartition(max(1, -(-n // TASK_TOKENS)), "token").mapInArrow(counted(path), "chunk long, body binary"), "token-pieces")
    freed(docs.sparkSession)
    both = pieces.select("chunk", F.lit(0).alias("kind"), "body").unionByName(chunks.where("body is not null").select("chunk", F.lit(1).alias("kind"), "body"))
    dealt = both.repartition(max(1, bodies), "chunk").sortWithinPartitions("chunk", "kind")
    return dealt.mapInArrow(summed(limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op5_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
