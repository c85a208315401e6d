"""Language-model scores by logistic context mixing.

A text is scored as its lower-cased words, each followed by a space, then an
end symbol. Each byte is coded in eight binary decisions. For each, five
predictors, one a hashed context, look up how often the training texts took
either side; gated weights mix their stretched probabilities, where the gate
is how sure two of the contexts are; a table over the mixed probability and
the partial byte refines the result.

- Contexts of a word's first `HEAD` bytes: the bytes of the word so far, with
  the last 0 to 3 bytes of the word before, and the last byte alone. Contexts
  of later bytes: the last 2 to 5 bytes of the word, and the whole word so far. So a text's probability is
  made of *units*: heads (the end of a word and the first bytes of the next)
  and whole words. Each distinct unit of the corpus is worked out once, however
  often it stands in the texts.
- Counts come from all training texts and are kept by key, never in slots that
  contexts share. They grow with the input and lie in buckets of keys, which no
  machine holds together: parts of the units, ranges of their bytes, ask the
  buckets for the counts of their own contexts.
- Weights and the refining table are learned online over all units of the
  training texts, each weighing as often as it stands there and its own
  occurrence left out of the counts. Every part learns for itself; the sums
  over parts, weighted by bytes, are the model.
- While a text is scored, the words it had so far refine the model: `EXPERTS`
  give them some of the probability, and are mixed online by how well each has
  predicted the text up to there. That mixture over a whole text is the mean of
  the experts' probabilities of it.

The word-frequency base score needs each token's count in the whole corpus,
which comes with the units. A chunk of documents asks for its own distinct
units, so no task or driver holds the vocabulary. Words are told apart by 63
bits of hash.

Null texts count as empty, which still have the end token. Repeated rows are
scored each, and rows are dealt by their place in the input, so that neither
repeated nor null ids meet. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import _text
from tidemark.llm._boxes import boxed, unboxed
from tidemark.plans.scratch import dropped, freed, written
from tidemark.sources.tables import table

CHUNK_ROWS = 8192
PART_ROWS = 300_000  # distinct units of chunks that a part collects
SLICE = 1 << 20
MOST_WAITING = 600_000  # units that wait before they are added up
HEAD, BACK = 3, 3
LONGEST = (0, 1, 2, None, 3)  # bytes of the word before that a head's contexts see; None: one byte in all
CONTEXTS = 5
END = 0xFF  # no byte of UTF-8
SPACE = 0x20
BATCH = 2048  # events a step of learning
FAN = 32  # mixers a task adds up
BLOCK = 1 << 15  # events scored at once
RATE, REFINED_PRIOR = 0.3, 16
GATES, BUCKETS = 32, 33
STEPS = 8  # of a stretched probability
EXPERTS = (0.0, 0.02, 0.1, 0.3)  # what the text's own words so far get of the probability
U = np.uint64
IS_HEAD = U(1 << 63)
_HASH = _text.mix(np.arange(CONTEXTS, dtype=np.uint64) + U(77)) | U(1)


def first_of_runs(sorted_: np.ndarray) -> np.ndarray:
    return np.concatenate([[True], sorted_[1:] != sorted_[:-1]]) if len(sorted_) else np.zeros(0, bool)


def runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of equal neighbours."""
    if len(values):
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        yield from zip([0, *cuts], [*cuts, len(values)], strict=True)


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, and the sum of each one's n."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys)
    keys = keys[order]
    at = np.flatnonzero(first_of_runs(keys))
    return keys[at], np.add.reduceat(n[order], at)


# texts as units


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Keys of all words and of all heads (a row's words, then its end), where each row's words begin, and the words as (lower-cased bytes, starts, ends)."""
    starts, ends, bounds = _text.words(data, offsets)
    low = _text.LOWER[data]
    keys = _text.word_hashes(data, starts, ends) & ~IS_HEAD
    n, rows = len(starts), len(offsets) - 1
    length = ends - starts
    tail, lead = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    for k in range(BACK):
        has = length > k
        tail[has] |= low[ends[has] - 1 - k].astype(np.uint64) << U(8 * k)
    for k in range(HEAD):
        has = length > k
        byte = np.where(length == k, np.uint64(SPACE), U(0))
        byte[has] = low[starts[has] + k]
        lead |= byte << U(8 * (HEAD - 1 - k))
    owner = np.repeat(np.arange(rows), np.diff(bounds))
    place = np.arange(n) + owner
    last = bounds[1:] + np.arange(rows)
    heads = np.empty(n + rows, np.uint64)
    heads[place], heads[last] = lead, U(END << (8 * (HEAD - 1)))
    before = np.zeros(n + rows, np.uint64)
    before[place + 1] = tail  # of a row's last word: before its end
    heads |= before << U(8 * HEAD)
    return keys, heads | IS_HEAD, bounds, (low, starts, ends)


def gathered_bytes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of all ranges, one after the other."""
    at = np.cumsum(lengths) - lengths
    return data[np.arange(int(lengths.sum())) + np.repeat(starts - at, lengths)]


class Units:
    """Distinct keys, how often training texts have each, and the words' bytes."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

    def __len__(self) -> int:
        return sum(len(p[0]) for p in self.parts)

    def add(self, keys: np.ndarray, n: np.ndarray, lengths: np.ndarray, data: np.ndarray) -> None:
        """Keys in any order; heads have length 0."""
        self.parts.append((keys, n, lengths, data))
        if len(self.parts) > 1 and len(self) - len(self.parts[0][0]) > MOST_WAITING:
            self.parts = [self.total()]

    def seen(self, data: np.ndarray, offsets: np.ndarray, training: np.ndarray) -> None:
        """All units of some rows."""
        keys, heads, bounds, (low, starts, ends) = tokens(data, offsets)
        words = np.diff(bounds)
        for k, times, is_word in ((keys, np.repeat(training, words), True), (heads, np.repeat(training, words + 1), False)):
            if not len(k):
                continue
            order = np.argsort(k)
            run = np.flatnonzero(first_of_runs(k[order]))
            n = np.add.reduceat(times[order].astype(np.int64), run)
            at = order[run]
            if is_word:
                lengths = ends[at] - starts[at]
                self.add(k[at], n, lengths, gathered_bytes(low, starts[at], lengths))
            else:
                self.add(k[at], n, np.zeros(len(at), np.int64), np.zeros(0, np.uint8))

    def total(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys, n, lengths and bytes."""
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)
        keys, n, lengths, data = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        starts = np.cumsum(lengths) - lengths
        order = np.argsort(keys, kind="stable")
        run = np.flatnonzero(first_of_runs(keys[order]))
        at = order[run]
        return keys[at], np.add.reduceat(n[order], run), lengths[at], gathered_bytes(data, starts[at], lengths[at])


GATHERED = "chunk long, key long, n long, word binary, docs long"


def gathered(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (chunk, text, training), a chunk's together -> each chunk's distinct units and their training counts; then the training documents."""
    units, last, docs = Units(), None, 0

    def flush() -> pa.RecordBatch:
        nonlocal units
        keys, n, lengths, data = units.total()
        units = Units()
        at = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        word = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(keys), [None, pa.py_buffer(at), pa.py_buffer(data)]).cast(pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), last, np.int64)), pa.array(keys.view(np.int64)), pa.array(n), word, pa.nulls(len(keys), pa.int64())], ["chunk", "key", "n", "word", "docs"])

    for batch in rows:
        data, offsets = _text.raw(batch.column("text"))
        chunks, training = batch.column("chunk").to_numpy(), np.asarray(batch.column("training"))
        docs += int(training.sum())
        for lo, hi in runs(chunks):
            if last is not None and last != chunks[lo]:
                yield flush()
            last = int(chunks[lo])
            for a, b in _text.slices(offsets[lo : hi + 1], SLICE):
                a, b = a + lo, b + lo
                units.seen(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], training[a:b])
                if len(units) > 4 * MOST_WAITING:  # what is asked twice is answered once
                    yield flush()
    if last is not None:
        yield flush()
    yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([docs], pa.int64())], ["chunk", "key", "n", "word", "docs"])


# units as events


class Events:
    """The coded bytes of units: what each context sees, with the byte as the lowest eight bits; how often; of which unit."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, lengths: np.ndarray, data: np.ndarray):
        codes: list[list[np.ndarray]] = [[] for _ in range(CONTEXTS)]
        owner, times = [], []
        at = np.flatnonzero(keys >= IS_HEAD)
        lead, back = keys[at] & U((1 << 8 * HEAD) - 1), (keys[at] & ~IS_HEAD) >> U(8 * HEAD)
        for j in range(HEAD):
            if j:  # unless the end or a space came before
                was = (lead >> U(8 * (HEAD - j))) & U(0xFF)
                on = was != U(SPACE) if j > 1 else was != U(END)
                at, lead, back = at[on], lead[on], back[on]
            so_far = lead >> U(8 * (HEAD - j))
            symbol = (lead >> U(8 * (HEAD - 1 - j))) & U(0xFF)
            for c, k in enumerate(LONGEST):
                if k is None:
                    seen = so_far & U(0xFF) if j else back & U(0xFF)
                else:
                    seen = (back & U((1 << 8 * k) - 1)) << U(16) | so_far
                codes[c].append(U(j) << U(56) | seen << U(8) | symbol)
            owner.append(at)
            times.append(n[at])
        long = np.flatnonzero(lengths >= HEAD)
        if len(long):
            size = lengths[long]
            # two zeros, the word, a space
            stream = np.zeros(int((size + 3).sum()), np.uint8)
            first = np.cumsum(size + 3) - size - 1
            stream[np.arange(int(size.sum())) + np.repeat(first - (np.cumsum(size) - size), size)] = gathered_bytes(data, (np.cumsum(lengths) - lengths)[long], size)
            stream[first + size] = SPACE
            count = size + 1 - HEAD
            place = np.arange(int(count.sum())) + np.repeat(first + HEAD - (np.cumsum(count) - count), count)
            x = stream.astype(np.uint64)
            seen = x[place]
            for k in range(1, 6):
                seen |= x[place - k] << U(8 * k)
                if k > 1:
                    codes[k - 2].append(U(HEAD) << U(56) | seen)
            up, down = _text._power(len(stream) + 1)
            total = np.zeros(len(stream) + 1, np.uint64)
            np.cumsum(_text._CODE[stream] * up[: len(stream)], out=total[1:])
            begin = np.repeat(first, count)
            so_far = _text.mix((total[place] - total[begin]) * down[begin])
            codes[4].append(U(HEAD) << U(56) | (so_far >> U(16)) << U(8) | seen & U(0xFF))
            owner.append(np.repeat(long, count))
            times.append(np.repeat(n[long], count))
        self.codes = [np.concatenate(c) for c in codes]
        self.owner, self.times = np.concatenate(owner), np.concatenate(times)

    def __len__(self) -> int:
        return len(self.owner)

    @property
    def symbol(self) -> np.ndarray:
        return (self.codes[0] & U(0xFF)).astype(np.uint8)

    @property
    def is_tail(self) -> np.ndarray:
        return self.codes[0] >> U(56) == U(HEAD)


    def distinct(self, c: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Context c's distinct codes and their counts, by bucket; where each bucket's begin; and each event's code. All codes of a context are in one bucket."""
        order = np.argsort(self.codes[c])
        first = first_of_runs(self.codes[c][order])
        at = np.flatnonzero(first)
        keys = self.codes[c][order][at]
        n = np.add.reduceat(self.times[order], at) if len(at) else np.zeros(0, np.int64)
        bucket = (((_text.mix((keys >> U(8)) * _HASH[c]) >> U(32)) * U(buckets)) >> U(32)).astype(np.int64)
        dealt = np.argsort(bucket, kind="stable")
        place = np.empty(len(keys), np.int32)
        place[dealt] = np.arange(len(keys), dtype=np.int32)
        code = np.empty(len(order), np.int32)
        code[order] = place[np.cumsum(first) - 1]
        return keys[dealt], n[dealt], np.searchsorted(bucket[dealt], np.arange(buckets + 1)), code


def dealt_asks(events: Events, buckets: int) -> Iterator[tuple[int, bytes]]:
    """What the events' contexts ask of each bucket: codes and counts."""
    cut = [events.distinct(c, buckets)[:3] for c in range(CONTEXTS)]
    for b in range(buckets):
        part = [(keys[s[b] : s[b + 1]], n[s[b] : s[b + 1]]) for keys, n, s in cut]
        if any(len(k) for k, _ in part):
            yield b, boxed(*[x for k, v in part for x in (np.diff(k, prepend=U(0)), v)])


def paths(keys: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For sorted distinct codes: the code's own count, then at each of the eight decisions the count of the side its byte does not take."""
    out = np.zeros((len(keys), 9), np.int64)
    if not len(keys):
        return out
    below = n
    out[:, 0] = n
    for bit in range(7, -1, -1):
        first = first_of_runs(keys >> U(8 - bit))
        total = np.add.reduceat(n, np.flatnonzero(first))[np.cumsum(first) - 1]
        out[:, 1 + bit] = total - below
        below = total
    return out


def stretched(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.log((n1 + np.float32(0.25)) / (n0 + np.float32(0.25))).astype(np.float32)


def steps(keys: np.ndarray, counts: np.ndarray, left_out: int) -> np.ndarray:
    """Along each code's path its stretched probabilities of a 1, in `STEPS`; `left_out` of the code's own count does not count."""
    other = counts[:, 1:].astype(np.float32)
    own = np.empty_like(other)
    own[:, 7] = np.maximum(counts[:, 0] - left_out, 0)
    for bit in range(6, -1, -1):
        own[:, bit] = own[:, bit + 1] + other[:, bit + 1]
    x = np.clip(np.rint(stretched(other, own) * STEPS), -127, 127).astype(np.int8)
    one = np.unpackbits((keys & U(0xFF)).astype(np.uint8)[:, None], axis=1)
    return np.where(one == 1, x, -x)


def answers(asked: list[list[np.ndarray]]) -> Iterator[bytes]:
    """What parts ask of one bucket -> for each, in the order of its codes, their steps, and how these change with one occurrence left out."""
    for_context = []
    for c in range(CONTEXTS):
        keys, n = summed(np.concatenate([np.cumsum(p[2 * c]) for p in asked]), np.concatenate([p[2 * c + 1] for p in asked]))
        counts = paths(keys, n)
        whole = np.ascontiguousarray(steps(keys, counts, 0))
        for_context.append((keys, whole.view(np.int64).reshape(-1), np.ascontiguousarray(steps(keys, counts, 1) - whole).view(np.int64).reshape(-1)))
    for p in asked:
        out = []
        for c, (keys, whole, change) in enumerate(for_context):
            at = np.searchsorted(keys, np.cumsum(p[2 * c]))
            out += [whole[at], change[at]]
        yield boxed(*out)


def answered(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, part, body), ordered by bucket: what parts ask -> the same, with the answers."""

    def done(bucket: int, who: list[int], asked: list) -> Iterator[pa.RecordBatch]:
        for part, body in zip(who, answers(asked), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([part], pa.int32()), pa.array([body], pa.binary())], ["bucket", "part", "body"])

    last, who, asked = None, [], []
    for batch in rows:
        for i, (bucket, part) in enumerate(zip(batch.column("bucket").to_pylist(), batch.column("part").to_pylist(), strict=True)):
            if bucket != last and asked:
                yield from done(last, who, asked)
                who, asked = [], []
            last = bucket
            who.append(part)
            asked.append(unboxed(batch.column("body")[i].as_py()))
    if asked:
        yield from done(last, who, asked)


OWN = -1  # the bucket of a part's own row
COLLECTED = "part int, bucket int, body binary, words long, known long"


def collected(buckets: int):
    """Rows (chunk, key, n, word) of a range of units, a part -> its units and which chunk has which (bucket `OWN`), with the sum of their words and how many of them training texts have; then what it asks of buckets."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, units, chunks, asked = TaskContext.get().partitionId(), Units(), [], []
        for batch in rows:
            data, offsets = _text.raw(batch.column("word"))
            keys = batch.column("key").to_numpy().view(np.uint64).copy()
            chunks.append(batch.column("chunk").to_numpy().copy())
            asked.append(keys)
            units.add(keys, batch.column("n").to_numpy().copy(), np.diff(offsets), data.copy())
        if not asked:
            return
        keys, n, lengths, data = units.total()
        place = np.searchsorted(keys, np.concatenate(asked)).astype(np.int32)
        who, chunk = np.unique(np.concatenate(chunks), return_inverse=True)
        order = np.lexsort((place, chunk))
        word = keys < IS_HEAD

        def row(bucket: int, body: bytes, words: int | None = None, known: int | None = None) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([bucket], pa.int32()), pa.array([body], pa.binary()), pa.array([words], pa.int64()), pa.array([known], pa.int64())], ["part", "bucket", "body", "words", "known"]
            )

        yield row(OWN, boxed(keys, n, lengths, data, who, np.bincount(chunk, minlength=len(who)), np.diff(place[order], prepend=np.int32(0))), int(n[word].sum()), int((n[word] > 0).sum()))
        for bucket, body in dealt_asks(Events(keys, n, lengths, data), buckets):
            yield row(bucket, body)

    return run


#: Heads in the order of the bytes before them, the last one first: those with contexts in common are neighbours.
HEAD_ORDER = " + ".join(f"shiftleft(shiftright(key, {8 * (HEAD + k)}) & 255, {8 * (HEAD + BACK - 1 - k)})" for k in range(BACK)) + f" + (key & {(1 << 8 * HEAD) - 1})"


# mixing


def inputs(events: Events, bodies: dict[int, bytes], buckets: int, left_out: bool) -> np.ndarray:
    """The steps of each event's contexts from the answers by bucket: (CONTEXTS, events, 8 decisions)."""
    out = np.zeros((CONTEXTS, len(events), 8), np.int8)
    parts = [unboxed(bodies[b]) for b in sorted(bodies)]
    for c in range(CONTEXTS):
        keys, _, _, code = events.distinct(c, buckets)
        values = np.concatenate([np.zeros(0, np.int64), *[p[2 * c] for p in parts]])
        if len(values) != len(keys):
            raise ValueError("answers are missing")
        values = values.view(np.int8)
        if left_out:
            values = values + np.concatenate([np.zeros(0, np.int64), *[p[2 * c + 1] for p in parts]]).view(np.int8)
        out[c] = values.reshape(-1, 8)[code]
    return out


def sure(x: np.ndarray) -> np.ndarray:
    a = np.abs(x)
    return (a > 0.3).astype(np.int8) + (a > 1.5) + (a > 3.5)


def gate(x: np.ndarray, is_tail: np.ndarray) -> np.ndarray:
    """Which set of weights: the kind of event, and how sure the longest and a middle context are; x is (CONTEXTS, ...)."""
    return is_tail * np.int8(16) + sure(x[4]) * np.int8(4) + sure(x[2])


def bucket_of(z: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(z * 2), -(BUCKETS // 2), BUCKETS // 2).astype(np.int32) + BUCKETS // 2


def decisions(symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(8, events): the partial byte before each decision, with a leading 1, and the decision."""
    bit = np.arange(8)[:, None]
    s = symbol[None].astype(np.int32)
    return (1 << bit) | (s >> (8 - bit)), (s >> (7 - bit)) & 1


CENTRE = np.tile((1 / (1 + np.exp(-(np.arange(BUCKETS) - BUCKETS // 2) / 2.0))).astype(np.float32), (256, 1))


class Mixer:
    """Gated weights and the refining table, and from how many bytes each was learned."""

    def __init__(self):
        self.weights = np.full((GATES, 8, CONTEXTS + 1), 0.3, np.float32)
        self.weights[..., -1] = 0
        self.mass = np.zeros((GATES, 8))
        self.ones, self.seen = np.zeros(256 * BUCKETS), np.zeros(256 * BUCKETS)
        self.taken = 0

    @property
    def refined(self) -> np.ndarray:
        return np.clip((CENTRE.reshape(-1) * REFINED_PRIOR + self.ones) / (REFINED_PRIOR + self.seen), 0.0005, 0.9995).astype(np.float32)

    def mixed(self, x: np.ndarray, is_tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Steps (CONTEXTS, events, 8) -> the mixed stretch (8, events), and the inputs (8, events, CONTEXTS + 1)."""
        full = np.ones((8, x.shape[1], CONTEXTS + 1), np.float32)
        full[:, :, :CONTEXTS] = x.transpose(2, 1, 0) * np.float32(1 / STEPS)
        known = gate(full[:, :, :CONTEXTS].transpose(2, 0, 1), is_tail)
        w = self.weights[known, np.arange(8)[:, None]]
        return np.clip(np.einsum("bec,bec->be", w, full), -12, 12), full, known

    def learn(self, events: Events, x: np.ndarray) -> None:
        """One online pass over the events of training texts, each weighing as often as it occurs."""
        on = np.flatnonzero(events.times > 0)
        order = on[np.random.default_rng(7).permutation(len(on))]
        symbol, tail = events.symbol, events.is_tail
        gates = np.arange(GATES)[None, :, None]
        for lo in range(0, len(order), BATCH):
            at = order[lo : lo + BATCH]
            t = events.times[at].astype(np.float32)
            z, full, known = self.mixed(x[:, at], tail[at])
            node, one = decisions(symbol[at])
            spot = (node * BUCKETS + bucket_of(z)).reshape(-1)
            weight = np.tile(t, 8)
            self.seen += np.bincount(spot, weight, len(self.seen))
            self.ones += np.bincount(spot, weight * one.reshape(-1), len(self.ones))
            own = (known[:, None, :] == gates).astype(np.float32) * t
            mass = own.sum(-1)
            slope = own @ ((one - 1 / (1 + np.exp(-z)))[:, :, None].astype(np.float32) * np.clip(full, -8, 8))
            self.weights += (RATE / math.sqrt(1 + self.taken / 16) * slope / np.maximum(mass, 1)[:, :, None]).transpose(1, 0, 2)
            self.mass += mass.T
            self.taken += 1

    def log2_probability(self, events: Events, x: np.ndarray) -> np.ndarray:
        """log2 of the probability of each event's byte."""
        out, flat = np.zeros(len(events)), self.refined
        symbol, tail = events.symbol, events.is_tail
        for lo in range(0, len(out), BLOCK):
            s = slice(lo, lo + BLOCK)
            z, _, _ = self.mixed(x[:, s], tail[s])
            node, one = decisions(symbol[s])
            p = (1 / (1 + np.exp(-z)) + flat[node * BUCKETS + bucket_of(z)]) / 2
            out[s] = np.log2(np.where(one == 1, p, 1 - p)).sum(0)
        return out

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        """What is added up over parts: weights by their bytes, then the refining table."""
        by = np.repeat(self.mass.reshape(-1), CONTEXTS + 1)
        return np.concatenate([self.weights.reshape(-1) * by, self.ones]), np.concatenate([by, self.seen])

    def put(self, a: np.ndarray, b: np.ndarray) -> None:
        """Take sums over parts; weights that nothing was learned for stay."""
        n = self.weights.size
        self.weights = np.where(b[:n] > 0, a[:n] / np.maximum(b[:n], 1e-9), self.weights.reshape(-1)).astype(np.float32).reshape(self.weights.shape)
        self.ones, self.seen = a[n:], b[n:]


def each_part(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray], dict[int, bytes]]]:
    """Rows (part, bucket, body), ordered by part: each part, its own row and its answers by bucket."""
    last, own, bodies = None, None, {}
    for batch in rows:
        for i, (part, bucket) in enumerate(zip(batch.column("part").to_pylist(), batch.column("bucket").to_pylist(), strict=True)):
            if part != last:
                if own is not None:
                    yield last, own, bodies
                last, own, bodies = part, None, {}
            body = batch.column("body")[i].as_py()
            if bucket == OWN:
                own = unboxed(body)
            else:
                bodies[bucket] = body
    if own is not None:
        yield last, own, bodies


SUMS = "part int, body binary"


def learned(buckets: int):
    """Each part's sums of a mixer."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, own, bodies in each_part(rows):
            mixer, events = Mixer(), Events(*own[:4])
            mixer.learn(events, inputs(events, bodies, buckets, True))
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([boxed(*mixer.sums())], pa.binary())], ["part", "body"])

    return run


def added(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, body), ordered by part -> one with the sum of all bodies' arrays, under the least part."""
    part, total = None, None
    for batch in rows:
        for p, body in zip(batch.column("part").to_pylist(), batch.column("body").to_pylist(), strict=True):
            new = unboxed(body)
            part, total = (p, new) if total is None else (part, [x + y for x, y in zip(total, new, strict=True)])
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([boxed(*total)], pa.binary())], ["part", "body"])


def sum_of(sums: DataFrame, parts: int) -> Mixer:
    """The mixer of all parts' sums, added up `FAN` at a time and in a fixed order."""
    span = 1
    while parts > FAN * span:
        span *= FAN
        sums = sums.repartitionByRange(-(-parts // span), F.expr(f"part div {span}")).sortWithinPartitions("part").mapInArrow(added, SUMS)
    mixer, total = Mixer(), None
    for r in sorted(sums.collect(), key=lambda r: r["part"]):  # at most FAN rows, but where the engine dealt them finer
        new = unboxed(r["body"])
        total = new if total is None else [x + y for x, y in zip(total, new, strict=True)]
    if total is not None:
        mixer.put(*total)
    return mixer


def worked_out(model, buckets: int):
    """(chunk, body) for each part and the chunks that have units of it: their keys, how often training texts have them, and the log2 of their probability. `model` is a broadcast."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer = model.value
        for _, own, bodies in each_part(rows):
            events = Events(*own[:4])
            keys, n, _, _, who, counts, place = own
            bits = np.bincount(events.owner, mixer.log2_probability(events, inputs(events, bodies, buckets, False)), len(keys)).astype(np.float32)
            place = np.cumsum(place, dtype=np.int32)
            for chunk, lo, hi in zip(who.tolist(), np.cumsum(counts) - counts, np.cumsum(counts), strict=True):
                at = place[lo:hi]
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([boxed(np.diff(keys[at], prepend=U(0)), n[at], bits[at])], pa.binary())], ["chunk", "body"])

    return run


# texts


def earlier(owner: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For each word how often its row had it before; words in the order of rows."""
    order = np.lexsort((np.arange(len(keys)), keys, owner)) if len(keys) else np.zeros(0, np.int64)
    first = first_of_runs(keys[order]) | first_of_runs(owner[order])
    at = np.arange(len(keys))
    out = np.empty(len(keys), np.int64)
    out[order] = at - np.maximum.accumulate(np.where(first, at, 0)) if len(keys) else 0
    return out


def text_bits(owner: np.ndarray, place: np.ndarray, keys: np.ndarray, word_bits: np.ndarray, end_bits: np.ndarray) -> np.ndarray:
    """log2 of each row's probability: its words' (owner, place in the row, key, log2 of the model's probability) and its end's, mixed by experts."""
    n = len(end_bits)
    share = earlier(owner, keys) / np.maximum(place, 1)
    total = np.zeros((len(EXPERTS), n))
    for e, own in enumerate(EXPERTS):
        if own:
            p = np.exp2(np.maximum(word_bits, -1000))
            with np.errstate(divide="ignore"):  # of very long words that are new, which take the other branch
                shared = np.log2((1 - own) * p + own * share)
            got = np.where(place > 0, np.where(share > 0, shared, word_bits + math.log2(1 - own)), word_bits)
            after = np.bincount(owner, minlength=n) > 0  # with no word so far there is nothing to share with
            total[e] = np.bincount(owner, got, n) + end_bits + np.where(after, math.log2(1 - own), 0)
        else:
            total[e] = np.bincount(owner, word_bits, n) + end_bits
    most = total.max(0)
    return most + np.log2(np.exp2(total - most).mean(0))


class Lookup:
    """Values by sorted 64-bit keys; all that is wanted must be there."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], [v[order] for v in values]

    def __call__(self, wanted: np.ndarray) -> list[np.ndarray]:
        at = np.searchsorted(self.keys, wanted)
        if len(wanted) and (not len(self.keys) or int(at.max()) >= len(self.keys) or (self.keys[at] != wanted).any()):
            raise ValueError("a unit was not asked for")
        return [v[at] for v in self.values]


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double"


def scored(total: int, vocabulary: int, ends: int):
    """Rows of a chunk: first its units (kind 0), then its texts (kind 1) -> scores."""
    scale = math.log10(total + 0.5 * (vocabulary + 1))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, parts, look = None, [], None
        for batch in rows:
            chunks, kinds = batch.column("chunk").to_numpy(), batch.column("kind").to_numpy()
            data, offsets = _text.raw(batch.column("text"))
            for lo, hi in runs(chunks * 2 + kinds):
                if chunks[lo] != last:
                    last, parts, look = chunks[lo], [], None
                if not kinds[lo]:
                    for body in batch.column("body").slice(lo, hi - lo).to_pylist():
                        found, c, bits = unboxed(body)
                        parts.append((np.cumsum(found), c, bits))
                    continue
                if look is None:
                    look = Lookup(*[np.concatenate(x) for x in zip(*parts, strict=True)])
                    parts = []
                for a, b in _text.slices(offsets[lo : hi + 1], SLICE):
                    a, b = a + lo, b + lo
                    keys, heads, bounds, (_, starts, ends_) = tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                    words = np.diff(bounds)
                    owner = np.repeat(np.arange(b - a), words)
                    c, bits = look(keys)
                    _, head_bits = look(heads)
                    at = np.arange(len(keys)) + owner
                    score = text_bits(owner, np.arange(len(keys)) - bounds[owner], keys, bits + head_bits[at], head_bits[bounds[1:] + np.arange(b - a)])
                    base = np.bincount(owner, np.log10(c + 0.5), b - a) + math.log10(ends + 0.5) - (words + 1) * scale
                    length = np.bincount(owner, ends_ - starts + 1, b - a).astype(np.int64) + 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").slice(a, b - a),
                            batch.column("held_out").slice(a, b - a),
                            pa.array(words + 1),
                            pa.array((np.bincount(owner, c > 0, b - a) + (ends > 0)).astype(np.int64)),
                            pa.array(np.full(b - a, total)),
                            pa.array(base),
                            pa.array(score * math.log10(2)),
                            pa.array(length),
                            pa.array(-score / length),
                        ],
                        ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte"],
                    )

    return run


def null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def score(docs: DataFrame, held_out: Column, chunk_rows: int = CHUNK_ROWS, part_rows: int = PART_ROWS) -> DataFrame:
    """Base and model scores of every row of (doc_id, text), learned from those where `held_out` is false.

    `n_bytes` counts the coded bytes (each word with its space, and the end);
    `bits_per_byte` is the text's total over them.
    """
    spark = docs.sparkSession
    rows = written(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce("text", F.lit("")).alias("text"),
            held_out.alias("held_out"),
            (~held_out).alias("training"),
            # a partition's rows in chunks; as written, so that they stay
            F.expr(f"(shiftright(monotonically_increasing_id(), 33) << 33) + (monotonically_increasing_id() & 8589934591L) div {chunk_rows}").alias("chunk"),
        ),
        "lm-texts",
    )
    raw = written(rows.select("chunk", "text", "training").mapInArrow(gathered, GATHERED), "lm-gathered")
    n, chunks, ends = raw.agg(F.count("key"), F.countDistinct("chunk"), F.sum("docs")).first()
    parts = max(1, -(-n // part_rows))
    # words by their bytes, heads by theirs: what a part asks has many contexts in common
    ranged = raw.where("key is not null").select("chunk", "key", "n", "word").repartitionByRange(parts, F.col("word"), F.expr(HEAD_ORDER))
    units = written(ranged.mapInArrow(collected(parts), COLLECTED), "lm-units")
    del ranged
    dropped(raw)
    freed(spark)
    words, known_words = units.agg(F.sum("words"), F.sum("known")).first()
    total, vocabulary = int(words or 0) + int(ends or 0), int(known_words or 0) + (1 if ends else 0)
    asks = units.where(f"bucket <> {OWN}").select("bucket", "part", "body")
    known = written(asks.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(answered, "bucket int, part int, body binary"), "lm-known")
    del asks
    freed(spark)

    own = units.where(f"bucket = {OWN}").select("part", "bucket", "body").unionByName(known.select("part", "bucket", "body"))
    own = own.repartition(parts, "part").sortWithinPartitions("part")
    model = spark.sparkContext.broadcast(sum_of(own.mapInArrow(learned(parts), SUMS), parts))
    freed(spark)
    found = written(own.mapInArrow(worked_out(model, parts), "chunk long, body binary"), "lm-found")
    del own
    for done in (units, known):
        dropped(done)
    freed(spark)

    look = found.select("chunk", F.lit(0).alias("kind"), "body", null("long").alias("doc_id"), null("boolean").alias("held_out"), null("string").alias("text"))
    texts = rows.select("chunk", F.lit(1).alias("kind"), null("binary").alias("body"), "doc_id", "held_out", "text")
    both = look.unionByName(texts).repartition(max(1, chunks // 2), "chunk").sortWithinPartitions("chunk", "kind")
    return both.mapInArrow(scored(total, vocabulary, int(ends or 0)), SCORED)


def op7_lm_scoring(spark, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5, F.lit(0)) == 1
    return score(table(spark, sf_dir, "documents"), held_out)
