"""N-gram Jaccard join: linked documents and their components, exactly, by prefix lists and set relations.

Texts with the same shingle set are one class, and only classes are joined.
Shingles are ordered by how common their hash bucket is, rarest first; two
sets that link share one of their first few shingles in that order, so each
such shingle's inverted list holds all candidates. Lists are ordered by the
shingle's position in the sets; the position and the sizes bound the overlap,
by which pairs, and whole blocks of a list against each other, are skipped.

Set relations save most of the rest. Each list's first set is its pivot, and
the others are verified against it alone. What that proves to be in one
component needs no more answers. Other pairs of a list are skipped where the
known overlaps with a common pivot already exclude a link: of two sets x, y
with overlaps p, q with it, no more than min(p, q) + min(|x| - p, |y| - q)
can be common. Where x and y are both similar to their pivot p, their overlap
is derived from what they differ in from p, without reading the sets:
|x y| = |p y| - |p-x| + |(p-x)(p-y)| + |(x-p)(y-p)|.
All pairs left are verified, so no link is lost; a list is worked off in pairs
of hash blocks of bounded size.

Before sets are fetched, a pair's overlap is bounded by how many shingles each
set has in every one of `SPREAD` classes of hashes: the sum of the lesser
counts. Pairs that merely share a common shingle end there.

Texts are one class where the 64-bit names of their sets agree, which depend
on all hashes and their number.

A set holds fewer than 2**32 shingles.

Defined cases: a text of fewer words than a shingle has its whole sequence as
one shingle; an empty or null text has none and links with nothing; repeated
rows are linked as equal texts are; a row with a null id takes no part and
has a null component. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import _tables, _text
from tidemark.operators.graph import connected_components
from tidemark.plans.scratch import cut, dropped, written
from tidemark.sources.tables import table

BUCKET_BITS = 20
LIST_BLOCK = 2048
HOLD = 4096
SPREAD = 64
FULL = 0xFFFF  # a class count that stands for more, too
MOST_BROADCAST = 1_000_000
U = np.uint64


class Threshold(NamedTuple):
    """Link where den * intersection >= num * union, of `shingle`-word sets."""

    shingle: int = 3
    num: int = 90
    den: int = 100


def doc_sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct shingle hashes of each row) of slices of a batch."""
    for a, _, data, offsets in _text.batches(batch):
        starts, ends, bounds = _text.words(data, offsets)
        hashes, at = _text.shingle_hashes(_text.word_hashes(data, starts, ends), bounds, k)
        sets = []
        for i, j in zip(at[:-1], at[1:], strict=True):
            s = np.sort(hashes[i:j])
            sets.append(s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s)
        yield a, sets


def class_of(sets: list[np.ndarray]) -> np.ndarray:
    """A 64-bit name of each set."""
    out = np.zeros(len(sets), np.uint64)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    sizes = np.array([len(s) for s in sets], np.int64)
    if len(flat):
        full = np.flatnonzero(sizes)
        at = (np.cumsum(sizes) - sizes)[full]
        a = np.add.reduceat(_text.mix(flat), at)
        b = np.bitwise_xor.reduceat(flat * _text._SALT[50], at)
        out[full] = _text.mix(a * _text._SALT[51] + _text.mix(b) + sizes[full].astype(np.uint64))
    return out.view(np.int64)


def signatures(k: int):
    """(doc_id, text) -> (doc_id, n, cls) of each row, then the task's bucket counts as (piece, body)."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "cls", "piece", "body"]
        counts = np.zeros(1 << BUCKET_BITS, np.uint32)
        for batch in rows:
            for a, sets in doc_sets(batch, k):
                n = np.array([len(s) for s in sets], np.int64)
                if n.any():
                    counts += np.bincount((np.concatenate(sets) >> U(64 - BUCKET_BITS)).astype(np.int64), minlength=1 << BUCKET_BITS).astype(np.uint32)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, len(sets)), pa.array(n), pa.array(class_of(sets)), pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())], names)
        for piece, body in _tables.pieces(counts):
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([piece], pa.int32()), pa.array([body], pa.binary())], names)

    return run


def spread(sets: list[np.ndarray]) -> np.ndarray:
    """How many hashes of each set lie in each class: (sets, SPREAD)."""
    flat = (np.concatenate(sets) if sets else np.zeros(0, np.uint64)) * _text._SALT[52] >> U(64 - (SPREAD - 1).bit_length())
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    counts = np.bincount(owner * SPREAD + flat.astype(np.int64), minlength=len(sets) * SPREAD)
    return np.minimum(counts, FULL).astype(np.uint16).reshape(len(sets), SPREAD)


def prefixes(t: Threshold, levels: np.ndarray):
    """(doc_id, text) -> (cls, doc_id, n, tokens, spread): the first shingles of each set in the common order, and its class counts."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for a, sets in doc_sets(batch, t.shingle):
                out, keep = [], []
                for i, s in enumerate(sets):
                    if len(s):
                        size = len(s) + (-len(s) * t.num) // t.den + 1
                        order = (levels[(s >> U(64 - BUCKET_BITS)).astype(np.int64)] << U(56)) | (s >> U(8))
                        out.append(np.sort(order)[:size] if size >= len(s) else np.sort(np.partition(order, size - 1)[:size]))
                        keep.append(i)
                if not keep:
                    continue
                lengths = np.array([len(x) for x in out])
                tokens = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.array(np.concatenate(out).view(np.int64)))
                names = class_of(sets)[keep]
                ids = batch.column("doc_id").slice(a, len(sets)).take(pa.array(keep))
                counts = pa.array([c.tobytes() for c in spread([sets[i] for i in keep])], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(names), ids, pa.array(np.array([len(sets[i]) for i in keep], np.int64)), tokens, counts], ["cls", "doc_id", "n", "tokens", "spread"])

    return run


def whole_sets(k: int):
    """(doc_id, text) -> (cls, body): the sorted hashes as bytes."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for _, sets in doc_sets(batch, k):
                yield pa.RecordBatch.from_arrays([pa.array(class_of(sets)), pa.array([s.tobytes() for s in sets], pa.binary())], ["cls", "body"])

    return run


ANSWERED = "a long, b long, na long, nb long, both long, minus binary, plus binary"


def overlaps(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, salt, kind, b, body), ordered so that a's own set comes first -> a, b, their sizes and overlap; for similar ones (half of all shingles common) also a's hashes that b lacks and b's that a lacks."""
    held, own = None, np.zeros(0, np.uint64)
    for batch in rows:
        a, salt, kind, b = (batch.column(c).to_numpy() for c in ("a", "salt", "kind", "b"))
        data, offsets = _text.raw(batch.column("body"))
        flat, at = np.ascontiguousarray(data).view(np.uint64), offsets // 8
        cuts = np.flatnonzero((a[1:] != a[:-1]) | (salt[1:] != salt[:-1])) + 1
        out, minus, plus = [], [], []
        for lo, hi in zip([0, *cuts], [*cuts, len(a)], strict=True):
            if lo == hi:
                continue
            if kind[lo] == 0:
                held, own = (a[lo], salt[lo]), flat[at[lo] : at[lo + 1]].copy()
                lo += 1
            if lo == hi or held != (a[lo], salt[lo]):
                continue
            part = flat[at[lo] : at[hi]]
            place = np.searchsorted(own, part)
            place[place == len(own)] = 0
            hit = own[place] == part
            before = np.concatenate([[0], np.cumsum(hit)])
            ends = at[lo : hi + 1] - at[lo]
            both, size = before[ends[1:]] - before[ends[:-1]], np.diff(ends)
            out.append(np.stack([a[lo:hi], b[lo:hi], np.full(hi - lo, len(own)), size, both]))
            for i in range(hi - lo):
                if 2 * both[i] < len(own) + size[i] - both[i]:
                    minus.append(None)
                    plus.append(None)
                    continue
                row = slice(ends[i], ends[i + 1])
                lacks = np.ones(len(own), bool)
                lacks[place[row][hit[row]]] = False
                minus.append(own[lacks].tobytes())
                plus.append(part[row][~hit[row]].tobytes())
        if out:
            yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in np.concatenate(out, 1)], pa.array(minus, pa.binary()), pa.array(plus, pa.binary())], ["a", "b", "na", "nb", "both", "minus", "plus"])


def derived(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, na, nb, known, minus_a, plus_a, minus_b, plus_b) of sets with a common pivot, `known` being b's overlap with it -> (a, b, na, nb, both)."""
    for batch in rows:
        sets = [(batch.column(c)) for c in ("minus_a", "minus_b", "plus_a", "plus_b")]
        known, both = batch.column("known").to_numpy(), []
        for i in range(len(batch)):
            less_a, less_b, more_a, more_b = (np.frombuffer(c[i].as_py(), np.uint64) for c in sets)
            both.append(int(known[i]) - len(less_a) + len(np.intersect1d(less_a, less_b, True)) + len(np.intersect1d(more_a, more_b, True)))
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("a", "b", "na", "nb")], pa.array(both, pa.int64())], ["a", "b", "na", "nb", "both"])


def near_enough(t: Threshold):
    """Rows (a, b, na, nb, sa, sb) -> those (a, b) whose class counts allow a link."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            if not len(batch):
                continue
            x, y = (np.ascontiguousarray(_text.raw(batch.column(c))[0]).view(np.uint16).reshape(-1, SPREAD) for c in ("sa", "sb"))
            least = np.minimum(x, y)
            keep = (least.sum(1, dtype=np.int64) >= needed(batch.column("na").to_numpy(), batch.column("nb").to_numpy(), t)) | (least == FULL).any(1)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def needed(na, nb, t: Threshold):
    """The least overlap that links sets of these sizes: whole numbers, columns or arrays alike."""
    return ((na + nb) * t.num + (t.den + t.num - 1)) // (t.den + t.num)


def needed_column(na: Column, nb: Column, t: Threshold) -> Column:
    return F.ceil((na + nb) * t.num / (t.den + t.num))


def may_link(na: Column, pa_: Column, nb: Column, pb: Column, t: Threshold) -> Column:
    """Whether sets with a shingle at these positions (from 0), the first they share, can link."""
    sizes = F.least(na, nb) * t.den >= F.greatest(na, nb) * t.num
    return sizes & (F.least(na - pa_, nb - pb) * (t.den + t.num) >= (na + nb) * t.num)


def list_pairs(t: Threshold, step: int = 256):
    """Rows of list blocks (token, i, j, mine, cls, n, pos, label, pivot, known), ordered by list and position -> pairs left to verify.

    Blocks of `step` rows are skipped against each other by their sizes and
    positions, or where all of both have one label.
    """

    def pairs(g: dict[str, np.ndarray], i: int, j: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        m = len(g["cls"])
        room = g["n"] - g["pos"]
        cuts = range(0, m, step)
        ends = {x: min(x + step, m) for x in cuts}
        low = {x: (g["n"][x : ends[x]].min(), g["n"][x : ends[x]].max(), room[x : ends[x]].max(), g["label"][x : ends[x]].min(), g["label"][x : ends[x]].max()) for x in cuts}
        for x in cuts:
            for y in range(x, m, step):
                nx0, nx1, rx, lx0, lx1 = low[x]
                ny0, ny1, ry, ly0, ly1 = low[y]
                if nx1 * t.den < ny0 * t.num or ny1 * t.den < nx0 * t.num or min(rx, ry) < needed(nx0, ny0, t) or (lx0 == lx1 == ly0 == ly1):
                    continue
                p, q = slice(x, ends[x]), slice(y, ends[y])
                na, nb = g["n"][p][:, None], g["n"][q][None]
                need = needed(na, nb, t)
                ok = (np.minimum(na, nb) * t.den >= np.maximum(na, nb) * t.num) & (np.minimum(room[p][:, None], room[q][None]) >= need) & (g["label"][p][:, None] != g["label"][q][None])
                if i != j:
                    ok &= g["mine"][p][:, None] != g["mine"][q][None]
                if x == y:
                    ok = np.triu(ok, 1)
                same = (g["pivot"][p][:, None] == g["pivot"][q][None]) & (g["known"][p][:, None] >= 0) & (g["known"][q][None] >= 0)
                ka, kb = g["known"][p][:, None], g["known"][q][None]
                ok &= ~same | (np.minimum(ka, kb) + np.minimum(na - ka, nb - kb) >= need)
                r, c = np.nonzero(ok)
                if len(r):
                    a, b = g["cls"][p][r], g["cls"][q][c]
                    yield np.minimum(a, b), np.maximum(a, b)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ["mine", "cls", "n", "pos", "label", "pivot", "known"]
        key, parts = None, []

        def done() -> Iterator[pa.RecordBatch]:
            if key is not None and parts:
                g = {c: np.concatenate([p[c] for p in parts]) for c in columns}
                if g["label"].min() != g["label"].max():
                    for a, b in pairs(g, key[1], key[2]):
                        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in rows:
            token, i, j = (batch.column(c).to_numpy() for c in ("token", "i", "j"))
            data = {c: batch.column(c).to_numpy() for c in columns}
            cuts = np.flatnonzero((token[1:] != token[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(token)], strict=True):
                if lo == hi:
                    continue
                here = (token[lo], i[lo], j[lo])
                if here != key:
                    yield from done()
                    key, parts = here, []
                parts.append({c: v[lo:hi] for c, v in data.items()})
        yield from done()

    return run


def dealt(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the data: joined by shuffle and sort at every size, where large keys can be split."""
    return df.hint("merge")


def one_a_class(sets: DataFrame, most: int, name: str) -> DataFrame:
    """The written sets, each class once: where rows repeat an id and its text they come several times, and are more than `most`."""
    if sets.count() <= most:
        return sets
    out = written(sets.dropDuplicates(["cls"]), name)
    dropped(sets)
    return out


def bounded(pairs: DataFrame, sets: DataFrame, t: Threshold) -> DataFrame:
    """The pairs (a, b) whose class counts allow a link."""
    counts = sets.select("cls", "n", "spread")
    first = pairs.join(dealt(counts.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("spread").alias("sa"))), "a")
    both = first.join(dealt(counts.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("spread").alias("sb"))), "b")
    return both.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(near_enough(t), "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, t: Threshold) -> DataFrame:
    """(a, b, na, nb, both, minus, plus) of distinct pairs of classes: sets are fetched for these only, each a's in groups of bounded size."""
    sides = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
    wanted = cut(sides.join(classes, "cls").select(F.col("rep").alias("doc_id")).distinct())
    ids = wanted.count()
    if ids <= MOST_BROADCAST:  # one number a set; beyond, a shuffled join
        wanted = F.broadcast(wanted)
    sets = written(docs.join(wanted, "doc_id").select("doc_id", "text").mapInArrow(whole_sets(t.shingle), "cls long, body binary"), "join-sets")
    sets = one_a_class(sets, ids, "join-sets-once")
    salts = pairs.groupBy("a").agg(F.expr(f"cast(count(*) div {HOLD} as int)").alias("most"))
    held = salts.join(dealt(sets), F.col("a") == F.col("cls")).select("a", F.explode(F.sequence(F.lit(0), F.col("most"))).alias("salt"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("b"), "body")
    members = (
        pairs.join(dealt(salts), "a")
        .select("a", "b", F.pmod(F.xxhash64("b"), F.col("most") + 1).cast("int").alias("salt"))
        .join(dealt(sets), F.col("b") == F.col("cls"))
        .select("a", "salt", F.lit(1).alias("kind"), "b", "body")
    )
    both = held.unionByName(members).repartition("a", "salt").sortWithinPartitions("a", "salt", "kind")
    out = written(both.mapInArrow(overlaps, ANSWERED), "join-overlaps")
    dropped(sets)
    return out


def linked(found: DataFrame, t: Threshold) -> DataFrame:
    return found.where(F.col("both") * (t.den + t.num) >= (F.col("na") + F.col("nb")) * t.num).select(F.col("a").alias("src"), F.col("b").alias("dst"))


def similarity_components(docs: DataFrame, t: Threshold = Threshold()) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of (doc_id, text)."""
    return labelled(docs, t).select("doc_id", "n_shingles", "component_id")


def labelled(docs: DataFrame, t: Threshold) -> DataFrame:
    """doc_id, n_shingles, component_id, cls (the name of the row's set), label (of its component): a row's component where ids repeat."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    raw = written(docs.mapInArrow(signatures(t.shingle), "doc_id long, n long, cls long, piece int, body binary"), "join-signatures")
    own = raw.where("piece is null").select("doc_id", "n", "cls")
    classes = cut(own.where("n > 0 and doc_id is not null").groupBy("cls").agg(F.min("doc_id").alias("rep")))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = _tables.total_table(raw.where("piece is not null"), 1 << BUCKET_BITS, tasks)
    levels = np.minimum(np.rint(4 * np.log2(np.maximum(counts, 1))), 127).astype(np.uint64)

    first = docs.where("doc_id is not null").mapInArrow(prefixes(t, levels), "cls long, doc_id long, n long, tokens array<bigint>, spread binary")
    reps = classes.select("cls", F.col("rep").alias("doc_id"))
    sets = written(first.join(dealt(reps), ["cls", "doc_id"]).select("cls", "n", "tokens", "spread"), "join-prefixes")
    sets = one_a_class(sets, classes.count(), "join-prefixes-once")
    postings = sets.select("cls", "n", F.posexplode("tokens").alias("pos", "token"))
    # a list's pivot is the set in which its shingle comes first, then the smallest; position and size share a number
    rank = F.col("pos").cast("long") * (1 << 32) + F.col("n")
    lists = postings.groupBy("token").agg(F.count("*").alias("c"), F.min_by("cls", rank).alias("pivot"), F.min(rank).alias("rank")).where("c > 1")
    lists = lists.select("token", "c", "pivot", F.expr("rank & 4294967295L").alias("pivot_n"), F.expr("shiftright(rank, 32)").alias("pivot_pos"))
    listed = written(postings.join(dealt(lists), "token"), "join-lists")

    near = listed.where((F.col("cls") != F.col("pivot")) & may_link(F.col("n"), F.col("pos"), F.col("pivot_n"), F.col("pivot_pos"), t))
    pairs = written(near.select(F.col("pivot").alias("a"), F.col("cls").alias("b")).distinct(), "join-pairs")
    close = written(bounded(pairs, sets, t), "join-close")
    answers = verified(close, docs, classes, t)
    links = linked(answers, t)
    labels = connected_components(links).select(F.col("node").alias("cls"), F.col("component").alias("label"))

    # what pivots leave open: lists with several components
    best = answers.groupBy(F.col("b").alias("cls")).agg(F.max(F.struct("both", "a")).alias("best")).select("cls", F.col("best.a").alias("pivot"), F.col("best.both").alias("known"))
    state = cut(sets.select("cls").distinct().join(labels, "cls", "left").join(best, "cls", "left").select("cls", F.coalesce("label", "cls").alias("label"), F.coalesce("pivot", F.lit(0)).alias("pivot"), F.coalesce("known", F.lit(-1)).alias("known")))
    joined = listed.select("token", "c", "cls", "n", "pos").join(dealt(state), "cls")
    open_lists = joined.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("token")
    # sets whose shingle comes too late for any partner are no candidates
    left = joined.where((F.col("n") - F.col("pos")) * t.den >= F.col("n") * t.num).join(dealt(open_lists), "token")
    blocks = F.expr(f"cast(c div {LIST_BLOCK} as int)")
    mine = F.pmod(F.xxhash64("cls"), blocks + 1).cast("int")
    blocked = left.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), blocks)))
    blocked = blocked.select("token", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "cls", "n", F.col("pos").cast("long").alias("pos"), "label", "pivot", "known")
    more = blocked.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "pos", "n").mapInArrow(list_pairs(t), "a long, b long").distinct()
    more = written(more.join(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), ["a", "b"], "left_anti"), "join-more")
    more_close = written(bounded(more, sets, t), "join-more-close")
    for done in (sets, listed, more, pairs, close):  # what follows reads the close pairs only
        dropped(done)
    told = answers.where("minus is not null").join(best, (F.col("b") == F.col("cls")) & (F.col("a") == F.col("pivot"))).select("cls", "pivot", F.col("nb").alias("n"), F.col("both").alias("known"), "minus", "plus")
    x, y = (told.select(*[F.col(c).alias(c if c == side else f"{c}_{side}") for c in ("pivot", "n", "known", "minus", "plus")], F.col("cls").alias(side)) for side in ("a", "b"))
    common = more_close.join(dealt(x), "a").join(dealt(y), "b").where("pivot_a = pivot_b")
    by_pivot = written(common.select("a", "b", F.col("n_a").alias("na"), F.col("n_b").alias("nb"), F.col("known_b").alias("known"), "minus_a", "plus_a", "minus_b", "plus_b").mapInArrow(derived, "a long, b long, na long, nb long, both long"), "join-derived")
    rest = written(more_close.join(dealt(by_pivot.select("a", "b")), ["a", "b"], "left_anti"), "join-rest")
    links = links.union(linked(by_pivot, t)).union(linked(verified(rest, docs, classes, t), t))

    labels = connected_components(links).select(F.col("node").alias("cls"), F.col("component").alias("label"))
    named = classes.join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    least = named.groupBy("label").agg(F.min("rep").alias("component"))
    named = cut(named.join(least, "label").select("cls", "component", "label"))
    out = own.join(dealt(named), "cls", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.cast("long").alias("component_id"), "cls", "label")


def named_rows(k: int, columns: list[str], at: int):
    """Rows with one more column: the name of the set of the row's text, 0 without words."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            names = np.zeros(batch.num_rows, np.int64)
            for a, sets in doc_sets(batch, k):
                names[a : a + len(sets)] = np.where([len(s) > 0 for s in sets], class_of(sets), 0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], *batch.columns[at + 1 :], pa.array(names)], columns)

    return run


def one_of_each(docs: DataFrame, t: Threshold) -> DataFrame:
    """The rows of docs, all columns, but one document of each component: that of the smallest id, and one row of that.

    Rows with a null id and documents without words stay. Where an id has
    several texts each is judged by itself: what is no copy stays.
    """
    found = cut(labelled(docs, t).where("doc_id is not null"))
    repeated = cut(found.groupBy("doc_id").count().where("count > 1").select("doc_id"))
    gone = cut(found.join(dealt(repeated), "doc_id", "left_anti").where("doc_id <> component_id").select("doc_id"))
    if gone.count() <= MOST_BROADCAST:  # one number a document; beyond, a shuffled join
        gone = F.broadcast(gone)
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    if repeated.isEmpty():
        return kept
    several = kept.join(dealt(repeated), "doc_id", "left_semi").select(*docs.columns)
    return kept.join(dealt(repeated), "doc_id", "left_anti").select(*docs.columns).unionByName(rows_of_several_texts(several, found, t))


def rows_of_several_texts(docs: DataFrame, found: DataFrame, t: Threshold) -> DataFrame:
    """Of rows whose ids repeat, those without words and one of each id and component that the id is the smallest of."""
    held = [f"c{i}" for i in range(len(docs.columns))]  # names of our own, whatever the columns are called
    plain = docs.toDF(*held)
    id_, text = held[docs.columns.index("doc_id")], held[docs.columns.index("text")]
    asked = plain.select(F.col(id_).cast("long").alias("doc_id"), F.col(text).alias("text"), F.struct(*held).alias("row"))
    schema = F.col("row")
    named = asked.mapInArrow(named_rows(t.shingle, ["doc_id", "row", "cls"], 1), f"doc_id long, row {asked.schema['row'].dataType.simpleString()}, cls long")
    labels = found.where("n_shingles > 0 and doc_id = component_id").select("doc_id", "cls", "label").distinct()
    worded = named.where("cls <> 0").join(dealt(labels), ["doc_id", "cls"]).dropDuplicates(["doc_id", "label"])
    rows = named.where("cls = 0").select("row").unionByName(worded.select("row"))
    return rows.select(*[schema[h].alias(c) for h, c in zip(held, docs.columns, strict=True)])


def op2_ngram_join(spark, sf_dir: str) -> DataFrame:
    return similarity_components(table(spark, sf_dir, "documents"), Threshold(3, 90, 100))


OP2_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * common >= 90 * (a.n + b.n - common)),
u AS (SELECT x AS a, y AS b FROM l UNION SELECT y, x FROM l),
r AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, u.b FROM r JOIN u ON r.seen = u.a),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.node = d.doc_id
"""
