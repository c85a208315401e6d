"""Document fingerprints: threshold-scaled sketches, in DataFrame functions only.

A text's sketch keeps every shingle hash below a fixed fraction of the hash
range, so its size follows the text's and any two sketches compare: their
common hashes estimate resemblance and containment, and two sketches merge to
that of both texts' shingles. Where no hash is so low, the least one stands
for the text, so that only texts without words have the empty fingerprint.

Null texts count as empty; a text of fewer words than a shingle has its whole
word sequence as one. Rows that repeat an id are each a document, ordered by
their texts' hashes; null ids come last. Columns other than doc_id and text are
not read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.scratch import cut
from tidemark.sources.tables import table

SHINGLE = 5
SCALE = 4
ROWS_A_RANGE = 1024
QUANTILES, COARSE = 1024, 32
MOST_BROADCAST = 500_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def once(value: Column, body) -> Column:
    """`body` of a value that is worked out once a row, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased, as an array."""
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER + "\t\n\x0b\x0c\r", LOWER + "     ")
    return F.filter(F.split(plain, " "), lambda w: w != "")


def sketch(text: Column, shingle: int = SHINGLE, scale: int = SCALE) -> Column:
    """The sorted distinct hashes of `shingle` words that fall in 1/`scale` of the range, as array<bigint>."""

    def hashes(w: Column) -> Column:
        n = F.size(w)
        each = F.transform(F.slice(w, F.lit(1), F.greatest(n - (shingle - 1), F.lit(0))), lambda x, i: F.xxhash64(x, *[F.get(w, i + j) for j in range(1, shingle)]))
        short = F.when(n > 0, F.array(F.xxhash64(F.array_join(w, " "), F.lit("short")))).otherwise(F.array().cast("array<bigint>"))
        return F.when(n >= shingle, each).otherwise(short)

    return once(once(text_words(text), hashes), lambda h: lowest(h, scale))


def lowest(hashes: Column, scale: int = SCALE) -> Column:
    """The sorted distinct hashes in the lowest 1/`scale` of the range, or the least one if none is."""
    most = (1 << 63) // scale * 2 - (1 << 63)
    below = F.sort_array(F.array_distinct(F.filter(hashes, lambda h: h < F.lit(most).cast("long"))))
    return once(below, lambda b: F.when((F.size(b) > 0) | (F.size(hashes) == 0), b).otherwise(F.array(F.array_min(hashes))))


def fingerprint(sketch_: Column) -> Column:
    """A sketch as a string: 16 hex digits a hash, in order."""
    return F.array_join(F.transform(sketch_, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def merged(a: Column, b: Column, scale: int = SCALE) -> Column:
    """The sketch of both texts' shingles together."""
    return once(F.array_union(a, b), lambda both: lowest(both, scale))


def common(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def resemblance(a: Column, b: Column) -> Column:
    """Estimated shared part of all shingles; 0 where both sketches are empty."""
    both = common(a, b)
    union = F.size(a) + F.size(b) - both
    return F.when(union > 0, both / union).otherwise(F.lit(0.0))


def containment(a: Column, b: Column) -> Column:
    """Estimated part of a's shingles that b has; 0 where a's sketch is empty."""
    return F.when(F.size(a) > 0, common(a, b) / F.size(a)).otherwise(F.lit(0.0))


def id_ranges(docs: DataFrame, rows_a_range: int) -> Column:
    """A number for each row's range: higher for higher ids, and for one id higher for lower hashes of text.

    Quantiles of the ids part the rows; between two of them ids are parted
    evenly, so that far-off ids spoil only their own quantile. An id that
    fills a quantile, and the null ids, are parted by the texts' hashes. Takes
    the columns doc_id and hash.
    """
    steps = F.array(*[F.lit(k / QUANTILES) for k in range(QUANTILES + 1)])
    n, nulls, cuts = docs.agg(F.count("*"), F.count_if(F.col("doc_id").isNull()), F.percentile_approx(F.col("doc_id").cast("long"), steps, F.lit(8 * QUANTILES))).first()
    cuts = sorted(cuts or [])
    bounds = sorted(set(cuts))
    pieces = max(1, n // (QUANTILES * rows_a_range))
    id_, hash_ = F.col("doc_id").cast("long"), F.col("hash")

    def longs(values: list[int]) -> Column:
        return F.from_json(F.lit(str(list(values))), "array<bigint>")

    def parted(by: Column) -> Column:
        """Which of so many equal parts of the hash range, the lowest hashes last."""
        return by - 1 - F.least(by - 1, F.floor((hash_ / F.lit(2.0**64) + 0.5) * by))

    of_null = parted(F.lit(max(1, nulls // rows_a_range)).cast("long"))
    if not bounds:
        return of_null
    blocks = [bounds[k : k + COARSE] for k in range(0, len(bounds), COARSE)]
    block = F.size(F.filter(longs([b[0] for b in blocks]), lambda b: b <= id_)) - 1
    within = F.size(F.filter(F.get(F.from_json(F.lit(str(blocks)), "array<array<bigint>>"), block), lambda b: b <= id_))
    at = F.when(block < 0, F.lit(-1)).otherwise(block * COARSE + within - 1)  # the last bound up to the id; -1: below all
    low, high = F.get(longs(bounds), at), F.get(longs([*bounds[1:], bounds[-1] + 1]), at)
    splits = F.get(longs([pieces * cuts.count(b) if cuts.count(b) > 1 else 1 for b in bounds]), at)
    even = F.least(F.lit(pieces), F.floor((id_ - low).cast("double") / (high - low).cast("double") * pieces) + 1)
    here = F.when(at < 0, F.lit(0)).when((id_ == low) & (splits > 1), parted(splits)).otherwise(F.shiftleft(even.cast("long"), 24))
    return F.when(id_.isNull(), of_null).otherwise(F.shiftleft((at + 2).cast("long"), 48) + here)


def with_next(docs: DataFrame, value: Column, rows_a_range: int = ROWS_A_RANGE) -> DataFrame:
    """(doc_id, text, value, next_text, next_value): the row that follows by descending doc_id; the last is followed by the first.

    Rows are dealt by ranges of ids, each ordered on its own. Only one row a
    range looks across: for the next range, in its own quantile or else the
    next one that holds any. Null ids come last; equal ids are ordered by their
    texts' hashes. `value` is worked out of `text` once a row.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    rows = rows.withColumn("at", id_ranges(rows, rows_a_range))

    tops = cut(rows.groupBy("at").agg(F.max("doc_id").alias("top")))
    quantile = F.shiftright("at", 48).alias("quantile")
    groups = tops.groupBy(quantile).agg(F.max("at").alias("first"))  # QUANTILES + 3 rows at most
    round_ = Window.orderBy(F.col("quantile").desc())
    whole = round_.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    groups = groups.select("quantile", F.coalesce(F.lead("first").over(round_), F.first("first").over(whole)).alias("beyond"))
    own = tops.select("at", "top", quantile).withColumn("inside", F.lead("at").over(Window.partitionBy("quantile").orderBy(F.col("at").desc())))
    follows = cut(own.join(F.broadcast(groups), "quantile").select("at", "top", F.coalesce("inside", "beyond").alias("follows")))
    top = follows.select(F.col("at").alias("top_at"), "top")
    if follows.count() < MOST_BROADCAST:  # two numbers a range; beyond, a shuffled join
        top = F.broadcast(top)
    firsts = rows.join(top, (F.col("at") == F.col("top_at")) & F.col("doc_id").eqNullSafe(F.col("top"))).groupBy("at").agg(F.min(F.struct("hash", "text")).alias("head"))
    heads = firsts.select(F.col("at").alias("follows"), F.col("head.text").alias("text")).join(follows, "follows").select("at", F.col("text").alias("head_text"), value.alias("head_value"))

    ranged = Window.partitionBy("at").orderBy(F.col("doc_id").desc_nulls_last(), F.col("hash"), F.col("text"))
    rows = rows.withColumn("value", value).withColumn("after_text", F.lead("text").over(ranged)).withColumn("after_value", F.lead("value").over(ranged))
    return rows.join(heads, "at", "left").select(
        "doc_id",
        "text",
        "value",
        F.coalesce(F.col("after_text"), F.col("head_text")).alias("next_text"),
        F.coalesce(F.col("after_value"), F.col("head_value")).alias("next_value"),
    )


def compared(docs: DataFrame, shingle: int = SHINGLE, scale: int = SCALE) -> DataFrame:
    """Every document against its edited text (its second half replaced from the next document) and the next document."""
    half = F.expr("length(text) div 2")
    edited = F.concat(F.substr("text", F.lit(1), F.length("text") - half), F.substr("next_text", F.lit(1), half))
    pairs = with_next(docs, sketch(F.col("text"), shingle, scale)).withColumn("edited", edited)
    shaped = pairs.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        (F.col("edited") == F.col("text")).alias("same_edited"),
        (F.col("next_text") == F.col("text")).alias("same_next"),
        F.col("value").alias("own"),
        sketch(F.col("edited"), shingle, scale).alias("changed"),
        F.col("next_value").alias("next"),
    )

    def like(other: str, same: str) -> Column:
        return F.when(F.col(same), 1.0).otherwise(resemblance(F.col("own"), F.col(other)))

    return shaped.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("changed")).alias("edited_fingerprint"),
        like("changed", "same_edited").alias("near_edited"),
        like("next", "same_next").alias("near_next"),
    )


def op10_fingerprints(spark, sf_dir: str) -> DataFrame:
    return compared(table(spark, sf_dir, "documents"))
