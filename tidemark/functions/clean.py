"""Cleaning and safe casts of raw string columns, surrogate keys and lookups.

Everything is a Column expression; a value that can't be cast becomes null and
a flag column says so, so a rule can report it and no row is lost.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Tokens that stand for "nothing" in raw files.
NULL_TOKENS = ("", "\\N")
LOOSE_NULL_TOKENS = ("", "NULL", "\\N")


def clean(column: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Trimmed text, null where only a token stands; letters keep their case."""
    text = F.trim(column.cast("string"))
    return F.when(~text.isin(*tokens), text)


def with_long(df: DataFrame, source: str, target: str, unsigned: bool = True) -> DataFrame:
    """Add `target` as long and `_bad_<target>`: whether there was text that isn't digits or overflows."""
    text = clean(F.col(source))
    ok = text.rlike(r"^\d+$" if unsigned else r"^-?\d+$")
    number = F.when(ok, text.try_cast("long"))
    return df.withColumn(target, number).withColumn(f"_bad_{target}", text.isNotNull() & number.isNull())


# The layouts in which raw files write moments.
TIME_LAYOUTS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ssXXX")


def with_timestamp(df: DataFrame, source: str, target: str, layouts: Sequence[str] = TIME_LAYOUTS) -> DataFrame:
    """Add `target` as timestamp, by the first layout that fits, and `_bad_<target>`."""
    if dict(df.dtypes)[source].startswith("timestamp"):
        return df.withColumn(target, F.col(source).cast("timestamp")).withColumn(f"_bad_{target}", F.lit(False))
    text = clean(F.col(source))
    moment = F.coalesce(*[F.try_to_timestamp(text, F.lit(x)) for x in layouts])
    return df.withColumn(target, moment).withColumn(f"_bad_{target}", text.isNotNull() & moment.isNull())


def with_date(df: DataFrame, source: str, target: str) -> DataFrame:
    """Add `target` as a strict yyyy-MM-dd date and `_bad_<target>`."""
    text = clean(F.col(source))
    day = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.to_date(F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))))
    return df.withColumn(target, day).withColumn(f"_bad_{target}", text.isNotNull() & day.isNull())


def epoch_ms(column: Column, low: int = 0, high: int = 4102444800000) -> Column:
    """A moment from epoch milliseconds within bounds, else null."""
    return F.when(column.between(low, high), F.timestamp_millis(column))


def padded_id(column: Column, width: int = 10) -> Column:
    """Digits of 1 to `width` places filled with zeros on the left; anything else untouched."""
    return F.when(column.rlike(rf"^\d{{1,{width}}}$"), F.lpad(column, width, "0")).otherwise(column)


def with_json(df: DataFrame, source: str, target: str, schema: StructType | str) -> DataFrame:
    """Add `target`, a struct parsed from JSON text, and `_bad_<target>` for text that isn't one object."""
    text = clean(F.col(source))
    whole = text.rlike(r"(?s)^\s*\{.*\}\s*$") & F.json_object_keys(text).isNotNull()
    return df.withColumn(target, F.when(whole, F.from_json(text, schema))).withColumn(f"_bad_{target}", text.isNotNull() & ~F.coalesce(whole, F.lit(False)))


def looked_up(column: Column, names: Mapping[str, str]) -> Column:
    """The name of a code, or the code where there is none."""
    return F.coalesce(F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[column], column) if names else column


def surrogate_key(*parts: Column) -> Column:
    """SHA-256 in hex of the parts joined by `|`; a null part counts as empty."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def uuid_like(*parts: Column) -> Column:
    """A deterministic id in the shape 8-4-4-4-12."""
    h = surrogate_key(*parts)
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def joined_ids(column: Column) -> Column:
    """Aggregate: the distinct ids of a group in order, joined by commas."""
    return F.concat_ws(",", F.array_sort(F.collect_set(column.cast("string"))))


def to_contract(df: DataFrame, schema: StructType, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Exactly the schema's columns, in order and cast; names match without regard to case. A missing one raises."""
    have = {}
    for c in df.columns:
        if c.lower() in have:
            raise ValueError(f"{c} and {have[c.lower()]} differ only in case")
        have[c.lower()] = c
    names = {f.name: have.get((aliases or {}).get(f.name, f.name).lower()) for f in schema.fields}
    if missing := [k for k, v in names.items() if v is None]:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[F.col(f"`{names[f.name]}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def with_missing(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add typed nulls for columns (name to type) that aren't there."""
    return df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in columns.items() if c not in df.columns])


def unique_columns(df: DataFrame) -> DataFrame:
    """The first of each column name."""
    names = [f"c{i}" for i in range(len(df.columns))]
    first = {c: n for c, n in reversed(list(zip(df.columns, names, strict=True)))}
    return df.toDF(*names).select(*[F.col(n).alias(c) for c, n in first.items()])


def raw_payload(df: DataFrame) -> Column:
    """A row as JSON, nulls written out."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})


def filled(df: DataFrame, numeric: Sequence[str], text: Sequence[str], word: str = "UNKNOWN", error: float = 0.01) -> DataFrame:
    """Approximate medians for numeric nulls, one word for others."""
    medians = dict(zip(numeric, df.approxQuantile(list(numeric), [0.5], error), strict=True)) if numeric else {}
    return df.fillna({**{c: m[0] for c, m in medians.items() if m}, **{c: word for c in text}})
