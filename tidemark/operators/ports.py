"""Lives that only a porting history knows of: stays at carriers without a feed, fitted between the lives the feeds built."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.clean import surrogate_key
from tidemark.operators.sequence import FROM_FLOOR, FROM_PREVIOUS, HIGH, LOW, TO_NEXT, TO_OPEN, subtract_intervals

# How a boundary that a port witnessed is named.
PORT_IN = "explicit_tu_port_in"
PORT_OUT = "_to_explicit_tu_port_out"
PORT_KIND = "tu_inter_spid_port"


def latest_answer(ports: DataFrame, key: str, asked_at: str, request: str) -> DataFrame:
    """The rows of a key's last request: an answer is a whole history, so an older one counts for nothing."""
    newest = F.max(F.struct(F.col(asked_at).alias("a"), F.col(request).alias("r"))).over(Window.partitionBy(key))
    return ports.withColumn("_newest", newest).where((F.col(asked_at) == F.col("_newest.a")) & (F.col(request) == F.col("_newest.r"))).drop("_newest")


def carrier_name(name: Column, code: Column) -> Column:
    """The carrier's name, else its code marked as one; never empty."""
    some = lambda c: F.when(F.trim(c) != "", F.upper(F.trim(c)))
    return F.coalesce(some(name), F.concat(F.lit("SPID_"), some(code.cast("string"))), F.lit("UNKNOWN_CARRIER"))


def stays(ports: DataFrame, key: str) -> DataFrame:
    """(key, carrier, start_ts, end_ts, start_id, end_id) between ports from carrier to carrier; the last stay is open.

    ports: key, ts, seq, record_id, between_carriers, to_name, to_code. At one
    moment the order is seq, none first, then record_id.
    """
    order = Window.partitionBy(key).orderBy("ts", F.coalesce("seq", F.lit(-1)), "record_id")
    return ports.where(F.col("between_carriers") & F.col(key).isNotNull() & F.col("ts").isNotNull()).select(
        key,
        carrier_name(F.col("to_name"), F.col("to_code")).alias("carrier"),
        F.col("ts").alias("start_ts"),
        F.lead("ts").over(order).alias("end_ts"),
        F.col("record_id").cast("string").alias("start_id"),
        F.lead("record_id").over(order).cast("string").alias("end_id"),
    )


def floors_recovered(lives: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Lives whose start is only a floor begin with the stay at their carrier that was on when they ended; ids stay."""
    at = found.select(F.col(key), F.col("carrier"), F.col("start_ts").alias("_s"), F.col("end_ts").alias("_e"), F.col("start_id").alias("_id"), F.lit(FROM_FLOOR).alias("start_reason"))
    on = F.when(F.col("end_ts").isNull(), F.col("_e").isNull()).otherwise((F.col("_s") < F.col("end_ts")) & (F.col("_e").isNull() | (F.col("_e") >= F.col("end_ts"))))
    floored = lives.where(F.col("start_reason") == FROM_FLOOR)
    match = floored.join(at, [key, "carrier", "start_reason"]).where(on).select("lifecycle_uid", "_s", "_id")
    moved = F.col("_s").isNotNull()
    to = lambda c, value: F.when(moved, value).otherwise(F.col(c))
    return lives.join(match, "lifecycle_uid", "left").withColumns(
        {
            "start_ts": to("start_ts", F.col("_s")),
            "start_reason": to("start_reason", F.lit(PORT_IN)),
            "start_inferred": to("start_inferred", F.lit(False)),
            "start_confidence": to("start_confidence", F.lit(HIGH)),
            "confidence": to("confidence", F.col("end_confidence")),
            "ported": to("ported", F.lit(True)),
            "start_id": to("start_id", F.col("_id")),
            "start_kind": to("start_kind", F.lit(PORT_KIND)),
        }
    ).select(*lives.columns)


def port_lives(lives: DataFrame, ports: DataFrame, key: str, fed: Sequence[str]) -> DataFrame:
    """All lives, with those added that the porting history knows of at carriers not in `fed`.

    lives: the columns of sequence.lifecycles with `key`. Stays are clipped
    to what no life of the key covers; a part's boundary is of high confidence
    where a port witnessed it or the stay is open. Numbers and segments of keys
    with an answer are given anew; all other lives stay as they are. Adds
    `ported`, `enriched` (there was an answer) and `supported` (a fed carrier).
    """
    home = F.col("carrier").isin(*fed)
    asked = ports.select(F.col(key)).na.drop().distinct()
    flagged = lives.withColumns({"ported": F.lit(False), "supported": home})
    known = flagged.join(asked, key, "left_semi")
    found = stays(ports, key)
    known = floors_recovered(known, found, key).withColumn("enriched", F.lit(True))
    foreign = found.where(~home).select(key, "start_ts", "end_ts", "carrier", "start_id", "end_id", F.col("start_ts").alias("was_from"), F.col("end_ts").alias("was_to"))
    parts = subtract_intervals(foreign, known.select(key, "start_ts", "end_ts"), key, "start_ts", "end_ts", ["carrier", "start_id", "end_id", "was_from", "was_to"])
    nth = F.row_number().over(Window.partitionBy(key, "start_id").orderBy("start_ts")) - 1
    seen_from = F.col("start_ts") == F.col("was_from").cast("timestamp")
    open_ = F.col("end_ts").isNull()
    seen_to = F.coalesce(F.col("end_ts") == F.col("was_to").cast("timestamp"), F.lit(False))
    grade = lambda c: F.when(c, HIGH).otherwise(LOW)
    anchor = F.when(F.col("_nth") == 0, F.col("start_id")).otherwise(F.concat_ws("#", "start_id", F.col("_nth").cast("string")))
    added = parts.withColumn("_nth", nth).withColumn("anchor_id", anchor).select(
        F.col(key).cast(lives.schema[key].dataType).alias(key),
        F.lit(0).alias("lifecycle_no"),
        "carrier",
        F.lit(0).alias("segment"),
        "anchor_id",
        "start_ts",
        "end_ts",
        open_.alias("is_open"),
        (~seen_from).alias("start_inferred"),
        (~seen_to).alias("end_inferred"),
        F.col("anchor_id").alias("start_id"),
        F.lit(PORT_KIND).alias("start_kind"),
        F.when(seen_from, PORT_IN).otherwise(FROM_PREVIOUS).alias("start_reason"),
        grade(seen_from).alias("start_confidence"),
        F.when(seen_to, F.col("end_id")).alias("end_id"),
        F.when(seen_to, PORT_KIND).alias("end_kind"),
        F.when(open_, TO_OPEN).when(seen_to, PORT_OUT).otherwise(TO_NEXT).alias("end_reason"),
        grade(open_ | seen_to).alias("end_confidence"),
        grade(seen_from & (open_ | seen_to)).alias("confidence"),
        F.lit(0).alias("plan_changes"),
        F.lit(0).alias("ignored_ends"),
        surrogate_key(F.lit("lifecycle"), F.lit(1), F.col(key), F.col("carrier"), F.col("anchor_id")).alias("lifecycle_uid"),
        F.lit(True).alias("ported"),
        F.lit(False).alias("supported"),
        F.lit(True).alias("enriched"),
    )
    order = Window.partitionBy(key).orderBy("start_ts", F.col("end_ts").asc_nulls_last(), "lifecycle_uid")
    both = known.unionByName(added).withColumn("lifecycle_no", F.row_number().over(order))
    turned = both.withColumn("_turn", (~F.lag("carrier").over(order).eqNullSafe(F.col("carrier")) | (F.col("lifecycle_no") == 1)).cast("int"))
    renumbered = turned.withColumn("segment", F.sum("_turn").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("_turn")
    untouched = flagged.join(asked, key, "left_anti").withColumn("enriched", F.lit(False))
    return renumbered.unionByName(untouched)


def lineage_changes(lineage: DataFrame, keys: Sequence[str], value: str, at: str, kind: str) -> DataFrame:
    """An event of `kind` wherever an interval of the keys has another value than the one before it, at its own start."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(at, F.col(value)))
    return lineage.withColumn("_before", before).where(F.col("_before") != F.col(value)).drop("_before").withColumn("event_kind", F.lit(kind))
