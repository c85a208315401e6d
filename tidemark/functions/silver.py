"""Raw rows of three feeds to typed rows with flags: account changes, device events and API audits.

No row is lost: what can't be read becomes null with a `_bad_` flag, what is
odd gets a `_warn_` flag, and the row's own text travels along for quarantine.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clean import NULL_TOKENS, clean, looked_up, padded_id, raw_payload, with_date, with_long, with_timestamp

# Layouts of moments in these feeds, and the bounds of epoch milliseconds (years 1 to 9999).
LAYOUTS = ("yyyy-MM-dd HH:mm:ss[.SSSSSSSSS]", "yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]XXX", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]")
EPOCH_MS = (-62135596800000, 253402300799999)
# Note fields that only one carrier writes, that carrier, its landline name, and who is meant otherwise.
BELL_NOTES = ("subId", "msisdnChangeSide", "correlationId", "otherMSISDN")
BELL, BELL_LANDLINE, OTHERWISE = "BELL", "BELL_LANDLINE", "ROGERS"


@dataclass(frozen=True)
class Feed:
    """inputs: our name of a column to the names it may have; required: those that must be there; notes: fields read from JSON."""

    inputs: Mapping[str, Sequence[str]]
    output: Mapping[str, str]
    required: frozenset[str] = frozenset()
    notes: Sequence[str] = ()
    tokens: Sequence[str] = NULL_TOKENS
    source_name: str = ""
    schema_version: str = "1"
    test_partners: Sequence[str] = ()
    test_providers: Sequence[str] = ()
    api_types: Mapping[str, str] = field(default_factory=dict)


def prepared(df: DataFrame, feed: Feed) -> DataFrame:
    """Add `_in_` and trimmed `_s_` columns for the feed's inputs, the row as JSON, its file and a row token.

    A missing required input, two names for one input, names that differ only
    in case, and names that begin with `_` raise. Other columns are let through.
    """
    names: dict[str, str] = {}
    for c in df.columns:
        if c.lower() in names:
            raise ValueError(f"{c} and {names[c.lower()]} differ only in case")
        if c.startswith("_"):
            raise ValueError(f"{c}: names beginning with _ are reserved")
        names[c.lower()] = c
    columns = {"_raw_payload": raw_payload(df), "_source_file": F.input_file_name(), "_source_row_id": F.monotonically_increasing_id().cast("string")}
    for name, aliases in feed.inputs.items():
        found = [names[a.lower()] for a in aliases if a.lower() in names]
        if len(found) > 1:
            raise ValueError(f"{name}: several of its names are there: {found}")
        if not found and name in feed.required:
            raise ValueError(f"{name} is missing; names: {list(aliases)}")
        columns[f"_in_{name}"] = F.col(f"`{found[0]}`") if found else F.lit(None).cast("string")
        columns[f"_s_{name}"] = clean(columns[f"_in_{name}"], feed.tokens)
    return df.withColumns(columns)


def with_notes(df: DataFrame, feed: Feed) -> DataFrame:
    """Add `_n_` columns of the notes' fields, and `_bad_notes` where there is text that is no JSON object."""
    text = F.col("_s_notes")
    read = F.from_json(text, ", ".join(f"`{n}` string" for n in feed.notes))
    df = df.withColumns({"_bad_notes": text.isNotNull() & F.json_object_keys(text).isNull(), "_notes": read})
    return df.withColumns({f"_n_{n}": clean(F.col("_notes").getField(n), feed.tokens) for n in feed.notes})


def finished(df: DataFrame, feed: Feed) -> DataFrame:
    """The feed's output columns, cast; then the flags and the row's evidence."""
    flags = [c for c in df.columns if c.startswith(("_bad_", "_warn_"))]
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in feed.output.items()], *flags, "_raw_payload", "_source_file", "_source_row_id")


def _provenance(feed: Feed, at: str, event_id: str | None = "record_id") -> dict[str, Column]:
    out = {"event_date": F.to_date(at), "source_name": F.lit(feed.source_name), "schema_version": F.lit(feed.schema_version)}
    return out | ({"source_event_id": F.col(event_id)} if event_id else {})


def account(raw: DataFrame, feed: Feed, ingested: Column) -> DataFrame:
    """Account changes: the carrier comes from the notes; unreadable notes leave it null.

    A named carrier wins, fields only one carrier writes imply it, all else is
    the other's; `_warn_rogers_notes` marks the other's rows with such fields.
    """
    df = with_timestamp(with_long(with_notes(prepared(raw, feed), feed), "_s_id", "record_id"), "_in_timestamp", "event_timestamp", LAYOUTS)
    named = F.upper("_n_mno")
    telling = F.coalesce(*[F.col(f"_n_{n}") for n in BELL_NOTES]).isNotNull()
    carrier = F.when(F.col("_bad_notes"), None).when(named == BELL_LANDLINE, BELL).when(named.isNotNull(), named).when(telling, BELL).otherwise(OTHERWISE)
    df = df.withColumns({"mno": carrier, **{n: F.col(f"_n_{n}") for n in BELL_NOTES}, "phone_number_AC_hash": F.col("_s_change_key"), "event_type": F.upper("_s_change_type"), "ingestion_ts": ingested.cast("timestamp")})
    return finished(df.withColumns({**_provenance(feed, "event_timestamp"), "_warn_rogers_notes": (F.col("mno") == OTHERWISE) & telling}), feed)


def device(raw: DataFrame, feed: Feed, ingested: Column) -> DataFrame:
    """Device events: carrier and status as given in upper case, hashes as they are, the rest from the notes."""
    df = with_timestamp(with_long(with_notes(prepared(raw, feed), feed), "_s_id", "record_id"), "_in_timestamp", "event_timestamp", LAYOUTS)
    names = {"phone_number_AC_hash": "_s_change_key", "phone_number_AT_hash": "_s_change_key_ats", "imei": "_s_imei", "imsi": "_s_imsi", "related_id": "_s_related_id", "correlation_id": "_n_correlationId"}
    names |= {n: f"_n_{n}" for n in ("tac", "oldIMSI", "oldIMEI", "fromADCSnapshot")}
    df = with_date(df, "_s_date", "date").withColumns({k: F.col(c) for k, c in names.items()})
    return finished(df.withColumns({"mno": F.upper("_s_mno"), "event_type": F.upper("_s_status"), "ingestion_ts": ingested.cast("timestamp"), **_provenance(feed, "event_timestamp")}), feed)


def audit(raw: DataFrame, feed: Feed, partners: DataFrame, providers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, excluded): API audits with names of partners and providers; rows of test ids are excluded, not lost.

    partners has partner_id, providers service_provider_id, both padded and
    unique, with whatever columns the output names; they are small reference
    tables, yet joined without a broadcast hint.
    """
    df = prepared(raw, feed)
    among = lambda c, ids: F.coalesce(F.lower(c).isin(*[x.lower() for x in ids]), F.lit(False)) if ids else F.lit(False)
    test = among("_s_partner_id", feed.test_partners) | among("_s_service_provider_id", feed.test_providers)
    excluded = df.where(test).select(F.col("_s_id").alias("record_id"), "_raw_payload", "_source_file")
    df = with_date(with_timestamp(df.where(~test), "_in_timestamp", "api_timestamp", LAYOUTS), "_s_date", "date")
    df = with_long(with_long(df, "_s_processing_time", "processing_time_ms", unsigned=False), "_s_timestamp_ms", "_epoch", unsigned=False).drop("_bad__epoch")
    moment = F.timestamp_millis(F.when(F.col("_epoch").between(*EPOCH_MS), F.col("_epoch")))
    same = {"record_id": "id", "msisdn": "msisdn", "phone_number_AT_hash": "hashed_msisdn", "encrypted_msisdn": "encrypted_msisdn", "brand": "brand", "source_ip": "source_ip", "source_event_id": "request_id"}
    df = df.withColumns(
        {
            "timestamp_ms": moment,
            "_bad_timestamp_ms": F.col("_s_timestamp_ms").isNotNull() & moment.isNull(),
            **{k: F.col(f"_s_{c}") for k, c in same.items()},
            **{c: F.upper(f"_s_{c}") for c in ("operation", "mno", "response_code")},
            **{c: padded_id(F.col(f"_s_{c}")) for c in ("partner_id", "service_provider_id")},
            "correlation_id": F.lit(None).cast("string"),
        }
    )
    df = df.join(partners.withColumn("_partner", F.lit(True)), "partner_id", "left").join(providers.withColumn("_provider", F.lit(True)), "service_provider_id", "left")
    operation = F.col("operation")
    known = operation.isin(*feed.api_types) if feed.api_types else F.lit(False)
    df = df.withColumns(
        {
            "api_type": looked_up(operation, feed.api_types),
            "_warn_unknown_api": operation.isNotNull() & ~known,
            "_warn_partner_reference": F.col("partner_id").isNotNull() & F.col("_partner").isNull(),
            "_warn_provider_reference": F.col("service_provider_id").isNotNull() & F.col("_provider").isNull(),
            **_provenance(feed, "api_timestamp", None),
        }
    )
    return finished(df, feed), excluded
