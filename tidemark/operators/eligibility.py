"""Which columns may be features, by their names and types."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

# Columns that tell the label or where a row came from.
LEAKING = frozenset(
    """
    testing_label testing_label_name testing_split testing_version
    testing_input_feature_set testing_gather_pipeline_version testing_gathered_at_utc
    fraud_type fraud_category fraud_category_short_label fraud_timestamp
    fraud_event_key fraud_case_natural_key fraud_case_natural_key_columns
    fraud_event_occurrence_seq fraud_case_transaction_count is_duplicate_fraud_case
    deduplication_policy transaction_level_rows_represented
    source source_name source_version fraud_source fraud_source_key
    fraud_source_name fraud_source_version partner industry phone_type
    label scenario hyperparam_id anomaly_score rank
    _sample_source_prefix _sample_source_files_used _sample_label _sample_source_root
    """.split()
)
# Name patterns of identifiers and of moments, tokens of behaviour, and prefixes of scopes.
IDS = re.compile(r"(^|_)id$|(^|_)key$|hash|reference_id|phone|msisdn|imsi|imei")
MOMENTS = re.compile(r"_ts$|timestamp|created|updated|_date$|(^|_)dt$")
BEHAVIOUR = ("cnt", "days", "entropy", "velocity", "interval", "distinct", "ratio", "frac", "stddev", "slope", "burst")
SCOPES = ("msisdn_", "cust_", "customer_", "acct_", "account_")
NUMBERS = re.compile(r"(tinyint|smallint|int|integer|bigint|long|short|float|double|real|decimal(\(\d+, ?\d+\))?|numeric)")


def verdict(name: str, kind: str, join_key: str = "customer_id", provenance: Iterable[str] = (), leaking: Iterable[str] = LEAKING) -> tuple[str, bool]:
    """(reason, readmitted): an empty reason admits the column.

    The first reason in order counts: the join key, leakage, provenance, the
    name of a moment or an identifier, no number. Names of behaviour within a
    scope are readmitted in spite of their pattern.
    """
    low = name.lower()
    if low == join_key.lower():
        return "join_key", False
    if low in leaking:
        return "label_leakage", False
    if name in set(provenance) or low.startswith("__"):
        return "provenance", False
    pattern = "timestamp_pattern" if MOMENTS.search(low) else "id_pattern" if IDS.search(low) else ""
    if pattern and not (low.startswith(SCOPES) and any(b in low for b in BEHAVIOUR)):
        return pattern, False
    return ("" if NUMBERS.fullmatch(kind.strip().lower()) else "not_numeric"), bool(pattern)


def eligible(dtypes: Sequence[tuple[str, str]], **how) -> list[str]:
    """The names of a table's columns that may be features, in order."""
    return sorted(n for n, k in dtypes if not verdict(n, k, **how)[0])


def top(ranked: Sequence[tuple[str, float]], n: int) -> list[str]:
    """The n best features by score, ties by name."""
    return [f for f, _ in sorted(ranked, key=lambda r: (-r[1], r[0]))[: max(n, 0)]]
