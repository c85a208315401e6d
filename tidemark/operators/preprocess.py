"""Filling and scaling of feature columns, fitted on a training table and applied to any."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.scoring import quantiles, stacked

# Names of ways to fill and to scale, as variants are written.
FILLS = {"raw_numeric_zero": "zero", "zero": "zero", "median": "median", "domain": "domain"}
SCALES = {"no_scaling": None, "standard_scaler": "standard", "robust_scaler": "robust", "minmax_scaler": "minmax"}
INDICATORS = "with_missing_indicators"
# By their names, features that are zero, a tenure or a mean where nothing happened.
ZERO = re.compile(r"(^|_)(cnt|any)(_|$)|_weighted_cnt(_|$)|_distinct_cnt(_|$)|_event_cnt(_|$)|_event_frac(_|$)|_velocity(_|$)|_stddev(_|$)|_cv(_|$)|_slope(_|$)|_peak_to_avg(_|$)|_over_")
TENURE = re.compile(r"days_since|interval_(mean|median|min|max)|spread_days|transition_days|days_for_last")
ENTROPY = re.compile(r"entropy")
# Tenure columns of a scope, and those of the customer for any scope.
SCOPES = {"customer": ("cust_", "customer_"), "account": ("acct_", "account_")}
SCOPE_TENURES = {"customer": ("cust_node_tenure_days", "customer_node_tenure_days"), "account": ("acct_node_tenure_days", "account_node_tenure_days"), "msisdn": ("msisdn_node_tenure_days",)}
TENURES = ("cust_node_tenure_days", "cust_days_since_first_seen", "cust_days_since_current_assignment_start")


@dataclass(frozen=True)
class Variant:
    fill: str
    scale: str | None
    indicators: bool = False


def variant(name: str) -> Variant:
    """`<fill>_impute[_with_missing_indicators]_<scale>`; anything else raises."""
    m = re.fullmatch(rf"({'|'.join(FILLS)})_impute(_{INDICATORS})?_({'|'.join(SCALES)})", name.strip().lower())
    if not m:
        raise ValueError(f"{name!r} is no known way to fill and scale")
    return Variant(FILLS[m[1]], SCALES[m[3]], bool(m[2]))


def tenure_of(feature: str, columns: Sequence[str]) -> str | None:
    """The tenure column for a feature: of its own scope first, then the customer's."""
    scope = next((s for s, p in SCOPES.items() if feature.lower().startswith(p)), "msisdn")
    return next((c for c in SCOPE_TENURES[scope] + TENURES if c in columns and c != feature), None)


def number(name: str) -> Column:
    """A column as double; NaN and infinities, being undefined ratios, count as missing."""
    c = F.col(f"`{name}`").try_cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


@dataclass(frozen=True)
class Fitted:
    """Rules of each feature; nothing is computed from the table they are applied to."""

    features: tuple[str, ...]
    rules: Mapping[str, dict]
    scale: str | None

    def filled(self, name: str) -> Column:
        r = self.rules[name]
        other = [F.coalesce(number(r["source"]), F.lit(r["source_fill"]))] if r.get("source") else []
        return F.coalesce(number(name), *other, F.lit(r["fill"]))

    def apply(self, df: DataFrame) -> DataFrame:
        """The features filled and scaled, and `<feature>_missing` for those with indicators; other columns stay."""
        missing = [f for f in self.features if f not in df.columns]
        if missing:
            raise ValueError(f"features that are not there: {missing[:10]}")
        out = {}
        for f in self.features:
            r = self.rules[f]
            out[f] = (self.filled(f) - r["shift"]) / r["width"] if self.scale else self.filled(f)
            if r["indicator"]:
                out[f"{f}_missing"] = number(f).isNull().cast("int")
        return df.withColumns(out)


def _summary(df: DataFrame, columns: Mapping[str, Column], qs: Sequence[float]) -> dict[str, dict]:
    """Counts, means, spreads and exact quantiles of columns: a row a column comes to the driver."""
    named = df.select(*[c.alias(n) for n, c in columns.items()])
    long = stacked(named, list(columns))
    plain = long.groupBy("feature").agg(F.count("*").alias("n"), F.count("value").alias("some"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("sd"), F.min("value").alias("least"), F.max("value").alias("most"))
    out = {r["feature"]: r.asDict() for r in plain.collect()}
    for r in quantiles(long, ["feature"], "value", qs).collect() if qs else []:
        out[r["feature"]][r["q"]] = r["quantile"]
    return out


def fit(train: DataFrame, features: Sequence[str], way: Variant) -> Fitted:
    """Learn fills and scales. A column without any value is filled with 0; a spread of 0 divides by 1.

    `domain`: counts and dispersions are 0, elapsed times the tenure of their
    scope where there is one, entropies their mean, all else the median.
    robust: between the 5th and 95th percentile, centred on the median.
    """
    missing = [f for f in features if f not in train.columns]
    if missing:
        raise ValueError(f"features that are not there: {missing[:10]}")
    sources = {f: tenure_of(f, train.columns) for f in features if way.fill == "domain" and not ZERO.search(f.lower()) and TENURE.search(f.lower())}
    wanted = list(dict.fromkeys([*features, *[s for s in sources.values() if s]]))
    stats = _summary(train, {c: number(c) for c in wanted}, [0.5] if way.fill != "zero" else [])
    middle = lambda c: stats.get(c, {}).get(0.5) or 0.0
    rules: dict[str, dict] = {}
    for f in features:
        low = f.lower()
        if way.fill == "zero" or (way.fill == "domain" and ZERO.search(low)):
            rule = {"rule": "zero", "fill": 0.0}
        elif f in sources:
            rule = {"rule": "tenure" if sources[f] else "tenure_median", "fill": middle(f)} | ({"source": sources[f], "source_fill": middle(sources[f])} if sources[f] else {})
        elif way.fill == "domain" and ENTROPY.search(low):
            rule = {"rule": "entropy_mean", "fill": stats.get(f, {}).get("mean") or 0.0}
        else:
            rule = {"rule": "median", "fill": middle(f)}
        s = stats.get(f, {"n": 0, "some": 0})
        rules[f] = rule | {"indicator": way.indicators and s["some"] < s["n"], "shift": 0.0, "width": 1.0}
    out = Fitted(tuple(features), rules, way.scale)
    if way.scale:
        after = _summary(train, {f: out.filled(f) for f in features}, [0.05, 0.5, 0.95] if way.scale == "robust" else [])
        for f in features:
            s = after.get(f)
            if s is None:
                continue
            at, width = {"standard": lambda: (s["mean"], s["sd"]), "minmax": lambda: (s["least"], s["most"] - s["least"]), "robust": lambda: (s[0.5], s[0.95] - s[0.05])}[way.scale]()
            rules[f] |= {"shift": float(at), "width": float(width) or 1.0}
    return out
