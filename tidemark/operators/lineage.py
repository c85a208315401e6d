"""Linking lives into accounts and devices: evidence at the boundaries, edges by route, roles in a chain."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.dedup import latest
from tidemark.operators.joins import best_of, point_in_interval

HIGH, LOW = "HIGH", "LOW"


def firm_starts(lives: DataFrame, evidence: DataFrame, key: str) -> DataFrame:
    """Lives (key, carrier, start_ts, end_ts, start_inferred, start_confidence, floored) with start evidence (key, since, asked_at, carrier).

    Of a key's answers with a date only the latest asked counts, of equal ones
    the greatest, so lives are never multiplied.
    Evidence counts for the life that was on when the question was asked, at
    the same carrier or one unknown, and only where confidence is low. An
    inferred start moves back to it, if no earlier life is in the way; a
    floored one moves forward as well. A witnessed start on the same day is
    confirmed. Anything else contradicts. Adds `evidence_use`.
    """
    named = evidence.select(F.col(key), F.col("since").alias("_since"), F.col("asked_at").alias("_asked"), F.col("carrier").alias("_carrier"))
    e = latest(named.where("_since is not null"), [key], ["_asked"], ["_asked", "_since", "_carrier"])
    before = F.lag("end_ts").over(Window.partitionBy(key).orderBy("start_ts", "carrier"))
    d = lives.withColumn("_before", before).join(e, key, "left")
    on = F.col("_asked").between(F.col("start_ts"), F.coalesce(F.col("end_ts"), F.col("_asked"))) & ~F.col("_asked").eqNullSafe(F.col("end_ts"))
    counts = F.coalesce(on & F.coalesce(F.col("_carrier") == F.col("carrier"), F.lit(True)) & (F.col("start_confidence") == LOW) & F.col("_since").isNotNull(), F.lit(False))
    free = F.coalesce(F.col("_since") >= F.col("_before"), F.lit(True))
    reaches = (F.col("_since") <= F.col("start_ts")) | (F.col("floored") & F.coalesce(F.col("_since") < F.col("end_ts"), F.lit(True)))
    use = F.when(~counts, "none").when(F.col("start_inferred") & free & reaches, "moved").when(~F.col("start_inferred") & (F.to_date("start_ts") == F.to_date("_since")), "confirmed").otherwise("conflict")
    firm = F.col("evidence_use").isin("moved", "confirmed")
    return (
        d.withColumn("evidence_use", use)
        .withColumns(
            {
                "start_ts": F.when(F.col("evidence_use") == "moved", F.col("_since")).otherwise(F.col("start_ts")),
                "start_inferred": F.col("start_inferred") & ~firm,
                "start_confidence": F.when(firm, HIGH).otherwise(F.col("start_confidence")),
            }
        )
        .drop("_before", "_since", "_asked", "_carrier")
    )


def firm_ends(lives: DataFrame, ports: DataFrame, key: str, life_id: str) -> DataFrame:
    """Witnessed ends of low confidence become high where a port away from the carrier falls in (start, end]."""
    open_to = lives.where(F.col("end_ts").isNotNull() & ~F.col("end_inferred") & (F.col("end_confidence") == LOW)).alias("l")
    p = ports.alias("p")
    same = (F.col(f"l.{key}") == F.col(f"p.{key}")) & (F.upper("l.carrier") == F.upper("p.from_carrier"))
    found = open_to.join(p, same & (F.col("p.ts") > F.col("l.start_ts")) & (F.col("p.ts") <= F.col("l.end_ts")), "left_semi").select(life_id, F.lit(True).alias("_firm"))
    return lives.join(found, life_id, "left").withColumn("end_confidence", F.when(F.col("_firm"), HIGH).otherwise(F.col("end_confidence"))).drop("_firm")


def _sides(froms: DataFrame, tos: DataFrame) -> tuple[DataFrame, DataFrame]:
    named = lambda d, side: d.select(*[F.col(c).alias(f"{side}_{c}") for c in ("id", "key", "carrier", "ts", "correlation")])
    return named(froms, "from"), named(tos, "to")


def correlation_edges(froms: DataFrame, tos: DataFrame) -> DataFrame:
    """(from_id, to_id, to_ts): the two sides of a change that share a correlation id and a carrier, on different numbers.

    Both sides: id, key, carrier, ts, correlation. A blank id correlates nothing.
    """
    a, b = _sides(froms, tos)
    given = lambda c: F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")
    same = (F.col("from_correlation") == F.col("to_correlation")) & (F.col("from_carrier") == F.col("to_carrier")) & (F.col("from_key") != F.col("to_key"))
    return a.where(given("from_correlation")).join(b.where(given("to_correlation")), same).select("from_id", "to_id", "to_ts")


def counterparty_edges(froms: DataFrame, tos: DataFrame, stated: DataFrame, days: float) -> DataFrame:
    """(from_id, to_id, to_ts): sides of a change near a statement (was, becomes, carrier, ts) that one number became another.

    Each side may be `days` away from the statement's moment; numbers and
    moments meet by time ranges. A number that becomes itself or a blank one
    states nothing.
    """
    a, b = _sides(froms, tos)
    good = F.col("was").isNotNull() & (F.trim(F.col("becomes").cast("string")) != "") & (F.col("was") != F.col("becomes"))
    margin = F.expr(f"INTERVAL {int(days * 86400)} SECONDS")
    s = stated.where(good).select("was", "becomes", F.upper("carrier").alias("_c"), (F.col("ts") - margin).alias("_low"), (F.col("ts") + margin).alias("_high")).distinct()
    pair = lambda k, c: F.when(F.col(k).isNotNull() & F.col(c).isNotNull(), F.struct(F.col(k).cast("string").alias("k"), F.col(c).alias("c")))
    left = point_in_interval(a.withColumn("_pair", pair("from_key", "from_carrier")), s.withColumn("_pair", pair("was", "_c")), "_pair", "from_ts", "_low", "_high")
    right = b.withColumn("_pair", pair("to_key", "to_carrier"))
    found = point_in_interval(right, left.select("from_id", "_low", "_high", pair("becomes", "_c").alias("_pair")), "_pair", "to_ts", "_low", "_high")
    return found.select("from_id", "to_id", "to_ts").distinct()


def life_edges(edges: DataFrame, lives: DataFrame, end_kind: str, start_kind: str) -> DataFrame:
    """Edges between events as edges between the lives that the one ended and the other began; others link nothing."""
    closing = lives.where(F.col("end_kind") == end_kind).select(F.col("lifecycle_uid").alias("from_uid"), F.col("end_id").alias("from_id"))
    opening = lives.where(F.col("start_kind") == start_kind).select(F.col("lifecycle_uid").alias("to_uid"), F.col("start_id").alias("to_id"))
    return edges.join(closing, "from_id").join(opening, "to_id").where("from_uid <> to_uid")


def best_edges(candidates: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """One successor an event: of (from_id, to_id, to_ts) by route, the first route listed wins, then the earlier successor."""
    out = None
    for rank, (route, frame) in enumerate(candidates):
        f = frame.select("from_id", "to_id", "to_ts", F.lit(route).alias("route"), F.lit(rank).alias("_rank"))
        out = f if out is None else out.unionByName(f)
    return best_of(out, ["from_id"], [F.col("_rank"), F.col("to_ts"), F.col("to_id")]).drop("_rank")


def chain_roles(chains: DataFrame, lives: DataFrame, links: DataFrame) -> DataFrame:
    """Each node's role in its chain.

    chains: node, root, position; lives: node, start_inferred, is_open; links:
    node and the confidence of its link from before. A node that chains don't
    have is a chain of its own.
    """
    d = lives.join(chains.select("node", "root", "position"), "node", "left").withColumns({"root": F.coalesce("root", "node"), "position": F.coalesce("position", F.lit(0))})
    d = d.join(links.select("node", "link_confidence"), "node", "left").withColumn("link_confidence", F.coalesce("link_confidence", F.lit(HIGH)))
    whole = Window.partitionBy("root")
    length = F.count("*").over(whole)
    first, last = F.col("position") == 0, F.col("position") == F.col("chain_length") - 1
    role = (
        F.when(F.col("chain_length") == 1, "single")
        .when(first & F.col("start_inferred"), "origin_unmatched")
        .when(first, "origin")
        .when(last & F.col("is_open"), "final_unmatched")
        .when(last, "final")
        .otherwise("intermediate")
    )
    d = d.withColumn("chain_length", length).withColumn("segment_type", role).withColumn("account_type", F.when(F.col("chain_length") == 1, "single").otherwise("chain"))
    return d.withColumn("weakest_link", F.min(F.when(F.col("link_confidence") == LOW, LOW).otherwise("ZHIGH")).over(whole)).withColumn("weakest_link", F.when(F.col("weakest_link") == LOW, LOW).otherwise(HIGH))


def port_edges(lives: DataFrame, key: str, account: str) -> DataFrame:
    """(from_account, to_account, port_ts): a life that began by a port, after one at another carrier and account."""
    w = Window.partitionBy(key).orderBy("start_ts", "life_id")
    d = lives.where(F.col(key).isNotNull()).withColumn("_carrier", F.lag("carrier").over(w)).withColumn("_account", F.lag(account).over(w))
    moved = F.col("ported") & (F.col("_carrier") != F.col("carrier")) & (F.col("_account") != F.col(account))
    return d.where(moved).select(F.col("_account").alias("from_account"), F.col(account).alias("to_account"), F.col("start_ts").alias("port_ts")).distinct()


def quiet_ports(lives: DataFrame, key: str, window_days: float, restart_days: float) -> DataFrame:
    """(n): lives after a gap longer than a port takes and shorter than a restart."""
    w = Window.partitionBy(key).orderBy("start_ts", "life_id")
    gap = F.expr("timestampdiff(SECOND, _before, start_ts)") / 86400
    return lives.withColumn("_before", F.lag("end_ts").over(w)).where((gap > window_days) & (gap < restart_days)).agg(F.count("*").alias("n"))


def port_sequence(ports: DataFrame, key: str, at: str, to: str, kind: str, assigned: str, returned: str) -> DataFrame:
    """Add event_seq and `from_id`: whom a number came from; nobody for the first event, an assignment, or after a return."""
    w = Window.partitionBy(key).orderBy(at)
    before = F.lag(to).over(w)
    fresh = (F.col(kind) == assigned) | F.coalesce(F.lag(kind).over(w) == returned, F.lit(False))
    return ports.withColumn("event_seq", F.row_number().over(w)).withColumn("from_id", F.when(~fresh, before))


def parent_of(code: Column, brands: Mapping[str, str], parents: Mapping[str, str], kept: Sequence[str]) -> Column:
    """The parent of a code's brand, where it is one of those kept."""
    as_map = lambda m: F.create_map(*[F.lit(x) for kv in sorted(m.items()) for x in kv])
    parent = as_map(parents)[as_map(brands)[code]]
    return F.when(parent.isin(*kept), parent)


DEVICES = "subscriber string, segment_no int, device string, carrier string, displaced string, from_ts timestamp, to_ts timestamp"


def device_walk(events: Iterable) -> list[dict]:
    """One subscriber's devices from rows with kind (start, end, sim_end), device, carrier, ts, event_id.

    A start of the device that is on changes nothing; one of another displaces
    it. An end counts for the device that is on, or for any if it names none.
    A segment that ends when it began never was: the next one displaces what
    it had displaced.
    """
    out: list[dict] = []
    on: dict | None = None

    def off(at) -> str | None:
        """Close what is on; the device that a successor displaces."""
        nonlocal on
        if on is None:
            return None
        gone, on = on, None
        if at <= gone["from_ts"]:
            return gone["displaced"]
        out.append({**gone, "to_ts": at})
        return gone["device"]

    for e in sorted(events, key=lambda e: (e.ts, e.kind != "end" and e.kind != "sim_end", e.event_id)):
        if e.kind == "start" and e.device is not None and (on is None or on["device"] != e.device):
            on = {"device": e.device, "carrier": e.carrier, "displaced": off(e.ts), "from_ts": e.ts, "to_ts": None}
        elif e.kind == "sim_end" or (e.kind == "end" and on is not None and e.device in (None, on["device"])):
            off(e.ts)
    if on is not None:
        out.append(on)
    return [{**s, "segment_no": i + 1} for i, s in enumerate(sorted(out, key=lambda s: (s["from_ts"], s["to_ts"] is None, s["device"])))]


def device_segments(events: DataFrame) -> DataFrame:
    """Device intervals of (subscriber, kind, device, carrier, ts, event_id), walked once a subscriber."""

    def of(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.astype(object).where(rows.notna(), None)
        names = [c.split()[0] for c in DEVICES.split(", ")]
        found = pd.DataFrame(device_walk(rows.itertuples(index=False)), columns=[n for n in names if n != "subscriber"])
        found.insert(0, "subscriber", rows["subscriber"].iloc[0])
        for c in ("from_ts", "to_ts"):
            found[c] = pd.to_datetime(found[c])
        return found[names]

    shaped = events.select(F.col("subscriber").cast("string").alias("subscriber"), "kind", F.col("device").cast("string").alias("device"), F.col("carrier").cast("string").alias("carrier"), F.col("ts").cast("timestamp").alias("ts"), "event_id")
    return shaped.groupBy("subscriber").applyInPandas(of, DEVICES)


def close_at_life_end(segments: DataFrame, lives: DataFrame, key: str) -> DataFrame:
    """Open segments end with the last life where no life is open any more; what that leaves empty goes."""
    ends = lives.groupBy(key).agg(F.max("end_ts").alias("_last"), F.count_if(F.col("end_ts").isNull()).alias("_open"))
    closes = F.col("to_ts").isNull() & (F.col("_open") == 0) & (F.col("_last") >= F.col("from_ts"))
    d = segments.join(ends, key, "left").withColumn("to_ts", F.when(F.coalesce(closes, F.lit(False)), F.col("_last")).otherwise(F.col("to_ts")))
    return d.where(F.col("to_ts").isNull() | (F.col("from_ts") < F.col("to_ts"))).drop("_last", "_open")
