"""All queries of the core library by name, with their SQL twins.

A query is a thin use of an operator on the benchmark tables. Whole numbers
come out as bigint and doubles rounded to six places, in both forms.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import clean as C
from tidemark.functions import silver, xml
from tidemark.operators import dedup, features, graph, joins, lineage as accounts, merge, ports, preprocess, quality, scoring, sequence
from tidemark.sources.tables import table
from tidemark.streaming.incremental import in_window

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        out.append((c.cast("bigint") if kind in ("int", "smallint", "tinyint") or kind.startswith("decimal") else F.round(c, 6) if kind in ("double", "float") else c).alias(name))
    return df.select(*out)


def query(sql: str | None = None):
    """Register a function of a table reader under its name, with its SQL."""

    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: plain(f(lambda name: table(spark, sf_dir, name)))
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


REFERENCE = "2024-01-31 00:00:00"
SCOPED = f"""
scoped AS (SELECT user_id, TIMESTAMP '{REFERENCE}' AS reference_ts, ts AS event_ts, event_type, event_id, value AS event_weight,
  date_diff('day', CAST(ts AS DATE), DATE '2024-01-31') AS age FROM events WHERE ts <= TIMESTAMP '{REFERENCE}'),
base AS (SELECT DISTINCT user_id FROM events)
"""
USER = ["user_id"]


def scoped(t) -> DataFrame:
    moment = F.to_timestamp_ntz(F.lit(REFERENCE))
    return t("events").where(F.col("ts") <= moment).select("user_id", moment.alias("reference_ts"), F.col("ts").alias("event_ts"), "event_type", "event_id", F.col("value").alias("event_weight"))


def users(t) -> DataFrame:
    return t("events").select("user_id").distinct()


def kind(t, name: str) -> DataFrame:
    return scoped(t).where(F.col("event_type") == name)


def _lookback(d: int) -> str:
    return f"event_ts > reference_ts - INTERVAL {24 * d} HOUR" if d in features.HOURLY else f"age BETWEEN 0 AND {d - 1}"


# Features


@query(
    f"WITH {SCOPED}, f AS (SELECT user_id, "
    + ", ".join(f"CAST(sum(CASE WHEN {_lookback(d)} THEN 1 ELSE 0 END) AS BIGINT) AS u_purchase_cnt_{d}d, round(sum(CASE WHEN {_lookback(d)} THEN coalesce(event_weight, 1) ELSE 0 END), 6) AS u_purchase_weighted_cnt_{d}d, CAST(max(CASE WHEN {_lookback(d)} THEN 1 ELSE 0 END) AS BIGINT) AS u_purchase_any_{d}d" for d in features.LOOKBACKS)
    + " FROM scoped WHERE event_type = 'purchase' GROUP BY user_id) SELECT * FROM base LEFT JOIN f USING (user_id)"
)
def windowed_counts(t):
    return features.frequency(users(t), kind(t, "purchase"), USER, "u_purchase")


@query(f"WITH {SCOPED}, f AS (SELECT user_id, count(*) AS u_error_total_cnt, min(age) AS u_error_days_since_last, max(age) AS u_error_days_since_first FROM scoped WHERE event_type = 'error' GROUP BY user_id) SELECT * FROM base LEFT JOIN f USING (user_id)")
def recency_features(t):
    return features.recency(users(t), kind(t, "error"), USER, "u_error")


@query("""
SELECT c_custkey, count(DISTINCT l_suppkey) AS c_line_l_suppkey_distinct_cnt, count(l_suppkey) AS c_line_l_suppkey_non_null_cnt,
  count(DISTINCT l_returnflag) AS c_line_l_returnflag_distinct_cnt, count(l_returnflag) AS c_line_l_returnflag_non_null_cnt
FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey GROUP BY c_custkey
UNION ALL SELECT c_custkey, NULL, NULL, NULL, NULL FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey)""")
def diversity_features(t):
    lines = t("orders").join(t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("c_custkey"), "l_suppkey", "l_returnflag")
    return features.diversity(t("customer").select("c_custkey"), lines, ["c_custkey"], "c_line", ["l_suppkey", "l_returnflag", "not_there"])


GAPS = f"WITH {SCOPED}, g AS (SELECT user_id, date_diff('day', CAST(lag(event_ts) OVER (PARTITION BY user_id ORDER BY event_ts) AS DATE), CAST(event_ts AS DATE)) AS gap FROM scoped WHERE event_type = 'click')"


@query(f"""{GAPS}, a AS (SELECT user_id, avg(gap) AS m, quantile_disc(gap, 0.5) AS md, min(gap) AS lo, max(gap) AS hi, stddev_samp(gap) AS sd FROM g WHERE gap IS NOT NULL GROUP BY user_id)
SELECT user_id, round(m, 6) AS u_click_interval_mean, md AS u_click_interval_median, lo AS u_click_interval_min, hi AS u_click_interval_max, round(sd, 6) AS u_click_interval_stddev,
  round(sd / nullif(m, 0), 6) AS u_click_interval_cv, round(1.0 / nullif(m, 0), 6) AS u_click_interarrival_velocity FROM a""")
def periodicity_features(t):
    return features.periodicity(kind(t, "click"), USER, "u_click")


@query(f"""WITH {SCOPED}, w AS (SELECT user_id, date_trunc('week', event_ts) AS m, count(*) AS n, count(*) FILTER ({_lookback(1)}) AS c1, count(*) FILTER ({_lookback(3)}) AS c3,
  count(*) FILTER ({_lookback(7)}) AS c7, count(*) FILTER ({_lookback(30)}) AS c30, count(*) FILTER ({_lookback(90)}) AS c90 FROM scoped WHERE event_type = 'view' GROUP BY ALL),
a AS (SELECT user_id, max(n) AS mx, avg(n) AS av, stddev_samp(n) AS sd, count(*) AS k, sum(c1) AS c1, sum(c3) AS c3, sum(c7) AS c7, sum(c30) AS c30, sum(c90) AS c90 FROM w GROUP BY user_id)
SELECT user_id, mx AS u_view_max_weekly_cnt, round(av, 6) AS u_view_avg_weekly_cnt, round(sd, 6) AS u_view_weekly_cnt_std, k AS u_view_active_weeks, round(mx / nullif(av, 0), 6) AS u_view_weekly_peak_to_avg,
  round(c1 / nullif(c3, 0), 6) AS u_view_cnt_1d_over_3d, round(c7 / nullif(c30, 0), 6) AS u_view_cnt_7d_over_30d, round(c30 / nullif(c90, 0), 6) AS u_view_cnt_30d_over_90d FROM a""")
def burstiness_features(t):
    return features.burstiness(kind(t, "view"), USER, "u_view", "week")


def _entropy(part: str, name: str) -> str:
    return f"""(SELECT user_id, round(-sum(p * log2(p)), 6) AS u_view_{name}_entropy FROM (SELECT user_id, c / sum(c) OVER (PARTITION BY user_id) AS p FROM (SELECT user_id, {part} AS v, count(*) AS c FROM scoped WHERE event_type = 'view' GROUP BY ALL)) GROUP BY user_id)"""


@query(f"""WITH {SCOPED} SELECT user_id, u_view_hour_entropy + 0.0 AS u_view_hour_entropy, u_view_day_of_week_entropy + 0.0 AS u_view_day_of_week_entropy, u_view_month_entropy + 0.0 AS u_view_month_entropy
FROM {_entropy("hour(event_ts)", "hour")} JOIN {_entropy("dayofweek(event_ts)", "day_of_week")} USING (user_id) JOIN {_entropy("month(event_ts)", "month")} USING (user_id)""")
def temporal_entropy(t):
    return features.temporal_entropy(kind(t, "view"), USER, "u_view")


@query(f"""WITH {SCOPED}, p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_ts DESC, event_id DESC) AS n FROM scoped WHERE event_type = 'signup'),
a AS (SELECT user_id, CASE WHEN count(*) >= 3 THEN date_diff('day', CAST(min(event_ts) AS DATE), CAST(max(event_ts) AS DATE)) END AS d FROM p WHERE n <= 3 GROUP BY user_id)
SELECT user_id, d AS u_signup_days_for_last_3_events, round(3.0 / nullif(d, 0), 6) AS u_signup_k_event_velocity_3 FROM a""")
def time_to_k(t):
    return features.time_to_k(kind(t, "signup"), USER, "u_signup", 3)


@query(f"WITH {SCOPED} SELECT user_id, round(sum(exp(-ln(2) / 7 * age)), 6) AS u_purchase_recency_weighted_intensity FROM scoped WHERE event_type = 'purchase' GROUP BY user_id")
def recency_intensity(t):
    return features.recency_intensity(kind(t, "purchase"), USER, "u_purchase")


@query(f"""WITH {SCOPED}, c AS (SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_ts, event_id) AS DOUBLE) AS n,
  date_diff('day', CAST(min(event_ts) OVER (PARTITION BY user_id) AS DATE), CAST(event_ts AS DATE)) AS d FROM scoped WHERE event_type = 'view')
SELECT user_id, round(regr_slope(n, d), 6) AS u_view_cumulative_event_slope FROM c GROUP BY user_id""")
def cumulative_slope(t):
    return features.cumulative_slope(kind(t, "view"), USER, "u_view")


PAIRS = [("signup", "purchase"), ("view", "error")]


@query(
    f"""WITH {SCOPED}, n AS (SELECT user_id, event_type, event_ts, """
    + ", ".join(f"min(CASE WHEN event_type = '{b}' THEN event_ts END) OVER (PARTITION BY user_id ORDER BY event_ts DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS next_{b}" for _, b in PAIRS)
    + " FROM scoped WHERE event_type IN ('signup', 'purchase', 'view', 'error')), d AS (SELECT user_id, "
    + ", ".join(f"CASE WHEN event_type = '{a}' THEN date_diff('day', CAST(event_ts AS DATE), CAST(next_{b} AS DATE)) END AS d_{a}_{b}" for a, b in PAIRS)
    + " FROM n) SELECT user_id, "
    + ", ".join(f"round(avg(d_{a}_{b}), 6) AS u_{a}_to_{b}_avg_transition_days, min(d_{a}_{b}) AS u_{a}_to_{b}_min_transition_days, round(1.0 / nullif(avg(d_{a}_{b}), 0), 6) AS u_{a}_to_{b}_transition_velocity" for a, b in PAIRS)
    + " FROM d GROUP BY user_id"
)
def state_transitions(t):
    return features.state_transitions(scoped(t), USER, "u", PAIRS)


@query("""
WITH e AS (SELECT o_custkey, o_orderdate AS event_ts, l_returnflag AS flag FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
f AS (SELECT *, min(event_ts) OVER (PARTITION BY o_custkey, flag) AS first FROM e WHERE flag IS NOT NULL)
SELECT o_custkey, date_diff('day', CAST(min(first) AS DATE), CAST(max(first) AS DATE)) AS c_new_flag_spread_days, date_diff('day', CAST(max(first) AS DATE), DATE '2025-01-01') AS c_days_since_last_new_flag,
  count(DISTINCT flag) AS c_flag_distinct_cnt, count(*) FILTER (event_ts = first) AS c_new_flag_event_cnt, count(*) AS c_flag_event_cnt, round(count(*) FILTER (event_ts = first) / count(*), 6) AS c_new_flag_event_frac
FROM f GROUP BY o_custkey""")
def novelty_features(t):
    e = t("orders").join(t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    e = e.select("o_custkey", F.col("o_orderdate").alias("event_ts"), F.col("l_returnflag").alias("flag"), F.to_timestamp_ntz(F.lit("2025-01-01 00:00:00")).alias("reference_ts"))
    return features.novelty(e, ["o_custkey"], "c", "flag")


@query(f"""WITH {SCOPED}, v AS (SELECT user_id, event_type, count(*) FILTER (age BETWEEN 0 AND 29) AS volume FROM scoped GROUP BY ALL)
SELECT user_id, event_type, volume, round(least(4.0, greatest(0.25, sqrt(avg(volume) OVER (PARTITION BY user_id) / greatest(volume, 1)))), 6) AS weight FROM v""")
def partner_weighted_counts(t):
    return features.partner_weights(scoped(t), USER, "event_type", 30)


@query("""
SELECT 'customer' AS scope, c_custkey AS id, min(o_orderdate) AS from_ts, max(l_shipdate) AS to_ts FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey GROUP BY c_custkey
UNION ALL SELECT 'nation', c_nationkey, min(o_orderdate), max(l_shipdate) FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey GROUP BY c_nationkey
UNION ALL SELECT 'order', o_orderkey, min(o_orderdate), max(l_shipdate) FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def scope_snapshots(t):
    base = t("customer").join(t("orders"), F.col("c_custkey") == F.col("o_custkey")).join(t("lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    base = base.select("c_custkey", "c_nationkey", "o_orderkey", F.col("o_orderdate").alias("from_ts"), F.col("l_shipdate").alias("to_ts"))
    keys = {"customer": ["c_custkey"], "nation": ["c_nationkey"], "order": ["o_orderkey"]}
    out = None
    for scope, d in features.scope_snapshots(base, keys, "from_ts", "to_ts").items():
        d = d.select(F.lit(scope).alias("scope"), F.col(keys[scope][0]).cast("long").alias("id"), "from_ts", "to_ts")
        out = d if out is None else out.unionByName(d)
    return out


@query("""SELECT o_custkey, date_diff('day', CAST(min(o_orderdate) AS DATE), DATE '2025-01-01') AS c_days_since_first_seen, date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2025-01-01') AS c_days_since_current_start,
  count(DISTINCT o_orderpriority) AS c_distinct_o_orderpriority_cnt FROM orders GROUP BY o_custkey""")
def stability_features(t):
    base = t("orders").withColumn("reference_ts", F.to_timestamp_ntz(F.lit("2025-01-01 00:00:00")))
    return features.stability(base, ["o_custkey"], "c", "o_orderdate", "reference_ts", ["o_orderpriority"])


@query()
def feature_assembly(t):
    """The wide feature frame; its families are checked one by one above."""
    return features.all_features(users(t), scoped(t), USER, "u", {"buy": ["purchase"], "look": ["view", "click"]}, PAIRS)


# Joins


def lineage(t) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return t("events").where("event_type = 'signup'").select("user_id", F.col("event_id").alias("interval_id"), F.col("ts").alias("from_ts"), F.lead("ts").over(w).alias("to_ts"))


LINEAGE = "lineage AS (SELECT user_id, event_id AS interval_id, ts AS from_ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS to_ts FROM events WHERE event_type = 'signup')"


@query(f"""WITH {LINEAGE}, j AS (SELECT e.event_id, e.user_id, interval_id, row_number() OVER (PARTITION BY e.event_id ORDER BY from_ts DESC) AS n FROM events e JOIN lineage l
  ON e.user_id = l.user_id AND e.ts >= from_ts AND (to_ts IS NULL OR e.ts <= to_ts) WHERE e.event_type = 'purchase') SELECT event_id, user_id, interval_id FROM j WHERE n = 1""")
def point_in_interval_join(t):
    e = t("events").where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return joins.point_in_interval(e, lineage(t), "user_id", "ts", "from_ts", "to_ts", True, "event_id").select("event_id", "user_id", "interval_id")


@query(f"WITH {LINEAGE} SELECT interval_id, count(*) AS n FROM events e JOIN lineage l ON e.user_id = l.user_id AND e.ts >= from_ts AND (to_ts IS NULL OR e.ts < to_ts) GROUP BY interval_id")
def half_open_interval_join(t):
    e = t("events").select("event_id", "user_id", "ts")
    return joins.point_in_interval(e, lineage(t), "user_id", "ts", "from_ts", "to_ts", False).groupBy("interval_id").agg(F.count("*").alias("n"))


@query(f"""WITH {LINEAGE}, r AS (SELECT DISTINCT user_id, TIMESTAMP '2024-01-15 06:00:00' AS moment FROM events),
j AS (SELECT r.user_id, interval_id, from_ts, row_number() OVER (PARTITION BY r.user_id ORDER BY from_ts DESC, to_ts DESC NULLS FIRST) AS n FROM r JOIN lineage l ON r.user_id = l.user_id
  AND CAST(from_ts AS DATE) <= CAST(moment AS DATE) AND (to_ts IS NULL OR CAST(moment AS DATE) <= CAST(to_ts AS DATE))) SELECT user_id, interval_id, from_ts FROM j WHERE n = 1""")
def active_at_reference(t):
    r = users(t).withColumn("at", F.to_timestamp_ntz(F.lit("2024-01-15 06:00:00")))
    return joins.active_at(lineage(t), r, "user_id", "at", "from_ts", "to_ts").select("user_id", "interval_id", "from_ts")


@query("""
WITH s AS (SELECT user_id, min(ts) AS from_ts, TIMESTAMP '2024-01-20 00:00:00' AS ref FROM events WHERE event_type = 'signup' GROUP BY user_id)
SELECT s.user_id, count(event_id) AS n, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS n_error
FROM s LEFT JOIN events e ON e.user_id = s.user_id AND e.ts > greatest(from_ts, ref - INTERVAL 10 DAY) AND e.ts <= ref GROUP BY s.user_id""")
def pruned_scope_join(t):
    s = t("events").where("event_type = 'signup'").groupBy("user_id").agg(F.min("ts").alias("from_ts")).withColumn("ref", F.to_timestamp_ntz(F.lit("2024-01-20 00:00:00")))
    found = joins.scope_events(s, t("events"), "user_id", "ts", "ref", "from_ts", 10)
    return found.groupBy("user_id").agg(F.count("event_id").alias("n"), F.count_if(F.col("event_type") == "error").alias("n_error"))


@query("""
WITH p AS (SELECT user_id, event_id AS p_id, ts AS p_ts FROM events WHERE event_type = 'purchase'), e AS (SELECT user_id, event_id AS e_id, ts AS e_ts FROM events WHERE event_type = 'error'),
j AS (SELECT p_id, e_id, abs(date_diff('microsecond', p_ts, e_ts)) AS gap_us FROM p JOIN e USING (user_id) WHERE abs(date_diff('microsecond', p_ts, e_ts)) <= 43200000000)
SELECT p_id, e_id, gap_us FROM (SELECT *, row_number() OVER (PARTITION BY p_id ORDER BY gap_us, e_id) AS n FROM j) WHERE n = 1""")
def band_join_nearest(t):
    p = t("events").where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("p_id"), F.col("ts").alias("p_ts"))
    e = t("events").where("event_type = 'error'").select("user_id", F.col("event_id").alias("e_id"), F.col("ts").alias("e_ts"))
    return joins.nearest_in_band(p, e, "user_id", "p_ts", "e_ts", "p_id", "e_id", 0.5).select("p_id", "e_id", "gap_us")


@query("SELECT event_id, EXISTS (SELECT 1 FROM events b WHERE b.user_id = a.user_id AND b.ts > a.ts AND b.event_type <> 'error') AS goes_on FROM events a WHERE event_type = 'error'")
def theta_lookahead(t):
    return t("events").withColumn("goes_on", joins.later_exists(t("events"), ["user_id"], "ts", F.col("event_type") != "error")).where("event_type = 'error'").select("event_id", "goes_on")


@query("SELECT a.o_orderkey, a.o_custkey FROM orders a WHERE NOT EXISTS (SELECT 1 FROM orders b WHERE b.o_custkey = a.o_custkey AND b.o_orderpriority <> a.o_orderpriority AND b.o_orderdate < a.o_orderdate)")
def theta_anti_join(t):
    o = t("orders")
    return joins.none_before(o, o, "o_custkey", "o_orderdate", "o_orderdate", ("o_orderpriority", "o_orderpriority")).select("o_orderkey", "o_custkey")


@query("""
SELECT o_orderkey, next_id, next_at FROM (SELECT a.o_orderkey, b.o_orderkey AS next_id, b.o_orderdate AS next_at, row_number() OVER (PARTITION BY a.o_orderkey ORDER BY b.o_orderdate, b.o_orderkey) AS n
FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderpriority <> b.o_orderpriority AND (b.o_orderdate > a.o_orderdate OR (b.o_orderdate = a.o_orderdate AND b.o_orderkey > a.o_orderkey))) WHERE n = 1""")
def nearest_successor(t):
    return joins.next_of_other(t("orders").select("o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey"), "o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey")


@query("SELECT s_suppkey, n_name, r_name, n_name IS NULL AS unknown_nation FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def reference_enrichment(t):
    one = joins.enriched(t("supplier"), t("nation"), "s_nationkey", "n_nationkey")
    return joins.enriched(one, t("region"), "n_regionkey", "r_regionkey").select("s_suppkey", "n_name", "r_name", F.col("n_name").isNull().alias("unknown_nation"))


# Sequences


def stream(t) -> DataFrame:
    return t("events").select("user_id", "event_id", "event_type", "ts")


RUNS = """r AS (SELECT *, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS c FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, CAST(sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment FROM r),
b AS (SELECT user_id, segment, event_type, min(ts) AS seg_from, max(ts) AS seg_to, count(*) AS n_events FROM s GROUP BY ALL)"""


@query(f"WITH {RUNS} SELECT * FROM b")
def segments_gaps_islands(t):
    return sequence.segment_bounds(sequence.segments(stream(t), USER, "event_type", ["ts", "event_id"]), USER, "event_type", "ts")


@query(f"""WITH {RUNS}, h AS (SELECT user_id, segment, lag(event_type) OVER w AS from_value, event_type AS to_value, date_diff('microsecond', lag(seg_to) OVER w, seg_from) AS gap_us FROM b WINDOW w AS (PARTITION BY user_id ORDER BY segment))
SELECT *, gap_us <= 21600000000 AS within FROM h WHERE gap_us IS NOT NULL""")
def segment_handovers(t):
    b = sequence.segment_bounds(sequence.segments(stream(t), USER, "event_type", ["ts", "event_id"]), USER, "event_type", "ts")
    return sequence.handovers(b, USER, "event_type", 0.25)


@query("""
WITH l AS (SELECT user_id, event_id, event_type, ts, lead(event_type) OVER w AS nx, lead(ts) OVER w AS nt, lag(event_type) OVER w AS lx, lag(ts) OVER w AS lt FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
f AS (SELECT *, coalesce(event_type = 'view' AND nx = 'click' AND date_diff('microsecond', ts, nt) <= 10800000000, false) AS goes, coalesce(event_type = 'click' AND lx = 'view' AND date_diff('microsecond', lt, ts) <= 10800000000, false) AS turns FROM l)
SELECT user_id, event_id, CASE WHEN turns THEN 'visit' ELSE event_type END AS event_type, ts, turns AS collapsed FROM f WHERE NOT goes""")
def pair_collapse(t):
    return sequence.collapse_pairs(stream(t), USER, "event_type", "view", "click", "ts", "event_id", 3, "visit").select("user_id", "event_id", "event_type", "ts", "collapsed")


@query("SELECT o_custkey, o_orderkey, coalesce(date_diff('microsecond', lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), o_orderdate) >= 90 * 86400000000, false) AS restarts FROM orders")
def long_gap_restart(t):
    return sequence.long_gaps(t("orders"), ["o_custkey"], "o_orderdate", "o_orderkey", 90).select("o_custkey", "o_orderkey", "restarts")


ORDER_INTERVALS = "i AS (SELECT o_custkey, o_orderkey, min(o_orderdate) AS f, max(l_shipdate) AS e FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL)"


def order_intervals(t) -> DataFrame:
    return t("orders").join(t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_custkey", "o_orderkey").agg(F.min("o_orderdate").alias("f"), F.max("l_shipdate").alias("e"))


@query(f"WITH {ORDER_INTERVALS}, m AS (SELECT *, max(e) OVER (PARTITION BY o_custkey ORDER BY f, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM i) SELECT o_custkey, o_orderkey FROM m WHERE f < reached")
def overlap_check(t):
    return sequence.overlapping(order_intervals(t), ["o_custkey"], "f", "e", ["o_orderkey"]).select("o_custkey", "o_orderkey")


@query(f"WITH {LINEAGE}, c AS (SELECT user_id, count(*) AS n FROM lineage WHERE to_ts IS NULL GROUP BY user_id) SELECT count(*) AS failed FROM c WHERE n > 1")
def one_open_interval(t):
    return quality.at_most_one_open(USER, "to_ts").frame(lineage(t))


WORDS = sequence.Vocabulary(starts=frozenset({"signup"}), forces=frozenset(), resumes=frozenset({"purchase"}), ends=frozenset({"error"}))


@query()
def lifecycle_walk(t):
    """Users as subscribers, the parity of the value as carrier: a state machine, tested branch by branch."""
    e = t("events").select(F.col("user_id").alias("subscriber"), (F.floor("value") % 2).cast("string").alias("carrier"), F.col("event_type").alias("kind"), "ts", "event_id")
    return sequence.lifecycles(e, WORDS)


@query(f"""WITH {ORDER_INTERVALS}, u AS (SELECT o_custkey, f AS s, e FROM i WHERE e > f), x AS (SELECT *, max(e) OVER (PARTITION BY o_custkey ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM u),
y AS (SELECT *, sum(CASE WHEN s <= reached THEN 0 ELSE 1 END) OVER (PARTITION BY o_custkey ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS run FROM x), c AS (SELECT o_custkey, min(s) AS s, max(e) AS e FROM y GROUP BY o_custkey, run),
g AS (SELECT o_custkey, coalesce(lag(e) OVER (PARTITION BY o_custkey ORDER BY s), TIMESTAMP '0001-01-01') AS gs, s AS ge FROM c UNION ALL SELECT o_custkey, max(e), TIMESTAMP '9999-12-31' FROM c GROUP BY o_custkey),
w AS (SELECT o_custkey, min(o_orderdate) AS f, max(o_orderdate) + INTERVAL 60 DAY AS e FROM orders GROUP BY o_custkey)
SELECT CAST(o_custkey AS VARCHAR) AS o_custkey, greatest(f, gs) AS f, least(e, ge) AS e FROM w JOIN g USING (o_custkey) WHERE greatest(f, gs) < least(e, ge)
UNION ALL SELECT CAST(o_custkey AS VARCHAR), f, e FROM w WHERE o_custkey NOT IN (SELECT o_custkey FROM c)""")
def interval_subtraction(t):
    free = t("orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("f"), F.max(F.col("o_orderdate") + F.expr("INTERVAL 60 DAYS")).alias("e"))
    left = sequence.subtract_intervals(free, order_intervals(t), "o_custkey", "f", "e")
    return left.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("f", "e")})


@query(f"""WITH {LINEAGE}, lives AS (SELECT user_id, interval_id, from_ts AS s, least(coalesce(to_ts, TIMESTAMP '9999-01-01'), from_ts + INTERVAL 12 HOUR) AS e FROM lineage),
k AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'error'),
g AS (SELECT user_id, coalesce(lag(e) OVER (PARTITION BY user_id ORDER BY s), TIMESTAMP '0001-01-01') AS gs, s AS ge FROM lives UNION ALL SELECT user_id, max(e), TIMESTAMP '9999-01-01' FROM lives GROUP BY user_id
  UNION ALL SELECT user_id, TIMESTAMP '0001-01-01', TIMESTAMP '9999-01-01' FROM k WHERE user_id NOT IN (SELECT user_id FROM lives)),
st AS (SELECT user_id, event_id, CAST(floor(value) % 3 AS BIGINT) AS c, ts AS s, coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), TIMESTAMP '9999-01-01') AS e FROM events WHERE event_type = 'error'),
p AS (SELECT user_id, event_id, CASE c WHEN 1 THEN 'OTHER' ELSE 'SPID_2B' END AS carrier, greatest(s, gs) AS start_ts, least(e, ge) AS end_ts, s, e FROM st JOIN g USING (user_id) WHERE c <> 0 AND greatest(s, gs) < least(e, ge)),
u AS (SELECT user_id, carrier, start_ts, CASE WHEN end_ts < TIMESTAMP '9999-01-01' THEN end_ts END AS end_ts, CASE WHEN start_ts = s AND (e = end_ts) THEN 'HIGH' ELSE 'LOW' END AS confidence, true AS ported FROM p
  UNION ALL SELECT user_id, 'HOME', s, e, 'HIGH', false FROM lives)
SELECT user_id, carrier, start_ts, end_ts, confidence, ported, user_id IN (SELECT user_id FROM k) AS enriched, CASE WHEN user_id IN (SELECT user_id FROM k) THEN row_number() OVER (PARTITION BY user_id ORDER BY start_ts) ELSE 0 END AS lifecycle_no FROM u""")
def port_lifecycles(t):
    """Half-day lives from signups; errors as ports to a fed carrier, a named and an unnamed one."""
    w = lineage(t).withColumn("to_ts", F.least(F.coalesce("to_ts", F.to_timestamp_ntz(F.lit("9999-01-01 00:00:00"))), F.col("from_ts") + F.expr("INTERVAL 12 HOURS")))
    none, high = F.lit(None).cast("string"), F.lit("HIGH")
    names = {"lifecycle_no": F.lit(0), "segment": F.lit(0), "carrier": F.lit("HOME"), "anchor_id": F.col("interval_id").cast("string"), "start_ts": F.col("from_ts").cast("timestamp"), "end_ts": F.col("to_ts").cast("timestamp"), "is_open": F.lit(False), "start_inferred": F.lit(False), "end_inferred": F.lit(False)}
    names |= {"start_id": none, "start_kind": none, "start_reason": F.lit("explicit"), "start_confidence": high, "end_id": none, "end_kind": none, "end_reason": none, "end_confidence": high, "confidence": high, "plan_changes": F.lit(0), "ignored_ends": F.lit(0), "lifecycle_uid": F.sha2(F.col("interval_id").cast("string"), 256)}
    c = F.floor("value") % 3
    asked = t("events").where("event_type = 'error'").select("user_id", F.col("ts").cast("timestamp").alias("ts"), F.lit(None).cast("int").alias("seq"), F.col("event_id").alias("record_id"), F.lit(True).alias("between_carriers"), F.when(c == 0, "home").when(c == 1, " other ").alias("to_name"), F.when(c == 2, "2b").alias("to_code"))
    found = ports.port_lives(w.select("user_id", *[v.alias(k) for k, v in names.items()]), asked, "user_id", ["HOME"])
    return found.select("user_id", "carrier", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("start_ts", "end_ts")], "confidence", "ported", "enriched", "lifecycle_no")


@query("""WITH w AS (SELECT *, lag(o_orderpriority) OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate, o_orderpriority) AS b FROM orders)
SELECT o_custkey, o_orderstatus, o_orderdate, o_orderpriority, 'NUMBER_CHANGE' AS event_kind FROM w WHERE b <> o_orderpriority""")
def derived_changes(t):
    o = t("orders").select("o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    return ports.lineage_changes(o, ["o_custkey", "o_orderstatus"], "o_orderpriority", "o_orderdate", "NUMBER_CHANGE")


# Graphs


def _edges(t) -> DataFrame:
    """Customers who bought the same part on the same day."""
    o = t("orders").join(t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("c"), F.concat_ws("/", "l_partkey", F.to_date("o_orderdate").cast("string")).alias("k")).distinct()
    least = o.groupBy("k").agg(F.min("c").alias("src"))
    return o.join(least, "k").where("c <> src").select("src", F.col("c").alias("dst")).distinct()


@query("""
WITH RECURSIVE o AS (SELECT DISTINCT o_custkey AS c, l_partkey AS p, CAST(o_orderdate AS DATE) AS d FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
e AS (SELECT DISTINCT min(c) OVER (PARTITION BY p, d) AS src, c AS dst FROM o), u AS (SELECT src AS a, dst AS b FROM e WHERE src <> dst UNION SELECT dst, src FROM e WHERE src <> dst),
r AS (SELECT a AS node, a AS seen FROM u UNION SELECT r.node, u.b FROM r JOIN u ON r.seen = u.a)
SELECT node, min(seen) AS component FROM r GROUP BY node""")
def connected_components(t):
    return graph.connected_components(_edges(t))


@query("""
WITH RECURSIVE n AS (SELECT o_orderkey, lead(o_orderkey) OVER w AS nx, date_diff('day', CAST(o_orderdate AS DATE), CAST(lead(o_orderdate) OVER w AS DATE)) AS gap FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
e AS (SELECT o_orderkey AS s, nx AS d FROM n WHERE gap <= 30), heads AS (SELECT s FROM e WHERE s NOT IN (SELECT d FROM e)),
c AS (SELECT s AS node, s AS root, CAST(0 AS BIGINT) AS position FROM heads UNION ALL SELECT e.d, c.root, c.position + 1 FROM c JOIN e ON c.node = e.s)
SELECT CAST(node AS VARCHAR) AS node, CAST(root AS VARCHAR) AS root, position, node NOT IN (SELECT s FROM e) AS is_tail FROM c""")
def ordered_chains(t):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    e = t("orders").select(F.col("o_orderkey").alias("s"), F.lead("o_orderkey").over(w).alias("d"), F.lead("o_orderdate").over(w).alias("at"), "o_orderdate")
    return graph.ordered_chains(e.where(F.datediff("at", "o_orderdate") <= 30), "s", "d", "at")


@query("""
WITH RECURSIVE l AS (SELECT DISTINCT o_custkey AS c, CAST(floor(o_totalprice / 50) AS BIGINT) AS p FROM orders), r AS (SELECT 1::BIGINT AS c UNION SELECT b.c FROM r JOIN l a ON r.c = a.c JOIN l b ON a.p = b.p)
SELECT DISTINCT c FROM r""")
def slice_closure(t):
    links = t("orders").select(F.col("o_custkey").alias("c"), F.floor(F.col("o_totalprice") / 50).alias("p")).distinct()
    seeds = t("orders").select(F.lit(1).cast("long").alias("c")).limit(1)
    return graph.closure(seeds, links, "c", "p", rounds=50)


@query("""
WITH RECURSIVE l AS (SELECT DISTINCT o_custkey AS c, 'price::' || CAST(floor(o_totalprice / 200) AS BIGINT) AS p FROM orders UNION SELECT c, 'step::' || a FROM (SELECT DISTINCT o_custkey AS a, unnest([o_custkey, o_custkey + 7]) AS c FROM orders WHERE o_orderstatus = 'P')),
r AS (SELECT unnest([1, 3])::BIGINT AS c UNION SELECT b.c FROM r JOIN l a ON r.c = a.c JOIN l b ON a.p = b.p) SELECT DISTINCT c FROM r""")
def slice_levels(t):
    o = t("orders")
    seeds = [o.select(F.lit(k).cast("long").alias("c")).limit(1) for k in (1, 3)]
    price = o.select(F.col("o_custkey").alias("c"), F.floor(F.col("o_totalprice") / 200).alias("p")).distinct()
    step = graph.pair_links(o.where("o_orderstatus = 'P'").select("o_custkey", (F.col("o_custkey") + 7).alias("b")), "o_custkey", "b", "c", "p")
    return graph.slice_of(seeds, {"price": price, "step": step}, "c", "p", rounds=50)


# Lineage


def _sides(t) -> tuple[DataFrame, DataFrame]:
    o = t("orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("key"), F.upper("o_orderpriority").alias("carrier"), F.col("o_orderdate").alias("ts"), F.floor(F.col("o_totalprice") / 100).cast("string").alias("correlation"), "o_orderstatus")
    return o.where("o_orderstatus = 'F'"), o.where("o_orderstatus = 'O'")


@query("""SELECT a.o_orderkey AS from_id, b.o_orderkey AS to_id, b.o_orderdate AS to_ts FROM orders a JOIN orders b ON floor(a.o_totalprice / 100) = floor(b.o_totalprice / 100) AND a.o_orderpriority = b.o_orderpriority AND a.o_custkey <> b.o_custkey
WHERE a.o_orderstatus = 'F' AND b.o_orderstatus = 'O'""")
def correlation_edges(t):
    return accounts.correlation_edges(*_sides(t))


@query("""SELECT DISTINCT a.o_orderkey AS from_id, b.o_orderkey AS to_id, b.o_orderdate AS to_ts FROM orders p JOIN orders a ON a.o_custkey = p.o_custkey AND a.o_orderstatus = 'F' AND a.o_orderpriority = p.o_orderpriority
  AND a.o_orderdate BETWEEN p.o_orderdate - INTERVAL 60 DAY AND p.o_orderdate + INTERVAL 60 DAY
JOIN orders b ON b.o_custkey = p.o_custkey + 1 AND b.o_orderstatus = 'O' AND b.o_orderpriority = p.o_orderpriority AND b.o_orderdate BETWEEN p.o_orderdate - INTERVAL 60 DAY AND p.o_orderdate + INTERVAL 60 DAY""")
def counterparty_edges(t):
    stated = t("orders").select(F.col("o_custkey").alias("was"), (F.col("o_custkey") + 1).alias("becomes"), F.lower("o_orderpriority").alias("carrier"), F.col("o_orderdate").alias("ts"))
    return accounts.counterparty_edges(*_sides(t), stated, 60)


@query("""
WITH RECURSIVE n AS (SELECT o_orderkey, lead(o_orderkey) OVER w AS nx, date_diff('day', CAST(o_orderdate AS DATE), CAST(lead(o_orderdate) OVER w AS DATE)) AS gap FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
e AS (SELECT o_orderkey AS s, nx AS d, gap FROM n WHERE gap <= 30), heads AS (SELECT o_orderkey AS s FROM orders WHERE o_orderkey NOT IN (SELECT d FROM e)),
c AS (SELECT s AS node, s AS root, CAST(0 AS BIGINT) AS position FROM heads UNION ALL SELECT e.d, c.root, c.position + 1 FROM c JOIN e ON c.node = e.s),
l AS (SELECT node, root, position, count(*) OVER (PARTITION BY root) AS chain_length, o_orderstatus, coalesce(gap > 7, false) AS weak FROM c JOIN orders ON node = o_orderkey LEFT JOIN e ON e.d = node)
SELECT CAST(node AS VARCHAR) AS node, CASE WHEN chain_length = 1 THEN 'single' WHEN position = 0 AND o_orderstatus = 'F' THEN 'origin_unmatched' WHEN position = 0 THEN 'origin'
  WHEN position = chain_length - 1 AND o_orderstatus = 'O' THEN 'final_unmatched' WHEN position = chain_length - 1 THEN 'final' ELSE 'intermediate' END AS segment_type,
  CASE WHEN chain_length = 1 THEN 'single' ELSE 'chain' END AS account_type, CASE WHEN bool_or(weak) OVER (PARTITION BY root) THEN 'LOW' ELSE 'HIGH' END AS weakest_link FROM l""")
def chain_roles(t):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    e = t("orders").select(F.col("o_orderkey").alias("s"), F.lead("o_orderkey").over(w).alias("d"), F.lead("o_orderdate").over(w).alias("at"), "o_orderdate").withColumn("gap", F.datediff("at", "o_orderdate")).where("gap <= 30")
    lives = t("orders").select(F.col("o_orderkey").cast("string").alias("node"), (F.col("o_orderstatus") == "F").alias("start_inferred"), (F.col("o_orderstatus") == "O").alias("is_open"))
    links = e.select(F.col("d").cast("string").alias("node"), F.when(F.col("gap") > 7, "LOW").otherwise("HIGH").alias("link_confidence"))
    return accounts.chain_roles(graph.ordered_chains(e, "s", "d", "at"), lives, links).select("node", "segment_type", "account_type", "weakest_link")


@query("""
WITH x AS (SELECT user_id, event_id, event_type, lag(value) OVER w AS before, lag(event_type) OVER w AS lt, row_number() OVER w AS event_seq FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts))
SELECT event_id, event_seq, CASE WHEN event_type = 'signup' OR coalesce(lt = 'error', false) THEN NULL ELSE round(before, 6) END AS from_id FROM x""")
def port_sequence(t):
    return accounts.port_sequence(t("events"), "user_id", "ts", "value", "event_type", "signup", "error").select("event_id", "event_seq", "from_id")


@query("""
WITH a AS (SELECT event_id AS from_id, lead(event_id) OVER w AS to_id, lead(ts) OVER w AS to_ts, event_type = lead(event_type) OVER w AS same FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
b AS (SELECT event_id AS from_id, lead(event_id) OVER w AS to_id, lead(ts) OVER w AS to_ts FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)),
c AS (SELECT from_id, to_id, to_ts, 'direct' AS route, 0 AS r FROM a WHERE same UNION ALL SELECT from_id, to_id, to_ts, 'kind', 1 FROM b WHERE to_id IS NOT NULL)
SELECT from_id, to_id, to_ts, route FROM (SELECT *, row_number() OVER (PARTITION BY from_id ORDER BY r, to_ts, to_id) AS n FROM c) WHERE n = 1""")
def edges_by_route(t):
    w, k = Window.partitionBy("user_id").orderBy("ts", "event_id"), Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id")
    nxt = lambda x: t("events").select(F.col("event_id").alias("from_id"), F.lead("event_id").over(x).alias("to_id"), F.lead("ts").over(x).alias("to_ts"), (F.col("event_type") == F.lead("event_type").over(x)).alias("same")).where("to_id IS NOT NULL")
    return accounts.best_edges([("direct", nxt(w).where("same")), ("kind", nxt(k))])


def _devices(t) -> DataFrame:
    k = F.when(F.col("event_type") == "error", "end").when(F.col("event_type") == "signup", "sim_end").otherwise("start")
    return t("events").select(F.col("user_id").alias("subscriber"), k.alias("kind"), F.when(F.col("event_type") != "error", (F.floor("value") % 3).cast("string")).alias("device"), F.lit("c").alias("carrier"), "ts", "event_id")


@query()
def device_map(t):
    """A walk with state; tested branch by branch."""
    d = accounts.device_segments(_devices(t))
    lives = sequence.lifecycles(t("events").select(F.col("user_id").alias("subscriber"), F.lit("c").alias("carrier"), F.col("event_type").alias("kind"), "ts", "event_id"), WORDS)
    return accounts.close_at_life_end(d, lives, "subscriber")


@query()
def firmed_boundaries(t):
    """Low starts firmed by evidence and low ends by ports; tested rule by rule."""
    lives = sequence.lifecycles(t("events").select(F.col("user_id").alias("subscriber"), F.lit("c").alias("carrier"), F.col("event_type").alias("kind"), "ts", "event_id"), WORDS)
    low = lives.withColumn("start_confidence", F.when(F.col("start_inferred"), "LOW").otherwise("HIGH")).withColumn("end_confidence", F.lit("LOW")).withColumn("floored", F.year("start_ts") == 1970)
    evidence = t("events").groupBy(F.col("user_id").cast("string").alias("subscriber")).agg((F.min("ts").cast("timestamp") - F.expr("INTERVAL 1 DAY")).alias("since"), F.expr("min(ts) + (max(ts) - min(ts)) / 2").cast("timestamp").alias("asked_at"), F.lit("c").alias("carrier"))
    ports = t("events").where("event_type = 'error'").select(F.col("user_id").cast("string").alias("subscriber"), F.lit("C").alias("from_carrier"), F.col("ts").cast("timestamp").alias("ts"))
    return accounts.firm_ends(accounts.firm_starts(low, evidence, "subscriber"), ports, "subscriber", "lifecycle_uid")


@query("SELECT o_orderkey, o_orderkey % 7 <> 0 AS ok, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS key, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS status, CASE WHEN o_orderkey % 7 <> 0 THEN 2 ELSE 0 END::BIGINT AS n_events FROM orders")
def xml_documents(t):
    text = F.concat(F.lit("<R><Owner><Key>"), "o_custkey", F.lit("</Key></Owner><Status> "), "o_orderstatus", F.lit(" </Status><Past><Step><To>1</To></Step><Step><To>2</To></Step></Past></R>"))
    text = F.when(F.col("o_orderkey") % 7 == 0, F.substring(text, 1, 20)).otherwise(text)
    d = t("orders").select("o_orderkey", xml.parsed(text, "Owner/Key", "Past", "Step").alias("p"))
    return d.select("o_orderkey", "p.ok", "p.key", F.col("p.leaves")["Status"].alias("status"), F.size("p.events").alias("n_events"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'north' END AS parent FROM orders")
def parent_rollup(t):
    return t("orders").select("o_orderkey", accounts.parent_of(F.col("o_orderstatus"), {"F": "brand1", "O": "brand2"}, {"brand1": "north", "brand2": "south"}, ["north"]).alias("parent"))


# Dedup, keys, cleaning


@query("SELECT lang, source, sha256(text) AS h, min(doc_id) AS doc_id, min(n_chars) AS n_chars FROM documents GROUP BY lang, source, text")
def exact_dedup(t):
    found = dedup.exact_duplicates(t("documents"), ["lang", "source", "text"], ["doc_id", "n_chars"])
    return found.select("lang", "source", F.sha2("text", 256).alias("h"), "doc_id", "n_chars")


@query("SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1")
def latest_response(t):
    return dedup.latest(t("orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderstatus"])


@query("SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT CAST(l_suppkey AS VARCHAR))), ',') AS ids, count(*) AS n FROM lineitem GROUP BY l_orderkey")
def sorted_id_collapse(t):
    return dedup.collapsed(t("lineitem"), ["l_orderkey"], "l_suppkey")


@query("SELECT o_orderkey, sha256(concat_ws('|', 'order', '1', CAST(o_custkey AS VARCHAR), strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), coalesce(o_orderpriority, ''))) AS uid FROM orders")
def surrogate_keys(t):
    return t("orders").select("o_orderkey", C.surrogate_key(F.lit("order"), F.lit(1), F.col("o_custkey"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.col("o_orderpriority")).alias("uid"))


@query("SELECT o_orderkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS request_id FROM (SELECT o_orderkey, sha256(CAST(o_orderkey AS VARCHAR)) AS h FROM orders)")
def uuid_keys(t):
    return t("orders").select("o_orderkey", C.uuid_like(F.col("o_orderkey")).alias("request_id"))


@query("""
WITH r AS (SELECT event_id, CASE WHEN trim(x) IN ('', '\\N') THEN NULL ELSE trim(x) END AS c FROM (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN ' \\N' WHEN event_id % 7 = 0 THEN 'k' || event_id ELSE ' ' || regexp_extract(props, '\\d+') || ' ' END AS x FROM events))
SELECT event_id, c, try_cast(CASE WHEN regexp_full_match(c, '\\d+') THEN c END AS BIGINT) AS k, c IS NOT NULL AND try_cast(CASE WHEN regexp_full_match(c, '\\d+') THEN c END AS BIGINT) IS NULL AS bad_k,
  CASE WHEN regexp_full_match(c, '\\d{1,10}') THEN lpad(c, 10, '0') ELSE c END AS padded FROM r""")
def safe_cast_clean(t):
    raw = F.when(F.col("event_id") % 5 == 0, F.lit(" \\N")).when(F.col("event_id") % 7 == 0, F.concat(F.lit("k"), "event_id")).otherwise(F.concat(F.lit(" "), F.regexp_extract("props", r"\d+", 0), F.lit(" ")))
    d = C.with_long(t("events").select("event_id", raw.alias("x")), "x", "k")
    return d.select("event_id", C.clean(F.col("x")).alias("c"), "k", F.col("_bad_k").alias("bad_k"), C.padded_id(C.clean(F.col("x"))).alias("padded"))


@query("""SELECT event_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k, event_id % 9 = 0 AS malformed FROM events""")
def json_notes(t):
    d = t("events").select("event_id", F.when(F.col("event_id") % 9 == 0, F.substring("props", 2, 99)).otherwise(F.col("props")).alias("notes"))
    return C.with_json(d, "notes", "n", "k bigint").select("event_id", F.col("n.k").alias("k"), F.col("_bad_n").alias("malformed"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS status FROM orders")
def map_lookup(t):
    return t("orders").select("o_orderkey", C.looked_up(F.col("o_orderstatus"), {"F": "finished", "O": "open"}).alias("status"))


@query("SELECT event_id, make_timestamp(epoch_us(ts) // 1000 * 1000) AS moment, CAST(ts AS DATE) AS d FROM events")
def epoch_moments(t):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    at = C.epoch_ms(ms)
    return t("events").select("event_id", at.cast("timestamp_ntz").alias("moment"), F.to_date(at).alias("d"))


# Quality

ORDER_RULES = [
    quality.Rule("r_required", "required", "o_orderstatus"),
    quality.Rule("r_allowed", "allowed", "o_orderstatus", options={"values": ["F", "O"]}),
    quality.Rule("r_regex", "regex", "o_orderpriority", "warn", {"pattern": "^[1-3]"}),
    quality.Rule("r_positive", "positive", "o_totalprice"),
    quality.Rule("r_group", "by_group", "o_orderpriority", "warn", {"group": "o_orderstatus", "allowed": {"P": ["1-URGENT", "2-HIGH"]}}),
    quality.Rule("r_future", "future", "o_orderdate", "warn", {"now": "1998-01-01 00:00:00"}),
    quality.Rule("r_when", "required_when", "o_totalprice", options={"when": "o_orderstatus = 'F'"}),
]
ORDER_BAD = {
    "r_required": ("o_orderstatus IS NULL", "error"),
    "r_allowed": ("o_orderstatus NOT IN ('F', 'O')", "error"),
    "r_regex": ("NOT regexp_matches(o_orderpriority, '^[1-3]')", "warn"),
    "r_positive": ("o_totalprice <= 0", "error"),
    "r_group": ("o_orderstatus = 'P' AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH')", "warn"),
    "r_future": ("o_orderdate > TIMESTAMP '1998-01-01 00:00:00'", "warn"),
    "r_when": ("o_totalprice IS NULL AND o_orderstatus = 'F'", "error"),
}


@query(" UNION ALL ".join(f"SELECT o_orderkey, '{k}' AS rule_id, '{s}' AS severity FROM orders WHERE {c}" for k, (c, s) in ORDER_BAD.items()))
def rule_issues(t):
    return quality.issue_rows(quality.annotate(t("orders"), ORDER_RULES, "o_orderkey"), ["o_orderkey"])


@query("SELECT has_errors, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS ids FROM (SELECT o_orderkey, " + " OR ".join(f"coalesce({c}, false)" for c, s in ORDER_BAD.values() if s == "error") + " AS has_errors FROM orders) GROUP BY has_errors")
def quarantine_split(t):
    good, bad = quality.split(quality.annotate(t("orders"), ORDER_RULES))
    rows = good.select("o_orderkey", F.lit(False).alias("has_errors")).union(bad.select("o_orderkey", F.lit(True)))
    return rows.groupBy("has_errors").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("ids"))


@query("""SELECT sha256(concat_ws('|', 'orders', CAST(o_orderkey AS VARCHAR), 'r_allowed' || CASE WHEN regexp_matches(o_orderpriority, '^[1-3]') THEN '' ELSE ',r_regex' END)) AS quarantine_id, 'orders' AS dataset, o_orderkey,
  'r_allowed' || CASE WHEN regexp_matches(o_orderpriority, '^[1-3]') THEN '' ELSE ',r_regex' END AS rules FROM orders WHERE o_orderstatus NOT IN ('F', 'O')""")
def quarantine_records(t):
    a = quality.annotate(t("orders"), [r for r in ORDER_RULES if r.rule_id in ("r_allowed", "r_regex")]).where("has_errors")
    return quality.quarantine(a, "orders", ["o_orderkey"]).drop("payload")


@query(
    " UNION ALL ".join(
        f"SELECT o_orderstatus AS grp, '{n}' AS name, '{d}' AS dimension, '{s}' AS severity, count(*) AS total, count(*) FILTER (coalesce({c}, false)) AS failed FROM orders GROUP BY o_orderstatus"
        for n, d, s, c in (
            ("completeness_o_totalprice", "completeness", "abort", "o_totalprice IS NULL"),
            ("consistency_o_orderpriority_domain", "consistency", "abort", "coalesce(o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM'), true)"),
            ("validity_o_orderpriority_format", "validity", "warn", "NOT regexp_matches(o_orderpriority, '^\\d-[A-Z]+$')"),
            ("large", "info", "info", "o_totalprice > 1000"),
        )
    )
)
def dq_metrics_by_group(t):
    checks = [
        quality.not_null("o_totalprice"),
        quality.in_domain("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]),
        quality.matches_when_present("o_orderpriority", r"^\d-[A-Z]+$"),
        quality.counter("large", F.col("o_totalprice") > 1000),
    ]
    return quality.run_checks(t("orders"), checks, "o_orderstatus")


@query("""SELECT 'all' AS grp, 'uniqueness_l_orderkey_l_linenumber' AS name, 'uniqueness' AS dimension, 'abort' AS severity, (SELECT count(*) FROM lineitem) AS total, (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS failed
UNION ALL SELECT 'all', 'uniqueness_l_partkey', 'uniqueness', 'abort', (SELECT count(*) FROM lineitem), (SELECT count(*) - count(DISTINCT l_partkey) FROM lineitem)""")
def uniqueness_checks(t):
    return quality.run_checks(t("lineitem"), [quality.unique_by(["l_orderkey", "l_linenumber"]), quality.unique_by(["l_partkey"])])


@query("SELECT 'all' AS grp, 'referential_o_custkey' AS name, 'consistency' AS dimension, 'abort' AS severity, (SELECT count(*) FROM orders) AS total, (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')) AS failed")
def referential_check(t):
    return quality.run_checks(t("orders"), [quality.references("o_custkey", t("customer").where("c_mktsegment <> 'BUILDING'"), "c_custkey")])


@query("SELECT count(*) AS failed FROM (SELECT text FROM documents GROUP BY text HAVING count(DISTINCT source) > 1)")
def hash_fan_out(t):
    return quality.fan_out("text", "source").frame(t("documents"))


@query("SELECT CAST(hour(ts) AS BIGINT) AS hour, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, hour LIMIT 1")
def modal_hour(t):
    return quality.modal_hour(t("events"), "ts")


# Merging


@query("SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-12 00:00:00'")
def incremental_window(t):
    return in_window(t("events"), "ts", "2024-01-05 00:00:00", "2024-01-12 00:00:00").select("event_id", "ts")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def publish_insert_only(t):
    """All orders against a target that has those with a returned line."""
    published = t("lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return merge.new_rows(t("orders").select("o_orderkey"), published, "o_orderkey")


@query("""
WITH target AS (SELECT * FROM orders WHERE o_orderkey % 4 <> 0), scope AS (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey % 3 = 0),
source AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_custkey % 3 = 0 AND o_orderkey % 7 <> 0)
SELECT s.o_orderkey, s.o_custkey, s.o_orderstatus, CASE WHEN t.o_orderkey IS NULL THEN 'insert' WHEN s.o_orderstatus IS DISTINCT FROM t.o_orderstatus THEN 'update' ELSE 'same' END AS action FROM source s LEFT JOIN target t ON s.o_orderkey = t.o_orderkey AND t.o_custkey IN (SELECT o_custkey FROM scope)
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, 'untouched' FROM target WHERE o_custkey NOT IN (SELECT o_custkey FROM scope)""")
def scoped_merge(t):
    o = t("orders")
    source = o.where("o_custkey % 3 = 0 AND o_orderkey % 7 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.col("o_orderstatus")))
    scope = o.where("o_custkey % 3 = 0").select("o_custkey")
    merged = merge.scoped_merge(source, o.where("o_orderkey % 4 <> 0"), scope, "o_custkey", ["o_orderkey"], ["o_orderstatus", "o_totalprice"], ["o_orderdate"])
    return merged.select("o_orderkey", "o_custkey", "o_orderstatus", "action")


@query("SELECT c_custkey FROM customer WHERE CAST('0x' || substr(md5('salt::' || c_custkey), 1, 8) AS BIGINT) % 10 < 3")
def cohort_sample(t):
    """A sampling operator."""
    return t("customer").where(dedup.in_cohort(F.col("c_custkey"), "salt", 10, 3)).select("c_custkey")


# Feeds

ACCOUNT = silver.Feed(
    {"id": ["id"], "timestamp": ["timestamp"], "change_key": ["change_key"], "change_type": ["change_type"], "notes": ["notes"]},
    {"record_id": "long", "event_timestamp": "timestamp_ntz", "mno": "string", "subId": "string", "phone_number_AC_hash": "string", "event_type": "string", "event_date": "date", "source_name": "string", "schema_version": "string"},
    frozenset({"id", "timestamp"}),
    ["mno", *silver.BELL_NOTES],
    source_name="account_changes",
)


@query("""SELECT CASE WHEN event_id % 11 > 0 THEN event_id END AS record_id, date_trunc('second', ts) AS event_timestamp, CASE event_id % 5 WHEN 0 THEN 'BELL' WHEN 1 THEN 'TELUS' WHEN 2 THEN 'BELL' WHEN 3 THEN 'ROGERS' END AS mno,
CASE WHEN event_id % 5 = 2 THEN '7' WHEN event_id % 10 = 8 THEN '1' END AS "subId", CAST(user_id AS VARCHAR) AS "phone_number_AC_hash", upper(event_type) AS event_type, CAST(ts AS DATE) AS event_date, 'account_changes' AS source_name, '1' AS schema_version,
event_id % 5 = 4 AS _bad_notes, event_id % 11 = 0 AS _bad_record_id, false AS _bad_event_timestamp, event_id % 10 = 8 AS _warn_rogers_notes FROM events""")
def silver_account(t):
    n = F.col("event_id") % 5
    notes = F.when(n == 0, '{"mno": "bell_landline"}').when(n == 1, '{"mno": " telus ", "subId": "\\\\N"}').when(n == 2, '{"subId": 7}').when(F.col("event_id") % 10 == 8, '{"mno": "rogers", "subId": "1"}').when(n == 3, "\\N").otherwise("no json")
    key = F.when(F.col("event_id") % 11 > 0, F.col("event_id").cast("string")).otherwise("x1")
    raw = t("events").select(key.alias("ID"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), F.concat(F.lit(" "), F.col("user_id").cast("string")).alias("change_key"), F.col("event_type").alias("change_type"), notes.alias("notes"))
    return silver.account(raw, ACCOUNT, F.current_timestamp()).drop("_raw_payload", "_source_file", "_source_row_id")


DEVICE = silver.Feed(
    {c: [c] for c in ("id", "timestamp", "date", "change_key", "change_key_ats", "imei", "imsi", "related_id", "mno", "status", "notes")},
    {"record_id": "long", "event_timestamp": "timestamp_ntz", "date": "date", "imei": "string", "mno": "string", "event_type": "string", "tac": "string", "event_date": "date"},
    notes=["correlationId", "tac", "oldIMSI", "oldIMEI", "fromADCSnapshot"],
)


@query("""SELECT event_id AS record_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS event_timestamp, CASE WHEN event_id % 2 > 0 THEN CAST(ts AS DATE) END AS date, CAST(user_id AS VARCHAR) AS imei, 'BELL' AS mno, upper(event_type) AS event_type, CAST(event_id AS VARCHAR) AS tac, CAST(ts AS DATE) AS event_date,
false AS _bad_notes, false AS _bad_record_id, false AS _bad_event_timestamp, event_id % 2 = 0 AS _bad_date FROM events""")
def silver_device(t):
    day = F.date_format("ts", "yyyy-MM-dd")
    raw = t("events").select(F.col("event_id").alias("id"), day.alias("timestamp"), F.when(F.col("event_id") % 2 > 0, day).otherwise("2024-02-31").alias("date"), F.col("user_id").alias("imei"), F.lit("bell").alias("mno"), F.col("event_type").alias("status"), F.to_json(F.struct(F.col("event_id").alias("tac"))).alias("notes"))
    return silver.device(raw, DEVICE, F.current_timestamp()).drop("_raw_payload", "_source_file", "_source_row_id")


AUDIT = silver.Feed(
    {c: [c] for c in ("id", "timestamp", "date", "processing_time", "timestamp_ms", "msisdn", "hashed_msisdn", "encrypted_msisdn", "brand", "source_ip", "request_id", "operation", "mno", "response_code", "partner_id", "service_provider_id")},
    {"record_id": "string", "api_timestamp": "timestamp_ntz", "timestamp_ms": "timestamp_ntz", "processing_time_ms": "long", "partner_id": "string", "partner_name": "string", "api_type": "string"},
    test_partners=["3"],
    api_types={"PURCHASE": "BUY"},
)


@query("""SELECT CAST(event_id AS VARCHAR) AS record_id, date_trunc('second', ts) AS api_timestamp, CASE WHEN event_id % 3 > 0 THEN TIMESTAMP '1970-01-01 00:00:01' END AS timestamp_ms, -5::BIGINT AS processing_time_ms, lpad(CAST(user_id % 9 AS VARCHAR), 10, '0') AS partner_id, n_name AS partner_name,
CASE event_type WHEN 'purchase' THEN 'BUY' ELSE upper(event_type) END AS api_type, false AS _bad_api_timestamp, false AS _bad_date, false AS _bad_processing_time_ms, event_id % 3 = 0 AS _bad_timestamp_ms,
event_type <> 'purchase' AS _warn_unknown_api, n_name IS NULL AS _warn_partner_reference, false AS _warn_provider_reference FROM events LEFT JOIN nation ON n_nationkey = user_id % 9 AND n_nationkey < 7 WHERE user_id % 9 <> 3""")
def silver_audit(t):
    raw = t("events").select(F.col("event_id").alias("id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), F.lit("-5").alias("processing_time"), F.when(F.col("event_id") % 3 > 0, "1000").otherwise("999999999999999").alias("timestamp_ms"), (F.col("user_id") % 9).alias("partner_id"), F.col("event_type").alias("operation"))
    partners = t("nation").where("n_nationkey < 7").select(F.lpad(F.col("n_nationkey").cast("string"), 10, "0").alias("partner_id"), F.col("n_name").alias("partner_name"))
    providers = partners.select(F.col("partner_id").alias("service_provider_id")).limit(0)
    kept, _ = silver.audit(raw, AUDIT, partners, providers)
    return kept.drop("_raw_payload", "_source_file", "_source_row_id")


# Scoring

LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS feature, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_rate, round(var_samp({c}), 6) AS variance, round(quantile_cont({c}, 0.95) - quantile_cont({c}, 0.05), 6) AS spread FROM lineitem" for c in LINE))
def feature_profile(t):
    return scoring.profile(t("lineitem"), LINE)


@query("WITH p AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, (quantile_cont({c}, 0.95) - quantile_cont({c}, 0.05)) * {1.1 if c == 'l_tax' else 1.0} AS score FROM lineitem" for c in LINE) + ") SELECT feature, round(score, 6) AS score, row_number() OVER (ORDER BY score DESC, feature) AS place FROM p")
def feature_ranking(t):
    return scoring.ranked_features(scoring.profile(t("lineitem"), LINE), ["l_tax"]).select("feature", "score", "place")


@query("""
WITH r AS (SELECT l_quantity AS v FROM lineitem WHERE l_linenumber <= 3), c AS (SELECT l_quantity + l_linenumber AS v FROM lineitem WHERE l_linenumber > 3),
e AS (SELECT list_distinct(quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS edges FROM r),
b AS (SELECT 1 AS ref, len(list_filter(edges, lambda x: v > x)) AS bin FROM r, e UNION ALL SELECT 0, len(list_filter(edges, lambda x: v > x)) FROM c, e),
n AS (SELECT sum(ref) AS nr, sum(1 - ref) AS nc FROM b), g AS (SELECT bin, sum(ref) AS r, sum(1 - ref) AS c FROM b GROUP BY bin),
s AS (SELECT greatest(r / nr, 0.1 / greatest(nr, nc)) AS p, greatest(c / nc, 0.1 / greatest(nr, nc)) AS q FROM g, n) SELECT round(sum((q - p) * ln(q / p)), 6) AS psi FROM s""")
def psi_drift(t):
    line = t("lineitem")
    return scoring.psi(line.where("l_linenumber <= 3").select(F.col("l_quantity").alias("v")), line.where("l_linenumber > 3").select((F.col("l_quantity") + F.col("l_linenumber")).alias("v")), "v")


@query("""
WITH a AS (SELECT o_orderpriority AS v, count(*) AS c FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), b AS (SELECT o_orderpriority AS v, count(*) AS c FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1)
SELECT round(sum(abs(coalesce(a.c, 0) / (SELECT sum(c) FROM a) - coalesce(b.c, 0) / (SELECT sum(c) FROM b))) / 2, 6) AS distance FROM a FULL JOIN b ON a.v = b.v""")
def total_variation(t):
    return scoring.total_variation(t("orders").where("o_orderstatus = 'F'"), t("orders").where("o_orderstatus <> 'F'"), "o_orderpriority")


def scored_documents(t) -> DataFrame:
    return t("documents").select("doc_id", F.col("n_chars").cast("double").alias("score")).join(t("labels"), "doc_id").select("doc_id", "score", "toxic", "quality")


SCORED = "d AS (SELECT doc_id, CAST(n_chars AS DOUBLE) AS score, toxic, quality FROM documents JOIN labels USING (doc_id))"


@query(f"""WITH {SCORED}, p AS (SELECT *, row_number() OVER (ORDER BY score DESC, CAST(doc_id AS VARCHAR)) AS n FROM d), t AS (SELECT count(*) AS n, sum(toxic) AS pos FROM d), k AS (SELECT unnest([10, 50, 100]) AS k)
SELECT CAST(k AS BIGINT) AS k, CAST(sum(toxic) AS BIGINT) AS hits, round(sum(toxic) / count(*), 6) AS precision, round(sum(toxic) / any_value(pos), 6) AS recall, round(sum(toxic) / count(*) / (any_value(pos) / any_value(t.n)), 6) AS lift, min(score) AS score_at_k
FROM k JOIN p ON p.n <= k, t GROUP BY k""")
def topk_metrics(t):
    return scoring.top_k_metrics(scored_documents(t), "doc_id", "score", "toxic", [10, 50, 100])


@query(f"""WITH {SCORED}, r AS (SELECT quality AS y, (rank() OVER (ORDER BY score) + rank() OVER (ORDER BY score) + count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM d),
s AS (SELECT count(*) FILTER (y = 1) AS n_pos, count(*) FILTER (y <> 1) AS n_neg, sum(r) FILTER (y = 1) AS rs FROM r) SELECT n_pos, n_neg, round((rs - n_pos * (n_pos + 1) / 2.0) / (n_pos * n_neg), 6) AS auc FROM s""")
def rank_auc(t):
    return scoring.rank_auc(scored_documents(t), "score", "quality")


@query(f"""WITH {SCORED}, c AS (SELECT score, count(*) AS n, sum(quality) AS p FROM d GROUP BY score), u AS (SELECT p, sum(n) OVER (ORDER BY score DESC) AS taken, sum(p) OVER (ORDER BY score DESC) AS hits FROM c)
SELECT round(sum(hits / taken * p) / (SELECT sum(quality) FROM d), 6) AS ap FROM u""")
def average_precision(t):
    return scoring.average_precision(scored_documents(t), "score", "quality")


@query(f"""WITH {SCORED}, c AS (SELECT score, count(*) AS n, sum(quality) AS p FROM d GROUP BY score), u AS (SELECT score, p, sum(n) OVER (ORDER BY score DESC) AS taken, sum(p) OVER (ORDER BY score DESC) AS hits FROM c)
SELECT score AS threshold, round(hits / taken, 6) AS precision, round(hits / (SELECT sum(quality) FROM d), 6) AS recall FROM u WHERE p > 0 AND hits / taken >= 0.5 ORDER BY hits DESC, score DESC LIMIT 1""")
def threshold_search(t):
    return scoring.best_threshold(scored_documents(t), "score", "quality", 0.5)


@query("""
WITH m AS (SELECT o_orderpriority AS model, o_orderstatus AS scenario, avg(o_totalprice) AS v FROM orders GROUP BY ALL),
a AS (SELECT model, round(avg(v), 6) AS mean, round(quantile_cont(v, 0.5), 6) AS median, round(min(v), 6) AS least, round(max(v), 6) AS most, count(DISTINCT scenario) AS scenarios FROM m GROUP BY model)
SELECT *, row_number() OVER (ORDER BY mean DESC, most - least, model) AS place FROM a""")
def leaderboard(t):
    m = t("orders").groupBy(F.col("o_orderpriority").alias("model"), F.col("o_orderstatus").alias("scenario")).agg(F.avg("o_totalprice").alias("v"))
    return scoring.leaderboard(m, ["model"], "scenario", "v")


ORDER = ["o_totalprice", "o_custkey"]


@query(
    "WITH "
    + ", ".join(
        f"c{i} AS (SELECT o_orderkey, -ln(count(*) OVER (ORDER BY {c} RANGE UNBOUNDED PRECEDING) / count(*) OVER ()) AS lt, -ln(count(*) OVER (ORDER BY {c} DESC RANGE UNBOUNDED PRECEDING) / count(*) OVER ()) AS rt, (SELECT skewness({c}) FROM orders) AS sk FROM orders)"
        for i, c in enumerate(ORDER)
    )
    + " SELECT o_orderkey, round(greatest(c0.lt + c1.lt, c0.rt + c1.rt, CASE WHEN c0.sk < 0 THEN c0.lt ELSE c0.rt END + CASE WHEN c1.sk < 0 THEN c1.lt ELSE c1.rt END), 6) AS score FROM c0 JOIN c1 USING (o_orderkey)"
)
def tail_probability_score(t):
    return scoring.tail_probability(t("orders"), "o_orderkey", ORDER)


@query(
    "WITH l AS (SELECT o_orderkey, o_totalprice AS a, o_custkey AS b FROM orders), s AS (SELECT min(a) AS a0, max(a) AS a1, min(b) AS b0, max(b) AS b1, count(*) AS n FROM l), "
    "k AS (SELECT o_orderkey, least(floor((a - a0) / ((a1 - a0) / 10)), 9) AS x, least(floor((b - b0) / ((b1 - b0) / 10)), 9) AS y, n FROM l, s) "
    "SELECT o_orderkey, round(-ln(count(*) OVER (PARTITION BY x) / n) - ln(count(*) OVER (PARTITION BY y) / n), 6) AS score FROM k"
)
def histogram_score(t):
    return scoring.histogram_score(t("orders"), "o_orderkey", ORDER)


@query()
def kmeans_anomaly(t):
    line = t("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), *LINE)
    return scoring.kmeans_score(line, "id", LINE, 4)


@query()
def pca_anomaly(t):
    line = t("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), *LINE)
    return scoring.pca_score(line, "id", LINE, 2)


@query()
def isolation_forest(t):
    line = t("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), *LINE)
    return scoring.isolation_scores(line, "id", LINE)


@query()
def mondrian_forest(t):
    line = t("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), *LINE)
    return scoring.isolation_scores(line, "id", LINE, mondrian=True)


@query("""
WITH s AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_discount >= 0.08 THEN 'fraud' WHEN l_discount <= 0.04 THEN 'normal' ELSE 'uncertain' END AS a, CASE WHEN l_quantity >= 45 THEN 'fraud' WHEN l_quantity <= 30 THEN 'normal' ELSE 'uncertain' END AS b FROM lineitem)
SELECT l_orderkey, l_linenumber, a, b, CAST(CASE a WHEN 'fraud' THEN 3.0 WHEN 'uncertain' THEN 1.5 ELSE 0.0 END + CASE b WHEN 'fraud' THEN 1.0 WHEN 'uncertain' THEN 0.5 ELSE 0.0 END AS DOUBLE) AS score FROM s""")
def rule_scores(t):
    d = t("lineitem").select("l_orderkey", "l_linenumber", scoring.signal(F.col("l_discount"), 0.08, 0.04).alias("a"), scoring.signal(F.col("l_quantity"), 45, 30).alias("b"))
    return d.withColumn("score", scoring.rule_score({"a": "H", "b": "L"}))


@query("SELECT CAST(floor(o_totalprice / 1000) AS BIGINT) AS bin, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O FROM orders GROUP BY 1")
def pivot_histogram(t):
    return t("orders").groupBy(F.floor(F.col("o_totalprice") / 1000).alias("bin")).pivot("o_orderstatus", ["F", "O"]).count().fillna(0)


@query("""WITH p AS (SELECT * FROM labels WHERE toxic = 1), n AS (SELECT *, row_number() OVER (ORDER BY md5('0::' || doc_id), doc_id) AS place FROM labels WHERE toxic IS DISTINCT FROM 1)
SELECT doc_id, CAST(quality AS BIGINT) AS quality, CAST(toxic AS BIGINT) AS toxic FROM p UNION ALL SELECT doc_id, quality, toxic FROM n WHERE place <= greatest(0, 200 - (SELECT count(*) FROM p))""")
def stratified_cap(t):
    """A sampling operator: every positive, and a hash sample of the rest."""
    return dedup.kept_positives(t("labels"), F.col("toxic") == 1, 200, "doc_id")


def _drift_sql(col: str) -> str:
    """Reference: linenumber <= 3; current: the others, the discount null on every tenth of them and the quantity shifted."""
    now = {"l_quantity": "l_quantity + 10", "l_discount": "CASE WHEN l_orderkey % 5 > 0 THEN l_discount END"}.get(col, col)
    return f"""SELECT '{col}' AS feature, nulls_r AS reference_null_share, nulls_c AS batch_null_share, abs(nulls_c - nulls_r) AS null_share_shift, psi FROM (
WITH r AS (SELECT CAST({col} AS DOUBLE) AS v FROM lineitem WHERE l_linenumber <= 3), c AS (SELECT CAST({now} AS DOUBLE) AS v FROM lineitem WHERE l_linenumber > 3),
e AS (SELECT list_distinct(quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS edges FROM r),
b AS (SELECT 1 AS ref, len(list_filter(edges, lambda x: v > x)) AS bin FROM r, e WHERE v IS NOT NULL UNION ALL SELECT 0, len(list_filter(edges, lambda x: v > x)) FROM c, e WHERE v IS NOT NULL),
n AS (SELECT sum(ref) AS nr, sum(1 - ref) AS nc FROM b), g AS (SELECT bin, sum(ref) AS r, sum(1 - ref) AS c FROM b GROUP BY bin),
s AS (SELECT greatest(r / nr, 0.1 / greatest(nr, nc)) AS p, greatest(c / nc, 0.1 / greatest(nr, nc)) AS q FROM g, n)
SELECT (SELECT avg(CASE WHEN v IS NULL THEN 1.0 ELSE 0.0 END) FROM r) AS nulls_r, (SELECT avg(CASE WHEN v IS NULL THEN 1.0 ELSE 0.0 END) FROM c) AS nulls_c, sum((q - p) * ln(q / p)) AS psi FROM s)"""


DRIFT = "d AS (" + " UNION ALL ".join(_drift_sql(c) for c in LINE) + ")"


def _drift(t) -> DataFrame:
    line = t("lineitem")
    now = line.where("l_linenumber > 3").withColumns({"l_quantity": F.col("l_quantity") + 10, "l_discount": F.when(F.col("l_orderkey") % 5 > 0, F.col("l_discount"))})
    return scoring.feature_drift(line.where("l_linenumber <= 3"), now, LINE)


@query(f"""WITH {DRIFT} SELECT feature, round(reference_null_share, 6) AS reference_null_share, round(batch_null_share, 6) AS batch_null_share, round(null_share_shift, 6) AS null_share_shift, round(psi, 6) AS psi,
CASE WHEN psi > 0.2 THEN 'drifted' ELSE 'ok' END AS status, null_share_shift > 0.1 AS null_shift_flag FROM d""")
def feature_drift(t):
    return _drift(t)


@query(f"""WITH {DRIFT}, a AS (SELECT count(*) AS n, count(*) FILTER (psi > 0.2) AS k, count(*) FILTER (null_share_shift > 0.1) AS z, max(CASE WHEN feature = 'l_tax' THEN psi END) AS p FROM d)
SELECT n AS n_features, n AS n_evaluated, k AS n_drifted, round(k / n, 6) AS share_drifted, z AS n_null_shift, round(p, 6) AS score_psi, p > 0.2 OR k / n >= 0.25 AS retrain FROM a""")
def retrain_decision(t):
    found = _drift(t)
    return scoring.retrain_decision(found, found.where("feature = 'l_tax'").select("psi"))


RAW_ORDER = "SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice END AS price, CASE WHEN o_orderkey % 4 > 0 THEN o_custkey END AS visits_cnt, CASE WHEN o_orderkey % 5 > 0 THEN o_totalprice / 1000 END AS days_since_last, o_custkey * 2.0 AS cust_node_tenure_days, CASE WHEN o_orderkey % 7 > 0 THEN ln(o_totalprice) END AS hour_entropy FROM orders"
FILLED_COLUMNS = ["price", "visits_cnt", "days_since_last", "hour_entropy"]


@query(f"""WITH x AS ({RAW_ORDER}), f AS (SELECT o_orderkey, price IS NULL AS pm, visits_cnt IS NULL AS vm, days_since_last IS NULL AS dm, hour_entropy IS NULL AS hm, CAST(coalesce(price, (SELECT quantile_cont(price, 0.5) FROM x)) AS DOUBLE) AS price, CAST(coalesce(visits_cnt, 0) AS DOUBLE) AS visits_cnt,
CAST(coalesce(days_since_last, cust_node_tenure_days) AS DOUBLE) AS days_since_last, coalesce(hour_entropy, (SELECT avg(hour_entropy) FROM x)) AS hour_entropy FROM x)
SELECT o_orderkey, {", ".join(f"round(({c} - (SELECT quantile_cont({c}, 0.5) FROM f)) / (SELECT quantile_cont({c}, 0.95) - quantile_cont({c}, 0.05) FROM f), 6) AS {c}" for c in FILLED_COLUMNS)},
CAST(pm AS BIGINT) AS price_missing, CAST(vm AS BIGINT) AS visits_cnt_missing, CAST(dm AS BIGINT) AS days_since_last_missing, CAST(hm AS BIGINT) AS hour_entropy_missing FROM f""")
def preprocessed(t):
    k = F.col("o_orderkey")
    price = F.col("o_totalprice")
    df = t("orders").select("o_orderkey", F.when(k % 3 > 0, price).alias("price"), F.when(k % 4 > 0, F.col("o_custkey")).alias("visits_cnt"), F.when(k % 5 > 0, price / 1000).alias("days_since_last"), (F.col("o_custkey") * 2.0).alias("cust_node_tenure_days"), F.when(k % 7 > 0, F.log(price)).alias("hour_entropy"))
    fitted = preprocess.fit(df, FILLED_COLUMNS, preprocess.variant("domain_impute_with_missing_indicators_robust_scaler"))
    return fitted.apply(df).drop("cust_node_tenure_days")


@query("""
WITH f AS (SELECT source, min(doc_id) AS doc_id FROM documents JOIN labels USING (doc_id) WHERE toxic = 1 GROUP BY source)
SELECT d.doc_id, 1::BIGINT AS label FROM f d UNION ALL SELECT doc_id, 0 FROM documents JOIN labels USING (doc_id) WHERE toxic = 0 AND lang NOT IN (SELECT lang FROM documents JOIN f USING (doc_id) WHERE lang = 'de')""")
def case_dedup_decontaminate(t):
    d = t("documents").select("doc_id", "source", "lang").join(t("labels"), "doc_id")
    cases = dedup.exact_duplicates(d.where("toxic = 1"), ["source"], ["doc_id"])
    tainted = d.join(cases.select("doc_id"), "doc_id", "left_semi").where("lang = 'de'").select("lang").distinct()
    return cases.select("doc_id", F.lit(1).alias("label")).union(d.where("toxic = 0").join(tainted, "lang", "left_anti").select("doc_id", F.lit(0)))


@query(f"WITH {SCORED}, s AS (SELECT doc_id, source, n_chars FROM documents) SELECT source, CAST(max(score) AS DOUBLE) AS score, CAST(max(toxic) AS BIGINT) AS toxic FROM d JOIN s USING (doc_id) GROUP BY source")
def level_aggregation(t):
    d = scored_documents(t).join(t("documents").select("doc_id", "source"), "doc_id")
    return scoring.best_of_level(d, "source", "score", "toxic")


@query("SELECT source, doc_id AS row_id, CAST(n_chars AS DOUBLE) AS score FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS n FROM documents) WHERE n = 1 ORDER BY score DESC, source LIMIT 10")
def review_queue(t):
    return scoring.review_queue(t("documents").select("doc_id", "source", F.col("n_chars").cast("double").alias("score")), "source", "doc_id", "score", 10)


@query("SELECT 'l_quantity' AS a, 'l_extendedprice' AS b, round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem UNION ALL SELECT 'l_quantity', 'l_tax', round(corr(l_quantity, l_tax), 6) FROM lineitem UNION ALL SELECT 'l_extendedprice', 'l_tax', round(corr(l_extendedprice, l_tax), 6) FROM lineitem")
def correlation_pairs(t):
    return scoring.correlations(t("lineitem"), ["l_quantity", "l_extendedprice", "l_tax"])


@query("""
WITH d AS (SELECT toxic, CASE WHEN n_chars > 2000 THEN NULL ELSE n_chars END AS x FROM documents JOIN labels USING (doc_id)), r AS (SELECT avg(CASE WHEN x IS NULL THEN 1.0 ELSE 0.0 END) FILTER (toxic = 1) AS b, avg(CASE WHEN x IS NULL THEN 1.0 ELSE 0.0 END) FILTER (toxic = 0) AS g FROM d)
SELECT 'x' AS feature, round(b, 6) AS bad_null, round(g, 6) AS good_null, round(abs(b - g), 6) AS gap FROM r""")
def null_gap_table(t):
    d = scored_documents(t).withColumn("x", F.when(F.col("score") <= 2000, F.col("score")))
    return scoring.null_gaps(d, ["x"], "toxic")
