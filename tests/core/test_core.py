"""Core operators: every query against its SQL twin, and unit tests of what SQL cannot express."""

import datetime as dt
import math
from types import SimpleNamespace

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

import __spark_entry__
from tidemark.functions import clean
from tidemark.functions import silver, xml
from tidemark.operators import dedup, eligibility, features, graph, joins, lineage, merge, ports, preprocess, quality, scoring, sequence
from tidemark.plans import catalogue
from tidemark.sources import files
from tidemark.streaming.incremental import in_window, publish_stream

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{small}/{t}.parquet')")
    return con


def shown(v):
    return "" if v is None or (isinstance(v, float) and math.isnan(v)) else repr(v)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, small, oracle, name):
    df = catalogue.QUERIES[name](spark, small)
    rows = df.collect()
    if name not in catalogue.ORACLE:
        assert rows
        return
    want = oracle.sql(catalogue.ORACLE[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    assert sorted(tuple(shown(r[c]) for c in columns) for r in rows) == sorted(tuple(shown(r[i]) for i in at) for r in want.fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


# Lifecycle walk, branch by branch

WORDS = sequence.Vocabulary(frozenset({"start"}), frozenset({"port"}), frozenset({"resume"}), frozenset({"end"}))
T0 = dt.datetime(2024, 1, 1)


def lives(*events):
    rows = [SimpleNamespace(kind=k, ts=T0 + dt.timedelta(hours=h), carrier=c, event_id=f"e{i}") for i, (k, h, c) in enumerate(events)]
    hours = lambda t: None if t is None else round((t - T0).total_seconds() / 3600)
    return [(r["carrier"], hours(r["start_ts"]) if r["start_ts"] != sequence.pd.Timestamp(WORDS.floor) else "floor", hours(r["end_ts"]), r["start_inferred"], r["end_inferred"]) for r in sequence.walk(rows, WORDS)]


@pytest.mark.parametrize(
    ("events", "want"),
    [
        ([("start", 0, "a")], [("a", 0, None, False, True)]),
        ([("start", 0, "a"), ("end", 5, "a")], [("a", 0, 5, False, False)]),
        ([("start", 0, "a"), ("start", 5, "a")], [("a", 0, 5, False, True), ("a", 5, None, False, True)]),
        ([("start", 0, "a"), ("port", 5, "b")], [("a", 0, 5, False, True), ("b", 5, None, False, True)]),
        ([("start", 0, "a"), ("x", 5, "b")], [("a", 0, 5, False, True), ("b", 5, None, True, True)]),
        ([("x", 0, "a")], [("a", 0, None, True, True)]),
        ([("resume", 0, "a")], [("a", 0, None, False, True)]),
        ([("start", 0, "a"), ("resume", 5, "a")], [("a", 0, None, False, True)]),
        ([("end", 3, "a")], [("a", "floor", 3, True, False)]),
        ([("start", 0, "a"), ("end", 5, "a"), ("end", 20, "a")], [("a", 0, 5, False, False)]),
        ([("start", 0, "a"), ("end", 5, "a"), ("end", 40, "a")], [("a", 0, 5, False, False), ("a", 5, 40, True, False)]),
        ([("start", 0, "a"), ("port", 5, "b"), ("end", 9, "c")], [("a", 0, 5, False, True), ("b", 5, 9, False, True), ("c", 9, 9, True, False)]),
        ([("start", 0, "a"), ("start", 5, "a"), ("end", 5, "a")], [("a", 0, 5, False, False), ("a", 5, None, False, True)]),
    ],
)
def test_walk(events, want):
    assert lives(*events) == want


def test_lifecycles_never_overlap_and_ids_repeat(spark, small):
    rows = catalogue.QUERIES["lifecycle_walk"](spark, small).collect()
    by = {}
    for r in rows:
        by.setdefault(r.subscriber, []).append(r)
    for rs in by.values():
        rs.sort(key=lambda r: r.lifecycle_no)
        for a, b in zip(rs, rs[1:]):
            assert a.end_ts is not None and a.end_ts <= b.start_ts
        assert sum(r.is_open for r in rs) <= 1
    again = {r.lifecycle_uid for r in catalogue.QUERIES["lifecycle_walk"](spark, small).collect()}
    assert again == {r.lifecycle_uid for r in rows}


def test_interval_subtraction():
    assert sequence.minus(0, 10, [(2, 3), (5, 7)]) == [(0, 2), (3, 5), (7, 10)]
    assert sequence.minus(0, None, [(2, 3)]) == [(0, 2), (3, None)]
    assert sequence.minus(0, None, [(2, None)]) == [(0, 2)]
    assert sequence.minus(0, 10, [(0, 10)]) == [] and sequence.minus(0, 10, []) == [(0, 10)]
    assert sequence.minus(0, 10, [(5, 8), (1, 6)]) == [(0, 1), (8, 10)]


# Graphs


def test_components_of_random_graphs(spark):
    r = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in r.integers(0, 120, (70, 2))] + [(i, i + 1) for i in range(200, 240)] + [(300, i) for i in range(301, 340)] + [(5, None)]
    label = {x: x for e in edges for x in e if None not in e}
    for _ in range(100):
        for a, b in edges:
            if b is not None:
                label[a] = label[b] = min(label[a], label[b])
    got = {x.node: x.component for x in graph.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {k: v for k, v in label.items() if k in got} and all((a == b or b is None or a in got) for a, b in edges)


def test_chains_keep_earliest_edges_and_cut_rings(spark):
    e = [("a", "b", 1), ("a", "c", 2), ("x", "b", 3), ("b", "d", 4), ("p", "q", 1), ("q", "r", 2), ("r", "p", 3), ("s", "s", 1)]
    got = {r.node: (r.root, r.position, r.is_tail) for r in graph.ordered_chains(spark.createDataFrame(e, "s string, d string, t int"), "s", "d", "t").collect()}
    assert got == {"a": ("a", 0, False), "b": ("a", 1, False), "d": ("a", 2, True), "p": ("p", 0, False), "q": ("p", 1, False), "r": ("p", 2, True)}
    long = spark.createDataFrame([(f"n{i:03}", f"n{i + 1:03}", i) for i in range(60)], "s string, d string, t int")
    with pytest.raises(RuntimeError):
        graph.ordered_chains(long, "s", "d", "t")


def test_closure_limits(spark):
    links = spark.createDataFrame([(i, i // 2) for i in range(20)] + [(i + 1, i // 2 + 100) for i in range(20)], "k long, p long")
    seeds = spark.createDataFrame([(0,)], "k long")
    assert graph.closure(seeds, links, "k", "p", rounds=50).count() == 21
    with pytest.raises(RuntimeError):
        graph.closure(seeds, links, "k", "p", rounds=2)
    with pytest.raises(RuntimeError):
        graph.closure(seeds, links, "k", "p", rounds=50, most=3)


# Cleaning


def test_cleaning(spark):
    d = spark.createDataFrame([(" 12 ", "2024-01-02 03:04:05", "2024-01-02", '{"k": 1}'), ("x", "bad", "2024-1-2", "[1]"), ("\\N", None, "", "{"), ("99999999999999999999", "2024-01-02T03:04:05", "2024-02-30", None)], "a string, t string, d string, j string")
    out = clean.with_json(clean.with_date(clean.with_timestamp(clean.with_long(d, "a", "n"), "t", "at"), "d", "day"), "j", "note", "k bigint").collect()
    assert [(r.n, r._bad_n) for r in out] == [(12, False), (None, True), (None, False), (None, True)]
    assert [r._bad_at for r in out] == [False, True, False, False] and out[0].at == out[3].at
    assert [(r.day is None, r._bad_day) for r in out] == [(False, False), (True, True), (True, False), (True, True)]
    assert [(r.note and r.note.k, r._bad_note) for r in out] == [(1, False), (None, True), (None, True), (None, False)]


def test_contract(spark):
    schema = StructType([StructField("Id", StringType()), StructField("n", LongType())])
    d = spark.createDataFrame([(1, "2", 3)], "ID int, m string, extra int")
    assert clean.to_contract(d, schema, {"n": "m"}).first().asDict() == {"Id": "1", "n": 2}
    with pytest.raises(ValueError):
        clean.to_contract(d, schema)
    assert clean.with_missing(d, {"ID": "int", "z": "double"}).columns == ["ID", "m", "extra", "z"]
    twice = d.select("ID", F.col("m"), F.lit(9).alias("ID"))
    assert clean.unique_columns(twice).first().asDict() == {"ID": 1, "m": "2"}
    assert clean.filled(spark.createDataFrame([(1.0, None), (None, "a"), (3.0, "b")], "x double, s string"), ["x"], ["s"]).where("x IS NULL OR s IS NULL").count() == 0


# Quality and merging


def test_rule_kinds(spark):
    d = spark.createDataFrame([("1", None, -1, "2024-01-01", "2024-01-02", True, "12345678901")], "id string, v string, n int, a string, b string, f boolean, long string")
    rules = [
        quality.Rule("req", "required", "v"),
        quality.Rule("flag", "flag", "f"),
        quality.Rule("neg", "nonnegative", "n", "warn"),
        quality.Rule("date", "date_equal", "a", "warn", {"other": "b"}),
        quality.Rule("long", "long_numeric_id", "long", "warn"),
        quality.Rule("fine", "regex", "v", options={"pattern": "x"}),
    ]
    a = quality.annotate(d, rules)
    assert [i.rule_id for i in a.first().issues] == ["req", "flag", "neg", "date", "long"] and a.first().has_errors
    with pytest.raises(ValueError):
        quality.annotate(d, [quality.Rule("x", "nope", "v")])
    with pytest.raises(ValueError):
        quality.annotate(d, rules + rules[:1])
    q = quality.quarantine(a, "d", ["id"]).first()
    assert '"v":null' in q.payload and q.rules == "date,flag,long,neg,req"


def test_checks_and_verdict(spark):
    d = spark.createDataFrame([(1, "a"), (1, None), (2, "c")], "k int, v string")
    m = quality.run_checks(d, [quality.not_null("v", "warn"), quality.unique_by(["k"], "info"), quality.in_domain("v", ["a", "c"], True, "abort")])
    assert {r.name: r.failed for r in m.collect()} == {"completeness_v": 1, "uniqueness_k": 1, "consistency_v_domain": 0}
    assert quality.verdict(m) == "warn" and quality.verdict(m, {"completeness_v": "abort"}) == "abort"
    assert quality.verdict(quality.run_checks(d.limit(0), [quality.not_null("v")])) == "abort"
    assert quality.hour_drift(23, 1) == 2


def test_schema_compat(spark):
    want = StructType([StructField("a", LongType()), StructField("b", StringType())])
    frame = lambda rows, s: (lambda d: (d.schema, d))(spark.createDataFrame(rows, s))
    assert quality.schema_compat(want, want)[0] == "PASS"
    s, d = frame([("1", "x", 2)], "a string, b string, c int")
    assert quality.schema_compat(want, s, d) == ("WARN", ["castable: a", "added: c"])
    s, d = frame([("q", "x")], "a string, b string")
    assert quality.schema_compat(want, s, d)[0] == "FAIL"
    assert quality.schema_compat(want, StructType([StructField("a", LongType())])) == ("FAIL", ["removed: b"])


def test_merge_guard_and_repeat(spark):
    target = spark.createDataFrame([(i, i % 2, "old", 1) for i in range(20)], "id int, s int, v string, made int")
    scope = spark.createDataFrame([(0,)], "s int")
    source = spark.createDataFrame([(i, 0, "new" if i == 2 else "old", 9) for i in range(0, 18, 2)] + [(40, 0, "x", 9)], "id int, s int, v string, made int")
    out = merge.scoped_merge(source, target, scope, "s", ["id"], ["v"], ["made"])
    by = {r.id: r for r in out.collect()}
    assert by[2].action == "update" and by[2].made == 1 and by[40].action == "insert" and by[40].made == 9 and 18 not in by and by[1].action == "untouched" and by[4].action == "same"
    again = merge.scoped_merge(source, out.drop("action"), scope, "s", ["id"], ["v"], ["made"])
    assert {r.action for r in again.collect()} == {"same", "untouched"}
    with pytest.raises(ValueError):
        merge.scoped_merge(source.limit(3), target, scope, "s", ["id"], ["v"])
    with pytest.raises(ValueError):
        merge.scoped_merge(target, target, scope, "s", ["id"], ["v"])
    assert [r.id for r in merge.conflicts(source, target, "id", ["v"]).collect()] == [2]


def test_enrichment_refuses_repeated_keys(spark):
    d = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError):
        joins.enriched(d, spark.createDataFrame([(1, "a"), (1, "b")], "j int, v string"), "k", "j")


# Files and streams


def test_files(spark, tmp_path):
    d = spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string")
    p = f"{tmp_path}/t"
    assert files.optional_table(spark, p, d.schema).count() == 0
    files.write_once(d, p)
    with pytest.raises(Exception):
        files.write_once(d, p)
    before = files.fingerprint(spark, [p])
    assert files.optional_table(spark, p, d.schema).count() == 2
    d.write.mode("append").parquet(p)
    assert files.fingerprint(spark, [p]) != before
    s = f"{tmp_path}/staged"
    assert files.staged(d, s).count() == 2 and files.staged(d.limit(1), s).count() == 2 and files.staged(d.limit(1), s, force=True).count() == 1
    o = f"{tmp_path}/parts"
    files.overwrite_partitions(d, o, ["p"])
    files.overwrite_partitions(d.where("p = 'a'").withColumn("k", F.lit(7)), o, ["p"])
    assert sorted((r.k, r.p) for r in spark.read.parquet(o).collect()) == [(2, "b"), (7, "a")]
    assert files.partitioned(spark, o, "p=a").first().p == "a"
    assert set(files.united(spark, [p, o]).columns) == {"k", "p", "source_path"}
    files.manifest(d, f"{tmp_path}/m")
    assert len([x for x, *_ in files.listed(spark, f"{tmp_path}/m") if x.endswith(".csv")]) == 1
    c = tmp_path / "c.csv"
    c.write_text('k,v\n1,"a\nb"\n')
    assert files.strict_csv(spark, str(c), "k int, v string").first().v == "a\nb"
    c.write_text("k,v\n1,a,b\n")
    with pytest.raises(Exception):
        files.strict_csv(spark, str(c), "k int, v string").collect()
    assert files.file_count(1000, 1 << 20) == 8


def test_stream_publishes_each_id_once(spark, tmp_path):
    src, out = f"{tmp_path}/src", f"{tmp_path}/out"
    spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string").write.parquet(src)
    for _ in range(2):
        publish_stream(spark.readStream.schema("k int, v string").parquet(src), out, "k", f"{tmp_path}/ck").awaitTermination()
        spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string").write.mode("append").parquet(src)
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == [1, 2, 3]
    e = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-02 00:00:00",)], "t string")
    assert in_window(e, "t", None, "2024-01-01 00:00:00").count() == 1 and in_window(e, "t", "2024-01-01 00:00:00", "2024-01-02 00:00:00").count() == 1


# Features and scores


def test_features_of_missing_entities_are_null(spark):
    base = spark.createDataFrame([(1,), (2,)], "user_id long")
    e = spark.createDataFrame([(1, "2024-01-10 00:00:00", "2024-01-09 12:00:00", "a", 1)], "user_id long, reference_ts string, event_ts string, event_type string, event_id long")
    e = e.withColumn("reference_ts", F.to_timestamp("reference_ts")).withColumn("event_ts", F.to_timestamp("event_ts"))
    got = {r.user_id: r for r in features.all_features(base, e, ["user_id"], "u", {"a": ["a"]}, [("a", "b")]).collect()}
    assert got[1].u_a_cnt_1d == 1 and got[2].u_a_cnt_1d is None and got[1].u_a_interval_mean is None and got[1].u_a_hour_entropy == 0
    assert features.biweekly("2024-01-01", 2) == [("2024-01-01", "2024-01-15"), ("2024-01-15", "2024-01-29")]
    with pytest.raises(ValueError):
        features.recency_intensity(e, ["user_id"], "u", 0)


def test_anomaly_scores_single_out_an_outlier(spark):
    r = np.random.default_rng(2)
    rows = [(i, *map(float, r.normal(0, 1, 3))) for i in range(400)] + [(999, 12.0, -11.0, 14.0)]
    d = spark.createDataFrame(rows, "id long, a double, b double, c double")
    cols = ["a", "b", "c"]
    along = r.normal(0, 5, 400)
    line = spark.createDataFrame([(i, float(x), float(x + r.normal(0, 0.1)), float(x + r.normal(0, 0.1))) for i, x in enumerate(along)] + [(999, 2.0, -2.0, 2.0)], "id long, a double, b double, c double")
    for found in (
        scoring.tail_probability(d, "id", cols),
        scoring.histogram_score(d, "id", cols),
        scoring.pca_score(line, "id", cols, 1),
        scoring.isolation_scores(d, "id", cols, trees=30),
        scoring.isolation_scores(d, "id", cols, trees=30, mondrian=True),
    ):
        assert 999 in [x.id for x in found.orderBy(F.desc("score")).limit(3).collect()]
    assert scoring.kmeans_score(d, "id", cols, 3, weights={"a": 2.0}).count() == 401


def test_cluster_drift(spark):
    rows = lambda *c: spark.createDataFrame([(k, d) for k, d, n in c for _ in range(n)], "cluster int, distance double")
    got = {r.cluster: r.status for r in scoring.cluster_drift(rows((0, 1.0, 50), (1, 1.0, 50), (2, 1.0, 40), (4, 1.0, 2)), rows((0, 1.0, 50), (1, 2.0, 50), (3, 1.0, 40), (4, 1.0, 2)), "cluster", "distance").collect()}
    assert got == {0: "ok", 1: "drifted", 2: "vanished", 3: "emerged", 4: "unevaluable"}


def test_cohort_is_the_same_everywhere(spark):
    a = {r.k for r in spark.range(1000).withColumnRenamed("id", "k").where(dedup.in_cohort(F.col("k"), "s", 10, 3)).collect()}
    b = {r.k for r in spark.range(500, 1500).withColumnRenamed("id", "k").where(dedup.in_cohort(F.col("k"), "s", 10, 3)).collect()}
    assert 200 < len(a) < 400 and {x for x in a if x >= 500} == {x for x in b if x < 1000}


# Lineage


def devices(*events):
    rows = [SimpleNamespace(kind=k, device=d, ts=T0 + dt.timedelta(hours=h), carrier="c", event_id=f"e{i}") for i, (k, d, h) in enumerate(events)]
    hours = lambda t: None if t is None else round((t - T0).total_seconds() / 3600)
    return [(s["device"], hours(s["from_ts"]), hours(s["to_ts"]), s["displaced"]) for s in lineage.device_walk(rows)]


@pytest.mark.parametrize(
    ("events", "want"),
    [
        ([("start", "A", 0), ("start", "A", 3), ("end", "A", 5)], [("A", 0, 5, None)]),
        ([("start", "A", 0), ("start", "B", 3)], [("A", 0, 3, None), ("B", 3, None, "A")]),
        ([("start", "A", 0), ("end", "B", 3), ("end", None, 4)], [("A", 0, 4, None)]),
        ([("start", "A", 0), ("start", "B", 3), ("start", "A", 3)], [("A", 0, 3, None), ("A", 3, None, "A")]),
        ([("end", "A", 0), ("start", None, 1), ("sim_end", None, 2)], []),
        ([("start", "A", 0), ("sim_end", None, 2), ("start", "B", 3)], [("A", 0, 2, None), ("B", 3, None, None)]),
    ],
)
def test_device_walk(events, want):
    assert devices(*events) == want


def test_segments_close_with_the_last_life(spark):
    s = spark.createDataFrame([("a", 1, None), ("b", 1, None), ("c", 9, None), ("d", 1, 2)], "k string, from_ts int, to_ts int")
    lives = spark.createDataFrame([("a", 5), ("a", 7), ("b", 5), ("b", None), ("c", 9), ("d", 5)], "k string, end_ts int")
    assert sorted((r.k, r.to_ts) for r in lineage.close_at_life_end(s, lives, "k").collect()) == [("a", 7), ("b", None), ("d", 2)]


def test_firm_starts_and_ends(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    rows = [
        ("moved", day(10), None, True, "LOW", False, day(5), day(12), "c"),
        ("late", day(10), None, True, "LOW", False, day(11), day(12), "c"),
        ("floor", day(1), None, True, "LOW", True, day(5), day(12), "c"),
        ("same", day(10), None, False, "LOW", False, day(10), day(12), None),
        ("other", day(10), None, True, "LOW", False, day(5), day(12), "x"),
        ("off", day(10), day(11), True, "LOW", False, day(5), day(11), "c"),
        ("high", day(10), None, False, "HIGH", False, day(10), day(12), "c"),
    ]
    d = spark.createDataFrame(rows, "k string, start_ts timestamp, end_ts timestamp, start_inferred boolean, start_confidence string, floored boolean, since timestamp, asked_at timestamp, e string")
    lives = d.select("k", F.lit("c").alias("carrier"), "start_ts", "end_ts", "start_inferred", "start_confidence", "floored")
    got = {r.k: (r.evidence_use, r.start_ts.day, r.start_confidence) for r in lineage.firm_starts(lives, d.select("k", "since", "asked_at", F.col("e").alias("carrier")), "k").collect()}
    assert got == {"moved": ("moved", 5, "HIGH"), "late": ("conflict", 10, "LOW"), "floor": ("moved", 5, "HIGH"), "same": ("confirmed", 10, "HIGH"), "other": ("none", 10, "LOW"), "off": ("none", 10, "LOW"), "high": ("none", 10, "HIGH")}
    ends = spark.createDataFrame([(1, "k", "a", day(1), day(5)), (2, "k", "a", day(5), day(9)), (3, "k", "b", day(1), day(5))], "id int, k string, carrier string, start_ts timestamp, end_ts timestamp").withColumns({"end_inferred": F.lit(False), "end_confidence": F.lit("LOW")})
    ports = spark.createDataFrame([("k", "A", day(5))], "k string, from_carrier string, ts timestamp")
    assert {r.id: r.end_confidence for r in lineage.firm_ends(ends, ports, "k", "id").collect()} == {1: "HIGH", 2: "LOW", 3: "LOW"}


def test_port_edges_and_quiet_ports(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    d = spark.createDataFrame([("p", "1", "a", "x", day(1), day(3), False), ("p", "2", "b", "y", day(5), day(6), True), ("p", "3", "b", "z", day(20), None, True)], "k string, life_id string, carrier string, acct string, start_ts timestamp, end_ts timestamp, ported boolean")
    assert [(r.from_account, r.to_account) for r in lineage.port_edges(d, "k", "acct").collect()] == [("x", "y")]
    assert lineage.quiet_ports(d, "k", 10, 90).first().n == 1


def test_xml_rules():
    one = lambda t: xml.parse(t, "O/K", "Past", "Step")
    assert one("<R><O><K> 1 </K><E/></O><Past><Step><A>x</A></Step></Past></R>") == {"ok": True, "key": "1", "leaves": {"O/K": "1"}, "events": [{"A": "x"}]}
    assert one("<R><O/></R>") == {"ok": True, "key": None, "leaves": {}, "events": []}
    assert not any(one(t)["ok"] for t in (None, "", " ", "<R>", "text", "<n:R xmlns:n='u'/>"))


def test_two_answers_for_a_phone_leave_one_life(spark):
    """The latest answer counts, whichever way it points; a life is never multiplied."""
    from datetime import datetime as at

    lives = spark.createDataFrame([("a", "c", at(2024, 1, 10), None, True, "LOW", False), ("b", "c", at(2024, 1, 10), None, True, "LOW", False)], "k string, carrier string, start_ts timestamp, end_ts timestamp, start_inferred boolean, start_confidence string, floored boolean")
    rows = [("a", at(2024, 1, 5), at(2024, 2, 1), "c"), ("a", at(2024, 1, 20), at(2024, 3, 1), "c"), ("b", at(2024, 1, 20), at(2024, 2, 1), "c"), ("b", at(2024, 1, 5), at(2024, 3, 1), "c"), ("b", at(2024, 1, 5), at(2024, 3, 1), "c"), ("b", None, at(2024, 4, 1), "c")]
    evidence = spark.createDataFrame(rows, "k string, since timestamp, asked_at timestamp, carrier string")
    got = [(r.k, r.evidence_use, r.start_ts.day) for r in lineage.firm_starts(lives, evidence, "k").orderBy("k").collect()]
    assert got == [("a", "conflict", 10), ("b", "moved", 5)]


# Joins and ranks against brute force


def test_intervals_meet_points_at_every_length(spark):
    r = np.random.default_rng(3)
    day = lambda x: T0 + dt.timedelta(days=float(x))
    points = [(int(r.integers(3)), i, day(r.uniform(-4000, 4000))) for i in range(150)]
    spans = [(int(r.integers(3)), i, day(a := r.uniform(-4000, 4000)), None if i % 9 == 0 else day(a + r.choice([0.0, 0.5, 6, 100, 113, 900, 6000, 30000]) - (1 if i % 11 == 0 else 0))) for i in range(120)]
    spans += [(None, 900, day(0), None), (1, 901, None, day(3)), (1, 902, *[points[0][2]] * 2)]
    p = spark.createDataFrame(points + [(None, 900, day(1)), (1, 901, None)], "k int, p int, at timestamp_ntz")
    i = spark.createDataFrame(spans, "k int, i int, s timestamp_ntz, e timestamp_ntz")
    for closed in (True, False):
        want = sorted((b, d) for a, b, at in points for c, d, s, e in spans if a == c and s is not None and s <= at and (e is None or (at <= e if closed else at < e)))
        got = joins.point_in_interval(p, i, "k", "at", "s", "e", closed).collect()
        assert sorted((x.p, x.i) for x in got) == want
    assert joins.point_in_interval(p.limit(0), i, "k", "at", "s", "e").collect() == []


def test_nearest_in_band_against_all_pairs(spark):
    r = np.random.default_rng(4)
    rows = lambda n: [(int(r.integers(3)), i, T0 + dt.timedelta(hours=int(r.integers(400)))) for i in range(n)]
    left, right = rows(120), rows(60)
    a = spark.createDataFrame([*left, (None, 900, T0), (1, 901, None)], "k int, a int, at timestamp_ntz")
    b = spark.createDataFrame([*right, right[0], (1, 900, None)], "k int, b int, bt timestamp_ntz")
    want = {}
    for k, i, at in left:
        near = [(abs(at - bt), j) for h, j, bt in right if h == k and abs(at - bt) <= dt.timedelta(hours=12)]
        if near:
            want[i] = min(near)[1]
    got = joins.nearest_in_band(a, b, "k", "at", "bt", "a", "b", 0.5)
    assert got.columns == ["k", "a", "at", "b", "bt", "gap_us"]
    assert {x.a: x.b for x in got.collect()} == want and got.count() == len(want)


def test_none_before_against_all_pairs(spark):
    r = np.random.default_rng(5)
    rows = [(int(r.integers(12)), i, int(r.integers(5)), "abc"[int(r.integers(3))] if i % 7 else None) for i in range(150)]
    df = spark.createDataFrame(rows, "k int, i int, at int, v string")
    want = {i for k, i, at, v in rows if not any(k == h and v is not None and w is not None and v != w and bt < at for h, _, bt, w in rows)}
    assert {x.i for x in joins.none_before(df, df, "k", "at", "at", ("v", "v")).collect()} == want


def test_subtraction_against_one_interval_at_a_time(spark):
    r = np.random.default_rng(6)
    day = lambda x: T0 + dt.timedelta(days=int(x))

    def some(n, keys):
        out = []
        for i in range(n):
            a = int(r.integers(2000))
            out.append((str(int(r.integers(keys))), day(a), None if i % 13 == 0 else day(a + int(r.choice([1, 5, 90, 700])))))
        return out

    free, taken = some(60, 9), some(40, 7)
    frame = lambda rows: spark.createDataFrame(rows, "k string, s timestamp, e timestamp")
    want = [(k, *piece) for k, s, e in free for piece in sequence.minus(s, e, [(a, b) for h, a, b in taken if h == k])]
    order = lambda x: (x[0], x[1], x[2] or dt.datetime.max)
    got = sequence.subtract_intervals(frame(free), frame([*taken, ("1", day(5), day(5)), ("2", day(9), day(3)), (None, day(0), None)]), "k", "s", "e")
    assert sorted([tuple(x) for x in got.collect()], key=order) == sorted(want, key=order)


def test_quantiles_of_a_column_with_an_outlier(spark):
    r = np.random.default_rng(7)
    values = [*r.exponential(1, 3000), 1e12, -1e12]
    df = spark.createDataFrame([("a", float(v)) for v in values] + [("b", float(i)) for i in range(5)] + [("a", None)], "f string, v double")
    got = {(x.f, x.q): x.quantile for x in scoring.quantiles(df, ["f"], "v", [0.0, 0.05, 0.5, 0.95, 1.0]).collect()}
    for q in (0.0, 0.05, 0.5, 0.95, 1.0):
        assert math.isclose(got["a", q], float(np.quantile(values, q)), rel_tol=1e-9) and math.isclose(got["b", q], 4 * q)
    parts = scoring._tie_ranks(df.where("v IS NOT NULL"), ["f"], "v").where("f = 'a'").orderBy("v").collect()
    assert [p.below for p in parts] == list(range(len(values)))


# Reasons and counts of lives, and lives of the porting history


def test_walk_names_reasons_counts_plans_and_ignored_ends():
    words = sequence.Vocabulary(frozenset({"start"}), frozenset({"port"}), frozenset({"resume"}), frozenset({"end"}), plans=frozenset({"plan"}), low_carriers=frozenset({"low"}))
    run = lambda *es: sequence.walk([SimpleNamespace(kind=k, ts=T0 + dt.timedelta(hours=h), carrier=c, event_id=f"e{i}") for i, (k, h, c) in enumerate(es)], words)
    (a,) = run(("plan", 0, "a"), ("plan", 1, "a"))
    assert (a["start_reason"], a["plan_changes"], a["end_reason"], a["end_confidence"], a["confidence"]) == (sequence.FROM_PLAN, 2, sequence.TO_OPEN, "HIGH", "LOW")
    (a,) = run(("plan", 0, "a"), ("resume", 1, "a"))
    assert a["start_reason"] == words.other_start
    (a,) = run(("start", 0, "a"), ("end", 5, "a"), ("end", 6, "a"))
    assert (a["start_reason"], a["end_reason"], a["end_id"], a["end_kind"], a["ignored_ends"], a["confidence"]) == ("explicit_start", "_to_explicit_end", "e1", "end", 1, "HIGH")
    a, b = run(("start", 0, "a"), ("port", 5, "b"))
    assert (a["end_reason"], a["end_id"], a["end_confidence"], b["start_reason"]) == (sequence.TO_NEXT, None, "LOW", "explicit_port")
    assert [r["start_reason"] for r in run(("end", 0, "a"), ("end", 90, "a"))] == [sequence.FROM_FLOOR, sequence.FROM_PREVIOUS]
    assert run(("start", 0, "low"), ("end", 5, "low"))[0]["confidence"] == "LOW"


def test_port_lives(spark):
    day = lambda n: T0 + dt.timedelta(days=n)
    words = sequence.Vocabulary(frozenset({"start"}), frozenset(), frozenset(), frozenset({"end"}))
    events = [("a", "X", "start", 0), ("a", "X", "end", 10), ("a", "Y", "start", 40), ("b", "X", "end", 20), ("c", "X", "start", 0)]
    lives = sequence.lifecycles(spark.createDataFrame([(s, c, k, day(n), f"{s}{n}") for s, c, k, n in events], "subscriber string, carrier string, kind string, ts timestamp, event_id string"), words)
    rows = [("a", 5, 1, "a1", True, "Foreign ", None), ("a", 30, 1, "a2", True, None, " 9z"), ("a", 31, 1, "a3", False, "Q", None), ("b", 2, 1, "b0", True, "F", None), ("b", 8, 1, "b1", True, "x", None), ("b", 25, 1, "b2", True, "", None), (None, 1, 1, "n", True, "F", None)]
    asked = spark.createDataFrame([(k, day(n), *r) for k, n, *r in rows], "subscriber string, ts timestamp, seq int, record_id string, between_carriers boolean, to_name string, to_code string")
    got = [(r.subscriber, r.lifecycle_no, r.segment, r.carrier, r.start_ts, r.end_ts, r.start_reason, r.end_reason, r.confidence, r.enriched) for r in ports.port_lives(lives, asked, "subscriber", ["X", "Y"]).collect()]
    assert sorted(got, key=lambda g: g[:2]) == [
        ("a", 1, 1, "X", day(0), day(10), "explicit_start", "_to_explicit_end", "HIGH", True),
        ("a", 2, 2, "FOREIGN", day(10), day(30), sequence.FROM_PREVIOUS, ports.PORT_OUT, "LOW", True),
        ("a", 3, 3, "SPID_9Z", day(30), day(40), ports.PORT_IN, sequence.TO_NEXT, "LOW", True),
        ("a", 4, 4, "Y", day(40), None, "explicit_start", sequence.TO_OPEN, "HIGH", True),
        ("b", 1, 1, "F", day(2), day(8), ports.PORT_IN, ports.PORT_OUT, "HIGH", True),
        ("b", 2, 2, "X", day(8), day(20), ports.PORT_IN, "_to_explicit_end", "HIGH", True),
        ("b", 3, 3, "UNKNOWN_CARRIER", day(25), None, ports.PORT_IN, sequence.TO_OPEN, "HIGH", True),
        ("c", 1, 1, "X", day(0), None, "explicit_start", sequence.TO_OPEN, "HIGH", False),
    ]
    assert ports.port_lives(lives, asked.limit(0), "subscriber", ["X"]).count() == lives.count()
    twice = asked.withColumn("asked_at", F.lit(1)).withColumn("request", F.col("record_id")).where("subscriber = 'a'")
    assert [r.record_id for r in ports.latest_answer(twice, "subscriber", "asked_at", "request").collect()] == ["a3"]


# Feeds, filling and drift


def test_feeds_refuse_what_is_ambiguous(spark):
    feed = silver.Feed({"id": ["id", "ID2"], "timestamp": ["timestamp"]}, {}, frozenset({"timestamp"}))
    for columns in ("id string, ID string", "id string, id2 string, timestamp string", "id string", "_x string, timestamp string"):
        with pytest.raises(ValueError):
            silver.prepared(spark.createDataFrame([], columns), feed)
    assert "_s_id" in silver.prepared(spark.createDataFrame([], "timestamp string, more int"), feed).columns


def test_audit_excludes_test_ids_and_keeps_their_rows(spark):
    raw = spark.createDataFrame([("a", "T1", "7", "x"), ("b", "5", None, "2024-01-01"), ("c", None, "77777777777", None)], "id string, partner_id string, service_provider_id string, timestamp string")
    feed = silver.Feed({c: [c] for c in catalogue.AUDIT.inputs}, {"record_id": "string", "partner_id": "string", "service_provider_id": "string"}, test_partners=["t1"])
    none = spark.createDataFrame([], "partner_id string, partner_name string")
    kept, out = silver.audit(raw, feed, none, none.withColumnRenamed("partner_id", "service_provider_id").drop("partner_name"))
    assert [(r.record_id, r.partner_id, r.service_provider_id, r._warn_partner_reference) for r in kept.orderBy("record_id").collect()] == [("b", "0000000005", None, True), ("c", None, "77777777777", False)]
    (gone,) = out.collect()
    assert gone.record_id == "a" and '"T1"' in gone._raw_payload


def test_variants_and_fitted_fills(spark):
    assert preprocess.variant("raw_numeric_zero_impute_no_scaling") == preprocess.Variant("zero", None)
    assert preprocess.variant("domain_impute_with_missing_indicators_minmax_scaler") == preprocess.Variant("domain", "minmax", True)
    for bad in ("", "mean_impute_no_scaling", "zero_impute", "zero_impute_robust", "zero_no_scaling"):
        with pytest.raises(ValueError):
            preprocess.variant(bad)
    assert preprocess.tenure_of("acct_days_since_x", ["acct_node_tenure_days", "cust_node_tenure_days"]) == "acct_node_tenure_days"
    assert preprocess.tenure_of("x_days_since", ["cust_node_tenure_days"]) == "cust_node_tenure_days" and preprocess.tenure_of("x", []) is None
    train = spark.createDataFrame([(1.0, None, 5.0), (float("inf"), None, 5.0), (4.0, None, 5.0)], "a double, b double, c double")
    for scale, want in (("standard", [(-1.0, 0.0, 0.0), (0.0, 0.0, 0.0), (1.0, 0.0, 0.0)]), ("minmax", [(0.0, 0.0, 0.0), (0.5, 0.0, 0.0), (1.0, 0.0, 0.0)]), (None, [(1.0, 0.0, 5.0), (2.5, 0.0, 5.0), (4.0, 0.0, 5.0)])):
        got = preprocess.fit(train, ["a", "b", "c"], preprocess.Variant("median", scale)).apply(train).collect()
        assert all(math.isclose(x, y * (1.5 / np.std([1, 2.5, 4]) if scale == "standard" and i == 0 else 1), abs_tol=1e-9) for g, w in zip(sorted(tuple(r) for r in got), want) for i, (x, y) in enumerate(zip(g, w)))
    marked = preprocess.fit(train, ["a", "c"], preprocess.Variant("zero", None, True)).apply(train)
    assert marked.columns == ["a", "b", "c", "a_missing"] and sorted(r.a for r in marked.collect()) == [0.0, 1.0, 4.0]
    assert preprocess.fit(train.limit(0), ["a"], preprocess.Variant("median", "robust")).apply(train).where("a IS NULL").isEmpty()
    with pytest.raises(ValueError):
        preprocess.fit(train, ["z"], preprocess.Variant("zero", None))


def test_drift_of_columns_without_values(spark):
    a = spark.createDataFrame([(float(i), None, float("nan")) for i in range(50)], "x double, y double, z double")
    b = spark.createDataFrame([(float(i), 1.0, 2.0) for i in range(50)], "x double, y double, z double")
    got = {r.feature: (r.status, r.null_share_shift, r.null_shift_flag) for r in scoring.feature_drift(a, b, ["x", "y", "z"]).collect()}
    assert got == {"x": ("ok", 0.0, False), "y": ("unevaluable", 1.0, True), "z": ("unevaluable", 0.0, False)}
    one = scoring.retrain_decision(scoring.feature_drift(a, b, ["x", "y"]), spark.createDataFrame([(None,)], "psi double")).collect()
    assert [(r.n_features, r.n_evaluated, r.n_drifted, r.retrain) for r in one] == [(2, 1, 0, False)]


# Edges and eligibility


def test_edges_of_changes_and_of_lives(spark):
    side = lambda rows: spark.createDataFrame([(i, k, c, T0 + dt.timedelta(days=d), x) for i, k, c, d, x in rows], "id string, key string, carrier string, ts timestamp, correlation string")
    froms = side([("f1", "p", "A", 0, "x"), ("f2", "q", "A", 0, " "), ("f3", "r", "B", 9, None)])
    tos = side([("t1", "q", "A", 1, "x"), ("t2", "p", "A", 1, "x"), ("t3", "s", "B", 1, "x"), ("t4", "u", "A", 1, " "), ("t5", "s", "B", 10, None)])
    found = lineage.correlation_edges(froms, tos)
    assert [(e.from_id, e.to_id) for e in found.collect()] == [("f1", "t1")]
    stated = spark.createDataFrame([("r", "s", "b", T0 + dt.timedelta(days=9.5)), ("r", "s", "b", T0 + dt.timedelta(days=9.5)), ("r", "r", "b", T0), ("p", " ", "a", T0), (None, "s", "b", T0), ("p", "q", None, T0)], "was string, becomes string, carrier string, ts timestamp")
    assert [(e.from_id, e.to_id) for e in lineage.counterparty_edges(froms, tos, stated, 0.5).collect()] == [("f3", "t5")]
    assert lineage.counterparty_edges(froms, tos, stated, 0.25).collect() == []
    lives = spark.createDataFrame([("l1", "start", "s1", "left", "f1"), ("l2", "came", "t1", None, None), ("l3", "start", "t1", "other", "f1")], "lifecycle_uid string, start_kind string, start_id string, end_kind string, end_id string")
    assert [(e.from_uid, e.to_uid) for e in lineage.life_edges(found, lives, "left", "came").collect()] == [("l1", "l2")]


def test_eligibility():
    say = lambda n, k="double", **how: eligibility.verdict(n, k, **how)
    assert say("Customer_ID") == ("join_key", False) and say("fraud_timestamp") == ("label_leakage", False) and say("__x") == ("provenance", False)
    assert say("made", provenance=["made"]) == ("provenance", False) and say("created_ts") == ("timestamp_pattern", False) and say("imei") == ("id_pattern", False)
    assert say("cust_days_since_account_created") == ("", True) and say("distinct_cnt_phone") == ("id_pattern", False)
    assert say("x", "string") == ("not_numeric", False) and say("x", "decimal(10,2)") == ("", False) and say("x", "array<int>") == ("not_numeric", False)
    assert eligibility.eligible([("b", "int"), ("a", "double"), ("label", "int")]) == ["a", "b"]
    assert eligibility.top([("b", 1.0), ("a", 1.0), ("c", 2.0)], 2) == ["c", "a"] and eligibility.top([], 3) == []
    assert scoring.k_grid(100, 7, [10, 500], [0.001, 0.05]) == [1, 5, 7, 10] and scoring.k_grid(0, 3, [1]) == []


def test_slices_follow_every_kind_of_link(spark):
    f = lambda rows: spark.createDataFrame(rows, "k string, p string")
    pairs = spark.createDataFrame([("c", "d"), ("d", "d"), (None, "e"), ("x", "y")], "a string, b string")
    links = {"one": f([("a", "1"), ("b", "1"), ("y", "2"), (None, "1")]), "two": f([("b", "2"), ("c", "2"), ("z", None)]), "pair": graph.pair_links(pairs, "a", "b", "k", "p")}
    got = graph.slice_of([f([("a", "")]), f([(None, "")])], links, "k", "p")
    assert sorted(r.k for r in got.collect()) == ["a", "b", "c", "d"]
    with pytest.raises(RuntimeError):
        graph.slice_of([f([("a", "")])], links, "k", "p", rounds=2)
