"""The training-data operators on small fixtures, against brute force, with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import _tables, _text, exact_topk, fingerprints, language_id, license_scan, lm_scoring, mixing, ngram_join, packing, token_counts, url_filters

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def odd_documents():
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty".split()
    rows = [
        (1, " ".join(base * 3), "en", "a", 1),
        (2, " ".join(base * 3) + " extra", "en", "a", 1),
        (3, None, None, None, None),
        (4, "", "en", "a", 0),
        (5, "  \t\n ", "en", "b", 5),
        (6, "Solo", "en", "b", 4),
        (7, "solo", None, "b", 4),
        (8, "éàü ñ ß — ‘quotes’ 123", "fr", "c", 3),
        (9, " ".join(f"w{i % 977}" for i in range(30_000)), "en", "c", 9),
        (10, "1234 5678 !!", "en", None, 3),
        (11, "le chat est sur la table et le chien", "fr", "c", 3),
        (11, "le chat est sur la table et le chien", "fr", "c", 3),
        (12, "<|endoftext|> a <|startoftext|>b's it'll", "en", "c", 3),
        (None, "no id here", "en", "c", 3),
    ]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_documents(), SCHEMA).withColumn("score", F.lit(1.5)).withColumn("n", F.lit(3)).withColumn("size", F.lit("x"))


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_words_and_shingles_match_plain_python():
    texts = ["a B c d e", "", None, "x", "  lead and\ttrail \n", "é\u00a0b c", "q r"]
    data, offsets = _text.raw(pa.array(texts))
    s, e, b = _text.words(data, offsets)
    got = [[bytes(data[i:j]).decode() for i, j in zip(s[b[r] : b[r + 1]], e[b[r] : b[r + 1]])] for r in range(len(texts))]
    assert got == [WORD.findall(t or "") for t in texts]
    h = _text.word_hashes(data, s, e)
    sh, at = _text.shingle_hashes(h, b, 3)
    assert list(np.diff(at)) == [3, 0, 0, 1, 1, 1, 1]
    again, _ = _text.shingle_hashes(_text.word_hashes(*[(x := _text.raw(pa.array(["c D E"])))[0], *_text.words(*x)[:2]]), _text.words(*x)[2], 3)
    assert again[0] == sh[2]


def test_tables_round_trip():
    r = np.random.default_rng(0)
    part = r.integers(0, 3, 5000).astype(np.uint32)
    part[7] = 1 << 30
    part[9] = 255
    assert (_tables.unsqueezed(_tables.squeezed(part)) == part).all()


# language ID


def test_network_tables_equal_the_network():
    net = language_id.ByteNetwork(["a", "b", "c"])
    x = np.random.default_rng(1).integers(0, 256, (5, language_id.WINDOW)).astype(np.uint8)
    e = net.embed[x]
    pooled = []
    for w, f, b in zip(language_id.WIDTHS, net.filters, net.bias):
        z = np.stack([np.concatenate([e[:, t + j] for j in range(w)], 1) @ f + b for t in range(x.shape[1] - w + 1)], 1)
        pooled.append(z.max(1))
    s = np.maximum(np.concatenate(pooled, 1), 0) @ net.out + net.out_bias
    p = np.exp(s) / np.exp(s).sum(1, keepdims=True)
    assert np.allclose(language_id.probabilities(net.tables(), x), p, atol=1e-4)


def test_windows_hold_every_byte_once():
    texts = [b"x" * 300, b"", b"ab", b"y" * 128]
    data = np.frombuffer(b"".join(texts), np.uint8)
    w, rows, held = language_id.windows_of(data, np.cumsum([0, *map(len, texts)]))
    for i, t in enumerate(texts):
        assert w[rows == i].tobytes().rstrip(b"\0") == t and held[rows == i].sum() == len(t)


def test_language_id_held_out_accuracy(spark, small):
    got = language_id.op1_language_id(spark, small).toPandas().merge(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang").toPandas())
    assert list(got.held_out) == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]
    assert (got.lang_pred == got.lang)[got.held_out].mean() > 0.9
    assert got.score.between(0, 1).all()


def test_language_id_odd_rows(spark, odd, none):
    got = language_id.identify(odd, language_id.fitted(odd), ("_l", "_s")).toPandas()
    assert len(got) == len(odd_documents()) and list(got.columns[:-2]) == odd.columns
    by = {r.doc_id: r for r in got.itertuples() if r.doc_id == r.doc_id}
    for i in (3, 4, 5, 10):
        row = got[got.doc_id == i].iloc[0]
        assert row["_l"] == "und" and row["_s"] == 0
    assert set(got["_l"]) <= {"en", "fr", "und"} and by
    assert language_id.identify(none, language_id.fitted(none)).count() == 0


# n-gram join


def brute_components(rows, t):
    sets = {}
    for i, text in rows:
        w = WORD.findall(lower(text or ""))
        k = t.shingle
        sets.setdefault(i, set()).update({tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    ids = sorted(sets)
    label = {i: i for i in ids}
    changed = True
    links = [(a, b) for x, a in enumerate(ids) for b in ids[:x] if sets[a] and sets[b] and t.den * len(sets[a] & sets[b]) >= t.num * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            m = min(label[a], label[b])
            if label[a] != m or label[b] != m:
                label[a] = label[b] = m
                changed = True
    return {i: (len(sets[i]), label[i]) for i in ids}, len(links)


@pytest.mark.parametrize("t", [ngram_join.Threshold(3, 90, 100), ngram_join.Threshold(5, 80, 100)])
def test_join_equals_brute_force(spark, t):
    r = np.random.default_rng(3)
    words = [f"v{i}" for i in range(400)]
    rows = []
    for g in range(12):
        base = list(r.choice(words, 60))
        for c in range(12):
            copy = base[:]
            for _ in range(int(r.integers(0, 4))):
                copy[int(r.integers(len(copy)))] = str(r.choice(words))
            rows.append((g * 20 + c, " ".join(copy)))
    common = " ".join(words[:50])
    rows += [(500 + i, common + f" tail{i}") for i in range(30)]
    want, links = brute_components(rows, t)
    got = ngram_join.similarity_components(spark.createDataFrame(rows, "doc_id long, text string"), t).collect()
    assert links > 50
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == want


def test_join_pairs_of_blocks_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LIST_BLOCK", 4)
    monkeypatch.setattr(ngram_join, "HOLD", 3)
    monkeypatch.setattr(ngram_join, "MOST_BROADCAST", 0)
    r = np.random.default_rng(4)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(60):
        copy = base[:]
        for _ in range(int(r.integers(0, 4))):
            copy[int(r.integers(80))] = f"x{int(r.integers(9))}"
        rows.append((i, " ".join(copy)))
    t = ngram_join.Threshold(3, 90, 100)
    got = ngram_join.similarity_components(spark.createDataFrame(rows, "doc_id long, text string"), t).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == brute_components(rows, t)[0]


def test_join_class_counts_bound_overlaps():
    r = np.random.default_rng(12)
    pool = r.integers(0, 1 << 63, 500).astype(np.uint64) * np.uint64(2)
    sets = [np.sort(r.choice(pool, int(r.integers(1, 300)), replace=False)) for _ in range(40)]
    counts = ngram_join.spread(sets).astype(np.int64)
    assert [c.sum() for c in counts] == [len(x) for x in sets]
    for i in range(40):
        for j in range(i):
            assert len(np.intersect1d(sets[i], sets[j])) <= np.minimum(counts[i], counts[j]).sum()


def test_join_overlaps_and_derived_overlaps():
    r = np.random.default_rng(13)
    pivot = np.sort(r.integers(0, 1 << 62, 200).astype(np.uint64))
    near = [np.sort(np.concatenate([r.choice(pivot, 180, replace=False), r.integers(0, 1 << 62, int(r.integers(1, 30))).astype(np.uint64)])) for _ in range(8)] + [np.sort(r.integers(0, 1 << 62, 50).astype(np.uint64))]
    rows = {"a": [1] * 10 + [2] * 2, "salt": [0] * 12, "kind": [0] + [1] * 9 + [0, 1], "b": [0, *range(10, 19), 0, 18], "body": [x.tobytes() for x in (pivot, *near, near[0], near[8])]}
    got = pa.Table.from_batches(ngram_join.overlaps(iter([pa.RecordBatch.from_pydict(rows)]))).to_pylist()
    by = {x["b"]: x for x in got if x["a"] == 1}
    for i, x in enumerate(near):
        row = by[10 + i]
        assert (row["na"], row["nb"], row["both"]) == (200, len(x), len(np.intersect1d(pivot, x)))
        if i < 8:
            assert row["minus"] == np.setdiff1d(pivot, x).tobytes() and row["plus"] == np.setdiff1d(x, pivot).tobytes()
    assert by[18]["minus"] is None and [x["both"] for x in got if x["a"] == 2] == [len(np.intersect1d(near[0], near[8]))]
    pairs = [(i, j) for i in range(8) for j in range(i)]
    ask = {"a": [10 + i for i, _ in pairs], "b": [10 + j for _, j in pairs], "na": [len(near[i]) for i, _ in pairs], "nb": [len(near[j]) for _, j in pairs], "known": [by[10 + j]["both"] for _, j in pairs]}
    for c in ("minus", "plus"):
        ask |= {f"{c}_a": [by[10 + i][c] for i, _ in pairs], f"{c}_b": [by[10 + j][c] for _, j in pairs]}
    found = pa.Table.from_batches(ngram_join.derived(iter([pa.RecordBatch.from_pydict(ask)]))).to_pylist()
    assert [x["both"] for x in found] == [len(np.intersect1d(near[i], near[j])) for i, j in pairs]


def test_join_odd_rows(spark, odd, none):
    t = ngram_join.Threshold(3, 90, 100)
    got = ngram_join.similarity_components(odd, t).collect()
    assert len(got) == len(odd_documents())
    want, _ = brute_components([(i, x) for i, x, *_ in odd_documents() if i is not None], t)
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got if x.doc_id is not None} == want
    assert [x.component_id for x in got if x.doc_id is None] == [None]
    assert ngram_join.similarity_components(none, t).count() == 0
    kept = ngram_join.one_of_each(odd, t)
    assert kept.columns == odd.columns
    assert sorted(x.doc_id for x in kept.collect() if x.doc_id is not None) == [1, 3, 4, 5, 6, 8, 9, 10, 11, 12]


def test_join_of_repeated_rows_equals_brute_force(spark):
    t = ngram_join.Threshold(3, 90, 100)
    rng = np.random.default_rng(3)
    rows = []
    for g in range(6):
        words = [f"g{g}w{i}" for i in range(80)]
        for k in range(3):
            w = list(words)
            w[int(rng.integers(80))] = f"x{g}{k}"
            rows += [(10 * g + k, " ".join(w))] * int(rng.integers(1, 4))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similarity_components(spark.createDataFrame(rows, "doc_id long, text string"), t).collect()}
    assert got == brute_components(sorted(set(rows)), t)[0]


def test_one_of_each_judges_texts_of_a_repeated_id_by_themselves(spark):
    t = ngram_join.Threshold(3, 90, 100)
    a, b, c = (" ".join(f"{k}{i}" for i in range(60)) for k in "abc")
    rows = [(3, a, "x"), (7, a, "y"), (7, b, "z"), (7, b, "u"), (7, b + " end", "v"), (7, None, "n"), (7, "", "e"), (9, c, "r"), (9, c, "s"), (11, b, "t"), (12, c + " more", "q")]
    d = spark.createDataFrame(rows, "doc_id long, text string, cls string")
    kept = ngram_join.one_of_each(d, t)
    assert kept.columns == d.columns
    got = kept.collect()
    assert sorted((r.doc_id, "-" if r.text is None else r.text[:1]) for r in got) == [(3, "a"), (7, ""), (7, "-"), (7, "b"), (9, "c")]
    assert {r.cls for r in got} >= {"x", "n", "e"}


# URL filters


def plain_url(u):
    if u is None or "://" not in u:
        return "", ""
    rest = u.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return lower(host), re.match(r"[^?#]*", rest[len(host) :])[0]


def test_url_rules_equal_brute_force(spark, small):
    urls = [r.url for r in spark.read.parquet(f"{small}/pages.parquet").collect()]
    urls += [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/a?x#y", "x://a.net/es/", "x://net/fr/1", "x://net", "x://notnet/es/", "a://b://c.net/es/", "x://example.com/en", "x://e.example.com/en/1", "x://www.example.com/en/", "x://ö.com/ü?"]
    got = url_filters.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash"))).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path = plain_url(urls[r.page_id])
        fit = [(h + p, v) for v, h, p in url_filters.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fit, key=lambda x: len(x[0])) if fit else (None, None)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.bad >= 0.8 else "allow"))


def test_url_templates_generalise_and_reject_by_purity(spark):
    rows = [(i, f"http://h.test/spam/{i}") for i in range(40)] + [(100 + i, f"http://h.test/news/{i}") for i in range(40)] + [(200 + i, f"http://h.test/spam/x{i}") for i in range(10)]
    got = {r.page_id: r for r in url_filters.judge(spark.createDataFrame(rows, "page_id long, url string"), rules=[("block", "h.test", f"/spam/{d}") for d in range(1, 10)] + [("allow", "h.test", "/news/")], least_share=0.05).collect()}
    assert got[5].template == "/spam/*" and got[105].template == "/news/*"
    assert got[5].verdict == "block" and got[203].rule is None and got[203].verdict == "block" and got[105].verdict == "allow"
    assert url_filters.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def plain_tree(rows, rules, depth=3, least_pages=5, least_share=0.02, many_pages=1000, smooth=4.0, sigma=1.96):
    """(template, smoothed share) of every url, by a plain tree."""
    parsed = [plain_url(u) for u in rows]
    labels = []
    for host, path in parsed:
        fit = [(h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        labels.append(max(fit, key=lambda x: len(x[0]))[1] if fit else None)
    segments = [[x for x in p.split("/") if x] for _, p in parsed]
    levels = [[(h, "") for h, _ in parsed]]
    for d in range(depth):
        child = Counter((*levels[d][i], s[d]) for i, s in enumerate(segments) if len(s) > d)
        parent = Counter()
        for (h, t, _), n in child.items():
            parent[h, t] += n
        now = []
        for i, s in enumerate(segments):
            h, t = levels[d][i]
            if len(s) <= d:
                now.append((h, t))
                continue
            n = child[h, t, s[d]]
            now.append((h, t + "/" + (s[d] if n >= least_pages and (n >= least_share * parent[h, t] or n >= many_pages) else "*")))
        levels.append(now)
    count = lambda keys: {k: (sum(labels[i] == "block" for i in at), sum(labels[i] is not None for i in at)) for k, at in keys.items()}

    def grouped(of):
        out = {}
        for i in range(len(rows)):
            out.setdefault(of(i), []).append(i)
        return count(out)

    bad, all_ = grouped(lambda i: 0)[0]
    base = min(bad / all_, 0.5) if all_ else 0.0
    estimate = {k: (b + smooth * base) / (a + smooth) for k, (b, a) in grouped(lambda i: levels[0][i]).items()}
    for d in range(depth):
        nodes = grouped(lambda i: (levels[d][i], levels[d + 1][i]))  # noqa: B023
        after = {}
        for parent in {k[0] for k in nodes}:
            mine = sorted((b / a, k[1][1], b, a, k[1]) for k, (b, a) in nodes.items() if k[0] == parent and a)
            pools = []
            for x in mine:
                if pools:
                    p = pools[-1][-1]
                    both = (x[2] + p[2]) / (x[3] + p[3])
                    if x[0] - p[0] <= sigma * math.sqrt(both * (1 - both) * (1 / x[3] + 1 / p[3])):
                        pools[-1].append(x)
                        continue
                pools.append([x])
            sums = {x[4]: (sum(y[2] for y in pool), sum(y[3] for y in pool)) for pool in pools for x in pool}
            for k in nodes:
                if k[0] == parent:
                    b, a = sums.get(k[1], (0, 0))
                    after[k[1]] = (b + smooth * estimate[parent]) / (a + smooth) if a else base
        estimate = after
    template = [t + ("/**" if len(segments[i]) > depth else "") for i, (_, t) in enumerate(levels[depth])]
    leaf = grouped(lambda i: (levels[depth][i], template[i]))
    out = []
    for i in range(len(rows)):
        b, a = leaf[levels[depth][i], template[i]]
        out.append((template[i], round((b + smooth * estimate[levels[depth][i]]) / (a + smooth), 6)))
    return out


def test_url_tree_equals_a_plain_tree(spark):
    """Several hosts and levels, repeated rows, unlabelled branches, and branches that merge or stay apart below the first level."""
    r = np.random.default_rng(16)
    urls = []
    for host in ("a.test", "b.test", "c.other", "d.net"):
        for top in ("x", "y", "zz"):
            for sub in ("good", "bad", "mix", "new"):
                urls += [f"http://{host}/{top}/{sub}/{int(r.integers(0, 9))}/{k}" for k in range(int(r.integers(3, 30)))]
        urls += [f"http://{host}/{k}.html" for k in range(12)] + [f"http://{host}/", f"http://{host}"] * 3
    rules = [("block", "test", f"/{top}/bad/{k}") for top in ("x", "y") for k in range(7)] + [("allow", "test", f"/{top}/good/") for top in ("x", "zz")] + [("block", "a.test", "/x/mix/1"), ("allow", "a.test", "/x/mix/2"), ("block", "d.net", "/")]
    got = {x.page_id: (x.template, round(x.bad, 6)) for x in url_filters.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules, many_pages=15, least_share=0.4).collect()}
    want = plain_tree(urls, rules, many_pages=15, least_share=0.4)
    assert [got[i] for i in range(len(urls))] == want
    assert len({b for _, b in want}) > 10


# mixing


def test_mix_targets_and_cuts(spark):
    r = np.random.default_rng(5)
    rows = [(i, ["a", "b", "c", "d", None][int(r.choice(5, p=[0.5, 0.2, 0.1, 0.1, 0.1]))], int(r.integers(0, 50))) for i in range(600)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, size long")).collect()
    assert len(got) == 600
    size = Counter()
    for _, s, n in rows:
        size[s] += n
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, over = {}, 1.5 * sum(size.values())
    free = list(order)
    while free:  # what is over is dealt again by weight
        share = over / sum(weight[s] for s in free)
        full = [s for s in free if share * weight[s] > 2 * size[s]]
        if not full:
            target |= {s: share * weight[s] for s in free}
            break
        for s in full:
            target[s] = 2.0 * size[s]
            over -= target[s]
            free.remove(s)
    taken = Counter()
    for x in got:
        assert math.isclose(x.target, target[x.source], rel_tol=1e-9) and x.source_size == size[x.source] and 0 <= x.taken <= 2 * x.size
        taken[x.source] += x.taken
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in order)


def test_mix_odd_rows(spark, odd, none):
    got = mixing.mixed_documents(odd)
    assert got.columns == odd.columns and got.where("doc_id = 3").count() == 0
    sizes = mixing.mix(odd.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")))
    assert {r.doc_id: r["size"] for r in sizes.collect() if r.doc_id in (3, 4, 5, 6, 9)} == {3: 0, 4: 0, 5: 0, 6: 1, 9: 30_000}
    assert mixing.mixed_documents(none).count() == 0


# token counts


def test_token_counts_equal_the_library(spark, odd, none, small):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(token_counts.vocabulary_path())
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").union(odd.select("doc_id", "text"))
    texts = [r.text or "" for r in docs.collect()]
    got = token_counts.token_counts(docs).collect()
    want = sorted((len(t.encode()), len(e.ids)) for t, e in zip(texts, lib.encode_batch(texts, add_special_tokens=False)))
    assert sorted((r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)
    assert token_counts.token_counts(none).count() == 0


def test_piece_counter_on_any_text():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    counter = token_counts.PieceCounter(token_counts.vocabulary_path())

    @settings(max_examples=400, deadline=None)
    @given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("abcXYZ019 '\u0130\u01c5\u00df\u03a3\x1c\x1f\x85\xa0\n!$")), max_size=40))
    def same(text):
        assert counter.count([text]) == [len(counter.library.encode(text, add_special_tokens=False).ids)]

    same()


# license scans


def test_license_scan_finds_whole_notices(spark):
    filler = " ".join(f"f{i}" for i in range(101))
    rows = [(i, f"{' '.join(filler.split()[: i % 17])} {t}. {filler}") for i, t in enumerate(license_scan.TEMPLATES.values())]
    rows += [(100, filler), (101, None), (102, ""), (103, "the MIT"), (104, filler + " RELEASED under\nthe (MIT) License!")]
    got = {(r.doc_id, r.template): r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, name in enumerate(license_scan.TEMPLATES):
        assert got[i, name].containment == 1.0
    assert (104, "mit") in got and not {k[0] for k in got} & {100, 101, 102, 103}
    assert license_scan.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def notice_words(text):
    apart = license_scan.APART
    return lower((text or "").translate({ord(c): " " for c in apart})).split(" ")


def plain_scan(text):
    """Templates of which some stretch of the text, long enough for it, holds 0.8 of the shingles: no bands, no hashes."""
    w = [x for x in notice_words(text) if x]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    found = set()
    for name, notice in license_scan.TEMPLATES.items():
        n = [x for x in notice_words(notice) if x]
        wanted = {tuple(n[i : i + 3]) for i in range(len(n) - 2)}
        span = 2 * len(n)
        if any(len(wanted & set(grams[i : i + span])) >= 0.8 * len(wanted) for i in range(max(1, len(grams)))):
            found.add(name)
    return found


def test_license_scan_of_edited_notices_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    filler = [f"f{i}" for i in range(200)]
    rows = []
    for notice in license_scan.TEMPLATES.values():
        for _ in range(12):
            w = notice.split()
            for _ in range(int(rng.integers(0, 1 + len(w) // 8))):
                at = int(rng.integers(len(w)))
                w[at : at + 1] = [] if rng.random() < 0.5 else ["other", "words"][: int(rng.integers(1, 3))]
            a = int(rng.integers(0, 40))
            rows.append((len(rows), " ".join([*filler[:a], *w, *filler[a : 2 * a]])))
    got = {}
    for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, set()).add(r.template)
    want = {(i, name) for i, t in rows for name in plain_scan(t)}
    have = {(i, name) for i, names in got.items() for name in names}
    assert len(want) > len(rows) / 2
    assert have <= want
    assert len(have & want) >= 0.95 * len(want)


def test_license_scan_odd_rows(spark, odd, none):
    short = "All Rights Reserved."
    long = " ".join(f"w{i % 977}" for i in range(30_000)) + " " + short
    rows = [(1, short, 7, "t", "a"), (1, short, 7, "t", "a"), (None, short, 7, "t", "a"), (None, f"x {short} y {short}", 7, "t", "a"), (2, "all rights", 7, "t", "a"), (3, long, 7, "t", "a")]
    d = spark.createDataFrame(rows, "doc_id long, text string, row long, template string, hashes string")
    got = sorted((r.doc_id or 0, r.template, r.n_windows, r.first_word) for r in license_scan.scan(d).collect())
    assert got == [(0, "all-rights-reserved", 1, 0), (0, "all-rights-reserved", 2, 1), (1, "all-rights-reserved", 1, 0), (1, "all-rights-reserved", 1, 0), (3, "all-rights-reserved", 1, 30_000)]
    assert license_scan.scan(odd).count() == 0 and license_scan.scan(none).count() == 0


# LM scoring


def is_held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5, F.lit(0)) == 1


def test_lm_base_score_and_counts(spark, odd, none):
    rows = [(i, t) for i, t, *_ in odd_documents()] + [(100 + i, f"The cat number {i % 7} sat on the mat and saw word{i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("chunk", F.lit("x"))
    got = lm_scoring.score(docs, held_out(), chunk_rows=32, part_rows=2000).collect()
    assert len(got) == len(rows)
    count = Counter()
    for i, t in rows:
        if not is_held(i):
            count.update([*WORD.findall(lower(t or "")), None])
    n, v = sum(count.values()), len(count)
    want = Counter()
    for i, t in rows:
        tokens = [*WORD.findall(lower(t or "")), None]
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        want[(i, is_held(i), len(tokens), sum(count[w] > 0 for w in tokens), n, round(base, 6), sum(len(w.encode()) + 1 for w in tokens if w) + 1)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), r.n_bytes) for r in got) == want
    assert all(r.score < 0 and math.isclose(r.bits_per_byte, -r.score / math.log10(2) / r.n_bytes) for r in got)
    assert lm_scoring.score(none, F.lit(False)).count() == 0


def plain_units(words):
    """The units of a text: heads as (bytes before, bytes), words as bytes with their space."""
    before = b""
    for w in words:
        yield before[-lm_scoring.BACK :], (w + b" ")[: lm_scoring.HEAD]
        if len(w) >= lm_scoring.HEAD:
            yield None, w + b" "
        before = w
    yield before[-lm_scoring.BACK :], b"\xff"


def plain_events(before, body):
    """(contexts, byte) of every coded byte of a unit."""
    if before is not None:
        for j, byte in enumerate(body):
            last = (b"\0" + before + body[:j])[-1:] if j or before else b"\0"
            yield [("h", j, last if c is None else (before[len(before) - min(c, len(before)) :].rjust(c, b"\0"), body[:j])) for c in lm_scoring.LONGEST], byte
        return
    for j in range(lm_scoring.HEAD, len(body)):
        padded = b"\0\0" + body
        yield [*[("t", k, padded[j + 2 - k : j + 2]) for k in (2, 3, 4, 5)], ("w", body[:j])], body[j]


def plain_probability(contexts, byte, counts, mixer):
    """One byte's probability, decision by decision."""
    p = 1.0
    for bit in range(8):
        same = [[n for b, n in counts.get((k, c), {}).items() for _ in [0] if b >> (8 - bit) == byte >> (8 - bit) and (b >> (7 - bit)) & 1 == side] for k, c in enumerate(contexts) for side in (0, 1)]
        x = [max(-127, min(127, round(float(np.float32(math.log((sum(one) + 0.25) / (sum(zero) + 0.25)))) * 8))) / 8 for zero, one in zip(same[::2], same[1::2])]
        sure = [sum(abs(v) > b for b in (0.3, 1.5, 3.5)) for v in x]
        w = mixer.weights[16 * (contexts[4][0] == "w") + 4 * sure[4] + sure[2], bit]
        z = max(-12.0, min(12.0, sum(float(a) * b for a, b in zip(w, [*x, 1.0]))))
        spot = ((1 << bit) | (byte >> (8 - bit))) * lm_scoring.BUCKETS + max(-16, min(16, round(2 * z))) + 16
        one = (1 / (1 + math.exp(-z)) + float(mixer.refined[spot])) / 2
        p *= one if (byte >> (7 - bit)) & 1 else 1 - one
    return p


def test_lm_scores_equal_a_plain_mixer(spark, monkeypatch):
    """Counts, mixing, refining and the online mixture of experts, worked out one byte and one word at a time."""
    r = np.random.default_rng(11)
    vocabulary = [bytes(r.choice(list(b"abcdeorst"), int(r.integers(1, 9)))).decode() for _ in range(60)] + ["é", "naïve", "x" * 40]
    rows = [(i, " ".join(r.choice(vocabulary, int(r.integers(0, 40))))) for i in range(60)] + [(100, None), (101, "unseen words here"), (102, "A  a\tA")]
    kept = []
    put = lm_scoring.Mixer.put
    monkeypatch.setattr(lm_scoring.Mixer, "put", lambda self, a, b: (put(self, a, b), kept.append(self))[0])
    got = {x.doc_id: x.score for x in lm_scoring.score(spark.createDataFrame(rows, "doc_id long, text string"), held_out(), chunk_rows=16, part_rows=1200).collect()}
    (mixer,) = kept
    counts = {}
    texts = {i: [w.encode() for w in WORD.findall(lower(t or ""))] for i, t in rows}
    for i, words in texts.items():
        if not is_held(i):
            for unit in plain_units(words):
                for contexts, byte in plain_events(*unit):
                    for k, c in enumerate(contexts):
                        counts.setdefault((k, c), Counter())[byte] += 1
    for i, words in texts.items():
        units = list(plain_units(words))
        p = [math.prod(plain_probability(c, b, counts, mixer) for c, b in plain_events(*u)) for u in units]
        each, at = [], 0  # of each word and the end
        for w in [*words, None]:
            take = 2 if w is not None and len(w) >= lm_scoring.HEAD else 1
            each.append(math.prod(p[at : at + take]))
            at += take
        belief, total = [1 / len(lm_scoring.EXPERTS)] * len(lm_scoring.EXPERTS), 0.0
        for j, (w, q) in enumerate(zip([*words, None], each)):
            own = [(1 - e) * q + e * (words[:j].count(w) / j) if j else q for e in lm_scoring.EXPERTS]
            mixed = sum(a * b for a, b in zip(belief, own))
            belief = [a * b / mixed for a, b in zip(belief, own)]
            total += math.log10(mixed)
        assert math.isclose(got[i], total, rel_tol=1e-3), (i, got[i], total)


def test_lm_probabilities_sum_to_one():
    data, offsets = _text.raw(pa.array(["the cat sat on the mat", "the dog", None]))
    units = lm_scoring.Units()
    units.seen(data, offsets, np.ones(3, bool))
    every = np.concatenate([lm_scoring.IS_HEAD | (np.uint64(before) << np.uint64(24)) | (np.arange(256, dtype=np.uint64) << np.uint64(16)) for before in (0, int.from_bytes(b"the", "big"))])
    units.add(every, np.zeros(512, np.int64), np.zeros(512, np.int64), np.zeros(0, np.uint8))
    keys, n, lengths, body = units.total()
    events = lm_scoring.Events(keys, n, lengths, body)
    answers = {b: a for b, ask in lm_scoring.dealt_asks(events, 3) for a in lm_scoring.answers([lm_scoring.unboxed(ask)])}
    p = 2 ** lm_scoring.Mixer().log2_probability(events, lm_scoring.inputs(events, answers, 3, False))
    first = events.codes[0] >> np.uint64(56) == 0
    for before in (0, int.from_bytes(b"the", "big")):
        of = first & ((keys[events.owner] & ~lm_scoring.IS_HEAD) >> np.uint64(24) == before)
        symbols, at = np.unique(events.symbol[of], return_index=True)
        assert len(symbols) == 256 and math.isclose(p[of][at].sum(), 1, rel_tol=1e-5)


def test_lm_learns_from_all_training_texts(spark, monkeypatch):
    rows = [(i, f"text {i} of many " * (1 + i % 90)) for i in range(700)]
    taken = []
    put = lm_scoring.Mixer.put
    monkeypatch.setattr(lm_scoring.Mixer, "put", lambda self, a, b: (taken.append(b), put(self, a, b))[1])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert lm_scoring.score(docs, F.col("doc_id") % 5 == 1, chunk_rows=128, part_rows=100).count() == 700
    all_bytes = sum(len(t.strip()) + 2 for i, t in rows if i % 5 != 1)
    weights = lm_scoring.Mixer().weights.size
    assert taken[0][:weights].sum() == all_bytes * 8 * (lm_scoring.CONTEXTS + 1)
    assert taken[0][weights:].sum() == all_bytes * 8


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_lm_beats_word_frequencies_on_held_out_texts(spark, sf):
    got = lm_scoring.op7_lm_scoring(spark, f"/root/testdata/{sf}").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_lm_boxes_round_trip():
    r = np.random.default_rng(2)
    arrays = [r.integers(0, 1 << 63, 100).astype(np.uint64), np.zeros(0, np.int64), r.integers(0, 255, 7).astype(np.uint8)]
    assert all(np.array_equal(a, b) and a.dtype == b.dtype for a, b in zip(arrays, lm_scoring.unboxed(lm_scoring.boxed(*arrays)), strict=True))


# packing


def test_bucket_boundaries_are_optimal():
    from itertools import combinations

    r = np.random.default_rng(6)
    for _ in range(10):
        edges = np.sort(r.choice(200, 9, replace=False)) + 1
        counts = r.integers(1, 20, 9)
        cost = lambda bounds: sum(c * min(b for b in bounds if b >= e) for e, c in zip(edges, counts))  # noqa: E731,B023
        best = min(cost([*some, edges[-1]]) for k in range(3) for some in combinations(edges[:-1], k))
        assert cost(packing.boundaries(edges, counts, 3)) == best


def test_packing_holds_every_row_within_the_budget(spark, odd, none):
    r = np.random.default_rng(7)
    rows = [(i, int(x)) for i, x in enumerate(r.geometric(0.004, 900))] + [(9000, 40_000), (9001, 0), (9001, 0)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, length long"), buckets=5, budget=4096).collect()
    assert sorted((x.doc_id, x.length) for x in got) == sorted(rows)
    batches = Counter((x.bucket, x.batch) for x in got)
    for x in got:
        assert x.length <= x.padded_to and x.slot < max(1, 4096 // max(x.padded_to, 1))
    by = {}
    for x in got:
        by.setdefault(x.bucket, []).append(x)
    for b, xs in by.items():
        holds = max(1, 4096 // max(xs[0].padded_to, 1))
        assert sorted(n for (k, _), n in batches.items() if k == b)[1:] == [holds] * (len([1 for k, _ in batches if k == b]) - 1)
    assert packing.packed_documents(odd).count() == len(odd_documents())
    assert packing.packed_documents(none).count() == 0


# exact top-k


def test_top_k_equals_brute_force(spark):
    r = np.random.default_rng(8)
    v = r.normal(0, 1, (300, 16))
    v[50:120] = v[50]
    rows = [(i, [float(np.float32(x)) for x in v[i]]) for i in range(300)]
    rows += [(300, None), (320, [1.0, None] + [0.0] * 14), (340, [float("nan")] + [0.0] * 15), (360, [float("inf")] * 16), (None, [1.0] * 16), (40, rows[40][1]), (380, [0.0] * 16), (400, [])]
    got = exact_topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash")), F.col("vec_id") % 20 == 0, k=20, block_rows=64).collect()
    ids = np.array([*range(300), 380, 400])
    ints = np.floor(64 * np.vstack([np.float32(v), np.zeros((2, 16), np.float32)]).astype(np.float64)).astype(np.int64)
    want = set()
    for q in (i for i in range(len(ids)) if ids[i] % 20 == 0):
        s = ints @ ints[q]
        best = sorted((-int(s[i]), int(ids[i])) for i in range(len(ids)) if i != q)[:20]
        want |= {(int(ids[q]), k + 1, i, -s_) for k, (s_, i) in enumerate(best)}
    assert {tuple(x) for x in got} == want and len(got) == len(want)
    assert exact_topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0


def test_top_k_of_huge_components(spark):
    rows = [(0, [1e200, 1.0]), (1, [1e200, 2.0]), (2, [-1e200, 3.0]), (3, [1.0, 1e12]), (20, [0.5, 1e12]), (21, [2.0, 0.0])]
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in exact_topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=5, block_rows=2).collect()}
    ints = {i: [int(np.floor(64 * x)) for x in v] for i, v in rows}
    for q in (0, 20):
        s = {i: max(-(2**63 - 1), min(2**63 - 1, sum(a * b for a, b in zip(ints[q], v)))) for i, v in ints.items() if i != q}
        assert [got[q, k + 1] for k in range(5)] == [(i, s[i]) for i in sorted(s, key=lambda i: (-s[i], i))]


def test_blocks_are_skipped_or_read_as_deep_as_the_floor_asks():
    r = np.random.default_rng(15)
    v = np.zeros((4000, 6))
    v[:, 0] = np.floor(r.exponential(100, 4000))
    v[:, 1:] = r.integers(-3, 4, (4000, 5))
    lists = exact_topk.SortedLists(np.arange(4000), v)
    qs = np.array([[5.0, 1, 0, -1, 0, 0], [-1, 0, 0, 2, 0, 1], [1, 1, 1, 1, 1, 1], [9, 0, 0, 0, 0, 0], [0, 0, 0, 0, 0, 0]])
    s = v @ qs.T
    floors = np.array([np.sort(s[:, 0])[-9], -np.inf, s[:, 2].max() + 10**6, s[:, 3].max(), 0.0])
    got = {i: list(zip(ids.tolist(), scores.tolist())) for i, ids, scores in lists.reaching(qs, floors, 5)}
    assert 2 not in got
    for i in (0, 1, 3, 4):
        want = sorted((-s[j, i], j) for j in range(4000) if s[j, i] >= floors[i])[:5]
        assert got[i] == [(j, -x) for x, j in want]


def test_threshold_stops_early_on_spread_lists():
    r = np.random.default_rng(9)
    v = np.zeros((4000, 4))
    v[:, 0] = np.floor(r.exponential(100, 4000))
    v[:, 1:] = r.integers(-2, 3, (4000, 3))
    lists = exact_topk.SortedLists(np.arange(4000), v)
    ids, scores = lists.top(np.array([5.0, 1, 0, -1]), -1, 5)
    s = v @ np.array([5.0, 1, 0, -1])
    assert [(-a, b) for a, b in zip(scores, ids)] == sorted((-s[i], i) for i in range(4000))[:5]


# fingerprints


def test_fingerprints_edit_and_follow(spark, odd, none):
    rows = [(i, t) for i, t, *_ in odd_documents() if i is not None]
    rows = list(dict(rows).items())
    got = {r.doc_id: r for r in fingerprints.compared(spark.createDataFrame(rows, "doc_id long, text string").withColumn("value", F.lit(1)).withColumn("at", F.lit("clash"))).collect()}
    down = sorted(rows, reverse=True)
    for k, (i, t) in enumerate(down):
        t, nxt = t or "", down[(k + 1) % len(down)][1] or ""
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    assert got[6].fingerprint == got[7].fingerprint and got[4].fingerprint == ""
    assert len(got[9].fingerprint) % 16 == 0 and len(got[9].fingerprint) > 16 * 60
    assert fingerprints.compared(none).count() == 0
    assert fingerprints.compared(odd).count() == len(odd_documents())


def plain_sketches(spark, texts):
    """Sketches from plain Python shingles; only their hashes come from the engine, which defines them."""
    sets = {}
    for t in set(texts):
        w = WORD.findall(lower(t))
        sets[t] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({(" ".join(w), "short")} if w else set())
    hashes = {}
    for size in (2, 5):
        rows = sorted({g for x in sets.values() for g in x if len(g) == size})
        if rows:
            names = [f"w{k}" for k in range(size)]
            hashes |= {tuple(r)[:-1]: r.h for r in spark.createDataFrame(rows, names).select(*names, F.xxhash64(*names).alias("h")).collect()}
    most = -(1 << 63) + (1 << 64) // fingerprints.SCALE
    out = {}
    for t, x in sets.items():
        own = {hashes[g] for g in x}
        out[t] = {h for h in own if h < most} or ({min(own)} if own else set())
    return out


@pytest.mark.parametrize("rows_a_range", [3, 1024])
def test_fingerprints_equal_brute_force(spark, rows_a_range, monkeypatch):
    """Outlying, negative and repeated ids, a hot one, null ids and short texts: order, sketches and likenesses."""
    monkeypatch.setattr(fingerprints, "QUANTILES", 16)
    r = np.random.default_rng(14)
    words = [f"w{i}" for i in range(30)]
    text = lambda: " ".join(r.choice(words, int(r.integers(0, 14))))
    rows = [(int(i), text()) for i in [*range(60), -(10**15), 10**17, 9 * 10**18, *[7] * 60, 7, 12, 12]] + [(None, text()) for _ in range(20)] + [(7, "same text"), (7, "same text"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = fingerprints.with_next(docs, fingerprints.sketch(F.col("text")), rows_a_range).collect()
    hashed = {x.text: x.h for x in docs.select(F.coalesce("text", F.lit("")).alias("text")).distinct().select("text", F.xxhash64("text").alias("h")).collect()}
    down = sorted(((i, t or "") for i, t in rows), key=lambda x: (x[0] is None, -(x[0] or 0), hashed[x[1]], x[1]))
    want = Counter((i, t, down[(k + 1) % len(down)][1]) for k, (i, t) in enumerate(down))
    assert Counter((x.doc_id, x.text, x.next_text) for x in got) == want
    plain = plain_sketches(spark, [t for _, t in down])
    assert all(sorted(plain[x.text]) == x.value and sorted(plain[x.next_text]) == x.next_value for x in got)

    edits = {(i, t, after): t[: len(t) - len(t) // 2] + after[: len(t) // 2] for i, t, after in want}
    plain |= plain_sketches(spark, edits.values())
    like = lambda a, b: 1.0 if a == b else (len(plain[a] & plain[b]) / len(plain[a] | plain[b]) if plain[a] | plain[b] else 0.0)
    print_ = lambda t: "".join(f"{h & (2**64 - 1):016X}" for h in sorted(plain[t]))
    judged = Counter()
    for (i, t, after), n in want.items():
        edited = edits[i, t, after]
        judged[i, len(t), hashlib.sha256(edited.encode()).hexdigest(), print_(t), print_(edited), round(like(t, edited), 9), round(like(t, after), 9)] += n
        assert bool(print_(t)) == bool(t.split())
    assert Counter((*x[:5], round(x.near_edited, 9), round(x.near_next, 9)) for x in fingerprints.compared(docs).collect()) == judged


def test_sketches_merge_and_estimate(spark):
    a = " ".join(f"a{i}" for i in range(6000))
    b = " ".join(f"a{i}" for i in range(3000))
    own = spark.createDataFrame([(a, b)], "a string, b string").select(fingerprints.sketch(F.col("a")).alias("a"), fingerprints.sketch(F.col("b")).alias("b"))
    r = own.select(fingerprints.resemblance(F.col("a"), F.col("b")).alias("j"), fingerprints.containment(F.col("b"), F.col("a")).alias("c"), (fingerprints.merged(F.col("a"), F.col("b")) == F.col("a")).alias("m"), F.size("a").alias("n")).first()
    assert abs(r.j - 0.5) < 0.1 and r.c == 1.0 and r.m and abs(r.n - 1500) < 170


# pipeline


def test_pipeline_stages(spark, odd, none, small):
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == odd.columns
    ids = {r.doc_id for r in docs.collect()}
    assert not ids & {3, 4, 5, 10} and not {6, 7} <= ids
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, small).count() == 0
    assert len(corpus_pipeline.STAGES) == 4


def test_pipeline_keeps_clean_documents_and_one_of_each_group(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    first = corpus_pipeline.language_id(spark, docs, small)
    assert first.count() >= 0.97 * docs.count()
    rows = [(r.doc_id, r.text) for r in first.collect()]
    want, _ = brute_components(rows, corpus_pipeline.NEAR)
    assert sorted(r.doc_id for r in corpus_pipeline.ngram_join(spark, first, small).collect()) == sorted(i for i, (_, c) in want.items() if i == c)
