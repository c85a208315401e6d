"""Feature profiles, anomaly scores, ranking metrics and drift, as aggregations and windows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def stacked(df: DataFrame, features: Sequence[str], *keep: str) -> DataFrame:
    """(keep, feature, value): one row a feature and row."""
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]))
    return df.select(*keep, each.alias("f")).select(*keep, "f.feature", "f.value")


def profile(df: DataFrame, features: Sequence[str], low: float = 0.05, high: float = 0.95) -> DataFrame:
    """null_rate, variance and exact quantile spread of each feature."""
    long = stacked(df, features)
    plain = long.groupBy("feature").agg(F.avg(F.col("value").isNull().cast("double")).alias("null_rate"), F.coalesce(F.var_samp("value"), F.lit(0.0)).alias("variance"))
    ends = quantiles(long, ["feature"], "value", [low, high])
    spread = ends.groupBy("feature").agg((F.max(F.when(F.col("q") == high, F.col("quantile"))) - F.max(F.when(F.col("q") == low, F.col("quantile")))).alias("spread"))
    return plain.join(F.broadcast(spread), "feature", "left")  # a row a feature


def ranked_features(profiled: DataFrame, boosted: Sequence[str] = (), boost: float = 1.1, most_null: float = 0.95, least_variance: float = 1e-12) -> DataFrame:
    """Score (1 - null rate) * spread * boost, the reason a feature is dropped, and ranks of the rest by score, then name."""
    factor = F.when(F.col("feature").isin(*boosted), boost).otherwise(1.0) if boosted else F.lit(1.0)
    reason = F.when(F.col("null_rate") > most_null, "null_rate").when(F.col("variance") <= least_variance, "variance")
    scored = profiled.withColumn("dropped", reason).withColumn("score", (1 - F.col("null_rate")) * F.coalesce("spread", F.lit(0.0)) * factor)
    place = F.row_number().over(Window.orderBy(F.col("dropped").isNotNull(), F.desc("score"), "feature"))  # a row a feature
    return scored.withColumn("place", F.when(F.col("dropped").isNull(), place))


def _tie_ranks(df: DataFrame, by: Sequence[str], value: str, rows: str = "n") -> DataFrame:
    """(by, value, rows, below, upto): counts of distinct values and how many rows lie below and up to each.

    Values are dealt by ranges between quantiles of the distinct ones, each
    accumulated on its own, then the ranges' sums are added, so a whole column
    isn't ordered in one task, however its values are spread.
    """
    steps = [2**i for i in range(9, -1, -1)]
    parts = 2 * steps[0]
    on = list(by)
    counts = df.groupBy(*by, value).agg(F.count("*").alias(rows))
    # rows are asked for, so that both uses of the counts have the same columns and share one shuffle
    bounds = counts.groupBy(*by).agg(F.percentile_approx(F.when(F.col(rows) > 0, F.col(value)), [i / parts for i in range(1, parts)], 10_000).alias("_bounds"))
    part = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: at + F.when(F.get("_bounds", at + s - 1) < F.col(value), s).otherwise(0))  # how many bounds lie below, by halving
    counts = (counts.join(F.broadcast(bounds), on) if on else counts.crossJoin(F.broadcast(bounds))).withColumn("_part", part).drop("_bounds")  # one row a group
    sums = counts.groupBy(*by, "_part").agg(F.sum(rows).alias("_s"))
    before = F.coalesce(F.sum("_s").over(Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.withColumn("_before", before).drop("_s")
    inner = F.sum(rows).over(Window.partitionBy(*by, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    out = counts.withColumn("_in", inner).join(sums, [*by, "_part"])
    return out.select(*by, value, rows, (F.col("_before") + F.col("_in") - F.col(rows)).alias("below"), (F.col("_before") + F.col("_in")).alias("upto"))


def quantiles(df: DataFrame, by: Sequence[str], value: str, qs: Sequence[float]) -> DataFrame:
    """(by, q, quantile): exact quantiles of non-null values, interpolated, from their ranks rather than in one task a group."""
    some = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    ranks = _tie_ranks(some, by, "_v")
    total = some.groupBy(*by, "_v").agg(F.count("*").alias("n")).groupBy(*by).agg(F.sum("n").alias("_total"))  # the ranks' own counts, whose shuffle is shared
    each = (ranks.join(F.broadcast(total), list(by)) if by else ranks.crossJoin(F.broadcast(total))).withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs])))  # one row a group
    place = (F.col("_total") - 1) * F.col("q")
    low, high = F.floor(place), F.ceil(place)
    each = each.where((F.col("below") <= high) & (F.col("upto") > low)).withColumn("_share", place - low)
    holds = lambda at: F.max(F.when((F.col("below") <= at) & (F.col("upto") > at), F.col("_v")))
    found = each.groupBy(*by, "q").agg(holds(low).alias("_a"), holds(high).alias("_b"), F.max("_share").alias("_share"))
    return found.select(*by, "q", (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_share")).alias("quantile"))


def tail_probability(df: DataFrame, row_id: str, features: Sequence[str]) -> DataFrame:
    """(row_id, score): the largest of the sums of -log tail probabilities to the left, to the right, and on the side of each feature's skew.

    The empirical distribution of a feature counts ties fully on both sides,
    so no probability is below 1/n. Nulls are left out.
    """
    long = stacked(df, features, row_id).where(F.col("value").isNotNull())
    ranks = _tie_ranks(long, ["feature"], "value")
    stats = long.groupBy("feature").agg(F.count("*").alias("total"), F.skewness("value").alias("skew"))
    tails = ranks.join(F.broadcast(stats), "feature").select(  # a row a feature
        "feature",
        "value",
        (-F.log(F.col("upto") / F.col("total"))).alias("left_tail"),
        (-F.log((F.col("total") - F.col("below")) / F.col("total"))).alias("right_tail"),
        "skew",
    )
    side = F.when(F.col("skew") < 0, F.col("left_tail")).otherwise(F.col("right_tail"))
    return long.join(tails, ["feature", "value"]).groupBy(row_id).agg(F.greatest(F.sum("left_tail"), F.sum("right_tail"), F.sum(side)).alias("score"))


def histogram_score(df: DataFrame, row_id: str, features: Sequence[str], bins: int = 10, floor: float = 1e-12) -> DataFrame:
    """(row_id, score): the sum of -log densities over equal-width bins of each feature."""
    long = stacked(df, features, row_id).where(F.col("value").isNotNull())
    stats = long.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("*").alias("total"))
    bin_ = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col("value") - F.col("lo")) / ((F.col("hi") - F.col("lo")) / bins)), F.lit(bins - 1))).otherwise(0)
    binned = long.join(F.broadcast(stats), "feature").withColumn("bin", bin_.cast("int"))  # a row a feature
    counts = binned.groupBy("feature", "bin").agg(F.count("*").alias("n"))
    density = F.greatest(F.col("n") / F.col("total"), F.lit(floor))
    return binned.join(counts, ["feature", "bin"]).groupBy(row_id).agg(F.sum(-F.log(density)).alias("score"))


def kmeans_score(df: DataFrame, row_id: str, features: Sequence[str], k: int = 8, seed: int = 7, weights: Mapping[str, float] | None = None) -> DataFrame:
    """(row_id, cluster, score): distance to the nearest centre over that cluster's mean distance, on standardised (and weighted) columns."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    filled = df.select(row_id, *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features])
    vectors = VectorAssembler(inputCols=list(features), outputCol="raw").transform(filled)
    scaled = StandardScaler(inputCol="raw", outputCol="x", withMean=True).fit(vectors).transform(vectors)
    if weights:
        from pyspark.ml.feature import ElementwiseProduct
        from pyspark.ml.linalg import Vectors

        scaled = ElementwiseProduct(scalingVec=Vectors.dense([float(weights.get(f, 1.0)) for f in features]), inputCol="x", outputCol="xw").transform(scaled).drop("x").withColumnRenamed("xw", "x")
    model = KMeans(k=k, seed=seed, featuresCol="x", predictionCol="cluster").fit(scaled)
    from pyspark.ml.functions import vector_to_array

    centres = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in model.clusterCenters()])
    near = F.get(centres, F.col("cluster"))
    gap = F.sqrt(F.aggregate(F.zip_with(vector_to_array("x"), near, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v))
    out = model.transform(scaled).withColumn("distance", gap)
    mean = out.groupBy("cluster").agg(F.avg("distance").alias("mean_distance"))  # k rows
    return out.join(F.broadcast(mean), "cluster").withColumn("score", F.col("distance") / F.greatest("mean_distance", F.lit(1e-12))).select(row_id, "cluster", "score")


def pca_score(df: DataFrame, row_id: str, features: Sequence[str], k: int) -> DataFrame:
    """(row_id, score): mean squared error of the reconstruction from k principal components of standardised columns."""
    from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    filled = df.select(row_id, *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features])
    vectors = VectorAssembler(inputCols=list(features), outputCol="raw").transform(filled)
    scaled = StandardScaler(inputCol="raw", outputCol="x", withMean=True).fit(vectors).transform(vectors)
    parts = PCA(k=k, inputCol="x", outputCol="z").fit(scaled)
    pc = parts.pc.toArray()
    z, x = vector_to_array("z"), vector_to_array("x")
    error = sum(F.pow(F.get(x, F.lit(i)) - sum((F.get(z, F.lit(j)) * float(pc[i, j]) for j in range(k)), F.lit(0.0)), 2) for i in range(len(features))) / len(features)
    return parts.transform(scaled).select(row_id, error.alias("score"))


def isolation_scores(df: DataFrame, row_id: str, features: Sequence[str], trees: int = 50, sample: int = 256, seed: int = 7, mondrian: bool = False) -> DataFrame:
    """(row_id, score): 2 ** (-mean depth / c), from random trees grown on a bounded hash sample; `mondrian` picks split columns by their range.

    Trees grow on the driver from `trees` * `sample` rows at most and score in
    Arrow batches.
    """
    import pandas as pd

    filled = df.select(row_id, *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features])
    rows = np.array(filled.orderBy(F.xxhash64(F.lit(seed), row_id)).limit(trees * sample).select(*features).collect(), float).reshape(-1, len(features))
    r = np.random.default_rng(seed)

    def harmonic(n: int) -> float:
        return 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else float(n == 2)

    def grow(x: np.ndarray, depth: int, most: int):
        low, high = x.min(0), x.max(0)
        open_ = np.flatnonzero(high > low)
        if depth >= most or len(x) <= 1 or not len(open_):
            return depth + harmonic(len(x))
        p = (high - low)[open_] if mondrian else np.ones(len(open_))
        f = int(r.choice(open_, p=p / p.sum()))
        at = float(r.uniform(low[f], high[f]))
        return f, at, grow(x[x[:, f] <= at], depth + 1, most), grow(x[x[:, f] > at], depth + 1, most)

    size = min(sample, max(len(rows), 1))
    forest = [grow(rows[r.choice(len(rows), size, replace=False)], 0, int(np.ceil(np.log2(max(size, 2))))) for _ in range(trees)] if len(rows) else []

    def depth(tree, x: np.ndarray) -> np.ndarray:
        if not isinstance(tree, tuple):
            return np.full(len(x), tree)
        f, at, a, b = tree
        left, out = x[:, f] <= at, np.empty(len(x))
        out[left], out[~left] = depth(a, x[left]), depth(b, x[~left])
        return out

    def scored(batches):
        for rows_ in batches:
            x = rows_[list(features)].to_numpy(float)
            yield pd.DataFrame({row_id: rows_[row_id], "score": 2.0 ** (-np.mean([depth(t, x) for t in forest], axis=0) / max(harmonic(size), 1e-9))})

    return filled.mapInPandas(scored, f"`{row_id}` {dict(df.dtypes)[row_id]}, score double")


def score_order(score: str, row_id: str) -> list[Column]:
    """Best first; ties by the id as text."""
    return [F.desc(score), F.col(row_id).cast("string")]


def top_k_metrics(df: DataFrame, row_id: str, score: str, label: str, ks: Sequence[int]) -> DataFrame:
    """(k, hits, precision, recall, lift, score_at_k) for each k, without ordering the whole table: only its best rows."""
    most = max(ks)
    best = df.where(F.col(score).isNotNull()).orderBy(*score_order(score, row_id)).limit(most)
    placed = best.withColumn("place", F.row_number().over(Window.orderBy(*score_order(score, row_id))))  # max(ks) rows
    totals = df.where(F.col(score).isNotNull()).agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col(label)), F.lit(0)).alias("positives"))
    each = placed.withColumn("k", F.explode(F.array(*[F.lit(k) for k in ks]))).where(F.col("place") <= F.col("k"))
    sums = each.groupBy("k").agg(F.sum(F.coalesce(F.col(label), F.lit(0))).alias("hits"), F.count("*").alias("taken"), F.min(score).alias("score_at_k"))
    out = sums.join(F.broadcast(totals))  # one row
    rate = F.col("positives") / F.col("n")
    return out.select(
        "k",
        F.col("hits").cast("long").alias("hits"),
        (F.col("hits") / F.col("taken")).alias("precision"),
        F.when(F.col("positives") > 0, F.col("hits") / F.col("positives")).alias("recall"),
        F.when(F.col("positives") > 0, F.col("hits") / F.col("taken") / rate).alias("lift"),
        "score_at_k",
    )


def k_grid(rows: int, positives: int = 0, fixed: Sequence[int] = (), shares: Sequence[float] = ()) -> list[int]:
    """The ks to report: fixed ones, shares of the rows (at least 1), and as many as there are positives; none beyond the rows."""
    ks = {*map(int, fixed), *(max(1, round(rows * s)) for s in shares), int(positives)}
    return sorted(k for k in ks if 1 <= k <= rows)


def rank_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """(n_pos, n_neg, auc): rank-sum area under the ROC curve, ties counting half, from counts of distinct scores."""
    good = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).select(F.col(score).cast("double").alias("s"), F.col(label).alias("y"))
    ranks = _tie_ranks(good, [], "s")
    pos = good.where("y = 1").groupBy("s").agg(F.count("*").alias("p"))
    total = good.agg(F.count_if(F.col("y") == 1).alias("n_pos"), F.count_if(F.col("y") != 1).alias("n_neg"))
    rank_sum = ranks.join(pos, "s").agg(F.sum(F.col("p") * (F.col("below") + F.col("upto") + 1) / 2).alias("r"))
    out = total.join(F.broadcast(rank_sum))  # one row each
    return out.select("n_pos", "n_neg", F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0), (F.col("r") - F.col("n_pos") * (F.col("n_pos") + 1) / 2) / (F.col("n_pos") * F.col("n_neg"))).alias("auc"))


def average_precision(df: DataFrame, score: str, label: str) -> DataFrame:
    """(ap): precision averaged over the recall steps of distinct scores."""
    good = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).select((-F.col(score).cast("double")).alias("s"), F.col(label).cast("int").alias("y"))
    all_ = _tie_ranks(good, [], "s").select("s", F.col("upto").alias("taken"))
    hits = _tie_ranks(good.where("y = 1"), [], "s", "p").select("s", "p", F.col("upto").alias("hits"))
    total = good.agg(F.count_if(F.col("y") == 1).alias("pos"))
    return all_.join(hits, "s").join(F.broadcast(total)).agg(F.sum(F.col("hits") / F.col("taken") * F.col("p") / F.col("pos")).alias("ap"))  # one row


def leaderboard(metrics: DataFrame, keys: Sequence[str], scenario: str, metric: str) -> DataFrame:
    """Mean, median, least and most of a metric over scenarios; places by mean, then spread, then key."""
    out = metrics.groupBy(*keys).agg(F.avg(metric).alias("mean"), F.percentile(metric, 0.5).alias("median"), F.min(metric).alias("least"), F.max(metric).alias("most"), F.countDistinct(scenario).alias("scenarios"))
    rounded = out.withColumns({c: F.round(c, 9) for c in ("mean", "median", "least", "most")})
    return rounded.withColumn("place", F.row_number().over(Window.orderBy(F.desc("mean"), F.col("most") - F.col("least"), *keys)))  # a row a candidate


def psi(reference: DataFrame, current: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """(psi): population stability index over the reference's quantile bins, ends open, shares floored at 0.1 / the larger count."""
    edges = quantiles(reference, [], value, [i / bins for i in range(1, bins)]).agg(F.array_sort(F.collect_set("quantile")).alias("edges"))  # bins - 1 rows
    both = reference.select(F.col(value).alias("v"), F.lit(1).alias("ref")).unionAll(current.select(F.col(value).alias("v"), F.lit(0).alias("ref"))).where("v IS NOT NULL")
    binned = both.join(F.broadcast(edges)).withColumn("bin", F.size(F.filter("edges", lambda e: F.col("v") > e)))  # one row of edges
    counts = binned.groupBy("bin").agg(F.sum("ref").alias("r"), F.sum(1 - F.col("ref")).alias("c"))
    totals = both.agg(F.sum("ref").alias("nr"), F.sum(1 - F.col("ref")).alias("nc"))
    floor = F.lit(0.1) / F.greatest("nr", "nc")
    r, c = F.greatest(F.col("r") / F.col("nr"), floor), F.greatest(F.col("c") / F.col("nc"), floor)
    return counts.join(F.broadcast(totals)).agg(F.sum((c - r) * F.log(c / r)).alias("psi"))


def feature_drift(reference: DataFrame, current: DataFrame, features: Sequence[str], most: float = 0.2, null_shift: float = 0.1, bins: int = 10) -> DataFrame:
    """(feature, reference_null_share, batch_null_share, null_share_shift, psi, status, null_shift_flag), all features in one pass.

    psi as in `psi`, over each feature's own quantile bins. status: drifted
    beyond `most`, ok, or unevaluable where a side has no finite value.
    """
    finite = F.when(~F.isnan("value") & (F.abs("value") < float("inf")), F.col("value"))
    side = lambda d, ref: stacked(d, features).select("feature", F.lit(ref).alias("ref"), F.col("value").isNull().alias("_null"), finite.alias("value"))
    both = side(reference, 1).unionAll(side(current, 0))
    edges = quantiles(both.where("ref = 1"), ["feature"], "value", [i / bins for i in range(1, bins)]).groupBy("feature").agg(F.array_sort(F.collect_set("quantile")).alias("edges"))  # bins - 1 values a feature
    share = lambda ref: F.avg(F.when(F.col("ref") == ref, F.col("_null").cast("double")))
    some = lambda ref: F.count(F.when(F.col("ref") == ref, F.col("value")))
    totals = both.groupBy("feature").agg(share(1).alias("reference_null_share"), share(0).alias("batch_null_share"), some(1).alias("nr"), some(0).alias("nc"))
    binned = both.where("value IS NOT NULL").join(F.broadcast(edges), "feature").withColumn("bin", F.size(F.filter("edges", lambda e: F.col("value") > e)))  # a row a feature
    counts = binned.groupBy("feature", "bin").agg(F.sum("ref").alias("r"), F.sum(1 - F.col("ref")).alias("c")).join(F.broadcast(totals), "feature").where("nr > 0 AND nc > 0")
    floor = F.lit(0.1) / F.greatest("nr", "nc")
    r, c = F.greatest(F.col("r") / F.col("nr"), floor), F.greatest(F.col("c") / F.col("nc"), floor)
    index = counts.groupBy("feature").agg(F.sum((c - r) * F.log(c / r)).alias("psi"))
    shift = F.abs(F.col("batch_null_share") - F.col("reference_null_share"))
    status = F.when(F.col("psi").isNull(), "unevaluable").when(F.col("psi") > most, "drifted").otherwise("ok")
    return totals.join(F.broadcast(index), "feature", "left").select("feature", "reference_null_share", "batch_null_share", shift.alias("null_share_shift"), "psi", status.alias("status"), F.coalesce(shift > null_shift, F.lit(False)).alias("null_shift_flag"))


def retrain_decision(drift: DataFrame, score_psi: DataFrame, most: float = 0.2, share: float = 0.25) -> DataFrame:
    """(n_features, n_evaluated, n_drifted, share_drifted, n_null_shift, score_psi, retrain): whether the score or enough features drifted."""
    one = drift.agg(F.count("*").alias("n_features"), F.count_if(F.col("status") != "unevaluable").alias("n_evaluated"), F.count_if(F.col("status") == "drifted").alias("n_drifted"), F.count_if("null_shift_flag").alias("n_null_shift"))
    part = F.when(F.col("n_evaluated") > 0, F.col("n_drifted") / F.col("n_evaluated")).otherwise(0.0)
    out = one.crossJoin(F.broadcast(score_psi.select(F.col("psi").alias("score_psi")))).withColumn("share_drifted", part)  # one row each
    retrain = F.coalesce(F.col("score_psi") > most, F.lit(False)) | ((F.col("n_evaluated") > 0) & (F.col("share_drifted") >= share))
    return out.select("n_features", "n_evaluated", "n_drifted", "share_drifted", "n_null_shift", "score_psi", retrain.alias("retrain"))


def total_variation(a: DataFrame, b: DataFrame, value: str) -> DataFrame:
    """(distance): half the sum of differences of shares."""
    both = a.select(F.col(value).alias("v"), F.lit(1).alias("a")).unionAll(b.select(F.col(value).alias("v"), F.lit(0).alias("a")))
    totals = both.agg(F.sum("a").alias("na"), F.sum(1 - F.col("a")).alias("nb"))
    counts = both.groupBy("v").agg(F.sum("a").alias("ca"), F.sum(1 - F.col("a")).alias("cb"))
    return counts.join(F.broadcast(totals)).agg((F.sum(F.abs(F.col("ca") / F.col("na") - F.col("cb") / F.col("nb"))) / 2).alias("distance"))


def cluster_drift(train: DataFrame, now: DataFrame, cluster: str, distance: str, least_rows: int = 5, share: float = 0.25, stretch: float = 1.25) -> DataFrame:
    """(cluster, status): vanished, emerged, unevaluable, drifted (its share or mean distance moved) or ok."""
    stats = lambda d, p: d.groupBy(cluster).agg(F.count("*").alias(f"{p}_n"), F.avg(distance).alias(f"{p}_d")).withColumn(f"{p}_share", F.col(f"{p}_n") / F.sum(f"{p}_n").over(Window.partitionBy()))
    both = stats(train, "t").join(stats(now, "n"), cluster, "full")
    status = (
        F.when(F.col("n_n").isNull(), "vanished")
        .when(F.col("t_n").isNull(), "emerged")
        .when(F.least("t_n", "n_n") < least_rows, "unevaluable")
        .when((F.abs(F.col("n_share") - F.col("t_share")) > share * F.col("t_share")) | (F.col("n_d") > stretch * F.col("t_d")), "drifted")
        .otherwise("ok")
    )
    return both.select(cluster, status.alias("status"))


def best_of_level(df: DataFrame, level: str, score: str, label: str) -> DataFrame:
    """One row an entity of a level: its highest score and label."""
    return df.groupBy(level).agg(F.max(score).alias(score), F.max(label).alias(label))


def review_queue(df: DataFrame, level: str, row_id: str, score: str, k: int) -> DataFrame:
    """The k entities with the highest scores, each by its best row (a top-k report)."""
    best = df.groupBy(level).agg(F.max_by(F.struct(F.col(score).alias("score"), F.col(row_id).alias("row_id")), F.struct(F.col(score), -F.col(row_id))).alias("b"))
    return best.select(level, "b.row_id", "b.score").orderBy(F.desc("score"), F.col(level).cast("string")).limit(k)


def signal(value: Column, bad_from: float, good_to: float) -> Column:
    """fraud above one threshold, normal below the other, uncertain between; null stays null."""
    return F.when(value.isNull(), None).when(value >= bad_from, "fraud").when(value <= good_to, "normal").otherwise("uncertain")


# Points of a signal by its weight class.
POINTS = {"H": 3.0, "M": 2.0, "L": 1.0}


def rule_score(signals: Mapping[str, str]) -> Column:
    """Points of all signals (column to weight class), an uncertain one giving half."""
    total = F.lit(0.0)
    for c, w in signals.items():
        total = total + F.when(F.col(c) == "fraud", POINTS[w]).when(F.col(c) == "uncertain", POINTS[w] / 2).otherwise(0.0)
    return total


def best_threshold(df: DataFrame, score: str, label: str, least_precision: float) -> DataFrame:
    """(threshold, precision, recall): the most recall with a precision of at least the floor, from counts of distinct scores."""
    good = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).select((-F.col(score).cast("double")).alias("s"), F.col(label).cast("int").alias("y"))
    all_ = _tie_ranks(good, [], "s").select("s", F.col("upto").alias("taken"))
    hits = _tie_ranks(good.where("y = 1"), [], "s", "p").select("s", F.col("upto").alias("hits"))
    total = good.agg(F.count_if(F.col("y") == 1).alias("pos"))
    each = all_.join(hits, "s").join(F.broadcast(total)).select((-F.col("s")).alias("threshold"), (F.col("hits") / F.col("taken")).alias("precision"), (F.col("hits") / F.col("pos")).alias("recall"))
    return each.where(F.col("precision") >= least_precision).orderBy(F.desc("recall"), F.desc("threshold")).limit(1)


def correlations(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(a, b, r) of mean-filled columns, all pairs in one aggregation."""
    means = df.agg(*[F.avg(f).alias(f"_{f}") for f in features])
    filled = df.join(F.broadcast(means)).select(*[F.coalesce(F.col(f).cast("double"), F.col(f"_{f}")).alias(f) for f in features])  # one row of means
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i + 1 :]]
    one = filled.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    return one.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r")) for i, (a, b) in enumerate(pairs)])).alias("p")).select("p.*")


def null_gaps(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(feature, bad_null, good_null, gap): null rates by label."""
    long = stacked(df, features, label)
    rate = lambda y: F.avg(F.when(F.col(label) == y, F.col("value").isNull().cast("double")))
    return long.groupBy("feature").agg(rate(1).alias("bad_null"), rate(0).alias("good_null")).withColumn("gap", F.abs(F.col("bad_null") - F.col("good_null")))
