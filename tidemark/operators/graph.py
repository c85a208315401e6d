"""Connected components and ordered chains."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.scratch import cut

MAX_ROUNDS = 200


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """Undirected components: (node, component), component being the smallest reachable node.

    Alternating large-star and small-star steps, each an aggregation with
    map-side combine and an equi-join, so a hub is never gathered in one task.
    Rounds grow with the logarithm of the diameter. Null ends and self loops
    are ignored; a node without another end does not appear. Raises after
    `max_rounds` rather than return unfinished labels.
    """
    a, b = F.col(src), F.col(dst)
    links = cut(edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    before = None
    for _ in range(max_rounds):
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: every larger neighbour goes to the smallest of the neighbourhood
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: the node and its smaller neighbours go to the smallest of them
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        links = cut(small.union(small_low.select("u", F.col("m").alias("v"))).distinct())
        now = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if before == now:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))


CHAIN = "node string, root string, position int, is_tail boolean"


def ordered_chains(edges: DataFrame, src: str, dst: str, at: str, max_depth: int = 50) -> DataFrame:
    """Successor chains: (node, root, position from 0, is_tail).

    A node keeps its earliest edge out and in; the latest edge of a cycle is
    cut. Conflicts are windows, and roots are found by pointer doubling, so a
    long chain needs rounds with the logarithm of its length. Raises where a
    chain is longer than `max_depth`.
    """
    plain = edges.where((F.col(src) != F.col(dst)) & F.col(at).isNotNull()).select(F.col(src).cast("string").alias("s"), F.col(dst).cast("string").alias("d"), F.col(at).alias("t"))
    by = lambda c: F.row_number().over(Window.partitionBy(c).orderBy("t", "s", "d"))
    kept = cut(plain.withColumn("n", by("s")).where("n = 1").withColumn("n", by("d")).where("n = 1").select("s", "d", "t"))
    # only rings are left as conflicts: a component with as many edges as nodes
    ring = connected_components(kept, "s", "d").withColumnRenamed("node", "s")
    counted = kept.join(ring, "s").groupBy("component").agg(F.count("*").alias("edges"))
    nodes = ring.groupBy("component").agg(F.count("*").alias("nodes"))
    rings = counted.join(nodes, "component").where("edges = nodes").select("component")
    latest = kept.join(ring, "s").join(rings, "component").withColumn("n", F.row_number().over(Window.partitionBy("component").orderBy(F.col("t").desc(), "s"))).where("n = 1").select("s")
    kept = cut(kept.join(latest, "s", "left_anti"))
    nodes = kept.select(F.col("s").alias("node")).union(kept.select(F.col("d").alias("node"))).distinct()
    state = cut(nodes.join(kept.select(F.col("d").alias("node"), F.col("s").alias("up")), "node", "left").select("node", F.coalesce("up", "node").alias("root"), F.when(F.col("up").isNull(), 0).otherwise(1).alias("position")))
    while True:
        above = state.select(F.col("node").alias("root"), F.col("root").alias("r2"), F.col("position").alias("p2"))
        state = cut(state.join(above, "root").select("node", F.col("r2").alias("root"), (F.col("position") + F.col("p2")).alias("position"), (F.col("p2") > 0).alias("moved")))
        if state.agg(F.coalesce(F.max("position"), F.lit(0))).first()[0] > max_depth:
            raise RuntimeError(f"a chain is longer than {max_depth}")
        if state.where("moved").isEmpty():
            break
    tails = kept.select(F.col("s").alias("node"), F.lit(False).alias("is_tail"))
    return state.join(tails, "node", "left").select("node", "root", F.col("position").cast("int").alias("position"), F.coalesce("is_tail", F.lit(True)).alias("is_tail"))


def closure(seeds: DataFrame, links: DataFrame, key: str, partner: str, rounds: int = 5, most: int = 5_000_000) -> DataFrame:
    """All keys reachable from the seeds over shared partners, by semi-joins; raises beyond `most` keys or when `rounds` don't suffice."""
    found = cut(seeds.select(key).distinct())
    n = found.count()
    for _ in range(rounds):
        partners = links.join(found, key, "left_semi").select(partner).distinct()
        grown = cut(links.join(partners, partner, "left_semi").select(key).union(found).distinct())
        now = grown.count()
        if now > most:
            raise RuntimeError(f"the slice has more than {most} keys")
        if now == n:
            return found
        found, n = grown, now
    raise RuntimeError(f"the slice did not close in {rounds} rounds")


def pair_links(pairs: DataFrame, a: str, b: str, key: str, partner: str) -> DataFrame:
    """Pairs of keys as links: both ends share the pair as their partner, so it is followed from either; nulls link nothing."""
    both = pairs.select(F.col(a).alias("_a"), F.col(b).alias("_b")).na.drop().where("_a <> _b").distinct()
    shared = F.concat_ws("|", F.col("_a").cast("string"), F.col("_b").cast("string"))
    return both.select(F.explode(F.array("_a", "_b")).alias(key), shared.alias(partner))


def slice_of(seeds: Sequence[DataFrame], links: Mapping[str, DataFrame], key: str, partner: str, rounds: int = 5, most: int = 5_000_000) -> DataFrame:
    """The closure of several seed tables under links of several kinds; partners of unlike kinds are never the same."""
    start = reduce(DataFrame.unionByName, [s.select(key) for s in seeds]).na.drop()
    kinds = [f.select(key, F.concat(F.lit(f"{kind}::"), F.col(partner).cast("string")).alias(partner)) for kind, f in sorted(links.items())]
    return closure(start, reduce(DataFrame.unionByName, kinds).na.drop(), key, partner, rounds, most)
