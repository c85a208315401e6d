"""URL filters: domain rules, then a path-template tree learned from what the rules decide.

DataFrame functions only. Per host, path segments that few pages share become
wildcards, level by level. At each level the children of a node are taken in
the order of their labelled share of blocked pages, and neighbours whose shares
do not differ significantly are merged into one pool. Estimates go down the
tree: a pool's share is smoothed towards its parent's, a host's towards that of
all labelled pages. A template is rejected where its own share, smoothed
towards its pool's, reaches a bound.

What the rules never decide has no label: a branch without labelled pages, be
it beside blocked ones, has the global estimate, 0.5 at most, and so is
allowed. Segments below `depth` levels are `**`.

A null url, or one without `://`, has an empty host and an empty path and no
rule. Repeated rows are judged alike. An empty table gives an empty result.
Columns other than page_id and url are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.scratch import cut, written
from tidemark.sources.tables import table

#: (verdict, host, path); a rule fits its host and all subdomains where the path starts with its path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    return (
        F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER),
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    )


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits, else null. The rules are a parameter and end up in the plan."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r)):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def grown(side: DataFrame) -> DataFrame:
    """A side of a join that grows with the pages, though it compresses well: never broadcast."""
    return side.hint("merge")


def templates(paths: DataFrame, depth: int, least_pages: int, least_share: float, many_pages: int) -> DataFrame:
    """Add the tree's levels `t0` to `t<depth>` and `template` to (host, path, n, ...).

    A segment stays where at least `least_pages` pages have it and either
    `least_share` of its parent's pages or `many_pages`; any other becomes
    `*`. What is deeper than `depth` becomes `**`.
    """
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    rows = paths.withColumn("segments", segments).withColumn("t0", F.lit(""))
    for level in range(depth):
        was, now = f"t{level}", f"t{level + 1}"
        # written at each level, as the level reads its rows three times
        rows = written(rows.withColumn("segment", F.get("segments", F.lit(level))), "url-level")
        children = rows.where("segment is not null").groupBy("host", was, "segment").agg(F.sum("n").alias("child"))
        parents = children.groupBy("host", was).agg(F.sum("child").alias("parent"))
        kept = children.where(F.col("child") >= least_pages).join(grown(parents), ["host", was])
        kept = kept.where((F.col("child") >= F.col("parent") * least_share) | (F.col("child") >= many_pages)).select("host", was, "segment", F.lit(True).alias("literal"))
        here = F.when(F.col("segment").isNull(), F.col(was)).when(F.col("literal"), F.concat(was, F.lit("/"), "segment")).otherwise(F.concat(was, F.lit("/*")))
        rows = rows.join(grown(kept), ["host", was, "segment"], "left").withColumn(now, here).drop("literal", "segment")
    last = F.col(f"t{depth}")
    return rows.withColumn("template", F.when(F.size("segments") > depth, F.concat(last, F.lit("/**"))).otherwise(last)).drop("segments")


def pooled(nodes: DataFrame, was: str, now: str, sigma: float) -> DataFrame:
    """(host, was, now, bad_n, all_n) of one level, with `pool_bad` and `pool_all` of the children each is merged with.

    A parent's labelled children are ordered by their share of blocked pages;
    neighbours stay in one pool unless their shares lie more than `sigma`
    standard errors apart. Children without labels have empty pools.
    """
    share = F.col("bad_n") / F.col("all_n")
    order = Window.partitionBy("host", was).orderBy("share", now)
    labelled = nodes.where("all_n > 0").withColumn("share", share)
    bad, all_ = F.lag("bad_n").over(order), F.lag("all_n").over(order)
    both = (F.col("bad_n") + bad) / (F.col("all_n") + all_)
    error = F.sqrt(both * (1 - both) * (1 / F.col("all_n") + 1 / all_))
    labelled = labelled.withColumn("apart", F.coalesce((F.col("share") - bad / all_ > sigma * error).cast("int"), F.lit(0)))
    labelled = labelled.withColumn("pool", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    pools = labelled.groupBy("host", was, "pool").agg(F.sum("bad_n").alias("pool_bad"), F.sum("all_n").alias("pool_all"))
    found = labelled.select("host", was, now, "pool").join(grown(pools), ["host", was, "pool"]).select("host", now, "pool_bad", "pool_all")
    joined = nodes.join(grown(found), ["host", now], "left")
    return joined.select("host", was, now, "bad_n", "all_n", F.coalesce("pool_bad", F.lit(0)).alias("pool_bad"), F.coalesce("pool_all", F.lit(0)).alias("pool_all"))


def purity(found: DataFrame, depth: int, smooth: float, sigma: float) -> DataFrame:
    """(host, template) with `bad`, the smoothed share of blocked pages among labelled ones, of (host, t0.., template, n_allow, n_block)."""
    levels = [f"t{d}" for d in range(depth + 1)]
    leaf = cut(found.groupBy("host", *levels, "template").agg(F.sum("n_block").alias("bad_n"), F.sum(F.col("n_block") + F.col("n_allow")).alias("all_n")))
    sums = [F.sum(c).alias(c) for c in ("bad_n", "all_n")]
    bad_n, all_n = leaf.agg(F.coalesce(F.sum("bad_n"), F.lit(0)), F.coalesce(F.sum("all_n"), F.lit(0))).first()
    base = min(bad_n / all_n, 0.5) if all_n else 0.0
    above = leaf.groupBy("host", "t0").agg(*sums).select("host", "t0", ((F.col("bad_n") + smooth * base) / (F.col("all_n") + smooth)).alias("estimate"))
    for was, now in zip(levels[:-1], levels[1:], strict=True):
        nodes = cut(leaf.groupBy("host", was, now).agg(*sums))
        here = pooled(nodes, was, now, sigma).join(grown(above), ["host", was])
        smoothed = (F.col("pool_bad") + smooth * F.col("estimate")) / (F.col("pool_all") + smooth)
        above = cut(here.select("host", now, F.when(F.col("pool_all") > 0, smoothed).otherwise(F.lit(float(base))).alias("estimate")))
    judged = leaf.join(grown(above), ["host", levels[-1]])
    return judged.select("host", "template", ((F.col("bad_n") + smooth * F.col("estimate")) / (F.col("all_n") + smooth)).alias("bad"))


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    depth: int = 3,
    least_pages: int = 5,
    least_share: float = 0.02,
    many_pages: int = 1000,
    smooth: float = 4.0,
    sigma: float = 1.96,
    reject: float = 0.8,
) -> DataFrame:
    """page_id, host, path, rule, verdict, template, bad for every page (page_id, url)."""
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    ruled = longest_rule(F.col("host"), F.col("path"), rules)
    rows = parsed.withColumn("found", ruled)
    paths = rows.groupBy("host", "path").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("found.verdict") == "allow").alias("n_allow"),
        F.count_if(F.col("found.verdict") == "block").alias("n_block"),
    )
    shaped = written(templates(paths, depth, least_pages, least_share, many_pages), "url-templates")
    scored = shaped.select("host", "path", "template").join(grown(purity(shaped, depth, smooth, sigma)), ["host", "template"])
    return rows.join(grown(scored), ["host", "path"]).select(
        "page_id",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), F.when(F.col("bad") >= reject, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "template",
        F.round("bad", 9).alias("bad"),
    )


def op3_url_filters(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def _levels_sql(depth: int, least_pages: int, least_share: float, many_pages: int) -> str:
    """The tree's levels: l0 are the paths, l1 to l<depth> add t<level>."""
    out = []
    for d in range(1, depth + 1):
        was = f"t{d - 1}"
        out.append(
            f"""c{d} AS (SELECT host, {was}, seg[{d}] AS s, sum(n) AS c FROM l{d - 1} WHERE seg[{d}] IS NOT NULL GROUP BY ALL),
k{d} AS (SELECT host, {was}, s FROM c{d} JOIN (SELECT host, {was}, sum(c) AS p FROM c{d} GROUP BY ALL) USING (host, {was}) WHERE c >= {least_pages} AND (c >= p * {least_share}::DOUBLE OR c >= {many_pages})),
l{d} AS (SELECT l.*, CASE WHEN seg[{d}] IS NULL THEN l.{was} WHEN k.s IS NOT NULL THEN l.{was} || '/' || k.s ELSE l.{was} || '/*' END AS t{d} FROM l{d - 1} l LEFT JOIN k{d} k ON l.host = k.host AND l.{was} = k.{was} AND seg[{d}] = k.s)"""
        )
    return ",\n".join(out)


def _pools_sql(depth: int, smooth: float, sigma: float) -> str:
    """Estimates e0 of the hosts and e1 to e<depth> of the nodes, from their pools."""
    out = [f"e0 AS (SELECT host, t0, (sum(bad_n) + {smooth}::DOUBLE * any_value(base)) / (sum(all_n) + {smooth}::DOUBLE) AS est FROM leaf, base GROUP BY host, t0)"]
    for d in range(1, depth + 1):
        was, now = f"t{d - 1}", f"t{d}"
        out.append(
            f"""n{d} AS (SELECT host, {was}, {now}, sum(bad_n) AS b, sum(all_n) AS a FROM leaf GROUP BY ALL),
o{d} AS (SELECT *, b / a AS share, lag(b) OVER w AS pb, lag(a) OVER w AS pa FROM n{d} WHERE a > 0 WINDOW w AS (PARTITION BY host, {was} ORDER BY b / a, {now})),
s{d} AS (SELECT *, CASE WHEN share - pb / pa > {sigma}::DOUBLE * sqrt(((b + pb) / (a + pa)) * (1 - (b + pb) / (a + pa)) * (1 / a + 1 / pa)) THEN 1 ELSE 0 END AS apart FROM o{d}),
g{d} AS (SELECT *, sum(apart) OVER (PARTITION BY host, {was} ORDER BY share, {now} ROWS UNBOUNDED PRECEDING) AS pool FROM s{d}),
p{d} AS (SELECT host, {now}, sum(b) OVER q AS pool_b, sum(a) OVER q AS pool_a FROM g{d} WINDOW q AS (PARTITION BY host, {was}, pool)),
e{d} AS (SELECT n.host, n.{now}, CASE WHEN pool_a > 0 THEN (pool_b + {smooth}::DOUBLE * est) / (pool_a + {smooth}::DOUBLE) ELSE base END AS est
  FROM base, n{d} n JOIN e{d - 1} e ON n.host = e.host AND n.{was} = e.{was} LEFT JOIN p{d} p ON p.host = n.host AND p.{now} = n.{now})"""
        )
    return ",\n".join(out)


OP3_SQL = f"""
WITH rest AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
urls AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
ruled AS (SELECT *, CASE
  WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
  WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
  WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule FROM urls),
said AS (SELECT *, CASE WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS v FROM ruled),
l0 AS (SELECT host, path, list_filter(string_split(path, '/'), lambda s: s <> '') AS seg, '' AS t0, count(*) AS n, count(*) FILTER (v = 'allow') AS a, count(*) FILTER (v = 'block') AS b FROM said GROUP BY host, path),
{_levels_sql(3, 5, 0.02, 1000)},
shaped AS (SELECT *, CASE WHEN len(seg) > 3 THEN t3 || '/**' ELSE t3 END AS template FROM l3),
leaf AS (SELECT host, t0, t1, t2, t3, template, sum(b) AS bad_n, sum(a + b) AS all_n FROM shaped GROUP BY ALL),
base AS (SELECT least(coalesce(sum(bad_n) / nullif(sum(all_n), 0), 0), 0.5) AS base FROM leaf),
{_pools_sql(3, 4.0, 1.96)},
pure AS (SELECT leaf.host, template, (bad_n + 4.0::DOUBLE * est) / (all_n + 4.0::DOUBLE) AS bad FROM leaf JOIN e3 ON e3.host = leaf.host AND e3.t3 = leaf.t3)
SELECT page_id, said.host, said.path, rule, coalesce(v, CASE WHEN bad >= 0.8 THEN 'block' ELSE 'allow' END) AS verdict
FROM said JOIN shaped ON said.host = shaped.host AND said.path = shaped.path JOIN pure ON pure.host = shaped.host AND pure.template = shaped.template
"""
