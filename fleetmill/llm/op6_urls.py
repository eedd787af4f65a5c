r"""URL filters: rules for hosts and paths and, where none fits, propagation over the link graph.

Hosts are joined by the links in their pages: absolute urls and those without a scheme in ``href``,
``src``, ``srcset``, ``action`` and the like, a ``base``, and urls written out in the text. Relative
links stay on the page's host, so they join nothing. Trust starts at hosts whose pages the rules
allow, by the share of such pages, and flows along links (personalised PageRank with damping);
distrust starts at hosts whose pages the rules block and flows against them, to those who link
there: a host gets the damped mean distrust of what it links to, weighted by its own links, so it
does not matter how many others link there too. Both are iterated until no host's score moves by
CLOSE; each round's largest move is kept below the last by the damping, so they end. A page without
a rule is blocked if its host's distrust reaches BLOCK_FROM and exceeds the trust; the measure is the
same whatever the number of hosts.

The host stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; the path
follows up to ``?``, ``#`` or the end. Null urls, and those without ``://``, have an empty host and
path, fit no rule and are allowed. Of rules equally long, the one listed last counts. Null pages have
no links, very long ones are read whole. A null page_id passes through, repeated rows give repeated
rows, and a page set without links keeps the seeds' own scores. An empty table gives no rows; extra
columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmill.llm.common import Tables, hubs, join_hubs, join_small, materialize, read, rows_of

#: (verdict, host, path): fits the host and its subdomains if the path starts so; the longest wins.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
DAMPING, CLOSE, BLOCK_FROM = 0.85, 1e-4, 0.5
#: Distrust fades faster: it reaches those who link to blocked hosts, hardly those beyond.
DISTRUST_DAMPING = 0.6
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as a struct (rule, verdict), or null. Rules are a short list, tried
    in the order of their lengths."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


#: A url with a scheme, anywhere; and one without, in an attribute or further on in a list of them.
ABSOLUTE = r"""(?i)(?<![a-z0-9+.-])[a-z][a-z0-9+.-]*://([^/?#"'\s<>()\\,]+)"""
SCHEMELESS = r"""(?i)(?:\b(?:href|src|srcset|action|formaction|poster|data|cite|background)\s*=\s*["']?\s*|[0-9][wx]\s*,\s*)//([^/?#"'\s<>()\\,]+)"""


def link_hosts(html: Column) -> Column:
    """Hosts of the links in a page."""
    found = F.concat(*[F.regexp_extract_all(html, F.lit(pattern), 1) for pattern in (ABSOLUTE, SCHEMELESS)])
    return F.when(F.contains(html, F.lit("//")), F.transform(found, lambda h: F.translate(h, UPPER, LOWER)))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, close: float = CLOSE, by: str = "src") -> DataFrame:
    """``edges(src, dst, weight)``, ``seeds(host, seed)`` -> ``(host, score)`` with score = seed +
    damping * the scores of those that link here, each split over its links by weight: personalised
    PageRank but for the factor 1 - damping. With ``by="dst"`` nothing is split: the scores of those
    that link here are averaged by weight. Rounds go on until no score moves by ``close``; each
    round's scores are a written table, a hub's links are not gathered, and contributions are summed
    before they are shuffled."""
    out = edges.groupBy(by).agg(F.sum("weight").alias("total"))
    shares, drop_shares = materialize(join_hubs(edges, out, by, hubs(edges, by)).select("src", "dst", (F.col("weight") / F.col("total")).alias("part")))
    seeds = seeds.where("seed > 0")
    scores, drop = materialize(seeds.select("host", F.col("seed").alias("score")))
    found = hubs(shares, "src")
    change = close if rows_of(shares) else 0.0
    while change >= close:
        flow = join_hubs(shares, scores.withColumnRenamed("host", "src"), "src", found).groupBy(F.col("dst").alias("host")).agg((damping * F.sum(F.col("part") * F.col("score"))).alias("flow"))
        new = seeds.join(flow, "host", "full_outer").select("host", (F.coalesce("seed", F.lit(0.0)) + F.coalesce("flow", F.lit(0.0))).alias("score"))
        # whoever has a score keeps one, so none of the old scores is missed by the left join
        moved = new.join(scores.withColumnRenamed("score", "old"), "host", "left").withColumn("move", F.abs(F.col("score") - F.coalesce("old", F.lit(0.0))))
        new, drop_new = materialize(moved.select("host", "score", "move"), F.col("move") >= close)
        change = close if new.counted_rows else 0.0
        drop()
        scores, drop = new.select("host", "score"), drop_new
    drop_shares()
    return scores


def judge_urls(pages: DataFrame, rules=RULES, damping: float = DAMPING, distrust_damping: float = DISTRUST_DAMPING, block_from: float = BLOCK_FROM) -> DataFrame:
    """``pages(page_id, url, html)`` -> ``(page_id, host, path, rule, verdict, trust, distrust)``."""
    tables = Tables()
    host, path = host_and_path(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path"), "html")
    judged = judged.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    links = judged.select("host", F.explode(link_hosts(F.col("html"))).alias("dst")).where("host <> '' and dst <> host")
    edges = tables.put(links.groupBy(F.col("host").alias("src"), "dst").agg(F.count(F.lit(1)).alias("weight")))
    share = lambda verdict: F.avg(F.when(F.col("fit.verdict") == verdict, 1.0).otherwise(0.0))
    seeds = tables.put(judged.where("host <> ''").groupBy("host").agg(share("allow").alias("allow"), share("block").alias("block")))
    trust = propagate(edges, seeds.select("host", F.col("allow").alias("seed")), damping)
    distrust = propagate(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"), seeds.select("host", F.col("block").alias("seed")), distrust_damping, by="dst")
    scores = tables.finish(trust.withColumnRenamed("score", "trust").join(distrust.withColumnRenamed("score", "distrust"), "host", "full_outer"))
    out = join_small(judged.drop("html"), scores, "host", "left")
    t, d = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    own = F.when((d >= block_from) & (d > t), "block").otherwise("allow")
    return out.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", own).alias("verdict"), t.alias("trust"), d.alias("distrust"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")
