import numpy as np
import pandas as pd
from llm_data import DATA
from pyspark.sql import functions as F

from fleetmill.llm import op6_urls as u

SCHEMA = "page_id long, url string, html string"


def by_hand(url):
    at = (url or "").find("://")
    if at < 0:
        return "", "", None, None
    rest = url[at + 3 :]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h + p), h + p, v) for v, h, p in u.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


URLS = [None, "", "nothing", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "https://example.com/en/", "https://a.example.com/en", "x://b.net/es/1", "x://net/fr/", "x://notnet/fr/", "x://b.net?/fr/", "a://b://c/d", "https://com", "https://com/", "//x.com/y", "https://ex.org/#/q?"]


def test_rules_equal_plain_loops(spark):
    pages = spark.createDataFrame([(i, url, None) for i, url in enumerate(URLS)] + [(None, "x://y.com/", ""), (3, URLS[3], None)], SCHEMA)
    got = u.judge_urls(pages).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        if r["page_id"] is not None:
            host, path, rule, verdict = by_hand(URLS[r["page_id"]])
            assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
            assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")


def test_every_page_of_the_table(spark):
    from fleetmill.llm.common import read

    urls = {r["page_id"]: r["url"] for r in read(spark, DATA, "pages").collect()}
    for r in u.query(spark, DATA).collect():
        host, path, rule, verdict = by_hand(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and (verdict is None or r["verdict"] == verdict)
    assert u.judge_urls(spark.createDataFrame([], SCHEMA)).count() == 0


def test_propagation_solves_the_linear_system(spark):
    edges = [("a", "b", 2), ("a", "c", 1), ("b", "c", 1), ("c", "a", 1), ("d", "c", 3)]
    got = {r["host"]: r["score"] for r in u.propagate(spark.createDataFrame(edges, "src string, dst string, weight long"), spark.createDataFrame([("a", 1.0), ("d", 0.5)], "host string, seed double"), 0.5, 1e-7).collect()}
    names = "abcd"
    m = np.zeros((4, 4))
    for s, t, w in edges:
        m[names.index(t), names.index(s)] = w / sum(x[2] for x in edges if x[0] == s)
    want = np.linalg.solve(np.eye(4) - 0.5 * m, [1, 0, 0, 0.5])
    assert all(abs(got[n] - want[i]) < 1e-6 for i, n in enumerate(names))


def test_distrust_reaches_those_who_link_to_blocked_hosts(spark):
    link = '<a href="https://{}/x">'
    pages = [(1, "https://bad.net/fr/1", ""), (2, "https://spam.org/1", link.format("bad.net") + link.format("BAD.net")), (3, "https://fine.org/1", link.format("good.com")), (4, "https://good.com/1", link.format("fine.org")), (5, "https://alone.org/", None)]
    got = {r["page_id"]: (r["verdict"], r["trust"], r["distrust"]) for r in u.judge_urls(spark.createDataFrame(pages, SCHEMA)).collect()}
    assert [got[i][0] for i in range(1, 6)] == ["block", "block", "allow", "allow", "allow"]
    assert got[3][1] > 0 and got[2][2] >= 0.5 and got[5][1:] == (0.0, 0.0)


def test_distrust_does_not_shrink_with_the_number_of_linkers(spark):
    link = '<a href="https://{}/x">'
    pages = [(0, "https://bad.net/fr/1", link.format("far.org")), (1, "https://mixed.org/1", link.format("bad.net") + link.format("far.org") * 3), (2, "https://beyond.org/1", link.format("spam7.org"))]
    for n in (1, 2, 100):
        rows = pages + [(10 + i, f"https://spam{i + 7}.org/1", link.format("bad.net")) for i in range(n)]
        got = {r["page_id"]: r for r in u.judge_urls(spark.createDataFrame(rows, SCHEMA)).collect()}
        assert all(got[10 + i]["verdict"] == "block" and abs(got[10 + i]["distrust"] - 0.6) < 1e-3 for i in range(n))
        assert got[1]["verdict"] == got[2]["verdict"] == "allow"


def test_links_of_all_kinds(spark):
    html = """<base href="HTTP://Base.org/a/"><a href=/own><a href='//Bare.com:80/x'><img srcset="https://one.net/a 1x, //two.net/b 2x"><form action="//form.org">
    see https://plain.example.com/x, (ftp://files.org) and "//no.link" <a href="page.html"> x=a//b http:///empty <a href="https:\\\\odd.org">"""
    got = spark.createDataFrame([(1, html), (2, None), (3, "")], "i long, html string").select("i", u.link_hosts(F.col("html")).alias("h")).collect()
    assert sorted(got[0]["h"]) == ["bare.com:80", "base.org", "files.org", "form.org", "one.net", "plain.example.com", "two.net"]
    assert not got[1]["h"] and not got[2]["h"]


def test_a_large_graph_with_hubs(spark):
    """100,000 hosts, of which ten are linked by a fifth of all and one links to a tenth, against a
    plain power iteration."""
    rng = np.random.default_rng(0)
    n = 100_000
    src, dst = rng.integers(0, n, 300_000), rng.integers(0, n, 300_000)
    dst[:60_000] = rng.integers(0, 10, 60_000)
    src[60_000:70_000] = 11
    keep = src != dst
    pairs, weight = np.unique(np.stack([src[keep], dst[keep]], axis=1), axis=0, return_counts=True)
    edges = spark.createDataFrame(pd.DataFrame({"s": pairs[:, 0], "d": pairs[:, 1], "weight": weight})).selectExpr("concat('h', s) AS src", "concat('h', d) AS dst", "weight")
    seeds = spark.createDataFrame([(f"h{i}", 1.0) for i in range(0, n, 500)], "host string, seed double")
    for by, damping in (("src", 0.6), ("dst", 0.5)):
        got = {r["host"]: r["score"] for r in u.propagate(edges, seeds, damping, 1e-6, by=by).collect()}
        total = np.bincount(pairs[:, 0 if by == "src" else 1], weights=weight, minlength=n)
        part = weight / total[pairs[:, 0 if by == "src" else 1]]
        seed = (np.arange(n) % 500 == 0).astype(float)
        score = seed
        for _ in range(60):
            score = seed + damping * np.bincount(pairs[:, 1], weights=part * score[pairs[:, 0]], minlength=n)
        assert max(abs(got.get(f"h{i}", 0.0) - score[i]) for i in range(n)) < 1e-5


def test_long_pages_and_clashing_columns(spark):
    link = '<a href="https://bad.net/x">'
    pages = [(1, "https://bad.net/fr/1", ""), (2, "https://spam.org/1", "x " * 200_000 + link), (3, "https://spam.org/2", "")]
    df = spark.createDataFrame([(*p, "a", "b", "c", 1.0) for p in pages], SCHEMA + ", host string, path string, fit string, trust double")
    assert {r["page_id"]: r["verdict"] for r in u.judge_urls(df).collect()} == {1: "block", 2: "block", 3: "block"}


def test_of_equally_long_rules_the_last_counts(spark):
    pages = spark.createDataFrame([(1, "x://a.b/cd", "")], SCHEMA)
    for first, last in (("allow", "block"), ("block", "allow")):
        for rules in (((first, "a.b", "/"), (last, "b", "/cd")), ((first, "b", "/cd"), (last, "a.b", "/"))):
            fit = pages.select(u.fitting_rule(*u.host_and_path(F.col("url")), rules).alias("fit")).first()["fit"]
            assert (fit["rule"], fit["verdict"]) == (rules[1][1] + rules[1][2], last)
