from __future__ import annotations

import random

import duckdb
from pyspark.sql import functions as F

from sensorspan.llm import urls
from sensorspan.llm.common import table
from sensorspan.llm.queries import ORACLES

from .conftest import SF

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:end], rest[end:]
    end = min((rest.index(c) for c in "?#" if c in rest), default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:end]


def fitting(url):
    host, path = parts(url)
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def brute(rows, edges):
    """Verdicts by walking over the edges from each page."""
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    out = []
    for page_id, url in rows:
        name, verdict = fitting(url)
        if verdict is None:
            start = url.split("#")[0] if url else ""
            seen, queue = {start}, [start]
            while queue:
                for other in near.get(queue.pop(), ()):
                    if other not in seen:
                        seen.add(other)
                        queue.append(other)
            said = {fitting(u)[1] for u in seen}
            verdict = "allow" if "allow" in said or "block" not in said else "block"
        out.append((page_id, *parts(url), name, verdict))
    return sorted(out, key=str)


def judged(frame, **more):
    return sorted((tuple(r) for r in urls.filter_urls(frame, **more).collect()), key=str)


def test_rules_and_parts_of_odd_urls(spark):
    rows = [
        (1, "http://a.net/x"), (2, "https://www.Example.NET/en/1?x#y"), (3, "ftp://example.com/de/"), (4, "http://example.com/dex"),
        (5, "http://a.b.org/fr/z"), (6, "http://org/fr"), (7, "http://xnet/"), (8, "http://a.net"), (9, None), (10, ""), (11, "no scheme"),
        (12, "://net/x"), (13, "http://a.net?x=://b.org/fr/"), (14, "http:///fr/"), (15, "http://ÉXAMPLE.org/fr/é"), (16, "a://b://c.net/"),
        (17, "http://x.net/" + "p/" * 50_000), (None, "http://a.net/"), (1, "http://a.net/x"), (18, "http://a.net:80/x"), (19, "http://net/\nx"),
    ]
    frame = spark.createDataFrame([(i, u, None) for i, u in rows], "page_id long, url string, html string")
    for extra in ("host", "path", "rule", "verdict", "node", "root", "a", "b"):
        frame = frame.withColumn(extra, frame["url"])
    assert judged(frame) == brute(rows, [])
    assert judged(frame.limit(0)) == []


def aliased():
    def page(i, url, link=None, form="canonical"):
        tag = "" if link is None else f"<link rel='canonical' href=\"{link}\">" if form == "canonical" else f'<META http-equiv="Refresh" content="0; url={link}">'
        return (i, url, f"<html><head>{tag}</head>body</html>")

    rows = [
        page(1, "http://a.com/x", "http://bad.net/"), page(2, "http://b.com/y", "http://a.com/x", "refresh"), page(3, "http://c.com/z"),
        page(4, "http://d.com/1", "http://c.com/z"), page(5, "http://example.net/en/", "http://bad2.net/q"), page(6, "http://e.com/", "http://example.net/en/"),
        page(7, "http://bad3.net/k"), page(8, "http://f.com/k/l", "//bad3.net/k"), page(9, "http://f.com/k/m", "l"), page(10, "http://F.com/k/n", "/k/m#part"),
        (11, "http://g.com/", "<!-- <link rel=canonical href=http://bad.net/> -->"), (12, "http://h.com/", '<link href="http://bad.net/" rel="stylesheet">'),
        page(13, "http://i.com/", "mailto:x@bad.net"), page(14, None, "http://bad.net/"), page(15, "http://j.com/", ""),
    ]
    return rows


def test_blocks_reach_aliases(spark):
    got = {r[0]: r[4] for r in judged(spark.createDataFrame(aliased(), "page_id long, url string, html string"))}
    blocked = {1, 2, 7, 8, 9, 10}
    assert got == {i: "block" if i in blocked else "allow" for i in range(1, 16)}


def test_random_graphs_equal_a_walk(spark):
    draw = random.Random(5)
    pool = [f"http://h{i}.{draw.choice(['com', 'net', 'org', 'example.net'])}/{draw.choice(['en', 'fr', 'de'])}/{i}" for i in range(120)]
    edges = [(draw.choice(pool), draw.choice(pool)) for _ in range(70)]
    rows = list(enumerate(pool))
    frame = spark.createDataFrame([(i, u, "") for i, u in rows], "page_id long, url string, html string")
    log = spark.createDataFrame(edges, "a string, b string")
    assert judged(frame, edges=log) == brute(rows, edges)


def test_a_hot_component(spark):
    rows = [(i, f"http://s{i}.com/", '<link rel=canonical href="http://centre.net/">') for i in range(3000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert urls.filter_urls(frame).groupBy("verdict").agg(F.count("*")).collect() == [("block", 3000)]


def test_the_given_pages(spark):
    pages = table(spark, SF, "pages")
    rows = [(r["page_id"], r["url"]) for r in pages.collect()]
    assert judged(pages) == brute(rows, [])


def test_the_sql_gives_the_same_rows(spark):
    rows = aliased() + [(50, None, None), (51, "x", ""), (52, "http://A.net?q", None), (53, "http://k.com/?a", '<link rel=canonical href="?b#c">')]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert judged(frame) == sorted(con.execute(ORACLES["op6_url_filters"]).fetchall(), key=str)
