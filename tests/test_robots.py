"""Robots rules of many hosts against a scan of all rules for each URL."""

from __future__ import annotations

import random
import re
from urllib.parse import unquote

from pyspark.sql import functions as F

from siftworks.operators import robots

FILES = {
    "a.example": "User-agent: *\nDisallow: /\nAllow: /open\nAllow: /*.html$\nDisallow: /open/*/shut\n",
    "b.example:8080": "User-agent: SiftBot\nDisallow: /x%20y\nAllow: /x%20y/ok\nDisallow: /*?q=\nAllow: /same\nDisallow: /same\n",
    "c.example": "User-agent: other\nDisallow: /\n",
    "d.example": None,
    "e.example": "User-agent: sift\nDisallow: *\nAllow: /a$\nDisallow:\n",
}
PATHS = ["", "/", "/open", "/open/1/shut", "/open/x.html", "/x y/ok", "/x%20y", "/x%20y/no", "/p?q=1", "/p?r=1", "/same", "/a", "/ab", "/a.html?x", "/é", "/%C3%A9.html"]


def judged_by_scan(host, path):
    from siftworks.operators.crawl import read_robots

    said = read_robots(FILES.get(host) or "", "SiftBot/2")
    best = (-1, True)
    shown = unquote((path or "/").split("#")[0])
    for allow, patterns in ((True, said.allow), (False, said.disallow)):
        for p in patterns:
            body = ".*".join(re.escape(unquote(x)) for x in p.removesuffix("$").split("*"))
            if re.match(body + ("$" if p.endswith("$") else ""), shown):
                best = max(best, (len(p), allow))
    return best[1]


def test_many_hosts_equal_a_scan(spark):
    rng = random.Random(6)
    hosts = [*FILES, "unknown.example", "A.Example"]
    rows = [(i, host := "a.example" if i % 3 == 0 else rng.choice(hosts), path := rng.choice(PATHS), f"https://{host}{path}#top", "clash") for i in range(600)]
    urls = spark.createDataFrame([(r[0], r[3], r[4], "h") for r in rows], "id int, url string, allowed string, host string").repartition(3)
    urls = urls.unionByName(spark.createDataFrame([(-1, None, None, None), (-2, "no url", None, None)], urls.schema))
    files = spark.createDataFrame(list(FILES.items()), "host string, content string")
    out = robots.allowed_by_host(urls, robots.rules_of_hosts(files, "SiftBot/2"))
    got = {r["id"]: r["allowed"] for r in out.collect()}
    assert len(got) == 602 and got[-1] and got[-2] and out.columns == ["id", "url", "host", "allowed"]
    for i, host, path, *_ in rows:
        assert got[i] == judged_by_scan(host.lower(), path), (host, path)
    assert {False, True} == set(got.values())
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan and ".html" not in plan
    physical = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in physical and "Cartesian" not in physical


def test_no_rules(spark):
    rules = robots.rules_of_hosts(spark.createDataFrame([], "host string, content string"), "x")
    urls = spark.createDataFrame([("https://a/b",)], "url string")
    assert robots.allowed_by_host(urls, rules).collect() == [("https://a/b", True)]
    assert robots.allowed_by_host(urls.limit(0), rules).collect() == []
    assert urls.select(robots.host_of(F.lit("//user:x@Host.Example:81/p"))).first()[0] == "host.example:81"
