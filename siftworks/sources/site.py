"""Crawled sites: robots, sitemaps, selection, pages, and what is remembered.

One run of a site asks for its robots file and sitemaps on the driver (few, and
one after the other), selects URLs with Spark, and reads the chosen pages, at
most a run's cap, through the payload source, whose one task a host waits
between pages.  The state comes back only if all of it could be read.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial
from urllib.parse import urljoin

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.functions import dates as D
from siftworks.operators import crawl
from siftworks.sources import fetch, jobpages, state

#: Headers of a crawl: no browser's, no referer.
HEADERS = {"User-Agent": fetch.AGENT, "Accept": "text/html, application/xml, text/plain, */*"}


@dataclass(frozen=True)
class Site:
    """``sitemap`` empty: the first one that the robots file names."""

    name: str
    home: str
    sitemap: str = ""
    pattern: str = r"/jobs?/[^/]+/[^/]+$"
    pages: int = 30
    sitemaps: int = 25


# The sites.
SITES = {"japandev": Site("japandev", "https://japan-dev.com/", "https://japan-dev.com/sitemap.xml", r"/jobs/[^/]+/[^/]+$")}


def crawl_site(
    spark: SparkSession,
    site: Site,
    remembered: dict[str, dict],
    *,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    via: str = "",
    call=fetch.call_url,
    sleep: Callable[[float], None] = time.sleep,
) -> tuple[DataFrame | None, dict[str, dict]]:
    """(postings, new state) of one run; the state has cursor and URLs by source.

    No postings frame (None) where the site forbids everything or names no
    sitemap.  An unreadable robots file, sitemap or page is a FetchError, and
    the old state holds: the next run starts where this one did.
    """

    def get(url: str) -> bytes | None:
        return fetch.fetch(site.name, fetch.mirrored(url, via), partial(call, headers=HEADERS), sleep)

    robots = get(urljoin(site.home, "/robots.txt"))
    rules = crawl.Robots() if robots is None else crawl.read_robots(robots.decode("utf-8", "replace"), fetch.AGENT)
    roots = [site.sitemap] if site.sitemap else list(rules.sitemaps[:1])
    if rules.shut() or not roots:
        return None, remembered
    listed: list[tuple[str, str]] = []

    def read(url: str) -> tuple[list, list[str]]:
        raw = get(url)
        try:
            urls, children = ([], []) if raw is None else jobpages.sitemap(raw)
        except ValueError as e:
            raise fetch.FetchError(f"{site.name}: {url}: {e}") from e
        listed.extend(urls)
        return urls, children

    jobpages.walk_sitemaps(read, roots, site.sitemaps)
    old = remembered.get(site.name, {"cursor": "", "urls": []})
    rows = spark.createDataFrame([(i, *u) for i, u in enumerate(listed)], "pos long, loc string, lastmod string")
    entries = rows.withColumn("lastmod", D.to_iso_utc(F.col("lastmod")))
    known = spark.createDataFrame([(u,) for u in old["urls"]], "loc string")
    cursor = crawl.start_cursor(old["cursor"], F.current_timestamp())
    got = crawl.run(entries, known, cursor, rules, site.pattern, include, exclude, site.pages)
    wanted = [r["loc"] for r in got["loaded"].collect()]  # a run's cap at most
    at = got["cursor"].first()["cursor"]
    urls = [r["loc"] for r in got["known"].collect()]  # KNOWN_LIMIT at most
    spark.dataSource.register(fetch.PayloadSource)
    requests = [{"source_ord": i, "source": site.name, "url": u} for i, u in enumerate(wanted)]
    pages = spark.read.format("payloads").options(requests=json.dumps(requests), delay=rules.pause(), via=via).load()
    read_once = pages.select("source_ord", "url", "payload", "problem").collect()
    for r in read_once:
        if r["problem"]:
            raise fetch.FetchError(r["problem"])
    html = spark.createDataFrame([(r["url"], r["payload"]) for r in sorted(read_once, key=lambda r: r["source_ord"])], "url string, html string")
    return jobpages.parse_pages(html, site.name), state.record_crawl(remembered, site.name, at or "", urls)
