"""Crawled sites as a streaming source: cursor and known URLs are its offsets.

A batch is one run of each site: robots file and sitemaps are read, new entries
selected, and the pages under the run's cap planned.  An offset holds what a
site remembers after its batch and the pages of the batch that ends there, so it
alone tells a restarted query what to read again.  Pages go from the tasks that
read them to the sink; Spark writes a batch off as done after its sink, and the
next plan starts from there.  A page, sitemap or robots file that cannot be read
fails the batch, and its pages come again as a whole.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Iterator, Sequence
from dataclasses import asdict
from datetime import UTC, datetime, timedelta
from email.utils import parsedate_to_datetime
from functools import partial
from urllib.parse import unquote, urljoin, urlsplit

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from siftworks.operators import crawl
from siftworks.sources import fetch, jobpages
from siftworks.sources.site import HEADERS, Site


def iso_utc(said: str) -> str:
    """A sitemap's date in the one ISO form, empty where unreadable; without an
    offset it is UTC."""
    said = said.strip()
    try:
        if re.fullmatch(r"-?\d{9,}", said):
            at = datetime.fromtimestamp(int(said) / (1000 if abs(int(said)) > 1e11 else 1), UTC)
        elif re.match(r"\d{4}-\d{2}-\d{2}|\d{8}$", said):
            at = datetime.fromisoformat(said)
        else:
            at = parsedate_to_datetime(said)
    except (ValueError, OverflowError, OSError):
        return ""
    return (at.replace(tzinfo=UTC) if at.tzinfo is None else at.astimezone(UTC)).strftime("%Y-%m-%dT%H:%M:%S+00:00")


def allowed(url: str, rules: crawl.Robots) -> bool:
    """May the URL be fetched?  As :func:`crawl.allowed`, for one URL."""
    parts = urlsplit(url)
    path = unquote((parts.path or "/") + (f"?{parts.query}" if parts.query else ""))
    longest = lambda patterns: max((len(p) for p in patterns if re.match(crawl.path_pattern(p).removeprefix("(?d)"), path)), default=-1)
    return longest(rules.allow) >= longest(rules.disallow)


def slug_matches(url: str, include: Sequence[str], exclude: Sequence[str]) -> bool:
    words = re.sub(r"[-_+]+", " ", url.rstrip("/").rpartition("/")[2]).strip().lower()
    within = lambda terms: any(t.lower() in words for t in terms)
    return not within(exclude) and (within(include) or not include)


def plan(entries: list[tuple[str, str]], old: dict, rules: crawl.Robots, site: Site, include: Sequence[str], exclude: Sequence[str], start: str) -> dict:
    """What a site remembers after a run over its sitemap entries (URL, date),
    and the run's pages.

    The selection of :func:`crawl.run`, for the planner of a stream, which has
    no session: dated entries after the cursor (at first, ``start``), undated
    ones that are not known; filtered, then capped by date and position; a cap
    that held some back holds the cursor too.
    """
    cursor, known = old["cursor"] or start, set(old["urls"])
    new = [(at, pos, loc) for pos, (loc, at) in enumerate(entries) if (at > cursor if at else loc not in known)]
    found = [x for x in new if allowed(x[2], rules) and re.search(site.pattern, x[2]) and slug_matches(x[2], include, exclude)]
    loaded = sorted(found)[: site.pages]
    reached = max((at for at, _, _ in (loaded if len(found) > site.pages else new)), default="")
    undated = {loc for loc, at in entries if not at}
    urls = sorted((known | {loc for _, _, loc in loaded}) & undated)[: crawl.KNOWN_LIMIT]
    return {"cursor": max(reached, cursor), "urls": urls, "pages": [loc for _, _, loc in loaded], "pause": rules.pause()}


class SiteStream(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.sites = [Site(**s) for s in json.loads(options["sites"])]
        self.include, self.exclude = (json.loads(options.get(k, "[]")) for k in ("include", "exclude"))
        self.via, self.now = options.get("via", ""), options.get("now")
        self.last: dict | None = None

    def initialOffset(self) -> dict:
        return {"run": 0, "sites": {}}

    def latestOffset(self) -> dict:
        """The offset after one more run, or the last one if it has no page and
        remembers nothing new."""
        if self.last is None:
            self.last = self.initialOffset()
        after = {s.name: self.after(s, self.last["sites"].get(s.name)) for s in self.sites}
        kept = lambda sites: {name: (s["cursor"], s["urls"]) for name, s in sites.items()}
        if any(s["pages"] for s in after.values()) or kept(after) != kept(self.last["sites"]):
            self.last = {"run": self.last["run"] + 1, "sites": after}
        return self.last

    def after(self, site: Site, old: dict | None) -> dict:
        old = old or {"cursor": "", "urls": []}
        same = {"cursor": old["cursor"], "urls": old["urls"], "pages": [], "pause": crawl.DELAY}
        robots = self.get(site, urljoin(site.home, "/robots.txt"))
        rules = crawl.Robots() if robots is None else crawl.read_robots(robots.decode("utf-8", "replace"), fetch.AGENT)
        roots = [site.sitemap] if site.sitemap else list(rules.sitemaps[:1])
        if rules.shut() or not roots:
            return same
        listed: list[tuple[str, str]] = []

        def read(url: str) -> tuple[list, list[str]]:
            raw = self.get(site, url)
            try:
                urls, children = ([], []) if raw is None else jobpages.sitemap(raw)
            except ValueError as e:
                raise fetch.FetchError(f"{site.name}: {url}: {e}") from e
            listed.extend((loc, iso_utc(at)) for loc, at in urls)
            return urls, children

        jobpages.walk_sitemaps(read, roots, site.sitemaps)
        now = datetime.fromisoformat(self.now).astimezone(UTC) if self.now else datetime.now(UTC)
        start = (now - timedelta(days=crawl.BOOTSTRAP_DAYS)).strftime("%Y-%m-%dT%H:%M:%S+00:00")
        return plan(listed, old, rules, site, self.include, self.exclude, start)

    def get(self, site: Site, url: str) -> bytes | None:
        return fetch.fetch(site.name, fetch.mirrored(url, self.via), partial(fetch.call_url, headers=HEADERS))

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """A task for each site: its server is asked by one, with its pause.  A
        restarted query tells here, from its own log, where it stands."""
        if self.last is None:
            self.last = end
        if start["run"] == end["run"]:
            return []
        return [fetch.Requests([fetch.Request(end["run"], name, url=u) for u in s["pages"]], s["pause"]) for name, s in end["sites"].items() if s["pages"]]

    def read(self, partition: fetch.Requests) -> Iterator[tuple]:
        for i, p in enumerate(partition.requests):
            if i and partition.delay:
                time.sleep(partition.delay)
            body = fetch.fetch(p.source, fetch.mirrored(p.url, self.via), partial(fetch.call_url, headers=HEADERS))
            yield p.source_ord, p.source, p.url, None if body is None else body.decode("utf-8", "replace")

    def commit(self, end: dict) -> None:
        """Nothing: the query's own log has the offset by now."""

    def stop(self) -> None:
        """Nothing is open between two batches."""


class SiteSource(DataSource):
    """``spark.readStream.format("sites").option("sites", json)``: rows of pages;
    ``html`` is null where a page is gone (404).

    Options: ``sites``, a JSON list of the fields of :class:`Site`; ``include``
    and ``exclude``, JSON lists of slug terms; ``via``, a mirror; ``now``, the
    clock of a first run.
    """

    @classmethod
    def name(cls) -> str:
        return "sites"

    def schema(self) -> str:
        return "run int, source string, url string, html string"

    def streamReader(self, schema) -> SiteStream:
        return SiteStream(self.options)


def site_pages(spark, sites: Sequence[Site], **options: str):
    """The pages of sites as a stream."""
    from siftworks.session import ship_package

    ship_package(spark)
    spark.dataSource.register(SiteSource)
    return spark.readStream.format("sites").option("sites", json.dumps([asdict(s) for s in sites])).options(**options).load()
