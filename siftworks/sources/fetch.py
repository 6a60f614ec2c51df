"""Fetching payloads: one policy, the feeds' endpoints, and a Spark data source
that applies both."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field
from functools import partial
from urllib.parse import urlsplit

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Fixed values of the policy.
TIMEOUT, RETRY_AFTER = 15.0, 2.0
SLOW_TIMEOUTS = {"remoteok": 60.0}
RETRIED = frozenset({500, 502, 503, 504})


class FetchError(Exception):
    """A source that could not be read; names the source."""


def fetch(source: str, url: str, call: Callable[[str, float], tuple[int, bytes]], sleep: Callable[[float], None] = time.sleep) -> bytes | None:
    """The body at ``url``, or None for 404.

    ``call(url, timeout)`` returns (status, body) and raises OSError for network
    trouble.  Trouble and the statuses in ``RETRIED`` are tried once more;
    429 is not, nor any other status from 400, which are errors.
    """
    timeout = SLOW_TIMEOUTS.get(source, TIMEOUT)
    for last in (False, True):
        try:
            status, body = call(url, timeout)
        except OSError as e:
            if last:
                raise FetchError(f"{source}: {e}") from e
        else:
            if status == 404:
                return None
            if status < 400:
                return body
            if last or status not in RETRIED:
                raise FetchError(f"{source}: status {status}")
        sleep(RETRY_AFTER)
    raise AssertionError("unreachable")


def paged(read: Callable[[int], tuple[list, int | None] | None], full: int | None, cap: int) -> Iterator[list]:
    """Pages 0, 1, ... of a paged feed: ``read(page)`` gives (entries, total).

    Ends at a missing or empty page, at one shorter than ``full``, once
    ``total`` entries were read, or after ``cap`` pages.
    """
    seen = 0
    for page in range(cap):
        got = read(page)
        if got is None or not got[0]:
            return
        entries, total = got
        yield entries
        seen += len(entries)
        if full is not None and len(entries) < full or total is not None and seen >= total:
            return


def call_url(url: str, timeout: float, method: str = "GET", body: object = None, headers: Mapping[str, str] | None = None) -> tuple[int, bytes]:
    """One request with the standard library; ``body`` goes as JSON."""
    from urllib import error, request

    data = None if body is None else json.dumps(body).encode()
    sent = {"User-Agent": AGENT} | ({} if data is None else {"Content-Type": "application/json"}) | dict(headers or {})
    try:
        with request.urlopen(request.Request(url, data, sent, method=method), timeout=timeout) as r:
            return getattr(r, "status", None) or 200, r.read()
    except error.HTTPError as e:
        return e.code, b""


# What feeds expect of a caller.
AGENT = "siftworks/0.1"
PLAIN = {"User-Agent": AGENT, "Accept": "application/json"}
BROWSER = {
    "User-Agent": "Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/124.0.0.0 Safari/537.36",
    "Accept-Language": "en-US,en;q=0.9",
    "Accept": "application/json, text/xml, text/plain, */*",
}


@dataclass(frozen=True)
class Endpoint:
    """Where and how a feed is read.

    ``url`` may name {token}, {page} (from ``first`` on), {offset} (pages times
    ``full``) and {found}, which the payload at ``lead`` tells.  A feed of
    several pages ends as :func:`paged` says; ``entries`` and ``total`` are the
    keys of a page's list and of the number of all entries.  ``site``: an
    aggregator, which wants a browser's headers and a referer.
    """

    url: str
    token: str = ""
    method: str = "GET"
    body: Callable[[str, int], object] | None = None
    site: str = ""
    pages: int = 1
    first: int = 0
    full: int | None = None
    entries: str = ""
    total: str = ""
    lead: str = ""
    found: Callable[[object], str | None] | None = None

    def headers(self) -> dict[str, str]:
        return BROWSER | {"Referer": self.site} if self.site else dict(PLAIN)


def hiring_story(stories: object) -> str | None:
    """Id of the first story, in feed order, that asks who is hiring."""
    hits = stories.get("hits") if isinstance(stories, dict) else None
    for hit in hits or []:
        title = hit.get("title") if isinstance(hit, dict) else None
        if isinstance(title, str) and title.strip().lower().startswith("ask hn: who is hiring?") and re.fullmatch(r"\s*\d+\s*", str(hit.get("objectID"))):
            return str(hit["objectID"]).strip()
    return None


def search_body(words: str, offset: int) -> dict:
    """Fixed value: a search without filters, as its server takes it."""
    lists = ("lieux", "fonctions", "statutPoste", "typesContrat", "typesConvention", "niveauxExperience", "secteursActivite", "typesTeletravail")
    return {k: [] for k in lists} | {"sorts": [{"type": "SCORE", "direction": "DESCENDING"}], "pagination": {"range": 20, "startIndex": offset}, "activeFiltre": True, "motsCles": words}


# Addresses of the feeds.
ENDPOINTS: dict[str, Endpoint] = {
    "greenhouse": Endpoint("https://boards-api.greenhouse.io/v1/boards/{token}/jobs?content=true"),
    "lever": Endpoint("https://api.lever.co/v0/postings/{token}?mode=json"),
    "ashby": Endpoint("https://api.ashbyhq.com/posting-api/job-board/{token}"),
    "smartrecruiters": Endpoint("https://api.smartrecruiters.com/v1/companies/{token}/postings?limit=100&offset={offset}", pages=10, full=100, entries="content"),
    "workable": Endpoint("https://apply.workable.com/api/v3/accounts/{token}/jobs", method="POST", body=lambda token, offset: {}),
    "remoteok": Endpoint("https://remoteok.com/api", site="https://remoteok.com/"),
    "remotive": Endpoint("https://remotive.com/api/remote-jobs?search={token}", token="engineer", site="https://remotive.com/"),
    "weworkremotely": Endpoint("https://weworkremotely.com/categories/{token}.rss", token="remote-programming-jobs", site="https://weworkremotely.com/"),
    "hackernews": Endpoint("https://hn.algolia.com/api/v1/items/{found}", site="https://news.ycombinator.com/", lead="https://hn.algolia.com/api/v1/search_by_date?tags=story,author_whoishiring&hitsPerPage=6", found=hiring_story),
    "himalayas": Endpoint("https://himalayas.app/jobs/api?limit={token}", token="100", site="https://himalayas.app/"),
    "workingnomads": Endpoint("https://www.workingnomads.com/api/exposed_jobs/", site="https://www.workingnomads.com/"),
    "nodesk": Endpoint("https://nodesk.co/remote-jobs/index.xml", site="https://nodesk.co/"),
    "jobspresso": Endpoint("https://jobspresso.co/?feed=job_feed", site="https://jobspresso.co/"),
    "euremotejobs": Endpoint("https://euremotejobs.com/?feed=job_feed", site="https://euremotejobs.com/"),
    "landingjobs": Endpoint("https://landing.jobs/api/v1/jobs", site="https://landing.jobs/"),
    "freework": Endpoint("https://www.free-work.com/api/job_postings?contracts={token}&page={page}", token="permanent", site="https://www.free-work.com/", pages=5, first=1, entries="hydra:member", total="hydra:totalItems"),
    "apec": Endpoint("https://www.apec.fr/cms/webservices/rechercheOffre", token="developpeur", method="POST", body=search_body, site="https://www.apec.fr/candidat/recherche-emploi.html", pages=5, full=20, entries="resultats", total="totalCount"),
}


def mirrored(url: str, via: str) -> str:
    """The address of ``url`` at a mirror, which has hosts as its top folders."""
    return f"{via.rstrip('/')}/{url.partition('://')[2]}" if via else url


def read_feed(source: str, token: str, via: str = "", call=call_url, sleep: Callable[[float], None] = time.sleep) -> list[tuple[int, bytes]]:
    """(page, payload) of all pages of a feed; none where it is not found.

    A page that fails fails the feed.  A page that is no JSON, or of another
    shape, ends it: the parser says what is wrong with it.
    """
    end = ENDPOINTS[source]
    token = token or end.token

    def get(url: str, offset: int = 0) -> bytes | None:
        body = None if end.body is None else end.body(token, offset)
        return fetch(source, mirrored(url, via), partial(call, method=end.method, body=body, headers=end.headers()), sleep)

    def decoded(raw: bytes) -> object:
        try:
            return json.loads(raw)
        except ValueError:
            return None

    found: str | None = ""
    if end.lead:
        stories = get(end.lead)
        found = None if stories is None else end.found(decoded(stories))
        if found is None:
            return []
    out: list[tuple[int, bytes]] = []

    def page(k: int) -> tuple[list, int | None] | None:
        offset = k * (end.full or 0)
        raw = get(end.url.format(token=token, page=k + end.first, offset=offset, found=found), offset)
        if raw is None:
            return None
        out.append((k + end.first, raw))
        if not end.entries:
            return None
        value = decoded(raw)
        entries, total = (value.get(end.entries), value.get(end.total)) if isinstance(value, dict) else (None, None)
        return (entries if isinstance(entries, list) else [], total if isinstance(total, int) and not isinstance(total, bool) else None)

    for _ in paged(page, end.full, end.pages):
        pass
    return out


@dataclass
class Request:
    """One feed, or the page at ``url`` where there is one."""

    source_ord: int
    source: str
    company: str = ""
    token: str = ""
    page: int = 1
    url: str = ""


@dataclass
class Requests(InputPartition):
    """Requests that one task makes one after the other, ``delay`` apart."""

    requests: list[Request] = field(default_factory=list)
    delay: float = 0.0


class PayloadReader(DataSourceReader):
    def __init__(self, requests: list[dict], delay: float, via: str):
        self.requests, self.delay, self.via = [Request(**r) for r in requests], delay, via

    def partitions(self) -> list[InputPartition]:
        """A feed is a task of its own, so a failing one fails alone.  Pages of
        one host share a task: its server is asked once in a while only."""
        groups: dict[object, list[Request]] = {}
        for i, r in enumerate(self.requests):
            groups.setdefault(urlsplit(r.url).netloc if r.url and self.delay else i, []).append(r)
        return [Requests(g, self.delay) for g in groups.values()]

    def read(self, partition: Requests | None) -> Iterator[tuple]:
        for i, p in enumerate(partition.requests if partition else ()):  # without requests Spark reads None
            if i and partition.delay:
                time.sleep(partition.delay)
            said = lambda page, body, problem, p=p: (p.source_ord, p.source, p.company, p.token, page, p.url, None if body is None else body.decode("utf-8", "replace"), problem)
            try:
                if p.url:
                    got = [(p.page, fetch(p.source, mirrored(p.url, self.via), call_url))]
                else:
                    got = read_feed(p.source, p.token, self.via) or [(p.page, None)]
            except FetchError as e:  # a row of its own: other sources go on
                yield said(p.page, None, str(e))
            else:
                for page, body in got:
                    yield said(page, body, None)


class PayloadSource(DataSource):
    """``spark.read.format("payloads").option("requests", json)``: payload rows
    for the feed parsers; ``problem`` says why a payload is missing (null
    payload without a problem: not found).

    A request names a source, and its token or an address of its own; feeds are
    read page by page as :data:`ENDPOINTS` says.  Options: ``delay``, seconds
    between two addresses of one host; ``via``, a mirror.
    """

    @classmethod
    def name(cls) -> str:
        return "payloads"

    def schema(self) -> str:
        return "source_ord int, source string, company string, token string, page int, url string, payload string, problem string"

    def reader(self, schema) -> PayloadReader:
        return PayloadReader(json.loads(self.options["requests"]), float(self.options.get("delay", 0)), self.options.get("via", ""))
