"""Fetch policy, payload source, state files, feed problems."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from siftworks.sources import feeds, fetch, state


def run(*answers):
    left, slept = list(answers), []

    def call(url, timeout):
        a = left.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    return lambda: fetch.fetch("acme", "u", call, slept.append), left, slept


def test_policy():
    go, left, slept = run((503, b""), (200, b"x"))
    assert go() == b"x" and slept == [2.0]
    go, left, slept = run(OSError("net"), (200, b"y"))
    assert go() == b"y"
    go, left, slept = run((404, b""))
    assert go() is None and slept == []
    for answers in [((429, b""),), ((500, b""), (500, b"")), (OSError("a"), OSError("b")), ((403, b""),)]:
        go, left, slept = run(*answers)
        with pytest.raises(fetch.FetchError, match="acme"):
            go()
        assert left == []


def test_payload_source(spark, tmp_path):
    spark.dataSource.register(fetch.PayloadSource)
    f = tmp_path / "p.json"
    f.write_text('{"jobs": [{"id": 1, "title": "é", "company_name": "A"}]}', encoding="utf-8")
    base = {"source": "remotive", "company": "", "token": "", "page": 1}
    requests = [base | {"source_ord": 0, "url": f.as_uri()}, base | {"source_ord": 1, "url": (tmp_path / "none").as_uri()}]
    rows = spark.read.format("payloads").option("requests", json.dumps(requests)).load()
    got = {r["source_ord"]: r for r in rows.collect()}
    assert got[0]["problem"] is None and "remotive" in got[1]["problem"] and got[1]["payload"] is None
    parsed = feeds.parse(rows.where("problem is null").drop("problem", "url"), "remotive").collect()
    assert [(r["id"], r["title"], r["problem"]) for r in parsed] == [("1", "é", None)]


class Mirror:
    """A local server with hosts as folders; remembers what was asked."""

    def __init__(self, answer):
        import http.server
        import threading
        import time

        asked = self.asked = []

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_GET(self):
                size = int(self.headers.get("Content-Length") or 0)
                body = json.loads(self.rfile.read(size)) if size else None
                asked.append((time.monotonic(), self.command, self.path, body, dict(self.headers)))
                status, content = answer(self.command, self.path, body)
                self.send_response(status)
                self.end_headers()
                self.wfile.write(content)

            do_POST = do_GET

            def log_message(self, *args):
                pass

        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        self.via = f"http://127.0.0.1:{self.server.server_address[1]}"
        threading.Thread(target=self.server.serve_forever, daemon=True).start()

    def __enter__(self):
        return self

    def __exit__(self, *error):
        self.server.shutdown()


def test_all_feeds_from_a_server(spark):
    """All 17 feeds by their endpoints: methods, bodies, headers, pages, leads."""
    from siftworks.plans import samples

    hosts = {name: end.url.partition("://")[2].partition("?")[0].replace("{token}", "acme").replace("{found}", "77") for name, end in fetch.ENDPOINTS.items()}

    def answer(method, path, body):
        place, _, asked = path[1:].partition("?")
        if place.endswith("/search_by_date"):
            return 200, json.dumps({"hits": [{"title": "Ask HN: Freelancer?", "objectID": "5"}, {"title": " Ask HN: Who is hiring? (May)", "objectID": "77"}]}).encode()
        name = next((n for n, p in hosts.items() if p == place), None)
        if name in ("workable", "apec") and method != "POST" or name is None:
            return 405, b""
        page = json.loads(samples.PAYLOADS[name]) if name in ("smartrecruiters", "freework", "apec") else None
        if name == "smartrecruiters":  # two full pages and a short one
            at = int(asked.partition("offset=")[2])
            page["content"] = [{"id": f"s{at + i}", "name": "Dev"} for i in range(100 if at < 200 else 3)]
        elif name == "freework":  # the total says when to stop
            page["hydra:totalItems"] = 2
            page["hydra:member"][0]["id"] = int(asked.partition("page=")[2])
        elif name == "apec":
            at = body["pagination"]["startIndex"]
            page = {"totalCount": 100, "resultats": [{"numeroOffre": f"N{at + i}", "intitule": "Dev", "nomCommercial": "Acme"} for i in range(20 if at < 40 else 0)]}
        return 200, (samples.PAYLOADS[name] if page is None else json.dumps(page)).encode()

    spark.dataSource.register(fetch.PayloadSource)
    names = list(fetch.ENDPOINTS)
    assert set(names) == {*feeds.JSON_FEEDS, *feeds.RSS_FEEDS}
    requests = [{"source_ord": i, "source": n, "company": "Acme", "token": "acme" if "{token}" in fetch.ENDPOINTS[n].url and not fetch.ENDPOINTS[n].site else ""} for i, n in enumerate(names)]
    hosts |= {n: fetch.ENDPOINTS[n].url.partition("://")[2].partition("?")[0].replace("{token}", fetch.ENDPOINTS[n].token) for n in names if fetch.ENDPOINTS[n].token}
    with Mirror(answer) as mirror:
        asked_once = spark.read.format("payloads").options(requests=json.dumps(requests), via=mirror.via).load()
        rows = spark.createDataFrame(asked_once.collect(), asked_once.schema)
    assert rows.where("problem is not null").count() == 0
    found = {n: feeds.parse(rows.where(F.col("source") == n).drop("problem", "url"), n).where("problem is null").count() for n in names}
    want = {n: sum(r[0] == n for r in samples.FEED_ROWS) for n in names} | {"smartrecruiters": 203, "freework": 2, "apec": 40}
    assert found == want
    by = {n: [a for a in mirror.asked if a[2][1:].partition("?")[0] == hosts[n]] for n in names}
    assert {n: len(a) for n, a in by.items()} == dict.fromkeys(names, 1) | {"smartrecruiters": 3, "freework": 2, "apec": 3}
    assert by["workable"][0][3] == {} and by["apec"][1][3]["pagination"] == {"range": 20, "startIndex": 20} and by["apec"][0][3]["motsCles"] == "developpeur"
    assert by["remotive"][0][4]["Referer"] == "https://remotive.com/" and "Referer" not in by["lever"][0][4]


def test_a_failing_page_fails_its_feed_alone(spark, monkeypatch):
    def call(url, timeout, **more):
        return (200, json.dumps({"content": [{}] * 100}).encode()) if url.endswith("offset=0") else (403, b"")

    with pytest.raises(fetch.FetchError):
        fetch.read_feed("smartrecruiters", "t", call=call)
    assert fetch.read_feed("hackernews", "", call=lambda *a, **k: (200, b'{"hits": []}')) == []
    assert fetch.read_feed("lever", "t", call=lambda *a, **k: (404, b"")) == []
    assert fetch.read_feed("freework", "", call=lambda *a, **k: (200, b"no json")) == [(1, b"no json")]


def test_site_is_crawled_and_remembered_only_as_a_whole(spark):
    """Robots, sitemap index, selection, pause between pages, state."""
    from siftworks.plans import samples
    from siftworks.sources import site

    pages = {"/jobs/acme/one": samples.JOB_PAGES[0][1], "/jobs/acme/two": samples.JOB_PAGES[1][1], "/jobs/acme/lost": None}
    files = {
        "/robots.txt": "User-agent: *\nDisallow: /jobs/shut\nCrawl-delay: 0.3\n",
        "/sitemap.xml": "<sitemapindex><sitemap><loc>https://japan-dev.com/s1.xml</loc></sitemap><sitemap><loc>https://japan-dev.com/gone.xml</loc></sitemap></sitemapindex>",
        "/s1.xml": "<urlset>" + "".join(f"<url><loc>https://japan-dev.com{p}</loc></url>" for p in ["/about", "/jobs/shut/x", "/jobs/acme/known", *pages]) + "</urlset>",
    }
    broken = set()

    def answer(method, path, body):
        at = path.removeprefix("/japan-dev.com")
        text = None if at in broken else files.get(at, pages.get(at))
        return (500 if at in broken and at != "/s1.xml" else 200, b"<urlset><url>" if at in broken else text.encode()) if text is not None or at in broken else (404, b"")

    old = {"japandev": {"cursor": "", "urls": ["https://japan-dev.com/jobs/acme/known"]}}
    with Mirror(answer) as mirror:
        go = lambda: site.crawl_site(spark, site.SITES["japandev"], old, via=mirror.via, sleep=lambda s: None)
        rows, new = go()
        assert sorted(r["company"] for r in rows.collect()) == ["Acme", "Beta"]
        assert new["japandev"]["urls"] == sorted([*old["japandev"]["urls"], *(f"https://japan-dev.com{p}" for p in pages)])
        asked = [a for a in mirror.asked if "/jobs/" in a[2]]
        assert len(asked) == 3 and all(b[0] - a[0] >= 0.29 for a, b in zip(asked, asked[1:]))
        again, _ = site.crawl_site(spark, site.SITES["japandev"], new, via=mirror.via)
        assert again.count() == 0
        for bad in ("/s1.xml", "/robots.txt"):
            broken |= {bad}
            with pytest.raises(fetch.FetchError, match="japandev"):
                go()
            broken.clear()
        files["/robots.txt"] = "User-agent: *\nDisallow: /\n"
        assert go() == (None, old)


def test_pages_of_postings_without_a_company_are_dropped(spark):
    from siftworks.sources import jobpages

    page = '<script type="application/ld+json">{"@type": "JobPosting", "title": "Dev", "hiringOrganization": "%s"}</script>'
    rows = spark.createDataFrame([("https://x/1", page % ""), ("https://x/2", page % "Acme")], "url string, html string")
    assert [r["company"] for r in jobpages.parse_pages(rows, "x").collect()] == ["Acme"]


def test_state_files(tmp_path):
    f = tmp_path / "deep" / "s.json"
    state.write_atomic(f, {"b": "2", "a": "1"})
    assert f.read_text().startswith('{\n  "a"') and list(f.parent.iterdir()) == [f]
    assert state.read_seen(f) == {"a": "1", "b": "2"}
    f.write_text('{"a": 3, "": "x", "c": "d"}')
    assert state.read_seen(f) == {"c": "d"}
    assert state.read_seen(tmp_path / "none") == {}
    f.write_text("[1]")
    assert state.read_seen(f) == {} == state.read_crawl(f)
    f.write_text('{"x": {"cursor": 3, "urls": ["u", 4]}, "y": 5}')
    assert state.read_crawl(f) == {"x": {"cursor": "", "urls": ["u"]}}
    got = state.record_crawl({"x": {"cursor": "2026", "urls": []}}, "x", "2025", ["b", "a", "b"])
    assert got == {"x": {"cursor": "2026", "urls": ["a", "b"]}}


def test_registry_state_is_not_guessed(tmp_path):
    f = tmp_path / "r.json"
    assert state.read_cards(f) == {}
    for bad in ("{", "[]", '{"a": 1}'):
        f.write_text(bad)
        with pytest.raises(state.StateError):
            state.read_cards(f)


def test_feed_problems(spark):
    schema = "source_ord int, source string, company string, token string, page int, payload string"
    payloads = ['{"jobs": [{"id": 1, "title": "a"}, 3, {"id": 2}, {"id": 3, "title": "b", "company_name": "B"}]}', "no json", "{}", None]
    rows = spark.createDataFrame([(i, "remotive", "", "", 1, p) for i, p in enumerate(payloads)], schema)
    got = sorted((r["source_ord"], r["entry_ord"], r["problem"]) for r in feeds.parse(rows, "remotive").select("source_ord", "problem", F.coalesce("entry_ord", F.lit(-1)).alias("entry_ord")).collect() if r["problem"])
    assert got == [(0, 0, "company"), (0, 1, "entry"), (0, 2, "missing"), (1, -1, "shape"), (2, -1, "shape"), (3, -1, "shape")]
    with pytest.raises(ValueError):
        feeds.parse(rows, "nobody")
    bad = spark.createDataFrame([(0, "nodesk", "", "", 1, "<rss><bad"), (1, "nodesk", "", "", 1, "<rss><channel/></rss>")], schema)
    assert [(r["source_ord"], r["problem"]) for r in feeds.parse(bad, "nodesk").collect()] == [(0, "shape")]


def test_hiring_thread(spark):
    hits = json.dumps({"hits": [{"objectID": "1", "title": "Ask HN: Who wants to be hired?"}, {"objectID": "2", "title": " ask HN: Who is hiring? (May)"}, {"objectID": "3", "title": "Ask HN: Who is hiring?"}]})
    assert spark.range(1).select(feeds.hiring_thread(F.lit(hits)).alias("x")).first()["x"] == "2"


def test_paging():
    def pages(*sizes, total=None):
        return lambda p: ([p] * sizes[p], total) if p < len(sizes) else None

    def count(*a, **k):
        return [len(x) for x in fetch.paged(*a, **k)]

    assert count(pages(3, 3, 1, 3), 3, 9) == [3, 3, 1]
    assert count(pages(3, 3, 3), 3, 2) == [3, 3]
    assert count(pages(3, 0, 3), None, 9) == [3]
    assert count(pages(3, 3, 3, total=6), None, 9) == [3, 3]
    assert count(pages(), 3, 9) == []
