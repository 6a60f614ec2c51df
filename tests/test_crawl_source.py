"""Sites as a streaming source: batches, failures, restarts."""

from __future__ import annotations

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_sources import Mirror

from siftworks.functions import dates as D
from siftworks.operators import crawl
from siftworks.sources import jobpages
from siftworks.sources.site import Site
from siftworks.streaming import crawl_source

PAGE = '<script type="application/ld+json">{"@type": "JobPosting", "title": "Dev %s", "hiringOrganization": "Acme"}</script>'
ROBOTS = "User-agent: *\nDisallow: /jobs/a/shut\nCrawl-delay: 0\n"


def sitemap(*entries):
    return "<urlset>" + "".join(f"<url><loc>{loc}</loc>" + (f"<lastmod>{at}</lastmod>" if at else "") + "</url>" for loc, at in entries) + "</urlset>"


def test_a_crawl_in_batches_survives_failures(spark, tmp_path):
    """Two sites, three and more pages each under a cap of two a run; a page that
    breaks kills a batch in the middle.  Every page reaches the sink once."""
    sites = [Site("one", "https://one.example/", "https://one.example/sitemap.xml", r"/jobs/[^/]+/[^/]+$", pages=2), Site("two", "https://two.example/", "https://two.example/sitemap.xml", r"/jobs/[^/]+/[^/]+$", pages=2)]
    dated = [(f"https://one.example/jobs/a/{n}", f"2026-09-0{n}T00:00:00Z") for n in range(1, 6)]
    undated = [(f"https://two.example/jobs/b/{n}", "") for n in "xyz"]
    files = {"/one.example/robots.txt": ROBOTS, "/one.example/sitemap.xml": sitemap(*dated, ("https://one.example/jobs/a/shut", "2026-09-02"), ("https://one.example/about", "2026-09-03")), "/two.example/sitemap.xml": sitemap(*undated)}
    files |= {loc.removeprefix("https:/"): PAGE % loc[-1] for loc, _ in dated + undated}
    broken: set[str] = set()

    def answer(method, path, body):
        return (403, b"") if path in broken else (200, files[path].encode()) if path in files else (404, b"")

    with Mirror(answer) as mirror:

        def run():
            pages = crawl_source.site_pages(spark, sites, via=mirror.via, now="2026-09-03T00:00:00+00:00", exclude='["zzz"]')
            rows = jobpages.parse_pages(pages.where("html IS NOT NULL").select("url", "html"), "x").select("url", "title")
            query = rows.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start()
            query.awaitTermination()

        out = lambda: Counter(r["title"] for r in spark.read.parquet(f"{tmp_path}/out").collect())
        run()
        assert out() == Counter(["Dev 1", "Dev 2", "Dev x", "Dev y"])
        broken.add("/one.example/jobs/a/4")
        with pytest.raises(Exception, match="403"):
            run()
        assert out() == Counter(["Dev 1", "Dev 2", "Dev x", "Dev y"])  # nothing of the batch that died
        files["/one.example/sitemap.xml"] = sitemap(*dated, ("https://one.example/jobs/a/6", "2026-09-06T00:00:00Z"))
        files["/one.example/jobs/a/6"] = PAGE % "6"
        broken.clear()
        for _ in range(3):
            run()
        assert out() == Counter(f"Dev {x}" for x in "123456xyz")
        asked = Counter(a[2] for a in mirror.asked if "/jobs/" in a[2])
        assert asked["/one.example/jobs/a/1"] == 1 and "/one.example/jobs/a/shut" not in asked
        before = sum(asked.values())
        run()  # nothing new: no page is asked again
        assert sum(1 for a in mirror.asked if "/jobs/" in a[2]) == before and sum(out().values()) == 9
        broken.add("/two.example/sitemap.xml")
        with pytest.raises(Exception, match="403"):
            run()


def test_the_plan_equals_the_batch_crawl(spark):
    rng = random.Random(8)
    rules = crawl.Robots(("/jobs/open",), ("/jobs", "/*?x="), 0.0, ())
    site = Site("s", "https://s/", pages=3, pattern="/job")
    for _ in range(6):
        entries = [(f"https://s/jobs/{rng.choice(['open', 'open-sesame', 'shut', 'o%70en'])}/{rng.randrange(9)}{rng.choice(['', '?x=1', '/', '-dev'])}", rng.choice(["", "2026-09-05", "2026-09-05T10:00:00+02:00", f"2026-09-0{rng.randrange(1, 9)}"])) for _ in range(rng.randrange(0, 25))]
        old = {"cursor": rng.choice(["", "2026-09-04T00:00:00+00:00"]), "urls": [loc for loc, _ in entries[::4]]}
        include, exclude = rng.choice([[], ["dev", "1"]]), rng.choice([[], ["2"]])
        shown = [(loc, crawl_source.iso_utc(at)) for loc, at in entries]
        got = crawl_source.plan(shown, old, rules, site, include, exclude, "2026-09-02T00:00:00+00:00")
        frame = spark.createDataFrame([(i, *e) for i, e in enumerate(shown)], "pos long, loc string, lastmod string")
        known = spark.createDataFrame([(u,) for u in old["urls"]], "loc string")
        want = crawl.run(frame, known, F.lit(old["cursor"] or "2026-09-02T00:00:00+00:00"), rules, "/job", include, exclude, 3)
        assert got["pages"] == [r["loc"] for r in want["loaded"].orderBy("lastmod", "pos").collect()]
        assert got["cursor"] == want["cursor"].first()["cursor"]
        assert got["urls"] == sorted(r["loc"] for r in want["known"].collect())


def test_dates_of_sitemaps_are_those_of_the_engine(spark):
    said = ["2026-09-05", "2026-09-05T10:20:30Z", "2026-09-05T10:20:30.5+02:00", "20260905", "Sat, 05 Sep 2026 10:20:30 GMT", "1788603630", "1788603630000", "2026", "", "soon", "2026-13-01"]
    rows = spark.createDataFrame([(s,) for s in said], "s string").select("s", D.to_iso_utc(F.col("s")).alias("iso")).collect()
    assert {r["s"]: r["iso"] for r in rows} == {s: crawl_source.iso_utc(s) for s in said}


def test_offsets_are_plain_json():
    reader = crawl_source.SiteStream({"sites": "[]"})
    first = reader.latestOffset()
    assert json.loads(json.dumps(first)) == first == reader.initialOffset() and reader.partitions(first, first) == []
