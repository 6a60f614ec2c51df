"""State across runs: dedup, publication, streaming, crawling, configuration."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from siftworks.operators import crawl, dedup, publication, report
from siftworks.plans.collect import collect, normalise
from siftworks.operators.retention import Retention
from siftworks.operators.scoring import Scoring
from siftworks.sources import registry
from siftworks.streaming import incremental

RAW = "id string, source string, company string, title string, location string, remote_type string, url string, date string, description string, ord int"


def raw(spark):
    rows = [
        ("1", "x", "Acme", "Dev  Python", "Remote", "", "https://x/1", "2026-09-05", "<p>sql</p>", 0),
        ("1", "x", "ACME", "Dev", "Remote", "", "https://x/1", "2026-09-06", "", 1),
        ("", "x", "", "Ops", "Paris", "unknown", "https://x/2", "bad", "", 2),
        ("", "x", "", "None", "", "", "", "", "", 3),
        (None, "x", "Beta", None, "Tokyo", "onsite", "https://x/3", None, None, 4),
    ]
    return spark.createDataFrame(rows, RAW)


def test_normalise_drops_only_rows_without_identity(spark):
    rows = normalise(raw(spark)).orderBy("ord").collect()
    assert [r["ord"] for r in rows] == [0, 1, 2, 4]
    assert rows[0]["tech"] == ["Python", "SQL"] and rows[0]["remote_type"] == "remote"
    assert rows[2]["stable_id"].startswith("x:_:") and rows[2]["date"] == ""


def test_second_run_finds_nothing_new(spark):
    seen = spark.createDataFrame([], "stable_id string, first_seen timestamp")
    first = collect(raw(spark), seen, Retention(), Scoring(), "ord")
    ids = [r["stable_id"] for r in first["ranked"].collect()]
    assert len(ids) == 3 and ids[0] == "x:acme:1"
    again = dedup.remember(seen, first["ranked"], F.current_timestamp())
    second = collect(raw(spark), again, Retention(), Scoring(), "ord")
    assert second["ranked"].count() == 0
    assert {r["status"]: r["n"] for r in dedup.status_counts(second["split"]).collect()} == {"seen": 3, "repeat": 1}


def test_run_plan_caps_refuses_and_stops():
    rows = [{"stable_id": str(i), "needs_call": i != 3} for i in range(8)]

    def publish(row):
        if row["stable_id"] == "1":
            raise publication.CallRefused
        if row["stable_id"] == "5":
            raise OSError("down")
        return True

    got = publication.run_plan(rows, publish, cap=10)
    assert got.published == ["0", "2", "4"] and got.refused == ["1"] and got.complete == ["3"]
    assert got.deferred == ["5", "6", "7"] and "down" in got.error
    assert got.treated == ["0", "2", "4", "3", "1"]
    got = publication.run_plan(rows, lambda r: True, cap=2)
    assert got.published == ["0", "1"] and got.complete == ["3"] and got.deferred == ["2", "4", "5", "6", "7"]


def test_stream_remembers_only_what_was_treated(spark, tmp_path):
    landing, seen, mark = (str(tmp_path / n) for n in ("in", "seen", "mark"))
    out = []

    def treat(new):
        rows = new.orderBy("ord").limit(1)
        out.append([r["stable_id"] for r in rows.collect()])
        return rows

    def run(rows):
        spark.createDataFrame(rows, "stable_id string, ord int").write.mode("append").parquet(landing)
        stream = spark.readStream.schema("stable_id string, ord int").parquet(landing)
        incremental.follow(stream, seen, mark, treat, "ord").awaitTermination()

    run([("a", 0), ("b", 1), ("a", 2)])
    run([("a", 3), ("b", 4)])
    assert out == [["a"], ["b"]]
    assert sorted(r["stable_id"] for r in incremental.read_seen(spark, seen).collect()) == ["a", "b"]


def test_robots_groups():
    r = crawl.read_robots("User-agent: a\nDisallow: /x\nUser-agent: sift\nUser-agent: z\nAllow: /y # c\nCrawl-delay: -1\nCrawl-delay: 3\nSitemap: s\n", "SiftBot")
    assert r == crawl.Robots(("/y",), (), 3.0, ("s",))
    assert crawl.read_robots("", "x") == crawl.Robots()
    late = "Disallow: /early\nUser-agent: sift\nUser-agent: sift\nnoise: 1\nUser-agent: other\nAllow: /a\nDisallow: /b\nUser-agent: sift\nDisallow: /c\nUser-agent: siftbot"
    assert crawl.read_robots(late, "SiftB") == crawl.Robots(("/a",), ("/b", "/c"))
    assert crawl.read_robots(late, "siftbot/2") == crawl.Robots()
    assert [r.shut() for r in (crawl.Robots(), crawl.Robots((), ("/",)), crawl.Robots(("/$",), ("/",)), crawl.Robots((), ("/x",)))] == [False, True, False, False]
    assert crawl.Robots().pause() == 1.0 and crawl.Robots(delay=0.0).pause() == 0.0
    assert crawl.read_robots("User-agent: *\nDisallow:\n", "x") == crawl.Robots()


def test_robots_decide_by_the_longest_rule(spark):
    rules = crawl.Robots(("/jobs/open", "/a$", "/c+d%2Fe"), ("/jobs", "/a", "/*.pdf$", "/s%20p", "/caf%C3%A9", "/100%", "/st%2Ar", "/c"))
    want = {"https://h/jobs/open/1": True, "https://h/jobs/2": False, "https://h/a": True, "https://h/ab": False, "https://h/x.pdf": False, "https://h/x.pdf?y": True, "https://h": True}
    want |= {"https://h/s p/c": False, "https://h/s%20p": False, "https://h/café": False, "https://h/caf%c3%a9/x": False, "https://h/100%/x": False, "https://h/100%25": False, "https://h/st*r": False, "https://h/star": True}
    want |= {"https://h/c+d/e": True, "https://h/c%2Bd%2fe": True, "https://h/c d/e": False, "https://h/x%0a.pdf": True}
    rows = spark.createDataFrame([(u, w) for u, w in want.items()], "u string, w boolean")
    assert rows.where(crawl.allowed(F.col("u"), rules) != F.col("w")).count() == 0


def test_first_crawl_looks_back_a_week(spark):
    now = F.to_timestamp(F.lit("2026-09-08 10:00:00"))
    assert spark.range(1).select(crawl.start_cursor(None, now).alias("c")).first()["c"] == "2026-09-01T10:00:00+00:00"
    assert spark.range(1).select(crawl.start_cursor("2026", now).alias("c")).first()["c"] == "2026"


def test_configuration_is_typed():
    good = {"retention": {"tech_include_any": ["zig"]}, "scoring": {"geo_priority": {"europe": 3}, "tech_bonus": {"max": 4, "g": {"points": 2, "techs": ["k8s"]}, "h": {"points": 3, "techs": ["Kubernetes"]}}}}
    keep, rate = registry.filters(good)
    assert rate.points == {"Kubernetes": 3} and rate.cap == 4 and keep.vocabulary["zig"] == ("zig",)
    for bad in ({}, {"retention": {}, "scoring": 3}, {"retention": {"title_include": "x"}, "scoring": {}}, {"retention": {}, "scoring": {"geo_priority": {"a": True}}}, {"retention": {}, "scoring": {}, "retention_days": "7"}):
        with pytest.raises(registry.ConfigError):
            registry.filters(bad)


def test_registries(tmp_path):
    assert registry.tolerant([{"nom": "a", "ats": "lever", "token": "t"}, {"nom": "b", "ats": "lever"}, 3, {"nom": "c", "ats": "remotive"}]) == [registry.Source("a", "lever", "t"), registry.Source("c", "remotive")]
    assert registry.tolerant(None) == [] and registry.tolerant({}) == []
    with pytest.raises(registry.ConfigError):
        registry.strict([{"nom": "a", "ats": "lever"}])
    f = tmp_path / "s.json"
    f.write_text('[{"nom": "a", "ats": "lever", "token": "t"}, {"nom": "c", "ats": "remotive"}]')
    assert [s.name for s in registry.load_all([f, tmp_path / "none.json"], "slow")] == ["c"]
    with pytest.raises(ValueError):
        registry.load_all([f], "never")


def test_sitemap_walk_is_capped_and_visits_once():
    site = {"r": ([], ["a", "b", "a"]), "a": (["u"], []), "b": ([], ["r", "c"]), "c": (["v"], [])}
    from siftworks.sources.jobpages import walk_sitemaps

    assert walk_sitemaps(site.__getitem__, ["r"]) == ["a", "c"]
    assert walk_sitemaps(site.__getitem__, ["r"], cap=2) == ["a"]


def test_sitemaps(spark):
    import gzip

    from siftworks.sources.jobpages import readable, sitemap, sitemap_entries

    xml = b'<urlset xmlns="http://s/"><url><loc> https://x/1 </loc><lastmod>2026-09-05</lastmod></url><url><loc>https://x/2</loc></url><url/></urlset>'
    index = b"<sitemapindex><sitemap><loc></loc><loc> c1 </loc><loc>c2</loc></sitemap><sitemap/></sitemapindex>"
    assert sitemap(index) == ([], ["c1"])
    good = [("p", bytearray(xml)), ("z", bytearray(gzip.compress(xml))), ("i", bytearray(index))]
    bad = [("bad", bytearray(b"<")), ("cut", bytearray(gzip.compress(xml)[:30])), ("none", None), ("flipped", bytearray(gzip.compress(xml)[:12] + b"\xff" * 40))]
    rows = spark.createDataFrame(good + bad, "path string, content binary")
    entries = sitemap_entries(rows)
    want = [(p, i, f"https://x/{i + 1}", "2026-09-05T00:00:00+00:00" if i == 0 else "") for p in ("p", "z") for i in (0, 1)]
    assert sorted(tuple(r)[:4] for r in entries.where("problem is null").collect()) == want
    assert sorted(r["path"] for r in entries.where("problem is not null").collect()) == sorted(p for p, _ in bad)
    assert sorted(map(tuple, readable(sitemap_entries(spark.createDataFrame(good, rows.schema))).collect())) == want
    with pytest.raises(Exception, match="unreadable sitemap"):
        readable(entries).collect()


def test_summaries():
    assert report.retention_line(3, {}) == "3 retenue(s) sur 3"
    assert report.retention_line(3, {"tech": 1, "titre-exclu": 2}) == "3 retenue(s) sur 6 — 3 écartée(s) (titre-exclu 2, tech 1)"
    assert report.dedup_line({"new": 1}) == "1 nouvelle(s) sur 1 — 0 déjà vue(s)"
    assert report.dedup_line({"seen": 2, "repeat": 1}) == "0 nouvelle(s) sur 3 — 2 déjà vue(s), 1 doublon(s) dans le run"
    assert report.scoring_line({}, []) == "0 offre(s) classée(s)"
    assert report.scoring_line({"a": 1, "default": 2}, ["a", "b", "default"]) == "3 offre(s) classée(s) — a 1, default 2"
    run = publication.Run(published=["1"], deferred=["2"], error="X")
    assert report.publication_line(run) == "1 fiche(s) publiée(s) sur 2 offre(s), 1 reportée(s) au run suivant — INTERROMPUE : X"


def test_crawl_holds_the_cursor_back_only_when_capped(spark):
    rows = [("https://x/job/a", "2026-01-01", 0), ("https://x/job/b", "2026-01-03", 1), ("https://x/other", "2026-01-09", 2), ("https://x/job/c", "", 3), ("https://x/job/d", "", 4)]
    entries = spark.createDataFrame(rows, "loc string, lastmod string, pos int")
    known = entries.where("pos = 4").select("loc")
    args = (entries, known, F.lit("2025-12-31"), crawl.Robots(), "/job/")
    wide = crawl.run(*args)
    assert wide["cursor"].first()["cursor"] == "2026-01-09"
    assert [r["loc"] for r in wide["loaded"].collect()] == ["https://x/job/c", "https://x/job/a", "https://x/job/b"]
    assert sorted(r["loc"] for r in wide["known"].collect()) == ["https://x/job/c", "https://x/job/d"]
    tight = crawl.run(*args, cap=2)
    assert tight["cursor"].first()["cursor"] == "2026-01-01" and tight["loaded"].count() == 2
