"""Functions on small inputs whose results are written by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from siftworks.functions import dates as D
from siftworks.functions import text as T
from siftworks.functions import vocabulary as V
from siftworks.operators import publication
from siftworks.plans import samples
from siftworks.sources import feeds, jobpages, registry


def results(spark, pairs, made):
    """What a column function makes of each input, in order."""
    rows = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(pairs)], "k int, raw string")
    return [r["made"] for r in rows.select("k", made(F.col("raw")).alias("made")).orderBy("k").collect()]


@pytest.mark.parametrize(
    ("pairs", "made"),
    [
        (samples.SLUGS, T.slug),
        (samples.DATES, D.to_iso_utc),
        (samples.MODES, lambda c: T.work_mode(F.lit("unknown"), c)),
        (samples.MODE_NAMES, T.normalise_work_mode),
        (samples.MOJIBAKE, T.repair_mojibake),
        (samples.LINKS, publication.link),
    ],
    ids=["slugs", "dates", "modes", "mode_names", "mojibake", "links"],
)
def test_samples(spark, pairs, made):
    assert results(spark, pairs, made) == [want for _, want in pairs]


def test_four_byte_sequences_are_left_alone(spark):
    damaged = "🙂 é".encode().decode("latin-1")
    assert results(spark, [(damaged, None)], T.repair_mojibake) == [damaged[:-2] + "é"]


def test_headlines(spark):
    assert [tuple(r) for r in results(spark, samples.HEADLINES, T.headline)] == [want for _, want in samples.HEADLINES]


def test_feeds(spark):
    got = []
    for i, (name, payload) in enumerate(samples.PAYLOADS.items()):
        raw = spark.createDataFrame([(i, name, "Acme", "acme", 1, payload)], "source_ord int, source string, company string, token string, page int, payload string")
        got += map(tuple, feeds.parse(raw, name).where("problem IS NULL").select(samples.FEED_COLUMNS).collect())
    assert sorted(got) == sorted(samples.FEED_ROWS)


def test_pages(spark):
    pages = spark.createDataFrame(samples.JOB_PAGES, "url string, html string")
    assert sorted(map(tuple, jobpages.parse_pages(pages, "pages").collect())) == sorted(samples.PAGE_ROWS)


def test_health(spark):
    reg = spark.createDataFrame([(i, n) for i, (n, *_) in enumerate(samples.HEALTH)], "source_ord int, name string")
    raw = spark.createDataFrame([(i, n, "Acme", "acme", 1, p) for i, (n, p) in enumerate(samples.HEALTH_PAYLOADS) if p is not None], "source_ord int, source string, company string, token string, page int, payload string")
    states = feeds.health(reg, feeds.parse_json_feed(raw, "remotive"))
    assert sorted((r["name"], r["n_rows"], r["state"]) for r in states.collect()) == sorted(samples.HEALTH)
    assert tuple(feeds.run_totals(states).first()) == (1, 2, 2, False)


def test_registry(spark):
    rows = spark.createDataFrame([(i, *r[:3]) for i, r in enumerate(samples.REGISTRY)], "k int, name string, feed string, token string")
    got = rows.select("k", registry.problem_column(F.col("name"), F.col("feed"), F.col("token")).alias("p")).orderBy("k").collect()
    assert [r["p"] for r in got] == [r[3] for r in samples.REGISTRY]


def test_card(spark):
    rows = spark.createDataFrame([samples.CARD_ROW], samples.CARD_SCHEMA)
    card = rows.select(publication.card_body({c: F.col(c) for c in rows.columns}).alias("card")).withColumn("id", publication.marked_id(F.col("card"))).first()
    assert tuple(card) == (samples.CARD, samples.CARD_ROW[-1])


def test_terms_inside_and_beside_each_other(spark):
    """Every term that occurs is found, also where two begin at one place; the
    first in order wins, whatever the text's order."""
    words = {"Cloud": ("google cloud",), "Run": ("google cloud run",), "Lead": ("lead",), "Tech lead": ("tech lead",), "R": ("R",), "C++": ("c++",), "v": ("v2x", "7up")}
    texts = [("we use Google Cloud Run", ["Cloud", "Run"]), ("TECH LEAD, c++17", ["C++", "Lead", "Tech lead"]), ("r R2 9R", ["R"]), ("V2X and 7up", ["v"]), ("leader google cloudy", []), (None, [])]
    assert results(spark, texts, lambda c: V.tag(c, words)) == [want for _, want in texts]
    first = [("the lead is a tech lead", "tech lead"), ("lead", "lead"), ("mislead", None), ("Tech-Lead X", "lead"), ("x X", "X")]
    assert results(spark, first, lambda c: V.first_word(c, ["tech lead", "lead", "X", "x"])) == [want for _, want in first]
    assert V.without_prefixes(["a", "b", "ab", "Ac"]) == [["a", "b"], ["ab", "Ac"]]
    digits = "1" * 200_000 + "x"
    assert results(spark, [(digits, [])], lambda c: V.tag(c, words)) == [[]]
