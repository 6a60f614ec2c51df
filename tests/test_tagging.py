"""Tagging by a vocabulary table against one bounded pattern a term."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from siftworks.functions import vocabulary as V
from siftworks.operators import tagging

TERMS = [
    ("Python", "python"), ("C", "c++"), ("C", "C#"), ("Net", ".net"), ("Net", "asp.net"), ("Rails", "ruby on rails"), ("Rails", "rails"), ("CI", "ci/cd"), ("Go", "Go"), ("Node", "node.js"),
    ("One", "1"), ("Dots", "..."), ("End", "inc."), ("Two", "a  b"), ("Two", "b2b"), ("Accent", "élan"), ("Accent", "über x"), ("Long", "k8"), ("Kelvin", "kilo"), ("Sign", "| on"), ("", "blank"), ("Empty", ""),
]
PIECES = ["python", "Python3", "python3x", "PYTHON", "c++", "C++11", "C#", "c#", ".net", "ASP.NET", "x.net", "ruby on rails", "Rails", "ci/cd", "CI/CD2", "Go", "go", "node.js", "1", "12", "...", "..", "inc.", "inc", "a  b", "a b", "b2b", "b2b2b", "élan", "ÉLAN", "über x", "k8s", "k8", "\u212ailo", "kilo", "\u017f", "| on", "blank", "_", "#", "ruby on  rails"]


def by_patterns(text):
    return sorted({n for n, t in TERMS if t and re.search(V.term_pattern(t).replace("(?iu)", "(?i)"), text or "")}, key=lambda n: (n.lower(), n))


def test_tags_equal_bounded_patterns(spark):
    rng = random.Random(4)
    texts = [None, "", *PIECES] + ["".join(rng.choice(PIECES) + rng.choice(["", " ", " ", ", ", "-", "\n", "."]) for _ in range(rng.randrange(1, 12))) for _ in range(500)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc long, body string, tech string").repartition(3)
    terms = spark.createDataFrame([*TERMS, ("Python", "python")], "name string, term string")
    got = {r["doc"]: r["tech"] for r in tagging.tag_by_table(df, terms, id_col="doc", text_col="body").collect()}
    for i, t in enumerate(texts):
        assert got[i] == by_patterns(t), t


def test_tags_equal_the_projection(spark):
    """The configured vocabulary gives the same names by join and by expression."""
    texts = ["Senior Python3 developer, C++11, node.js", "spring boot2 Spark spark", "CI/CD; ruby on rails8, .NET core", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    joined = tagging.tag_by_table(df, tagging.terms_of(spark, V.TECHNOLOGIES), id_col="id", text_col="text")
    want = {r["id"]: r["tech"] for r in df.select("id", V.tag(F.col("text")).alias("tech")).collect()}
    assert {r["id"]: r["tech"] for r in joined.collect()} == want


def test_no_terms_and_no_texts(spark):
    none = spark.createDataFrame([], "name string, term string")
    df = spark.createDataFrame([(1, "python")], "id int, text string")
    assert tagging.tag_by_table(df, none, id_col="id", text_col="text").collect() == [(1, "python", [])]
    some = spark.createDataFrame([("a", "b")], "name string, term string")
    assert tagging.tag_by_table(df.limit(0), some, id_col="id", text_col="text").collect() == []


def test_plan_holds_no_term(spark):
    """Ten thousand terms: equal plans, joined by key."""
    rows = [(f"n{i}", f"zzterm{i}") for i in range(10_000)]
    terms = spark.createDataFrame(rows, "name string, term string")
    df = spark.createDataFrame([(1, "zzterm77 zzterm9999x zzterm12a")], "id int, text string").repartition(2)
    pairs = tagging.tag_pairs(df, terms, id_col="id", text_col="text")
    want = {f"n{i}" for i in (7, 77, 999, 99, 9, 9999, 1, 12) if re.search(V.term_pattern(f"zzterm{i}"), "zzterm77 zzterm9999x zzterm12a")}
    assert {r["name"] for r in pairs.collect()} == want
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "zzterm" not in plan and "Join Inner" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def shuffled_rows(plan) -> int:
    """Rows that all exchanges of an executed plan wrote."""
    metric = plan.metrics().get("shuffleRecordsWritten")
    inner = plan.children()
    return (metric.get().value() if metric.isDefined() else 0) + sum(shuffled_rows(inner.apply(i)) for i in range(inner.size()))


def test_only_pieces_that_may_be_terms_are_shuffled(spark):
    """Texts of many words, few of them terms, whose table is too large for a broadcast."""
    texts = [(i, " ".join(f"w{i}x{j}" for j in range(400)) + f" order {i} C#{i}") for i in range(50)]
    df = spark.createDataFrame(texts, "id int, text string").repartition(2)
    terms = spark.createDataFrame([(f"n{i}", t) for i in range(25) for t in (f"order {i}", f"C#{i}", f"two {i} of {i}")], "name string, term string")
    held = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        pairs = tagging.tag_pairs(df, terms, id_col="id", text_col="text")
        got = {(r["id"], r["name"]) for r in pairs.collect()}
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert got == {(i, f"n{j}") for i, t in texts for j in range(25) if any(re.search(V.term_pattern(x), t) for x in (f"order {j}", f"C#{j}"))}
    assert shuffled_rows(pairs._jdf.queryExecution().executedPlan()) < 2_000  # 20,000 words


def test_filter_passes_every_key(spark):
    """Also full: with fewer bits than it would need, it lets more pass and loses none."""
    rng = random.Random(5)
    texts = ["".join(rng.choice(PIECES) + rng.choice([" ", ", ", "\n"]) for _ in range(9)) for _ in range(60)]
    terms = tagging.term_table(spark.createDataFrame(TERMS, "name string, term string")).cache()
    shapes = tagging.shapes_of(terms)
    good = tagging.sieve_of(terms, len(TERMS))
    full = tagging.Sieve(good.log2, good.bits | 255)
    keys = {r["key"] for r in terms.collect()}
    fold = lambda k: k if k[0] == tagging.EXACT else "~" + "".join(dict(zip(tagging.ODD, tagging.PLAIN, strict=True)).get(x, x) for x in k[1:]).lower()
    pairs = lambda sieve: {(i, fold(k)) for numbers, found in tagging.sifted(texts, shapes, sieve) for i, k in zip(numbers.tolist(), found.to_pylist(), strict=True)}
    all_of, few = pairs(full), pairs(good)
    assert few <= all_of and {p for p in all_of if p[1] in keys} <= few
    assert len(few) < len(all_of) / 2
    terms.unpersist()


def test_long_and_invalid_texts(spark):
    """Texts beyond a chunk, digits at their ends, and bytes that are no UTF-8."""
    long = "k8s " * 400_000 + "ruby on rails"
    df = spark.createDataFrame([(1, bytearray(long.encode())), (2, bytearray(b"\xff go Go\xc3 node.js2")), (3, bytearray(b"rails")), (4, None)], "id int, raw binary").selectExpr("id", "CAST(raw AS STRING) AS text")
    terms = spark.createDataFrame(TERMS, "name string, term string")
    got = {r["id"]: r["tech"] for r in tagging.tag_by_table(df, terms, id_col="id", text_col="text").collect()}
    assert got == {1: by_patterns(long), 2: ["Go", "Node"], 3: ["Rails"], 4: []}
